"""Boosted regression trees from gradient histograms, grown level by level over a table of bins.

The rows are binned once and written, packed in blocks. While the packed rows are few (``ALONE_BYTES``), one task
holds them and grows all trees in its memory. Beyond that, each level of a tree is one job: tasks pass their rows
down the tree and sum gradients by (node, feature, bin) in numpy, Spark adds the sums up, and every (node,
feature) finds its best split where its histogram is. The driver sees one row for each of them.
"""

from __future__ import annotations

import json
import pickle
import random
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field, fields

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrier.sources.files import remove_folder
from terrier.sources.scratch import own_shuffles_removed, scratch_path, settle

# What runs in tasks is shipped with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Most bins of a numeric column, and rounds whose trees are applied before predictions are written again.
BINS = 64
REFRESH = 1
#: Bytes of packed rows up to which one task fits all trees in its memory; beyond, each level of a tree is a job.
ALONE_BYTES = 192 << 20

_HISTOGRAM = "node int, feature int, bin int, g double, h double"
_SPLIT = "node int, feature int, gain double, cut int, chosen binary, left_g double, left_h double, g double, h double"
_ROW = "tree int, node int, feature int, cut double, chosen binary, left int, right int, value double"


@dataclass
class Tree:
    """Arrays of nodes: feature (-1: leaf), last bin or set of codes that goes left, children, leaf value."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    chosen: list[bytes | None] = field(default_factory=lambda: [None])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def add(self) -> int:
        for column, empty in zip((getattr(self, f.name) for f in fields(self)), (-1, 0, None, 0, 0, 0.0)):
            column.append(empty)
        return len(self.feature) - 1


def _plain(tree: Tree) -> tuple:
    return tuple(getattr(tree, f.name) for f in fields(tree))


def leaves_of(tree: tuple, bins: list[np.ndarray] | np.ndarray, rows: int) -> np.ndarray:
    """The node that each row ends in; all rows go down a level at once. A missing value (-1) and a code outside a set go right."""
    feature, cut, chosen, left, right, _ = tree
    feature, cut, values = np.asarray(feature), np.asarray(cut), np.asarray(bins).reshape(-1)
    inner, own = feature >= 0, np.arange(len(feature))
    left, right = (np.where(inner, np.asarray(x), own) for x in (left, right))
    column = np.where(inner, feature, 0) * rows
    # The bitmaps of all sets as one, with the place and size of each node's.
    sizes = np.array([len(c or b"") for c in chosen])
    start, bits = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(c for c in chosen if c), np.uint8)
    at, index = np.zeros(rows, np.int64), np.arange(rows)
    while inner.take(at).any():
        value = values.take(column.take(at) + index)
        goes = (value >= 0) & (value <= cut.take(at))
        sets = np.flatnonzero(sizes.take(at))
        if len(sets):
            node, code = at[sets], value[sets]
            inside = (code >= 0) & (code < 8 * sizes[node])
            safe = np.where(inside, code, 0)
            goes[sets] = inside & ((bits[start[node] + (safe >> 3)] >> (safe & 7).astype(np.uint8)) & 1).astype(bool)
        at = np.where(goes, left.take(at), right.take(at))
    return at


def sampled(ids: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    """Whether each row takes part in a tree: the same rows wherever they are read."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)) < np.uint64(int(share * 2**53))


def best_split(node: int, feature: int, bins, g, h, nominal: bool, l2: float, least: float) -> tuple:
    """The split of one node by one feature with the largest drop in loss, as a row of ``_SPLIT``.

    Bins are tried as prefixes of their order; nominal codes as prefixes of their order by gradient over
    weight, in which the best set of codes is found. Equal gains go to the first cut.
    """
    bins, g, h = np.asarray(bins), np.asarray(g, float), np.asarray(h, float)
    known = bins >= 0
    total_g, total_h = g.sum(), h.sum()
    bins, g, h = bins[known], g[known], h[known]
    order = np.lexsort((bins, g / h)) if nominal else np.argsort(bins)
    left_g, left_h = np.cumsum(g[order]), np.cumsum(h[order])
    right_g, right_h = total_g - left_g, total_h - left_h
    gain = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - total_g**2 / (total_h + l2)
    gain[(left_h < least) | (right_h < least)] = -np.inf
    if not len(gain) or not np.isfinite(gain.max()):
        return node, feature, -1.0, 0, None, 0.0, 0.0, float(total_g), float(total_h)
    best = int(np.argmax(gain))
    cut, chosen = int(bins[order[best]]), None
    if nominal:
        codes = bins[order[: best + 1]].astype(np.int64)
        bits = np.zeros(int(codes.max()) // 8 + 1, np.uint8)
        np.bitwise_or.at(bits, codes >> 3, (1 << (codes & 7)).astype(np.uint8))
        chosen = bits.tobytes()
    return (node, feature, float(gain[best]), cut, chosen, float(left_g[best]), float(left_h[best]), float(total_g), float(total_h))


def _binned(value: np.ndarray, edges: list[float]) -> np.ndarray:
    found = np.searchsorted(np.asarray(edges), value, "left").astype(np.int32)
    return np.where(np.isnan(value), -1, found).astype(np.int32)


def bin_columns(columns: list[np.ndarray], names: list[str], edges: dict[str, list[float]]) -> list[np.ndarray]:
    """Bins of numeric columns by their edges, codes of the others as they are."""
    return [
        _binned(np.asarray(c, float), edges[n]) if n in edges else np.where(np.isnan(np.asarray(c, float)), -1, c).astype(np.int32)
        for n, c in zip(names, columns, strict=True)
    ]


@dataclass
class BoostedTrees:
    """A fitted ensemble: ``transform`` adds ``prediction`` to rows that hold its features."""

    features: list[str]
    edges: dict[str, list[float]]
    base: float
    rate: float
    trees: list[Tree]
    losses: list[float]
    prediction: str = "log_price"

    @property
    def rounds(self) -> int:
        return len(self.trees)

    def plain(self) -> list[tuple]:
        return [_plain(t) for t in self.trees]

    def transform(self, df: DataFrame) -> DataFrame:
        names, edges, base, rate = self.features, self.edges, self.base, self.rate
        sent = df.sparkSession.sparkContext.broadcast(self.plain())

        @F.pandas_udf("double")
        def score(table: pd.DataFrame) -> pd.Series:
            bins = np.stack(bin_columns([table[n].to_numpy(float, na_value=np.nan) for n in names], names, edges))
            total = np.full(len(table), base)
            for tree in sent.value:
                total += rate * np.asarray(tree[5])[leaves_of(tree, bins, len(total))]
            return pd.Series(total)

        return df.withColumn(self.prediction, score(F.struct(*[F.col(f"`{n}`").cast("double").alias(n) for n in names])))

    def curve(self, df: DataFrame, target: str) -> DataFrame:
        """round, loss: the mean squared error on rows after each round, from one pass."""
        names, edges, base, rate = self.features, self.edges, self.base, self.rate
        sent = df.sparkSession.sparkContext.broadcast(self.plain())

        def sums(tables):
            for table in tables:
                bins = np.stack(bin_columns([table[n].to_numpy(float, na_value=np.nan) for n in names], names, edges))
                total, y = np.full(len(table), base), table["y"].to_numpy(float)
                found = []
                for number, tree in enumerate(sent.value, 1):
                    total += rate * np.asarray(tree[5])[leaves_of(tree, bins, len(total))]
                    found.append((number, float(np.square(total - y).sum()), len(y)))
                yield pd.DataFrame(found, columns=["round", "error", "n"])

        rows = df.select(*[F.col(f"`{n}`").cast("double").alias(n) for n in names], F.col(target).cast("double").alias("y"))
        sums = rows.mapInPandas(sums, "round int, error double, n long")
        return sums.groupBy("round").agg((F.sum("error") / F.sum("n")).alias("loss")).orderBy("round")

    def save(self, spark: SparkSession, path: str) -> None:
        """Nodes and head as Parquet tables; any path scheme Spark can write works."""
        rows = [
            (t, i, tree.feature[i], float(tree.cut[i]), tree.chosen[i], tree.left[i], tree.right[i], float(tree.value[i]))
            for t, tree in enumerate(self.trees)
            for i in range(len(tree.feature))
        ]
        spark.createDataFrame(rows, _ROW).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        head = {n: getattr(self, n) for n in ("features", "edges", "base", "rate", "losses", "prediction")}
        spark.createDataFrame([(json.dumps(head),)], "head string").coalesce(1).write.mode("overwrite").parquet(f"{path}/head")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        head = json.loads(spark.read.parquet(f"{path}/head").first()["head"])
        trees: dict[int, Tree] = {}
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            tree = trees.setdefault(r["tree"], Tree())
            node = r["node"] if r["node"] == 0 else tree.add()
            tree.feature[node], tree.cut[node], tree.value[node] = r["feature"], int(r["cut"]), r["value"]
            tree.left[node], tree.right[node] = r["left"], r["right"]
            tree.chosen[node] = None if r["chosen"] is None else bytes(r["chosen"])
        return cls(trees=[trees[t] for t in sorted(trees)], **head)


def bin_edges(rows: DataFrame, columns: list[str], bins: int = BINS) -> dict[str, list[float]]:
    """Upper ends of the bins of each column, from one pass of quantile sketches. They are candidate cuts only."""
    found = rows.approxQuantile(columns, [i / bins for i in range(1, bins)], 0.2 / bins)
    return {c: sorted(set(values)) for c, values in zip(columns, found, strict=True)}


@dataclass(frozen=True)
class _Blocks:
    """How rows are packed, one block a batch: targets, scores, then each feature, as bytes of one record."""

    kinds: tuple[str, ...]

    SCHEMA = "part int, first long, n long, data binary"

    def width(self) -> int:
        return 16 + sum(np.dtype(k).itemsize for k in self.kinds)

    def order(self) -> list[int]:
        return sorted(range(len(self.kinds)), key=lambda i: -np.dtype(self.kinds[i]).itemsize)

    def pack(self, part: int, first: int, y: np.ndarray, score: np.ndarray, bins: list[np.ndarray]) -> pa.RecordBatch:
        columns = [y, score, *(bins[i].astype(self.kinds[i], copy=False) for i in self.order())]
        arrays = [pa.array([part], pa.int32()), pa.array([first]), pa.array([len(y)]), pa.array([b"".join(c.tobytes() for c in columns)], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["part", "first", "n", "data"])

    def read(self, batches) -> Iterator[tuple]:
        """(part, number of the first row, targets, scores, bins) of each block."""
        for batch in batches:
            parts, firsts, sizes = (batch.column(i).to_pylist() for i in range(3))
            for i, (part, first, n) in enumerate(zip(parts, firsts, sizes, strict=True)):
                data, at, found = batch.column(3)[i].as_py(), 16 * n, {}
                for f in self.order():
                    kind = np.dtype(self.kinds[f])
                    found[f] = np.frombuffer(data, kind, n, at)
                    at += n * kind.itemsize
                y, score = np.frombuffer(data, float, n, 0), np.frombuffer(data, float, n, 8 * n)
                yield part, first, y, score, [found[f] for f in range(len(self.kinds))]


@dataclass(frozen=True)
class _How:
    """What a level needs to know besides the rows."""

    blocks: _Blocks
    nominal: frozenset[int]
    bins: int
    rate: float
    seed: int
    share: float
    l2: float
    least: float


def fit_trees(
    fit: DataFrame,
    target: str,
    numeric: list[str],
    nominal: list[str],
    validation: DataFrame | None = None,
    patience: int = 5,
    rounds: int = 100,
    depth: int = 8,
    rate: float = 0.05,
    row_share: float = 0.8,
    column_share: float = 0.8,
    l2: float = 1.0,
    gamma: float = 0.1,
    least: float = 1.0,
    seed: int = 42,
    bins: int = BINS,
    prediction: str = "log_price",
) -> BoostedTrees:
    """Boosted trees for a squared error, with second-order leaf values.

    A split's gain is GL^2/(HL + l2) + GR^2/(HR + l2) - G^2/(H + l2); each child needs a weight of ``least``. Trees
    grow to ``depth`` while the gain is positive; then splits above leaves whose gain is below ``gamma`` are
    taken back. Each tree draws its columns and rows. Nominal columns hold codes from 0 on; a split of
    one is a set of codes. With validation rows, fitting ends after ``patience`` rounds without a lower
    error, and the trees up to the lowest stay. Features may be missing (they go right), targets not.
    """
    spark = fit.sparkSession
    features = [*numeric, *nominal]
    edges = bin_edges(fit, numeric, bins)
    base = fit.agg(F.avg(target)).first()[0]
    if base is None:
        raise ValueError("no rows to fit")
    both = fit.select(*features, target, F.lit(0).alias("part"))
    if validation is not None:
        both = both.unionByName(validation.select(*features, target, F.lit(1).alias("part")))
    columns = [F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)]
    small = "int8" if max(map(len, edges.values()), default=0) < 127 else "int32"
    blocks = _Blocks((small,) * len(numeric) + ("int32",) * len(nominal))
    how = _How(blocks, frozenset(range(len(numeric), len(features))), bins + 1, rate, seed, row_share, l2, least)

    def bin_rows(batches):
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            values = [batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(features))]
            found = bin_columns(values, features, edges)
            y, part = (batch.column(len(features) + i).to_numpy(zero_copy_only=False) for i in range(2))
            for p in np.unique(part).tolist():
                own = part == p
                yield blocks.pack(p, number, y[own], np.full(np.count_nonzero(own), float(base)), [f[own] for f in found])
                number += np.count_nonzero(own)

    numbered = both.select(*columns, F.col(target).cast("double").alias("y"), "part")
    packed = numbered.mapInArrow(bin_rows, blocks.SCHEMA).repartition(spark.sparkContext.defaultParallelism)
    path = scratch_path(spark, "bins")
    rows = settle(packed, "bins", path)

    model = BoostedTrees(features, edges, float(base), rate, [], [], prediction)
    draw = _Draw(len(features), column_share, seed)
    judged = validation is not None
    if rows.agg(F.sum("n")).first()[0] * blocks.width() <= ALONE_BYTES:

        def alone(batches):
            held = _Alone(blocks.read(batches), how)
            trees, losses = _boost(held.level, held.passed, draw, judged, patience, rounds, depth, l2, gamma)
            # Plain lists: classes that were shipped by value can't be sent back by name.
            found = pickle.dumps(([_plain(t) for t in trees], losses))
            yield pa.RecordBatch.from_arrays([pa.array([found], pa.binary())], names=["found"])

        trees, model.losses = pickle.loads(rows.coalesce(1).mapInArrow(alone, "found binary").collect()[0]["found"])
        model.trees = [Tree(*t) for t in trees]
        return model

    pending: list[Tree] = []

    def level(tree, open_nodes, used, number, judge):
        return _level(rows, pending, tree, open_nodes, used, number, judge, how)

    def passed(tree):
        nonlocal rows, pending, path
        pending.append(tree)
        if len(pending) == REFRESH:
            before, path = path, scratch_path(spark, "bins")
            rows, pending = settle(_refreshed(rows, pending, how), "bins", path), []
            remove_folder(spark, before)

    model.trees, model.losses = _boost(level, passed, draw, judged, patience, rounds, depth, l2, gamma)
    return model


@dataclass(frozen=True)
class _Draw:
    """The columns of each tree, in their order."""

    count: int
    share: float
    seed: int

    def __iter__(self) -> Iterator[list[int]]:
        draw = random.Random(self.seed)
        while True:
            yield sorted(draw.sample(range(self.count), max(1, int(self.share * self.count))))


def _boost(level, passed, draw, judged: bool, patience: int, rounds: int, depth: int, l2: float, gamma: float) -> tuple[list[Tree], list[float]]:
    """The trees, and with rows to judge by their errors, cut after the lowest.

    ``level`` gives the error so far, if asked for, and the best splits of open nodes; ``passed`` is told of each tree.
    """
    trees, losses, best = [], [], 0
    # One more pass than rounds judges the last tree; the error of a tree comes with the next one's first level.
    for number, used in zip(range(rounds + judged), draw):
        tree, sums = Tree(), {}
        open_nodes = [0] if number < rounds else []
        for at in range(depth):
            loss, splits = level(tree, open_nodes, used, number, judged and at == 0 and number > 0)
            if loss is not None:
                losses.append(loss)
                if loss < losses[best]:
                    best = number - 1
                if number - 1 - best >= patience:
                    break
            chosen = {}
            for s in sorted(splits, key=lambda s: (s["node"], -_digits(s["gain"]), s["feature"])):
                chosen.setdefault(s["node"], s)
            if at == 0 and chosen:
                sums[0] = (chosen[0]["g"], chosen[0]["h"], 0.0)
            next_nodes = []
            for node, s in chosen.items():
                if s["gain"] <= 1e-9:
                    continue
                tree.feature[node], tree.cut[node] = s["feature"], s["cut"]
                tree.chosen[node] = None if s["chosen"] is None else bytes(s["chosen"])
                tree.left[node], tree.right[node] = tree.add(), tree.add()
                sums[node] = (s["g"], s["h"], s["gain"])
                sums[tree.left[node]] = (s["left_g"], s["left_h"], 0.0)
                sums[tree.right[node]] = (s["g"] - s["left_g"], s["h"] - s["left_h"], 0.0)
                next_nodes += [tree.left[node], tree.right[node]]
            open_nodes = next_nodes
            if not open_nodes:
                break
        if number == rounds or (losses and number - 1 - best >= patience):
            break
        _prune(tree, sums, gamma, l2)
        trees.append(tree)
        passed(tree)
    return (trees[: best + 1], losses[: best + 1]) if judged else (trees, losses)


def _digits(gain: float) -> float:
    """Nine digits: columns that split the same rows alike are equal, in whatever order the sums were taken."""
    return float(f"{gain:.9g}")


def _goes_left(value: np.ndarray, cut: int, chosen: bytes | None) -> np.ndarray:
    """Which bins or codes go left. A missing value (-1) and a code outside a set go right."""
    if chosen is None:
        return (value >= 0) & (value <= cut)
    bits = np.frombuffer(chosen, np.uint8)
    inside = (value >= 0) & (value < 8 * len(bits))
    safe = np.where(inside, value, 0)
    return inside & ((bits[safe >> 3] >> (safe & 7).astype(np.uint8)) & 1).astype(bool)


def best_numeric_splits(g: np.ndarray, h: np.ndarray, l2: float, least: float) -> tuple[np.ndarray, ...]:
    """For histograms [feature, node, bin], the first bin of those without a value: gain, cut, sums on the left, all sums."""
    total_g, total_h = g.sum(axis=2), h.sum(axis=2)
    left_g, left_h = np.cumsum(g[:, :, 1:], axis=2), np.cumsum(h[:, :, 1:], axis=2)
    right_g, right_h = total_g[:, :, None] - left_g, total_h[:, :, None] - left_h
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - (total_g**2 / (total_h + l2))[:, :, None]
    gain[(h[:, :, 1:] == 0) | (left_h < least) | (right_h < least) | ~np.isfinite(gain)] = -np.inf
    cut = gain.argmax(axis=2)
    best, own_g, own_h = (np.take_along_axis(x, cut[:, :, None], 2)[:, :, 0] for x in (gain, left_g, left_h))
    return best, cut, own_g, own_h, total_g, total_h


class _Alone:
    """All packed rows in the memory of one task, with the rows of a growing tree kept together by node.

    Of two children, the one with fewer rows is counted; the sums of the other are what the parent's leave.
    """

    #: Slots of a table of codes by node that is counted at once.
    SLOTS = 1 << 22
    #: Values of several numeric columns taken together, which are counted in one go, and rows that are counted at once.
    JOINT = 512
    PIECE = 1 << 15

    def __init__(self, blocks, how: _How):
        self.how, count = how, len(how.blocks.kinds)
        parts: dict[int, list] = {0: [], 1: []}
        for part, first, *columns in blocks:
            parts[part].append((first, *columns))
        # Column by column, so that little is there twice.
        fit, held = ([[b[i] for b in parts[p]] for i in (1, 2)] for p in (0, 1))
        whole = lambda arrays, kind: np.concatenate(arrays) if arrays else np.zeros(0, kind)
        self.y, self.score, self.held_y, self.held_score = (whole(x, float) for x in (*fit, *held))
        self.bins, self.held_bins = ([whole([b[3][f] for b in parts[p]], how.blocks.kinds[f]) for f in range(count)] for p in (0, 1))
        self.ids = whole([b[0] + np.arange(len(b[1])) for b in parts[0]], np.int64)
        self.codes = {f: int(self.bins[f].max(initial=-1)) + 2 for f in how.nominal}
        self.coded = {f: self.bins[f] + 1 for f in how.nominal}
        self.groups = self._joined([f for f in range(count) if f not in how.nominal])
        self.rows, self.rest = np.zeros(0, np.int64), np.arange(len(self.y))
        self.ends, self.leaves = {}, []

    def _joined(self, columns: list[int]) -> list[tuple]:
        """Columns of few bins are joined to one: (columns, their sizes, their bins as one number)."""
        sizes = {f: int(self.bins[f].max(initial=-1)) + 2 for f in columns}
        groups: list[list[int]] = []
        for f in sorted(columns, key=sizes.get):
            if groups and sizes[f] * np.prod([sizes[x] for x in groups[-1]]) <= self.JOINT:
                groups[-1].append(f)
            else:
                groups.append([f])
        found = []
        for group in groups:
            joint = np.zeros(len(self.y), np.int32)
            for f in group:
                joint = joint * sizes[f] + self.bins[f] + 1
            found.append((group, [sizes[f] for f in group], joint.astype("int16" if joint.max(initial=0) < 1 << 15 else "int32")))
        return found

    def level(self, tree: Tree, open_nodes: list[int], used: list[int], number: int, judge: bool) -> tuple:
        loss = None
        if judge:
            loss = float(np.square(self.held_score - self.held_y).mean()) if len(self.held_y) else float("inf")
        if not open_nodes:
            return loss, []
        if len(tree.feature) == 1:
            take = sampled(self.ids, number, self.how.seed, self.how.share)
            self.rows, self.rest = np.flatnonzero(take), np.flatnonzero(~take)
            self.gradient = self.score - self.y
            self.ends, self.leaves = {0: (0, len(self.rows))}, []
            self.numeric, self.nominal = {}, {}
            if not len(self.rows):
                return loss, []
            counted, others = [0], {}
        else:
            self._divide(tree)
            size = {n: b - a for n, (a, b) in self.ends.items()}
            counted, others = [], {}
            for node in (n for n in range(len(tree.feature)) if tree.left[n] in size):
                less, more = sorted((tree.left[node], tree.right[node]), key=size.get)
                counted.append(less)
                others[more] = (node, less)
        self._count(counted, others, used)
        return loss, self._splits(open_nodes, used)

    def passed(self, tree: Tree) -> None:
        """Scores move on by a finished tree; rows below a split that was taken back end at it."""
        self._divide(tree)
        self.leaves += [(n, self.rows[a:b]) for n, (a, b) in self.ends.items()]
        value, todo = {}, [(0, None)]
        while todo:
            node, above = todo.pop()
            own = tree.value[node] if above is None and tree.feature[node] < 0 else above
            value[node] = own
            if tree.left[node]:
                todo += [(tree.left[node], own), (tree.right[node], own)]
        for node, rows in self.leaves:
            self.score[rows] += self.how.rate * value[node]
        for a in range(0, len(self.rest), self.PIECE):
            rows = self.rest[a : a + self.PIECE]
            self.score[rows] += self._gained(tree, [b[rows] for b in self.bins], len(rows))
        for a in range(0, len(self.held_y), self.PIECE):
            here = slice(a, a + self.PIECE)
            self.held_score[here] += self._gained(tree, [b[here] for b in self.held_bins], len(self.held_y[here]))

    def _gained(self, tree: Tree, bins: list[np.ndarray], rows: int) -> np.ndarray:
        return self.how.rate * np.asarray(tree.value)[leaves_of(_plain(tree), bins, rows)]

    def _divide(self, tree: Tree) -> None:
        """The rows by the children of the nodes that were split; what was not is a leaf."""
        rows, ends, at = [], {}, 0
        for node, (a, b) in self.ends.items():
            here = self.rows[a:b]
            if not tree.left[node]:
                self.leaves.append((node, here))
                continue
            goes = _goes_left(self.bins[self.split[node][0]][here], *self.split[node][1:])
            for child, own in ((tree.left[node], here[goes]), (tree.right[node], here[~goes])):
                rows.append(own)
                ends[child] = (at, at + len(own))
                at += len(own)
        self.rows = np.concatenate(rows) if rows else self.rows[:0]
        self.ends = ends

    def _count(self, counted: list[int], others: dict[int, tuple[int, int]], used: list[int]) -> None:
        """Sums of gradients and rows by bin (numeric) or by code (nominal) of every open node."""
        parts = [self.rows[slice(*self.ends[n])] for n in counted]
        rows, sizes = np.concatenate(parts), [len(p) for p in parts]
        g, place = self.gradient[rows], np.repeat(np.arange(len(counted)), sizes)
        before = self.numeric, self.nominal
        self.numeric, self.nominal = {n: {} for n in (*counted, *others)}, {n: {} for n in (*counted, *others)}
        starts = np.cumsum([0, *sizes])
        for columns, sizes, joint in self.groups:
            if not set(columns) & set(used):
                continue
            sums = self._joint_sums(joint, rows, place, g, len(counted), int(np.prod(sizes))).reshape(2, len(counted), *sizes)
            for i, f in enumerate(columns):
                if f in used:
                    own = sums.sum(axis=tuple(k + 2 for k in range(len(columns)) if k != i))
                    padded = np.zeros((len(counted), 2, self.how.bins))
                    padded[:, :, : sizes[i]] = own.transpose(1, 0, 2)
                    for n, x in zip(counted, padded, strict=True):
                        self.numeric[n][f] = x
        for f in (f for f in used if f in self.how.nominal):
            step = max(1, self.SLOTS // self.codes[f])
            for a in range(0, len(counted), step):
                nodes = counted[a : a + step]
                here = slice(starts[a], starts[a + len(nodes)])
                g_sums, n = self._joint_sums(self.coded[f], rows[here], place[here] - a, g[here], len(nodes), self.codes[f])
                there = np.flatnonzero(n)
                found = there % self.codes[f] - 1, g_sums[there], n[there]
                cuts = np.searchsorted(there, np.arange(1, len(nodes)) * self.codes[f])
                for node, *own in zip(nodes, *(np.split(x, cuts) for x in found), strict=True):
                    self.nominal[node][f] = own
        for more, (parent, less) in others.items():
            for f in used:
                if f not in self.how.nominal:
                    own = before[0][parent][f] - self.numeric[less][f]
                    own[0][own[1] == 0] = 0.0
                    self.numeric[more][f] = own
                    continue
                codes, g, n = (x.copy() for x in before[1][parent][f])
                taken = np.searchsorted(codes, self.nominal[less][f][0])
                g[taken] -= self.nominal[less][f][1]
                n[taken] -= self.nominal[less][f][2]
                self.nominal[more][f] = [x[n > 0] for x in (codes, g, n)]

    def _joint_sums(self, joint, rows, place, g, nodes: int, width: int) -> np.ndarray:
        """Sums of gradients and rows by node and value, in pieces that stay in the processor's cache."""
        sums = np.zeros((2, nodes * width))
        piece = max(self.PIECE, width)
        for a in range(0, len(rows), piece):
            here = slice(a, a + piece)
            low, high = int(place[here][0]), int(place[here][-1]) + 1
            key = joint.take(rows[here])
            if high - low > 1:
                key = (place[here] - low) * width + key
            for own, weight in zip(sums[:, low * width : high * width], (g[here], None), strict=True):
                own += np.bincount(key, weight, (high - low) * width)
        return sums

    def _splits(self, open_nodes: list[int], used: list[int]) -> list[dict]:
        names = ["node", "feature", "gain", "cut", "chosen", "left_g", "left_h", "g", "h"]
        plain = [f for f in used if f not in self.how.nominal]
        found = []
        if plain:
            sums = np.stack([[self.numeric[n][f] for n in open_nodes] for f in plain])
            gain, cut, left_g, left_h, g, h = best_numeric_splits(sums[:, :, 0], sums[:, :, 1], self.how.l2, self.how.least)
            most = gain.max(axis=0)
            for i, (node, k) in enumerate(zip(open_nodes, (gain >= most - 1e-9 * np.abs(most)).argmax(axis=0).tolist(), strict=True)):
                best = float(gain[k, i]) if np.isfinite(gain[k, i]) else -1.0
                found.append((node, plain[k], best, int(cut[k, i]), None, *(float(x[k, i]) for x in (left_g, left_h, g, h))))
        for f in (f for f in used if f in self.how.nominal):
            found += [best_split(n, f, *self.nominal[n][f], True, self.how.l2, self.how.least) for n in open_nodes if len(self.nominal[n][f][0])]
        best = {}
        for s in sorted(found, key=lambda s: (s[0], -_digits(s[2]), s[1])):
            best.setdefault(s[0], dict(zip(names, s, strict=True)))
        self.split = {n: (s["feature"], s["cut"], s["chosen"]) for n, s in best.items()}
        return list(best.values())


def _passed(block: tuple, pending: list[tuple], rate: float) -> np.ndarray:
    """The scores of a block once the trees since the last writing are applied."""
    _, _, y, score, bins = block
    for tree in pending:
        score = score + rate * np.asarray(tree[5])[leaves_of(tree, bins, len(y))]
    return score


def _refreshed(rows: DataFrame, pending: list[Tree], how: _How) -> DataFrame:
    """The rows with their scores moved on by the trees since the last writing."""
    plain = [_plain(t) for t in pending]

    def run(batches):
        for block in how.blocks.read(batches):
            part, first, y, _, bins = block
            yield how.blocks.pack(part, first, y, _passed(block, plain, how.rate), bins)

    return rows.mapInArrow(run, how.blocks.SCHEMA)


def _level(rows, pending, tree, open_nodes, used, number, judge, how):
    """The best split of every open node by every used feature, and the validation error so far if asked for."""
    plain = [_plain(t) for t in pending]
    growing = _plain(tree)
    place = np.full(len(tree.feature), -1, np.int64)
    place[open_nodes] = np.arange(len(open_nodes))

    def partial(batches):
        dense = {f: np.zeros((2, len(open_nodes) * how.bins)) for f in used if f not in how.nominal}
        held: dict[int, list[np.ndarray]] = {}
        fresh: dict[int, list[tuple]] = {f: [] for f in used if f in how.nominal}
        waiting = dict.fromkeys(fresh, 0)
        error = np.zeros(2)

        def merge(f):
            keys, g, h = (np.concatenate(x) for x in zip(*fresh[f], *([held[f]] if f in held else []), strict=True))
            unique, inverse = np.unique(keys, return_inverse=True)
            held[f] = [unique, np.bincount(inverse, g, len(unique)), np.bincount(inverse, h, len(unique))]
            fresh[f], waiting[f] = [], 0

        for block in how.blocks.read(batches):
            part, first, y, _, bins = block
            if part and not judge:
                continue
            gradient = _passed(block, plain, how.rate) - y
            if part:
                error += (np.square(gradient).sum(), len(y))
                continue
            take = np.flatnonzero(sampled(first + np.arange(len(y)), number, how.seed, how.share))
            node = place[leaves_of(growing, [b[take] for b in bins], len(take))]
            take, node = take[node >= 0], node[node >= 0]
            g = gradient[take]
            for f in used:
                value = bins[f][take]
                if f in dense:
                    key = node * how.bins + 1 + value
                    dense[f] += [np.bincount(key, w, dense[f].shape[1]) for w in (g, None)]
                elif len(take):
                    fresh[f].append(((node << 32) + (value.astype(np.int64) + 1), g, np.ones(len(g))))
                    waiting[f] += len(g)
                    # Merged once as many wait as are held: each is then gone through a few times only.
                    if waiting[f] >= max(1 << 18, len(held[f][0]) if f in held else 0):
                        merge(f)
        for f in used:
            if f in dense:
                there = np.flatnonzero(dense[f][1])
                keys, g, h = (there // how.bins << 32) + there % how.bins, *dense[f][:, there]
            else:
                if fresh[f]:
                    merge(f)
                keys, g, h = held.get(f, [np.zeros(0, np.int64), np.zeros(0), np.zeros(0)])
            nodes = np.asarray(open_nodes, np.int32)[keys >> 32]
            feature = np.full(len(keys), f, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(feature), pa.array(((keys & 0xFFFFFFFF) - 1).astype(np.int32)), pa.array(g), pa.array(h)],
                names=["node", "feature", "bin", "g", "h"],
            )
        if judge:
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1], pa.int32())] * 3 + [pa.array([error[0]]), pa.array([error[1]])], names=["node", "feature", "bin", "g", "h"]
            )

    def find(batches):
        def splits(columns):
            node, feature, bins, g, h = columns
            edges = np.flatnonzero(np.append(True, (node[1:] != node[:-1]) | (feature[1:] != feature[:-1])))
            found = []
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(node)], strict=True):
                n, f = int(node[a]), int(feature[a])
                if n < 0:
                    found.append((n, f, 0.0, 0, None, 0.0, 0.0, float(g[a:b].sum()), float(h[a:b].sum())))
                else:
                    found.append(best_split(n, f, bins[a:b], g[a:b], h[a:b], f in how.nominal, how.l2, how.least))
            return pd.DataFrame(found, columns=["node", "feature", "gain", "cut", "chosen", "left_g", "left_h", "g", "h"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if held is not None:
                columns = [np.concatenate(c) for c in zip(held, columns, strict=True)]
            node, feature = columns[:2]
            last = int(np.flatnonzero((node != node[-1]) | (feature != feature[-1]))[-1]) + 1 if (node[0], feature[0]) != (node[-1], feature[-1]) else 0
            if last:  # the last histogram may go on in the next batch
                yield pa.RecordBatch.from_pandas(splits([c[:last] for c in columns]), schema=kind, preserve_index=False)
            held = [c[last:] for c in columns]
        if held is not None:
            yield pa.RecordBatch.from_pandas(splits(held), schema=kind, preserve_index=False)

    whole, number_type, real = pa.int32(), pa.binary(), pa.float64()
    kinds = [whole, whole, real, whole, number_type, real, real, real, real]
    kind = pa.schema(list(zip(["node", "feature", "gain", "cut", "chosen", "left_g", "left_h", "g", "h"], kinds, strict=True)))
    sums = rows.mapInArrow(partial, _HISTOGRAM).repartition("node", "feature")
    sums = sums.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    with own_shuffles_removed(rows.sparkSession):
        found = sums.sortWithinPartitions("node", "feature").mapInArrow(find, _SPLIT).collect()
    loss = next((r["g"] / r["h"] if r["h"] else float("inf") for r in found if r["node"] < 0), None)
    return loss, [r for r in found if r["node"] >= 0]


def _prune(tree: Tree, sums: dict, gamma: float, l2: float) -> None:
    """Take back splits above two leaves that gain less than ``gamma``, from below, and set the leaves' values."""
    for node in reversed(range(len(tree.feature))):
        if tree.feature[node] >= 0:
            ends = tree.feature[tree.left[node]] < 0 and tree.feature[tree.right[node]] < 0
            if ends and sums[node][2] < gamma:
                tree.feature[node], tree.chosen[node] = -1, None
        if tree.feature[node] < 0:
            g, h, _ = sums.get(node, (0.0, 0.0, 0.0))
            tree.value[node] = -g / (h + l2)
