"""Nearest neighbours through a hierarchical k-means tree with best-bin-first search."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrier.llm.common import bounded_sample, map_rows, sorted_runs
from terrier.sources.scratch import settle

#: Vectors that the tree is fitted on at most, children of a node, sample vectors of a leaf.
FIT_ROWS = 20_000
BRANCH = 16
LEAF_SAMPLE = 40
#: Queries that calibrate the number of leaves to visit, and the recall that it must reach.
CALIBRATION = 128
RECALL = 0.97
#: Vectors and queries of one piece of work.
BLOCK = 4096


@dataclass
class Tree:
    """Nodes in breadth-first order; ``leaf`` numbers the leaves and is -1 at inner nodes."""

    centers: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int((self.leaf >= 0).sum())

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: from the root, always to the nearest child."""
        found = np.full(len(vectors), -1)
        work = [(0, np.arange(len(vectors)))]
        while work:
            node, rows = work.pop()
            if not len(rows):
                continue
            if self.leaf[node] >= 0:
                found[rows] = self.leaf[node]
                continue
            own = self.children[node]
            near = _distances(vectors[rows], self.centers[own]).argmin(axis=1)
            work += [(child, rows[near == i]) for i, child in enumerate(own)]
        return found

    def visits(self, query: np.ndarray):
        """Leaves in the order in which best-bin-first search comes to them: the nearest open node is next."""
        heap = [(0.0, 0)]
        while heap:
            _, node = heapq.heappop(heap)
            if self.leaf[node] >= 0:
                yield int(self.leaf[node])
                continue
            own = self.children[node]
            for distance, child in zip(((self.centers[own] - query) ** 2).sum(axis=1).tolist(), own, strict=True):
                heapq.heappush(heap, (distance, child))


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances, fast; good enough to choose by, not to report."""
    return np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * x @ y.T, 0)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, steps: int = 8) -> np.ndarray:
    centers = x[rng.choice(len(x), k, replace=False)]
    for _ in range(steps):
        near = _distances(x, centers).argmin(axis=1)
        counts = np.bincount(near, minlength=k)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    return centers


def build(sample: np.ndarray, branch: int = BRANCH, leaf_sample: int = LEAF_SAMPLE, seed: int = 5) -> Tree:
    """Split by k-means until a node has few sample vectors, or k-means can't tell them apart."""
    rng = np.random.default_rng(seed)
    centers, children, leaf = [sample.mean(axis=0)], [[]], [-1]
    work = [(0, sample)]
    leaves = 0
    while work:
        node, x = work.pop(0)
        parts = []
        if len(x) > leaf_sample:
            k = min(branch, max(2, -(-len(x) // leaf_sample)))
            middle = _kmeans(x, k, rng)
            near = _distances(x, middle).argmin(axis=1)
            parts = [(c, x[near == i]) for i, c in enumerate(middle) if (near == i).any()]
        if len(parts) < 2:
            leaf[node] = leaves
            leaves += 1
            continue
        for center, part in parts:
            children[node].append(len(centers))
            work.append((len(centers), part))
            centers.append(center)
            children.append([])
            leaf.append(-1)
    return Tree(np.array(centers), children, np.array(leaf))


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, vector (doubles) of the rows that take part: an id, and finite components, not all zero.

    Vectors of another length than the most frequent one take no part either (ties: the longer one).
    """
    vector = F.col(vector_col)
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    found = vectors.filter(F.col(id_col).isNotNull() & F.coalesce(good, F.lit(False)))
    found = found.select(F.col(id_col).cast("long").alias("vec_id"), vector.cast("array<double>").alias("vector"))
    most = found.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return found.filter(F.size("vector") == (most[0] if most else -1))


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(flat), -1) if len(flat) else np.empty((0, 0))


def _top(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """(query, id, distance) of each query's ``k`` nearest others: chosen roughly, then measured exactly."""
    for at in range(0, len(queries), 64):
        part = slice(at, at + 64)
        rough = _distances(queries[part], vectors)
        rough[query_ids[part][:, None] == ids[None, :]] = np.inf
        last = min(k, rough.shape[1]) - 1
        limit = np.partition(rough, last, axis=1)[:, last]
        scale = (queries[part] ** 2).sum(axis=1) + (vectors**2).sum(axis=1).max()
        for i, (bound, size) in enumerate(zip(limit, scale, strict=True)):
            if not np.isfinite(bound):
                bound = np.finfo(float).max
            near = np.flatnonzero(rough[i] <= bound + 1e-9 * size)
            exact = np.sqrt(((vectors[near] - queries[at + i]) ** 2).sum(axis=1))
            best = near[np.lexsort((ids[near], exact))][:k]
            exact = np.sort(exact)[:k]
            yield np.full(len(best), query_ids[at + i]), ids[best], exact


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _calibrate(tree: Tree, indexed: DataFrame, k: int, recall: float, queries: int) -> int:
    """Leaves to visit: the fewest with which the mean recall of ``queries`` vectors is ``recall``.

    Their true neighbours come from all vectors, by blocks; how many leaves each one costs follows from
    the order of visits.
    """
    chosen = bounded_sample(indexed.select("vec_id", "vector"), "vec_id", queries).toArrow()
    ids, vectors = chosen["vec_id"].to_numpy(), _matrix(chosen["vector"])

    def rows(batches):
        for columns in batches:
            if not len(columns["vec_id"]):
                continue
            own, leaf = columns["vec_id"].to_numpy(), dict(zip(columns["vec_id"].to_pylist(), columns["leaf"].to_pylist(), strict=True))
            for query, found, score in _top(own, _matrix(columns["vector"]), ids, vectors, k):
                yield query, found, score, [leaf[i] for i in found.tolist()]

    true = _best(map_rows(indexed.select("vec_id", "vector", "leaf"), rows, "query_id long, vec_id long, score double, leaf int"), k)
    table = true.select("query_id", "leaf").toArrow()
    order = {i: {leaf: at for at, leaf in enumerate(tree.visits(v))} for i, v in zip(ids.tolist(), vectors, strict=True)}
    cost = np.array([order[q][leaf] for q, leaf in zip(*(table[c].to_pylist() for c in ("query_id", "leaf")), strict=True)])
    if not len(cost):
        return tree.leaves
    reached = np.bincount(cost, minlength=tree.leaves).cumsum() / len(cost)
    return int(np.searchsorted(reached, recall - 1e-12)) + 1


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    recall: float = RECALL,
    fit_rows: int = FIT_ROWS,
    leaf_sample: int = LEAF_SAMPLE,
    block: int = BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found of each query, by Euclidean distance.

    The tree is fitted on at most ``fit_rows`` vectors (chosen by a hash of the id); every vector is
    indexed. A query visits leaves best-bin-first: as many as calibration found necessary, and more
    until they hold more than ``k`` vectors. Leaves and their queries are dealt in blocks, so a leaf of many equal vectors is
    spread over tasks. Scores are measured in double precision on the original vectors; ties go to the
    smaller id, and a query's own id is no candidate.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do null ids and
    lengths other than the most frequent. Rows that repeat an id are candidates each, and a query once
    for each row. Other columns are ignored. With no usable vector the result is empty.
    """
    spark = vectors.sparkSession
    found = usable(vectors, id_col, vector_col)
    asked = usable(queries, id_col, vector_col)
    sample = bounded_sample(found, "vec_id", fit_rows).toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = build(_matrix(sample["vector"]), leaf_sample=leaf_sample)
    sent = spark.sparkContext.broadcast((tree.centers, tree.children, tree.leaf))

    def index(batches):
        own = Tree(*sent.value)
        for columns in batches:
            if len(columns["vec_id"]):
                yield columns["vec_id"], columns["vector"], own.assign(_matrix(columns["vector"]))

    indexed = settle(map_rows(found, index, "vec_id long, vector array<double>, leaf int"), "indexed")
    counts = {r[0]: r[1] for r in indexed.groupBy("leaf").count().collect()}
    visits = _calibrate(tree, indexed, k, recall, CALIBRATION)

    def search(batches):
        own = Tree(*sent.value)
        for columns in batches:
            if not len(columns["vec_id"]):
                continue
            table = _matrix(columns["vector"])
            for i, (key, vector) in enumerate(zip(columns["vec_id"].to_pylist(), table, strict=True)):
                leaves, held = [], 0
                for at, leaf in enumerate(own.visits(vector)):
                    if at >= visits and held > k:
                        break
                    if counts.get(leaf):
                        leaves.append(leaf)
                        held += counts[leaf]
                yield [key] * len(leaves), columns["vector"].take(pa.array([i] * len(leaves), pa.int64())), leaves

    length = len(tree.centers[0])
    if length:
        asked = asked.filter(F.size("vector") == length)
    visited = settle(map_rows(asked, search, "vec_id long, vector array<double>, leaf int"), "visits")
    wanted = visited.groupBy("leaf").agg(F.ceil(F.count("*") / F.lit(float(block))).cast("int").alias("query_blocks"))
    held = indexed.groupBy("leaf").agg(F.ceil(F.count("*") / F.lit(float(block))).cast("int").alias("blocks"))
    shape = F.broadcast(settle(wanted.join(held, "leaf"), "blocks"))  # a row for each leaf of the tree

    def dealt(rows: DataFrame, own: str, other: str, mine: str, theirs: str, is_query: bool) -> DataFrame:
        return (
            rows.join(shape, "leaf")
            .withColumn(own, F.pmod(F.xxhash64("vec_id"), F.col(mine)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(theirs) - 1)))
            .select("leaf", "x", "y", F.lit(is_query).alias("query"), "vec_id", "vector")
        )

    both = dealt(indexed, "x", "y", "blocks", "query_blocks", False).union(
        dealt(visited, "y", "x", "query_blocks", "blocks", True)
    )
    keys = ["leaf", "x", "y"]

    def compare(batches):
        for table in sorted_runs(batches, keys):
            ask = table["query"].to_numpy()
            ids, values = table["vec_id"].to_numpy(), _matrix(table["vector"])
            if ask.any() and not ask.all():
                for query, near, score in _top(ids[~ask], values[~ask], ids[ask], values[ask], k):
                    yield pa.RecordBatch.from_arrays([query, near, score], names=["query_id", "vec_id", "score"])

    measured = both.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "query_id long, vec_id long, score double")
    return _best(measured, k).select("query_id", "rank", "vec_id", "score")
