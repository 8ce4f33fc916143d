"""Joining documents by the Jaccard similarity of their word 5-grams through signature trees."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.llm.common import components, linked, map_rows, mix, shingles, sorted_runs, words
from terrier.sources.scratch import settle

#: Smallest fingerprints that route a document. Two sets that link share at least three quarters of the
#: 64 smallest of their union on average; that they share 16 or fewer has a probability below 1e-15,
#: as small as that of a clash of fingerprints. Sets of up to 64 are routed whole, which is exact.
SAMPLE = 64
#: A fingerprint that more documents than this are routed by is hot.
HOT = 64
#: Bits of a document's token bitmap, and documents in one block of a group.
BITS = 2048
BLOCK = 1024


def bitmap(tokens: np.ndarray) -> bytes:
    """The token bitmap of a set of fingerprints."""
    bits = np.zeros(BITS, bool)
    bits[(tokens >> np.uint64(20)) % np.uint64(BITS)] = True
    return np.packbits(bits).tobytes()


def _sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, size, two words that identify the set, the routing sample and the token bitmap."""

    def rows(batches):
        for batch in batches:
            ids, sizes, low, high, samples, maps = [], [], [], [], [], []
            for key, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                found = shingles(words(text), width)
                with np.errstate(over="ignore"):
                    sums = [mix(found ^ np.uint64(seed)).sum(dtype=np.uint64).astype(np.int64) for seed in (11, 1013)]
                ids.append(key)
                sizes.append(len(found))
                low.append(int(sums[0]))
                high.append(int(sums[1]))
                samples.append(found[:SAMPLE].astype(np.int64))
                maps.append(bitmap(found))
            yield ids, sizes, low, high, samples, maps

    schema = "doc_id long, n_shingles long, low long, high long, sample array<long>, bitmap binary"
    return map_rows(docs, rows, schema)


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole texts link, by their sets."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")

    def rows(batches):
        last, first = None, None
        for batch in batches:
            kept_a, kept_b = [], []
            columns = (batch[c].to_pylist() for c in ("a", "text_a", "b", "text_b"))
            for a, text_a, b, text_b in zip(*columns, strict=True):
                if a != last:
                    last, first = a, shingles(words(text_a), width)
                if linked(first, shingles(words(text_b), width), percent):
                    kept_a.append(a)
                    kept_b.append(b)
            yield kept_a, kept_b

    return map_rows(both.select("a", "text_a", "b", "text_b"), rows, "a long, b long")


class _Node:
    """Documents ``start`` to ``end`` of a block: OR-combined bitmap, size range, largest surplus."""

    __slots__ = ("bits", "children", "end", "group", "high", "low", "start", "surplus")

    def __init__(self, block: _Block, start: int, end: int, fan: int):
        self.start, self.end = start, end
        self.children = []
        if end - start > fan:
            step = -(-(end - start) // fan)
            self.children = [_Node(block, s, min(s + step, end), fan) for s in range(start, end, step)]
        self.bits = np.bitwise_or.reduce(block.maps[start:end])
        self.low, self.high = int(block.sizes[start]), int(block.sizes[end - 1])
        self.surplus = int(block.surplus[start:end].max())
        groups = block.groups[start:end]
        self.group = int(groups[0]) if (groups == groups[0]).all() else None


class _Block:
    """Documents in order of size. ``surplus``: tokens beyond the bits they set, which the bitmap hides."""

    def __init__(self, table: pa.Table, fan: int = 16):
        sizes = table["n_shingles"].to_numpy()
        order = np.argsort(sizes, kind="stable")
        self.sizes = sizes[order]
        self.ids = table["doc_id"].to_numpy()[order]
        self.groups = table["component"].to_numpy()[order]
        raw = b"".join(table["bitmap"].to_pylist())
        self.maps = np.frombuffer(raw, np.uint64).reshape(len(sizes), -1)[order]
        self.counts = np.bitwise_count(self.maps).sum(axis=1).astype(np.int64)
        self.surplus = self.sizes - self.counts
        self.root = _Node(self, 0, len(sizes), fan)


def _dual(a: _Block, b: _Block, percent: int):
    """Pairs of two blocks that may link: arrays of positions.

    Two nodes are dropped when their size ranges cannot meet the ratio, when all their documents are
    known to be connected, or when the bits they have in common and the hidden tokens are fewer than
    the overlap that the smallest sizes need.
    """
    stack = [(a.root, b.root)]
    same = a is b
    while stack:
        x, y = stack.pop()
        if same and y.end <= x.start:
            continue
        if 100 * x.high < percent * y.low or 100 * y.high < percent * x.low:
            continue
        if x.group is not None and x.group == y.group:
            continue
        common = int(np.bitwise_count(x.bits & y.bits).sum()) + min(x.surplus, y.surplus)
        if (100 + percent) * common < percent * (x.low + y.low):
            continue
        if x.children or y.children:
            stack += [(p, q) for p in x.children or [x] for q in y.children or [y]]
            continue
        i, j = np.meshgrid(np.arange(x.start, x.end), np.arange(y.start, y.end), indexing="ij")
        i, j = i.ravel(), j.ravel()
        meet = a.groups[i] != b.groups[j]
        if same:
            meet &= i < j
        i, j = i[meet], j[meet]
        shared = np.bitwise_count(a.maps[i] & b.maps[j]).sum(axis=1).astype(np.int64)
        most = np.minimum(shared + np.minimum(a.surplus[i], b.surplus[j]), np.minimum(a.sizes[i], b.sizes[j]))
        good = (100 + percent) * most >= percent * (a.sizes[i] + b.sizes[j])
        if good.any():
            yield i[good], j[good]


def _tree_join(members: DataFrame, percent: int, block: int) -> DataFrame:
    """Candidate pairs (a, b) of the documents of each group that are not known to be connected.

    A group's documents are dealt to blocks of about ``block``; each pair of blocks is one piece of
    work, so that a group of any size is spread over many tasks.
    """
    sizes = members.groupBy("pivot").agg(F.ceil(F.count("*") / F.lit(float(block))).cast("int").alias("blocks"))
    placed = members.join(sizes, "pivot").withColumn(
        "own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    )
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "pivot",
        F.least("own", "other").alias("x"),
        F.greatest("own", "other").alias("y"),
        "own",
        "doc_id",
        "n_shingles",
        "component",
        "bitmap",
    )
    keys = ["pivot", "x", "y"]

    def run(batches):
        for table in sorted_runs(batches, keys):
            x, y, own = table["x"][0].as_py(), table["y"][0].as_py(), table["own"].to_numpy()
            first = _Block(table.filter(pa.array(own == x)))if (own == x).any() else None
            second = first if x == y else _Block(table.filter(pa.array(own == y))) if (own == y).any() else None
            if first is None or second is None:
                continue
            for i, j in _dual(first, second, percent):
                p, q = first.ids[i], second.ids[j]
                yield pa.RecordBatch.from_arrays([np.minimum(p, q), np.maximum(p, q)], names=["a", "b"])

    spread = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return spread.mapInArrow(run, "a long, b long").distinct()


def connect(
    stars: DataFrame,
    features: DataFrame,
    texts: DataFrame,
    width: int = 5,
    percent: int = 75,
    block: int = BLOCK,
    hubs: int = 0,
) -> DataFrame:
    """Components (node, component) of the links inside groups.

    ``stars`` (doc_id, pivot) lists the members of each group but its pivot. Each is compared with its
    pivot; groups whose members are then in several components are searched by signature trees on
    ``features`` (doc_id, n_shingles, bitmap). All candidates are verified on ``texts`` (doc_id, text).
    With ``hubs``, members of a group are first compared with so many more of it, chosen by a hash, where
    they aren't connected yet: linear in the members, it leaves less to the trees.
    """
    pairs = stars.select(F.col("pivot").alias("a"), F.col("doc_id").alias("b"))
    links = settle(_verified(pairs, texts, width, percent), "links")
    part = settle(components(links, "star_components"), "parts")
    members = stars.join(part.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", "pivot", F.coalesce("component", "doc_id").alias("component")
    )
    members = settle(members, "members")
    if hubs:
        centres = members.groupBy("pivot").agg(
            F.array(*[F.min_by(F.struct("doc_id", "component"), F.xxhash64("doc_id", F.lit(i))) for i in range(hubs)]).alias("hubs")
        )
        near = (
            members.join(settle(centres, "hubs"), "pivot")
            .select("doc_id", "component", F.explode("hubs").alias("hub"))
            .filter("component <> hub.component")
            .select(F.least("doc_id", "hub.doc_id").alias("a"), F.greatest("doc_id", "hub.doc_id").alias("b"))
            .distinct()
        )
        links = settle(links.union(_verified(near, texts, width, percent)), "hub_links")
        part = components(links, "hub_components").withColumnRenamed("node", "doc_id")
        members = stars.join(part, "doc_id", "left").select(
            "doc_id", "pivot", F.coalesce("component", "doc_id").alias("component")
        )
        members = settle(members, "hub_members")
    mixed = members.groupBy("pivot").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
    members = members.join(mixed.select("pivot"), "pivot").join(features, "doc_id")
    rest = settle(_tree_join(members, percent, block), "candidates")
    more = _verified(rest, texts, width, percent)
    return components(links.union(more), "link_components")


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 75,
    hot: int = HOT,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable by links).

    1. Equal sets become one class, named by its smallest id; copies are never paired.
    2. Each class is routed by the smallest fingerprints of its set. Each fingerprint has a pivot, its
       smallest class; every class is compared with its pivots, which is linear in the routes, and the
       links found already connect most of what belongs together.
    3. Groups that hold several components are searched by signature trees: nodes of 16 with OR-combined
       bitmaps and size ranges, traversed in pairs, dropping what cannot overlap enough or is connected.
    4. All candidates are verified on whole texts; components follow from the links.

    Hot fingerprints route only classes of which they make up more than a quarter of the sample: any
    other class shares a fingerprint that isn't hot with whatever it links to.

    Null and empty texts have no shingles and are their own component. A null id has a null component
    and takes no part. Rows that share an id are one node, with the links of all. Other columns are ignored.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketch = settle(_sketches(source, width), "sketch")
    known = sketch.filter("n_shingles > 0 and doc_id is not null")
    key = ["n_shingles", "low", "high"]
    classes = settle(known.groupBy(*key).agg(F.min("doc_id").alias("rep")), "classes")
    single = known.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    posts = single.select("doc_id", F.explode("sample").alias("token"), F.size("sample").alias("sampled"))
    shared = posts.groupBy("token").agg(F.min("doc_id").alias("pivot"), F.count("*").alias("n")).filter("n > 1")
    routes = settle(posts.join(shared, "token").select("doc_id", "sampled", "pivot", (F.col("n") > hot).alias("hot")), "routes")
    counts = routes.groupBy("doc_id", "sampled").agg(F.count_if("hot").alias("hots"))
    heavy = counts.filter("4 * hots > sampled").select("doc_id", F.lit(True).alias("heavy"))
    stars = settle(
        routes.join(heavy, "doc_id", "left")
        .filter("(not hot or heavy) and doc_id <> pivot")
        .select("doc_id", "pivot")
        .distinct(),
        "stars",
    )
    texts = source.filter("doc_id is not null")
    features = known.select("doc_id", "n_shingles", "bitmap").dropDuplicates(["doc_id"])
    part = connect(stars, features, texts, width, percent, block).withColumnRenamed("node", "rep")
    reach = settle(classes.join(part, "rep", "left").withColumn("component", F.coalesce("component", "rep")), "reach")
    least = sketch.join(reach, key, "left").select("doc_id", "n_shingles", "component")
    return least.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest id. Rows with a null id stay.

    Rows are linked, not ids: a text that resembles nothing stays, whatever else carries its id. Of rows
    of one component that share the smallest id, the smallest by its text's digest stays.
    """
    mark = "_row"
    while mark in docs.columns:
        mark += "_"
    rows = settle(docs.withColumn(mark, F.monotonically_increasing_id()), "rows")
    linked = jaccard_components(rows.filter(F.col(id_col).isNotNull()), mark, text_col).select("doc_id", "component_id")
    linked = settle(linked, "linked")
    several = linked.groupBy("component_id").count().filter("count > 1").select("component_id")
    members = linked.join(several, "component_id")
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    ranks = rows.select(F.col(mark).alias("doc_id"), F.struct(F.col(id_col).alias("id"), digest.alias("sha"), F.col(mark).alias("row")).alias("rank"))
    stays = members.join(ranks, "doc_id").groupBy("component_id").agg(F.min("rank").alias("rank")).select(F.col("rank.row").alias("doc_id"))
    dropped = settle(members.join(stays, "doc_id", "left_anti").select(F.col("doc_id").alias("_dropped")), "dropped")
    return rows.join(dropped, F.col(mark) == F.col("_dropped"), "left_anti").drop(mark)


SQL = r"""with recursive w as materialized (select doc_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''] as w from documents),
s as materialized (select distinct doc_id, md5(unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else [array_to_string(w[i:i+4], ' ') for i in range(1, len(w) - 3)] end)) as s from w),
n as materialized (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
e as materialized (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
r as (select doc_id as a, doc_id as b from documents union select r.a, e.b from r join e on r.b = e.a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, m.component_id from documents d left join n using (doc_id)
  join (select a as doc_id, min(b) as component_id from r group by 1) m using (doc_id)"""
