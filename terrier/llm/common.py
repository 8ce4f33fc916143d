"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.sources.scratch import settle

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Texts of ASCII alone take ``lower``, which is the same there and faster."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


#: Bytes of rows that a function over Arrow batches gets at a time (about; one row at least).
BATCH_BYTES = 1 << 22


_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Let Spark fill Arrow batches up to about BATCH_BYTES, unless the session states a limit of its own.

    A batch of long texts stands several times in an executor, outside its heap too. The setting stays in
    the session, since results are computed later; rows are the same however they are batched.
    """
    if spark.conf.get(_LIMIT, None) is None:
        spark.conf.set(_LIMIT, BATCH_BYTES)


def slices(batches: Iterator[pa.RecordBatch], most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches' rows in order, in slices of about ``most`` bytes; an empty batch as it is."""
    for batch in batches:
        step = max(1, batch.num_rows * most // max(1, batch.nbytes))
        for start in range(0, max(1, batch.num_rows), step):
            yield batch.slice(start, step)


def map_rows(df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[tuple]], schema: str) -> DataFrame:
    """Apply ``rows`` to Arrow batches as column lists; it yields lists of result columns, batch by batch.

    Batches come in slices of about BATCH_BYTES, so that Python's copies of long texts stay small.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = fields.names

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(fields)
        for columns in rows({n: b.column(i) for i, n in enumerate(b.schema.names)} for b in slices(batches)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=target.field(n).type) for c, n in zip(columns, names, strict=True)], names=names
            )

    return df.mapInArrow(run, fields)


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Cut batches that are sorted by ``keys`` into one table per key, across batch borders."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows, bool)
        for k in keys:
            column = batch.column(k).to_numpy(zero_copy_only=False)
            changed[1:] |= column[1:] != column[:-1]
        first = tuple(batch.column(k)[0].as_py() for k in keys)
        starts = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        for start, end in zip(starts, starts[1:], strict=False):
            if start and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
        last = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in keys)
    if held:
        yield pa.Table.from_batches(held)


# ---- word shingles ---------------------------------------------------------------------------------

_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = 0x9E3779B97F4A7C15 | 5  # odd, so that it can be inverted modulo 2^64
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept between calls and doubled when a text is longer."""
    if not _powers or len(_powers[0]) < size:
        n = max(1 << 16, 1 << (size - 1).bit_length())
        inverse = pow(_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            _powers[:] = [
                np.concatenate(([np.uint64(1)], np.cumprod(np.full(n - 1, b, np.uint64), dtype=np.uint64)))
                for b in (_BASE, inverse)
            ]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of the hash depends on every bit of the sum."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z: what ``bytes`` does without arguments."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingles(parts: list[bytes], width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit fingerprints of ``width`` words; with fewer words, of the whole sequence."""
    if not parts:
        return np.empty(0, np.uint64)
    joined = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    power, inverse = _power_tables(len(joined) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate(([np.uint64(0)], np.cumsum(_BYTE[joined] * power[: len(joined)], dtype=np.uint64)))
        ends = np.flatnonzero(joined == 32) + 1
        starts = np.concatenate(([0], ends[:-1]))
        if len(parts) > width:
            starts, ends = starts[: len(starts) - width + 1], ends[width - 1 :]
        else:
            starts, ends = starts[:1], ends[-1:]
        return np.unique(mix((total[ends] - total[starts]) * inverse[starts]))


def linked(a: np.ndarray, b: np.ndarray, percent: int = 75) -> bool:
    """Whether 100 * intersection >= percent * union of two sorted sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int(np.count_nonzero(large[np.minimum(at, len(large) - 1)] == small))
    return 100 * both >= percent * (len(a) + len(b) - both)


# ---- connected components --------------------------------------------------------------------------


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Label every node of ``edges`` (a, b) with the smallest node it reaches: columns node, component.

    Alternates large-star and small-star steps. Each step is a minimum per node (combined map-side) and
    a join back, so a node with very many links is never one task's list; each result is a table in the
    shared scratch folder, so lost executors don't lengthen the lineage.
    """

    def step(pairs: DataFrame) -> tuple[DataFrame, tuple]:
        table = settle(pairs.filter("a <> b").distinct(), name)
        mark = table.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return table, tuple(mark)

    links, mark = step(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    while mark[0]:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b")
        large, _ = step(large)
        least = large.groupBy(F.col("b").alias("b")).agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
        links, new = step(small)
        if new == mark:
            break
        mark = new
    roots = links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return roots.union(links.select(F.col("b").alias("node"), F.col("a").alias("component")))


def look_up(
    left: DataFrame, right: DataFrame, keys: list[str], by: list[str] | None = None, of: DataFrame | None = None, deal: int = 64
) -> DataFrame:
    """Left join of ``left`` with ``right``, whose ``keys`` are unique, without a task for all rows of a hot key.

    Every key of ``left`` is dealt into ``deal`` parts by a hash of the columns ``by`` (all, unless stated), and
    a row of ``right`` is copied only to the parts in use, so there are never more copies than rows of
    ``left``. ``of`` may hold the same keys and columns as ``left`` where they are cheaper to read.
    """
    part = F.pmod(F.xxhash64(*(by or left.columns)), F.lit(deal))
    source = (left if of is None else of).select(*keys, part.alias("_deal")).dropna(subset=keys)
    used = source.groupBy(*keys).agg(F.collect_set("_deal").alias("_deals"))
    copies = right.join(used, keys).withColumn("_deal", F.explode("_deals")).drop("_deals")
    return left.withColumn("_deal", part).join(copies, [*keys, "_deal"], "left").drop("_deal")


def bounded_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, those with the smallest hash of ``key``: the same ones however rows are dealt."""
    rows = df.count()
    if rows > most:
        share = min(1.0, 1.2 * most / rows + 0.001)
        df = df.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(share * (1 << 30)))
    return df.withColumn("_order", F.pmod(F.xxhash64(key), F.lit(1 << 30))).orderBy("_order", key).limit(most).drop("_order")


# ---- words for tokenizers --------------------------------------------------------------------------


def portions(texts: list[str], letters: int = 1 << 20):
    """Slices of ``texts`` of about so many letters, so that lists of words stay small beside long texts."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= letters:
            yield slice(start, i + 1)
            start, total = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


#: Latin letters up to U+024F. Texts of these, ASCII and other signs below U+0250 but for numbers such as
#: superscripts are plain: for them, Python's patterns cut where the tokenizers' patterns do.
LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
PLAIN = re.compile("[\x00-\x1b\x20-\u00b1\u00b4-\u00b8\u00ba\u00bb\u00bf-\u012f\u0131-\u024f]*")


class WordIds:
    """Ids of words, as bytes: each word is encoded once while it is remembered.

    ``table`` is never forgotten; beside it, at most ``most`` words are remembered, in ``memory``.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list[bytes]],
        most: int,
        table: dict[str, bytes] | None = None,
        memory: dict[str, bytes] | None = None,
    ):
        self.encode, self.most, self.own = encode, most, len(table or {})
        self.table, self.known = table or {}, memory if memory is not None else {}
        if not self.known:
            self.known.update(self.table)

    def of(self, split: list[list[str]]) -> list[bytes]:
        """The ids of each list of words, one after the other."""
        wanted = set().union(*split)
        new = list(wanted.difference(self.known))  # "-" would go through all that is known
        if len(self.known) + len(new) > self.most + self.own:
            self.known.clear()
            self.known.update(self.table)
            new = list(wanted.difference(self.known))
        for start in range(0, len(new), 20_000):
            part = new[start : start + 20_000]
            self.known.update(zip(part, self.encode(part), strict=True))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


def worker_memory(name: str) -> dict:
    """A dictionary that stays in a Python worker from task to task, for what costs much to compute again.

    Those of other names are emptied: Spark uses its workers again for the next operator, and what each of
    them remembers would add up.
    """
    store = sys.modules.setdefault("_terrier_memory", types.ModuleType("_terrier_memory"))
    held = store.__dict__.setdefault("held", {})
    for other in held.keys() - {name}:
        del held[other]
    return held.setdefault(name, {})
