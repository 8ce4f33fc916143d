"""CSV whose quoted fields hold line breaks, read by file block.

Spark's own reader takes such a file as one task, since a block may begin inside a field. Here each block
first tells in which state it ends, inside a quoted field or outside, for either state it may begin in;
a running composition over the blocks of a file gives where each really begins. Then the lines of every
block are joined to records, what crosses its ends is put together through a small shuffle, and the
records are parsed by Spark's CSV expression. A first scan looks at quotes only; each record is parsed once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.sources.scratch import settle

#: Blocks that begin inside a field and are broadcast at most, some 200 bytes each; beyond, lines are joined through a shuffle.
BROADCAST_BLOCKS = 100_000

_CLOSE = re.compile(r'[^"]*+(?:""[^"]*+)*+"')
_BLANK = "".join(map(chr, range(33)))


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that begins inside a quoted field (or at a record's start) ends inside one.

    A quote opens a field only where the field begins; in a quoted field, doubled quotes are text. What
    follows a closing quote belongs to no quoted field until the next comma.
    """
    at = 0
    while True:
        if inside:
            closed = _CLOSE.match(line, at)
            if not closed:
                return True
            at = line.find(",", closed.end())
        elif line.find('"', at) < 0:
            return False
        elif not line.startswith('"', at):
            at = line.find(",", at)
        else:
            at, inside = at + 1, True
            continue
        if at < 0:
            return False
        at, inside = at + 1, False


def _block_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: the state after it if it begins outside or inside, and whether any line in it ends inside."""
    block, after, ever = None, (False, True), False
    done: list[tuple] = []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for path, start, line in zip(*columns, strict=True):
            if (path, start) != block:
                if block:
                    done.append((*block, *after, ever))
                block, after, ever = (path, start), (False, True), False
            if line is not None:
                first = ends_inside(line, after[0])
                after = (first, first if after[0] == after[1] else ends_inside(line, after[1]))
                ever |= first
    if block:
        done.append((*block, *after, ever))
    if done:
        names = ["path", "start", "outside", "inside", "breaks"]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=names)


def _joined_lines(header: bool):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole records of a block (piece null), its end of a record begun before (0), and one begun in it (1)."""
        block, held, inside, tail, first = None, [], False, False, False
        out: list[tuple] = []

        def emit(whole: bool):
            nonlocal held, tail, first
            if held and (not whole or tail or not first):
                piece = 0 if tail else None if whole else 1
                out.append((*block, piece, first and not tail, "\n".join(held)))
            first = first and tail
            held, tail = [], False

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for path, start, line, enters in zip(*columns, strict=True):
                if (path, start) != block:
                    if block:
                        emit(False)
                    block, inside = (path, start), enters
                    tail, first = enters, header and start == 0
                if not held and not inside and not line.strip(_BLANK):
                    continue
                held.append(line)
                inside = ends_inside(line, inside)
                if not inside:
                    held[-1] = held[-1].removesuffix("\r")
                    emit(True)
            if out:
                yield _batch(out)
                out.clear()
        if block:
            emit(False)
        if out:
            yield _batch(out)

    return pieces


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"path": pa.string(), "start": pa.int64(), "piece": pa.int32(), "first": pa.bool_(), "text": pa.string()}
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], names=list(kinds))


def _begins(blocks: DataFrame) -> DataFrame:
    """The blocks that begin inside a field.

    Each block sets the state (both ends alike), keeps it or swaps it; so the state is that of the last
    block before that set it, swapped as often as blocks have swapped it since.
    """
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    swap = F.col("outside") & ~F.col("inside")
    sets = F.when(F.col("outside") == F.col("inside"), F.struct(F.col("outside").cast("int").alias("to"), "swaps"))
    counted = blocks.withColumn("swaps", F.sum(swap.cast("int")).over(upto))
    known = counted.select(
        "path", "start", F.last(sets, ignorenulls=True).over(before).alias("set"), F.lag("swaps", 1, 0).over(Window.partitionBy("path").orderBy("start")).alias("swaps"),
    )
    state = F.coalesce("set.to", F.lit(0)) + F.col("swaps") - F.coalesce("set.swaps", F.lit(0))
    return known.filter(state % 2 == 1).select("path", "start", F.lit(True).alias("enters"))


def read_records(spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool, **options: str) -> DataFrame:
    """Rows of CSV files whose quoted fields may hold line breaks, in as many tasks as the files have blocks.

    Parsed as Spark's reader does, permissively, quotes doubled, lines by position in ``schema``. Records end
    with a line feed, after a carriage return or not; line breaks inside fields stay as they are. Lines of
    white space are no records. A quote that is never closed takes the rest of its file, which one task then
    holds. The rows are written to the scratch folder once; where no field holds a line break, which the first
    scan finds, Spark's reader takes the files by block without Python.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line")
    )
    quoted = lines.withColumn("line", F.when(F.contains("line", F.lit('"')), F.col("line")))
    ends = "path string, start long, outside boolean, inside boolean, breaks boolean"
    blocks = settle(quoted.mapInArrow(_block_ends, ends), "blocks")
    if not blocks.filter("breaks").head(1):
        return settle(spark.read.csv(path, schema=schema, header=header, mode="PERMISSIVE", escape='"', **options), "rows")

    begins = settle(_begins(blocks), "begins")
    if begins.count() <= BROADCAST_BLOCKS:
        placed = lines.join(F.broadcast(begins), ["path", "start"], "left")
    else:
        placed = lines.withColumn("at", F.monotonically_increasing_id()).join(begins, ["path", "start"], "left")
        placed = placed.repartition("path", "start").sortWithinPartitions("path", "start", "at")
    placed = placed.select("path", "start", "line", F.coalesce("enters", F.lit(False)).alias("enters"))
    form = "path string, start long, piece int, first boolean, text string"
    pieces = placed.mapInArrow(_joined_lines(header), form)

    def parsed(text):
        return F.from_csv(text, _ddl(schema), {"escape": '"', "mode": "PERMISSIVE", **options})

    whole = F.col("piece").isNull()
    done = settle(
        pieces.select("path", "start", "piece", "first", F.when(~whole, F.col("text")).alias("text"), parsed(F.when(whole, F.col("text"))).alias("row")),
        "records",
    )
    order = Window.partitionBy("path").orderBy("start", "piece")
    parts = done.filter(~whole).select("path", "start", "piece", "first", "text", F.sum("piece").over(order).alias("record"))
    crossing = parts.groupBy("path", "record").agg(
        F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("start", "piece", "text"))).alias("parts")
    )
    crossing = crossing.filter(~F.col("first")).select(parsed(F.array_join(F.transform("parts", lambda p: p["text"]), "\n")).alias("row"))
    return done.filter(whole).select("row.*").unionByName(crossing.select("row.*"))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
