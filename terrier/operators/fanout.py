"""Many-to-many joins whose work is dealt out evenly, whatever keys are hot."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.sources.scratch import settle

#: Rows that one cell of a heavy key gives, and parts that a key's rows are dealt into when something small
#: is looked up for them.
CELL = 1 << 16
DEAL = 64


def _unused(*tables: DataFrame) -> str:
    name = "_f"
    while any(c.startswith(name) for t in tables for c in t.columns):
        name += "_"
    return name


def _looked_up(left: DataFrame, right: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """Left join with a table of unique keys: a key's rows are dealt into parts, its one row copied to those in use."""
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(DEAL))
    dealt = left.withColumn(f"{prefix}deal", part)
    used = dealt.dropna(subset=keys).groupBy(*keys).agg(F.collect_set(f"{prefix}deal").alias(f"{prefix}used"))
    copies = right.join(used, keys).withColumn(f"{prefix}deal", F.explode(f"{prefix}used")).drop(f"{prefix}used")
    return dealt.join(copies, [*keys, f"{prefix}deal"], "left").drop(f"{prefix}deal")


def balanced_join(left: DataFrame, right: DataFrame, keys: list[str], cell: int = CELL) -> DataFrame:
    """Inner join on ``keys``: the columns of the keys, then the others of ``left`` and of ``right``.

    Rows are counted by key on both sides first. Keys whose rows multiply to more than ``cell`` are
    joined as a grid: blocks of the left by blocks of the right, each pair of blocks a join key of its own,
    so a key is as many tasks as its output needs. Blocks go by a row's number in a written table, so copies
    spread too. Other keys are joined as usual, and where none is heavy nothing else is done. Null keys meet nothing.
    """
    p = _unused(left, right)
    count = lambda t, name: t.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias(name))
    side = max(1, math.isqrt(cell))
    both = count(left, f"{p}l").join(count(right, f"{p}r"), keys)
    blocks = lambda n: F.ceil(F.col(n) / side).cast("long")
    heavy = both.filter(F.col(f"{p}l").cast("decimal(38,0)") * F.col(f"{p}r") > cell)
    grid = settle(heavy.select(*keys, blocks(f"{p}l").alias(f"{p}a"), blocks(f"{p}r").alias(f"{p}b")), "fanout")
    if grid.isEmpty():
        return left.join(right, keys)
    marked = [settle(_looked_up(t, grid, keys, p), "fanout_side") for t in (left, right)]
    light = [t.filter(F.col(f"{p}a").isNull()).drop(f"{p}a", f"{p}b") for t in marked]
    own = F.monotonically_increasing_id()
    grown = []
    for table, (mine, other), (rows, columns) in zip(marked, (("a", "b"), ("b", "a")), (("i", "j"), ("j", "i"))):
        table = table.filter(F.col(f"{p}a").isNotNull()).withColumn(f"{p}{rows}", own % F.col(f"{p}{mine}"))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{p}{other}") - 1))
        grown.append(table.withColumn(f"{p}{columns}", every).drop(f"{p}a", f"{p}b"))
    cells = grown[0].join(grown[1].hint("merge"), [*keys, f"{p}i", f"{p}j"]).drop(f"{p}i", f"{p}j")
    return light[0].join(light[1], keys).unionByName(cells)
