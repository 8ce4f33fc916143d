"""Exact order statistics and cuts by position without a global sort.

``locate_ranks`` finds the value at given ranks of a column by counting: a histogram over the value
range (over powers of two where it is wide), then a finer one inside the bucket that holds the rank,
until the bucket is a single value: at most six passes for one rank, whatever the distribution.
Each pass is one map-side-combined count that returns at most ``HISTOGRAM_ROWS`` rows, whatever the
size or skew of the data; a value that makes up a third of all rows is one histogram row.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Upper bound on the rows one counting pass sends to the driver, shared by all open brackets.
HISTOGRAM_ROWS = 16_384

# Bits of the row hash; a few hundred keys times this range still count exactly in a double.
HASH_BITS = 44
HASH_RANGE = 2**HASH_BITS

# Copies of one row that a single task writes when a tie group is cut.
COPIES_PER_TASK = 1_000_000


@dataclass(frozen=True)
class Hit:
    """The value at a rank, the rows strictly before it, and the rows that share it."""

    value: float
    below: int
    count: int


@dataclass(frozen=True)
class Extent:
    """Counts of one column: finite range, values at each infinity, rows without a value."""

    low: float | None
    high: float | None
    finite: int
    minus: int
    plus: int
    missing: int

    @property
    def rows(self) -> int:
        return self.minus + self.finite + self.plus


def extent(df: DataFrame, value: Column | str) -> Extent:
    return _extents(df, [F.col(value) if isinstance(value, str) else value])[0]


def _extents(df: DataFrame, values: list[Column]) -> list[Extent]:
    """The extents of several columns in one aggregate."""
    wanted = []
    for i, value in enumerate(v.cast("double") for v in values):
        finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(math.inf))
        wanted += [
            F.min(F.when(finite, value)).alias(f"low{i}"),
            F.max(F.when(finite, value)).alias(f"high{i}"),
            F.count_if(finite).alias(f"finite{i}"),
            F.count_if(value == F.lit(-math.inf)).alias(f"minus{i}"),
            F.count_if(value == F.lit(math.inf)).alias(f"plus{i}"),
            F.count_if(value.isNull() | F.isnan(value)).alias(f"missing{i}"),
        ]
    row = df.agg(*wanted).first() if wanted else ()
    return [Extent(*row[6 * i : 6 * i + 6]) for i in range(len(values))]


def locate_ranks(df: DataFrame, value: Column | str, ranks: list[int], known: Extent | None = None) -> dict[int, Hit]:
    """The hit for each zero-based rank in ascending order of ``value``; NULL and NaN are ignored."""
    column = (F.col(value) if isinstance(value, str) else value).cast("double")
    seen = known or extent(df, column)
    hits, brackets = _begin(ranks, seen)
    by_scale = bool(brackets) and _spans_scales(seen.low, seen.high)
    while brackets:
        found = [_scales(df, column)] if by_scale else _histogram(df, column, brackets)
        by_scale = False
        brackets = _narrow(brackets, found, hits)
    return hits


def _begin(ranks: list[int], seen: Extent) -> tuple[dict[int, Hit], list[tuple]]:
    """The ranks that fall on infinite values, and the bracket (low, high, rows below, ranks) of the others."""
    hits: dict[int, Hit] = {}
    inside: list[int] = []
    for rank in sorted(set(ranks)):
        if not 0 <= rank < seen.rows:
            raise ValueError(f"rank {rank} outside 0..{seen.rows - 1}")
        if rank < seen.minus:
            hits[rank] = Hit(-math.inf, 0, seen.minus)
        elif rank >= seen.minus + seen.finite:
            hits[rank] = Hit(math.inf, seen.minus + seen.finite, seen.plus)
        else:
            inside.append(rank)
    return hits, [(seen.low, seen.high, seen.minus, inside)] if inside else []


def _narrow(brackets: list[tuple], found: list[list], hits: dict[int, Hit]) -> list[tuple]:
    """The buckets that hold wanted ranks; those of a single value become hits."""
    finer = []
    for (_, _, below, wanted), buckets in zip(brackets, found, strict=True):
        for bucket in buckets:
            held = [r for r in wanted if below <= r < below + bucket["n"]]
            if held and bucket["low"] == bucket["high"]:
                hits.update({r: Hit(bucket["low"], below, bucket["n"]) for r in held})
            elif held:
                finer.append((bucket["low"], bucket["high"], below, held))
            below += bucket["n"]
    return finer


def locate_ranks_of(df: DataFrame, values: list[Column], ranks: list[list[int]], seen: list[Extent]) -> list[dict[int, Hit]]:
    """``locate_ranks`` of several columns in the scans of one: a slot of the histogram carries its column's number.

    A scan returns at most HISTOGRAM_ROWS rows (the first one 4,200 for each column whose range is wide).
    """
    columns = [v.cast("double") for v in values]
    begun = [_begin(r, e) for r, e in zip(ranks, seen, strict=True)]
    hits, brackets = [b[0] for b in begun], [b[1] for b in begun]
    wide = {i for i, own in enumerate(brackets) if own and _spans_scales(seen[i].low, seen[i].high)}
    while any(brackets):
        per = max(2, HISTOGRAM_ROWS // sum(map(len, brackets)))
        places = []
        for i, own in enumerate(brackets):
            if own:
                # A name in place of the expression: the value is computed once a row.
                v = F.col(f"v{i}")
                slot = F.when(F.abs(v) < F.lit(math.inf), _scale_slot(v)) if i in wide else _bracket_slot(v, own, per)
                places.append(F.struct(F.lit(i).alias("i"), slot.cast("long").alias("slot"), v.alias("v")))
        rows = (
            df.select(*[c.alias(f"v{i}") for i, c in enumerate(columns) if brackets[i]])
            .select(F.explode(F.array(*places)).alias("p"))
            .filter(F.col("p.slot").isNotNull())
            .groupBy("p.i", "p.slot")
            .agg(F.count("*").alias("n"), F.min("p.v").alias("low"), F.max("p.v").alias("high"))
            .collect()
        )
        found: list[list[list]] = [[[] for _ in own] for own in brackets]
        for row in sorted(rows, key=lambda r: (r["i"], r["slot"])):
            found[row["i"]][0 if row["i"] in wide else row["slot"] // per].append(row)
        brackets = [_narrow(own, buckets, h) for own, buckets, h in zip(brackets, found, hits, strict=True)]
        wide = set()
    return hits


def whole_extent(df: DataFrame, name: str) -> Extent:
    """``extent`` of a column of whole numbers, with its ends as they are: a double would round them."""
    key = F.col(f"`{name}`").cast("long")
    low, high, known, rows = df.agg(F.min(key), F.max(key), F.count(key), F.count("*")).first()
    return Extent(low, high, known, 0, 0, rows - known)


def locate_whole_ranks(df: DataFrame, name: str, ranks: list[int], seen: Extent) -> dict[int, Hit]:
    """The hit for each rank of a column of whole numbers, exact over all 64 bits.

    A radix count: rows are counted by their leading bits, then, inside the prefixes that hold a wanted
    rank, by some bits more. A prefix is an arithmetic shift, which keeps the order of signed numbers. One
    rank takes at most five passes, since each adds as many bits as HISTOGRAM_ROWS has.
    """
    for rank in ranks:
        if not 0 <= rank < seen.finite:
            raise ValueError(f"rank {rank} outside 0..{seen.finite - 1}")
    if not ranks:
        return {}
    key = F.col(f"`{name}`").cast("long")
    shift = 0
    while (seen.high >> shift) - (seen.low >> shift) >= HISTOGRAM_ROWS:
        shift += 1
    rows = df.filter(key.isNotNull())
    open_prefixes: dict[int, tuple[int, list[int]]] | None = None  # prefix: rows below it, ranks inside
    above = 64
    while True:
        counted = rows
        if open_prefixes is not None:
            counted = rows.filter(F.shiftright(key, above).isin(*open_prefixes))
        sizes = sorted(counted.groupBy(F.shiftright(key, shift).alias("slot")).agg(F.count("*").alias("n")).collect())
        starts = {None: 0} if open_prefixes is None else {p: below for p, (below, _) in open_prefixes.items()}
        wanted = {None: sorted(set(ranks))} if open_prefixes is None else {p: held for p, (_, held) in open_prefixes.items()}
        found: dict[int, tuple[int, int, list[int]]] = {}
        for slot, n in sizes:
            prefix = None if open_prefixes is None else slot >> (above - shift)
            below = starts[prefix]
            held = [r for r in wanted[prefix] if below <= r < below + n]
            if held:
                found[slot] = (below, n, held)
            starts[prefix] = below + n
        if not shift:
            return {r: Hit(slot, below, n) for slot, (below, n, held) in found.items() for r in held}
        open_prefixes = {slot: (below, held) for slot, (below, _, held) in found.items()}
        above, step = shift, max(1, (HISTOGRAM_ROWS // len(open_prefixes)).bit_length() - 1)
        shift = max(0, shift - step)


def _spans_scales(low: float, high: float) -> bool:
    """Whether equal widths would leave a bucket that spans many powers of two."""
    small, large = sorted((abs(low), abs(high)))
    return low <= 0 <= high and low != high or small * HISTOGRAM_ROWS < large


def _scales(df: DataFrame, value: Column) -> list:
    """The first histogram of a wide range: a bucket for each sign and power of two, some 4,200 at most.

    Inside one, equal widths gain all their bits in every pass, so the number of passes has a bound for
    any distribution: the 52 bits of a double's fraction by those of the buckets.
    """
    rows = (
        df.select(value.alias("v"))
        .filter(F.abs(F.col("v")) < F.lit(math.inf))
        .groupBy(_scale_slot(F.col("v")).cast("int").alias("slot"))
        .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        .collect()
    )
    return sorted(rows, key=lambda r: r["slot"])


def _scale_slot(v: Column) -> Column:
    power = F.floor(F.log2(F.abs(v))) + 1100
    return F.when(v == 0, 0).when(v > 0, power).otherwise(-power)


def _histogram(df: DataFrame, value: Column, brackets: list[tuple]) -> list[list]:
    """Per bracket, its non-empty equal-width buckets in value order with count, min and max."""
    per = max(2, HISTOGRAM_ROWS // len(brackets))
    lows, highs = [b[0] for b in brackets], [b[1] for b in brackets]
    rows = (
        df.filter(value.between(F.lit(lows[0]), F.lit(highs[-1])))
        .select(value.alias("v"))
        .select("v", _bracket_slot(F.col("v"), brackets, per).alias("slot"))
        .filter("slot is not null")
        .groupBy("slot")
        .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        .collect()
    )
    grouped: list[list] = [[] for _ in brackets]
    for row in sorted(rows, key=lambda r: r["slot"]):
        grouped[row["slot"] // per].append(row)
    return grouped


def _bracket_slot(v: Column, brackets: list[tuple], per: int) -> Column:
    """Bracket number times ``per`` plus the place among its equal widths; NULL outside all brackets."""
    lows, highs = [b[0] for b in brackets], [b[1] for b in brackets]
    i = _bracket_of(v, highs, 0, len(highs) - 1)
    low, high = F.get(_numbers(lows), i), F.get(_numbers(highs), i)
    # Halved so that the width of a range beyond half the double maximum stays finite.
    width = F.get(_numbers([high / 2 - low / 2 or 1.0 for low, high in zip(lows, highs)]), i)
    share = (v / 2 - low / 2) / width
    place = F.when(v >= high, per - 1).otherwise(F.least(F.floor(share * per), F.lit(per - 1)))
    return F.when((v >= low) & (v <= F.lit(highs[-1])), (i * per + place).cast("long"))


def _numbers(values: list[float]) -> Column:
    return F.array(*[F.lit(x) for x in values])


def _bracket_of(value: Column, highs: list[float], first: int, last: int) -> Column:
    """Index of the first bracket whose upper end is not below the value: a comparison per halving."""
    if first == last:
        return F.lit(first)
    middle = (first + last) // 2
    left = _bracket_of(value, highs, first, middle)
    return F.when(value <= F.lit(highs[middle]), left).otherwise(_bracket_of(value, highs, middle + 1, last))


def column_quantiles(df: DataFrame, values: list[Column], shares: list[float]) -> list[dict[float, float | None]]:
    """``exact_quantiles`` of several columns, as doubles, in the scans of one column."""
    seen = _extents(df, values)
    places = [{s: s * (e.rows - 1) for s in shares if e.rows} for e in seen]
    hits = locate_ranks_of(df, values, [_neighbours(own) for own in places], seen)
    return [{s: _at(found, own[s]) if own else None for s in shares} for own, found in zip(places, hits, strict=True)]


def _neighbours(places: dict[float, float]) -> list[int]:
    return sorted({r for place in places.values() for r in (math.floor(place), math.ceil(place))})


def _at(hits: dict[int, Hit], place: float) -> float:
    low, high = hits[math.floor(place)].value, hits[math.ceil(place)].value
    return float(low) if low == high else low + (high - low) * (place - math.floor(place))


def exact_quantiles(df: DataFrame, value: Column | str, shares: list[float]) -> dict[float, float | None]:
    """Quantiles with linear interpolation between neighbouring ranks."""
    whole = isinstance(value, str) and isinstance(df.schema[value].dataType, T.IntegralType)
    seen = whole_extent(df, value) if whole else extent(df, value)
    if seen.rows == 0:
        return {share: None for share in shares}
    places = {share: share * (seen.rows - 1) for share in shares}
    hits = (locate_whole_ranks if whole else locate_ranks)(df, value, _neighbours(places), seen)
    return {share: _at(hits, place) for share, place in places.items()}


def canonical_text(column: Column, kind: T.DataType) -> Column:
    """A value as text that any SQL engine can write alike; ``\\N`` for null, ``\\`` and ``|`` escaped in texts.

    Fractions count in steps of 2^-16, so the last bits of a sum don't change the text; numbers of 2^46 and
    more, and infinite ones, are written as Spark does.
    """
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        x = column.cast("double")
        text = F.when(F.abs(x) < 2.0**46, F.floor(x * 65536 + 0.5).cast("string")).otherwise(x.cast("string"))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(kind, T.BinaryType):
        text = F.hex(column)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(F.struct(column))
    else:
        text = column.cast("string")
    if isinstance(kind, (T.StringType, T.ArrayType, T.MapType, T.StructType)):
        text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
    return F.coalesce(text, F.lit("\\N"))


def row_hash(df: DataFrame) -> Column:
    """Digest of a row in ``0 .. HASH_RANGE - 1``, the tie-break among equal keys.

    The first 44 bits of the MD5 of the canonical texts of all columns, so that SQL elsewhere can state
    which rows of a tie come first.
    """
    texts = [canonical_text(F.col(f"`{f.name}`"), f.dataType) for f in df.schema]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, HASH_BITS // 4), 16, 10).cast("long")


def sort_spread(df: DataFrame, order_by: str) -> DataFrame:
    """Whole table in key order.

    Equal keys are ordered by row hash and copies by the partition they come from, so the range
    shuffle can cut through a hot key and through a hot group of copies.
    """
    tied = df.withColumns({"_hash": row_hash(df), "_from": F.spark_partition_id()})
    return tied.orderBy(order_by, "_hash", "_from").drop("_hash", "_from")


def label_by_position(
    df: DataFrame, order_by: str, cuts: Callable[[int], list[int]], label: str = "segment"
) -> DataFrame:
    """Number the pieces of ``df`` between cut positions, as if it were sorted by ``order_by``.

    Rows with equal keys are ordered by a hash of the whole row. Only the key at each cut needs
    looking into: everything before or after it is settled by a comparison with a constant, so the
    big table is neither sorted nor shuffled, and a filter on the label pushes down to the key.
    Copies of one row at a cut are counted, divided, and written out again in bounded pieces.
    ``order_by`` must be numeric without missing values; whole numbers count with all 64 bits. ``df`` is read
    several times, so pass a table that is cheap to read and the same each time, such as a stage.
    """
    whole = isinstance(df.schema[order_by].dataType, T.IntegralType)
    seen = whole_extent(df, order_by) if whole else extent(df, order_by)
    if seen.missing:
        raise ValueError(f"{seen.missing} rows have no {order_by}")

    def bound(value: float) -> Column:
        # A literal of the key's own type keeps the comparison free of casts, so it pushes down.
        return F.lit(int(value)) if whole else F.lit(value)

    places = sorted(cuts(seen.rows))
    key = F.col(order_by)
    digest = row_hash(df)
    inner = [p for p in places if 0 < p < seen.rows]
    hits = (locate_whole_ranks if whole else locate_ranks)(df, order_by, inner, seen)

    # A cut that falls inside the rows of one key continues on their hashes. All such keys are
    # looked into together: key number times the hash range plus hash, still exact as a double.
    split_keys = {h.value: h.count for p, h in sorted(hits.items()) if p > h.below}
    starts, offset = {}, 0
    for value, count in split_keys.items():
        starts[value] = offset
        offset += count
    index = {value: i for i, value in enumerate(split_keys)}
    within: dict[int, Hit] = {}
    if split_keys:
        position = F
        for value, i in index.items():
            position = position.when(key == bound(value), F.lit(i * HASH_RANGE) + digest)
        found = locate_ranks(
            df.filter(key.isin(*[bound(v) for v in split_keys])),
            position,
            [starts[hits[p].value] + p - hits[p].below for p in inner if p > hits[p].below],
            Extent(0.0, float(len(index) * HASH_RANGE - 1), offset, 0, 0, 0),
        )
        for p in inner:
            if p > hits[p].below:
                value = hits[p].value
                hit = found[starts[value] + p - hits[p].below]
                within[p] = Hit(hit.value - index[value] * HASH_RANGE, hit.below - starts[value], hit.count)

    # The digest is computed once a row, and only where a tie has to be cut.
    tie = "_tie"
    while tie in df.columns:
        tie += "_"
    columns = df.columns
    if split_keys:
        df = df.withColumn(tie, F.when(key.isin(*[bound(v) for v in split_keys]), digest))
    digest = F.col(tie)
    number = F.lit(0)
    ties: dict[tuple[float, float], list[tuple[int, int]]] = {}
    for i, place in enumerate(places):
        if place <= 0:
            lower = F.lit(False)
        elif place >= seen.rows:
            lower = F.lit(True)
        elif place == hits[place].below:
            lower = key < bound(hits[place].value)
        else:
            value = hits[place].value
            offset = place - hits[place].below
            cut = within[place]
            lower = (key < bound(value)) | ((key == bound(value)) & (digest < F.lit(int(cut.value))))
            if offset > cut.below:
                ties.setdefault((value, cut.value), []).append((i, offset - cut.below))
        number = number + F.when(lower, 0).otherwise(1)

    if not ties:
        return df.withColumn(label, number).drop(tie)
    rest = df
    divided = []
    for (value, tied), parts in ties.items():
        same = (key == bound(value)) & (digest == F.lit(int(tied)))
        rest = rest.filter(~same)
        divided.append(_divide_copies(df.filter(same).select(*[F.col(f"`{c}`") for c in columns]), parts, label))
    labelled = rest.withColumn(label, number).drop(tie)
    for piece in divided:
        labelled = labelled.unionByName(piece)
    return labelled


def _divide_copies(tied: DataFrame, parts: list[tuple[int, int]], label: str) -> DataFrame:
    """Give the first rows of a tie group to earlier segments.

    ``parts`` holds ``(cut number, rows of the group before that cut)``. Rows that share key and hash
    are copies of each other (or one of a handful of hash collisions), so they are counted first;
    each distinct row then occupies an interval of the group and is written once per copy.
    """
    columns = tied.columns
    order = Window.partitionBy(F.lit(0)).orderBy(*[F.col(f"`{c}`") for c in columns])
    counted = tied.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count("*").alias("_n"))
    counted = counted.withColumn("_end", F.sum("_n").over(order))
    start = F.col("_end") - F.col("_n")
    first = min(i for i, _ in parts)
    bounds = [0, *[rows for _, rows in sorted(parts)], None]
    pieces = []
    for step, (low, high) in enumerate(zip(bounds, bounds[1:])):
        upper = F.col("_end") if high is None else F.least(F.col("_end"), F.lit(high))
        copies = F.greatest(upper - F.greatest(start, F.lit(low)), F.lit(0)).cast("long")
        pieces.append(F.struct(F.lit(first + step).alias("segment"), copies.alias("copies")))
    shares = counted.withColumn("_share", F.explode(F.array(*pieces))).filter(F.col("_share.copies") > 0)
    chunks = shares.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_share.copies - 1) div {COPIES_PER_TASK}")))
    )
    left = F.col("_share.copies") - F.col("_chunk") * COPIES_PER_TASK
    spread = chunks.withColumn("_left", F.least(left, F.lit(COPIES_PER_TASK)))
    spread = spread.repartition(F.col("_chunk"), F.col("_share.segment"))
    rows = spread.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_left"))))
    return rows.select(*[F.col(f"`{c}`") for c in columns], F.col("_share.segment").cast("int").alias(label))
