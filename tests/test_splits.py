"""Cuts by position: sizes, order, copies, and independence from the physical layout."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrier.operators import ranks, splits


def months(spark, counts, partitions=4):
    rows = [(m, i) for m, n in counts.items() for i in range(n)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "year_month_numeric int, id long").repartition(partitions)


def sizes(df, label):
    return {r[label]: r["count"] for r in df.groupBy(label).count().collect()}


@pytest.mark.parametrize(("n", "train"), [(10, 7), (5, 3), (90, 62)])
def test_train_size_uses_double_arithmetic(spark, n, train):
    got = sizes(splits.temporal_split(months(spark, {1: n // 2, 2: n - n // 2})), "part")
    assert got == {"train": train, "test": n - train}


def test_split_is_a_partition_in_time_order(spark):
    df = months(spark, {5: 30, 6: 50, 7: 17})
    done = splits.temporal_split(df).cache()
    train, test = (done.filter(F.col("part") == p) for p in ("train", "test"))
    assert train.count() == 67
    assert train.agg(F.max("year_month_numeric")).first()[0] <= test.agg(F.min("year_month_numeric")).first()[0]
    assert done.drop("part").exceptAll(df).count() == 0
    assert done.count() == df.count()


def test_split_does_not_depend_on_layout(spark):
    counts = {5: 30, 6: 50, 7: 17}
    first = splits.temporal_split(months(spark, counts, 1)).filter("part = 'train'")
    second = splits.temporal_split(months(spark, counts, 7)).filter("part = 'train'")
    assert first.exceptAll(second).count() == 0
    assert second.exceptAll(first).count() == 0


def test_validation(spark):
    assert sizes(splits.validation_split(months(spark, {1: 10})), "part") == {"fit": 8, "validation": 2}


def test_expanding_folds(spark):
    df = spark.range(12).withColumnRenamed("id", "k")
    blocks = splits.time_series_folds(df, "k")
    got = [tuple(d.count() for d in splits.fold_sets(blocks, f)) for f in range(1, 6)]
    assert got == [(2, 2), (4, 2), (6, 2), (8, 2), (10, 2)]
    assert sorted(r[0] for r in splits.fold_sets(blocks, 5)[1].collect()) == [10, 11]
    with pytest.raises(ValueError, match="too few"):
        splits.expanding_cuts(5)


def test_contiguous_folds(spark):
    got = splits.kfold_contiguous(spark.range(12), "id").groupBy("fold").agg(F.count("*"), F.min("id")).orderBy("fold")
    assert [tuple(r) for r in got.collect()] == [(1, 3, 0), (2, 3, 3), (3, 2, 6), (4, 2, 8), (5, 2, 10)]


def test_copies_at_a_cut_are_divided(spark):
    """A group of copies larger than a third of the table, cut in several places."""
    copies = spark.range(1000).select(F.lit(5).alias("k"), F.lit("same").alias("x"))
    rest = spark.range(700).select(F.lit(5).alias("k"), F.col("id").cast("string").alias("x"))
    df = copies.unionByName(rest).unionByName(spark.range(300).select(F.lit(4).alias("k"), F.lit("low").alias("x")))
    for cuts in ([100, 400, 900, 1500], [299], [300], [301], [2000], [0], [50, 50]):
        done = ranks.label_by_position(df, "k", lambda n, cuts=cuts: cuts)
        bounds = [0, *cuts, 2000]
        want = {i: b - a for i, (a, b) in enumerate(zip(bounds, bounds[1:])) if b > a}
        assert sizes(done, "segment") == want
        assert done.drop("segment").exceptAll(df).count() == 0


def test_copies_are_written_in_bounded_pieces(spark, monkeypatch):
    monkeypatch.setattr(ranks, "COPIES_PER_TASK", 64)
    df = spark.range(1000).select(F.lit(1).alias("k"), F.lit("x").alias("x"))
    assert sizes(ranks.label_by_position(df, "k", lambda n: [333]), "segment") == {0: 333, 1: 667}


def test_missing_order_key_is_an_error(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    with pytest.raises(ValueError, match="no k"):
        splits.temporal_split(df, "k")


def test_row_at(spark):
    df = spark.range(50).select((F.col("id") * 3).alias("k")).repartition(5)
    assert [r[0] for r in splits.row_at(df, 10, "k").collect()] == [30]
    assert splits.row_at(df, 50, "k").count() == 0


def test_sort_by_month_keeps_every_row_in_order(spark):
    df = months(spark, {3: 20, 1: 5, 2: 400})
    got = [r["year_month_numeric"] for r in splits.sort_by_month(df).collect()]
    assert got == sorted(got)
    assert len(got) == 425


def test_sample_one_is_seeded(spark):
    df = spark.range(100)
    first = splits.sample_one(df, 1, ["id"]).first()
    assert splits.sample_one(df.repartition(9), 1, ["id"]).first() == first
    assert any(splits.sample_one(df, s, ["id"]).first() != first for s in range(2, 6))


def test_quantile_of_fixture(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (10,)], "x int")
    assert ranks.exact_quantiles(df, "x", [0.7])[0.7] == pytest.approx(2.8)


@pytest.mark.parametrize("seed", range(4))
def test_quantiles_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    data = {
        0: rng.normal(size=997),
        1: np.concatenate([np.full(500, 7.25), rng.normal(size=400)]),
        2: np.exp(rng.normal(scale=30, size=701)),
        3: rng.integers(0, 5, size=600).astype(float),
    }[seed]
    df = spark.createDataFrame([(float(x),) for x in data] + [(None,), (math.nan,)], "x double")
    shares = [0.0, 0.01, 0.25, 0.5, 0.7, 0.99, 1.0]
    got = ranks.exact_quantiles(df, "x", shares)
    for share in shares:
        assert got[share] == pytest.approx(np.quantile(data, share), rel=1e-9, abs=1e-12)


def test_ranks_of_extreme_values(spark):
    data = [-math.inf, -1.7e308, -1.0, 0.0, 5e-324, 1e-300, 1.0, 1.7e308, math.inf]
    df = spark.createDataFrame([(x,) for x in data * 2], "x double")
    hits = ranks.locate_ranks(df, "x", list(range(18)))
    assert [hits[r].value for r in range(18)] == sorted(data * 2)
    assert all(hits[r].count == 2 and hits[r].below == r - r % 2 for r in range(18))


def test_quantile_split_and_filter(spark):
    df = months(spark, {1: 10, 2: 10, 3: 10})
    got = splits.quantile_split(df).groupBy("part").agg(F.max("year_month_numeric"), F.count("*")).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == {"before": (3, 30)} or {r[0]: r[2] for r in got} == {"before": 20, "after": 10}
    assert splits.filter_before_quantile(df, share=0.5).count() == 20
    assert splits.filter_before_quantile(df.limit(0)).count() == 0


def test_sample_one_of_tied_rows_is_the_same_however_dealt(spark):
    from terrier.operators import splits

    table = spark.range(1000).selectExpr("id", "1 as k")
    picked = {splits.sample_one(table.repartition(n), 3, ["k"]).first()["id"] for n in (1, 2, 5, 8)}
    assert len(picked) == 1


def test_passes_have_a_bound_for_any_distribution(spark, monkeypatch):
    from terrier.operators import ranks

    passes = []
    for name in ("_histogram", "_scales", "extent"):
        whole = getattr(ranks, name)
        monkeypatch.setattr(ranks, name, lambda *a, whole=whole, name=name: passes.append(name) or whole(*a))
    geometric = [2.0**i for i in range(-300, 300)]
    for values in (geometric, [-v for v in geometric], [0.0, 5e-324, 1e308, -1e308, 1.0, 1.0 + 2**-52] * 3, [1.0 + i * 2**-52 for i in range(900)]):
        table = spark.createDataFrame([(v,) for v in values], "v double").coalesce(2)
        passes.clear()
        own = sorted(values)
        place = 0.3 * (len(own) - 1)
        low = own[int(place)]
        expected = low + (own[int(place) + 1] - low) * (place - int(place)) if own[int(place) + 1] != low else low
        assert ranks.exact_quantiles(table, "v", [0.3])[0.3] == expected
        assert len(passes) <= 6, passes


def test_keys_of_64_bits_split_exactly(spark, monkeypatch):
    rng = random.Random(7)
    keys = [2**60 + rng.randrange(50) for _ in range(300)] + [-(2**63), 2**63 - 1, 2**63 - 1, -1, 0]
    keys += [rng.randrange(-(2**63), 2**63) for _ in range(200)] + [2**53 + 1] * 40
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, x int").repartition(3)
    ordered = sorted(keys)
    wanted = [0, 1, 150, 280, 281, 400, len(keys) - 2, len(keys) - 1]
    scans = []
    plain = ranks.F.shiftright
    monkeypatch.setattr(ranks.F, "shiftright", lambda c, n: scans.append(n) or plain(c, n))
    for rank in wanted:
        scans.clear()
        hit = ranks.locate_whole_ranks(df, "k", [rank], ranks.whole_extent(df, "k"))[rank]
        assert (hit.value, hit.below, hit.count) == (ordered[rank], ordered.index(ordered[rank]), ordered.count(ordered[rank]))
        assert len(scans) <= 2 * 5 - 1  # each scan but the first shifts twice
    hits = ranks.locate_whole_ranks(df, "k", wanted, ranks.whole_extent(df, "k"))
    assert [hits[r].value for r in wanted] == [ordered[r] for r in wanted]
    parts = splits.positional_split_80(df, "k").collect()
    train = sorted(r.k for r in parts if r.part == "train")
    assert train == ordered[: int(0.8 * len(keys))] and len(parts) == len(keys)
    assert [r.k for r in splits.row_at(df, 280, "k").collect()] == [ordered[280]]
    folds = splits.kfold_contiguous(df, "k").collect()
    assert [sorted(r.k for r in folds if r.fold == 2)] == [ordered[109:218]]


def test_ties_follow_a_digest_that_sql_can_state(spark):
    import hashlib

    rows = [(1, f"a|{i}", 0.1 * i, None if i % 3 else "\\") for i in range(60)]
    df = spark.createDataFrame(rows, "k int, s string, d double, n string").repartition(4)

    def digest(r):
        escaped = [None if t is None else t.replace("\\", "\\\\").replace("|", "\\|") for t in (r[1], r[3])]
        texts = [str(r[0]), escaped[0], str(math.floor(r[2] * 65536 + 0.5)), escaped[1]]
        return hashlib.md5("|".join("\\N" if t is None else t for t in texts).encode()).hexdigest()[:11]

    first = sorted(rows, key=digest)[:42]
    got = splits.temporal_split(df, "k").filter("part = 'train'").drop("part").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, first))
