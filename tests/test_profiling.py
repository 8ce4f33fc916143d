"""Profiling tables against NumPy and hand-computed values."""

import numpy as np
import pytest

from terrier.operators import profiling, ranks


def test_histogram_matches_numpy(spark):
    data = np.random.default_rng(3).normal(size=500)
    df = spark.createDataFrame([(float(x),) for x in data], "x double")
    got = profiling.histogram(df, "x", 80).orderBy("bin").collect()
    counts, edges = np.histogram(data, bins=80)
    assert [r["n"] for r in got] == list(counts)
    assert [r["low"] for r in got] == pytest.approx(edges[:-1])


def test_histogram_of_a_constant(spark):
    got = profiling.histogram(spark.createDataFrame([(5.0,), (5.0,)], "x double"), "x", 4).collect()
    assert sum(r["n"] for r in got) == 2


def test_box_stats(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]], "x double")
    row = profiling.box_stats(df, ["x"]).first()
    assert tuple(row) == ("x", 1.0, 2.0, 3.0, 4.0, 4.0, 1)


def test_qq_points(spark):
    df = spark.range(101)
    got = profiling.qq_points(df, "id", [0.25, 0.5]).collect()
    assert [r["sample"] for r in got] == [25.0, 50.0]
    assert got[1]["theoretical"] == pytest.approx(0.0)


def test_null_and_table_profile(spark):
    df = spark.createDataFrame([(1, float("nan")), (None, 2.0)], "a int, b double")
    assert {r["column"]: r["n_missing"] for r in profiling.null_profile(df).collect()} == {"a": 1, "b": 1}
    assert {tuple(r) for r in profiling.table_profile(df).collect()} == {("a", 1, "int"), ("b", 1, "double")}


def test_value_frequencies(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (2, "c")], "x int, y string")
    got = {(r["x"], r["y"]): r["proportion"] for r in profiling.value_frequencies(df).collect()}
    assert got == {(1, "a"): 0.5, (2, "b"): 0.25, (2, "c"): 0.25}


def test_infinite_values_are_left_out(spark):
    from terrier.operators import profiling

    inf = float("inf")
    table = spark.createDataFrame([(x,) for x in (1.0, 2.0, 3.0, inf, -inf, float("nan"), None)], "v double")
    assert [r["n"] for r in profiling.histogram(table, "v", 2).orderBy("bin").collect()] == [1, 2]
    row = profiling.box_stats(table, ["v"]).first()
    assert (row["low"], row["median"], row["high"], row["outliers"]) == (1.0, 2.0, 3.0, 0)


def test_quartiles_of_many_columns_take_the_scans_of_one(spark, monkeypatch):
    rng = np.random.default_rng(5)
    data = {
        "a": rng.normal(size=400),
        "b": np.exp(rng.normal(scale=40, size=400)),
        "c": np.where(rng.random(400) < 0.4, 7.0, rng.normal(size=400) - 1e6),
        "d": rng.integers(-3, 3, 400).astype(float),
        "e": np.full(400, 2.5),
        "f": np.full(400, np.nan),
    }
    data["a"][:9], data["a"][9] = np.inf, np.nan
    df = spark.createDataFrame(list(zip(*[map(float, v) for v in data.values()])), ", ".join(f"{c} double" for c in data)).repartition(3)
    scans = []
    explode = ranks.F.explode
    monkeypatch.setattr(ranks.F, "explode", lambda c: scans.append(c) or explode(c))
    shares = [0.0, 0.25, 0.5, 0.75, 1.0]
    every = ranks.column_quantiles(df, [ranks.F.col(c) for c in data], shares)
    many = len(scans)
    for found, (name, values) in zip(every, data.items(), strict=True):
        assert found == ranks.exact_quantiles(df, name, shares)
        known = values[np.isfinite(values)]
        if name not in "af":
            assert list(found.values()) == pytest.approx(np.quantile(known, shares).tolist(), rel=1e-9)
    alone = []
    for name in data:
        scans.clear()
        ranks.column_quantiles(df, [ranks.F.col(name)], shares)
        alone.append(len(scans))
    assert many <= max(alone) + 1 < sum(alone)
    assert ranks.column_quantiles(df, [], shares) == []
    box = {r.column: r for r in profiling.box_stats(df, list(data)).collect()}
    assert box["e"].median == 2.5 and box["f"].median is None and box["a"].high < np.inf
