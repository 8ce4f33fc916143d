"""Sums by city: no pass over them shuffles them, and what is dealt is no larger than the rows."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrier.operators import factors
from terrier.operators.factors import fit_factors, statistics


def rows(spark, n, cities, seed=2):
    """(city, part, dep, y, x0, x1) with a hot city and cities of one row."""
    rng = random.Random(seed)
    found = []
    for i in range(n):
        city = 7 if i % 3 == 0 else 1000 + rng.randrange(cities)
        found.append((city, i % 2, city % 4, float(rng.randrange(9)), float(rng.randrange(5)), float(rng.randrange(3))))
    return spark.createDataFrame(found, "city long, part int, dep long, y double, x0 double, x1 double").repartition(4)


def test_a_pass_over_the_sums_shuffles_none_of_them(spark, monkeypatch):
    read = []
    plain = factors._summed
    monkeypatch.setattr(factors, "_summed", lambda stats, *a: read.append(stats) or plain(stats, *a))
    df = rows(spark, 400, 60)
    fit_factors(df.filter("part = 0"), "y", ["x0", "x1"], "dep", "city", df.filter("part = 1"), 2, 1, 2, rounds=3, prediction="p")
    assert len(read) >= 3
    assert not any("Exchange" in stats._jdf.queryExecution().executedPlan().toString() for stats in read)


def test_one_record_a_city_holds_its_sums(spark):
    df = rows(spark, 6000, 2000)
    want = {(r.city, r.part, r.dep): [r.n, r.yy, *r.t, *r.s] for r in statistics(df, 3).collect()}
    got = {}
    records = factors.city_records(df, 3).collect()
    for r in records:
        halves = np.array(r.v).reshape(len(r.part), -1)
        for part, dep, sums in zip(r.part, r.dep, factors._whole(halves, 3).tolist(), strict=True):
            got[r.city, part, dep] = sums
    assert got == want and len(records) == df.select("city").distinct().count()
    plain = df.groupBy("city", "part", "dep").agg(F.count("*").alias("n"), F.sum(F.col("x0") * F.col("x1")).alias("xx"))
    assert {(r.city, r.part, r.dep): [r.n, r.xx] for r in plain.collect()} == {k: [v[0], v[5 + 5]] for k, v in want.items()}


def test_what_is_dealt_is_no_larger_than_the_rows(spark):
    n = 6000
    dealt = factors._dealt(rows(spark, n, 2000), 3).select("city", F.size("v").alias("n")).collect()
    assert sum(r.n for r in dealt) <= 3 * n
    assert sum(r.n for r in dealt if r.city == 7) <= 4 * 2 * 11


@pytest.mark.parametrize("limit", [1, 4096])
def test_pieces_end_where_a_city_ends(spark, limit):
    import pyarrow as pa

    df = rows(spark, 500, 50)
    table = pa.Table.from_pylist([r.asDict() for r in factors.city_records(df, 3).collect()], pa.schema(
        [("city", pa.int64()), ("part", pa.list_(pa.int32())), ("dep", pa.list_(pa.int64())), ("v", pa.list_(pa.float64()))]
    ))
    pieces = list(factors._whole_cities(table.to_batches(max_chunksize=20 * limit), 3))
    cities = [set(keys[:, 0].tolist()) for keys, _ in pieces]
    assert sum(map(len, cities)) == len(set().union(*cities)) == table.num_rows
    assert sum(sums[:, 0].sum() for _, sums in pieces) == 500


def test_rounds_leave_no_shuffle_files_of_their_own(spark):
    def shuffles():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = [found.apply(i).getName() for i in range(found.size())]
        return {n.split("_")[1] for n in names if n.startswith("shuffle_")}

    df, before = rows(spark, 300, 40).cache(), shuffles()
    df.count()
    fit_factors(df.filter("part = 0"), "y", ["x0", "x1"], "dep", "city", df.filter("part = 1"), 9, 1, 2, rounds=5, prediction="p")
    for _ in range(50):
        if len(shuffles() - before) <= 3:
            break
        time.sleep(0.2)
    assert len(shuffles() - before) <= 3  # of the rows themselves and of the moments before the rounds
