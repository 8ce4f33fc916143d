"""Factors of cities and departments: a planted low-rank table, the stop, saving, skew."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrier.operators.factors import FactorModel, fit_factors, statistics

NUMERIC = [f"n{i}" for i in range(9)]


def planted(spark, cities=200, each=8, noise=0.01, seed=1):
    """Coefficients of a city are of rank 2; a city has fewer rows than coefficients."""
    rng = np.random.default_rng(seed)
    p, u = rng.normal(size=(10, 2)), rng.normal(size=(cities, 2))
    q, v = rng.normal(size=(10, 1)), rng.normal(size=(10, 1))
    rows = []
    for c in range(cities):
        for k in range(each + 4):
            x = rng.normal(size=9)
            one = np.append(1.0, x)
            y = one @ (p @ u[c] + q @ v[c % 10]) + 3 + rng.normal() * noise
            rows.append((k < each, c, c % 10, float(y), *map(float, x)))
    schema = "train boolean, city long, dep long, y double, " + ", ".join(f"{n} double" for n in NUMERIC)
    df = spark.createDataFrame(rows, schema).repartition(4)
    return df.filter("train"), df.filter("not train")


def error(model, df):
    return model.transform(df).agg(F.sqrt(F.avg((F.col("p") - F.col("y")) ** 2))).first()[0]


@pytest.fixture(scope="module")
def model(spark):
    fit, held = planted(spark)
    return fit_factors(fit, "y", NUMERIC, "dep", "city", held, 5, 1, 2, rounds=25, ridge=0.01, prediction="p"), fit, held


def test_a_planted_table_is_recovered(model):
    model, fit, held = model
    spread = held.agg(F.stddev_pop("y")).first()[0]
    assert spread > 2 and error(model, held) < 0.15
    assert model.losses[-1] == min(model.losses) and model.losses[-1] == pytest.approx(error(model, held) ** 2, rel=1e-6)
    assert model.cities.count() == 200 and len(model.cities.first()["factor"]) == 2


def test_the_best_round_is_kept(spark):
    fit, held = planted(spark, cities=40, noise=1.0)
    noisy = held.withColumn("y", F.randn(3))
    model = fit_factors(fit, "y", NUMERIC, "dep", "city", noisy, patience=2, rounds=40, ridge=0.1, prediction="p")
    assert len(model.losses) < 40 and model.losses[-1] == min(model.losses)


def test_saved_and_unknown(spark, model, tmp_path):
    model, _, held = model
    model.save(spark, str(tmp_path / "m"))
    again = FactorModel.load(spark, str(tmp_path / "m"))
    odd = held.limit(5).withColumn("city", F.lit(10**12)).withColumn("dep", F.lit(None).cast("long"))
    for df in (held, odd):
        assert sorted(r.p for r in again.transform(df).collect()) == sorted(r.p for r in model.transform(df).collect())
    assert again.transform(held).columns == [*held.columns, "p"]


def test_sums_of_a_hot_city(spark):
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("long").alias("city"), F.lit(0).alias("part"),
        (F.col("id") % 2).alias("dep"), (F.col("id") % 11).cast("double").alias("y"), (F.col("id") % 5).cast("double").alias("x0"),
    )
    want = df.groupBy("city", "dep").agg(F.count("*").alias("n"), F.sum(F.col("x0") * F.col("y")).alias("xy"), F.sum(F.col("x0") * F.col("x0")).alias("xx"))
    got = statistics(df.repartition(6), 2).select("city", "dep", "n", F.col("t")[1].alias("xy"), F.col("s")[3].alias("xx"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
