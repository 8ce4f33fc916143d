"""Models on a small synthetic relation, scoring requests, evaluation."""

import math

import pytest
from pyspark.sql import functions as F

from terrier.operators import modelling
from terrier.operators import preprocessing as pre
from terrier.schemas import SCORING_REQUEST

# The sample request of the scoring interface.
REQUEST = (24260, -0.8660254037844384, -0.5, "27", "(27, 185)", 67.0, "Maison", 2, "No garden",
           26094000000.0, 102.92333, 1.09, 263.5555, 28603.3277)


@pytest.fixture(scope="module")
def merged(spark):
    n = F.col("id")
    return spark.range(600).select(
        (24200 + n % 60).cast("int").alias("year_month_numeric"),
        F.sin(n).alias("month_sin"), F.cos(n).alias("month_cos"),
        F.expr("cast(1 + id % 7 as string)").alias("departement"),
        F.expr("concat('(', 1 + id % 7, ',', id % 21, ')')").alias("unique_city_id"),
        (7 + n % 5 * 0.3 + F.expr("if(id % 2 = 0, 0.4, 0)")).alias("log_price_per_m2"),
        (20 + n % 5 * 10).cast("float").alias("living_area"),
        F.expr("if(id % 2 = 0, 'Maison', 'Appartement')").alias("building_type"),
        (1 + n % 4).cast("int").alias("n_rooms"), F.lit("No garden").alias("outdoor_area"),
        (n % 60 * 1e9).alias("new_mortgages"), F.lit(100.0).cast("float").alias("debt_ratio"),
        (n % 9).cast("float").alias("interest_rates"), (n % 21 * 10.0).alias("n_tax_households"),
        (n % 21 * 100.0).alias("average_tax_income"),
    ).repartition(2)


@pytest.fixture(scope="module")
def fitted(merged):
    return pre.fit_preprocessor(merged)


def encoded(merged, fitted):
    return pre.encode_labels(pre.apply_preprocessor(merged, fitted, keep=["log_price_per_m2"]), fitted)


@pytest.fixture(scope="module")
def gbt(merged, fitted):
    return modelling.train_gbt(encoded(merged, fitted), 7, maxIter=8, maxDepth=4, stepSize=0.3)


def test_trees_learn(merged, fitted, gbt):
    scored = modelling.predict(encoded(merged, fitted), gbt)
    rmse = modelling.evaluate_rmse(scored).first()["rmse"]
    mean = merged.agg(F.stddev_pop("log_price_per_m2")).first()[0]
    assert rmse < mean / 2


def test_training_ends_at_the_best_round(merged, fitted):
    rows = encoded(merged, fitted)
    flat = rows.withColumn("log_price_per_m2", F.lit(0.0))
    model = modelling.train_gbt(rows, 7, flat, patience=2, maxIter=6, maxDepth=3)
    losses = [r["rmse"] for r in modelling.training_curve(model, flat).collect()]
    assert len(losses) == modelling.best_round([x * x for x in losses], 2) < 6


def test_best_round():
    assert modelling.best_round([5, 4, 3, 3.5, 3.4, 1], 5) == 6
    assert modelling.best_round([5, 4, 3, 3.5, 3.4, 1], 2) == 3
    assert modelling.best_round([1], 5) == 1


def test_requests(spark, fitted, gbt):
    row = modelling.score_requests(spark.createDataFrame([REQUEST], SCORING_REQUEST), fitted, gbt).first()
    assert row["unique_city_id"] == "(27,185)"
    assert row["price_per_sq_meter"] == pytest.approx(math.exp(row["log_price"]))


def test_batch_scores_every_row(merged, fitted, gbt):
    scored = modelling.score_batch(merged, fitted, gbt, keep=["unique_city_id", "living_area"])
    assert scored.columns == ["unique_city_id", "living_area", "log_price", "price_per_sq_meter"]
    assert scored.count() == 600


def test_factor_model_beats_the_mean(merged, fitted):
    model = modelling.train_embedding_model(encoded(merged, fitted), 7, 21, factor_size=2, max_iter=60)
    rmse = modelling.evaluate(modelling.predict(encoded(merged, fitted), model)).first()["rmse"]
    assert rmse < merged.agg(F.stddev_pop("log_price_per_m2")).first()[0]


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "log_price double, log_price_per_m2 double")
    row = modelling.evaluate(df).first()
    assert (row["loss"], row["mae"], row["row_count"]) == (2.5, 1.5, 2)
    assert row["rmse"] == pytest.approx(math.sqrt(2.5 + 1e-8), abs=1e-12)


def test_baseline_r2(spark):
    df = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 1.0).alias("y"))
    folds = [[2 * i, 2 * i + 1] for i in range(5)]
    want = []
    for test in folds:
        rest = [x for x in range(10) if x not in test]
        guess, mean = sum(rest) / 8, sum(test) / 2
        want.append(1 - sum((x - guess) ** 2 for x in test) / sum((x - mean) ** 2 for x in test))
    got = modelling.baseline_mean(df, "y", "k").first()["mean_r2"]
    assert got == pytest.approx(sum(want) / 5)


def test_non_finite_targets_do_not_reach_the_learner(spark, merged, fitted):
    rows = encoded(merged, fitted)
    odd = rows.withColumn("log_price_per_m2", F.when(F.col("n_rooms") == 0, F.lit(math.inf)).otherwise(F.col("log_price_per_m2")))
    model = modelling.train_gbt(odd, 7, maxIter=1, maxDepth=2)
    assert math.isfinite(modelling.predict(rows, model).agg(F.max("log_price")).first()[0])
