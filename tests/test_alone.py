"""Boosted trees in one task: few jobs, the same trees as by a job for each level, bounded by bytes."""

import math
import random

import pytest
from pyspark.sql import functions as F

from terrier.operators import boosting
from terrier.operators.boosting import fit_trees
from terrier.sources.scratch import scratch_home

HOW = dict(patience=30, rate=0.3, l2=1.0, gamma=0.1, least=2.0, bins=16, prediction="p")


def table(spark, n=900, seed=5):
    """Two smooth columns, two of few values, one with gaps, two nominal ones; one nominal code is missing at times."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c, d, city = rng.random(), rng.gauss(0, 1), float(rng.randrange(2)), float(rng.randrange(4)), rng.randrange(40)
        y = math.sin(5 * a) + 0.2 * b + 0.5 * c * d + (1.0 if city % 3 == 1 else 0.0) + rng.gauss(0, 0.3)
        rows.append((i, a if i % 7 else None, b, c, d, city % 5, city if i % 11 else None, y))
    return spark.createDataFrame(rows, "k long, a double, b double, c double, d double, dep long, city long, y double").repartition(3).cache()


def fitted(spark, **how):
    df = table(spark)
    return fit_trees(df.filter("k % 4 > 0"), "y", ["a", "b", "c", "d"], ["dep", "city"], df.filter("k % 4 = 0"), **{**HOW, **how}), df


def jobs(spark, run):
    """How many jobs a call takes."""
    spark.sparkContext.setJobGroup("counted", "")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    run()
    found = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return found


def test_few_rows_take_few_jobs_whatever_the_rounds(spark):
    assert jobs(spark, lambda: fitted(spark, rounds=6, depth=4)) < 6 * 4


def test_the_same_trees_as_by_a_job_for_each_level(spark, monkeypatch):
    alone, df = fitted(spark, rounds=5, depth=4)
    calls = []
    plain = boosting._level
    monkeypatch.setattr(boosting, "ALONE_BYTES", 0)
    monkeypatch.setattr(boosting, "_level", lambda *a: calls.append(1) or plain(*a))
    by_jobs, _ = fitted(spark, rounds=5, depth=4)
    assert len(calls) == 5 * 4 + 1 and alone.rounds == by_jobs.rounds == 5
    assert alone.losses == pytest.approx(by_jobs.losses, abs=1e-9)
    assert any(t.chosen[0] or any(t.chosen) for t in alone.trees) and any(f >= 0 for t in alone.trees for f in t.feature[3:])
    for one, other in zip(alone.trees, by_jobs.trees, strict=True):
        assert (one.feature, one.cut, one.chosen, one.left, one.right) == (other.feature, other.cut, other.chosen, other.left, other.right)
        assert one.value == pytest.approx(other.value, abs=1e-9)
    assert [r.loss for r in alone.curve(df.filter("k % 4 = 0"), "y").collect()] == pytest.approx(alone.losses)


def test_rewritten_rows_replace_those_before(spark, monkeypatch):
    monkeypatch.setattr(boosting, "ALONE_BYTES", 0)
    tables = lambda: {p.name for p in _home(spark).glob("bins-*")}
    before = tables()
    fitted(spark, rounds=2 * boosting.REFRESH + 1, depth=2)
    assert len(tables() - before) == 1


def _home(spark):
    from pathlib import Path

    return Path(scratch_home(spark).removeprefix("file:"))


def test_without_a_draw_of_rows_or_a_level(spark):
    df = table(spark, 60)
    model = fit_trees(df, "y", ["a", "b"], ["city"], rounds=2, depth=0, prediction="p")
    mean = df.agg(F.avg("y")).first()[0]
    assert model.rounds == 2 and {r.p for r in model.transform(df).select("p").collect()} == {mean}
