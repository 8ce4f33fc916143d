"""Quality and toxicity: held-out agreement with the labels, and awkward tables."""

import numpy as np
import pytest

from cases import awkward, empty
from terrier.llm import quality, toxicity

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return docs, spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_quality_agrees_with_labels_it_never_saw(spark, tables):
    docs, labels = tables
    known = docs.join(labels, "doc_id", "left_semi")
    found = quality.classify(known, quality.fit(known, most=3000)).join(labels, "doc_id").toPandas()
    good, bad = found[found.quality == 1], found[found.quality == 0]
    assert good.keep.mean() >= 0.99 and (~bad.keep).mean() >= 0.95


def test_quality_of_awkward_rows(spark):
    docs = awkward(spark)
    model = quality.fit(docs)
    found = quality.classify(docs, model)
    assert found.count() == docs.count()
    kept = {r.doc_id: r.keep for r in found.collect()}
    assert not kept[2] and not kept[3] and not kept[4]
    assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.classify(empty(spark), quality.fit(empty(spark))).count() == 0


def test_expectation_maximisation_finds_known_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.8
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.9, 0.95, 0.7, 0.9])
    correct = rng.random((len(truth), 8)) < right
    votes = np.where(rng.random(correct.shape) < 0.2, ".", np.where(correct == truth[:, None], "g", "b"))
    patterns, counts = np.unique(["".join(v) for v in votes], return_counts=True)
    found, posterior = quality.estimate(patterns.tolist(), counts)
    assert np.abs(found - right).max() < 0.03
    assert (np.array([posterior["".join(v)] for v in votes]) > 0.5).__eq__(truth).mean() > 0.97


def test_toxicity_on_held_out_rows(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels)
    found = toxicity.score(docs, model).filter("held_out").join(labels, "doc_id").toPandas()
    toxic, clean = found[found.toxic == 1], found[found.toxic == 0]
    assert (clean.predicted == 0).mean() >= 0.98 and (toxic.predicted == 1).mean() >= 0.8
    assert found.score.between(0, 1).all()
    # A misspelling that no training text holds shares n-grams with words that they do.
    rate = toxicity.scorer(model)
    assert rate(["and the patheticc of the idiott in that"])[0] > rate(["and the ofthe the inand in that"])[0]


def test_toxicity_of_awkward_rows(spark, tables):
    docs = awkward(spark)
    marks = spark.createDataFrame([(1, 1), (6, 0), (7, None), (None, 1)], "doc_id long, toxic int")
    found = toxicity.score(docs, toxicity.fit(docs, marks))
    assert found.count() == docs.count() and found.filter("score is null or predicted is null").count() == 0
    nothing = toxicity.fit(docs, marks.limit(0))
    assert {r.predicted for r in toxicity.score(docs, nothing).collect()} == {0}
    assert toxicity.score(empty(spark), nothing).count() == 0


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} and more of it") for i in range(60)], "doc_id long, text string")
    marks = spark.range(60).selectExpr("id doc_id", "cast(id % 7 = 0 as int) toxic")
    other = marks.withColumn("toxic", toxicity.F.when(toxicity.held_out(), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    a, b = toxicity.fit(docs, marks), toxicity.fit(docs, other)
    assert np.array_equal(a.value, b.value) and a.bias == b.bias
