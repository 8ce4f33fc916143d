"""The whole pipeline on the stand-in tables."""

import pytest
from pyspark.sql import functions as F

from terrier.catalog.models import _project
from terrier.catalog.registry import Tables
from terrier.plans import pipeline
from terrier.sources import registry
from terrier.sources.files import first_line

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def layout(spark):
    return _project(Tables(spark, FOLDER))


def test_steps_need_their_input(spark, tmp_path):
    empty = pipeline.Layout(str(tmp_path))
    with pytest.raises(FileNotFoundError, match="run_extract"):
        pipeline.run_clean(spark, empty)
    with pytest.raises(FileNotFoundError, match="run_clean"):
        pipeline.run_preprocess(spark, empty)
    with pytest.raises(FileNotFoundError, match="run_preprocess"):
        pipeline.run_train(spark, empty)
    with pytest.raises(ValueError, match="model_type"):
        pipeline.run_train(spark, empty, "other")


def test_clean_to_predict(spark, layout):
    sales = pipeline.run_clean(spark, layout, rows=None)
    rows = sales.count()
    assert pipeline.run_clean(spark, layout, rows=(rows - 1, rows + 1)).count() == rows
    assert pipeline.run_clean(spark, layout).count() == rows
    with pytest.raises(ValueError, match="outside"):
        pipeline.run_clean(spark, layout, rows=(7_000_000, 9_000_000))

    train, test = pipeline.run_preprocess(spark, layout)
    merged = spark.read.parquet(layout.merged)
    assert train.count() == int(0.7 * merged.count())
    assert train.count() + test.count() == merged.count()
    indicators = ["average_outdoor_space", "large_outdoor_space", "no_garden", "small_outdoor_space"]
    assert train.filter(sum(F.col(c) for c in indicators) > 1).isEmpty()

    pipeline.run_train(spark, layout, "gbt", maxIter=2, maxDepth=3)
    metrics = pipeline.run_evaluate(spark, layout).first()
    assert metrics["rmse"] ** 2 == pytest.approx(metrics["loss"] + 1e-8)
    one = pipeline.run_predict(spark, layout)
    assert one.count() == 1
    assert one.first()["price_per_sq_meter"] > 0
    assert sorted(r["context"] for r in registry.read_runs(spark, layout.artifacts).collect()) == ["evaluate", "train"]


def test_a_new_raw_table_renews_the_stages_made_from_it(spark, tmp_path):
    own = _project(Tables(spark, FOLDER))
    pipeline.run_clean(spark, own)
    pipeline.run_preprocess(spark, own)
    made = [own.merged, own.split, own.preprocessor, own.preprocessed("train")]

    def notes():
        return [first_line(spark, f"{p}/_MANIFEST") for p in made]

    before = notes()
    pipeline.run_clean(spark, own)
    pipeline.run_preprocess(spark, own)
    assert notes() == before

    raw = spark.read.parquet(own.transactions)
    smaller = raw.filter("n_pieces <= 3").toPandas()
    spark.createDataFrame(smaller, raw.schema).write.mode("overwrite").parquet(own.transactions)
    cleaned = pipeline.run_clean(spark, own)
    assert cleaned.filter("n_pieces > 3").isEmpty()
    train, test = pipeline.run_preprocess(spark, own)
    assert all(a != b for a, b in zip(notes(), before))
    assert train.count() + test.count() == spark.read.parquet(own.merged).count()
