"""Fit and transform against hand-computed values."""

import pytest
from pyspark.sql import functions as F

from terrier.operators import preprocessing as pre
from terrier.schemas import MERGED, PREPROCESSED, expect_schema

ROW = dict(
    year_month_numeric=24260, month_sin=-0.866, month_cos=-0.5, departement="27", unique_city_id="(27,185)",
    log_price_per_m2=7.6, living_area=67.0, building_type="Maison", n_rooms=2, outdoor_area="No garden",
    new_mortgages=1.0, debt_ratio=100.0, interest_rates=1.0, n_tax_households=10.0, average_tax_income=5.0,
)


def merged(spark, *changes):
    rows = [{**ROW, **c} for c in changes]
    return spark.createDataFrame([[r[f.name] for f in MERGED] for r in rows], MERGED)


def test_fitted_on_all_rows_at_once(spark):
    train = merged(
        spark,
        {"n_rooms": 1, "living_area": 1.0, "building_type": "Appartement"},
        {"n_rooms": 3, "living_area": 3.0, "outdoor_area": "Large outdoor space"},
    )
    fitted = pre.fit_preprocessor(train, with_labels=False)
    done = expect_schema(pre.apply_preprocessor(train, fitted), PREPROCESSED).orderBy("n_rooms").collect()
    assert [r["n_rooms"] for r in done] == [0.0, 1.0]
    assert [r["living_area"] for r in done] == [-1.0, 1.0]
    assert [r["building_type"] for r in done] == [0, 1]
    assert [r["new_mortgages"] for r in done] == [0.0, 0.0]
    assert [r["n_tax_households"] for r in done] == [0.0, 0.0]
    later = pre.apply_preprocessor(
        merged(spark, {"n_rooms": 5, "building_type": "Hangar", "outdoor_area": "Other"}, {"n_rooms": 6, "outdoor_area": None}),
        fitted,
    ).orderBy("n_rooms").collect()
    assert later[0]["n_rooms"] == 2.0
    assert later[0]["building_type"] == 0
    for row in later:
        assert sum(row[c] for c in pre.OUTDOOR_INDICATORS) == 0


def test_three_building_types_are_an_error(spark):
    rows = [{"building_type": t} for t in ("a", "b", "c")]
    with pytest.raises(ValueError, match="binary"):
        pre.fit_preprocessor(merged(spark, *rows), with_labels=False)


def test_labels(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "x string")
    labels = pre.label_table(df, "x")
    assert [tuple(r) for r in labels.orderBy("code").collect()] == [("a", 0), ("b", 1)]
    other = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "x string")
    got = pre.label_encode(other, "x", labels, "code").orderBy(F.expr("coalesce(x, '~')")).collect()
    assert [r["code"] for r in got] == [0, 1, 2, 2]


def test_many_labels_are_dense_and_sorted(spark):
    df = spark.range(5000).select(F.concat(F.lit("("), F.col("id") % 1777, F.lit(")")).alias("x"))
    rows = pre.label_table(df, "x").orderBy("label").collect()
    assert [r["code"] for r in rows] == list(range(1777))


def test_one_hot_keeps_the_second_of_two(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "x string")
    assert [r["x_b"] for r in pre.one_hot(df, "x", ["a", "b"]).collect()] == [0, 1, 0, 0]
    assert "x_a" in pre.one_hot(df, "x", ["a", "b", "c"]).columns
    assert [r["x"] for r in pre.category_codes(df, "x", ["a", "b"]).collect()] == [0, 1, -1, -1]


def test_state_survives_storage(spark, tmp_path):
    train = merged(spark, {"building_type": "Appartement", "n_rooms": 1}, {"n_rooms": 4, "unique_city_id": "(1,1)"})
    fitted = pre.fit_preprocessor(train)
    pre.save_preprocessor(spark, fitted, str(tmp_path / "state"))
    loaded = pre.load_preprocessor(spark, str(tmp_path / "state"))
    assert (loaded.minmax, loaded.moments, loaded.categories) == (fitted.minmax, fitted.moments, fitted.categories)
    assert pre.apply_preprocessor(train, loaded).collect() == pre.apply_preprocessor(train, fitted).collect()
    codes = pre.encode_labels(pre.apply_preprocessor(train, loaded), loaded)
    assert sorted(r["unique_city_id"] for r in codes.collect()) == [0, 1]


def test_numeric_matrix(spark):
    train = merged(spark, {"building_type": "Appartement"}, {"n_rooms": 4})
    done = pre.apply_preprocessor(train, pre.fit_preprocessor(train, with_labels=False))
    assert pre.numeric_matrix(done).first()["features"].size == 15
