"""Scalar expressions against hand-computed values."""

import math

import pytest
from pyspark.sql import functions as F

from terrier import functions as fx


def values(spark, kind, given, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(given)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("x"))).collect()]


def test_parse_number(spark):
    text = ["12", " 1.5 ", "-3e2", "1d", "1f", "abc", "", None, ".5", "5.", "inf", "1,5", "0x10"]
    assert values(spark, "string", text, fx.parse_number) == [
        12.0, 1.5, -300.0, None, None, None, None, None, 0.5, 5.0, math.inf, None, None,
    ]


def test_parse_integer_truncates_and_drops_overflow(spark):
    assert values(spark, "string", ["7", "7.9", "99999999999", "x"], fx.parse_integer) == [7, 7, None, None]


def test_parse_date(spark):
    text = ["2021-08-15", "2021-08-15 10:11:12", "not a date", None, "2021-02-30", "2021-08-15 junk"]
    got = values(spark, "string", text, fx.parse_date)
    assert [str(d) if d else None for d in got] == ["2021-08-15", "2021-08-15", None, None, None, None]


def test_parse_year_and_quarter(spark):
    assert str(values(spark, "int", [2014], fx.parse_year)[0]) == "2014-01-01"
    text = ["2014-Q3", "2014Q1", "Q4 2015", "2014-05-20", "2Q2016", "none"]
    got = values(spark, "string", text, fx.parse_quarter)
    assert [str(d) if d else None for d in got] == [
        "2014-07-01", "2014-01-01", "2015-10-01", "2014-04-01", "2016-04-01", None,
    ]


@pytest.mark.parametrize(
    ("area", "label"),
    [
        (0.0, "No garden"),
        (120.0, "Small outdoor space"),
        (200.0, "Small outdoor space"),
        (200.5, "Average outdoor space"),
        (1000.0, "Average outdoor space"),
        (1001.0, "Large outdoor space"),
        (math.inf, "Large outdoor space"),
        (-0.5, "No garden"),
        (-1.0, None),
        (-5.0, None),
        (math.nan, None),
        (None, None),
    ],
)
def test_bin_outdoor_area(spark, area, label):
    assert values(spark, "double", [area], fx.bin_outdoor_area) == [label]


def test_land_text(spark):
    text = ["{}", "{80,45}", "{120}", None]
    assert values(spark, "string", text, fx.strip_braces) == ["", "80,45", "120", None]
    assert values(spark, "string", ["80,45", "120", None], fx.collapse_multi_plot) == ["0", "120", None]
    assert values(spark, "string", ["80,45", "120"], lambda c: fx.parse_number(fx.sum_multi_plot(c))) == [125.0, 120.0]
    assert values(spark, "double", [None, math.nan, 3.0], fx.fill_missing_zero) == [0.0, 0.0, 3.0]


def test_price(spark):
    pairs = [(134000.0, 67.0), (134000.0, 0.0), (0.0, 0.0), (0.0, 67.0), (-100.0, 10.0), (-100.0, 0.0), (None, 5.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, p double, a double").orderBy("i")
    got = [r[0] for r in df.select(fx.price_per_m2("p", "a")).collect()]
    assert got == [2000.0, math.inf, 1e-5, 1e-5, -10.0, -math.inf, 1e-5]
    logs = [r[0] for r in df.select(fx.log_target("p", "a")).collect()]
    assert logs[0] == pytest.approx(7.6009025, abs=1e-7)
    assert logs[1] == math.inf
    assert logs[2] == pytest.approx(-11.5129255, abs=1e-7)
    assert logs[4] is None


def test_month_features(spark):
    row = spark.sql("select date'2021-08-15' d").select(
        fx.year_month_numeric("d"), fx.month_sin("d"), fx.month_cos("d")
    ).first()
    assert row[0] == 24260
    assert row[1] == pytest.approx(-0.8660254037844384)
    assert row[2] == pytest.approx(-0.5)


def test_city_key(spark):
    row = spark.sql("select 27 d, 185 i, '(27, 185)' k").select(fx.unique_city_id("d", "i"), fx.normal_city_id("k")).first()
    assert list(row) == ["(27,185)", "(27,185)"]


def test_scales(spark):
    assert values(spark, "double", [1.0, 3.0, 5.0], lambda c: fx.scale_minmax(c, 1.0, 3.0)) == [0.0, 1.0, 2.0]
    assert values(spark, "double", [5.0], lambda c: fx.scale_minmax(c, 5.0, 5.0)) == [0.0]
    assert values(spark, "double", [1.0, 3.0], lambda c: fx.scale_standard(c, 2.0, 1.0)) == [-1.0, 1.0]
    assert values(spark, "double", [5.0], lambda c: fx.scale_standard(c, 5.0, 0.0)) == [0.0]


def test_exp_inverts_log(spark):
    row = spark.sql("select 134000d p, 67d a").select(fx.exp_price(fx.log_target("p", "a"))).first()
    assert row[0] == pytest.approx(2000.0)
