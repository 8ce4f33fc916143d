"""Spine, interpolation and quarters on hand-computed series."""

from datetime import date

import pytest

from terrier.operators import cleaning, series


def table(spark, points, value="v"):
    return spark.createDataFrame([(date.fromisoformat(d), v) for d, v in points], f"month date, {value} double")


def spine(spark, first="2014-01-01", last="2014-08-01"):
    return series.month_spine(table(spark, [(first, 0.0), (last, 0.0)]))


def filled(spark, points):
    done = series.align_interpolate(spine(spark), table(spark, points), "v").orderBy("month").collect()
    return [r["v"] for r in done]


def test_yearly_values_become_monthly(spark):
    yearly = spark.createDataFrame([(2014, 0.0), (2015, 12.0), (2017, 36.0)], "date int, taux double")
    months = cleaning.clean_debt_ratio(yearly).orderBy("month").collect()
    assert [r["taux"] for r in months] == pytest.approx(list(range(37)))
    assert str(months[-1]["month"]) == "2017-01-01"


def test_leading_gap_stays_and_trailing_repeats(spark):
    got = filled(spark, [("2014-02-01", 1.0), ("2014-05-01", 3.0)])
    assert got[0] is None
    assert got[1:] == pytest.approx([1, 5 / 3, 7 / 3, 3, 3, 3, 3])


def test_dates_off_the_spine_vanish(spark):
    got = filled(spark, [("2014-02-01", 1.0), ("2014-04-01", 3.0), ("2014-06-15", 9.0)])
    assert got == [None, 1.0, 2.0, 3.0, 3.0, 3.0, 3.0, 3.0]


def test_spine_starts_at_the_next_month_start(spark):
    months = [str(r[0]) for r in spine(spark, "2014-01-10", "2014-03-20").orderBy("month").collect()]
    assert months == ["2014-02-01", "2014-03-01"]
    assert spine(spark, "2014-01-10", "2014-01-20").count() == 0


def test_quarters(spark):
    quarters = spark.createDataFrame(
        [(date(2014, 7, 1), 106.0), (date(2014, 1, 1), 100.0), (date(2014, 4, 1), 103.0)], "quarter date, IRL double"
    )
    got = series.expand_quarters(quarters).orderBy("month").collect()
    assert [(r["month"].month, r["IRL"]) for r in got] == [(i + 1, pytest.approx(100.0 + i)) for i in range(6)]


def test_several_series_stay_apart(spark):
    rows = [("a", date(2014, 1, 1), 0.0), ("a", date(2014, 3, 1), 2.0), ("b", date(2014, 2, 1), 5.0)]
    many = spark.createDataFrame(rows, "k string, month date, v double")
    aligned = series.align_to_spine(series.month_spine(many, ["k"]), many, ["v"], ["k"])
    got = series.interpolate_linear(aligned, ["v"], ["k"]).orderBy("k", "month").collect()
    assert [(r["k"], r["month"].month, r["v"]) for r in got] == [("a", 1, 0.0), ("a", 2, 1.0), ("a", 3, 2.0), ("b", 2, 5.0)]


def test_incomplete_months_are_dropped(spark):
    full = table(spark, [("2014-01-01", 1.0), ("2014-04-01", 4.0)], "a")
    late = table(spark, [("2014-03-01", 9.0)], "b")
    got = series.assemble_series(series.month_spine(full), [(full, "a", "x"), (late, "b", "y")]).orderBy("month").collect()
    assert [(r["month"].month, r["x"], r["y"]) for r in got] == [(3, 3.0, 9.0), (4, 4.0, 9.0)]


def test_repeated_months_raise(spark):
    rows = [("2020-01-01", 1.0, "a"), ("2020-02-01", 2.0, "a"), ("2020-02-01", 3.0, "b")]
    table = spark.createDataFrame(rows, "month string, v double, k string").selectExpr("to_date(month) month", "v", "k")
    spine = series.month_spine(table)
    with pytest.raises(ValueError, match="2020, 2, 1"):
        series.align_to_spine(spine, table, ["v"])
    keyed = series.month_spine(table, ["k"])
    assert series.align_to_spine(keyed, table, ["v"], ["k"]).count() == 3
