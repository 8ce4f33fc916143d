"""Monthly series: spine, alignment, linear interpolation, quarters.

A series holds one row per month of the calendar, so it has at most 12 x 9999 rows whatever the size
of the data it was aggregated from. ``expect_unique`` enforces that where a series comes in; it is what
allows the small windows and the broadcasts here. Pass ``key`` when a table holds several series; every window is then partitioned by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrier.functions import year_month_numeric
from terrier.schemas import TEMPORAL, cast_schema


def month_spine(series: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Month starts from the first to the last date of a series.

    A first date inside a month begins the spine at the following month.
    """
    key = key or []
    start = F.trunc(F.min("month"), "month")
    first = F.when(start == F.min("month"), start).otherwise(F.add_months(start, 1))
    last = F.trunc(F.max("month"), "month")
    bounds = series.groupBy(*key).agg(first.alias("_first"), last.alias("_last"))
    months = F.sequence("_first", "_last", F.expr("interval 1 month"))
    return bounds.filter(F.col("_first") <= F.col("_last")).select(*key, F.explode(months).alias("month"))


def expect_unique(series: DataFrame, key: list[str]) -> None:
    """Raise with the first few keys that stand in several rows. With it, a series has a row per month."""
    double = series.groupBy(*key).count().filter("count > 1").orderBy(*key).limit(5).collect()
    if double:
        raise ValueError(f"repeated {', '.join(key)}: {'; '.join(str(tuple(r)[:-1]) for r in double)}")


def align_to_spine(spine: DataFrame, series: DataFrame, values: list[str], key: list[str] | None = None) -> DataFrame:
    """Values of a series on the spine; months without an exact date are NULL, other dates vanish.

    A date that the series holds twice would double every month it is joined to, so it raises.
    """
    key = key or []
    expect_unique(series, [*key, "month"])
    return spine.join(series.select(*key, "month", *[f"`{v}`" for v in values]), [*key, "month"], "left")


def interpolate_linear(aligned: DataFrame, values: list[str], key: list[str] | None = None) -> DataFrame:
    """Fill gaps linearly with equal spacing by row.

    Leading gaps stay missing; trailing gaps repeat the last value.
    """
    key = key or []
    order = Window.partitionBy(*(key or [F.lit(0)])).orderBy("month")
    before = order.rowsBetween(Window.unboundedPreceding, 0)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    numbered = aligned.withColumn("_i", F.row_number().over(order))

    def filled(name: str) -> Column:
        value = F.col(f"`{name}`").cast("double")
        value = F.when(~F.isnan(value), value)
        at = F.when(value.isNotNull(), F.col("_i"))
        left, left_at = F.last(value, True).over(before), F.last(at, True).over(before)
        right, right_at = F.first(value, True).over(after), F.first(at, True).over(after)
        slope = F.try_divide((right - left) * (F.col("_i") - left_at), (right_at - left_at).cast("double"))
        return F.coalesce(value, left + slope, left).alias(name)

    return numbered.select(*key, "month", *[filled(v) for v in values])


def assemble_series(spine: DataFrame, series: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Line up ``(series, value column, output name)`` on a spine, interpolated, complete months only."""
    lined = spine
    for table, value, name in series:
        one = table.select("month", F.col(f"`{value}`").alias(name))
        lined = align_to_spine(lined, one, [name])
    names = [name for _, _, name in series]
    return interpolate_linear(lined, names).na.drop("any")


def align_interpolate(spine: DataFrame, series: DataFrame, value: str) -> DataFrame:
    return interpolate_linear(align_to_spine(spine, series, [value]), [value])


def common_month_spine(mortgages: DataFrame) -> DataFrame:
    """Spine of the indicators: first to last date of the mortgage series."""
    return month_spine(mortgages)


def combined_temporal_features(mortgages: DataFrame, rates: DataFrame, debt: DataFrame) -> DataFrame:
    """Monthly indicators keyed by month number, from the three cleaned series."""
    debt_value = next(c for c in debt.columns if c != "month")
    monthly = assemble_series(
        common_month_spine(mortgages),
        [
            (mortgages, "emprunts_€", "New_mortgages"),
            (debt, debt_value, "Debt_ratio"),
            (rates, "taux", "Interest_rates"),
        ],
    )
    return cast_schema(monthly.withColumn("year_month_numeric", year_month_numeric("month")), TEMPORAL)


def expand_quarters(quarters: DataFrame, value: str = "IRL", key: list[str] | None = None) -> DataFrame:
    """Quarterly values to three months each, stepping a third of the way to the next quarter.

    The last quarter has no next one and yields nothing. A repeated quarter raises.
    """
    key = key or []
    expect_unique(quarters, [*key, "quarter"])
    order = Window.partitionBy(*(key or [F.lit(0)])).orderBy("quarter")
    stepped = quarters.withColumn("_next", F.lead(value).over(order))
    stepped = stepped.withColumn("_quarters", F.lead("quarter").over(order)).filter(F.col("_quarters").isNotNull())
    steps = stepped.withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(2))))
    change = (F.col("_next") - F.col(value)) / 3
    return steps.select(
        *key,
        F.add_months("quarter", F.col("_step")).alias("month"),
        (F.col(value) + change * F.col("_step")).alias(value),
    )
