"""Profiling tables behind the exploration plots."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.functions import price_per_m2, year_month_numeric
from terrier.operators.ranks import column_quantiles, exact_quantiles


def value_frequencies(df: DataFrame) -> DataFrame:
    """Share of each distinct row without NULLs; the total is summed from the grouped counts."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    counts = df.na.drop("any").groupBy(*columns).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.select(*columns, (F.col("n") / total).alias("proportion"))


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values by column: one aggregate row turned into one row per column."""
    return _per_column(df, missing=True)


def table_profile(df: DataFrame) -> DataFrame:
    """Column names, types and non-NULL counts."""
    counts = _per_column(df, missing=False)
    types = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    return counts.withColumn("type", F.element_at(types, F.col("column")))


def _per_column(df: DataFrame, missing: bool) -> DataFrame:
    fractional = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}

    def present(name: str):
        column = F.col(f"`{name}`")
        return (column.isNotNull() & ~F.isnan(column)) if name in fractional else column.isNotNull()

    row = df.agg(*[F.count_if(~present(c) if missing else present(c)).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n")) for c in df.columns])
    name = "n_missing" if missing else "n_present"
    return row.select(F.explode(pairs).alias("p")).select("p.column", F.col("p.n").alias(name))


def quantile(df: DataFrame, column: str, share: float) -> DataFrame:
    """Exact interpolated quantile as a one-row table."""
    value = exact_quantiles(df, column, [share])[share]
    return df.sparkSession.createDataFrame([(float(share), value)], "share double, value double")


def min_metric(metrics: DataFrame, column: str = "rmse") -> DataFrame:
    """Best value over training rounds."""
    return metrics.agg(F.min(column).alias(column))


def mean_by_department(df: DataFrame, column: str) -> DataFrame:
    """Mean, sample deviation and row count of a column by department."""
    return df.groupBy("departement").agg(
        F.avg(column).alias("mean"), F.stddev(column).alias("deviation"), F.count(column).alias("n")
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in equal-width bins from minimum to maximum, empty bins included.

    Bins are closed on the left; the last one also holds the maximum. Infinite values have no bin and
    are left out, as missing ones are.
    """
    value = F.col(column).cast("double")
    numbers = df.select(value.alias("v")).filter(_is_finite(F.col("v")))
    row = numbers.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
    spark = df.sparkSession
    if row["low"] is None:
        return spark.createDataFrame([], "bin int, low double, high double, n bigint")
    low, high = row["low"], row["high"]
    if low == high:
        low, high = low - 0.5, high + 0.5
    share = (F.col("v") - F.lit(low)) / F.lit(high - low)
    bin_of = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")
    counts = numbers.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"))
    step = (high - low) / bins
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    # Both sides have at most ``bins`` rows.
    return grid.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * step).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * step).alias("high"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def _is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(math.inf))


def box_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 quartile ranges) and outliers per column.

    Infinite values are left out, as missing ones are. The quartiles of all columns are searched together, and
    their whiskers take one scan.
    """
    numbers = [F.col(f"`{c}`").cast("double") for c in columns]
    values = [F.when(_is_finite(v), v) for v in numbers]
    found = column_quantiles(df, values, [0.25, 0.5, 0.75])
    quartiles, wanted = {}, []
    for i, (column, value) in enumerate(zip(columns, values, strict=True)):
        quartiles[column] = q1, _, q3 = tuple(found[i].values())
        if q1 is not None:
            reach = 1.5 * (q3 - q1)
            inside = value.between(F.lit(q1 - reach), F.lit(q3 + reach))
            wanted += [
                F.min(F.when(inside, value)).alias(f"low{i}"),
                F.max(F.when(inside, value)).alias(f"high{i}"),
                F.count_if(~inside).alias(f"outside{i}"),
            ]
    ends = df.agg(*wanted).first().asDict() if wanted else {}
    rows = [
        (c, ends.get(f"low{i}"), *quartiles[c], ends.get(f"high{i}"), ends.get(f"outside{i}", 0))
        for i, c in enumerate(columns)
    ]
    schema = "column string, low double, q1 double, median double, q3 double, high double, outliers bigint"
    return df.sparkSession.createDataFrame(rows, schema)


def qq_points(df: DataFrame, column: str, shares: list[float]) -> DataFrame:
    """Sample quantiles against standard normal quantiles on a fixed grid of probabilities."""
    sample = exact_quantiles(df, column, shares)
    rows = [(float(p), NormalDist().inv_cdf(p), sample[p]) for p in shares]
    return df.sparkSession.createDataFrame(rows, "share double, theoretical double, sample double")


def price_series(cleaned: DataFrame, rates: DataFrame) -> DataFrame:
    """Mean price per square metre by building type and month with the interest rate alongside.

    Sales are averaged before the join, so both sides have at most one row per month (and type).
    """
    month = year_month_numeric("date_transaction")
    prices = cleaned.groupBy("type_batiment", month.alias("year_month_numeric")).agg(
        F.avg(price_per_m2("prix", "surface_habitable")).alias("price_per_m2")
    )
    monthly = rates.select(year_month_numeric("month").alias("year_month_numeric"), F.col("taux").alias("interest_rate"))
    return prices.join(monthly, "year_month_numeric", "left")


def department_map_table(cleaned: DataFrame) -> DataFrame:
    """Mean price, sales and number of communes by department."""
    by_city = cleaned.groupBy("departement", "ville").agg(
        F.sum("prix").alias("total"), F.count("*").alias("sales")
    )
    return by_city.groupBy("departement").agg(
        F.count("*").alias("communes"),
        F.sum("sales").alias("sales"),
        (F.sum("total") / F.sum("sales")).alias("prix"),
    )
