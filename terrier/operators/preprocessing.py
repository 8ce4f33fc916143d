"""Scalers, indicators and labels: fitted once on the training rows, applied as literals and joins."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrier.functions import category_indicator, scale_minmax, scale_standard
from terrier.schemas import NUMERIC_COLUMNS, PREPROCESSED, cast_schema
from terrier.sources.files import clear_mark, set_mark
from terrier.sources.scratch import settle

MINMAX_COLUMNS = ["n_rooms", "new_mortgages", "debt_ratio", "interest_rates"]
STANDARD_COLUMNS = ["living_area", "n_tax_households", "average_tax_income"]
LABEL_COLUMNS = ["departement", "unique_city_id"]

#: Distinct values of a column that become indicators at most.
MAX_CATEGORIES = 1000

# Indicator column of each outdoor class, in output order.
OUTDOOR_INDICATORS = {
    "average_outdoor_space": "Average outdoor space",
    "large_outdoor_space": "Large outdoor space",
    "no_garden": "No garden",
    "small_outdoor_space": "Small outdoor space",
}


@dataclass(frozen=True)
class FittedPreprocessor:
    """Fitted state: ranges, moments, categories and label tables of the training rows."""

    minmax: dict[str, tuple[float | None, float | None]]
    moments: dict[str, tuple[float | None, float | None]]
    categories: dict[str, list[str]]
    labels: dict[str, DataFrame] = field(default_factory=dict)


def _finite_number(name: str) -> Column:
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def fit_minmax(df: DataFrame, columns: list[str]) -> dict[str, tuple[float | None, float | None]]:
    return _fit_numbers(df, columns, [])[0]


def fit_standard(df: DataFrame, columns: list[str]) -> dict[str, tuple[float | None, float | None]]:
    """Mean and population deviation."""
    return _fit_numbers(df, [], columns)[1]


def _fit_numbers(df: DataFrame, minmax: list[str], standard: list[str]) -> tuple[dict, dict]:
    """All ranges and moments in one aggregate pass."""
    wanted = []
    for c in minmax:
        wanted += [F.min(_finite_number(c)).alias(f"min:{c}"), F.max(_finite_number(c)).alias(f"max:{c}")]
    for c in standard:
        wanted += [F.avg(_finite_number(c)).alias(f"avg:{c}"), F.stddev_pop(_finite_number(c)).alias(f"std:{c}")]
    row = df.agg(*wanted).first()
    return (
        {c: (row[f"min:{c}"], row[f"max:{c}"]) for c in minmax},
        {c: (row[f"avg:{c}"], row[f"std:{c}"]) for c in standard},
    )


def minmax_scale(df: DataFrame, columns: list[str], fitted: dict | None = None) -> DataFrame:
    """Replace columns by their position in the fitted range."""
    fitted = fitted or fit_minmax(df, columns)
    return df.withColumns({c: scale_minmax(f"`{c}`", *fitted[c]) for c in columns})


def standard_scale(df: DataFrame, columns: list[str], fitted: dict | None = None) -> DataFrame:
    """Replace columns by their distance from the fitted mean in population deviations."""
    fitted = fitted or fit_standard(df, columns)
    return df.withColumns({c: scale_standard(f"`{c}`", *fitted[c]) for c in columns})


def fit_categories(df: DataFrame, columns: list[str], most: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted distinct non-NULL values of columns that become one indicator each, in one pass.

    Each value is a column of the result, so more than ``most`` of a column raise; no more rows than
    that reach the driver.
    """
    values = df.groupingSets([[F.col(c)] for c in columns], *columns).agg(F.grouping_id().alias("_set"))
    found: dict[str, list] = {c: [] for c in columns}
    # With more rows than this, some column has more than ``most`` values among them, NULL left out.
    for row in values.limit(len(columns) * (most + 2)).collect():
        for c in columns:
            if row[c] is not None:
                found[c].append(row[c])
    many = {c: len(values) for c, values in found.items() if len(values) > most}
    if many:
        raise ValueError(f"more than {most} categories: {many}")
    return {c: sorted(values) for c, values in found.items()}


def one_hot(df: DataFrame, column: str, categories: list[str], prefix: str | None = None) -> DataFrame:
    """Add an indicator per category; a column of exactly two keeps only the second.

    Values outside the fitted categories get zeros everywhere.
    """
    kept = categories[1:] if len(categories) == 2 else categories
    prefix = prefix or column
    return df.withColumns({f"{prefix}_{c}".lower().replace(" ", "_"): category_indicator(column, c) for c in kept})


def label_table(df: DataFrame, column: str) -> DataFrame:
    """Distinct labels numbered 0..n-1 in sorted order, as a written ``(label, code)`` table.

    The distinct labels are range-partitioned and written with their partition number, counted per
    partition, and numbered inside each partition from the running total of the earlier ones. No
    task sees more than one range of labels, so the table may grow past what one task can sort.
    """
    labels = df.select(F.col(f"`{column}`").cast("string").alias("label")).na.drop().distinct()
    placed = settle(
        labels.repartitionByRange("label").withColumn("range", F.spark_partition_id()), f"labels-{column}"
    )
    # One row per shuffle partition: bounded by the session's partition count.
    sizes = placed.groupBy("range").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy("label"))
    numbered = placed.join(F.broadcast(starts), "range").withColumn("code", (F.col("start") + inside - 1).cast("long"))
    return settle(numbered.select("label", "code"), f"codes-{column}")


def label_encode(df: DataFrame, column: str, labels: DataFrame, out: str | None = None) -> DataFrame:
    """Replace a label by its code; a label outside the table gets the reserved code ``n``.

    The table is read from written files, so Catalyst broadcasts it only while it is small.
    """
    # count(code) fetches one number; the codes are dense, so it is the reserved code.
    unseen = labels.count()
    coded = labels.select(F.col("label").alias("_label"), F.col("code").alias("_code"))
    joined = df.join(coded, F.col(f"`{column}`").cast("string") == F.col("_label"), "left")
    code = F.coalesce("_code", F.lit(unseen))
    return joined.withColumn(out or column, code).drop("_label", "_code")


def category_codes(df: DataFrame, column: str, categories: list[str], out: str | None = None) -> DataFrame:
    """Integer code of a low-cardinality category in sorted order; -1 when unknown or NULL."""
    position = F.array_position(F.array(*[F.lit(c) for c in categories]), F.col(column))
    return df.withColumn(out or column, F.coalesce(position - 1, F.lit(-1)).cast("int"))


def fit_preprocessor(train: DataFrame, with_labels: bool = True) -> FittedPreprocessor:
    """Fit scalers, categories and labels on all training rows."""
    minmax, moments = _fit_numbers(train, MINMAX_COLUMNS, STANDARD_COLUMNS)
    categories = fit_categories(train, ["building_type", "outdoor_area"])
    if len(categories["building_type"]) > 2:
        raise ValueError(f"building_type must be binary, found {categories['building_type']}")
    unknown = set(categories["outdoor_area"]) - set(OUTDOOR_INDICATORS.values())
    if unknown:
        raise ValueError(f"unexpected outdoor classes {sorted(unknown)}")
    labels = {c: label_table(train, c) for c in LABEL_COLUMNS} if with_labels else {}
    return FittedPreprocessor(minmax, moments, categories, labels)


def apply_preprocessor(df: DataFrame, fitted: FittedPreprocessor, keep: list[str] | None = None) -> DataFrame:
    """The 17 preprocessed columns from merged rows, plus the columns in ``keep``.

    Scales and categories are literals, so this is one projection without a join or shuffle.
    """
    keep = keep or []
    types = fitted.categories["building_type"]
    # With both types seen the column marks the second one; with a single type it marks that one.
    house = category_indicator("building_type", types[-1]) if types else F.lit(0)
    seen = fitted.categories["outdoor_area"]
    columns: dict[str, Column] = {c: scale_minmax(c, *fitted.minmax[c]) for c in MINMAX_COLUMNS}
    columns["building_type"] = house
    for name, category in OUTDOOR_INDICATORS.items():
        columns[name] = category_indicator("outdoor_area", category) if category in seen else F.lit(0)
    columns.update({c: scale_standard(c, *fitted.moments[c]) for c in STANDARD_COLUMNS})
    for name in ["year_month_numeric", "month_sin", "month_cos", "departement", "unique_city_id"]:
        columns[name] = F.col(name)
    projected = df.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in PREPROCESSED],
        *[F.col(f"`{c}`") for c in keep],
    )
    return projected if keep else cast_schema(projected, PREPROCESSED)


def encode_labels(df: DataFrame, fitted: FittedPreprocessor) -> DataFrame:
    """Department and city codes from the fitted tables."""
    for column in LABEL_COLUMNS:
        df = label_encode(df, column, fitted.labels[column])
    return df


def numeric_matrix(df: DataFrame, columns: list[str] = NUMERIC_COLUMNS, out: str = "features") -> DataFrame:
    """The numeric columns as one vector column."""
    wide = df.withColumns({c: F.col(c).cast("double") for c in columns})
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid="keep").transform(wide)


# -- persistence -------------------------------------------------------------------------------


def save_preprocessor(spark: SparkSession, fitted: FittedPreprocessor, path: str) -> None:
    """Fitted state as Parquet tables: one of numbers, one of categories, one per label column.

    A mark is written last; without it, the state counts as not there.
    """
    clear_mark(spark, path)
    numbers = [("minmax", c, *pair) for c, pair in fitted.minmax.items()]
    numbers += [("moments", c, *pair) for c, pair in fitted.moments.items()]
    categories = [(c, i, v) for c, values in fitted.categories.items() for i, v in enumerate(values)]
    tables = {
        "numbers": spark.createDataFrame(numbers, "kind string, name string, a double, b double").coalesce(1),
        "categories": spark.createDataFrame(categories, "name string, position int, value string").coalesce(1),
        **{f"labels/{c}": table for c, table in fitted.labels.items()},
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
    set_mark(spark, path)


def load_preprocessor(spark: SparkSession, path: str) -> FittedPreprocessor:
    numbers: dict[str, dict] = {"minmax": {}, "moments": {}}
    for row in spark.read.parquet(f"{path}/numbers").collect():
        numbers[row["kind"]][row["name"]] = (row["a"], row["b"])
    categories: dict[str, list[str]] = {"building_type": [], "outdoor_area": []}
    for row in spark.read.parquet(f"{path}/categories").orderBy("name", "position").collect():
        categories[row["name"]].append(row["value"])
    labels = {c: spark.read.parquet(f"{path}/labels/{c}") for c in LABEL_COLUMNS}
    return FittedPreprocessor(numbers["minmax"], numbers["moments"], categories, labels)
