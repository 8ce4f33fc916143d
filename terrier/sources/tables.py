"""Reading raw tables, turning CSV into Parquet, typed CSV, writers."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.schemas import ECONOMIC_RAW, TRANSACTIONS_RAW
from terrier.sources.files import first_line, list_names
from terrier.sources.records import read_records

# Entries of the raw folder that are not tables of their own.
SKIPPED_RAW_ENTRIES = [
    "transactions_sample.csv",
    "transactions.npz",
    "raw_dataset_chunks",
    "raw_dataset_full",
    "full_transactions_dataset",
    "processed_chunks",
]

_OVERFLOW = "_overflow"


def _read(spark: SparkSession, schema: T.StructType | None):
    return spark.read if schema is None else spark.read.schema(schema)


def load_tables(spark: SparkSession, folder: str, schemas: dict[str, T.StructType] | None = None) -> dict[str, DataFrame]:
    """Every ``<name>.parquet`` of a folder as ``{<name>_df: DataFrame}``, read lazily."""
    schemas = schemas or {}
    tables = {}
    for entry in list_names(spark, folder):
        if entry.endswith(".parquet"):
            name = entry.removesuffix(".parquet")
            tables[f"{name}_df"] = _read(spark, schemas.get(name)).parquet(f"{folder}/{entry}")
    return tables


def load_csv_tables(
    spark: SparkSession, folder: str, schemas: dict[str, T.StructType] | None = None, only: set[str] | None = None
) -> dict[str, DataFrame]:
    """Every ``<name>.csv`` of a folder (of those named, if any) as ``{<name>_df: DataFrame}``.

    Known tables are read with their schema, by column name, in a task for each file block; only unknown
    ones pay for inference, and are one task a file.
    """
    schemas = {**ECONOMIC_RAW, **(schemas or {})}
    tables = {}
    for entry in list_names(spark, folder):
        if entry.endswith(".csv") and entry not in SKIPPED_RAW_ENTRIES:
            name = entry.removesuffix(".csv")
            if only is not None and name not in only:
                continue
            tables[f"{name}_df"] = _read_csv_by_name(spark, f"{folder}/{entry}", schemas.get(name))
    return tables


def _read_csv_by_name(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    """Read a CSV whose header may hold more columns, in another order, than the schema."""
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True, escape='"', multiLine=True)
    # The header's names, as Spark's reader makes them unique; only the first record is read for them.
    names = spark.read.csv(path, header=True, escape='"', multiLine=True).columns
    if any(f.name not in names for f in schema):
        return spark.read.csv(path, header=True, inferSchema=True, escape='"', multiLine=True)
    text = read_records(spark, path, T.StructType([T.StructField(n, T.StringType()) for n in names]), header=True)
    return text.select(*[_typed(f) for f in schema])


def _typed(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.IntegralType):
        # A whole-number column with gaps is often written as 2014.0.
        value = F.coalesce(value.try_cast(field.dataType), value.try_cast("double").try_cast(field.dataType))
    return value.try_cast(field.dataType).alias(field.name)


def csv_to_parquet(
    spark: SparkSession, folder: str, schemas: dict[str, T.StructType] | None = None, only: set[str] | None = None
) -> dict[str, DataFrame]:
    """Write each raw CSV of a folder (of those named, if any) as a sibling Parquet table; return the Parquet tables."""
    converted = {}
    for key, df in load_csv_tables(spark, folder, schemas, only).items():
        path = f"{folder}/{key.removesuffix('_df')}.parquet"
        write_parquet(df, path)
        converted[key] = spark.read.schema(df.schema).parquet(path)
    return converted


def _csv_split(
    spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool, multi_line: bool
) -> DataFrame:
    """Typed rows and a last column that holds what a line has beyond its fields."""
    wide = T.StructType(schema.fields + [T.StructField(_OVERFLOW, T.StringType())])
    if multi_line:
        return read_records(spark, path, wide, header)
    return spark.read.csv(path, schema=wide, header=header, mode="PERMISSIVE", escape='"')


def read_csv_typed(
    spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool = True, multi_line: bool = False
) -> DataFrame:
    """Typed CSV read that skips lines with too many fields and pads short lines with NULL.

    Quotes inside quoted fields are doubled. ``multi_line`` lets quoted fields hold line breaks; files are
    then read at once, in a task for each block (``read_records``). One extra trailing column catches
    surplus fields; a row that fills it is a bad line, which ``skipped_lines`` returns.
    """
    return _good(_csv_split(spark, path, schema, header, multi_line))


def _good(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(_OVERFLOW).isNull()).drop(_OVERFLOW)


def _surplus(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(_OVERFLOW).isNotNull()).withColumnRenamed(_OVERFLOW, "surplus")


def skipped_lines(
    spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool = True, multi_line: bool = False
) -> DataFrame:
    """The lines that ``read_csv_typed`` leaves out, with what they hold beyond the fields as ``surplus``."""
    return _surplus(_csv_split(spark, path, schema, header, multi_line))


def read_batches(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table as a lazy DataFrame: scan partitions take the place of row batches."""
    return _read(spark, schema).parquet(path)


def _by_header(spark: SparkSession, folder: str, schema: T.StructType) -> list[tuple[list[str], T.StructType]]:
    """Chunk files grouped by their header line, each group with the schema in its column order."""
    groups: dict[str, list[str]] = {}
    for name in list_names(spark, folder):
        if name.startswith("transactions_chunk_") and name.endswith(".csv"):
            path = f"{folder}/{name}"
            # A chunk is a file, or a folder of part files; a file lists itself.
            inside = [n for n in list_names(spark, path) if n.endswith(".csv")]
            parts = [path] if inside == [name] else [f"{path}/{n}" for n in inside]
            for part in parts:
                groups.setdefault(first_line(spark, part), []).append(part)
    known = {f.name: f for f in schema}
    found = []
    for line, paths in groups.items():
        names = next(csv.reader([line.removeprefix("\ufeff")]), [])
        fields = [known.get(n) or T.StructField(n or f"_unnamed_{i}", T.StringType()) for i, n in enumerate(names)]
        found.append((paths, T.StructType(fields)))
    return found


def ingest_chunks(spark: SparkSession, folder: str, out: str, schema: T.StructType = TRANSACTIONS_RAW) -> DataFrame:
    """Combine ``transactions_chunk_*.csv`` of a folder into one Parquet dataset.

    Columns are taken by the names in each file's header, in whatever order; other columns are dropped
    and missing ones NULL. Quoted fields may hold quotes (doubled) and line breaks; each record is parsed once.
    Lines with surplus fields go to ``<out>_skipped`` as JSON text, to be counted and looked at.
    """
    good, bad = [], []
    for paths, own in _by_header(spark, folder, schema):
        rows = _csv_split(spark, paths, own, header=True, multi_line=True)
        there = set(own.names)
        columns = [F.col(f"`{f.name}`") if f.name in there else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        good.append(_good(rows).select(*columns))
        bad.append(_surplus(rows).select(F.to_json(F.struct("*")).alias("value")))
    if not good:
        raise FileNotFoundError(f"no transactions_chunk_*.csv in {folder}")
    write_parquet(union_batches(*good), out)
    union_batches(*bad).write.mode("overwrite").text(f"{out}_skipped")
    return spark.read.schema(schema).parquet(out)


def union_batches(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack separately produced tables by column name."""
    for other in others:
        first = first.unionByName(other)
    return first


def union_distinct(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack tables by column name and keep each row once."""
    return union_batches(first, *others).distinct()


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Snappy Parquet."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header in each part file and doubled quotes; ``mode='append'`` adds to earlier output."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
