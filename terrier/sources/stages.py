"""Stage cache and data-quality gates between the steps of the pipeline."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from terrier.schemas import expect_schema
from terrier.sources.files import fingerprint, first_line, is_complete, path_exists, write_text
from terrier.sources.tables import write_parquet


def read_stage(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def require_stage(spark: SparkSession, path: str, hint: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a finished stage or fail with the step that produces it."""
    if not is_complete(spark, path):
        raise FileNotFoundError(f"stage {path} is missing: {hint}")
    return read_stage(spark, path, schema)


_MANIFEST = "_MANIFEST"


def _manifest(spark: SparkSession, inputs: list[str], params: dict | None) -> str:
    return json.dumps({"inputs": {p: fingerprint(spark, p) for p in inputs}, "params": params or {}}, sort_keys=True)


def is_current(spark: SparkSession, path: str, inputs: list[str], params: dict | None = None) -> bool:
    """Whether what is at ``path`` was made from these inputs, as they are now, and these parameters."""
    noted = f"{path.rstrip('/')}/{_MANIFEST}"
    return path_exists(spark, noted) and first_line(spark, noted) == _manifest(spark, inputs, params)


def note_inputs(spark: SparkSession, path: str, inputs: list[str], params: dict | None = None) -> None:
    """Note what ``path`` was made from; the last step of making it, after its own mark."""
    write_text(spark, f"{path.rstrip('/')}/{_MANIFEST}", _manifest(spark, inputs, params))


def materialize(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    schema: T.StructType | None = None,
    require_rows: bool = False,
    partition_by: list[str] | None = None,
    inputs: list[str] | None = None,
    params: dict | None = None,
) -> DataFrame:
    """Reuse a finished stage, else compute, write and re-read it.

    With ``require_rows`` an existing but empty stage is computed again. ``partition_by`` lays the
    stage out so that a filter on those columns reads only its part. With ``inputs`` (paths), the stage is
    computed again when one of them, or ``params``, is not what it was made from; stages made from it
    follow, because their own input is then new.
    """
    if is_complete(spark, path) and (inputs is None or is_current(spark, path, inputs, params)):
        stage = read_stage(spark, path, schema)
        if not (require_rows and stage.isEmpty()):
            return stage
    built = build()
    if schema is not None:
        expect_schema(built, schema)
    write_parquet(built, path, partition_by=partition_by)
    if inputs is not None:
        note_inputs(spark, path, inputs, params)
    return read_stage(spark, path, schema or built.schema)


def row_count(df: DataFrame) -> int:
    return df.count()


def expect_row_count(df: DataFrame, low: int, high: int) -> DataFrame:
    """Return ``df`` when ``low < rows < high`` holds strictly, else raise."""
    rows = row_count(df)
    if not low < rows < high:
        raise ValueError(f"total rows {rows} is outside the expected range ({low} to {high})")
    return df
