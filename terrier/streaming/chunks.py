"""Chunk files picked up as they arrive: each is read once and appended to the raw dataset."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.schemas import TRANSACTIONS_RAW


def append_new_chunks(
    spark: SparkSession, folder: str, out: str, checkpoint: str, schema: T.StructType = TRANSACTIONS_RAW
) -> None:
    """Append every ``transactions_chunk_*.csv`` not seen before, then stop.

    The file source records finished files under ``checkpoint``, which with the Parquet sink's commit
    log gives each chunk exactly once, also after a restart. Lines with surplus fields are skipped as
    in ``read_csv_typed``.
    """
    wide = T.StructType(schema.fields + [T.StructField("_overflow", T.StringType())])
    rows = (
        spark.readStream.schema(wide)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .option("multiLine", True)
        .option("pathGlobFilter", "transactions_chunk_*.csv")
        .csv(folder)
    )
    query = (
        rows.filter(F.col("_overflow").isNull())
        .drop("_overflow")
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
