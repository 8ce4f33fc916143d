"""Shared scratch space: the folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from terrier.sources.files import remove_folder


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    Read from the session. Only a local session without the setting (tests, laptop runs) gets a
    temporary folder of its own; on a cluster a missing setting is an error, because executors
    cannot see each other's local disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="terrier-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_home(spark: SparkSession) -> str:
    """The folder of this application's scratch tables; ``clear_scratch`` deletes it."""
    return f"{scratch_root(spark)}/terrier/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_home(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables, once nothing reads them any more."""
    remove_folder(spark, scratch_home(spark))


def settle(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a derived table once to the shared scratch folder and read it back.

    Used for lookup tables that an aggregate over the big data produces. The re-read table has its
    true size in the file statistics, so Catalyst's ``autoBroadcastJoinThreshold`` decides between a
    broadcast and a shuffle join on facts, the aggregate runs once instead of once per use, and the
    lineage is cut in storage that outlives any executor. Nothing reads the shuffles behind it again, so
    Spark removes their files at the end of the write and not at some later collection of garbage.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    with own_shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_REMOVE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def own_shuffles_removed(spark: SparkSession):
    """Queries that start in here give up their shuffle files when they end; the session's setting comes back after it."""
    before = spark.conf.get(_REMOVE, None)
    spark.conf.set(_REMOVE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVE)
        else:
            spark.conf.set(_REMOVE, before)
