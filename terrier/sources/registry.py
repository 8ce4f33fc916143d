"""Saved models and the log of training and evaluation runs."""

from __future__ import annotations

import time

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.operators.boosting import BoostedTrees
from terrier.operators.factors import FactorModel
from terrier.sources.files import has_mark, list_names, path_exists, set_mark

RUNS = T.StructType(
    [
        T.StructField("ts", T.StringType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("context", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ]
)


def timestamp() -> str:
    return time.strftime("%Y%m%d-%H%M%S")


def model_path(root: str, model_type: str, ts: str) -> str:
    return f"{root}/models/{model_type}/{ts}"


def save_model(model: PipelineModel | BoostedTrees | FactorModel, root: str, model_type: str, ts: str | None = None) -> str:
    """Save under a timestamped name; any path scheme Spark can write works.

    The mark comes last, so a model whose saving was cut short is never taken as the latest.
    """
    path = model_path(root, model_type, ts or timestamp())
    spark = SparkSession.active()
    if isinstance(model, (BoostedTrees, FactorModel)):
        model.save(spark, path)
    else:
        model.write().overwrite().save(path)
    set_mark(spark, path)
    return path


def load_latest_model(spark: SparkSession, root: str, model_type: str) -> PipelineModel | BoostedTrees | FactorModel | None:
    """The saved model with the greatest name, or None when there is none."""
    names = list_names(spark, f"{root}/models/{model_type}")
    names = [n for n in names if has_mark(spark, model_path(root, model_type, n))]
    if not names:
        return None
    path = model_path(root, model_type, names[-1])
    for kind, part in ((BoostedTrees, "nodes"), (FactorModel, "factors")):
        if path_exists(spark, f"{path}/{part}"):
            return kind.load(spark, path)
    return PipelineModel.load(path)


def log_run(
    spark: SparkSession,
    root: str,
    model_type: str,
    context: str,
    row_count: int,
    params: dict,
    metrics: dict,
    ts: str | None = None,
) -> None:
    """Append one run to the run table."""
    row = (
        ts or timestamp(),
        model_type,
        context,
        int(row_count),
        {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items()},
    )
    spark.createDataFrame([row], RUNS).coalesce(1).write.mode("append").parquet(f"{root}/runs")


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(f"{root}/runs").orderBy(F.desc("ts"))
