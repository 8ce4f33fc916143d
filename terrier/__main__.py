"""Command line: ``python -m terrier <step> --root <folder>`` runs one pipeline step."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from terrier.plans import pipeline
from terrier.sources.scratch import clear_scratch

STEPS = ["extract", "clean", "preprocess", "train", "evaluate", "predict", "all"]


def main() -> None:
    parser = argparse.ArgumentParser(prog="terrier")
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--root", required=True)
    parser.add_argument("--model-type", default="gbt", choices=["gbt", "embedding"])
    parser.add_argument("--rows", help="LOW:HIGH, bounds that the cleaned row count has to lie between")
    parser.add_argument("--requests", help="Parquet table of requests to score (predict)")
    parser.add_argument("--out", help="folder for the scores as Parquet (predict)")
    args = parser.parse_args()
    spark = (
        SparkSession.builder.appName(f"terrier-{args.step}")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    step = getattr(pipeline, f"run_{args.step}")
    layout = pipeline.Layout(args.root.rstrip("/"))
    extra = {"model_type": args.model_type} if args.step in ("train", "evaluate", "predict", "all") else {}
    if args.rows and args.step in ("clean", "all"):
        extra["rows"] = tuple(int(x) for x in args.rows.split(":"))
    if args.requests and args.step == "predict":
        extra["requests"] = spark.read.parquet(args.requests)
    result = step(spark, layout, **extra)
    if args.out and args.step == "predict":
        result.write.mode("overwrite").parquet(args.out)
    elif args.step in ("evaluate", "predict", "all"):
        result.show(truncate=False)
    elif args.step == "train":
        print(f"validation rmse {result}")
    clear_scratch(spark)


if __name__ == "__main__":
    main()
