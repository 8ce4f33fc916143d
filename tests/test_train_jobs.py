"""Training and all that follows it: the jobs of a run don't grow with its rounds."""

from pyspark.sql import functions as F

from terrier.operators import preprocessing as pre
from terrier.plans import pipeline


def merged(spark):
    n = F.col("id")
    return spark.range(400).select(
        (24200 + n % 60).cast("int").alias("year_month_numeric"), F.sin(n).alias("month_sin"), F.cos(n).alias("month_cos"),
        F.expr("cast(1 + id % 7 as string)").alias("departement"), F.expr("concat('(', 1 + id % 7, ',', id % 21, ')')").alias("unique_city_id"),
        (7 + n % 5 * 0.3 + F.expr("if(id % 2 = 0, 0.4, 0)")).alias("log_price_per_m2"), (20 + n % 5 * 10).cast("float").alias("living_area"),
        F.expr("if(id % 2 = 0, 'Maison', 'Appartement')").alias("building_type"), (1 + n % 4).cast("int").alias("n_rooms"),
        F.lit("No garden").alias("outdoor_area"), (n % 60 * 1e9).alias("new_mortgages"), (n % 3).cast("float").alias("debt_ratio"),
        (n % 9).cast("float").alias("interest_rates"), (n % 21 * 10.0).alias("n_tax_households"), (n % 21 * 100.0).alias("average_tax_income"),
    )


def test_jobs_do_not_grow_with_the_rounds(spark, tmp_path):
    layout, rows = pipeline.Layout(str(tmp_path)), merged(spark)
    fitted = pre.fit_preprocessor(rows)
    pre.save_preprocessor(spark, fitted, layout.preprocessor)
    for part in ("train", "test"):
        pre.apply_preprocessor(rows, fitted, keep=[pipeline.TARGET]).write.parquet(layout.preprocessed(part))

    def jobs(rounds):
        spark.sparkContext.setJobGroup(f"rounds-{rounds}", "")
        pipeline.run_train(spark, layout, "gbt", maxIter=rounds, maxDepth=4)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds-{rounds}"))

    jobs(1)  # makes the stage of fitted and validation rows
    assert jobs(6) <= jobs(2) + 2
    metrics = pipeline.run_evaluate(spark, layout).first()
    assert metrics["row_count"] == 400 and metrics["rmse"] ** 2 - metrics["loss"] < 1e-6
