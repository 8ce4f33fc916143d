"""Settled tables leave no shuffle files behind."""

import time

from pyspark.sql import functions as F

from terrier.sources.scratch import settle

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_no_shuffle_files_stay(spark):
    before, own = shuffle_files(spark), spark.conf.get(SETTING, None)
    counts = spark.range(100_000).groupBy((F.col("id") % 977).alias("x")).agg(F.count("*").alias("n"))
    found = settle(counts.join(counts.withColumnRenamed("n", "m"), "x"), "counted")
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert found.count() == 977 and found.agg(F.sum("m")).first()[0] == 100_000
    assert spark.conf.get(SETTING, None) == own
