"""Balanced joins: the rows of a plain join, and no task with more than its share."""

from collections import Counter

from pyspark.sql import functions as F

from terrier.operators import cleaning, fanout


def sides(spark, n=2000, m=300):
    left = spark.range(n).select(
        F.when(F.col("id") % 3 > 0, "HOT").when(F.col("id") % 17 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
        (F.col("id") % 7).alias("x"), F.lit(1).alias("_f"),
    )
    right = spark.range(m).select(
        F.when(F.col("id") % 2 == 0, "HOT").when(F.col("id") % 13 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 60)).alias("k"),
        F.col("id").alias("y"),
    )
    return left, right


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_the_rows_of_a_plain_join(spark):
    left, right = sides(spark)
    for cell in (64, 1000, 10**9):
        got = fanout.balanced_join(left, right, ["k"], cell)
        want = left.join(right, ["k"])
        assert got.columns == want.columns and rows(got) == rows(want)
    assert fanout.balanced_join(left.limit(0), right, ["k"]).count() == 0


def test_a_hot_name_is_many_tasks(spark):
    """10^4 equal rows by 10^3 of one name, without the runtime's help."""
    left = spark.range(10_000).select(F.lit("HOT").alias("k"), F.lit(1).alias("x"))
    right = spark.range(1_000).select(F.lit("HOT").alias("k"), F.col("id").alias("y"))
    kept = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        sizes = [r["count"] for r in fanout.balanced_join(left, right, ["k"]).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    assert sum(sizes) == 10**7 and max(sizes) <= 10**7 / 20


def test_city_names_keep_their_columns(spark, monkeypatch):
    monkeypatch.setattr(fanout.balanced_join, "__defaults__", (4,))
    table = spark.createDataFrame([(2014, "1", "Hot", 1.0)] * 5 + [(2014, "2", "b", 2.0)], "date int, departement string, ville string, v double")
    mapping = spark.createDataFrame([("HOT", "(1,1)"), ("HOT", "(2,9)"), ("B", "(2,2)")], "ville string, unique_city_id string")
    joined = cleaning.join_city_names(table, mapping)
    assert joined.columns == ["ville", "date", "departement", "v", "unique_city_id"] and joined.count() == 11
    assert cleaning.join_city_names(table, mapping, match_department=True).count() == 6
