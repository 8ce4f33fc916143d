"""Plans that must hold at scale."""

import re

from pyspark.sql import functions as F

from terrier.catalog.registry import Tables
from terrier.functions import year_month_numeric
from terrier.operators import cleaning, enrich, ranks, splits

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_temporal_split_neither_sorts_nor_shuffles(spark):
    orders = Tables(spark, FOLDER)["orders"]
    text = plan(splits.temporal_split(orders, "o_orderkey"))
    assert "Exchange" not in text and "Window" not in text and "Sort" not in text


def test_train_filter_reaches_the_scan(spark):
    orders = Tables(spark, FOLDER)["orders"].select("o_orderkey", "o_totalprice")
    text = plan(splits.filter_before_quantile(orders, "o_totalprice"))
    assert re.search(r"PushedFilters: \[.*LessThanOrEqual\(o_totalprice", text)


def test_cleaning_has_one_shuffle_and_filters_before_it(spark):
    t = Tables(spark, FOLDER)
    text = plan(cleaning.clean_transactions(t.raw))
    assert text.count("Exchange") == 1
    assert text.index("Exchange") < text.index("Filter")


def test_typed_raw_filters_push_down(spark, tmp_path):
    path = str(tmp_path / "raw")
    Tables(spark, FOLDER).raw.write.parquet(path)
    text = plan(cleaning.clean_transactions(spark.read.parquet(path)))
    for wanted in ("LessThanOrEqual(departement,95)", "GreaterThan(n_pieces,0)", "EqualTo(surface_terrains_agricoles,{})"):
        assert wanted in text
    assert "code_postal" not in text


def test_mapping_is_one_narrow_shuffle(spark):
    assert plan(Tables(spark, FOLDER).mapping).count("Exchange") == 1


def test_month_join_is_a_broadcast(spark):
    t = Tables(spark, FOLDER)
    sales = t["orders"].select(year_month_numeric("o_orderdate").alias("year_month_numeric"))
    months = spark.range(5).select(F.col("id").cast("int").alias("year_month_numeric"))
    text = plan(enrich.join_temporal(sales, months))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_city_join_is_decided_by_size(spark):
    """Small written lookups are broadcast; beyond the threshold the join shuffles."""
    t = Tables(spark, FOLDER)
    sales = t["orders"].select(F.col("o_custkey").cast("string").alias("unique_city_id"))
    assert "BroadcastHashJoin" in plan(enrich.join_tax_households(sales, t.tax))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        shuffled = enrich.join_tax_households(sales, t.tax)
        assert "SortMergeJoin" in plan(shuffled)
        rows = shuffled.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert enrich.join_tax_households(sales, t.tax).count() == rows


def test_month_table_beyond_its_bound_is_not_broadcast(spark):
    months = spark.range(5).select(F.col("id").cast("int").alias("year_month_numeric"))
    assert "ResolvedHint" in enrich.broadcast_within(months, 5)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in enrich.broadcast_within(months, 4)._jdf.queryExecution().analyzed().toString()


def test_counting_passes_return_bounded_rows(spark, monkeypatch):
    seen = []
    inner = ranks._histogram

    def counted(df, value, brackets):
        found = inner(df, value, brackets)
        seen.append(sum(len(b) for b in found))
        return found

    monkeypatch.setattr(ranks, "_histogram", counted)
    lines = Tables(spark, FOLDER)["lineitem"]
    ranks.exact_quantiles(lines, "l_extendedprice", [i / 50 for i in range(1, 50)])
    assert seen and max(seen) <= ranks.HISTOGRAM_ROWS
