"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.catalog.registry import query
from terrier.functions import year_month_numeric
from terrier.operators import cleaning, enrich, splits
from terrier.schemas import MERGED, cast_schema

_KEPT = """date_transaction, prix, departement, id_ville, ville, type_batiment, n_pieces, surface_habitable,
  surface_locaux_industriels, surface_terrains_agricoles, surface_terrains_sols"""


@query("prune_columns", f"select {_KEPT} from raw", "raw")
def prune_columns(t):
    return cleaning.prune_columns(t.raw)


@query("project", "select ville, departement, id_ville from raw", "raw")
def project(t):
    return t.raw.select("ville", "departement", "id_ville")


@query("drop_join_keys", "select n_foyers_fiscaux, revenu_fiscal_moyen from tax_raw", "tax_raw")
def drop_join_keys(t):
    return enrich.drop_join_keys(t.tax_raw)


_FRACTIONS = {"month_sin", "month_cos", "log_price_per_m2", "average_tax_income", "n_tax_households"}


def _rounded_name(field: T.StructField) -> str:
    return f"round({field.name}, 6) + 0 as {field.name}" if field.name in _FRACTIONS else field.name


def _rounded_column(field: T.StructField) -> Column:
    column = F.col(field.name)
    return (F.round(column, 6) + 0).alias(field.name) if field.name in _FRACTIONS else column


@query(
    "rename_features",
    f"select {', '.join(_rounded_name(f) for f in MERGED)} from merged",
    "merged",
)
def rename_features(t):
    """All columns of the merged table; computed fractions are rounded on both sides."""
    return t.merged.select(*[_rounded_column(f) for f in MERGED])


@query(
    "cast_schema",
    """select cast(s_suppkey as varchar) as s_suppkey, cast(s_nationkey as double) as s_nationkey,
      try_cast(replace(s_name, 'Supplier#', '') as int) as s_name from supplier""",
)
def cast_schema_query(t):
    named = t["supplier"].withColumn("s_name", F.replace("s_name", F.lit("Supplier#"), F.lit("")))
    return cast_schema(named, T.StructType.fromDDL("s_suppkey string, s_nationkey double, s_name int"))


@query("add_column", "select o_orderkey, o_totalprice * 1000000 as cents from orders")
def add_column(t):
    return t["orders"].withColumn("cents", F.col("o_totalprice") * 1_000_000).select("o_orderkey", "cents")


@query(
    "split_target",
    """select 'target' as side, count(*) as n, count(log_price_per_m2) as filled from stateless
    union all select 'features', count(*), count(living_area) from stateless""",
    "stateless",
)
def split_target(t):
    features, target = enrich.split_target(t.stateless)
    sides = {"target": (target, "log_price_per_m2"), "features": (features, "living_area")}
    one = [
        df.agg(F.count("*").alias("n"), F.count(c).alias("filled")).select(F.lit(side).alias("side"), "n", "filled")
        for side, (df, c) in sides.items()
    ]
    return one[0].unionByName(one[1])


@query(
    "filter_private_property",
    "select id_transaction from raw where surface_terrains_agricoles = '{}' and surface_locaux_industriels = '{}'",
    "raw",
)
def filter_private_property(t):
    return cleaning.filter_private_property(t.raw).select("id_transaction")


@query(
    "drop_missing",
    """select id_transaction, prix, surface_terrains_sols from raw
    where prix is not null and surface_terrains_sols is not null""",
    "raw",
)
def drop_missing(t):
    return cleaning.drop_missing(t.raw.select("id_transaction", "prix", "surface_terrains_sols"))


@query(
    "drop_missing_subset",
    "select date, departement, ville from tax_raw where n_foyers_fiscaux is not null and revenu_fiscal_moyen is not null",
    "tax_raw",
)
def drop_missing_subset(t):
    kept = cleaning.drop_missing_subset(t.tax_raw, ["n_foyers_fiscaux", "revenu_fiscal_moyen"])
    return kept.select("date", "departement", "ville")


@query("filter_mainland", "select id_transaction, departement from raw where departement <= 95", "raw")
def filter_mainland(t):
    return cleaning.filter_mainland(t.raw).select("id_transaction", "departement")


@query("filter_rooms", "select id_transaction, n_pieces from raw where n_pieces > 0", "raw")
def filter_rooms(t):
    return cleaning.filter_rooms(t.raw).select("id_transaction", "n_pieces")


@query(
    "filter_by_type",
    "select date_transaction, prix, ville from cleaned where type_batiment = 'Maison'",
    "cleaned",
)
def filter_by_type(t):
    return cleaning.filter_by_type(t.cleaned, "Maison").select("date_transaction", "prix", "ville")


@query(
    "filter_point",
    "select unique_city_id, log_price_per_m2 is null as no_price, n_pieces from stateless where year_month_numeric = 23960",
    "stateless",
)
def filter_point(t):
    found = cleaning.filter_point(t.stateless, "year_month_numeric", 23960)
    return found.select("unique_city_id", F.col("log_price_per_m2").isNull().alias("no_price"), "n_pieces")


@query(
    "filter_multi_plot",
    "select id_transaction, surface_terrains_sols from raw where contains(surface_terrains_sols, ',')",
    "raw",
)
def filter_multi_plot(t):
    return cleaning.filter_multi_plot(t.raw).select("id_transaction", "surface_terrains_sols")


@query(
    "filter_before_quantile",
    """select o_orderkey, o_totalprice from orders
    where o_totalprice <= (select quantile_cont(o_totalprice, 0.7) from orders)""",
)
def filter_before_quantile(t):
    return splits.filter_before_quantile(t["orders"], "o_totalprice", 0.7).select("o_orderkey", "o_totalprice")


@query(
    "sort_by_month",
    "select o_orderkey, o_custkey, cast(year(o_orderdate) * 12 + month(o_orderdate) as int) as year_month_numeric from orders",
)
def sort_by_month(t):
    months = t["orders"].withColumn("year_month_numeric", year_month_numeric("o_orderdate"))
    return splits.sort_by_month(months.select("o_orderkey", "o_custkey", "year_month_numeric"))


@query("head", "select o_orderkey, o_custkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def head(t):
    top = splits.head(t["orders"], 10, [F.desc("o_totalprice"), "o_orderkey"])
    return top.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "row_at",
    """select o_orderkey, o_custkey from (select *, row_number() over (order by o_orderkey) as r from orders)
    where r = 101""",
)
def row_at(t):
    return splits.row_at(t["orders"], 100, "o_orderkey").select("o_orderkey", "o_custkey")


@query("sample_one", "select o_orderkey, o_custkey from orders order by md5(concat('42|', o_orderkey)), o_orderkey limit 1")
def sample_one(t):
    return splits.sample_one(t["orders"], 42, ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query(
    "clean_transactions",
    """select date_transaction, prix, departement, id_ville, ville, type_batiment, n_pieces,
      cast(surface_habitable as double) as surface_habitable, surface_terrains_sols from cleaned""",
    "cleaned",
)
def clean_transactions(t):
    return t.cleaned.withColumn("surface_habitable", F.col("surface_habitable").cast("double"))


@query("dedupe_transactions", f"select distinct {_KEPT} from raw", "raw")
def dedupe_transactions(t):
    return cleaning.dedupe_transactions(cleaning.prune_columns(t.raw))


@query("city_mapping", "select ville, unique_city_id from mapping", "mapping")
def city_mapping(t):
    return t.mapping


@query(
    "stateless_features",
    """select year_month_numeric, round(month_sin, 9) + 0 as month_sin, round(month_cos, 9) + 0 as month_cos, departement,
      unique_city_id, round(log_price_per_m2, 9) as log_price_per_m2, cast(living_area as double) as living_area,
      type_batiment, n_pieces, surface_terrains_sols from stateless""",
    "stateless",
)
def stateless_features(t):
    return t.stateless.withColumns(
        {
            "month_sin": F.round("month_sin", 9) + 0,
            "month_cos": F.round("month_cos", 9) + 0,
            "log_price_per_m2": F.round("log_price_per_m2", 9),
            "living_area": F.col("living_area").cast("double"),
        }
    )
