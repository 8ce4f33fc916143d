"""Scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrier import functions as fx
from terrier.catalog.registry import query
from terrier.operators import preprocessing

_NUMBER = "try_cast(regexp_replace(surface_terrains_sols, '[{}]', '', 'g') as double)"


@query(
    "parse_date",
    "select id_transaction, date_transaction as text, try_cast(date_transaction as date) as day from raw",
    "raw",
)
def parse_date(t):
    return t.raw.select(
        "id_transaction", F.col("date_transaction").alias("text"), fx.parse_date("date_transaction").alias("day")
    )


@query("parse_year", "select departement, ville, make_date(date, 1, 1) as day from tax_raw", "tax_raw")
def parse_year(t):
    return t.tax_raw.select("departement", "ville", fx.parse_year("date").alias("day"))


@query(
    "parse_quarter",
    """select o_orderkey, make_date(cast(year(o_orderdate) as int), cast(quarter(o_orderdate) * 3 - 2 as int), 1) as day
    from orders""",
)
def parse_quarter(t):
    date = F.col("o_orderdate")
    text = F.concat(F.year(date).cast("string"), F.lit("-Q"), F.quarter(date).cast("string"))
    return t["orders"].select("o_orderkey", fx.parse_quarter(text).alias("day"))


@query(
    "parse_number",
    """select event_id, try_cast(regexp_replace(props, '[^0-9]', '', 'g') as double) as k,
      case when event_id % 7 = 2 then null else value end as v from events""",
)
def parse_number(t):
    digits = F.regexp_replace("props", "[^0-9]", "")
    # Every seventh number gets a type suffix that must not parse.
    text = F.concat(F.col("value").cast("string"), F.expr("if(event_id % 7 = 2, 'd', '')"))
    return t["events"].select("event_id", fx.parse_number(digits).alias("k"), fx.parse_number(text).alias("v"))


@query(
    "strip_braces",
    "select id_transaction, regexp_replace(surface_terrains_sols, '[{}]', '', 'g') as bare from raw",
    "raw",
)
def strip_braces(t):
    return t.raw.select("id_transaction", fx.strip_braces("surface_terrains_sols").alias("bare"))


@query(
    "collapse_multi_plot",
    """select id_transaction, case when contains(surface_terrains_sols, ',') then '0'
      else regexp_replace(surface_terrains_sols, '[{}]', '', 'g') end as plot from raw""",
    "raw",
)
def collapse_multi_plot(t):
    return t.raw.select(
        "id_transaction", fx.collapse_multi_plot(fx.strip_braces("surface_terrains_sols")).alias("plot")
    )


@query(
    "fill_missing_zero",
    f"select id_transaction, coalesce({_NUMBER}, 0) as area, coalesce(prix, 0) as prix from raw",
    "raw",
)
def fill_missing_zero(t):
    area = fx.fill_missing_zero(fx.parse_number(fx.strip_braces("surface_terrains_sols")))
    return t.raw.select("id_transaction", area.alias("area"), fx.fill_missing_zero("prix").alias("prix"))


@query(
    "bin_outdoor_area",
    """select p_partkey, case when p_size * 25 - 50 <= -1 then null when p_size * 25 - 50 <= 0 then 'No garden'
      when p_size * 25 - 50 <= 200 then 'Small outdoor space'
      when p_size * 25 - 50 <= 1000 then 'Average outdoor space' else 'Large outdoor space' end as label from part""",
)
def bin_outdoor_area(t):
    return t["part"].select("p_partkey", fx.bin_outdoor_area(F.col("p_size") * 25 - 50).alias("label"))


@query("upper_name", "select p_partkey, upper(p_name) as name from part")
def upper_name(t):
    return t["part"].select("p_partkey", fx.upper_name("p_name").alias("name"))


@query("unique_city_id", "select id_transaction, concat('(', departement, ',', id_ville, ')') as city from raw", "raw")
def unique_city_id(t):
    return t.raw.select("id_transaction", fx.unique_city_id("departement", "id_ville").alias("city"))


@query("year_month_numeric", "select o_orderkey, cast(year(o_orderdate) * 12 + month(o_orderdate) as int) as m from orders")
def year_month_numeric(t):
    return t["orders"].select("o_orderkey", fx.year_month_numeric("o_orderdate").alias("m"))


@query(
    "month_cyclic",
    """select o_orderkey, round(sin(2 * pi() * month(o_orderdate) / 12), 9) + 0 as month_sin,
      round(cos(2 * pi() * month(o_orderdate) / 12), 9) + 0 as month_cos from orders""",
)
def month_cyclic(t):
    return t["orders"].select(
        "o_orderkey",
        (F.round(fx.month_sin("o_orderdate"), 9) + 0).alias("month_sin"),
        (F.round(fx.month_cos("o_orderdate"), 9) + 0).alias("month_cos"),
    )


_RATIO = """case when l_partkey % 61 = 2 and l_partkey % 83 = 4 then 1e-5
  when l_partkey % 83 = 4 then 1e-5 when l_partkey % 61 = 2 then 'Infinity'::double
  else l_extendedprice / l_quantity end"""


def _price_and_area(t):
    return t["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_shipdate",
        F.expr("if(l_partkey % 83 = 4, 0d, l_extendedprice)").alias("price"),
        F.expr("if(l_partkey % 61 = 2, 0d, l_quantity)").alias("area"),
    )


@query("price_per_m2", f"select l_orderkey, l_linenumber, l_shipdate, {_RATIO} as price_per_m2 from lineitem")
def price_per_m2(t):
    return _price_and_area(t).select(
        "l_orderkey", "l_linenumber", "l_shipdate", fx.price_per_m2("price", "area").alias("price_per_m2")
    )


@query("log_target", f"select l_orderkey, l_linenumber, l_shipdate, round(ln({_RATIO}), 9) as log_price from lineitem")
def log_target(t):
    return _price_and_area(t).select(
        "l_orderkey", "l_linenumber", "l_shipdate", F.round(fx.log_target("price", "area"), 9).alias("log_price")
    )


@query("exp_price", "select o_orderkey, round(exp(ln(o_totalprice) / 3), 7) as price from orders")
def exp_price(t):
    return t["orders"].select("o_orderkey", F.round(fx.exp_price(F.ln("o_totalprice") / 3), 7).alias("price"))


@query(
    "category_codes",
    """select l_orderkey, l_linenumber, l_shipdate, cast(case l_returnflag when 'A' then 0 when 'N' then 1 else -1 end as int) as code
    from lineitem""",
)
def category_codes(t):
    coded = preprocessing.category_codes(t["lineitem"], "l_returnflag", ["A", "N"], "code")
    return coded.select("l_orderkey", "l_linenumber", "l_shipdate", "code")
