"""Profiling tables."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from terrier.catalog.registry import query
from terrier.operators import cleaning, profiling
from terrier.schemas import TRANSACTIONS_RAW


@query(
    "value_frequencies",
    """select date, departement, ville, n_foyers_fiscaux, revenu_fiscal_moyen,
      count(*) / cast(sum(count(*)) over () as double) as proportion from tax_raw
    where date is not null and departement is not null and ville is not null and n_foyers_fiscaux is not null
      and revenu_fiscal_moyen is not null and not isnan(n_foyers_fiscaux) and not isnan(revenu_fiscal_moyen)
    group by date, departement, ville, n_foyers_fiscaux, revenu_fiscal_moyen""",
    "tax_raw",
)
def value_frequencies(t):
    columns = ["date", "departement", "ville", "n_foyers_fiscaux", "revenu_fiscal_moyen"]
    return profiling.value_frequencies(t.tax_raw.select(*columns))


_PROFILED = TRANSACTIONS_RAW.names


@query(
    "null_profile",
    " union all ".join(f"select '{c}' as column, count(*) - count({c}) as n_missing from raw" for c in _PROFILED),
    "raw",
)
def null_profile(t):
    return profiling.null_profile(t.raw.select(*_PROFILED))


_TYPES = {f.name: f.dataType.simpleString() for f in TRANSACTIONS_RAW}


@query(
    "table_profile",
    " union all ".join(
        f"select '{c}' as column, count({c}) as n_present, '{k}' as type from raw" for c, k in _TYPES.items()
    ),
    "raw",
)
def table_profile(t):
    return profiling.table_profile(t.raw.select(*_TYPES))


@query("quantile", "select 0.7::double as share, round(quantile_cont(l_extendedprice, 0.7), 6) as value from lineitem")
def quantile(t):
    found = profiling.quantile(t["lineitem"], "l_extendedprice", 0.7)
    return found.select("share", F.round("value", 6).alias("value"))


@query(
    "min_metric",
    """select min(rmse) as rmse from (select l_linenumber, sum(cast(l_quantity as bigint)) / cast(count(*) as double) as rmse
    from lineitem group by l_linenumber)""",
)
def min_metric(t):
    rounds = t["lineitem"].groupBy("l_linenumber").agg(
        (F.sum(F.col("l_quantity").cast("bigint")) / F.count("*").cast("double")).alias("rmse")
    )
    return profiling.min_metric(rounds, "rmse")


@query(
    "mean_by_department",
    """select departement, avg(prix) as mean, round(stddev_samp(prix), 3) as deviation, count(prix) as n
    from raw group by departement""",
    "raw",
)
def mean_by_department(t):
    table = profiling.mean_by_department(t.raw, "prix")
    return table.withColumn("deviation", F.round("deviation", 3))


_DAY = "cast(date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as double)"


@query(
    "histogram",
    f"""select cast(b as int) as bin, low + b * ((high - low) / 80) as low, low + (b + 1) * ((high - low) / 80) as high,
      coalesce(n, 0) as n
    from range(80) as bins(b)
      left join (select least(floor((v - low) / (high - low) * 80), 79) as bin, count(*) as n from (
        select {_DAY} as v, min({_DAY}) over () as low, max({_DAY}) over () as high from orders) group by 1) on b = bin
      cross join (select min({_DAY}) as low, max({_DAY}) as high from orders)""",
)
def histogram(t):
    day = F.unix_date(F.col("o_orderdate").cast("date")).cast("double")
    return profiling.histogram(t["orders"].select(day.alias("day")), "day", 80)


_BOX = """select '{c}' as column, min({c}) filter ({c} >= q1 - 1.5 * (q3 - q1)) as low, any_value(q1) as q1,
  any_value(q2) as median, any_value(q3) as q3, max({c}) filter ({c} <= q3 + 1.5 * (q3 - q1)) as high,
  count(*) filter ({c} < q1 - 1.5 * (q3 - q1) or {c} > q3 + 1.5 * (q3 - q1)) as outliers
from (select cast({c} as double) as {c} from lineitem) cross join (select quantile_cont(cast({c} as double), 0.25) as q1,
  quantile_cont(cast({c} as double), 0.5) as q2, quantile_cont(cast({c} as double), 0.75) as q3 from lineitem)"""
_BOXED = ["l_linenumber", "l_quantity", "l_extendedprice"]


@query("box_stats", " union all ".join(_BOX.format(c=c) for c in _BOXED))
def box_stats(t):
    return profiling.box_stats(t["lineitem"], _BOXED)


_SHARES = [i / 20 for i in range(1, 20)]


@query(
    "qq_points",
    " union all ".join(
        f"""select {p!r}::double as share, {NormalDist().inv_cdf(p)!r}::double as theoretical,
        round(quantile_cont(o_totalprice, {p!r}), 6) as sample from orders"""
        for p in _SHARES
    ),
)
def qq_points(t):
    points = profiling.qq_points(t["orders"], "o_totalprice", _SHARES)
    return points.withColumn("sample", F.round("sample", 6))


_PRICE_SQL = "case when prix = 0 then 1e-5 else prix / cast(surface_habitable as double) end"


@query(
    "price_series",
    f"""select year_month_numeric, type_batiment, round(avg(p), 6) as price_per_m2, interest_rate from (
      select type_batiment, cast(year(date_transaction) * 12 + month(date_transaction) as int) as year_month_numeric,
        {_PRICE_SQL} as p from cleaned where surface_habitable > 0)
      left join (select cast(year(month) * 12 + month(month) as int) as year_month_numeric, taux as interest_rate
        from rates) using (year_month_numeric)
    group by all""",
    "cleaned rates",
)
def price_series(t):
    sales = t.cleaned.filter(F.col("surface_habitable") > 0)
    table = profiling.price_series(sales, cleaning.clean_interest_rates(t.rates_raw))
    return table.withColumn("price_per_m2", F.round("price_per_m2", 6))


@query(
    "department_map_table",
    """select departement, count(distinct ville) as communes, count(*) as sales, avg(prix) as prix
    from cleaned group by departement""",
    "cleaned",
)
def department_map_table(t):
    return profiling.department_map_table(t.cleaned)
