"""Monthly and quarterly series."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrier.catalog.registry import query
from terrier.operators import cleaning, series


@query("upsample_monthly", "select month, round(taux_endettement, 6) as taux_endettement from debt", "debt")
def upsample_monthly(t):
    monthly = cleaning.clean_debt_ratio(t.debt_raw)
    return monthly.select("month", F.round("taux_endettement", 6).alias("taux_endettement"))


def _spine_and_rates(t):
    spine = series.common_month_spine(cleaning.clean_new_mortgages(t.mortgages_raw))
    return spine, cleaning.clean_interest_rates(t.rates_raw)


@query("common_month_spine", "select month from spine", "spine")
def common_month_spine(t):
    return _spine_and_rates(t)[0]


@query("align_to_spine", "select month, taux from rates_on_spine", "rates_on_spine")
def align_to_spine(t):
    return series.align_to_spine(*_spine_and_rates(t), ["taux"])


@query("interpolate_linear", "select month, round(taux, 6) as taux from rates_filled", "rates_filled")
def interpolate_linear(t):
    spine, rates = _spine_and_rates(t)
    return series.align_interpolate(spine, rates, "taux").select("month", F.round("taux", 6).alias("taux"))


@query(
    "assemble_series",
    """select month, round(emprunts, 3) as emprunts, round(taux, 6) as taux
    from mortgages_filled join rates_filled using (month) where emprunts is not null and taux is not null""",
    "mortgages_filled rates_filled",
)
def assemble_series(t):
    mortgages = cleaning.clean_new_mortgages(t.mortgages_raw)
    spine, rates = _spine_and_rates(t)
    lined = series.assemble_series(spine, [(mortgages, "emprunts_€", "emprunts"), (rates, "taux", "taux")])
    return lined.select("month", F.round("emprunts", 3).alias("emprunts"), F.round("taux", 6).alias("taux"))


@query(
    "combined_temporal_features",
    """select round("New_mortgages", 3) as "New_mortgages", round(cast("Debt_ratio" as double), 4) as "Debt_ratio",
      round(cast("Interest_rates" as double), 4) as "Interest_rates", year_month_numeric from temporal""",
    "temporal",
)
def combined_temporal_features(t):
    return t.temporal.select(
        F.round("New_mortgages", 3).alias("New_mortgages"),
        F.round(F.col("Debt_ratio").cast("double"), 4).alias("Debt_ratio"),
        F.round(F.col("Interest_rates").cast("double"), 4).alias("Interest_rates"),
        "year_month_numeric",
    )


@query("sort_series", "select month, taux from rates", "rates")
def sort_series(t):
    return cleaning.clean_interest_rates(t.rates_raw)


@query("scale_mortgages", 'select month, "emprunts_€" as euros from mortgages', "mortgages")
def scale_mortgages(t):
    return cleaning.clean_new_mortgages(t.mortgages_raw).withColumnRenamed("emprunts_€", "euros")


_QUARTERS = """select cast(month as date) as month, round(v, 6) as "IRL" from (
  select q + to_months(cast(step as int)) as month, "IRL" + (next - "IRL") / 3 * step as v
  from (select q, "IRL", lead("IRL") over (order by q) as next, lead(q) over (order by q) as next_q
    from (select make_date(cast(left(quarter, 4) as int), cast(right(quarter, 1) as int) * 3 - 2, 1) as q, "IRL"
      from quarters_raw))
    cross join range(3) as steps(step) where next_q is not null)"""


def _months_of_quarters(t):
    from terrier.functions import parse_quarter

    quarters = t.quarters_raw.select(parse_quarter("quarter").alias("quarter"), "IRL")
    return series.expand_quarters(quarters).select("month", F.round("IRL", 6).alias("IRL"))


@query("expand_quarters", _QUARTERS, "quarters_raw")
def expand_quarters(t):
    return _months_of_quarters(t)


@query("union_months", f"select month, count(*) as n from ({_QUARTERS}) group by month", "quarters_raw")
def union_months(t):
    """The three months of each quarter stacked: every month appears once."""
    return _months_of_quarters(t).groupBy("month").agg(F.count("*").alias("n"))


@query(
    "clean_secondary",
    """select 'foyers_fiscaux_df' as name, count(*) as n from tax union all
    select 'taux_interet_df', count(*) from rates union all
    select 'flux_nouveaux_emprunts_df', count(*) from mortgages union all
    select 'taux_endettement_df', count(*) from debt""",
    "tax rates mortgages debt",
)
def clean_secondary(t):
    raw = {
        "foyers_fiscaux_df": t.tax_raw,
        "taux_interet_df": t.rates_raw,
        "flux_nouveaux_emprunts_df": t.mortgages_raw,
        "taux_endettement_df": t.debt_raw,
    }
    counts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in cleaning.clean_secondary(raw, t.mapping).items()
    ]
    first, *rest = counts
    for other in rest:
        first = first.unionByName(other)
    return first
