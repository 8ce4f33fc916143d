"""Enrichment joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrier.catalog.registry import query
from terrier.functions import unique_city_id
from terrier.operators import cleaning, enrich


@query(
    "join_temporal",
    """select unique_city_id, year_month_numeric, n_pieces, round("New_mortgages", 3) as new_mortgages,
      round(cast("Interest_rates" as double), 4) as interest_rates from stateless join temporal using (year_month_numeric)""",
    "stateless temporal",
)
def join_temporal(t):
    return enrich.join_temporal(t.stateless, t.temporal).select(
        "unique_city_id", "year_month_numeric", "n_pieces",
        F.round("New_mortgages", 3).alias("new_mortgages"),
        F.round(F.col("Interest_rates").cast("double"), 4).alias("interest_rates"),
    )


@query(
    "join_tax_households",
    """select unique_city_id, year_month_numeric, n_pieces, n_foyers_fiscaux, revenu_fiscal_moyen
    from stateless join tax using (unique_city_id)""",
    "stateless tax",
)
def join_tax_households(t):
    return enrich.join_tax_households(t.stateless, t.tax).select(
        "unique_city_id", "year_month_numeric", "n_pieces", "n_foyers_fiscaux", "revenu_fiscal_moyen"
    )


@query(
    "merge_features",
    """select year_month_numeric, departement, unique_city_id, round(log_price_per_m2, 9) as log_price_per_m2,
      cast(living_area as double) as living_area, building_type, n_rooms, outdoor_area,
      round(new_mortgages, 3) as new_mortgages, round(cast(debt_ratio as double), 4) as debt_ratio,
      round(cast(interest_rates as double), 4) as interest_rates, n_tax_households, average_tax_income from merged""",
    "merged",
)
def merge_features(t):
    return t.merged.select(
        "year_month_numeric", "departement", "unique_city_id",
        F.round("log_price_per_m2", 9).alias("log_price_per_m2"),
        F.col("living_area").cast("double").alias("living_area"),
        "building_type", "n_rooms", "outdoor_area",
        F.round("new_mortgages", 3).alias("new_mortgages"),
        F.round(F.col("debt_ratio").cast("double"), 4).alias("debt_ratio"),
        F.round(F.col("interest_rates").cast("double"), 4).alias("interest_rates"),
        "n_tax_households", "average_tax_income",
    )


@query(
    "join_city_names",
    """select upper(ville) as ville, unique_city_id, date, n_foyers_fiscaux, revenu_fiscal_moyen
    from tax_raw join (select ville as v, unique_city_id from mapping) on upper(ville) = v""",
    "tax_raw mapping",
)
def join_city_names(t):
    joined = cleaning.join_city_names(t.tax_raw, t.mapping)
    return joined.select("ville", "unique_city_id", "date", "n_foyers_fiscaux", "revenu_fiscal_moyen")


@query("clean_tax_households", "select unique_city_id, n_foyers_fiscaux, revenu_fiscal_moyen from tax", "tax")
def clean_tax_households(t):
    return cleaning.clean_tax_households(t.tax_raw, t.mapping)


@query(
    "agg_tax_by_city",
    """select concat('(', departement, ',', ville, ')') as unique_city_id, avg(n_foyers_fiscaux) as n_foyers_fiscaux,
      avg(revenu_fiscal_moyen) as revenu_fiscal_moyen from tax_raw group by 1""",
    "tax_raw",
)
def agg_tax_by_city(t):
    return cleaning.agg_tax_by_city(t.tax_raw.withColumn("unique_city_id", unique_city_id("departement", "ville")))


@query(
    "agg_tax_by_year_city",
    """select make_date(date, 1, 1) as date, unique_city_id, avg(n_foyers_fiscaux) as n_foyers_fiscaux,
      avg(revenu_fiscal_moyen) as revenu_fiscal_moyen
    from (select date, upper(ville) as ville, n_foyers_fiscaux, revenu_fiscal_moyen from tax_raw)
      join mapping using (ville) group by all""",
    "tax_raw mapping",
)
def agg_tax_by_year_city(t):
    return cleaning.agg_tax_by_year_city(t.tax_raw, t.mapping)


@query(
    "tax_features_by_year",
    """select n_foyers_fiscaux, revenu_fiscal_moyen, unique_city_id, cast(date * 12 + 1 as int) as year_month_numeric
    from (select date, upper(ville) as ville, n_foyers_fiscaux, revenu_fiscal_moyen from tax_raw) join mapping using (ville)""",
    "tax_raw mapping",
)
def tax_features_by_year(t):
    return cleaning.tax_features_by_year(t.tax_raw, t.mapping)


@query(
    "rents_features",
    """select loyer_m2, loyer_median, unique_city_id, cast(date * 12 + 1 as int) as year_month_numeric
    from (select date, upper(ville) as ville, loyer_m2, loyer_median from rents_raw) join mapping using (ville)""",
    "rents_raw mapping",
)
def rents_features(t):
    return cleaning.rents_features(t.rents_raw, t.mapping)


def _rent_columns(year: int) -> str:
    month = year * 12 + 1
    return ", ".join(
        f'avg({c}) filter (date = {year}) as "{month}_{c}"' for c in ("loyer_m2", "loyer_median")
    )


@query(
    "pivot_rents",
    f"""select unique_city_id, {", ".join(_rent_columns(y) for y in range(2018, 2022))}
    from (select date, upper(ville) as ville, loyer_m2, loyer_median from rents_raw)
      join mapping using (ville) group by unique_city_id""",
    "rents_raw mapping",
)
def pivot_rents(t):
    rents = cleaning.rents_by_month(t.rents_raw, t.mapping)
    return cleaning.pivot_rents(rents)
