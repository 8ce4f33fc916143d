"""Feature columns of single sales and the two enrichment joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.functions import log_target, month_cos, month_sin, unique_city_id, year_month_numeric
from terrier.schemas import MERGED, STATELESS, cast_schema

# Rows of a month table: one per calendar month of the years 1 to 9999, a few megabytes.
MAX_MONTHS = 12 * 9999


def broadcast_within(df: DataFrame, rows: int) -> DataFrame:
    """Mark a table for broadcast if it has at most ``rows`` rows, else leave the join to Catalyst.

    The check is a count that stops at the limit; pass a written table, so that it is not computed
    twice.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def stateless_features(cleaned: DataFrame) -> DataFrame:
    """Time, city and price features of each sale; the other columns pass through."""
    date = "date_transaction"
    return cast_schema(
        cleaned.select(
            year_month_numeric(date).alias("year_month_numeric"),
            month_sin(date).alias("month_sin"),
            month_cos(date).alias("month_cos"),
            F.col("departement").cast("string"),
            unique_city_id("departement", "id_ville").alias("unique_city_id"),
            log_target("prix", "surface_habitable").alias("log_price_per_m2"),
            F.col("surface_habitable").alias("living_area"),
            "type_batiment",
            "n_pieces",
            "surface_terrains_sols",
        ),
        STATELESS,
    )


def join_temporal(sales: DataFrame, temporal: DataFrame, on: str = "year_month_numeric") -> DataFrame:
    """Inner join with the monthly indicators.

    An indicator table has one row per month, whatever the number of sales. That bound is checked;
    within it the table is broadcast and the sales are not shuffled.
    """
    return sales.join(broadcast_within(temporal, MAX_MONTHS), on, "inner")


def join_tax_households(sales: DataFrame, tax: DataFrame, on: str = "unique_city_id") -> DataFrame:
    """Inner join with the tax means by city.

    The number of cities grows with the data, so nothing forces a broadcast: read ``tax`` from a
    written stage (or pass it through ``settle``) and Catalyst broadcasts it while its file size is
    under ``autoBroadcastJoinThreshold``. Beyond that the join shuffles on the city, where AQE splits
    the partitions of hot cities.
    """
    return sales.join(tax, on, "inner")


def merge_features(
    sales: DataFrame,
    temporal: DataFrame,
    tax: DataFrame,
    keys: tuple[str, str] = ("year_month_numeric", "unique_city_id"),
) -> DataFrame:
    """Sales with monthly indicators and tax means; unmatched sales drop out."""
    return join_tax_households(join_temporal(sales, temporal, keys[0]), tax, keys[1])


def rename_features(merged: DataFrame) -> DataFrame:
    """English names in the merged order."""
    # Name of each source column in the merged table.
    names = {
        "type_batiment": "building_type",
        "n_pieces": "n_rooms",
        "surface_terrains_sols": "outdoor_area",
        "New_mortgages": "new_mortgages",
        "Debt_ratio": "debt_ratio",
        "Interest_rates": "interest_rates",
        "n_foyers_fiscaux": "n_tax_households",
        "revenu_fiscal_moyen": "average_tax_income",
    }
    renamed = merged.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in merged.columns])
    return cast_schema(renamed, MERGED)


def split_target(df: DataFrame, target: str = "log_price_per_m2") -> tuple[DataFrame, DataFrame]:
    """Features and target of the same rows, for consumers that want them apart."""
    return df.drop(target), df.select(target)


def drop_join_keys(df: DataFrame, keys: tuple[str, ...] = ("date", "departement", "ville")) -> DataFrame:
    return df.drop(*keys)
