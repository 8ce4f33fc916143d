"""Cleaning of raw sales and of the economic tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.functions import (
    bin_outdoor_area,
    collapse_multi_plot,
    fill_missing_zero,
    is_finite,
    parse_date,
    parse_integer,
    parse_number,
    parse_year,
    strip_braces,
    sum_multi_plot,
    unique_city_id,
    upper_name,
)
from terrier.operators.fanout import balanced_join
from terrier.operators.ranks import sort_spread
from terrier.operators.series import align_to_spine, interpolate_linear, month_spine
from terrier.schemas import CITY_MAPPING, CLEANED, TAX_BY_CITY, UNUSED_RAW_COLUMNS, cast_schema

_LAND_USE = ["surface_terrains_agricoles", "surface_locaux_industriels"]


def prune_columns(df: DataFrame, columns: list[str] = UNUSED_RAW_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def filter_private_property(df: DataFrame) -> DataFrame:
    """Keep sales whose two land-use lists are both present and empty."""
    return df.filter((F.col(_LAND_USE[0]) == "{}") & (F.col(_LAND_USE[1]) == "{}"))


def filter_mainland(df: DataFrame, last: int = 95) -> DataFrame:
    return df.filter(F.col("departement") <= last)


def filter_rooms(df: DataFrame) -> DataFrame:
    return df.filter(F.col("n_pieces") > 0)


def filter_by_type(df: DataFrame, building_type: str, by: str = "date_transaction") -> DataFrame:
    """Sales of one building type in time order."""
    return sort_spread(df.filter(F.col("type_batiment") == building_type), by)


def filter_point(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def filter_multi_plot(df: DataFrame, column: str = "surface_terrains_sols") -> DataFrame:
    """Sales whose land list names several plots."""
    return df.filter(F.col(column).contains(","))


def drop_missing(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with NULL or NaN in any of the columns."""
    return df.na.drop("any", subset=subset)


def drop_missing_subset(df: DataFrame, subset: list[str]) -> DataFrame:
    return drop_missing(df, subset)


def drop_non_finite(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_finite(column))


def dedupe_transactions(df: DataFrame) -> DataFrame:
    """Keep one of each set of rows that agree in every column.

    A grouping on all columns with map-side combine, so copies collapse before the shuffle.
    """
    return df.dropDuplicates()


def land_area(text: Column | str, sum_plots: bool = False) -> Column:
    """Land list text to area: braces off, several plots count as none, unreadable is 0."""
    bare = strip_braces(text)
    return fill_missing_zero(parse_number(sum_multi_plot(bare) if sum_plots else collapse_multi_plot(bare)))


def clean_transactions(raw: DataFrame, sum_plots: bool = False, dedupe: bool = True) -> DataFrame:
    """Raw sales to the cleaned schema, in one lazy plan with one shuffle.

    ``dedupe=False`` leaves copies in and needs no shuffle, for consumers that take distinct values
    anyway.

    Every filter reads only columns that take part in the row comparison, so it commutes with the
    de-duplication and is written before it: rows that will be dropped never reach the shuffle. The
    two land-use texts are constant after their filter and leave the comparison too.
    """
    types = {f.name: f.dataType for f in raw.schema}

    def number(name: str) -> Column:
        # Typed columns stay bare, so their filters reach the Parquet scan.
        return (parse_number(name) if isinstance(types[name], T.StringType) else F.col(name)).alias(name)

    date = F.col("date_transaction")
    parsed = parse_date(date) if isinstance(types["date_transaction"], T.StringType) else date
    numbers = ["prix", "departement", "id_ville", "n_pieces", "surface_habitable"]
    compared = prune_columns(filter_private_property(raw)).select(
        date, *[number(n) for n in numbers], "ville", "type_batiment", "surface_terrains_sols"
    )
    # NULL land text is a valid "no garden", so it is not among the checked columns.
    kept = drop_missing(filter_rooms(filter_mainland(compared)), [*numbers, "ville", "type_batiment"])
    # A room count, city or department number that does not fit an int, or truncates to no room, is missing too.
    kept = kept.filter(
        parsed.isNotNull()
        & (F.col("n_pieces").try_cast("int") > 0)
        & F.col("id_ville").try_cast("int").isNotNull()
        & F.col("departement").try_cast("int").isNotNull()
    )
    unique = dedupe_transactions(kept) if dedupe else kept
    # A column of its own: the bins mention the parsed area several times.
    unique = unique.withColumn("_land", land_area("surface_terrains_sols", sum_plots))
    return cast_schema(
        unique.select(
            parsed.cast("date").alias("date_transaction"),
            "prix",
            F.col("departement").cast("int"),
            F.col("id_ville").cast("int"),
            "ville",
            "type_batiment",
            F.col("n_pieces").cast("int"),
            F.col("surface_habitable").cast("float"),
            bin_outdoor_area("_land").alias("surface_terrains_sols"),
        ),
        CLEANED,
    )


def city_mapping(cleaned: DataFrame) -> DataFrame:
    """Distinct pairs of commune name and city key."""
    pairs = cleaned.select("ville", unique_city_id("departement", "id_ville").alias("unique_city_id"))
    return cast_schema(pairs.distinct(), CITY_MAPPING)


# -- tax households ----------------------------------------------------------------------------


def join_city_names(table: DataFrame, mapping: DataFrame, match_department: bool = False) -> DataFrame:
    """Give each row of an economic table the city keys of its commune name.

    The name alone decides, so homonymous communes of several departments each get all rows of the
    name. ``match_department`` also compares the department. A name with many rows on both sides is dealt
    into cells of bounded output.
    """
    named = table.withColumn("ville", upper_name("ville"))
    joined = balanced_join(named, mapping, ["ville"])
    if match_department:
        own = F.regexp_extract("unique_city_id", r"^\(([^,]+),", 1)
        joined = joined.filter(parse_integer("departement") == parse_integer(own))
    return joined


def agg_tax_by_city(joined: DataFrame) -> DataFrame:
    """Mean household count and mean income of each city over all years."""
    return cast_schema(
        joined.groupBy("unique_city_id").agg(
            F.avg("n_foyers_fiscaux").alias("n_foyers_fiscaux"),
            F.avg("revenu_fiscal_moyen").alias("revenu_fiscal_moyen"),
        ),
        TAX_BY_CITY,
    )


def _means_by_city(
    table: DataFrame, mapping: DataFrame, measures: list[str], keys: dict[str, Column], match_department: bool = False
) -> DataFrame:
    """Means by city and ``keys``: the same numbers as joining on the name and then averaging.

    Sums and counts are taken by commune name (and department, when matched) before the join. A name
    then meets the mapping as one row, so the join output is the size of the mapping however many
    rows a name has, and no group of homonyms is multiplied out.
    """
    names = ["ville", "_dep"] if match_department else ["ville"]
    named = table.select(
        upper_name("ville").alias("ville"),
        *([parse_integer("departement").alias("_dep")] if match_department else []),
        *[key.alias(name) for name, key in keys.items()],
        *[F.col(f"`{m}`").cast("double").alias(m) for m in measures],
    )
    parts = [F.sum(f"`{m}`").alias(f"_sum_{m}") for m in measures]
    parts += [F.count(f"`{m}`").alias(f"_n_{m}") for m in measures]
    by_name = named.groupBy(*names, *keys).agg(*parts)
    cities = mapping
    if match_department:
        own = F.regexp_extract("unique_city_id", r"^\(([^,]+),", 1)
        cities = mapping.withColumn("_dep", parse_integer(own))
    means = [F.try_divide(F.sum(f"`_sum_{m}`"), F.sum(f"`_n_{m}`")).alias(m) for m in measures]
    return by_name.join(cities, names, "inner").groupBy("unique_city_id", *keys).agg(*means)


_TAX_MEASURES = ["n_foyers_fiscaux", "revenu_fiscal_moyen"]


def clean_tax_households(table: DataFrame, mapping: DataFrame, match_department: bool = False) -> DataFrame:
    """Mean household count and income of each city over all years."""
    return cast_schema(_means_by_city(table, mapping, _TAX_MEASURES, {}, match_department), TAX_BY_CITY)


def agg_tax_by_year_city(table: DataFrame, mapping: DataFrame) -> DataFrame:
    """Mean of the tax columns by year start and city."""
    return _means_by_city(table, mapping, _TAX_MEASURES, {"date": parse_year("date")})


def tax_features_by_year(table: DataFrame, mapping: DataFrame) -> DataFrame:
    """Tax rows by city and January month number of their year."""
    return _yearly_by_city(table, mapping, ["departement"])


def rents_features(table: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rent rows by city and January month number of their year."""
    return _yearly_by_city(table, mapping, ["departement", "id_ville"])


def _yearly_by_city(table: DataFrame, mapping: DataFrame, drop: list[str]) -> DataFrame:
    joined = join_city_names(table, mapping).drop(*drop, "ville")
    return joined.withColumn("year_month_numeric", (parse_integer("date") * 12 + 1).cast("int")).drop("date")


def rents_by_month(table: DataFrame, mapping: DataFrame) -> DataFrame:
    """Mean rents by city and month number, averaged by name before the join."""
    measures = [c for c in table.columns if c not in ("date", "departement", "id_ville", "ville")]
    month = (parse_integer("date") * 12 + 1).cast("int")
    return _means_by_city(table, mapping, measures, {"year_month_numeric": month})


def pivot_rents(rents: DataFrame, months: list[int] | None = None) -> DataFrame:
    """Mean rents by city with one column per month; without ``months`` Spark looks them up."""
    measures = [c for c in rents.columns if c not in ("unique_city_id", "year_month_numeric")]
    pivoted = rents.groupBy("unique_city_id").pivot("year_month_numeric", months)
    return pivoted.agg(*[F.avg(m).alias(m) for m in measures])


# -- series ------------------------------------------------------------------------------------


def clean_debt_ratio(table: DataFrame) -> DataFrame:
    """Yearly values at 1 January on a monthly grid, linear in between."""
    value = next(c for c in table.columns if c != "date")
    yearly = table.select(
        parse_year("date").alias("month"), F.col(f"`{value}`").cast("double").alias(value)
    )
    return upsample_monthly(yearly, value)


def upsample_monthly(series: DataFrame, value: str) -> DataFrame:
    """Monthly grid from the first to the last date of a series, linear between its points."""
    return interpolate_linear(align_to_spine(month_spine(series), series, [value]), [value])


def clean_interest_rates(table: DataFrame) -> DataFrame:
    return sort_series(table.select(parse_date(F.col("date").cast("string")).alias("month"), F.col("taux").cast("double")))


def clean_new_mortgages(table: DataFrame) -> DataFrame:
    return scale_mortgages(table.select(parse_date(F.col("date").cast("string")).alias("month"), "emprunts_M€"))


def sort_series(series: DataFrame) -> DataFrame:
    return series.orderBy("month")


def scale_mortgages(series: DataFrame) -> DataFrame:
    """Millions of euros to euros, in time order."""
    scaled = series.withColumn("emprunts_€", F.col("emprunts_M€").cast("double") * 1_000_000)
    return sort_series(scaled.drop("emprunts_M€"))


def clean_secondary(tables: dict[str, DataFrame], mapping: DataFrame) -> dict[str, DataFrame]:
    """The four cleaned economic tables under their raw names."""
    return {
        "foyers_fiscaux_df": clean_tax_households(tables["foyers_fiscaux_df"], mapping),
        "taux_interet_df": clean_interest_rates(tables["taux_interet_df"]),
        "flux_nouveaux_emprunts_df": clean_new_mortgages(tables["flux_nouveaux_emprunts_df"]),
        "taux_endettement_df": clean_debt_ratio(tables["taux_endettement_df"]),
    }
