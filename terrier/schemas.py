"""One ``StructType`` per stage, applied on read and asserted before write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "int": T.IntegerType(),
    "date": T.DateType(),
}


def _struct(text: str) -> T.StructType:
    """Schema from ``name type`` pairs; unlike the DDL parser it needs no running session."""
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Columns of the raw sales that no later step reads.
UNUSED_RAW_COLUMNS = [
    "id_transaction",
    "code_postal",
    "adresse",
    "vefa",
    "id_parcelle_cadastre",
    "surface_dependances",
    "surface_terrains_nature",
    "latitude",
    "longitude",
]

TRANSACTIONS_RAW = _struct(
    """id_transaction string, date_transaction string, prix double, departement int, id_ville int,
    ville string, code_postal string, adresse string, type_batiment string, vefa string,
    n_pieces int, surface_habitable double, id_parcelle_cadastre string, latitude string,
    longitude string, surface_dependances string, surface_locaux_industriels string,
    surface_terrains_agricoles string, surface_terrains_sols string,
    surface_terrains_nature string"""
)

ECONOMIC_RAW = {
    "foyers_fiscaux": _struct(
        "date int, departement string, ville string, n_foyers_fiscaux double, revenu_fiscal_moyen double"
    ),
    "taux_endettement": _struct("date int, taux_endettement double"),
    "taux_interet": _struct("date string, taux double"),
    "flux_nouveaux_emprunts": _struct("date string, emprunts_M€ double"),
    "indice_reference_loyers": _struct("quarter string, IRL double"),
}

CLEANED = _struct(
    """date_transaction date, prix double, departement int, id_ville int, ville string,
    type_batiment string, n_pieces int, surface_habitable float, surface_terrains_sols string"""
)

CITY_MAPPING = _struct("ville string, unique_city_id string")

STATELESS = _struct(
    """year_month_numeric int, month_sin double, month_cos double, departement string,
    unique_city_id string, log_price_per_m2 double, living_area float, type_batiment string,
    n_pieces int, surface_terrains_sols string"""
)

TAX_BY_CITY = _struct("unique_city_id string, n_foyers_fiscaux double, revenu_fiscal_moyen double")

TEMPORAL = _struct(
    "New_mortgages double, Debt_ratio float, Interest_rates float, year_month_numeric int"
)

MERGED = _struct(
    """year_month_numeric int, month_sin double, month_cos double, departement string,
    unique_city_id string, log_price_per_m2 double, living_area float, building_type string,
    n_rooms int, outdoor_area string, new_mortgages double, debt_ratio float,
    interest_rates float, n_tax_households double, average_tax_income double"""
)

PREPROCESSED = _struct(
    """n_rooms float, new_mortgages double, debt_ratio float, interest_rates float,
    building_type int, average_outdoor_space int, large_outdoor_space int, no_garden int,
    small_outdoor_space int, living_area float, n_tax_households double,
    average_tax_income double, year_month_numeric int, month_sin double, month_cos double,
    departement string, unique_city_id string"""
)

NUMERIC_COLUMNS = [f.name for f in PREPROCESSED if f.name not in ("departement", "unique_city_id")]

SCORING_REQUEST = _struct(
    """year_month_numeric int, month_sin double, month_cos double, departement string,
    unique_city_id string, living_area double, building_type string, n_rooms int,
    outdoor_area string, new_mortgages double, debt_ratio double, interest_rates double,
    n_tax_households double, average_tax_income double"""
)


def cast_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to exactly the columns, order and types of ``schema``.

    Text that does not parse becomes NULL; numbers follow SQL casts.
    """
    have = {f.name: f.dataType for f in df.schema}
    missing = [f.name for f in schema if f.name not in have]
    if missing:
        raise ValueError(f"columns missing for this stage: {missing}")

    def column(field: T.StructField):
        source = F.col(f"`{field.name}`")
        if isinstance(have[field.name], T.StringType) and not isinstance(field.dataType, T.StringType):
            source = source.try_cast(field.dataType)
        elif have[field.name] != field.dataType:
            source = source.cast(field.dataType)
        return source.alias(field.name)

    return df.select(*[column(field) for field in schema])


def expect_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Return ``df`` unchanged, or raise when its names or types differ from the stage schema."""
    got = [(f.name, f.dataType.simpleString()) for f in df.schema]
    want = [(f.name, f.dataType.simpleString()) for f in schema]
    if got != want:
        raise ValueError(f"stage schema mismatch: got {got}, want {want}")
    return df
