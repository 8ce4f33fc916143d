"""The query registry and the access to test tables that all queries share."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from terrier.catalog import standins
from terrier.operators import cleaning, enrich, series
from terrier.sources.scratch import scratch_path, settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Test tables and the stand-in tables and stages derived from them.

    All are lazy except the small ones that several steps read: the economic series and the two
    lookups are computed from the whole tables once, written, and read back.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    @cached_property
    def raw(self) -> DataFrame:
        return standins.raw_transactions(self["lineitem"])

    @cached_property
    def cleaned(self) -> DataFrame:
        return cleaning.clean_transactions(self.raw)

    @cached_property
    def stateless(self) -> DataFrame:
        return enrich.stateless_features(self.cleaned)

    @cached_property
    def mapping(self) -> DataFrame:
        # Distinct pairs do not need the copies removed first: no wide shuffle.
        return cleaning.city_mapping(cleaning.clean_transactions(self.raw, dedupe=False))

    @cached_property
    def tax_raw(self) -> DataFrame:
        return standins.tax_households(self["supplier"])

    @cached_property
    def rents_raw(self) -> DataFrame:
        return standins.rents(self["customer"])

    @cached_property
    def debt_raw(self) -> DataFrame:
        return settle(standins.debt_ratio(self["orders"]), "debt")

    @cached_property
    def rates_raw(self) -> DataFrame:
        return settle(standins.interest_rates(self["orders"]), "rates")

    @cached_property
    def mortgages_raw(self) -> DataFrame:
        return settle(standins.new_mortgages(self["orders"]), "mortgages")

    @cached_property
    def quarters_raw(self) -> DataFrame:
        return settle(standins.rent_index(self["orders"]), "quarters")

    @cached_property
    def tax(self) -> DataFrame:
        """Tax means by city, written once so that the join sees the true size."""
        return settle(cleaning.clean_tax_households(self.tax_raw, self.mapping), "tax")

    @cached_property
    def temporal(self) -> DataFrame:
        """Monthly indicators, computed over all orders once and then read from storage."""
        monthly = series.combined_temporal_features(
            cleaning.clean_new_mortgages(self.mortgages_raw),
            cleaning.clean_interest_rates(self.rates_raw),
            cleaning.clean_debt_ratio(self.debt_raw),
        )
        return settle(monthly, "temporal")

    @cached_property
    def merged(self) -> DataFrame:
        return enrich.rename_features(enrich.merge_features(self.stateless, self.temporal, self.tax))

    @cached_property
    def merged_stage(self) -> DataFrame:
        """The merged table as a written stage, for consumers that pass over it several times."""
        return settle(self.merged, "merged")


def query(name: str, sql: str | None = None, ctes: str = ""):
    """Register ``build(tables) -> DataFrame`` under a name, with SQL over the named stand-ins."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            SQL[name] = standins.with_ctes(sql, ctes.split())
        return build

    return register
