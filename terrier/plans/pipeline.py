"""Pipeline steps. Each reads finished stages, writes its own, and can run as its own job."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrier.operators import cleaning, modelling, preprocessing, splits
from terrier.operators.enrich import merge_features, rename_features, stateless_features
from terrier.operators.series import combined_temporal_features
from terrier.schemas import CITY_MAPPING, MERGED, STATELESS, TAX_BY_CITY, TEMPORAL, TRANSACTIONS_RAW, cast_schema
from terrier.sources.archive import read_archive
from terrier.sources.files import has_mark, is_complete, list_names
from terrier.sources.registry import load_latest_model, log_run, save_model
from terrier.sources.scratch import own_shuffles_removed
from terrier.sources.stages import expect_row_count, is_current, materialize, note_inputs, read_stage, require_stage
from terrier.sources.tables import SKIPPED_RAW_ENTRIES, csv_to_parquet, ingest_chunks, load_tables, write_parquet

TARGET = modelling.TARGET


@dataclass(frozen=True)
class Layout:
    """Where the stages of one project live; any path scheme Spark can read and write."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/data/raw_dataset"

    @property
    def chunks(self) -> str:
        return f"{self.raw}/raw_dataset_chunks"

    @property
    def archive(self) -> str:
        return f"{self.raw}/transactions.npz"

    @property
    def transactions(self) -> str:
        return f"{self.raw}/raw_dataset_full/transactions.parquet"

    def cleaned(self, name: str) -> str:
        return f"{self.root}/data/cleaned_dataset/cleaned_{name}.parquet"

    @property
    def merged(self) -> str:
        return f"{self.root}/data/merged_dataset/merged_dataset.parquet"

    @property
    def split(self) -> str:
        return f"{self.root}/data/merged_dataset/split.parquet"

    def preprocessed(self, part: str) -> str:
        return f"{self.root}/data/preprocessed_dataset/{part}_preprocessed.parquet"

    @property
    def artifacts(self) -> str:
        return f"{self.root}/artifacts"

    @property
    def city_mapping(self) -> str:
        return f"{self.artifacts}/city_mapping.parquet"

    @property
    def preprocessor(self) -> str:
        return f"{self.artifacts}/preprocessor"


def run_extract(spark: SparkSession, layout: Layout) -> DataFrame:
    """The archive, or chunk files where there is none, to one raw Parquet dataset; economic CSV to Parquet.

    Missing numbers of the archive (NaN) become NULL. A table that is there as Parquet is not converted.
    """
    there = set(list_names(spark, layout.raw))
    fresh = {n.removesuffix(".csv") for n in there if n.endswith(".csv") and n not in SKIPPED_RAW_ENTRIES}
    fresh = {n for n in fresh if f"{n}.parquet" not in there}
    if fresh:
        csv_to_parquet(spark, layout.raw, only=fresh)
    if "transactions.npz" not in there:
        return ingest_chunks(spark, layout.chunks, layout.transactions, TRANSACTIONS_RAW)
    rows = cast_schema(read_archive(spark, layout.archive), TRANSACTIONS_RAW)
    numbers = [f.name for f in TRANSACTIONS_RAW if f.dataType.simpleString() in ("double", "float")]
    rows = rows.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in numbers})
    write_parquet(rows, layout.transactions)
    return read_stage(spark, layout.transactions, TRANSACTIONS_RAW)


def run_clean(spark: SparkSession, layout: Layout, rows: tuple[int, int] | None = None) -> DataFrame:
    """Cleaned sales with stateless features, city mapping, and the four economic tables.

    A finished cleaned stage is reused while the raw table is the one it was made from; with ``rows``
    (low, high) its row count has to lie between them. An empty one is computed again, from the raw table on.
    """
    target = layout.cleaned("transactions_df")
    source = [layout.transactions]
    if is_complete(spark, target) and is_current(spark, target, source) and not (stage := read_stage(spark, target, STATELESS)).isEmpty():
        if rows is not None:
            expect_row_count(stage, *rows)
    else:
        raw = require_stage(spark, layout.transactions, "run_extract first", TRANSACTIONS_RAW)
        # The de-duplicated sales feed two outputs: written once, then both read narrow columns of it.
        sales = materialize(spark, layout.cleaned("sales_df"), lambda: cleaning.clean_transactions(raw), require_rows=True, inputs=source)
        write_parquet(cleaning.city_mapping(sales), layout.city_mapping)
        write_parquet(stateless_features(sales), target)
        note_inputs(spark, target, source)
    mapping = require_stage(spark, layout.city_mapping, "run_clean again", CITY_MAPPING)
    used = [f"{layout.raw}/{n}" for n in list_names(spark, layout.raw) if n.endswith(".parquet")] + [layout.city_mapping]
    for name, table in cleaning.clean_secondary(load_tables(spark, layout.raw), mapping).items():
        materialize(spark, layout.cleaned(name), lambda table=table: table, inputs=used)
    return read_stage(spark, target, STATELESS)


def temporal_table(spark: SparkSession, layout: Layout) -> DataFrame:
    def cleaned(name: str) -> DataFrame:
        return require_stage(spark, layout.cleaned(f"{name}_df"), "run_clean first")

    return combined_temporal_features(
        cleaned("flux_nouveaux_emprunts"), cleaned("taux_interet"), cleaned("taux_endettement")
    )


def run_merge(spark: SparkSession, layout: Layout) -> DataFrame:
    """Sales enriched with both lookups. Both are read from written stages, so their size is known."""
    sales = require_stage(spark, layout.cleaned("transactions_df"), "run_clean first", STATELESS)
    series = [layout.cleaned(f"{n}_df") for n in ("flux_nouveaux_emprunts", "taux_interet", "taux_endettement")]
    lookup = layout.cleaned("temporal_features_df")
    temporal = materialize(spark, lookup, lambda: temporal_table(spark, layout), TEMPORAL, inputs=series)
    tax = require_stage(spark, layout.cleaned("foyers_fiscaux_df"), "run_clean first", TAX_BY_CITY)
    return materialize(
        spark,
        layout.merged,
        lambda: rename_features(merge_features(sales, temporal, tax)),
        MERGED,
        require_rows=True,
        inputs=[layout.cleaned("transactions_df"), lookup, layout.cleaned("foyers_fiscaux_df")],
    )


def run_preprocess(spark: SparkSession, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """Merged, split by time, fitted on train; train and test keep the target in the row."""
    merged = run_merge(spark, layout)

    def split() -> DataFrame:
        complete = cleaning.drop_missing_subset(merged, ["n_tax_households", "average_tax_income"])
        return splits.temporal_split(complete)

    parts = materialize(spark, layout.split, split, partition_by=["part"], inputs=[layout.merged])
    train = parts.filter(F.col("part") == "train").drop("part")
    test = parts.filter(F.col("part") == "test").drop("part")
    if not (has_mark(spark, layout.preprocessor) and is_current(spark, layout.preprocessor, [layout.split])):
        fitted = preprocessing.fit_preprocessor(train)
        preprocessing.save_preprocessor(spark, fitted, layout.preprocessor)
        note_inputs(spark, layout.preprocessor, [layout.split])
    fitted = preprocessing.load_preprocessor(spark, layout.preprocessor)
    done = {
        part: materialize(
            spark,
            layout.preprocessed(part),
            lambda rows=rows: preprocessing.apply_preprocessor(rows, fitted, keep=[TARGET]),
            inputs=[layout.split, layout.preprocessor],
        )
        for part, rows in (("train", train), ("test", test))
    }
    return done["train"], done["test"]


def _encoded(spark: SparkSession, layout: Layout, part: str) -> tuple[DataFrame, preprocessing.FittedPreprocessor]:
    rows = require_stage(spark, layout.preprocessed(part), "run_preprocess first")
    fitted = preprocessing.load_preprocessor(spark, layout.preprocessor)
    return preprocessing.encode_labels(rows, fitted), fitted


def run_train(spark: SparkSession, layout: Layout, model_type: str = "gbt", **params) -> float:
    """Fit on the first 80 % of train, validate on the rest; save the model and log the run."""
    if model_type not in ("gbt", "embedding"):
        raise ValueError(f"model_type must be gbt or embedding, not {model_type}")
    rows = require_stage(spark, layout.preprocessed("train"), "run_preprocess first")
    fitted = preprocessing.load_preprocessor(spark, layout.preprocessor)
    # Split on the stored rows, then encoded once: both parts are read several times.
    parts = materialize(
        spark,
        layout.preprocessed("fit_validation"),
        lambda: preprocessing.encode_labels(splits.validation_split(cleaning.drop_non_finite(rows, TARGET)), fitted),
        partition_by=["part"],
        inputs=[layout.preprocessed("train"), layout.preprocessor],
    )
    fit, validation = (parts.filter(F.col("part") == p).drop("part") for p in ("fit", "validation"))
    departments = fitted.labels["departement"].count()
    if model_type == "gbt":
        model = modelling.train_gbt(fit, departments, validation, **params)
        rmse = math.sqrt(min(model.losses))
        metrics = {"rmse": rmse, "rounds": model.rounds}
    else:
        cities = fitted.labels["unique_city_id"].count()
        model = modelling.train_embedding_model(fit, departments, cities, validation=validation, **params)
        rmse = math.sqrt(min(model.losses))
        metrics = {"rmse": rmse, "rounds": len(model.losses) - 1}
    # The whole set, defaults included, so that the run can be repeated from its record.
    used = {**(modelling.GBT_PARAMS if model_type == "gbt" else modelling.EMBEDDING_PARAMS), **params}
    log_run(spark, layout.artifacts, model_type, "train", fit.count(), used, metrics)
    save_model(model, layout.artifacts, model_type)
    return rmse


def _model(spark: SparkSession, layout: Layout, model_type: str) -> modelling.Model:
    model = load_latest_model(spark, layout.artifacts, model_type)
    if model is None:
        raise FileNotFoundError(f"no saved {model_type} model: run_train first")
    return model


def run_evaluate(spark: SparkSession, layout: Layout, model_type: str = "gbt") -> DataFrame:
    """Test metrics of the latest model, logged."""
    rows, _ = _encoded(spark, layout, "test")
    usable = cleaning.drop_non_finite(rows, TARGET)
    metrics = modelling.evaluate(modelling.predict(usable, _model(spark, layout, model_type)))
    with own_shuffles_removed(spark):
        row = metrics.first()
    log_run(
        spark, layout.artifacts, model_type, "evaluate", row["row_count"], {},
        {m: row[m] for m in ("loss", "rmse", "mae")},
    )
    return spark.createDataFrame([row], metrics.schema)


def run_predict(
    spark: SparkSession, layout: Layout, requests: DataFrame | None = None, model_type: str = "gbt", seed: int = 42
) -> DataFrame:
    """Scores for a request table, or for one seeded test row when none is given."""
    if requests is None:
        parts = require_stage(spark, layout.split, "run_preprocess first")
        rows = parts.filter(F.col("part") == "test").drop("part")
        requests = splits.sample_one(rows, seed, ["unique_city_id", "year_month_numeric", "living_area", "n_rooms"])
    fitted = preprocessing.load_preprocessor(spark, layout.preprocessor)
    return modelling.score_requests(requests, fitted, _model(spark, layout, model_type))


def run_all(spark: SparkSession, layout: Layout, model_type: str = "gbt", rows=None, **params) -> DataFrame:
    """Clean to predict; extraction is a step of its own."""
    run_clean(spark, layout, rows)
    run_preprocess(spark, layout)
    run_train(spark, layout, model_type, **params)
    run_evaluate(spark, layout, model_type)
    return run_predict(spark, layout, model_type=model_type)
