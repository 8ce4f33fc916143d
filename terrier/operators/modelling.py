"""Baseline, boosted trees, factor model, evaluation and scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrier.functions import exp_price, normal_city_id
from terrier.operators.boosting import BoostedTrees, fit_trees
from terrier.operators.cleaning import drop_non_finite
from terrier.operators.factors import FactorModel, fit_factors
from terrier.operators.preprocessing import FittedPreprocessor, apply_preprocessor, encode_labels
from terrier.operators.splits import kfold_contiguous
from terrier.schemas import NUMERIC_COLUMNS, SCORING_REQUEST, cast_schema

TARGET = "log_price_per_m2"

# Training parameters of the boosted trees.
GBT_PARAMS = {
    "maxIter": 100,
    "maxDepth": 8,
    "stepSize": 0.05,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "gamma": 0.1,
    "regLambda": 1.0,
    "minChildWeight": 1.0,
    "seed": 42,
}

# Defaults of the factor model.
EMBEDDING_PARAMS = {"factor_size": 8, "city_factor_size": 32, "max_iter": 100, "ridge": 1.0, "seed": 42}

# Fixed value: added to each squared error inside the root.
RMSE_EPSILON = 1e-8


#: Whatever ``transform`` s encoded rows into rows with ``log_price``.
Model = PipelineModel | BoostedTrees | FactorModel


def mean_r2_by_fold(folds: DataFrame, target: str, fold: str = "fold") -> DataFrame:
    """R2 of predicting the mean of the other folds, per fold, from its count, mean and variance.

    Moments are centred, so targets that are large against their spread lose no digits.
    """
    value = F.col(target).cast("double")
    known = folds.filter(value.isNotNull())
    moments = known.groupBy(fold).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_pop(value).alias("variance")
    )
    # One row per fold from here on, so a window over all of them is small. The means of the others are
    # taken as distances from this fold's own.
    whole = Window.partitionBy(F.lit(0))
    others = F.collect_list(F.struct("n", "mean")).over(whole)
    far = F.aggregate(
        others, F.lit(0.0), lambda s, o: s + o["n"] * (o["mean"] - F.col("mean"))
    ) / (F.sum("n").over(whole) - F.col("n"))
    guessed = moments.withColumn("far", far)
    return guessed.select(
        fold,
        "n",
        (F.col("mean") + F.col("far")).alias("guess"),
        (-F.try_divide(F.col("far") * F.col("far"), F.col("variance"))).alias("r2"),
    )


def baseline_mean(df: DataFrame, target: str, order_by: str, folds: int = 5) -> DataFrame:
    """Mean R2 of the mean predictor over contiguous folds."""
    return mean_r2_by_fold(kfold_contiguous(df, order_by, folds), target).agg(F.avg("r2").alias("mean_r2"))


def _trainable(df: DataFrame) -> DataFrame:
    """Rows a learner can use: finite target and complete numeric features."""
    return drop_non_finite(df, TARGET).na.drop("any", subset=NUMERIC_COLUMNS)


def train_gbt(
    fit: DataFrame, departments: int, validation: DataFrame | None = None, patience: int = 5, **params
) -> BoostedTrees:
    """Boosted trees on log price over encoded rows; department and city are nominal.

    Second-order leaf values with L2, ``gamma`` as a penalty on the total error of a split, rows and
    columns drawn for each tree. With validation rows, fitting ends after ``patience`` rounds without a
    lower error, and the rounds up to the lowest stay. ``departments`` is not needed: codes are sets.
    """
    used = {**GBT_PARAMS, **params}
    return fit_trees(
        _tree_rows(fit),
        TARGET,
        NUMERIC_COLUMNS,
        ["departement", "unique_city_id"],
        None if validation is None else _tree_rows(validation),
        patience,
        rounds=used["maxIter"],
        depth=used["maxDepth"],
        rate=used["stepSize"],
        row_share=used["subsamplingRate"],
        column_share=float(used["featureSubsetStrategy"]),
        l2=used["regLambda"],
        gamma=used["gamma"],
        least=used["minChildWeight"],
        seed=used["seed"],
    )


def best_round(losses: list[float], patience: int) -> int:
    """One-based round with the lowest loss, looking no further than ``patience`` rounds past it."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def _tree_rows(encoded: DataFrame) -> DataFrame:
    return _trainable(encoded).withColumn("departement", F.col("departement").cast("double"))


def training_curve(model: BoostedTrees, validation: DataFrame) -> DataFrame:
    """RMSE on validation rows after each round of a boosted-tree model."""
    return model.curve(_tree_rows(validation), TARGET).select("round", F.sqrt("loss").alias("rmse"))


def train_embedding_model(
    train: DataFrame,
    departments: int,
    cities: int,
    factor_size: int = 8,
    max_iter: int = 100,
    seed: int = 42,
    city_factor_size: int = 32,
    ridge: float = 1.0,
    validation: DataFrame | None = None,
    patience: int = 5,
) -> FactorModel:
    """Learned factors of departments and cities that shape the coefficients of the numeric columns.

    With validation rows, fitting ends after ``patience`` rounds without a lower error and keeps the best.
    The codes of unseen labels (``departments``, ``cities``) have no factor and no effect.
    """
    known = (F.col("departement") < departments) & (F.col("unique_city_id") < cities)
    return fit_factors(
        _trainable(train).filter(known),
        TARGET,
        NUMERIC_COLUMNS,
        "departement",
        "unique_city_id",
        None if validation is None else _trainable(validation),
        patience,
        factor_size,
        city_factor_size,
        max_iter,
        ridge,
        seed=seed,
    )


def squared_error(prediction: str, target: str) -> Column:
    difference = F.col(prediction) - F.col(target)
    return difference * difference


def evaluate(df: DataFrame, prediction: str = "log_price", target: str = TARGET) -> DataFrame:
    """Mean squared error, RMSE and MAE over all rows in one aggregate."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.avg(squared_error(prediction, target)).alias("loss"),
        F.sqrt(F.avg(squared_error(prediction, target) + RMSE_EPSILON)).alias("rmse"),
        F.avg(F.abs(F.col(prediction) - F.col(target))).alias("mae"),
    )


def evaluate_rmse(df: DataFrame, prediction: str = "log_price", target: str = TARGET) -> DataFrame:
    return evaluate(df, prediction, target).select("loss", "rmse")


def evaluate_mae(df: DataFrame, prediction: str = "log_price", target: str = TARGET) -> DataFrame:
    return evaluate(df, prediction, target).select("mae")


def predict(encoded: DataFrame, model: Model) -> DataFrame:
    """Encoded rows with log price and euros per square metre."""
    numbers = {c: F.col(c).cast("double") for c in ("departement", "unique_city_id")}
    scored = model.transform(encoded.withColumns(numbers))
    return scored.withColumn("price_per_sq_meter", exp_price("log_price"))


def score_batch(merged: DataFrame, fitted: FittedPreprocessor, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Predictions for merged rows; ``keep`` names input columns to carry along."""
    keep = keep or []
    renamed = {c: f"in_{c}" for c in keep}
    carried = merged.withColumns({new: F.col(old) for old, new in renamed.items()})
    encoded = encode_labels(apply_preprocessor(carried, fitted, keep=list(renamed.values())), fitted)
    scored = predict(encoded, model).select(*renamed.values(), "log_price", "price_per_sq_meter")
    return scored.withColumnsRenamed({new: old for old, new in renamed.items()})


def score_requests(requests: DataFrame, fitted: FittedPreprocessor, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Predictions for a table of 14-field requests, under their proper names."""
    keep = [c for c in (keep or []) if c not in SCORING_REQUEST.names]
    typed = cast_schema(requests, SCORING_REQUEST) if not keep else requests
    cleaned = typed.withColumn("unique_city_id", normal_city_id("unique_city_id"))
    return score_batch(cleaned, fitted, model, keep=[*keep, *SCORING_REQUEST.names])
