"""Splits, folds and rows by position in an ordered table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.operators.ranks import exact_quantiles, label_by_position, sort_spread, row_hash

MONTH = "year_month_numeric"


def share_of(rows: int, share: float) -> int:
    """Rows in the first part, truncated in double arithmetic (0.7 of 90 is 62)."""
    return int(share * rows)


def _two_parts(df: DataFrame, order_by: str, share: float, names: tuple[str, str], column: str) -> DataFrame:
    labelled = label_by_position(df, order_by, lambda n: [share_of(n, share)], "_segment")
    part = F.when(F.col("_segment") == 0, names[0]).otherwise(names[1])
    return labelled.withColumn(column, part).drop("_segment")


def temporal_split(df: DataFrame, order_by: str = MONTH, share: float = 0.7) -> DataFrame:
    """``part`` is ``train`` for the earliest ``int(share * n)`` rows, else ``test``."""
    return _two_parts(df, order_by, share, ("train", "test"), "part")


def validation_split(train: DataFrame, order_by: str = MONTH, share: float = 0.8) -> DataFrame:
    """``part`` is ``fit`` for the first rows of the training set, else ``validation``."""
    return _two_parts(train, order_by, share, ("fit", "validation"), "part")


def positional_split_80(df: DataFrame, order_by: str, share: float = 0.8) -> DataFrame:
    """80/20 by row position under an explicit order."""
    return _two_parts(df, order_by, share, ("train", "test"), "part")


def quantile_split(df: DataFrame, column: str = MONTH, share: float = 0.7) -> DataFrame:
    """``part`` is ``before`` up to and including the quantile of ``column``, else ``after``."""
    cut = exact_quantiles(df, column, [share])[share]
    if cut is None:
        return df.withColumn("part", F.lit(None).cast("string"))
    return df.withColumn("part", F.when(F.col(column) <= F.lit(cut), "before").otherwise("after"))


def filter_before_quantile(df: DataFrame, column: str = MONTH, share: float = 0.7) -> DataFrame:
    """Rows at or before the quantile of ``column``, as a comparison that pushes down."""
    cut = exact_quantiles(df, column, [share])[share]
    return df.limit(0) if cut is None else df.filter(F.col(column) <= F.lit(cut))


def expanding_cuts(rows: int, folds: int = 5) -> list[int]:
    """Starts of the test blocks of an expanding-window split."""
    size = rows // (folds + 1)
    if size == 0:
        raise ValueError(f"{rows} rows are too few for {folds} folds")
    return [rows - (folds - i) * size for i in range(folds)]


def time_series_folds(df: DataFrame, order_by: str = MONTH, folds: int = 5) -> DataFrame:
    """Number the blocks of an expanding split.

    Block ``b >= 1`` is the test set of fold ``b``; its training set is every block below ``b``.
    """
    return label_by_position(df, order_by, lambda n: expanding_cuts(n, folds), "block")


def fold_sets(blocks: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of one expanding fold."""
    return (
        blocks.filter(F.col("block") < fold).drop("block"),
        blocks.filter(F.col("block") == fold).drop("block"),
    )


def contiguous_cuts(rows: int, folds: int = 5) -> list[int]:
    """Inner bounds of unshuffled folds; the first ``rows % folds`` folds hold one more row."""
    sizes = [rows // folds + (1 if i < rows % folds else 0) for i in range(folds)]
    return [sum(sizes[: i + 1]) for i in range(folds - 1)]


def kfold_contiguous(df: DataFrame, order_by: str, folds: int = 5) -> DataFrame:
    """``fold`` 1..k by position, without shuffling."""
    labelled = label_by_position(df, order_by, lambda n: contiguous_cuts(n, folds), "_segment")
    return labelled.withColumn("fold", F.col("_segment") + 1).drop("_segment")


def sort_by_month(df: DataFrame, order_by: str = MONTH) -> DataFrame:
    """Whole table in month order."""
    return sort_spread(df, order_by)


def head(df: DataFrame, rows: int, order_by: list[str]) -> DataFrame:
    """First rows under an order: a top-n per task, then one merge of n rows per task."""
    return df.orderBy(*order_by).limit(rows)


def row_at(df: DataFrame, position: int, order_by: str) -> DataFrame:
    """The row at a zero-based position under an order."""
    labelled = label_by_position(df, order_by, lambda n: [position, position + 1], "_segment")
    return labelled.filter(F.col("_segment") == 1).drop("_segment")


def sample_one(df: DataFrame, seed: int, by: list[str]) -> DataFrame:
    """One row picked by a seeded digest of the ``by`` columns: same seed, same row.

    Rows that tie there are ordered by their hash and then by all columns, so only copies of a row tie.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(f"`{c}`").cast("string") for c in by]))
    return df.orderBy(digest, *by, row_hash(df), *[F.col(f"`{c}`") for c in df.columns]).limit(1)


