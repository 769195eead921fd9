"""Train/test splits and time-series folds as positional filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsentry.operators.order import global_index
from logsentry.sources.schemas import CV_FOLDS, TRAIN_RATIO


def row_total(indexed: DataFrame, idx: str = "idx") -> Column:
    """Number of rows of an indexed table, as a value usable in expressions."""
    return indexed.agg((F.coalesce(F.max(idx), F.lit(-1)) + 1).alias("n")).scalar()


def mark_split(indexed: DataFrame, train_ratio: float = TRAIN_RATIO, total_of: DataFrame | None = None) -> DataFrame:
    """Add ``is_train``: the first ``floor(n * ratio)`` rows in time order."""
    n = row_total(total_of if total_of is not None else indexed)
    return indexed.withColumn("is_train", F.col("idx") < F.floor(n * F.lit(float(train_ratio))))


def split_time_series(indexed: DataFrame, train_ratio: float = TRAIN_RATIO) -> tuple[DataFrame, DataFrame]:
    marked = mark_split(indexed, train_ratio)
    return marked.filter("is_train").drop("is_train"), marked.filter(~F.col("is_train")).drop("is_train")


def time_folds(indexed: DataFrame, folds: int = CV_FOLDS, total_of: DataFrame | None = None) -> DataFrame:
    """One row per row and fold it takes part in, with ``fold`` and ``role`` (train or test).

    With fold size ``n div (folds + 1)``, fold i tests the i-th of the last
    ``folds`` runs of that size and trains on everything before it. Map-only.
    """
    n = row_total(total_of if total_of is not None else indexed)
    sized = indexed.withColumn("_n", n).withColumn("_size", F.expr(f"_n div {folds + 1}"))
    parts = []
    for fold in range(folds):
        start = F.col("_n") - F.lit(folds - fold) * F.col("_size")
        role = F.when(F.col("idx") < start, "train").when(F.col("idx") < start + F.col("_size"), "test")
        parts.append(F.struct(F.lit(fold).alias("fold"), role.alias("role")))
    return (
        sized.withColumn("_f", F.explode(F.filter(F.array(*parts), lambda p: p["role"].isNotNull())))
        .select("*", "_f.fold", "_f.role")
        .drop("_f", "_n", "_size")
    )


def shuffle_key(row_id: str) -> Column:
    """A repeatable pseudo-random sort key."""
    return F.md5(F.col(row_id).cast("string"))


def random_split(df: DataFrame, row_id: str, test_ratio: float = 0.3) -> DataFrame:
    """Add ``is_test`` for exactly ``ceil(n * ratio)`` rows, chosen by a hash of the row id."""
    shuffled = global_index(
        df.withColumn("_key", shuffle_key(row_id)), ["_key", row_id], "_at", tag="random-split", rows=df.count()
    )
    cut = F.ceil(row_total(shuffled, "_at") * F.lit(float(test_ratio)))
    return shuffled.withColumn("is_test", F.col("_at") < cut).drop("_key", "_at")


def stratified_split(df: DataFrame, label: str, row_id: str, test_ratio: float = 0.3) -> DataFrame:
    """Add ``is_test`` for ``round(n_class * ratio)`` rows of every class, chosen by a hash of the row id.

    Rows are ordered by (class, hash) with the ranged index, so a class holding
    most rows is still spread over many tasks. Classes are few: their counts are broadcast.
    """
    shuffled = global_index(
        df.withColumn("_key", shuffle_key(row_id)), [label, "_key", row_id], "_at", tag="stratified-split", rows=df.count()
    )
    classes = shuffled.groupBy(label).agg(
        F.min("_at").alias("_start"), F.round(F.count(F.lit(1)) * F.lit(float(test_ratio))).alias("_take")
    ).withColumnRenamed(label, "_class")
    return (
        shuffled.join(F.broadcast(classes), F.col(label).eqNullSafe(F.col("_class")))
        .withColumn("is_test", F.col("_at") - F.col("_start") < F.col("_take"))
        .drop("_key", "_at", "_class", "_start", "_take")
    )


def fold_bounds(n: int, folds: int) -> list[tuple[int, int]]:
    """(first test row, end) of every fold, for callers that already know ``n``."""
    size = n // (folds + 1)
    if size == 0:
        raise ValueError(f"cannot cut {n} rows into {folds} folds")
    return [(n - (folds - f) * size, n - (folds - f - 1) * size) for f in range(folds)]
