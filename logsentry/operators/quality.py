"""Table checks and simple column repairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsentry.session import one_row

UNKNOWN = "unknown"


def check_schema(df: DataFrame, n_columns: int | None = None, required: list[str] | None = None) -> DataFrame:
    """Return ``df``, or raise when the column count or a required column is wrong. Reads no rows."""
    if n_columns is not None and len(df.columns) != n_columns:
        raise ValueError(f"expected {n_columns} columns, found {len(df.columns)}")
    missing = [c for c in required or [] if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, n_null, has_null) for each column, in one pass."""
    columns = columns or df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    lines = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in columns])
    return counts.select(F.explode(lines).alias("line")).select("line.*", (F.col("line.n_null") > 0).alias("has_null"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Number of classes and largest/smallest class size."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count(F.lit(1)).alias("n_classes"), F.max("n").alias("largest"), F.min("n").alias("smallest"),
        (F.max("n") / F.min("n")).alias("imbalance_ratio"),
    )


def mean_impute(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Missing values become the column mean (of ``fit_on`` if given)."""
    source = fit_on if fit_on is not None else df
    means = one_row(source.agg(*[F.avg(c).alias(c) for c in columns]))
    return df.withColumn("_mean", means).withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.col(f"_mean.{c}")) for c in columns
    }).drop("_mean")


def fill_unknown(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cast to text, with missing values as ``unknown``."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)) for c in columns})


def standard_scale(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Add ``<c>_scaled``: zero mean and unit *population* deviation; a constant column becomes 0."""
    source = fit_on if fit_on is not None else df
    stats = one_row(source.agg(*[
        e for c in columns for e in (F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std"))
    ]))
    scaled = {}
    for c in columns:
        std = F.col(f"_stats.{c}_std")
        scaled[f"{c}_scaled"] = (F.col(c) - F.col(f"_stats.{c}_mean")) / F.when(std == 0, F.lit(1.0)).otherwise(std)
    return df.withColumn("_stats", stats).withColumns(scaled).drop("_stats")
