"""Inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsentry.functions.rules import log_score
from logsentry.operators.features import load_and_preprocess
from logsentry.sources.network_logs import network_logs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(column: str | Column) -> Column:
    """Six decimals, so sums added in another order compare equal."""
    name = column if isinstance(column, str) else None
    rounded = F.round(F.col(column) if name else column, 6)
    return rounded.alias(name) if name else rounded


def rounded(df: DataFrame) -> DataFrame:
    """Every DOUBLE column to six decimals."""
    return df.select(*[r6(n) if t == "double" else F.col(n) for n, t in df.dtypes])


def indexed_logs(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """The log with ``idx``; only the named columns travel through the sort."""
    logs = network_logs(spark, sf_dir)
    if columns is not None:
        logs = logs.select("log_id", "Timestamp", *columns)
    return load_and_preprocess(logs, "log_id")


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule score as y_prob: few distinct values, so heavily tied."""
    return network_logs(spark, sf_dir).select(
        F.col("log_id").alias("idx"), F.col("Intrusion").alias("y_true"), log_score().alias("y_prob")
    )


def payload_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A smooth function of the payload as y_prob: nearly every value is distinct."""
    size = F.col("Payload_Size")
    return network_logs(spark, sf_dir).select(
        F.col("log_id").alias("idx"), F.col("Intrusion").alias("y_true"),
        (size.cast("double") / (size + 5000).cast("double")).alias("y_prob"),
    )
