"""Label encoding: categories to codes in sorted order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logsentry.operators.order import global_index
from logsentry.session import BROADCAST_ROWS, pin


def fit_encoders(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mapping table (column, value, code): codes 0..k-1 in ascending value order per column.

    One scan for all columns; distinct values are found with map-side
    aggregation, so repeated values never travel. Missing values get no code. A
    distinct table beyond the broadcast size is numbered with the ranged index, so a
    column with very many distinct values needs no single task.
    """
    return numbered_values(distinct_values(df, columns))


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value): the distinct values that are there, as text, written once."""
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("pair")).select("pair.*").filter(F.col("value").isNotNull()).distinct()
    return pin(pairs, "categories")


def numbered_values(pairs: DataFrame) -> DataFrame:
    """(column, value, code) of a written table of distinct pairs: each column's values from 0 in their order."""
    rows = pairs.count()
    if rows <= BROADCAST_ROWS:
        code = F.row_number().over(Window.partitionBy("column").orderBy("value")) - 1
        return pairs.withColumn("code", code)
    numbered = global_index(pairs, ["column", "value"], "_at", tag="encoders", rows=rows)
    starts = numbered.groupBy("column").agg(F.min("_at").alias("_start"))  # one row per encoded column
    return numbered.join(F.broadcast(starts), "column").select(
        "column", "value", (F.col("_at") - F.col("_start")).cast("int").alias("code")
    )


def _lookup(mapping: DataFrame, column: str) -> DataFrame:
    return mapping.filter(F.col("column") == column).select(F.col("value").alias("_value"), F.col("code").alias("_code"))


def _fits(mapping: DataFrame, columns: list[str]) -> set[str]:
    """Columns whose codes are few enough to send to every executor; one count for all."""
    counts = mapping.filter(F.col("column").isin(columns)).groupBy("column").count().collect()  # one row per column
    return {r["column"] for r in counts if r["count"] <= BROADCAST_ROWS}


def apply_encoders(df: DataFrame, mapping: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``<column>_encoded``; a value the mapping does not know raises when the row is read.

    Small mappings are broadcast after a count; a larger one joins by shuffle, where AQE splits hot values.
    """
    small = _fits(mapping, columns)
    for column in columns:
        lookup = _lookup(mapping, column)
        lookup = F.broadcast(lookup) if column in small else lookup
        failure = F.concat(
            F.lit(f"unseen value in column {column}: "), F.coalesce(F.col(column).cast("string"), F.lit("null"))
        )
        df = df.join(lookup, F.col(column).cast("string") == F.col("_value"), "left").withColumn(
            f"{column}_encoded", F.coalesce("_code", F.raise_error(failure).cast("int"))
        ).drop("_value", "_code")
    return df


def unseen_values(df: DataFrame, mapping: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n_rows) of the values the mapping has no code for.

    Values are counted before they are looked up, so the anti join sees each value once.
    """
    counts = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("pair")).select("pair.*").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(mapping.select("column", "value"), ["column", "value"], "left_anti")


def decode(df: DataFrame, mapping: DataFrame, column: str, code: str, out: str) -> DataFrame:
    """Codes back to values."""
    lookup = _lookup(mapping, column).withColumnRenamed("_value", out)
    lookup = F.broadcast(lookup) if column in _fits(mapping, [column]) else lookup
    return df.join(lookup, F.col(code) == F.col("_code"), "left").drop("_code")
