"""Saves that are checked while they are written: the numbers come from the write's own pass, and a bad save is never seen."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from logsentry.operators.quality import check_schema
from logsentry.sources import files, folders


class Gate(NamedTuple):
    """What a table must hold to be published. ``least_balance``: rows of the rarest class, of those of the most frequent."""

    least_rows: int = 1
    columns: int | None = None
    required: Sequence[str] = ()
    most_nulls: dict[str, float] | None = None  # share of missing values, by column
    label: str | None = None
    classes: Sequence[int] = (0, 1)
    least_balance: float = 0.0

    def broken(self, told: dict) -> list[str]:
        """What is wrong with a table of these metrics."""
        rows, found = told["rows"], []
        if rows < self.least_rows:
            found.append(f"{rows} rows, {self.least_rows} wanted")
        for column, share in (self.most_nulls or {}).items():
            if told[f"nulls_{column}"] > share * rows:
                found.append(f"{told[f'nulls_{column}']} of {rows} values of {column} are missing")
        if self.label is not None:
            counts = [told[f"class_{c}"] for c in self.classes]
            if sum(counts) != rows:
                found.append(f"{rows - sum(counts)} rows of other classes")
            if min(counts) < self.least_balance * max(counts):
                found.append(f"classes of {counts} rows")
        return found


def metrics(df: DataFrame, gate: Gate, scale: Sequence[str] = ()) -> list:
    """The aggregates that a write of ``df`` collects: rows, missing values per column, rows per class, mean and deviation of ``scale``."""
    numeric = {f.name for f in df.schema if isinstance(f.dataType, NumericType)}
    if set(scale) - numeric:
        raise ValueError(f"not numeric: {sorted(set(scale) - numeric)}")
    return [
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in df.columns],
        *([F.count_if(F.col(gate.label) == c).alias(f"class_{c}") for c in gate.classes] if gate.label else []),
        *[e for c in scale for e in (F.avg(c).alias(f"mean_{c}"), F.stddev_pop(c).alias(f"std_{c}"))],
    ]


def save_checked(df: DataFrame, path: str, gate: Gate = Gate(), scale: Sequence[str] = (), version: str | None = None) -> str:
    """Save a version of ``df``; its metrics are collected by the write itself, with no second scan, and published beside it.

    A table that the gate refuses raises a ValueError that says why; its rows are deleted and its version never exists.
    """
    spark = df.sparkSession
    check_schema(df, gate.columns, list(gate.required))
    version = version or files.new_version()
    if version in files.versions(spark, path):
        raise ValueError(f"version {version} exists")
    folder, seen = f"{path}/version={version}", Observation()
    df.observe(seen, *metrics(df, gate, scale)).write.mode("overwrite").parquet(folder)
    told = seen.get
    broken = gate.broken(told)
    if broken:
        folders.remove(spark, folder)
        raise ValueError(f"version {version} is not published: {'; '.join(broken)}")
    if not files.publish_version(spark, path, version, told):
        raise ValueError(f"version {version} exists")
    return version


def saved_metrics(spark: SparkSession, path: str, version: str | None = None) -> dict:
    """The metrics of a version (the newest), as they were collected when it was written."""
    version = version or files.versions(spark, path)[-1]
    return json.loads(folders.read_text(spark, files.pointer(path, version)))
