"""Category codes that never change: a dictionary that only grows.

An increment's distinct values are looked up in the dictionary; those it lacks get the next codes of their column, in sorted order. Rows
of earlier increments are not read again, and their codes stay. The dictionary is a folder of small tables and of commits that
name the live ones and each column's number of codes. A commit is put in place by rename under the next number, so of two
runs that add at once one finds its number taken, drops what it wrote and numbers its values again after the other's. Missing values have no code.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsentry.operators.encode import apply_encoders, distinct_values, numbered_values
from logsentry.session import broadcast_if_small, pin
from logsentry.sources import folders

_SCHEMA = "column string, value string, code int"


class CodeDictionary:
    """The dictionary at ``path``; empty if there is none."""

    def __init__(self, spark: SparkSession, path: str, attempts: int = 10) -> None:
        self.spark, self.path, self.attempts = spark, path.rstrip("/"), attempts
        self.commits = folders.Commits(spark, f"{self.path}/commits")

    def _state(self) -> tuple[int, dict]:
        return self.commits.newest({"folders": [], "sizes": {}})

    def _mapping(self, state: dict) -> DataFrame:
        if not state["folders"]:
            return self.spark.createDataFrame([], _SCHEMA)
        return self.spark.read.schema(_SCHEMA).parquet(*[f"{self.path}/codes/{n}" for n in state["folders"]])

    def mapping(self) -> DataFrame:
        """(column, value, code) of all values so far."""
        return self._mapping(self._state()[1])

    def sizes(self) -> dict[str, int]:
        """Number of codes of each column."""
        return dict(self._state()[1]["sizes"])

    def add(self, increment: DataFrame, columns: list[str]) -> int:
        """Give codes to the values of ``columns`` that have none; returns how many these are."""
        pairs = distinct_values(increment, columns)
        for _ in range(self.attempts):
            number, state = self._state()
            known = self._mapping(state).select("column", "value")
            new = pin(pairs.join(known, ["column", "value"], "left_anti") if state["folders"] else pairs, "new-values")
            counts = {r[0]: r[1] for r in new.groupBy("column").count().collect()}  # one row per column
            if not counts:
                return 0
            start = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for c in counts for x in (c, state["sizes"].get(c, 0))]), F.col("column")), F.lit(0))
            name = uuid.uuid4().hex
            numbered_values(new).select("column", "value", (F.col("code") + start).cast("int").alias("code")).write.parquet(f"{self.path}/codes/{name}")
            sizes = state["sizes"] | {c: state["sizes"].get(c, 0) + n for c, n in counts.items()}
            if self.commits.put(number + 1, {"folders": [*state["folders"], name], "sizes": sizes}):
                return sum(counts.values())
            folders.remove(self.spark, f"{self.path}/codes/{name}")
        raise RuntimeError(f"other runs kept adding to {self.path}")

    def merge(self) -> None:
        """Put the tables of many increments into one. Call when no run adds."""
        number, state = self._state()
        name = uuid.uuid4().hex
        self._mapping(state).write.parquet(f"{self.path}/codes/{name}")
        if self.commits.put(number + 1, state | {"folders": [name]}):
            for old in state["folders"]:
                folders.remove(self.spark, f"{self.path}/codes/{old}")

    def apply(self, df: DataFrame, columns: list[str]) -> DataFrame:
        """Add ``<column>_encoded``; a value without a code raises when its row is read."""
        return apply_encoders(df, self.mapping(), columns)

    def missing(self, df: DataFrame, columns: list[str]) -> DataFrame:
        """(column, value) that have no code yet."""
        return distinct_values(df, columns).join(broadcast_if_small(pin(self.mapping().select("column", "value"), "known")), ["column", "value"], "left_anti")
