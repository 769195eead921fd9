"""Seconds since the previous row of a key, over a stream whose rows arrive out of order.

A key may hold a third of all rows, so it is cut into sub-keys, one per stretch of event time. A sub-key's rows wait in its state
until the watermark has passed its stretch; a timer then releases them in time order, the gap of each row but the first known, and
the state is gone. What is left, the gap between a stretch's first row and the key's last row before, needs one row per
sub-key: as each batch is written, these rows are put in order and joined with the last time of each key, which the batch before
left in a folder under its number. A batch that is repeated reads the same folder and replaces what it wrote.

Rows whose time lies behind the watermark come too late: their stretch may be gone. They are dropped and counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from logsentry.sources import folders
from logsentry.streaming.scoring import LATENESS

STRETCH = 600  # seconds of event time of a sub-key

_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_OUT = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("stretch", T.LongType()), T.StructField("us", T.LongType()),
    T.StructField("tie", T.LongType()), T.StructField("gap", T.DoubleType()), T.StructField("until", T.LongType()),
])


class Stretches(StatefulProcessor):
    """Rows (us, tie) of one key and stretch, released in order once the watermark has passed the stretch.

    The first row has no gap yet but the stretch's last time, ``until``. Both times are in microseconds.
    """

    def __init__(self, seconds: int) -> None:
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "us long, tie long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if not self.rows.exists():
            self.handle.registerTimer((int(key[1]) + 1) * self.seconds * 1000)
        for batch in rows:
            self.rows.appendList(list(zip(batch["us"].tolist(), batch["tie"].tolist())))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        told = pd.DataFrame(sorted(self.rows.get()), columns=["us", "tie"])
        self.rows.clear()
        gap = told["us"].diff() / 1e6
        until = pd.Series([None] * len(told), dtype="Int64")
        if len(told):
            until.iloc[0] = int(told["us"].iloc[-1])
        yield pd.DataFrame({"key": key[0], "stretch": int(key[1]), "us": told["us"], "tie": told["tie"], "gap": gap, "until": until})

    def close(self) -> None:
        pass


def _microseconds(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def released(logs: DataFrame, key: str, ts: str, tie: str, lateness: str = LATENESS, stretch: int = STRETCH) -> DataFrame:
    """The stream of released rows (key, stretch, us, tie, gap, until). Rows without a time never arrive; ``tie`` is a whole number.

    The state needs a store that keeps timers and lists, so the session is told to use RocksDB.
    """
    logs.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    timed = logs.filter(F.col(ts).isNotNull()).select(
        F.col(key).cast("string").alias("key"), F.col(ts).cast("timestamp").alias("_event_time"), _microseconds(ts).alias("us"),
        F.col(tie).cast("long").alias("tie"))
    marked = timed.withWatermark("_event_time", lateness).withColumn("stretch", F.floor(F.col("us") / F.lit(stretch * 1_000_000)))
    return marked.groupBy("key", "stretch").transformWithStateInPandas(
        statefulProcessor=Stretches(stretch), outputStructType=_OUT, outputMode="Append", timeMode="EventTime")


def _merge(path: str):
    """Writes a batch of released rows under its number, with every gap, and each key's last time after it."""
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        parts = f"{path}/parts/batch={number}"
        batch.write.mode("overwrite").parquet(parts)
        rows = spark.read.schema(_OUT).parquet(parts)
        before = [int(n.removeprefix("batch=")) for n in folders.names(spark, f"{path}/last") if n.startswith("batch=")]
        before = [n for n in before if n < number]
        last = spark.read.schema("key string, us long").parquet(f"{path}/last/batch={max(before)}") if before else None
        # One row per sub-key. Stretches of a key are released in order, so all of a batch come after those before.
        firsts = rows.filter("until IS NOT NULL").select("key", "stretch", "us", "until")
        seen = firsts.select("key", "stretch", "us", "until")
        if last is not None:
            seen = seen.unionByName(last.select("key", F.lit(None).cast("long").alias("stretch"), F.lit(None).cast("long").alias("us"),
                                                F.col("us").alias("until")))
        order = Window.partitionBy("key").orderBy(F.col("stretch").asc_nulls_first())
        gaps = seen.withColumn("gap0", (F.col("us") - F.lag("until").over(order)) / F.lit(1e6)).filter("stretch IS NOT NULL").select(
            F.col("key").alias("k"), F.col("stretch").alias("s"), "gap0")
        joined = rows.join(gaps, F.col("key").eqNullSafe(F.col("k")) & (F.col("stretch") == F.col("s")), "left")
        gap = F.when(F.col("key").isNull(), F.lit(0.0)).otherwise(F.coalesce("gap", F.when(F.col("until").isNotNull(), F.col("gap0")), F.lit(0.0)))
        joined.select("key", "us", "tie", gap.alias("time_since_last")).write.mode("overwrite").parquet(f"{path}/out/batch={number}")
        latest = seen.groupBy("key").agg(F.max("until").alias("us"))
        latest.write.mode("overwrite").parquet(f"{path}/last/batch={number}")
        for old in sorted(before)[:-1]:  # a repeated batch reads the folder of the one before, no older one
            folders.remove(spark, f"{path}/last/batch={old}")
        folders.remove(spark, parts)

    return write


def time_since_stream(logs: DataFrame, key: str, ts: str, tie: str, path: str, checkpoint: str, lateness: str = LATENESS,
                      stretch: int = STRETCH, timeout: int | None = None) -> int:
    """Process what is available of ``logs`` into ``path``; returns how many rows came too late.

    Run again with the same folders it goes on where it stopped. Rows of the last stretches stay in state until later rows, or those
    of ``heartbeat``, move the watermark past them. ``out`` below ``path`` is read with ``time_since_rows``.
    """
    stream = released(logs, key, ts, tie, lateness, stretch)
    query = stream.writeStream.foreachBatch(_merge(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination(timeout) if timeout else query.awaitTermination()
    return sum(int(op.numRowsDroppedByWatermark) for p in query.recentProgress for op in p.stateOperators)


def heartbeat(logs: DataFrame, ts: str, time: str) -> DataFrame:
    """One row of the columns of ``logs`` with nothing but a time: it moves the watermark and has no tie, so no result row counts it."""
    spark = logs.sparkSession
    empty = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in logs.schema}
    empty[ts] = F.lit(time).cast(logs.schema[ts].dataType).alias(ts)
    return spark.range(1).select(*empty.values())


def time_since_rows(spark: SparkSession, path: str) -> DataFrame:
    """(tie, time_since_last) of all rows released so far."""
    return spark.read.parquet(f"{path}/out").filter("tie IS NOT NULL").select("tie", "time_since_last")
