"""The batch column functions over a stream of log rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logsentry.functions.rules import score_logs
from logsentry.session import scratch_path

# How long rows may arrive after newer ones.
LATENESS = "10 minutes"


def read_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the parquet files under ``path``; ``files_per_trigger`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def event_time(ts: str = "Timestamp") -> Column:
    return F.col(ts).cast("timestamp")


def score_stream(logs: DataFrame) -> DataFrame:
    """Rule scores of each row as it arrives; stateless."""
    return score_logs(logs)


def reject_duplicates(logs: DataFrame, key: list[str], ts: str = "Timestamp", lateness: str = LATENESS) -> DataFrame:
    """The first row of each key; repeats within ``lateness`` of event time are dropped.

    State is kept per key only until the watermark passes it.
    """
    return logs.withColumn("_event_time", event_time(ts)).withWatermark("_event_time", lateness).dropDuplicatesWithinWatermark(
        key
    ).drop("_event_time")


def alert_counts(logs: DataFrame, width: str = "1 hour", ts: str = "Timestamp", lateness: str = LATENESS) -> DataFrame:
    """Rows and mean score per tumbling window and risk level, emitted once the watermark closes the window.

    Counts are combined before the shuffle; there are three rows of state per open window.
    """
    scored = score_logs(logs).withColumn("_event_time", event_time(ts)).withWatermark("_event_time", lateness)
    return scored.groupBy(F.window("_event_time", width), "risk_level").agg(
        F.count(F.lit(1)).alias("n"), F.avg("y_prob").alias("mean_score")
    ).select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"), "risk_level", "n", "mean_score",
    )


def run_available(stream: DataFrame, path: str | None = None, checkpoint: str | None = None, timeout: int | None = None) -> DataFrame:
    """Process everything available now into a parquet table and return that table.

    Output and progress live in the shared folder, so a restarted query goes on where it stopped.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, "stream-out")
    checkpoint = checkpoint or scratch_path(spark, "stream-state")
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination(timeout) if timeout else query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
