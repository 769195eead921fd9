"""Request bodies that arrive one by one: each is parsed once, and scores, refused items and refused bodies part on writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logsentry.operators.validate import assessed_bodies
from logsentry.sources import folders

_KINDS = ("score", "error", "body")


def score_bodies(bodies: DataFrame, path: str, checkpoint: str, timeout: int | None = None) -> None:
    """Score a stream of batch bodies (a text column ``body`` and columns that name it) into ``path``, everything available now.

    A micro-batch is one job over its bodies. It writes one folder with a part per kind: ``score`` (items with a prediction),
    ``error`` (items with an error) and ``body`` (bodies without items: refused as a whole, or empty). Then a commit file says
    how many rows of each there are: readers take committed batches only, so all kinds show the same batches. A batch
    that Spark repeats after a failure replaces its folder, or changes nothing if it was committed.
    """
    def take(batch: DataFrame, number: int) -> None:
        commits = folders.Commits(batch.sparkSession, f"{path}/commits")
        if number in commits.numbers():
            return
        told = assessed_bodies(batch)
        kind = F.when(F.col("index").isNull(), "body").when(F.col("error").isNull(), "score").otherwise("error")
        counted = Observation()
        marked = told.withColumn("kind", kind).observe(counted, *[F.count_if(F.col("kind") == k).alias(k) for k in _KINDS])
        marked.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/rows/batch={number}")
        commits.put(number, {k: counted.get[k] for k in _KINDS})

    query = bodies.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination(timeout) if timeout else query.awaitTermination()


def _rows(spark: SparkSession, path: str, *kinds: str) -> DataFrame:
    commits = folders.Commits(spark, f"{path}/commits")
    told = {n: commits.read(n) for n in commits.numbers()}
    whole = [f"{path}/rows/batch={n}/kind={k}" for n, t in told.items() for k in kinds if t[k]]
    if not whole:
        raise ValueError(f"{path} holds no rows of {', '.join(kinds)}")
    return spark.read.parquet(*whole)


def scores(spark: SparkSession, path: str) -> DataFrame:
    """One row per scored item: the body's columns, index and prediction."""
    return _rows(spark, path, "score").drop("error", "total_processed")


def errors(spark: SparkSession, path: str) -> DataFrame:
    """One row per refused item: the body's columns, index and error."""
    return _rows(spark, path, "error").drop("prediction", "total_processed")


def totals(spark: SparkSession, path: str) -> DataFrame:
    """One row per body: its columns, its error if it was refused as a whole, else how many items it had.

    Every body has one row that carries its total: its only row, or that of its first item.
    """
    return _rows(spark, path, *_KINDS).filter("index IS NULL OR index = 0").withColumn(
        "error", F.when(F.col("index").isNull(), F.col("error"))).drop("index", "prediction")
