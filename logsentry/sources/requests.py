"""Scoring requests as JSON text, kept as VARIANT because items mix types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_bodies(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """(body) from text files: one request per line, or one per file."""
    return spark.read.text(path, wholetext=one_per_file).withColumnRenamed("value", "body")


def parse_body(bodies: DataFrame) -> DataFrame:
    """Add ``request`` (VARIANT, NULL where the text is not JSON).

    The value passes through ``explode`` of a one-element array: filters on anything
    derived from it then stay above this step, and each body is parsed once.
    """
    return bodies.withColumn("request", F.explode(F.array(F.try_parse_json("body"))))


def batch_items(bodies: DataFrame) -> DataFrame:
    """One row per item of ``{"data": [...]}``, with its ``index``; map-only.

    Bodies without a data list yield no items; see ``validate.body_errors``.
    """
    items = F.expr("try_variant_get(try_parse_json(body), '$.data', 'array<variant>')")
    return bodies.select("*", F.posexplode(items).alias("index", "item")).drop("body")
