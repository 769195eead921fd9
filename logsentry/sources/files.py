"""Reading and writing tables: CSV, JSON, parquet, versioned datasets."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType

from logsentry.operators.quality import check_schema
from logsentry.sources import folders
from logsentry.sources.schemas import RAW_LOG

# Fixed value: how times are written in text files.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"

# Folder of the files that say which versions are whole; readers of the tables skip names with an underscore.
_POINTERS = "_whole"


def read_csv(spark: SparkSession, path: str, schema: StructType = RAW_LOG, dates: list[str] | None = None) -> DataFrame:
    """Header CSV with a declared schema, so no pass is spent on inference. ``dates`` are read as times."""
    dates = dates or []
    typed = StructType([StructField(f.name, TimestampNTZType() if f.name in dates else f.dataType) for f in schema])
    return spark.read.schema(typed).option("header", True).option("enforceSchema", False).option(
        "timestampNTZFormat", TIME_FORMAT).csv(path)


def read_csv_folder(
    spark: SparkSession, folder: str, schema: StructType | None = None,
    n_columns: int | None = None, required: list[str] | None = None,
) -> DataFrame:
    """All CSV parts of a folder as one table, checked for column count and names."""
    reader = spark.read.option("header", True)
    df = reader.schema(schema).csv(folder) if schema else reader.option("inferSchema", True).csv(folder)
    return check_schema(df, n_columns, required)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("timestampNTZFormat", TIME_FORMAT).csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", by: list[str] | None = None) -> None:
    df.write.mode(mode).partitionBy(*(by or [])).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def new_version() -> str:
    """Names sort in time order."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H.%M.%S.%fZ")


def save_version(df: DataFrame, path: str, version: str | None = None, keep: int | None = None) -> str:
    """Write a new version beside the earlier ones; it counts from the moment its pointer file appears.

    The rows are written first, then counted, then the pointer (a small file of the version's name and rows) is put in place by
    rename: a save that dies on the way leaves a folder nobody reads. ``keep`` deletes all but the newest so many versions,
    pointers first, and folders of broken saves that are older than the newest whole version.
    """
    spark = df.sparkSession
    version = version or new_version()
    folder = f"{path}/version={version}"
    if version in versions(spark, path):
        raise ValueError(f"version {version} exists")
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(folder)
    rows, stored = counted.get["rows"], spark.read.parquet(folder).count()
    if stored != rows:
        raise OSError(f"version {version}: {rows} rows were written, {stored} are there")
    if not publish_version(spark, path, version, {"rows": rows}):
        raise ValueError(f"version {version} exists")
    if keep is not None:
        expire_versions(spark, path, keep)
    return version


def pointer(path: str, version: str) -> str:
    """The small file that makes a version whole."""
    return f"{path}/{_POINTERS}/{version}.json"


def publish_version(spark: SparkSession, path: str, version: str, told: dict) -> bool:
    """Make a written version whole, with what is told of it; False if it is already."""
    return folders.publish(spark, pointer(path, version), json.dumps({"version": version, **told}))


def versions(spark: SparkSession, path: str) -> list[str]:
    """The whole versions under ``path``, oldest first."""
    return [n.removesuffix(".json") for n in folders.names(spark, f"{path}/{_POINTERS}") if n.endswith(".json") and n[0] != "."]


def expire_versions(spark: SparkSession, path: str, keep: int) -> list[str]:
    """Delete all but the newest ``keep`` (1 or more) whole versions, and broken saves older than the newest; returns their names."""
    whole = versions(spark, path)
    gone = whole[: -max(keep, 1)]
    for version in gone:  # no reader finds a version any more before its rows go
        folders.remove(spark, pointer(path, version))
    stored = [n.removeprefix("version=") for n in folders.names(spark, path) if n.startswith("version=")]
    broken = [v for v in stored if whole and v not in whole and v < whole[-1]]
    for version in {*gone, *broken}:
        folders.remove(spark, f"{path}/version={version}")
    return sorted({*gone, *broken})


def load_version(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The named version, or the newest whole one. Only pointers are listed, and only the chosen folder is read."""
    whole = versions(spark, path)
    if version is None and not whole:
        raise ValueError(f"{path} holds no versions")
    if version is not None and version not in whole:
        raise ValueError(f"no version {version} under {path}")
    return spark.read.parquet(f"{path}/version={version or whole[-1]}")


def save_encoders(mapping: DataFrame, path: str) -> None:
    """The fitted codes (column, value, code) as a parquet table."""
    mapping.write.mode("overwrite").parquet(path)


def register(df: DataFrame, name: str) -> DataFrame:
    """Make an in-memory table available to SQL under ``name``."""
    df.createOrReplaceTempView(name)
    return df
