"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a lookup table may hold and still be sent to every executor. Tables are
# counted before they are hinted; above this the join is left to AQE.
BROADCAST_ROWS = 1_000_000
# And the bytes its files may have: rows can hold texts and arrays.
BROADCAST_BYTES = 64 << 20

# Estimates from here on stand for tables that Spark knows no size of: rows given by the driver.
_UNKNOWN = 1 << 60

# Spark deletes the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: dict[str, int] = {}  # tables this process pinned, in order, with the thread that did


def build_session(app: str = "logsentry", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; the cluster's own settings win elsewhere."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Recording a Python stack for every column call makes plan building several times slower.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster that
    folder would vanish with the machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        named = tempfile.mkdtemp(prefix="logsentry-")
        spark.conf.set("spark.checkpoint.dir", named)
    if sc.getCheckpointDir() is None:  # the trees cut their lineage there
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder, grouped by application so it can be swept later."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/logsentry/{app}/{tag}-{uuid.uuid4().hex[:12]}"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run meanwhile delete their shuffle files when they end. The session's own setting then holds again."""
    before = spark.conf.get(_FILE_CLEANUP, None)
    spark.conf.set(_FILE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FILE_CLEANUP)
        else:
            spark.conf.set(_FILE_CLEANUP, before)


def pin(df: DataFrame, tag: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    The columnar copy survives lost executors, lets every later branch read only
    the columns it needs, and freezes values such as range-partition numbers that
    must not change between two evaluations. What was shuffled to make it is deleted.
    """
    spark = df.sparkSession
    if path is None:
        path = scratch_path(spark, tag)
        _written[path] = threading.get_ident()
    with _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written(here: bool = False) -> list[str]:
    """Paths of the scratch tables this process, or ``here`` this thread, pinned so far and has not dropped."""
    return [path for path, thread in _written.items() if not here or thread == threading.get_ident()]


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that nothing needs any more."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        del _written[name]


def release(spark: SparkSession) -> None:
    """Delete the tables this application pinned. Call when none of them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/logsentry/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _written.clear()


def planned_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a table's size; for a pinned table and a choice of its columns, from the sizes of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint ``df`` for broadcast only after finding that it stays within ``max_rows`` and ``max_bytes``.

    Meant for pinned tables, whose count is read from parquet footers and whose size from their files. A larger
    table comes back unhinted and joins by shuffle, where AQE splits skewed keys.
    """
    size = planned_bytes(df)
    fits = size <= max_bytes or size >= _UNKNOWN
    return F.broadcast(df) if fits and df.count() <= max_rows else df


def one_row(aggregated: DataFrame) -> Column:
    """The columns of a one-row aggregate as a struct value usable in any expression."""
    return aggregated.select(F.struct(*aggregated.columns)).scalar()
