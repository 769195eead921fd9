"""Ordered feature engineering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logsentry.functions.calendar import create_time_features
from logsentry.operators.encode import apply_encoders, fit_encoders
from logsentry.operators.order import TASK_ROWS, block_rows, blocked, carried, global_index, task_count
from logsentry.sources.schemas import (
    CATEGORICAL_COLUMNS, FEATURE_COLUMNS, LAGS, ROLLING_WINDOW, TARGET,
)


def load_and_preprocess(raw: DataFrame, tie: str, ts: str = "Timestamp") -> DataFrame:
    """Parse the time column if it is text (a bad value raises) and add ``idx`` in time order.

    Rows without a time come last. ``tie`` orders rows with equal times.
    """
    if dict(raw.dtypes)[ts] == "string":
        raw = raw.withColumn(ts, F.col(ts).cast("timestamp_ntz"))
    return global_index(raw, [ts, tie], rows=raw.count())


def require_rows(df: DataFrame) -> DataFrame:
    """Raise on an empty table; reads at most one row."""
    if df.isEmpty():
        raise ValueError("the log table has no rows")
    return df


def create_ordered_features(
    df: DataFrame,
    window: int | None = ROLLING_WINDOW,
    lags: list[int] | None = None,
    since: str | None = "Request_Type",
    value: str = "Payload_Size",
    ts: str = "Timestamp",
    fit_on: DataFrame | None = None,
    block: int | None = None,
    last_seen: DataFrame | None = None,
) -> DataFrame:
    """Rolling, lag and time-since features of indexed rows in one exchange.

    Every window partitions by the block number, so rows move once. The last time
    of each key in earlier blocks is added as extra rows in front of the block,
    not joined to the log: a few hot keys cost nothing. Lag gaps take the mean of
    ``fit_on`` (the whole table by default). ``block`` follows the table size unless given.
    Where the index knows the table's length there are tasks for it (``task_count``); blocks
    are small beside a task, so that hashing them spreads the rows evenly.
    """
    lags = LAGS if lags is None else lags
    halo = max([(window or 1) - 1, *lags, 0])
    block = block or max(min(block_rows(df), TASK_ROWS // 32), halo)
    rows = blocked(df, halo, block)
    if since:
        carry = carried(df, since, ts, block, seed=last_seen).select(
            "_blk", since, ts,
            (F.col("_blk") * block - halo - 1).alias("idx"),
            F.lit(True).alias("_halo"),
        )
        rows = rows.unionByName(carry, allowMissingColumns=True)

    # One exchange by block serves the windows by (block) and by (block, key).
    tasks = task_count(df.sparkSession, df.schema["idx"].metadata.get("rows", 0))
    rows = rows.repartition(*([tasks] if tasks else []), "_blk")
    ordered = Window.partitionBy("_blk").orderBy("idx")
    added = {}
    if window:
        frame = ordered.rowsBetween(-(window - 1), 0)
        added["payload_rolling_mean"] = F.avg(value).over(frame)
        added["payload_rolling_std"] = F.coalesce(F.stddev_samp(value).over(frame), F.lit(0.0))
    if lags:
        mean = (fit_on if fit_on is not None else df).agg(F.avg(value).alias("mean")).scalar()
        for n in lags:
            added[f"payload_lag_{n}"] = F.coalesce(F.lag(value, n).over(ordered).cast("double"), mean)
    if since:
        same_key = Window.partitionBy("_blk", since).orderBy("idx")
        gap = F.timestamp_diff("MICROSECOND", F.lag(ts).over(same_key), F.col(ts)) / F.lit(1e6)
        added["time_since_last"] = F.when(F.col(since).isNull(), F.lit(0.0)).otherwise(F.coalesce(gap, F.lit(0.0)))
    # Carry rows sort in front of the halo: frames over the block never reach them, and
    # a key's halo row, being later, is seen before its carry row.
    return rows.withColumns(added).filter(~F.col("_halo")).drop("_blk", "_halo")


def create_rolling_features(df: DataFrame, window_size: int = ROLLING_WINDOW, block: int | None = None) -> DataFrame:
    """Mean and sample standard deviation over the last ``window_size`` rows; a single row has deviation 0."""
    return create_ordered_features(df, window=window_size, lags=[], since=None, block=block)


def create_lag_features(
    df: DataFrame, lag_values: list[int], fit_on: DataFrame | None = None, block: int | None = None
) -> DataFrame:
    """The payload n rows back; gaps and missing values take the column mean."""
    return create_ordered_features(df, window=None, lags=lag_values, since=None, fit_on=fit_on, block=block)


def create_time_since_features(
    df: DataFrame, key: str = "Request_Type", block: int | None = None, last_seen: DataFrame | None = None
) -> DataFrame:
    """Seconds since the previous row of the same key; 0 on its first row and where the key is missing.

    For a log that arrives in increments, ``last_seen`` (key, time) holds each key's
    last time so far: no earlier row is read again, and no key is sorted in one task.
    """
    return create_ordered_features(df, window=None, lags=[], since=key, block=block, last_seen=last_seen)


def update_last_seen(
    increment: DataFrame, last_seen: DataFrame | None = None, key: str = "Request_Type", ts: str = "Timestamp"
) -> DataFrame:
    """Each key's last time after an increment, to hand to the next one."""
    seen = increment.groupBy(key).agg(F.max(ts).alias(ts))
    if last_seen is not None:
        seen = seen.unionByName(last_seen).groupBy(key).agg(F.max(ts).alias(ts))
    return seen


def create_feature_matrix(df: DataFrame, columns: list[str] | None = None, target: str = TARGET) -> DataFrame:
    """Position, feature columns and target; a missing column raises at plan time."""
    return df.select("idx", *(columns or FEATURE_COLUMNS), target)


def build_features(logs: DataFrame, tie: str = "log_id", block: int | None = None) -> tuple[DataFrame, DataFrame]:
    """All features of a raw log, and the fitted category codes."""
    indexed = load_and_preprocess(logs, tie)
    mapping = fit_encoders(indexed, CATEGORICAL_COLUMNS)
    enriched = create_ordered_features(create_time_features(indexed), block=block)
    return apply_encoders(enriched, mapping, CATEGORICAL_COLUMNS), mapping
