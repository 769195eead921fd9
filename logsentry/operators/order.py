"""Operators over one global row order, without one partition.

A window without partition keys moves every row into one task. Here the order is
cut into near-equal ranges by sampling (``repartitionByRange`` on the order
columns plus a tie key, so even a single timestamp holding a third of the rows is
split), the cut is written down once, and everything positional becomes a local
position plus an offset from a table with one row per range.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logsentry.session import pin

# Rows per block: enough blocks to fill the cluster, within these bounds.
MIN_BLOCK_ROWS = 1 << 12
MAX_BLOCK_ROWS = 1 << 20
# Rows a task sorts, about, in up to as many tasks as a shuffle writes rows straight to; and in more tasks.
TASK_ROWS = 1 << 19
MAX_TASK_ROWS = 1 << 22

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def _ascending(col: str | Column) -> Column:
    return F.col(col).asc_nulls_last() if isinstance(col, str) else col


def task_count(spark: SparkSession, rows: int) -> int | None:
    """Partitions of about ``TASK_ROWS`` rows, and enough to fill the cluster; None if one task can have all rows.

    The session's number of shuffle partitions does not follow the table, and AQE merges partitions by their
    compressed bytes, of which narrow sorted rows have few: both let tasks grow with the table. With more partitions
    than Spark's bypass threshold a task that writes a shuffle holds all its rows to sort them. So that number is
    passed only where tasks would get more than ``MAX_TASK_ROWS`` rows.
    """
    if rows <= TASK_ROWS:
        return None
    sc = spark.sparkContext
    direct = int(sc.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    return max(min(-(-rows // TASK_ROWS), direct), -(-rows // MAX_TASK_ROWS), sc.defaultParallelism)


def range_parts(df: DataFrame, order: list[str | Column], tag: str = "ranges", ranges: int | None = None) -> DataFrame:
    """Rows cut into ordered ranges, with ``_part`` (range number) and ``_pos`` (place in it).

    There are as many ranges as shuffle partitions, or ``ranges`` at most.

    ``monotonically_increasing_id`` yields both after the local sort, so no second
    shuffle is needed to number rows. The result is written once: range bounds come
    from a sample and would differ if the plan were evaluated again.
    """
    keys = [_ascending(c) for c in order]
    ranged = (
        df.repartitionByRange(*([ranges] if ranges else []), *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    return pin(ranged, tag).withColumns({
        "_part": F.shiftright("_mid", _POS_BITS).cast("int"),
        "_pos": F.col("_mid").bitwiseAND(F.lit(_POS_MASK)),
    }).drop("_mid")


def _offsets(parts: DataFrame, sums: dict[str, Column]) -> tuple[dict[str, Column], dict]:
    """For a row of a range, the total of each measure over all earlier ranges; and the overall totals.

    The totals per range are the only thing collected: one row per range partition, at most the shuffle
    partition count or as ``task_count`` says. They come back
    as one array looked up by range number, so no join is planned and a branch that
    does not use the value does not read its inputs.
    """
    rows = parts.groupBy("_part").agg(*[c.alias(n) for n, c in sums.items()]).collect()
    total = {r["_part"]: r for r in rows}
    before = {n: [] for n in sums}
    running = {n: 0 for n in sums}
    for part in range(max(total, default=-1) + 1):
        for n in sums:
            before[n].append(running[n])
            running[n] += (total[part][n] or 0) if part in total else 0
    table = parts.sparkSession.createDataFrame(pa.table({n: [before[n]] for n in sums}))
    return {n: F.element_at(table.select(n).scalar(), F.col("_part") + 1) for n in sums}, running


def global_index(
    df: DataFrame, order: list[str | Column], name: str = "idx", tag: str = "index", rows: int | None = None
) -> DataFrame:
    """Add the gap-free 0-based position of each row in the global order.

    ``order`` must end in a tie key that makes it total. One range shuffle, no join.
    The row count is kept as metadata of the column, to size blocks by. ``rows``, the count of ``df`` if it is
    known or cheap, bounds the rows of a range.
    """
    parts = range_parts(df, order, tag, rows and task_count(df.sparkSession, rows))
    base, total = _offsets(parts, {"rows": F.count(F.lit(1))})
    position = (base["rows"] + F.col("_pos")).alias(name, metadata={"rows": total["rows"]})
    return parts.select(*[c for c in parts.columns if c not in ("_part", "_pos")], position)


def block_rows(indexed: DataFrame, idx: str = "idx") -> int:
    """Rows per block for an indexed table: many blocks per shuffle partition, so hashing spreads them evenly."""
    rows = indexed.schema[idx].metadata.get("rows", 0)
    partitions = int(indexed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(rows // (16 * partitions), MIN_BLOCK_ROWS), MAX_BLOCK_ROWS)


def prefix_sum(df: DataFrame, order: list[str | Column], cols: list[str], tag: str = "prefix") -> DataFrame:
    """Add ``cum_<c>`` for each column: its inclusive running sum over the global order.

    ``_part`` and ``_pos`` are kept for neighbour look-ups across ranges.
    """
    parts = range_parts(df, order, tag)
    base, _ = _offsets(parts, {c: F.sum(c) for c in cols})
    so_far = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    return parts.withColumns({f"cum_{c}": base[c] + F.sum(c).over(so_far) for c in cols})


def next_value(df: DataFrame, cols: list[str]) -> DataFrame:
    """Add ``next_<c>``: the column's value on the following row, NULL on the last.

    For rows that carry ``_part`` and ``_pos``. The last row of a range looks into
    a table of the ranges' first rows.
    """
    inside = Window.partitionBy("_part").orderBy("_pos")
    firsts = df.groupBy("_part").agg(F.min_by(F.struct(*cols), "_pos").alias("_first"))
    # One row per range: bounded by the shuffle partition count.
    after = firsts.select(
        F.col("_part").alias("_range"), F.lead("_first").over(Window.orderBy("_part")).alias("_after")
    )
    return df.join(F.broadcast(after), df["_part"] == after["_range"]).withColumns({
        f"next_{c}": F.coalesce(F.lead(c).over(inside), F.col(f"_after.{c}")) for c in cols
    }).drop("_after", "_range")


def blocked(df: DataFrame, halo: int, block: int, idx: str = "idx") -> DataFrame:
    """Cut indexed rows into blocks of ``block`` rows with a ``halo`` of earlier rows.

    Adds ``_blk`` and ``_halo``. A frame reaching back at most ``halo`` rows gives
    the same value inside ``Window.partitionBy("_blk").orderBy(idx)`` as over the
    whole table. Blocks hold the same number of rows, so there is no skew. Halo
    rows must be dropped after the window.
    """
    if block < max(halo, 1):
        raise ValueError(f"block of {block} rows is smaller than the halo of {halo}")
    home = F.expr(f"{idx} div {block}")
    in_tail = F.col(idx) % block >= block - halo
    return df.withColumn(
        "_blk", F.explode(F.when(in_tail, F.array(home, home + 1)).otherwise(F.array(home)))
    ).withColumn("_halo", F.col("_blk") != home)


def carried(
    df: DataFrame, key: str, value: str, block: int, idx: str = "idx", seed: DataFrame | None = None
) -> DataFrame:
    """For each block and key, the key's last ``value`` (nulls skipped) in the nearest earlier block holding the key.

    ``value`` must not fall along the index (as a timestamp the index sorts by). The
    grid has at most blocks x keys rows, pre-aggregated on the map side. ``seed``
    (key, value) stands for everything before the first block.
    """
    grid = df.groupBy(F.expr(f"{idx} div {block}").alias("_blk"), key).agg(F.max(value).alias(value))
    if seed is not None:
        grid = grid.unionByName(seed.select(F.lit(-1).cast("long").alias("_blk"), key, value))
    earlier = Window.partitionBy(key).orderBy("_blk")
    return grid.withColumn(value, F.lag(value).over(earlier)).filter(F.col(value).isNotNull())
