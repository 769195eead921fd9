"""A log that grows by increments and keeps its global order, and its rolling and lag features.

The log is a folder of segments: ranges of the order that do not overlap, each with its number of rows and its first and last
key. A row knows its segment and its place in it; its position in the whole log is that place plus the rows of the segments before, a
small table. An increment sorts itself once, together with the segments' bounds, which tells each row its segment. Only segments
that receive rows are read and written again, in pieces of bounded size; later ones move by a larger offset alone, and rows behind the
end make new segments. A commit file that names the live segments is put in place by rename at the end.

Features of a row look back ``halo`` rows. With them an increment also rewrites the segments that hold the ``halo`` rows behind
those it changed, and reads the ``halo`` rows before. Lag gaps take the mean of the whole column, which every
increment changes: the gaps are kept as nulls and filled on reading, from a running sum and count in the commit.

Ties need a tie key at the end of the order. Rows without a time come last. An empty increment changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logsentry.operators.features import create_ordered_features
from logsentry.operators.order import range_parts, task_count
from logsentry.session import broadcast_if_small, pin
from logsentry.sources import folders

ROWS = 1 << 20  # rows of a segment, about


class SegmentedLog:
    """The log at ``path``, ordered by ``order``; opened if it exists. Segments hold about ``rows`` rows.

    ``value`` names the column whose rolling mean and deviation over ``window`` rows and ``lags`` are kept, if any.
    """

    def __init__(self, spark: SparkSession, path: str, order: Sequence[str], rows: int = ROWS, value: str | None = None,
                 window: int = 10, lags: Sequence[int] = (1, 5)) -> None:
        self.spark, self.path, self.order, self.rows = spark, path.rstrip("/"), list(order), rows
        self.value, self.window, self.lags = value, window, list(lags)
        self.halo = max([window - 1, *self.lags]) if value else 0

    # ---- what is there

    def _commits(self) -> list[str]:
        return [n for n in folders.names(self.spark, f"{self.path}/commits") if n.endswith(".json") and n[0] != "."]

    def _state(self) -> dict:
        """``segments``: (id, folder, rows) in order; ``sum`` and ``count`` of the value; ``version``."""
        found = self._commits()
        if not found:
            return {"version": 0, "segments": [], "sum": 0, "count": 0}
        return json.loads(folders.read_text(self.spark, f"{self.path}/commits/{found[-1]}"))

    def segments(self) -> list[tuple[int, str, int]]:
        return [tuple(s) for s in self._state()["segments"]]

    def _read(self, segments: Sequence[Sequence]) -> DataFrame:
        """The stored rows of segments, with ``_id`` and ``_pos``."""
        return self.spark.read.parquet(*[f"{self.path}/rows/{folder}/piece={i}" for i, folder, _ in segments])

    def _offsets(self, segments: Sequence[Sequence]) -> DataFrame:
        """(_id, _before, _rows): one row per segment."""
        before, total = [], 0
        for _, _, n in segments:
            before.append(total)
            total += n
        return self.spark.createDataFrame(pa.table({
            "_id": pa.array([s[0] for s in segments], pa.int64()), "_before": pa.array(before, pa.int64()),
            "_rows": pa.array([s[2] for s in segments], pa.int64())}))

    def read(self, name: str = "idx") -> DataFrame:
        """All rows with their position in the whole log, and their features."""
        state = self._state()
        if not state["segments"]:
            raise ValueError(f"{self.path} holds no rows")
        stored = self._read(state["segments"]).join(broadcast_if_small(self._offsets(state["segments"])), "_id")
        position = (F.col("_before") + F.col("_pos")).alias(name, metadata={"rows": sum(s[2] for s in state["segments"])})
        mean = state["sum"] / state["count"] if state["count"] else None
        filled = {f"payload_lag_{n}": F.coalesce(F.col(f"payload_lag_{n}"), F.lit(mean).cast("double")) for n in self.lags} if self.value else {}
        return stored.withColumns(filled).select(*[c for c in stored.columns if c not in ("_id", "_pos", "_before", "_rows")], position)

    # ---- increments

    def _placed(self, increment: DataFrame, n: int, state: dict) -> DataFrame:
        """The ``n`` rows with ``_at``: the number of their segment among the live ones; behind the last row of the log, that of a new one."""
        live = {s[0]: k for k, s in enumerate(state["segments"])}
        numbers = self.spark.createDataFrame(pa.table({"_id": pa.array(list(live), pa.int64()), "_at": pa.array(list(live.values()), pa.int64())}))
        bounds = self.spark.read.parquet(*sorted({f"{self.path}/bounds/{s[1]}" for s in state["segments"]})).join(broadcast_if_small(numbers), "_id")
        keys = lambda bound: [F.col(f"{bound}.{c}").alias(c) for c in self.order]
        firsts = bounds.select(*keys("first"), "_at", F.lit(0).alias("_turn"))
        end = bounds.filter(F.col("_at") == len(live) - 1).select(*keys("last"), (F.col("_at") + 1).alias("_at"), F.lit(2).alias("_turn"))
        marks = firsts.unionByName(end)
        rows = increment.withColumns({"_at": F.lit(None).cast("long"), "_turn": F.lit(1)})
        parts = range_parts(rows.unionByName(marks, allowMissingColumns=True), [*self.order, "_turn"], "increment", task_count(self.spark, n))
        # The last mark before a row: in its range, or in one before, of which one number per range reaches the driver.
        top = {r[0]: r[1] for r in parts.groupBy("_part").agg(F.max("_at")).collect()}
        carried, last = [], 0
        for part in range(max(top, default=-1) + 1):
            carried.append(last)
            last = max(last, top.get(part) or 0)
        table = self.spark.createDataFrame(pa.table({"_c": pa.array([carried or [0]], pa.list_(pa.int64()))}))
        so_far = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
        at = F.coalesce(F.max("_at").over(so_far), F.element_at(table.select("_c").scalar(), F.col("_part") + 1))
        return parts.withColumn("_at", at).filter("_turn = 1").select(*increment.columns, "_at")

    def add(self, increment: DataFrame) -> dict:
        """Put an increment in; returns the ids of the segments that were ``read`` and ``written``."""
        state = self._state()
        old = state["segments"]
        given = pin(increment, "given")
        n_new = given.count()
        if not n_new:
            return {"read": [], "written": []}
        if old:
            placed = pin(self._placed(given, n_new, state), "placed")
            touched = {r[0] for r in placed.select("_at").distinct().collect()}
            if len(old) in touched and old[-1][2] < self.rows // 2:  # the last segment has room
                placed = placed.withColumn("_at", F.least("_at", F.lit(len(old) - 1)))
                touched = {min(t, len(old) - 1) for t in touched}
        else:
            placed, touched = given.withColumn("_at", F.lit(0).cast("long")), {0}
        # Segments whose rows look back on what changes.
        for k in sorted(touched):
            left = self.halo
            for j in range(k + 1, len(old)):
                if left <= 0:
                    break
                touched.add(j)
                left -= old[j][2]
        again = [(k, s) for k, s in enumerate(old) if k in touched]
        rows = placed
        if again:
            numbers = self.spark.createDataFrame(pa.table({"_id": pa.array([s[0] for _, s in again], pa.int64()), "_at": pa.array([k for k, _ in again], pa.int64())}))
            before = self._read([s for _, s in again]).join(broadcast_if_small(numbers), "_id").select(*increment.columns, "_at")
            rows = placed.unionByName(before)
        total = n_new + sum(s[2] for _, s in again)
        parts = range_parts(rows, ["_at", *self.order], "pieces", max(1, -(-total // self.rows)))
        key = F.struct(*self.order)
        found = parts.groupBy("_at", "_part").agg(F.min("_pos").alias("start"), F.count(F.lit(1)).alias("n"),
                                                  F.min_by(key, "_pos").alias("first"), F.max_by(key, "_pos").alias("last"))
        cuts = pin(found, "cuts")
        pieces = cuts.select("_at", "_part", "start", "n").orderBy("_at", "_part").collect()
        version = state["version"] + 1
        folder = f"{version:012d}-{uuid.uuid4().hex[:8]}"
        ids = [(version << 24) + k for k in range(len(pieces))]
        table = self.spark.createDataFrame(pa.table({
            "_at": pa.array([p["_at"] for p in pieces], pa.int64()), "_part": pa.array([p["_part"] for p in pieces], pa.int32()),
            "_start": pa.array([p["start"] for p in pieces], pa.int64()), "_id": pa.array(ids, pa.int64())}))
        fresh = parts.join(broadcast_if_small(table), ["_at", "_part"]).withColumn("_pos", F.col("_pos") - F.col("_start")).select(
            *increment.columns, "_id", "_pos")
        by_segment: dict[int, list] = {}
        for i, p in zip(ids, pieces):
            by_segment.setdefault(p["_at"], []).append([i, folder, p["n"]])
        segments = []
        for k in range(len(old) + 1):
            segments += by_segment.get(k, [old[k]] if k < len(old) else [])
        halo: list[tuple[list, int]] = []
        if self.value:
            fresh, halo = self._with_features(fresh, segments, set(ids))
        fresh.withColumn("piece", F.col("_id")).write.partitionBy("piece").parquet(f"{self.path}/rows/{folder}")
        cuts.join(broadcast_if_small(table), ["_at", "_part"]).select("_id", "first", "last").write.parquet(f"{self.path}/bounds/{folder}")
        new = {"version": version, "segments": segments, "sum": state["sum"], "count": state["count"]}
        if self.value:
            more = given.agg(F.sum(self.value).alias("s"), F.count(self.value).alias("c")).first()
            total = more["s"] if isinstance(more["s"], int) else float(more["s"] or 0)
            new |= {"sum": state["sum"] + total, "count": state["count"] + more["c"]}
        if not folders.publish(self.spark, f"{self.path}/commits/{version:012d}.json", json.dumps(new)):
            raise RuntimeError(f"version {version} of {self.path} was committed by another writer")
        return {"read": sorted({s[0] for _, s in again} | {s[0] for s, _ in halo}), "written": ids}

    def _with_features(self, fresh: DataFrame, segments: list, ids: set[int]) -> tuple[DataFrame, list[tuple[list, int]]]:
        """The new pieces with their features, and the (segment, first place) that were read before them."""
        halo: list[tuple[list, int]] = []
        for k, s in enumerate(segments):
            if s[0] in ids and k and segments[k - 1][0] not in ids:
                left = self.halo
                for j in range(k - 1, -1, -1):
                    if left <= 0 or segments[j][0] in ids:
                        break
                    halo.append((segments[j], max(segments[j][2] - left, 0)))
                    left -= segments[j][2]
        columns = fresh.columns
        rows = fresh.withColumn("_new", F.lit(True))
        if halo:
            starts = self.spark.createDataFrame(pa.table({"_id": pa.array([s[0] for s, _ in halo], pa.int64()), "_from": pa.array([f for _, f in halo], pa.int64())}))
            tail = self._read([s for s, _ in halo]).filter(F.col("_pos") >= min(f for _, f in halo)).join(broadcast_if_small(starts), "_id")
            rows = rows.unionByName(tail.filter("_pos >= _from").select(*columns, F.lit(False).alias("_new")))
        indexed = rows.join(broadcast_if_small(self._offsets(segments)), "_id").withColumn("idx", F.col("_before") + F.col("_pos")).drop("_before", "_rows")
        indexed = indexed.withMetadata("idx", {"rows": sum(s[2] for s in segments if s[0] in ids)})  # as many tasks as they need
        # An empty table has no mean: gaps stay null.
        out = create_ordered_features(indexed, self.window, self.lags, None, self.value, fit_on=fresh.limit(0), block=max(self.rows, self.halo))
        return out.filter("_new").drop("_new", "idx"), halo

    def clean(self) -> list[str]:
        """Delete pieces that the newest commit does not name. Call when nobody reads an older state or writes."""
        state = self._state()
        live = {(s[1], f"piece={s[0]}") for s in state["segments"]}
        gone = []
        for folder in folders.names(self.spark, f"{self.path}/rows"):
            for piece in folders.names(self.spark, f"{self.path}/rows/{folder}"):
                if piece.startswith("piece=") and (folder, piece) not in live:
                    folders.remove(self.spark, f"{self.path}/rows/{folder}/{piece}")
                    gone.append(piece)
        return gone
