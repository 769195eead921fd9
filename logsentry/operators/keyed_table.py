"""A log table with unique keys that lasts: inserts, patches and deletes are kept as change files beside a base.

The table is a folder, split by a hash of the key. A change writes one folder of the rows it adds, one part per touched split, with a
version number; a deleted key is a row with a mark. Of a key's rows the one of the newest version counts. A commit file that
names the live folders is put in place by rename at the very end, so readers see all of a change or none of it, and of two writers
of one version one is told so. Splits whose changes outgrow a share of their base are folded: read, reduced and written as a new base.

Which keys exist is asked of Bloom filters first: each folder has, per split, bitmaps of 4 KB with 16 bits for a key, all of a key's
bits in one of them, so a key meets one bitmap per folder. Only the parts that may hold one of the asked keys are read.

Every change is first reduced to one row per key, map-side, so a key that makes up a third of a batch is one row. The commit also
holds, per named source, the number of its last batch: a batch that comes again changes nothing. Missing parts of a key are values
like others. Rows that a change rejects come back as tables.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsentry.operators.store import first_arrivals, merged_patches
from logsentry.session import broadcast_if_small, pin
from logsentry.sources import folders
from logsentry.sources.schemas import STORE_KEY

SPLITS = 64
SHARE = 0.5  # rows of changes, of those of the base, above which a split is folded
BITS_PER_KEY = 16
_BITMAP = 1 << 15  # bits of one bitmap, as Spark's bitmap functions have them
_PROBES = 4  # bits of a key: 15 bits each of one hash


class Conflict(RuntimeError):
    """Another writer committed first. Nothing was changed; do it again on the table as it is now."""


class KeyedTable:
    """The table at ``path``; opened if it exists, else made with ``schema``, ``key`` and ``splits``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None, key: Sequence[str] | None = None,
                 splits: int = SPLITS, share: float = SHARE) -> None:
        self.spark, self.path, self.share = spark, path.rstrip("/"), share
        if self.version() is None:
            if schema is None:
                raise ValueError(f"{path} holds no table; give a schema to make one")
            first = {"splits": splits, "key": list(key or STORE_KEY), "schema": json.loads(schema.json()), "folders": [], "sources": {}}
            folders.publish(spark, self._commit_name(0), json.dumps(first))
        state = self._state()
        self.key, self.splits = state["key"], state["splits"]
        if key is not None and list(key) != self.key:
            raise ValueError(f"the table's key is {self.key}")

    # ---- what is there

    def _commit_name(self, version: int) -> str:
        return f"{self.path}/commits/{version:012d}.json"

    def version(self) -> int | None:
        """Number of the newest commit."""
        found = [n for n in folders.names(self.spark, f"{self.path}/commits") if n.endswith(".json") and n[0] != "."]
        return int(found[-1].removesuffix(".json")) if found else None

    def _state(self) -> dict:
        return json.loads(folders.read_text(self.spark, self._commit_name(self.version()))) | {"version": self.version()}

    def schema(self, state: dict | None = None) -> T.StructType:
        return T.StructType.fromJson((state or self._state())["schema"])

    def last_batch(self, source: str) -> int | None:
        """Number of the last batch of a source that went in."""
        return self._state()["sources"].get(source)

    def _rows(self, state: dict, parts: Sequence[tuple[str, int]]) -> DataFrame:
        """The stored rows of (folder, split) parts, with ``_v`` and ``_gone``."""
        stored = T.StructType([*self.schema(state).fields, T.StructField("_v", T.LongType()), T.StructField("_gone", T.BooleanType())])
        if not parts:
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).parquet(*[f"{self.path}/rows/{name}/split={split}" for name, split in parts])

    def _newest(self, rows: DataFrame) -> DataFrame:
        """The newest row of each key, unless it says that the key is gone."""
        rest = [c for c in rows.columns if c not in self.key]
        newest = rows.groupBy(*self.key).agg(F.max_by(F.struct(*rest), "_v").alias("row")).filter("NOT row._gone")
        return newest.select(*[F.col(c) if c in self.key else F.col(f"row.{c}").alias(c) for c in rows.columns]).drop("_v", "_gone")

    def read(self) -> DataFrame:
        """All rows. Splits without changes since they were folded are read as they are."""
        state = self._state()
        names = self.schema(state).names
        plain, changed = [], []
        for split in range(self.splits):
            live = [f for f in state["folders"] if str(split) in f["parts"]]
            (plain if len(live) == 1 and live[0]["parts"][str(split)]["base"] else changed).extend((f["name"], split) for f in live)
        return self._rows(state, plain).select(*names).unionByName(self._newest(self._rows(state, changed)).select(*names))

    # ---- Bloom filters

    def _split(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.splits)).cast("int")

    def _bucket(self, buckets: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(1), *self.key), buckets).cast("int")

    def _positions(self) -> list[Column]:
        h = F.xxhash64(F.lit(2), *self.key)
        return [F.shiftrightunsigned(h, 15 * i).bitwiseAND(F.lit(_BITMAP - 1)) for i in range(_PROBES)]

    def _parts_with(self, state: dict, keys: DataFrame) -> list[tuple[str, int]]:
        """The (folder, split) parts that may hold one of ``keys``: one row per part reaches the driver."""
        live = [(int(s), f["v"], f["name"], n["buckets"]) for f in state["folders"] for s, n in f["parts"].items()]
        if not live:
            return []
        table = F.broadcast(self.spark.createDataFrame([(s, v, b) for s, v, _, b in live], "split int, _v long, buckets int"))
        asked = keys.select(self._split().alias("split"), *self.key).join(table, "split").select(
            "split", "_v", self._bucket(F.col("buckets")).alias("bucket"), F.array(*self._positions()).alias("at"))
        maps = self.spark.read.parquet(*sorted({f"{self.path}/bloom/{name}" for _, _, name, _ in live}))
        byte = lambda p: F.conv(F.hex(F.substring(F.col("bitmap"), (p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        bit = lambda p: F.call_function("shiftright", byte(p), (p % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
        found = asked.join(maps, ["split", "_v", "bucket"]).filter(F.forall("at", bit)).select("split", "_v").distinct().collect()
        name = {(s, v): n for s, v, n, _ in live}
        return sorted((name[r["split"], r["_v"]], r["split"]) for r in found)

    def find(self, keys: DataFrame) -> DataFrame:
        """The rows of the given keys."""
        return self._find(self._state(), pin(keys.select(*self.key).distinct(), "keys"))[0]

    def _find(self, state: dict, keys: DataFrame) -> tuple[DataFrame, list[tuple[str, int]]]:
        """The rows of the (unique, written) ``keys``, and the parts that were read for them."""
        parts = self._parts_with(state, keys)
        rows = self._rows(state, parts)
        return self._newest(rows.join(broadcast_if_small(self._named(keys)), self._same(), "left_semi")), parts

    def _named(self, keys: DataFrame) -> DataFrame:
        return keys.select(*[F.col(k).alias(f"_k_{k}") for k in self.key])

    def _same(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in self.key])

    # ---- commits

    def _commit(self, state: dict, changes: DataFrame, source: str | None = None, batch: int | None = None,
                schema: T.StructType | None = None, replaced: Sequence[tuple[str, int]] = (), base: bool = False) -> None:
        """Write ``changes`` (the table's columns and ``_gone``) as one folder and commit it in place of ``replaced`` parts."""
        version = state["version"] + 1
        name = f"{version:012d}-{uuid.uuid4().hex[:8]}"
        rows = changes.withColumns({"_v": F.lit(version).cast("long"), "split": self._split()}).repartition("split")
        rows.write.partitionBy("split").parquet(f"{self.path}/rows/{name}")
        counts = {}
        if any(n.startswith("split=") for n in folders.names(self.spark, f"{self.path}/rows/{name}")):  # there are rows
            stored = self.spark.read.parquet(f"{self.path}/rows/{name}")
            counts = {r["split"]: r["count"] for r in stored.groupBy("split").count().collect()}  # from the files' footers
        held = {s for f in state["folders"] for s in f["parts"]}  # inserts into splits without rows are their base
        parts = {str(s): {"rows": n, "buckets": -(-n * BITS_PER_KEY // _BITMAP), "base": base or str(s) not in held}
                 for s, n in sorted(counts.items())}
        if counts:
            table = F.broadcast(self.spark.createDataFrame([(int(s), p["buckets"]) for s, p in parts.items()], "split int, buckets int"))
            probes = stored.join(table, "split").select("split", self._bucket(F.col("buckets")).alias("bucket"), F.explode(F.array(*self._positions())).alias("at"))
            maps = probes.groupBy("split", "bucket").agg(F.bitmap_construct_agg("at").alias("bitmap"))
            maps.withColumn("_v", F.lit(version).cast("long")).write.parquet(f"{self.path}/bloom/{name}")
        gone = {(n, str(s)) for n, s in replaced}
        live = [f | {"parts": {s: p for s, p in f["parts"].items() if (f["name"], s) not in gone}} for f in state["folders"]]
        live = [f for f in live if f["parts"]] + ([{"name": name, "v": version, "parts": parts}] if parts else [])
        sources = state["sources"] | ({source: batch} if source is not None else {})
        new = {k: state[k] for k in ("splits", "key", "schema")} | {"folders": live, "sources": sources}
        if schema is not None:
            new["schema"] = json.loads(schema.json())
        if not folders.publish(self.spark, self._commit_name(version), json.dumps(new)):
            raise Conflict(f"version {version} of {self.path} was committed by another writer")

    def fold(self, share: float | None = None) -> list[int]:
        """Write a new base of the splits whose changes exceed ``share`` of their base; returns these splits. Others are not read."""
        state = self._state()
        share = self.share if share is None else share
        heavy = []
        for split in range(self.splits):
            live = [f["parts"][str(split)] for f in state["folders"] if str(split) in f["parts"]]
            changes = sum(p["rows"] for p in live if not p["base"])
            if changes and changes > share * sum(p["rows"] for p in live if p["base"]):
                heavy.append(split)
        if heavy:
            parts = [(f["name"], s) for f in state["folders"] for s in heavy if str(s) in f["parts"]]
            rows = self._newest(self._rows(state, parts)).withColumn("_gone", F.lit(False))
            self._commit(state, rows, replaced=parts, base=True)
        return heavy

    def clean(self) -> list[str]:
        """Delete folders that the newest commit does not name, and older commits. Call when nobody reads an older state or writes."""
        state = self._state()
        live = {f["name"] for f in state["folders"]}
        gone = [n for n in folders.names(self.spark, f"{self.path}/rows") if n not in live]
        for name in gone:
            folders.remove(self.spark, f"{self.path}/rows/{name}")
            folders.remove(self.spark, f"{self.path}/bloom/{name}")
        for version in range(state["version"]):
            folders.remove(self.spark, self._commit_name(version))
        return gone

    def _replayed(self, state: dict, source: str | None, batch: int | None) -> bool:
        if (source is None) != (batch is None):
            raise ValueError("a source and the number of its batch go together")
        return source is not None and batch <= state["sources"].get(source, -1)

    # ---- changes

    def insert(self, batch: DataFrame, arrival: str, source: str | None = None, number: int | None = None,
               rejects: str | None = None) -> DataFrame:
        """Add the rows whose key is new, the first arrival (by the unique column ``arrival``) of each; returns the rejected rows.

        ``number`` is that of the batch among those of ``source``: one that went in before changes nothing and rejects nothing.
        ``rejects`` names a folder the rejected rows are written to before the commit.
        """
        state = self._state()
        if self._replayed(state, source, number):
            return batch.limit(0)
        first = first_arrivals(batch, arrival, self.key)
        known, _ = self._find(state, first)
        names = self.schema(state).names
        fresh = pin(first.join(broadcast_if_small(pin(self._named(known), "known")), self._same(), "left_anti"), "accepted")
        stored = fresh.select(*[F.col(c) if c in fresh.columns else F.lit(None).cast(f.dataType).alias(c) for c, f in zip(names, self.schema(state))])
        turned_away = batch.join(fresh.select(arrival), arrival, "left_anti").select(*batch.columns)
        if rejects is not None:
            turned_away.write.mode("overwrite").parquet(rejects)
        self._commit(state, stored.withColumn("_gone", F.lit(False)), source, number)
        self.fold()
        return turned_away

    def update(self, patches: DataFrame, seq: str, supplied: str = "supplied", source: str | None = None, number: int | None = None) -> DataFrame:
        """Set the supplied fields of existing rows, later patches (by ``seq``) field by field; returns the keys not found.

        ``supplied`` lists the fields a patch sets, so a patch may set NULL. Fields new to the table are added to it.
        """
        state = self._state()
        if self._replayed(state, source, number):
            return patches.select(*self.key).limit(0)
        merged, fields = merged_patches(patches, seq, supplied, self.key)
        now, _ = self._find(state, merged)
        now = pin(now, "current")
        schema = self.schema(state)
        added = [f for f in patches.schema if f.name in fields and f.name not in schema.names]
        wide = T.StructType([*schema.fields, *[T.StructField(f.name, f.dataType) for f in added]])
        old = {f.name: (F.col(f.name) if f.name in schema.names else F.lit(None).cast(f.dataType)) for f in wide}
        joined = now.join(merged.select(*[F.col(k).alias(f"_k_{k}") for k in self.key], *[c for c in merged.columns if c not in self.key]), self._same())
        rows = joined.select(*[(F.when(F.col(f"_s_{c}"), F.col(f"_p_{c}")).otherwise(v) if c in fields else v).cast(wide[c].dataType).alias(c)
                               for c, v in old.items()])
        self._commit(state, rows.withColumn("_gone", F.lit(False)), source, number, schema=wide)
        self.fold()
        return merged.select(*self.key).join(self._named(now), self._same(), "left_anti")

    def delete(self, keys: DataFrame, source: str | None = None, number: int | None = None) -> DataFrame:
        """Remove the rows of the keys; returns the keys not found."""
        state = self._state()
        if self._replayed(state, source, number):
            return keys.select(*self.key).limit(0)
        asked = pin(keys.select(*self.key).distinct(), "delete")
        now = pin(self._find(state, asked)[0], "current")
        self._commit(state, now.withColumn("_gone", F.lit(True)), source, number)
        self.fold()
        return asked.join(self._named(now), self._same(), "left_anti")
