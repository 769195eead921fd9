"""Exact deduplication against a persistent digest index.

The index is a parquet table of one row per text ever kept, bucketed and sorted by
the digest. A batch is first reduced to one row per digest (map-side), dealt to the
buckets, and joined with the index by sort-merge anti-join: the index is read in
place, without a shuffle, so a batch costs what the batch weighs. What remains is
appended bucket by bucket.

Texts are equal when they are identical after lower-casing A to Z. Null counts as
empty. Of a batch's equal texts the row with the largest id stays; among rows with
one id (or with null ids, which rank lowest) a row number fixed at reading decides.
A text the index holds already is dropped whole: the row that entered first stays.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsentry.llm.text import col, documents, lower_az
from logsentry.session import pin, scratch_path
from logsentry.sources import folders

MERGE = 4  # files of a bucket
HOT = 1000  # shares of all rows: a group above one share is joined without a shuffle
CUT_SAMPLE = 1000  # keys looked at to cut a table into increments


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(lower_az(F.coalesce(text, F.lit(""))).cast("binary"), 256))


def digests(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, digest, rid) of every row, written once: ``rid`` tells repeated rows apart and must not change."""
    made = df.select(col(key).alias("key"), digest(col(text)).alias("digest"))
    return pin(made.withColumn("rid", F.monotonically_increasing_id()), "digests")


class DigestIndex:
    """A digest index at ``path``; opened if it exists, else made with ``buckets`` buckets for keys of ``key_type``.

    One row per kept text: digest, key (id of the row that stays) and rid. A small file beside the rows says how many
    buckets there are, the type of the keys and which folder is the live one, so that any session opens it as it was
    made; another count or type is refused. The rows are a folder of bucket files; each batch adds one file per bucket, and once
    a bucket has ``MERGE`` files on average all are merged into a new folder, sorted again, which the small file then names.
    """

    def __init__(self, spark: SparkSession, path: str, key_type: str | None = None, buckets: int | None = None) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        made = json.dumps({"buckets": buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), "key": key_type or "bigint"})
        folders.publish(spark, f"{self.path}/index.json", made)
        told = json.loads(folders.read_text(spark, f"{self.path}/index.json"))
        self.buckets, self.key_type = told["buckets"], told["key"]
        if buckets not in (None, self.buckets) or key_type not in (None, self.key_type):
            raise ValueError(f"the index has {self.buckets} buckets and keys of type {self.key_type}")
        live = [n for n in folders.names(spark, f"{self.path}/live") if n[0] != "."]
        self._open(int(live[-1]) if live else 0)

    def _open(self, generation: int) -> None:
        self.generation, self.folder = generation, f"{self.path}/rows-{generation:06d}"
        self.table = "digests_" + hashlib.sha256(self.folder.encode()).hexdigest()[:16]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, key {self.key_type}, rid BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.folder}'"
        )

    def unseen(self, batch: DataFrame) -> DataFrame:
        """One row per digest of the batch that the index lacks: the row with the largest key.

        The reduced batch is written first: read back it has no partitioning of its own, so it is the side that is
        dealt to the buckets, and the index stays where it is.
        """
        best = batch.groupBy("digest").agg(F.max(F.struct("key", "rid")).alias("best"))
        new = pin(best.select("digest", "best.key", "best.rid"), "batch")
        known = self.spark.table(self.table).select("digest").hint("merge")
        return new.join(known, "digest", "left_anti")

    def ingest(self, batch: DataFrame) -> None:
        """Append the batch's new texts; the rows of ``batch`` are (key, digest, rid)."""
        self.unseen(batch).select("digest", "key", "rid").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)
        if len(self.spark.table(self.table).inputFiles()) > MERGE * self.buckets:
            self.merge()

    def merge(self) -> None:
        """Write one sorted file per bucket into a new folder and make it the live one; the old folder goes."""
        rows, old, old_table = self.spark.table(self.table), self.folder, self.table
        self._open(self.generation + 1)
        # Grouped by the unique digest, the old buckets are read each by one task, without a shuffle.
        whole = rows.groupBy("digest").agg(F.first(F.struct("key", "rid")).alias("row"))
        whole.select("digest", "row.key", "row.rid").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)
        folders.publish(self.spark, f"{self.path}/live/{self.generation:06d}", "")
        self.spark.sql(f"DROP TABLE {old_table}")
        folders.remove(self.spark, old)

    def rows(self) -> DataFrame:
        """The index as plain files: joins with it may split a hot digest, which buckets forbid."""
        return self.spark.read.schema(f"digest binary, key {self.key_type}, rid bigint").parquet(self.folder)


def _cuts(made: DataFrame, batches: int) -> list:
    """Keys that cut the table into about equal ranges, highest first: any keys will do, so they come from a bounded sample."""
    rows = max(made.count(), 1)
    keys = made.select("key").filter("key IS NOT NULL").sample(min(1.0, CUT_SAMPLE / rows), seed=5).limit(2 * CUT_SAMPLE).orderBy("key").collect()
    return sorted({keys[len(keys) * i // batches][0] for i in range(1, batches)}, reverse=True) if keys else []


def resolve(batch: DataFrame, index: DigestIndex) -> DataFrame:
    """Every row of ``batch`` (key, digest, rid) with keep_id, group_size (its equals in ``batch``) and kept.

    Groups are counted map-side. Those with more than one in ``HOT`` of all rows, at most ``HOT`` of them, are sent to the rows; so
    no task of the join by digest gets more than that share of the rows in one group, even where a third of all rows are one text.
    """
    counts = batch.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    known = index.rows().withColumnsRenamed({"key": "keep_id", "rid": "keep_rid"})
    groups = pin(counts.join(known, "digest"), "groups")
    large = F.col("group_size") > max(batch.count() // HOT, 1)
    hot = F.broadcast(groups.filter(large))
    met = batch.join(hot, "digest").unionByName(
        batch.join(hot.select("digest"), "digest", "left_anti").join(groups.filter(~large), "digest"))
    return met.select("key", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "digest")


def exact_dedup(
    df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, batches: int = 2
) -> DataFrame:
    """Deduplicate a table through an index, as ``batches`` increments in falling order of the key.

    Taking larger keys first makes the index keep the largest key of the whole table. Keys are of any type with an order.
    ``path`` names a lasting index; without it a fresh one is made in the shared folder.
    Returns one row per input row: key (under its own name), keep_id, group_size, kept, digest.
    An empty table gives an empty result.
    """
    spark = df.sparkSession
    made = digests(df, key, text)
    index = DigestIndex(spark, path or scratch_path(spark, "digest-index"), made.schema["key"].dataType.simpleString())
    cuts = _cuts(made, batches) if batches > 1 else []
    above = F.lit(True)
    for cut in cuts:
        index.ingest(made.filter(above & (F.col("key") > cut)))
        above = F.col("key") <= cut
    index.ingest(made.filter(above | F.col("key").isNull()) if cuts else made)
    return resolve(made, index).withColumnRenamed("key", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays for its text."""
    return exact_dedup(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


ORACLE = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
    AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
