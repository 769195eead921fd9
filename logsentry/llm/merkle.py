"""Merkle manifest of a dataset: a content-addressed store of digests, and proofs by descent from the root.

H is the SHA-256 of its inputs put together, digests as lowercase hex. A leaf is H of a row's fields, each ``-`` if null,
else the length of its decimal or text form in UTF-8 bytes, ``:`` and that form. The leaves of a group, in the order of the
key, are reduced: every two neighbours (the last one maybe alone) become their H, until one node, the subroot, remains.
The subroots, in the order of their groups, are reduced to the root likewise.

* Build. Leaves get their rank in the group from one global order, which cuts a group of any size into ranges.
  ``LEVELS`` levels are reduced at a time: 2^LEVELS neighbours meet in one row, a bounded array, so a group of n rows takes
  log(n) / LEVELS steps. Every such segment is a record of the store: its digest, and the digests below it level by level,
  children first. Records are addressed by digest alone; equal subtrees are one record.
* Prove. Leaf requests (group, rank) descend from the root. Requests that share a node travel as one row, found by counting
  them up the ranks first; a step looks the node up by digest, and each requested child gets the path so far and the
  siblings that the digits of its rank leave unselected. Only at the last segment do requests part into rows. Their
  path segments, gathered from the top, are then turned round, so that a proof reads from the leaf to the root.
* A proof folds: each sibling goes left or right of the digest so far by a binary digit of the rank, or is missing where the
  node stood alone.

Null keys come first, rows of one key are in the order of their leaf digests (equal rows are interchangeable), the null group comes
before all others, groups are in the order of their UTF-8 bytes. An empty table has no root and no proofs. Columns besides the named
ones do not enter a leaf. The store stays in the folder it was written to; nothing but the number of levels reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsentry.llm.text import col, documents, packed
from logsentry.operators.order import global_index
from logsentry.session import broadcast_if_small, pin, scratch_path

LEVELS = 8  # levels of one record: at most 2^8 children
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<sib:string,left:boolean>>"


def digest(*parts: Column) -> Column:
    """H of its inputs."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(fields: Sequence[Column]) -> Column:
    """H of a row's fields."""
    return digest(*[F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-"))
                    for f in (c.cast("string") for c in fields)])


class Manifest(NamedTuple):
    """``store``: path of the records (digest, levels). ``root``: digest of the root, null for an empty table.

    ``ranks``: (group, n, rank, key, leaf) of every leaf, and what ``build`` carried. ``groups``: (group, place, n, subroot), in the order of ``place``.
    ``deepest``: levels of the largest group.
    """

    store: str
    root: str | None
    ranks: DataFrame
    groups: DataFrame
    deepest: int


def _depth(n: Column) -> Column:
    """Levels over n leaves."""
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1))).cast("int")


def _above(nodes: Column) -> Column:
    """The next level: every two neighbours become their H."""
    two = lambda i: digest(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit("")))
    return F.transform(F.sequence(F.lit(0), F.ceil(F.size(nodes) / 2).cast("int") - 1), two)


def _segments(nodes: DataFrame, below: int) -> DataFrame:
    """One row per segment (group, at, n, levels, digest) of nodes (group, n, at, digest) that stand ``below`` levels over the leaves.

    ``levels``: the segment's nodes level by level, its children first and the segment's own digest last.
    """
    part = nodes.groupBy("group", "n", F.shiftright("at", LEVELS).alias("at")).agg(
        F.array_sort(F.collect_list(F.struct("at", "digest"))).alias("nodes"))
    children = F.array(F.transform("nodes", lambda x: x["digest"]))
    rounds = F.least(_depth(F.col("n")) - below, F.lit(LEVELS))
    levels = F.when(rounds <= 0, children).otherwise(F.reduce(
        F.sequence(F.lit(1), F.greatest(rounds, F.lit(1))), children,
        lambda made, _: F.concat(made, F.array(_above(F.element_at(made, -1))))))
    made = part.select("group", "at", "n", levels.alias("levels"))
    return made.withColumn("digest", F.get(F.element_at("levels", -1), 0))


def _reduced(nodes: DataFrame, deepest: int, store: str) -> DataFrame:
    """(group, n, digest) of each group's last node. The records of all segments are added to ``store``."""
    spark = nodes.sparkSession
    for below in range(0, max(deepest, 1), LEVELS):
        made = pin(_segments(nodes, below), "segments")
        records = made.filter(F.size("levels") > 1).groupBy("digest").agg(F.first("levels").alias("levels"))
        known = spark.read.parquet(store).select("digest")
        records.join(known, "digest", "left_anti").write.mode("append").parquet(store)
        nodes = made.select("group", "n", "at", "digest")
    return nodes.select("group", "n", "digest")


def build(df: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "lang", store: str | None = None,
          carry: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``df`` over ``fields``, with a subtree per ``group``.

    A ``store`` that holds records of earlier versions gains only those it lacks. ``carry`` names values of a row that ``ranks`` keeps.
    """
    spark = df.sparkSession
    store = store or scratch_path(spark, "merkle-store")
    carried = {n: v.alias(n) for n, v in (carry or {}).items()}
    made = df.select(col(group).cast("string").alias("group"), col(key).alias("key"), leaf([col(f) for f in fields]).alias("leaf"),
                     *carried.values())
    bytewise = F.hex(F.col("group").cast("binary"))
    indexed = global_index(made, [bytewise.asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("leaf")], "idx", "leaves")
    sizes = indexed.groupBy("group").agg(F.min("idx").alias("first"), F.count(F.lit(1)).alias("n"))
    # Groups in the order of their first leaves: that is the order of their names.
    placed = global_index(sizes, [F.col("first")], "place", "groups")
    same = F.col("group").eqNullSafe(F.col("g"))
    small = broadcast_if_small(placed.select(F.col("group").alias("g"), "first", "n"))
    ranks = indexed.join(small, same).select(
        "group", "n", (F.col("idx") - F.col("first")).alias("rank"), "key", "leaf", *carried)
    top = placed.agg(F.max(_depth(F.col("n"))).alias("deepest"), F.count(F.lit(1)).alias("groups")).first()
    deepest = top["deepest"] or 0
    spark.createDataFrame([], "digest string, levels array<array<string>>").write.mode("append").parquet(store)
    last = _reduced(ranks.select("group", "n", F.col("rank").alias("at"), F.col("leaf").alias("digest")), deepest, store)
    groups = pin(placed.join(broadcast_if_small(pin(last.select(F.col("group").alias("g"), "digest"), "subroots")), same).select(
        "group", "place", "n", F.col("digest").alias("subroot")), "groups")
    over = groups.select(F.lit("").alias("group"), F.lit(top["groups"]).cast("long").alias("n"), F.col("place").alias("at"),
                         F.col("subroot").alias("digest"))
    whole = _reduced(over, max(top["groups"] - 1, 0).bit_length(), store).first()
    return Manifest(store, whole["digest"] if whole else None, ranks, groups, deepest)


def _selected(levels: Column, at: Column) -> Column:
    """What the descent to child ``at`` of a segment leaves unselected, from the children up: siblings ("" where there is none) and their sides."""
    level = lambda i: F.call_function("shiftright", at, i)
    return F.transform(F.sequence(F.lit(0), F.size(levels) - 2), lambda i: F.struct(
        F.coalesce(F.get(F.get(levels, i), level(i).bitwiseXOR(F.lit(1)).cast("int")), F.lit("")).alias("sib"),
        (level(i).bitwiseAND(F.lit(1)) == 1).alias("left")))


def _down(frontier: DataFrame, wanted: DataFrame, records: DataFrame, below: int, carry: Sequence[str] = ()) -> DataFrame:
    """One step: from the nodes of ``frontier`` (group, n, at, digest, path) to those of their children that ``wanted`` (group, at) names.

    ``below`` counts the levels under the children. ``path`` is an array of segments, the one at the root first. A node
    without a record of its own here (a group that ends higher up) is its own child.
    """
    rows = frontier.withColumn("alone", _depth(F.col("n")) <= below)
    asked = wanted.select(F.col("group").alias("g"), F.col("at").alias("child"), F.shiftright("at", LEVELS).alias("parent"), *carry)
    met = rows.join(asked, F.col("group").eqNullSafe(F.col("g")) & (F.col("at") == F.col("parent"))).drop("g", "parent")
    known = records.select(F.col("digest").alias("d"), "levels")
    found = met.filter(~F.col("alone")).join(known, F.col("digest") == F.col("d"))
    within = F.col("child").bitwiseAND(F.lit((1 << LEVELS) - 1))
    passed = found.select("group", "n", F.col("child").alias("at"), F.get(F.get("levels", 0), within.cast("int")).alias("digest"),
                          F.concat("path", F.array(_selected(F.col("levels"), within))).alias("path"), *carry)
    return passed.unionByName(met.filter("alone").select("group", "n", F.col("child").alias("at"), "digest", "path", *carry))


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """(group, rank, leaf, path, request) for each request (group, rank); ``path``: siblings and their sides from the leaf to the root.

    ``request`` holds the request's own columns. The digests come from the store alone, by descent from the root. Ranks that do not exist give no row.
    """
    spark = requests.sparkSession
    records = spark.read.parquet(manifest.store)
    # A group has at most one record per 2^LEVELS leaves; requests meet it as one row.
    steps = [requests.select("group", F.col("rank").cast("long").alias("at"), packed(requests, "request"))]
    for _ in range(LEVELS, max(manifest.deepest, 1) + LEVELS, LEVELS):
        steps.append(pin(steps[-1].select("group", F.shiftright("at", LEVELS).alias("at")).distinct(), "steps"))
    # From the root to the subroots, in the order of places: a group's digits are those of its place.
    total = manifest.groups.count()
    asked = pin(steps.pop().select(F.col("group").alias("g")).distinct(), "asked")
    chosen = manifest.groups.join(broadcast_if_small(asked), F.col("group").eqNullSafe(F.col("g"))).drop("g")
    over = [chosen.select(F.lit("").alias("group"), F.col("place").alias("at"))]
    depth = max(total - 1, 0).bit_length()
    for _ in range(LEVELS, max(depth, 1), LEVELS):
        over.append(over[-1].select("group", F.shiftright("at", LEVELS).alias("at")).distinct())
    root = spark.createDataFrame([("", total, 0, manifest.root, [])] if total else [], f"group string, n long, at long, digest string, path array<{_PATH}>")
    for k in reversed(range(len(over))):
        root = _down(root, over[k], records, k * LEVELS)
    tops = pin(root.select(F.col("at").alias("place"), "digest", "path"), "tops")
    frontier = chosen.join(broadcast_if_small(tops), "place").select("group", "n", F.lit(0).cast("long").alias("at"), "digest", "path")
    for k in reversed(range(len(steps))):
        # But for the last step, one row per 2^LEVELS leaves.
        frontier = _down(frontier, steps[k], records, k * LEVELS, () if k else ["request"])
        frontier = pin(frontier, "frontier") if k else frontier
    return frontier.filter("at < n").select(
        "group", F.col("at").alias("rank"), F.col("digest").alias("leaf"), F.flatten(F.reverse("path")).alias("path"), "request")


def siblings(path: Column) -> Column:
    """A proof as one text: the siblings' digests from the leaf to the root."""
    return F.array_join(F.transform(path, lambda p: p["sib"]), "")


def fold(start: Column, path: Column) -> Column:
    """The root that ``start`` gives with the siblings of ``path``."""
    return F.reduce(path, start, lambda done, p: digest(F.when(p["left"], F.concat(p["sib"], done)).otherwise(F.concat(done, p["sib"]))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof, and whether the row, tampered with where 7 divides the CRC-32 of its id, still folds to the root."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    told = F.when(hit, F.col("n_chars").cast("long") + 1).otherwise(F.col("n_chars").cast("long"))
    manifest = build(documents(spark, sf_dir), carry={"told": leaf([told if c == "n_chars" else F.col(c) for c in FIELDS])})
    proofs = prove(manifest, manifest.ranks.select("group", "rank", F.col("key").alias("doc_id"), "told"))
    subroots = broadcast_if_small(manifest.groups.select(F.col("group").alias("g"), "subroot"))
    out = proofs.join(subroots, F.col("group").eqNullSafe(F.col("g"))).select(
        "request.doc_id", "leaf", "subroot", F.lit(manifest.root).alias("root"), F.sha2(siblings(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        fold(F.col("request.told"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
