"""Balanced label propagation: documents move to the shards of their links under quotas.

Documents with equal texts are linked. A group is never spelled out as pairs, and its rows, all of one size, are
interchangeable: propagation sees of a group how many of its rows each shard holds (its cells, an aggregation that is
reduced map-side), and rows get their shards from the cells at the end.

* Linked documents start in a shard by the hash of their row. In rounds, every split group asks to move rows to the
  shard where most of its links come together, counted with what that shard has room for: one that holds some of
  the group, or the emptiest. A shard is open to a group if its room takes one of its documents. Rows also leave a
  cell larger than the one they go to, where that brings more links together. Requests are admitted up to the room.
* In every second round each split group asks for the shard that holds most of it, full or not (ties by a hash that
  changes with the round), and a request from a to b is granted up to what b asks to send to a, so both keep their
  sizes, plus b's share of its free room.
* A group only changes if more of its links are then inside shards, so the rounds come to an end: when neither kind of
  round grants a request. Requests are admitted in order by running sums over ranges, the cells of one group together.
* Documents without links then fill the shards up to equal bytes: first those over ``LARGE`` of a shard, then the rest,
  each by a running sum against the room left. So sizes differ by little more than a document.
* A document's slot is its place among its shard's rows, from one global order.

Only tables with one row per shard or pair of shards reach the driver. Null texts count as empty, and equal to empty
ones; empty texts have size 1. Rows that repeat a key are rows of their own. An empty table gives an empty result.
Links are counted as bigint, so a group may have three billion rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsentry.llm.text import col, documents
from logsentry.operators.order import global_index, prefix_sum
from logsentry.session import broadcast_if_small, pin

SHARDS = 16
LARGE = 0.02  # of a shard's bytes; larger documents are placed before the smaller ones even the sizes out


def sized(df: DataFrame, key: str, text: str) -> DataFrame:
    """(rid, key, size, text_crc32, digest) of every row, written once."""
    value = F.coalesce(col(text), F.lit(""))
    return pin(df.select(
        F.monotonically_increasing_id().alias("rid"), col(key).alias("key"),
        (F.octet_length(value) + 1).cast("long").alias("size"), F.crc32(value.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(value.cast("binary"), 256)).alias("digest")), "sized")


def _loads(rows: DataFrame, shards: int, by: str = "shard", of: str = "size") -> list[int]:
    found = {r[0]: r[1] for r in rows.groupBy(by).agg(F.sum(of)).collect()}  # one row per shard
    return [int(found.get(s) or 0) for s in range(shards)]


def _lookup(values: list, place: Column, kind: str = "bigint") -> Column:
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), (place + 1).cast("int"))


def quotas(asked: dict[tuple[int, int], int], loads: list[int], capacity: float) -> dict[tuple[int, int], int]:
    """Bytes that may move from a to b: as many as come back, and b's free room in proportion to what is asked beyond that."""
    swapped = {(a, b): min(n, asked.get((b, a), 0)) for (a, b), n in asked.items()}
    beyond: dict[int, int] = {}
    for (_, b), n in asked.items():
        beyond[b] = beyond.get(b, 0) + n
    for (_, b), n in swapped.items():
        beyond[b] -= n
    room = {b: max(0.0, capacity - loads[b]) for b in beyond}
    return {
        (a, b): swapped[a, b] + int((n - swapped[a, b]) * min(1.0, room[b] / beyond[b]) if beyond[b] else 0)
        for (a, b), n in asked.items()
    }


def _links(cells: Column) -> Column:
    """Twice the links inside shards, and the rows."""
    return F.aggregate(cells, F.lit(0).cast("bigint"), lambda sum_, c: sum_ + c["n"] * c["n"])


def _rows_in(cells: Column) -> Column:
    return F.aggregate(cells, F.lit(0).cast("bigint"), lambda sum_, c: sum_ + c["n"])


def _plan(cells: Column, to: Column, most: Column) -> Column:
    """The moves (n, shard) of up to ``most`` rows to a shard, smallest cells first, and the links they gain."""
    start = F.struct(
        F.greatest(F.lit(0).cast("bigint"), most).alias("left"), F.lit(0).cast("bigint").alias("moved"), F.lit(0).cast("bigint").alias("lost"),
        F.array().cast("array<struct<n:bigint,shard:int>>").alias("moves"))

    def take(done: Column, cell: Column) -> Column:
        n = F.least(done["left"], cell["n"])
        return F.struct(
            (done["left"] - n).alias("left"), (done["moved"] + n).alias("moved"), (done["lost"] + n * (2 * cell["n"] - n)).alias("lost"),
            F.when(n > 0, F.concat(done["moves"], F.array(F.struct(n.alias("n"), cell["shard"].alias("shard")))))
            .otherwise(done["moves"]).alias("moves"))

    held = _rows_in(F.filter(cells, lambda c: c["shard"] == to))
    return F.aggregate(F.array_sort(F.filter(cells, lambda c: c["shard"] != to)), start, take, lambda done: F.struct(
        (done["moved"] * (2 * held + done["moved"]) - done["lost"]).alias("gain"), held.alias("held"), to.alias("to"), done["moves"].alias("moves")))


def _wish_for_room(room: list[int]) -> Column:
    """The plan that gains most links by what the shards have room for."""
    size, emptiest = F.col("size"), room.index(max(room))
    shards = F.array_distinct(F.concat(F.transform("cells", lambda c: c["shard"]), F.array(F.lit(emptiest))))
    return F.array_max(F.transform(shards, lambda s: _plan(F.col("cells"), s, F.floor(_lookup(room, s) / size))))


def _wish_for_swap(salt: int) -> Column:
    """All other rows to the shard that holds most."""
    tied = F.transform("cells", lambda c: F.struct(
        c["n"].alias("n"), F.xxhash64(F.col("digest"), c["shard"], F.lit(salt)).alias("tie"), c["shard"].alias("shard")))
    return _plan(F.col("cells"), F.array_max(tied)["shard"], _rows_in(F.col("cells")))


def _round(groups: DataFrame, loads: list[int], capacity: float, salt: int | None) -> tuple[DataFrame, bool]:
    """One round over groups (digest, size, cells), for room or, with ``salt``, for swaps; false if nothing moved."""
    shards = len(loads)
    room = [max(0, int(capacity) - load) for load in loads]
    wish = _wish_for_room(room) if salt is None else _wish_for_swap(salt)
    wished = groups.withColumn("wish", F.when(F.size("cells") > 1, wish))
    wished = pin(wished.withColumn("wish", F.when(F.col("wish.gain") > 0, F.col("wish"))), "wishes")
    asking = wished.filter("wish IS NOT NULL").select(
        "digest", "size", F.col("wish.to").alias("to"), (-F.col("wish.gain")).alias("loss"), F.posexplode("wish.moves").alias("i", "move"))
    asking = asking.select("*", "move.*", (F.col("move.n") * F.col("size")).alias("bytes"))
    asked = {(r[0], r[1]): r[2] for r in asking.groupBy("shard", "to").agg(F.sum("bytes")).collect()}  # per pair of shards
    if not asked:
        return groups, False
    if salt is None:  # all that go to a shard share its room
        lane, quota = F.col("to"), room
        wanted = [sum(n for (_, b), n in asked.items() if b == s) for s in range(shards)]
    else:  # what a shard holds beyond its capacity, from swaps of unequal documents, goes back
        lane, granted = F.col("shard") * shards + F.col("to"), quotas(asked, loads, capacity)
        pairs = [divmod(p, shards) for p in range(shards * shards)]
        quota = [max(0, granted.get((a, b), 0) - max(0, loads[b] - int(capacity))) for a, b in pairs]
        wanted = [asked.get(p, 0) for p in pairs]
    start = [sum(wanted[:k]) for k in range(len(wanted))]
    run = prefix_sum(asking.withColumn("lane", lane), ["lane", "loss", "digest", "i"], ["bytes"], "requests")
    # A request is granted as far as it stays within the quota of its lane, so no shard grows beyond what was allowed.
    left = _lookup(quota, F.col("lane")) - (F.col("cum_bytes") - F.col("bytes") - _lookup(start, F.col("lane")))
    n = F.least(F.col("n"), F.floor(left / F.col("size")))
    admitted = run.withColumn("n", n).filter("n > 0").groupBy("digest").agg(F.collect_list(F.struct("n", "shard")).alias("gone"))
    to = F.col("wish.to")
    after = F.transform(F.array_union(F.transform("cells", lambda c: c["shard"]), F.array(to)), lambda s: F.struct((
        _rows_in(F.filter("cells", lambda c: c["shard"] == s)) - _rows_in(F.filter("gone", lambda c: c["shard"] == s))
        + F.when(s == to, _rows_in(F.col("gone"))).otherwise(0)).alias("n"), s.alias("shard")))
    moved = wished.join(admitted, "digest", "left").withColumn("after", F.when(
        F.col("gone").isNotNull(), F.filter(after, lambda c: c["n"] > 0)))
    better = F.coalesce(_links(F.col("after")) > _links(F.col("cells")), F.lit(False))
    moved = pin(moved.select("digest", "size", F.when(better, F.col("after")).otherwise(F.col("cells")).alias("cells"),
                             better.alias("moved")), "groups")
    return moved.drop("moved"), not moved.filter("moved").isEmpty()


def _group_loads(groups: DataFrame, shards: int) -> list[int]:
    each = groups.select("size", F.explode("cells").alias("c"))
    return _loads(each.select("c.shard", (F.col("size") * F.col("c.n")).alias("size")), shards)


def propagate(linked: DataFrame, shards: int = SHARDS, capacity: float | None = None, rounds: int | None = None) -> DataFrame:
    """A shard for every row of ``linked`` (rid, size, digest); rows with one digest are neighbours and have one size.

    ``capacity`` bounds what moves may fill a shard with, in bytes; an even share if not given. Rounds go on until none
    grants a request, or for ``rounds`` rounds.
    """
    start = F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int").alias("shard")
    cells = linked.groupBy("digest", "size", start).agg(F.count(F.lit(1)).alias("n"))
    groups = pin(cells.groupBy("digest", "size").agg(F.collect_list(F.struct("n", "shard")).alias("cells")), "groups")
    loads = _group_loads(groups, shards)
    if capacity is None:
        capacity = sum(loads) / shards
    done, swap, idle = 0, False, 0
    while idle < 2 and (rounds is None or done < rounds):
        groups, moving = _round(groups, loads, capacity, done if swap else None)
        if moving:
            loads = _group_loads(groups, shards)
        idle = 0 if moving else idle + 1
        swap = not swap
        done += 1
    indexed = global_index(linked, [F.col("digest"), F.col("rid")], "idx", "linked")
    first = indexed.groupBy("digest").agg(F.min("idx").alias("first"))
    first = broadcast_if_small(pin(groups.select("digest", "cells").join(first, "digest"), "cells"))
    place = F.struct((F.col("idx") - F.col("first")).alias("left"), F.lit(None).cast("int").alias("shard"))
    shard = F.aggregate("cells", place, lambda at, c: F.struct(
        (at["left"] - c["n"]).alias("left"),
        F.when((at["left"] >= 0) & (at["left"] < c["n"]), c["shard"]).otherwise(at["shard"]).alias("shard")))["shard"]
    return pin(indexed.join(first, "digest").select("rid", "size", "digest", shard.alias("shard")), "placed")


def _fill(rows: DataFrame, loads: list[int], shards: int) -> DataFrame:
    """Rows (rid, size) dealt to shards by running sum, so that each gets what it lacks of an even share."""
    run = prefix_sum(rows.withColumn("turn", F.xxhash64("rid")), ["turn", "rid"], ["size"], "fill")
    total = rows.agg(F.sum("size")).first()[0] or 0
    even = (total + sum(loads)) / shards
    lack = [max(0.0, even - load) for load in loads]
    scale = total / sum(lack) if sum(lack) else 0.0
    middle = F.col("cum_size") - F.col("size") / 2
    end, shard = 0.0, F.lit(shards - 1)
    bounds = []
    for s in range(shards):
        end += lack[s] * scale
        bounds.append((s, end))
    for s, bound in reversed(bounds):
        shard = F.when(middle <= bound, F.lit(s)).otherwise(shard)
    return pin(run.select("rid", shard.cast("int").alias("shard")), "filled")


def shard_documents(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """Every row with its shard: key (under its own name), size, text_crc32, shard, slot (gapless from 0 in each shard)."""
    rows = sized(df, key, text)
    groups = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("digest")
    linked = pin(rows.select("rid", "size", "digest").join(broadcast_if_small(pin(groups, "groups")), "digest"), "linked")
    even = (rows.agg(F.sum("size")).first()[0] or 0) / shards
    placed = propagate(linked, shards, even, rounds).select("rid", "shard")
    alone = pin(rows.select("rid", "size").join(placed, "rid", "left_anti"), "alone")
    parts = [placed]
    for part in (alone.filter(F.col("size") > LARGE * even), alone.filter(F.col("size") <= LARGE * even)):
        done = parts[0]
        for p in parts[1:]:
            done = done.unionByName(p)
        loads = _loads(done.join(rows.select("rid", "size"), "rid"), shards)
        parts.append(_fill(part, loads, shards))
    where = parts[0].unionByName(parts[1]).unionByName(parts[2])
    told = rows.drop("digest").join(where, "rid")
    indexed = global_index(told, [F.col("shard"), F.col("key"), F.col("rid")], "idx", "slots")
    counts = _loads(indexed.withColumn("one", F.lit(1)), shards, of="one")
    start = [sum(counts[:s]) for s in range(shards)]
    return indexed.select(F.col("key").alias(key), "size", "text_crc32", "shard",
                          (F.col("idx") - _lookup(start, F.col("shard"))).alias("slot"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard under the law of even bytes."""
    return shard_documents(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
