"""Mixing sources to target weights along a time-varying curriculum.

1. Each source's total size follows from one aggregation. The targets are the water level: every source gets
   its weight times one factor, but at most ``epochs`` times its size, and the targets add up to ``share`` of
   all sizes. The factor comes from running sums over the sources in the order of the level they are full at.
2. A source's documents stand in a fixed pseudo-random order; a running sum over all documents (ranges, not one
   task per source) gives each its place in the source's words. Reading the source again and again until the
   target is met takes each document whole, whole again, or, at the one place where the target ends, in part.
3. A source's share of the mix changes over training time t in [0, 1): its weight goes in a straight line from
   ``begin`` to ``end``. The integral of that line is the part of its target spent up to t; inverting it turns
   the words spent before a document into the document's position. Documents are range-sorted by position.

Null and blank texts have size 0 and are not taken. A null source is a source of its own and comes last. Rows
that repeat a key are documents of their own. Documents that agree in everything the order looks at (key and
text) are interchangeable. An empty table gives an empty mix. Reruns give the same mix.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsentry.llm.text import col, documents, packed, word_count, words
from logsentry.operators.order import global_index, prefix_sum
from logsentry.session import broadcast_if_small, pin


class Schedule(NamedTuple):
    """Weight in the mix, and how the source's rate changes from the start to the end of training."""

    weight: int
    begin: float = 1.0
    end: float = 1.0


#: Heavy sources gain over the training, light ones lose; the areas under the lines stay the weights.
CYCLE: tuple[Schedule, ...] = (Schedule(5, 0.5, 1.5), Schedule(2), Schedule(1, 1.5, 0.5))
SHARE = Fraction(3, 2)  # size of the mix over the size of all documents
EPOCHS = 2  # times a document can be taken


def _of_cycle(place: Column, values: Sequence[float], kind: str) -> Column:
    """The value for a place, repeating."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (place % len(values) + 1).cast("int")).cast(kind)


def targets(sizes: DataFrame, cycle: Sequence[Schedule] = CYCLE, share: Fraction = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Adds weight, begin, end and target to one row per source (source, source_size).

    Sources take turns in the cycle by code point, null last. A source is full when the level reaches
    epochs * size / weight. Before the source at which the level settles all are full; it and the later ones share
    what the full ones leave.
    """
    placed = global_index(sizes, [F.col("source").asc_nulls_last()], "place", "sources")
    given = placed.select("source", "source_size", *[
        _of_cycle(F.col("place"), [getattr(s, f) for s in cycle], kind).alias(f)
        for f, kind in (("weight", "long"), ("begin", "double"), ("end", "double"))
    ]).withColumn("most", epochs * F.col("source_size"))
    given = given.withColumn("full_at", F.col("most") / F.col("weight"))
    run = prefix_sum(given, ["full_at", "source"], ["most", "weight"], "levels")
    total = given.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    asked = Fraction(total["size"] or 0) * share
    # From the first source on that its own candidate does not overfill, candidates only fall.
    level = run.select("full_at", (
        (F.lit(float(asked)) - (F.col("cum_most") - F.col("most")))
        / (F.lit(total["weight"] or 0) - (F.col("cum_weight") - F.col("weight")))).alias("level"),
    ).filter("level <= full_at").agg(F.max("level").alias("level"))
    factor = F.coalesce(level.scalar(), F.lit(float("inf")))  # no source left open: all are full
    return pin(given.withColumn("target", F.least(F.col("most").cast("double"), F.col("weight") * factor)).drop("full_at", "most"),
               "targets")


def position(spent: Column, begin: Column, end: Column) -> Column:
    """The time at which a rate going straight from ``begin`` to ``end`` has spent the given part of its integral."""
    both = begin + end
    return spent * both / (begin + F.sqrt(begin * begin + (end - begin) * both * spent))


def allocate(
    df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", cycle: Sequence[Schedule] = CYCLE,
    share: Fraction = SHARE, epochs: int = EPOCHS, carry: Sequence[str] = (),
) -> DataFrame:
    """Every document with size, source_size, target, taken, and ``passes``: (pass, words, position) of each time it is taken.

    Columns besides: key, source, those of ``carry``, begin (its place in its source's words). Only these are shuffled.
    """
    sized = pin(df.select(
        col(key).alias("key"), col(source).alias("source"), word_count(col(text)).alias("size"),
        F.xxhash64(F.lit("mix"), col(key)).alias("turn"), F.xxhash64(col(text)).alias("content"), *carry), "sized")
    table = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, share, epochs)
    order = [F.col("source").asc_nulls_last(), F.col("turn"), F.col("key"), F.col("size"), F.col("content")]
    run = prefix_sum(sized, order, ["size"], "running")
    offset = prefix_sum(table.select(F.col("source").alias("s"), F.col("source_size").alias("z")),
                        [F.col("s").asc_nulls_last()], ["z"], "offsets")
    table = table.join(offset.select("s", (F.col("cum_z") - F.col("z")).alias("before")), F.col("source").eqNullSafe(F.col("s")))
    table = broadcast_if_small(pin(table.drop("source"), "sources"))
    quota = F.round("target").cast("long")
    begin = F.col("cum_size") - F.col("size") - F.col("before")
    found = run.join(table, F.col("source").eqNullSafe(F.col("s"))).withColumns({"quota": quota, "first": begin})

    def taken(turn: Column) -> Column:
        return F.greatest(F.lit(0), F.least("size", F.col("quota") - F.col("first") - turn * F.col("source_size")))

    each = F.transform(F.array(*[F.lit(p) for p in range(epochs)]), lambda p: F.struct(
        p.alias("pass"), taken(p).alias("words"),
        position((F.col("first") + p * F.col("source_size")) / F.greatest("quota", F.lit(1)), F.col("begin"), F.col("end")).alias("position")))
    return found.select(
        F.col("key"), "source", "size", "source_size", "target", F.col("first").alias("place"), *carry,
        F.filter(each, lambda x: x["words"] > 0).alias("passes"),
        sum((taken(F.lit(p)) for p in range(1, epochs)), taken(F.lit(0))).alias("taken"),
    )


def _ranged(df: DataFrame, *order: str) -> DataFrame:
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def mix(
    df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", cycle: Sequence[Schedule] = CYCLE,
    share: Fraction = SHARE, epochs: int = EPOCHS,
) -> DataFrame:
    """The training mix: the columns of ``df``, one row each time a document is taken, range-sorted by position.

    Where a source's target ends inside a document, the text is cut after the words taken and joined by spaces.
    """
    rows = pin(df.select(F.monotonically_increasing_id().alias("rid"), packed(df)), "rows")
    given = rows.select("rid", *[F.col("row").getField(c).alias(n) for c, n in ((key, "key"), (source, "source"), (text, "text"))])
    spent = allocate(given, "key", "source", "text", cycle, share, epochs, carry=["rid"])
    turns = spent.select("rid", "source", "size", F.explode("passes").alias("p")).select("rid", "source", "size", "p.*")
    placed = rows.join(turns, "rid").withColumn("text", F.when(F.col("words") < F.col("size"), F.array_join(
        F.slice(words(F.col("row").getField(text)), F.lit(1), F.col("words").cast("int")), " ")).otherwise(F.col("row").getField(text)))
    ordered = _ranged(placed, "position", "source", "rid", "pass")
    return ordered.select(*[F.col("text").alias(text) if c == text else F.col("row").getField(c).alias(c) for c in df.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, in the order of training; documents not taken come last."""
    spent = allocate(documents(spark, sf_dir).select("doc_id", "source", "text"))
    first = F.get("passes", F.lit(0))["position"]
    told = spent.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken", first.alias("position"))
    return _ranged(told.withColumn("last", F.col("position").isNull()), "last", "position", "doc_id").drop("last")
