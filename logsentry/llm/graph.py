"""Connected components of an edge table, by alternating stars.

Every round replaces edges by edges towards smaller nodes: first each node sends its
larger neighbours to its smallest one, then its smaller neighbours. The components stay
the same and the table shrinks to one star per component after a number of rounds that
grows with the logarithm of the size. Each round is two aggregations (reduced map-side) and
two joins that AQE can split at a hub; the table of a round is written to the shared
folder, so lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsentry.session import pin


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (columns a, b; a node is a long): label is the smallest node it reaches.

    Loops and repeated edges do no harm. No edges give no rows.
    """
    now = pin(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges"
    )
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                              F.col("m").alias("v"))
        now = pin(small.filter("u <> v").distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
