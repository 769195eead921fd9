"""What the second advice found missing."""

from pyspark.sql import functions as F

import corpus_pipeline
from logsentry.llm import minhash, mixing, sharding
from logsentry.session import pin
from tests.conftest import SF


def test_a_large_group_fills_shards(spark):
    """One group with a third of all rows: it goes on to other shards when the first is full."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("the same text"))
                                    .otherwise(F.concat(F.lit("text "), F.lpad(F.col("id").cast("string"), 8, "0"))).alias("text"))
    got = sharding.shard_documents(docs, shards=8).filter("doc_id % 3 = 0").groupBy("shard").count().collect()
    held = sorted((r["count"] for r in got), reverse=True)
    assert sum(held) == 1000 and len(held) == 3 and held[0] - held[1] <= 2


def test_the_pipeline_keeps_the_order_of_training(spark):
    """The places that encoding gives follow op7's positions over several part files."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    docs = pin(spark.range(600).select(
        F.col("id").alias("doc_id"), F.element_at(F.array(*map(F.lit, "abc")), (F.col("id") % 3 + 1).cast("int")).alias("source"),
        F.repeat(F.concat(F.lit("w"), F.col("id").cast("string"), F.lit(" ")), (F.col("id") % 50 + 1).cast("int")).alias("text")), "test-docs")
    kept = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        mixed = pin(corpus_pipeline.mixing(spark, docs, SF), "test-mixed")
    finally:
        spark.conf.set(key, kept)
    assert len(mixed.inputFiles()) > 3
    at = {r["key"]: [p["position"] for p in r["passes"]] for r in mixing.allocate(docs).collect()}
    rows = corpus_pipeline.encoding(spark, mixed, SF).collect()
    assert sorted(r["position"] for r in rows) == list(range(len(rows)))
    order = [at[r["doc_id"]].pop(0) for r in sorted(rows, key=lambda r: r["position"])]
    assert order == sorted(order) and not any(at.values())


def test_one_row_of_a_group_stays(spark):
    """Also where rows repeat a key or have none."""
    text = {n: " ".join(f"{n}{i}" for i in range(60)) for n in "abcd"}
    rows = [(1, text["a"]), (1, text["a"]), (2, text["a"]), (None, text["a"]), (None, text["b"]), (None, text["b"] + " more"),
            (3, text["c"]), (3, text["d"]), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], (r["text"] or "")[:2]) for r in minhash.drop_near_duplicates(df).collect()), key=repr)
    assert got == sorted([(1, "a0"), (None, "b0"), (3, "c0"), (3, "d0"), (None, ""), (None, "")], key=repr)
