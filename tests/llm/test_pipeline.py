"""The pipeline's stages beyond one plain run: near copies after line dedup, odd tables, results held side by side."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logsentry.llm import minhash
from logsentry.session import pin, written
from tests.llm import plain

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages():
    return dict(corpus_pipeline.STAGES)


def test_near_copies_go_although_their_lines_went(spark, stages):
    """Of the copies that near-dedup finds among the texts as they were, nine in ten or more are gone after the stage."""
    good = pin(stages["quality_rules"](spark, spark.read.parquet(f"{SF}/documents.parquet"), SF), "test-good")
    copies = {r["doc_id"] for r in minhash.near_duplicates(good).collect() if not r["kept"]}
    clean = pin(stages["line_dedup"](spark, good, SF), "test-clean")
    single = stages["minhash_near_dedup"](spark, clean, SF)
    left = {r["doc_id"] for r in single.select("doc_id").collect()}
    assert len(copies) >= 30 and len(copies & left) <= 0.1 * len(copies)
    assert {r["doc_id"] for r in good.select("doc_id").collect()} - copies - left <= {
        r["doc_id"] for r in good.join(clean.select("doc_id"), "doc_id", "left_anti").collect()}  # others went only as too short
    assert single.columns == good.columns


def test_two_results_of_a_stage(spark, stages, tmp_path):
    rows = [(i, f"line {i // 2} " + "w " * 12 + "\n" + "v " * 12) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    a, b = (stages["line_dedup"](spark, docs, str(tmp_path)) for _ in range(2))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_near_duplicates_keep_two_tables(spark):
    """Of the scratch tables only those that the result reads stay, and none of them has signatures."""
    text = " ".join(f"w{n}" for n in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " more"), (3, text), (4, "some other text of a few words"), (None, text), (5, None)],
                                 "doc_id long, text string")
    before = set(written())
    out = minhash.near_duplicates(docs)
    left = [p for p in written() if p not in before]
    assert len(left) == 2 and not any("sig" in spark.read.parquet(p).columns for p in left)
    assert {(r["doc_id"], r["component_id"]) for r in out.collect()} == {(1, 1), (2, 1), (3, 1), (None, 1), (4, 4), (5, 5)}


ODD = "doc_id long, text string, source string, lang string, n_chars long"


def odd(spark, rows):
    df = spark.createDataFrame(rows, ODD)
    for name in ("row", "rid", "key", "kept", "size", "gone", "clean", "removed", "words", "a.b"):
        df = df.withColumn(name, F.lit("mine"))
    return df


def test_odd_tables(spark, stages, tmp_path):
    """Nulls anywhere, empty texts, repeated ids and rows, columns of any names; then no rows at all."""
    prose = "The first of these lines says that many people like to walk along the river in spring."
    other = "Nobody knows why this house was built so far away from all of the others, or by whom."
    rows = [(None, prose, None, None, None), (None, prose, "a", "en", 3), (1, prose, "a", None, 5), (1, prose, "a", None, 5), (2, None, None, "x", None),
            (3, "", "a", "x", 0), (4, other + "\n" + prose, "b", "x", 1), (5, other, None, "x", 1), (5, "short", "b", "x", 1)]
    for name, given in (("full", rows), ("none", [])):
        path = str(tmp_path / name)
        docs = odd(spark, given)
        docs.write.parquet(f"{path}/documents.parquet")
        for step in ("quality_rules", "line_dedup", "minhash_near_dedup", "mixing"):
            docs = pin(stages[step](spark, docs, path), f"test-{step}")
            assert docs.columns == odd(spark, []).columns
            if step == "minhash_near_dedup":
                texts = [plain.words(r["text"]) for r in docs.collect()]
                assert len(texts) == len({tuple(t) for t in texts}) and bool(texts) == bool(given)
        assert bool(stages["byte_bpe"](spark, docs, path).count()) == bool(given)
