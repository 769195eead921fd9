"""Nulls, empty and very long texts, repeated rows, clashing columns and empty tables."""

import pytest
from pyspark.sql import functions as F

import public_tokenizers
from logsentry.llm import (
    byte_bpe, exact_dedup, line_dedup, merkle, minhash, mixing, periodic, quality, secret_scan, sharding, token_counts, toxicity, url_filter,
)
from tests.llm import plain

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"w{i % 9973}x{i}" for i in range(30000)) + "z" * 5000
PROSE = "one two three four five six seven eight nine ten eleven twelve"
ROWS = [
    (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "a b c", "b"), (4, "a b c", "b"), (5, "A b C", None), (None, "a b c", "c"),
    (None, None, None), (6, LONG, "a"), (7, PROSE + "\n" + PROSE, "a"), (8, PROSE.upper(), "b"), (9, PROSE + "\n\nÉé 漢字 it's", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with columns that clash with what the operators add."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    for name in ("row", "rid", "key", "kept", "size", "digest", "ids", "n_tokens", "lines", "gone", "position", "words", "pass", "score", "a.b"):
        df = df.withColumn(name, F.lit("mine"))
    return df


def pairs(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_exact(docs):
    out = exact_dedup.exact_dedup(docs).withColumn("sha", F.lower(F.hex("digest")))
    want = {}
    for key, text, _ in ROWS:
        ids = [k for k, t, _ in ROWS if plain.sha(t) == plain.sha(text) and k is not None]
        want.setdefault(plain.sha(text), (max(ids, default=None), sum(plain.sha(t) == plain.sha(text) for _, t, _ in ROWS)))
    got = out.collect()
    assert len(got) == len(ROWS)
    assert all((r["keep_id"], r["group_size"]) == want[r["sha"]] for r in got)
    assert sum(r["kept"] for r in got) == len(want)  # one row of each group, repeated rows or not


def test_quality(docs):
    got = docs.select("doc_id", quality.measures(F.col("text")).alias("m")).select("doc_id", "m.*")
    want = []
    for key, text, _ in ROWS:
        w, lines = plain.words(text), [x for x in (text or "").split("\n") if plain.words(x)]
        want.append((key, len(w), len("".join(w)), sum((text or "").count(c) for c in quality.SYMBOLS),
                     len(lines) - len(set(lines)), plain.repeat_words(w)))
    assert pairs(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") == sorted(want, key=repr)
    kept = quality.filter_quality(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {9}  # 6 has too long words, 7 repeats, 8 shouts, the others are short


def test_near(docs):
    got = minhash.near_duplicates(docs, words=4)
    want = plain.groups([(k, t) for k, t, _ in ROWS], 4)
    assert pairs(got, "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.collect())
    left = minhash.drop_near_duplicates(docs, words=4)
    assert left.columns == docs.columns and 5 not in {r["doc_id"] for r in left.collect()}


def test_lines(docs):
    got = line_dedup.drop_repeated_lines(docs)
    assert got.columns == docs.columns
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    want = plain.without_repeats([(k, t) for k, t, _ in order])
    assert pairs(got, "doc_id", "text") == sorted(zip([k for k, _, _ in order], want), key=repr)


def test_tokens(docs):
    import tiktoken
    from tokenizers import Tokenizer

    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=byte_bpe.load_ranks(open(RANKS, "rb").read()))
    encoded = byte_bpe.encode(docs, RANKS)
    want = [(k, own.encode_ordinary(t or "")) for k, t, _ in ROWS]
    assert pairs(encoded, "doc_id", "ids") == sorted(want, key=repr)
    assert pairs(byte_bpe.decode(encoded, RANKS), "doc_id", "decoded") == sorted(((k, bytearray((t or "").encode())) for k, t, _ in ROWS), key=repr)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    counted = token_counts.token_counts(docs, VOCABULARY)
    assert pairs(counted, "doc_id", "n_tokens") == sorted(((k, len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for k, t, _ in ROWS), key=repr)


def test_mix(docs):
    got = mixing.allocate(docs).collect()
    assert len(got) == len(ROWS) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    for source in ("a", "b", "c", None):
        of = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in of) - of[0]["target"]) <= 1
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(len(plain.words(r["text"])) for r in mixed.collect()) == sum(r["taken"] for r in got)


def test_shards(docs):
    got = sharding.shard_documents(docs, shards=3).collect()
    assert len(got) == len(ROWS)
    for s in range(3):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_scores(spark, docs):
    labels = spark.createDataFrame([(4, 0, 1), (5, 0, 0), (None, 0, 1), (6, 0, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(toxicity.labelled(docs, labels))
    got = toxicity.score(docs, model)
    rows = got.collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)


def test_periods(docs):
    got = periodic.periodic_runs(docs)
    assert [c for c in got.columns if c not in ("runs", "collapsed")] == [c for c in docs.columns if c != "text"]
    assert pairs(got, "doc_id", "runs", "collapsed") == sorted(((k, [], " ".join(plain.words(t))) for k, t, _ in ROWS), key=repr)


def test_secrets(docs):
    got = secret_scan.scan(docs)
    assert [c for c in got.columns if c != "spans"] == [c for c in docs.columns if c != "text"]
    assert {len(r["spans"]) for r in got.collect()} == {0}


def test_manifest(docs):
    fields = ["doc_id", "source", "text", "a.b"]
    manifest = merkle.build(docs, fields, group="source")
    rows = merkle.prove(manifest, manifest.ranks).withColumn("root", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    assert len(rows) == len(ROWS) and all(r["root"] == manifest.root and r["request"]["leaf"] == r["leaf"] for r in rows)
    assert sorted(r["leaf"] for r in rows) == sorted(plain.merkle_leaf((k, s, t, "mine")) for k, t, s in ROWS)


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "no mark"), (4, "http://"), (None, "HTTP://A.Example.NET/en/x?q#f"), (6, "x://a.net"), (6, "x://a.net"),
            (7, "x://É.net/" + "ab" * 3000), (8, "x://example.com/de/"), (9, "x://b.org/fr/y"), (10, "a://b://c/d")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit(1) for c in ("host", "rule", "name", "key")})
    got = url_filter.judge(pages, pages.select(F.col("url").alias("text")))
    want = [
        (1, "", "", None), (2, "", "", None), (3, "", "", None), (4, "", "", None), (None, "a.example.net", "/en/x", "example.net/en/"),
        (6, "a.net", "", None), (6, "a.net", "", None), (7, "É.net", "/" + "ab" * 3000, "net/"), (8, "example.com", "/de/", "example.com/de/"),
        (9, "b.org", "/fr/y", "org/fr/"), (10, "b:", "//c/d", None)]
    assert pairs(got.drop("verdict"), "page_id", "host", "path", "rule") == sorted(want, key=repr)


EMPTY = {
    "exact": lambda d: exact_dedup.exact_dedup(d), "quality": lambda d: quality.filter_quality(d),
    "near": lambda d: minhash.near_duplicates(d), "lines": lambda d: line_dedup.drop_repeated_lines(d),
    "encode": lambda d: byte_bpe.round_trip(d, RANKS), "count": lambda d: token_counts.token_counts(d, VOCABULARY),
    "mix": lambda d: mixing.mix(d), "shards": lambda d: sharding.shard_documents(d),
    "scores": lambda d: toxicity.score(d, toxicity.train(toxicity.labelled(d, d.withColumn("toxic", F.lit(1))))),
    "periods": lambda d: periodic.periodic_runs(d), "secrets": lambda d: secret_scan.scan(d),
    "manifest": lambda d: merkle.prove((m := merkle.build(d, group="source", fields=("doc_id", "text"))), m.ranks),
    "urls": lambda d: url_filter.judge(d, d, url="text", key="doc_id"),
}


@pytest.mark.parametrize("name", EMPTY)
def test_empty(docs, name):
    assert EMPTY[name](docs.limit(0)).collect() == []
