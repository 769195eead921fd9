"""The methods against plain versions, and the SQL of the queries."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
import public_tokenizers
from logsentry.llm import byte_bpe, catalog, exact_dedup, line_dedup, minhash, pretokens, quality, sharding, token_counts, toxicity, url_filter
from logsentry.llm.graph import components
from logsentry.session import pin, scratch_path
from tests.conftest import SF
from tests.llm import plain


@pytest.mark.parametrize("name", catalog.ORACLES)
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    cursor = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    want = sorted(repr([r[names.index(c)] for c in cols]) for r in cursor.fetchall())
    assert sorted(names) == cols and sorted(repr([r[c] for c in cols]) for r in df.collect()) == want


def test_index_keeps_what_entered_first(spark):
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "test-index"), buckets=4)
    first = exact_dedup.digests(spark.createDataFrame([(1, "x"), (2, "X"), (3, "y")], "doc_id long, text string"))
    more = exact_dedup.digests(spark.createDataFrame([(7, "x"), (8, "z"), (9, "z")], "doc_id long, text string"))
    index.ingest(first)
    plan = index.unseen(more)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    index.ingest(more)
    again = exact_dedup.DigestIndex(spark, index.path, buckets=4)
    assert sorted(r["key"] for r in again.rows().collect()) == [2, 3, 9]
    kept = {r["key"]: r["kept"] for r in exact_dedup.resolve(more, again).collect()}
    assert kept == {7: False, 8: False, 9: True}


def test_an_index_opened_elsewhere(spark):
    """By a session that knows neither its table nor its buckets: nothing enters twice. Files of a bucket are merged."""
    docs = spark.range(200).select(F.col("id").cast("string").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 150).alias("text"))
    path = scratch_path(spark, "test-index")
    index = exact_dedup.DigestIndex(spark, path, "string", 4)
    index.ingest(exact_dedup.digests(docs))
    spark.sql(f"DROP TABLE {index.table}")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        again = exact_dedup.DigestIndex(spark, path)
        again.ingest(exact_dedup.digests(docs))
        assert again.buckets == 4 and again.rows().count() == 150
        for k in range(exact_dedup.MERGE + 1):
            again.ingest(exact_dedup.digests(docs.withColumn("text", F.concat("text", F.lit(f" {k}")))))
        assert again.generation > 0 and len(again.rows().inputFiles()) <= exact_dedup.MERGE * 4
        last = exact_dedup.DigestIndex(spark, path)
        last.ingest(exact_dedup.digests(docs.withColumn("text", F.concat("text", F.lit(" 0")))))
        assert last.rows().count() == 150 * (exact_dedup.MERGE + 2) and last.folder == again.folder
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for other in ({"buckets": 9}, {"key_type": "bigint"}):
        with pytest.raises(ValueError):
            exact_dedup.DigestIndex(spark, path, **other)


def test_text_keys(spark):
    rows = [(f"k{i:03d}", f"text {i % 40}") for i in range(100)] + [(None, "text 1"), (None, "alone")]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id string, text string"), batches=4).collect()
    last = {t: max((k for k, x in rows if x == t and k is not None), default=None) for _, t in rows}
    assert sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in got if r["doc_id"]) == sorted((k, last[t], last[t] == k) for k, t in rows if k)
    assert sum(r["kept"] for r in got) == 41


def test_cascade_order():
    rules = [quality.Rule(n, lambda t: F.lit(True)) for n in "abcd"]
    told = [quality.Estimate(rules[0], 2.0, 0.5), quality.Estimate(rules[1], 0.1, 0.2), quality.Estimate(rules[2], 1.0, 0.0), quality.Estimate(rules[3], 0.5, 0.0)]
    assert [r.name for r in quality.ordered(told)] == ["b", "a", "d", "c"]


def test_components(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5)]
    label = {x: x for e in edges for x in e}
    while any(label[a] != label[b] for a, b in edges):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: v for x, v in label.items() if any(x in e and e[0] != e[1] for e in edges)}


def test_posterior_bound():
    for n, m in minhash.least_matches(80, 1e-3):
        def tail(k):  # of Beta(k + 1, n - k + 1) above 0.8, by summing its density
            steps = 4000
            density = [(x / steps) ** k * (1 - x / steps) ** (n - k) for x in range(steps + 1)]
            return sum(density[int(0.8 * steps):]) / sum(density)
        assert tail(m) >= 1e-3 * 0.9 and tail(m - 1) < 1e-3 * 1.1


def test_near_copies(spark):
    rnd = random.Random(1)
    vocabulary = [f"v{i}" for i in range(4000)]
    rows = []
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    for g in range(25):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(5, 120))] + (passage if g % 3 == 0 else [])
        for _ in range(rnd.randint(1, 14)):
            copy = list(base)
            for _ in range(rnd.randint(0, 3)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            rows.append((len(rows) * 7 % 1009, " ".join(copy)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == sorted(plain.groups(rows, 5))


def test_line_runs(spark):
    rnd = random.Random(2)
    pool = [f"line {i} " + "w " * (i % 14) for i in range(12)] + [""]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 9)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for least in (1, 2, 3):
        got = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(df, min_lines=least).collect()}
        assert [got[i] for i, _ in rows] == plain.without_repeats(rows, least)


def test_suffix_array(spark):
    rnd = random.Random(4)
    rows = [(i, "\n".join(rnd.choice("abc") for _ in range(rnd.randint(1, 8)))) for i in range(12)]
    told = line_dedup.lines(line_dedup.numbered(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text"))
    rank = {r["line"]: (r["h1"], r["h2"]) for r in spark.createDataFrame([("a",), ("b",), ("c",)], "line string").select(
        "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")).collect()}
    ranked = line_dedup.doubled(line_dedup.first_ranks(told))
    entries = line_dedup.suffix_array(ranked).orderBy("r").collect()
    assert ranked.final.count() == told.count() and all(
        a.count() >= b.count() for a, b in zip(ranked.rounds, ranked.rounds[1:])) and len(ranked.rounds) >= 3
    suffixes = sorted({tuple(rank[x] for x in t.split("\n")[i:]) for _, t in rows for i in range(len(t.split("\n")))})
    text = dict(rows)
    assert [tuple(rank[x] for x in text[e["at"]["key"]].split("\n")[e["at"]["i"]:]) for e in entries] == suffixes
    common = [0] + [next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(suffixes, suffixes[1:])]
    assert [e["lcp"] for e in entries] == common


def test_pieces():
    import tiktoken
    from tokenizers import Tokenizer

    raw = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read()
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=byte_bpe.load_ranks(raw))
    counts = token_counts.Counts(token_counts.load_merges(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read()))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rnd = random.Random(5)
    parts = ["'s", "'re", "'", "  ", " ", "\n", "\u00a0", "\x1c", "é", "漢", "٣", "1", "x", "S", "!", "😀", "<|endoftext|>", "l", "v"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(4000)] + ["a" * 3000, " " * 600]
    ids, offsets, rows = byte_bpe.encode_texts(texts, raw)
    assert [ids[a:b].tolist() for a, b in zip(rows, rows[1:])] == [own.encode_ordinary(t) for t in texts]
    data, begin = byte_bpe.decode_ids(ids, offsets, rows, raw)
    assert [data[a:b].tobytes().decode() for a, b in zip(begin, begin[1:])] == texts
    want = [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.count_texts(texts, counts) == want
    assert len(pretokens.in_blocks(texts, 100)) > 1


def test_quotas():
    got = sharding.quotas({(0, 1): 100, (1, 0): 40, (2, 1): 60}, [10, 70, 30], 100)
    assert got[1, 0] == 40 and got[0, 1] - 40 + got[2, 1] <= 30


def test_groups_share_a_shard(spark):
    rows = [(i, f"text {i % 50} " * 20) for i in range(200)] + [(1000 + i, "alone %d " % i * 20) for i in range(400)]
    got = {r["doc_id"]: r for r in sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), shards=4).collect()}
    together = sum(len({got[i]["shard"] for i in range(g, 200, 50)}) == 1 for g in range(50))
    loads = [sum(r["size"] for r in got.values() if r["shard"] == s) for s in range(4)]
    assert together >= 45 and max(loads) < 1.03 * min(loads)


def test_identity_terms(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(600):
        toxic = i % 2
        who = "muslim" if rnd.random() < (0.9 if toxic else 0.1) else "christian"
        rows.append((i, f"the {who} neighbour is {'awful' if toxic else 'friendly'} and {rnd.choice(['tall', 'busy', 'late'])}", toxic))
    told = pin(spark.createDataFrame(rows, "key long, text string, label int"), "told")
    neutral = spark.createDataFrame([("the muslim neighbour",), ("the christian neighbour",)], "text string")
    gap = {}
    for pull in (0.0, toxicity.COUNTERFACTUAL):
        model = toxicity.train(told, counterfactual=pull)
        a, b = (math.log(r["score"] / (1 - r["score"])) for r in toxicity.score(neutral.withColumn("t", F.col("text")), model).orderBy(F.desc("t")).collect())
        gap[pull] = abs(a - b)
    assert gap[toxicity.COUNTERFACTUAL] < 0.2 * gap[0.0]
    ends = toxicity.score(spark.createDataFrame([("awful",), ("friendly",)], "text string").withColumn("t", F.col("text")), model)
    assert [r["score"] > 0.5 for r in ends.orderBy("t").collect()] == [True, False]


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.1")
    got = toxicity.query(spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    r = got.selectExpr("sum(toxic) AS all", "count_if(predicted = 1 AND toxic = 1) AS hit",
                       "count_if(predicted = 1 AND toxic = 0) AS false", "count_if(toxic = 0) AS clean").first()
    assert r["hit"] >= 0.8 * r["all"] and r["false"] <= 0.02 * r["clean"]


def test_cutting():
    counts = {"cheap": 50, "pills": 40, "the": 900, "rapist": 3, "therapist": 30, "a": 500}
    total = 2000

    def best(name):
        if not name:
            return 0.0, []
        options = []
        for n in range(1, len(name) + 1):
            cost = math.log(total / counts[name[:n]]) if name[:n] in counts else math.log(total) + n * math.log(10)
            rest = best(name[n:])
            options.append((cost + rest[0], [name[:n], *rest[1]]))
        return min(options, key=lambda o: o[0])

    for name in ("cheappills", "therapist", "thecheapqx", "zzz", "aa"):
        found = [(i, n, counts[name[i : i + n]]) for i in range(len(name)) for n in range(1, len(name) - i + 1) if name[i : i + n] in counts]
        cost = sum(math.log(total / counts[w]) if w in counts else math.log(total) + len(w) * math.log(10) for w in url_filter.cut(name, found, total))
        assert abs(cost - best(name)[0]) < 1e-9
    assert url_filter.cut("cheappills", [(0, 5, 50), (5, 5, 40)], total) == ["cheap", "pills"]


def test_words_inside_names_are_found(spark):
    rows = [(i, f"http://www.{n}.example.org/a/{i}") for i, n in enumerate(
        ["casino-win", "casino-club", "free-casino", "garden", "garden-tools", "kitchen", "music", "tools"] * 6 + ["grandcasinowin"])]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    text = spark.createDataFrame([("grand garden tools kitchen music win club free " * 50,)], "text string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, text).collect()}
    assert got[48] == "block" and got[0] == "block" and got[3] == "allow" and got[7] == "allow"


def test_pipeline(spark):
    """Each stage on its own input, against the plain versions."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = []
    for _, stage in corpus_pipeline.STAGES:
        given, docs = docs, pin(stage(spark, docs, SF), "test-stage")
        out.append((given.collect(), docs.collect()))
    (raw, good), (_, clean), (_, single), (_, mixed), (_, coded) = out
    assert all(r.__fields__ == raw[0].__fields__ for _, rows in out[:4] for r in rows)
    assert {r["doc_id"] for r in good} <= {r["doc_id"] for r in raw if len(plain.words(r["text"])) >= 10}
    order = sorted(good, key=lambda r: r["doc_id"])
    told = {r["doc_id"]: r["text"] for r in raw}
    left = dict(zip([r["doc_id"] for r in order], plain.without_repeats([(r["doc_id"], r["text"]) for r in order])))
    left = {k: t for k, t in left.items() if t == told[k] or len(plain.words(t)) >= 10}
    assert {r["doc_id"]: r["text"] for r in clean} == left
    first = {k for k, _, c in plain.groups([(k, told[k]) for k in left], 5) if k == c}
    want = {k for k, _, c in plain.groups([(k, left[k]) for k in first], 5) if k == c}
    assert {r["doc_id"] for r in single} == want and len(want) < len(left)
    sizes = {r["doc_id"]: len(plain.words(r["text"])) for r in single}
    taken = {}
    for r in mixed:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + len(plain.words(r["text"]))
    assert all(n <= 2 * sizes[k] for k, n in taken.items())
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 20
    assert sorted((r["doc_id"], r["decoded_sha256"]) for r in coded) == sorted(
        (r["doc_id"], __import__("hashlib").sha256(r["text"].encode()).hexdigest()) for r in mixed)
