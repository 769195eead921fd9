"""URL filter: rules first, then words of the URL.

1. A rule names a host and the beginning of a path. It fits that host and all its subdomains; of the rules that fit, the
   longest decides. Rules are a table of any size: hosts are looked up by each of their endings.
2. Other URLs are judged by words. Names in hosts and paths are often words run together, so each distinct name is
   cut where a unigram model likes it best (Viterbi). The model counts the words of a whole corpus; a name meets the
   counts by a join on its substrings, so the dictionary is never sent anywhere whole. Then a multinomial naive
   Bayes classifier scores the words, those of hosts and of paths apart.
   It is trained on the same URLs: a host that has a seed word between its separators is an example of what to block,
   every other host an example of what to allow. Since names are cut, it also finds the words inside longer names.

Counts, examples and scores are kept per distinct (host, path), so a URL that a third of all rows repeat is one row.
Log-odds are whole millionths, so sums do not depend on the order of rows.

Null URLs and URLs without "://" have an empty host and path, no words, and get the verdict of the classes' shares alone.
Rows that repeat an id are judged one by one. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsentry.llm.text import arrow_rows, col, let, lower_az
from logsentry.session import broadcast_if_small, pin


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str  # "allow" or "block"


RULES: tuple[Rule, ...] = (
    Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"),
)
#: Words that mark a host as unwanted when they stand between its separators.
SEEDS = ("adult", "ads", "adserver", "bet", "bets", "betting", "casino", "cheap", "clickbait", "gambling", "loan", "loans", "lottery",
         "malware", "pharma", "phishing", "pills", "poker", "porn", "replica", "sex", "slots", "spam", "track", "tracker", "viagra",
         "warez", "xxx")
SEED_COUNT = 1000  # what a seed word counts at least in the unigram model
PROBE = 24  # letters by which names look words up; longer words are looked up by so many, then compared
SCALE = 1_000_000
_NAME = r"(\p{L}+|\p{N}+)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host after the first "://", A to Z in lower case, and the path up to a query or fragment; both empty without "://"."""
    url = F.coalesce(url, F.lit(""))
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return lower_az(host), let(rest, lambda r: F.regexp_extract(r, r"^[^/?#]*([^?#]*)", 1))


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    return spark.createDataFrame(
        [(r.host, r.path, r.host + r.path, r.verdict) for r in rules], "rule_host string, rule_path string, rule string, verdict string")


def apply_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the distinct (host, path) of ``urls`` that a rule fits; the longest, ties by text."""
    parts = F.split("host", r"\.")
    endings = urls.select("host", "path", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))).alias("rule_host"))
    fits = endings.join(broadcast_if_small(rules), "rule_host").filter(F.col("path").startswith(F.col("rule_path")))
    return fits.groupBy("host", "path").agg(
        F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "rule")).alias("r")).select("host", "path", "r.*")


def names(urls: DataFrame) -> DataFrame:
    """(host, path, part, name): the runs of letters and of digits, part h or p. Digits are all one name, ``#``."""
    def runs(part: str, value: Column) -> Column:
        return F.transform(F.regexp_extract_all(F.lower(value), F.lit(_NAME), 1), lambda x: F.struct(
            F.lit(part).alias("part"), F.when(x.rlike(r"^\p{N}"), F.lit("#")).otherwise(x).alias("name")))

    each = [runs("h", F.col("host")), runs("p", F.col("path"))]
    return urls.select("host", "path", F.explode(F.concat(*each)).alias("n")).select("host", "path", "n.*")


def word_counts(texts: DataFrame, column: str) -> DataFrame:
    """(word, n) over all texts, words of any length in lower case; markup tags are skipped."""
    plain = F.regexp_replace(F.coalesce(col(column), F.lit("")), r"<[^<>]*>", " ")
    words = texts.select(F.explode(F.regexp_extract_all(F.lower(plain), F.lit(r"\p{L}+"), 0)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def cut(name: str, found: list[tuple[int, int, int]], total: int) -> list[str]:
    """The best cutting of a name. ``found``: (start, length, count) of its substrings that are words.

    A known word costs minus the log of its share. An unknown stretch of n letters costs as a word seen once
    in a corpus 10 ** n times as large. One pass: a place is reached by a word, or within an unknown stretch, whose cost
    grows by a letter at a time.
    """
    n = len(name)
    known: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for start, length, count in found:
        known[start].append((length, math.log(total / count)))
    base, letter = math.log(total), math.log(10)
    best = [0.0] + [math.inf] * n
    back = [0] * (n + 1)
    stretch, begin = math.inf, 0  # the cheapest unknown stretch that ends here, with all before it
    for i in range(n):
        if best[i] + base < stretch - 1e-12:
            stretch, begin = best[i] + base, i
        stretch += letter
        if stretch < best[i + 1] - 1e-12:
            best[i + 1], back[i + 1] = stretch, begin
        for length, cost in known[i]:
            if best[i] + cost < best[i + length] - 1e-12:
                best[i + length], back[i + length] = best[i] + cost, i
    out, end = [], n
    while end:
        out.append(name[back[end] : end])
        end = back[end]
    return out[::-1]


def segment(distinct: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) for each name: its best cutting by the unigram counts (word, n)."""
    arrow_rows(distinct.sparkSession)
    total = max(int(counts.agg(F.sum("n")).first()[0] or 0), 2)
    length = F.length("name")
    starts = distinct.select("name", F.explode(F.sequence(F.lit(1), length)).alias("start"))
    parts = starts.select("name", "start", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(PROBE), length - F.col("start") + 1))).alias("length"))
    parts = parts.withColumn("probe", F.expr("substring(name, start, length)"))
    # A longer word is met by its first letters, and then compared with what the name has there.
    words = counts.select(F.substring("word", 1, PROBE).alias("probe"), "word", "n")
    same = F.col("probe") == F.col("word")
    longer = F.expr("substring(name, start, length(word))") == F.col("word")
    hits = parts.join(words, "probe").filter(same | longer).groupBy("name").agg(
        F.collect_list(F.struct((F.col("start") - 1).alias("start"), F.length("word").alias("length"), "n")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given, found = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            words = [cut(g, [(x["start"], x["length"], x["n"]) for x in f or []], total) for g, f in zip(given, found)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], ["name", "words"])

    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("words", T.ArrayType(T.StringType()))])
    return pin(distinct.join(hits, "name", "left").mapInArrow(run, schema), "segments")


def tokens(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, path, token): the cut words of each distinct URL, as often as they occur; marked h: or p: by where they stand."""
    named = pin(names(urls), "names")
    cuts = segment(named.filter("name <> '#'").select("name").distinct(), counts)
    whole = named.join(broadcast_if_small(cuts), "name", "left")
    return pin(whole.select("host", "path", "part", F.explode(F.coalesce("words", F.array("name"))).alias("word")).select(
        "host", "path", F.concat_ws(":", "part", "word").alias("token")), "tokens")


def _log_odds(block: Column, allow: Column) -> Column:
    return F.round(F.log(block / allow) * SCALE).cast("long")


def marked(seeds: Sequence[str]) -> Column:
    """Whether a host has a seed word between its separators."""
    return F.coalesce(F.arrays_overlap(F.split("host", "[^a-z0-9]+"), F.array(*[F.lit(s) for s in seeds])), F.lit(False))


def bayes(tokens: DataFrame, urls: DataFrame, seeds: Sequence[str] = SEEDS) -> tuple[DataFrame, int]:
    """(token, odds): log-odds of block over allow in millionths, smoothed by one; and those of the classes."""
    label = marked(seeds).cast("int")
    classes = urls.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("block")).first()
    block, allow = (classes["block"] or 0) + 1, classes["n"] - (classes["block"] or 0) + 1
    counts = pin(tokens.groupBy("token").agg(F.sum(label).alias("block"), F.sum(1 - label).alias("allow")), "token-counts")
    sums = counts.agg(F.count(F.lit(1)).alias("v"), F.sum("block").alias("block"), F.sum("allow").alias("allow")).first()
    in_block, in_allow = (sums["block"] or 0) + sums["v"], (sums["allow"] or 0) + sums["v"]
    odds = counts.select("token", _log_odds((F.col("block") + 1) / float(max(in_block, 1)),
                                            (F.col("allow") + 1) / float(max(in_allow, 1))).alias("odds"))
    return pin(odds, "odds"), round(math.log(block / allow) * SCALE)


def unigrams(corpus: DataFrame, column: str, seeds: Sequence[str]) -> DataFrame:
    """(word, n) of the corpus and the seeds, written once."""
    seeded = corpus.sparkSession.createDataFrame([(s, SEED_COUNT) for s in seeds], "word string, n long")
    return pin(word_counts(corpus, column).unionByName(seeded).groupBy("word").agg(F.max("n").alias("n")), "unigrams")


def held_out(df: DataFrame, corpus: DataFrame, url: str = "url", corpus_text: str = "text", seeds: Sequence[str] = SEEDS, parts: int = 4) -> DataFrame:
    """(host, marked, blocked) of one host in ``parts``: how words judge hosts that were not learnt from, without the seed words themselves.

    ``marked`` is the label by seeds, ``blocked`` the verdict of most of the host's URLs by all other words.
    """
    host, path = host_and_path(col(url))
    urls = pin(df.select(host.alias("host"), path.alias("path")).distinct(), "distinct-urls")
    words = tokens(urls, unigrams(corpus, corpus_text, seeds))
    apart = F.pmod(F.xxhash64("host"), F.lit(parts)) == 0
    odds, prior = bayes(words.filter(~apart), urls.filter(~apart), seeds)
    blind = words.filter(apart).filter(~F.substring("token", 3, 1 << 30).isin(*seeds))
    scored = blind.join(broadcast_if_small(odds), "token").groupBy("host", "path").agg(F.sum("odds").alias("odds"))
    told = urls.filter(apart).join(scored, ["host", "path"], "left").withColumn("block", (F.coalesce("odds", F.lit(0)) + prior > 0).cast("int"))
    return told.groupBy("host").agg(F.max(marked(seeds)).alias("marked"), (F.avg("block") > 0.5).alias("blocked"))


def judge(
    df: DataFrame, corpus: DataFrame, url: str = "url", corpus_text: str = "text", key: str = "page_id",
    rules: Sequence[Rule] = RULES, seeds: Sequence[str] = SEEDS,
) -> DataFrame:
    """Every row's key (under its own name), host, path, rule (null if none fits), verdict and score (log-odds of block by words).

    ``corpus`` gives the words names are cut into.
    """
    spark = df.sparkSession
    host, path = host_and_path(col(url))
    rows = pin(df.select(col(key).alias("key"), host.alias("host"), path.alias("path")), "urls")
    urls = pin(rows.select("host", "path").distinct(), "distinct-urls")
    words = tokens(urls, unigrams(corpus, corpus_text, seeds))
    odds, prior = bayes(words, urls, seeds)
    scored = words.join(broadcast_if_small(odds), "token").groupBy("host", "path").agg(F.sum("odds").alias("odds"))
    told = urls.join(scored, ["host", "path"], "left").join(apply_rules(urls, rule_table(spark, rules)), ["host", "path"], "left")
    score = F.coalesce("odds", F.lit(0)) + prior
    judged = pin(told.select("host", "path", "rule", F.coalesce(
        "verdict", F.when(score > 0, "block").otherwise("allow")).alias("verdict"), (score / SCALE).alias("score")), "judged")
    return rows.join(broadcast_if_small(judged), ["host", "path"]).select(
        F.col("key").alias(key), "host", "path", "rule", "verdict", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL; names are cut by the words of all pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge(pages.select("page_id", "url"), pages.select(F.col("html").alias("text")))
