"""Quality rules as a short-circuit cascade.

Each rule is a column expression that is true where a text passes. Rules are timed on
a sample, each by itself, and the share of the sample it rejects is counted. The
cascade asks the rule with the highest rejection per second first and asks the next
one only of texts that passed, as nested CASE branches: no shuffle, no Python, one
pass. The verdict is the conjunction of all rules, so the order changes cost only,
never the result, and the sample's bound (``sample_rows``) affects nothing else.

Null and blank texts have no words; every count is 0 and the base rules reject them.
Very long texts are measured whole.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsentry.llm.text import SPACE, WORD, col, documents, let, words
from logsentry.session import pin

WINDOW = 5  # words of a repeated sequence
SYMBOLS = "#*$%&|<>"  # characters of markup and tables
LEAST_WORDS = 10  # words of a text that the base rule lets pass
LEAST_SECONDS = 0.005  # of a rule over the sample: differences of two timings below this say nothing
SAMPLE_ROWS = 2000  # rows the order of the rules is estimated on


class Rule(NamedTuple):
    """``passes`` is built from the text column, so that a cascade evaluates only what it asks."""

    name: str
    passes: Callable[[Column], Column]


class Estimate(NamedTuple):
    rule: Rule
    seconds: float
    rejected: float


def repeat_words(w: Column) -> Column:
    """Words in windows of ``WINDOW`` words that occur twice or more in the array, the first included.

    Windows are 64-bit hashes. Where all differ, which is the rule, nothing is sorted. Else
    (hash, place) pairs are sorted, equal neighbours keep their places, and each place adds
    the words its window covers beyond the one before it.
    """
    def hashed(h: Column) -> Column:
        return F.when(F.size(h) < WINDOW, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW),
                        lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
        )

    def covered(pairs: Column) -> Column:
        def twin(p: Column, i: Column) -> Column:
            before = (i > 0) & (F.get(pairs, i - 1)["h"] == p["h"])
            return before | F.coalesce(F.get(pairs, i + 1)["h"] == p["h"], F.lit(False))

        places = F.sort_array(F.transform(F.filter(pairs, twin), lambda p: p["i"]))
        return F.aggregate(
            places,
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
            lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")),
            lambda acc: acc["n"],
        )

    def repeated(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(pairs, covered))

    return let(let(F.transform(w, lambda x: F.xxhash64(x)), hashed), repeated).cast("long")


def n_symbols(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    return let(lines_with_words(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def measures(text: Column) -> Column:
    """The base counts as one struct: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce(text, F.lit(""))
    by_words = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeat_words(w).alias("n_repeat_words"),
    ))
    return let(by_words, lambda m: F.struct(
        m["n_words"].alias("n_words"), m["word_chars"].alias("word_chars"), n_symbols(text).alias("n_symbols"),
        n_dup_lines(text).alias("n_dup_lines"), m["n_repeat_words"].alias("n_repeat_words"),
    ))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > 20 * n_words)


def _base(text: Column) -> Column:
    return let(words(text), lambda w: ~base_failed(F.size(w), repeat_words(w)))


def _characters(text: Column, kind: str = "") -> Column:
    """Characters of a kind, or all but white space: what is left when the runs of others are taken out, which is one match per run."""
    return F.char_length(F.regexp_replace(text, f"[^{kind}]+" if kind else SPACE, ""))


def _text_share(kind: str, percent: int, of: str = "") -> Callable[[Column], Column]:
    """Characters of ``kind`` are at most ``percent`` in a hundred of those of ``of``."""
    return lambda text: 100 * _characters(text, kind) <= percent * _characters(text, of)


#: The rules beyond the base: each names a kind of damage and its limit, wide enough for ordinary prose.
RULES: tuple[Rule, ...] = (
    Rule("symbols", _text_share(SYMBOLS, 10)),
    Rule("duplicate_lines", lambda t: let(
        lines_with_words(t), lambda x: 100 * (F.size(x) - F.size(F.array_distinct(x))) <= 60 * F.size(x))),
    Rule("word_length", lambda t: let(words(t), lambda w: (
        F.char_length(F.array_join(w, "")).between(2 * F.size(w), 15 * F.size(w))))),
    Rule("digits", _text_share(r"\p{Nd}", 40)),
    Rule("letters", lambda t: 100 * _characters(t, r"\p{L}") >= 50 * _characters(t)),
    Rule("capitals", _text_share(r"\p{Lu}", 50, r"\p{L}")),
)
BASE = Rule("base", _base)


def estimate(df: DataFrame, rules: Sequence[Rule], text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Seconds and rejected share of each rule on at most about ``sample_rows`` rows drawn from the whole table.

    The sample is written once; each rule is then timed alone over it: the quicker of two runs, as the first also compiles, less
    the time of a rule that asks nothing, which is that of starting a job and reading the sample.
    """
    rows = max(df.count(), 1)
    share = min(1.0, sample_rows / rows)
    sample = pin(df.select(F.coalesce(col(text), F.lit("")).alias("text")).sample(share, seed=5), "quality-sample")
    n = max(sample.count(), 1)

    def timed(passes: Column) -> tuple[float, int]:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            rejected = sample.agg(F.count_if(~passes)).first()[0]
            runs.append((time.perf_counter() - start, rejected))
        return min(runs)

    idle, _ = timed(F.length("text") >= 0)
    found = []
    for rule in rules:
        seconds, rejected = timed(rule.passes(F.col("text")))
        found.append(Estimate(rule, max(seconds - idle, LEAST_SECONDS), rejected / n))
    return found


def ordered(estimates: Sequence[Estimate]) -> list[Rule]:
    """Rules by rejection per second, highest first; rules that reject nothing come last, cheapest first."""
    return [e.rule for e in sorted(estimates, key=lambda e: (-e.rejected / max(e.seconds, 1e-9), e.seconds, e.rule.name))]


def cascade(rules: Sequence[Rule], text: Column) -> Column:
    """True where every rule passes; a rule is asked only where all before it passed."""
    verdict = F.lit(True)
    for rule in reversed(rules):
        verdict = F.when(F.coalesce(rule.passes(text), F.lit(True)), verdict).otherwise(F.lit(False))
    return verdict


def plan(df: DataFrame, rules: Sequence[Rule] = (BASE, *RULES), text: str = "text",
         sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules in the order the sample suggests."""
    return ordered(estimate(df, rules, text, sample_rows))


def filter_quality(df: DataFrame, text: str = "text", rules: Sequence[Rule] = (BASE, *RULES),
                   sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``df`` whose text passes every rule, all columns unchanged."""
    return df.filter(cascade(plan(df, rules, text, sample_rows), F.coalesce(col(text), F.lit(""))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the cascade for every document."""
    docs = documents(spark, sf_dir)
    rest = plan(docs, RULES)
    text = F.coalesce(F.col("text"), F.lit(""))
    measured = docs.select("doc_id", measures(F.col("text")).alias("m"), text.alias("text"))
    failed = base_failed(F.col("m.n_words"), F.col("m.n_repeat_words"))
    return measured.select(
        "doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
        failed.alias("base_failed"), F.when(failed, F.lit(False)).otherwise(cascade(rest, F.col("text"))).alias("kept"),
    )


ORACLE = r"""
WITH t AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM w WHERE len(w) >= 5),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) AS c FROM g),
p AS (SELECT r, least(5, i - coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -5)) AS n FROM h WHERE c > 1),
s AS (SELECT r, sum(n)::BIGINT AS n_repeat_words FROM p GROUP BY r),
m AS (SELECT doc_id, text, l, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN s USING (r)),
c AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  length(regexp_replace(text, '[^\p{Nd}]+', '', 'g')) AS digits, length(regexp_replace(text, '[^\p{L}]+', '', 'g')) AS letters,
  length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS capitals FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * n_symbols <= 10 * word_chars AND 100 * n_dup_lines <= 60 * len(l)
  AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND 100 * digits <= 40 * word_chars
  AND 100 * letters >= 50 * word_chars AND 100 * capitals <= 50 * letters AS kept
FROM c
"""
