"""Repeated runs of lines, found with a suffix array over line ids; later copies are deleted.

A line is known by two 64-bit hashes. Only lines that occur twice or more take part: a run ends where a line
occurs once or the text ends. A suffix is a place in a text and everything from there to the end of its run.

* Ranks by the first line are places of the hashes in their order. Prefix doubling ranks suffixes by 2, 4, 8, ...
  lines: a suffix's next rank is that of (its rank, the rank as many lines further on). The distinct pairs are
  counted map-side and ranked over ranges, so a line that makes up a third of all lines is one row there. A place whose rank no
  other has, or whose run has ended, is settled: later rounds only touch the others, and doubling ends when none is left.
* Equal ranks are one entry of the suffix array. The longest common prefix of neighbours is found by descending
  through the rounds' ranks: where both have one rank, both step on by the round's length.
* Neighbours whose common prefix has at least ``min_lines`` lines form an interval: the occurrences of a repeated
  run. All but the first of them, in the order of key, row and line, are later copies, and their first
  ``min_lines`` lines go. The places further on in a longer run are in intervals themselves, so the whole of
  each maximal run goes. A single line goes as a later copy if it has ``min_words`` words or more.

Lines without a word are never deleted and do not part a run. Null texts stay null, empty ones empty; a text
whose lines are all later copies becomes what is left, which may be the empty text. Null keys come first in the
order. Rows that repeat a key, or a whole row, are separate texts in a fixed order. All columns are kept.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logsentry.llm.text import WORD, col, documents, packed, word_count
from logsentry.operators.order import prefix_sum
from logsentry.session import BROADCAST_ROWS, broadcast_if_small, pin

MIN_LINES = 2  # lines of a run
MIN_WORDS = 10  # words of a line that counts as a run by itself
LOOKUP_ROWS = 250_000  # ranks that are sent to the tasks; several such tables are held at a time


def numbered(df: DataFrame, key: str, text: str) -> DataFrame:
    """(rid, key, text, row) of every row, written once: ``rid`` must not change, ``row`` holds all columns."""
    return pin(df.select(F.monotonically_increasing_id().alias("rid"), col(key).alias("key"), col(text).alias("text"),
                         packed(df)), "rows")


def lines(rows: DataFrame) -> DataFrame:
    """(rid, key, i, ln, words, h1, h2) of the lines with a word; i counts them, ln is their number among all lines."""
    every = F.transform(F.split("text", "\n"), lambda x, n: F.struct(n.alias("ln"), x.alias("line")))
    told = rows.select("rid", "key", F.posexplode(F.filter(every, lambda s: s["line"].rlike(WORD))).alias("i", "s"))
    return pin(told.select(
        "rid", "key", "i", "s.ln", F.regexp_count("s.line", F.lit(WORD)).alias("words"),
        F.xxhash64("s.line").alias("h1"), F.xxhash64(F.lit(1), "s.line").alias("h2")), "lines")


def _sent(table: DataFrame) -> DataFrame:
    """A written lookup table, sent to every task where it is small."""
    return broadcast_if_small(table, LOOKUP_ROWS)


def _ranks(counted: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rank) of counted keys (keys, c): the number of places with smaller keys."""
    run = prefix_sum(counted, keys, ["c"])
    return pin(run.select(*keys, (F.col("cum_c") - F.col("c")).alias("rank")), "ranks")


def first_ranks(told: DataFrame) -> DataFrame:
    """Places (rid, key, i, ln, words, left, r) of lines that occur twice or more.

    ``left``: lines to the end of the run.
    """
    ranks = _ranks(told.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), ["h1", "h2"])
    places = told.join(_sent(ranks), ["h1", "h2"]).drop("h1", "h2").withColumnRenamed("rank", "r")
    in_text = Window.partitionBy("rid").orderBy("i")
    run = places.withColumn("run", F.col("i") - F.row_number().over(in_text))
    return pin(run.withColumn("left", F.max("i").over(Window.partitionBy("rid", "run")) - F.col("i") + 1).drop("run"),
               "places")


class Doubled(NamedTuple):
    """``final``: (key, rid, i, left, r), the ranks of all places by their whole runs. ``rounds``: (rid, i, r) by 1, 2, 4, ... lines, of those
    places that have so many lines and share them with another place."""

    final: DataFrame
    rounds: list[DataFrame]


def doubled(places: DataFrame) -> Doubled:
    """Prefix doubling until every place is settled."""
    open_ = places.select("key", "rid", "i", "left", "r")
    settled, rounds = [], []
    while not open_.isEmpty():
        step = 1 << len(rounds)
        rounds.append(open_.select("rid", "i", "r"))
        known = reduce(DataFrame.unionByName, [*settled, open_]).select("rid", F.col("i").alias("there"), F.col("r").alias("ahead"))
        if settled:  # only texts with open places are asked
            known = known.join(_sent(pin(open_.select("rid").distinct(), "open")), "rid", "left_semi")
        pairs = open_.withColumn("there", F.col("i") + step).join(known, ["rid", "there"], "left").drop("there")
        pairs = pin(pairs.withColumn("then", F.when(F.col("left") > step, F.col("ahead") + 1).otherwise(F.lit(0))).drop("ahead"), "pairs")
        counted = pairs.groupBy("r", "then").agg(F.count(F.lit(1)).alias("c"))
        run = pin(prefix_sum(counted, ["r", "then"], ["c"]).select("r", "then", "c", (F.col("cum_c") - F.col("c")).alias("before")), "run")
        # A rank is the number of places before it: places of one rank part within the room that they had.
        first = run.groupBy("r").agg(F.min("before").alias("first"))
        found = pin(run.join(first, "r").select(
            "r", "then", (F.col("r") + F.col("before") - F.col("first")).alias("rank"), "c"), "ranks")
        ranked = pin(pairs.join(_sent(found), ["r", "then"]).select(
            "key", "rid", "i", "left", F.col("rank").alias("r"), ((F.col("c") == 1) | (F.col("then") == 0)).alias("done")), "round")
        settled.append(ranked.filter("done").drop("done"))
        open_ = ranked.filter("NOT done").drop("done")
    return Doubled(reduce(DataFrame.unionByName, settled) if settled else open_, rounds)


def suffix_array(ranked: Doubled) -> DataFrame:
    """Entries (r, c, at, left, lcp) in the order of r: c suffixes of one rank, the first of them at ``at`` (key, rid, i),
    and the lines in common with the entry before."""
    entries = pin(ranked.final.groupBy("r").agg(
        F.count(F.lit(1)).alias("c"), F.min(F.struct("key", "rid", "i")).alias("at"), F.first("left").alias("left")), "entries")
    state = entries.select(
        F.col("r"), (F.col("r") + F.col("c")).alias("next"), F.col("at.rid").alias("x"), F.col("at.i").alias("xi"), "left",
    )
    state = state.alias("p").join(
        entries.select(F.col("r").alias("next"), F.col("at.rid").alias("y"), F.col("at.i").alias("yi")), "next"
    ).withColumn("l", F.lit(0))
    for k in reversed(range(len(ranked.rounds))):
        todo = state.filter(F.col("left") - F.col("l") >= 1 << k)  # the others have no such run ahead
        for rid, i in (("x", "xi"), ("y", "yi")):
            there = ranked.rounds[k].select(F.col("rid").alias(rid), F.col("i").alias(f"{i}_"), F.col("r").alias(f"r_{rid}"))
            todo = todo.withColumn(f"{i}_", F.col(i) + F.col("l")).join(there, [rid, f"{i}_"], "left").drop(f"{i}_")
        equal = F.coalesce(F.col("r_x") == F.col("r_y"), F.lit(False))
        met = todo.withColumn("l", F.col("l") + F.when(equal, 1 << k).otherwise(0)).drop("r_x", "r_y")
        state = pin(state.filter(F.col("left") - F.col("l") < 1 << k).unionByName(met), "lcp")
    lcp = state.select(F.col("next").alias("r"), F.col("l").alias("lcp"))
    return entries.join(lcp, "r", "left").withColumn("lcp", F.coalesce("lcp", F.lit(0)))


def intervals(entries: DataFrame, min_lines: int) -> DataFrame:
    """(r, first): the first occurrence of the repeated run of ``min_lines`` lines that each entry's suffixes start with."""
    long = entries.filter(F.col("left") >= min_lines).withColumn("new", (F.col("lcp") < min_lines).cast("long"))
    named = pin(prefix_sum(long.select("r", "at", "new"), ["r"], ["new"]).select("r", "at", F.col("cum_new").alias("interval")),
                "intervals")
    first = named.groupBy("interval").agg(F.min("at").alias("first"))
    return named.select("r", "interval").join(first, "interval").select("r", "first")


def later_copies(rows: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """(rid, key, i, ln, run): the lines of all later copies. ``run`` numbers the maximal runs of a text."""
    places = first_ranks(lines(rows))
    ranked = doubled(places)
    starts = pin(intervals(suffix_array(ranked), min_lines), "starts")
    alone = places.groupBy("r").agg(F.min(F.struct("key", "rid", "i")).alias("first_line"))
    at = F.struct("key", "rid", "i")
    marked = (
        places.join(_sent(pin(alone, "alone")), "r")
        .withColumn("single", (F.col("words") >= min_words) & (at > F.col("first_line"))).drop("r", "first_line")
        .join(ranked.final.select("rid", "i", "r"), ["rid", "i"])
        .join(_sent(starts), "r", "left")
        .withColumn("starts", (F.col("left") >= min_lines) & F.coalesce(at > F.col("first"), F.lit(False)))
    )
    back = Window.partitionBy("rid").orderBy("i").rangeBetween(-(min_lines - 1), 0)
    gone = marked.withColumn("gone", F.col("single") | F.max("starts").over(back)).filter("gone")
    return pin(gone.select("rid", "key", "i", "ln", (
        F.col("i") - F.row_number().over(Window.partitionBy("rid").orderBy("i"))).alias("run")), "later-copies")


def repeated_runs(df: DataFrame, key: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES,
                  min_words: int = MIN_WORDS) -> DataFrame:
    """The later copies as runs: key, first_line and last_line (numbers among all lines from 0), n_lines with words."""
    gone = later_copies(numbered(df, key, text), min_lines, min_words)
    return gone.groupBy("rid", "key", "run").agg(
        F.min("ln").alias("first_line"), F.max("ln").alias("last_line"), F.count(F.lit(1)).alias("n_lines")
    ).select(F.col("key").alias(key), "first_line", "last_line", "n_lines")


def _cleaned(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """``rows`` with ``clean``, the text without its deleted lines, and ``removed``, their number."""
    each = pin(gone.groupBy("rid").agg(F.collect_list("ln").alias("gone")), "deletions")
    if gone.count() <= BROADCAST_ROWS:  # the numbers of so many lines fit; texts then stay where they are
        each = F.broadcast(each)
    split = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("gone"))
    return rows.join(each, "rid", "left").withColumn("lines", split).withColumns({
        "clean": F.when(F.col("gone").isNull(), F.col("text")).otherwise(
            F.array_join(F.transform(left, lambda n: F.get("lines", n)), "\n")),
        "removed": F.coalesce(F.size("gone"), F.lit(0)).cast("long"),
    })


def drop_repeated_lines(df: DataFrame, key: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES,
                        min_words: int = MIN_WORDS, least: int = 0) -> DataFrame:
    """``df``, all columns, with the later copies of repeated line runs gone from ``text``.

    All rows stay, except those that lost lines and have fewer than ``least`` words left.
    """
    rows = numbered(df, key, text)
    clean = _cleaned(rows, later_copies(rows, min_lines, min_words))
    if least:
        clean = clean.filter((F.col("removed") == 0) | (word_count(F.col("clean")) >= least))
    return clean.select(*[F.col("clean").alias(text) if c == text else F.col("row").getField(c).alias(c) for c in df.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its later copies of repeated runs."""
    rows = numbered(documents(spark, sf_dir).select("doc_id", "text"), "doc_id", "text")
    clean = _cleaned(rows, later_copies(rows))
    return clean.select(
        F.col("key").alias("doc_id"), F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(WORD))).cast("long").alias("n_lines"),
        F.col("removed").alias("n_removed"), F.col("clean").alias("text"))


ORACLE = r"""
WITH a AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
b AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS ln, l FROM a),
c AS (SELECT doc_id, ln, l[ln] AS line, row_number() OVER (PARTITION BY doc_id ORDER BY ln) AS i
  FROM b WHERE regexp_matches(l[ln], '[^\x20\x09-\x0D]')),
d AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS nxt,
  len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words FROM c),
e AS (SELECT *, words >= 10 AND (doc_id, i) > min((doc_id, i)) OVER (PARTITION BY line) AS single,
  nxt IS NOT NULL AND (doc_id, i) > min((doc_id, i)) OVER (PARTITION BY line, nxt) AS starts FROM d),
f AS (SELECT *, single OR starts OR coalesce(lag(starts) OVER (PARTITION BY doc_id ORDER BY i), false) AS gone FROM e),
g AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed FROM f GROUP BY doc_id),
h AS (SELECT b.doc_id, string_agg(b.l[b.ln], chr(10) ORDER BY b.ln) FILTER (NOT coalesce(f.gone, false)) AS kept
  FROM b LEFT JOIN f ON b.doc_id = f.doc_id AND b.ln = f.ln GROUP BY b.doc_id)
SELECT a.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  CASE WHEN text IS NOT NULL THEN coalesce(kept, '') END AS text
FROM a LEFT JOIN g ON a.doc_id = g.doc_id LEFT JOIN h ON a.doc_id = h.doc_id
"""
