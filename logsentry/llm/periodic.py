"""Runs of words that repeat with a period, found in Re-Pair grammars; the repeats can be taken out.

A run is a stretch of words whose smallest period q (words q apart are identical) fits into it ``times`` times or more, of ``least``
words or more, that no neighbouring word extends. Each text's word numbers are compressed by Re-Pair; the runs across the
middle of each rule are computed once, where the rule occurs first, moved to all places where it is derived, and merged to
maximal ones (``repair.py``). Texts are independent, so tasks take blocks of them: a block holds whole texts of about a million
characters, or one longer text. A text of n words takes time in proportion to n log n and to the different counts of its
repeated pairs, of which there are at most about the square root of 2n, and memory in proportion to n log n.

Words are longest stretches without white space (the blank and U+0009 to U+000D) and compared as they are. Null, empty and
short texts have no runs. Rows keep all their columns but the text; repeated rows and any keys are separate rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsentry.llm.pretokens import in_blocks
from logsentry.llm.repair import runs
from logsentry.llm.text import arrow_rows, col, documents, let, map_batches, words

LEAST = 24  # words of a run
TIMES = 3  # periods of a run

RUNS = T.ArrayType(T.StructType([
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())]))


def found(texts: list[str], least: int, times: int) -> tuple[list[np.ndarray], list[str]]:
    """Per text its runs (rows of start, length, period), and its words without the repeats of runs, joined by one blank."""
    split = [t.encode().split() for t in texts]  # of bytes: only ASCII white space
    lengths = np.array([len(w) for w in split], np.int64)
    number = defaultdict(count().__next__)
    ids = np.fromiter((number[w] for own in split for w in own), np.int64, int(lengths.sum()))
    owner = np.repeat(np.arange(len(texts)), lengths)
    start, end, period = runs(ids, owner, least, times)
    offset = np.cumsum(lengths) - lengths
    of = owner[start]
    told = np.column_stack([start - offset[of], end - start, period])
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    gone = np.zeros(len(ids) + 1, np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, end, -1)
    stay = np.cumsum(gone[:-1]) == 0
    each, left = [], []
    for k, own in enumerate(split):
        each.append(told[cuts[k] : cuts[k + 1]])
        if len(each[-1]):
            first = int(offset[k])
            own = [own[i] for i in np.flatnonzero(stay[first : first + len(own)]).tolist()]
        left.append(b" ".join(own).decode())
    return each, left


def periodic_runs(df: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES, name: str = "runs",
                  collapsed: str = "collapsed") -> DataFrame:
    """``df`` without ``text``, and with two columns (which replace those of their names): ``name``, an array of (start, length, period) in
    the order of starts and periods, in words from 0; and ``collapsed``, the text's words joined by one blank, without those
    that a run holds after its first period."""
    arrow_rows(df.sparkSession)
    kept = [c for c in df.columns if c not in (text, name, collapsed)]
    given = df.select(*[col(c) for c in kept], F.coalesce(col(text), F.lit("")).alias(text))
    schema = T.StructType([*(given.schema[c] for c in kept), T.StructField(name, RUNS, False), T.StructField(collapsed, T.StringType(), False)])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(kept)).to_pylist()
            each: list[np.ndarray] = []
            left: list[str] = []
            for a, b in in_blocks(texts):
                more, kept_words = found(texts[a:b], least, times)
                each += more
                left += kept_words
            told = np.concatenate([*each, np.empty((0, 3), np.int64)]).astype(np.int64)
            listed = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *map(len, each)]), pa.int32()),
                pa.StructArray.from_arrays([pa.array(told[:, k]) for k in range(3)], ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], listed, pa.array(left, pa.string())], [*kept, name, collapsed])

    return map_batches(given, look, schema)


def strongest(listed: Column) -> Column:
    """Of runs in order, the one with the greatest length / period (compared exactly), the first of equal ones; null if there is none."""
    better = lambda x, y: y["length"] * x["period"] > x["length"] * y["period"]
    return F.reduce(listed, F.get(listed, 0), lambda x, y: F.when(better(x, y), y).otherwise(x))


def made_periodic(key: Column, text: Column) -> Column:
    """The text's words joined by one blank; where ten divides the key's CRC-32, repeating from some word on."""
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        return F.transform(w, lambda x, i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))

    made = let(words(text), lambda w: F.when(F.size(w) > 0, F.array_join(repeated(w), " ")))
    return F.when(h % 10 == 0, made).otherwise(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document, after those whose id says so were made periodic: the strongest run, and digests of all runs and of what is left."""
    docs = documents(spark, sf_dir).select("doc_id", made_periodic(F.col("doc_id"), F.col("text")).alias("text"))
    told = periodic_runs(docs).withColumn("best", strongest(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return told.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
