"""A toxicity classifier whose scores must not move when identity terms are swapped.

Features of a text are the distinct words and their beginnings of 4 to 6 letters. Over all labelled training rows,
documents with each feature are counted by label (partial counts leave each task, sums are reduced map-side), and
the ``FEATURES`` most telling ones become the model's inputs. A logistic regression is fitted on at most
``TRAIN_ROWS`` of these rows. For each row with an identity term, counterfactual rows carry the other terms of its group
in its place; the fit adds ``COUNTERFACTUAL`` times the mean squared change of the log-odds between a row and its
counterfactuals. A term that only marks who is spoken of is so denied a weight of its own, which lowers false
positives on neutral mentions. Scoring is one pass over the texts with the model in every task.

Null and empty texts have no features and get the score of the intercept. Rows that repeat an id are scored one
by one; of an id's rows the least text is learnt from, and several labels of one id count as toxic if any is. Without labelled rows of both kinds every score
is the smoothed share of toxic labels (0.5 without any).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsentry.llm.text import arrow_rows, col, documents, map_batches
from logsentry.session import BROADCAST_ROWS, pin

FEATURES = 4096  # inputs of the model
TRAIN_ROWS = 20_000  # labelled rows the regression is fitted on, at most; counts cover all
MIN_DOCS = 4  # labelled rows a feature must occur in
BEGINNINGS = (4, 5, 6)
COUNTERFACTUAL = 5.0
RIDGE = 1e-4
STEPS = 400
THRESHOLD = 0.3
FLUSH = 200_000  # features a task counts before it passes its counts on
CACHE = 500_000  # words a task remembers the features of

#: Terms of one group may stand for each other.
IDENTITY: tuple[tuple[str, ...], ...] = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("women", "men"), ("woman", "man"), ("girl", "boy"), ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino"), ("immigrant", "citizen"), ("immigrants", "citizens"),
    ("old", "young"), ("deaf", "blind", "disabled"),
)

_WORD = re.compile(r"[^\W\d_]+")


class Model(NamedTuple):
    features: dict[str, int]
    weights: np.ndarray
    bias: float


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(word: str) -> list[str]:
    """A word and its beginnings; a beginning is marked so that it is no word."""
    return [word, *[word[:n] + "~" for n in BEGINNINGS if len(word) > n]]


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(key, text, label) of the rows to learn from: labelled and not held out, written once."""
    told = labels.select(col(key).alias("key"), col(label).cast("int").alias("label")).dropna().filter(
        ~held_out(F.col("key"))).groupBy("key").agg(F.max("label").alias("label"))
    told = pin(told, "labels")
    if told.count() <= BROADCAST_ROWS:
        told = F.broadcast(told)
    given = df.select(col(key).alias("key"), F.coalesce(col(text), F.lit("")).alias("text"))
    return pin(given.join(told, "key").groupBy("key", "label").agg(F.min("text").alias("text")).select("key", "text", "label"), "labelled")


def feature_counts(rows: DataFrame) -> DataFrame:
    """(feature, toxic, clean): labelled rows that have the feature, by label."""
    arrow_rows(rows.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            names = list(seen[0].keys() | seen[1].keys())
            batch = pa.RecordBatch.from_arrays([
                pa.array(names, pa.string()), pa.array([seen[1][n] for n in names], pa.int64()),
                pa.array([seen[0][n] for n in names], pa.int64())], ["feature", "toxic", "clean"])
            for c in seen:
                c.clear()
            return batch

        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = set()
                for w in words_of(text):
                    found.update(features_of(w))
                seen[1 if label else 0].update(found)
                if len(seen[0]) + len(seen[1]) > FLUSH:
                    yield out()
        yield out()

    parts = rows.select("text", "label").mapInArrow(count, "feature string, toxic long, clean long")
    return parts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose(counts: DataFrame, toxic: int, clean: int, features: int = FEATURES) -> list[str]:
    """The features whose log-odds ratio is largest in units of its error, ties by name."""
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    ratio = F.log(a / (toxic - F.col("toxic") + 0.5)) - F.log(b / (clean - F.col("clean") + 0.5))
    error = F.sqrt(1 / a + 1 / b + 1 / (toxic - F.col("toxic") + 0.5) + 1 / (clean - F.col("clean") + 0.5))
    top = counts.filter(F.col("toxic") + F.col("clean") >= MIN_DOCS).select("feature", F.round(F.abs(ratio) / error, 9).alias("z"))
    return [r[0] for r in top.orderBy(F.desc("z"), "feature").limit(features).collect()]  # as many as the model has inputs


class Known(dict):
    """The model's inputs that a word sets."""

    def __init__(self, features: dict[str, int]) -> None:
        super().__init__()
        self.features = features

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(self.features[f] for f in features_of(word) if f in self.features)
        if len(self) >= CACHE:
            self.clear()
        self[word] = found
        return found

    def inputs(self, words: set[str]) -> set[int]:
        out: set[int] = set()
        for found in map(self.__getitem__, words):
            if found:
                out.update(found)
        return out


def swaps(words: set[str], identity: Sequence[Sequence[str]] = IDENTITY) -> list[set[str]]:
    """The word sets with one identity term replaced by another of its group."""
    return [
        (words - {term}) | {other}
        for group in identity for term in group if term in words for other in group if other != term
    ]


def vectors(rows: DataFrame, features: dict[str, int], identity: Sequence[Sequence[str]] = IDENTITY) -> DataFrame:
    """(key, label, inputs, swaps): the inputs of each row, and what each of its counterfactuals changes.

    An input that a swap takes away is given as its number, one that it adds as minus one less its number: the rest cancels out in the penalty.
    """
    schema = T.StructType([
        rows.schema["key"], T.StructField("label", T.IntegerType()), T.StructField("inputs", T.ArrayType(T.IntegerType())),
        T.StructField("swaps", T.ArrayType(T.ArrayType(T.IntegerType())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(features)
        for batch in batches:
            inputs, changes = [], []
            for text in batch.column(2).to_pylist():
                words = words_of(text)
                own = known.inputs(words)
                inputs.append(sorted(own))
                other = (known.inputs(w) for w in swaps(words, identity))
                changes.append([[*sorted(own - o), *(-1 - i for i in sorted(o - own))] for o in other])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(inputs, pa.list_(pa.int32())),
                 pa.array(changes, pa.list_(pa.list_(pa.int32())))], ["key", "label", "inputs", "swaps"])

    return rows.select("key", "label", "text").mapInArrow(run, schema)


def _flat(lists: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(x) for x in lists]
    return (np.repeat(np.arange(len(lists), dtype=np.int32), sizes),
            np.fromiter((i for x in lists for i in x), np.int32, sum(sizes)))


def fit(inputs: list[list[int]], labels: np.ndarray, changes: list[list[list[int]]], size: int,
        counterfactual: float = COUNTERFACTUAL, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient steps with per-coordinate scaling (Adam) over all rows.

    ``changes``: per row and swap the inputs taken away, and those added as minus one less their number.
    """
    row, column = _flat(inputs)
    pairs = [o for each in changes for o in each]
    # The change of a pair: inputs of the row alone count 1, those of the counterfactual alone -1.
    ra, ca = _flat([[i for i in o if i >= 0] for o in pairs])
    rb, cb = _flat([[-1 - i for i in o if i < 0] for o in pairs])
    n, m = len(labels), max(len(pairs), 1)
    w, mean, square = (np.zeros(size + 1) for _ in range(3))
    share = (labels.sum() + 0.5) / (n + 1)
    w[size] = np.log(share / (1 - share))
    for step in range(1, steps + 1):
        z = np.bincount(row, w[column], n) + w[size]
        error = (1 / (1 + np.exp(-z)) - labels) / n
        gradient = np.append(np.bincount(column, error[row], size), error.sum())
        change = np.bincount(ra, w[ca], m) - np.bincount(rb, w[cb], m)
        pull = 2 * counterfactual * change / m
        gradient[:size] += np.bincount(ca, pull[ra], size) - np.bincount(cb, pull[rb], size) + RIDGE * w[:size]
        mean += 0.1 * (gradient - mean)
        square += 0.001 * (gradient**2 - square)
        w -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return w[:size], float(w[size])


def train(rows: DataFrame, identity: Sequence[Sequence[str]] = IDENTITY, counterfactual: float = COUNTERFACTUAL,
          train_rows: int = TRAIN_ROWS) -> Model:
    """The model for labelled rows (key, text, label)."""
    by_label = {r[0]: r[1] for r in rows.groupBy((F.col("label") != 0).alias("toxic")).count().collect()}
    toxic, clean = by_label.get(True, 0), by_label.get(False, 0)
    if not toxic or not clean:
        share = (toxic + 0.5) / (toxic + clean + 1)
        return Model({}, np.zeros(0), float(np.log(share / (1 - share))))
    chosen = choose(feature_counts(rows), toxic, clean)
    names = list(dict.fromkeys([*chosen, *(f for group in identity for t in group for f in features_of(t))]))
    features = {f: i for i, f in enumerate(names)}
    # A bounded sample by hash: the regression has a few thousand inputs, so more rows add little.
    part = min(1.0, train_rows / (toxic + clean))
    picked = rows if part == 1 else rows.filter(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < int(part * 1_000_000))
    got = vectors(picked, features, identity).orderBy("key").collect()
    weights, bias = fit([r["inputs"] for r in got], np.array([float(r["label"] != 0) for r in got]),
                        [r["swaps"] for r in got], len(names), counterfactual)
    kept = {f: i for f, i in features.items() if abs(weights[i]) > 1e-6}
    return Model(kept, weights, bias)


def score(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``df`` without ``text``, with the chance of toxicity under ``name`` (which replaces a column of that name)."""
    spark = df.sparkSession
    arrow_rows(spark)
    kept = [c for c in df.columns if c not in (text, name)]
    given = df.select(*[col(c) for c in kept], F.coalesce(col(text), F.lit("")).alias(text))
    schema = T.StructType([*(given.schema[c] for c in kept), T.StructField(name, T.DoubleType(), False)])
    sent = spark.sparkContext.broadcast(model)  # a few thousand weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights, bias = sent.value
        known = Known(features)
        for batch in batches:
            odds = [bias + float(sum(weights[i] for i in sorted(known.inputs(words_of(t))))) for t in batch.column(len(kept)).to_pylist()]
            chance = 1 / (1 + np.exp(-np.clip(np.array(odds, float), -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(chance, pa.float64())], [*kept, name])

    return map_batches(given, run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of the labelled rows that are not held out."""
    docs = documents(spark, sf_dir)
    model = train(labelled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
