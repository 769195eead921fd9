"""Counting byte-level BPE tokens without making them.

A piece of text is a linked list of symbols, at first its bytes. A heap holds the
adjacent pairs that have a merge rank; the lowest rank is popped, leftmost first, the two
symbols become one, and the pairs it forms with its neighbours are pushed. Entries whose
symbols have changed meanwhile are skipped. The count is the symbols at first minus the
merges done; no token gets an id. A piece of n bytes costs n log n, so a run of letters
as long as a document is no trap. Counts of pieces are kept per task in a table of bounded size.

Null and empty texts have no tokens. The vocabulary file is read by the driver and sent
to the tasks: its size is that of the model, not of the data.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsentry.llm.pretokens import in_blocks, slices
from logsentry.llm.text import arrow_rows, col, documents, map_batches

LIMIT = 512  # tokens a text may have before it is marked
CACHE = 500_000  # pieces a task remembers
MAX_VOCABULARY = 64 << 20  # bytes a vocabulary file may have to be sent to the tasks


class Merges(NamedTuple):
    """``pairs``: (left, right) symbol -> (rank, merged symbol). ``first``: the symbol of each byte. ``special``: strings that are one token."""

    pairs: dict[tuple[int, int], tuple[int, int]]
    first: list[int]
    special: tuple[str, ...]


@functools.cache
def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in such vocabularies: itself, or the next one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def load_merges(raw: bytes) -> Merges:
    """Merges of a tokenizer file of the byte-level kind, in the order of their ranks."""
    if len(raw) > MAX_VOCABULARY:
        raise ValueError(f"a vocabulary of {len(raw)} bytes is too large to send to every task")
    model = json.loads(raw)
    ids = model["model"]["vocab"]
    pairs = {}
    for rank, merge in enumerate(model["model"]["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        pairs.setdefault((ids[left], ids[right]), (rank, ids[left + right]))
    first = [0] * 256
    for letter, byte in byte_letters().items():
        first[byte] = ids[letter]
    return Merges(pairs, first, tuple(t["content"] for t in model.get("added_tokens", [])))


def merged(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> int:
    """Merge ``symbols`` in place, lowest rank first; merged-away places become -1. Returns the number of merges."""
    n = len(symbols)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        found = pairs.get((symbols[i], symbols[i + 1]))
        if found is not None:
            heap.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
    heapq.heapify(heap)
    done = 0
    while heap:
        _, i, left, right, into = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue  # one of the two has been merged since
        done += 1
        symbols[i], symbols[j] = into, -1
        j = after[i] = after[j]
        if j < n:
            before[j] = i
            found = pairs.get((into, symbols[j]))
            if found is not None:
                heapq.heappush(heap, (found[0], i, into, symbols[j], found[1]))
        h = before[i]
        if h >= 0:
            found = pairs.get((symbols[h], into))
            if found is not None:
                heapq.heappush(heap, (found[0], h, symbols[h], into, found[1]))
    return done


class Counts(dict):
    """Tokens of a piece, counted when first asked for."""

    def __init__(self, merges: Merges) -> None:
        super().__init__()
        self.merges = merges

    def __missing__(self, piece: bytes) -> int:
        first = self.merges.first
        n = len(piece) - merged([first[b] for b in piece], self.merges.pairs)
        if len(self) >= CACHE:
            self.clear()
        self[piece] = n
        return n


def count_texts(texts: list[str], counts: Counts) -> list[int]:
    """Tokens of each text. A special string inside a text is one token and parts what stands around it."""
    special = counts.merges.special
    parts, owner = texts, None
    totals = [0] * len(texts)
    if special and any(s in t for s in special for t in texts):
        cut = re.compile("|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)))
        parts, owner = [], []
        for i, t in enumerate(texts):
            own = cut.split(t)
            totals[i] += len(own) - 1
            parts += own
            owner += [i] * len(own)
    pieces, begin = slices(parts)
    each = list(map(counts.__getitem__, pieces))
    begin = begin.tolist()
    for k, (a, b) in enumerate(zip(begin, begin[1:])):
        totals[k if owner is None else owner[k]] += sum(each[a:b])
    return totals


@functools.lru_cache(2)
def _counts(raw: bytes) -> Counts:
    return Counts(load_merges(raw))


def token_counts(df: DataFrame, vocabulary: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """``df`` without ``text``, and with the number of tokens of each text under ``name`` (which replaces a column of that name).

    ``vocabulary`` is the path of the tokenizer file on the driver.
    """
    spark = df.sparkSession
    arrow_rows(spark)
    with open(vocabulary, "rb") as f:
        raw = f.read()
    load_merges(raw)  # fails here rather than in the tasks
    sent = spark.sparkContext.broadcast(raw)
    kept = [c for c in df.columns if c not in (text, name)]
    given = df.select(*[col(c) for c in kept], F.coalesce(col(text), F.lit("")).alias(text))
    schema = T.StructType([*(given.schema[c] for c in kept), T.StructField(name, T.LongType(), False)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(sent.value)
        for batch in batches:
            texts = batch.column(len(kept)).to_pylist()
            totals: list[int] = []
            for a, b in in_blocks(texts):
                totals += count_texts(texts[a:b], counts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(totals, pa.int64())], [*kept, name])

    return map_batches(given, count, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they exceed the limit."""
    import public_tokenizers

    docs = documents(spark, sf_dir).select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    counted = token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
