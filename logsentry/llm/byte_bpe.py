"""Byte-level BPE: texts to token ids with byte offsets, and back.

Pieces come from array scans (see ``pretokens``), each piece is merged once per task and
remembered, and a text's ids are the pieces' ids joined as raw integers. Offsets give the
byte each token starts at; decoding gathers all bytes of a batch from one table by ids
and offsets. Decoding of an encoded text gives its UTF-8 bytes exactly.

Null and empty texts have no ids and decode to nothing. The rank file is read by the
driver and sent to the tasks: its size is that of the model, not of the data.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsentry.llm.pretokens import in_blocks, slices
from logsentry.llm.text import arrow_rows, col, documents, map_batches
from logsentry.llm.token_counts import CACHE, MAX_VOCABULARY, merged

LONG_PIECE = 48  # bytes from which the heap beats scanning all pairs
_INTS = T.ArrayType(T.IntegerType(), False)


def load_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a file of lines "base64 rank"."""
    if len(raw) > MAX_VOCABULARY:
        raise ValueError(f"a vocabulary of {len(raw)} bytes is too large to send to every task")
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}


class PairRanks(dict):
    """(left id, right id) -> (rank, id) of the token they form, found when first asked for."""

    def __init__(self, ranks: dict[bytes, int], tokens: dict[int, bytes]) -> None:
        super().__init__()
        self.ranks, self.tokens = ranks, tokens

    def get(self, pair: tuple[int, int]) -> tuple[int, int] | None:  # dict.get would pass by __missing__
        return self[pair]

    def __missing__(self, pair: tuple[int, int]) -> tuple[int, int] | None:
        rank = self.ranks.get(self.tokens[pair[0]] + self.tokens[pair[1]])
        found = None if rank is None else (rank, rank)
        if len(self) >= CACHE:
            self.clear()
        self[pair] = found
        return found


class Pieces(dict):
    """The ids of a piece as int32 bytes, merged when first asked for."""

    def __init__(self, raw: bytes) -> None:
        super().__init__()
        self.ranks = load_ranks(raw)
        self.pairs = PairRanks(self.ranks, {r: t for t, r in self.ranks.items()})

    def __missing__(self, piece: bytes) -> bytes:
        whole = self.ranks.get(piece)
        ids = [whole] if whole is not None else self.long(piece) if len(piece) > LONG_PIECE else self.short(piece)
        found = np.array(ids, np.int32).tobytes()
        if len(self) >= CACHE:
            self.clear()
        self[piece] = found
        return found

    def long(self, piece: bytes) -> list[int]:
        symbols = [self.ranks[piece[i : i + 1]] for i in range(len(piece))]
        merged(symbols, self.pairs)
        return [s for s in symbols if s >= 0]

    def short(self, piece: bytes) -> list[int]:
        rank_of = self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [rank_of(a + b, 1 << 30) for a, b in zip(parts, parts[1:])]
        while pairs and (least := min(pairs)) < 1 << 30:
            i = pairs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank_of(parts[i] + parts[i + 1], 1 << 30)
            if i:
                pairs[i - 1] = rank_of(parts[i - 1] + parts[i], 1 << 30)
        return [self.ranks[p] for p in parts]


@functools.lru_cache(2)
def _pieces(raw: bytes) -> Pieces:
    return Pieces(raw)


@functools.lru_cache(2)
def _token_table(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes in a row; by id, where they start and how many they are."""
    ranks = load_ranks(raw)
    size = max(ranks.values()) + 1
    tokens = [b""] * size
    for t, r in ranks.items():
        tokens[r] = t
    lengths = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths


def encode_texts(texts: list[str], raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts in a row, the byte of its text each id starts at, and where each text's ids start (one more at the end)."""
    known = _pieces(raw)
    pieces, begin = slices(texts)
    begin = begin.tolist()
    joined = [b"".join(map(known.__getitem__, pieces[a:b])) for a, b in zip(begin, begin[1:])]
    ids = np.frombuffer(b"".join(joined), np.int32)
    rows = np.concatenate(([0], np.cumsum([len(x) // 4 for x in joined]))).astype(np.int64)
    places = np.concatenate(([0], np.cumsum(_token_table(raw)[2][ids])))
    return ids, (places[:-1] - np.repeat(places[rows[:-1]], np.diff(rows))).astype(np.int32), rows


def decode_ids(ids: np.ndarray, offsets: np.ndarray, rows: np.ndarray, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and where each text's bytes start. ``rows`` as ``encode_texts`` gives them."""
    table, where, lengths = _token_table(raw)
    if len(ids) and (ids.min() < 0 or ids.max() >= len(lengths)):
        raise ValueError("an id is not in the vocabulary")
    sizes = lengths[ids]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    begin = ends[rows]
    place = offsets + np.repeat(begin[:-1], np.diff(rows))  # of each token among all bytes
    if not np.array_equal(place, ends[:-1]):
        raise ValueError("offsets do not fit the ids")
    return table[np.repeat(where[ids] - place, sizes) + np.arange(ends[-1])], begin


def _kept(df: DataFrame, *gone: str) -> list[str]:
    return [c for c in df.columns if c not in gone]


def _sent(spark: SparkSession, ranks: str):
    with open(ranks, "rb") as f:
        raw = f.read()
    load_ranks(raw)  # fails here rather than in the tasks
    return spark.sparkContext.broadcast(raw)


def encode(df: DataFrame, ranks: str, text: str = "text") -> DataFrame:
    """``df`` without ``text``, with ``ids`` and ``offsets`` (array<int>; columns of these names are replaced).

    ``ranks`` is the path of the rank file on the driver.
    """
    arrow_rows(df.sparkSession)
    sent, kept = _sent(df.sparkSession, ranks), _kept(df, text, "ids", "offsets")
    given = df.select(*[col(c) for c in kept], F.coalesce(col(text), F.lit("")).alias(text))
    schema = T.StructType([*(given.schema[c] for c in kept), T.StructField("ids", _INTS), T.StructField("offsets", _INTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(kept)).to_pylist()
            for a, b in in_blocks(texts):
                ids, offsets, rows = encode_texts(texts[a:b], sent.value)
                rows = pa.array(rows, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(a, b - a) for c in batch.columns[: len(kept)]),
                     pa.ListArray.from_arrays(rows, pa.array(ids)), pa.ListArray.from_arrays(rows, pa.array(offsets))],
                    [*kept, "ids", "offsets"])

    return map_batches(given, run, schema)


def decode(df: DataFrame, ranks: str, name: str = "decoded") -> DataFrame:
    """``df`` without ``ids`` and ``offsets``, with the bytes they stand for under ``name`` (which replaces a column of that name)."""
    arrow_rows(df.sparkSession)
    sent, kept = _sent(df.sparkSession, ranks), _kept(df, "ids", "offsets", name)
    given = df.select(*[col(c) for c in kept], "ids", "offsets")
    schema = T.StructType([*(given.schema[c] for c in kept), T.StructField(name, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, offsets = batch.column(len(kept)), batch.column(len(kept) + 1)
            rows = np.concatenate(([0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
            data, begin = decode_ids(ids.flatten().to_numpy(), offsets.flatten().to_numpy(), rows, sent.value)
            decoded = pa.Array.from_buffers(pa.large_binary(), len(batch), [None, pa.py_buffer(begin.astype(np.int64)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], decoded.cast(pa.binary())], [*kept, name])

    return map_batches(given, run, schema)


def round_trip(df: DataFrame, ranks: str, text: str = "text") -> DataFrame:
    """``df`` without ``text``, with n_tokens, ids_sha256 (decimal ids joined by a space) and decoded_sha256 of the encoded and decoded text."""
    encoded = encode(df, ranks, text)
    kept = _kept(df, text, "n_tokens", "ids_sha256", "decoded_sha256", "ids", "offsets")
    digested = encoded.select(
        *[col(c) for c in kept], F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"), "ids", "offsets")
    return decode(digested, ranks).withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and what they decode to, as digests."""
    import public_tokenizers

    return round_trip(documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
