"""Secrets in texts, found by one automaton for all rules in one pass over the bytes.

The rules' automaton (``automaton.py``) is built on the driver and sent to the tasks; its size is that of the rules. A task
reads the bytes of a block of texts once: after many pairs of bytes (a letter and a blank, say) the state no longer depends on
what came before, so the block is cut at such pairs into pieces, and all pieces advance together, a byte at a time, through
the transition array. A match ends where its rule stops accepting, and is dropped if the rule has not accepted for long enough;
else its start is found by reading the match backwards with the rule's reversed automaton, not beyond the end of the match before.

Spans are in code points, the end exclusive, in the order of starts, then of the rules. Null and empty texts have none. Rows keep
all their columns but the text, repeated rows and any keys included.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsentry.llm.automaton import Automaton, Rule, compiled
from logsentry.llm.pretokens import in_blocks
from logsentry.llm.text import arrow_rows, col, documents, map_batches

# The kinds every scan has: values of 12 characters, keys of 18 with their mark of 4, runs of 16.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 12),
    Rule("access", r"AKIA[A-Z0-9]+", 14),
    Rule("hex", r"[0-9a-f]+", 16),
)
# Credentials that carry their own mark.
MARKED = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", 20),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 10),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 30),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 10),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MARKED
PIECE = 128  # bytes of a piece, about
FEW = 12  # pieces that are left: these are read one by one

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def states(read: np.ndarray, auto: Automaton) -> np.ndarray:
    """The automaton's state after each byte of ``read`` (byte classes), starting at the start."""
    width = auto.width
    sure = np.flatnonzero(auto.known[read[:-1], read[1:]] >= 0) + 1 if len(read) > 1 else np.empty(0, np.int64)
    near = np.searchsorted(sure, np.arange(PIECE, len(read), PIECE))
    cuts = sure[np.unique(near[near < len(sure)])]
    begin = np.concatenate(([0], cuts + 1))
    state = np.concatenate(([0], auto.known[read[cuts - 1], read[cuts]]))
    length = np.diff(np.append(begin, len(read)))
    order = np.argsort(-length, kind="stable")
    begin, state, length = begin[order], state[order], length[order]
    out = np.empty(len(read), np.int32)
    alive = np.searchsorted(-length, -np.arange(length[0] + 1), side="left") if len(length) else [0]
    for t, k in enumerate(alive):  # k pieces are longer than t
        if k < FEW:
            break
        at = begin[:k] + t
        state = auto.table[state[:k] * width + read[at]]
        out[at] = state
    if k:
        table = auto.table.tolist()
        for piece in range(k):
            s = int(state[piece])
            a, b = int(begin[piece]) + t, int(begin[piece] + length[piece])
            left = read[a:b].tolist()
            for i, c in enumerate(left):
                left[i] = s = table[s * width + c]
            out[a:b] = left
    return out


def _start(raw: bytes, classes: list[int], back: tuple[list[list[int]], list[int]], end: int, bound: int) -> int:
    """The first start of a match that ends at ``end``, not before ``bound``."""
    table, kind = back
    state, start = 0, end
    for at in range(end - 1, bound - 1, -1):
        state = table[state][classes[raw[at]]]
        if kind[state] < 0:
            break
        if kind[state]:
            start = at
    return start


def found(texts: list[str], rules: Sequence[Rule]) -> list[list[tuple[int, int, int]]]:
    """Per text the spans (start, number of the rule, end) in order."""
    auto = compiled(tuple(rules))
    raw = [t.encode() for t in texts]
    joined = b"\n".join(raw) + b"\n"
    bytes_ = np.frombuffer(joined, np.uint8)
    read = auto.classes[bytes_]
    ends = np.cumsum([len(r) + 1 for r in raw])
    read[ends - 1] = auto.width - 1  # between texts
    state = states(read, auto)
    within = auto.within[state]
    hits = np.flatnonzero(within)
    spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    classes = auto.classes.tolist()
    now, after, fresh = within[hits], within[hits + 1], auto.first[state[hits]]  # the last byte is between texts
    stays = after & ~auto.first[state[hits + 1]]
    for k, rule in enumerate(rules):
        bit = np.uint32(1 << k)
        begun = hits[(fresh & bit) > 0]
        stops = hits[(now & ~stays & bit) > 0] + 1
        before = np.concatenate(([0], stops[:-1]))  # the end of the match before, dropped or not
        chosen = np.flatnonzero(stops - begun >= rule.least)
        owner = np.searchsorted(ends, stops[chosen], side="right")
        for i, text in zip(chosen.tolist(), owner.tolist()):
            end = int(stops[i])
            bound = max(int(before[i]), int(ends[text]) - len(raw[text]) - 1)
            spans[text].append((_start(joined, classes, auto.back[k], end, bound), k, end))
    for text, own in enumerate(spans):
        if own:
            first = int(ends[text]) - len(raw[text]) - 1
            if len(texts[text]) == len(raw[text]):
                points = None
            else:  # code points before each byte
                points = np.concatenate(([0], np.cumsum((bytes_[first : first + len(raw[text])] & 0xC0) != 0x80)))
            spans[text] = sorted((a - first, k, b - first) if points is None else (int(points[a - first]), k, int(points[b - first]))
                                 for a, k, b in own)
    return spans


def scan(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", name: str = "spans") -> DataFrame:
    """``df`` without ``text``, and with the secrets of each text under ``name``: an array of (kind, start, end)."""
    spark = df.sparkSession
    arrow_rows(spark)
    rules = tuple(rules)
    compiled(rules)  # fails here rather than in the tasks
    kept = [c for c in df.columns if c not in (text, name)]
    given = df.select(*[col(c) for c in kept], F.coalesce(col(text), F.lit("")).alias(text))
    schema = T.StructType([*(given.schema[c] for c in kept), T.StructField(name, SPANS, False)])
    kinds = [r.kind for r in rules]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(kept)).to_pylist()
            spans: list[list[tuple[int, int, int]]] = []
            for a, b in in_blocks(texts):
                spans += found(texts[a:b], rules)
            rows = [[{"kind": kinds[k], "start": s, "end": e} for s, k, e in own] for own in spans]
            listed = pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], listed], [*kept, name])

    return map_batches(given, look, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets: counts of the base kinds, their digest, and all spans."""
    told = scan(documents(spark, sf_dir).select("doc_id", "text"))
    base = [r.kind for r in BASE]
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    own = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return told.select(
        "doc_id", *[F.size(own(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(listed(own(*base)).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
