"""Near duplicates by MinHash bands, verified in sequence and then exactly.

1. One pass over the texts gives each document its set of word shingles as 64-bit hashes, a
   signature of minima and a digest of the set. Documents with one set are one node from here on:
   exact copies, however many, cost one row.
2. Nodes whose signatures agree in a whole band share a bucket. Pairs are never made within a bucket.
   Three times, one node is the centre and is paired with the others; accepted links join nodes to
   components, and a bucket that lies in one component is done. The nodes of buckets that still hold
   several components are then joined by their rarest shingles, which finds every pair that can reach
   the threshold and skips what only shares common passages. So no link is lost that could join two
   components, and a group of thousands of copies costs a few rows per copy.
3. A pair is compared batch by batch of its signature (BayesLSH). With m of n minima equal and a uniform
   prior, the similarity is Beta(m + 1, n - m + 1); once the chance that it reaches the threshold is below
   ``miss``, the pair is dropped. What survives is decided on the full shingle sets.

Two sets just at 0.8 share no band with a probability of 6e-5, at 0.9 below 1e-10.

Null, empty and blank texts have an empty set and are linked with nothing. A text shorter than a
shingle is one shingle. Rows with a null key rank after all others: a component of such rows only
has a null id. Rows that repeat a key are separate rows with the same id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsentry.llm.graph import components
from logsentry.llm.text import arrow_rows, col, documents, packed, unpacked
from logsentry.session import broadcast_if_small, drop, pin, written

BANDS, ROWS = 32, 6
HASHES = BANDS * ROWS
BATCH = 32  # minima compared between two looks at the posterior
MISS = 1e-5  # chance of dropping a pair that reaches the threshold, at each look
WORDS, PERCENT = 5, 80
STARS = 3  # rounds with one centre per bucket
CACHE = 500_000  # word hashes a task remembers
BLOCK = 1024  # shingles hashed at a time

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * HASHES + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
    return seeds[:HASHES] | _U(1), seeds[HASHES:]


class WordHashes(dict):
    """64-bit hash of a word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingle_sets(texts: list[str], k: int, known: WordHashes) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text. Words are lower-cased from A to Z and parted by white space."""
    split = [t.encode().lower().split() for t in texts]  # of bytes: both touch ASCII only
    lengths = np.array([len(w) for w in split], np.int64)
    h = np.fromiter((known[w] for words in split for w in words), _U, int(lengths.sum()))
    n = max(len(h) - k + 1, 0)
    runs = np.full(n, k, _U)
    for j in range(k):
        runs = mix(runs ^ h[j : j + n])
    out, start = [], 0
    for length in lengths.tolist():
        if length >= k:
            out.append(np.unique(runs[start : start + length - k + 1]))
        elif length:
            whole = np.array([length], _U)
            for x in h[start : start + length]:
                whole = mix(whole ^ x)
            out.append(whole)
        else:
            out.append(np.empty(0, _U))
        start += length
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The upper halves of the smallest hash under each of ``HASHES`` functions."""
    a, b = _multipliers()
    least = np.full(HASHES, ~_U(0))
    for i in range(0, len(shingles), BLOCK):
        np.minimum(least, (shingles[i : i + BLOCK, None] * a + b).min(axis=0), out=least)
    return (least >> _U(32)).astype(np.uint32)


def _batched(texts: list[str], characters: int = 1 << 20) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= characters or i + 1 == len(texts):
            yield start, i + 1
            start, held = i + 1, 0


def signed(df: DataFrame, key: str, text: str, words: int, rid: str | None = None) -> DataFrame:
    """(key, rid, n_shingles, digest, sig) of every row, written once. ``rid`` numbers the rows, unless a column of ``df`` does."""
    arrow_rows(df.sparkSession)
    given = df.select(col(key).alias("key"), F.coalesce(col(text), F.lit("")).alias("text"), *([col(rid).alias("rid")] if rid else []))
    schema = T.StructType([
        given.schema["key"], T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.BinaryType()),
        T.StructField("sig", T.BinaryType()), *given.schema.fields[2:],
    ])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes, digests, sigs = [], [], []
            for a, b in _batched(texts):
                for s in shingle_sets(texts[a:b], words, known):
                    sizes.append(len(s))
                    digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                    sigs.append(signature(s).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary()), *batch.columns[2:]],
                schema.names)

    out = given.mapInArrow(sign, schema)
    return pin(out if rid else out.withColumn("rid", F.monotonically_increasing_id()), "signed")


def buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node) for each band of each node's signature."""
    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            parts = _minima(batch.column(1)).reshape(len(batch), BANDS, ROWS).astype(_U)
            h = np.tile(np.arange(BANDS, dtype=_U), (len(batch), 1))
            for j in range(ROWS):
                h = mix((h << _U(1)) ^ parts[:, :, j] ^ (h >> _U(33)))
            node = np.repeat(batch.column(0).to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(h.ravel().view(np.int64)), pa.array(node)], ["bucket", "node"])

    return nodes.select("node", "sig").mapInArrow(band, "bucket long, node long")


def _minima(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), HASHES)


def least_matches(percent: int, miss: float = MISS, batch: int = BATCH, hashes: int = HASHES) -> list[tuple[int, int]]:
    """For n = batch, 2 batch, ... the smallest m of n equal minima with which a similarity of the threshold is still likelier than ``miss``.

    The tail of Beta(m + 1, n - m + 1) above t is the chance of at most m successes in n + 1 trials of chance t.
    """
    t = percent / 100
    out = []
    for n in range(batch, hashes + 1, batch):
        tail, m = 0.0, -1
        while tail < miss and m < n:
            m += 1
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def likely(pairs: DataFrame, nodes: DataFrame, percent: int, miss: float = MISS) -> DataFrame:
    """The pairs (a, b) that sizes and the sequential look at the signatures leave."""
    arrow_rows(pairs.sparkSession)
    side = nodes.select("node", "n", "sig")
    joined = (
        pairs.join(side.withColumnsRenamed({"node": "a", "n": "na", "sig": "sa"}), "a")
        .join(side.withColumnsRenamed({"node": "b", "n": "nb", "sig": "sb"}), "b")
        .filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    )
    looks = least_matches(percent, miss)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = _minima(batch.column(2)), _minima(batch.column(3))
            alive = np.arange(len(batch))
            equal = np.zeros(len(batch), np.int64)
            seen = 0
            for n, least in looks:
                equal[alive] += (left[alive, seen:n] == right[alive, seen:n]).sum(axis=1)
                alive = alive[equal[alive] >= least]
                seen = n
            yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(alive)) for i in (0, 1)], ["a", "b"])

    return joined.select("a", "b", "sa", "sb").mapInArrow(look, "a long, b long")


def full_sets(df: DataFrame, key: str, text: str, words: int, wanted: DataFrame) -> DataFrame:
    """(node, set) of the wanted nodes (node, key, digest), from the texts. ``set``: array of shingle hashes."""
    given = df.select(col(key).alias("key"), F.coalesce(col(text), F.lit("")).alias("text"))
    keys = broadcast_if_small(pin(wanted.select(F.col("key").alias("k")).distinct(), "wanted-keys"))
    read = given.join(keys, F.col("key").eqNullSafe(F.col("k")), "left_semi").select("text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in _batched(texts):
                found = shingle_sets(texts[a:b], words, known)
                rows = np.concatenate(([0], np.cumsum([len(s) for s in found]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in found], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(rows), pa.array(np.concatenate(found).view(np.int64))),
                ], ["digest", "set"])

    made = read.mapInArrow(sets, "digest binary, set array<long>")
    hit = made.join(broadcast_if_small(pin(wanted.select("digest", "node"), "wanted")), "digest")
    return pin(hit.groupBy("node").agg(F.first("set").alias("set")), "sets")  # rows that repeat a key come more than once


def linked(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold, written once."""
    left, right = (sets.withColumnsRenamed({"node": x, "set": f"s{x}"}) for x in "ab")
    both = likely(pairs, nodes, percent).join(left, "a").join(right, "b")
    common = both.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("i"),
                         (F.size("sa") + F.size("sb")).alias("n"))
    return pin(common.filter(100 * F.col("i") >= percent * (F.col("n") - F.col("i"))).select("a", "b"), "links")


def _mixed(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Bucket rows with their component (the node itself where it has none), in buckets of two components or more."""
    if labels is None:
        return rows.withColumn("label", F.col("node"))
    named = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    spread = named.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    return pin(named.join(spread.filter("lo <> hi").select("bucket"), "bucket"), "mixed")


def _busy(rows: DataFrame) -> DataFrame:
    """Bucket rows with the number of buckets that their node is in."""
    return rows.join(rows.groupBy("node").agg(F.count(F.lit(1)).alias("buckets")), "node")


def _star(rows: DataFrame, step: int) -> DataFrame:
    """Each row of a bucket with the bucket's centre, where they are not of one component.

    The centre is the bucket's first node, then its last, then that which is in most of the buckets still mixed: the text that
    many others were made from is closer to all of them than they are to each other, and so meets them more often.
    """
    if step < 2:
        chosen = rows.groupBy("bucket").agg((F.min, F.max)[step](F.struct("node", "label")).alias("c"))
    else:
        chosen = _busy(rows).groupBy("bucket").agg(F.max_by(F.struct("node", "label"), F.struct("buckets", "node")).alias("c"))
    pairs = rows.join(chosen, "bucket").filter(F.col("label") != F.col("c.label"))
    return pairs.select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct()


def prefixes(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, label, n, s, place) of the rarest shingles of each node, as many as a similar set may have to be met by.

    A shingle whose nodes are all of one component joins nothing and is left out: were it in all nodes of a large component, looking
    at its pairs would cost the square of that component.
    """
    members = rows.select("node", "label").distinct()
    each = sets.join(members, "node").select("node", "label", F.size("set").alias("n"), F.explode("set").alias("s"))
    common = each.groupBy("s").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    rare_first = Window.partitionBy("node").orderBy("c", "s")
    placed = each.join(common, "s").withColumn(
        "place", F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("node")) + F.row_number().over(rare_first) - 1)
    placed = pin(placed.filter(F.col("place") <= F.col("n") - F.ceil(percent * F.col("n") / 100)).drop("c"), "prefixes")
    spread = placed.groupBy("s").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    return pin(placed.join(spread.filter("lo <> hi").select("s"), "s"), "prefixes")


def _rest_pairs(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components among the nodes of ``rows`` that can reach the threshold, by their rarest shingles.

    With a set's shingles ordered from rare to common, the first one that two similar sets share lies so early in
    both that enough can follow it. So the smaller set is looked up by a short prefix and the larger by a longer one:
    lines and passages that many texts share are common, come last, and make no pairs. Nothing is lost by it.
    A shingle that occurs once is never shared; it takes a place in the order but is not shuffled again.
    """
    placed = prefixes(rows, sets, percent)
    small = placed.filter(F.col("place") <= F.col("n") - F.ceil(2 * percent * F.col("n") / (100 + percent)))
    x, y = small.alias("x"), placed.alias("y")
    left = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    pairs = x.join(y, F.expr("x.s = y.s AND (x.n < y.n OR x.n = y.n AND x.node < y.node) AND x.label <> y.label")
                   & (100 * F.col("x.n") >= percent * F.col("y.n"))
                   & ((100 + percent) * left >= percent * (F.col("x.n") + F.col("y.n"))))
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _joined(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after more links: those of the links between the components so far."""
    if labels is None:
        return pin(components(links), "labels")
    named = links
    for x in "ab":
        named = named.join(labels.withColumnsRenamed({"node": x, "label": f"l{x}"}), x, "left").withColumn(
            x, F.coalesce(f"l{x}", x)).drop(f"l{x}")
    merged = components(named).toDF("label", "root")
    again = labels.join(merged, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    fresh = merged.select(F.col("label").alias("node"), F.col("root").alias("label")).join(labels, "node", "left_anti")
    return pin(again.unionByName(fresh), "labels")


def _components(df: DataFrame, key: str, text: str, words: int, percent: int, rid: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The signed rows without signatures, and (digest, label, component_id) of their sets of shingles.

    Only these two tables stay. Signatures are most of what is written: once each set has its own, those of the rows go.
    """
    given = set(written())
    mine = lambda: [p for p in written(here=True) if p not in given]
    full = signed(df, key, text, words, rid)
    signatures = mine()
    rows = pin(full.drop("sig"), "signed-rows")
    stay = mine()[-1:]
    reps = rows.filter("n_shingles > 0").groupBy("digest").agg(
        F.min("rid").alias("node"), F.min("key").alias("least"))
    nodes = pin(
        full.join(reps.select(F.col("node").alias("rid")), "rid").select(
            F.col("rid").alias("node"), "key", "digest", F.col("n_shingles").alias("n"), "sig"), "nodes")
    drop(df.sparkSession, signatures)
    banded = buckets(nodes)
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("bucket")
    in_buckets = pin(banded.join(shared, "bucket"), "buckets")
    wanted = nodes.join(in_buckets.select("node").distinct(), "node").select("node", "key", "digest")
    sets = full_sets(df, key, text, words, wanted)

    labels, tested = None, None
    for step in range(STARS + 1):
        mixed = _mixed(in_buckets, labels)
        if labels is not None and mixed.isEmpty():
            break
        pairs = _rest_pairs(mixed, sets, percent) if step == STARS else _star(mixed, step)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = pin(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        labels = _joined(labels, linked(pairs, nodes, sets, percent))

    of_digest = reps.join(labels, "node", "left").select(
        "digest", "least", F.coalesce("label", "node").alias("label"))
    smallest = of_digest.groupBy("label").agg(F.min("least").alias("component_id"))
    named = pin(of_digest.join(smallest, "label").select("digest", "label", "component_id"), "components")
    drop(df.sparkSession, [p for p in mine()[:-1] if p not in stay])
    return rows, named


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """Every row's component of near duplicates.

    Columns: key (under its own name), n_shingles, component_id (the smallest key reachable, its own included), kept
    (key = component_id). Two rows are linked where 100 * common >= percent * united shingles of ``words`` words.
    """
    rows, named = _components(df, key, text, words, percent)
    out = rows.select("key", "n_shingles", "digest").join(named.drop("label"), "digest", "left").select(
        "key", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("key")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("key").eqNullSafe(F.col("component_id"))).withColumnRenamed("key", key)


def copies(told: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(rid) of the rows of ``told`` (rid, key, text) that go: of each group that with the smallest key (null last), of these the first, stays.

    Rows without shingles are copies of nothing and stay.
    """
    rows, named = _components(told, "key", "text", words, percent, "rid")
    alike = rows.filter("n_shingles > 0")
    least = alike.groupBy("digest").agg(F.min(F.struct(F.col("key").isNull().alias("null"), "key", "rid")).alias("least"))
    stay = least.join(named, "digest").groupBy("label").agg(F.min("least").alias("least")).select(F.col("least.rid").alias("rid"))
    return pin(alike.select("rid").join(stay, "rid", "left_anti"), "gone")


def drop_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                         percent: int = PERCENT, earlier: DataFrame | None = None) -> DataFrame:
    """One row of ``df``, all columns, of each group: that with the smallest key (null last), of these the first.

    Rows without shingles are copies of nothing and stay. ``earlier`` is a table with ``key`` and ``text`` as they were before other
    steps took parts of the texts out: then copies are first looked for among the texts as they were, and afterwards, in
    what is left, among the texts as they are. A row's earlier text is the one with its key, if the key occurs once in both tables.
    """
    given = pin(df.select(F.monotonically_increasing_id().alias("rid"), packed(df)), "rows")
    told = given.select("rid", *[F.col("row").getField(c).alias(n) for c, n in ((key, "key"), (text, "text"))])
    gone = None
    if earlier is not None:
        kept = set(written())
        was = earlier.select(col(key).alias("key"), col(text).alias("text"))
        once = lambda t, *more: t.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.first(F.xxhash64("text")).alias("h"), *more).filter("n = 1")
        then = once(was).select(F.col("key").alias("k"), F.col("h").alias("h0"))
        changed = pin(once(told, F.first("rid").alias("rid")).join(then, F.col("key") == F.col("k")).filter("h <> h0").select("key", "rid"), "changed")
        few = broadcast_if_small(changed)
        start = told.join(few.select("rid"), "rid", "left_anti").unionByName(was.join(few, "key"))
        gone = copies(start, words, percent)
        mine = [p for p in written() if p not in kept]
        told = pin(told.join(broadcast_if_small(gone), "rid", "left_anti"), "left")
        drop(df.sparkSession, mine[:-1])  # all but the rows that go
    last = copies(told, words, percent)
    gone = last if gone is None else pin(gone.unionByName(last), "gone")
    return unpacked(given.join(broadcast_if_small(gone), "rid", "left_anti"), df.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents over shingles of four words."""
    return near_duplicates(documents(spark, sf_dir), words=4)
