"""From raw documents to token ids: quality rules, line dedup, near-dedup, mixing, encoding.

Each stage takes the documents its predecessor kept, as written parquet, and all but the last return the columns of
documents. Quality rules drop documents; line dedup takes later copies of repeated line runs out of texts, and drops a document
that lost lines and has fewer words left than the quality rules ask for; near-dedup keeps the document with the smallest id of each
group. A later copy of a text has by then lost the lines it shares with the first, so near-dedup looks at the texts as they stood
in the documents table first (of ids that are unique there), and then, among what is left, at the texts it was given. Mixing puts
documents in the order of training, some twice; encoding gives their token ids and their places in
that order, which is that of mixing's part files and of the rows in them: reading them again does not keep it.

As a stage starts only when its predecessor's result is written, it first deletes the scratch tables that
the predecessor's plans read, so the shared folder never holds more than one stage's. Results of one stage can be held side by side;
``run`` keeps its tables apart from those of other runs.

Null texts count as empty: they fail the quality rules. Null ids rank last in a group of copies, and such rows, like those that repeat an
id, are judged one by one, by the texts given. An empty table gives an empty result; other columns, whatever their names, pass through to the mix. SQL
cannot express the signatures, the curriculum and the merges, so the run is tested against plain Python on small tables.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsentry.llm.byte_bpe import round_trip
from logsentry.llm.line_dedup import drop_repeated_lines
from logsentry.llm.minhash import drop_near_duplicates
from logsentry.llm.mixing import mix
from logsentry.llm.quality import LEAST_WORDS, filter_quality
from logsentry.session import drop, pin, written

_BEFORE = {"lines": "quality", "near_duplicates": "lines", "mixing": "near_duplicates", "encoding": "mixing"}

Scratch = dict[str, list[str]]  # the tables that each stage has pinned

_scratch: dict[str, Scratch] = {}  # of stages that were called one by one, by their folder of documents


def _stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[..., DataFrame]:
    """The stage, after deleting what the stage before has left in the shared folder."""
    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
        tables = _scratch.setdefault(sf_dir, {}) if scratch is None else scratch
        live = set(written())
        drop(spark, [p for p in tables.pop(_BEFORE.get(function.__name__), []) if p in live])
        before = set(written())
        out = function(spark, docs, sf_dir)
        tables.setdefault(function.__name__, []).extend(p for p in written() if p not in before)
        return out

    return run_stage


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that may have changed."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def placed(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of a written table, and ``position``: the place of each row, from 0, in the order it was written in.

    Tasks number their part files, and a task that writes several numbers them too. Only one row per file reaches the driver.
    """
    told = docs.metadataColumn("_metadata")
    given = docs.select(*columns, told["file_name"].alias("_file"), told["row_index"].alias("_row"))
    rows = {r[0]: r[1] for r in given.groupBy("_file").agg(F.count(F.lit(1))).collect()}
    files = sorted(rows, key=lambda f: [int(n) for n in re.search(r"part-(\d+).*?(?:-c(\d+))?\.", f).groups(default="0")])
    before = [sum(rows[f] for f in files[:k]) for k in range(len(files))]
    table = docs.sparkSession.createDataFrame(pa.table({
        "_file": pa.array(files, pa.string()), "_before": pa.array(before, pa.int64())}))
    return given.join(F.broadcast(table), "_file").select(*columns, (F.col("_before") + F.col("_row")).alias("position"))


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return filter_quality(docs)


@_stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; those that are too short without them go."""
    return _counted(drop_repeated_lines(docs, least=LEAST_WORDS))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by the texts in ``sf_dir`` and by those given."""
    return drop_near_duplicates(docs, earlier=spark.read.parquet(f"{sf_dir}/documents.parquet"))


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order and as often as the mix takes them."""
    return _counted(mix(docs))


@_stage
def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, position, n_tokens, ids_sha256 and decoded_sha256 of every row of the mix; ``position`` counts the
    rows of the mix from 0 in the order of training."""
    import public_tokenizers

    given = placed(docs, "doc_id", "source", "text")
    return round_trip(given, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[..., DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("mixing", mixing),
    ("byte_bpe", encoding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch: Scratch = {}
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir, scratch), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir, scratch)
