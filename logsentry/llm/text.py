"""Column expressions and small helpers the document operators share."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# White space is the space and U+0009 to U+000D; a word is a longest run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once per row however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_az(text: Column) -> Column:
    """Lower-case A to Z and nothing else. Pure ASCII texts take the byte-wise path."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def col(name: str) -> Column:
    """A top-level column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def packed(df: DataFrame, row: str = "row") -> Column:
    """All columns as one struct, so that added columns cannot clash with them."""
    return F.struct(*[col(c) for c in df.columns]).alias(row)


def unpacked(df: DataFrame, names: Sequence[str], row: str = "row") -> DataFrame:
    return df.select(*[F.col(row).getField(n).alias(n) for n in names])


def arrow_rows(spark: SparkSession, rows: int = 1000) -> None:
    """Let an Arrow batch hold ``rows`` rows at most, so that long texts do not fill a worker's memory.

    Sets the session's ``spark.sql.execution.arrow.maxRecordsPerBatch`` unless it is lower already.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def map_batches(df: DataFrame, run: Callable, schema: T.StructType) -> DataFrame:
    """``mapInArrow`` by place instead of by name, for columns of any names."""
    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])

    placed = T.StructType([T.StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(schema.fields)])
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(renamed, placed).toDF(*schema.names)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
