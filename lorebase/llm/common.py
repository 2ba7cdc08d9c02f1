"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lorebase.session import drop_scratch, prepare, scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The white space of the contracts: blank and code points 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"

NO_ID = -(2**63)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def whole_text(docs: DataFrame, name: str = "text") -> Column:
    """The text of a document, empty where it is null."""
    return F.coalesce(docs[name], F.lit(""))


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of an id written as text; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared scratch folder and read them back.

    It cuts the lineage at a copy that outlives executors, and gives Catalyst the size of the rows,
    so that it broadcasts them only where they are below its threshold.
    """
    spark = prepare(df.sparkSession)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    rows.stored_at = path
    return rows


def drop_stored(rows: DataFrame) -> None:
    """Delete what `stored` wrote; for rows that nothing reads any more."""
    drop_scratch(rows.sparkSession, rows.stored_at)


def tasks_for(spark: SparkSession) -> int:
    """How many parts a shuffle of this session has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is computed in here sends at most `rows` rows at a time to Python workers: whole texts are large, and a batch lies in memory on both sides."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(min(int(before), rows) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


# Most bytes of rows that may be copied to every task.
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(rows: DataFrame, row_bytes: int) -> DataFrame:
    """Mark stored rows of at most `row_bytes` each for broadcast if all together are small; else a plain join follows."""
    return F.broadcast(rows) if rows.count() * row_bytes <= BROADCAST_BYTES else rows
