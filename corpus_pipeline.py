"""From raw documents to packed training sequences, in five stages over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lorebase.llm import decontam, langid, lines, packing, simhash
from lorebase.llm.common import stored
from lorebase.llm.queries import tokenizer
from lorebase.session import prepare

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose language cannot be told: null texts and texts without a letter.

    Repeated rows and rows without a doc_id are judged each for itself; no rows: no rows.
    """
    model = langid.train(docs.filter(~langid.held_out(docs["doc_id"])))
    judged = langid.identify(docs.select(*COLUMNS), model, carry=True)
    return judged.filter(F.col("lang_pred") != langid.UNKNOWN).select("row.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more hold stay in the largest doc_id only; n_chars follows the text.

    Every row comes back, with a null doc_id, a null text (now empty) or repeated, as `lines` says; no rows: no rows.
    """
    kept = lines.drop_repeated_lines(docs.select(*COLUMNS)).drop("line_counts")
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, by fingerprints at 2 or fewer differing bits, the row with the smallest doc_id stays.

    Rows are told apart by doc_id and text: of equal rows one stays, and rows that share a doc_id, or have none, are
    judged by their texts like any others. A row without a doc_id stays only where its group holds no other.
    No rows: no rows.
    """
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("version"))
    rows = docs.select(*COLUMNS).withColumn("key", key)
    groups = simhash.near_duplicates(rows.select(F.col("key").alias("doc_id"), "text"))
    first = groups.filter("doc_id = component_id").select("doc_id.doc_id", "doc_id.version").distinct()
    first = stored(first.toDF("first_id", "first_version"), "first-copies")
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("key.version") == F.col("first_version"))
    return rows.join(first, same, "left_semi").withColumn("version", F.col("key.version")).dropDuplicates(["doc_id", "version"]).select(*COLUMNS)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold a passage of the benchmark, whether or not they have a doc_id.

    A text is judged once for all rows that hold it; null texts and repeated rows stay. No rows: no rows.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = docs.select(*COLUMNS).withColumn("version", F.xxhash64("text"))
    found = decontam.contaminated(rows.select(F.col("version").alias("doc_id"), "text"), items).select(F.col("doc_id").alias("version"))
    return rows.join(stored(found.distinct(), "contaminated"), "version", "left_anti").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, placed in sequences of 2048 tokens; a null text is an empty one, no rows: no rows."""
    return packing.pack_documents(docs, tokenizer())


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_repeated_lines),
    ("simhash_dedup", without_near_copies),
    ("decontamination", without_benchmarks),
    ("best_fit_packing", packed),
]

# Language models, fingerprint components and best-fit are not for SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder, each written as Parquet and read again as the next one's input."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
