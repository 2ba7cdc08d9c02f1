"""Text and vector retrieval for whole tables of questions.

Text vectors are TF-IDF weights, kept as an index of blocks: the weights of a term that are about
equally large. Blocks that cannot lift a document to a question's k-th score are passed over; what is left
is summed up per document, and only the k best rows per question and partition leave it. Chunks are so many and so
short that a row for each of their weights costs more than the sums: they are kept and scored in packs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from operator import and_
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from lorebase.functions.text import CHUNK_OVERLAP, CHUNK_SIZE, chunks, tokens
from lorebase.operators.skew import hot_keys, lookup_join
from lorebase.session import broadcast_if_few, exists, read_dealt, scratch_path, write_dealt, written
from lorebase.sources.kb import FILE_PACKS

SCORE_DIGITS = 6
# Most bytes of question terms that one broadcast may hold.
BROADCAST_BYTES = 64 << 20
# Most question vectors that travel with a task.
VECTOR_BLOCK = 4096


def chunk_documents(
    docs: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, text: str = "content"
) -> DataFrame:
    """(doc_id, chunk_no, content): overlapping windows of each text, numbered from 0."""
    return docs.select("doc_id", F.posexplode(chunks(F.col(text), size, overlap)).alias("chunk_no", "content"))


# --- TF-IDF -----------------------------------------------------------------------------


class TextIndex(NamedTuple):
    """A kept search index: weights in blocks by term and size of the weight, dealt by document, or in packs, and the figures all weights depend on."""

    weights: DataFrame  # (unit, term, weight, class, bucket); of packs (unit, term, weight), taken out of them when read
    blocks: DataFrame | None  # (bucket, term, class, n, largest): how many weights a block holds, and the largest; counted when read
    unit: list[str]  # what a text is: a document, or a chunk of one
    terms: DataFrame  # (term, df)
    units: int  # number of texts
    rows: int  # number of postings
    term_bytes: int  # size of `terms`
    parts: int  # into so many parts the weights are dealt by doc_id
    buckets: int  # numbers of buckets of terms
    packs: DataFrame | None = None  # of an index of chunks: their weights in packs, see `_write_packs`


# Weights of a class lie within a quarter of a factor of two.
CLASSES_PER_OCTAVE, LAST_CLASS = 4, 63
# Postings of a bucket of terms, about; a search reads the buckets of its terms only. Each part has a file per bucket.
BUCKET_ROWS, MOST_BUCKETS = 1 << 27, 4096
# What a term of a vocabulary takes in a broadcast, about.
TERM_BYTES = "length(term) * 4 + 24"
FIGURES = "unit array<string>, units bigint, rows bigint, term_bytes bigint, parts int, buckets int"


def write_index(postings: DataFrame, path: str, unit: list[str] | None = None, parts: int | None = None) -> None:
    """Write the search index of live postings (unit, term, tf) to `path`.

    Document frequencies are counted first, so weights are never stale, then each text's weights and norm. Weights are kept dealt
    by document, in folders by bucket of terms; of postings that `write_postings` has dealt into `parts` they stay where they are.
    The figures come last and in one file: an index without them does not count.
    """
    unit = unit or ["doc_id"]
    spark = postings.sparkSession
    packed = "pack" in postings.columns
    counted = _pack_words(postings).groupBy("term").agg(F.sum("n").alias("df")) if packed else postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    counted.write.mode("overwrite").parquet(f"{path}/terms")
    terms = spark.read.schema("term string, df bigint").parquet(f"{path}/terms")
    size = terms.agg(F.sum("df").alias("rows"), F.sum(F.expr(TERM_BYTES)).alias("bytes")).first()
    rows, term_bytes = size["rows"] or 0, size["bytes"] or 0
    buckets = max(1, min(MOST_BUCKETS, rows // BUCKET_ROWS))
    if packed:
        kinds = postings.schema["units"].dataType.elementType
        units = postings.select(F.inline("units")).filter(reduce(and_, [F.col(c).isNotNull() for c in unit])).count()
        parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        _write_packs(postings, terms, units, term_bytes, f"{path}/packs", parts)
    else:
        kinds = postings.schema
        units = postings.agg(F.count_distinct(*unit)).first()[0]
        if parts is None:
            parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
            postings = postings.repartition(parts, "doc_id")
        raw = _dealt_raw_weights(postings, terms, unit, units, term_bytes, parts)
        norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy(*_dealt(unit))))
        weighed = raw.select(*_dealt(unit), "term", (F.col("raw") / norm).alias("weight")).filter("weight is not null")
        weighed = weighed.withColumnRenamed(DEALT, "doc_id")
        classed = F.least(F.floor(-CLASSES_PER_OCTAVE * F.log2("weight")), F.lit(LAST_CLASS)).cast("int")
        weighed = weighed.withColumn("class", classed).withColumn("bucket", _bucket(buckets))
        write_dealt(weighed, f"{path}/weights", "doc_id", parts, ["bucket"])
    typed = [f"{c} {kinds[c].dataType.simpleString()}" for c in unit]
    figures = spark.createDataFrame([(typed, units, rows, term_bytes, parts, buckets)], FIGURES)
    figures.coalesce(1).write.mode("overwrite").parquet(f"{path}/figures")


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")


def _blocks(weights: DataFrame) -> DataFrame:
    return weights.groupBy("bucket", "term", "class").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("largest"))


def read_index(spark, path: str) -> TextIndex:
    """The search index that `write_index` has put there."""
    figures = spark.read.schema(FIGURES).parquet(f"{path}/figures").first()
    terms = spark.read.schema("term string, df bigint").parquet(f"{path}/terms")
    unit = [c.split(" ")[0] for c in figures["unit"]]
    if exists(spark, f"{path}/packs"):
        packs = spark.read.schema(_pack_schema(figures["unit"])).parquet(f"{path}/packs")
        weights = packs.mapInArrow(_unpacked, f"{', '.join(figures['unit'])}, term string, weight double")
        return TextIndex(weights, None, unit, terms, *figures[1:], packs)
    fields = f"{', '.join(figures['unit'])}, term string, weight double, class int, bucket int"
    weights = read_dealt(spark, f"{path}/weights", fields, "doc_id", figures["parts"], ["bucket"])
    return TextIndex(weights, _blocks(weights), unit, terms, *figures[1:])


def open_index(postings: DataFrame, unit: list[str] | None = None) -> TextIndex:
    """The search index of postings that only this application needs."""
    path = scratch_path(postings.sparkSession, "index")
    write_index(postings, path, unit)
    return read_index(postings.sparkSession, path)


def _weight(units: int, tf, df):
    return (1 + F.log(tf.cast("double"))) * (F.log(F.lit(1.0 + units) / (1 + df.cast("double"))) + 1)


# Two tables that lie dealt by document lie so together as well, if Spark meets the column under a name of its own in their union.
DEALT = "dealt_id"


def _dealt(columns: list[str]) -> list[str]:
    return [DEALT if c == "doc_id" else c for c in columns]


def _raw_weights(postings: DataFrame, terms: DataFrame, unit: list[str], units: int, term_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Weights before normalisation, (unit, term, raw)."""
    return _dealt_raw_weights(postings, terms, unit, units, term_bytes, limit=limit).filter("raw is not null").withColumnRenamed(DEALT, "doc_id")


def _dealt_raw_weights(postings, terms, unit, units, term_bytes, parts: int | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Weights before normalisation, (unit, term, raw), with the name DEALT for doc_id, and perhaps rows without `raw`, which do not count.

    Terms go to where the postings are, most frequent first as far as one broadcast reaches; of a larger vocabulary only the postings
    of the other, rare terms are shuffled, and go back to the `parts` by document that they came from. They stand among the
    postings without `raw` too: taking them out there would make Spark shuffle all.
    """
    joined = _with_df(postings.withColumnRenamed("doc_id", DEALT), terms, term_bytes, limit, lambda found: found.repartition(parts, DEALT) if parts else found)
    return joined.select(*_dealt(unit), "term", _weight(units, F.col("tf"), F.col("df")).alias("raw"))


def _with_df(rows: DataFrame, terms: DataFrame, term_bytes: int, limit: int, deal=lambda found: found) -> DataFrame:
    """Rows with the `df` of their term. Those of a rare term of a large vocabulary come twice, once without `df`; the others pass through `deal`."""
    if term_bytes <= limit:
        return rows.join(F.broadcast(terms), "term")
    least = _least_df(terms, limit)
    frequent, rare = terms.filter(F.col("df") >= least), terms.filter(F.col("df") < least)
    known = rows.join(F.broadcast(frequent), "term", "left")
    return known.unionByName(deal(known.filter("df is null").drop("df").join(rare, "term")))


def _least_df(terms: DataFrame, limit: int) -> int:
    """The least power of two such that the terms of that frequency or more are within `limit` bytes."""
    power = F.floor(F.log2("df"))
    sizes = terms.groupBy(power.alias("power")).agg(F.sum(F.expr(TERM_BYTES)).alias("bytes")).orderBy(F.desc("power")).collect()  # 63 rows at most
    held, least = 0, 1 << 62
    for row in sizes:
        held += row["bytes"]
        if held > limit:
            break
        least = 1 << row["power"]
    return least


# --- weights in packs -------------------------------------------------------------------


def _pack_words(packs: DataFrame) -> DataFrame:
    """(pack, at, term, n): the terms of each pack in order, and how many of its units hold them."""
    return packs.select("pack", F.posexplode("words").alias("at", "word")).select("pack", "at", "word.term", "word.n")


def _pack_schema(unit: list[str]) -> str:
    return f"units array<struct<{', '.join(unit)}>>, words string, idf binary, norms binary, sizes binary, codes binary, tf binary"


def _write_packs(packs: DataFrame, terms: DataFrame, units: int, term_bytes: int, path: str, parts: int, limit: int = BROADCAST_BYTES) -> None:
    """Write packs of postings with what makes weights of them: a factor for each term of a pack, and the norm of each unit.

    Only the terms of each pack meet the vocabulary, once per pack, and come back to it as one row.
    """
    found = _with_df(_pack_words(packs).drop("n"), terms, term_bytes, limit).filter("df is not null").select("pack", "at", "df")
    dfs = found.repartition(parts, "pack").sortWithinPartitions("pack", "at").mapInArrow(_gathered, "pack string, dfs binary")
    kinds = packs.schema["units"].dataType.elementType
    schema = _pack_schema([f"`{f.name}` {f.dataType.simpleString()}" for f in kinds])
    weighed = packs.repartition(parts, "pack").join(dfs, "pack").mapInArrow(partial(_weighed, units), schema)
    weighed.write.mode("overwrite").option("maxRecordsPerFile", FILE_PACKS).parquet(path)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (pack, at, df) to (pack, dfs), numbers of 64 bits."""
    row = lambda name, dfs: pa.RecordBatch.from_arrays([name, pa.array([np.concatenate(dfs).tobytes()], pa.binary())], ["pack", "dfs"])
    name, dfs = None, []
    for batch in batches:
        df, start = batch.column("df").to_numpy(), 0
        for at in np.flatnonzero(batch.column("at").to_numpy() == 0):
            if name is not None:
                yield row(name, [*dfs, df[start:at]])
            name, dfs, start = batch.column("pack").slice(at, 1), [], at
        dfs.append(df[start:])
    if name is not None:
        yield row(name, dfs)


def _weighed(units: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs of postings with the `dfs` of their terms to rows of `_pack_schema`."""
    for batch in batches:
        for at in range(batch.num_rows):
            sizes, codes, tf = (_numbers(batch, c, at) for c in ("sizes", "codes", "tf"))
            idf = np.log((1.0 + units) / (1 + _numbers(batch, "dfs", at, np.int64))) + 1
            raw = (1 + np.log(tf)) * idf[codes]
            norms = np.sqrt(np.bincount(np.repeat(np.arange(len(sizes)), sizes), raw * raw))
            terms = batch.column("words")[at].values.field("term")
            words = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms), " ")  # terms have no blanks
            kept, figures = ["sizes", "codes", "tf"], [pa.array([x.tobytes()], pa.binary()) for x in (idf, norms)]
            columns = [batch.column("units").slice(at, 1), words, *figures, *(batch.column(c).slice(at, 1) for c in kept)]
            yield pa.RecordBatch.from_arrays(columns, ["units", "words", "idf", "norms", *kept])


def _numbers(pack: pa.RecordBatch, name: str, at: int, kind=np.int32) -> np.ndarray:
    return np.frombuffer(pack.column(name)[at].as_buffer(), kind)


def _terms_of(pack: pa.RecordBatch, at: int) -> pa.Array:
    return pc.split_pattern(pack.column("words").slice(at, 1), " ").flatten()


def _pack_weights(pack: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(of, codes, weight): the place of the unit and of the term of each weight of a pack, in order of units."""
    sizes, codes, tf = (_numbers(pack, c, at) for c in ("sizes", "codes", "tf"))
    idf, norms = (_numbers(pack, c, at, np.float64) for c in ("idf", "norms"))
    of = np.repeat(np.arange(len(sizes)), sizes)
    return of, codes, (1 + np.log(tf)) * idf[codes] / norms[of]


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs to rows (unit, term, weight)."""
    for batch in batches:
        for at in range(batch.num_rows):
            of, codes, weight = _pack_weights(batch, at)
            rows = pa.Table.from_struct_array(batch.column("units")[at].values).take(of).append_column("term", _terms_of(batch, at).take(pa.array(codes)))
            yield from rows.append_column("weight", pa.array(weight)).combine_chunks().to_batches()


def embed_tfidf(index: TextIndex) -> DataFrame:
    """L2-normalised TF-IDF weights (unit, term, weight)."""
    return index.weights.select(*index.unit, "term", "weight")


def embed_questions(questions: DataFrame, index: TextIndex) -> DataFrame:
    """The questions in the vector space of the index: (question_id, term, question_weight, df)."""
    counts = (
        questions.select("question_id", F.explode(tokens(F.col("question"))).alias("term"))
        .groupBy("question_id", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    if index.term_bytes <= BROADCAST_BYTES:
        joined = counts.join(F.broadcast(index.terms), "term", "left")
    else:
        asked = counts.groupBy("term").agg(F.count(F.lit(1)).alias("rows"))
        known = asked.select("term").join(index.terms, "term", "left")
        joined = lookup_join(counts, known, "term", spread_by="question_id", hot=hot_keys(asked, "term", "rows"))
    joined = joined.withColumn("df", F.coalesce("df", F.lit(0)))
    raw = joined.select("question_id", "term", "df", _weight(index.units, F.col("tf"), F.col("df")).alias("raw"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy("question_id")))
    return raw.select("question_id", "term", (F.col("raw") / norm).alias("question_weight"), "df")


def question_blocks(weights: DataFrame, limit: int = BROADCAST_BYTES) -> list[tuple[DataFrame, bool]]:
    """Cut question terms into parts of at most `limit` bytes, each with all terms of its questions.

    Sizes are measured. A part that cannot be made small enough (one huge question) is
    marked False and must not be broadcast.
    """
    size = F.length("term") * 4 + F.length(F.col("question_id").cast("string")) + 32
    total = weights.agg(F.sum(size)).first()[0] or 0
    if total <= limit:
        return [(weights, True)]
    parts = -(-total // limit)
    while True:
        part = F.pmod(F.xxhash64("question_id"), F.lit(parts))
        sizes = (
            weights.groupBy(part.alias("part"))
            .agg(F.sum(size).alias("bytes"), F.count_distinct("question_id").alias("questions"))
            .collect()  # one row per part
        )
        if all(r["bytes"] <= limit or r["questions"] == 1 for r in sizes) or parts > 4096:
            break
        parts *= 2
    return [(weights.filter(part == r["part"]), r["bytes"] <= limit) for r in sizes]


def _top(scores: DataFrame, k: int, by: str = "question_id", tie: str = "doc_id") -> DataFrame:
    """The k best rows per question, numbered from 1; equal scores go by `tie`."""
    best = W.partitionBy(by).orderBy(F.desc("score"), tie)
    return scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _check_k(k: int) -> None:
    if k < 1:
        raise ValueError("k must be at least 1")


def search_topk_text(
    questions: DataFrame,
    index: TextIndex,
    k: int = 5,
    threshold: float | None = None,
    exclude_self: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(question_id, doc_id, score, rank) for `questions` (question_id, question).

    Exact. `threshold` keeps scores at or above it; it is off unless given. Questions
    beyond the size of a broadcast are answered part by part over the same index. See `_found`.
    """
    _check_k(k)
    found = _found(questions, index, k, threshold, exclude_self, broadcast_bytes)
    if threshold is not None:
        found = relevance_filter(found, threshold)
    return _top(found, k).select("question_id", "doc_id", "score", "rank")


# Weights that the first look at a question's blocks takes in, per hit that is wanted.
FIRST_LOOK = 100
# Scores are compared after rounding, so a floor must be missed by more than a rounding step.
SLACK = 2 * 10.0**-SCORE_DIGITS


def _found(questions: DataFrame, index: TextIndex, k: int, threshold: float | None, exclude_self: bool, broadcast_bytes: int) -> DataFrame:
    """(question_id, unit, score) of all texts that can be among the k best documents of a question, with their exact scores.

    Blocks of weights that cannot lift a document to the k-th score are never read for it:

    1. The blocks of a question's terms that can add most are read first; the k-th best sum over them is a floor under the k-th score.
    2. Of all its blocks, the least ones are set aside as long as a text that has only such blocks, one of each term, stays under the floor.
       A question that would have less than half of its weights set aside reads all at once instead.
    3. Texts in the blocks that are left are candidates; those whose sum, with all that was set aside, stays under the floor go.
    4. The blocks set aside are read for the remaining candidates only.

    Only the buckets of asked terms are read. Weights lie dealt by document, so those that pass a filter by block add up
    to pairs of question and text where they are; what shuffles are the k best pairs of each task, and counts of blocks.
    """
    question_weights = written(embed_questions(questions, index), "question-weights")
    out = None
    for part, small in question_blocks(question_weights, broadcast_bytes):
        found = _found_for(part, small, index, k, threshold, exclude_self)
        out = found if out is None else out.unionByName(found)
    return out


def _found_for(part: DataFrame, small: bool, index: TextIndex, k: int, threshold: float | None, exclude_self: bool) -> DataFrame:
    hint = F.broadcast if small else (lambda df: df)
    block = ["bucket", "term", "class"]
    terms = written(part.select("term").distinct(), "asked-terms")
    buckets = [r[0] for r in terms.select(_bucket(index.buckets)).distinct().collect()]  # MOST_BUCKETS numbers at most
    asked = _blocks(index.weights.filter(F.col("bucket").isin(buckets)).join(broadcast_if_few(terms), "term", "left_semi"))
    asked = asked.join(hint(part.select("question_id", "term", "question_weight")), "term")
    asked = asked.withColumn("most", F.col("question_weight") * F.col("largest"))
    by_gain = W.partitionBy("question_id").orderBy(F.desc("most"), "term", "class").rowsBetween(W.unboundedPreceding, -1)
    lesser = F.lag("most", 1, 0.0).over(W.partitionBy("question_id", "term").orderBy("most", F.desc("class")))
    asked = asked.withColumn("first", F.coalesce(F.sum("n").over(by_gain), F.lit(0)) < FIRST_LOOK * k + 1)
    asked = written(asked.withColumn("step", F.col("most") - lesser), "asked-blocks")

    partial = _sums(index, asked.filter("first"), block, hint)
    if exclude_self:
        partial = partial.filter("doc_id <> question_id")
    if index.unit != ["doc_id"]:
        partial = partial.groupBy("doc_id", "question_id").agg(F.max("sum").alias("sum"))
    floor = _top(partial.withColumnRenamed("sum", "score"), k).filter(F.col("rank") == k).select("question_id", F.col("score").alias("floor"))
    if threshold is not None:
        wanted = part.select("question_id").distinct().join(floor, "question_id", "left")
        floor = wanted.select("question_id", F.greatest("floor", F.lit(float(threshold))).alias("floor"))

    adding = W.partitionBy("question_id").orderBy("most", "term", F.desc("class")).rowsBetween(W.unboundedPreceding, W.currentRow)
    split = asked.withColumn("together", F.sum("step").over(adding)).join(floor, "question_id", "left")
    split = split.withColumn("needed", F.coalesce(F.col("together") >= F.col("floor") - SLACK, F.lit(True)))
    whole = W.partitionBy("question_id")
    mostly = F.sum(F.when(F.col("needed"), F.col("n")).otherwise(0)).over(whole) * 2 > F.sum("n").over(whole)
    split = split.withColumn("needed", F.col("needed") | mostly)
    split = written(split.select("question_id", *block, "question_weight", "together", "floor", "needed"), "split-blocks")
    aside = split.filter("not needed")
    spare = aside.groupBy("question_id").agg(F.max("together").alias("spare"), F.first("floor").alias("floor"))

    candidates = _sums(index, split.filter("needed"), block, hint).join(hint(spare), "question_id", "left")
    candidates = candidates.filter(F.coalesce(F.col("sum") + F.col("spare") >= F.col("floor") - SLACK, F.lit(True)))
    if exclude_self:
        candidates = candidates.filter("doc_id <> question_id")
    if aside.isEmpty():
        return candidates.select(*index.unit, "question_id", F.round("sum", SCORE_DIGITS).alias("score"))
    pairs = [*index.unit, "question_id"]
    path, fields = scratch_path(index.weights.sparkSession, "candidates"), [*pairs, "sum"]
    typed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in candidates.select(*fields).schema)
    write_dealt(candidates.select(*fields), path, "doc_id", index.parts)
    candidates = read_dealt(index.weights.sparkSession, path, typed, "doc_id", index.parts)

    # Joined by document, which all lies dealt by; which chunks of it are meant goes along.
    rest = [c for c in index.unit if c != "doc_id"]
    kept = candidates.groupBy("doc_id").agg(F.max(F.lit(True)), *[F.collect_set(c).alias(c) for c in rest]).hint("shuffle_hash")
    others = _block_weights(index, aside, block, hint)
    meant = [F.array_contains(kept[c], others[c]) for c in rest]
    others = others.join(kept, reduce(and_, meant, others["doc_id"] == kept["doc_id"]), "left_semi")
    # Each has its block, so a left join finds the same rows; after it Spark still knows that they lie dealt by document.
    more = others.join(hint(aside.select("question_id", *block, "question_weight")), block, "left")
    more = more.select(*pairs, (F.col("weight") * F.col("question_weight")).alias("sum"))
    both = candidates.select(*fields, F.lit(True).alias("candidate")).withColumnRenamed("doc_id", DEALT)
    both = both.unionByName(more.withColumn("candidate", F.lit(False)).withColumnRenamed("doc_id", DEALT))
    score = F.round(F.sum("sum"), SCORE_DIGITS)
    scored = both.groupBy(*_dealt(pairs)).agg(score.alias("score"), F.max("candidate").alias("candidate")).filter("candidate")
    return scored.withColumnRenamed(DEALT, "doc_id").drop("candidate")


def _block_weights(index: TextIndex, wanted: DataFrame, block: list[str], hint) -> DataFrame:
    """The weights in the blocks that `wanted` names, out of their buckets only."""
    buckets = [r[0] for r in wanted.select("bucket").distinct().collect()]  # MOST_BUCKETS numbers at most
    return index.weights.filter(F.col("bucket").isin(buckets)).join(hint(wanted.select(*block)), block, "left_semi")


def _sums(index: TextIndex, wanted: DataFrame, block: list[str], hint) -> DataFrame:
    """(unit, question_id, sum): what the texts in `wanted` blocks (question_id, block, question_weight) gather there."""
    held = _block_weights(index, wanted, block, hint)
    matched = held.join(hint(wanted.select("question_id", *block, "question_weight")), block)
    return matched.groupBy(*index.unit, "question_id").agg(F.sum(F.col("weight") * F.col("question_weight")).alias("sum"))


def relevance_filter(hits: DataFrame, threshold: float = 0.7) -> DataFrame:
    return hits.filter(F.col("score") >= threshold)


def search_chunk_rollup(questions: DataFrame, index: TextIndex, k: int = 5, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Search an index of chunks, keep the best chunk of each document, then the k best documents.

    Exact: all chunks are scored, pack by pack where they lie. Questions beyond the size of a broadcast are answered part by part.
    """
    _check_k(k)
    question_weights = written(embed_questions(questions, index).select("question_id", "term", "question_weight"), "question-weights")
    found = None
    for part, small in question_blocks(question_weights, broadcast_bytes):
        best = _best_chunks(part, index.packs, k) if small else _all_chunks(part, index, broadcast_bytes)
        found = best if found is None else found.unionByName(best)
    best = found.groupBy("doc_id", "question_id").agg(F.max(F.struct("score", (-F.col("chunk_no")).alias("least"))).alias("best"))
    best = best.select("question_id", "doc_id", F.col("best.score").alias("score"), (-F.col("best.least")).alias("chunk_no"))
    return _top(best, k).select("question_id", "doc_id", "chunk_no", "score", "rank")


def _best_chunks(part: DataFrame, packs: DataFrame, k: int | None) -> DataFrame:
    """(question_id, unit, score): the best chunk of the k best documents for each question, of all that a task meets at a time; unrounded sums of all chunks without k.

    The terms of the questions, no more than a broadcast may hold, travel with the tasks.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in packs.schema["units"].dataType.elementType)
    asked = part.select("question_id", "term", "question_weight").toArrow()
    return packs.mapInArrow(partial(_scored, asked, k), f"question_id {part.schema['question_id'].dataType.simpleString()}, {kinds}, score double")


def _all_chunks(part: DataFrame, index: TextIndex, limit: int) -> DataFrame:
    """The same rows with the scores of all chunks for one question with more terms than a broadcast may hold: its terms are cut into pieces, and sums added up."""
    size = part.agg(F.sum(F.length("term") * 4)).first()[0]
    pieces = min(-(-size // max(limit, 1)) + 1, 64)
    piece = F.pmod(F.xxhash64("term"), F.lit(pieces))
    sums = reduce(DataFrame.unionByName, [_best_chunks(part.filter(piece == n), index.packs, None) for n in range(pieces)])
    return sums.groupBy("question_id", *index.unit).agg(F.round(F.sum("score"), SCORE_DIGITS).alias("score"))


# What a task scores at a time: so many questions, and chunks up to so many or so many products.
QUESTIONS_AT_ONCE, CHUNKS_AT_ONCE, PRODUCTS_AT_ONCE = 256, 2048, 1 << 21


def _scored(asked: pa.Table, k: int | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, terms = (asked[c].combine_chunks().dictionary_encode("encode") for c in ("question_id", "term"))
    q, t, qw = ids.indices.to_numpy(), terms.indices.to_numpy(), asked["question_weight"].to_numpy()
    slices = []
    for first in range(0, len(ids.dictionary), QUESTIONS_AT_ONCE):
        here = np.flatnonzero((q >= first) & (q < first + QUESTIONS_AT_ONCE))
        here = here[np.argsort(t[here], kind="stable")]
        n = np.bincount(t[here], minlength=len(terms.dictionary))
        width = min(QUESTIONS_AT_ONCE, len(ids.dictionary) - first)
        # Of documents scored so far at least k reach the floor, or it is 0.
        slices.append((first, width, n, np.cumsum(n) - n, q[here] - first, qw[here], np.zeros(width)))
    for batch in batches:
        for at in range(batch.num_rows):
            of, codes, weight = _pack_weights(batch, at)
            met = pc.index_in(_terms_of(batch, at), terms.dictionary).fill_null(-1).to_numpy()[codes]
            hit = np.flatnonzero(met >= 0)
            of, met, weight = of[hit], met[hit], weight[hit]
            units = pa.Table.from_struct_array(batch.column("units")[at].values)
            for first, width, n, begin, q_of, w_of, floor in slices:
                rows = list(_scored_pack(of, met, weight, units, k, width, n, begin, q_of, w_of, floor))
                if rows:
                    questions, places, scores = (np.concatenate(x) for x in zip(*rows))
                    out = units.take(places).add_column(0, "question_id", ids.dictionary.take(pa.array(questions + first)))
                    yield from out.append_column("score", pa.array(scores)).combine_chunks().to_batches()


def _scored_pack(of, met, weight, units, k, width, n, begin, q_of, w_of, floor):
    """(question, unit, score) of the chunks of a pack, as places; `floor` is lifted to the k-th score of documents."""
    doc = units["doc_id"].combine_chunks().dictionary_encode("encode").indices.to_numpy()
    many = n[met]
    products = np.append(0, np.cumsum(many))
    ends = np.searchsorted(of, np.arange(len(doc) + 1))  # where the weights of each unit begin
    start = 0
    while start < len(doc):
        most = np.searchsorted(products[ends], products[ends[start]] + PRODUCTS_AT_ONCE, "right") - 1
        end = int(min(max(start + 1, most), start + CHUNKS_AT_ONCE, len(doc)))
        here = slice(ends[start], ends[end])
        reps, count = many[here], end - start
        entry = np.arange(products[here.stop] - products[here.start]) + np.repeat(begin[met[here]] - (products[here] - products[here.start]), reps)
        cell = q_of[entry].astype(np.int64) * count + np.repeat(of[here] - start, reps)
        sums = np.bincount(cell, np.repeat(weight[here], reps) * w_of[entry], width * count).reshape(width, count)
        if k is None:
            question, unit = np.nonzero(sums)
            yield question, unit + start, sums[question, unit]
        else:
            score = np.where(sums > 0, np.floor(sums * 10**SCORE_DIGITS + 0.5) / 10**SCORE_DIGITS, -1.0)
            firsts = np.flatnonzero(np.append(True, doc[start + 1 : end] != doc[start : end - 1]))
            best = np.maximum.reduceat(score, firsts, axis=1)
            if len(firsts) > k:
                np.maximum(floor, np.partition(best, len(firsts) - k, axis=1)[:, -k], out=floor)
            question, place = np.nonzero(best >= floor[:, None])
            found = best[question, place]
            order = np.lexsort((place, -found, question))  # documents lie in their order
            question, place, found = question[order], place[order], found[order]
            kept = np.arange(len(question)) - np.searchsorted(question, question) < k
            question, place, found = question[kept], place[kept], found[kept]
            unit = [x + int(np.argmax(score[i, x:y])) for i, x, y in zip(question, firsts[place], np.append(firsts, count)[place + 1])]
            yield question, np.array(unit, np.int64) + start, found
        start = end


def attach_documents(hits: DataFrame, docs: DataFrame) -> DataFrame:
    """Add the documents' columns to stored search hits; few hits go to where the documents lie."""
    return docs.join(broadcast_if_few(hits), "doc_id")


# --- dense vectors ----------------------------------------------------------------------


def _unit_rows(vectors: pd.Series) -> np.ndarray:
    matrix = np.array(vectors.tolist(), dtype=np.float64)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _best_per_question(q_ids, q_rows, batches: Iterator[pd.DataFrame], k: int, exclude_self: bool) -> pd.DataFrame:
    """The k best vectors for each question over a stream of batches; keeps k rows per question."""
    best = [(np.empty(0), np.empty(0, dtype=np.int64)) for _ in q_ids]
    for batch in batches:
        ids = batch["vec_id"].to_numpy()
        scores = np.round(q_rows @ _unit_rows(batch["embedding"]).T, SCORE_DIGITS)
        for i, (had_scores, had_ids) in enumerate(best):
            row = scores[i]
            keep = row >= had_scores[-1] if len(had_scores) == k else np.ones(len(row), dtype=bool)
            if exclude_self:
                keep = keep & (ids != q_ids[i])
            if not keep.any():
                continue
            all_scores = np.concatenate([had_scores, row[keep]])
            all_ids = np.concatenate([had_ids, ids[keep]])
            order = np.lexsort((all_ids, -all_scores))[:k]
            best[i] = (all_scores[order], all_ids[order])
    lengths = [len(s) for s, _ in best]
    return pd.DataFrame(
        {
            "question_id": np.repeat(np.asarray(q_ids, dtype=np.int64), lengths),
            "vec_id": np.concatenate([ids for _, ids in best]) if best else np.empty(0, dtype=np.int64),
            "score": np.concatenate([s for s, _ in best]) if best else np.empty(0),
        }
    )


_HIT = "question_id long, vec_id long, score double"


def search_topk_vector(
    questions: DataFrame,
    vectors: DataFrame,
    k: int = 5,
    threshold: float | None = None,
    exclude_self: bool = False,
    block: int = VECTOR_BLOCK,
    vector_block: int = 65536,
) -> DataFrame:
    """Exact cosine top-k of `questions` (question_id, embedding) in `vectors` (vec_id, embedding).

    Up to `block` questions travel with the tasks: one pass over the vectors, no shuffle
    of them, at most k rows per question and task come out. Larger question tables are
    multiplied block by block: both sides are cut by hash, every pair of blocks is one
    matrix product, and again only k rows per question and block leave it.
    """
    _check_k(k)
    questions = questions.select("question_id", "embedding")
    vectors = vectors.select("vec_id", "embedding")
    head = questions.limit(block + 1).toPandas()
    if len(head) <= block:
        q_ids, q_rows = head["question_id"].to_numpy(), _unit_rows(head["embedding"]) if len(head) else None

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            if len(q_ids):
                yield _best_per_question(q_ids, q_rows, batches, k, exclude_self)

        local = vectors.mapInPandas(scan, _HIT)
    else:
        local = _block_product(questions, vectors, k, exclude_self, block, vector_block)
    if threshold is not None:
        local = relevance_filter(local, threshold)
    return _top(local, k, tie="vec_id").select("question_id", "vec_id", "score", "rank")


def _block_product(questions, vectors, k, exclude_self, block, vector_block) -> DataFrame:
    # Blocks are cut by hash; a quarter of head room keeps nearly all within their size.
    q_parts = max(1, -(-questions.count() * 5 // (block * 4)))
    v_parts = max(1, -(-vectors.count() * 5 // (vector_block * 4)))
    left = questions.withColumn("q_part", F.pmod(F.xxhash64("question_id"), F.lit(q_parts))).withColumn(
        "v_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(v_parts - 1).cast("long")))
    )
    right = vectors.withColumn("v_part", F.pmod(F.xxhash64("vec_id"), F.lit(v_parts))).withColumn(
        "q_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_parts - 1).cast("long")))
    )

    def multiply(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if q.empty or v.empty:
            return pd.DataFrame({"question_id": [], "vec_id": [], "score": []})
        return _best_per_question(q["question_id"].to_numpy(), _unit_rows(q["embedding"]), iter([v]), k, exclude_self)

    by = ["q_part", "v_part"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(multiply, _HIT)


def hyperplane_signatures(vectors: DataFrame, id_column: str, tables: int, bits: int, seed: int) -> DataFrame:
    """(id, embedding, signatures): per hash table, on which side of `bits` random planes a vector lies."""

    @F.pandas_udf("array<long>")
    def sign(embedding: pd.Series) -> pd.Series:
        rows = np.array(embedding.tolist(), dtype=np.float64)
        planes = np.random.default_rng(seed).standard_normal((rows.shape[1], tables * bits))
        sides = (rows @ planes > 0).reshape(len(rows), tables, bits)
        return pd.Series(list((sides * (1 << np.arange(bits))).sum(axis=2)))

    return vectors.select(id_column, "embedding", sign("embedding").alias("signatures"))


def _cosine(a, b):
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    length = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    return F.try_divide(dot, length(a) * length(b))


def search_ann_vector(
    questions: DataFrame, vectors: DataFrame, k: int = 5, tables: int = 8, bits: int = 6, seed: int = 42
) -> DataFrame:
    """Approximate cosine top-k: only vectors sharing a hash bucket with the question are scored.

    A pair met in several tables is scored in the first one only, so no later shuffle has
    to remove doubles. Bucket members are never gathered: the vectors stay where they are,
    some thousand questions at a time come to them, and each task keeps k rows per question.
    """
    _check_k(k)
    v = hyperplane_signatures(vectors, "vec_id", tables, bits, seed).select(
        "vec_id", "embedding", "signatures", F.posexplode("signatures").alias("table_no", "bucket")
    )
    first_match = F.array_position(F.zip_with("signatures", "q_signatures", lambda a, b: a == b), True) - 1
    parts = max(1, -(-questions.count() // VECTOR_BLOCK))
    out = None
    for n in range(parts):
        part = questions.filter(F.pmod(F.xxhash64("question_id"), F.lit(parts)) == n) if parts > 1 else questions
        q = hyperplane_signatures(part, "question_id", tables, bits, seed).select(
            "question_id",
            F.col("embedding").alias("q_embedding"),
            F.col("signatures").alias("q_signatures"),
            F.posexplode("signatures").alias("table_no", "bucket"),
        )
        pairs = v.join(F.broadcast(q), ["table_no", "bucket"]).filter(first_match == F.col("table_no"))
        score = F.round(_cosine(F.col("q_embedding"), F.col("embedding")), SCORE_DIGITS)
        hits = _top(pairs.select("question_id", "vec_id", score.alias("score")), k, tie="vec_id")
        out = hits if out is None else out.unionByName(hits)
    return out.select("question_id", "vec_id", "score", "rank")


def topic_vectors(vectors: DataFrame, by: str = "label") -> DataFrame:
    """Mean vector per label, as (question_id, embedding)."""
    mean = (
        vectors.select(by, F.posexplode("embedding").alias("at", "x"))
        .groupBy(by, "at")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
    )
    return (
        mean.groupBy(by)  # one row per dimension
        .agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("xs"))
        .select(F.col(by).cast("long").alias("question_id"), F.transform("xs", lambda p: p["x"]).alias("embedding"))
    )


def ann_recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact hits that the approximate search found."""
    found = exact.join(approximate.select("question_id", "vec_id").withColumn("hit", F.lit(1)), ["question_id", "vec_id"], "left")
    return found.agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))


# --- documents by their tags, types and feedback -----------------------------------------


def filter_documents(
    docs: DataFrame,
    doc_type: str | None = None,
    table: str | None = None,
    column: str | None = None,
    any_tags: list[str] | None = None,
) -> DataFrame:
    """Documents of a type, naming a table or column, or carrying one of some tags."""
    if doc_type is not None:
        docs = docs.filter(F.col("doc_type") == doc_type)
    if table is not None:
        docs = docs.filter(F.array_contains("tables", table))
    if column is not None:
        docs = docs.filter(F.array_contains("columns", column))
    if any_tags is not None:
        docs = docs.filter(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in any_tags])))
    return docs


def related_documents(docs: DataFrame, candidates: DataFrame, k: int = 3) -> DataFrame:
    """The k candidates with the highest tag Jaccard per document, itself left out.

    Documents with equal tags have equal neighbours, so sets of tags are compared, not
    documents. Of the candidates with one set of tags only the first k + 1 ids can be among
    the k best of anything (equal scores go by id, one may be the document itself), and by
    the same reasoning only the first k + 1 sets; `related_sets` finds those.
    """
    _check_k(k)
    tag_set = F.array_compact(F.array_sort(F.array_distinct("tags")))
    key = F.to_json(F.col("tags"))
    tagged = docs.select("doc_id", tag_set.alias("tags")).filter(F.size("tags") > 0).withColumn("set_id", key)
    first = W.partitionBy("member_set").orderBy("doc_id")
    members = (
        candidates.select("doc_id", tag_set.alias("tags"))
        .filter(F.size("tags") > 0)
        .withColumn("member_set", key)
        .withColumn("n", F.row_number().over(first))
        .filter(F.col("n") <= k + 1)
        .groupBy("member_set")
        .agg(
            F.sort_array(F.collect_list("doc_id")).alias("members"),  # k + 1 ids at most
            F.first("tags").alias("tags"),  # the same in the whole group
        )
        .checkpoint()
    )
    sets = (
        tagged.groupBy("set_id")
        .agg(F.count(F.lit(1)).alias("rows"), F.first("tags").alias("tags"))
        .checkpoint()
    )
    offered = members.select(F.struct(F.element_at("members", 1).alias("first_id"), "member_set").alias("member"), "tags")
    best_sets = related_sets(sets.select("set_id", "tags"), offered, k + 1)
    ranked = (
        best_sets.select("set_id", F.col("member.member_set").alias("member_set"), "score")
        .join(members.select("member_set", "members"), "member_set")
        .select("set_id", "score", F.explode("members").alias("related_id"))
        .withColumn("n", F.row_number().over(W.partitionBy("set_id").orderBy(F.desc("score"), "related_id")))
        .filter(F.col("n") <= k + 1)
        .groupBy("set_id")
        .agg(F.sort_array(F.collect_list(F.struct("n", "related_id", "score"))).alias("best"))  # k + 1 at most
    )
    matched = lookup_join(
        tagged.select("doc_id", "set_id"), ranked, key="set_id", spread_by="doc_id", hot=hot_keys(sets, "set_id", "rows")
    )
    others = F.slice(F.filter("best", lambda b: b["related_id"] != F.col("doc_id")), 1, k)
    return matched.select("doc_id", F.posexplode(others).alias("at", "b")).select(
        "doc_id",
        F.col("b.related_id").alias("related_id"),
        F.col("b.score").alias("score"),
        (F.col("at") + 1).alias("rank"),
    )


def related_sets(asked: DataFrame, offered: DataFrame, k: int) -> DataFrame:
    """(set_id, member, score): exact Jaccard top-k of `asked` (set_id, tags) in `offered` (member, tags); ties go by member.

    `tags` are distinct sets, a row each. Tags are ordered by rarity among the offered, rarest
    first, and two sets meet at their first tag in common. From there on a set is its suffix: what
    both share lies in the two suffixes. Sets of equal size and suffix therefore score alike
    where they meet, so a tag is joined suffix with suffix, not set with set, and of the offered sets behind
    one suffix the first k are enough. However many sets hold a frequent tag, only still more frequent
    tags can follow it and its suffixes stay few. Meeting again at a later tag finds a
    lower score only, and the highest counts.

    All sets first meet at their rarest tag. That gives a k-th score so far, and later tags are
    passed over where the length of the suffixes cannot reach it.
    """
    df = offered.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("df")).checkpoint()
    hot = hot_keys(df, "tag", "df")
    offers = (
        _suffixes(offered, "member", df, hot)
        .withColumn("n", F.row_number().over(W.partitionBy("tag", "size", "suffix").orderBy("member")))
        .filter(F.col("n") <= k)
        .groupBy("tag", "size", "suffix")
        .agg(F.sort_array(F.collect_list("member")).alias("members"))  # k at most
        .select("tag", F.col("size").alias("o_size"), F.col("suffix").alias("o_suffix"), "members")
        .checkpoint()
    )
    places = _suffixes(asked, "set_id", df, hot).withColumn("node", F.to_json(F.struct("size", "suffix"))).checkpoint()
    rarest = places.filter("at = 1").withColumn("floor", F.lit(0.0))
    first = _met(rarest, offers, k).checkpoint()
    kth = first.groupBy("set_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    later = places.filter("at > 1").join(kth, "set_id", "left").withColumn("floor", F.coalesce("kth", F.lit(0.0))).drop("kth")
    # A set that is nothing but this suffix would score highest.
    open_places = later.filter(F.round(F.size("suffix") / F.col("size"), SCORE_DIGITS) >= F.col("floor"))
    found = first.unionByName(_met(open_places, offers, k))
    best = found.groupBy("set_id", "member").agg(F.max("score").alias("score"))
    return _top(best, k, by="set_id", tie="member").drop("rank")


def _suffixes(sets: DataFrame, key: str, df: DataFrame, hot: DataFrame) -> DataFrame:
    """(key, size, at, tag, suffix): per tag of a set, rarest first, this tag and those after it; tags not in `df` only count in size."""
    each = sets.select(key, F.size("tags").alias("size"), F.explode("tags").alias("tag"))
    ordered = (
        lookup_join(each, df, "tag", spread_by=key, hot=hot)
        .groupBy(key, "size")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "tag"))), lambda t: t["tag"]).alias("tags"))  # one set's tags
    )
    return ordered.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("tags")))).select(
        key, "size", "at", F.element_at("tags", F.col("at")).alias("tag"), F.slice("tags", F.col("at"), F.size("tags")).alias("suffix")
    )


def suffix_pairs(nodes: DataFrame, offers: DataFrame) -> DataFrame:
    """(node, members, score) of the suffixes that meet at a tag and can reach the floor of their node."""
    shorter = F.least(F.size("suffix"), F.size("o_suffix"))
    jaccard = lambda shared: F.round(shared / (F.col("size") + F.col("o_size") - shared), SCORE_DIGITS)
    pairs = nodes.join(offers, "tag").filter(jaccard(shorter) >= F.col("floor"))
    return pairs.select("node", "members", jaccard(F.size(F.array_intersect("suffix", "o_suffix"))).alias("score"), "floor")


def _met(places: DataFrame, offers: DataFrame, k: int) -> DataFrame:
    """(set_id, member, score): per place of a set its k best offers by what they share from there on."""
    nodes = places.groupBy("node", "tag", "size", "suffix").agg(F.min("floor").alias("floor"), F.count(F.lit(1)).alias("rows")).checkpoint()
    groups = suffix_pairs(nodes.drop("rows"), offers).filter("score >= floor").withColumn("member", F.element_at("members", 1))
    # Before a set among the k best there are fewer than k groups, as there are fewer than k sets.
    single = _top(groups, k, by="node", tie="member").select("node", "score", F.explode("members").alias("member"))
    best = (
        _top(single, k, by="node", tie="member")
        .groupBy("node")
        .agg(F.collect_list(F.struct("member", "score")).alias("best"))  # k at most
    )
    spread = lookup_join(places.select("set_id", "node"), best, "node", spread_by="set_id", hot=hot_keys(nodes, "node", "rows"))
    return spread.select("set_id", F.explode("best").alias("b")).select("set_id", "b.member", "b.score")


def document_prior(history: DataFrame) -> DataFrame:
    """(doc_id, approval): share of thumbs up among the votes, smoothed by one vote each way."""
    votes = history.filter("thumbs_up is not null").select(
        F.explode("context_docs").alias("doc_id"), F.col("thumbs_up").cast("int").alias("up")
    )
    return votes.groupBy("doc_id").agg(((F.sum("up") + 1) / (F.count(F.lit(1)) + 2)).alias("approval"))


def feedback_rerank(hits: DataFrame, prior: DataFrame, alpha: float = 0.5) -> DataFrame:
    """Order each question's hits by score times what users thought of the document."""
    factor = 1 + F.lit(alpha) * (F.coalesce("approval", F.lit(0.5)) - 0.5)
    adjusted = hits.join(prior, "doc_id", "left").withColumn("adjusted", F.round(F.col("score") * factor, 10))
    best = W.partitionBy("question_id").orderBy(F.desc("adjusted"), "doc_id")
    return adjusted.select(
        "question_id", "doc_id", "score", "adjusted", F.row_number().over(best).cast("int").alias("rank")
    )


def retrieval_quality(hits: DataFrame, truth: DataFrame, k: int = 5) -> DataFrame:
    """Recall of known (question_id, doc_id) pairs within rank k, and the mean reciprocal rank.

    The reciprocal rank of a question is that of its first right document, 0 if none.
    """
    found = truth.join(hits.select("question_id", "doc_id", "rank"), ["question_id", "doc_id"], "left")
    per_pair = found.select("question_id", F.when(F.col("rank") <= k, 1).otherwise(0).alias("hit"), "rank")
    per_question = per_pair.groupBy("question_id").agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("hit").alias("hits"), F.min("rank").alias("first")
    )
    return per_question.agg(
        F.count(F.lit(1)).alias("questions"),
        F.sum("pairs").alias("pairs"),
        F.round(F.try_divide(F.sum("hits"), F.sum("pairs")), 6).alias("recall"),
        F.round(F.avg(F.coalesce(1 / F.col("first"), F.lit(0.0))), 6).alias("mrr"),
    )


# --- schema documents -------------------------------------------------------------------

# Fixed value: how a schema document lists a column.
COLUMN_LINE = r"- (\w+) \(([^\n]+?)\): ([^\n]*)"


def schema_columns(docs: DataFrame) -> DataFrame:
    """(table_name, position, column_name, column_type, description) out of schema documents.

    A document that names no table goes by its doc_id.
    """
    named = F.nullif(F.regexp_extract("content", r"Table: (\w+)", 1), F.lit(""))
    table = F.coalesce(named, F.col("doc_id"))
    group = lambda n: F.regexp_extract_all("content", F.lit(COLUMN_LINE), F.lit(n))
    return docs.filter("doc_type = 'schema'").select(
        table.alias("table_name"),
        F.posexplode(F.arrays_zip(group(1).alias("name"), group(2).alias("type"), group(3).alias("text"))).alias(
            "at", "c"
        ),
    ).select(
        "table_name",
        (F.col("at") + 1).alias("position"),
        F.col("c.name").alias("column_name"),
        F.col("c.type").alias("column_type"),
        F.trim("c.text").alias("description"),
    )


def schema_lookup(columns: DataFrame, word: str) -> DataFrame:
    """Tables with a column that mentions a word: how many columns match, and of how many."""
    word = word.lower()
    match = (
        F.contains(F.lower("table_name"), F.lit(word))
        | F.contains(F.lower("column_name"), F.lit(word))
        | F.contains(F.lower("description"), F.lit(word))
    )
    return (
        columns.groupBy("table_name")
        .agg(
            F.count(F.lit(1)).alias("columns_total"),
            F.count(F.when(match, 1)).alias("columns_matched"),
            F.array_join(F.array_sort(F.collect_list(F.when(match, F.col("column_name")))), ", ").alias("matched_names"),
        )
        .filter("columns_matched > 0")
    )


# How often a word counts in the text of a table, by where it stands.
TABLE_WEIGHT, COLUMN_WEIGHT = 4, 3
# Words of questions about schemas that say nothing about what is looked for.
QUESTION_WORDS = (
    "a all an and are available be by can contain do does find for from have hold how i in is it many me of on or our show that the "
    "there to we what where which who with column field information list schema table"
).split()


def schema_words(text):
    """Words of names and descriptions: lower case, cut at anything but letters and digits, plurals without their ending."""
    words = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")
    words = F.regexp_replace(words, r"(ss|x|ch|sh)es( |$)", "$1$2")
    return F.trim(F.regexp_replace(words, r"([a-z]{2}[a-rt-z])s( |$)", "$1$2"))


def schema_texts(columns: DataFrame) -> DataFrame:
    """(doc_id, content): per table the words of all its fields, those of its name and its column names several times.

    An index of these texts is one over fields with a weight each; `columns` comes from `schema_columns`.
    """
    field = lambda name, times: F.repeat(F.concat(schema_words(F.col(name)), F.lit(" ")), times)
    line = F.concat(field("column_name", F.lit(COLUMN_WEIGHT)), field("column_type", F.lit(1)), field("description", F.lit(1)))
    return (
        columns.groupBy("table_name")
        .agg(F.array_join(F.array_sort(F.collect_list(F.struct("position", line.alias("line"))))["line"], "").alias("lines"))  # one table's columns
        .select(F.col("table_name").alias("doc_id"), F.concat(field("table_name", F.lit(TABLE_WEIGHT)), "lines").alias("content"))
    )


def schema_answers(questions: DataFrame, columns: DataFrame, index: TextIndex, k: int = 3) -> DataFrame:
    """Where to look for what questions (question_id, question) ask: their k best tables and the columns that matter.

    (question_id, rank, table_name, columns_total, position, column_name, column_type, matched, score), where `index`
    is one of `schema_texts`. A table that the question names shows all its columns, another only
    those that share a word with the question; `matched` counts these words.
    """
    words = F.array_distinct(F.split(schema_words(F.col("question")), " "))
    asked = questions.select("question_id", F.array_except(words, F.array(*[F.lit(w) for w in QUESTION_WORDS])).alias("words"))
    hits = search_topk_text(asked.select("question_id", F.array_join("words", " ").alias("question")), index, k)
    own = F.split(schema_words(F.concat_ws(" ", "column_name", "column_type", "description")), " ")
    totals = columns.groupBy("table_name").agg(F.count(F.lit(1)).alias("columns_total"))
    return (
        hits.withColumnRenamed("doc_id", "table_name")
        .join(asked, "question_id")
        .join(columns.select("table_name", "position", "column_name", "column_type", own.alias("own")), "table_name")
        .withColumn("matched", F.size(F.array_intersect("own", "words")))
        .filter((F.col("matched") > 0) | F.arrays_overlap("words", F.split(schema_words(F.col("table_name")), " ")))
        .join(totals, "table_name")
        .select("question_id", "rank", "table_name", "columns_total", "position", "column_name", "column_type", "matched", "score")
    )
