"""The documentation table: schema, loading, appending, live rows, sync plan, index tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from lorebase.functions.text import token_characters
from lorebase.session import broadcast_if_few, delete, drop_scratch, exists, folders, read_dealt, scratch_path, write_dealt, written

# The columns of the documentation table, in order.
KB_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.StringType(), False),
        T.StructField("doc_type", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("metadata", T.StringType()),
        T.StructField("tables", T.ArrayType(T.StringType())),
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)
KB_COLUMNS = KB_SCHEMA.fieldNames()


def create_kb(spark: SparkSession, table: str, path: str | None = None) -> None:
    """Create the database and the table unless they are there."""
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in KB_SCHEMA)
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{location}")


def _stamped(docs: DataFrame, source: str, stamp) -> DataFrame:
    """Fill the columns a caller may leave out and put all in table order."""
    empty = F.array().cast("array<string>")
    now = F.current_timestamp() if stamp is None else F.lit(stamp).cast("timestamp")
    defaults = {
        "metadata": F.to_json(F.struct(F.lit(source).alias("source"))),
        "tables": empty,
        "columns": empty,
        "tags": empty,
        "created_at": now,
        "updated_at": now,
    }
    out = docs
    for name, default in defaults.items():
        out = out.withColumn(name, F.coalesce(F.col(name), default) if name in docs.columns else default)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in KB_SCHEMA])


def load_documents(docs: DataFrame, source: str = "sample", stamp: str | None = None) -> DataFrame:
    """Documents in table form: metadata names the source, both times are the load time."""
    return _stamped(docs, source, stamp)


def new_documents(docs: DataFrame, source: str = "user_added", stamp: str | None = None) -> DataFrame:
    """Documents to append, marked as added by a user."""
    return _stamped(docs, source, stamp)


def write_kb(docs: DataFrame, path: str, seq: int = 0, mode: str = "overwrite") -> None:
    """Write one ingest; `seq` is its number and decides between equal update times."""
    docs.withColumn("seq", F.lit(seq).cast("bigint")).write.mode(mode).parquet(path)


def read_kb(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*KB_SCHEMA.fields, T.StructField("seq", T.LongType())])
    return spark.read.schema(schema).parquet(path)


def current_documents(kb: DataFrame) -> DataFrame:
    """One live row per `doc_id`: the latest update, then the latest ingest.

    Spark keeps one row per id on each map task before it shuffles, so an id with very
    many versions does not pile up in one task.
    """
    latest = W.partitionBy("doc_id").orderBy(F.desc("updated_at"), F.desc("seq"))
    return kb.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").drop("_n")


# Shares of rows per part of them, so that parts are about equally large.
SHARES = 8


def dealt_versions(kb: DataFrame, path: str) -> DataFrame:
    """`current_documents` of a table whose tasks may be few and large, dealt by document into parts of about equal size.

    Sorting a task's rows to find the latest versions would hold all that it reads, such as a file of one row group. So rows are dealt out first,
    unsorted and in any order, into no more parts than a shuffle writes without holding rows. Each share keeps one row per id, written to
    `path`; an id with very many versions does not pile up. What is left is dealt by document. A task sorts a part, whatever it was given to read.
    """
    spark = kb.sparkSession
    parts = parts_of(kb)
    direct = int(spark.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    at_once = max(1, min(parts, direct))
    shared = kb.withColumn("_share", F.pmod(F.monotonically_increasing_id(), F.lit(at_once * SHARES))).repartition(at_once, "_share")
    latest = W.partitionBy("doc_id", "_share").orderBy(F.desc("updated_at"), F.desc("seq"))
    kept = shared.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").select(*kb.columns)
    kept.write.mode("overwrite").parquet(path)
    return current_documents(spark.read.schema(kb.schema).parquet(path).repartition(parts, "doc_id"))


def metadata_source(metadata):
    return F.from_json(metadata, "map<string,string>")["source"]


def content_hash(content):
    return F.sha2(content, 256)


def _hash_of(docs: DataFrame):
    return F.col("content_hash") if "content_hash" in docs.columns else content_hash(F.col("content"))


def sync_plan(docs: DataFrame, indexed: DataFrame) -> DataFrame:
    """What a sync has to do per document, from hashes only.

    `docs` needs (doc_id, content), or a content_hash where that is known; `indexed` holds (doc_id, content_hash) of the last sync.
    """
    now = docs.select("doc_id", _hash_of(docs).alias("new_hash"))
    then = indexed.select("doc_id", F.col("content_hash").alias("old_hash"))
    action = (
        F.when(F.col("old_hash").isNull(), "insert")
        .when(F.col("new_hash").isNull(), "delete")
        .when(F.col("old_hash") != F.col("new_hash"), "update")
        .otherwise("unchanged")
    )
    return now.join(then, "doc_id", "full").select("doc_id", action.alias("action"), "new_hash")


# --- index tables -----------------------------------------------------------------------


# Most bytes of text that a task counts at a time, but for a longer text.
COUNTED_BYTES = 1 << 22
# Most bytes of text in a pack, about, and most packs in a file: a reader may hold all of these at once.
PACK_BYTES, FILE_PACKS = 6 << 20, 4


def term_counts(docs: DataFrame, unit: list[str], text: str = "content") -> DataFrame:
    """Term frequencies per unit (a document, or a chunk of one); rows that share a unit count together.

    Texts are sorted by unit and counted as they pass, so what moves between tasks is texts, not their many terms, and a task
    holds the terms of some texts only, however many it is given. Terms are those of `tokens`; a batch of texts is cut at once.
    """
    found, kinds = _by_unit(docs, unit, text)
    return found.mapInArrow(partial(_counted, token_characters(docs.sparkSession)), f"{', '.join(kinds)}, term string, tf int")


def packed_counts(docs: DataFrame, unit: list[str], text: str = "content") -> DataFrame:
    """The counts of `term_counts` in packs, one row for some thousand small texts.

    A pack has its units in order, its terms with the number of its units that hold them, and, as numbers of 32 bits, how many
    terms each unit has, and the place among the terms and the frequency of each. A unit lies in one pack; those without a term in none.
    """
    found, kinds = _by_unit(docs, unit, text)
    cut = partial(_counted, token_characters(docs.sparkSession), rows=_packed, most=PACK_BYTES)
    schema = f"pack string, units array<struct<{', '.join(kinds)}>>, words array<struct<term string, n int>>, sizes binary, codes binary, tf binary"
    return found.mapInArrow(lambda batches: cut(_joined(batches)), schema)


def _by_unit(docs: DataFrame, unit: list[str], text: str) -> tuple[DataFrame, list[str]]:
    """Lower-case texts sorted by unit, with the first row of each marked, and the unit's columns with their types."""
    same_unit = W.partitionBy(*unit).orderBy(unit[0])
    placed = docs.select(*unit, F.col(text).alias("_text"), (F.row_number().over(same_unit) == 1).alias("_first"))
    found = placed.select(*unit, "_first", F.lower("_text").alias("_text"))
    return found, [f"`{f.name}` {f.dataType.simpleString()}" for f in found.select(*unit).schema]


def _posted(units: pa.Table, of: np.ndarray, words: pa.Array, codes: np.ndarray, tf: np.ndarray) -> list[pa.RecordBatch]:
    """Counts as rows (unit, term, tf): `of` and `codes` are the places of their units and terms."""
    rows = units.take(of).append_column("term", words.take(pa.array(codes))).append_column("tf", pa.array(tf.astype(np.int32)))
    return rows.combine_chunks().to_batches()


def _packed(units: pa.Table, of: np.ndarray, words: pa.Array, codes: np.ndarray, tf: np.ndarray) -> list[pa.RecordBatch]:
    """The same counts, in order of their units, as one pack."""
    if not len(tf):
        return []
    sizes, n = np.bincount(of, minlength=units.num_rows), np.bincount(codes, minlength=len(words))
    told = units.take(np.flatnonzero(sizes)).combine_chunks().to_batches()[0].to_struct_array()
    terms = pa.StructArray.from_arrays([words.take(pa.array(np.flatnonzero(n))), pa.array(n[n > 0].astype(np.int32))], ["term", "n"])
    codes = (np.cumsum(n > 0) - 1)[codes]
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    numbers = [pa.array([x.astype(np.int32).tobytes()], pa.binary()) for x in (sizes[sizes > 0], codes, tf)]
    names = ["pack", "units", "words", "sizes", "codes", "tf"]
    return [pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), one(told), one(terms), *numbers], names)]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about as many bytes as go into a pack."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > PACK_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _counted(characters: np.ndarray, batches: Iterator[pa.RecordBatch], rows=_posted, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows (unit, _first, _text) that are sorted by unit to `rows` of their counts. The last unit waits for what may follow of it."""
    taken = np.zeros(0x110000, bool)
    for start, end in characters:
        taken[start:end] = True
    held = None  # its row, terms and counts
    for batch in batches:
        texts = pc.fill_null(batch.column("_text"), "").cast(pa.large_string())
        starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        at = 0
        while at < batch.num_rows:
            after = max(at + 1, int(np.searchsorted(starts, starts[at] + (most or COUNTED_BYTES), "right")) - 1)
            part, first = batch.slice(at, after - at), batch.column("_first").slice(at, after - at).to_numpy(zero_copy_only=False)
            fresh, sizes = _cut(texts.buffers()[2], starts[at : after + 1], taken)
            at = after
            units = pa.Table.from_batches([part]).drop_columns(["_first", "_text"]).take(np.flatnonzero(first))
            of = np.repeat(np.cumsum(first) - 1, sizes)
            waiting = 0 if held is None else len(held[1])
            if held is not None:
                units, of, fresh = pa.concat_tables([held[0], units]), of + 1, pa.concat_arrays([held[1], fresh])
            coded = fresh.dictionary_encode()
            words, width, codes = coded.dictionary, max(len(coded.dictionary), 1), coded.indices.to_numpy().astype(np.int64)
            keys, tf = _runs(of * width + codes[waiting:])
            if waiting:  # of the first unit
                more = np.searchsorted(keys, width)
                both, place = np.unique(np.concatenate([codes[:waiting], keys[:more]]), return_inverse=True)
                n = np.bincount(place, np.concatenate([held[2], tf[:more]]), len(both)).astype(np.int64)
                keys, tf = np.concatenate([both, keys[more:]]), np.concatenate([n, tf[more:]])
            of, code = keys // width, keys % width
            end = np.searchsorted(of, units.num_rows - 1)
            yield from rows(units, of[:end], words, code[:end], tf[:end])
            held = units.slice(units.num_rows - 1), words.take(pa.array(code[end:])), tf[end:]
    if held is not None:
        units, terms, tf = held
        yield from rows(units, np.zeros(len(tf), np.int64), terms, np.arange(len(tf)), tf)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order, and how often each occurs."""
    keys = np.sort(keys)
    starts = np.flatnonzero(np.append(np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]))
    return keys[starts], np.diff(np.append(starts, len(keys)))


def _cut(buffer: pa.Buffer | None, starts: np.ndarray, taken: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts in UTF-8 that begin at `starts` (the last ends at the last), and how many each text has: maximal runs of `taken` code points."""
    starts = starts.astype(np.int64)
    data = np.frombuffer(buffer or b"", np.uint8)[starts[0] : starts[-1]]
    starts = starts - starts[0]
    inside = np.frombuffer(data.tobytes().translate(taken[:128].tobytes() + bytes(128)), bool)
    lead = np.flatnonzero(data >= 0xC0)  # first bytes of longer code points
    if len(lead):
        inside = inside.copy()
        size = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
        point = data[lead] & (0x7F >> size)
        point = point.astype(np.int32)
        for n in (1, 2, 3):
            longer = size > n
            point[longer] = (point[longer] << 6) | (data[lead[longer] + n] & 0x3F)
        lead, size = lead[taken[point]], size[taken[point]]
        for n in range(4):
            inside[lead[size > n] + n] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    own = starts[:-1][starts[:-1] < starts[1:]]  # no run goes on from one text into the next
    begins[own] = inside[own]
    ends[own[1:] - 1] = inside[own[1:] - 1]
    begin = np.flatnonzero(begins)
    offsets = np.concatenate([[0], np.cumsum(np.flatnonzero(ends) + 1 - begin)]).astype(np.int32)
    terms = pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
    return terms, np.diff(np.searchsorted(begin, starts))


# Characters of text in a part of an index, about.
PART_CHARACTERS = 1 << 23


def parts_of(docs: DataFrame, text: str = "content") -> int:
    """Into how many parts an index of these texts is dealt; texts are measured."""
    return _parts_for(docs, docs.agg(F.sum(F.length(text).cast("long"))).first()[0])


def _parts_for(docs: DataFrame, total: int | None) -> int:
    total = total or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-total // PART_CHARACTERS))


def write_postings(docs: DataFrame, path: str, unit: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """Tokenise once and keep the term frequencies as a table; returns the table.

    Tokenising is the dear step and three later steps read its result (document
    frequencies, weights, scores), so it is written rather than recomputed, and a lost
    executor costs no second pass over the texts. Of `docs` that are dealt by doc_id into `parts` the postings stay so, and
    what follows by document needs no shuffle. Those of chunks are kept in packs, see `packed_counts`: a row of its own for each
    of their many postings costs more than all that is done with it.
    """
    unit = unit or ["doc_id"]
    if unit != ["doc_id"]:
        counts = packed_counts(docs, unit)
        counts.write.mode("overwrite").option("maxRecordsPerFile", FILE_PACKS).parquet(path)
        return docs.sparkSession.read.schema(counts.schema).parquet(path)
    counts = term_counts(docs, unit)
    if parts:
        write_dealt(counts, path, "doc_id", parts)
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in counts.schema)
        return read_dealt(docs.sparkSession, path, fields, "doc_id", parts)
    counts.write.mode("overwrite").parquet(path)
    return docs.sparkSession.read.schema(counts.schema).parquet(path)


# An index is kept in segments, one per sync or stream batch: postings, and `docs`, which says per document which
# version the segment holds. `docs` is written last and in one go, so a segment without it does not count.
ENTRY_SCHEMA = "doc_id string, content_hash string, updated_at timestamp, seq bigint, sync_no bigint, segment string"
POSTING_SCHEMA = "doc_id string, term string, tf int, segment string"


def _entries(docs: DataFrame, sync_no: int) -> DataFrame:
    seq = F.col("seq").cast("bigint") if "seq" in docs.columns else F.lit(0).cast("bigint")
    return docs.select(
        "doc_id",
        _hash_of(docs).alias("content_hash"),
        F.col("updated_at").cast("timestamp").alias("updated_at"),
        seq.alias("seq"),
        F.lit(sync_no).cast("bigint").alias("sync_no"),
    )


def _write_postings(postings: DataFrame, path: str) -> None:
    """A dictionary of terms outgrows its page and is then given up, so none is tried."""
    postings.write.mode("overwrite").option("parquet.enable.dictionary#term", "false").parquet(path)


def write_segment(docs: DataFrame, path: str, segment: str, sync_no: int = 0, gone: DataFrame | None = None) -> None:
    """Write one segment; writing it again replaces it.

    `docs` needs (doc_id, content, updated_at, seq), perhaps content_hash, one row per document. `gone` are entries of deleted documents: a
    row without a hash, which hides what earlier entries say.
    """
    entries = _entries(docs, sync_no)
    if gone is not None:
        entries = entries.unionByName(gone)
    _write_postings(term_counts(docs, ["doc_id"]), f"{path}/postings/segment={segment}")
    entries.write.mode("overwrite").parquet(f"{path}/docs/segment={segment}")


def _read_segments(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    """A table of an index over all segments, empty before the first one."""
    try:
        table = spark.read.schema(schema).parquet(f"{path}/{kind}")
        table.schema
        return table
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schema)


# Compactions in place are entered in `compactions`, one folder each, which names the segments that its segment stands for.
# An entry counts once it is written whole, and only where no earlier one has replaced any of its segments: of two
# compactions that ran at the same time over the same segments the one with the smaller number counts.
def _compacted(number: int) -> str:
    return f"compacted-{number:09d}"


def _replaced_segments(spark: SparkSession, path: str) -> tuple[set[str], set[str]]:
    """(segments that a compaction replaced, segments of the compactions that count)."""
    replaced: set[str] = set()
    counting: set[str] = set()
    for name in sorted(folders(spark, f"{path}/compactions")):
        if exists(spark, f"{path}/compactions/{name}/_SUCCESS"):
            stands_for = {r[0] for r in spark.read.text(f"{path}/compactions/{name}").collect()}
            if not stands_for & replaced:
                replaced |= stands_for
                counting.add(name)
    return replaced, counting


def live_segments(spark: SparkSession, path: str) -> list[str]:
    """The segments that make up an index now: those of syncs and streams since the last compaction, and what it left."""
    replaced, counting = _replaced_segments(spark, path)
    names = {f.removeprefix("segment=") for f in folders(spark, f"{path}/docs")}
    return sorted(n for n in names - replaced if n in counting or not n.startswith("compacted-"))


# What makes an entry the latest of its document: update time, ingest, sync; the rest settles ties.
_ORDER = ["updated_at", "seq", "sync_no", "segment"]


def _latest_entries(docs: DataFrame) -> DataFrame:
    """(doc_id, last, n): the latest entry of each document, and how many there are."""
    return docs.groupBy("doc_id").agg(F.max(F.struct(*_ORDER, "content_hash")).alias("last"), F.count(F.lit(1)).alias("n"))


def live_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The live documents and postings of a segmented index.

    Per document only its latest version counts, by update time, then ingest, whatever the order in which
    segments were written; documents whose latest entry is a deletion are gone. The superseded entries are taken out
    rather than the live ones looked up: they are few after a compaction, and then the postings need no shuffle.
    Tables that were opened before a compaction go on reading the segments it replaced, until `drop_replaced` deletes them.
    """
    now = F.col("segment").isin(live_segments(spark, path))
    docs = _read_segments(spark, path, "docs", ENTRY_SCHEMA).filter(now)
    postings = _read_segments(spark, path, "postings", POSTING_SCHEMA).filter(now)
    entries = _latest_entries(docs)
    latest = entries.select("doc_id", "last.*").filter("content_hash is not null")
    superseded = (
        docs.join(entries.filter("n > 1 or last.content_hash is null").select("doc_id", "last"), "doc_id")
        .filter("segment <> last.segment or last.content_hash is null")
        .select("doc_id", "segment")
        .checkpoint()
    )
    whole = {r[0] for r in docs.select("segment").distinct().collect()}  # a row per sync since the last compaction
    outdated = {r[0] for r in superseded.select("segment").distinct().collect()}
    # Most postings are read as they are; only those of segments that hold outdated versions meet them.
    live = postings.filter(F.col("segment").isin(sorted(whole - outdated)))
    if outdated:
        mixed = postings.filter(F.col("segment").isin(sorted(outdated)))
        live = live.unionByName(mixed.join(broadcast_if_few(superseded), ["doc_id", "segment"], "left_anti").select(*live.columns))
    return latest, live


def compact_index(spark: SparkSession, path: str, to: str) -> None:
    """Write the live rows of a segmented index as one segment of a new index."""
    latest, postings = live_index(spark, path)
    postings.drop("segment").write.parquet(f"{to}/postings/segment=compacted")
    latest.drop("segment").select("doc_id", "content_hash", "updated_at", "seq", "sync_no").write.parquet(f"{to}/docs/segment=compacted")


def compact_in_place(spark: SparkSession, path: str, number: int) -> bool:
    """Fold all segments of an index into one, under readers and writers; False where compaction `number` was done before.

    Postings and entries of the live documents are written as a new segment, entries of deletions with them, so that versions that arrive
    late are still outdone. The entry that lets it stand for the old segments comes last. A compaction that broke off left
    nothing that counts and is run again under its number; segments written in the meantime stay beside it.
    """
    segment = _compacted(number)
    if exists(spark, f"{path}/compactions/{segment}/_SUCCESS"):
        return False
    folded = live_segments(spark, path)
    entries = _read_segments(spark, path, "docs", ENTRY_SCHEMA).filter(F.col("segment").isin(folded))
    latest = written(_latest_entries(entries).select("doc_id", "last.*"), "latest")
    _, postings = live_index(spark, path)
    postings = postings.filter(F.col("segment").isin(folded)).drop("segment")
    _write_postings(postings, f"{path}/postings/segment={segment}")
    latest.drop("segment").write.mode("overwrite").parquet(f"{path}/docs/segment={segment}")
    names = spark.createDataFrame([(n,) for n in folded], "segment string")
    names.coalesce(1).write.mode("overwrite").text(f"{path}/compactions/{segment}")
    return True


def drop_replaced(spark: SparkSession, path: str) -> list[str]:
    """Delete the segments that compactions replaced, and those of compactions that do not count; returns their names.

    To be run when nobody reads an index opened before the last compaction, and no compaction is under way.
    """
    replaced, counting = _replaced_segments(spark, path)
    names = {f.removeprefix("segment=") for f in folders(spark, f"{path}/docs")}
    gone = sorted(n for n in names if n in replaced or (n.startswith("compacted-") and n not in counting))
    for name in gone:
        for kind in ("postings", "docs"):
            delete(spark, f"{path}/{kind}/segment={name}")
    return gone


def sync_index(kb: DataFrame, path: str, sync_no: int) -> DataFrame:
    """Bring a segmented index up to date with `kb` (doc_id, content, perhaps updated_at and seq; one live row per document), touching changed documents only.

    Returns the plan that was carried out. With no change nothing is written. The plan is made against the entries of
    other syncs, so a sync that broke off is simply run again under its number. What `kb` says
    is final: an entry is never dated before the one it replaces, and a deletion comes right after it.
    """
    spark = kb.sparkSession
    segment = f"sync-{sync_no}"
    replaced, _ = _replaced_segments(spark, path)
    while segment in replaced:  # what is written under that name would not be read
        segment += "-again"
    others = _read_segments(spark, path, "docs", ENTRY_SCHEMA)
    others = others.filter((F.col("segment") != segment) & F.col("segment").isin(live_segments(spark, path)))
    latest = _latest_entries(others).select("doc_id", "last.*")
    indexed = latest.filter("content_hash is not null")
    seq = F.col("seq").cast("bigint") if "seq" in kb.columns else F.lit(0).cast("bigint")
    updated = F.col("updated_at") if "updated_at" in kb.columns else F.lit("1970-01-01").cast("timestamp")
    held = scratch_path(spark, "texts")
    texts = _dealt_texts(kb.select("doc_id", "content", updated.alias("updated_at"), seq.alias("seq")), held)
    plan = sync_plan(texts, indexed).filter("action <> 'unchanged'").checkpoint()
    if not plan.isEmpty():
        was = latest.select("doc_id", F.struct("updated_at", "seq").alias("was"))
        to_write = plan.filter("action <> 'delete'").select("doc_id").distinct().join(was, "doc_id", "left").checkpoint()
        earlier = F.coalesce(F.struct("updated_at", "seq") <= F.col("was"), F.lit(False))
        stamp = F.when(earlier, F.struct("was.updated_at", (F.col("was.seq") + 1).alias("seq"))).otherwise(F.struct("updated_at", "seq"))
        changed = _texts_to_write(texts, to_write).withColumn("stamp", stamp).select("doc_id", "content", "content_hash", "stamp.*")
        gone = indexed.join(plan.filter("action = 'delete'").select("doc_id"), "doc_id").select(
            "doc_id", F.lit(None).cast("string").alias("content_hash"), "updated_at", (F.col("seq") + 1).alias("seq"),
            F.lit(sync_no).cast("bigint").alias("sync_no"),
        )
        write_segment(changed, path, segment, sync_no, gone.checkpoint())
    drop_scratch(spark, held)
    return plan


def _dealt_texts(docs: DataFrame, path: str) -> DataFrame:
    """Texts with their hash and length, written to `path` in parts by document.

    The given table is read once, by however few tasks, and what a sync does with its texts starts from the parts.
    """
    dealt = docs.repartition("doc_id").withColumn("content_hash", content_hash(F.col("content"))).withColumn("characters", F.length("content").cast("bigint"))
    dealt.write.parquet(path)
    return docs.sparkSession.read.schema(dealt.schema).parquet(path)


def _texts_to_write(texts: DataFrame, to_write: DataFrame) -> DataFrame:
    """The texts of some documents (doc_id, was), dealt by document into the parts of an index; few documents go to where the texts lie."""
    few = broadcast_if_few(to_write)
    parts = _parts_for(texts, texts.select("doc_id", "characters").join(few.select("doc_id"), "doc_id", "left_semi").agg(F.sum("characters")).first()[0])
    if few is not to_write:
        return texts.join(few, "doc_id").repartition(parts, "doc_id")
    return texts.repartition(parts, "doc_id").join(to_write.repartition(parts, "doc_id"), "doc_id")
