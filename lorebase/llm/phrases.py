"""Phrase collocations by relational mining: occurrences of frequent groups joined with their neighbours, level by level."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lorebase.llm.common import BROADCAST_BYTES, drop_stored, small_batches, stored

NO_LANG = "und"
SEED = 42
# All that ends a piece becomes a line feed, which stays in place as a token: words on both sides are not adjacent.
TOKENS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")
END = b"\n"
# Distinct words that a task counts before it hands them on, of all languages together, and groups likewise.
COUNTED, GROUPED = 1 << 18, 1 << 21
# Keys of words that a task keeps at hand, of all languages together.
KNOWN = 1 << 18
# Texts that a task works on at a time.
TEXTS = 1024

# Rows, and what makes a relation of their batches. It runs in one pass with what is done to the relation next.
Step = tuple[DataFrame, Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None]
RELATION = "row long, at array<int>, key array<long>"


def _tokens(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased, and a line feed for each end of a piece."""
    flat = (text or "").encode().lower().translate(TOKENS).replace(END, b" \n ")
    return [w for w in flat.split(b" ") if w]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS):
            yield batch.slice(at, TEXTS)


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all texts of `docs` (lang, text). Tasks count before they shuffle."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, words in counts.items():
                words.pop(END, None)
                names = pa.array([w.decode() for w in words], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), names, pa.array(list(words.values()), pa.int64())], names=["lang", "word", "n"])
            counts.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                counts.setdefault(lang.as_py(), Counter()).update(_tokens(text.as_py()))
                if sum(map(len, counts.values())) > COUNTED:
                    yield from out()
        yield from out()

    rows = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text")
    return rows.mapInArrow(per_batch, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _word_key(lang: Column, word: Column) -> Column:
    return F.xxhash64(F.concat(lang, F.lit("\0"), word))


def occurrences(docs: DataFrame) -> Step:
    """(row, at, key) of `docs` (lang, text): per text its words as keys, sorted by their place `at`.

    This is the relation of pieces, places and words, with one row for all that a text holds. Ends of pieces take a place
    of their own, so two words lie in one piece side by side exactly if their places differ by one.
    """

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[bytes, int]] = {}
        for batch in _slices(batches):
            places, keys, ends = [], [], [0]
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                lang = lang.as_py()
                of = known.setdefault(lang, {END: 0})
                head, words = lang.encode() + b"\0", _tokens(text.as_py())
                for w in set(words).difference(of):
                    of[w] = xxhash.xxh64_intdigest(head + w, SEED)
                found = np.fromiter(map(of.__getitem__, words), np.uint64, len(words))
                inside = np.flatnonzero(np.fromiter((w != END for w in words), bool, len(words)))
                places.append(inside.astype(np.int32)), keys.append(found[inside])
                ends.append(ends[-1] + len(inside))
                if sum(map(len, known.values())) > KNOWN:
                    known.clear()
            yield _relation(batch.column("row"), places, keys, ends)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text")
    return rows, per_batch


def _relation(rows: pa.Array, places: list[np.ndarray], keys: list[np.ndarray], ends: list[int]) -> pa.RecordBatch:
    together = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.zeros(0), kind)
    offsets = pa.array(ends, pa.int32())
    at = pa.ListArray.from_arrays(offsets, together(places, pa.int32()))
    key = pa.ListArray.from_arrays(offsets, pa.array((np.concatenate(keys) if keys else np.zeros(0, np.uint64)).view(np.int64), pa.int64()))
    return pa.RecordBatch.from_arrays([rows, at, key], names=["row", "at", "key"])


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row number in the batch, place, key) of all occurrences of a batch."""
    at, key = batch.column("at"), batch.column("key")
    lengths = np.diff(at.offsets.to_numpy())
    return np.repeat(np.arange(len(lengths)), lengths), at.flatten().to_numpy(), key.flatten().to_numpy().view(np.uint64)


def _joined(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The relation merged with itself at adjacent places: (row, place, key, prefix, suffix) of groups one word longer."""
    row, at, key = _columns(batch)
    first = np.flatnonzero((at[1:] == at[:-1] + 1) & (row[1:] == row[:-1]))
    prefix, suffix = key[first], key[first + 1]
    x = (prefix * np.uint64(0x9E3779B97F4A7C15)) ^ (suffix + np.uint64(0xD1B54A32D192ED03) + (prefix << np.uint64(7)))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return row[first], at[first], x ^ (x >> np.uint64(31)), prefix, suffix


def _source(row: pa.Array) -> np.ndarray:
    """The part of the input that rows come from, by the number `occurrences` gave them."""
    return (row.to_numpy() >> 33).astype(np.int32)


def _by_source(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of batches by the part of the input they come from."""
    for batch in _slices(batches):
        source = _source(batch.column("row"))
        cuts = [0, *(np.flatnonzero(np.diff(source)) + 1).tolist(), len(source)]
        for at, end in zip(cuts, cuts[1:]):
            if end > at:
                yield int(source[at]), batch.slice(at, end - at)


def _frequent_groups(relation: DataFrame, least: int, sourced: bool = False) -> DataFrame:
    """(key, a) of the groups one word longer that occur at least `least` times; `sourced` adds `source`, the first part of the input that holds one.

    Tasks count before they shuffle.
    """

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[np.ndarray]] = {}
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            for source, found in waiting.items():
                keys, n = np.unique(np.concatenate(found), return_counts=True)
                columns = [pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(np.full(len(keys), source, np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "source"])
            waiting.clear()

        for source, batch in _by_source(batches):
            key = _joined(batch)[2]
            waiting.setdefault(source, []).append(key)
            held += len(key)
            if held > GROUPED:
                yield from out()
                held = 0
        yield from out()

    counted = relation.mapInArrow(per_batch, "key long, n long, source int").groupBy("key")
    counted = counted.agg(F.sum("n").alias("a"), *[F.min("source").alias("source")] * sourced)
    return counted.filter(F.col("a") >= least)


def _copied(frequent: DataFrame):
    """The keys of frequent groups, sorted and copied to all tasks."""
    return frequent.sparkSession.sparkContext.broadcast(np.sort(frequent.select("key").toPandas()["key"].to_numpy(np.int64).view(np.uint64)))


def _parts_of_groups(relation: DataFrame, frequent: DataFrame, limit: int) -> DataFrame:
    """(key, prefix, suffix) of the `frequent` groups (key, perhaps source) one word longer.

    Their keys are copied to all tasks while they are within `limit` bytes (12 each), and a group is told once from its `source`, the
    part of the input it is known to be in; without that, once by each task that holds it. Beyond, tasks drop
    repeated ones before they hand them on, and a join follows.
    """

    def rows(key: np.ndarray, prefix: np.ndarray, suffix: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in (key, prefix, suffix)], names=["key", "prefix", "suffix"])

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, ...]] = []

        def out() -> pa.RecordBatch:
            key, prefix, suffix = (np.concatenate([w[n] for w in waiting] or [np.zeros(0, np.uint64)]) for n in range(3))
            waiting.clear()
            key, first = np.unique(key, return_index=True)
            return rows(key, prefix[first], suffix[first])

        for batch in _slices(batches):
            _, _, key, prefix, suffix = _joined(batch)
            key, first = np.unique(key, return_index=True)
            waiting.append((key, prefix[first], suffix[first]))
            if sum(len(w[0]) for w in waiting) > GROUPED // 4:
                yield out()
        yield out()

    schema = "key long, prefix long, suffix long"
    if frequent.count() * 12 > limit:
        return relation.mapInArrow(per_batch, schema).join(frequent.select("key"), "key", "left_semi")
    sourced = "source" in frequent.columns
    groups = frequent.select("key", *["source"] * sourced).toPandas()
    known = groups["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(known)
    copied = frequent.sparkSession.sparkContext.broadcast((known[order], groups["source"].to_numpy(np.int32)[order] if sourced else None))

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sources = copied.value
        wanted: dict[int | None, tuple[np.ndarray, np.ndarray]] = {}  # per part of the input the keys to tell from it, and which are still to be told
        for source, batch in _by_source(batches):
            source = source if sourced else None
            if source not in wanted:
                of = known[sources == source] if sourced else known
                wanted[source] = of, np.ones(len(of), bool)
            of, untold = wanted[source]
            if not untold.any():
                continue
            _, _, key, prefix, suffix = _joined(batch)
            place = np.minimum(np.searchsorted(of, key), len(of) - 1)
            new = np.flatnonzero((of[place] == key) & untold[place])
            place, first = np.unique(place[new], return_index=True)
            untold[place] = False
            first = new[first]
            yield rows(key[first], prefix[first], suffix[first])

    return relation.mapInArrow(once, schema)


def _longer(relation: DataFrame) -> Step:
    """The occurrences of all groups one word longer."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            row, at, key, _, _ = _joined(batch)
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).tolist()
            yield _relation(batch.column("row"), [at], [key], ends)

    return relation, per_batch


def _semi_join(step: Step, frequent: DataFrame, limit: int) -> DataFrame:
    """Occurrences whose group is `frequent` (key). Its keys are copied to all tasks while they are within `limit` bytes (8 each); else a join follows."""
    rows, relation = step
    if frequent.count() * 8 > limit:
        held = rows.mapInArrow(relation, RELATION) if relation else rows
        held = held.select("row", F.explode(F.arrays_zip("at", "key")).alias("o")).select("row", "o.at", "o.key")
        held = held.join(frequent.select("key"), "key", "left_semi").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "key"))).alias("o"))
        return held.select("row", F.col("o.at").alias("at"), F.col("o.key").alias("key"))  # a text's share of one row
    keys = _copied(frequent)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = keys.value
        for batch in relation(batches):
            row, at, key = _columns(batch)
            place = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
            kept = known[place] == key if len(known) else np.zeros(len(key), bool)
            ends = np.searchsorted(row[kept], np.arange(batch.num_rows + 1)).tolist()
            yield _relation(batch.column("row"), [at[kept]], [key[kept]], ends)

    return rows.mapInArrow(per_batch, RELATION).filter(F.size("key") > 0)


def frequent_phrases(docs: DataFrame, least: int, longest: int, limit: int = BROADCAST_BYTES) -> tuple[list[DataFrame], DataFrame]:
    """The frequent groups of each length from 1 to `longest`, and (lang, n), the number of all words.

    A group is (key, lang, phrase, last, a, heads, tails): its words and the last of them, how often it occurs, and how often its first
    and last 1, 2, ... words do, up to itself. Occurrences of frequent groups are persisted sorted by place; each
    level is this relation merged with itself at adjacent places, counted by group, and semi-joined with the frequent groups.
    """
    words = stored(word_counts(docs), "word-counts")
    totals = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "words-of-languages")
    a = F.col("n")
    level = words.filter(a >= least).select(
        _word_key(F.col("lang"), F.col("word")).alias("key"), "lang", F.col("word").alias("phrase"), F.col("word").alias("last"),
        a.alias("a"), F.array(a).alias("heads"), F.array(a).alias("tails"),
    )
    levels = [stored(level, "frequent-1")]
    step = occurrences(docs)
    if levels[0].count() * 8 > limit:
        step = stored(step[0].mapInArrow(step[1], RELATION), "occurrences"), None  # its row numbers must not change between two readings
    relation = stored(_semi_join(step, levels[0], limit), "occurrences-1")
    for size in range(2, longest + 1):
        frequent = stored(_frequent_groups(relation, least, sourced=True), f"groups-{size}")
        parts = _parts_of_groups(relation, frequent, limit).groupBy("key").agg(F.min("prefix").alias("prefix"), F.min("suffix").alias("suffix"))
        heads = levels[-1].select(F.col("key").alias("prefix"), "lang", F.col("phrase").alias("head"), "heads")
        tails = levels[-1].select(F.col("key").alias("suffix"), "last", "tails")
        level = frequent.join(parts, "key").join(heads, "prefix").join(tails, "suffix").select(
            "key", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "a",
            F.concat("heads", F.array("a")).alias("heads"), F.concat("tails", F.array("a")).alias("tails"), "prefix", "suffix",
        )
        levels.append(stored(level, f"frequent-{size}"))
        if size < longest:
            last, relation = relation, stored(_semi_join(_longer(relation), frequent, limit), f"occurrences-{size}")
            drop_stored(last)
    drop_stored(relation), drop_stored(words)
    return levels, totals


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language of `docs` (lang, text, ...).

    Texts are cut into pieces at `.,;:!?` and line ends, pieces into words at blanks and tabs, A-Z lower-cased. Phrases are 2 to
    `longest` words in a row within a piece that occur at least `least` times, overlaps included. A cut of
    a phrase in two scores floor(1000 * a * n / (l * r)) with the counts a of the phrase, l and r of the two parts, n of all words of the language;
    the lowest cut counts, of equal ones the first. Phrases inside a longer one of the same count go. Ties in rank go by a, then by phrase.

    Null texts are empty ones; a null lang is `und`. Repeated rows count each. Words and groups are told apart by 64-bit hashes. No rows:
    no rows. Other columns are ignored. Keys of frequent groups beyond `limit` bytes are joined instead of copied to tasks.
    """
    with small_batches(docs.sparkSession, TEXTS):
        levels, totals = frequent_phrases(docs.select("lang", "text"), least, longest, limit)
    columns = ["key", "lang", "phrase", "a", "heads", "tails"]
    found = dropped = None
    for shorter, level in zip(levels, levels[1:]):
        found = level.select(*columns) if found is None else found.union(level.select(*columns))
        inside = level.select(F.col("prefix").alias("key"), "a").union(level.select(F.col("suffix").alias("key"), "a"))
        inside = inside.join(shorter.select("key", "a"), ["key", "a"]).select("key")
        dropped = inside if dropped is None else dropped.union(inside)
    whole = lambda c: c.cast("decimal(38,0)")
    part = lambda c: c.cast("decimal(19,0)")

    def cut(k: Column) -> Column:
        left, right = F.element_at("heads", k), F.element_at("tails", F.size("heads") - k)
        above, below = F.lit(1000).cast("decimal(4,0)") * whole(F.col("a")) * part(F.col("n")), part(left) * part(right)
        return F.struct(F.call_function("div", above, below).alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    scored = found.join(stored(dropped.distinct(), "inside-longer"), "key", "left_anti").join(totals, "lang")
    best = F.array_min(F.transform(F.sequence(F.lit(1), F.size("heads") - 1), cut))
    scored = scored.select("lang", "phrase", "a", best.alias("best"), "n").select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
