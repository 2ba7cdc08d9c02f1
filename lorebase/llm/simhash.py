"""SimHash near-dedup: fingerprints of word shingles, linked by a range join over popcounts of segments."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lorebase.llm.common import stored
from lorebase.llm.components import components

BITS = 64
# Segments of a fingerprint, and bits that hold the popcount of one in the number of a cell.
SEGMENTS = 16
WIDTH = BITS // SEGMENTS
FIELD = 3
# Cells of up to this many fingerprints are compared pair by pair.
SMALL_CELL = 24

PIECE = 1 << 22
HASHES = 1 << 16
BLANK = re.compile(rb"[\x20\x09-\x0d]")


def _pieces(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        cut = BLANK.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        yield data[at:end]
        at = end


def shingle_hashes(data: bytes, shingle: int, seed: int) -> Iterator[list[int]]:
    """XXH64 values of all shingles of a text, piece by piece."""
    one = xxhash.xxh64_intdigest
    carry: list[bytes] = []
    seen = False
    for piece in _pieces(data):
        words = carry + piece.lower().split()
        if len(words) < shingle:
            carry = words
            continue
        seen = True
        line = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
        yield [one(line[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
        carry = words[len(words) - shingle + 1 :]
    if carry and not seen:
        yield [one(b" ".join(carry), seed)]


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) for each document; `fp` is the 64-bit fingerprint as a signed number.

    A-Z are lower-cased; words are runs without white space (blank, code points 9 to 13); shingles are `shingle`
    words joined by blanks, repeats included, or all words if there are fewer. A bit is 1 if it is set in over half
    of the XXH64 values. Null or empty text and text without words: zero. Long texts are read in pieces of 4 MB.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, BITS), np.uint8)
            waiting: list[int] = []
            rows: list[int] = []
            firsts: list[int] = []
            ones = np.zeros((batch.num_rows, BITS), np.int64)
            totals = np.zeros((batch.num_rows, 1), np.int64)

            def count() -> None:
                if not waiting:
                    return
                bits = np.unpackbits(np.array(waiting, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
                np.add.at(ones, rows, np.add.reduceat(bits, firsts, axis=0, dtype=np.int64))
                waiting.clear(), rows.clear(), firsts.clear()

            for row, text in enumerate(batch.column("text")):
                data = text.as_py()
                for found in shingle_hashes(data.encode() if data else b"", shingle, seed):
                    totals[row] += len(found)
                    rows.append(row), firsts.append(len(waiting))
                    waiting += found
                    if len(waiting) >= HASHES:
                        count()
            count()
            out = (2 * ones > totals).astype(np.uint8)
            fps = np.packbits(out, axis=1).view(">u8").ravel().astype(np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps)], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(per_batch, f"doc_id {id_type}, fp long")


def _popcount(segment: int) -> Column:
    mask = (1 << WIDTH) - 1
    return F.bit_count(F.shiftrightunsigned("fp", segment * WIDTH).bitwiseAND(F.lit(mask)))


def _cells() -> Column:
    """Cells a fingerprint enters: that of its popcounts, and those one step away in one segment."""
    own = F.lit(0).cast("long")
    for s in range(SEGMENTS):
        own = own + F.shiftleft(_popcount(s).cast("long"), s * FIELD)
    steps = []
    for s in range(SEGMENTS):
        step = F.lit(1 << (s * FIELD)).cast("long")
        steps.append(F.when(_popcount(s) < WIDTH, own + step))
        steps.append(F.when(_popcount(s) > 0, own - step))
    return F.array_compact(F.array(own, *steps))


def close_links(fps: DataFrame) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of `fps` (fp, distinct) at 2 or fewer differing bits.

    Each fingerprint is embedded as the popcounts of 16 segments of 4 bits. The Manhattan distance of two
    embeddings is never more than the number of differing bits, so fingerprints that link lie within 2 of each
    other and meet in a grid cell that is at most one step from either. Cells with a single member go; members of small
    cells are paired and the differing bits are counted. A cell of over `SMALL_CELL` members is not paired:
    its members are written under themselves and each number one bit away, and meet there exactly if they differ in
    at most 2 bits. At most 65 fingerprints can meet under one number, which are linked to the smallest, so
    the work is in proportion to the members however many there are.
    """
    entered = fps.select("fp", F.explode(_cells()).alias("cell"))
    counts = entered.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    shared = stored(counts.filter("n > 1"), "cells")
    members = stored(entered.join(shared, "cell"), "cell-members")
    small = members.filter(F.col("n") <= SMALL_CELL).select("cell", "fp")
    other = small.withColumnRenamed("fp", "b")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= 2
    paired = small.join(other, (small.cell == other.cell) & (F.col("fp") > F.col("b")) & near)
    paired = paired.select(F.col("fp").alias("a"), "b")
    crowded = members.filter(F.col("n") > SMALL_CELL).select("fp").distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(BITS)])
    met = crowded.select("fp", F.explode(flips).alias("number")).groupBy("number").agg(F.collect_set("fp").alias("fps"))
    met = met.filter(F.size("fps") > 1).select(F.explode("fps").alias("a"), F.array_min("fps").alias("b"))
    return paired.union(met.filter("a <> b")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of `docs` (doc_id, text, ...).

    Fingerprints link at 2 or fewer differing bits; component_id is the smallest doc_id that can be reached.
    Fingerprints are computed once and stored; equal ones count as one from there on, so copies cost a row each.

    Null, empty and wordless texts have fingerprint zero, which links like any other. A null doc_id is
    never a component_id unless a component has no other. Repeated rows come back each. No rows: no rows. Other
    columns are ignored.
    """
    hashed = stored(fingerprints(docs, shingle), "fingerprints")
    first = stored(hashed.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(close_links(first.select("fp"))).withColumnRenamed("node", "fp")
    rooted = stored(first.join(roots, "fp"), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("first").alias("lowest"))
    linked = rooted.join(lowest, "root").select("fp", "lowest")
    ids = stored(
        first.join(linked, "fp", "left").select("fp", F.coalesce("lowest", "first").alias("component_id")),
        "component-ids",
    )
    return hashed.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
