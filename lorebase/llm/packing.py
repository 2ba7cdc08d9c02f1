"""Best-fit packing of token pieces into sequences, by hierarchical residual packing."""

from __future__ import annotations

import gc
import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lorebase.llm.common import small_batches, stored

# Items that one best-fit run takes, and bytes of ids it may hold back.
BLOCK_ITEMS = 1 << 16
BLOCK_BYTES = 1 << 26
# Words whose ids a worker keeps.
CACHE_WORDS = 1_200_000
# Texts that are sent to a worker at a time.
TEXTS = 2048
# A sequence with no more than this share of its room left is done.
SLACK = 0.005

GROUP = 1 << 21
BLANK = re.compile(rb"[\x20\x09-\x0d]")
STOPS = (b".", b",")
SIMPLE = "\u0130"


class WordIds:
    """Ids of texts under a tokenizer that never joins what white space separates; remembers words.

    Texts are cut at blanks and code points 9 to 13, so this holds for tokenizers that drop white space, such
    as word_bpe_49k. Where the tokenizer lower-cases anyway, words are lower-cased first to be found again, but only
    those of characters below U+0130: they have no separate accents, which may compose differently in either case.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        same = self.tokenizer.encode("A", add_special_tokens=False).ids
        self.lowers = same == self.tokenizer.encode("a", add_special_tokens=False).ids

    def _learn(self, words: set[bytes]) -> None:
        """Find the ids of new words; those that differ by case or a last stop only are found once."""
        known = self.known
        plain: dict[bytes, tuple[bytes, bytes]] = {}
        for word in words:
            stem, stop = (word[:-1], word[-1:]) if word.endswith(STOPS) else (word, b"")
            text = stem.decode()
            if stop and not text.lower().isalpha():
                text, stop = word.decode(), b""
            if self.lowers and max(text, default="") < SIMPLE:
                text = text.lower()
            plain[word] = (text.encode(), stop)
        new = list({stem for stem, _ in plain.values() if stem not in known}.union(STOPS))
        found = self.tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)
        for word, ids in zip(new, found):
            known[word] = array("I", ids.ids).tobytes()
        for word, (stem, stop) in plain.items():
            known[word] = known[stem] + known[stop] if stop else known[stem]

    def _of_group(self, texts: list[bytes]) -> Iterator[bytes]:
        known = self.known
        collects = gc.isenabled()
        gc.disable()  # what is made here is in no cycles, and there is much of it to look through
        try:
            lists = [(t.lower() if self.lowers and t.isascii() else t).split() for t in texts]
            new = set().union(*[set(words).difference(known) for words in lists])
            if len(known) + len(new) > CACHE_WORDS:
                known.clear()
                new = set().union(*lists)
            self._learn(new)
        finally:
            if collects:
                gc.enable()
        for words in lists:
            yield b"".join(map(known.__getitem__, words))

    def encode(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """Ids of each text as little-endian 32-bit numbers; texts go in groups of about 2 MB, longer ones in pieces."""
        group: list[bytes] = []
        size = 0
        for text in texts:
            if size and size + len(text) > GROUP:
                yield from self._of_group(group)
                group, size = [], 0
            if len(text) <= GROUP:
                group.append(text)
                size += len(text)
                continue
            at, parts = 0, []
            while at < len(text):
                cut = BLANK.search(text, at + GROUP)
                end = cut.start() if cut else len(text)
                parts += self._of_group([text[at:end]])
                at = end
            yield b"".join(parts)
        yield from self._of_group(group)


_TOKENIZERS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The tokenizer of this worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordIds(path)
    return _TOKENIZERS[path]


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each size, and what each bin holds; largest first, each into the fullest bin it fits.

    Bins are found by what they have left: bit r of `rooms` says that one with r left exists.
    """
    bins, offsets, fills = [0] * len(sizes), [0] * len(sizes), []
    free: dict[int, list[int]] = {}
    rooms = 0
    for i in sorted(range(len(sizes)), key=sizes.__getitem__, reverse=True):
        size = sizes[i]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = free[room].pop()
            if not free[room]:
                rooms ^= 1 << room
        else:
            room, at = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = at, capacity - room
        fills[at] += size
        room -= size
        if room:
            free.setdefault(room, []).append(at)
            rooms |= 1 << room
    return bins, offsets, fills


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False
) -> DataFrame:
    """Cut `docs` (doc_id, text) into pieces of tokens and pack these into sequences of at most `capacity` tokens.

    `tokenizer` is the path of a tokenizers file, which all executors can read. A document is its ids, then
    `end_id`; only longer ones are cut, into pieces of `capacity`, the last of which may be shorter.
    Returns per piece: doc_id, piece (from 0), start (ids of the document before it), length, ids_crc32 (of
    little-endian 32-bit ids), sequence_id, offset (gapless from 0), and with `with_ids` also ids, an array.

    Method: each task packs its pieces best-fit, blocks of 65,536 at a time. Sequences within half a percent of
    full are done. The others go on as single items: they meet those of other tasks in blocks of 65,536 and are
    packed again, round by round, until one block is enough or a round saves less than one in a hundred. A
    round holds one row per sequence that is not yet full, and no task takes more than a block at a time.

    Null and empty texts give one piece, the end id. Null doc_id stays null. Repeated rows are packed each. No rows:
    no rows. Long texts are read in pieces of 2 MB. Other columns are ignored.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    end = end_id.to_bytes(4, "little")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset", "fill"] + ["ids"] * with_ids

    def cut_and_pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer)
        next_bin = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        held = 0

        def packed() -> pa.RecordBatch:
            nonlocal next_bin, held
            bins, offsets, fills = best_fit([r[3] for r in rows], capacity)
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            columns += [
                pa.array([next_bin + b for b in bins], pa.int64()),
                pa.array(offsets, pa.int64()),
                pa.array([fills[b] for b in bins], pa.int64()),
            ]
            if with_ids:
                columns.append(pa.array([memoryview(r[5]).cast("I").tolist() for r in rows], pa.list_(pa.int32())))
            next_bin += len(fills)
            held = 0
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        types: list[pa.DataType] = []
        for batch in batches:
            types = [batch.column("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            texts = (text.as_py().encode() if text.is_valid else b"" for text in batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts)):
                ids += end
                for number, start in enumerate(range(0, len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + capacity)]
                    kept = part if with_ids else None
                    rows.append((doc_id, number, start, len(part) // 4, zlib.crc32(part), kept))
                    held += len(part) * with_ids
                    if len(rows) >= BLOCK_ITEMS or held >= BLOCK_BYTES:
                        yield packed()
        if rows:
            yield packed()

    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, bin long, offset long, fill long"
    cut = docs.select("doc_id", "text").mapInArrow(cut_and_pack, schema + ", ids array<int>" * with_ids)
    with small_batches(docs.sparkSession, TEXTS):
        pieces = stored(cut, "pieces")
    moved = _merge(pieces.filter("offset = 0").select(F.col("bin").alias("item"), "fill"), capacity)
    placed = pieces.join(moved.withColumnRenamed("item", "bin"), "bin", "left")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("goes_to", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0).cast("long"))).alias("offset"),
        *(["ids"] * with_ids),
    )


def _merge(sequences: DataFrame, capacity: int) -> DataFrame:
    """(item, goes_to, shift) for sequences (item, fill) that are packed again; they keep the name of their first item."""

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: list[int] = []
        fills: list[int] = []

        def packed() -> pa.RecordBatch:
            bins, offsets, sums = best_fit(fills, capacity)
            first = {b: item for b, item, offset in zip(bins, items, offsets) if offset == 0}
            columns = [items, [first[b] for b in bins], offsets, [sums[b] for b in bins]]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["item", "bin", "offset", "fill"]
            )
            items.clear(), fills.clear()
            return batch

        for batch in batches:
            items += batch.column("item").to_pylist()
            fills += batch.column("fill").to_pylist()
            if len(items) >= BLOCK_ITEMS:
                yield packed()
        if items:
            yield packed()

    not_full = F.col("fill") < int(capacity * (1 - SLACK))
    left = stored(sequences.filter(not_full), "sequences")
    where = left.select("item", F.col("item").alias("goes_to"), F.lit(0).cast("long").alias("shift"))
    count = left.count()
    while count > 1:
        blocks = -(-count // BLOCK_ITEMS)
        dealt = left.repartition(blocks, F.xxhash64("item", F.lit(count)))
        packed = stored(dealt.mapInArrow(again, "item long, bin long, offset long, fill long"), "sequences")
        step = packed.select(F.col("item").alias("goes_to"), "bin", "offset")
        where = where.join(step, "goes_to", "left").select(
            "item",
            F.coalesce("bin", "goes_to").alias("goes_to"),
            (F.col("shift") + F.coalesce("offset", F.lit(0).cast("long"))).alias("shift"),
        )
        where = stored(where, "places")
        left = packed.filter("offset = 0").filter(not_full).select(F.col("bin").alias("item"), "fill")
        last, count = count, left.count()
        if blocks == 1 or count > 0.99 * last:
            break
    return where


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids) from pieces packed with their ids: what a training job reads."""
    part = F.struct("offset", "doc_id", "ids")
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
