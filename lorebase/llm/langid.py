"""Language identification by prediction by partial matching (PPM) over byte contexts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lorebase.llm.common import crc_of_id, stored

# Cells of a language's table of code lengths, at most: symbols ** (order + 1).
MAX_CELLS = 1 << 23
# Bytes scored at a time.
PIECE = 1 << 20
UNKNOWN = "und"
# Hashed ids are told apart to so many parts.
MIX = 1 << 40


@dataclass(frozen=True)
class ByteModel:
    """Frozen statistics: how bytes map to symbols, and per language the counts of symbol runs."""

    languages: tuple[str, ...]
    symbol: np.ndarray  # 256 symbols
    order: int
    runs: tuple[np.ndarray, ...]  # per language, sorted codes of order + 1 symbols
    counts: tuple[np.ndarray, ...]

    @property
    def symbols(self) -> int:
        return int(self.symbol.max()) + 1

    def code_lengths(self) -> np.ndarray:
        """Bits of each symbol after each context of `order` symbols: (context and symbol, language).

        Method C of PPM: after a context seen n times with d different symbols, a symbol seen there c times
        has probability c / (n + d), and d / (n + d) is left for escaping to the context that is shorter by
        its first symbol. Below the empty context all symbols are equally likely. A context never seen escapes for nothing.
        """
        size = self.symbols
        table = np.empty((size ** (self.order + 1), len(self.languages)), np.float32)
        for at, (runs, counts) in enumerate(zip(self.runs, self.counts)):
            bits = np.full((1, size), np.log2(size))
            for length in range(self.order + 1):
                cells = size ** (length + 1)
                seen = np.bincount(runs % cells, counts, cells).reshape(-1, size)
                total = seen.sum(axis=1, keepdims=True)
                kinds = (seen > 0).sum(axis=1, keepdims=True)
                shorter = np.tile(bits, (size, 1)) if length else bits
                with np.errstate(divide="ignore", invalid="ignore"):
                    escape = np.where(total > 0, np.log2((total + kinds) / kinds), 0)
                    direct = np.log2((total + kinds) / seen)
                bits = np.where(seen > 0, direct, escape + shorter)
            table[:, at] = bits.ravel()
        return table


_TABLES: dict[str, np.ndarray] = {}


def _table(token: str, model: ByteModel) -> np.ndarray:
    """The code lengths on this worker, laid out once."""
    if token not in _TABLES:
        _TABLES.clear()
        _TABLES[token] = model.code_lengths()
    return _TABLES[token]


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins and ends; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data, offsets


def _lower() -> np.ndarray:
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A") : ord("Z") + 1] += 32
    return lower


def _codes(symbols: np.ndarray, order: int, size: int) -> np.ndarray:
    """The code of each symbol with the `order` symbols before it; the first ones see the space symbol before them."""
    codes = symbols.astype(np.int32)
    for back in range(1, order + 1):
        before = np.empty_like(codes)
        before[back:] = symbols[:-back] if back < len(symbols) else 0
        before[:back] = 0
        codes += before * size**back
    return codes


def train(docs: DataFrame, max_docs: int = 2000, order: int = 3, symbols: int = 39) -> ByteModel:
    """Learn from `docs` (doc_id, text, lang), per language from about `max_docs` documents, or all if there are fewer.

    The sample holds the documents whose hashed id is in the part of all hashes that `max_docs` is of the language's documents,
    so it does not depend on layout or number of tasks. Rows with a null take no part. Symbols are the `symbols` most frequent bytes of the sample, A-Z lower-cased; space
    bytes are symbol 0 and all other bytes share the last one. `symbols` is lowered where
    the tables would get too large. Driver and tasks hold counts of symbol runs, which `MAX_CELLS` bounds.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    sizes = stored(usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    mix = F.abs(F.xxhash64("doc_id") % F.lit(MIX)) / F.lit(float(MIX))
    sample = usable.join(sizes, "lang").filter(mix * F.col("n") < max_docs).select("lang", "text")
    sample = stored(sample, "sample")
    while symbols > 8 and (symbols + 1) ** (order + 1) > MAX_CELLS:
        symbols -= 1

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.bincount(_lower()[_buffers(batch.column("text"))[0]], minlength=256)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(counts)], names=["byte", "n"])

    totals = sample.mapInArrow(histogram, "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect()
    counts = {r.byte: r.n for r in totals if r.n and r.byte not in b"\t\n\x0b\x0c\r "}
    symbol = np.full(256, min(len(counts), symbols - 1) + 1, np.uint8)
    for at, byte in enumerate(sorted(counts, key=lambda b: (-counts[b], b))[: symbols - 1]):
        symbol[byte] = at + 1
    symbol[list(b"\t\n\x0b\x0c\r ")] = 0
    symbol = symbol[_lower()]
    size = int(symbol.max()) + 1

    def count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _buffers(batch.column("text"))
            for at, lang in enumerate(batch.column("lang").to_pylist()):
                for start in range(offsets[at], offsets[at + 1], PIECE):
                    part = symbol[data[max(offsets[at], start - order) : min(offsets[at + 1], start + PIECE)]]
                    codes = _codes(part, order, size)[min(order, start - offsets[at]) :]
                    runs, n = np.unique(codes, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(runs), pa.string()), pa.array(runs.astype(np.int64)), pa.array(n)],
                        names=["lang", "run", "n"],
                    )

    counted = sample.mapInArrow(count_runs, "lang string, run long, n long")
    rows = counted.groupBy("lang", "run").agg(F.sum("n").alias("n")).toArrow()
    langs = np.array(rows.column("lang").to_pylist(), object)
    names = tuple(sorted(set(langs)))
    runs, n = rows.column("run").to_numpy(), rows.column("n").to_numpy()
    per = []
    for name in names:
        mine = langs == name
        order_of = np.argsort(runs[mine])
        per.append((runs[mine][order_of].astype(np.int32), n[mine][order_of].astype(np.int64)))
    return ByteModel(names, symbol, order, tuple(p[0] for p in per), tuple(p[1] for p in per))


def identify(docs: DataFrame, model: ByteModel, carry: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score, bits_per_byte) for each row of `docs` (doc_id, text, ...).

    With `carry`, `row` stands in place of doc_id, a struct of all columns.

    The language under whose frozen statistics the whole text has the shortest code; ties go to the first
    name in order. `score` is its probability among the languages if all are equally likely before. Null texts,
    texts without a letter, and all texts under a model without languages are `und` with score 0. Null doc_id
    stays null; repeated rows come back each. Texts are scored in pieces of 1 MB, in place, without a shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    token = uuid.uuid4().hex

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names, size = model.languages, model.symbols
        table = _table(token, model) if names else None
        for batch in batches:
            text = batch.column("row").field("text") if carry else batch.column("text")
            data, offsets = _buffers(text)
            rows = batch.num_rows
            bits = np.zeros((rows, max(1, len(names))))
            if names:
                begin = np.repeat(0, rows)
                for start in range(int(offsets[0]), int(offsets[-1]), PIECE):
                    end = min(int(offsets[-1]), start + PIECE)
                    lead = max(int(offsets[0]), start - model.order)
                    codes = _codes(model.symbol[data[lead:end]], model.order, size)[start - lead :]
                    first = np.searchsorted(offsets, start, "right") - 1
                    last = np.searchsorted(offsets, end, "left")
                    for row in range(first, last):  # the first symbols of a text follow a space, not the text before
                        at = int(offsets[row])
                        for i in range(max(at, start), min(at + model.order, int(offsets[row + 1]), end)):
                            keep = size ** (i - at + 1)
                            codes[i - start] %= keep
                    begin = np.maximum(offsets[first:last], start) - start
                    filled = np.minimum(offsets[first + 1 : last + 1], end) - start > begin
                    lengths = np.take(table, codes, axis=0)
                    if filled.any():
                        sums = np.add.reduceat(lengths, begin[filled], axis=0, dtype=np.float64)
                        bits[np.arange(first, last)[filled]] += sums
            sizes = np.diff(offsets)
            best = bits.argmin(axis=1)
            least = bits[np.arange(rows), best]
            odds = np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
            known = np.array(batch.column("has_letter").to_pylist(), bool) & bool(names)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([names[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
                    pa.array(np.where(known, 1 / odds, 0.0)),
                    pa.array(np.where(known, least / np.maximum(sizes, 1), 0.0)),
                ],
                names=[name, "lang_pred", "score", "bits_per_byte"],
            )

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter")
    name = "row" if carry else "doc_id"
    out = (F.struct(*[docs[c] for c in docs.columns]) if carry else docs["doc_id"]).alias(name)
    given = docs.select(out, letters) if carry else docs.select(out, docs["text"].alias("text"), letters)
    kind = given.schema[name].dataType.simpleString()
    return given.mapInArrow(score, f"{name} {kind}, lang_pred string, score double, bits_per_byte double")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 2 modulo 4. A null id is not."""
    return F.coalesce(crc_of_id(doc_id) % 4 == 2, F.lit(False))
