"""Language-model scoring by deleted interpolation of word unigrams and bigrams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from lorebase.llm.common import crc_of_id, drop_stored, stored, tasks_for

# Tokens in a block, and keys that one task counts, about.
BLOCK_TOKENS = 1 << 21
TASK_KEYS = 1 << 21
# Words whose hash a worker keeps.
CACHE_WORDS = 400_000
# Probabilities are told apart to a quarter of a power of two when weights are learned; the last bin is zero.
STEPS, BINS = 4, 162
ROUNDS = 60

PIECE = 1 << 22
BLANK = re.compile(rb"[\x20\x09-\x0d]")
# Hash of the token that ends a document and is the context of its first word; no word has a blank in it.
END = np.uint64(xxhash.xxh64_intdigest(b" end "))


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers by byte planes, compressed."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), numbers.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


BLOCK = "block long, doc_ids array<long>, rows array<long>, sizes array<int>, trained array<boolean>, leads binary, words binary, tokens binary, n_words long"


def _blocks(docs: DataFrame) -> DataFrame:
    """Texts as numbers: per block of about two million tokens the sorted hashes of its words, and each token's place there."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        hashes = _Hashes()
        doc_ids, rows, sizes, trained, leads, tokens = [], [], [], [], [], []
        held = made = row = 0

        def block() -> pa.RecordBatch:
            nonlocal held, made
            words, places = np.unique(np.concatenate([*tokens, np.array(leads, np.uint64)]), return_inverse=True)
            places = places.astype(np.uint32)
            made += 1
            values = [part + made, doc_ids, rows, sizes, trained, _pack(places[held:]), _pack_sorted(words), _pack(places[:held]), len(words)]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_()), *[pa.binary()] * 3, pa.int64()]
            batch = pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=[f.split()[0] for f in BLOCK.split(", ")])
            held = 0
            for column in (doc_ids, rows, sizes, trained, leads, tokens):
                column.clear()
            return batch

        for batch in batches:
            learns = batch.column("learns").to_pylist()
            for doc_id, text, learn in zip(batch.column("doc_id").to_pylist(), batch.column("text"), learns):
                text = text.as_py()
                data = text.encode().lower() if text else b""
                row, at, lead, ended = row + 1, 0, END, False
                while not ended:
                    cut = BLANK.search(data, at + PIECE)
                    end = cut.start() if cut else len(data)
                    words = data[at:end].split()
                    ended, at = end >= len(data), end
                    found = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                    if ended:
                        found = np.append(found, END)
                    if len(found):
                        doc_ids.append(doc_id), rows.append(part + row), sizes.append(len(found)), trained.append(learn)
                        leads.append(lead), tokens.append(found)
                        lead = found[-1]
                        held += len(found)
                    if held >= BLOCK_TOKENS:
                        yield block()
        if held:
            yield block()

    return docs.mapInArrow(encode, BLOCK)


def _open(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, their contexts, where each document begins, and whether each token is learned from."""
    tokens = _unpack(row["tokens"], np.uint32).astype(np.int64)
    sizes = np.array(row["sizes"], np.int64)
    starts = np.cumsum(sizes) - sizes
    contexts = np.empty_like(tokens)
    contexts[1:] = tokens[:-1]
    contexts[starts] = _unpack(row["leads"], np.uint32)
    return tokens, contexts, starts, np.repeat(np.array(row["trained"], bool), sizes)


def _pair_keys(words: np.ndarray, contexts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each pair of context and token."""
    mixed = words * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    keys = mixed[contexts] + words[tokens]
    keys ^= keys >> np.uint64(32)
    keys *= np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(29))


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _count(blocks: DataFrame, buckets: int, pairs: bool) -> DataFrame:
    """(block, bucket, answers, distinct, total): training counts of the words, or pairs, of each block, in the order of their keys.

    Each block sends its distinct keys with its own counts to the task that owns their range, where the counts of all
    blocks are added up and answered, key by key. A key comes once per block at most, however frequent it is.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens, contexts, _, learn = _open(row)
                keys = _unpack_sorted(row["words"])
                if pairs:
                    keys, tokens = np.unique(_pair_keys(keys, contexts, tokens), return_inverse=True)
                counts = np.bincount(tokens[learn], minlength=len(keys)).astype(np.uint32)
                owner = _bucket_of(keys, buckets)
                edges = np.flatnonzero(np.diff(owner, prepend=-1))
                ends = [*edges[1:].tolist(), len(keys)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]] * len(edges), pa.int64()),
                        pa.array(owner[edges].astype(np.int32)),
                        pa.array([_pack_sorted(keys[a:b]) for a, b in zip(edges, ends)], pa.binary()),
                        pa.array([_pack(counts[a:b]) for a, b in zip(edges, ends)], pa.binary()),
                    ],
                    names=["block", "bucket", "keys", "counts"],
                )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        if not rows:
            return
        keys = [_unpack_sorted(r["keys"]) for r in rows]
        counts = np.concatenate([_unpack(r["counts"], np.uint32) for r in rows])
        found, places = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(places, counts, len(found)).astype(np.uint32)
        answers, at = sums[places], 0
        for n, (row, mine) in enumerate(zip(rows, keys)):
            values = [row["block"], row["bucket"], _pack(answers[at : at + len(mine)])]
            values += [int((sums > 0).sum()), int(sums.sum(dtype=np.int64))] if n == 0 else [0, 0]
            types = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
            at += len(mine)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=["block", "bucket", "answers", "distinct", "total"])

    asked = blocks.mapInArrow(ask, "block long, bucket int, keys binary, counts binary")
    dealt = asked.repartitionById(buckets, F.col("bucket"))
    return dealt.mapInArrow(answer, "block long, bucket int, answers binary, distinct long, total long")


def _bins(part: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        bits = np.rint(-STEPS * np.log2(part / whole))
    return np.where(part > 0, np.clip(np.nan_to_num(bits, posinf=0), 0, BINS - 2), BINS - 1).astype(np.int64)


def _frequency(counts: np.ndarray) -> np.ndarray:
    """The bucket of a context that occurs so often: 0 for at most once, then one per power of two."""
    return np.log2(np.maximum(counts, 1)).astype(np.int64)


def learn_weights(codes: np.ndarray, n: np.ndarray, total: int, kinds: int) -> np.ndarray:
    """Weights of bigram, unigram and uniform estimate per frequency bucket, by expectation-maximisation.

    `codes` number (bucket, bin of the bigram estimate, bin of the unigram estimate), `n` says how many training tokens
    have them when they are left out of the counts themselves. Buckets without tokens get the weights of all.
    """
    buckets = 64
    bucket, rest = codes // BINS**2, codes % BINS**2
    value = np.append(2.0 ** (-np.arange(BINS - 1) / STEPS), 0)
    chances = np.stack([value[rest // BINS], value[rest % BINS], np.full(len(codes), 1 / (kinds + 1))], axis=1)

    def fit(group: np.ndarray, size: int) -> np.ndarray:
        weights = np.full((size, 3), 1 / 3)
        for _ in range(ROUNDS):
            share = weights[group] * chances
            share *= (n / share.sum(axis=1))[:, None]
            sums = np.stack([np.bincount(group, share[:, i], size) for i in range(3)], axis=1) + [0.01, 0.01, 0.02]
            weights = sums / sums.sum(axis=1, keepdims=True)
        return weights

    if not len(codes):
        return np.tile([0.0, 0.0, 1.0], (buckets, 1))
    together = fit(np.zeros(len(codes), np.int64), 1)[0]
    weights = fit(bucket, buckets)
    weights[np.bincount(bucket, n, buckets) == 0] = together
    return weights


def score_documents(docs: DataFrame, learns: Column) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for each row of `docs` (doc_id, text).

    `learns` is the condition of the documents to learn from; a null condition or doc_id says no. A-Z are lower-cased; tokens
    are the words (runs without blanks and code points 9 to 13), then one end. With c the training count of a token, N of all
    and V of distinct ones, base_score is the sum of log10((c + 0.5) / (N + 0.5 (V + 1))). `score` is the log10
    probability of the text under w2 c(u, w) / c(u) + w1 c(w) / N + w0 / (V + 1), u being the token before w, the end
    before the first. The weights depend on how often u occurs, in powers of two, and are learned by
    expectation-maximisation from all training tokens, each held out from the counts in turn (minus itself).

    Method: texts are turned into blocks of about two million tokens, each a list of distinct word hashes and
    places in it. Counting is an exchange: a block asks for its distinct words, then for its distinct pairs, with its own
    counts; the owner of a key range adds up and answers. So a frequent word costs one key per block, what moves
    grows with the corpus, and no model is ever in one place: tasks hold a block or about two million keys. The driver
    gets two sums, and a table of weights' statistics whose size is bounded by bins. Words and pairs are told apart by 64-bit hashes.

    Null and empty texts have the end token only. Repeated rows are learned and scored each. Without
    training tokens scores are 0. No rows: no rows. Texts longer than a block are scored in parts that are added up.
    """
    spark = docs.sparkSession
    given = docs.select("doc_id", "text", F.coalesce(learns & F.col("doc_id").isNotNull(), F.lit(False)).alias("learns"))
    blocks = stored(_blocks(given), "blocks")
    n_words, n_tokens = blocks.agg(
        F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum(F.aggregate("sizes", F.lit(0), lambda a, b: a + b)), F.lit(0))
    ).first()
    words = stored(_count(blocks, max(1, n_words // TASK_KEYS), False), "word-counts")
    kinds, total = words.agg(F.coalesce(F.sum("distinct"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    pairs = _count(blocks, max(1, n_tokens // TASK_KEYS), True)

    fields = [f.split()[0] for f in BLOCK.split(", ")]
    parts = blocks.select("block", F.lit(0).alias("kind"), F.lit(0).alias("bucket"), F.lit(None).cast("binary").alias("answers"), *fields[1:])
    for kind, answers in ((1, words), (2, pairs)):
        told = answers.select("block", F.lit(kind).alias("kind"), "bucket", "answers")
        parts = parts.unionByName(told, allowMissingColumns=True)
    dealt = parts.repartition(max(tasks_for(spark), n_tokens // BLOCK_TOKENS), "block").sortWithinPartitions("block", "kind", "bucket")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: dict | None = None
        told: dict[int, list[np.ndarray]] = {1: [], 2: []}

        def done() -> pa.RecordBatch:
            tokens, contexts, _, learn = _open(block)
            of_word = np.concatenate(told[1])
            _, places = np.unique(_pair_keys(_unpack_sorted(block["words"]), contexts, tokens), return_inverse=True)
            of_pair = np.concatenate(told[2])[places]
            after, here = (of_word[at][learn].astype(np.int64) - 1 for at in (contexts, tokens))
            both = of_pair[learn].astype(np.int64) - 1
            codes = (_frequency(after + 1) * BINS + _bins(both, after)) * BINS + _bins(here, max(1, total - 1))
            codes, n = np.unique(codes, return_counts=True)
            columns = {
                "doc_ids": pa.array([block["doc_ids"]], pa.list_(pa.int64())),
                "rows": pa.array([block["rows"]], pa.list_(pa.int64())),
                "sizes": pa.array([block["sizes"]], pa.list_(pa.int32())),
                "of_token": pa.array([_pack(of_word[tokens])], pa.binary()),
                "of_context": pa.array([_pack(of_word[_unpack(block["leads"], np.uint32)])], pa.binary()),
                "of_pair": pa.array([_pack(of_pair)], pa.binary()),
                "codes": pa.array([codes.tolist()], pa.list_(pa.int64())),
                "n": pa.array([n.tolist()], pa.list_(pa.int64())),
            }
            told[1].clear(), told[2].clear()
            return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    if block is not None:
                        yield done()
                    block = row
                else:
                    told[row["kind"]].append(_unpack(row["answers"], np.uint32))
        if block is not None:
            yield done()

    counted = "doc_ids array<long>, rows array<long>, sizes array<int>, of_token binary, of_context binary, of_pair binary, codes array<long>, n array<long>"
    ready = stored(dealt.mapInArrow(assemble, counted), "counted")
    drop_stored(blocks), drop_stored(words)
    codes = ready.select(F.explode(F.arrays_zip("codes", "n")).alias("c")).groupBy("c.codes").agg(F.sum("c.n").alias("n")).collect()
    weights = learn_weights(np.array([r[0] for r in codes], np.int64), np.array([r[1] for r in codes], np.float64), total, kinds)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["sizes"], np.int64)
                starts = np.cumsum(sizes) - sizes
                here = _unpack(row["of_token"], np.uint32).astype(np.float64)
                after = np.empty_like(here)
                after[1:] = here[:-1]
                after[starts] = _unpack(row["of_context"], np.uint32)
                both = _unpack(row["of_pair"], np.uint32)
                weight = weights[_frequency(after)]
                chance = weight[:, 0] * both / np.maximum(after, 1) + weight[:, 1] * here / max(1, total) + weight[:, 2] / (kinds + 1)
                base = np.log10((here + 0.5) / (total + 0.5 * (kinds + 1)))
                sums = [np.add.reduceat(x, starts) for x in ((here > 0).astype(np.int64), base, np.log10(chance))]
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(row["rows"], pa.int64()), pa.array(sizes), *map(pa.array, sums)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "n_tokens", "n_known", "base_score", "score"])

    scored = ready.select("doc_ids", "rows", "sizes", "of_token", "of_context", "of_pair").mapInArrow(
        score, "doc_id long, row long, n_tokens long, n_known long, base_score double, score double"
    )
    whole = scored.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    )
    return whole.select("doc_id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 1 modulo 5. A null id is not."""
    return F.coalesce(crc_of_id(doc_id) % 5 == 1, F.lit(False))
