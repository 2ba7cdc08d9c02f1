"""Quality classifier from weak labels: heuristic labellers, their accuracies by EM, and a hashed linear scorer."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lorebase.llm.common import stored

GOOD, BAD, SILENT = 1, 0, 2
# Under so many words, shares say little.
FEW_WORDS = 30

# Weights of the scorer: hashed words and hashed word shapes share the slots; the last one counts repeated words.
SLOTS = 1 << 15
ROUNDS = 300
CACHE_WORDS = 400_000
PIECE = 1 << 22
BLANK = re.compile(rb"[\x20\x09-\x0d]")
MIX = 1 << 40

# Fixed classes of bytes: 1 other letter, 2 capital letter, 3 digit, 4 ordinary punctuation, 5 blank, 0 symbol or control.
CLASS = np.zeros(256, np.uint8)
CLASS[ord("a") : ord("z") + 1] = 1
CLASS[0x80:] = 1
CLASS[ord("A") : ord("Z") + 1] = 2
CLASS[ord("0") : ord("9") + 1] = 3
CLASS[list(b".,;:!?'\"()-")] = 4
CLASS[list(b"\t\n\x0b\x0c\r ")] = 5
# A word in outline: letters become a or A, digits 9, all else stays; runs count once.
OUTLINE = bytes(b"a"[0] if c == 1 else b"A"[0] if c == 2 else b"9"[0] if c == 3 else i for i, c in enumerate(CLASS))
RUNS = re.compile(rb"([aA9])\1+")


class Profile:
    """Counts of one text that the labellers look at."""

    def __init__(self):
        self.words = self.letters_in_words = self.marks = self.short = self.repeats = self.stops = self.shouts = self.lines = 0
        self.bytes = np.zeros(6, np.int64)
        self.distinct: set[int] = set()
        self.distinct_lines: set[bytes] = set()

    def add(self, data: bytes, words: list[bytes], codes: np.ndarray) -> None:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        bare = codes >> 32 > 0
        marks = int(bare.sum())
        self.words += len(words)
        self.marks += marks
        self.letters_in_words += int(sizes[~bare].sum() if marks else sizes.sum())
        self.short += int((sizes[~bare] <= 3).sum() if marks else (sizes <= 3).sum())
        self.repeats += int((codes[1:] == codes[:-1]).sum())
        self.stops += data.count(b".") + data.count(b"?")
        self.shouts += data.count(b"!")
        self.bytes += np.bincount(CLASS[np.frombuffer(data, np.uint8)], minlength=6)
        self.distinct.update(np.unique(codes).tolist())
        lines = data.split(b"\n")
        self.lines += len(lines)
        self.distinct_lines.update(xxhash.xxh64_digest(line) for line in lines)


def _vote(value: float, good: tuple[float, float], fair: tuple[float, float]) -> int:
    """Good inside the first range, bad outside the second, silent between."""
    if good[0] <= value <= good[1]:
        return GOOD
    return SILENT if fair[0] <= value <= fair[1] else BAD


def votes(p: Profile) -> list[int]:
    """What each labeller says of a text: good, bad or nothing."""
    words, size = max(1, p.words), max(1, int(p.bytes.sum()))
    proper = max(1, p.words - p.marks)
    letters = max(1, int(p.bytes[1] + p.bytes[2]))
    said = [
        _vote(p.bytes[0] / size, (0, 0.004), (0, 0.02)),  # symbols
        _vote(p.marks / words, (0, 0.02), (0, 0.1)),  # words without letters or digits
        _vote(p.bytes[2] / letters, (0, 0.08), (0, 0.25)),  # capitals
        _vote(p.repeats / words, (0, 0.03), (0, 0.2)),  # the same word again
        _vote(p.shouts / words, (0, 0.05), (0, 0.2)),  # exclamation marks
        _vote(1 - len(p.distinct_lines) / max(1, p.lines), (0, 0.1), (0, 0.4)),  # lines again
        _vote(p.words, (10, 1e18), (2, 1e18)),  # length
    ]
    shares = [
        _vote(len(p.distinct) / words, (0.25, 1), (0.1, 1)),  # variety
        _vote(p.letters_in_words / proper, (3.8, 7), (3, 9)),  # length of words
        _vote(p.short / proper, (0.15, 0.6), (0.08, 0.75)),  # short words, which sentences need
        _vote(p.stops / words, (0.02, 0.25), (0.01, 0.4)),  # ends of sentences
    ]
    return said + (shares if p.words >= FEW_WORDS else [SILENT] * len(shares))


LABELLERS = len(votes(Profile()))


def _slot(kind: int, data: bytes) -> int:
    return xxhash.xxh64_intdigest(data, kind) % (SLOTS - 1)


SMALL_SHAPE = _slot(2, b"a")


class _Codes(dict):
    """Whether a word has neither letter nor digit, and the slots of the word and of its shape, as one number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        if word.isalpha() and word.islower():
            bare, shape = False, SMALL_SHAPE
        else:
            outline = RUNS.sub(rb"\1", word.translate(OUTLINE))
            bare, shape = not word.translate(OUTLINE, b" !\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"), _slot(2, outline)
        self[word] = value = bare << 32 | _slot(1, word.lower()) << 16 | shape
        return value


def _pieces(text: pa.Scalar) -> Iterator[bytes]:
    data = text.as_py().encode() if text.is_valid else b""
    at = 0
    while at < len(data):
        cut = BLANK.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        yield data[at:end]
        at = end


def vote_patterns(docs: DataFrame) -> DataFrame:
    """(doc_id, pattern): the votes on each text as digits of a number to base 3."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Codes()
        for batch in batches:
            patterns = []
            for text in batch.column("text"):
                profile = Profile()
                for piece in _pieces(text):
                    words = piece.split()
                    profile.add(piece, words, np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
                patterns.append(sum(v * 3**i for i, v in enumerate(votes(profile))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(patterns, pa.int32())], names=["doc_id", "pattern"])

    return docs.select("doc_id", "text").mapInArrow(per_batch, f"doc_id {id_type}, pattern int")


def learn_accuracies(patterns: np.ndarray, n: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Probability of a good text per vote pattern, and P(vote | class) per labeller as (labeller, class, vote).

    Expectation-maximisation, the labellers taken as independent given the class. It starts from the majority of
    votes, which also says which class is the good one. Silence says nothing.
    """
    said = patterns[:, None] // 3 ** np.arange(LABELLERS) % 3
    good, bad = (said == GOOD).sum(axis=1), (said == BAD).sum(axis=1)
    chance = (good + 1) / (good + bad + 2)
    one_hot = np.eye(3)[said][:, :, :2]  # pattern, labeller, vote
    table = np.full((LABELLERS, 2, 2), 1 / 2)
    for _ in range(rounds):
        weight = np.stack([n * (1 - chance), n * chance], axis=1)
        counts = np.einsum("pc,plv->lcv", weight, one_hot) + 1
        table = counts / counts.sum(axis=2, keepdims=True)
        prior = (weight.sum(axis=0) + 1) / (weight.sum() + 2)
        logs = np.log(prior) + np.einsum("plv,lcv->pc", one_hot, np.log(table))
        last, chance = chance, 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))
        if np.abs(chance - last).max(initial=0) < 1e-9:
            break
    return chance, table


def _features(docs: DataFrame) -> DataFrame:
    """(p, slots, counts) of `docs` (text, p)."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Codes()
        for batch in batches:
            slots, counts = [], []
            for text in batch.column("text"):
                total = np.zeros(SLOTS, np.int64)
                for piece in _pieces(text):
                    words = piece.split()
                    codes = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                    total += np.bincount(codes >> 16 & 0xFFFF, minlength=SLOTS) + np.bincount(codes & 0xFFFF, minlength=SLOTS)
                    total[-1] += int((codes[1:] == codes[:-1]).sum())
                slots.append(np.flatnonzero(total).tolist())
                counts.append(total[slots[-1]].tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("p"), pa.array(slots, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                names=["p", "slots", "counts"],
            )

    return docs.select("text", "p").mapInArrow(per_batch, "p double, slots array<int>, counts array<int>")


def fit(sample: pa.Table) -> np.ndarray:
    """Weights and bias of a logistic model of p from how often each slot occurs per word; gradient steps of adapted size."""
    p = sample.column("p").to_numpy()
    lists, counts = sample.column("slots").to_pylist(), sample.column("counts").to_pylist()
    rows = np.repeat(np.arange(len(p)), [len(s) for s in lists])
    slots = np.concatenate([np.array(s, np.int64) for s in lists]) if lists else np.zeros(0, np.int64)
    values = np.concatenate([np.array(c, float) / max(1, sum(c)) for c in counts]) if lists else np.zeros(0)
    weights, moment, speed = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    for step in range(1, ROUNDS + 1 if len(p) else 1):
        score = np.bincount(rows, weights[slots] * values, len(p)) + weights[-1]
        miss = 1 / (1 + np.exp(-np.clip(score, -500, 500))) - p
        slope = np.append(np.bincount(slots, miss[rows] * values, SLOTS), miss.sum()) / len(p)
        slope[:-1] += 1e-6 * weights[:-1]
        moment = 0.9 * moment + 0.1 * slope
        speed = 0.99 * speed + 0.01 * slope**2
        weights -= 0.5 * (moment / (1 - 0.9**step)) / (np.sqrt(speed / (1 - 0.99**step)) + 1e-8)
    return weights


def classify(docs: DataFrame, max_train: int = 8192) -> DataFrame:
    """(doc_id, score, quality) for each row of `docs` (doc_id, text, ...).

    Eleven heuristic labellers vote good, bad or nothing on every text. How often each is right is estimated by
    expectation-maximisation from the counts of all vote patterns over all documents (at most 3 ** 11 patterns, so what the
    driver gets is bounded). The posterior of the patterns labels a sample of about `max_train` documents, chosen by the hash of
    their id (all, if there are fewer), on which a logistic scorer over hashed words and word shapes is
    fitted. It scores all texts. `score` is the probability of good quality, `quality` is 1 from 0.5 on, else 0.

    Null and empty texts and texts without words: score 0, quality 0. A null doc_id stays null and is not in the sample.
    Repeated rows come back each. No rows: no rows. Texts are read in pieces of 4 MB, in place. Other columns are ignored.
    """
    voted = stored(vote_patterns(docs).select("doc_id", "pattern"), "votes")
    counted = voted.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = np.array([r.pattern for r in counted], np.int64)
    chance, _ = learn_accuracies(patterns, np.array([r.n for r in counted], float))
    good = dict(zip(patterns.tolist(), chance.tolist()))

    def posterior(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = pa.array([good[x] for x in batch.column("pattern").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), p], names=["doc_id", "p"])

    total = sum(r.n for r in counted)
    mix = F.abs(F.xxhash64("doc_id") % F.lit(MIX)) / F.lit(float(MIX))
    chosen = (mix * total < max_train) & F.col("doc_id").isNotNull()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    labels = stored(voted.filter(chosen).mapInArrow(posterior, f"doc_id {id_type}, p double").distinct(), "weak-labels")
    sample = docs.select("doc_id", "text").filter(chosen).join(labels, "doc_id")
    weights = fit(_features(sample).toArrow()).astype(np.float32)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Codes()
        for batch in batches:
            scores = []
            for text in batch.column("text"):
                total, count = 0.0, 0
                for piece in _pieces(text):
                    words = piece.split()
                    codes = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                    repeats = int((codes[1:] == codes[:-1]).sum())
                    total += float(weights[codes >> 16 & 0xFFFF].sum() + weights[codes & 0xFFFF].sum() + repeats * weights[SLOTS - 1])
                    count += 2 * len(words) + repeats
                scores.append(1 / (1 + np.exp(-np.clip(total / count + weights[-1], -500, 500))) if count else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(score, f"doc_id {id_type}, score double")
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("quality"))
