import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lorebase.llm import lm
from lorebase.llm.queries import QUERIES
from tests.llm.data import no_docs, odd_docs, tables

WORD = re.compile("[^\x20\x09-\x0d]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


@pytest.fixture
def weights(monkeypatch):
    kept = {}
    learn = lm.learn_weights

    def spy(codes, n, total, kinds):
        kept["weights"], kept["tokens"] = learn(codes, n, total, kinds), n.sum()
        return kept["weights"]

    monkeypatch.setattr(lm, "learn_weights", spy)
    return kept


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def check(rows, given, kept):
    texts = [(i, WORD.findall((t or "").translate(UPPER)) + [0]) for i, t in given]
    words, pairs = Counter(), Counter()
    for i, w in texts:
        if i is not None and not held_out(i):
            words.update(w)
            pairs.update(zip([0, *w[:-1]], w))
    total, kinds = sum(words.values()), len(words)
    assert kept["tokens"] == total
    want = []
    for i, w in texts:
        base = sum(math.log10((words[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in w)
        score = 0.0
        for u, x in zip([0, *w[:-1]], w):
            two, one, none = kept["weights"][int(math.log2(max(1, words[u])))]
            score += math.log10(two * pairs[u, x] / max(1, words[u]) + one * words[x] / max(1, total) + none / (kinds + 1))
        want.append((i, len(w), sum(words[x] > 0 for x in w), total, round(base, 4), round(score, 4)))
    got = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score, 4)) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_query(spark, data, weights):
    rows = QUERIES["op8_lm_score"](spark, data).collect()
    check(rows, [(d.doc_id, d.text) for d in tables(spark, data, "documents")], weights)
    assert all(r.held_out == held_out(r.doc_id) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_documents_in_small_blocks(spark, weights, monkeypatch):
    for name, value in (("BLOCK_TOKENS", 20000), ("TASK_KEYS", 20000), ("PIECE", 100), ("CACHE_WORDS", 5)):
        monkeypatch.setattr(lm, name, value)
    docs = odd_docs(spark)
    given = [(d.doc_id, d.text) for d in docs.collect()]
    check(lm.score_documents(docs, ~lm.held_out(docs["doc_id"])).collect(), given, weights)


def test_nothing(spark):
    docs = no_docs(spark)
    assert lm.score_documents(docs, ~lm.held_out(docs["doc_id"])).count() == 0
    docs = odd_docs(spark)
    assert {(r.base_score, r.score, r.n_known) for r in lm.score_documents(docs, docs["doc_id"] < 0).collect()} == {(0.0, 0.0, 0)}


def test_weights_follow_the_held_out_counts():
    code = lambda bucket, two, one: (bucket * lm.BINS + two) * lm.BINS + one
    codes = np.array([code(0, lm.BINS - 1, 8), code(5, 0, 40), code(5, lm.BINS - 1, 20)])
    w = lm.learn_weights(codes, np.array([100.0, 900.0, 100.0]), 1000, 500)
    assert w[0][0] < 0.01 and w[5][0] > 0.8
    assert np.allclose(w.sum(axis=1), 1) and (w > 0).all()
    assert np.allclose(w[40], w[63])


def test_packing_of_numbers():
    for numbers in ([], [0], [5, 5, 2**64 - 1], list(range(0, 10**6, 7))):
        assert lm._unpack_sorted(lm._pack_sorted(np.array(numbers, np.uint64))).tolist() == numbers
        small = np.array(numbers[:2], np.uint32)
        assert lm._unpack(lm._pack(small), np.uint32).tolist() == small.tolist()
