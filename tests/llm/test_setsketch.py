import random

import numpy as np
import pytest

from lorebase.llm import setsketch as s
from tests.llm.data import docs, no_docs, odd_docs, tables
from tests.llm.test_simhash import UPPER, WORD, lowest


def shingles(text, n=5):
    words = WORD.findall((text or "").translate(UPPER))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(texts, percent):
    """component_id per id, over all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in texts.items()}
    held = {}
    for i, x in sets.items():
        for y in x:
            held.setdefault(y, []).append(i)
    pairs = {(a, b) for ids in held.values() for n, a in enumerate(ids) for b in ids[n + 1 :]}
    return lowest(texts, [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])])


def edited(rnd, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
    return " ".join(words)


def crowd(copies, seed=3, most=10):
    """Copies of one text with up to `most` changed words each, one in ten with many and one in four exact, and longer ones."""
    rnd = random.Random(seed)
    words = [f"w{rnd.randrange(10**4)}" for _ in range(200)]
    rows = [edited(rnd, words, 40 if i % 10 == 9 else rnd.randint(0, most)) for i in range(copies)]
    return [rows[i - 1] if i % 4 == 3 else t + " tail" * (i % 60) if i % 17 == 0 else t for i, t in enumerate(rows)]


@pytest.mark.parametrize("small_band", [2, 8])
@pytest.mark.parametrize("percent", [80, 85])
def test_links_against_brute_force(spark, monkeypatch, small_band, percent):
    """Groups of three and crowds of near copies, on both sides of the bound between small and large bands."""
    monkeypatch.setattr(s, "SMALL_BAND", small_band)
    texts = [t for n in range(20) for t in crowd(3, n)] + crowd(150, 50) + crowd(90, 51, 4)
    texts = dict(enumerate(texts))
    got = s.near_duplicates(docs(spark, texts), percent=percent).collect()
    want = brute(texts, percent)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingles(texts[r.doc_id])) for r in got)
    assert len(set(want.values())) > 30


def test_few_pairs_of_a_crowd_are_read(spark, monkeypatch):
    """Of some 180,000 pairs of sets in a crowd about as many are read in full as there are copies."""
    read = []
    confirmed = s._confirmed
    monkeypatch.setattr(s, "_confirmed", lambda pairs, whole, percent: read.append(pairs.count()) or confirmed(pairs, whole, percent))
    s.near_duplicates(docs(spark, crowd(800)), percent=85).count()
    assert sum(read) <= 3 * 800


@pytest.mark.parametrize("percent", [80, 85])
def test_all_near_copies_of_a_table_are_found(spark, data, percent):
    texts = {d.doc_id: d.text for d in tables(spark, data.replace("sf0.001", "sf0.01"), "documents")}
    got = s.near_duplicates(docs(spark, texts), percent=percent).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(texts, percent)


def test_registers_merge_and_estimate():
    rnd = np.random.default_rng(5)
    for size, similarity in ((50, 0.9), (400, 0.85), (400, 0.3), (3000, 0.6)):
        pool = np.unique(rnd.integers(0, 2**64, 2 * size, np.uint64))
        shared = int(2 * size * similarity / (1 + similarity) / 2)
        a, b = pool[:size], pool[size - shared : 2 * size - shared]
        assert (s.registers(np.union1d(a, b)) == np.maximum(s.registers(a), s.registers(b))).all()
        x, y = s.registers(a).astype(int), s.registers(b).astype(int)
        one = lambda n: np.array([n], float)
        found = s.estimate(one((x > y).sum()), one((x < y).sum()), one(len(a)), one(len(b)))[0]
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(found - true) < 4 * (true * (1 - true) / s.REGISTERS) ** 0.5 + 0.01
        # Registers grow with the logarithm of the size: each holds about log_BASE(RATE * size).
        assert abs(x.mean() * np.log(s.BASE) - np.log(s.RATE * size)) < 1


def test_odd_documents(spark):
    given = odd_docs(spark)
    got = s.near_duplicates(given).collect()
    assert len(got) == given.count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[2].component_id == by_id[1].component_id == 1 and not by_id[2].kept
    assert [by_id[i].component_id for i in (3, 4, 5, 7, 10)] == [3, 4, 5, 7, 10]
    assert [by_id[i].n_shingles for i in (3, 4, 5, 10)] == [0, 0, 0, 1]
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert s.near_duplicates(no_docs(spark)).count() == 0


def test_null_ids_take_the_id_of_their_component(spark):
    rows = [(None, "a b c d e f g"), (4, "a b c d e f g"), (2, "a b c d e f g"), (None, "a B c")]
    got = {(r.doc_id, r.component_id, r.kept) for r in s.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(None, 2, False), (4, 2, False), (2, 2, True), (None, None, True)}
