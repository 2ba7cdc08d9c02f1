import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from lorebase.llm import simhash
from lorebase.llm.components import components
from lorebase.llm.queries import QUERIES
from tests.llm.data import docs, no_docs, odd_docs, sentence, tables

WORD = re.compile("[^\x20\x09-\x0d]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def fingerprint(text):
    words = WORD.findall((text or "").translate(UPPER))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def lowest(nodes, links):
    """Smallest reachable node of each."""
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in links:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def check(rows, given):
    fps = {i: fingerprint(t) for i, t in given}
    ids = sorted(i for i in fps if i is not None)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if (fps[a] ^ fps[b]).bit_count() <= 2]
    root = lowest(ids, links)
    assert len(rows) == len(given)
    for r in rows:
        assert r.fingerprint == f"{fps[r.doc_id]:016x}"
        if r.doc_id is not None:
            assert r.component_id == root[r.doc_id]


def test_query(spark, data):
    check(QUERIES["op7_simhash"](spark, data).collect(), [(d.doc_id, d.text) for d in tables(spark, data, "documents")])


def test_odd_documents(spark):
    rows = [(d.doc_id, d.text) for d in odd_docs(spark).collect() if d.doc_id is not None]
    check(simhash.near_duplicates(odd_docs(spark).filter("doc_id is not null")).collect(), rows)
    assert simhash.near_duplicates(odd_docs(spark)).count() == odd_docs(spark).count()
    assert simhash.near_duplicates(no_docs(spark)).count() == 0


def test_texts_in_pieces(spark, monkeypatch):
    texts = [sentence(i, 200) for i in range(5)] + ["one two", "x " * 50, "  a\tb\nc d "]
    whole = {r.doc_id: r.fp for r in simhash.fingerprints(docs(spark, texts)).collect()}
    monkeypatch.setattr(simhash, "PIECE", 7)
    monkeypatch.setattr(simhash, "HASHES", 5)
    assert {r.doc_id: r.fp for r in simhash.fingerprints(docs(spark, texts)).collect()} == whole


@pytest.mark.parametrize("small_cell", [1, 5, 24])
def test_links_of_crowded_and_sparse_cells(spark, monkeypatch, small_cell):
    monkeypatch.setattr(simhash, "SMALL_CELL", small_cell)
    rnd = random.Random(small_cell)
    fps = {rnd.getrandbits(64) for _ in range(200)} | {0, 2**64 - 1, 1, 3, 7, 1 << 63}
    for _ in range(6):
        centre = rnd.getrandbits(64)
        for _ in range(60):
            fps.add(centre ^ sum({1 << rnd.randrange(64) for _ in range(rnd.randint(0, 3))}))
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    frame = spark.createDataFrame([(signed(x),) for x in fps], "fp long").repartition(5)
    got = [(r.a, r.b) for r in simhash.close_links(frame).collect()]
    order = sorted(fps)
    want = [(signed(a), signed(b)) for n, a in enumerate(order) for b in order[n + 1 :] if (a ^ b).bit_count() <= 2]
    nodes = [signed(x) for x in fps]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in got)
    assert lowest(nodes, got) == lowest(nodes, want)


def test_components(spark):
    rnd = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 301), (301, 300), (300, 301)]
    links += [(1000 + rnd.randrange(80), 1000 + rnd.randrange(80)) for _ in range(70)]
    frame = spark.createDataFrame([*links, (None, 5), (None, None)], "a long, b long")
    real = [(a, b) for a, b in links if a != b]
    nodes = {n for pair in real for n in pair}
    assert {r.node: r.root for r in components(frame).collect()} == lowest(nodes, real)
    assert components(frame.filter(F.lit(False))).count() == 0
