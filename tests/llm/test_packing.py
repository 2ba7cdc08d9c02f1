import gc
import random
import struct
import zlib
from collections import defaultdict

import pytest

from lorebase.llm import packing
from lorebase.llm.queries import tokenizer
from lorebase.llm.queries import QUERIES
from tests.llm.data import docs, no_docs, odd_docs, tables

CAPACITY = 2048


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer())
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids + [0]


def pieces_of(ids, capacity):
    parts = [ids[k : k + capacity] for k in range(0, len(ids), capacity)]
    return [(n, n * capacity, len(p), zlib.crc32(struct.pack(f"<{len(p)}I", *p))) for n, p in enumerate(parts)]


def check(rows, given, encode, capacity=CAPACITY):
    want = sorted(((i, *p) for i, t in given for p in pieces_of(encode(t), capacity)), key=repr)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(r.length for r in rows) // capacity)


def test_query_is_a_whole_and_tight_packing(spark, data, encode):
    given = [(d.doc_id, d.text) for d in tables(spark, data, "documents")]
    used, bound = check(QUERIES["op2_best_fit_packing"](spark, data).collect(), given, encode)
    assert used <= bound * 1.02 + 1


def test_odd_documents(spark, encode):
    given = odd_docs(spark)
    rows = packing.pack_documents(given, tokenizer()).collect()
    check(rows, [(d.doc_id, d.text) for d in given.collect()], encode)
    assert packing.pack_documents(no_docs(spark), tokenizer()).count() == 0


def test_words_are_encoded_as_whole_texts_are(spark, encode):
    odd = [
        "J̌ ǰ É é Straße STRASSE İi ǰ.", "it's 'tis 'street <|endoftext|> a<|startoftext|>b", "...a.. b., 3.14 x1,", "\x1c\u00a0\u2003z\x85\x0b", "K Å Ω",
        "Éa. éA, \u0301 a\u0301.", "ß. ẞ.", "don't. DON'T, we'll.", "漢字。漢字.", "\u0130. \u0131,",
    ]
    rnd = random.Random(1)
    odd += ["".join(rnd.choice("aA.,'é\u0301 İß1\n") for _ in range(30)) for _ in range(300)]
    rows = packing.pack_documents(docs(spark, odd), tokenizer()).collect()
    check(rows, list(enumerate(odd)), encode)


def test_rounds_over_several_blocks(spark, monkeypatch, encode):
    monkeypatch.setattr(packing, "BLOCK_ITEMS", 40)
    rnd = random.Random(2)
    given = [(i, "river " * rnd.randint(1, 60)) for i in range(700)]
    frame = spark.createDataFrame(given, "doc_id long, text string").repartition(5)
    used, bound = check(packing.pack_documents(frame, tokenizer(), capacity=64).collect(), given, encode, 64)
    assert used <= bound * 1.1


def test_sequences_hold_the_ids(spark, encode):
    given = {1: "river stone", 2: None, 3: "cloud " * 90}
    packed = packing.pack_documents(docs(spark, given), tokenizer(), capacity=32, with_ids=True)
    ids = [i for r in packing.sequences(packed).collect() for i in r.ids]
    assert sorted(ids) == sorted(i for t in given.values() for i in encode(t))


def test_best_fit():
    bins, offsets, fills = packing.best_fit([5, 5, 4, 3, 2, 1], 10)
    assert sorted(fills) == [10, 10]
    assert len(set(zip(bins, offsets))) == 6
    assert packing.best_fit([], 10) == ([], [], [])


def test_words_are_found_without_collecting_garbage(monkeypatch):
    """Thousands of words at a time are in no cycles; afterwards garbage is collected as before, also where finding them fails."""
    words = packing.WordIds(tokenizer())
    learn, seen = words._learn, []
    monkeypatch.setattr(words, "_learn", lambda new: seen.append(gc.isenabled()) or learn(new))
    assert len(list(words.encode([b"one two", b"three"]))) == 2
    assert seen == [False] and gc.isenabled()
    monkeypatch.setattr(words, "_learn", lambda new: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        list(words.encode([b"four"]))
    assert gc.isenabled()
