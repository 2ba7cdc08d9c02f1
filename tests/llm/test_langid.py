import math
import random
from collections import Counter

import pytest

from lorebase.llm import langid
from lorebase.llm.queries import QUERIES
from tests.llm.data import no_docs, odd_docs, tables


def test_held_out_accuracy(spark, data):
    truth = {d.doc_id: d.lang for d in tables(spark, data, "documents")}
    rows = QUERIES["op6_language_id"](spark, data).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and 0.15 * len(rows) < len(held) < 0.35 * len(rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def code_length(model, at, text):
    """Bits of a text, symbol by symbol down the contexts."""
    size, order = model.symbols, model.order
    tables = [{} for _ in range(order + 1)]
    for run, n in zip(model.runs[at].tolist(), model.counts[at].tolist()):
        symbols = [run // size**k % size for k in reversed(range(order + 1))]
        for length in range(order + 1):
            context = tuple(symbols[order - length : order])
            tables[length].setdefault(context, Counter())[symbols[-1]] += n
    bits, seen = 0.0, [0] * order
    for byte in text.encode():
        symbol = int(model.symbol[byte])
        for length in range(order, -2, -1):
            if length < 0:
                bits += math.log2(size)
                break
            counts = tables[length].get(tuple(seen[order - length :]))
            if counts is None:
                continue
            n, kinds = sum(counts.values()), len(counts)
            if counts[symbol]:
                bits += math.log2((n + kinds) / counts[symbol])
                break
            bits += math.log2((n + kinds) / kinds)
        seen = (seen + [symbol])[1:] if order else []
    return bits


@pytest.mark.parametrize("order", [1, 2, 3])
def test_code_lengths(spark, data, monkeypatch, order):
    monkeypatch.setattr(langid, "PIECE", 50)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = langid.train(docs.filter("doc_id % 5 = 0"), order=order, symbols=15)
    rnd = random.Random(order)
    some = [(r.doc_id, r.text[: rnd.randint(1, 400)]) for r in docs.limit(25).collect()] + [(-1, "Ö"), (-2, "a"), (-3, "zzzz\n\t  Q")]
    for r in langid.identify(spark.createDataFrame(some, "doc_id long, text string").repartition(2), model).collect():
        text = dict(some)[r.doc_id]
        bits = [code_length(model, at, text) for at in range(len(model.languages))]
        best = min(range(len(bits)), key=bits.__getitem__)
        assert r.lang_pred == model.languages[best]
        assert math.isclose(r.bits_per_byte * len(text.encode()), bits[best], rel_tol=1e-4)
        assert math.isclose(r.score, 1 / sum(2 ** max(-1000, bits[best] - b) for b in bits), rel_tol=1e-2)


def test_odd_documents(spark):
    docs = odd_docs(spark)
    model = langid.train(docs.filter(~langid.held_out(docs["doc_id"])))
    rows = langid.identify(docs, model).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        if r.doc_id is not None and not any(c.isalpha() for c in texts[r.doc_id] or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred in ("de", "en")
    carried = langid.identify(docs, model, carry=True).select("row.*")
    assert carried.columns == docs.columns and sorted(carried.collect(), key=repr) == sorted(docs.collect(), key=repr)


def test_nothing_to_learn_from(spark):
    model = langid.train(no_docs(spark))
    assert {r.lang_pred for r in langid.identify(odd_docs(spark), model).collect()} == {"und"}
    assert langid.identify(no_docs(spark), model).count() == 0


def test_sample_is_bounded(spark):
    rows = [(i, "text number " + str(i), "en") for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    few = langid.train(frame, max_docs=100)
    size = sum(n.sum() for n in few.counts)
    assert 60 * 12 < size < 150 * 20
