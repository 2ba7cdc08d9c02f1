import numpy as np

from lorebase.llm import quality
from lorebase.llm.queries import QUERIES
from tests.llm.data import docs, no_docs, odd_docs, sentence, tables


def test_agrees_with_the_labels(spark, data):
    labels = {r.doc_id: r.quality for r in tables(spark, data, "labels")}
    rows = QUERIES["op9_quality"](spark, data).collect()
    assert len(rows) == len(tables(spark, data, "documents"))
    known = [(labels[r.doc_id], r.quality) for r in rows if r.doc_id in labels]
    assert sum(a == b for a, b in known) >= 0.95 * len(known)
    assert sum(b for a, b in known if a) >= 0.97 * sum(a for a, _ in known)


def test_accuracies_of_labellers(monkeypatch):
    monkeypatch.setattr(quality, "LABELLERS", 4)
    rnd = np.random.default_rng(1)
    truth = rnd.random(20000) < 0.8
    right = np.array([0.95, 0.9, 0.7, 0.6])
    votes = np.where(rnd.random((20000, 4)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[rnd.random((20000, 4)) < 0.2] = quality.SILENT
    patterns, n = np.unique(votes @ 3 ** np.arange(4), return_counts=True)
    chance, table = quality.learn_accuracies(patterns, n.astype(float))
    assert np.allclose(table[:, 1, 1], right, atol=0.03) and np.allclose(table[:, 0, 0], right, atol=0.05)
    assert chance[patterns == 1 + 3 + 9 + 27][0] > 0.99 and chance[patterns == 0][0] < 0.1


def test_odd_documents(spark):
    rows = quality.classify(odd_docs(spark)).collect()
    assert len(rows) == odd_docs(spark).count()
    texts = {r.doc_id: r.text for r in odd_docs(spark).collect()}
    for r in rows:
        assert 0 <= r.score <= 1 and r.quality == int(r.score >= 0.5)
        if r.doc_id is not None and not (texts[r.doc_id] or "").split():
            assert (r.score, r.quality) == (0.0, 0)
    assert quality.classify(no_docs(spark)).count() == 0


def test_texts_in_pieces(spark, monkeypatch):
    texts = [sentence(i, 80) for i in range(30)] + ["!!! ### $$$ " * 30, "same " * 200]
    whole = {r.doc_id: r.pattern for r in quality.vote_patterns(docs(spark, texts, 1)).collect()}
    assert whole[30] != whole[0] and whole[31] != whole[0]
    monkeypatch.setattr(quality, "PIECE", 100)
    scores = {r.doc_id: r.quality for r in quality.classify(docs(spark, texts)).collect()}
    assert scores[0] == 1 and scores[30] == 0
