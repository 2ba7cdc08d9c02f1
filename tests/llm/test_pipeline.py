import re

import corpus_pipeline as p
from tests.llm.test_decontam import QUESTION
from tests.llm.test_lines import brute as without_lines
from tests.llm.test_simhash import fingerprint, lowest
from tests.llm.data import sentence, tables


def test_stages(spark, data):
    assert [name for name, _ in p.STAGES] == ["language_id", "line_dedup", "simhash_dedup", "decontamination", "best_fit_packing"]
    assert p.ORACLE_SQL is None
    docs = spark.read.parquet(f"{data}/documents.parquet")
    for name, stage in p.STAGES[:-1]:
        docs = p.stored(stage(spark, docs, data), name)
        assert docs.columns == p.COLUMNS
    kept = docs.count()
    packed = p.run(spark, data)
    assert packed.select("doc_id").distinct().count() == kept
    assert packed.agg({"length": "sum"}).first()[0] == docs_tokens(docs)


def docs_tokens(docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(p.tokenizer())
    return sum(len(tok.encode(d.text, add_special_tokens=False).ids) + 1 for d in docs.collect())


def words(text):
    return re.findall(r"\w+", text.lower())


def runs(text, n=13):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_documents_that_stay(spark, data):
    """Each stage against brute force on what the one before it kept."""
    given = {d.doc_id: d.text for d in tables(spark, data, "documents")}
    passages = set().union(*(runs(d.text) for d in tables(spark, data, "benchmark")))
    docs = spark.read.parquet(f"{data}/documents.parquet")
    for name, stage in p.STAGES[:-1]:
        docs = p.stored(stage(spark, docs, data), name)
        got = {d.doc_id: d.text for d in docs.collect()}
        if name == "language_id":
            want = {i: t for i, t in given.items() if any(c.isalpha() for c in t or "")}
        elif name == "line_dedup":
            want = {i: t for i, t, _, _ in without_lines(list(given.items()), 20, 3)}
        elif name == "simhash_dedup":
            fps, ids = {i: fingerprint(t) for i, t in given.items()}, sorted(given)
            root = lowest(ids, [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if (fps[a] ^ fps[b]).bit_count() <= 2])
            want = {i: t for i, t in given.items() if root[i] == i}
        else:
            want = {i: t for i, t in given.items() if not runs(t) & passages}
        assert got == want, name
        given = got


def test_rows_without_id_lose_passages_and_copies(spark, data):
    passage = tables(spark, data, "benchmark")[0].text
    row = lambda i, t: (i, t, "en", "s", len(t))
    given = [row(None, sentence(1) + " " + passage), row(None, sentence(2)), row(None, sentence(2)), row(5, sentence(2)), row(None, sentence(4)), row(None, sentence(6)), row(9, sentence(6)), row(9, sentence(8))]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long")
    kept = p.without_benchmarks(spark, docs, data).collect()
    assert len(kept) == 7 and not any(passage in r.text for r in kept)
    kept = sorted(((r.doc_id, r.text) for r in p.without_near_copies(spark, docs, data).collect()), key=repr)
    want = [(5, sentence(2)), (9, sentence(6)), (9, sentence(8)), (None, sentence(1) + " " + passage), (None, sentence(4))]
    assert kept == sorted(want, key=repr)


def test_odd_documents(spark, data):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string"
    rows = [(1, None, None, None, None, "r"), (2, "", "en", None, 0, None), (3, sentence(3), "en", "s", 1, None), (3, sentence(3), "en", "s", 1, None)]
    rows += [(4, sentence(3), None, "s", 1, "x"), (5, "123 !!", "de", "s", 1, "x"), (None, sentence(5), "en", None, None, None), (6, QUESTION, "en", "s", 9, None)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in p.STAGES[:-1]:
        docs = p.stored(stage(spark, docs, data), name)
    assert sorted((d.doc_id for d in docs.collect()), key=repr) == [3, 6, None]
    none = spark.createDataFrame([], schema)
    for name, stage in p.STAGES:
        none = p.stored(stage(spark, none, data), name)
    assert none.count() == 0
