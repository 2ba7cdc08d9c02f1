import math
import re
from collections import Counter, defaultdict
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window as W, functions as F

from lorebase.functions.text import chunks, token_characters, tokens
from lorebase.operators import retrieval as r
from lorebase.session import scratch_path
from lorebase.sources import bindings, kb

WORDS = "apple pear plum fig date lime kiwi melon grape mango".split()


def texts(n=60, seed=3):
    """Texts with a very frequent word, and a third of them equal."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        picked = ["plum", "fig"] if i % 3 == 0 else list(rng.choice(WORDS, size=int(rng.integers(1, 9))))
        rows.append((f"d{i:03d}", " ".join(["The", *picked])))
    return rows


def brute(docs, questions, k, threshold=None, skip_self=False):
    tokens = lambda s: re.findall(r"[^\W]+", s.lower())
    tf = {d: Counter(tokens(t)) for d, t in docs}
    tf = {d: c for d, c in tf.items() if c}
    df = Counter(t for c in tf.values() for t in c)
    n = len(tf)
    weigh = lambda c: {t: (1 + math.log(f)) * (math.log((1 + n) / (1 + df[t])) + 1) for t, f in c.items()}

    def unit(c):
        w = weigh(c)
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()}

    vectors = {d: unit(c) for d, c in tf.items()}
    out = set()
    for q, text in questions:
        if not tokens(text):
            continue
        v = unit(Counter(tokens(text)))
        scored = []
        for d, w in vectors.items():
            if v.keys() & w.keys() and not (skip_self and d == q):
                s = round(sum(v[t] * w[t] for t in v.keys() & w.keys()), 6)
                if threshold is None or s >= threshold:
                    scored.append((-s, d))
        for rank, (s, d) in enumerate(sorted(scored)[:k], 1):
            out.add((q, d, round(-s, 5), rank))
    return out


def rows(hits):
    return {(h["question_id"], h["doc_id"], round(h["score"], 5), h["rank"]) for h in hits.collect()}


@pytest.fixture(scope="module")
def corpus(spark):
    docs = [*texts(), ("empty", ""), ("marks", "?! ..")]
    frame = spark.createDataFrame(docs, "doc_id string, content string")
    questions = [("q1", "the plum"), ("q2", "Apple, apple kiwi"), ("q3", "unknown words"), ("q4", "melon"), ("q5", "the")]
    postings = kb.write_postings(frame, scratch_path(spark, "postings"))
    return docs, questions, spark.createDataFrame(questions, "question_id string, question string"), r.open_index(postings)


@pytest.mark.parametrize("k", [1, 3, 50])
def test_text_search_matches_brute_force(corpus, k):
    docs, questions, frame, index = corpus
    assert rows(r.search_topk_text(frame, index, k)) == brute(docs, questions, k)


def test_text_search_in_small_question_parts(corpus):
    docs, questions, frame, index = corpus
    assert rows(r.search_topk_text(frame, index, 4, broadcast_bytes=150)) == brute(docs, questions, 4)
    assert rows(r.search_topk_text(frame, index, 4, broadcast_bytes=1)) == brute(docs, questions, 4)


@pytest.mark.parametrize("k, skip, part", [(1, False, 1 << 20), (3, True, 40000), (8, False, 40000)])
def test_pruned_search_matches_brute_force(spark, k, skip, part):
    """Words with very different frequencies, equal texts, and one question per text."""
    rng = np.random.default_rng(11)
    vocabulary = [f"w{i}" for i in range(60)]
    odds = 1 / np.arange(1, 61) ** 1.3
    docs = [(f"d{i:03d}", " ".join(rng.choice(vocabulary, size=int(rng.integers(2, 25)), p=odds / odds.sum()))) for i in range(150)]
    docs = [(d, docs[0][1]) if i % 3 == 0 else (d, t) for i, (d, t) in enumerate(docs)]
    frame = spark.createDataFrame(docs, "doc_id string, content string")
    index = r.open_index(kb.write_postings(frame, scratch_path(spark, "postings")))
    questions = spark.createDataFrame(docs, "question_id string, question string")
    hits = r.search_topk_text(questions, index, k, exclude_self=skip, broadcast_bytes=part)
    assert rows(hits) == brute(docs, docs, k, skip_self=skip)


def test_blocks_are_set_aside(spark, monkeypatch):
    """A word in all texts adds little, so its blocks are read for candidates only."""
    docs = [(f"d{i:03d}", "the " * 5 + f"name{i % 20} thing{i % 3}") for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id string, content string")
    index = r.open_index(kb.write_postings(frame, scratch_path(spark, "postings")))
    questions = spark.createDataFrame([("q", "the thing1 name7"), ("p", "the")], "question_id string, question string")
    read = []
    monkeypatch.setattr(r, "FIRST_LOOK", 4)
    plain = r._block_weights
    monkeypatch.setattr(r, "_block_weights", lambda i, wanted, *more: read.append({(x.question_id, x.term) for x in wanted.collect()}) or plain(i, wanted, *more))
    assert rows(r.search_topk_text(questions, index, 3)) == brute(docs, [("q", "the thing1 name7"), ("p", "the")], 3)
    first, needed, aside = read
    assert ("q", "name7") in first and ("q", "the") not in first
    assert ("q", "name7") in needed and ("q", "the") not in needed and ("p", "the") in needed
    assert ("q", "the") in aside and ("p", "the") not in aside


def test_weights_are_filtered_before_they_shuffle(corpus):
    """No exchange stands over weights that have not passed the filter by bucket and block."""
    index = corpus[3]
    wanted = index.blocks.filter("term = 'plum'").selectExpr("'q' AS question_id", "bucket", "term", "class", "0.5D AS question_weight").checkpoint()
    sums = r._sums(index, wanted, ["bucket", "term", "class"], F.broadcast)
    for found in (r.search_topk_text(corpus[2], index, 5), sums):
        plan = found._jdf.queryExecution().executedPlan().toString()
        above, scans = [], 0
        for line in plan.splitlines():
            depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
            above = [x for x in above if x[0] < depth]
            if "FileScan" in line and re.search(r"[\[,]weight#", line):
                scans += 1
                assert "PartitionFilters: [isnotnull(bucket" in line or "PartitionFilters: [bucket" in line
                kinds = [x[1] for x in above]
                nearest = max((n for n, x in enumerate(kinds) if x.startswith("Exchange")), default=-1)
                assert any("LeftSemi" in x for x in kinds[nearest + 1 :])
            above.append((depth, line.lstrip(" :+-*()0123456789")))
        assert scans == 1


def test_index_reads_the_buckets_of_its_terms(spark, monkeypatch):
    """Several buckets, weights of a term in several files, and the same hits; an index is read back as it was written."""
    monkeypatch.setattr(r, "BUCKET_ROWS", 50)
    docs = texts(200)
    frame = spark.createDataFrame(docs, "doc_id string, content string")
    path = scratch_path(spark, "index")
    r.write_index(kb.write_postings(frame, scratch_path(spark, "postings")), path)
    index = r.read_index(spark, path)
    assert index.blocks.select("bucket").distinct().count() > 3
    asked = [("q1", "plum kiwi"), ("q2", "the fig"), ("q3", "")]
    questions = spark.createDataFrame(asked, "question_id string, question string")
    assert rows(r.search_topk_text(questions, index, 7)) == brute(docs, asked, 7)
    empty = r.open_index(kb.write_postings(frame.filter("doc_id = ''"), scratch_path(spark, "postings")))
    assert r.search_topk_text(questions, empty, 7).count() == 0


def test_chunk_search_matches_brute_force(spark):
    rng = np.random.default_rng(21)
    docs = [(f"d{i:02d}", " ".join(rng.choice(WORDS, size=int(rng.integers(1, 400))))) for i in range(40)]
    pieces = r.chunk_documents(spark.createDataFrame(docs, "doc_id string, content string"))
    units = {f"{p.doc_id}/{p.chunk_no:04d}": p.content for p in pieces.collect()}
    asked = [("q1", "plum kiwi kiwi"), ("q2", "mango"), ("q3", " ".join(WORDS))]
    scores = brute(list(units.items()), asked, len(units))
    want = set()
    for q, _ in asked:
        best = {}
        for _, u, s, _ in sorted((x for x in scores if x[0] == q), key=lambda x: (-x[2], x[1])):
            best.setdefault(u.split("/")[0], s)
        want |= {(q, d, s, n) for n, (d, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:6], 1)}
    index = r.open_index(kb.write_postings(pieces, scratch_path(spark, "postings"), ["doc_id", "chunk_no"]), ["doc_id", "chunk_no"])
    questions = spark.createDataFrame(asked, "question_id string, question string")
    assert rows(r.search_chunk_rollup(questions, index, 6)) == want


def test_text_search_with_large_vocabulary(corpus, monkeypatch):
    docs, questions, frame, index = corpus
    monkeypatch.setattr(r, "BROADCAST_BYTES", 0)
    assert rows(r.search_topk_text(frame, index, 4)) == brute(docs, questions, 4)


def test_text_search_threshold_and_self(spark, corpus):
    docs, _, frame, index = corpus
    assert rows(r.search_topk_text(frame, index, 9, threshold=0.3)) == brute(docs, corpus[1], 9, threshold=0.3)
    own = spark.createDataFrame(docs, "question_id string, question string")
    assert rows(r.search_topk_text(own, index, 2, exclude_self=True)) == brute(docs, docs, 2, skip_self=True)


def test_k_must_be_positive(corpus):
    with pytest.raises(ValueError):
        r.search_topk_text(corpus[2], corpus[3], 0)


def test_scores_need_no_shuffle_of_pairs(corpus):
    plan = r.search_topk_text(corpus[2], corpus[3], 5)._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)", plan)
    assert set(exchanges) <= {"doc_id", "question_id"}
    assert "doc_id, question_id" not in " ".join(re.findall(r"Exchange hashpartitioning\([^)]*\)", plan))


@pytest.mark.parametrize("length", [0, 1, 49, 50, 51, 499, 500, 501, 950, 951, 5000])
def test_chunks_follow_the_offsets(spark, length):
    text = "".join(chr(0x61 + i % 26) if i % 7 else "\U0001f600" for i in range(length)).replace("b", "\n")
    got = spark.createDataFrame([(text,)], "t string").select(chunks(F.col("t"))).first()[0]
    count = 0 if length == 0 else max(1, math.ceil((length - 50) / 450))
    assert got == [text[450 * i : 450 * i + 500] for i in range(count)]


def test_chunk_rollup_keeps_best_chunk(spark):
    docs = spark.createDataFrame(
        [("a", "x " * 300 + "needle " + "y " * 300), ("b", "needle"), ("c", "z " * 900)], "doc_id string, content string"
    )
    pieces = r.chunk_documents(docs)
    index = r.open_index(kb.write_postings(pieces, scratch_path(spark, "postings"), ["doc_id", "chunk_no"]), ["doc_id", "chunk_no"])
    questions = spark.createDataFrame([("q", "needle")], "question_id string, question string")
    hits = r.search_chunk_rollup(questions, index, 5).orderBy("rank").collect()
    assert [(h["doc_id"], h["rank"]) for h in hits] == [("b", 1), ("a", 2)]
    where = {row["chunk_no"] for row in pieces.filter("doc_id = 'a' and contains(content, 'needle')").collect()}
    assert hits[1]["chunk_no"] in where


def test_strides_are_cut_once(spark):
    """A window looks at the next stride without cutting the whole text again."""
    docs = spark.range(1).selectExpr("id AS doc_id", "repeat('word ', id + 1000) AS content")
    assert r.chunk_documents(docs)._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(") == 1


@pytest.fixture(scope="module")
def chunked(spark, tmp_path_factory):
    """Documents of up to three chunks, a third of them equal, three under one id and one without id; the index lies in several packs."""
    rng = np.random.default_rng(8)
    docs = [(f"d{i:03d}", " ".join(rng.choice(WORDS, size=int(rng.integers(1, 250)))) + f" own{i}") for i in range(90)]
    docs = [(d, docs[0][1]) if i % 3 == 0 else ("d001", t) if i in (4, 5) else (None, t) if i == 7 else (d, t) for i, (d, t) in enumerate(docs)]
    frame = spark.createDataFrame([*docs, ("blank", "?!"), ("none", None)], "doc_id string, content string")
    path = tmp_path_factory.mktemp("chunked")
    postings = kb.write_postings(r.chunk_documents(frame.repartition(3, "doc_id")), str(path / "postings"), UNIT, 3)
    r.write_index(postings, str(path / "index"), UNIT, 3)
    units = defaultdict(list)
    for d, text in docs:
        for n in range(max(1, math.ceil((len(text) - 50) / 450))):
            units[d, n].append(text[450 * n : 450 * n + 500])
    return postings, r.read_index(spark, str(path / "index")), {u: " ".join(x) for u, x in units.items()}


UNIT = ["doc_id", "chunk_no"]


def best_chunks(units, asked, k):
    """(question, doc, chunk, score, rank) by brute force; as many texts count as have an id."""
    tf = {u: Counter(t.lower().split()) for u, t in units.items()}
    df, n = Counter(t for c in tf.values() for t in c), sum(d is not None for d, _ in units)
    weigh = lambda c: {t: (1 + math.log(f)) * (math.log((1 + n) / (1 + df[t])) + 1) for t, f in c.items()}
    long = lambda w: math.sqrt(sum(x * x for x in w.values()))
    out = []
    for q, text in asked:
        v, best = weigh(Counter(text.lower().split())), {}
        for (d, c), counts in sorted(tf.items(), key=lambda x: (x[0][0] or "", x[0][1])):
            w = weigh(counts)
            if v.keys() & w.keys():
                s = round(sum(v[t] * w[t] for t in v.keys() & w.keys()) / long(v) / long(w), 6)
                if d not in best or s > best[d][0]:
                    best[d] = s, c
        ranked = sorted(best.items(), key=lambda x: (-x[1][0], x[0] or ""))[:k]
        out += [(q, d, c, round(s, 5), rank) for rank, (d, (s, c)) in enumerate(ranked, 1)]
    return sorted(out, key=str)


ASKED = [("q1", "plum kiwi kiwi"), ("q2", "Mango own3 own7"), ("q3", " ".join(WORDS)), ("q4", "unknown"), ("q5", "own4 apple own5"), (None, "fig own8")]


@pytest.mark.parametrize("k, part", [(1, 1 << 20), (6, 1 << 20), (200, 1 << 20), (6, 100), (3, 1)])
def test_chunks_in_packs_match_brute_force(spark, chunked, k, part):
    """Also with questions cut into parts, and a question whose terms do not fit into one."""
    asked = ASKED if part > 100 else ASKED[:-1]  # parts are told by question id
    hits = r.search_chunk_rollup(spark.createDataFrame(asked, "question_id string, question string"), chunked[1], k, broadcast_bytes=part).collect()
    assert sorted(((h.question_id, h.doc_id, h.chunk_no, round(h.score, 5), h["rank"]) for h in hits), key=str) == best_chunks(chunked[2], asked, k)


def test_chunks_scored_some_at_a_time(spark, chunked, monkeypatch):
    """Whatever a task scores at a time, the k best of what it finds are the k best."""
    questions = spark.createDataFrame(ASKED, "question_id string, question string")
    asked = r.embed_questions(questions, chunked[1]).select("question_id", "term", "question_weight").toArrow()
    packs = chunked[1].packs.toArrow().combine_chunks().to_batches()
    for questions_at, chunks_at, products in ((256, 2048, 1 << 21), (2, 7, 1 << 21), (3, 50, 30), (1, 1, 1)):
        monkeypatch.setattr(r, "QUESTIONS_AT_ONCE", questions_at)
        monkeypatch.setattr(r, "CHUNKS_AT_ONCE", chunks_at)
        monkeypatch.setattr(r, "PRODUCTS_AT_ONCE", products)
        best = {}
        for h in pa.Table.from_batches(list(r._scored(asked, 4, iter(packs)))).to_pylist():
            key = h["question_id"], h["doc_id"]
            best[key] = max(best.get(key, (-1, 0)), (h["score"], -h["chunk_no"]))
        got = []
        for q in {q for q, _ in best}:
            ranked = sorted(((-s, d or "", d, -c) for (p, d), (s, c) in best.items() if p == q))[:4]
            got += [(q, d, c, round(-s, 5), rank) for rank, (s, _, d, c) in enumerate(ranked, 1)]
        assert sorted(got, key=str) == best_chunks(chunked[2], ASKED, 4)


def test_an_index_of_chunks_lies_in_packs(spark, chunked, tmp_path):
    """No row per posting is written; the weights in packs are those of each chunk, also with a vocabulary beyond a broadcast."""
    postings, index, units = chunked
    want = {(d, n, t) for (d, n), text in units.items() for t in text.lower().split()}
    assert postings.count() < 10 and index.packs.count() == postings.count() and index.rows == len(want)
    weights = lambda i: sorted((x.doc_id or "", x.chunk_no, x.term, round(x.weight, 9)) for x in r.embed_tfidf(i).collect())
    held = weights(index)
    assert {(d or None, n, t) for d, n, t, _ in held} == want and len(held) == len(want)
    lengths = Counter()
    for d, n, _, w in held:
        lengths[d, n] += w * w
    assert all(abs(x - 1) < 1e-6 for x in lengths.values())
    for limit in (0, 600):
        r._write_packs(postings, index.terms, index.units, index.term_bytes, str(tmp_path / f"packs{limit}"), 2, limit)
        packs = spark.read.schema(index.packs.schema).parquet(str(tmp_path / f"packs{limit}"))
        assert weights(index._replace(weights=packs.mapInArrow(r._unpacked, index.weights.schema))) == held


@pytest.mark.parametrize("most", [1, 900, 1 << 20])
def test_packs_of_any_size_hold_the_counts_of_terms(spark, monkeypatch, most):
    """Units lie whole in one pack, in order, however many batches and rows they come from."""
    monkeypatch.setattr(kb, "PACK_BYTES", most)
    rows = [(f"u{i // 3:02d}", " ".join(f"w{i * j % 17}" for j in range(i % 30))) for i in range(60)]
    found, _ = kb._by_unit(spark.createDataFrame(rows, "doc_id string, content string").coalesce(1), ["doc_id"], "content")
    batches = [b for s in found.toArrow().combine_chunks().to_batches() for b in (s.slice(i, 7) for i in range(0, s.num_rows, 7))]
    want, got, seen = Counter((d, w) for d, t in rows for w in t.split()), {}, []
    for pack in kb._counted(token_characters(spark), kb._joined(iter(batches)), kb._packed, most):
        units, words = pack.column("units")[0].as_py(), pack.column("words")[0].as_py()
        sizes, codes, tf = (np.frombuffer(pack.column(c)[0].as_buffer(), np.int32) for c in ("sizes", "codes", "tf"))
        seen += [u["doc_id"] for u in units]
        assert len(units) == len(sizes) and [w["n"] for w in words] == list(np.bincount(codes))
        for u, c, n in zip(np.repeat([u["doc_id"] for u in units], sizes), codes, tf):
            got[str(u), words[c]["term"]] = n
    assert got == dict(want) and seen == sorted({d for d, _ in want})


# --- vectors ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vectors(spark):
    """Vectors of which a third are equal, so that ties decide."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((90, 8)).round(3)
    x[::3] = x[0]
    data = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(5)
    return x.astype(np.float32).astype(np.float64), frame, frame.withColumnRenamed("vec_id", "question_id")


def brute_vectors(x, k, skip_self=False):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    out = set()
    for q in range(len(x)):
        order = sorted((-s[q, i], i) for i in range(len(x)) if not (skip_self and i == q))[:k]
        out |= {(q, i, round(float(-a), 5), n) for n, (a, i) in enumerate(order, 1)}
    return out


def vrows(hits):
    return {(h["question_id"], h["vec_id"], round(float(h["score"]), 5), h["rank"]) for h in hits.collect()}


@pytest.mark.parametrize("block, vector_block", [(4096, 65536), (20, 30)])
def test_vector_search_matches_brute_force(vectors, block, vector_block):
    x, frame, questions = vectors
    for skip in (False, True):
        hits = r.search_topk_vector(questions, frame, 4, exclude_self=skip, block=block, vector_block=vector_block)
        assert vrows(hits) == brute_vectors(x, 4, skip)


def test_ann_finds_most(vectors):
    _, frame, questions = vectors
    exact = r.search_topk_vector(questions, frame, 3)
    near = r.search_ann_vector(questions, frame, 3, tables=12, bits=3)
    assert near.groupBy("question_id", "vec_id").count().filter("count > 1").isEmpty()
    assert r.ann_recall(near, exact).first()["recall"] > 0.8


# --- tags, feedback, schema documents ----------------------------------------------------


def test_related_documents_match_brute_force(spark):
    rng = np.random.default_rng(1)
    tags = {f"d{i:02d}": (["t0"] if i % 3 == 0 else sorted(set(rng.choice(["t0", "t1", "t2", "t3"], 3)))) for i in range(40)}
    docs = spark.createDataFrame(list(tags.items()), "doc_id string, tags array<string>")
    pool = [d for d in tags if int(d[1:]) % 2 == 0]
    candidates = docs.filter(F.col("doc_id").isin(pool))
    want = set()
    for d, a in tags.items():
        scored = []
        for c in pool:
            both = set(a) & set(tags[c])
            if c != d and both:
                scored.append((-round(len(both) / len(set(a) | set(tags[c])), 6), c))
        want |= {(d, c, -s, n) for n, (s, c) in enumerate(sorted(scored)[:3], 1)}
    got = {tuple(x) for x in r.related_documents(docs, candidates, 3).collect()}
    assert got == want


@pytest.mark.parametrize("k", [1, 2, 5])
def test_related_sets_match_brute_force(spark, k):
    """Tags of very uneven frequency, sets of one to seven tags, tags that only one side knows, and many ties."""
    rng = np.random.default_rng(k)
    names, odds = np.array([f"t{i}" for i in range(30)]), 1 / np.arange(1, 31)
    def draw(more):
        picked = rng.choice(names, rng.integers(1, 7), replace=False, p=odds / odds.sum())
        return sorted({*picked, *rng.choice(more, rng.integers(0, 2))})
    asked = {f"a{i:03d}": draw(["x", "y"]) for i in range(150)}
    offered = {f"o{i:03d}": draw(["u", "v"]) for i in range(200)}
    want = set()
    for a, tags in asked.items():
        scores = [(-round(len({*tags} & {*o}) / len({*tags, *o}), 6), name) for name, o in offered.items() if {*tags} & {*o}]
        want |= {(a, name, -score) for score, name in sorted(scores)[:k]}
    got = r.related_sets(
        spark.createDataFrame(list(asked.items()), "set_id string, tags array<string>"),
        spark.createDataFrame(list(offered.items()), "member string, tags array<string>"),
        k,
    )
    assert {tuple(x) for x in got.select("set_id", "member", "score").collect()} == want


def test_related_pairs_grow_with_the_documents(spark, monkeypatch):
    """Two tags on all documents, one more on each: what is joined grows with the documents, not with their square."""
    pairs, joined = r.suffix_pairs, []

    def counted(nodes, offers):
        joined.append(nodes.join(offers, "tag").count())
        return pairs(nodes, offers)

    monkeypatch.setattr(r, "suffix_pairs", counted)
    for n in (200, 800):
        docs = spark.range(n).select(
            F.format_string("d%04d", "id").alias("doc_id"), F.array(F.lit("all"), F.lit("every"), F.format_string("own%d", "id")).alias("tags")
        )
        rows = r.related_documents(docs, docs, 3).collect()
        assert len(rows) == 3 * n and {x["score"] for x in rows} == {0.5}
        assert {x["related_id"] for x in rows if x["doc_id"] == "d0001"} == {"d0000", "d0002", "d0003"}
        assert sum(joined) <= 2 * n
        joined.clear()


def test_related_documents_without_tags(spark):
    rows = [("a", ["x", None, "x"]), ("b", []), ("c", None), ("d", ["x"]), ("e", ["only here"]), ("f", [None])]
    docs = spark.createDataFrame(rows, "doc_id string, tags array<string>")
    assert {tuple(x) for x in r.related_documents(docs, docs, 2).collect()} == {("a", "d", 1.0, 1), ("d", "a", 1.0, 1)}
    assert r.related_documents(docs, docs.limit(0), 2).isEmpty()


def test_feedback_moves_a_document(spark):
    hits = spark.createDataFrame([("q", "a", 0.5, 1), ("q", "b", 0.48, 2)], "question_id string, doc_id string, score double, rank int")
    log = spark.createDataFrame(
        [(["b"], True)] * 8 + [(["a"], False)] * 8 + [(["a"], None)] * 5, "context_docs array<string>, thumbs_up boolean"
    )
    out = r.feedback_rerank(hits, r.document_prior(log)).orderBy("rank").collect()
    assert [h["doc_id"] for h in out] == ["b", "a"]


def test_schema_questions(spark):
    from lorebase.sources.bindings import business_kb

    columns = r.schema_columns(business_kb(spark))
    counts = {x["table_name"]: x["count"] for x in columns.groupBy("table_name").count().collect()}
    assert counts == {"customers": 9, "orders": 9}
    found = {x["table_name"]: x["matched_names"] for x in r.schema_lookup(columns, "email").collect()}
    assert found == {"customers": "email"}
    assert {x["table_name"] for x in r.schema_lookup(columns, "customer").collect()} == {"customers", "orders"}


def test_schema_answers(spark):
    from lorebase.plans.knowledge import SCHEMA_QUESTIONS
    from lorebase.sources.bindings import business_kb

    nameless = spark.createDataFrame([("loose", "schema", "- box_sizes (INT): Size of the boxes\n")], "doc_id string, doc_type string, content string")
    columns = r.schema_columns(business_kb(spark)).unionByName(r.schema_columns(nameless))
    index = r.open_index(kb.write_postings(r.schema_texts(columns), scratch_path(spark, "postings")))
    more = [("s5", "Boxes?"), ("s6", "What is in it?"), ("s7", None), ("s8", "")]
    questions = spark.createDataFrame(SCHEMA_QUESTIONS + more, "question_id string, question string")
    rows = r.schema_answers(questions, columns, index, 2).orderBy("question_id", "rank", "position").collect()
    by = defaultdict(list)
    for x in rows:
        by[x["question_id"]].append((x["rank"], x["table_name"], x["column_name"], x["column_type"], x["columns_total"]))
    names = lambda q, table: [x[2] for x in by[q] if x[1] == table]
    assert {x[1] for x in by["s1"]} == {"customers", "orders"} and by["s1"][0][:2] == (1, "customers")
    assert by["s2"] == [(1, "customers", "email", "STRING", 9), (1, "customers", "phone", "STRING", 9)][: len(by["s2"])]
    assert len(names("s3", "customers")) == 9 and by["s3"][0][:2] == (1, "customers")
    assert len(names("s4", "orders")) == 9 and by["s4"][0][1::3] == ("orders", 9)
    assert by["s5"] == [(1, "loose", "box_sizes", "INT", 1)]
    assert not {"s6", "s7", "s8"} & set(by)


def test_filter_documents(spark):
    from lorebase.sources.bindings import business_kb

    docs = business_kb(spark)
    names = lambda df: sorted(x["doc_id"] for x in df.collect())
    assert names(r.filter_documents(docs, doc_type="metric")) == ["how_conversion_counts", "how_revenue_counts"]
    assert names(r.filter_documents(docs, table="customers", any_tags=["formula"])) == ["how_conversion_counts"]
    assert names(r.filter_documents(docs, column="order_date")) == ["how_churn_counts", "table_of_orders"]


def test_terms_are_counted_as_texts_pass(spark):
    """Texts are shuffled once, by unit; no aggregation holds the terms of all texts of a task. Units that come several times count together."""
    rows = [(str(i % 70) if i % 50 else None, None if i % 9 == 0 else " ".join(f"w{i * j % 37}" for j in range(i % 40))) for i in range(600)]
    rows += [("hot", f"a b b c{i % 5}") for i in range(300)]
    counts = kb.term_counts(spark.createDataFrame(rows, "doc_id string, content string"), ["doc_id"])
    want = Counter((doc, word) for doc, text in rows for word in (text or "").split())
    for rows_per_batch in ("7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_per_batch)
        got = [((x.doc_id, x.term), x.tf) for x in counts.collect()]
        assert dict(got) == want and len(got) == len(want)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Window [") == 1
    assert kb.term_counts(spark.createDataFrame([], "doc_id string, content string"), ["doc_id"]).count() == 0


@pytest.mark.parametrize("at_once", [1, 40, 1 << 22])
def test_terms_counted_are_those_of_tokens(spark, monkeypatch, at_once):
    """Whatever the script, at the ends of texts, and however texts are cut into batches; no list of tokens is made on the way."""
    monkeypatch.setattr(kb, "COUNTED_BYTES", at_once)
    rng = np.random.default_rng(5)
    signs = list("aB_ .-éßñ—“日本語İΣς😀𝒜𐐀١²½\u0301\n\x001")
    rows = [(str(i % 250), None if i % 17 == 0 else "".join(rng.choice(signs, size=int(rng.integers(0, 40))))) for i in range(300)]
    docs = spark.createDataFrame([*rows, ("ends", "a"), ("ends", "a"), ("next", "é")], "doc_id string, content string")
    words = docs.select("doc_id", F.explode(tokens(F.col("content"))).alias("term"))
    want = {(x.doc_id, x.term): x.n for x in words.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = kb.term_counts(docs, ["doc_id"])
    cut = partial(kb._counted, token_characters(spark))
    sorted_docs = docs.sort("doc_id").coalesce(1).withColumn("_first", F.row_number().over(W.partitionBy("doc_id").orderBy("doc_id")) == 1)
    here = sorted_docs.select("doc_id", "_first", F.lower("content").alias("_text")).toArrow().combine_chunks().to_batches()
    got = pa.Table.from_batches(list(cut(iter(here)))).to_pylist()
    assert {(x["doc_id"], x["term"]): x["tf"] for x in got} == want and len(got) == len(want)
    assert {(x.doc_id, x.term): x.tf for x in counts.collect()} == want
    assert "regexp_extract_all" not in counts._jdf.queryExecution().optimizedPlan().toString()


def test_weights_with_a_vocabulary_beyond_a_broadcast(spark, tmp_path):
    """Postings of frequent terms stay where they are whatever the size of the vocabulary; weights do not depend on it."""
    docs = spark.createDataFrame([(str(i), f"all half{i % 2} some{i % 9} own{i}") for i in range(60)], "doc_id string, content string")
    postings = kb.write_postings(docs, str(tmp_path / "postings"))
    terms = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    size = terms.agg(F.sum(F.expr(r.TERM_BYTES))).first()[0]
    weights = lambda limit: sorted(map(tuple, r._raw_weights(postings, terms, ["doc_id"], 60, size, limit).collect()))
    want = weights(size)
    assert len(want) == 240
    for limit in (0, 150, 800, size - 1):
        assert weights(limit) == want
    assert r._least_df(terms, 150) == 16 and r._least_df(terms, 800) == 4 and r._least_df(terms, 0) > 60


def test_norms_of_texts_without_an_id(spark, tmp_path):
    docs = spark.createDataFrame([(None if i == 7 else str(i), f"all half{i % 2} own{i}") for i in range(40)], "doc_id string, content string")
    r.write_index(kb.write_postings(docs, str(tmp_path / "postings")), str(tmp_path / "index"))
    weights = r.read_index(spark, str(tmp_path / "index")).weights
    lengths = weights.groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n")).collect()
    assert len(lengths) == 40 and all(abs(x.n - 1) < 1e-9 for x in lengths)


def _executed(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_an_index_that_lies_dealt_by_document_is_not_shuffled(spark, tmp_path, monkeypatch):
    """Weights are found, kept and added up where the texts of a document were dealt; also with rare terms beside a broadcast and blocks set aside."""
    docs = [(f"d{i:03d}", "the " * 5 + f"name{i % 20} thing{i % 3} own{i}") for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id string, content string")
    assert kb.parts_of(frame) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(kb, "PART_CHARACTERS", 100)
    assert kb.parts_of(frame) == -(-sum(len(text) for _, text in docs) // 100)
    postings = kb.write_postings(frame.repartition(5, "doc_id"), str(tmp_path / "postings"), None, 5)
    plain, plans = r._dealt_raw_weights, []
    monkeypatch.setattr(r, "_dealt_raw_weights", lambda *a: plain(*a, limit=300))
    write = r.write_dealt
    monkeypatch.setattr(r, "write_dealt", lambda rows, *a: plans.append(_executed(rows)) or write(rows, *a))
    monkeypatch.setattr(r, "FIRST_LOOK", 4)
    r.write_index(postings, str(tmp_path / "index"), None, 5)
    index = r.read_index(spark, str(tmp_path / "index"))
    asked = [("q", "the thing1 name7"), ("p", "the")]
    hits = r.search_topk_text(spark.createDataFrame(asked, "question_id string, question string"), index, 3)
    assert rows(hits) == brute(docs, asked, 3)
    assert "Union" in plans[0] and "Union" in _executed(hits)
    for plan in [*plans, _executed(hits)]:
        assert "hashpartitioning(doc_id" not in plan and "hashpartitioning(dealt_id" not in plan


def test_schema_documents_of_a_table_in_one_file_are_dealt(spark, tmp_path):
    """A table that one task reads is dealt out before its texts are made and taken apart."""
    rows = [(n, f"red bolt {n}", "Brand#1", "TIN") for n in range(50)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    columns = r.schema_columns(bindings.schema_kb(spark, str(tmp_path)))
    stock = columns.filter("table_name LIKE 'stock%'")
    assert stock.count() == 200 and stock.select(F.spark_partition_id()).distinct().count() > 2
