from collections import Counter, defaultdict

from lorebase.llm.lines import drop_repeated_lines
from tests.llm.data import ODD_SCHEMA, no_docs, odd_docs

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(rows, min_chars, min_docs):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    holders = defaultdict(set)
    low = lambda i: -(2**63) if i is None else i
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(low(doc_id))
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        gone = [len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs and max(holders[key(x)]) != low(doc_id) for x in lines]
        out.append((doc_id, "\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone)))
    return Counter(out)


def check(spark, frame, **limits):
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    got = drop_repeated_lines(frame, **limits)
    assert got.columns == [*frame.columns, "line_counts"]
    found = Counter((r.doc_id, r.text, r.line_counts.n_lines, r.line_counts.n_dropped) for r in got.collect())
    assert found == brute(rows, limits.get("min_chars", 20), limits.get("min_docs", 3))


def test_odd_documents(spark):
    check(spark, odd_docs(spark))
    check(spark, odd_docs(spark), min_chars=0, min_docs=2)
    assert drop_repeated_lines(no_docs(spark)).count() == 0


def test_shared_lines(spark):
    shared, other = "This line stands in many documents", "ANOTHER line that MANY hold"
    texts = [f"\t{shared} \r\nown {i}\n{other.upper() if i % 2 else other}\n{shared}\n" for i in range(30)]
    texts += ["short\n" * 3, "Äußere Zeilen mit mehr als zwanzig", "äußere Zeilen mit mehr als zwanzig", shared, "\n" * 50]
    rows = [(i, t, *[None] * 8) for i, t in enumerate(texts)]
    rows += [(3, texts[3], *[None] * 8), (3, "another text\n" + shared, *[None] * 8), (None, shared, *[None] * 8), (None, other, *[None] * 8)]
    check(spark, spark.createDataFrame(rows, ODD_SCHEMA).repartition(7))
