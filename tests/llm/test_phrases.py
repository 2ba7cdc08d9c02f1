import random
import re
from collections import Counter

import pytest

from lorebase.llm import phrases
from tests.llm.data import WORDS, no_docs, odd_docs, tables
from tests.llm.test_simhash import UPPER


def brute(docs, least, longest, top):
    counts, totals = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {x: a for x, a in counts.items() if a >= least}
    gone = set()
    for (lang, words), a in found.items():
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                if j - i < len(words) and a >= found[lang, words[i:j]]:
                    gone.add((lang, words[i:j]))
    rows = {}
    for (lang, words), a in found.items():
        if len(words) < 2 or (lang, words) in gone:
            continue
        cuts = [(found[lang, words[:k]], found[lang, words[k:]]) for k in range(1, len(words))]
        score, _, left, right = min((1000 * a * totals[lang] // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
        rows.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return {
        (lang, rank, p.decode(), -a, left, right, totals[lang], -score)
        for lang, xs in rows.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(xs)[:top], 1)
    }


def found(docs, *options, **more):
    rows = phrases.collocations(docs, *options, **more).collect()
    assert len(set(rows)) == len(rows)
    return {tuple(r) for r in rows}


def made(n=150, seed=9):
    rnd = random.Random(seed)
    fixed = ["River stone cloud maple ember", "frost lantern frost lantern frost", "the the the the the the", "É été\tÜber-all 漢字 漢字"]
    rows = []
    for i in range(n):
        text = "".join(rnd.choice([rnd.choice(WORDS[:8]), rnd.choice(fixed)]) + rnd.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(rnd.randint(0, 60)))
        rows.append((rnd.choice(["en", "de", None, "und"]), text))
    return rows


@pytest.mark.parametrize("limit", [32 << 20, 0])
@pytest.mark.parametrize("least, longest, top", [(20, 5, 2000), (5, 4, 7), (3, 2, 50)])
def test_against_brute_force(spark, monkeypatch, limit, least, longest, top):
    """With frequent keys copied to tasks and joined; with tasks that count in small parts and forget words."""
    monkeypatch.setattr(phrases, "COUNTED", 50)
    monkeypatch.setattr(phrases, "KNOWN", 5)
    rows = made()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    want = brute(rows, least, longest, top)
    assert found(docs, least, longest, top, limit=limit) == want
    assert len(want) > 20


def test_tables(spark, data):
    rows = [(d.lang, d.text) for d in tables(spark, data.replace("sf0.001", "sf0.01"), "documents")]
    docs = spark.read.parquet(data.replace("sf0.001", "sf0.01") + "/documents.parquet")
    want = brute(rows, 100, 5, 2000)
    assert len(want) > 50 and found(docs) == want


def test_large_counts_are_exact(spark):
    """A product past 64 bits."""
    levels = [
        spark.createDataFrame([(1, "en", "a", "a", 3 * 10**13, [3 * 10**13], [3 * 10**13])], "key long, lang string, phrase string, last string, a long, heads array<long>, tails array<long>"),
        spark.createDataFrame([(2, "en", "a a", "a", 2 * 10**13 + 1, [3 * 10**13, 2 * 10**13 + 1], [3 * 10**13, 2 * 10**13 + 1], 1, 1)], "key long, lang string, phrase string, last string, a long, heads array<long>, tails array<long>, prefix long, suffix long"),
    ]
    totals = spark.createDataFrame([("en", 10**15 + 7)], "lang string, n long")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(phrases, "frequent_phrases", lambda *_: (levels, totals))
        row = phrases.collocations(no_docs(spark)).first()
    assert row.score == 1000 * (2 * 10**13 + 1) * (10**15 + 7) // (3 * 10**13) ** 2


def test_odd_documents(spark):
    given = odd_docs(spark)
    rows = [(r.lang, r.text) for r in given.collect()]
    want = brute(rows, 2, 5, 100)
    assert found(given, 2, 5, 100) == want and {r[0] for r in want} >= {"und"}
    assert phrases.collocations(no_docs(spark), 1).count() == 0
    assert phrases.collocations(given.filter("text is null"), 1).count() == 0


def test_a_task_holds_few_texts_and_words(spark, monkeypatch):
    """One Python process per task finds words and keeps the frequent ones; it works on some texts at a time and remembers words of all languages together."""
    docs = spark.createDataFrame([(n, f"l{n % 4}", f"one two three w{n}") for n in range(40)], "id long, lang string, text string")
    frequent = spark.createDataFrame([(1,)], "key long")
    plan = phrases._semi_join(phrases.occurrences(docs), frequent, 32 << 20)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    monkeypatch.setattr(phrases, "TEXTS", 8)
    monkeypatch.setattr(phrases, "KNOWN", 8)
    hashed = []
    digest = phrases.xxhash.xxh64_intdigest
    monkeypatch.setattr(phrases.xxhash, "xxh64_intdigest", lambda word, seed: hashed.append(word) or digest(word, seed))
    rows, relation = phrases.occurrences(docs)
    batches = list(relation(iter(rows.toArrow().combine_chunks().to_batches())))
    assert [b.num_rows for b in batches] == [8] * 5
    assert len(hashed) > 40 + 4 * 3  # more than once per word and language, so words were forgotten


def test_a_task_tells_the_parts_of_a_frequent_group_once(spark, monkeypatch):
    """However many texts hold it, and no group that is not frequent; the same parts where keys are joined."""
    monkeypatch.setattr(phrases, "TEXTS", 2)
    monkeypatch.setattr(phrases, "GROUPED", 8)
    docs = spark.createDataFrame([("en", f"to be or not to be x{i}") for i in range(60)], "lang string, text string").repartition(3)
    rows, relation = phrases.occurrences(docs)
    words = rows.mapInArrow(relation, phrases.RELATION).checkpoint()
    frequent = phrases._frequent_groups(words, 50).checkpoint()
    parts = phrases._parts_of_groups(words, frequent, 1 << 20).collect()
    assert frequent.count() == 4 and len(parts) == 3 * 4
    assert set(parts) == set(phrases._parts_of_groups(words, frequent, 0).collect())


def test_parts_of_a_group_are_told_once_of_all_tasks(spark, monkeypatch):
    """Once where it is known which part of the input holds a group, in however many parts it is and however parts are dealt to tasks."""
    monkeypatch.setattr(phrases, "TEXTS", 2)
    docs = spark.createDataFrame([("en", f"to be or not to be x{i}") for i in range(60)], "lang string, text string").repartition(5)
    rows, relation = phrases.occurrences(docs)
    words = rows.mapInArrow(relation, phrases.RELATION).checkpoint()
    frequent = phrases._frequent_groups(words, 50, sourced=True).checkpoint()
    told = phrases._parts_of_groups(words.coalesce(2), frequent, 1 << 20).collect()
    assert frequent.count() == 4 and len(told) == 4
    assert set(told) == set(phrases._parts_of_groups(words, frequent.drop("source"), 1 << 20).collect())
