import random
import re

from lorebase.llm import decontam
from lorebase.llm.queries import QUERIES
from tests.llm.data import WORDS, no_docs, odd_docs, tables

QUESTION = (
    "A farmer named John Smith had 12 apples and gave 5 of them to Mary who walked 3 km to the market in town with her basket of fruit"
)


def found(spark, texts, items):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").selectExpr("*", "1 AS item_id", "'w' AS words", "0 AS version")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string").selectExpr("*", "'x' AS doc_words", "1 AS window")
    return {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs.repartition(3), bench).collect()}


def test_query_finds_all_passages(spark, data):
    docs = {d.doc_id: d.text for d in tables(spark, data, "documents")}
    items = {d.item_id: d.text for d in tables(spark, data, "benchmark")}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op4_decontamination"](spark, data).collect()}
    assert got == {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}


def test_new_numbers_names_and_units(spark):
    texts = {
        1: "Intro here. " + QUESTION + " and more.",
        2: QUESTION.replace("John Smith", "Bob Jones").replace("Mary", "Ann").replace("12", "40").replace("5", "8").replace("3 km", "9 miles"),
        3: QUESTION.lower(),
        4: QUESTION.upper(),
        5: re.sub(r"\s", "\n  ", QUESTION).replace(",", " ; "),
        6: " ".join(QUESTION.split()[8:24]),
        7: " ".join(QUESTION.split()[8:17]),
        8: QUESTION.replace("farmer named", "baker called").replace("apples", "pears").replace("market", "mill").replace("gave", "sold"),
    }
    got = found(spark, texts, {5: QUESTION, 9: QUESTION, 3: "too short", 4: None, 6: ""})
    assert set(got) == {(i, 5) for i in (1, 2, 3, 4, 5, 6)}
    assert got[1, 5].changed == 0 and got[2, 5].changed == 7 and got[1, 5].first_word == 2
    assert got[1, 5].run_words == got[1, 5].item_words == len(QUESTION.split())


def test_slots_must_be_consistent(spark):
    item = "Take 7 boxes from the shelf then put 7 boxes on the cart and bring 4 of them to the gate"
    texts = {1: item.replace("7", "9"), 2: item.replace("7", "9", 1), 3: item.replace("4", "7"), 4: item.replace("7", "5.000").replace("4", "3,5")}
    # Other values in 1 and 4 are consistent; 2 and 3 hold 15 words or more as they are.
    assert set(found(spark, texts, {1: item})) == {(1, 1), (2, 1), (3, 1), (4, 1)}
    # Where only the first 7 changes, the longest stretches without a conflict have 12 and 10 words.
    short = "please take from the old shelf at once 7 boxes and then 7 more to the cart by noon"
    assert set(found(spark, {1: short.replace("7", "9"), 2: short.replace("7", "9", 1)}, {1: short})) == {(1, 1)}


def test_short_items_and_every_offset(spark):
    rnd = random.Random(7)
    items = {i: " ".join(rnd.choice(WORDS) + str(rnd.choice("abcdef")) for _ in range(n)) for i, n in enumerate([7, 8, 9, 12, 13, 14, 30])}
    texts = {
        100 * i + k: " ".join(["lead"] * k + [t] + ["tail"] * 3) for i, t in items.items() for k in range(7)
    }
    assert set(found(spark, texts, items)) == {(100 * i + k, i) for i in items if i > 0 for k in range(7)}


def test_words_of_other_texts_do_not_count(spark):
    rnd = random.Random(8)
    text = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n))
    items = {i: text(30) for i in range(20)}
    assert not found(spark, {i: text(400) for i in range(40)}, items)


def test_odd_documents(spark):
    given = odd_docs(spark)
    items = spark.createDataFrame([(1, r.text) for r in given.filter("doc_id = 1").collect()] + [(None, QUESTION), (2, None)], "item_id long, text string")
    assert {r.doc_id for r in decontam.contaminated(given, items).collect()} == {1, 2, 6, 11}
    assert decontam.contaminated(no_docs(spark), items).count() == 0
    assert decontam.contaminated(given, items.filter("item_id < 0")).count() == 0


def test_verbatim_passages_beside_other_slots(spark):
    """One other value, at the edge or within, hides no passage of 13 words, nor does a longer run elsewhere on the diagonal."""
    item = "Take 7 boxes from the shelf then put 7 boxes on the cart and bring 4 of them to the gate"
    twice = "we send 3 red ones by the late train and then they count " + "3 blue ones at dawn before noon and go home along the river bank again"
    numbers = " ".join(str(n) for n in range(100, 120))
    cut = item.split()
    long = "one 3 two four five six seven 3 eight nine ten eleven twelve dozen score gross split " + " ".join(f"word{c}" for c in "abcdefghijklm")
    texts = {
        1: item.replace("7", "9", 1), 2: item.replace("4", "7"), 3: twice.replace("3", "5", 1), 4: "so " + numbers + " end",
        5: " ".join([*cut[:3], "x", *cut[4:]]).replace("7", "9", 1), 6: "Take 9 boxes from the shelf then put 7 boxes on a cart",
        7: long.replace("3", "5", 1).replace("split", "other").replace("dozen", "pair"), 8: long.replace("3", "5", 1).replace("split", "other"),
    }
    got = found(spark, texts, {1: item, 2: twice, 3: numbers, 4: long})
    assert set(got) == {(1, 1), (2, 1), (3, 2), (4, 3), (5, 1), (7, 4), (8, 4)}
    assert (got[1, 1].run_words, got[1, 1].first_word, got[1, 1].changed) == (19, 2, 0)
    assert (got[2, 1].run_words, got[2, 1].changed) == (21, 1)
    assert got[4, 3].run_words == got[4, 3].slots == 20
