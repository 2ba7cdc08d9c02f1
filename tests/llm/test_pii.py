import hashlib
import random
import re

from lorebase.llm import pii
from lorebase.llm.queries import QUERIES
from tests.llm.data import docs, no_docs, odd_docs, tables


def digits(value):
    return re.sub("[^0-9]", "", value)


def luhn(value):
    total = 0
    for i, d in enumerate(reversed(value)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda v: 13 <= len(digits(v)) <= 19 and luhn(digits(v))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(digits(v)) <= 15),
}


def brute(text):
    return [(k, m.start(), m.end()) for k, (p, ok) in KINDS.items() for m in re.finditer(p, text or "") if ok(m.group())]


def test_query(spark, data):
    texts = {d.doc_id: d.text for d in tables(spark, data, "documents")}
    rows = QUERIES["op5_personal_data"](spark, data).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute(texts[r.doc_id])
        told = ",".join(f"{k}:{a}:{z}" for k, a, z in spans)
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest() and r.spans.startswith(told)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in KINDS]


def test_odd_texts(spark):
    rnd = random.Random(5)
    odd = [
        "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "300.1.1.1 001.02.003.255", "5", "4111 1111 1111 1111", "4111-1111-1111-1111 +49 30 1234567", "a@b", "@@a@b.c@d.e",
        "ééééé a@b.co é +123456789012 😀 1.2.3.4", "1" * 70000, "x@y.z " * 3000, "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0", "9" * 400 + ".1.1.1", None, "",
    ]
    odd += ["".join(rnd.choice("a1.@+- 4()_%b0\n") for _ in range(rnd.randint(1, 120))) for _ in range(1500)]
    for r in pii.find_personal_data(docs(spark, odd)).collect():
        assert [(s.kind, s.start, s.end) for s in r.base] == brute(odd[r.doc_id])


def company(seed=1):
    """Six different contexts of one address share a name; forty other documents do not."""
    rnd = random.Random(seed)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda omicron".split()
    some = lambda n: " ".join(rnd.sample(words, n))
    return [f"{some(4)} bob.x@mail.org {some(1)} Zorbakov {some(5)} filler{i}" for i in range(6)] + [some(6) + " filler" for _ in range(40)] + ["Then zorbakov, came"]


def test_terms_that_disclose(spark):
    texts = company()
    frame = docs(spark, texts)
    clean = {r.doc_id: r.text for r in pii.sanitise(frame, pii.find_personal_data(frame)).collect()}
    for i, text in enumerate(texts):
        assert clean[i] == re.sub(r"(?i)zorbakov", "[TERM]", text.replace("bob.x@mail.org", "[EMAIL]"))
    removed = {r.doc_id: r.text for r in pii.sanitise(frame, pii.find_personal_data(frame, remove_at=0.8)).collect()}
    assert removed[46] == "Then , came"
    assert not any(r.added for r in pii.find_personal_data(frame, generalise_at=0.9).collect())


def test_copies_disclose_nothing(spark):
    same = ["alpha beta bob.x@mail.org Zorbakov gamma"] * 20
    assert not any(r.added for r in pii.find_personal_data(docs(spark, same)).collect())


def told(spark, texts):
    """{term: kind} of all terms marked."""
    found = pii.find_personal_data(docs(spark, texts)).collect()
    return {(s.value.lower(), s.kind) for r in found for s in r.added}


def test_copies_hide_nothing(spark):
    """Six texts with name and address; a thousand more copies of one of them change no share."""
    texts = company()[:-1]
    assert told(spark, texts) == told(spark, texts + [texts[0]] * 1000) == {("zorbakov", "removed")}


def test_same_sentence_in_different_texts(spark):
    texts = [f"{t} Contact Zorbakov at bob@x.org {t}" for t in company()[6:-1][:8]] + company()[6:-1]
    assert ("zorbakov", "removed") in told(spark, texts)


def test_name_far_from_value(spark):
    texts = [t.replace("Zorbakov ", "").replace("bob.x", "Zorbakov " + "alpha " * 50 + "bob.x") for t in company()[:-1]]
    assert told(spark, texts) == {("zorbakov", "removed")}


def test_odd_documents(spark):
    given = odd_docs(spark)
    assert pii.find_personal_data(given).count() == given.count()
    kept = pii.sanitise(given, pii.find_personal_data(given))
    assert kept.columns == given.columns and sorted(kept.collect(), key=repr) == sorted(given.collect(), key=repr)
    assert pii.find_personal_data(no_docs(spark)).count() == 0
