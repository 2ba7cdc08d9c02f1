import random
import re
import zlib
from collections import Counter

from lorebase.llm import queries, spelling
from tests.llm.data import no_docs, odd_docs, tables


def one_edit(a, b):
    """Whether b is a with one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute(words, factor=10):
    near = {w: [] for w in words}
    by_rest = {}
    for w in words:  # words one edit apart are equal after a deletion from one or both
        for rest in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            by_rest.setdefault(rest, []).append(w)
    for group in by_rest.values():
        for a in group:
            near[a] += [b for b in group if one_edit(a, b)]
    out, form = {}, {}
    for w, found in near.items():
        best = min(set(found), key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= factor * words[w] else None
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (words[w], len(set(near[w])), form[w], words[form[w]] if form[w] else None, root)
    return out


def found(spark, words, **options):
    given = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    rows = spelling.spelling_variants(given, **options).collect()
    assert len(rows) == len(words)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


def edits(rnd, word, letters):
    i = rnd.randrange(len(word))
    return rnd.choice([word[:i] + word[i + 1 :], word[:i] + rnd.choice(letters) + word[i:], word[:i] + rnd.choice(letters) + word[i + 1 :]])


def test_against_brute_force(spark):
    """Words of few letters, so that bigrams repeat within a word, and their variants; chains of forms; a long word."""
    rnd = random.Random(4)
    words = {}
    for letters in ("ab", "abc", "aeinrstéü", "abcdefghijklmnopqrstuvwxyz"):
        for _ in range(120):
            word = "".join(rnd.choice(letters) for _ in range(rnd.randint(7, 12)))
            for n in (5000, 480, 30, 3, 3):
                if len(word) >= 4:
                    words[word] = rnd.choice([n, n, 10 * n])
                word = edits(rnd, word, letters)
    words |= {"z" * 9: 7, "z" * 10: 70, "z" * 11: 700, "z" * 12: 7000, "x" * 500 + "y" + "x" * 500: 20, "x" * 1000: 2}
    want = brute(words)
    assert found(spark, words) == want
    assert sum(w[1] for w in want.values()) > 1000 and want["z" * 9][4] == "z" * 12 and want["x" * 1000][3] == 20
    assert found(spark, words, factor=1_000) == brute(words, 1_000)


def test_pivots_are_disjoint_and_cheapest(spark):
    words = spark.createDataFrame([("aabcabcz", 1), ("zbcaabca", 1), ("bcabcabc", 1), ("cabcabca", 1)], "word string, n long")
    for r in spelling.pivotal_grams(words).collect():
        first = sorted(r.prefix)[:3]
        pairs = [x.df + y.df for x in first for y in first if y.at - x.at > 1]
        one, two = r.pivots
        assert two.at - one.at > 1 and one.df + two.df == min(pairs) and one in first and two in first


def noisy(docs):
    counts = Counter()
    for d in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", d.text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d.doc_id is None else d.doc_id}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_query(spark, data):
    words = noisy(tables(spark, data, "documents"))
    got = queries.QUERIES["op12_spelling_variants"](spark, data)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got.collect()} == brute(words)


def test_odd_rows(spark):
    given = odd_docs(spark)
    words = noisy(given.collect())
    assert {r.word: r.n for r in queries.noisy_words(given).collect()} == words
    assert queries.noisy_words(no_docs(spark)).count() == 0
    rows = [(None, 5, "x"), ("null", None, "x"), ("", 3, None), ("ab", 4, None), ("abc", 4, "x"), ("naïves", 40, "x"), ("naives", 4, "x")]
    got = spelling.spelling_variants(spark.createDataFrame(rows, "word string, n int, root string")).collect()
    assert {(r.word, r.n_near, r.form, r.root) for r in got} == {
        ("", 0, None, ""), ("ab", 0, None, "ab"), ("abc", 0, None, "abc"), ("naïves", 1, None, "naïves"), ("naives", 1, "naïves", "naïves"),
    }
    assert spelling.spelling_variants(spark.createDataFrame([], "word string, n long")).count() == 0
