"""Small tables with every kind of odd row."""

from __future__ import annotations

import random

ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id long, version long, words string, h1 long"
WORDS = "river stone cloud maple ember frost lantern meadow harbor copper violet cedar thunder willow saffron".split()


def sentence(seed: int, words: int = 40) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) for _ in range(words)).capitalize() + "."


def odd_rows() -> list[tuple]:
    """Nulls in all columns, empty and blank texts, a long one, repeated rows, copies, and columns with names used inside."""
    long = " ".join(sentence(i) for i in range(3000))
    texts = [
        (1, sentence(1)), (2, sentence(1)), (3, None), (4, ""), (5, " \n\t "), (6, long), (7, sentence(7)), (7, sentence(7)),
        (8, "é ü 漢字 😀 " + sentence(8)), (None, sentence(9)), (None, None), (9, "0123 4567 !!"), (10, "a"), (11, sentence(1) + " Extra"),
    ]
    return [(i, t, None if n % 5 == 0 else "en" if n % 2 else "de", None, None, "row", n, None, "w", 1) for n, (i, t) in enumerate(texts)]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), ODD_SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


def docs(spark, texts, parts: int = 3):
    rows = list(texts.items()) if isinstance(texts, dict) else list(enumerate(texts))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


def tables(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet").collect()
