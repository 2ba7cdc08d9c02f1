import math
import random

from pyspark.sql import functions as F

from lorebase.llm import nearest as n

SCHEMA = "vec_id long, embedding array<double>, label int, id long, tile string, score double"


def product(a, b):
    total = 0.0  # sum() would carry the rounding along
    for x, y in zip(a, b):
        total += x * y
    return total


def brute(rows, k):
    usable = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in usable:
        if q % 20 == 0:
            pairs = [(-product(a, b), i) for i, b in usable if i != q and len(a) == len(b)]
            out[q] = [(i, -s) for s, i in sorted(pairs)[:k]]
    return {q: best for q, best in out.items() if best}


def check(spark, rows, k=20, parts=4):
    frame = spark.createDataFrame([(i, v, 1, 5, "t", 0.5) for i, v in rows], SCHEMA).repartition(parts)
    got = {}
    for r in n.nearest(frame, F.col("vec_id") % 20 == 0, k).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    assert got == brute(rows, k)


def vector(rnd, dims=8):
    return [rnd.gauss(0, 1) for _ in range(dims)]


def test_same_as_brute_force(spark, monkeypatch):
    monkeypatch.setattr(n, "TILE", 16)
    monkeypatch.setattr(n, "QUERIES", 16)
    rnd = random.Random(1)
    hot = vector(rnd)
    rows = [(i, hot if rnd.random() < 0.3 else vector(rnd)) for i in range(500)]
    check(spark, rows, 7)


def test_vectors_that_take_no_part(spark):
    rnd = random.Random(2)
    rows = [(i, vector(rnd)) for i in range(25)]
    rows += [(40, None), (60, [0.0] * 8), (80, [float("nan")] + [1.0] * 7), (100, [None] + [1.0] * 7), (120, [float("inf")] + [1.0] * 7), (140, []), (None, vector(rnd))]
    rows += [(160, vector(rnd, 3)), (161, vector(rnd, 3)), (180, vector(rnd, 5)), (200, [1e-300] * 8), (220, [1e150] * 8)]
    check(spark, rows)
    check(spark, rows[:5], 20)


def test_nothing(spark):
    assert n.nearest(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
