"""Writing, reading, syncing and streaming."""

import datetime as dt
import hashlib
import random
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lorebase.functions.rules import register_rules
from lorebase.operators import metrics as m
from lorebase.operators import usage as u
from lorebase.session import drop_scratch, scratch_path
from lorebase.sources import bindings as b
from lorebase.sources import kb
from lorebase.sources.tables import business_orders, customer_facts, order_facts, read_table
from lorebase.streaming.sync import run_kb_sync
from lorebase.streaming.usage import run_usage_daily


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, content string").withColumn("doc_type", F.lit("x")).withColumn("title", F.col("doc_id"))


def test_documents_get_the_table_schema(spark):
    loaded = kb.load_documents(docs_of(spark, [("a", "x")]))
    assert [f.name for f in loaded.schema] == kb.KB_COLUMNS
    assert [f.dataType for f in loaded.schema] == [f.dataType for f in kb.KB_SCHEMA]
    row = loaded.first()
    assert row["metadata"] == '{"source":"sample"}' and row["tables"] == [] and row["created_at"] is not None


def test_create_append_current(spark):
    spark.sql("DROP TABLE IF EXISTS notes_db.notes")
    path = scratch_path(spark, "notes")
    for _ in range(2):
        kb.create_kb(spark, "notes_db.notes", path)
    assert spark.table("notes_db.notes").columns == kb.KB_COLUMNS
    spark.sql("DROP TABLE notes_db.notes")
    spark.sql("DROP DATABASE notes_db")
    path = scratch_path(spark, "kb")
    old = kb.load_documents(docs_of(spark, [("a", "one"), ("b", "two")]), stamp="2024-01-01")
    kb.write_kb(old, path, seq=0)
    kb.write_kb(kb.new_documents(docs_of(spark, [("a", "three")]), stamp="2024-01-01"), path, seq=1, mode="append")
    kb.write_kb(kb.new_documents(docs_of(spark, [("b", "early")]), stamp="2023-01-01"), path, seq=2, mode="append")
    live = {r["doc_id"]: r["content"] for r in kb.current_documents(kb.read_kb(spark, path)).collect()}
    assert live == {"a": "three", "b": "two"}


def live_terms(spark, path):
    _, postings = kb.live_index(spark, path)
    return {(r["doc_id"], r["term"], r["tf"]) for r in postings.select("doc_id", "term", "tf").collect()}


def test_sync_touches_changes_only(spark):
    path = scratch_path(spark, "index")
    first = docs_of(spark, [("a", "x x y"), ("b", "z"), ("c", "old")])
    assert {r["action"] for r in kb.sync_index(first, path, 0).collect()} == {"insert"}
    assert kb.sync_index(first, path, 1).isEmpty()
    assert not os.path.exists(f"{path.removeprefix('file:')}/postings/segment=sync-1")
    second = docs_of(spark, [("a", "x x y"), ("c", "new"), ("d", "w")])
    plan = {r["doc_id"]: r["action"] for r in kb.sync_index(second, path, 2).collect()}
    assert plan == {"b": "delete", "c": "update", "d": "insert"}
    assert live_terms(spark, path) == {("a", "x", 2), ("a", "y", 1), ("c", "new", 1), ("d", "w", 1)}
    assert kb.sync_index(second, path, 3).isEmpty()
    compact = scratch_path(spark, "compact")
    kb.compact_index(spark, path, compact)
    assert live_terms(spark, compact) == live_terms(spark, path)
    assert kb.sync_index(second, compact, 1).isEmpty()
    kb.sync_index(first, path, 4)
    assert live_terms(spark, path) == {("a", "x", 2), ("a", "y", 1), ("b", "z", 1), ("c", "old", 1)}


def test_stream_sync_takes_new_files_only(spark):
    source, path, progress = (scratch_path(spark, n) for n in ("source", "index", "progress"))
    schema = "doc_id string, content string, updated_at timestamp, seq bigint"
    now = dt.datetime(2024, 1, 1)
    spark.createDataFrame([("a", "x", now, 0), ("a", "x y", now, 1)], schema).coalesce(1).write.parquet(source)
    stream = lambda: spark.readStream.schema(schema).parquet(source)
    run_kb_sync(stream(), path, progress)
    run_kb_sync(stream(), path, progress)
    assert live_terms(spark, path) == {("a", "x", 1), ("a", "y", 1)}
    spark.createDataFrame([("b", "z", now, 0), ("a", "w", now, 2)], schema).coalesce(1).write.mode("append").parquet(source)
    run_kb_sync(stream(), path, progress)
    segments = {r["segment"] for r in spark.read.parquet(f"{path}/docs").select("segment").distinct().collect()}
    assert sorted(s.rsplit("-", 1)[1] for s in segments) == ["0", "1"] and len({s.rsplit("-", 1)[0] for s in segments}) == 1
    assert live_terms(spark, path) == {("a", "w", 1), ("b", "z", 1)}
    late, other = scratch_path(spark, "source"), scratch_path(spark, "progress")
    spark.createDataFrame([("b", "old", dt.datetime(2023, 1, 1), 9), ("c", "v", now, 0)], schema).coalesce(1).write.parquet(late)
    run_kb_sync(spark.readStream.schema(schema).parquet(late), path, other)
    assert live_terms(spark, path) == {("a", "w", 1), ("b", "z", 1), ("c", "v", 1)}


def test_stream_of_one_large_task_is_sorted_in_parts(spark, monkeypatch):
    schema = "doc_id string, content string, updated_at timestamp, seq bigint"
    source, path, progress = (scratch_path(spark, n) for n in ("one-file", "index", "progress"))
    rows = [(str(n), f"word{n} more", dt.datetime(2024, 1, 1), 0) for n in range(200)]
    rows += [("7", f"version{n}", dt.datetime(2024, 1, 2), n) for n in range(300)] + [(None, "nameless", None, None)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
    monkeypatch.setattr(kb, "PART_CHARACTERS", 200)
    run_kb_sync(spark.readStream.schema(schema).parquet(source), path, progress)
    files = [f for _, _, names in os.walk(f"{path}/postings") for f in names if f.endswith(".parquet")]
    assert len(files) > int(spark.conf.get("spark.sql.shuffle.partitions")) * 2
    live, postings = kb.live_index(spark, path)
    want = {(str(n), t) for n in range(200) if n != 7 for t in (f"word{n}", "more")} | {("7", "version299")}
    assert {(r.doc_id, r.term) for r in postings.filter("doc_id is not null").collect()} == want
    assert live.filter("doc_id is not null").count() == 200


def test_sync_that_broke_off_is_run_again(spark, monkeypatch):
    path = scratch_path(spark, "index")
    kb.sync_index(docs_of(spark, [("a", "old"), ("b", "z"), ("c", "x")]), path, 0)
    second = docs_of(spark, [("a", "new"), ("b", "z")])
    write = kb.write_segment

    def breaks(docs, path, segment, sync_no=0, gone=None):
        kb.term_counts(docs, ["doc_id"]).write.mode("overwrite").parquet(f"{path}/postings/segment={segment}")
        raise RuntimeError("lost")

    monkeypatch.setattr(kb, "write_segment", breaks)
    with pytest.raises(RuntimeError):
        kb.sync_index(second, path, 1)
    assert live_terms(spark, path) == {("a", "old", 1), ("b", "z", 1), ("c", "x", 1)}
    monkeypatch.setattr(kb, "write_segment", write)
    for _ in range(2):
        plan = {r["doc_id"]: r["action"] for r in kb.sync_index(second, path, 1).collect()}
        assert plan == {"a": "update", "c": "delete"}
        assert live_terms(spark, path) == {("a", "new", 1), ("b", "z", 1)}


def test_compaction_in_place(spark, monkeypatch):
    path = scratch_path(spark, "index")
    first = docs_of(spark, [("a", "x x y"), ("b", "z"), ("c", "old")])
    second = docs_of(spark, [("a", "x x y"), ("c", "new"), ("d", "w")])
    kb.sync_index(first, path, 0)
    kb.sync_index(second, path, 1)
    now = {("a", "x", 2), ("a", "y", 1), ("c", "new", 1), ("d", "w", 1)}
    assert live_terms(spark, path) == now
    _, opened = kb.live_index(spark, path)

    # It breaks off before the entry is written: the segment does not count, and the compaction is run again.
    frame = spark.createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        kb.compact_in_place(spark, path, 0)
    monkeypatch.undo()
    assert spark.createDataFrame == frame and kb.live_segments(spark, path) == ["sync-0", "sync-1"] and live_terms(spark, path) == now
    assert kb.compact_in_place(spark, path, 0) and not kb.compact_in_place(spark, path, 0)
    assert kb.live_segments(spark, path) == ["compacted-000000000"] and live_terms(spark, path) == now

    # A late version of a deleted document stays outdone, a newer one does not; tables opened before read on.
    late, new = dt.datetime(1960, 1, 1), dt.datetime(2024, 1, 1)
    schema = "doc_id string, content string, updated_at timestamp, seq bigint"
    kb.write_segment(spark.createDataFrame([("b", "late", late, 0), ("a", "q", new, 0)], schema), path, "stream-s-0")
    now = {("a", "q", 1), ("c", "new", 1), ("d", "w", 1)}
    assert live_terms(spark, path) == now
    assert {r["term"] for r in opened.collect()} == {"x", "y", "new", "w"}

    # Of two compactions over the same segments the first counts, and the other may stay or go.
    names = kb.live_segments(spark, path)
    assert kb.compact_in_place(spark, path, 1)
    spark.createDataFrame([(n,) for n in names], "s string").coalesce(1).write.text(f"{path}/compactions/compacted-000000002")
    kb.write_segment(spark.createDataFrame([("z", "wrong", new, 0)], schema), path, "compacted-000000002")
    assert kb.live_segments(spark, path) == ["compacted-000000001"] and live_terms(spark, path) == now
    assert kb.drop_replaced(spark, path) == ["compacted-000000000", "compacted-000000002", "stream-s-0", "sync-0", "sync-1"]
    assert live_terms(spark, path) == now

    # A sync under a number whose segment was folded in is read all the same.
    assert {r["action"] for r in kb.sync_index(first, path, 1).collect()} == {"insert", "update", "delete"}
    assert live_terms(spark, path) == {("a", "x", 2), ("a", "y", 1), ("b", "z", 1), ("c", "old", 1)}


def test_a_sync_reads_the_given_table_once(spark):
    """Also where a document changes, is new or goes; its hash is that of its text."""
    path, read = scratch_path(spark, "index"), spark.sparkContext.accumulator(0)

    def given(rows):
        see = F.udf(lambda text: read.add(1) or text).asNondeterministic()
        return docs_of(spark, rows).withColumn("content", see("content"))

    kb.sync_index(given([("a", "x x y"), ("b", "z"), ("c", "old")]), path, 0)
    assert read.value == 3
    plan = kb.sync_index(given([("a", "x x y"), ("c", "new new"), ("d", "w")]), path, 1)
    assert read.value == 6 and {r["doc_id"]: r["action"] for r in plan.collect()} == {"b": "delete", "c": "update", "d": "insert"}
    assert live_terms(spark, path) == {("a", "x", 2), ("a", "y", 1), ("c", "new", 2), ("d", "w", 1)}
    live, _ = kb.live_index(spark, path)
    assert {(r.doc_id, r.content_hash) for r in live.collect()} == {(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in (("a", "x x y"), ("c", "new new"), ("d", "w"))}


def test_a_sync_of_many_documents_joins_them_where_they_are_dealt(spark, monkeypatch):
    path = scratch_path(spark, "index")
    monkeypatch.setattr(kb, "broadcast_if_few", lambda rows: rows)
    monkeypatch.setattr(kb, "PART_CHARACTERS", 5)
    kb.sync_index(docs_of(spark, [(str(n), f"word{n} more more") for n in range(60)]), path, 0)
    kb.sync_index(docs_of(spark, [(str(n), f"word{n} more" + " more" * (n % 2)) for n in range(10, 70)]), path, 1)
    want = {(str(n), t, f) for n in range(10, 70) for t, f in ((f"word{n}", 1), ("more", 1 + n % 2))}
    assert live_terms(spark, path) == want


def test_postings_of_segments_without_outdated_versions_meet_nothing(spark):
    path = scratch_path(spark, "index")
    kb.sync_index(docs_of(spark, [("a", "x"), ("b", "z")]), path, 0)
    joins = lambda: kb.live_index(spark, path)[1]._jdf.queryExecution().optimizedPlan().toString().count("Join")
    assert joins() == 0
    kb.sync_index(docs_of(spark, [("a", "y"), ("b", "z")]), path, 1)
    assert joins() == 1 and live_terms(spark, path) == {("a", "y", 1), ("b", "z", 1)}


def test_sketches(spark):
    """A small sketch keeps its bounds, days are replaced, and merged days tell what all rows tell."""
    rows, start = [], dt.datetime(2024, 1, 1)
    for i in range(30_000):
        often = i % 3 == 0
        rows.append((i, f"Common {i % 7}?" if often else f"rare {i * 7919 % 20_011}", start + dt.timedelta(hours=i % 96), float((i * 37) % 1000)))
    log = spark.createDataFrame(rows, "id long, question string, timestamp timestamp, response_time_seconds double").repartition(8)
    log = log.unionByName(spark.createDataFrame([(-1, None, start, None), (-2, None, None, 5.0)], log.schema))
    path = scratch_path(spark, "sketches")
    u.write_sketches(log, path, tracked=500, size=200)
    u.write_sketches(log.filter("timestamp < '2024-01-02'"), path, tracked=500, size=200)
    sketches = spark.read.parquet(path)
    assert sketches.agg({"rows": "sum"}).first()[0] == 30_002
    found = u.common_questions_sketched(sketches, 7, tracked=500).collect()
    exact = {r["question"]: r["asked"] for r in u.common_questions(log, 10**6).collect()}
    assert {r["question"] for r in found} == {f"common {i}" for i in range(7)}
    assert all(0 <= r["asked"] - exact[r["question"]] <= r["error_at_most"] for r in found)
    whole = sketches.withColumn("all", F.lit(1))
    got = u.response_percentiles_sketched(whole, "all")
    assert got.first()["responses"] == 30_001 and got.first()["max_time"] == 999
    errors = u.rank_errors(log.withColumn("all", F.lit(1)), got, "all").first()
    assert errors["p50_error"] < 0.04 and errors["p95_error"] < 0.04
    none = scratch_path(spark, "sketches")
    u.write_sketches(log.limit(0), none)
    assert u.response_percentiles_sketched(sketches.limit(0)).count() == 0


def test_stream_usage_equals_batch_for_closed_days(spark, data):
    source, path, progress = (scratch_path(spark, n) for n in ("log", "daily", "progress"))
    log = b.history(spark, data)
    log.select("timestamp", "response_time_seconds", "thumbs_up").repartitionByRange(4, "timestamp").write.parquet(source)
    schema = "timestamp timestamp, response_time_seconds double, thumbs_up boolean"
    run_usage_daily(spark.readStream.schema(schema).parquet(source), path, progress)
    streamed = {r["date"]: tuple(r) for r in spark.read.parquet(path).collect()}
    batch = {r["date"]: tuple(r) for r in u.usage_daily(log).collect()}
    assert streamed == {d: r for d, r in batch.items() if d < max(batch)}


def test_scratch_tables_can_be_dropped(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    drop_scratch(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        drop_scratch(spark, "/elsewhere")


# --- the log ----------------------------------------------------------------------------


def test_history_is_appended_by_day(spark, data):
    path = scratch_path(spark, "history")
    log = b.history(spark, data)
    u.append_history(log, path)
    before = u.read_history(spark, path).count()
    u.append_history(log.limit(10).withColumn("id", F.col("id") + 100000), path)
    assert u.read_history(spark, path).count() == before + 10
    day = u.read_history(spark, path).filter("date = '2024-01-02'")
    assert "PartitionFilters: [isnotnull(date" in day._jdf.queryExecution().executedPlan().toString()


def test_list_and_clear_history(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, i % 2, f"q{i}", "a" * 300, ["x", "y"], t0 + dt.timedelta(hours=i // 4), 1.0, None, "ok") for i in range(12)]
    log = spark.createDataFrame(rows, u.HISTORY_SCHEMA)
    listed = sorted(map(tuple, u.list_history(log).select("user_id", "interaction_no", "id", "context_docs").collect()))
    assert [r[1] for r in listed if r[0] == 1] == [1, 2, 3, 4, 5, 6]
    assert [r[2] for r in listed if r[0] == 1] == [1, 3, 5, 7, 9, 11] and listed[0][3] == "x, y"
    assert u.list_history(log).selectExpr("max(length(answer_preview))").first()[0] == 200
    markers = spark.createDataFrame([(1, t0), (1, t0 + dt.timedelta(hours=1))], "user_id long, cleared_at timestamp")
    kept = {r["id"] for r in u.clear_history(log, markers).collect()}
    assert kept == {0, 2, 4, 6, 8, 10, 9, 11}


def test_percentiles_match_numpy(spark):
    rng = np.random.default_rng(2)
    t0 = dt.datetime(2024, 1, 1)
    values = {d: rng.integers(0, 50, size=n).astype(float) for d, n in enumerate([1, 2, 3, 40, 101])}
    rows = [
        (d * 1000 + i, 1, "q", "a", [], t0 + dt.timedelta(days=d, seconds=i), float(v), None, "ok")
        for d, vs in values.items()
        for i, v in enumerate(vs)
    ]
    got = {r["date"].day - 1: r for r in u.response_percentiles(spark.createDataFrame(rows, u.HISTORY_SCHEMA)).collect()}
    for d, vs in values.items():
        assert got[d]["p50"] == pytest.approx(np.percentile(vs, 50), abs=1e-6)
        assert got[d]["p95"] == pytest.approx(np.percentile(vs, 95), abs=1e-6)
        assert got[d]["max_time"] == vs.max()


def test_cache_hits_and_misses(spark):
    t0 = dt.datetime(2024, 1, 1)
    at = lambda s: t0 + dt.timedelta(seconds=s)
    schema = u.HISTORY_SCHEMA
    log = [
        (1, 1, "What is it?", "old", [], at(0), 1.0, None, "ok"),
        (2, 1, "what  is it", "new", [], at(100), 1.0, None, "ok"),
        (3, 1, "What is it?", "bad", [], at(200), 1.0, None, "failed"),
    ]
    cache = u.cached_answers(spark.createDataFrame(log, schema))
    asked = [("WHAT is it ?", 3699), ("What is it", 3700), ("else", 200), ("what is it", 50)]
    requests = spark.createDataFrame([(i, q, at(s)) for i, (q, s) in enumerate(asked)], "id long, question string, timestamp timestamp")
    answered = u.answer_from_cache(requests, cache)
    assert sorted((r["id"], r["hit"], r["answer"]) for r in answered.collect()) == [
        (0, True, "new"), (1, False, None), (2, False, None), (3, True, "old"),
    ]
    assert {r["id"] for r in u.cache_misses(requests, answered).collect()} == {1, 2}


def test_cache_is_as_of_each_request(spark):
    rnd = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    at = lambda: t0 + dt.timedelta(milliseconds=rnd.randrange(0, 40_000, 50))
    log = [(i, 1, rnd.choice("ab"), f"a{i}", [], at(), 1.0, None, rnd.choice(["ok", "failed"])) for i in range(60)]
    asked = [(i, rnd.choice("abc"), at()) for i in range(200)]
    requests = spark.createDataFrame(asked, "id long, question string, timestamp timestamp")
    got = u.answer_from_cache(requests, u.cached_answers(spark.createDataFrame(log, u.HISTORY_SCHEMA)), ttl_seconds=5)
    want = {}
    for i, question, when in asked:
        old = [(r[5], r[0], r[3]) for r in log if r[8] == "ok" and r[2] == question and r[5] <= when < r[5] + dt.timedelta(seconds=5)]
        want[i] = (bool(old), max(old)[2] if old else None)
    assert {r["id"]: (r["hit"], r["answer"]) for r in got.collect()} == want


def test_profile_keeps_types(spark):
    rows = spark.sql("SELECT 9007199254740993L AS big, 9.00BD AS price, 'x' AS t, array(1) AS xs UNION ALL SELECT 5L, 10.50BD, NULL, array(2)")
    got = {r["column_name"]: (r["nulls"], r["distinct_values"], r["min_value"], r["max_value"]) for r in m.table_profile(rows).collect()}
    assert got["big"] == (0, 2, "5", "9007199254740993") and got["price"] == (0, 2, "9.00", "10.50") and got["t"] == (1, 1, "x", "x")
    assert m.table_profile(rows.filter("false")).count() == 4


def test_quality_counts_equal_results(spark):
    results = lambda rows: spark.createDataFrame(rows, "statement_id long, a long, b string")
    got = results([(1, 1, "x"), (1, 2, "y"), (2, 1, "x"), (3, 1, None)])
    want = results([(1, 2, "y"), (1, 1, "x"), (2, 1, "z"), (3, 1, None), (3, 1, None)])
    runs = spark.createDataFrame([(1, "ok", 1.0), (2, "ok", 3.0), (3, "ok", 2.0), (4, "failed", 2.0)], "statement_id long, status string, response_time_seconds double")
    row = u.sql_quality(got, want, runs).first()
    assert (row["statements"], row["accuracy"], row["success_rate"], row["avg_response_time"]) == (4, 0.25, 0.75, 2.0)


# --- business tables --------------------------------------------------------------------


def test_unused_joins_vanish(spark, data):
    plan = business_orders(spark, data).select("order_id", "order_amount")._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "Join" not in plan
    plan = m.total_revenue(order_facts(spark, data))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "o_orderdate" not in plan


def test_one_row_per_order(spark, data):
    orders = business_orders(spark, data)
    assert orders.count() == read_table(spark, data, "orders").count()
    assert orders.selectExpr("count(distinct order_id)").first()[0] == orders.count()


def test_conversion_of_customers_without_orders(spark):
    customers = spark.createDataFrame([(i, f"c{i}", "s", "r") for i in range(4)], "customer_id long, customer_name string, customer_segment string, region string")
    orders = spark.createDataFrame(
        [(1, 0, dt.date(2024, 1, 1), 5.0, "completed"), (2, 0, dt.date(2024, 1, 2), 5.0, "completed"), (3, 1, dt.date(2024, 1, 3), 5.0, "pending")],
        "order_id long, customer_id long, order_date date, order_amount double, order_status string",
    )
    assert m.conversion_rate(customers, orders).first()["conversion_rate"] == 25.0
    assert m.conversion_rate_literal(customers, orders).first()["conversion_rate"] == 100.0
    status = {r["customer_id"]: r["churn_status"] for r in m.churn_status(customers, orders, "2024-03-31").collect()}
    assert status == {0: "at risk", 1: "at risk", 2: "churned", 3: "churned"}
    status = {r["customer_id"]: r["churn_status"] for r in m.churn_status(customers, orders, "2024-04-01").collect()}
    assert status[0] == "at risk" and m.churn_rate(customers, orders, "2024-04-02").first()["churn_rate"] == 75.0


def test_cost_per_new_customer(spark, data):
    spend = spark.createDataFrame([(dt.date(2001, 7, 1), 100.0)], "month date, spend double")
    trend = m.acquisition_trend(order_facts(spark, data), months=80, spend=spend)
    assert trend.count() == 80
    assert all(r["cost_per_customer"] is None or r["new_customers"] > 0 for r in trend.collect())


def test_rules_in_sql(spark):
    register_rules(spark)
    row = spark.sql("SELECT fiscal_quarter(DATE'2024-05-01') q, fiscal_year(DATE'2024-12-31') y, churn_label(60) a, churn_label(91) b, churn_label(NULL) c, churn_label(59) d").first()
    assert tuple(row) == (2, 2024, "at risk", "churned", "churned", "active")


def test_row_filter_keeps_own_region(spark, data):
    rows = m.row_filter(customer_facts(spark, data), b.entitlements(spark, data), "NATION_7")
    assert rows.select("region").distinct().count() == 1
    assert m.row_filter(customer_facts(spark, data), b.entitlements(spark, data), "nobody").isEmpty()
