import re

import pytest
from pyspark.sql import functions as F

from lorebase.functions import text as t
from lorebase.operators import ask, guard
from lorebase.operators.retrieval import open_index
from lorebase.session import scratch_path
from lorebase.sources import kb
from lorebase.sources.bindings import business_kb
from lorebase.sources.notes import BUSINESS_QUESTIONS
from lorebase.sources.tables import register_business_views


def value(spark, column, text):
    return spark.createDataFrame([(text,)], "x string").select(column(F.col("x"))).first()[0]


# --- extraction -------------------------------------------------------------------------

CASES = [
    # answer, our rule, plain rule
    ("Look:\n```sql\nSELECT 1\n```\nDone.", "SELECT 1", "SELECT 1"),
    ("SELECT a FROM t;\n\nThat is all.", "SELECT a FROM t;", "SELECT a FROM t;"),
    ("You can select one of these.\n\nSELECT b FROM t", "SELECT b FROM t", "select one of these."),
    ("```\nWITH x AS (SELECT 1 AS a)\n\nSELECT a FROM x\n```", "WITH x AS (SELECT 1 AS a)\n\nSELECT a FROM x", "SELECT 1 AS a)"),
    ("Straße und SELECT 2", "SELECT 2", "SELECT 2"),
    ("Nothing here", "", ""),
    ("", "", ""),
    ("with tea\n select lower\nfrom t  ", "with tea\n select lower\nfrom t", "select lower\nfrom t"),
    ("```python\nprint(1)\n```\n```sql\nselect 3\n```", "select 3", "select 3"),
]


@pytest.mark.parametrize("answer, ours, plain", CASES)
def test_extraction(spark, answer, ours, plain):
    assert value(spark, t.extract_sql, answer) == ours
    assert value(spark, t.cut_answer_literal, answer) == plain


@pytest.mark.parametrize(
    "sql, capped",
    [
        ("SELECT 1", "SELECT 1 LIMIT 100"),
        ("SELECT 1 ; \n", "SELECT 1 LIMIT 100"),
        ("SELECT credit_limit FROM t", "SELECT credit_limit FROM t LIMIT 100"),
        ("SELECT * FROM (SELECT 1 LIMIT 3) x", "SELECT * FROM (SELECT 1 LIMIT 3) x LIMIT 100"),
        ("SELECT 1 limit 7;", "SELECT 1 limit 7;"),
        ("SELECT 1 -- note", "SELECT 1 LIMIT 100"),
        ("SELECT 1 LIMIT 5 -- c", "SELECT 1 LIMIT 5 -- c"),
        ("SELECT 1 LIMIT 5 OFFSET 10", "SELECT 1 LIMIT 5 OFFSET 10"),
        ("SELECT 1 OFFSET 10;", "SELECT 1 LIMIT 100 OFFSET 10"),
        ("SELECT '-- limit 5' AS t", "SELECT '-- limit 5' AS t LIMIT 100"),
        ("SELECT 1 /* limit 5 */", "SELECT 1 LIMIT 100"),
    ],
)
def test_row_cap(spark, sql, capped):
    assert value(spark, t.cap_rows, sql) == capped


@pytest.mark.parametrize(
    "sql, names",
    [
        ("SELECT 1 FROM a JOIN b.c ON true", ["a", "b.c"]),
        ("WITH x AS (SELECT * FROM a) SELECT * FROM x", ["a"]),
        ("SELECT extract(year FROM d) FROM a", ["a"]),
        ("SELECT 1", []),
        ("SELECT 1 FROM a x, `b`.`c` AS y, d WHERE x.i = 'from e' -- from f", ["a", "b.c", "d"]),
        ("SELECT a IS DISTINCT FROM b FROM t", ["t"]),
        ("SELECT * FROM (SELECT 1 FROM a) s, secret", ["a","secret"]),
        ("SELECT * FROM a JOIN b ON a.x = b.x, c", ["a","b","c"]),
        ("SELECT * FROM a, LATERAL (SELECT 1 FROM q WHERE q.i = a.i) z, w", ["a","q","w"]),
        ("SELECT * FROM a, LATERAL explode(a.b) t, c", ["a","c"]),
        ("SELECT * FROM a LATERAL VIEW explode(split(a.b, ',')) t AS u WHERE u IN (SELECT v FROM w)", ["a","w"]),
        ("WITH t AS (SELECT * FROM t) SELECT * FROM t", ["t"]),
        ("WITH x AS (WITH y AS (SELECT * FROM a) SELECT * FROM y JOIN b USING (i)), z AS (SELECT * FROM x, y) SELECT * FROM x JOIN z ON x.i = z.i, d", ["a","b","d","y"]),
        ("SELECT * FROM ((a JOIN b ON a.i = (b.i + 1))), c", ["a","b","c"]),
        ("SELECT * FROM (a) x, ((b)) y", ["a","b"]),
        ("SELECT * FROM range(10) r, c", ["c"]),
        ("SELECT * FROM VALUES (1), (2) AS v(i) JOIN c ON true", ["c"]),
        ("(SELECT 1 FROM a) UNION ALL (SELECT 2 FROM b) UNION TABLE c", ["a","b","c"]),
        ("TABLE a", ["a"]),
        ("FROM a, b SELECT 1", ["a","b"]),
        ("SELECT (SELECT max(i) FROM b), trim(BOTH 'x' FROM c) FROM a ORDER BY (SELECT 1 FROM d)", ["a","b","d"]),
        ("SELECT sum(i) OVER secret FROM secret WINDOW secret AS (ORDER BY i)", ["secret"]),
        ("SELECT * FROM a WHERE EXISTS (SELECT 1 FROM b WHERE b.i IN (SELECT i FROM c)) AND a.from_day > 3", ["a","b","c"]),
        ("SELECT * FROM a LEFT JOIN (SELECT i, count(*) AS n FROM b GROUP BY i) g ON a.i = g.i AND a.j IN (1, 2), c", ["a","b","c"]),
        ("SELECT * FROM a JOIN b ON a.order = b.order, c", ["a","b","c"]),
        ("WITH RECURSIVE r(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM r JOIN a ON true) SELECT * FROM r", ["a"]),
        ("SELECT * FROM " + "(SELECT * FROM "*40 + "a" + ")"*40 + ", b", ["a","b"]),
        ("SELECT ((1) FROM a", ["a"]),
        ("", []), (None, None),
        ("SELECT " + "("*300 + "1" + ")"*300, ["?"]),
        ("SELECT CAST(a AS string) FROM t TABLESAMPLE (10 PERCENT) x, u PIVOT (sum(i) FOR j IN (1, 2))", ["t","u"]),
        ("FROM a |> JOIN b USING (i) |> WHERE i > 1", ["a","b"]),
    ],
)
def test_named_tables(spark, sql, names):
    assert value(spark, t.named_tables, sql) == names
    # Spark's own parser names the same tables, and those that WITH defines.
    if sql and names != [t.TOO_DEEP] and "((1) FROM" not in sql:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString()
        relations = {n.replace(", ", ".") for n in re.findall(r"'UnresolvedRelation \[([^\]]*)\]", plan)}
        assert set(names) <= relations
        assert "WITH" in sql or set(names) == relations


def test_masking(spark):
    text = "Write to a.b+c@mail.example.com or 10.0.0.1, call +1 (555) 123-4567 or 555-123-4567."
    assert value(spark, t.mask_pii, text) == "Write to [EMAIL] or [IP], call [PHONE] or [PHONE]."
    assert value(spark, t.mask_pii, "+49 30 1234567, 5551234567 and 2001:db8::8a2e:370:7334") == "[PHONE], [NUMBER] and [IP]"
    assert value(spark, t.mask_pii, "a" * 70 + "@b.com, c@d.co-e@f.org") == "[EMAIL], [EMAIL][EMAIL]"


def test_odd_texts_stay_cheap(spark):
    gap = " " * 300000
    assert value(spark, t.strip_space, f" a{gap}b \n") == f"a{gap}b"
    assert value(spark, t.strip_semicolon, f"a{gap};b ;; ") == f"a{gap};b"
    assert value(spark, t.normal_question, "So?" + "?" * 100000 + " x ?!") == "so?" + "?" * 100000 + " x"
    assert value(spark, t.mask_pii, "a@" + "b." * 20000) is not None
    assert value(spark, t.mask_pii, "a" * 300000) == "a" * 300000


# --- guard ------------------------------------------------------------------------------


@pytest.fixture()
def stock(spark):
    path = scratch_path(spark, "stock")
    spark.range(250).select(F.col("id"), (F.col("id") % 7).alias("v")).write.parquet(path)
    spark.sql("DROP TABLE IF EXISTS guarded_stock")
    spark.sql(f"CREATE TABLE guarded_stock USING parquet LOCATION '{path}'")
    yield path
    spark.sql("DROP TABLE IF EXISTS guarded_stock")


REFUSED = [
    "DROP TABLE guarded_stock",
    "SELECT 1; DROP TABLE guarded_stock",
    "SELECT 1) t; DROP TABLE guarded_stock; --",
    "WITH s AS (SELECT 1L AS id, 2L AS v) INSERT INTO guarded_stock SELECT * FROM s",
    "FROM guarded_stock INSERT INTO guarded_stock SELECT *",
    "INSERT INTO guarded_stock VALUES (1, 2)",
    "TRUNCATE TABLE guarded_stock",
    "BEGIN SELECT 1; END",
    "EXECUTE IMMEDIATE 'DROP TABLE guarded_stock'",
    "CLEAR CACHE",
    "SHOW TABLES",
    "SET x=1",
    "SELECT reflect('java.lang.System', 'getProperty', 'user.home')",
    "SELECT `reflect`('java.lang.System', 'getProperty', 'user.home')",
    "SELECT java_method('java.lang.System', 'nanoTime')",
    "SELECT 1 -- '\n, reflect('java.lang.System', 'getProperty', 'user.home')",
    "SELECT 1 /* ' */, reflect('java.lang.System', 'getProperty', 'user.home')",
    "SELECT r'\\', reflect('java.lang.System', 'getProperty', 'user.home')",
    "SELECT IDENTIFIER('ref' || 'lect')('java.lang.System', 'getProperty', 'user.home')",
    "SELECT `a` AS `it's`, reflect('java.lang.System', 'nanoTime') FROM (SELECT 1 AS a)",
    "SELECT * FROM no_such_table",
    "SELECT nothing FROM guarded_stock",
]


@pytest.mark.parametrize("sql", REFUSED)
def test_refused(spark, stock, sql):
    run = guard.execute_query(spark, sql)
    assert run.status in ("rejected", "failed") and run.result is None and run.reason
    assert spark.table("guarded_stock").count() == 250


def test_files_are_no_tables(spark, stock):
    run = guard.execute_query(spark, f"SELECT * FROM parquet.`{stock}`")
    assert run.status == "rejected"
    run = guard.execute_query(spark, f"SELECT * FROM guarded_stock, /* */ parquet /* */ . `{stock}`")
    assert run.status in ("rejected", "failed")
    assert spark.conf.get("spark.sql.runSQLOnFiles") == "true"


@pytest.mark.parametrize(
    "sql, rows",
    [
        ("SELECT id FROM guarded_stock", 100),
        ("SELECT id FROM guarded_stock LIMIT 3;", 3),
        ("WITH x AS (SELECT id FROM guarded_stock WHERE v = 0) SELECT count(*) AS n FROM x -- drop table x", 1),
        ("TABLE guarded_stock", 100),
        ("SELECT 'a; drop table b' AS text", 1),
        ("SELECT 1 AS a, 2 AS a", 1),
        ("(SELECT id FROM guarded_stock LIMIT 2) UNION ALL SELECT 1", 3),
    ],
)
def test_accepted(spark, stock, sql, rows):
    run = guard.execute_query(spark, sql)
    assert (run.status, run.reason) == ("ok", None)
    assert run.result.count() == rows


def test_long_texts_are_screened(spark):
    for body in ("x" * 200000, "\\'" * 50000, "''" * 50000, "; -- " * 30000):
        assert value(spark, guard.screen, f"SELECT '{body}' AS a") == "ok"
    assert value(spark, guard.screen, "SELECT \"it's; fine\" AS a") == "ok"
    assert value(spark, guard.screen, "SELECT 1 -- it's\n; DROP TABLE t") == "several_statements"


def test_order_survives(spark, stock):
    run = guard.execute_query(spark, "SELECT id FROM guarded_stock ORDER BY id DESC", limit=5)
    assert [r["id"] for r in run.result.collect()] == [249, 248, 247, 246, 245]


def test_blank_is_no_sql(spark):
    assert guard.execute_query(spark, "  ;\n").status == "no_sql"
    assert guard.execute_query(spark, None).status == "no_sql"


# --- the whole way ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def small(spark):
    docs = business_kb(spark)
    return docs, open_index(kb.write_postings(docs, scratch_path(spark, "postings")))


def questions_of(spark, rows=None):
    return spark.createDataFrame(rows or BUSINESS_QUESTIONS, "question_id string, question string")


def test_ask_batch(spark, small):
    docs, index = small
    asked = questions_of(spark, [*BUSINESS_QUESTIONS, ("q8", "zzz")])
    answers = {r["question_id"]: r for r in ask.ask_batch(asked, docs, index).collect()}
    assert set(answers) == {"q1", "q2", "q3", "q4", "q5", "q6", "q8"}
    assert answers["q1"]["answer_doc"] == "how_revenue_counts"
    assert answers["q2"]["answer_doc"] == "ask_best_customers"
    assert answers["q8"]["status"] == "no_context" and answers["q8"]["answer"] == ""
    assert 1 <= len(answers["q1"]["context_docs"]) <= 5


def test_context_and_prompt(spark, small):
    docs, index = small
    asked = questions_of(spark, [("a", "When does the fiscal year begin?"), ("b", "zzz")])
    found = ask.retrieve_context(asked, docs, index, k=1)
    rows = {r["question_id"]: r for r in ask.build_prompt(ask.assemble_context(asked, found)).collect()}
    assert rows["a"]["context"].startswith("Document: The fiscal year begins in January\nType: business_logic\nThe fiscal")
    assert rows["b"]["context"] == "" and rows["b"]["context_docs"] == []
    assert rows["a"]["question"] in rows["a"]["prompt"] and rows["a"]["context"] in rows["a"]["prompt"]
    assert ask.context_optional(asked, found, False).columns == ["question_id", "question"]
    listed = {r["question_id"]: r["context"] for r in ask.context_optional(asked, found, True).collect()}
    assert listed["b"] is None and listed["a"][0]["doc_id"] == "when_the_year_turns"


def test_ask_and_execute(spark, small, data):
    register_business_views(spark, data)
    docs, index = small
    runs = {a["question_id"]: (a, run) for a, run in ask.ask_and_execute(questions_of(spark), docs, index)}
    assert runs["q2"][1].status == "ok" and runs["q2"][1].result.count() == 10
    assert runs["q5"][1].result.first()["conversion_rate"] > 0
    assert runs["q6"][1].status in ("ok", "no_sql")


def test_generator_failure_is_a_status(spark):
    prompts = spark.createDataFrame([("a", "x", "p")], "question_id string, question string, prompt string")

    def fail(batch):
        raise RuntimeError("no model")

    assert ask.answer_with(prompts, fail).first()["status"] == "failed"
    assert ask.answer_with(prompts, lambda batch: batch.str.upper()).first()["answer"] == "P"


def test_grounding(spark):
    held = spark.createDataFrame(
        [("SELECT * FROM Orders", ["orders"]), ("SELECT * FROM pay JOIN orders ON true", ["orders"]), ("SELECT 1 FROM x", None)],
        "sql string, tables array<string>",
    )
    assert [r["violations"] for r in ask.sql_grounding(held).collect()] == [[], ["pay"], ["x"]]


def test_every_question_gets_an_outcome(spark, stock):
    notes = [
        ("good", "good numbers: SELECT v, count(*) AS n FROM guarded_stock GROUP BY v"),
        ("bad", "bad habits: SELECT reflect('java.lang.System', 'nanoTime') FROM guarded_stock"),
        ("broken", "broken pieces: SELECT raise_error('x') FROM guarded_stock"),
        ("lost", "lost columns: SELECT nothing FROM guarded_stock"),
        ("plain", "plain words without a statement"),
    ]
    docs = kb.load_documents(spark.createDataFrame([(d, "t", d, c) for d, c in notes], "doc_id string, doc_type string, title string, content string"))
    index = open_index(kb.write_postings(docs, scratch_path(spark, "postings")))
    asked = questions_of(spark, [(d, c.split(":")[0]) for d, c in notes] + [("good2", "good numbers"), ("none", "zzz"), ("blank", " ")])
    got = {row["question_id"]: row for row in ask.execute_answers(asked, docs, index, k=1).collect()}
    status = {q: row["status"] for q, row in got.items()}
    assert status == {
        "good": "ok", "good2": "ok", "bad": "rejected", "broken": "failed", "lost": "failed", "plain": "no_sql", "none": "no_context",
    }
    assert got["good"]["rows"] == 7 and got["good"]["checksum"] == got["good2"]["checksum"] is not None


def test_columns_may_be_named_like_commands(spark):
    said = lambda sql: spark.range(1).select(guard.screen(F.lit(sql))).first()[0]
    assert said("SELECT drop FROM t") == said("SELECT create AS x, alter y FROM t") == "ok"
    assert said("WITH x AS (SELECT 1) DROP TABLE t") == said("SELECT 1 FROM (CREATE OR REPLACE TEMPORARY VIEW v AS SELECT 1)") == "writes"
    assert guard.execute_query(spark, "SELECT * FROM (TRUNCATE t)").status != "ok"


def test_log_takes_a_batch_once(spark):
    import datetime as dt

    from lorebase.operators import usage as u

    docs = business_kb(spark)
    index = open_index(kb.write_postings(docs, scratch_path(spark, "postings")))
    log = scratch_path(spark, "asked")
    t0 = dt.datetime(2024, 3, 1)
    schema = "id long, user_id long, question string, timestamp timestamp"
    ask_at = lambda name, *rows: ask.ask_logged(
        spark.createDataFrame([(i, 1, q, t0 + dt.timedelta(minutes=m)) for i, q, m in rows], schema), docs, index, log, name
    )
    question = "How is revenue counted?"
    assert u.read_batches(spark, log).isEmpty()
    # A try that broke off has left rows, and no entry among the commits.
    u.read_batches(spark, log).drop("batch").write.parquet(f"{log}/rows/batch=one")
    assert ask_at("one", (1, question, 0), (2, question.upper(), 0), (3, "", 0), (4, None, 0), (5, "xyzzy", 0))
    assert not ask_at("one", (1, question, 0))
    # The answer is repeated within the hour; what was repeated does not start a new hour.
    assert ask_at("two", (11, "how is  revenue counted", 59), (12, "xyzzy", 59))
    assert ask_at("three", (21, question, 61))
    rows = {x["id"]: x for x in u.read_batches(spark, log).collect()}
    assert {i: x["status"] for i, x in rows.items()} == {
        1: "ok", 2: "ok", 3: "no_question", 4: "no_question", 5: "no_context", 11: "cached", 12: "no_context", 21: "ok"
    }
    assert len({rows[i]["answer"] for i in (1, 2, 11, 21)}) == 1 and rows[1]["context_docs"][0] == "how_revenue_counts"
    assert all(x["response_time_seconds"] > 0 for x in rows.values())
    u.read_batches(spark, log).drop("batch").limit(1).write.parquet(f"{log}/rows/batch=broken")
    assert u.read_batches(spark, log).count() == 8
    with pytest.raises(ValueError):
        ask_at("no/path")


def test_questions_follow_their_thread(spark):
    import datetime as dt

    from lorebase.operators import usage as u

    t0 = dt.datetime(2024, 3, 1)
    at = lambda m: t0 + dt.timedelta(minutes=m)
    old = [(1, 7, "q1", "a", [], at(0), 1.0, None, "ok"), (2, 7, "asked: q2", "a", [], at(1), 1.0, None, "ok"), (3, 8, "other", "a", [], at(2), 1.0, None, "ok")]
    now = [(4, 7, "q3", at(3)), (5, 7, None, at(4)), (6, 9, "alone", at(4))]
    threads = ask.threaded_questions(
        spark.createDataFrame(now, "id long, user_id long, question string, timestamp timestamp"), spark.createDataFrame(old, u.HISTORY_SCHEMA), 2
    )
    assert {x["id"]: x["question"] for x in threads.collect()} == {4: "q1\nasked: q2\nq3", 5: "asked: q2\nq3\n", 6: "alone"}


def test_quality_of_statements_that_run(spark):
    from lorebase.operators import usage as u

    spark.range(5).selectExpr("id", "id % 2 AS odd").createOrReplaceTempView("quality_numbers")
    right, empty = "SELECT odd, count(*) AS n FROM quality_numbers GROUP BY odd", "SELECT id FROM quality_numbers WHERE id > 9"
    answers = [
        ("1", "a", right),
        ("2", "a", "SELECT odd AS x, count(id) FROM quality_numbers GROUP BY odd ORDER BY x DESC"),
        ("3", "a", "SELECT odd, count(*) + 1 AS n FROM quality_numbers GROUP BY odd"),
        ("4", "a", "SELECT nothing FROM quality_numbers"),
        ("5", "a", "SELECT id DIV (id - id) AS x FROM quality_numbers"),
        ("6", "a", "SELECT 1; DROP TABLE quality_numbers"),
        ("7", "a", "I cannot tell"),
        ("8", "a", None),
        ("9", "b", "SELECT odd FROM quality_numbers WHERE odd > 1"),
        ("10", "b", right),
        ("11", None, "SELECT odd, odd AS odd FROM quality_numbers"),
    ]
    expected = [(i, empty if i == "9" else "SELECT * FROM nowhere" if i == "11" else right) for i, *_ in answers if i != "10"]
    rows = u.run_quality(
        spark.createDataFrame(answers, "statement_id string, team string, answer string"),
        spark.createDataFrame(expected, "statement_id string, sql string"),
        "team",
    )
    got = {x["team"]: (x["statements"], x["ok"], x["failed"], x["rejected"], x["without_sql"], x["accuracy"]) for x in rows.collect()}
    assert got == {"a": (8, 3, 2, 1, 2, 0.25), "b": (2, 2, 0, 0, 0, 0.5), None: (1, 1, 0, 0, 0, 0.0)}
