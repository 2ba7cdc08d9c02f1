"""The interaction log and what is read off it."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorebase.operators import usage as u
from lorebase.plans.business import CUST, ORD
from lorebase.plans.knowledge import kept_index
from lorebase.plans.registry import query
from lorebase.plans.sql import LIVE_EVENTS, tfidf
from lorebase.session import scratch_path, written
from lorebase.sources import bindings as b
from lorebase.sources.tables import order_facts, read_table, register_business_views
from lorebase.streaming.usage import read_stream, run_usage_daily

LOG = f"WITH {LIVE_EVENTS}"


@query(
    "history_append",
    f"""{LOG} SELECT id, user_id, question, answer, array_to_string(context_docs, ',') AS context_docs, timestamp,
      response_time_seconds, thumbs_up, status, CAST(timestamp AS DATE) AS date FROM history""",
)
def _(spark, folder):
    path = scratch_path(spark, "history")
    u.append_history(b.history(spark, folder), path)
    return u.read_history(spark, path).withColumn("context_docs", F.array_join("context_docs", ","))


@query(
    "history_read",
    f"""{LOG} SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY timestamp, id) AS interaction_no, id, timestamp,
      question, substr(answer, 1, 200) AS answer_preview, array_to_string(context_docs, ', ') AS context_docs FROM history""",
)
def _(spark, folder):
    return u.list_history(b.history(spark, folder))


@query(
    "history_clear",
    f"""{LOG}, markers AS (SELECT user_id, max(timestamp) AS cleared_at FROM history WHERE status = 'failed' GROUP BY 1)
    SELECT h.id, h.user_id, h.timestamp FROM history h LEFT JOIN markers m USING (user_id)
    WHERE cleared_at IS NULL OR h.timestamp > cleared_at""",
)
def _(spark, folder):
    """Each failed interaction stands for a user clearing the list."""
    log = b.history(spark, folder)
    markers = log.filter("status = 'failed'").select("user_id", F.col("timestamp").alias("cleared_at"))
    return u.clear_history(log, markers).select("id", "user_id", "timestamp")


@query(
    "feedback_append",
    f"""{LOG} SELECT user_id, question AS interaction, arg_max(thumbs_up, (timestamp, id)) AS thumbs_up,
      max(timestamp) AS voted_at, count(*) AS votes FROM history WHERE thumbs_up IS NOT NULL GROUP BY 1, 2""",
)
def _(spark, folder):
    return u.latest_feedback(b.votes(spark, folder))


@query("usage_totals", f"{LOG} SELECT count(*) AS total_questions FROM history")
def _(spark, folder):
    return u.usage_totals(b.history(spark, folder))


DAILY = """SELECT CAST(timestamp AS DATE) AS date, count(*) AS questions_asked,
  round(avg(response_time_seconds), 6) AS avg_response_time,
  round(count(*) FILTER (thumbs_up) * 1.0 / count(*), 6) AS satisfaction_rate FROM history GROUP BY 1"""


@query("usage_daily", f"{LOG} {DAILY} ORDER BY date DESC")
def _(spark, folder):
    return u.usage_daily(b.history(spark, folder))


@query(
    "usage_dashboard",
    f"""{LOG} SELECT count(*) AS total_questions, round(count(*) FILTER (status = 'ok') * 1.0 / count(*), 6) AS success_rate,
      round(avg(response_time_seconds), 6) AS avg_response_time,
      round(count(*) FILTER (thumbs_up) * 1.0 / count(*), 6) AS satisfaction_rate FROM history""",
)
def _(spark, folder):
    return u.usage_dashboard(b.history(spark, folder))


@query(
    "usage_patterns",
    f"{LOG} SELECT CAST(dayofweek(timestamp) + 1 AS INT) AS weekday, CAST(hour(timestamp) AS INT) AS hour, count(*) AS questions FROM history GROUP BY ALL",
)
def _(spark, folder):
    return u.usage_patterns(b.history(spark, folder))


@query(
    "common_questions",
    f"{LOG} SELECT lower(question) AS question, count(*) AS asked FROM history GROUP BY 1 ORDER BY asked DESC, question LIMIT 10",
)
def _(spark, folder):
    return u.common_questions(b.history(spark, folder))


@query(
    "response_percentiles",
    f"""{LOG} SELECT CAST(timestamp AS DATE) AS date, round(quantile_cont(response_time_seconds, 0.5), 6) AS p50,
      round(quantile_cont(response_time_seconds, 0.95), 6) AS p95, max(response_time_seconds) AS max_time
    FROM history GROUP BY 1""",
)
def _(spark, folder):
    return u.response_percentiles(b.history(spark, folder))


def _sketches(spark, folder):
    path = scratch_path(spark, "sketches")
    u.write_sketches(b.history(spark, folder), path)
    return spark.read.parquet(path)


@query(
    "common_questions_sketch",
    f"""{LOG} SELECT lower(question) AS question, count(*) AS asked,
      (SELECT CAST(floor(count(*) * 3.5 / 16384) AS BIGINT) FROM history) AS error_at_most
    FROM history GROUP BY 1 ORDER BY asked DESC, question LIMIT 10""",
)
def _(spark, folder):
    """The frequent questions from a sketch per day, exact while there are fewer questions than it tracks."""
    return u.common_questions_sketched(_sketches(spark, folder), 10)


@query(
    "response_percentiles_sketch",
    f"""{LOG} SELECT CAST(date_trunc('month', timestamp) AS DATE) AS month, count(response_time_seconds) AS responses,
      max(response_time_seconds) AS max_time, true AS p50_within, true AS p95_within FROM history GROUP BY 1""",
)
def _(spark, folder):
    """Percentiles per month from a sketch per day, held against their ranks among all rows: within one percent."""
    month = lambda c: F.trunc(c, "month").alias("month")
    monthly = _sketches(spark, folder).withColumn("month", F.trunc("date", "month"))
    found = written(u.response_percentiles_sketched(monthly, "month"), "percentiles")
    log = b.history(spark, folder).select(month(F.to_date("timestamp")), "response_time_seconds")
    within = lambda name: (F.col(f"{name}_error") <= 0.01).alias(f"{name}_within")
    errors = u.rank_errors(log, found, "month").select("month", within("p50"), within("p95"))
    return found.select("month", "responses", "max_time").join(errors, "month")


@query("doc_usage", f"{LOG} SELECT doc_id, count(*) AS uses FROM (SELECT unnest(context_docs) AS doc_id FROM history) GROUP BY 1")
def _(spark, folder):
    return u.doc_usage(b.history(spark, folder))


@query(
    "doc_usage_summary",
    f"{LOG} SELECT count(DISTINCT doc_id) AS documents_used, count(*) AS uses FROM (SELECT unnest(context_docs) AS doc_id FROM history)",
)
def _(spark, folder):
    return u.doc_usage_summary(b.history(spark, folder))


@query(
    "doc_usage_top",
    f"""{LOG}, used AS (SELECT timestamp, id, unnest(context_docs) AS doc_id, unnest([0, 1]) AS pos FROM history)
    SELECT doc_id, count(*) AS uses FROM used GROUP BY doc_id ORDER BY uses DESC, min((timestamp, id, pos)) LIMIT 5""",
)
def _(spark, folder):
    return u.doc_usage_top(b.history(spark, folder))


@query(
    "answer_cache",
    f"""{LOG}, cut AS (SELECT date_trunc('day', max(timestamp)) AS c FROM history),
    pairs AS (SELECT h.id, arg_max(a.answer, (a.timestamp, a.id)) AS answer FROM history h, cut, history a
      WHERE h.timestamp >= c AND a.status = 'ok' AND lower(a.question) = lower(h.question)
        AND a.timestamp <= h.timestamp AND h.timestamp - a.timestamp < INTERVAL 1 HOUR GROUP BY 1)
    SELECT h.id, question, pairs.id IS NOT NULL AS hit, pairs.answer
    FROM history h CROSS JOIN cut LEFT JOIN pairs ON pairs.id = h.id WHERE timestamp >= c""",
)
def _(spark, folder):
    """Questions of the last day against all answers given before each, up to an hour ago."""
    log = b.history(spark, folder)
    cut = log.agg(F.date_trunc("day", F.max("timestamp"))).scalar()
    return u.answer_from_cache(log.filter(F.col("timestamp") >= cut), u.cached_answers(log), ttl_seconds=3600)


@query(
    "similar_questions",
    f"""{LOG}, asked AS (SELECT DISTINCT lower(question) AS doc_id, lower(question) AS content FROM history),
    {tfidf("asked", "SELECT doc_id AS question_id, content AS question FROM asked", more="WHERE question_id <> doc_id")}
    SELECT question_id AS question, doc_id AS similar_question, score, rank FROM hits WHERE rank <= 3""",
)
def _(spark, folder):
    questions = u.distinct_questions(b.history(spark, folder))
    return u.similar_questions(questions, kept_index(spark, folder, "questions", lambda: questions), 3)


STATEMENT = """'SELECT count(*) FROM customers WHERE segment = ''' || {0} || ''' AND nation = ' || {1} || ' AND band = ' ||
  CAST(floor({2} / 500) AS BIGINT)"""


@query(
    "promote_queries",
    f"""WITH q AS (SELECT c_custkey AS id, 'Customers like ' || c_name AS question,
        {STATEMENT.format("c_mktsegment", "c_nationkey", "c_acctbal")} AS sql
      FROM customer WHERE c_acctbal >= 0),
    known AS (SELECT {STATEMENT.format("'BUILDING'", "s_nationkey", "s_acctbal")} AS sql FROM supplier)
    SELECT 'query_' || sha256(sql) AS doc_id, 'query_example' AS doc_type, arg_min(question, id) AS title,
      sql AS content, '{{"source":"user_added"}}' AS metadata FROM q WHERE sql NOT IN (SELECT sql FROM known) GROUP BY sql""",
)
def _(spark, folder):
    fresh = u.promote_queries(b.query_log(spark, folder), b.known_statements(spark, folder), stamp=b.STAMP)
    return fresh.select("doc_id", "doc_type", "title", "content", "metadata")


@query(
    "sql_quality",
    f"""WITH {ORD}, judged AS (SELECT c_custkey,
        CASE WHEN c_acctbal < 0 THEN 'failed' ELSE 'ok' END AS status, c_acctbal AS response_time_seconds,
        (SELECT count(*) FROM ord WHERE customer_id = c_custkey AND order_status = 'pending') = 0 AS same_rows FROM customer)
    SELECT count(*) AS statements, round(count(*) FILTER (same_rows AND status = 'ok') * 1.0 / count(*), 6) AS accuracy,
      round(count(*) FILTER (status = 'ok') * 1.0 / count(*), 6) AS success_rate,
      round(avg(response_time_seconds), 6) AS avg_response_time FROM judged""",
)
def _(spark, folder):
    """One statement per customer; it should list all orders but the cancelled, and leaves out the pending ones."""
    orders = order_facts(spark, folder).withColumnRenamed("customer_id", "statement_id")
    runs = read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("statement_id"),
        F.when(F.col("c_acctbal") < 0, "failed").otherwise("ok").alias("status"),
        F.col("c_acctbal").alias("response_time_seconds"),
    )
    return u.sql_quality(
        orders.filter("order_status = 'completed'"), orders.filter("order_status <> 'cancelled'"), runs
    )


# What seven answers to "how many customers of a segment are there per region" hold; the first two are right.
QUALITY_ANSWERS = [
    "SELECT region, count(*) AS customers FROM customers WHERE customer_segment = '{}' GROUP BY region",
    "This counts them:\n```sql\nWITH s AS (SELECT * FROM customers WHERE customer_segment = '{}')\n"
    "SELECT region AS r, count(customer_id) AS n FROM s GROUP BY region ORDER BY n DESC, r\n```",
    "SELECT region, count(*) AS customers FROM customers WHERE customer_segment <> '{}' GROUP BY region",
    "SELECT region, count(*) AS customers FROM customers WHERE segment_name = '{}' GROUP BY region",
    "SELECT region, count(*) DIV (count(*) - count(*)) AS customers FROM customers WHERE customer_segment = '{}' GROUP BY region",
    "```sql\nSELECT count(*) FROM customers WHERE customer_segment = '{}'; DROP TABLE customers\n```",
    "Nobody counts the customers of {}.",
]


@query(
    "sql_quality_runs",
    f"""WITH {ORD}, {CUST}, n AS (SELECT customer_segment AS segment, region, count(*) AS here FROM cust GROUP BY ALL),
    t AS (SELECT region, sum(here) AS total FROM n GROUP BY 1),
    -- The third answer counts all other segments, which may come to the same; regions without the segment are missing in the right one.
    third AS (SELECT s.segment, bool_and(coalesce(here, 0) = total - coalesce(here, 0)) AS same FROM (SELECT DISTINCT segment FROM n) s
      CROSS JOIN t LEFT JOIN n ON n.segment = s.segment AND n.region = t.region GROUP BY 1)
    SELECT segment, CAST(7 AS BIGINT) AS statements, CAST(3 AS BIGINT) AS ok, CAST(2 AS BIGINT) AS failed, CAST(1 AS BIGINT) AS rejected,
      CAST(1 AS BIGINT) AS without_sql, round((2 + CAST(same AS INT)) / 7.0, 6) AS accuracy, round(3 / 7.0, 6) AS success_rate, true AS timed
    FROM third""",
)
def _(spark, folder):
    """Seven answers per customer segment, cut out, checked and run on the whole tables."""
    register_business_views(spark, folder)
    segments = read_table(spark, folder, "customer").select(F.col("c_mktsegment").alias("segment")).distinct()
    fill = lambda text: F.replace(F.lit(text), F.lit("{}"), F.col("segment"))
    each = segments.select("segment", F.posexplode(F.array(*[fill(a) for a in QUALITY_ANSWERS])).alias("n", "answer"))
    answers = each.select(F.concat_ws(" ", "segment", "n").alias("statement_id"), "segment", "answer")
    expected = each.select(F.concat_ws(" ", "segment", "n").alias("statement_id"), fill(QUALITY_ANSWERS[0]).alias("sql"))
    rows = u.run_quality(answers, expected, "segment")
    return rows.withColumn("timed", F.col("avg_response_time") > 0).drop("avg_response_time")


@query(
    "stream_usage_daily",
    f"{LOG} {DAILY} HAVING CAST(timestamp AS DATE) + INTERVAL 1 DAY <= (SELECT max(timestamp) - INTERVAL 1 HOUR FROM history)",
)
def _(spark, folder):
    schema = read_table(spark, folder, "events").schema
    kind = F.col("event_type")
    log = read_stream(spark, folder, "events", schema).select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").alias("response_time_seconds"),
        (kind == "purchase").alias("thumbs_up"),
    )
    path = scratch_path(spark, "usage")
    run_usage_daily(log, path, scratch_path(spark, "usage-progress"))
    return spark.read.schema(
        "date date, questions_asked bigint, avg_response_time double, satisfaction_rate double"
    ).parquet(path)
