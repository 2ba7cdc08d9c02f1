"""The interaction log: writing and reading it, usage figures, caching, quality of answers.

`history` has (id, user_id, question, answer, context_docs, timestamp,
response_time_seconds, thumbs_up, status).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from lorebase.functions.text import extract_sql, normal_question, preview
from lorebase.operators.guard import statement_outcomes
from lorebase.operators.retrieval import TextIndex, search_topk_text
from lorebase.operators.skew import lookup_join, running_number
from lorebase.session import broadcast_if_few, exists
from lorebase.sources.kb import KB_COLUMNS, content_hash, new_documents

HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("user_id", T.LongType()),
        T.StructField("question", T.StringType()),
        T.StructField("answer", T.StringType()),
        T.StructField("context_docs", T.ArrayType(T.StringType())),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("response_time_seconds", T.DoubleType()),
        T.StructField("thumbs_up", T.BooleanType()),
        T.StructField("status", T.StringType()),
    ]
)


# --- the log itself ---------------------------------------------------------------------


def append_history(rows: DataFrame, path: str) -> None:
    """Append interactions, in one folder per day, so that reading a period reads only its days."""
    (
        rows.select(*[F.col(f.name).cast(f.dataType) for f in HISTORY_SCHEMA])
        .withColumn("date", F.to_date("timestamp"))
        .repartition("date", F.pmod(F.xxhash64("id"), F.lit(8)))
        .write.mode("append")
        .partitionBy("date")
        .parquet(path)
    )


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(T.StructType([*HISTORY_SCHEMA.fields, T.StructField("date", T.DateType())])).parquet(path)


def append_batch(rows: DataFrame, path: str, batch: str) -> bool:
    """Append a batch of interactions once, however often it is tried; False where it is in the log already.

    Rows go to a folder of the batch, which a new try overwrites. They count once the batch is
    entered among the commits, which comes last.
    """
    if not re.fullmatch(r"[\w-]+", batch):
        raise ValueError("a batch is named by letters, digits, _ and -")
    spark = rows.sparkSession
    if exists(spark, f"{path}/commits/batch={batch}/_SUCCESS"):
        return False
    columns = [F.col(f.name).cast(f.dataType) for f in HISTORY_SCHEMA]
    rows.select(*columns).write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")
    spark.range(1).select(F.current_timestamp().alias("committed_at")).write.mode("overwrite").parquet(f"{path}/commits/batch={batch}")
    return True


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The interactions of all committed batches, with `batch`; none where nothing was ever committed."""
    batch = T.StructField("batch", T.StringType())
    if not exists(spark, f"{path}/commits"):
        return spark.createDataFrame([], T.StructType([*HISTORY_SCHEMA.fields, batch]))
    rows = spark.read.schema(T.StructType([*HISTORY_SCHEMA.fields, batch])).parquet(f"{path}/rows")
    commits = spark.read.schema(T.StructType([T.StructField("committed_at", T.TimestampType()), batch])).parquet(f"{path}/commits")
    return rows.join(commits.select("batch").distinct(), "batch", "left_semi").select(*rows.columns)


def list_history(history: DataFrame, length: int = 200) -> DataFrame:
    """A user's interactions in order: number from 1, start of the answer, documents as one text."""
    numbered = running_number(
        history.select("id", "user_id", "timestamp", "question", preview(F.col("answer"), length).alias("answer_preview"), "context_docs"),
        ["user_id"],
        ["timestamp", "id"],
        "interaction_no",
    )
    return numbered.select(
        "user_id",
        "interaction_no",
        "id",
        "timestamp",
        "question",
        "answer_preview",
        F.array_join("context_docs", ", ").alias("context_docs"),
    )


def clear_history(history: DataFrame, markers: DataFrame) -> DataFrame:
    """History after each user's latest clearing; `markers` holds (user_id, cleared_at).

    Clearing appends a marker and rewrites nothing.
    """
    latest = markers.groupBy("user_id").agg(F.max("cleared_at").alias("cleared_at"))
    keep = F.col("cleared_at").isNull() | (F.col("timestamp") > F.col("cleared_at"))
    return history.join(latest, "user_id", "left").filter(keep).drop("cleared_at")


def latest_feedback(votes: DataFrame) -> DataFrame:
    """The vote that counts per user and interaction; `votes` has (user_id, interaction, thumbs_up, voted_at, id)."""
    return (
        votes.groupBy("user_id", "interaction")
        .agg(F.max(F.struct("voted_at", "id", "thumbs_up")).alias("v"), F.count(F.lit(1)).alias("votes"))
        .select("user_id", "interaction", "v.thumbs_up", "v.voted_at", "votes")
    )


# --- usage figures ----------------------------------------------------------------------


def _satisfaction():
    """Thumbs up over all rows: no vote counts as no approval."""
    return F.try_divide(F.count(F.when(F.col("thumbs_up"), 1)), F.count(F.lit(1)))


def usage_totals(history: DataFrame) -> DataFrame:
    return history.agg(F.count(F.lit(1)).alias("total_questions"))


def usage_daily(history: DataFrame) -> DataFrame:
    return (
        history.groupBy(F.to_date("timestamp").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("questions_asked"),
            F.round(F.avg("response_time_seconds"), 6).alias("avg_response_time"),
            F.round(_satisfaction(), 6).alias("satisfaction_rate"),
        )
        .orderBy(F.desc("date"))
    )


def usage_dashboard(history: DataFrame) -> DataFrame:
    ok = F.count(F.when(F.col("status").isin("ok", "cached"), 1))
    return history.agg(
        F.count(F.lit(1)).alias("total_questions"),
        F.round(F.try_divide(ok, F.count(F.lit(1))), 6).alias("success_rate"),
        F.round(F.avg("response_time_seconds"), 6).alias("avg_response_time"),
        F.round(_satisfaction(), 6).alias("satisfaction_rate"),
    )


def usage_patterns(history: DataFrame) -> DataFrame:
    """Questions by weekday (Sunday is 1) and hour."""
    return history.groupBy(
        F.dayofweek("timestamp").alias("weekday"), F.hour("timestamp").alias("hour")
    ).agg(F.count(F.lit(1)).alias("questions"))


def common_questions(history: DataFrame, k: int = 10) -> DataFrame:
    return (
        history.groupBy(normal_question(F.col("question")).alias("question"))
        .agg(F.count(F.lit(1)).alias("asked"))
        .orderBy(F.desc("asked"), "question")
        .limit(k)
    )


def response_percentiles(history: DataFrame) -> DataFrame:
    """Exact median, 95th percentile and maximum of the response time per day.

    The exact aggregate of Spark holds all values of a day in one task. Here the rows are
    numbered by one distributed sort, and only those next to a percentile are read off.
    """
    timed = history.filter("response_time_seconds is not null").select(
        F.to_date("timestamp").alias("date"), "response_time_seconds", "id"
    )
    numbered = running_number(timed, ["date"], ["response_time_seconds", "id"], "n", total="rows")
    at = lambda p: (F.col("rows") - 1) * F.lit(p) + 1
    placed = numbered.withColumn("p50_at", at(0.5)).withColumn("p95_at", at(0.95))
    places = [f(p) for p in ("p50_at", "p95_at") for f in (F.floor, F.ceil)]
    near = placed.filter(F.col("n").isin(*places) | (F.col("n") == F.col("rows")))

    def read_off(p):
        low = F.max(F.when(F.col("n") == F.floor(p), F.col("response_time_seconds")))
        high = F.max(F.when(F.col("n") == F.ceil(p), F.col("response_time_seconds")))
        part = F.max(F.col(p) - F.floor(p))
        return F.round(low + (high - low) * part, 6)

    return near.groupBy("date").agg(
        read_off("p50_at").alias("p50"), read_off("p95_at").alias("p95"), F.max("response_time_seconds").alias("max_time")
    )


# --- figures from a sketch per day ------------------------------------------------------

# Questions a sketch counts, and the size of a sketch of times.
TRACKED = 10_000
QUANTILE_SIZE = 1000


def write_sketches(history: DataFrame, path: str, tracked: int = TRACKED, size: int = QUANTILE_SIZE) -> None:
    """One row per day: how many rows, a sketch of the frequent questions, one of the response times, and the longest time.

    Days that `history` holds replace what was written of them; other days stay. A day is summed up where its rows are
    and only sketches move, of a size that does not depend on the number of rows.
    """
    daily = history.select(
        F.to_date("timestamp").alias("date"), F.coalesce(normal_question(F.col("question")), F.lit("")).alias("question"), "response_time_seconds"
    ).groupBy("date")
    sketches = daily.agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"approx_top_k_accumulate(question, {tracked})").alias("questions"),
        F.kll_sketch_agg_double("response_time_seconds", F.lit(size)).alias("times"),
        F.count("response_time_seconds").alias("timed"),
        F.max("response_time_seconds").alias("max_time"),
    )
    sketches.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("date").parquet(path)


def common_questions_sketched(sketches: DataFrame, k: int = 10, tracked: int = TRACKED) -> DataFrame:
    """The most frequent questions of the days at hand: (question, asked, error_at_most). Null and blank questions count as ''.

    `asked` lies at most `error_at_most` over the true count, 3.5 times the rows over the slots of the sketch, and never under it; it is exact
    while the days hold at most `tracked` different questions. A question asked more often than that error is never left out.
    """
    slots = 1 << (-(-4 * tracked // 3) - 1).bit_length()
    merged = sketches.agg(F.expr(f"approx_top_k_combine(questions, {tracked})").alias("all"), F.sum("rows").alias("rows"))
    found = merged.select("rows", F.explode(F.expr(f"approx_top_k_estimate(all, {tracked})")).alias("found"))
    return (
        found.select(
            F.col("found.item").alias("question"), F.col("found.count").alias("asked"), F.floor(F.col("rows") * 3.5 / slots).alias("error_at_most")
        )
        .orderBy(F.desc("asked"), "question")
        .limit(k)
    )


def response_percentiles_sketched(sketches: DataFrame, by: str = "date") -> DataFrame:
    """Median, 95th percentile and maximum of the response time per value of `by`, a column of the sketches, from merged sketches.

    With the usual size the rank of a percentile is within 0.3 % of all rows for 99 of 100 percentiles; the maximum is exact.
    Values without any time have no row.
    """
    merged = sketches.filter("timed > 0").groupBy(by).agg(
        F.kll_merge_agg_double("times").alias("times"), F.sum("timed").alias("responses"), F.max("max_time").alias("max_time")
    )
    at = lambda p: F.kll_sketch_get_quantile_double("times", F.lit(p))
    return merged.select(by, "responses", at(0.5).alias("p50"), at(0.95).alias("p95"), "max_time")


def rank_errors(history: DataFrame, percentiles: DataFrame, by: str) -> DataFrame:
    """How far percentiles lie from their rank among all times, as a share of the rows: (`by`, p50_error, p95_error).

    `history` needs `by` and response_time_seconds; percentiles are a row per `by`.
    """
    time = F.col("response_time_seconds")
    joined = history.filter(time.isNotNull()).select(by, "response_time_seconds").join(broadcast_if_few(percentiles.select(by, "p50", "p95")), by)
    share = lambda c: F.count(F.when(c, 1)) / F.count(F.lit(1))
    off = lambda name, p: F.greatest(share(time < F.col(name)) - p, p - share(time <= F.col(name)), F.lit(0.0)).alias(f"{name}_error")
    return joined.groupBy(by).agg(off("p50", 0.5), off("p95", 0.95))


# --- documents in use -------------------------------------------------------------------


def doc_usage(history: DataFrame) -> DataFrame:
    return history.select(F.explode("context_docs").alias("doc_id")).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("uses")
    )


def doc_usage_summary(history: DataFrame) -> DataFrame:
    return doc_usage(history).agg(
        F.count(F.lit(1)).alias("documents_used"), F.coalesce(F.sum("uses"), F.lit(0)).alias("uses")
    )


def doc_usage_top(history: DataFrame, k: int = 5) -> DataFrame:
    """The most used documents; of equally used ones the one used first."""
    return (
        history.select("timestamp", "id", F.posexplode("context_docs").alias("at", "doc_id"))
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("uses"), F.min(F.struct("timestamp", "id", "at")).alias("first_use"))
        .orderBy(F.desc("uses"), "first_use")
        .limit(k)
        .select("doc_id", "uses")
    )


# --- reuse of answers and questions -----------------------------------------------------


def cached_answers(history: DataFrame) -> DataFrame:
    """The good answers with the key of their question: (cache_key, answered_at, id, answer)."""
    return history.filter("status = 'ok'").select(
        normal_question(F.col("question")).alias("cache_key"), F.col("timestamp").alias("answered_at"), "id", "answer"
    )


# Slices of time that the time to live is cut into.
SLICES = 3600


def answer_from_cache(requests: DataFrame, cache: DataFrame, ttl_seconds: int = 3600) -> DataFrame:
    """Each request with the latest answer given to its question before it, if that is within the time to live.

    `requests` needs (id, question, timestamp), `cache` the columns of `cached_answers`. An answer of the same time counts.
    Time is cut into spans as long as the time to live, and these into slices. Of each slice only the last answer is
    kept for later ones, so what a question has in a span is a row per slice however often it was asked; within a slice
    answers and requests are gone through in order.
    """
    slice_of = lambda at: F.floor(F.unix_micros(at) / F.lit(ttl_seconds * 1_000_000 / SLICES)).cast("bigint")
    answer = F.struct(F.col("answered_at").alias("at"), F.col("id").alias("answer_id"), "answer")
    given = cache.select("cache_key", slice_of("answered_at").alias("slice"), F.col("answered_at").alias("time"), answer.alias("given"))
    asked = requests.select(
        normal_question(F.col("question")).alias("cache_key"), slice_of("timestamp").alias("slice"), F.col("timestamp").alias("time"),
        F.col("id").alias("asked_id"), "question",
    )
    per_slice = given.groupBy("cache_key", "slice").agg(F.max("given").alias("last"))
    span = F.floor(F.col("slice") / SLICES).cast("bigint")
    known = per_slice.join(asked.select("cache_key", "slice").distinct(), ["cache_key", "slice"], "full").withColumn("span", span)
    before = W.partitionBy("cache_key", "span").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    known = known.withColumn("before", F.max("last").over(before))
    per_span = known.groupBy("cache_key", (F.col("span") + 1).alias("span")).agg(F.max("last").alias("earlier"))
    known = known.join(per_span, ["cache_key", "span"], "left").select("cache_key", "slice", F.coalesce("before", "earlier").alias("before"))
    both = given.unionByName(asked, allowMissingColumns=True)
    order = W.partitionBy("cache_key", "slice").orderBy("time", F.col("asked_id").isNotNull()).rowsBetween(W.unboundedPreceding, 0)
    within = both.withColumn("within", F.max("given").over(order)).filter(F.col("asked_id").isNotNull())
    best = within.join(known, ["cache_key", "slice"]).withColumn("best", F.coalesce("within", "before"))
    age = F.unix_micros("time") - F.unix_micros("best.at")
    fresh = F.coalesce(age < ttl_seconds * 1_000_000, F.lit(False))
    return best.select(F.col("asked_id").alias("id"), "question", fresh.alias("hit"), F.when(fresh, F.col("best.answer")).alias("answer"))


def cache_misses(requests: DataFrame, answered: DataFrame) -> DataFrame:
    return requests.join(answered.filter("hit"), "id", "left_anti")


def distinct_questions(history: DataFrame) -> DataFrame:
    """Questions asked, once each: (doc_id, content, asked); the id is the question itself."""
    key = normal_question(F.col("question"))
    return history.groupBy(key.alias("content")).agg(F.count(F.lit(1)).alias("asked")).select(
        F.col("content").alias("doc_id"), "content", "asked"
    )


def similar_questions(questions: DataFrame, index: TextIndex, k: int = 3) -> DataFrame:
    """For each distinct question the k nearest other ones; repeats were merged before."""
    asked = questions.select(F.col("doc_id").alias("question_id"), F.col("content").alias("question"))
    return search_topk_text(asked, index, k, exclude_self=True).select(
        F.col("question_id").alias("question"), F.col("doc_id").alias("similar_question"), "score", "rank"
    )


def promote_queries(history: DataFrame, kb: DataFrame, stamp: str | None = None) -> DataFrame:
    """Successful statements as new `query_example` documents, once per statement, unless known.

    `history` needs (id, question, sql, status).
    """
    good = history.filter("status = 'ok' and sql <> ''").withColumn("key", content_hash(F.col("sql")))
    once = good.groupBy("key").agg(F.min(F.struct("id", "question", "sql")).alias("first"))
    docs = once.select(
        F.concat(F.lit("query_"), F.col("key")).alias("doc_id"),
        F.lit("query_example").alias("doc_type"),
        F.col("first.question").alias("title"),
        F.col("first.sql").alias("content"),
    )
    known = kb.select(content_hash(F.col("content")).alias("known")).distinct()
    fresh = docs.withColumn("known", content_hash(F.col("content"))).join(known, "known", "left_anti").drop("known")
    return new_documents(fresh, stamp=stamp).select(*KB_COLUMNS)


# --- quality ----------------------------------------------------------------------------


def fingerprints(results: DataFrame, by: str) -> DataFrame:
    """Row count and order-free checksum per result set; the sum is a decimal, a long would overflow."""
    values = [c for c in results.columns if c != by]
    row_hash = F.xxhash64(*values).cast("decimal(38,0)")
    return results.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.sum(row_hash).alias("checksum"))


def sql_quality(produced: DataFrame, expected: DataFrame, runs: DataFrame, by: str = "statement_id") -> DataFrame:
    """Share of statements whose rows are the expected ones, share that ran, mean response time.

    `produced` and `expected` hold result rows with the statement they belong to; `runs`
    has (statement_id, status, response_time_seconds).
    """
    got = fingerprints(produced, by)
    want = fingerprints(expected, by).select(by, F.col("rows").alias("want_rows"), F.col("checksum").alias("want_sum"))
    judged = runs.join(got, by, "left").join(want, by, "left").select(
        "status",
        "response_time_seconds",
        (F.col("rows").eqNullSafe(F.col("want_rows")) & F.col("checksum").eqNullSafe(F.col("want_sum"))).alias("right"),
    )
    share = lambda c: F.round(F.try_divide(F.count(F.when(c, 1)), F.count(F.lit(1))), 6)
    return judged.agg(
        F.count(F.lit(1)).alias("statements"),
        share(F.col("right") & (F.col("status") == "ok")).alias("accuracy"),
        share(F.col("status") == "ok").alias("success_rate"),
        F.round(F.avg("response_time_seconds"), 6).alias("avg_response_time"),
    )


def run_quality(answers: DataFrame, expected: DataFrame, by: str, limit: int | None = None) -> DataFrame:
    """Run the statements of answers and those expected, and judge the ones by the others, per value of `by`.

    `answers` has (statement_id, answer, `by`), `expected` (statement_id, sql). An answer is right if its statement ran and
    its rows are those of the expected one, in any order and under any names. Equal statements run once.
    (`by`, statements, ok, failed, rejected, without_sql, accuracy, success_rate, avg_response_time), where the
    time is that of statements that were started; an answer for which nothing is expected is not right.
    """
    cut = answers.select("statement_id", by, extract_sql(F.col("answer")).alias("sql")).checkpoint()
    got = statement_outcomes(cut, "sql", limit).select("sql", "status", "rows", "checksum", "seconds")
    wanted = expected.select("statement_id", F.col("sql").alias("want_sql")).checkpoint()
    ran = statement_outcomes(wanted, "want_sql", limit).filter("status = 'ok'")
    want = wanted.join(ran.select(F.col("sql").alias("want_sql"), F.col("rows").alias("want_rows"), F.col("checksum").alias("want_sum")), "want_sql")
    judged = (
        cut.join(got, "sql", "left")
        .join(want, "statement_id", "left")
        .withColumn("status", F.coalesce("status", F.lit("no_sql")))
        .withColumn("right", (F.col("status") == "ok") & (F.col("rows") == F.col("want_rows")) & F.col("checksum").eqNullSafe(F.col("want_sum")))
    )
    of = lambda c: F.count(F.when(c, 1))
    share = lambda c: F.round(F.try_divide(of(c), F.count(F.lit(1))), 6)
    status = F.col("status")
    return judged.groupBy(by).agg(
        F.count(F.lit(1)).alias("statements"),
        of(status == "ok").alias("ok"),
        of(status == "failed").alias("failed"),
        of(status == "rejected").alias("rejected"),
        of(status == "no_sql").alias("without_sql"),
        share(F.col("right")).alias("accuracy"),
        share(status == "ok").alias("success_rate"),
        F.avg(F.when(status.isin("ok", "failed"), F.col("seconds"))).alias("avg_response_time"),
    )
