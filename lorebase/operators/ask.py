"""From tables of questions to context, prompt, answer, SQL and result.

Every answer row carries a status: ok, no_context, no_sql, rejected or failed.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from lorebase.functions.text import cap_rows, extract_sql, is_blank, named_tables, normal_question
from lorebase.operators import usage as u
from lorebase.operators.guard import Run, execute_query, guard_statements, statement_outcomes
from lorebase.operators.retrieval import TextIndex, attach_documents, search_topk_text
from lorebase.operators.skew import hot_keys, lookup_join, running_number
from lorebase.session import exists

DEFAULT_K = 5

# What the later steps need from a reply: extraction reads the first fenced block, the guard takes single
# queries only, the row cap is added when there is none, and a reply without SQL is shown as it is.
PROMPT_HEAD = "The notes come from the documentation of the tables that the question is about."
PROMPT_RULES = [
    "Put SQL into one fenced block marked sql. Only the first block is read.",
    "Write a single statement that starts with SELECT or WITH. Statements that change anything are refused.",
    "Results are cut off after 100 rows; aggregate or order so that these are the ones that matter.",
    "Where the notes do not hold the answer, write NOT KNOWN and name the note that is missing.",
]
PROMPT_TAIL = "REPLY:"


def clean_questions(questions: DataFrame) -> DataFrame:
    """Questions (question_id, question) without the blank ones."""
    return questions.filter(~is_blank(F.col("question")))


def retrieve_context(questions: DataFrame, docs: DataFrame, index: TextIndex, k: int = DEFAULT_K, threshold: float | None = None) -> DataFrame:
    """The k best documents per question with their text and tags."""
    hits = search_topk_text(questions, index, k, threshold).checkpoint()
    empty = F.array().cast("array<string>")
    columns = ["doc_id", "doc_type", "title", "content", "tables", "tags"]
    found = attach_documents(hits, docs.select(*columns))
    return found.withColumn("tables", F.coalesce("tables", empty)).withColumn("tags", F.coalesce("tags", empty))


def assemble_context(questions: DataFrame, retrieved: DataFrame) -> DataFrame:
    """Add `context`: the retrieved documents in rank order, '' where there are none.

    At most k documents come together per question.
    """
    # How a document is laid out in the context.
    block = F.concat(
        F.lit("Document: "), F.col("title"), F.lit("\nType: "), F.col("doc_type"), F.lit("\n"), F.col("content")
    )
    per_question = retrieved.groupBy("question_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "doc_id", block.alias("block")))).alias("blocks")
    )
    return questions.join(per_question, "question_id", "left").select(
        *questions.columns,
        F.coalesce(F.array_join(F.transform("blocks", lambda b: b["block"]), "\n\n"), F.lit("")).alias("context"),
        F.coalesce(F.transform("blocks", lambda b: b["doc_id"]), F.array().cast("array<string>")).alias("context_docs"),
    )


def context_optional(questions: DataFrame, retrieved: DataFrame, return_context: bool) -> DataFrame:
    """Questions, with the list of retrieved documents only when asked for."""
    if not return_context:
        return questions
    listed = retrieved.groupBy("question_id").agg(
        F.array_sort(
            F.collect_list(F.struct("rank", "doc_id", "doc_type", "title", "content", "tables", "tags"))
        ).alias("context")
    )
    return questions.join(listed, "question_id", "left")


def build_prompt(with_context: DataFrame) -> DataFrame:
    """Add `prompt` to rows with (question, context)."""
    rules = "\n".join(f"{n}. {rule}" for n, rule in enumerate(PROMPT_RULES, 1))
    prompt = F.concat(
        F.lit(f"{PROMPT_HEAD}\n\nNOTES:\n"),
        F.col("context"),
        F.lit("\n\nQUESTION:\n"),
        F.col("question"),
        F.lit(f"\n\nRULES:\n{rules}\n\n{PROMPT_TAIL}"),
    )
    return with_context.withColumn("prompt", prompt)


def holds_sql(text):
    return F.regexp_like(text, F.lit(r"(?is)\bselect\s.*\sfrom\s"))


def answer_grounded(questions: DataFrame, retrieved: DataFrame) -> DataFrame:
    """Answer from the documents: the best ranked one that holds SQL, else the best ranked.

    This is extraction, not generation: where no document fits there is no answer, and the
    status says so. `answer_with` puts a generator in its place.
    """
    chosen = retrieved.groupBy("question_id").agg(
        F.max_by(F.struct("doc_id", "content"), F.struct(holds_sql(F.col("content")), -F.col("rank"))).alias("best"),
        F.array_sort(F.collect_list(F.struct("rank", "doc_id"))).alias("found"),  # k at most
    )
    return questions.join(chosen, "question_id", "left").select(
        *questions.columns,
        F.transform("found", lambda h: h["doc_id"]).alias("context_docs"),
        F.col("best.doc_id").alias("answer_doc"),
        F.coalesce("best.content", F.lit("")).alias("answer"),
        F.when(F.col("best").isNull(), "no_context").otherwise("ok").alias("status"),
    )


def answer_with(prompts: DataFrame, generate: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """Answer with any generator: `generate` maps a batch of prompts to a batch of answers.

    `prompts` needs (question_id, question, prompt). A batch that fails is marked, it does
    not end the job.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["question_id", "question"]].copy()
            try:
                out["answer"] = list(generate(batch["prompt"]))
                out["status"] = "ok"
            except Exception as e:
                out["answer"] = f"{type(e).__name__}: {e}"
                out["status"] = "failed"
            yield out

    kind = prompts.schema["question_id"].dataType.simpleString()
    return prompts.select("question_id", "question", "prompt").mapInPandas(
        run, f"question_id {kind}, question string, answer string, status string"
    )


def ask_batch(questions: DataFrame, docs: DataFrame, index: TextIndex, k: int = DEFAULT_K) -> DataFrame:
    """Retrieve and answer for a whole table of questions in one job.

    (question_id, question, context_docs, answer_doc, answer, status), ready for the log.
    """
    questions = clean_questions(questions)
    return answer_grounded(questions, retrieve_context(questions, docs, index, k))


def ask_logged(
    requests: DataFrame, docs: DataFrame, index: TextIndex, log: str, batch: str, k: int = DEFAULT_K, ttl_seconds: int = 3600
) -> bool:
    """Answer a batch of requests (id, user_id, question, timestamp) and enter it into the log; False where it is there already.

    Questions with a good answer in the log that is not older than `ttl_seconds` get it again, with status
    `cached`; such rows are no source for later ones, so an answer does not outlive its time. The others are answered once
    per distinct question. A blank question is logged as `no_question`. A batch that breaks off is run again
    under its name and counts once. `threaded_questions` puts the turns before a question in front of it.
    """
    spark = requests.sparkSession
    if exists(spark, f"{log}/commits/batch={batch}/_SUCCESS"):
        return False
    started = time.monotonic()
    requests = requests.select("id", "user_id", "question", "timestamp")
    known = u.answer_from_cache(requests, u.cached_answers(u.read_batches(spark, log)), ttl_seconds=ttl_seconds)
    known = requests.join(known.select("id", "hit", F.col("answer").alias("known")), "id", "left").checkpoint()
    looked_up = time.monotonic() - started
    missed = known.filter("not coalesce(hit, false)").withColumn("key", F.coalesce(normal_question(F.col("question")), F.lit("")))
    distinct = missed.groupBy("key").agg(F.min_by("question", "id").alias("question"), F.count(F.lit(1)).alias("rows")).checkpoint()
    fresh = ask_batch(distinct.select(F.col("key").alias("question_id"), "question"), docs, index, k)
    answers = distinct.select("key", "rows").join(
        fresh.select(F.col("question_id").alias("key"), "context_docs", "answer", "status"), "key", "left"
    ).checkpoint()
    waited = time.monotonic() - started
    spread = lookup_join(missed, answers.drop("rows"), "key", spread_by="id", hot=hot_keys(answers, "key", "rows"))
    told = ["id", "user_id", "question", "answer", "context_docs", "timestamp", "response_time_seconds", "thumbs_up", "status"]
    no_vote, none = F.lit(None).cast("boolean").alias("thumbs_up"), F.array().cast("array<string>")
    answered = spread.select(
        "id", "user_id", "question", F.coalesce("answer", F.lit("")).alias("answer"), F.coalesce("context_docs", none).alias("context_docs"),
        "timestamp", F.lit(waited).alias("response_time_seconds"), no_vote, F.coalesce("status", F.lit("no_question")).alias("status"),
    )
    repeated = known.filter("hit").select(
        "id", "user_id", "question", F.col("known").alias("answer"), none.alias("context_docs"), "timestamp",
        F.lit(looked_up).alias("response_time_seconds"), no_vote, F.lit("cached").alias("status"),
    )
    return u.append_batch(answered.select(*told).unionByName(repeated.select(*told)), log, batch)


def threaded_questions(requests: DataFrame, history: DataFrame, n: int = 3) -> DataFrame:
    """Requests whose question is led by the user's `n` questions before it, oldest first, from the log or the same requests.

    What is searched, and kept under in the cache, is then the thread and not the last words of it.
    """
    asked = requests.select("id", "user_id", "question", "timestamp", F.lit(True).alias("now"))
    before = history.select("id", "user_id", "question", "timestamp", F.lit(False).alias("now"))
    turns = asked.unionByName(before).select(
        F.col("user_id").alias("conv_id"), F.struct("timestamp", "id", "now").alias("turn"), F.lit("asked").alias("role"),
        F.coalesce("question", F.lit("")).alias("text"),
    )
    led = multi_turn_context(turns, n).filter("turn.now")
    thread = F.concat_ws("\n", F.nullif(F.regexp_replace("history", "(?m)^asked: ", ""), F.lit("")), "text")
    return led.select(F.col("turn.id").alias("id"), F.col("conv_id").alias("user_id"), thread.alias("question"), F.col("turn.timestamp").alias("timestamp"))


def sql_of_answers(answers: DataFrame, limit: int = 100) -> DataFrame:
    """Add `sql`, `capped_sql`, `verdict` and the status after extraction and screening."""
    held = answers.withColumn("sql", extract_sql(F.col("answer"))).drop("status")
    return guard_statements(held).withColumn("capped_sql", F.when(F.col("sql") != "", cap_rows(F.col("sql"), limit)))


def sql_grounding(answers: DataFrame) -> DataFrame:
    """Tables a statement names that its documents do not; needs (sql, tables)."""
    named = named_tables(F.col("sql"))
    allowed = F.transform(F.coalesce("tables", F.array().cast("array<string>")), F.lower)
    return answers.withColumn("violations", F.array_except(named, allowed)).withColumn(
        "grounded", F.size("violations") == 0
    )


def ask_and_execute(
    questions: DataFrame, docs: DataFrame, index: TextIndex, k: int = DEFAULT_K, limit: int = 100
) -> Iterator[tuple[dict, Run]]:
    """Ask, cut the SQL out of the answers and run it: (answer row, run) per question.

    Answers come to the driver one partition at a time, since each statement is a query of
    its own; results stay lazy. The table of questions is what a person would ask, the
    documents and the data may be of any size.
    """
    answers = sql_of_answers(ask_batch(questions, docs, index, k), limit).checkpoint()
    for row in answers.toLocalIterator():
        answer = row.asDict()
        if answer["sql"] == "":
            yield answer, Run("", "no_sql")
        else:
            yield answer, execute_query(docs.sparkSession, answer["sql"], limit)


def execute_answers(
    questions: DataFrame, docs: DataFrame, index: TextIndex, k: int = DEFAULT_K, limit: int = 100
) -> DataFrame:
    """Ask and execute for a whole table of questions: one row each, with (question_id, question, answer_doc, sql, status,
    reason, rows, checksum).

    Equal statements run once. What passes through the driver is their texts, one partition at a time, and a row
    of outcome for each; result rows are counted and summed up (without regard to order) where they are.
    """
    answers = sql_of_answers(ask_batch(questions, docs, index, k), limit).checkpoint()
    told = statement_outcomes(answers, "sql", limit).drop("seconds")
    without = F.when(F.col("answer_doc").isNull(), "no_context").otherwise("no_sql")
    return answers.select("question_id", "question", "answer_doc", "sql").join(told, "sql", "left").select(
        "question_id", "question", "answer_doc", "sql", F.coalesce("status", without).alias("status"), "reason", "rows", "checksum"
    )


def multi_turn_context(turns: DataFrame, n: int = 3, block: int = 1024) -> DataFrame:
    """Add `history`: the `n` turns before each turn of its conversation, oldest first.

    `turns` has (conv_id, turn, role, text). A conversation is cut into blocks of turns; the
    last `n` turns of a block are copied into the next, so no task holds a conversation whole.
    """
    if not 0 < n < block:
        raise ValueError("n must be positive and smaller than a block")
    placed = running_number(turns, ["conv_id"], ["turn"], "_n").withColumn(
        "_block", F.floor((F.col("_n") - 1) / block)
    )
    reaches_next = F.pmod(F.col("_n") - 1, F.lit(block)) >= block - n
    copied = placed.withColumn(
        "_in", F.explode(F.when(reaches_next, F.array("_block", F.col("_block") + 1)).otherwise(F.array("_block")))
    )
    before = W.partitionBy("conv_id", "_in").orderBy("_n").rowsBetween(-n, -1)
    line = F.concat(F.col("role"), F.lit(": "), F.col("text"))
    return (
        copied.withColumn("history", F.array_join(F.collect_list(line).over(before), "\n"))
        .filter("_in = _block")
        .select("conv_id", "turn", "role", "text", "history")
    )
