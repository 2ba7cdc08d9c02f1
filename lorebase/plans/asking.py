"""From questions to context, prompt, answer, SQL and result."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorebase.functions import text as t
from lorebase.operators import ask, guard, usage as u
from lorebase.operators.retrieval import search_topk_text
from lorebase.plans.business import TOP, WITH
from lorebase.plans.knowledge import kept_index
from lorebase.plans.registry import query
from lorebase.plans.sql import ALL_QUESTIONS, FULL_KB, text, tfidf
from lorebase.session import scratch_path
from lorebase.sources import bindings as b
from lorebase.sources.notes import BUSINESS_QUESTIONS
from lorebase.sources.tables import read_table, register_business_views

# Retrieval of the five best documents of the whole knowledge base for all questions.
ASKED = f"""{FULL_KB}, {tfidf("full_kb", ALL_QUESTIONS)},
found AS (SELECT h.question_id, h.rank, f.* FROM hits h JOIN full_kb f USING (doc_id) WHERE h.rank <= 5)"""
CONTEXT = f"""{ASKED}, ctx AS (
  SELECT question_id, question,
    coalesce(string_agg('Document: ' || title || chr(10) || 'Type: ' || doc_type || chr(10) || content, chr(10) || chr(10) ORDER BY rank), '') AS context,
    coalesce(string_agg(doc_id, ',' ORDER BY rank), '') AS context_docs
  FROM questions LEFT JOIN found USING (question_id) GROUP BY 1, 2)"""
HOLDS_SQL = "regexp_matches(content, '(?is)\\bselect\\s.*\\sfrom\\s')"
ANSWERED = f"""{ASKED}, best AS (
  SELECT question_id, doc_id AS answer_doc, content AS answer FROM found
  QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY {HOLDS_SQL} DESC, rank) = 1),
answered AS (
  SELECT q.question_id, q.question, answer_doc, coalesce(answer, '') AS answer,
    CASE WHEN answer_doc IS NULL THEN 'no_context' ELSE 'ok' END AS status
  FROM questions q LEFT JOIN best USING (question_id))"""


def full_index(spark, folder):
    return kept_index(spark, folder, "full", lambda: b.full_kb(spark, folder))


def _asked(spark, folder):
    """Questions, knowledge base and what retrieval finds for them."""
    questions = ask.clean_questions(b.all_questions(spark, folder))
    docs = b.full_kb(spark, folder)
    return questions, docs, ask.retrieve_context(questions, docs, full_index(spark, folder))


@query("assemble_context", f"WITH {CONTEXT} SELECT * FROM ctx")
def _(spark, folder):
    questions, _, found = _asked(spark, folder)
    return ask.assemble_context(questions, found).withColumn("context_docs", F.array_join("context_docs", ","))


@query(
    "context_optional",
    f"""WITH {ASKED} SELECT question_id, count(doc_id) AS documents, min_by(title, rank) AS first_title,
      coalesce(string_agg(array_to_string(tags, '+'), ',' ORDER BY rank), '') AS tags
    FROM questions LEFT JOIN found USING (question_id) GROUP BY 1""",
)
def _(spark, folder):
    questions, _, found = _asked(spark, folder)
    rows = ask.context_optional(questions, found, return_context=True)
    return rows.select(
        "question_id",
        F.coalesce(F.size("context"), F.lit(0)).cast("bigint").alias("documents"),
        F.get("context", F.lit(0))["title"].alias("first_title"),
        F.coalesce(F.array_join(F.transform("context", lambda c: F.array_join(c["tags"], "+")), ","), F.lit("")).alias("tags"),
    )


_RULES = "\n".join(f"{n}. {rule}" for n, rule in enumerate(ask.PROMPT_RULES, 1))
PROMPT = f"""{text(ask.PROMPT_HEAD + chr(10) * 2 + 'NOTES:' + chr(10))} || context || {text(chr(10) * 2 + 'QUESTION:' + chr(10))} || question ||
  {text(chr(10) * 2 + 'RULES:' + chr(10) + _RULES + chr(10) * 2 + ask.PROMPT_TAIL)}"""


@query(
    "build_prompt",
    f"WITH {CONTEXT} SELECT question_id, {PROMPT} AS prompt FROM ctx",
)
def _(spark, folder):
    questions, _, found = _asked(spark, folder)
    return ask.build_prompt(ask.assemble_context(questions, found)).select("question_id", "prompt")


@query("answer_grounded", f"WITH {ANSWERED} SELECT * FROM answered")
def _(spark, folder):
    questions, _, found = _asked(spark, folder)
    return ask.answer_grounded(questions, found).drop("context_docs")


@query(
    "ask_batch",
    f"""WITH {ANSWERED}, listed AS (SELECT question_id, string_agg(doc_id, ',' ORDER BY rank) AS context_docs FROM found GROUP BY 1)
    SELECT question_id, question, context_docs, answer_doc, answer, status FROM answered LEFT JOIN listed USING (question_id)""",
)
def _(spark, folder):
    docs = b.full_kb(spark, folder)
    answers = ask.ask_batch(b.all_questions(spark, folder), docs, full_index(spark, folder))
    return answers.withColumn("context_docs", F.array_join("context_docs", ","))


_KEY = "regexp_replace(lower(regexp_replace(question, '\\s+', ' ', 'g')), '[?!. ]+$', '')"


@query(
    "ask_logged",
    f"""WITH {ANSWERED}, listed AS (SELECT question_id, string_agg(doc_id, ',' ORDER BY rank) AS context_docs FROM found GROUP BY 1),
    told AS (SELECT CAST(substr(question_id, 2) AS BIGINT) AS item, question, answer, coalesce(context_docs, '') AS context_docs, status, {_KEY} AS key
      FROM answered LEFT JOIN listed USING (question_id) WHERE regexp_matches(question_id, '^b[0-9]+$')),
    kept AS (SELECT DISTINCT key FROM told WHERE item % 2 = 0 AND status = 'ok')
    SELECT 'first' AS batch, item AS id, item % 7 AS user_id, question, answer, context_docs, status FROM told WHERE item % 2 = 0
    UNION ALL SELECT 'second', item + 1000000, item % 7, question, answer, CASE WHEN kept.key IS NULL THEN context_docs ELSE '' END,
      CASE WHEN kept.key IS NULL THEN status ELSE 'cached' END FROM told LEFT JOIN kept USING (key)
    UNION ALL SELECT 'third', item + 2000000, item % 7, question, answer, context_docs, status FROM told WHERE item % 5 = 0""",
)
def _(spark, folder):
    """Every second question, all of them half an hour later, some again two hours later; each batch is sent twice and logged once."""
    docs, log = b.full_kb(spark, folder), scratch_path(spark, "asked")
    item = F.expr("substr(question_id, 2)").cast("bigint")
    asked = b.benchmark_questions(spark, folder).select(item.alias("item"), "question")
    batches = [("first", "item % 2 = 0", "09:00"), ("second", "true", "09:30"), ("third", "item % 5 = 0", "11:30")]
    for n, (name, which, at) in enumerate(batches):
        requests = asked.filter(which).select(
            (F.col("item") + n * 1_000_000).alias("id"), (F.col("item") % 7).alias("user_id"), "question",
            F.lit(f"2024-03-01 {at}:00").cast("timestamp").alias("timestamp"),
        )
        for _ in range(2):
            ask.ask_logged(requests, docs, full_index(spark, folder), log, name)
    rows = u.read_batches(spark, log)
    return rows.select("batch", "id", "user_id", "question", "answer", F.array_join("context_docs", ",").alias("context_docs"), "status")


@query(
    "answer_with",
    f"""WITH {CONTEXT} SELECT question_id, question, 'prompt of ' || length({PROMPT}) || ' characters' AS answer, 'ok' AS status FROM ctx""",
)
def _(spark, folder):
    questions, _, found = _asked(spark, folder)
    prompts = ask.build_prompt(ask.assemble_context(questions, found))
    return ask.answer_with(prompts, lambda batch: batch.str.len().map("prompt of {} characters".format))


@query("ask_and_execute", f"{WITH} {TOP.format(where='')}")
def _(spark, folder):
    """The second business question, answered out of the whole knowledge base and run on the whole tables."""
    register_business_views(spark, folder)
    docs = b.full_kb(spark, folder)
    wanted = spark.createDataFrame([BUSINESS_QUESTIONS[1]], "question_id string, question string")
    for _, run in ask.ask_and_execute(wanted, docs, full_index(spark, folder)):
        if run.result is None:
            raise RuntimeError(f"{run.status}: {run.reason}")
        return run.result


@query(
    "ask_and_execute_all",
    f"""WITH {ANSWERED} SELECT question_id, answer_doc,
      CASE WHEN answer_doc IS NULL THEN 'no_context' WHEN contains(answer, 'SELECT ') THEN 'ok'
        -- Documents: a line that begins with one of the two words is taken for a statement and does not parse. So are the
        -- letters of select inside, but where they only begin a word they are no query.
        WHEN regexp_matches(answer, '(?i)(?:^|\\n)[ \\t]*(?:select|with)\\b') THEN 'failed'
        WHEN NOT contains(lower(answer), 'select') THEN 'no_sql'
        WHEN regexp_matches(regexp_extract(lower(answer), 'select.?', 0), 'select\\w') THEN 'rejected' ELSE 'failed' END AS status,
      CASE WHEN contains(answer, 'SELECT ') THEN CASE answer_doc WHEN 'ask_best_customers' THEN 10 ELSE 1 END END AS rows
    FROM answered""",
)
def _(spark, folder):
    """Every question, about the business and out of the benchmark, from retrieval to the rows of its statement."""
    register_business_views(spark, folder)
    docs = b.full_kb(spark, folder)
    done = ask.execute_answers(b.all_questions(spark, folder), docs, full_index(spark, folder))
    return done.select("question_id", "answer_doc", "status", F.col("rows").cast("int").alias("rows"))


@query(
    "execute_query",
    f"""{WITH} SELECT region, customer_segment, count(*) AS orders_completed, round(sum(order_amount), 2) AS revenue
    FROM done JOIN cust USING (customer_id) GROUP BY ALL""",
)
def _(spark, folder):
    register_business_views(spark, folder)
    statement = """
        WITH done AS (SELECT customer_id, order_amount FROM orders WHERE order_status = 'completed')
        SELECT c.region, c.customer_segment, count(*) AS orders_completed, round(sum(d.order_amount), 2) AS revenue
        FROM done d JOIN customers c ON d.customer_id = c.customer_id
        GROUP BY c.region, c.customer_segment;
    """
    run = guard.execute_query(spark, statement, limit=None)
    if run.result is None:
        raise RuntimeError(f"{run.status}: {run.reason}")
    return run.result


# --- SQL in answers ---------------------------------------------------------------------

ANSWERS = """answers AS (
  SELECT c_custkey AS answer_id, c_mktsegment, CASE c_custkey % 10
    WHEN 0 THEN 'Here it is.' || chr(10) || chr(10) || '```sql' || chr(10) || 'SELECT order_id, order_amount' || chr(10) || 'FROM orders' || chr(10)
      || 'WHERE customer_id = ' || c_custkey || chr(10) || '```' || chr(10) || 'One row per order.'
    WHEN 1 THEN 'SELECT count(*) AS n FROM orders WHERE customer_id = ' || c_custkey || ';' || chr(10) || chr(10) || 'This counts the orders.'
    WHEN 2 THEN 'Run' || chr(10) || 'select order_id from orders where customer_id = ' || c_custkey || ' order by order_id LIMIT 5'
    WHEN 3 THEN 'Like this:' || chr(10) || '```' || chr(10)
      || 'WITH spend AS (SELECT customer_id, sum(order_amount) AS total FROM orders GROUP BY customer_id)' || chr(10) || chr(10)
      || 'SELECT total FROM spend WHERE customer_id = ' || c_custkey || chr(10) || '```'
    WHEN 4 THEN 'In der Straße: SELECT customer_name FROM customers WHERE customer_id = ' || c_custkey
    WHEN 5 THEN 'SELECT customer_name, credit_limit FROM customers JOIN accounts USING (customer_id) WHERE customer_id = ' || c_custkey
    WHEN 6 THEN 'SELECT o.order_id FROM customers c, `secret_orders` AS o WHERE c.note = ''from nowhere'' AND o.order_id = ' || c_custkey
    WHEN 7 THEN 'SELECT order_id FROM orders ORDER BY order_id LIMIT 5 OFFSET ' || c_custkey
    WHEN 8 THEN 'SELECT order_id FROM orders WHERE customer_id = ' || c_custkey || ' -- not from payments'
    ELSE 'Nothing is known about ' || c_name || '.' END AS answer
  FROM customer),
fenced AS (SELECT *, trim(regexp_extract(answer, '(?is)```[ \\t]*(?:sql)?\\s*((?:select|with)\\b.*?)```', 1), E' \\n\\t') AS f,
  regexp_extract(answer, '(?is)(?:^|\\n)[ \\t]*((?:select|with)\\b.*)', 1) AS l,
  regexp_extract(answer, '(?is)(select.*)', 1) AS p FROM answers),
cut AS (SELECT answer_id, c_mktsegment, f,
  trim(split_part(split_part(l, '```', 1), chr(10) || chr(10), 1), E' \\n\\t') AS l,
  trim(split_part(split_part(p, '```', 1), chr(10) || chr(10), 1), E' \\n\\t') AS p FROM fenced),
extracted AS (SELECT answer_id, c_mktsegment, CASE WHEN f <> '' THEN f WHEN l <> '' THEN l ELSE p END AS sql, p AS literal FROM cut)"""


@query(
    "extract_sql",
    f"WITH {ANSWERS} SELECT answer_id, sql, CASE WHEN sql = '' THEN 'no_sql' ELSE 'ok' END AS status FROM extracted",
)
def _(spark, folder):
    sql = t.extract_sql(F.col("answer"))
    return b.answers(spark, folder).select("answer_id", sql.alias("sql")).withColumn(
        "status", F.when(F.col("sql") == "", "no_sql").otherwise("ok")
    )


@query("extract_sql_literal", f"WITH {ANSWERS} SELECT answer_id, literal AS sql FROM extracted")
def _(spark, folder):
    return b.answers(spark, folder).select("answer_id", t.cut_answer_literal(F.col("answer")).alias("sql"))


@query(
    "sql_row_cap",
    f"""WITH {ANSWERS} SELECT answer_id, CASE WHEN answer_id % 10 IN (2, 7) THEN sql
      WHEN answer_id % 10 = 8 THEN split_part(sql, ' --', 1) || ' LIMIT 100'
      ELSE regexp_replace(sql, '[;\\s]+$', '') || ' LIMIT 100' END AS sql FROM extracted WHERE sql <> ''""",
)
def _(spark, folder):
    held = b.answers(spark, folder).select("answer_id", t.extract_sql(F.col("answer")).alias("sql")).filter("sql <> ''")
    return held.select("answer_id", t.cap_rows(F.col("sql"), 100).alias("sql"))


@query(
    "sql_guard",
    """SELECT c_custkey AS statement_id,
      CASE c_custkey % 10 WHEN 0 THEN 'ok' WHEN 5 THEN 'ok' WHEN 7 THEN 'ok' WHEN 9 THEN 'no_sql' ELSE 'rejected' END AS status,
      CASE c_custkey % 10 WHEN 1 THEN 'not_a_query' WHEN 2 THEN 'several_statements' WHEN 3 THEN 'denied_function'
        WHEN 4 THEN 'path_as_table' WHEN 6 THEN 'not_a_query' WHEN 8 THEN 'writes' WHEN 9 THEN 'no_sql' ELSE 'ok' END AS verdict
    FROM customer""",
)
def _(spark, folder):
    return guard.guard_statements(b.statements(spark, folder)).select("statement_id", "status", "verdict")


@query(
    "sql_grounding",
    """WITH named AS (SELECT c_custkey AS answer_id, c_mktsegment, CASE c_custkey % 10
        WHEN 4 THEN ['customers'] WHEN 5 THEN ['accounts', 'customers'] WHEN 6 THEN ['customers', 'secret_orders']
        ELSE ['orders'] END AS used FROM customer WHERE c_custkey % 10 <> 9),
    bad AS (SELECT answer_id, list_filter(used, lambda x: NOT list_contains(
        CASE c_mktsegment WHEN 'BUILDING' THEN ['customers', 'orders'] ELSE ['orders'] END, x)) AS v FROM named)
    SELECT answer_id, coalesce(array_to_string(v, ','), '') AS violations, len(v) = 0 AS grounded FROM bad""",
)
def _(spark, folder):
    held = b.answers(spark, folder).withColumn("sql", t.extract_sql(F.col("answer"))).filter("sql <> ''")
    return ask.sql_grounding(held).select("answer_id", F.array_join("violations", ",").alias("violations"), "grounded")


# Statements whose tables stand in subqueries, lists and conditions. Only customers and orders are documented.
NESTED = [
    "SELECT * FROM (SELECT order_id FROM orders WHERE customer_id = {}) s, secret",
    "SELECT 1 FROM customers c JOIN orders o ON c.customer_id = o.customer_id, payments WHERE c.customer_id = {}",
    "SELECT * FROM customers c, LATERAL (SELECT max(order_id) AS m FROM orders o WHERE o.customer_id = c.customer_id) z, plans WHERE z.m > {}",
    "WITH x AS (WITH y AS (SELECT * FROM orders) SELECT * FROM y JOIN refunds USING (order_id)), z AS (SELECT * FROM x)\nSELECT * FROM z WHERE customer_id = {}",
    "SELECT * FROM orders WHERE customer_id IN (SELECT customer_id FROM customers WHERE EXISTS (SELECT 1 FROM notes n WHERE n.i IN (1, {})))",
    "SELECT order_id FROM orders WHERE customer_id = {} UNION ALL (SELECT order_id FROM old_orders ORDER BY (SELECT max(i) FROM limits))",
    "SELECT extract(year FROM order_date), 'from nowhere, else' FROM orders /* from comments, more */ WHERE customer_id = {}",
    "SELECT * FROM ((customers c JOIN orders o ON c.customer_id = (o.customer_id + {}))), spare",
]


@query(
    "sql_grounding_nested",
    f"""WITH statements AS (SELECT c_custkey AS answer_id, replace(CASE c_nationkey % {len(NESTED)}
        {" ".join(f"WHEN {n} THEN {text(s)}" for n, s in enumerate(NESTED))} END, '{{}}', CAST(c_custkey AS VARCHAR)) AS sql FROM customer),
    parsed AS (SELECT answer_id, json_serialize_sql(sql) AS tree FROM statements),
    named AS (SELECT answer_id, list_distinct(json_extract_string(tree, '$..table_name')) AS used,
      json_extract_string(tree, '$..cte_map.map[*].key') AS defined FROM parsed),
    bad AS (SELECT answer_id, list_sort(list_filter(used, lambda x: NOT list_contains(defined, x) AND x NOT IN ('customers', 'orders'))) AS v FROM named)
    SELECT answer_id, coalesce(array_to_string(v, ','), '') AS violations, len(v) = 0 AS grounded FROM bad""",
)
def _(spark, folder):
    shape = F.get(F.array(*[F.lit(s) for s in NESTED]), (F.col("c_nationkey") % len(NESTED)).cast("int"))
    held = read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("answer_id"),
        F.replace(shape, F.lit("{}"), F.col("c_custkey").cast("string")).alias("sql"),
        F.array(F.lit("customers"), F.lit("orders")).alias("tables"),
    )
    return ask.sql_grounding(held).select("answer_id", F.array_join("violations", ",").alias("violations"), "grounded")


# --- conversations and personal data ----------------------------------------------------


@query(
    "multi_turn_context",
    """SELECT conv_id, turn, role, text,
      coalesce(string_agg(role || ': ' || text, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), '') AS history
    FROM conversations""",
)
def _(spark, folder):
    return ask.multi_turn_context(read_table(spark, folder, "conversations"), 3)


@query(
    "mask_pii",
    f"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '{t.EMAIL}', '[EMAIL]', 'g'),
        '{t.IPV6}', '[IP]', 'g'), '{t.IPV4}', '[IP]', 'g'), '{t.PHONE}', '[PHONE]', 'g'), '{t.NUMBER}', '[NUMBER]', 'g') AS masked,
      len(regexp_extract_all(text, '{t.EMAIL}')) AS emails, len(regexp_extract_all(text, '{t.IPV4}')) AS addresses,
      len(regexp_extract_all(text, '{t.PHONE}')) AS phones
    FROM documents""",
)
def _(spark, folder):
    count = lambda pattern: F.regexp_count("text", F.lit(pattern)).cast("bigint")
    return b.documents(spark, folder).select(
        "doc_id", t.mask_pii(F.col("text")).alias("masked"), count(t.EMAIL_AT_START).alias("emails"), count(t.IPV4).alias("addresses"),
        count(t.PHONE).alias("phones"),
    )
