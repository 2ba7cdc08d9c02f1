"""SQL fragments that several checks share."""

from __future__ import annotations

from lorebase.sources.notes import BUSINESS_DOCS, BUSINESS_QUESTIONS


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def texts(values: list[str]) -> str:
    return "CAST([" + ", ".join(text(v) for v in values) + "] AS VARCHAR[])"


KB = """kb AS (
  SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang AS doc_type, substr(text, 1, 60) AS title, text AS content,
    '{"source":"' || source || '"}' AS metadata, CAST([] AS VARCHAR[]) AS tables, [source, lang] AS tags,
    TIMESTAMP '2024-01-01' AS created_at, TIMESTAMP '2024-01-01' AS updated_at
  FROM documents)"""


def literal_docs() -> str:
    rows = ",\n".join(
        f"({text(d)}, {text(t)}, {text(title)}, {text(content)}, {texts(tables)}, {texts(tags)})"
        for d, t, title, content, tables, _, tags in BUSINESS_DOCS
    )
    return f"notes AS (SELECT * FROM (VALUES {rows}) AS v(doc_id, doc_type, title, content, tables, tags))"


FULL_KB = f"""{KB}, {literal_docs()},
full_kb AS (SELECT doc_id, doc_type, title, content, tables, tags FROM kb UNION ALL SELECT * FROM notes)"""

BENCHMARK = "SELECT 'b' || item_id AS question_id, text AS question FROM benchmark"
ALL_QUESTIONS = BENCHMARK + " UNION ALL SELECT * FROM (VALUES " + ", ".join(
    f"({text(i)}, {text(q)})" for i, q in BUSINESS_QUESTIONS if q.strip()
) + ") AS v(question_id, question)"


def tfidf(corpus: str | None = None, questions: str = BENCHMARK, unit: str = "doc_id", more: str = "") -> str:
    """CTEs from a corpus (unit, content) to `doc_weights`, `scores` and ranked `hits`."""
    source = corpus or "(SELECT CAST(doc_id AS VARCHAR) AS doc_id, text AS content FROM documents)"
    token = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+')"
    same_unit = unit
    return f"""postings AS (SELECT {unit}, term, count(*) AS tf
      FROM (SELECT {unit}, unnest({token.format("content")}) AS term FROM {source}) GROUP BY ALL),
    n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM (SELECT DISTINCT {unit} FROM postings)),
    dfs AS (SELECT term, count(*) AS df FROM postings GROUP BY 1),
    doc_raw AS (SELECT {unit}, term, (1 + ln(tf)) * (ln((1 + n) / (1 + df)) + 1) AS raw FROM postings JOIN dfs USING (term), n),
    doc_norm AS (SELECT {unit}, sqrt(sum(raw * raw)) AS norm FROM doc_raw GROUP BY ALL),
    doc_weights AS (SELECT {same_unit}, term, raw / norm AS weight FROM doc_raw JOIN doc_norm USING ({unit})),
    questions AS ({questions}),
    q_tf AS (SELECT question_id, term, count(*) AS tf
      FROM (SELECT question_id, unnest({token.format("question")}) AS term FROM questions) GROUP BY ALL),
    q_raw AS (SELECT question_id, term, (1 + ln(tf)) * (ln((1 + n) / (1 + coalesce(df, 0))) + 1) AS raw
      FROM q_tf LEFT JOIN dfs USING (term), n),
    q_norm AS (SELECT question_id, sqrt(sum(raw * raw)) AS norm FROM q_raw GROUP BY 1),
    q_weights AS (SELECT question_id, term, raw / norm AS qw FROM q_raw JOIN q_norm USING (question_id)),
    scores AS (SELECT question_id, {unit}, round(sum(weight * qw), 6) AS score
      FROM doc_weights JOIN q_weights USING (term) {more} GROUP BY ALL),
    hits AS (SELECT *, CAST(row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM scores)"""


LIVE_EVENTS = """history AS (
  SELECT event_id AS id, user_id, 'question ' || k AS question, 'answer ' || k AS answer,
    [k, CAST((CAST(k AS BIGINT) + user_id) % 100 AS VARCHAR)] AS context_docs, ts AS timestamp,
    value AS response_time_seconds,
    CASE event_type WHEN 'purchase' THEN true WHEN 'error' THEN false END AS thumbs_up,
    CASE event_type WHEN 'error' THEN 'failed' ELSE 'ok' END AS status
  FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events))"""

SCHEMA_COLUMNS = f"""{literal_docs()}, schema_docs AS (
  SELECT content FROM notes WHERE doc_type = 'schema'
  UNION ALL SELECT 'Table: stock_' || p_partkey || chr(10) || 'Description: What is left of ' || p_name || '.' || chr(10) || chr(10)
    || 'Columns:' || chr(10) || '- ' || split_part(p_name, ' ', 1) || '_id (BIGINT): Number of the ' || p_name || chr(10)
    || '- ' || split_part(p_name, ' ', 2) || '_size (DECIMAL(10,2)): Size of one piece' || chr(10)
    || '- ' || lower(p_type) || '_price (DOUBLE): Price of the ' || lower(p_type) || ' kind' || chr(10)
    || '- brand (ARRAY<STRING>): Always ' || p_brand || chr(10) FROM part),
lines AS (SELECT regexp_extract(content, 'Table: (\\w+)', 1) AS table_name,
    unnest(regexp_extract_all(content, '- \\w+ [^\\n]*')) AS line,
    CAST(unnest(range(1, 100)) AS INT) AS position FROM schema_docs),
cols AS (SELECT table_name, position, regexp_extract(line, '- (\\w+)', 1) AS column_name,
    substr(split_part(line, '): ', 1), strpos(line, '(') + 1) AS column_type, trim(regexp_extract(line, '\\): (.*)', 1)) AS description
  FROM lines WHERE line IS NOT NULL)"""
