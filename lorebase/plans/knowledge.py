"""The documentation table: loading, live rows, sync, chunks, search, schema documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorebase.operators import retrieval as r
from lorebase.plans.registry import query
from lorebase.plans.sql import KB, LIVE_EVENTS, SCHEMA_COLUMNS, text, tfidf
from lorebase.session import exists, kept_path, scratch_path, written
from lorebase.sources import bindings as b
from lorebase.sources import kb
from lorebase.sources.tables import read_table
from lorebase.streaming.sync import run_kb_sync
from lorebase.streaming.usage import read_stream


def kept_index(spark, folder, name, docs, unit=None):
    """The search index of a table of texts, written by the first query that needs it and read by the others.

    It is kept for this application, during which the tables of a folder are taken not to change.
    """
    path = kept_path(spark, f"index-{name}", folder)
    if not exists(spark, f"{path}/figures/_SUCCESS"):
        whole = docs()
        parts = kb.parts_of(whole)
        texts = whole.repartition(parts, "doc_id")
        texts = texts if unit is None else r.chunk_documents(texts)
        r.write_index(kb.write_postings(texts, f"{path}/postings", unit, parts), path, unit, parts)
    return r.read_index(spark, path)


def document_index(spark, folder):
    return kept_index(spark, folder, "documents", lambda: b.document_kb(spark, folder, dealt=False))


# --- the table --------------------------------------------------------------------------

KB_FIELDS = """doc_id, doc_type, title, content, metadata, array_to_string(tags, ',') AS tags,
  len(tables) AS n_tables, created_at, updated_at"""


def _flat(docs):
    return docs.select(
        "doc_id", "doc_type", "title", "content", "metadata", F.array_join("tags", ",").alias("tags"),
        F.size("tables").cast("bigint").alias("n_tables"), "created_at", "updated_at",
    )


@query("kb_load", f"WITH {KB} SELECT {KB_FIELDS} FROM kb")
def _(spark, folder):
    path = scratch_path(spark, "kb")
    kb.write_kb(b.document_kb(spark, folder), path)
    return _flat(kb.read_kb(spark, path))


@query(
    "kb_append",
    f"""WITH {KB}, added AS (SELECT 'page_' || page_id AS doc_id, 'page' AS doc_type, url AS title, html AS content FROM pages)
    SELECT doc_id, doc_type, title, content, 'src' AS source, CAST(0 AS BIGINT) AS seq FROM kb
    UNION ALL SELECT doc_id, doc_type, title, content, 'user_added', 1 FROM added""",
)
def _(spark, folder):
    path = scratch_path(spark, "kb")
    kb.write_kb(b.document_kb(spark, folder), path, seq=0)
    kb.write_kb(kb.new_documents(b.added_pages(spark, folder), stamp=b.LATER_STAMP), path, seq=1, mode="append")
    source = kb.metadata_source("metadata")
    return kb.read_kb(spark, path).select(
        "doc_id", "doc_type", "title", "content",
        F.when(F.startswith(source, F.lit("src")), "src").otherwise(source).alias("source"), "seq",
    )


@query(
    "kb_current",
    f"""WITH {KB}, versions AS (
      SELECT doc_id, title, updated_at, CAST(0 AS BIGINT) AS seq FROM kb
      UNION ALL SELECT kb.doc_id, 'again: ' || title,
        CASE quality WHEN 1 THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-01' END, 1
        FROM kb JOIN labels ON kb.doc_id = CAST(labels.doc_id AS VARCHAR))
    SELECT doc_id, title, updated_at, seq FROM versions
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY updated_at DESC, seq DESC) = 1""",
)
def _(spark, folder):
    first = b.document_kb(spark, folder).withColumn("seq", F.lit(0).cast("bigint"))
    versions = first.unionByName(b.readded_documents(spark, folder)).select("doc_id", "title", "updated_at", "seq")
    return kb.current_documents(versions)


@query("kb_scan", f"WITH {KB} SELECT doc_id, doc_type, title, length(content) AS n_chars FROM kb")
def _(spark, folder):
    return b.document_kb(spark, folder).select(
        "doc_id", "doc_type", "title", F.length("content").cast("bigint").alias("n_chars")
    )


@query(
    "kb_sync_plan",
    """WITH now AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, sha256(text) AS new_hash FROM documents),
    earlier AS (
      SELECT CAST(doc_id AS VARCHAR) AS doc_id, sha256(CASE quality WHEN 0 THEN text || ' (earlier)' ELSE text END) AS old_hash
      FROM documents JOIN labels USING (doc_id)
      UNION ALL SELECT 'page_' || page_id, sha256(html) FROM pages)
    SELECT doc_id, CASE WHEN old_hash IS NULL THEN 'insert' WHEN new_hash IS NULL THEN 'delete'
      WHEN old_hash <> new_hash THEN 'update' ELSE 'unchanged' END AS action, new_hash
    FROM now FULL JOIN earlier USING (doc_id)""",
)
def _(spark, folder):
    return kb.sync_plan(b.document_kb(spark, folder), b.earlier_index(spark, folder))


WORD = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]+')"


@query(
    "kb_sync_apply",
    f"""WITH t AS (SELECT doc_id, text, unnest({WORD.format("text")}) AS term FROM documents)
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, sha256(any_value(text)) AS content_hash, count(DISTINCT term) AS terms, count(*) AS tokens
    FROM t GROUP BY 1""",
)
def _(spark, folder):
    """Documents are added, changed, deleted or left as they are by two syncs; the second is carried out twice."""
    path = scratch_path(spark, "index")
    for number, docs in ((0, b.earlier_documents(spark, folder)), (1, b.document_kb(spark, folder, dealt=False)), (1, b.document_kb(spark, folder, dealt=False))):
        kb.sync_index(docs.select("doc_id", "content", "updated_at"), path, number)
    live, postings = kb.live_index(spark, path)
    counts = postings.groupBy("doc_id").agg(F.count(F.lit(1)).alias("terms"), F.sum("tf").alias("tokens"))
    return live.select("doc_id", "content_hash").join(counts, "doc_id")


@query(
    "kb_compaction",
    f"""WITH earlier AS (
      SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE quality WHEN 0 THEN text || ' (earlier)' ELSE text END AS content
      FROM documents JOIN labels USING (doc_id)
      UNION ALL SELECT 'page_' || page_id, html FROM pages),
    states AS (SELECT 'opened before' AS state, * FROM earlier UNION ALL SELECT 'synced after', CAST(doc_id AS VARCHAR), text FROM documents),
    t AS (SELECT state, doc_id, content, unnest({WORD.format("content")}) AS term FROM states)
    SELECT state, doc_id, sha256(any_value(content)) AS content_hash, count(DISTINCT term) AS terms, count(*) AS tokens FROM t GROUP BY 1, 2""",
)
def _(spark, folder):
    """Two syncs with a compaction after each; the first state is opened before the first compaction and read after the last."""
    path = scratch_path(spark, "index")
    kept = ["doc_id", "content", "updated_at"]
    kb.sync_index(b.earlier_documents(spark, folder).select(*kept), path, 0)
    before = kb.live_index(spark, path)
    kb.compact_in_place(spark, path, 0)
    kb.sync_index(b.document_kb(spark, folder, dealt=False).select(*kept), path, 1)
    kb.compact_in_place(spark, path, 1)
    out = None
    for state, (live, postings) in (("opened before", before), ("synced after", kb.live_index(spark, path))):
        counts = postings.groupBy("doc_id").agg(F.count(F.lit(1)).alias("terms"), F.sum("tf").alias("tokens"))
        rows = live.select(F.lit(state).alias("state"), "doc_id", "content_hash").join(counts, "doc_id")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("kb_metadata", "SELECT source, count(*) AS documents, min(doc_id) AS first_id FROM documents GROUP BY 1")
def _(spark, folder):
    docs = b.document_kb(spark, folder)
    return docs.groupBy(kb.metadata_source("metadata").alias("source")).agg(
        F.count(F.lit(1)).alias("documents"), F.min(F.col("doc_id").cast("bigint")).alias("first_id")
    )


@query("doc_type_counts", "SELECT lang AS doc_type, count(*) AS documents FROM documents GROUP BY 1")
def _(spark, folder):
    return b.document_kb(spark, folder).groupBy("doc_type").agg(F.count(F.lit(1)).alias("documents"))


@query(
    "doc_filter_tags",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang AS doc_type, source || ',' || lang AS tags FROM documents
    WHERE lang = 'en' AND source IN ('src1', 'src2')""",
)
def _(spark, folder):
    found = r.filter_documents(b.document_kb(spark, folder), doc_type="en", any_tags=["src1", "src2"])
    return found.select("doc_id", "doc_type", F.array_join("tags", ",").alias("tags"))


# --- chunks, vectors, search ------------------------------------------------------------


@query(
    "chunk_documents",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, i AS chunk_no, substr(text, 1 + 450 * i, 500) AS content
    FROM (SELECT doc_id, text, unnest(range(greatest(1, CAST(ceil((length(text) - 50) / 450.0) AS BIGINT)))) AS i
      FROM documents WHERE length(text) > 0)""",
)
def _(spark, folder):
    return r.chunk_documents(b.document_kb(spark, folder)).withColumn("chunk_no", F.col("chunk_no").cast("bigint"))


@query("embed_tfidf", f"WITH {tfidf()} SELECT doc_id, term, round(weight, 6) AS weight FROM doc_weights")
def _(spark, folder):
    weights = r.embed_tfidf(document_index(spark, folder))
    return weights.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query("search_topk_text", f"WITH {tfidf()} SELECT question_id, doc_id, score, rank FROM hits WHERE rank <= 5")
def _(spark, folder):
    index = document_index(spark, folder)
    return r.search_topk_text(b.benchmark_questions(spark, folder), index, 5)


@query(
    "relevance_filter",
    f"WITH {tfidf()} SELECT question_id, doc_id, score, rank FROM hits WHERE rank <= 5 AND score >= 0.3",
)
def _(spark, folder):
    index = document_index(spark, folder)
    return r.search_topk_text(b.benchmark_questions(spark, folder), index, 5, threshold=0.3)


CHUNKS = """chunked AS (
  SELECT CAST(doc_id AS VARCHAR) AS doc_id, i AS chunk_no, substr(text, 1 + 450 * i, 500) AS content
  FROM (SELECT doc_id, text, unnest(range(greatest(1, CAST(ceil((length(text) - 50) / 450.0) AS BIGINT)))) AS i
    FROM documents WHERE length(text) > 0))"""


@query(
    "search_chunk_rollup",
    f"""WITH {CHUNKS}, {tfidf("chunked", unit="doc_id, chunk_no")},
    best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY question_id, doc_id ORDER BY score DESC, chunk_no) = 1)
    SELECT question_id, doc_id, chunk_no, score, CAST(row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS INT) AS rank
    FROM best QUALIFY rank <= 5""",
)
def _(spark, folder):
    index = kept_index(spark, folder, "chunks", lambda: b.document_kb(spark, folder, dealt=False), ["doc_id", "chunk_no"])
    hits = r.search_chunk_rollup(b.benchmark_questions(spark, folder), index, 5)
    return hits.withColumn("chunk_no", F.col("chunk_no").cast("bigint"))


TOPICS = """topics AS (
  SELECT label AS question_id, dim, avg(CAST(x AS DOUBLE)) AS x
  FROM (SELECT label, unnest(embedding) AS x, unnest(range(64)) AS dim FROM embeddings) GROUP BY ALL),
topic_vec AS (SELECT question_id, list(x ORDER BY dim) AS q FROM topics GROUP BY 1),
cosines AS (SELECT CAST(question_id AS BIGINT) AS question_id, vec_id,
  round(list_inner_product(q, v) / sqrt(list_inner_product(q, q)) / sqrt(list_inner_product(v, v)), 6) AS score
  FROM topic_vec, (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings))"""


@query(
    "search_topk_vector",
    f"""WITH {TOPICS} SELECT *, CAST(row_number() OVER (PARTITION BY question_id ORDER BY score DESC, vec_id) AS INT) AS rank
    FROM cosines QUALIFY rank <= 5""",
)
def _(spark, folder):
    vectors = b.stored_vectors(spark, folder)
    return r.search_topk_vector(r.topic_vectors(vectors), vectors, 5)


@query("search_ann_vector")
def _(spark, folder):
    vectors = b.stored_vectors(spark, folder)
    return r.search_ann_vector(r.topic_vectors(vectors), vectors, 5)


@query(
    "retrieval_quality",
    f"""WITH {tfidf()}, truth AS (SELECT 'b' || item_id AS question_id, CAST(d.doc_id AS VARCHAR) AS doc_id
      FROM benchmark b JOIN documents d ON contains(d.text, b.text)),
    found AS (SELECT t.question_id, h.rank FROM truth t LEFT JOIN (SELECT * FROM hits WHERE rank <= 5) h USING (question_id, doc_id)),
    per AS (SELECT question_id, count(*) AS pairs, count(rank) AS hits, min(rank) AS first FROM found GROUP BY 1)
    SELECT count(*) AS questions, CAST(sum(pairs) AS BIGINT) AS pairs, round(sum(hits) / sum(pairs), 6) AS recall,
      round(avg(coalesce(1.0 / first, 0)), 6) AS mrr FROM per""",
)
def _(spark, folder):
    index = document_index(spark, folder)
    hits = r.search_topk_text(b.benchmark_questions(spark, folder), index, 5)
    return r.retrieval_quality(hits, b.known_pairs(spark, folder), 5)


@query(
    "related_documents",
    """WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source FROM documents),
    pairs AS (SELECT a.doc_id, c.doc_id AS related_id,
        CAST(a.lang = c.lang AS INT) + CAST(a.source = c.source AS INT) AS shared
      FROM d a JOIN (SELECT * FROM d WHERE lang = 'es') c ON a.doc_id <> c.doc_id AND (a.lang = c.lang OR a.source = c.source))
    SELECT doc_id, related_id, round(shared / (4.0 - shared), 6) AS score,
      CAST(row_number() OVER (PARTITION BY doc_id ORDER BY round(shared / (4.0 - shared), 6) DESC, related_id) AS INT) AS rank
    FROM pairs QUALIFY rank <= 3""",
)
def _(spark, folder):
    docs = b.document_kb(spark, folder)
    return r.related_documents(docs, r.filter_documents(docs, doc_type="es"), 3)


@query(
    "feedback_rerank",
    f"""WITH {tfidf()}, {LIVE_EVENTS},
    votes AS (SELECT unnest(context_docs) AS doc_id, CAST(thumbs_up AS INT) AS up FROM history WHERE thumbs_up IS NOT NULL),
    prior AS (SELECT doc_id, (sum(up) + 1) / (count(*) + 2) AS approval FROM votes GROUP BY 1),
    adjusted AS (SELECT question_id, doc_id, score, round(score * (1 + 0.5 * (coalesce(approval, 0.5) - 0.5)), 10) AS adjusted
      FROM hits LEFT JOIN prior USING (doc_id) WHERE rank <= 10)
    SELECT *, CAST(row_number() OVER (PARTITION BY question_id ORDER BY adjusted DESC, doc_id) AS INT) AS rank FROM adjusted""",
)
def _(spark, folder):
    index = document_index(spark, folder)
    hits = r.search_topk_text(b.benchmark_questions(spark, folder), index, 10)
    return r.feedback_rerank(hits, r.document_prior(b.history(spark, folder)))


# --- schema documents -------------------------------------------------------------------


@query("schema_columns", f"WITH {SCHEMA_COLUMNS} SELECT * FROM cols")
def _(spark, folder):
    return r.schema_columns(b.schema_kb(spark, folder))


@query(
    "schema_lookup",
    f"""WITH {SCHEMA_COLUMNS}, marked AS (SELECT *, (contains(lower(table_name), 'bolt') OR contains(lower(column_name), 'bolt')
        OR contains(lower(description), 'bolt')) AS m FROM cols)
    SELECT table_name, count(*) AS columns_total, count(*) FILTER (m) AS columns_matched,
      string_agg(column_name, ', ' ORDER BY column_name) FILTER (m) AS matched_names
    FROM marked GROUP BY 1 HAVING count(*) FILTER (m) > 0""",
)
def _(spark, folder):
    return r.schema_lookup(r.schema_columns(b.schema_kb(spark, folder)), "bolt")


SCHEMA_QUESTIONS = [
    ("s1", "What tables contain customer information?"),
    ("s2", "Where are email addresses?"),
    ("s3", "What columns are in customers?"),
    ("s4", "How many columns are in orders?"),
]


def schema_questions(spark, folder):
    """Four questions as people ask them, and one after the price of each kind of part."""
    kinds = read_table(spark, folder, "part").select(F.lower("p_type").alias("kind")).distinct()
    per_kind = kinds.select(
        F.concat(F.lit("k "), "kind").alias("question_id"), F.concat(F.lit("Which tables have the prices of "), "kind", F.lit(" kinds?")).alias("question")
    )
    return spark.createDataFrame(SCHEMA_QUESTIONS, "question_id string, question string").unionByName(per_kind)


def _words(value: str) -> str:
    """`schema_words` in SQL."""
    words = f"regexp_replace(lower({value}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')"
    for pattern, kept in (("(ss|x|ch|sh)es( |$)", "\\1\\2"), ("([a-z]{2}[a-rt-z])s( |$)", "\\1\\2")):
        words = f"regexp_replace({words}, '{pattern}', '{kept}', 'g')"
    return f"trim({words})"


_STOP = "[" + ", ".join(text(w) for w in r.QUESTION_WORDS) + "]"
_LEFT = f"list_filter(list_distinct(string_split({_words('question')}, ' ')), lambda w: NOT list_contains({_STOP}, w))"


@query(
    "schema_answers",
    f"""WITH {SCHEMA_COLUMNS}, fields AS (SELECT table_name, string_agg(
        repeat({_words("column_name")} || ' ', {r.COLUMN_WEIGHT}) || {_words("column_type")} || ' ' || {_words("description")}, ' ') AS content
      FROM cols GROUP BY 1),
    schema_texts AS (SELECT table_name AS doc_id, repeat({_words("table_name")} || ' ', {r.TABLE_WEIGHT}) || content AS content FROM fields),
    raw_questions AS (SELECT * FROM (VALUES {", ".join(f"({text(i)}, {text(q)})" for i, q in SCHEMA_QUESTIONS)}) AS v(question_id, question)
      UNION ALL SELECT DISTINCT 'k ' || lower(p_type), 'Which tables have the prices of ' || lower(p_type) || ' kinds?' FROM part),
    asked AS (SELECT question_id, {_LEFT} AS words FROM raw_questions),
    {tfidf("schema_texts", "SELECT question_id, array_to_string(words, ' ') AS question FROM asked")},
    seen AS (SELECT h.question_id, h.rank, h.score, c.table_name, c.position, c.column_name, c.column_type, a.words,
        list_distinct(string_split({_words("c.column_name || ' ' || c.column_type || ' ' || c.description")}, ' ')) AS own
      FROM hits h JOIN asked a USING (question_id) JOIN cols c ON c.table_name = h.doc_id WHERE h.rank <= 3)
    SELECT question_id, rank, table_name, (SELECT count(*) FROM cols c WHERE c.table_name = seen.table_name) AS columns_total, position,
      column_name, column_type, CAST(len(list_intersect(own, words)) AS INT) AS matched, score
    FROM seen WHERE len(list_intersect(own, words)) > 0 OR len(list_intersect(string_split({_words("table_name")}, ' '), words)) > 0""",
)
def _(spark, folder):
    columns = written(r.schema_columns(b.schema_kb(spark, folder)), "columns")
    index = kept_index(spark, folder, "schemas", lambda: written(r.schema_texts(columns), "schema-texts"))
    return r.schema_answers(schema_questions(spark, folder), columns, index, 3)


# --- streaming --------------------------------------------------------------------------


@query(
    "stream_kb_sync",
    f"""WITH v AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN text || ' once more' ELSE text END AS text FROM documents),
    t AS (SELECT doc_id, unnest({WORD.format("text")}) AS term FROM v)
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, count(DISTINCT term) AS terms, count(*) AS tokens FROM t GROUP BY 1""",
)
def _(spark, folder):
    """Two streams into one index: the second brings newer versions of the even documents and late ones of the others."""
    docs = b.documents(spark, folder)
    path = scratch_path(spark, "index")
    even = F.col("doc_id") % 2 == 0
    for number in range(2):
        stamp = F.when(even, b.LATER_STAMP).otherwise(b.EARLIER_STAMP) if number else F.lit(b.STAMP)
        versions = read_stream(spark, folder, "documents", docs.schema).select(
            F.col("doc_id").cast("string").alias("doc_id"),
            (F.concat("text", F.lit(" once more")) if number else F.col("text")).alias("content"),
            stamp.cast("timestamp").alias("updated_at"),
            F.lit(0).cast("bigint").alias("seq"),
        )
        run_kb_sync(versions, path, scratch_path(spark, "index-progress"))
    _, postings = kb.live_index(spark, path)
    return postings.groupBy("doc_id").agg(F.count(F.lit(1)).alias("terms"), F.sum("tf").alias("tokens"))
