"""The queries opN_<name>, each next to the SQL it is checked against where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorebase.llm import decontam, langid, lines, lm, nearest, packing, phrases, pii, quality, setsketch, simhash, spelling, url_rules
from lorebase.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401

BLANK_CHARS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


URL_RULES = [
    url_rules.Rule("block", "net", "/"),
    url_rules.Rule("allow", "example.net", "/en/"),
    url_rules.Rule("block", "example.com", "/de/"),
    url_rules.Rule("allow", "org", "/fr/"),
]


@query(
    "op1_url_filter",
    f"""WITH rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parts AS (SELECT page_id, {LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
    judged AS (SELECT *, CASE
      WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts)
    SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
    FROM judged""",
)
def url_filter(spark, folder):
    return url_rules.judge_urls(table(spark, folder, "pages"), URL_RULES)


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Where a public tokenizer lies on this machine; the same on all machines of a cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_best_fit_packing")
def best_fit_packing(spark, folder):
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer())


@query(
    "op3_nearest_vectors",
    """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
    FROM pairs QUALIFY rank <= 20""",
)
def nearest_vectors(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return nearest.nearest(vectors, vectors["vec_id"] % 20 == 0, k=20)


@query("op4_decontamination")
def decontamination(spark, folder):
    return decontam.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def span_text(spans):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op5_personal_data")
def personal_data(spark, folder):
    found = pii.find_personal_data(table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(kind) for kind in pii.PATTERNS],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.concat("base", "added")).alias("spans"),
    )


@query("op6_language_id")
def language_id(spark, folder):
    docs = table(spark, folder, "documents")
    model = langid.train(docs.filter(~langid.held_out(docs["doc_id"])))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op7_simhash")
def near_duplicates(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op8_lm_score")
def lm_score(spark, folder):
    docs = table(spark, folder, "documents")
    scored = lm.score_documents(docs, ~lm.held_out(docs["doc_id"]))
    return scored.select("doc_id", lm.held_out(F.col("doc_id")).alias("held_out"), *scored.columns[1:])


@query("op9_quality")
def document_quality(spark, folder):
    return quality.classify(table(spark, folder, "documents"))


@query(
    "op10_line_dedup",
    f"""WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
    lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM parts),
    keyed AS (SELECT *, {LOWER.format(f"trim(line, {BLANK_CHARS})")} AS key FROM lines),
    repeated AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3),
    marked AS (SELECT doc_id, pos, line, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM keyed LEFT JOIN repeated USING (key))
    SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY 1""",
)
def line_dedup(spark, folder):
    done = lines.drop_repeated_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return done.select(
        "doc_id", "line_counts.n_lines", "line_counts.n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


PHRASES_SQL = f"""WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang, {LOWER.format("coalesce(text, '')")} AS t FROM documents),
    pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
    words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
    totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM words GROUP BY 1),
    grams AS ({{grams}}),
    f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {{least}}),
    cand AS (SELECT * FROM f WHERE k > 1),
    cuts AS (SELECT lang, phrase, k, a, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS c FROM cand),
    scored AS (SELECT cuts.lang, cuts.phrase, cuts.a, x.a AS l, y.a AS r, n, c,
        CAST(CAST(1000 AS HUGEINT) * cuts.a * n // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
      FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(ws[1:c], ' ')
      JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(ws[c + 1:], ' ') JOIN totals ON totals.lang = cuts.lang),
    inside AS (SELECT c.lang, c.phrase FROM cand c JOIN cand b ON b.lang = c.lang AND b.k > c.k AND 100 * b.a >= 100 * c.a
      AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' ')),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM best ANTI JOIN inside USING (lang, phrase) QUALIFY rank <= {{top}}"""


def phrases_sql(least: int, longest: int, top: int) -> str:
    gram = "SELECT lang, {k} AS k, array_to_string(ws[i:i + {k} - 1], ' ') AS phrase FROM (SELECT lang, ws, unnest(range(1, len(ws) - {k} + 2)) AS i FROM words)"
    return PHRASES_SQL.format(least=least, top=top, grams=" UNION ALL ".join(gram.format(k=k) for k in range(1, longest + 1)))


@query("op11_phrase_collocations", phrases_sql(100, 5, 2000))
def phrase_collocations(spark, folder):
    return phrases.collocations(table(spark, folder, "documents"), least=100, longest=5, top=2000)


def noisy_words(docs):
    """(word, n): words of 7 letters or more that occur twice or more, after one in 31 runs has lost a letter, chosen by a crc32 of id and run."""
    runs = spelling.letter_runs(docs, 7)
    mark = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    lost = (F.col("mark") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), lost), F.substring("run", lost + 2, F.length("run")))
    words = runs.withColumn("mark", mark).select(F.when(F.col("mark") % 31 == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= 7).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")


@query("op12_spelling_variants")
def spelling_variants(spark, folder):
    found = spelling.spelling_variants(noisy_words(table(spark, folder, "documents")))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query("op13_near_duplicates")
def near_duplicate_sets(spark, folder):
    return setsketch.near_duplicates(table(spark, folder, "documents"), shingle=5, percent=85)
