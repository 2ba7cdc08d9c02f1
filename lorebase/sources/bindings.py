"""How the documented inputs (knowledge base, log, answers) are derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lorebase.session import broadcast_if_few
from lorebase.sources.kb import KB_COLUMNS, load_documents
from lorebase.sources.notes import BUSINESS_DOC_COLUMNS, BUSINESS_DOCS, BUSINESS_QUESTIONS
from lorebase.sources.tables import read_table, spread

# Load times of the test data are fixed, so that results can be compared.
STAMP = "2024-01-01 00:00:00"
LATER_STAMP = "2024-01-02 00:00:00"
EARLIER_STAMP = "2023-12-31 00:00:00"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(read_table(spark, folder, "documents"), "doc_id")


def document_kb(spark: SparkSession, folder: str, dealt: bool = True) -> DataFrame:
    """`documents` as a knowledge base; `dealt` is of use where texts are worked on without another shuffle before."""
    read = read_table(spark, folder, "documents").withColumn("doc_id", F.col("doc_id").cast("string"))
    # Spread by the id in its final type, so that grouping by it later needs no shuffle.
    docs = (spread(read, "doc_id") if dealt else read).select(
        "doc_id",
        F.col("lang").alias("doc_type"),
        F.substring("text", 1, 60).alias("title"),  # a title only; the text stays whole
        F.col("text").alias("content"),
        F.to_json(F.struct("source")).alias("metadata"),
        F.array("source", "lang").alias("tags"),
    )
    return load_documents(docs, stamp=STAMP)


def business_kb(spark: SparkSession) -> DataFrame:
    return load_documents(spark.createDataFrame(BUSINESS_DOCS, BUSINESS_DOC_COLUMNS), stamp=STAMP)


def full_kb(spark: SparkSession, folder: str) -> DataFrame:
    """The documents and the notes on the business tables."""
    return document_kb(spark, folder, dealt=False).unionByName(business_kb(spark))


def schema_kb(spark: SparkSession, folder: str) -> DataFrame:
    """Schema documents: the two business tables, and one stock table per part."""
    first, second = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    key = F.col("p_partkey").cast("string")
    content = F.concat(
        F.lit("Table: stock_"), key, F.lit("\nDescription: What is left of "), F.col("p_name"), F.lit(".\n\nColumns:\n- "),
        first, F.lit("_id (BIGINT): Number of the "), F.col("p_name"), F.lit("\n- "),
        second, F.lit("_size (DECIMAL(10,2)): Size of one piece\n- "),
        F.lower("p_type"), F.lit("_price (DOUBLE): Price of the "), F.lower("p_type"), F.lit(" kind\n- "),
        F.lit("brand (ARRAY<STRING>): Always "), F.col("p_brand"), F.lit("\n"),
    )
    stock = spread(read_table(spark, folder, "part"), "p_partkey").select(
        F.concat(F.lit("schema_stock_"), key).alias("doc_id"),
        F.lit("schema").alias("doc_type"),
        F.concat(F.lit("Stock of "), F.col("p_name")).alias("title"),
        content.alias("content"),
        F.array(F.concat(F.lit("stock_"), key)).alias("tables"),
        F.array(F.concat(first, F.lit("_id")), F.lit("brand")).alias("columns"),
        F.array(first, second, F.lower("p_type")).alias("tags"),
    )
    return load_documents(stock, stamp=STAMP).unionByName(business_kb(spark))


def added_pages(spark: SparkSession, folder: str) -> DataFrame:
    """`pages` as documents that users add."""
    return read_table(spark, folder, "pages").select(
        F.concat(F.lit("page_"), F.col("page_id").cast("string")).alias("doc_id"),
        F.lit("page").alias("doc_type"),
        F.col("url").alias("title"),
        F.col("html").alias("content"),
    )


def readded_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents added once more; the good ones with a later time. Has `seq`."""
    labels = read_table(spark, folder, "labels").select(F.col("doc_id").cast("string").alias("doc_id"), "quality")
    again = document_kb(spark, folder).join(labels, "doc_id")
    time = F.when(F.col("quality") == 1, LATER_STAMP).otherwise(STAMP).cast("timestamp")
    return again.withColumn("title", F.concat(F.lit("again: "), F.col("title"))).withColumn("updated_at", time).select(
        *KB_COLUMNS, F.lit(1).cast("bigint").alias("seq")
    )


def earlier_documents(spark: SparkSession, folder: str) -> DataFrame:
    """What there was before: labelled documents, the bad ones with another text, and pages now gone."""
    text = F.when(F.col("quality") == 0, F.concat("text", F.lit(" (earlier)"))).otherwise(F.col("text"))
    labelled = read_table(spark, folder, "documents").join(read_table(spark, folder, "labels"), "doc_id").select(
        F.col("doc_id").cast("string").alias("doc_id"), text.alias("content")
    )
    gone = added_pages(spark, folder).select("doc_id", "content")
    return labelled.unionByName(gone).withColumn("updated_at", F.lit(EARLIER_STAMP).cast("timestamp"))


def earlier_index(spark: SparkSession, folder: str) -> DataFrame:
    """What an earlier sync may have left of these documents."""
    return earlier_documents(spark, folder).select("doc_id", F.sha2("content", 256).alias("content_hash"))


def benchmark_questions(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "benchmark").select(
        F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("question_id"), F.col("text").alias("question")
    )


def all_questions(spark: SparkSession, folder: str) -> DataFrame:
    """The benchmark passages and the questions about the business tables, one of them blank."""
    own = spark.createDataFrame(BUSINESS_QUESTIONS, "question_id string, question string")
    return benchmark_questions(spark, folder).unionByName(own)


def known_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """(question_id, doc_id) where a document holds a benchmark passage whole.

    Passages and documents meet on the longest word inside the passage (its first and last
    word may be cut, and count where there is no other, as whole words); only documents with that word are compared as texts.
    Passages without a word are found in no document.
    """
    words = F.regexp_extract_all("question", F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    inside = F.when(F.size(words) > 2, F.slice(words, F.lit(2), F.greatest(F.size(words) - 2, F.lit(0)))).otherwise(words)
    longest = F.sort_array(F.transform(inside, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))), asc=False)
    passages = benchmark_questions(spark, folder).select(
        "question_id", "question", F.get(longest, F.lit(0))["w"].alias("word")
    )
    docs = documents(spark, folder).select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    words_of = docs.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))).alias("word"))
    maybe = words_of.join(passages.drop("question"), "word").select("doc_id", "question_id").checkpoint()
    return (
        docs.join(broadcast_if_few(maybe), "doc_id")
        .join(passages.drop("word"), "question_id")
        .filter(F.contains("text", F.col("question")))
        .select("question_id", "doc_id")
    )


def history(spark: SparkSession, folder: str) -> DataFrame:
    """`events` as the interaction log."""
    events = read_table(spark, folder, "events")
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").alias("id"),
        "user_id",
        F.concat(F.lit("question "), k).alias("question"),
        F.concat(F.lit("answer "), k).alias("answer"),
        F.array(k, ((k.cast("bigint") + F.col("user_id")) % 100).cast("string")).alias("context_docs"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").alias("response_time_seconds"),
        F.when(kind == "purchase", True).when(kind == "error", False).alias("thumbs_up"),
        F.when(kind == "error", "failed").otherwise("ok").alias("status"),
    )


def votes(spark: SparkSession, folder: str) -> DataFrame:
    """Thumbs given, possibly several times by a user for the same interaction."""
    return history(spark, folder).filter("thumbs_up is not null").select(
        "user_id", F.col("question").alias("interaction"), "thumbs_up", F.col("timestamp").alias("voted_at"), "id"
    )


def answers(spark: SparkSession, folder: str) -> DataFrame:
    """Answer texts of ten shapes, one per customer: (answer_id, answer, tables)."""
    customer = read_table(spark, folder, "customer")
    key = F.col("c_custkey").cast("string")
    say = lambda before, after="": F.concat(F.lit(before), key, F.lit(after))
    shapes = [
        say("Here it is.\n\n```sql\nSELECT order_id, order_amount\nFROM orders\nWHERE customer_id = ", "\n```\nOne row per order."),
        say("SELECT count(*) AS n FROM orders WHERE customer_id = ", ";\n\nThis counts the orders."),
        say("Run\nselect order_id from orders where customer_id = ", " order by order_id LIMIT 5"),
        say(
            "Like this:\n```\nWITH spend AS (SELECT customer_id, sum(order_amount) AS total FROM orders GROUP BY customer_id)\n\n"
            "SELECT total FROM spend WHERE customer_id = ",
            "\n```",
        ),
        say("In der Straße: SELECT customer_name FROM customers WHERE customer_id = "),
        say("SELECT customer_name, credit_limit FROM customers JOIN accounts USING (customer_id) WHERE customer_id = "),
        say("SELECT o.order_id FROM customers c, `secret_orders` AS o WHERE c.note = 'from nowhere' AND o.order_id = "),
        say("SELECT order_id FROM orders ORDER BY order_id LIMIT 5 OFFSET "),
        say("SELECT order_id FROM orders WHERE customer_id = ", " -- not from payments"),
        F.concat(F.lit("Nothing is known about "), F.col("c_name"), F.lit(".")),
    ]
    shape = F.lit(None).cast("string")
    for n, text in enumerate(shapes):
        shape = F.when(F.col("c_custkey") % 10 == n, text).otherwise(shape)
    tables = F.when(F.col("c_mktsegment") == "BUILDING", F.array(F.lit("customers"), F.lit("orders"))).otherwise(
        F.array(F.lit("orders"))
    )
    return customer.select(F.col("c_custkey").alias("answer_id"), shape.alias("answer"), tables.alias("tables"))


def statements(spark: SparkSession, folder: str) -> DataFrame:
    """Statements, good and bad, one per customer: (statement_id, sql)."""
    customer = read_table(spark, folder, "customer")
    key = F.col("c_custkey").cast("string")
    say = lambda before, after="": F.concat(F.lit(before), key, F.lit(after))
    shapes = [
        say("SELECT order_id FROM orders WHERE customer_id = ", ";"),
        say("DROP TABLE orders_"),
        say("SELECT ", "; DROP TABLE orders"),
        say("SELECT reflect('java.lang.System', 'exit', ", ")"),
        say("SELECT * FROM parquet.`/data/", "`"),
        say("WITH t AS (SELECT ", " AS a) SELECT a FROM t -- drop table t"),
        say("INSERT INTO orders VALUES (", ")"),
        say("SELECT 'a; drop table ", "' AS text"),
        say("WITH s AS (SELECT ", ") INSERT INTO orders SELECT * FROM s"),
        F.lit("  "),
    ]
    shape = F.lit(None).cast("string")
    for n, text in enumerate(shapes):
        shape = F.when(F.col("c_custkey") % len(shapes) == n, text).otherwise(shape)
    return customer.select(F.col("c_custkey").alias("statement_id"), shape.alias("sql"))


def query_log(spark: SparkSession, folder: str) -> DataFrame:
    """Statements that were run for customers: (id, question, sql, status)."""
    return read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("Customers like "), F.col("c_name")).alias("question"),
        band_statement(F.col("c_mktsegment"), F.col("c_nationkey"), F.col("c_acctbal")).alias("sql"),
        F.when(F.col("c_acctbal") < 0, "failed").otherwise("ok").alias("status"),
    )


def band_statement(segment, nation, balance):
    return F.concat(
        F.lit("SELECT count(*) FROM customers WHERE segment = '"), segment, F.lit("' AND nation = "),
        nation.cast("string"), F.lit(" AND band = "), F.floor(balance / 500).cast("string"),
    )


def known_statements(spark: SparkSession, folder: str) -> DataFrame:
    """Statements that are documented already: those of the suppliers' nations and balances."""
    return read_table(spark, folder, "supplier").select(
        F.concat(F.lit("known_"), F.col("s_suppkey").cast("string")).alias("doc_id"),
        band_statement(F.lit("BUILDING"), F.col("s_nationkey"), F.col("s_acctbal")).alias("content"),
    )


def entitlements(spark: SparkSession, folder: str) -> DataFrame:
    """Each nation may see the customers of its own region: (user_name, region)."""
    nation, region = read_table(spark, folder, "nation"), read_table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("user_name"), F.col("r_name").alias("region")
    )


def product_lines(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_quantity").alias("quantity"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("part_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
    )


def stored_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "embeddings")
