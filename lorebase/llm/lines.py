"""Line dedup: lines that many documents hold stay in one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lorebase.llm.common import BLANKS, NO_ID, ascii_lower, stored, whole_text


def drop_repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Drop lines whose key at least `min_docs` documents hold, except in the largest doc_id holding it.

    The key of a line is the line without white space at both ends, A-Z lower-cased; keys under `min_chars`
    code points are left alone. Lines end at a line feed. Returns the rows of `docs` with their columns, `text`
    replaced by the kept lines, and `line_counts`, a struct of n_lines (before) and n_dropped.

    Method: lines become 128-bit hashes with document and position, without their text. Documents are counted per
    hash; the positions of dropped lines come back to their document, whose lines are put together by position.
    A line that a third of all documents holds is counted with partial sums, and the join that finds
    its positions is between two plain shuffles, so adaptive execution splits it.

    Null or empty text: one empty line. A null doc_id counts as one document, below all others. Rows repeated
    with the same doc_id and text count once and are treated alike; rows with the same doc_id and other texts count
    as one document. No rows: no rows. Other columns, whatever their names, are carried along.
    """
    row = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(whole_text(docs)).alias("version"),
    )
    keyed = row.select("id", "version", F.split(ascii_lower(F.coalesce("row.text", F.lit(""))), "\n", -1).alias("lines"))
    keys = keyed.select(
        "id", "version", F.posexplode(F.transform("lines", lambda x: F.trim(x, F.lit(BLANKS)))).alias("at", "key")
    )
    hashes = stored(
        keys.filter(F.length("key") >= min_chars).select(
            "id", "version", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2")
        ),
        "line-hashes",
    )
    held = hashes.groupBy("h1", "h2").agg(F.countDistinct("id").alias("n"), F.max("id").alias("keeper"))
    repeated = stored(held.filter(F.col("n") >= min_docs).drop("n"), "repeated-lines")
    dropped = (
        hashes.join(repeated, ["h1", "h2"])
        .filter(F.col("id") < F.col("keeper"))
        .groupBy("id", "version")
        .agg(F.collect_set("at").alias("dropped"))
    )
    lines = F.split(F.coalesce("row.text", F.lit("")), "\n", -1)
    both = row.join(dropped, ["id", "version"], "left").select(
        "row", lines.alias("lines"), F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped")
    )
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.transform(F.array_except(places, "dropped"), lambda i: F.get("lines", i))
    text = F.when(F.size("dropped") == 0, F.coalesce("row.text", F.lit(""))).otherwise(F.array_join(kept, "\n"))
    counts = F.struct(
        F.size("lines").cast("long").alias("n_lines"), F.size("dropped").cast("long").alias("n_dropped")
    )
    others = [F.col("row").getField(c).alias(c) if c != "text" else text.alias("text") for c in docs.columns]
    return both.select(*others, counts.alias("line_counts"))
