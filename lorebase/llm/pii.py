"""Personal data: patterns, and terms that give away the protected values of the texts that hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lorebase.llm.common import NO_ID, broadcast_if_small, stored, whole_text

CHUNK = 256

# The patterns of the four kinds. They match what the plain ones do: a run is never entered in its middle,
# except where the match before ended, and never given back, so they take time in proportion to the text.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold to be searched at all.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
SMALL_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)
    doubled = F.translate(turned, "0123456789", "0246813579")
    add = lambda acc, i: acc + F.when(i % 2 == 1, turned.substr(i, F.lit(1))).otherwise(doubled.substr(i, F.lit(1))).cast("int")
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    size = F.length(digits)
    return {
        "email": F.lit(True),
        "ip": value.rlike(rf"^{SMALL_BYTE}(?:\.{SMALL_BYTE}){{3}}$"),
        "card": F.when(size.between(13, 19), _luhn(digits)).otherwise(False),
        "phone": size.between(9, 15),
    }[kind]


def _sums_before(sizes: Column) -> Column:
    """What the numbers before each one add up to, in chunks, so that long arrays take little more than linear time."""
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))
    step = lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["out"], F.array(acc["sum"])).alias("out"))
    before = lambda xs: F.aggregate(xs, start, step, lambda acc: acc["out"])
    firsts = F.sequence(F.lit(1), F.size(sizes), F.lit(CHUNK))
    chunks = F.transform(firsts, lambda i: F.slice(sizes, i, F.lit(CHUNK)))
    totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, b: a + b))
    moved = F.zip_with(F.transform(chunks, before), before(totals), lambda c, t: F.transform(c, lambda x: x + t))
    return F.when(F.size(sizes) > 0, F.flatten(moved)).otherwise(F.array().cast("array<int>"))


def _found(text: Column, pattern: Column, kind: Column | str) -> Column:
    """All matches as spans, in code points, the end exclusive."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    values = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(values)), lambda g: F.length(g))
    steps = F.zip_with(gaps, values, lambda g, v: g + F.length(v))
    starts = F.zip_with(_sums_before(steps), gaps, lambda s, g: s + g)
    span = lambda v, s: F.struct(kind.alias("kind"), s.alias("start"), (s + F.length(v)).alias("end"), v.alias("value"))
    return F.zip_with(values, starts, span)


def base_spans(text: Column) -> Column:
    """Spans of e-mail addresses, IP addresses, card and phone numbers, by kind, then start; empty texts have none."""

    def of_kind(kind: str) -> Column:
        spans = F.filter(_found(text, F.lit(PATTERNS[kind]), kind), lambda s: _holds(kind, s["value"]))
        return F.when(text.rlike(HINTS[kind]), spans.cast(SPANS)).otherwise(F.array().cast(SPANS))

    return F.concat(*[of_kind(kind) for kind in PATTERNS])


def _terms(text: Column) -> Column:
    """Distinct words of three letters or more, in lower case."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: F.length(w) >= 3))


def _company(text: Column) -> Column:
    """Distinct words of a text without parts of addresses."""
    return _terms(F.regexp_replace(text, r"(?<!\S)[^\s@]*+@\S*+", " "))


def find_personal_data(
    docs: DataFrame, min_support: int = 3, generalise_at: float = 0.5, remove_at: float = 0.9
) -> DataFrame:
    """(doc_id, id, version, base, added) for each row of `docs` (doc_id, text, ...).

    `base` are the spans of the four kinds (kind, start, end, value); `added` those of disclosing terms, of kind `generalised`
    or `removed`. `id` and `version` name the document and its text for `sanitise`, which makes the texts.

    A term discloses a protected value if at least `min_support` different texts hold both, and P(value | term), these
    texts over all different texts that hold the term, reaches `generalise_at`. That is the information log2(1 / P) that
    the term leaves open about the value: one bit at 0.5. From `remove_at` on the term is removed. Equal texts count once
    on both sides, so copies of a document neither disclose nor hide. Terms are words of three letters or more, of a text
    without addresses; they are marked in all documents, except inside base spans.

    Method: one pass over the texts stores spans and hashes of values. Values in fewer than `min_support` texts
    go; words of the texts with the others are counted, then those same words in all texts. A word and a value are only
    paired if the texts with any such value, and those with this one, are enough for P = `generalise_at`, which no word that
    discloses can fail. The words that do are looked up once more; lists are copied to all tasks while they are
    below 32 MB, and shuffled beyond. Only documents with such terms are read again for their places.

    Null and empty texts have no spans. A null doc_id stays null. Repeated rows come back each.
    No rows: no rows. Other columns are ignored.
    """
    key = [F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(whole_text(docs)).alias("version")]
    texts = docs.select("doc_id", *key, whole_text(docs).alias("text"))
    spotted = texts.select("doc_id", "id", "version", "text", base_spans(F.col("text")).alias("base"))
    entity = lambda s: F.xxhash64(s["kind"], F.lower(s["value"]))
    entities = F.array_distinct(F.transform("base", entity))
    base = stored(spotted.select("doc_id", "id", "version", "base", entities.alias("entities")), "base-spans")

    repeated = base.groupBy("version").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("version")
    repeated = broadcast_if_small(stored(repeated, "repeated-texts"), 16)
    several = texts.join(repeated, "version", "left_semi").select("version", "text").dropDuplicates(["version"])
    different = texts.join(repeated, "version", "left_anti").select("version", "text").union(several)
    company = lambda of: of.select("version", F.explode(_company(F.col("text"))).alias("term"))

    holds = base.filter(F.size("entities") > 0).select("version", F.explode("entities").alias("entity")).distinct()
    holds = stored(holds, "values")
    often = holds.groupBy("entity").agg(F.count(F.lit(1)).alias("texts")).filter(F.col("texts") >= min_support)
    holds = stored(holds.join(broadcast_if_small(stored(often, "often"), 24), "entity"), "values-often")
    most = holds.agg(F.max("texts")).first()[0] or 0
    private = different.join(broadcast_if_small(stored(holds.select("version").distinct(), "private-texts"), 16), "version", "left_semi")
    around = company(private).groupBy("term").agg(F.count(F.lit(1)).alias("around")).filter(F.col("around") >= min_support)
    around = stored(around, "around")
    held = company(different).join(broadcast_if_small(around.select("term"), 64), "term")
    held = held.groupBy("term").agg(F.count(F.lit(1)).alias("holders"))
    enough = F.least("around", F.lit(most)) >= generalise_at * F.col("holders")
    held = stored(held.join(around, "term").filter(enough).select("term", "holders"), "holders")
    met = company(private).join(broadcast_if_small(held, 72), "term").join(broadcast_if_small(holds, 32), "version")
    met = met.filter(F.col("texts") >= generalise_at * F.col("holders"))
    support = met.groupBy("entity", "term", "holders").agg(F.count(F.lit(1)).alias("both")).filter(F.col("both") >= min_support)
    support = support.groupBy("term", "holders").agg(F.max("both").alias("both"))
    share = F.col("both") / F.col("holders")
    action = F.when(share >= remove_at, "removed").when(share >= generalise_at, "generalised")
    telling = stored(support.select("term", action.alias("kind")).filter("kind IS NOT NULL"), "telling")

    words = texts.select("id", "version", F.explode(_terms(F.col("text"))).alias("term"))
    places = stored(words.join(broadcast_if_small(telling, 80), "term").distinct(), "telling-words")
    some = texts.join(stored(places.select("id", "version").distinct(), "telling-documents"), ["id", "version"], "left_semi")
    some = some.dropDuplicates(["id", "version"]).select("id", "version", "text")
    word = F.concat(F.lit(r"(?iu)(?<!\p{L})"), F.col("term"), F.lit(r"(?!\p{L})"))
    marks = places.join(some, ["id", "version"]).select("id", "version", _found(F.col("text"), word, F.col("kind")).alias("spans"))
    added = marks.groupBy("id", "version").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("added"))
    both = base.join(added, ["id", "version"], "left").select("doc_id", "id", "version", "base", "added")
    outside = F.filter("added", lambda a: ~F.exists("base", lambda b: (b["start"] < a["end"]) & (a["start"] < b["end"])))
    return both.select("doc_id", "id", "version", "base", F.coalesce(outside, F.array().cast(SPANS)).alias("added"))


def sanitise(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """`docs` (doc_id, text, ...) with values and generalised terms of `find_personal_data` replaced by tags and removed terms left out.

    Of overlapping spans the one that starts first goes. Rows, other columns and null texts stay as they are.
    """
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(whole_text(docs)).alias("version"),
    )
    every = F.concat("base", "added")
    by_start = F.array_sort(F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    marked = spans.dropDuplicates(["id", "version"]).select("id", "version", by_start.alias("spans"))
    text = F.col("row.text")
    tag = lambda s: F.when(s["kind"] == "removed", "").when(s["kind"] == "generalised", "[TERM]").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda acc, s: F.when(
        s["start"] >= acc["at"],
        F.struct(s["end"].alias("at"), F.concat(acc["out"], text.substr(acc["at"] + 1, s["start"] - acc["at"]), tag(s)).alias("out")),
    ).otherwise(acc)
    end = lambda acc: F.concat(acc["out"], text.substr(acc["at"] + 1, F.length(text)))
    clean = F.when(F.size("spans") > 0, F.aggregate("spans", start, step, end)).otherwise(text)
    joined = rows.join(marked, ["id", "version"], "left")
    return joined.select(*[clean.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
