"""Benchmark decontamination by templates: finds benchmark passages in documents, also with other numbers, units and names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from lorebase.llm.common import broadcast_if_small, stored, whole_text

# Words of a template window, and every how many words at most a window of a document begins.
WINDOW = 8
STEP = 6

# Marks in front of slot words, from the private use area; texts are stripped of them first.
NAME, NUMBER, UNIT = "\ue001", "\ue002", "\ue003"
MARKS = NAME + NUMBER + UNIT

# Words that count as units after a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb oz ml cl l gal s sec min h hr hrs ms w kw mw kwh v a hz khz mhz ghz kb mb gb tb "
    "percent meter meters metre metres kilometer kilometers kilometre kilometres mile miles foot feet inch inches "
    "gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres second seconds minute minutes "
    "hour hours day days week weeks month months year years dollar dollars euro euros cent cents degree degrees "
    "stunde stunden tag tage jahr jahre heure heures jour jours an ans hora horas dia dias año años"
).split()

IS_NAME = r"(?=\p{Lu})(?<=[\p{L}\p{Nd},;] )(?=\p{Lu}*\p{Ll})"
IS_NUMBER = r"(?<![\p{L}\p{N}])\p{Nd}++(?:[.,:/]\p{Nd}++)*+"
IS_UNIT = rf"(?<={NUMBER}[\p{{Nd}}_]{{1,40}} {{1,3}}){NAME}?(?=(?:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}]))"
CUT = rf"[^\p{{L}}\p{{N}}_{MARKS}]+"


def marked(texts: DataFrame) -> DataFrame:
    """`texts` with `text` in lower case and a mark in front of each slot word.

    Numbers are runs of digits with single dots, commas, colons or slashes inside, which become `_`; units are unit
    words right after a number; names are capitalised words after another word in the same sentence.
    """
    # Steps of their own, so that none is evaluated twice.
    clean = texts.withColumn("text", F.regexp_replace("text", f"[{MARKS}_]", " "))
    named = clean.withColumn("text", F.regexp_replace("text", IS_NAME, NAME))
    named = named.withColumn("numbers", F.col("text").rlike(r"\p{Nd}"))
    numbered = F.regexp_replace("text", IS_NUMBER, f" {NUMBER}$0 ")
    numbered = F.regexp_replace(numbered, r"(?<=\p{Nd})[.,:/](?=\p{Nd})", "_")
    numbered = F.regexp_replace(F.lower(numbered), IS_UNIT, UNIT)
    return named.withColumn("text", F.when(F.col("numbers"), numbered).otherwise(F.lower("text"))).drop("numbers")


def words_of(text: Column) -> Column:
    """Words between all that is neither letter nor digit."""
    return F.array_remove(F.split(text, CUT), "")


def _template(text: Column, marks: str) -> Column:
    """The words of a marked text with the slots of these kinds emptied and other marks removed."""
    for mark in MARKS:
        if mark not in marks:
            text = F.replace(text, F.lit(mark), F.lit(""))
    return words_of(F.regexp_replace(text, rf"([{marks}])[\p{{L}}\p{{N}}_]+", "$1"))


def _windows(words: Column, step: int) -> Column:
    """(at, window hash) of every `step`-th window; null if there is none."""
    first = F.sequence(F.lit(0), F.size(words) - WINDOW, F.lit(step))
    window = lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice(words, i + 1, F.lit(WINDOW))).alias("window"))
    return F.when(F.size(words) >= WINDOW, F.transform(first, window))


def _all_windows(texts: DataFrame, step: int) -> DataFrame:
    """(..., at, window) of marked `texts` (..., text): windows with names as slots, and those with names as words that differ."""
    keys = [c for c in texts.columns if c != "text"]
    both = texts.select(*keys, _template(F.col("text"), MARKS).alias("a"), _template(F.col("text"), NUMBER + UNIT).alias("b"))
    both = both.select(*keys, _windows(F.col("a"), step).alias("a"), _windows(F.col("b"), step).alias("b"))
    others = F.filter("b", lambda w, k: w["window"] != F.get("a", k)["window"])
    return both.select(*keys, F.explode(F.concat("a", others)).alias("w")).select(*keys, "w.at", "w.window")


def contaminated(docs: DataFrame, items: DataFrame, run: int = WINDOW + STEP - 1, literal: int = 6) -> DataFrame:
    """Documents that hold a passage of a benchmark item: (doc_id, item_id, run_words, item_words, first_word, slots, changed).

    `docs` is (doc_id, text, ...), `items` (item_id, text, ...). Texts become templates: numbers, units and
    names are slots of a type, other words stay in lower case. A document holds an item if `run` consecutive words (the whole
    item, if it is shorter) have the same templates, at least `literal` of them words and not slots (all words that
    the item has, if fewer), and the slots are consistent: equal values of the item have equal values in the document,
    while different ones may become equal. Every run is judged, and of a run with conflicting slots every longest stretch
    without a conflict. A run with unchanged values needs no words that are not slots. A name may also match as a
    word, whatever its case. `run_words` is the longest such run, `first_word` where it starts in the document, `slots` its
    slots and `changed` those with other values than the item. Items with the same words count as one, under the smallest id.

    Method: windows of 8 template words are hashed, of items at every word, of documents at every sixth, which is enough
    to meet every run of 13 (for shorter items the step is smaller). Document windows are joined to item
    windows without their text; only documents with a hit are read again, and the words around each hit are compared.
    Item windows are copied to all tasks while they are below 32 MB; beyond, both sides are shuffled.

    Null and empty texts hold nothing; items under 8 words are too short to tell and match nothing. A null doc_id
    or item_id takes no part. Rows repeated with the same doc_id and text count once; rows with the same doc_id and
    other texts count as one document with the better run. No rows: no rows. Other columns are ignored.
    """
    known = marked(items.filter(F.col("item_id").isNotNull()).select("item_id", whole_text(items).alias("text")))
    known = known.groupBy(words_of(F.col("text")).alias("words")).agg(F.min("item_id").alias("item_id"), F.first("text").alias("text"))
    known = stored(known.filter(F.size("words") >= WINDOW), "items")
    shortest = known.agg(F.min(F.size("words"))).first()[0]
    step = max(1, min(STEP, min(run, shortest or run) - WINDOW + 1))

    item_windows = _all_windows(known.select("item_id", "text"), 1).withColumnRenamed("at", "item_at")
    item_windows = stored(item_windows, "item-windows")

    texts = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64("text").alias("version"), whole_text(docs).alias("text"))
    windows = _all_windows(marked(texts), step)
    hits = windows.join(broadcast_if_small(item_windows, 40), "window")
    places = hits.select("doc_id", "version", "item_id", (F.col("at") - F.col("item_at")).alias("shift"))
    places = stored(places.distinct(), "places")

    met = stored(places.select("doc_id", "version").distinct(), "met")
    held = texts.join(met, ["doc_id", "version"], "left_semi").dropDuplicates(["doc_id", "version"])
    held = marked(held.select("doc_id", "version", "text"))
    held = stored(held.select("doc_id", "version", words_of(F.col("text")).alias("doc_words")), "met-texts")
    lined = places.join(held, ["doc_id", "version"]).join(broadcast_if_small(known.select("item_id", "words"), 4096), "item_id")
    first = F.greatest("shift", F.lit(0))
    count = F.least(F.size("doc_words"), F.col("shift") + F.size("words")) - first
    lined = lined.select(
        "doc_id", "item_id", F.size("words").alias("item_words"), first.alias("first"),
        F.size(F.filter("words", lambda w: ~_is_slot(w))).alias("item_literals"),
        F.arrays_zip(
            F.slice("doc_words", first + 1, count).alias("d"), F.slice("words", first - F.col("shift") + 1, count).alias("i")
        ).alias("pairs"),
    )
    needed = F.least(F.lit(run), "item_words")
    long_enough = lambda spans: F.filter(spans, lambda r: (r["end"] - r["from"] >= needed) & (r["end"] > r["from"]))
    runs = lined.withColumn("r", F.explode(long_enough(_runs(F.col("pairs"), lambda p: _same(p["d"], p["i"])))))
    runs = runs.withColumn("pairs", F.slice("pairs", F.col("r.from") + 1, F.col("r.end") - F.col("r.from")))
    runs = runs.withColumn("conflicts", _conflicts(F.col("pairs")))
    kept = F.transform(long_enough(_between("conflicts", F.size("pairs"))), lambda r: F.struct(r["from"], r["end"], F.lit(False).alias("verbatim")))
    verbatim = long_enough(_runs(F.col("pairs"), lambda p: _bare(p["d"]) == _bare(p["i"])))
    verbatim = F.transform(verbatim, lambda r: F.struct(r["from"], r["end"], F.lit(True).alias("verbatim")))
    found = runs.withColumn("w", F.explode(F.concat(kept, verbatim)))
    found = found.withColumn("run_words", F.col("w.end") - F.col("w.from")).withColumn("start", F.col("r.from") + F.col("w.from") + 1)
    found = found.withColumn("pairs", F.slice("pairs", F.col("w.from") + 1, F.col("run_words")))
    as_slots = F.filter("pairs", lambda p: _is_slot(p["d"]) & _is_slot(p["i"]))
    found = found.withColumn("filled", F.transform(as_slots, lambda p: F.struct(_bare(p["d"]).alias("d"), _bare(p["i"]).alias("i"))))
    literals = F.col("run_words") - F.size("filled")
    found = found.filter(F.col("w.verbatim") | (literals >= F.least(F.lit(literal), "item_literals")))
    row = F.struct(
        F.col("run_words").cast("long").alias("run_words"), F.col("item_words").cast("long").alias("item_words"), (F.col("first") + F.col("start") - 1).cast("long").alias("first_word"),
        F.size("filled").cast("long").alias("slots"), F.size(F.filter("filled", lambda p: p["d"] != p["i"])).cast("long").alias("changed"),
    )
    order = F.struct("run_words", (-F.size("filled")).alias("s"), (-(F.col("first") + F.col("start"))).alias("f"))
    best = found.groupBy("doc_id", "item_id").agg(F.max_by(row, order).alias("best"))
    return best.select("doc_id", "item_id", "best.*")


def _runs(pairs: Column, holds: Callable[[Column], Column]) -> Column:
    """(from, end) between the pairs for which `holds` does not, the end exclusive."""
    breaks = F.filter(F.transform(pairs, lambda p, at: F.when(~holds(p), at)), lambda at: at.isNotNull())
    froms = F.concat(F.array(F.lit(0)), F.transform(breaks, lambda at: at + 1))
    return F.zip_with(froms, F.concat(breaks, F.array(F.size(pairs))), lambda a, z: F.struct(a.alias("from"), z.alias("end")))


def _conflicts(pairs: Column) -> Column:
    """(at, before): the slot at `at` has another value in the document than the last slot before it with the same item value."""
    slot = lambda p, at: F.struct(_bare(p["i"]).alias("i"), at.alias("at"), _bare(p["d"]).alias("d"))
    slots = F.array_sort(F.array_compact(F.transform(pairs, lambda p, at: F.when(_is_slot(p["d"]) & _is_slot(p["i"]), slot(p, at)))))
    conflict = lambda x, y: F.when((x["i"] == y["i"]) & (x["d"] != y["d"]), F.struct(y["at"].alias("at"), x["at"].alias("before")))
    return F.array_sort(F.array_compact(F.zip_with(slots, F.slice(slots, F.lit(2), F.greatest(F.size(slots) - 1, F.lit(0))), conflict)))


def _between(conflicts: str, size: Column) -> Column:
    """(from, end) of the longest stretches without both sides of a conflict, the end exclusive."""
    none = F.array().cast("array<struct<from:int,end:int>>")
    start = F.struct(F.lit(0).alias("from"), none.alias("out"))
    stretch = lambda acc, end: F.concat(acc["out"], F.array(F.struct(acc["from"].alias("from"), end.alias("end"))))
    step = lambda acc, c: F.struct(F.greatest(acc["from"], c["before"] + 1).alias("from"), stretch(acc, c["at"]).alias("out"))
    return F.aggregate(conflicts, start, step, lambda acc: stretch(acc, size))


def _is_slot(word: Column) -> Column:
    return word.substr(1, 1).isin(*MARKS)


def _bare(word: Column) -> Column:
    return F.when(_is_slot(word), word.substr(F.lit(2), F.length(word))).otherwise(word)


def _same(a: Column, b: Column) -> Column:
    """The same word, or slots of the same type."""
    return (_bare(a) == _bare(b)) | (_is_slot(a) & (a.substr(1, 1) == b.substr(1, 1)))
