"""Spelling variants: words one edit apart, found by pivotal grams, and the frequent form each word goes back to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lorebase.llm.common import ascii_lower, broadcast_if_small, drop_stored, stored, whole_text

LETTERS = "A-Za-zÀ-ÿ"
# One edit touches at most two bigrams, so of three bigrams at different places two disjoint ones can be chosen.
PREFIX = 3
# Bits of the masks that rule candidates out before they are compared letter by letter.
MASK_BITS = 64


def letter_runs(docs: DataFrame, shortest: int) -> DataFrame:
    """(doc_id, run) for each maximal run of at least `shortest` letters in the texts, A-Z lower-cased."""
    runs = F.regexp_extract_all(whole_text(docs), F.lit(f"[{LETTERS}]{{{shortest},}}+"), F.lit(0))
    return docs.select("doc_id", F.explode(runs).alias("run")).withColumn("run", ascii_lower(F.col("run")))


def _bit(value: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(value), F.lit(MASK_BITS)).cast("int"))


def _cheapest_disjoint(grams: Column) -> Column:
    """The two grams (df, gram, at) of least total df that share no letter, by dynamic programming over their places.

    `grams` is sorted by place. State: the cheapest gram so far, the cheapest without the last one, the place of the last
    one, and the best pair. A gram next to the last one can only go with the cheapest without it.
    """
    gram = "struct<df:bigint,gram:string,at:int>"
    none = F.lit(None).cast(gram)
    start = F.struct(
        none.alias("one"), none.alias("before"), F.lit(-2).alias("last"), F.lit(None).cast(f"struct<cost:bigint,x:{gram},y:{gram}>").alias("two")
    )

    def step(state: Column, g: Column) -> Column:
        partner = F.when(g["at"] - state["last"] > 1, state["one"]).otherwise(state["before"])
        pair = F.when(partner.isNotNull(), F.struct((partner["df"] + g["df"]).alias("cost"), partner.alias("x"), g.alias("y")))
        return F.struct(F.least(state["one"], g).alias("one"), state["one"].alias("before"), g["at"].alias("last"), F.least(state["two"], pair).alias("two"))

    two = F.aggregate(grams, start, step, lambda state: state["two"])
    return F.array(two["x"], two["y"])


def pivotal_grams(words: DataFrame) -> DataFrame:
    """(word, n, size, letters, mask, last, prefix, pivots) of `words` (word, n), words of three bigrams or more.

    Bigrams are ordered by how many words hold them, the rarest first. `prefix` holds the first three of a word, with their places, and all
    that equal the last of these; `last` is where that one stands in the order; `pivots` are two disjoint ones of the first three with the
    fewest words. `letters` and `mask` are bit sets of hashed letters and bigrams.
    """
    places = F.transform(F.sequence(F.lit(0), F.length("word") - 2), lambda i: F.struct(F.substring("word", i + 1, F.lit(2)).alias("gram"), i.alias("at")))
    grams = words.filter(F.length("word") > PREFIX).select("word", "n", F.explode(places).alias("g")).select("word", "n", "g.gram", "g.at")
    # One number to sort by: the count, then a hash of the bigram. Equal numbers of different bigrams do no harm.
    df = F.count(F.lit(1)) * (1 << 20) + F.pmod(F.xxhash64("gram"), F.lit(1 << 20))
    counted = stored(grams.groupBy("gram").agg(df.alias("df")), "gram-counts")
    # A bigram has at most 8 bytes.
    held = grams.join(broadcast_if_small(counted, 64), "gram").groupBy("word", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "gram", "at"))).alias("grams"), F.bit_or(_bit(F.col("gram"))).alias("mask")
    )  # as many as the word has letters
    third = F.element_at("grams", PREFIX)
    letters = F.aggregate(F.split("word", ""), F.lit(0).cast("long"), lambda acc, c: acc.bitwiseOR(_bit(c)))
    first = F.array_sort(F.slice("grams", 1, PREFIX), lambda x, y: x["at"] - y["at"])
    return held.select(
        "word", "n", F.length("word").alias("size"), letters.alias("letters"), "mask",
        third["df"].alias("last"), F.filter("grams", lambda g: g["df"] <= third["df"]).alias("prefix"),
        _cheapest_disjoint(first).alias("pivots"),
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n), both ways, for words that differ by one inserted, deleted or replaced code point.

    One edit leaves one of two disjoint bigrams whole. Of two near words, take the one whose `last` is not the later: its whole
    pivot stands in the other word, and no later in the order than that word's `last`, so in its prefix. So
    pivots meet prefixes by the bigram, its place and the length: with equal lengths the place is the same, else
    the same or one further in the longer word. What meets is ruled out by the bit sets (an edit changes at most two letters and
    four bigrams) or compared letter by letter, inside the join.
    """
    grams = stored(pivotal_grams(words), "pivotal-grams")
    shared = ["word", "n", "letters", "mask", "last"]
    prefixes = grams.select(*shared, "size", F.explode("prefix").alias("g")).select(*shared, "size", "g.gram", "g.at")
    meets = F.array(*[F.struct((F.col("p.at") + a).alias("at"), (F.col("size") + s).alias("size")) for a, s in ((0, 0), (0, 1), (1, 1), (0, -1), (-1, -1))])
    pivots = grams.select(*shared, "size", F.explode("pivots").alias("p")).select(*shared, F.col("p.gram").alias("gram"), F.explode(meets).alias("m"))
    pivots = pivots.select(*[F.col(c).alias(f"p_{c}") for c in shared], "gram", "m.at", "m.size")
    differ = lambda name: F.bit_count(F.col(name).bitwiseXOR(F.col(f"p_{name}")))
    near = (
        (differ("mask") <= 4)
        & (differ("letters") <= 2)
        & (F.col("p_last") <= F.col("last"))
        & (F.col("word") != F.col("p_word"))
        & (F.levenshtein("word", "p_word", 1) == 1)
    )
    met = prefixes.join(pivots, ["gram", "at", "size"]).filter(near)
    one, two = F.struct("word", "n"), F.struct(F.col("p_word").alias("word"), F.col("p_n").alias("n"))
    met = met.select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).distinct()
    met = stored(met.select("a.word", "a.n", F.col("b.word").alias("other"), F.col("b.n").alias("other_n")), "near-words")
    return met.union(met.select("other", "other_n", "word", "n"))


def spelling_variants(words: DataFrame, factor: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each of `words` (word, n), which are distinct.

    Words are near if they differ by one inserted, deleted or replaced code point. `n_near` counts the near words; `form` is the one with
    the largest n (ties: the smallest in code-point order) if that is at least `factor` times the n of the word, else null; `root` is where
    the forms lead in the end, the word itself if it has none. n grows by `factor` with each form, so chains
    are short; they are followed by doubling.

    A null word or n takes no part; words under four code points have no near words here. No rows: no rows. Other columns are ignored.
    """
    words = stored(words.select("word", F.col("n").cast("long").alias("n")).filter("word is not null and n is not null"), "words")
    near = near_pairs(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    )
    judged = words.join(near, "word", "left").withColumn("form_n", -F.col("best.less"))
    has_form = F.col("form_n") >= factor * F.col("n")
    judged = judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, F.col("best.form")).alias("form"), F.when(has_form, F.col("form_n")).alias("form_n"),
    )
    judged = stored(judged, "judged-words")
    roots = stored(judged.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.toDF("root", "further")
        if roots.join(onward, "root", "left_semi").isEmpty():
            break
        last, roots = roots, stored(roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
        drop_stored(last)
    return judged.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
