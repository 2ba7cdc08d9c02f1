"""Text expressions: tokens, trimming, chunks, SQL extraction, masking."""

from __future__ import annotations

import numpy as np
from pyspark.sql import SparkSession, functions as F

# What counts as a token, and the chunk sizes.
TOKEN = r"[\p{L}\p{N}_]+"
CHUNK_SIZE = 500
CHUNK_OVERLAP = 50

# Personal data patterns. They use no word boundaries, since engines
# disagree on boundaries next to letters with accents.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
IPV4 = r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"
IPV6 = r"([0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|([0-9A-Fa-f]{1,4}:){1,6}(:[0-9A-Fa-f]{1,4}){1,6}"
PHONE = r"\+[0-9][0-9 ().-]{6,18}[0-9]|(\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
NUMBER = r"[0-9]{10,}"

# The same addresses as EMAIL, found without going back into a run of letters that was read before.
EMAIL_AT_START = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}+"


def tokens(text):
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


_CHARACTERS: dict[str, np.ndarray] = {}


def token_characters(spark: SparkSession) -> np.ndarray:
    """The code points that `TOKEN` takes, as ranges (first, after last). Spark is asked once per application, so that what counts as a letter is the same wherever texts are cut."""
    held = spark.sparkContext.applicationId
    if held not in _CHARACTERS:
        points = spark.range(0x110000).filter("id NOT BETWEEN 55296 AND 57343")  # surrogates are no characters
        letter = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
        taken = points.filter(F.regexp_like(letter, F.lit(f"^{TOKEN}$"))).toPandas()["id"].to_numpy()  # as many as there are letters
        taken = np.sort(taken)
        starts = np.flatnonzero(np.diff(taken, prepend=-2) > 1)
        ends = np.append(starts[1:], len(taken)) - 1
        _CHARACTERS[held] = np.stack([taken[starts], taken[ends] + 1], axis=1)
    return _CHARACTERS[held]


def strip_space(text):
    """Drop white space of every kind at both ends.

    The look-behind lets only the start of a run try to reach the end of the text.
    """
    return F.regexp_replace(text, r"^\s+|(?<!\s)\s+$", "")


def normal_question(text):
    """Questions that differ in case, spacing or closing marks are the same question."""
    return F.regexp_replace(strip_space(F.lower(F.regexp_replace(text, r"\s+", " "))), r"(?<![?!. ])[?!. ]+$", "")


def is_blank(text):
    return F.coalesce(F.length(F.regexp_replace(text, r"\s+", "")) == 0, F.lit(True))


def preview(text, length: int = 200):
    return F.substring(text, 1, length)


def chunks(text, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP):
    """Array of windows of `size` characters, each starting `size - overlap` after the last.

    One pass of a regex cuts the text into strides; a window is a stride and the start of
    the next. Cutting each window by its offset would scan the text once per window, and so would strides that are not kept.
    """
    if not 0 <= overlap < size or overlap > size - overlap:
        raise ValueError("overlap must be at least 0 and at most half of size")
    stride = size - overlap

    def windows(strides):
        # A last stride no longer than the overlap already lies in the window before it.
        keeps_last = (F.size(strides) == 1) | (F.length(F.element_at(strides, -1)) > overlap)
        whole = F.transform(
            strides,
            lambda piece, i: F.concat(piece, F.substring(F.coalesce(F.get(strides, i + 1), F.lit("")), 1, overlap)),
        )
        count = F.when(keeps_last, F.size(strides)).otherwise(F.size(strides) - 1)
        return F.slice(whole, F.lit(1), F.greatest(count, F.lit(1)))

    strides = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{stride}}}"), F.lit(0))
    return F.when(F.length(text) > 0, _let(strides, windows)).otherwise(F.array().cast("array<string>"))


# --- SQL in answers ---------------------------------------------------------------------


def cut_answer_literal(answer):
    """The plain rule: from the first `select` to a code fence, then to a blank line."""
    found = F.regexp_extract(answer, r"(?is)(select.*)", 1)
    return strip_space(F.split(F.split(found, "```", 2)[0], "\n\n", 2)[0])


def extract_sql(answer):
    """SQL held in an answer, or ''.

    A fenced block that starts with SELECT or WITH is taken whole, blank lines included.
    Else the text from a line that starts with SELECT or WITH, up to a blank line. Else
    the plain rule.
    """
    fenced = strip_space(F.regexp_extract(answer, r"(?is)```[ \t]*(?:sql)?\s*((?:select|with)\b.*?)```", 1))
    line = F.regexp_extract(answer, r"(?is)(?:^|\n)[ \t]*((?:select|with)\b.*)", 1)
    line = strip_space(F.split(F.split(line, "```", 2)[0], "\n\n", 2)[0])
    return (
        F.when(fenced != "", fenced).when(line != "", line).otherwise(cut_answer_literal(answer))
    )


# Quoted names, then texts and comments, in one pattern: whichever begins first wins, so a
# quote inside a comment opens no text and a comment mark inside a text opens no comment.
# The possessive repeats keep long texts from exhausting the stack.
_QUOTED = (
    r"(`[^`]*+`)"
    r"|(?<!\w)[rR](?:'[^']*+'|\"[^\"]*+\")"
    r"|'(?:[^'\\]++|\\[\s\S])*+'"
    r"|\"(?:[^\"\\]++|\\[\s\S])*+\""
    r"|--[^\n]*+"
    r"|/\*[\s\S]*?\*/"
)


def without_text(sql):
    """The statement without texts and comments, so that their words are not taken for SQL."""
    return F.regexp_replace(sql, _QUOTED, "$1 ")


def without_comments(sql):
    """The statement without comments; texts and quoted names stay."""
    kept = r"(`[^`]*+`|(?<!\w)[rR](?:'[^']*+'|\"[^\"]*+\")|'(?:[^'\\]++|\\[\s\S])*+'|\"(?:[^\"\\]++|\\[\s\S])*+\")"
    return F.regexp_replace(sql, kept + r"|--[^\n]*+|/\*[\s\S]*?\*/", "$1")


def strip_semicolon(sql):
    return F.regexp_replace(sql, r"(?<![;\s])[;\s]+$", "")


def has_row_limit(sql):
    """Whether the statement ends in LIMIT n, perhaps with an OFFSET; comments do not count."""
    return F.regexp_like(without_text(sql), F.lit(r"(?i)\blimit\s+[0-9]+(\s+offset\s+[0-9]+)?[\s;]*$"))


def cap_rows(sql, limit: int = 100):
    """Append a LIMIT unless the statement ends in one. Comments go, lest they hide it; it stands before an OFFSET."""
    bare = strip_semicolon(without_comments(sql))
    offset = r"(?i)\boffset\s+[0-9]+$"
    capped = F.concat(bare, F.lit(f" LIMIT {limit}"))
    before_offset = F.regexp_replace(bare, offset, f"LIMIT {limit} $0")
    return F.when(has_row_limit(sql), sql).when(bare.rlike(offset), before_offset).otherwise(capped)


# Marks that stand in for a part in parentheses: around the tables it names, and between them.
_OPEN, _CLOSE, _NEXT = "\x01", "\x02", "\x03"
_PART = f"{_OPEN}([^{_CLOSE}]*){_CLOSE}"
# What ends the list of tables after FROM, unless it is a column of some table.
_CLAUSE = r"(?<![\w.])(?:where|group|having|order|sort|cluster|distribute|limit|offset|window|union|intersect|except|minus|lateral\s+view|select|from)\b"
_DEFINED = rf"(\w+)\s*(?:{_PART}\s*)?\bas\s*{_PART}"
_HEAD = rf"^\s*with\s+(?:recursive\s+)?(?:{_DEFINED}\s*,?\s*)+"
# A table, and no function; a table of its own; a table alone in parentheses.
_NAME = rf"\s*+(?:lateral\s++)?+([\w.]++)(?!\s*{_OPEN})"
_TABLE = r"(?:^\s*|\b(?:union|intersect|except|minus)\s+(?:all\s+|distinct\s+)?)table\s+([\w.]++)"
_SINGLE = r"((?:(?<![\w.])(?:from|join)|,|\()\s*)\(\s*([\w.]+)\s*\)"
# A statement nested deeper than this is not looked into; Spark's own parser gives up on far less.
MAX_DEPTH = 200
TOO_DEEP = "?"


def _found(text, pattern, group: int = 1):
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _let(value, use):
    """`use(value)`, with the value worked out once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _inner(text):
    """The tables that the parts in parentheses of a text name."""
    return F.flatten(F.transform(_found(text, _PART), lambda names: F.split(names, _NEXT)))


def _named(level):
    """The tables in lists after FROM, after JOIN and after TABLE on one level."""
    lists = _found(level, rf"(?s)(?<![\w.])from\b(.*?)(?={_CLAUSE}|\|>|;|$)")
    first = F.flatten(F.transform(lists, lambda clause: F.transform(F.split(clause, ","), lambda item: F.regexp_extract(item, f"^{_NAME}", 1))))
    named = F.concat(first, _found(level, rf"(?<![\w.])join\b{_NAME}"), _found(level, _TABLE))
    return F.filter(named, lambda n: ~n.rlike(r"^[0-9.]*$") & ~n.isin("values", "lateral"))


def _tables_of(level):
    """The tables a level of a statement names and does not define; parts in parentheses are marks that hold theirs.

    A name that WITH defines counts from the next definition on, within its own level.
    """
    query = level.rlike(rf"^\s*(?:with|select|from|table|values|{_OPEN})")
    joins = level.rlike(r"(?<![\w.])join\b")

    def all_names(whole, head):
        defined = _found(head, _DEFINED)
        recursive = F.when(head.rlike(r"^\s*with\s+recursive\s"), 1).otherwise(0)
        within = F.transform(_found(head, _DEFINED, 3), lambda names, i: F.array_except(F.split(names, _NEXT), F.slice(defined, F.lit(1), i + recursive)))
        after = F.substr(whole, F.length(head) + 1)
        return F.concat(F.flatten(within), F.array_except(F.concat(_inner(after), _named(after)), defined))

    whole = F.when(query, level).otherwise(F.concat(F.lit("from "), level))
    names = _let(whole, lambda w: _let(F.regexp_extract(w, _HEAD, 0), lambda head: all_names(w, head)))
    return F.filter(F.array_distinct(F.when(query | joins, names).otherwise(_inner(level))), lambda n: n != "")


def _take_out_parts(text):
    """Replace the innermost parentheses by marks."""
    marks = F.transform(_found(text, r"\(([^()]*)\)"), lambda part: F.concat(F.lit(_OPEN), F.array_join(_tables_of(part), _NEXT), F.lit(_CLOSE)))
    between = F.split(text, r"\([^()]*\)", -1)
    return F.array_join(F.flatten(F.zip_with(between, marks, lambda before, mark: F.array(before, F.coalesce(mark, F.lit(""))))), "")


def _depth(text):
    """How deep parentheses nest."""

    def step(state, mark):
        at = F.greatest(state["at"] + F.when(mark == "(", 1).otherwise(-1), F.lit(0))
        return F.struct(at.alias("at"), F.greatest(state["deepest"], at).alias("deepest"))

    return F.aggregate(_found(text, "[()]", 0), F.struct(F.lit(0).alias("at"), F.lit(0).alias("deepest")), step)["deepest"]


def named_tables(sql):
    """The tables a statement reads: those after FROM, JOIN and TABLE, in lists too, quoted or not, at any depth.

    Names defined by WITH are none within the statement or subquery that defines them. Texts and comments are taken out first.
    The innermost parentheses are replaced by marks with the tables they name, level by level, so that a list goes on behind a
    subquery or the condition of a JOIN. A statement of more than `MAX_DEPTH` levels names one table, `?`; a null statement is null.
    """
    bare = F.regexp_replace(without_text(F.lower(F.translate(sql, _OPEN + _CLOSE + _NEXT, ""))), "`([^`]*)`", "$1")
    bare = F.regexp_replace(bare, r"(?<!\s)\s*\.\s*", ".")
    bare = F.regexp_replace(bare, r"\bdistinct\s+from\s", "distinct ")

    def read(text, depth):
        levels = F.when(depth > 0, F.sequence(F.lit(1), depth)).otherwise(F.array().cast("array<int>"))
        single = F.aggregate(levels, text, lambda t, _: F.regexp_replace(t, _SINGLE, "$1$2 "))
        flat = F.aggregate(levels, single, lambda t, _: _let(t, _take_out_parts))
        return _let(F.regexp_replace(flat, "[()]", " "), lambda t: F.array_sort(_tables_of(t)))

    found = _let(bare, lambda text: _let(_depth(text), lambda depth: F.when(depth > MAX_DEPTH, F.array(F.lit(TOO_DEEP))).otherwise(read(text, depth))))
    return F.when(sql.isNotNull(), found)


# --- personal data ----------------------------------------------------------------------


def mask_pii(text):
    """Replace mail addresses, IP addresses, phone numbers and other numbers of ten digits or more by their kind."""
    for pattern, kind in ((EMAIL_AT_START, "EMAIL"), (IPV6, "IP"), (IPV4, "IP"), (PHONE, "PHONE"), (NUMBER, "NUMBER")):
        text = F.regexp_replace(text, pattern, f"[{kind}]")
    return text
