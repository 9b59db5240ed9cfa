"""Text cleaning and searching with Spark's own string functions; whole texts, no Python per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Typographic characters with a one-character ASCII form.
ONE_TO_ONE = {
    "‘": "'", "’": "'", "‚": "'", "‛": "'", "“": '"', "”": '"', "„": '"', "‟": '"', "′": "'", "″": '"',
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "•": "*", "·": "*", "×": "x", "⁄": "/",
    " ": " ", " ": " ", " ": " ", " ": " ", "\x0b": "\r",
}
# Those that need several characters.
ONE_TO_MANY = {"—": "--", "…": "...", "ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl", "≤": "<=",
               "≥": ">=", "≠": "!=", "±": "+/-", "→": "->", "←": "<-", "™": "(TM)", "®": "(R)", "©": "(C)",
               "½": "1/2", "¼": "1/4", "¾": "3/4", "œ": "oe", "Œ": "OE", "æ": "ae", "Æ": "AE"}


def to_ascii(text: Column | str) -> Column:
    """Typographic characters as ASCII, vertical tab as carriage return; other letters stay."""
    col = F.translate(_c(text), "".join(ONE_TO_ONE), "".join(ONE_TO_ONE.values()))
    many = reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), ONE_TO_MANY.items(), col)
    return F.when(col.rlike(f"[{''.join(ONE_TO_MANY)}]"), many).otherwise(col)  # one pass for most texts


def strip_brackets(text: Column | str) -> Column:
    """Without [[instructions]]; an opening without its closing stays, and there is no nesting."""
    return F.regexp_replace(_c(text), r"\[\[(?:[^\[\]]++|\[(?!\[)|\](?!\]))*+\]\]", "")


PAD = "\x00" * 4


def question_marks(text: Column | str) -> Column:
    """Snippets around question marks that may be lost characters, each followed by `|`.

    A mark after a letter and before a blank or quote is taken as a question and skipped. The text
    is searched from its end, and a reported mark hides those in the three characters before it;
    on the reversed text that is an ordinary left-to-right match. Near the beginning of the text
    (fewer than three characters before the mark) the snippet starts at the mark and ends the search.
    """
    backwards = F.concat(F.lit(PAD), F.reverse(_c(text)))
    # the mark itself comes first, so nothing else is tried at other characters
    mark = r"\?(?<=([\s\S]{4})\?)(?:[\s\S]{0,2}\z|(?!(?<=[ '\"]\?)[a-zA-Z])([\s\S]{3}))"
    after = F.regexp_extract_all(backwards, F.lit(mark), F.lit(1))
    before = F.regexp_extract_all(backwards, F.lit(mark), F.lit(2))
    snippets = F.zip_with(before, after, lambda b, a: F.concat(
        F.reverse(b), F.lit("?"), F.replace(F.reverse(a), F.lit("\x00"), F.lit("")), F.lit("|")))
    return F.concat(F.array_join(F.reverse(snippets), ""), F.lit(" "))


def keyword_tail(first: Column | str, second: Column | str) -> Column:
    """What follows `keyword` or `key word` (and one more character) in the first of two texts."""
    def tail(text, word):
        at = F.locate(word, F.lower(text))
        start = at + len(word) + 1
        return F.when((at > 0) & (start <= F.length(text) + 1), F.substring(text, start, F.length(text)))

    a, b = _c(first), _c(second)
    return F.coalesce(tail(a, "keyword"), tail(a, "key word"), tail(b, "keyword"), tail(b, "key word"), F.lit(""))


def contains(text: Column | str, term: str) -> Column:
    """Case-insensitive search for a term."""
    return F.coalesce(F.contains(F.lower(_c(text)), F.lit(term.lower())), F.lit(False))


def title_flag(title: Column | str, tag: str) -> Column:
    """`Y` where the title carries a tag word."""
    return F.when(F.contains(F.upper(_c(title)), F.lit(tag.upper())), "Y")


IN_PDF = "(in the PDF)"


def sections(flag: Column | str, *texts: Column | str) -> Column:
    """Sections joined to one text, or a note where a PDF holds them."""
    return F.when(_c(flag) == "Y", IN_PDF).otherwise(F.concat_ws("", *texts))


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x
