"""The one-line criteria language: a text per column becomes a Column predicate.

    (blank) or eg:...   no restriction
    a,b,c               one of the values
    a::b                between a and b, both included
    a%  a_b  0[12]      pattern: % any run, _ one character, [..] a character class
    anything else       equal
    ~...                negation of any of the above

Quotes are ignored. The text never becomes SQL, so it cannot inject any.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CriteriaError(ValueError):
    pass


def has_value(spec: str | None) -> bool:
    text = (spec or "").strip()
    return text != "" and not text.startswith("eg:")


def split_negation(spec: str | None) -> tuple[bool, str]:
    """(negated, rest); the rest is empty when there is no restriction."""
    if not has_value(spec):
        return False, ""
    text = re.sub(" +", " ", spec.strip(" "))
    return (True, text[1:]) if text.startswith("~") else (False, text)


def like_to_regex(pattern: str) -> str:
    """An anchored regular expression for a pattern with character classes."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        close = pattern.find("]", i + 2) if ch == "[" else -1
        if ch == "%":
            out.append(".*")
        elif ch == "_":
            out.append(".")
        elif close > 0:
            body = pattern[i + 1 : close]
            negated = body.startswith("^")
            body = re.sub(r"([\\\[\]&~^])", r"\\\1", body[1:] if negated else body)
            out.append(f"[{'^' if negated else ''}{body}]")
            i = close
        else:
            out.append(re.escape(ch))
        i += 1
    return "(?s)^" + "".join(out) + r"\z"


def like(col: Column, pattern: str) -> Column:
    """LIKE with character classes. Without a class Spark's own LIKE is used, which reaches the
    scan as a StartsWith, EndsWith or Contains filter where it is one."""
    if "[" in pattern and "]" in pattern:
        return col.rlike(like_to_regex(pattern))
    return col.like(pattern.replace("\\", "\\\\"))


def positive(col: Column, text: str, integer: bool = False) -> Column:
    """The predicate of a specification without its negation."""
    bare = text.replace('"', "").replace("'", "")
    listed, ranged = "," in text, "::" in text
    wild = "%" in text or "_" in text or ("[" in text and "]" in text)
    if wild and (listed or ranged):
        raise CriteriaError(f"wildcards cannot be used in a list or a range: {text}")
    value = (lambda s: int(s)) if integer else (lambda s: s)
    if listed:
        return col.isin([value(part.strip(" ")) for part in bare.split(",")])
    if ranged:
        low, high = bare.split("::", 1)
        return col.between(value(low), value(high))
    if wild:
        return like(col, bare)
    return col == value(bare)


def predicate(col: Column | str, spec: str | None, integer: bool = False) -> Column | None:
    """The predicate of one specification, or None where it does not restrict."""
    negated, text = split_negation(spec)
    if text == "":
        return None
    cond = positive(F.col(col) if isinstance(col, str) else col, text, integer)
    return ~cond if negated else cond


def combine(specs: dict[str, str | None], integers: tuple[str, ...] = ()) -> Column | None:
    """All specifications of a dict column -> text, joined by AND."""
    cond = None
    for name, spec in specs.items():
        one = predicate(name, spec, name in integers)
        if one is not None:
            cond = one if cond is None else cond & one
    return cond


def apply(df: DataFrame, specs: dict[str, str | None], integers: tuple[str, ...] = (),
          when_empty: str = "nothing") -> DataFrame:
    """Filter by all specifications.

    Without any restriction the result is empty rather than the whole table, or an error with
    `when_empty="error"`.
    """
    cond = combine(specs, integers)
    if cond is None:
        if when_empty == "error":
            raise CriteriaError("give at least one restriction, or list proposals")
        return df.filter(F.lit(False))
    return df.filter(cond)
