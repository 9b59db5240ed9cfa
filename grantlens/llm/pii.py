"""Personal data by weak supervision, in DataFrame functions.

Regular expressions propose spans: the strict ones of the base kinds, and wider ones (written-out mail addresses, phone
numbers without a country code, other long numbers, keys and passwords). Labelers vote for or against each proposed span, or abstain: strict
patterns, gazetteers of endings and signal words, the words before it, its shape and its neighbours. Expectation-maximisation over
the counts of vote patterns (a table bounded by the number of patterns, not of spans) estimates how reliable each labeler
is and how likely each pattern is personal data. A logistic span classifier is trained on those probabilities with the span's length and share of
digits as further features, and decides on the wider spans; base spans always stay.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

KINDS = ["email", "ip", "card", "phone", "secret", "account", "person", "address"]
BASE = 4  # the first kinds have strict patterns
VOTES = ["strict", "gazetteer", "context", "shape", "edges"]
AROUND = 32  # characters before and after a span that labelers see
ROUNDS = 40

# Strict patterns find what the plain ones of the contract find, from the same places, without trying again inside a run.
_NAME = "[A-Za-z0-9._%+-]"
STRICT = {
    "email": rf"(?:\G|(?<!{_NAME})){_NAME}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][ -][0-9])(?:[ -]?+[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "phone": "+"}  # characters without which a pattern cannot match
# The gazetteers. Given names and words of streets, in the languages of the signal words below.
GIVEN = ("Alice Anna Anne Antonio Barbara Carlos Charles Christian Christine Claire Claudia Daniel David Elena Elizabeth Emily Emma Eva Fatima Francisco Frank George Hannah Hans "
         "Heinrich Helen Isabel Ivan Jack Jacques James Jan Javier Jean Jennifer Joan Johann John Jorge Jose José Juan Julia Jürgen Karen Karl Katharina Klaus Laura Lena Linda "
         "Louis Lucas Luis Manuel Marco Maria María Marie Mark Martin Mary Mehmet Michael Michel Miguel Mohammed Monika Nicolas Olga Patricia Paul Pedro Peter Philippe Pierre Rachel "
         "Richard Robert Rosa Sabine Sarah Sofia Sophie Stefan Susan Sylvie Thomas Ursula Wei William Wolfgang").split()
TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra"
ROADS = "Street|St|Road|Rd|Avenue|Ave|Lane|Drive|Boulevard|Square"
_WORD = r"[\p{Lu}][\p{Ll}]{1,30}+"
WIDE = {
    "email": rf"(?<!{_NAME}){_NAME}{{1,64}}+ ?[\[(](?:at|AT|arroba)[\])] ?[A-Za-z0-9-]{{1,63}}+(?: ?(?:\.|[\[(](?:dot|DOT|punkt|punto|point)[\])]) ?[A-Za-z0-9-]{{1,63}}+)++",
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][ -][0-9])(?:[ -]?+[0-9]){10,18}+(?![ -]?[0-9])",
    "phone": r"(?<![0-9+(.-])(?<![0-9] )\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])(?![ .-][0-9])",
    "secret": r"(?<![A-Za-z0-9_/+.-])(?=[A-Za-z_/+-]*+[0-9])[A-Za-z0-9_/+-]{20,512}+(?![A-Za-z0-9_/+@-])",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?+[A-Z0-9]{4}){2,7}+(?: ?+[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
    "person": rf"(?=[A-Z][\p{{L}}]{{1,11}}+\.? [\p{{Lu}}])(?<![\p{{L}}0-9])(?:(?:{TITLES})\.? (?:{_WORD}|[\p{{Lu}}]\.)|(?:{'|'.join(GIVEN)}) (?:[\p{{Lu}}]\. )?{_WORD})(?:[ -]{_WORD}){{0,2}}+",
    "address": rf"(?=[0-9A-ZÄÖÜc])(?<![\p{{L}}0-9])(?:[0-9]{{1,5}}+ (?:{_WORD} ){{1,3}}(?:{ROADS})(?![\p{{L}}])|[\p{{Lu}}][\p{{Ll}}]{{1,30}}(?:straße|strasse|weg|gasse|platz) [0-9]{{1,5}}+|[0-9]{{1,5}}+,? [Rr]ue (?:de (?:la )?)?{_WORD}|[Cc]alle (?:de )?{_WORD},? [0-9]{{1,5}}+)",
}
WIDE_NEEDS = {"email": r"[\[(](?:at|AT|arroba)[\])]", "card": r"[0-9][0-9 -]{9}", "phone": r"[0-9]{3}[ .-][0-9]{4}", "secret": r"[A-Za-z0-9_/+-]{20}",
              "account": r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}", "person": r"[A-Z][\p{L}]{1,11}+\.? [\p{Lu}]",
              "address": r"[0-9]{1,5}+,? [\p{Lu}Rr]|[\p{L}],? [0-9]"}

# Signal words of the gazetteer and context labelers.
ENDINGS = r"(?i)\.(?:com|net|org|edu|gov|info|io|de|fr|es|uk|eu)$"
SIGNALS = {
    "email": r"(?i)(?:e-?mail|contact|write|kontakt|courriel|correo)",
    "ip": r"(?i)(?:\bip\b|host|server|address|adresse|from)",
    "card": r"(?i)(?:card|visa|amex|karte|carte|tarjeta|iban|account)",
    "phone": r"(?i)(?:tel|phone|call|fax|mobil|fon|numéro|llam)",
    "secret": r"(?i)(?:token|secret|passw|pwd|api|key|bearer|credential)",
    "account": r"(?i)(?:iban|account|konto|compte|cuenta|bank)",
    "person": r"(?i)(?:name|by|from|dear|author|signed|von|nom|nombre|sehr geehrte[r]?|chère?|estimad[oa])",
    "address": r"(?i)(?:address|lives?|at|street|adresse|wohnt|habite|dirección|vive)",
}
AT_ONCE = 64


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scanned(items: Column, zero: Column, out: str, step) -> Column:
    """What `step(state, item) -> (state, output)` gives for the items in turn: an array of `out`.

    Outputs are gathered AT_ONCE at a time, so that no growing array is copied for each item.
    """
    empty = F.array().cast(f"array<{out}>")

    def inner(done, x):
        state, made = step(done["state"], x)
        return F.struct(state.alias("state"), F.concat(done["out"], F.array(made.cast(out))).alias("out"))

    def outer(done, chunk):
        part = F.aggregate(chunk, F.struct(done["state"].alias("state"), empty.alias("out")), inner)
        return let(part, lambda p: F.struct(p["state"].alias("state"), F.concat(done["out"], p["out"]).alias("out")))

    def whole(it):
        chunks = F.transform(F.sequence(F.lit(0), ((F.size(it) - 1) / AT_ONCE).cast("int")), lambda i: F.slice(it, i * AT_ONCE + 1, F.lit(AT_ONCE)))
        begun = F.struct(zero.alias("state"), empty.alias("out"))
        return F.when(F.size(it) == 0, empty).when(F.size(it) <= AT_ONCE, F.aggregate(it, begun, inner, lambda d: d["out"])).otherwise(
            F.aggregate(chunks, begun, outer, lambda d: d["out"]))

    return let(items, whole)


MATCH = "struct<start:int,end:int,m:string,before:string,after:string>"


def found(text: Column, pattern: str, guard: Column) -> Column:
    """All matches, leftmost first without overlap: array of (start, end, m, before, after), in characters.

    `before` and `after` hold what stands around a match: up to AROUND characters, no further back than the gap before the match before it, and two.
    Everything comes from the matches and the gaps between them, so that the work grows with the text.
    """
    cut = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g"))
    around = F.lit(AROUND)

    def rows(c):
        last = lambda a, i: F.right(F.get(c[a], i), around)
        return F.transform(c["m"], lambda m, i: F.struct(
            F.length(F.get(c["g"], i)).alias("gap"), m.alias("m"),
            F.right(F.concat(F.when(i > 0, F.concat(last("g", i - 1), last("m", i - 1))).otherwise(""), last("g", i)), around).alias("before"),
            F.left(F.concat(F.left(F.get(c["g"], i + 1), F.lit(2)), F.coalesce(F.left(F.get(c["m"], i + 1), F.lit(2)), F.lit(""))), F.lit(2)).alias("after")))

    def place(at, x):
        end = at + x["gap"] + F.length(x["m"])
        return end, F.struct((at + x["gap"]).alias("start"), end.alias("end"), x["m"].alias("m"), x["before"].alias("before"), x["after"].alias("after"))

    spans = scanned(let(cut, rows), F.lit(0), MATCH, place)
    return F.when(guard & text.rlike(pattern), spans).otherwise(F.array().cast(f"array<{MATCH}>"))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the check of payment cards."""
    figures = F.transform(F.split(F.reverse(number), ""), lambda d: d.cast("int"))
    doubled = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def valid(kind: str, s: Column) -> Column:
    """Whether a match of a strict pattern counts."""
    m = s["m"]
    if kind == "ip":
        return m.rlike(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$")
    if kind == "card":
        return luhn(digits(m))
    if kind == "phone":
        return F.length(digits(m)).between(10, 15)
    return F.lit(True)


def _of(fn, *fixed):
    """A function of one span, with its other arguments fixed (higher-order functions count parameters)."""
    return lambda s: fn(*fixed, s)


def account(m: Column) -> Column:
    """Whether the letters and figures of an account number have the remainder 1 that its check digits give them."""
    signs = F.split(F.translate(F.concat(F.substring(F.translate(m, " ", ""), F.lit(5), F.lit(64)), F.substring(m, F.lit(1), F.lit(4))), " ", ""), "")
    value = lambda c: F.when(c.between("A", "Z"), F.ascii(c) - 55).otherwise(c.cast("int"))
    return F.aggregate(F.filter(signs, lambda c: c != ""), F.lit(0), lambda a, c: (a * F.when(c.between("A", "Z"), 100).otherwise(10) + value(c)) % 97) == 1


def _span(kind: int, base: bool, s: Column) -> Column:
    return F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"), F.lit(base).alias("base"), s["m"].alias("m"),
                    s["before"].alias("before"), s["after"].alias("after"))


def proposals(text: Column) -> Column:
    """All proposed spans of a text: array of (start, kind, end, base, m, before, after)."""
    strict = []
    for number, kind in enumerate(KINDS[:BASE]):
        guard = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else F.lit(True)
        kept = F.filter(found(text, STRICT[kind], guard), _of(valid, kind))
        strict.append(F.transform(kept, _of(_span, number, True)))
    wide = [F.transform(found(text, p, text.rlike(WIDE_NEEDS[kind])), _of(_span, KINDS.index(kind), False)) for kind, p in WIDE.items()]
    return F.concat(*strict, *wide)


PROPOSED = "struct<start:int,kind:int,end:int,base:boolean,m:string,before:string,after:string,ok:boolean>"


def distinct_places(spans: Column) -> Column:
    """The spans in order, without the wide ones that overlap a base span: one pass knows how far base spans before it reach, one where the next begins."""

    def told(s, ok):
        return F.struct(*[s[c].alias(c) for c in ("start", "kind", "end", "base", "m", "before", "after")], ok.alias("ok"))

    def forth(reach, s):
        return F.when(s["base"], F.greatest(reach, s["end"])).otherwise(reach), told(s, s["base"] | (reach <= s["start"]))

    def back(begin, s):
        return F.when(s["base"], s["start"]).otherwise(begin), told(s, s["base"] | (s["ok"] & (begin >= s["end"])))

    def passed(every):
        first = scanned(F.array_sort(every), F.lit(0), PROPOSED, forth)
        return F.reverse(F.filter(scanned(F.reverse(first), F.lit(2**31 - 1), PROPOSED, back), lambda s: s["ok"]))

    mixed = lambda every: F.exists(every, lambda s: ~s["base"]) & F.exists(every, lambda s: s["base"])
    whole = lambda every: F.transform(F.array_sort(every), lambda s: told(s, F.lit(True)))
    return let(spans, lambda every: F.when(mixed(every), passed(every)).otherwise(whole(every)))


def votes(s: Column) -> dict[str, Column]:
    """What each labeler says on a span: 2 for, 0 against, 1 nothing."""
    by_kind = lambda of: F.coalesce(*(F.when(s["kind"] == i, of(k)) for i, k in enumerate(KINDS)))
    share = F.length(digits(s["m"])) / F.length(s["m"])

    def gazetteer(kind):
        if kind == "email":
            return F.when(s["m"].rlike(ENDINGS), 2).otherwise(1)
        if kind == "phone":
            return F.when(s["m"].rlike(r"^\+(?:1|33|34|44|49)[^0-9]"), 2).otherwise(1)
        if kind == "card":
            return F.when(s["m"].rlike("^(?:4|5[1-5]|3[47]|6011)"), 2).otherwise(1)
        if kind == "ip":
            return F.when(s["m"].rlike(r"^0+\.|^255\."), 0).otherwise(1)
        if kind == "account":
            return F.when(s["m"].rlike("^(?:AT|BE|CH|DE|ES|FR|GB|IE|IT|LU|NL|PL|PT|SE)"), 2).otherwise(1)
        if kind == "person":
            return F.when(s["m"].rlike(rf"(?<![\p{{L}}])(?:{'|'.join(GIVEN)})(?![\p{{L}}])"), 2).otherwise(1)
        if kind == "address":
            return F.when(s["m"].rlike(rf"(?i)(?:{ROADS}|straße|strasse|weg|gasse|platz|rue|calle)"), 2).otherwise(1)
        return F.when(s["m"].rlike("^(?:sk-|ghp_|AKIA|xox)"), 2).otherwise(1)

    def shape(kind):
        if kind == "secret":
            return F.when(s["m"].rlike("^[0-9a-f]{32,64}$") | (share.between(0.1, 0.9) & s["m"].rlike("[a-z]")), 2).otherwise(0)
        if kind == "phone":
            return F.when(F.length(digits(s["m"])).between(10, 15), 2).otherwise(0)
        if kind == "account":
            return F.when(account(s["m"]), 2).otherwise(0)
        if kind == "person":
            return F.when(s["m"].rlike(rf"^(?:{TITLES})\.? .*[\p{{Ll}}]{{2}}"), 2).otherwise(1)
        if kind == "address":
            return F.when(s["m"].rlike(r"[0-9]") & s["m"].rlike(r"[\p{Lu}]"), 2).otherwise(1)
        if kind == "card":
            return F.when(s["base"], 2).otherwise(0)
        return F.when(s["base"], 2).otherwise(1)

    return {
        "strict": F.when(s["base"] | s["m"].rlike("^[0-9a-f]{32,64}$"), 2).when((s["kind"] == KINDS.index("account")) & account(s["m"]), 2).otherwise(1),
        "gazetteer": by_kind(gazetteer),
        "context": by_kind(lambda k: F.when(s["before"].rlike(SIGNALS[k]), 2).otherwise(F.lit(0) if k in ("secret", "address") else F.lit(1))),
        "shape": by_kind(shape),
        "edges": F.when(s["before"].rlike(r"[A-Za-z0-9/]$") | s["after"].rlike("^[A-Za-z0-9/]"), 0).when(
            s["before"].rlike(r"[\s\"'(:=<|]$|^$") & s["after"].rlike(r"^[\s\"').,;:>|]|^$"), 2).otherwise(1),
    }


def features(s: Column) -> Column:
    """Small numbers that describe a span: kind, votes, length and share of digits."""
    length, share = F.length(s["m"]), F.length(digits(s["m"])) / F.length(s["m"])
    size = F.when(length < 12, 0).when(length < 20, 1).when(length < 40, 2).otherwise(3)
    figures = F.when(share < 0.1, 0).when(share < 0.5, 1).when(share < 0.9, 2).otherwise(3)
    return F.struct(s["kind"].alias("kind"), *(v.cast("int").alias(n) for n, v in votes(s).items()), size.alias("size"), figures.alias("figures"))


NAMES = ["kind", *VOTES, "size", "figures"]
SIZES = [len(KINDS), *[3] * len(VOTES), 4, 4]


def reliabilities(kinds: np.ndarray, said: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns: P(vote | personal or not) of each labeler, and each pattern's probability."""
    p = np.clip(0.5 + (said - 1).sum(axis=1) / (2 * said.shape[1]), 0.05, 0.95)
    table = np.zeros((said.shape[1], 2, 3))
    for _ in range(ROUNDS):
        weight = np.stack([n * (1 - p), n * p])
        for j in range(said.shape[1]):
            for y in (0, 1):
                table[j, y] = np.bincount(said[:, j], weight[y], minlength=3) + [0.5, 1.0, 0.5]
        table /= table.sum(axis=2, keepdims=True)
        prior = (np.bincount(kinds, weight[1], minlength=len(KINDS)) + 1) / (np.bincount(kinds, n, minlength=len(KINDS)) + 2)
        odds = np.log(prior / (1 - prior))[kinds]
        for j in range(said.shape[1]):
            odds = odds + np.log(table[j, 1, said[:, j]] / table[j, 0, said[:, j]])
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return table, p


def classifier(rows: np.ndarray, n: np.ndarray, p: np.ndarray) -> list[np.ndarray]:
    """Logistic regression on one-hot features against the estimated probabilities; weights per feature value."""
    start = np.cumsum([0, *SIZES[:-1]])
    columns = rows + start
    w = np.zeros(sum(SIZES))
    weight = n / max(n.sum(), 1)
    spread = np.bincount(columns.ravel(), np.repeat(weight, len(SIZES)), minlength=len(w)) + 1e-6
    for _ in range(600):
        guess = 1 / (1 + np.exp(-np.clip(w[columns].sum(axis=1), -30, 30)))
        slope = np.bincount(columns.ravel(), np.repeat((guess - p) * weight, len(SIZES)), minlength=len(w))
        w -= (slope + 1e-5 * w) / spread / len(SIZES) * 2
    return np.split(w, start[1:])


def labelled(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns `keep` with `_spans`: base spans and the wide ones the trained classifier accepts, in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    spans = docs.select(*keep, distinct_places(proposals(text)).alias("_proposed"))
    stored = staged(spans.withColumn("_proposed", F.transform("_proposed", lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["base"].alias("base"), features(s).alias("f")))))
    seen = stored.select(F.explode("_proposed.f").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    patterns = sorted(([r["f"][c] for c in NAMES], r["n"]) for r in seen.collect())  # one row per pattern
    weights = [np.zeros(size) for size in SIZES]
    if patterns:
        rows, n = np.array([p for p, _ in patterns]), np.array([c for _, c in patterns], float)
        _, likely = reliabilities(rows[:, 0], rows[:, 1:1 + len(VOTES)], n)
        weights = classifier(rows, n, likely)
    accept = lambda s: sum((F.get(F.array(*map(F.lit, map(float, w))), s["f"][c]) for c, w in zip(NAMES, weights)), F.lit(0.0)) > math.log(1.0)
    chosen = F.filter("_proposed", lambda s: s["base"] | accept(s))
    ordered = F.array_sort(F.transform(chosen, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["base"].alias("base"))))
    return stored.withColumn("_spans", ordered).drop("_proposed")


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans per kind, base_sha256, spans and n_spans (how many there are in all) of every whole text (null: empty).

    Each row is searched by itself, so repeated rows repeat their result. Texts without spans have an empty string and its hash. Very
    long texts, and any number of matches in one, take time in proportion. An empty table has no rows. Other columns are not read.
    """
    found_in = labelled(docs.select("doc_id", "text"), ["doc_id"])
    base = F.filter("_spans", lambda s: s["base"])
    counts = [F.size(F.filter("_spans", _of(lambda i, s: s["base"] & (s["kind"] == i), i))).cast("long").alias(f"n_{k}")
              for i, k in enumerate(KINDS[:BASE])]
    return found_in.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("_spans")).alias("spans"), F.size("_spans").cast("long").alias("n_spans"))


PIECE = 4096  # characters; a place in a long text is looked up in its piece


def _cut(pieces: Column, start: Column, end: Column) -> Column:
    """The characters from start to end of a text given in pieces."""
    a, b = (start / PIECE).cast("int"), ((end - 1) / PIECE).cast("int")
    first = F.get(pieces, a)
    apart = F.concat(F.substring(first, start % PIECE + 1, F.lit(PIECE)), F.array_join(F.slice(pieces, a + 2, b - a - 1), ""), F.substring(F.get(pieces, b), F.lit(1), (end - 1) % PIECE + 1))
    return F.when(start >= end, "").when(a == b, F.substring(first, start % PIECE + 1, end - start)).otherwise(apart)


def masked(docs: DataFrame) -> DataFrame:
    """Documents with every span replaced by its kind in angle brackets; n_chars, where there is one, follows the text. A null text stays.

    Spans that overlap are replaced together, under the kind of the first one.
    """
    columns = docs.columns
    named = {c: f"_{i}" for i, c in enumerate(columns) if c != "text"}  # span columns cannot clash
    renamed = docs.select(*(F.col(f"`{c}`").alias(named.get(c, c)) for c in columns))
    marked = labelled(renamed, [named.get(c, c) for c in columns])
    names = F.array(*map(F.lit, [f"<{k.upper()}>" for k in KINDS]))

    whole = F.regexp_extract_all(F.col("text"), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def put(pieces):
        def step(at, s):
            label = F.when(s["start"] >= at, F.get(names, s["kind"])).otherwise("")
            return F.greatest(at, s["end"]), F.struct(F.greatest(at, s["end"]).alias("at"), F.concat(_cut(pieces, at, s["start"]), label).alias("out"))

        out = scanned(F.col("_spans"), F.lit(0), "struct<at:int,out:string>", step)
        return let(out, lambda o: F.concat(F.array_join(F.transform(o, lambda x: x["out"]), ""), _cut(pieces, F.element_at(o, -1)["at"], F.length("text"))))

    text = F.when(F.size("_spans") == 0, F.col("text")).otherwise(let(whole, put))
    changed = marked.withColumn("text", text)
    return changed.select(*((F.length("text").cast(docs.schema[c].dataType) if c == "n_chars" else F.col(named.get(c, c))).alias(c) for c in columns))
