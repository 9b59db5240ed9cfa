"""Base spans against plain regular expressions; what the method adds; masking."""

import hashlib
import re

import pytest

from grantlens.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for k, (name, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if name == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if name == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if name == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end(), name))
    return [(name, start, end) for start, _, end, name in sorted(out)]


def joined(spans):
    return ",".join(f"{n}:{a}:{b}" for n, a, b in spans)


HARD = ["a@b.c%d@e.f x@y", "a@b.c@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.4", "4111 1111 1111 1111 4111-1111-1111-1111", "4111111111111111 5",
        "x4111111111111111y", "+1 (017) 555-7713 +44 20 7946 0958...) ++4911122233344", "é" * 50 + " ünï@ex-am.co.uk 😀 a.b+c@x.y.z. " + "1" * 5000,
        "1." * 3000 + " " + "a." * 4000 + "@" + "b." * 5000 + "c", "4" * 30 + " 4111 1111 1111  1111", "12 4111111111111111", "4111111111111111 4111111111111111",
        "a (at) b" + ".c" * 20_000, " ".join(f"u{i}@mail.example.com" for i in range(20_000)), " ".join(f"u{i} (at) mail (dot) com u{i}@x.org" for i in range(10_000)),
        "DE" + "89 3704" * 3000, "Mr. " * 5000 + "Ann " * 5000, "1 Aa " * 5000 + "Street",
        "999.9.9.9 9.9.9.9.9", "+12 34", "+1-234-567-890-123-456-7", "a" * 30_000, "@" * 1000 + "." * 1000, "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 " * 50]


def check(frame, docs):
    found = {}
    for r in frame.collect():
        found.setdefault(r["doc_id"], []).append(r)
    for doc_id, text in docs:
        spans = brute(text)
        r = found[doc_id][0]
        assert r["base_sha256"] == hashlib.sha256(joined(spans).encode()).hexdigest(), text[:80]
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(s[0] == k for s in spans) for k in PLAIN]
        assert set(filter(None, joined(spans).split(","))) <= set(r["spans"].split(","))
    assert sum(map(len, found.values())) == len(docs)


def test_documents(documents, texts):
    check(pii.digest(documents), texts)


def test_hard(spark):
    docs = list(enumerate(HARD))
    check(pii.digest(spark.createDataFrame(docs, "doc_id long, text string")), docs)


def test_odd(odd, none):
    from .conftest import ODD

    check(pii.digest(odd), ODD)
    assert pii.digest(none).count() == 0 and pii.masked(none).count() == 0
    assert pii.masked(odd).schema.names == odd.columns


def test_the_method_adds_keys_and_leaves_words_alone(documents, texts):
    found = {r["doc_id"]: r["spans"] for r in pii.digest(documents).collect()}
    secret = re.compile(r'token = "([0-9a-f]{40})"')
    for doc_id, text in texts:
        extra = set(filter(None, found[doc_id].split(","))) - set(joined(brute(text)).split(","))
        assert extra == {f"secret:{m.start(1)}:{m.end(1)}" for m in secret.finditer(text)}


def test_masked(documents, texts):
    masked = {r["doc_id"]: r for r in pii.masked(documents).collect()}
    changed = 0
    for doc_id, text in texts:
        out, at = [], 0
        extra = [("secret", m.start(1), m.end(1)) for m in re.finditer(r'token = "([0-9a-f]{40})"', text)]
        for name, start, end in sorted(brute(text) + extra, key=lambda s: s[1]):
            if start >= at:
                out.append(text[at:start] + f"<{name.upper()}>")
            at = max(at, end)
        want = "".join(out) + text[at:]
        changed += want != text
        assert masked[doc_id]["text"] == want and masked[doc_id]["n_chars"] == len(want)
    assert changed


def test_many_matches_in_one_text(spark):
    """20,000 addresses in one text take seconds, in the search and in the mask."""
    import time

    text = " ".join(f"user{i}@mail.example.com" for i in range(20_000))
    frame = spark.createDataFrame([(1, "a@b.co"), (2, text)], "doc_id long, text string")
    pii.digest(frame.limit(1)).collect()  # compiled before
    begin = time.time()
    found = {r["doc_id"]: r for r in pii.digest(frame).collect()}
    assert found[2]["n_email"] == found[2]["n_spans"] == 20_000
    assert time.time() - begin < 15
    begin = time.time()
    assert {r["doc_id"]: r["text"] for r in pii.masked(frame).collect()}[2] == " ".join(["<EMAIL>"] * 20_000)
    assert time.time() - begin < 25


PLANTED = [("person", "signed by Dr. Maria {w}"), ("person", "the author name is John {w}"), ("account", "please pay to IBAN DE89 3704 0044 0532 0130 00 {n}"), ("account", "konto GB82WEST12345698765432 {n}"),
           ("address", "she lives at {n} Green {w} Street"), ("address", "Adresse: Haupt{l}straße {n}"), ("email", "write to jo{l} [at] example [dot] org {n}"),
           ("secret", "api key = {h}"), ("phone", "call 555-0{n}-1234 {w}")]


def test_planted_names_accounts_and_addresses(spark):
    """Spans of every kind are found where they were planted, and sentences of the same words without them stay clean."""
    random = __import__("random").Random(3)
    docs, want = [], {}
    for i in range(180):
        kind, form = PLANTED[i % len(PLANTED)]
        text = form.format(w=random.choice(["Keller", "Mason", "Oak", "Hill"]), n=random.randint(10, 99), l=random.choice("abcdefg"), h="%040x" % random.getrandbits(160))
        docs.append((i, f"some words come first and {text} then more words follow"))
        want[i] = kind
    clean = ["the green street was empty and the author had no name", "we met 12 people at the square and they paid by card", "DE is a code and GB is another, an account of both follows",
             "Doctor and master are titles, john is a word here", "version 1.2 of the key came out in May"]
    docs += [(1000 + i, clean[i % len(clean)]) for i in range(100)]
    found = {r["doc_id"]: [x.split(":")[0] for x in r["spans"].split(",") if x] for r in pii.digest(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    hits = {k: [i for i, kind in want.items() if kind == k and k in found[i]] for k in set(want.values())}
    for kind, ids in hits.items():
        assert len(ids) >= 0.9 * sum(k == kind for k in want.values()), kind
    assert not [i for i in found if i >= 1000 and found[i]]


@pytest.mark.parametrize("vote", [0, 2])
def test_reliabilities_tell_good_labelers_from_noise(vote):
    import numpy as np

    random = np.random.default_rng(0)
    truth = random.random(4000) < 0.4
    said = np.stack([np.where(random.random(4000) < q, np.where(truth, 2, 0), np.where(random.random(4000) < 0.5, 2, 0)) for q in (0.9, 0.85, 0.9, 0.0, 0.8)], axis=1)
    table, p = pii.reliabilities(np.zeros(4000, int), said, np.ones(4000))
    assert ((p > 0.5) == truth).mean() > 0.95
    assert abs(table[3, 1, vote] - table[3, 0, vote]) < 0.1 < abs(table[0, 1, vote] - table[0, 0, vote])


def test_no_python_in_the_plan(documents):
    for frame in (pii.digest(documents), pii.masked(documents)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
