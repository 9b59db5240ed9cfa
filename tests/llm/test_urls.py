"""URL rules against brute force."""

import random

import pytest

from grantlens.llm import urls

LOWER = {i: i + 32 for i in range(65, 91)}


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host, rest = rest[:end].translate(LOWER), rest[end:]
    return host, rest[:min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))]


def brute(pages, rules, default="allow"):
    out = []
    for page_id, url in pages:
        host, path = parts(url)
        best = None
        for h, p, v in rules:
            if not h or p is None:
                continue
            h = h.translate(LOWER)
            if (host == h or host.endswith("." + h)) and path.startswith(p):
                best = max(best or (0,), (len(h + p), len(h), h + p, v))
        out.append((page_id, host, path, best[2] if best else None, best[3] if best else default))
    return sorted(out, key=repr)


def judged(spark, pages, rules, **more):
    frame = spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "'x' as host", "'y' as rule", "'z' as key", "1 as range", "2 as kind")
    given = spark.createDataFrame(rules, "host string, path string, verdict string")
    return sorted((tuple(r) for r in urls.judge(frame, given, **more).collect()), key=repr)


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
ODD = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://WWW.Example.COM/en/x?y#z"), (6, "http://example.com"), (7, "http://example.com?/en/"),
       (8, "http://notexample.com/en/"), (9, "http://a.b.net/es/é?ü"), (9, "http://a.b.net/es/é?ü"), (None, "http://net/fr/"), (10, "x://y://com/"), (11, "http://.com/"),
       (12, "http://com./"), (13, "http://com:80/"), (14, "http://" + "a." * 5000 + "com/" + "x/" * 5000), (15, "http://www.example.com/en"), (16, "://com/")]


@pytest.mark.parametrize("rules", [RULES, [], [("", "/", "block"), (None, "/", "block"), ("com", None, "block"), ("COM", "", "block"), ("com", "/", "allow"), ("com", "/", "block")]])
def test_odd(spark, rules):
    assert judged(spark, ODD, rules, default="block") == brute(ODD, rules, "block")


def test_empty(spark):
    assert judged(spark, [], RULES) == []


def test_many_nested_rules(spark, monkeypatch):
    """Random rules and pages over few labels, cut into many ranges, with one page that a third of the rows share."""
    monkeypatch.setattr(urls, "RANGES", (64, 64))
    random.seed(4)
    host = lambda n: ".".join(random.choice("abc") for _ in range(n))
    path = lambda n: "".join(random.choice(["/", "a", "b", "/a", "/b/"]) for _ in range(n))
    rules = list({(host(random.randint(1, 4)), path(random.randint(0, 4)), random.choice(["allow", "block"])) for _ in range(150)})
    pages = [(i, f"http://{host(random.randint(1, 6))}{'/' + path(5) if random.random() < 0.9 else ''}") for i in range(1200)]
    pages += [(2000 + i, "http://a.b.c.a/a/b/a") for i in range(600)]
    assert judged(spark, pages, rules) == brute(pages, rules)


def test_pages(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = sorted((tuple(r) for r in urls.judge(pages, rules).collect()), key=repr)
    assert got == brute([(r["page_id"], r["url"]) for r in pages.collect()], RULES)


def test_no_python_in_the_plan(spark, folder):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    plan = urls.judge(spark.read.parquet(f"{folder}/pages.parquet"), rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "html:string" not in plan
