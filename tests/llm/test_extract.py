"""Main text: minimum cuts against enumeration, page structure, and the articles of the test pages."""

import html
import itertools
import random
import re

import numpy as np
import pytest

from grantlens.llm import extract


def test_minimum_cut_is_minimal():
    random.seed(1)
    for _ in range(200):
        n = random.randint(1, 7)
        content, boiler = ([random.random() * 4 for _ in range(n)] for _ in range(2))
        edges = [(i, j, random.random()) for i in range(n) for j in range(i) if random.random() < 0.5]
        cost = lambda kept: sum(c if not k else b for c, b, k in zip(content, boiler, kept)) + sum(w for i, j, w in edges if kept[i] != kept[j])
        best = min(cost(kept) for kept in itertools.product([False, True], repeat=n))
        assert cost(extract.minimum_cut(content, boiler, edges)) == pytest.approx(best)


def article(page):
    """The truth of the test pages: what their article element holds."""
    inner = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", page, re.S)[1]
    plain = re.sub(r"</?(?:b|i|a)\b[^>]*>", "", inner).replace("<br>", " ")
    return "\n".join(filter(None, (" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:p|h1|h2|ul|li)>", plain))))


def test_pages(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    for r in extract.extract(pages).collect():
        assert r["text"] == want[r["page_id"]] and r["n_chars"] == len(r["text"])


PAGE = """<html><head><title>My story - Site</title></head><body class="has-sidebar"><header><h1>Site</h1><a href=x>Login</a></header>
<div id=cookieNotice>We use cookies</div><div class="layout-with-sidebar"><main><h1>My story</h1><p>First&nbsp;paragraph &lt;here&gt;, with <a href=y>a link</a>.</p>
<div class="ad-slot">Buy now!</div><ul><li>One point</li><li>Two points</ul><p>Second para.<script>x("</p>")</script> More <!-- not this --><b>t</b>ext<form><label>Mail</label><input>
<button>Go</button></form></main><aside><p>Related: long text of another article, with commas, and more of it.</p></aside>
<section id="comments"><p>I totally disagree with this, sir.</p></section></div><footer>&copy; 2020</footer></body></html>"""


def test_parts_of_a_page():
    weights = np.array(list(extract.PRIOR.values()))
    assert extract.main_text(PAGE, weights) == "My story\nFirst paragraph <here>, with a link.\nOne point\nTwo points\nSecond para. More text"


def test_pages_without_marks(spark, folder):
    """With all container marks removed, text features find most of the article and little else."""
    pages = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    weights = extract.train(spark.read.parquet(f"{folder}/pages.parquet"))
    right = total = extra = 0
    for _, page in pages:
        bare = re.sub(r"</?(?:article|nav|footer)>", "", re.sub(r'<div class="ad">', "<div>", page))
        got, want = set(extract.main_text(bare, weights).split("\n")), set(article(page).split("\n"))
        right, total, extra = right + len(got & want), total + len(want), extra + len(got - want)
    assert right > 0.9 * total and extra < 0.3 * total


@pytest.mark.parametrize("page", ["", "plain, only words and more of them. Truly.", "<", "<p", "<p>a<p>b", "<!--", "</div></p>x", "<script>never closed", "<a href='x\">y</a>", "&#0;&#xD800;&notit;",
                                  "<div>" * 3000 + "deep" + "</div>" * 10, "<p>" + "long text, " * 30_000, "<ul>" + "<li><a href=x>y</a>" * 3000, "<title>only", "\x00"])
def test_odd_pages_do_not_break(page):
    text = extract.main_text(page, np.array(list(extract.PRIOR.values())))
    assert isinstance(text, str)
    text.encode("utf-8", "strict")


def test_odd(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", PAGE), (3, "u", PAGE), (None, None, PAGE), (4, "u", "<p>" + "word, " * 100_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars", "2 as examples")
    got = extract.extract(frame).collect()
    assert len(got) == 6 and {r["text"] for r in got if r["page_id"] in (1, 2)} == {""}
    assert len({r["text"] for r in got if r["page_id"] == 3}) == 1 and next(r for r in got if r["page_id"] == 4)["n_chars"] == 100_000 * 6 - 1
    assert extract.extract(frame.limit(0)).count() == 0


@pytest.mark.parametrize("page, want", [
    ("<article><p>Before it.</p><object data=x><p>Inside of it.</p><p>After it.</p></article>", ["Before it.", "Inside of it.", "After it."]),
    *[(f"<article><p>Before it.</p><{tag}><p>After it.</p></article>", ["Before it.", "After it."]) for tag in "video audio canvas svg math noscript iframe template".split()],
    ("<article><p>So <math><mi>x</mi> = <mn>2</mn></math> holds.</p></article>", ["So x = 2 holds."]),
    ("<article><p>A <svg><title>icon</title><path d='M0'/><text>label</text></svg> b.</p></article>", ["A", "label b."]),
    ("<article><p>A <svg/>b <noscript>not this</noscript>c<template>nor this</template>.</p></article>", ["A b c."]),
    ("<html><head><title>T</title><div><p>A page without an end of its head.</p></div>", ["A page without an end of its head."]),
    ("<head><meta charset=x><title>T</title><script>x</script>Text at once, <b>and more</b>.", ["Text at once, and more."]),
    ("<head><title>A <b>bold</b> title</title></head><body><p>Text.</p>", ["Text."]),
])
def test_no_text_is_lost(page, want):
    assert [b.text for b in extract.blocks(page)[0]] == want


def test_features_look_at_whole_blocks():
    title = "A title of more than sixty characters, which a paragraph may repeat at its begin"
    table, repeated, same = (extract.Block(t, "p", False, False, 0, 0) for t in ("prose " * 100 + "1" * 600, title[:60] + " and then go on with text.", title))
    rows = extract.describe([table, repeated, same], title)
    assert rows[0, extract.NAMES.index("digits")] == 0.5 and rows[:, extract.NAMES.index("is_title")].tolist() == [0, 0, 1]


LEARNED = {}


@pytest.fixture(params=["prior", "learned"])
def weights(request, spark, folder):
    if request.param == "prior":
        return np.array(list(extract.PRIOR.values()))
    if not LEARNED:
        LEARNED["w"] = extract.train(spark.read.parquet(f"{folder}/pages.parquet"))
    return LEARNED["w"]


RECIPE = ("<html><body><div class='wrap'><nav><a href=/>Home</a></nav><div><h1>Pancakes</h1><ul><li>Two eggs</li><li>Some flour</li><li>A cup of milk</li></ul>"
          "<p>Mix everything well, let it rest for a while, and bake thin pancakes in a hot pan.</p></div><footer>&copy; 2021 Site</footer></div></body></html>")


@pytest.mark.parametrize("page, want", [
    ("<article><p>First paragraph of the text.</p><![CDATA[ never closed ><p>Second paragraph, after it.</p></article>", "First paragraph of the text.\nSecond paragraph, after it."),
    ("<article><p>One sentence here.</p><!--><p>Two sentences here.</p><!-- x --!><p>Three of them.</p></article>", "One sentence here.\nTwo sentences here.\nThree of them."),
    ("<div class='share-price-report'><p>The share price rose by a tenth on Monday, the company said.</p></div>", "The share price rose by a tenth on Monday, the company said."),
    ("<div class='share-price-report'>" + "".join(f"<p>The share price rose by {i} tenths on Monday, as the company and its bank said.</p>" for i in (2, 3, 4)) + "</div>",
     "\n".join(f"The share price rose by {i} tenths on Monday, as the company and its bank said." for i in (2, 3, 4))),
    (RECIPE, "Pancakes\nTwo eggs\nSome flour\nA cup of milk\nMix everything well, let it rest for a while, and bake thin pancakes in a hot pan."),
    ("<p>One short paragraph.</p>", "One short paragraph."),
    ("<html><body><p>Just a few words</p></body></html>", "Just a few words"),
    ("<nav><a href=x>Home page of this site</a></nav><footer>All about us and our partners.</footer>", ""),
    ("<div class='sidebar'><p>Some words of a sidebar that stands alone.</p></div><div id='share-buttons'><a href=x>Share this with all your friends</a></div>", ""),
])
def test_article_text_is_kept(weights, page, want):
    assert extract.main_text(page, weights) == want


@pytest.mark.parametrize("name, told", [("share-price-report", {"share": 1 / 9}), ("share-buttons", {"share": 1.0}), ("cookieNotice", {"cookie": 1.0, "notice": 1.0}), ("layout-with-sidebar", {}),
                                        ("sponsored-content", {"sponsored": 1.0}), ("post-body", {}), ("related", {"related": 1.0})])
def test_words_count_by_their_share_of_a_name(name, told):
    assert extract.told_by(name)[0] == pytest.approx(told)


def test_time_grows_with_the_page_however_deep():
    import time

    for page in ("<div>" * 60_000 + "<p>deep text here</p>", "<div><b>" * 30_000 + "x" + "</i>" * 60_000, "<p>a</p></div>" * 40_000, "<svg>" * 30_000 + "<title>t</title>" * 10_000):
        begin = time.time()
        extract.blocks(page)
        assert time.time() - begin < 6
