"""Main text of web pages by a minimum cut.

A page is cut into blocks of text at block-level tags. A logistic classifier gives each block's probability of being content; its log odds
become capacities to the two terminals. Smoothness edges join neighbouring blocks, and more strongly blocks of the same container, items
of one list, and headings and lists with what stands beside them. The minimum cut then separates content from boilerplate with the
lowest total cost.

The classifier learns, on a bounded sample of pages, from blocks whose elements or roles say what they are (an article or main element; navigation,
footers and so on). Words of classes and ids are features with weights of their own, never labels: a word counts by its share of the name that it stands in, so that no
single word of a longer name decides. In half of the examples marks and words are hidden, so that the classifier also learns from length, links and punctuation
for pages without them. It is drawn towards fixed prior weights, which alone decide where a table has no marked page.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

SAMPLE_PAGES, SAMPLE_BLOCKS = 400, 64  # pages, and blocks of each, that the classifier learns from
NEIGHBOUR, CONTAINER = 0.3, 0.5  # capacities between blocks next to each other, and inside one container
ITEMS, BESIDE = 1.5, 1.5  # ... between items of one list, and between a heading or list and its neighbour in the same part of the page
CERTAIN = 6.0  # log odds count up to here

# Names of the language of web pages, and words that name parts of pages.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html iframe legend li main menu nav ol optgroup option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style".split())  # hold no markup, up to their end tag or the end of the page
HIDDEN_TAGS = frozenset("noscript template iframe".split())  # not shown; without an end tag they are taken as any element
FOREIGN_TAGS = frozenset("svg math".split())
HEAD_TAGS = frozenset("html head title meta link base script style noscript template".split())  # anything else ends an open head
CONTENT_TAGS = frozenset("article main".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog button select textarea fieldset".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
CONTENT_WORDS = frozenset("article content main post entry story".split())
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login menu nav navbar navigation breadcrumb breadcrumbs sidebar widget widgets related recommended recommendations share sharing social "
    "footer copyright header masthead topbar toolbar pagination pager comment comments commentlist reply replies disqus respond discussion search form".split())
PLAIN_WORDS = frozenset(  # say nothing about what a part holds
    "area block body bottom box button buttons card col column container group head header icon icons inline inner item items left link links list outer panel post posts results right row "
    "section slot small large strip the title top unit wrap wrapper bar".split())
ABOUT_OTHERS = frozenset("has with no without not hide show".split())  # a name with them tells what stands elsewhere
LISTED = frozenset("li dt dd".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

# Features of a block with the weights that training starts from.
PRIOR = {
    "constant": -0.2, "marked_content": 3.0, "marked_boiler": -5.0, "link_share": -2.5, "length": 0.35, "few_words": -0.6, "sentence_end": 0.8,
    "heading": 0.6, "list_item": 0.2, "commas": 0.3, "copyright": -2.0, "is_title": 1.0, "digits": -0.5, "content_word": 1.5,
    **{f"word_{w}": -6.0 for w in sorted(BOILER_WORDS)},
}
NAMES = list(PRIOR)
MARKS = [i for i, n in enumerate(NAMES) if n.startswith(("marked_", "word_")) or n == "content_word"]
WORD_AT = {n[5:]: i for i, n in enumerate(NAMES) if n.startswith("word_")}

_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Element:
    tag: str
    content: bool = False  # stands inside a marked article
    boiler: bool = False  # stands inside an element or role that is none
    content_word: bool = False
    words: dict[str, float] = field(default_factory=dict)  # words of the names around it that tell of other parts, with their shares
    number: int = 0


@dataclass
class Block:
    text: str
    tag: str
    content: bool
    boiler: bool
    container: int  # the element that the block's own element stands in
    linked: int
    part: int = 0  # the element around that
    content_word: bool = False
    words: dict[str, float] = field(default_factory=dict)


def told_by(name: str) -> tuple[dict[str, float], bool]:
    """The words of one class or id that tell of other parts than the article, with their squared share of its meaning words; whether it tells of an article."""
    words = [w.lower() for w in _WORDS.findall(name)]
    if ABOUT_OTHERS & set(words):
        return {}, False
    boiler = [w for w in words if w in BOILER_WORDS]
    if not boiler:
        return {}, bool(CONTENT_WORDS & set(words))
    meaning = [w for w in words if w in BOILER_WORDS or w not in PLAIN_WORDS and w not in CONTENT_WORDS]
    return {w: (len(boiler) / len(meaning)) ** 2 for w in boiler}, False


def _mark(parent: Element, tag: str, attributes: str, number: int) -> Element:
    out = Element(tag, parent.content, parent.boiler, parent.content_word, parent.words, number)
    if tag in CONTENT_TAGS:
        out.content, out.words = True, {}  # a page's wrapper may be named after its sidebar
    if tag in BOILER_TAGS or (tag == "header" and not parent.content):
        out.boiler = True
    if attributes and tag not in ("html", "body"):
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values)
            if name in ("class", "id"):
                for one in value.split():
                    words, content = told_by(one)
                    if words and tag not in CONTENT_TAGS:
                        out.words = {w: max(words.get(w, 0.0), out.words.get(w, 0.0)) for w in {*words, *out.words}}
                    if content and tag in ("div", "section"):
                        out.content_word = True
            elif name == "role":
                if value.lower() in BOILER_ROLES:
                    out.boiler = True
                elif value.lower() in CONTENT_TAGS:
                    out.content = True
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
                out.boiler = True
    return out


def blocks(page: str) -> tuple[list[Block], str]:
    """The blocks of a page with text, and its title. Unclosed and unmatched tags are taken as browsers mostly do.

    Open elements are found by their tag, so the work grows with the page, however deep it is nested.
    """
    stack, out, title = [Element("")], [], []
    places: dict[str, list[int]] = {}  # of open elements in the stack, by tag
    held: list[int] = []  # of open block elements
    text: list[str] = []
    linked, at, count = 0, 0, 0

    def is_open(*tags: str) -> bool:
        return any(places.get(t) for t in tags)

    def flush() -> None:
        nonlocal linked
        if text:
            found = " ".join(html.unescape("".join(text)).split())
            text.clear()
            inner = stack[-1]
            if found:
                if is_open("title"):
                    if not is_open(*FOREIGN_TAGS):
                        title.append(found)
                elif not is_open("head"):
                    own, around, part = (stack[held[-i]] if len(held) >= i else stack[0] for i in (1, 2, 3))
                    out.append(Block(found, own.tag, inner.content, inner.boiler, around.number, linked, part.number, inner.content_word, inner.words))
        linked = 0

    def open_(element: Element) -> None:
        places.setdefault(element.tag, []).append(len(stack))
        if element.tag in BLOCK_TAGS:
            held.append(len(stack))
        stack.append(element)

    def close(upto: int) -> None:
        while len(stack) > upto:
            gone = stack.pop()
            places[gone.tag].pop()
            if gone.tag in BLOCK_TAGS:
                held.pop()

    def end_head(tag: str = "") -> None:
        if is_open("head") and (tag in ("body", "article", "main", "nav", "footer") or not is_open("title") or places["title"][-1] < places["head"][0]):
            flush()
            close(places["head"][0])

    end = len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        run = page[at:m.start() if m else end]
        if run:
            if not run.isspace():
                end_head()
            text.append(run)
            if is_open("a"):
                linked += len(run.strip())
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCK_TAGS:
                flush()
            if is_open(tag):
                close(places[tag][-1])
            continue
        alone = m[3].rstrip().endswith("/")
        if tag in RAW_TAGS or tag in HIDDEN_TAGS:
            last = None if alone else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if last:
                at = last.end()
            elif tag in RAW_TAGS and not alone:
                at = end
            if last or alone or tag in RAW_TAGS:
                continue
        if tag not in HEAD_TAGS:
            end_head(tag)
        if alone and (tag in ("svg", "math", "object", "canvas", "audio", "video") or is_open(*FOREIGN_TAGS)):
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
            if stack[-1].tag not in BLOCK_TAGS or stack[-1].tag in ("p", *CLOSED_BY):
                inner = held[-1] if held else 0
                if inner and (stack[inner].tag == "p" or tag in CLOSED_BY and stack[inner].tag in CLOSED_BY[tag]):
                    close(inner)
        if tag in VOID_TAGS:
            continue
        count += 1
        open_(_mark(stack[-1], tag, m[3], count))
    flush()
    return out, " ".join(title)


def describe(found: list[Block], title: str) -> np.ndarray:
    """Feature rows, in the order of NAMES."""
    rows = np.zeros((len(found), len(NAMES)))
    for row, b in zip(rows, found):
        n = len(b.text)
        listed, heading = b.tag in LISTED, b.tag in HEADINGS
        size, few = math.log1p(n) - 3, b.text.count(" ") < 3
        row[:14] = (1, b.content and not b.boiler, b.boiler, min(1.0, b.linked / n), max(size, 0.0) if listed or heading else size, few and not listed and not heading, b.text[-1] in ".!?:;…»”\"'", heading,
                    listed, min(1.0, 20 * b.text.count(",") / n), "©" in b.text, bool(title) and b.text in title, sum(map(str.isdigit, b.text)) / n, b.content_word and not b.boiler and not b.words)
        for word, share in b.words.items():
            row[WORD_AT[word]] = share / len(b.words)  # together as much as one
    return rows


def fit(rows: np.ndarray, labels: np.ndarray, seed: int = 5) -> np.ndarray:
    """Weights of the classifier: logistic regression drawn towards the prior, with the marks hidden in half of the examples."""
    prior = np.array([PRIOR[n] for n in NAMES])
    if not len(rows) or labels.min() == labels.max():
        return prior
    random = np.random.default_rng(seed)
    hidden = rows.copy()
    hidden[:, MARKS] = 0
    x, y = np.concatenate([rows, hidden]), np.concatenate([labels, labels])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    order = random.permutation(len(x))
    x, y, weight, w = x[order], y[order], weight[order], prior.copy()
    for _ in range(30):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + 0.01 * (w - prior)
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def minimum_cut(content: list[float], boiler: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay on the content side. content, boiler: cost of calling a node boilerplate, or content; edges: cost of parting two nodes.

    What both terminals can send through a node is sent at once; shortest augmenting paths by levels carry the rest.
    """
    n = len(content)
    source = [max(0.0, c - b) for c, b in zip(content, boiler)]
    sink = [max(0.0, b - c) for c, b in zip(content, boiler)]
    near: list[list[list]] = [[] for _ in range(n)]  # [other node, capacity left, place of the reverse edge]
    for a, b, capacity in edges:
        near[a].append([b, capacity, len(near[b])])
        near[b].append([a, capacity, len(near[a]) - 1])
    tiny = 1e-12
    while True:
        level = [0 if s > tiny else -1 for s in source]
        queue = deque(i for i in range(n) if not level[i])
        reached = False
        while queue:
            i = queue.popleft()
            if sink[i] > tiny:
                reached = True
            for j, left, _ in near[i]:
                if left > tiny and level[j] < 0:
                    level[j] = level[i] + 1
                    queue.append(j)
        if not reached:
            return [x >= 0 for x in level]
        following = [0] * n
        for start in range(n):
            while source[start] > tiny:
                path: list[list] = []
                i = start
                while True:
                    if sink[i] > tiny:
                        break
                    while following[i] < len(near[i]):
                        edge = near[i][following[i]]
                        if edge[1] > tiny and level[edge[0]] == level[i] + 1:
                            break
                        following[i] += 1
                    else:
                        if not path:
                            i = -1
                            break
                        i = near[path[-1][0]][path[-1][2]][0]
                        path.pop()
                        following[i] += 1
                        continue
                    path.append(edge)
                    i = edge[0]
                if i < 0:
                    break
                flow = min(source[start], sink[i], *(e[1] for e in path)) if path else min(source[start], sink[i])
                source[start] -= flow
                sink[i] -= flow
                for e in path:
                    e[1] -= flow
                    near[e[0]][e[2]][1] += flow


def main_text(page: str | None, weights: np.ndarray) -> str:
    """The content blocks of a page, one a line."""
    if not page:
        return ""
    found, title = blocks(page)
    if not found:
        return ""
    odds = np.clip(describe(found, title) @ weights, -CERTAIN, CERTAIN)
    kept = _cut(found, odds)
    if not any(kept):
        # A page of prose has a main text: the likeliest paragraph is one, and what holds on to it.
        prose = [i for i, b in enumerate(found) if not b.boiler and 2 * b.linked < len(b.text) and "©" not in b.text and b.text.count(" ") >= 3 and max(b.words.values(), default=0.0) < 0.5]
        if prose:
            odds[max(prose, key=lambda i: odds[i])] = 2 * CERTAIN
            kept = _cut(found, odds)
    return "\n".join(b.text for b, k in zip(found, kept) if k)


def _cut(found: list[Block], odds: np.ndarray) -> list[bool]:
    content, boiler = np.logaddexp(0, odds), np.logaddexp(0, -odds)
    return minimum_cut(content.tolist(), boiler.tolist(), edges(found))


def edges(found: list[Block]) -> list[tuple[int, int, float]]:
    """What parting two blocks costs. Blocks that are marked differently, or mostly links, hold on to others as any neighbours only."""
    out, last = [], {}
    alike = lambda a, b: a.boiler == b.boiler and a.content == b.content and a.words == b.words and 2 * a.linked < len(a.text) and 2 * b.linked < len(b.text)
    for i, b in enumerate(found):
        if i:
            before = found[i - 1]
            close = NEIGHBOUR
            if alike(before, b):
                a_part, b_part = (x.part if x.tag in LISTED else x.container for x in (before, b))
                if before.tag in LISTED and b.tag in LISTED and before.container == b.container:
                    close = ITEMS
                elif a_part == b_part and {before.tag, b.tag} & (LISTED | HEADINGS):
                    close = BESIDE
            out.append((i - 1, i, close))
        if b.container in last:
            out.append((last[b.container], i, CONTAINER))
        last[b.container] = i
    return out


def train(pages: DataFrame) -> np.ndarray:
    """Fit the classifier on marked blocks of at most SAMPLE_PAGES pages, chosen by a hash of their ids."""
    chosen = pages.select(F.col("page_id").cast("long").alias("page_id")).where("page_id IS NOT NULL").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE_PAGES)
    ids = pages.sparkSession.createDataFrame([(r["page_id"],) for r in chosen.collect()], "page_id long")  # SAMPLE_PAGES rows at most

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            out = []
            for page in part.column("html").to_pylist():
                found, title = blocks(page or "")
                # A block of an article that stands in a part named otherwise is no example of either kind.
                known = [b for b in found if b.boiler or b.content and not b.words]
                known = [known[i] for i in np.unique(np.linspace(0, len(known) - 1, min(len(known), SAMPLE_BLOCKS)).astype(int))] if known else []
                rows = describe(known, title)
                out.append([[*row, float(not b.boiler)] for row, b in zip(rows.tolist(), known)])
            yield pa.RecordBatch.from_arrays([part.column("page_id"), pa.array(out, pa.list_(pa.list_(pa.float64())))], ["page_id", "examples"])

    read = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").alias("html"))
    found = read.join(F.broadcast(ids), "page_id", "left_semi").mapInArrow(marked, "page_id long, examples array<array<double>>")
    once = found.groupBy("page_id").agg(F.min("examples").alias("examples")).orderBy("page_id").collect()  # a repeated id counts once
    examples = np.array([e for r in once for e in r["examples"]]).reshape(-1, len(NAMES) + 1)
    return fit(examples[:, :-1], examples[:, -1])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page: the main text of the whole html (null: empty), blocks in page order, one a line.

    Each row is read by itself, so repeated rows repeat their text. Very long and deeply nested pages are read whole. An empty table has no
    rows. Other columns are not read.
    """
    weights = train(pages)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            found = [main_text(page, weights) for page in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(found, pa.string()),
                                              pa.array([len(t) for t in found], pa.int64())], ["page_id", "url", "text", "n_chars"])

    read = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), F.col("html").alias("html"))
    return read.mapInArrow(texts, "page_id long, url string, text string, n_chars long")
