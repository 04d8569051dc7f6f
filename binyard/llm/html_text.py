"""Operator 8: main-text extraction by minimum-cut labelling of text blocks.

A page is read into text blocks (runs of text between block-level tags), each
with its path of open elements.  Two things speak for or against a block being
content: what its page says outright (semantic elements, roles, and names such
as ``sidebar`` on its path), and a classifier of all else - length, sentence
marks, share of link text, the plain elements and the unlisted names around it.

The classifier is a logistic regression that learns from the pages themselves:
blocks that semantic elements or listed names settle are the labelled rows, and
those elements and names are no features of it.  It is fitted on the blocks of
a bounded sample (``SAMPLE`` pages by hash, ``PER_PAGE`` blocks of each); where
nothing is labelled, fixed weights stand in.  Its log-odds, bounded, and those
of the outright hints add up to a block's terminal capacity: to the source if
positive, to the sink if negative.

Smoothness edges join neighbours in page order and consecutive blocks of one
section; an element that sections a page or bears a telling name opens a
section.  An edge inside a section has the log-odds, over the labelled pages,
that such neighbours agree; one across a boundary likewise, near zero.  The
minimum cut labels the blocks; the source side is the article.  Sections nest,
so the edges never cross, and the cut is found in linear time: a node that no
later edge can reach is folded into a two-by-two table between its neighbours.

Script, style, form controls and the like never make blocks: they are not
text of the page.  Character references are decoded, white space inside a
block becomes one space, blocks are joined by one newline.  Nothing is capped.

Extraction is per page and needs no shuffle; one page is one row.

Edge cases: null, empty and text-free pages give an empty text; pages cut off
anywhere, tags left open or closed twice, quotes inside unquoted attributes and
unknown tags are read like a browser would, roughly; repeated rows are
extracted alike; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binyard.llm.common import ship

#: Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset("script style noscript template svg math canvas iframe object select option datalist textarea button head title".split())
RAW = frozenset("script style textarea title noscript iframe".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
#: What may stand in a head; any other start tag ends it, as text does.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: A start tag that ends an open element of the same kind.
SELF_CLOSING = {
    "p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that end an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SECTION = frozenset("article main section div nav header footer aside form ul ol table body figure dl".split())

#: Log-odds that an open element adds to the blocks inside it.
ELEMENT = {"article": 3.0, "main": 2.0, "p": 1.0, "blockquote": 0.5, "pre": 0.5, "h1": 1.0, "h2": 0.5, "h3": 0.3,
           "nav": -6.0, "footer": -6.0, "aside": -6.0, "header": -2.0, "form": -6.0, "menu": -6.0, "dialog": -6.0, "address": -1.0, "fieldset": -4.0}
#: Words of class names and ids.  A name is split at ``-``, ``_`` and capitals.
NOT_CONTENT = frozenset(
    """ad ads advert adverts advertisement advertising banner sponsor sponsored nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent
    popup modal overlay newsletter subscribe signup login comment comments respond replies disqus discussion pagination pager copyright disclaimer""".split())
HARDLY = frozenset(
    "promo promotion side widget foot header notice alert share sharing social related recommend recommended recommendations reply toolbar skip legal search tag tags rss toc".split())
CONTENT = frozenset("article content story post entry body main text prose".split())
#: A name with one of these tells of the page, not of the element: no-sidebar.
ABOUT = frozenset("no not non without with has have is js hide hides".split())
_BAD_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
BAD_NAME, GOOD_NAME = -5.0, 1.0
#: What the classifier may say at most beside those hints.
BOUND = 2.5
#: Capacities of the smoothness edges where none are learnt: inside a section,
#: and across a boundary; and the range of learnt ones.
INSIDE, ACROSS = 1.5, 0.2
INSIDE_RANGE, ACROSS_RANGE = (0.5, 2.0), (0.0, 0.5)

#: Pages that the classifier learns from, and blocks of each, at most.
SAMPLE, PER_PAGE = 1000, 100
#: Hint from which a block is labelled content, or boilerplate.
SURE, SURELY_NOT = 2.0, -3.0
#: Hash buckets of elements and names.
NAMES = 1 << 12

_ATTRS = r"(?:=\s*\"[^\"]*(?:\"|$)|=\s*'[^']*(?:'|$)|[^>=]|=)*"
_TOKEN = re.compile(rf"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)({_ATTRS})(?:>|$)", re.S)
_ATTR = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style|itemprop)(?![\w-])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WS = re.compile(r"[\s]+")
_END_MARK = re.compile(r"[.!?…:;]['\"»”)]?(?:\s|$)")
_NAME_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*|[^\W\d_]+")


def _named(value: str) -> tuple[float, list[str]]:
    """What the names in a class or id attribute say, and their words that
    are in no list.  An outright word beats a good name, and that a doubtful
    one."""
    bad = good = doubt = False
    rest = []
    for name in value.split():
        words = [w.lower() for w in _NAME_WORD.findall(name)]
        if not ABOUT.isdisjoint(words):
            continue
        if not NOT_CONTENT.isdisjoint(words):
            bad = True
        elif not HARDLY.isdisjoint(words):
            doubt = True
        elif not CONTENT.isdisjoint(words):
            good = True
        else:
            rest += words
    return (BAD_NAME if bad else GOOD_NAME if good else BAD_NAME if doubt else 0.0), rest


def _hint(tag: str, attrs: str) -> tuple[float, bool, bool, list[str]]:
    """What an element's name and attributes say about its text; whether the
    attributes do; hidden; words of names that say nothing."""
    score, hidden, rest = 0.0, False, []
    if attrs and not attrs.isspace():
        for m in _ATTR.finditer(attrs):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id"):
                said, words = _named(value)
                rest += words
                if tag not in ("body", "html"):  # theirs tell of the page
                    score += said
            elif name == "itemprop":
                score += 3.0 if value.lower() == "articlebody" else 0.0
            elif name == "role":
                score += BAD_NAME if value.lower() in _BAD_ROLE else GOOD_NAME if value.lower() in ("main", "article") else 0.0
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                hidden = True
            elif name == "style" and "display:none" in value.replace(" ", "").lower():
                hidden = True
    return ELEMENT.get(tag, 0.0) + score, score != 0.0, hidden, rest


class Block:
    __slots__ = ("text", "link", "hint", "section", "heading", "near")

    def __init__(self, text: str, link: int, hint: float, section: int, heading: bool, near: tuple[str, ...]) -> None:
        self.text, self.link, self.hint, self.section, self.heading, self.near = text, link, hint, section, heading, near


#: Elements and names nearest to a block that the classifier sees.
NEAREST = 6


def blocks(page: str) -> list[Block]:
    """Text blocks in page order."""
    out: list[Block] = []
    # name, log-odds so far, section, skipped, nearest plain elements and names
    stack: list[tuple[str, float, int, bool, tuple[str, ...]]] = [("", 0.0, 0, False, ())]
    run: list[str] = []
    linked, in_link, in_heading, sections, at, n = 0, 0, 0, 0, 0, len(page)

    def close() -> None:
        nonlocal linked
        if run:
            text = _WS.sub(" ", html.unescape("".join(run))).strip()
            if text:
                _, hint, section, _, near = stack[-1]
                out.append(Block(text, linked, hint, section, in_heading > 0, near))
            run.clear()
        linked = 0

    def pop(to: int) -> None:
        nonlocal in_link, in_heading
        for name, *_ in stack[to:]:
            in_link -= name == "a"
            in_heading -= name in HEADINGS
        del stack[to:]

    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        if stack[-1][0] == "head" and page[at : m.start()].strip():
            pop(len(stack) - 1)
        if m.start() > at and not stack[-1][3]:
            run.append(page[at : m.start()])
            if in_link:
                linked += m.start() - at
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:  # an end tag
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if tag not in INLINE:
                close()
            if place and not (tag in INLINE and any(x[0] not in INLINE for x in stack[place + 1 :])):
                pop(place)
            elif tag == "a" and in_link and place:
                in_link = 0
                stack[:] = [("" if i and x[0] == "a" else x[0], *x[1:]) for i, x in enumerate(stack)]
            continue
        if stack[-1][0] == "head" and tag not in IN_HEAD:
            pop(len(stack) - 1)
        if tag == "br":
            run.append(" ")
            continue
        if tag not in INLINE:
            close()
            ends = SELF_CLOSING.get(tag, ())
            if tag in ENDS_P and "p" not in ends:
                ends = (*ends, "p")
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in ends:
                    pop(i)
                    break
                if stack[i][0] in SECTION and not (tag in ("td", "th", "tr") and stack[i][0] not in ("table",)):
                    break
        if tag in VOID:
            continue
        hint, telling, hidden, names = _hint(tag, m[3])
        if m[3].endswith("/") and tag in SKIP:
            continue
        _, so_far, section, skipped, near = stack[-1]
        if hint <= SURELY_NOT:  # outright boilerplate, whatever it stands in
            so_far = min(so_far, 0.0)
        if tag not in INLINE and (tag in SECTION or telling):
            sections += 1
            section = sections
        if tag not in ELEMENT or names:
            near = (*([tag] if tag not in ELEMENT else []), *names, *near)[:NEAREST]
        stack.append((tag, so_far + hint, section, skipped or hidden or tag in SKIP, near))
        in_link += tag == "a"
        in_heading += tag in HEADINGS
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|$)", re.I).search(page, at)
            at = end.end() if end else n
            pop(len(stack) - 1)
    if stack[-1][0] == "head" and page[at:].strip():
        pop(len(stack) - 1)
    if at < n and not stack[-1][3]:
        run.append(page[at:])
    close()
    return out


def features(b: Block) -> tuple[list[int], list[float]]:
    """(places, values) of a block's features; the hints are none of them."""
    size = len(b.text)
    at = [0, 1, 2, 3, 4, 5]
    value = [1.0, math.log10(size + 1), min(len(_END_MARK.findall(b.text)), 4) / 4, min(1.0, b.link / size), float(b.heading), float(b.text[0] in "©℗")]
    for i, name in enumerate(b.near):
        # a stable hash of the name, apart for elements and names nearer and farther
        h = int.from_bytes(name.encode()[:8].ljust(8, b"\0"), "little") * 0x9E3779B97F4A7C15 + len(name) * 0xD6E8FEB86659FD93 & (1 << 64) - 1
        at.append(6 + (h >> 40) % NAMES)
        value.append(1.0 if i < 2 else 0.5)
    return at, value


class Model:
    """Weights of the classifier, and the smoothness edges' capacities."""

    def __init__(self, weights: np.ndarray | None = None, inside: float = INSIDE, across: float = ACROSS) -> None:
        self.weights, self.inside, self.across = weights, inside, across

    def log_odds(self, b: Block) -> float:
        """That a block is content: the classifier and the hints."""
        hint = max(-12.0, min(b.hint, 5.0))
        at, value = features(b)
        if self.weights is None:
            return -1.0 + 0.9 * value[1] + 2.0 * value[2] - 4.0 * value[3] - 3.0 * value[5] + hint
        z = sum(self.weights[i] * x for i, x in zip(at, value, strict=True))
        return max(-BOUND, min(z, BOUND)) + hint


PLAIN = Model()


def label(b: Block) -> int:
    """1 content, 0 boilerplate by the outright hints, else -1."""
    return 1 if b.hint >= SURE else 0 if b.hint <= SURELY_NOT else -1


def fit(rows: list[tuple[int, list[int], list[float]]], pairs: np.ndarray, rounds: int = 150, ridge: float = 3e-3) -> Model:
    """Logistic regression on (label, places, values); ``pairs`` counts
    neighbours by (across a boundary, labels differ).  Both labels weigh the
    same.  Without both labels, the plain model."""
    capacity = []
    for (same, differ), (low, high), plain in zip(pairs, (INSIDE_RANGE, ACROSS_RANGE), (INSIDE, ACROSS), strict=True):
        capacity.append(float(np.clip(math.log((same + 1) / (differ + 1)), low, high)) if same + differ else plain)
    y = np.array([r[0] for r in rows], dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return PLAIN
    size = np.array([len(r[1]) for r in rows])
    row, at = np.repeat(np.arange(len(y)), size), np.concatenate([r[1] for r in rows])
    x = np.concatenate([r[2] for r in rows])
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    w, step, last = np.zeros(6 + NAMES), np.zeros(6 + NAMES), np.zeros(6 + NAMES)
    for _ in range(rounds):  # gradient descent with momentum
        ahead = w + 0.9 * (w - last)
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights=ahead[at] * x, minlength=len(y)), -30, 30)))
        step = np.bincount(at, weights=(weight * (p - y))[row] * x, minlength=len(w)) + ridge * ahead
        last, w = w, ahead - 0.5 * step
    return Model(w, *capacity)


def cut(weights: list[float], inside: list[float], arcs: list[tuple[int, float]]) -> list[bool]:
    """Minimum cut of a chain with nested arcs: True for the source side.

    ``weights``: terminal capacities (positive: source, negative: sink);
    ``inside[i]``: of the edge between nodes i - 1 and i; ``arcs[i]``: (an
    earlier node, capacity) of one more edge of node i, (-1, 0) for none.  Arcs
    must nest.  Nodes between the ends of an arc have no edge that leaves it,
    so they are folded into the costs of the ends' labels; ties go to the sink."""
    n = len(weights)
    cost = [(max(w, 0.0), max(-w, 0.0)) for w in weights]  # of label 0 (sink side), 1
    # the nodes not yet folded; each with the cheapest cost of what lies between
    # it and the one before, by their labels (before, own)
    path: list[int] = []
    between: list[list[list[float]]] = []
    folded: list[tuple[int, int, int, list[list[int]]]] = []  # node, before, after, best label

    def fold() -> None:
        """The last node but one goes into the table of its neighbours."""
        mid, after = path.pop(-2), path[-1]
        right, left = between.pop(), between.pop()
        best = [[0, 0], [0, 0]]
        table = [[0.0, 0.0], [0.0, 0.0]]
        for a in (0, 1):
            for b in (0, 1):
                off, on = left[a][0] + cost[mid][0] + right[0][b], left[a][1] + cost[mid][1] + right[1][b]
                best[a][b], table[a][b] = (1, on) if on < off - 1e-12 else (0, off)
        between.append(table)
        folded.append((mid, path[-2], after, best))

    for i in range(n):
        path.append(i)
        between.append([[0.0, inside[i]], [inside[i], 0.0]])
        earlier, capacity = arcs[i]
        if earlier >= 0:
            while path[-2] != earlier:
                fold()
            between[-1][0][1] += capacity
            between[-1][1][0] += capacity
    if not n:
        return []
    while len(path) > 2:
        fold()
    out = [0] * n
    if len(path) == 1:
        out[path[0]] = int(cost[path[0]][1] < cost[path[0]][0] - 1e-12)
    else:
        a, b = path
        table = between[-1]
        total = [(cost[a][x] + table[x][y] + cost[b][y], x, y) for x in (0, 1) for y in (0, 1)]
        least = min(t for t, _, _ in total)
        _, out[a], out[b] = min((x + y, x, y) for t, x, y in total if t <= least + 1e-12)
    for mid, a, b, best in reversed(folded):
        out[mid] = best[out[a]][out[b]]
    return [bool(x) for x in out]


def labelled(found: list[Block], model: Model = PLAIN) -> list[bool]:
    """Which blocks are content."""
    last: dict[int, int] = {}
    inside, arcs = [], []
    for i, b in enumerate(found):
        inside.append(0.0 if not i else model.inside if found[i - 1].section == b.section else model.across)
        before = last.get(b.section, -1)
        arcs.append((before, model.inside) if 0 <= before < i - 1 else (-1, 0.0))
        last[b.section] = i
    return cut([model.log_odds(b) for b in found], inside, arcs)


def main_text(page: str | None, model: Model = PLAIN) -> str:
    if not page:
        return ""
    found = blocks(page)
    return "\n".join(b.text for b, k in zip(found, labelled(found, model), strict=True) if k)


_PAIRS = "kind int, label int, at array<int>, value array<double>"


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled blocks (kind 0) and counts of neighbours (kind 1) of pages."""
    pairs = np.zeros((2, 2))
    schema = pa.schema([("kind", pa.int32()), ("label", pa.int32()), ("at", pa.list_(pa.int32())), ("value", pa.list_(pa.float64()))])
    for batch in batches:
        rows = []
        for page in batch.column("html").to_pylist():
            found = blocks(page or "")
            own = [label(b) for b in found]
            for a, b, x, y in zip(found, found[1:], own, own[1:], strict=False):
                if x >= 0 <= y:
                    pairs[int(a.section != b.section), int(x != y)] += 1
            known = [(b, x) for b, x in zip(found, own, strict=True) if x >= 0]
            step = max(1, -(-len(known) // PER_PAGE))
            rows += [(0, x, *features(b)) for b, x in known[::step]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows else
                                         [pa.array([], f.type) for f in schema], schema=schema)
    yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.array([0], pa.int32()), pa.array([[]], pa.list_(pa.int32())),
                                      pa.array([pairs.ravel().tolist()], pa.list_(pa.float64()))], schema=schema)


def train(pages: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from about ``sample`` pages, chosen by a hash of their text."""
    ship(pages.sparkSession)
    rows = pages.select(F.col("html").cast("string").alias("html")).filter("html is not null")
    n = rows.count()
    share = F.lit(min(1.0, sample / max(n, 1)))
    rows = rows.filter(F.pmod(F.xxhash64("html"), F.lit(1 << 20)) < share * (1 << 20))
    found = rows.mapInArrow(_examples, _PAIRS).collect()  # bounded: about sample * PER_PAGE blocks
    pairs = sum((np.array(r["value"]).reshape(2, 2) for r in found if r["kind"] == 1), np.zeros((2, 2)))
    return fit(sorted((r["label"], r["at"], r["value"]) for r in found if r["kind"] == 0), pairs)


def extract(pages: DataFrame, model: Model = PLAIN) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html)."""
    spark = pages.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast((model.weights, model.inside, model.across))  # some 30 KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            texts = [main_text(x, own) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op8(spark, sf_dir: str) -> DataFrame:
    """The main text of every page, by a classifier of these pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, train(pages))
