"""Spark-free parts against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from binyard.llm import decontaminate, html_text, kernel, lang_id, near_dedup, ngram_trie, quality, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = ["a b c d", None, "", " \t\n\x0b\x0c\r", "One  two\tÉÈ\xa0x", "one two ÉÈ\xa0x", "x " * 4000, "tail", "Ünïcode 漢字 😀 b c d"]


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def test_words_and_shingles():
    data, offsets = kernel.buffers(pa.array(TEXTS))
    _, _, row, h = kernel.words(data, offsets)
    flat = [(r, w) for r, t in enumerate(TEXTS) for w in words_of(t)]
    assert row.tolist() == [r for r, _ in flat]
    by_word = {}
    for (_, w), x in zip(flat, h.tolist(), strict=True):
        assert by_word.setdefault(w, x) == x
    assert len(set(by_word.values())) == len(by_word)
    for k in (3, 5):
        sets = dict(kernel.shingle_sets(data, offsets, k))
        for r, t in enumerate(TEXTS):
            w = words_of(t)
            want = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}
            assert len(sets[r]) == len(want), (k, r)
        assert sets[4].tolist() == sets[5].tolist()


def test_sliced_and_chunked_columns():
    whole = pa.chunked_array([TEXTS[:4], TEXTS[4:]])
    data, offsets = kernel.buffers(pa.array(["zz", *TEXTS]).slice(1))
    other, places = kernel.buffers(whole)
    assert data.tobytes() == other.tobytes() and offsets.tolist() == places.tolist()
    assert kernel.buffers(pa.array([], pa.string()))[1].tolist() == [0]


@pytest.mark.parametrize("n,top", [(0, 10), (1, 1), (5, 3), (700, 2**64 - 1), (3000, 60)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
    e = ngram_trie.EliasFano.view(ngram_trie.EliasFano.encode(v).tobytes())
    assert (e.values() == v).all()
    asked = np.concatenate((v, rng.integers(0, top, 300, dtype=np.uint64, endpoint=True)))
    first = {int(x): i for i, x in reversed(list(enumerate(v)))}
    assert e.find(asked).tolist() == [first.get(int(x), -1) for x in asked]


@pytest.mark.parametrize("n,top", [(1, 1), (5, 3), (700, 2**64 - 1), (3000, 60), (5000, 2**40)])
def test_elias_fano_access(n, top):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
    e = ngram_trie.EliasFano.view(ngram_trie.EliasFano.encode(v).tobytes())
    at = rng.permutation(n)
    assert (e.access(at) == v[at]).all()


@pytest.mark.parametrize("words", [0, 1, 40, 3000])
def test_trie_in_a_mapped_file(words, tmp_path):
    """Searches relative to a context, against a dictionary."""
    rng = np.random.default_rng(words)
    word = np.unique(rng.integers(0, 2**64 - 1, words, dtype=np.uint64))
    # few successors, so that contexts share them; 0 and the largest among them
    pool = np.concatenate((np.array([0, ngram_trie.SUCCESSOR_MASK], np.uint64), rng.integers(0, 2**40, 30, dtype=np.uint64)))
    pairs = {}
    for i in range(len(word)):
        for s in rng.choice(pool, rng.integers(0, 12)).tolist():
            pairs[i, s] = int(rng.integers(1, 9))
    keys = sorted(pairs)
    pair = np.array([i << 40 | s for i, s in keys], dtype=np.uint64)
    n = np.array([pairs[k] for k in keys], dtype=np.int64)
    taken = np.array([0.0, 0.5, 0.9, 1.2])
    whole = {int(word[3]): (1000, 5, 6, 7)} if len(word) > 3 else {}
    (tmp_path / "t").write_bytes(ngram_trie.Trie.build(word, np.arange(len(word)), pair, n, taken, whole))
    trie = ngram_trie.Trie.view(np.memmap(tmp_path / "t", dtype=np.uint8, mode="r"))
    assert trie.word(word).tolist() == list(range(len(word))) and trie.count.tolist() == list(range(len(word)))
    asked = np.concatenate((word, rng.integers(0, 2**64 - 1, 20, dtype=np.uint64)))
    place = trie.word(asked)
    assert (place[len(word):] == -1).all()
    spread = rng.integers(0, 25, len(asked))
    successor = np.concatenate([rng.choice(pool, k) for k in spread] + [np.zeros(0, np.uint64)])
    code = trie.pairs(place, spread, successor)
    follows = {}
    for (i, _), c in pairs.items():
        follows[i] = follows.get(i, 0) + c
    if whole:
        follows[3] = 1000
    got = ngram_trie.restore(code)
    for i, s, p in zip(np.repeat(place, spread).tolist(), successor.tolist(), got.tolist(), strict=True):
        c = pairs.get((i, s))
        assert p == 0 if c is None else abs(np.log10(p) - np.log10((c - taken[min(c, 3)]) / follows[i])) <= ngram_trie.STEP / 2 + 1e-9
    if whole:
        assert abs(np.log10(ngram_trie.restore(trie.backoff[3:4])[0]) - np.log10((0.5 * 5 + 0.9 * 6 + 1.2 * 7) / 1000)) <= ngram_trie.STEP / 2 + 1e-9


def test_elias_fano_in_a_mapped_file(tmp_path):
    v = np.arange(0, 50000, 7, dtype=np.uint64)
    (tmp_path / "level").write_bytes(ngram_trie.EliasFano.encode(v).tobytes())
    e = ngram_trie.EliasFano.view(np.memmap(tmp_path / "level", dtype=np.uint8, mode="r"))
    assert e.find(np.array([14, 15], dtype=np.uint64)).tolist() == [2, -1]


def test_sketch_estimates():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 2**63, 4000, dtype=np.uint64) * np.uint64(2))
    for share in (0.5, 0.8, 0.95):
        b = np.sort(np.concatenate((a[: int(len(a) * share)], np.unique(rng.integers(0, 2**63, int(len(a) * (1 - share)), dtype=np.uint64)))))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        j, n = near_dedup.estimate(near_dedup.registers(a)[None], near_dedup.registers(b)[None], np.array([len(a)]), np.array([len(b)]))
        assert abs(j[0] - true) < 5 * np.sqrt(true * (1 - true) / n[0]) + 0.01
    far = np.unique(rng.integers(0, 2**63, 4000, dtype=np.uint64))
    assert near_dedup.estimate(near_dedup.registers(a)[None], near_dedup.registers(far)[None], np.array([4000]), np.array([4000]))[0][0] < 0.05


def test_containment_recall():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [say(n) for n in (1, 4, 5, 7, 11, 16, 25, 40, 59, 90, 300, 2000) for _ in range(4)] + [None, ""]
    docs = []
    for i, item in enumerate(items):
        w = (item or "").split()
        if len(w) > 12 and i % 2:
            w[len(w) // 2] = "changed"
        docs.append(f"{say(700)} {' '.join(w)} {say(3000)}")
    docs += [say(2000) for _ in range(10)] + [None, "", items[0], items[4]]
    def sets(texts):
        return [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w := words_of(t)) >= 5 else {tuple(w)} - {()} for t in texts]
    ds, its = sets(docs), sets(items)
    want = {(d, i, len(ds[d] & its[i])) for d in range(len(docs)) for i in range(len(items)) if its[i] and 10 * len(ds[d] & its[i]) >= 8 * len(its[i])}
    index = decontaminate.Index([x for _, x in kernel.shingle_sets(*kernel.buffers(pa.array(items)), 5)])
    assert set(decontaminate.search(index, *kernel.buffers(pa.array(docs)), 5, 0.8)) == want
    assert len(want) > 30


def nested(rng, n):
    """A chain's capacities and random arcs that nest, one earlier end a node."""
    inside, arcs, open_ = [0.0], [(-1, 0.0)], [0]
    for i in range(1, n):
        inside.append(rng.uniform(0, 2))
        while len(open_) > 1 and rng.random() < 0.4:
            open_.pop()
        if rng.random() < 0.5 and open_[-1] < i - 1:
            arcs.append((open_[-1], rng.uniform(0, 2)))
            open_[-1] = i
        else:
            arcs.append((-1, 0.0))
            if rng.random() < 0.5:
                open_.append(i)
    return inside, arcs


def test_minimum_cut_is_minimal():
    rng = random.Random(8)
    for _ in range(300):
        n = rng.randrange(1, 11)
        weights = [rng.choice([rng.uniform(-3, 3), 0.0, 1.0, -1.0]) for _ in range(n)]
        inside, arcs = nested(rng, n)
        edges = [(i - 1, i, inside[i]) for i in range(1, n)] + [(a, i, c) for i, (a, c) in enumerate(arcs) if a >= 0]
        cost = lambda keep: sum(abs(w) for w, k in zip(weights, keep, strict=True) if (w > 0) != k and w) + sum(c for a, b, c in edges if keep[a] != keep[b])  # noqa: E731, B023
        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert abs(cost(html_text.cut(weights, inside, arcs)) - best) < 1e-6
    assert html_text.cut([], [], []) == []


def signs(page, model=html_text.PLAIN):
    return "\n".join(b.text for b in html_text.blocks(page) if model.log_odds(b) > 0)


def test_the_cut_decides_where_the_sign_is_wrong():
    """Short, link-heavy or unmarked blocks go with what they stand among."""
    text = "A paragraph of the story that says what happened, and to whom. It goes on for a while."
    story = f"<div><p>{text}</p><p>{text}</p><div><a href=/x>Read the document</a></div><p>{text}</p><p>Yes.</p><p>{text}</p></div>"
    menu = "".join(f"<li><a href=/{i}>Topic number {i}</a></li>" for i in range(6))
    page = f"<body><ul>{menu}<li>Our own page for news of every kind.</li>{menu}</ul><section>{story.replace('<div><a', '<span></span><p><a').replace('document</a></div>', 'document</a></p>')}</section></body>"
    got = html_text.main_text(page).split("\n")
    assert got == [text, text, "Read the document", text, "Yes.", text]
    assert signs(page).split("\n") != got and "Our own page for news of every kind." in signs(page)


def test_names_and_attributes():
    text = "Some text of the article that stands here. It has two sentences."
    for page in (f"<p class=it's>{text}", f"<body class='no-sidebar'><p>{text}</p>", f"<div class='entry-content social'><p>{text}</p></div>",
                 f"<body class='has-sidebar with-footer'><div id=main><p title='a>b'>{text}</p></div>", f"<div data-class=sidebar><p>{text}</p></div>",
                 f"<p class=x'y\"z>{text}</p>", f"<p class = 'a>b' id=\"c>d\">{text}</p>", f"<div class=noSidebar><p>{text}</p></div>"):
        assert html_text.main_text(page) == text, page
    for page in (f"<div class='content sidebar'><p>{text}</p></div>", f"<div class='x-nav'><p>{text}</p></div>", f"<div class=mainMenu><p>{text}</p></div>",
                 f"<div id=comments class=content><p>{text}</p></div>", f"<div role=navigation><p>{text}</p></div>", f"<div hidden><p>{text}</p></div>"):
        assert html_text.main_text(page) == "", page
    inside = f"<article><p>{text}</p><p class=ad>Buy this now. It is cheap.</p><p>{text}</p></article>"
    assert html_text.main_text(inside) == f"{text}\n{text}"


def test_large_pages_take_linear_time():
    import time
    text = "<p>Some text of a paragraph that stands here.</p>"
    for page in (text * 40000, "".join(f"<div>{text}" for _ in range(4000)), "".join(f"<section>{text}<ul><li><a href=x>link {i}</a></ul></section>" for i in range(12000))):
        began = time.process_time()
        got = html_text.main_text(page)
        assert time.process_time() - began < 8 and got.count("Some text") >= 4000


def test_a_classifier_learns_from_labelled_blocks():
    rng = random.Random(3)
    word = lambda n: " ".join(rng.choice("one two river stone green walk far low".split()) for _ in range(n))
    def page(i):
        para = "".join(f"<div class='q7'>{word(rng.randrange(8, 40))}</div>" for _ in range(6))
        links = "".join(f"<div class='zz9'>{word(12)}</div>" for _ in range(4))
        return f"<nav>{links}</nav><article>{para}</article><aside>{links}</aside>", f"<div>{links}</div><section>{para}</section><div>{links}</div>"
    rows, pairs = [], np.zeros((2, 2))
    for i in range(60):
        found = html_text.blocks(page(i)[0])
        rows += [(html_text.label(b), *html_text.features(b)) for b in found if html_text.label(b) >= 0]
        for a, b in zip(found, found[1:], strict=False):
            pairs[int(a.section != b.section), int(html_text.label(a) != html_text.label(b))] += 1
    model = html_text.fit(rows, pairs)
    assert model.inside == html_text.INSIDE and model.across == html_text.ACROSS_RANGE[1]
    for i in range(20):  # no semantic element is left: only what was learnt tells
        plain = page(i)[1]
        want = [b.text for b in html_text.blocks(plain) if "q" in b.near]
        assert html_text.main_text(plain, model).split("\n") == want
    assert html_text.fit([], pairs) is html_text.PLAIN and html_text.fit([(1, [0], [1.0])], pairs) is html_text.PLAIN


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>";</script></head>
<body class="page"><header class="site-header"><a href="/">Home</a> <a href="/a">About us</a></header>
<nav><ul><li><a href=/x>One</a><li><a href=/y>Two</a></ul></nav>
<div class="cookie-notice">We use cookies. Please accept them all.</div>
<div id="content"><h1>A title &amp; more</h1><p>First  paragraph,\nwith <b>bold</b> and <a href="#">a link</a> in it.
<p>Second one &lt;here&gt; &eacute;&#233;. It says a little more than the first.</p>
<div class="ad">Buy now! Great offers. Click here.</div>
<ul><li>A point that the article makes.</li><li>Another point that it makes.</li></ul>
<form><input name=q><label>Your mail</label><button>Send</button></form>
<p>Last words of the article. They are kept.</p></div>
<aside class="sidebar"><p>Related stories that nobody asked for. Read them.</p></aside>
<section id="comments"><p>I think this is a great article. Thanks.</p></section>
<footer>&copy; 2024 Someone. All rights reserved.</footer></body></html>"""


def test_main_text():
    text = html_text.main_text(PAGE)
    assert text == ("A title & more\nFirst paragraph, with bold and a link in it.\nSecond one <here> éé. It says a little more than the first.\n"
                    "A point that the article makes.\nAnother point that it makes.\nLast words of the article. They are kept.")
    for page in (None, "", "<", "<!--", "<p", "</div></p>", "<script>x", "<a href='x", "&#xffffffff;", "<p>" * 3000):
        assert isinstance(html_text.main_text(page), str)
    for end in range(0, len(PAGE), 37):  # cut off anywhere
        html_text.main_text(PAGE[:end])
    assert html_text.main_text("<body><article><p>Only this line stands here.</article>") == "Only this line stands here."


def test_quality_counts_and_fit():
    texts = ["a b c a b c d # $x", "one\none\n\n two \none", None, "", "é é é é", "x " * 300]
    data, offsets = kernel.buffers(pa.array(texts))
    got = quality._judged(None, pa.array(texts))
    for r, t in enumerate(texts):
        w = WORD.findall(t or "")
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        inside = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        assert [got[k][r] for k in quality._STATS] == [
            len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)]
        assert not got["kept"][r]
    rng = random.Random(1)
    good = [" ".join(rng.choice(["river", "stone", "quiet", "walks", "green"]) for _ in range(60)) for _ in range(120)]
    bad = [" ".join(rng.choice(["BUY!!", "NOW!!", "$$$", "###"]) for _ in range(60)) for _ in range(120)]
    fold = np.arange(240) % 5 == 0
    model = quality.fit(good + bad, np.array([1] * 120 + [0] * 120), fold)
    at = [f for _, _, part in quality.measure(*kernel.buffers(pa.array(good + bad)), True) for f in part]
    assert all((quality._margin(model, *f) * model["scale"] + model["shift"] > 0) == (i < 120) for i, f in enumerate(at))
    assert quality.fit(good, np.ones(120), fold[:120]) is None


def test_language_prediction_edges():
    model = lang_id.Model([], np.zeros(0), np.zeros((8, 0)))
    assert lang_id.predict(model, ["abc", None])[0] == ["und", "und"]
    model = lang_id.Model(["x"], np.zeros(1, np.float32), np.zeros((256, 1), np.float32))
    names, score = lang_id.predict(model, [None, "", "12 !?", "a", "é" * 10000])
    assert names == ["und", "und", "und", "x", "x"] and (score <= 1).all() and (score >= 0).all()


def test_bloom_never_misses():
    rng = np.random.default_rng(2)
    words = np.zeros((50, url_filter.LANES), dtype=np.uint64)
    h = rng.integers(-2**63, 2**63 - 1, 300, dtype=np.int64)
    u = h.view(np.uint64)
    for x in u.tolist():
        for i, salt in enumerate(url_filter._SALT):
            words[(x >> 32) % 50, i] |= np.uint64(1 << ((x & 0xFFFFFFFF) * salt >> 16) % 64)
    assert url_filter.maybe_listed(words, h).all()
    assert url_filter.maybe_listed(words, rng.integers(-2**63, 2**63 - 1, 2000, dtype=np.int64)).mean() < 0.2


def test_open_head():
    head = "<!doctype html><html><head><meta charset=utf-8><title>Not this</title><style>p {}</style>\n<script>x = '<p>';</script>"
    text = "This is the text of a page whose head is left open."
    for body in (f"<body><p>{text}", f"<div><p>{text}</p></div>", f"<p>{text}", f"<br>{text}", text, f"<a name=x></a><p>{text}"):
        assert html_text.main_text(head + body) == text, body
    assert html_text.main_text(f"{head}<template><p>Not this sentence either.</p></template></head><body><p>{text}") == text
    assert html_text.main_text(head) == ""
