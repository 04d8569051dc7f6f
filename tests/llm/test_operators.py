"""The operators in Spark: brute force, round trips, edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from binyard.llm import chat_format, decontaminate, html_text, lang_id, line_dedup, lm_score, mixing, near_dedup, quality, queries, url_filter
from binyard.llm.common import components, merged
from tests.compare import compare

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, copies string"
EDGE = [(1, None, None, None, None, "x"), (2, "", "en", "a", 0, None), (3, " \n\t", "en", "a", 3, None), (4, "one two", "en", "b", 7, None),
        (4, "one two", "en", "b", 7, None), (None, "no id here at all", None, "b", None, None), (5, "w " * 30000, "en", "a", 60000, None),
        (6, "12 34 !?", "de", None, 8, None)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def brute_components(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").lower())
        sets[i] = frozenset(zip(*[w[j:] for j in range(k)], strict=False)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    up = {i: i for i in sets}
    def top(a):
        while up[a] != a:
            a = up[a]
        return a
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = top(a), top(b)
                    up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


def test_near_dedup_in_a_dense_group(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    base = [rng.choice(words) for _ in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6])):
            w[rng.randrange(120)] = rng.choice(words)
        rows.append((i * 7 % 150, " ".join(w)))
    rows += [(1000 + i, t) for i, t in rows[:20]] + [(2000, None), (2001, ""), (2003, "one two"), (2004, "One  two"), (2005, "one")]
    want = brute_components(rows, 3, 85)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_classes(df, 3, 85).collect()}
    assert got == want


def test_components_after_further_links(spark):
    rng = random.Random(3)
    links = [tuple(sorted(rng.sample(range(60), 2))) for _ in range(45)]
    frame = lambda x: spark.createDataFrame(x, "lo long, hi long")
    want = {tuple(r) for r in components(frame(links)).collect()}
    got = merged(components(frame(links[:20])), frame(links[20:])).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_near_dedup_edges(spark, edge, empty):
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_classes(edge, 3, 85).collect())
    assert got == [(0, 3, None, False), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (4, 1, 4, True), (5, 1, 5, True), (6, 1, 6, True)]
    kept = near_dedup.near_dedup(edge, 3, 85)
    assert kept.columns == edge.columns and kept.count() == len(EDGE) - 1  # the repeated row once
    assert near_dedup.near_dedup(empty).count() == 0
    assert near_dedup.near_classes(empty).count() == 0


def test_near_dedup_decides_by_row(spark):
    """Repeated ids with unlike texts, copies under a null id, clashing names."""
    a, b, c, q, r = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcqr")
    near_c = c.replace("c29", "other")
    rows = [(1, a, "x"), (1, b, "x"), (2, c, "x"), (3, a, "x"), (5, q, "x"), (4, q, "x"), (5, r, "x"), (None, "null " + b, "x"), (None, "null " + b, "x"),
            (None, near_c, "x"), (7, None, "x"), (7, None, "y"), (8, "", "x"), (9, r, "y"), (5, r, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, doc string").selectExpr("*", "doc AS text_hash", "1 AS rows", "0 AS first", "doc AS h1", "map(1, 2) AS m")
    kept = near_dedup.near_dedup(df, 5, 80)
    assert kept.columns == df.columns
    got = sorted((x.doc_id or 0, x.text) for x in kept.collect() if x.text)
    assert got == sorted([(1, a), (1, b), (2, c), (4, q), (5, r)])  # "null b" is b but for one word, near_c is c
    assert sum(not x.text for x in kept.collect()) == 3
    # against brute force, with components named by row
    rng = random.Random(6)
    texts = [" ".join(rng.choice("uvwxyz") + str(rng.randrange(50)) for _ in range(40)) for _ in range(25)]
    texts += [t + f" more{i}" for i, t in enumerate(texts[:12])] + texts[:8]
    rows = [(rng.choice([None, 1, 2, 3, 4, 5]), t, str(i)) for i, t in enumerate(texts)]
    want = brute_components(list(enumerate(t for _, t, _ in rows)), 5, 80)
    groups = defaultdict(list)
    for i, (_, top) in want.items():
        groups[top].append(rows[i])
    out = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string, place string"), 5, 80).collect()
    assert len(out) == len(groups)
    for own in groups.values():
        assert sum(tuple(x) in own for x in out) == 1
        top = min((x[0] is None, x[0] or 0) for x in own)
        assert all((x.doc_id is None, x.doc_id or 0) == top for x in out if tuple(x) in own)


def test_clashing_names_and_odd_ids(spark):
    names = "_cut _removed _doc _hash removed doc text_hash places copies mix_source mix_passes mix_cut _mix_source _mix_passes source_size Doc_ hash size".split()
    line = "a passage of some twenty words that a handful of sites hold and that goes"
    rows = [(i, f"own text {i}\n{line}", f"s{i % 6}") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", *[f"'{n}' AS `{n}`" for n in names])
    out = line_dedup.clean(df)
    assert out.columns == df.columns and sorted(r.text for r in out.collect()) == sorted([rows[0][1], *(f"own text {i}" for i in range(1, 12))])
    assert all(r[n] == n for r in out.collect() for n in names)
    mixed = mixing.mix_documents(df)
    assert mixed.columns == [*df.columns, "copies_"] and all(r[n] == n for r in mixed.collect() for n in names)
    # item ids beyond what doubles hold, beside a null one
    big = 9007199254740993
    items = spark.createDataFrame([(big, "own text 3"), (None, "own text 4"), (big + 2, "own text 5")], "item_id long, text string")
    docs = spark.createDataFrame([(3, "own text 3"), (4, "own text 4"), (5, "own text 5")], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.find(docs, items).collect()) == [(3, big), (4, None), (5, big + 2)]


def test_targets_of_many_sources(spark):
    rows = [(f"s{i:05d}" if i else None, 100 + i) for i in range(3000)]
    frame = spark.createDataFrame(rows, "source string, source_size long").repartition(7)
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    order = sorted((s for s, _ in rows), key=lambda s: (s is None, s))
    size, weight = dict(rows), {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, budget = set(), 1.5 * sum(size.values())
    while True:
        level = (budget - sum(2 * size[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and weight[s] * level > 2 * size[s]}
        if not more:
            break
        full |= more
    assert all(math.isclose(got[s], 2 * size[s] if s in full else weight[s] * level, rel_tol=1e-9) for s in order)


def test_mix_of_rows_without_an_id(spark):
    rng = random.Random(1)
    rows = [(None, " ".join(rng.choice("abcdefgh") for _ in range(100)) + f" {i}", "only") for i in range(200)] + [(i, "x " * 100, "other") for i in range(100)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for source in ("only", "other"):
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 101
        assert 0 < len({r.copies for r in own}) and all(r.taken <= 2 * r.size for r in own)


def test_lm_scores(spark, edge, empty):
    docs = documents(spark)
    rows = {r.doc_id: r for r in lm_score.op2(spark, SF).collect()}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {r.doc_id: [*WORD.findall((r.text or "").translate(lower)), None] for r in docs.select("doc_id", "text").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    count, pair, starts = Counter(), Counter(), 0
    for i, x in tokens.items():
        if not held[i]:
            count.update(x)
            pair.update(zip(["<s>", *x], x, strict=False))
            starts += 1
    n, v = sum(count.values()), len(count)
    follows, by = Counter(), defaultdict(Counter)
    for (a, _), c in pair.items():
        follows[a] += c
        by[a][min(c, 3)] += 1
    from binyard.llm.ngram_trie import discounts
    import numpy as np
    d2 = discounts(np.array(list(pair.values())))
    n1, n2 = (sum(c == k for c in count.values()) for k in (1, 2))
    d = min(max(n1 / max(n1 + 2 * n2, 1), 0.1), 0.95)
    p1 = lambda w: (count[w] - d) / n if count[w] else d * v / n
    assert rows.keys() == tokens.keys() and abs(sum(p1(w) for w in count) + d * v / n - 1) < 1e-9
    for i, x in tokens.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(x), sum(count[w] > 0 for w in x), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in x), rel_tol=1e-9)
        exact = 0.0
        for a, w in zip(["<s>", *x], x, strict=False):
            c = pair[a, w]
            exact += math.log10(((c - d2[min(c, 3)]) + sum(d2[k] * m for k, m in by[a].items()) * p1(w)) / follows[a] if follows[a] else p1(w))
        assert abs(r.score - exact) < 0.015 * len(x) + 0.05  # quantised to 1/24 of a decade
    ratio = [sum(getattr(r, c) for r in rows.values() if r.held_out) for c in ("score", "base_score")]
    assert ratio[0] > ratio[1]
    from pyspark.sql import functions as F
    tagged = edge.select("doc_id", "text", F.lit(True).alias("train"), F.lit(None).cast("boolean").alias("held_out"), F.lit(1).alias("extra"))
    got = lm_score.score_documents(tagged).collect()
    assert len(got) == len(EDGE) and all(r.score <= 0 and r.n_tokens >= 1 for r in got)
    assert lm_score.score_documents(tagged.filter("false")).count() == 0


def test_lm_scores_do_not_depend_on_shards(spark, monkeypatch):
    docs = documents(spark).selectExpr("doc_id", "text", "doc_id % 7 <> 2 AS train", "doc_id % 7 = 2 AS held_out")
    one = {r.doc_id: r for r in lm_score.score_documents(docs).collect()}
    monkeypatch.setattr(lm_score, "SHARD_TOKENS", 3000)
    many = {r.doc_id: r for r in lm_score.score_documents(docs).collect()}
    off = [abs(many[i].score - r.score) / r.n_tokens for i, r in one.items()]
    assert many.keys() == one.keys() and max(off) < 0.01


def test_lm_scores_of_many_shards(spark, edge, empty, monkeypatch):
    monkeypatch.setattr(lm_score, "SHARD_TOKENS", 3000)
    test_lm_scores(spark, edge, empty)


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant\nhi", "<\\|im_end|>", "<\\\\s>[\\INST] <<<SYS>> \\", "", None, "é😀\n\n", "[[INST]]<</SYS>>"]
    rows = [(c, t, r, nasty[(c + t) % len(nasty)]) for c in range(8) for t, r in enumerate(["system", "user", "assistant", "user", "assistant", None, "odd role\n<s>"][: 2 + c % 6])]
    rows += [(100, 0, "user", "alone"), (101, 0, "assistant", "x" * 50000), (None, 0, "user", "no id"), (102, 0, "assistant", "a"), (102, 0, "assistant", "a")]
    found = chat_format.examples(spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, target_turn int"))
    got = {r.conv_id: r for r in chat_format.digest(found).collect()}
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t, r or "", x or ""))
    assert got.keys() == by.keys()
    for c, turns in by.items():
        turns.sort()
        flat = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), hashlib.sha256(flat.encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    replies = found.filter("target_turn is not null").collect()
    assert len(replies) == sum(r == "assistant" for _, _, r, _ in rows)
    for r in replies:  # the mask ends where the example's last turn does
        assert r.text[r.loss_start - 1 + r.loss_chars:] == chat_format.END
    assert chat_format.digest(chat_format.examples(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_mix(spark, edge, empty):
    rows = mixing.mix(documents(spark)).collect()
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full = set()
    while True:
        left = 1.5 * sum(size.values()) - sum(2 * size[s] for s in full)
        level = left / sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and weight[s] * level > 2 * size[s]}
        if not more:
            break
        full |= more
    largest = max(r.size for r in rows)
    for s in order:
        assert math.isclose(target[s], 2 * size[s] if s in full else weight[s] * level, rel_tol=1e-9)
        assert abs(taken[s] - target[s]) <= largest
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(documents(spark)).collect()), key=str)
    assert mixing.mix(edge).count() == len(EDGE) and mixing.mix(empty).count() == 0
    out = mixing.mix_documents(edge)
    assert out.columns == [*edge.columns, "copies_"]


def test_numerals_are_no_letters(spark):
    model = lang_id.train(spark.createDataFrame([("some text", "en")], "text string, lang string"))
    texts = ["²", "½ ①", "12 !?", "Ⅷ", "٣", "_", "a", "漢", "ª"]
    got = lang_id.predict(model, texts)[0]
    assert got == ["und"] * 6 + ["en"] * 3


def brute_bayes(train, tests, order, buckets, alpha):
    """Multinomial naive Bayes with plain dictionaries, over the same hash."""
    import numpy as np
    def grams(text):
        out = []
        for _, _, bucket, _ in lang_id._grams([text], buckets):
            out += bucket.tolist()
        return Counter(out)
    counts, docs = defaultdict(Counter), Counter()
    for text, lang in train:
        counts[lang] += grams(text)
        docs[lang] += 1
    out = []
    for text in tests:
        g = grams(text)
        like = {x: math.log(docs[x] / sum(docs.values())) + sum(n * math.log((counts[x][b] + alpha) / (sum(counts[x].values()) + alpha * buckets)) for b, n in g.items())
                for x in docs}
        best = min(docs, key=lambda x: (-like[x], x))
        rel = [math.exp((v - like[best]) / math.sqrt(sum(g.values()))) for v in like.values()]
        out.append((best, 1 / sum(rel)))
    return out


def test_language_id_is_naive_bayes(spark):
    docs = documents(spark).filter("text is not null and lang is not null").limit(120).collect()
    train, tests = [(r.text, r.lang) for r in docs[:60]], [r.text for r in docs[60:] if any(map(str.isalpha, r.text))]
    model = lang_id.train(spark.createDataFrame(train, "text string, lang string"), 1 << 12)
    names, score = lang_id.predict(model, tests)
    want = brute_bayes(train, tests, lang_id.ORDER, 1 << 12, lang_id.ALPHA)
    assert names == [x for x, _ in want]
    assert all(abs(a - b) < 1e-3 for a, (_, b) in zip(score, want, strict=True))


def test_language_id(spark, edge, empty):
    lang = {r.doc_id: r.lang for r in documents(spark).collect()}
    rows = lang_id.op5(spark, SF).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and sum(r.lang_pred == lang[r.doc_id] for r in held) > 0.95 * len(held)
    model = lang_id.train(edge.select("text", "lang"))
    got = {r.doc_id: r for r in lang_id.identify(edge, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 6)] == ["und"] * 4 and got[5].lang_pred == "en"
    assert lang_id.identify(edge, lang_id.train(empty)).filter("lang_pred <> 'und'").count() == 0


def test_quality_keeps_good(spark, edge, empty):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in quality.op7(spark, SF).collect() if r.doc_id in labels and not r.base_failed]
    assert sum(r.kept == (labels[r.doc_id] == 1) for r in rows) > 0.95 * len(rows)
    assert quality.train(edge, spark.createDataFrame([], "doc_id long, quality int, toxic int")) is None
    kept = quality.keep_good(edge, None)
    assert kept.columns == edge.columns and kept.count() == 0  # all are short or repeat themselves
    assert quality.judge(empty, None).count() == 0


def test_quality_on_rows_it_did_not_learn_from(spark):
    docs, labels = documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels.filter("doc_id % 4 <> 0"))
    held = {r.doc_id: r.quality for r in labels.filter("doc_id % 4 = 0").collect()}
    rows = [r for r in quality.judge(docs, model).collect() if r.doc_id in held and not r.base_failed]
    assert len(rows) > 10 and sum(r.kept == (held[r.doc_id] == 1) for r in rows) >= 0.95 * len(rows)


def test_quality_and_mix_stages(spark):
    """Stages 1 and 5 of the pipeline against plain Python."""
    import corpus_pipeline
    docs = documents(spark)
    texts = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id: r for r in corpus_pipeline.quality_rules(spark, docs, SF).collect()}
    assert all(r == texts[i] for i, r in kept.items())
    verdict = {r.doc_id: r.kept for r in quality.op7(spark, SF).collect()}
    for i, r in texts.items():
        w = WORD.findall(r.text or "")
        grams = Counter(zip(w, w[1:], w[2:], strict=False))
        again = {j + k for j in range(len(w) - 2) if grams[w[j], w[j + 1], w[j + 2]] > 1 for k in range(3)}
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        assert (i in kept) == verdict[i] and not (failed and i in kept)
    settled = [i for i in labels if len(WORD.findall(texts[i].text or "")) >= 50 and verdict[i] is not None]
    assert sum((i in kept) == (labels[i] == 1) for i in settled) > 0.9 * len(settled)
    mixed = corpus_pipeline.source_mix(spark, docs, SF).collect()
    plan = {r.doc_id: r for r in mixing.op4(spark, SF).collect()}
    assert {r.doc_id: r.copies * plan[r.doc_id].size for r in mixed if plan[r.doc_id].size} == {i: r.taken for i, r in plan.items() if r.taken}
    assert all(r.text == texts[r.doc_id].text and 1 <= r.copies <= 2 for r in mixed)


def test_pages(spark):
    rows = html_text.extract(spark.createDataFrame([(1, None, None, 1), (1, "u", "", 1), (None, "u", "<p>Some text stands here.", 1)], "page_id long, url string, html string, text int")).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in rows) == [(0, "Some text stands here.", 22), (1, "", 0), (1, "", 0)]


def test_pages_against_their_articles(spark):
    """The given pages mark their article: all of its text, and no other."""
    import html as references
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in html_text.op8(spark, SF).collect()}
    squeeze = lambda x: "".join(references.unescape(x).split())
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)(?:</article>|$)", r.html or "", re.S)
        want = re.sub(r"<!--.*?-->|<(script|style|form|aside|nav|button|div)\b.*?</\1>|<[^>]*>", " ", inside[1], flags=re.S) if inside else ""
        assert squeeze(got[r.page_id]) == squeeze(want), r.page_id
    assert html_text.train(pages.filter("false")) is html_text.PLAIN


def test_decontaminate(spark, edge, empty):
    items = spark.createDataFrame([(1, "one two", 0), (2, None, 0), (3, "", 0), (4, "never seen in here at all", 0)], "item_id long, text string, doc_id int")
    assert [(r.doc_id, r.item_id) for r in decontaminate.find(edge, items).collect()] == [(4, 1), (4, 1)]
    kept = decontaminate.clean(edge, items)
    assert kept.columns == edge.columns and kept.count() == len(EDGE) - 2
    assert decontaminate.find(empty, items).count() == 0 and decontaminate.find(edge, items.filter("false")).count() == 0


def test_line_dedup(spark, empty):
    line = "the same line on many sites"
    rows = [(i, f"own text of number {i}\n {line}\nshort one", "en", None if i == 0 else f"s{i}", 1, None) for i in range(11)] + [
        (20, line, "en", "s1", 1, None), (21, None, "en", "s1", None, None), (22, "nine sites have this\nx", "en", "s2", 1, None)]
    rows += [(30 + i, "nine sites have this\nbut nothing else", "en", f"s{i}", 1, None) for i in range(3, 11)]
    out = {r.doc_id: r for r in line_dedup.clean(spark.createDataFrame(rows, DOCS)).collect()}
    assert out[0].text == rows[0][1] and out[3].text == "own text of number 3\nshort one" and out[3].n_chars == len(out[3].text)
    assert 20 not in out and out[21].text is None and out[22].text == rows[13][1] and out[33].text.startswith("nine")
    assert line_dedup.clean(empty).count() == 0


def test_line_dedup_by_length(spark):
    passage = "a passage of some twenty words that a handful of sites hold " * 2
    hot = "one site alone repeats this passage of more than ten words in all its documents"
    rows = [(i, f"own text {i}\n{passage}", "en", f"s{i % 4}", 1, None) for i in range(5)]
    rows += [(100 + i, f"{hot}\n{passage if i == 7 else 'own'}", "en", "hot", 1, None) for i in range(60)]
    rows += [(200 + i, f"five words on eight sites\nfive words on seven sites{' x' * (i == 7)}\nown {i}", "en", f"t{i}", 1, None) for i in range(8)]
    rows += [(300 + i, "ten words that are found on no more than three\nz", "en", f"u{i % 3}", 1, None) for i in range(9)]
    out = {r.doc_id: r.text for r in line_dedup.clean(spark.createDataFrame(rows, DOCS)).collect()}
    assert out[0] == rows[0][1] and [out[i] for i in range(1, 5)] == [f"own text {i}" for i in range(1, 5)]
    assert out[107] == hot and all(out[100 + i].startswith(hot) for i in range(60))
    assert out[200] == rows[65][1] and out[203] == "five words on seven sites\nown 3"
    assert all(out[300 + i] == rows[73 + i][1] for i in range(9))


def test_line_dedup_of_short_lines(spark):
    short = ("All rights reserved.", "Two words", "One")
    for n in (11, 12, 13, 14, 15, 16):
        rows = [(i, "\n".join((f"own text {i}", " \t", *short)), "en", f"s{i % n}", 1, None) for i in range(n + 1)]
        out = {r.doc_id: r.text for r in line_dedup.clean(spark.createDataFrame(rows, DOCS)).collect()}
        left = [x for x, need in zip(short, (12, 14, 16), strict=True) if n < need]
        assert out[0] == rows[0][1] and all(out[i] == "\n".join((f"own text {i}", " \t", *left)) for i in range(1, n + 1))


def test_line_spread_stage(spark):
    import corpus_pipeline
    docs = documents(spark).select("doc_id", "source", "text", "n_chars")
    rows, sites, words = docs.collect(), defaultdict(set), {}
    for r in rows:
        for x in (r.text or "").split("\n"):
            line = x.strip(" \t\n\x0b\x0c\r")
            sites[line].add(r.source)
            words[line] = len(WORD.findall(x))
    need = dict(zip(range(4, 10), (10, 8, 7, 6, 5, 5), strict=True))
    gone = {x for x, n in words.items() if n >= 4 and len(sites[x]) >= need.get(n, 4)}
    keeper, want = {}, {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        lines = [(x, x.strip(" \t\n\x0b\x0c\r")) for x in (r.text or "").split("\n")]
        kept = [x for x, y in lines if y not in gone or keeper.setdefault(y, r.doc_id) == r.doc_id]
        if len(kept) == len(lines) or WORD.search("\n".join(kept)):
            want[r.doc_id] = r.text if len(kept) == len(lines) else "\n".join(kept)
    assert {r.doc_id: r.text for r in corpus_pipeline.line_spread(spark, docs, SF).collect()} == want


def test_url_rules(spark):
    urls = [None, "no host", "HTTP://WWW.Example.ORG/es/1?q#f", "https://example.org/en/12", "http://a.com/de/x", "http://com/fr/", "http://xcom/fr/", "http://h.net/a/?utm_source=f", "https://m.h.net:80/a#x", "://", "http://h.net/b"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, url_filter.syndicated(pages)).collect()}
    assert got[0] == got[1] == got[9] == ("", "", None, "allow")
    assert got[2] == ("www.example.org", "/es/1", "example.org/es/", "block") and got[3][2:] == ("example.org/en/1", "block")
    assert got[4][2:] == ("com/de/", "block") and got[5][2:] == ("com/fr/", "allow") and got[6][2:] == (None, "allow")
    assert got[7][2:] == got[8][2:] == (None, "block") and got[10][2:] == (None, "allow")
    assert url_filter.judge(pages.filter("false"), url_filter.syndicated(pages)).count() == 0


def test_oracles(spark):
    import duckdb
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    for name, sql in queries.oracle_sql().items():
        assert not compare(queries.queries()[name](spark, SF), con, sql), name


def test_pipeline(spark):
    import corpus_pipeline
    docs = documents(spark)
    step = lambda i, d: corpus_pipeline.STAGES[i][1](spark, d, SF)
    import os
    from binyard.llm.common import shared_dir
    before = set(os.listdir(shared_dir(spark).removeprefix("file://")))
    out = corpus_pipeline.run(spark, SF)
    left = set(os.listdir(shared_dir(spark).removeprefix("file://"))) - before
    assert len(left) == 1 and os.listdir(os.path.join(shared_dir(spark).removeprefix("file://"), left.pop())) == ["source_mix"]
    assert out.columns == [*docs.columns, "copies"] and 0 < out.count() < docs.count()
    near = step(2, docs)
    want = brute_components([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 5, 80)
    assert sorted(r.doc_id for r in near.select("doc_id").collect()) == sorted(i for i, (_, c) in want.items() if i == c)
    found = {r.doc_id for r in decontaminate.op6(spark, SF).collect()}
    assert {r.doc_id for r in step(3, docs).select("doc_id").collect()} == {i for i in want if i not in found}
