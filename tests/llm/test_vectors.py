"""Operators 12 and 13 against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest

from binyard.llm import hard_negatives, vector_codes
from binyard.llm.hard_negatives import hilbert, score_bounds
from binyard.llm.vectors import LIMIT

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, label int, code string, score string, zone string, x string"


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) and abs(x) < LIMIT for x in v)


def brute_codes(rows, parts, entries, rounds):
    kept = sorted([(i is None, i or 0, v, l) for i, v, l in rows if usable(v)], key=lambda r: (r[0], r[1], r[2]))
    width = -(-len(kept[0][2]) // parts)
    x = np.array([[math.floor(256 * float(c)) for c in r[2]] + [0] * (parts * width - len(r[2])) for r in kept]).reshape(len(kept), parts, width)
    book = x[:entries].transpose(1, 0, 2).copy()
    near = lambda: np.stack([((x[:, p, None] - book[p]) ** 2).sum(2).argmin(1) for p in range(parts)], 1)
    for _ in range(rounds):
        code = near()
        for p in range(parts):
            for e in range(book.shape[1]):
                own = x[code[:, p] == e, p]
                if len(own):
                    book[p, e] = own.sum(0) // len(own)
    code = near()
    error = [sum(int(((x[n, p] - book[p, code[n, p]]) ** 2).sum()) for p in range(parts)) for n in range(len(x))]
    out = [(None if r[0] else r[1], "".join(f"{c:02x}" for c in code[n]), error[n], r[3]) for n, r in enumerate(kept)]
    return sorted(out, key=str), hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def vectors(rng, n, dim, spread=0.2, centres=None):
    out = []
    for i in range(n):
        base = rng.choice(centres) if centres else [0.0] * dim
        out.append((i, [b + rng.gauss(0, spread) for b in base], rng.randrange(4)))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "s", "z", "x") for r in rows], SCHEMA)


ODD_ROWS = [(None, [0.1] * 20, 1), (3, None, 1), (4, [0.1] * 19 + [None], 2), (5, [NAN] + [0.0] * 19, 2), (6, [INF] * 20, 1), (7, [1e30] * 20, 1),
            (8, [], 1), (9, [0.5] * 3, 1), (10, [-0.001] * 20, None), (10, [-0.001] * 20, None), (10, [0.3] * 20, 1)]


@pytest.mark.parametrize(("n", "entries", "rounds"), [(300, 64, 2), (40, 64, 3), (500, 16, 6), (1, 64, 2)])
def test_codes_are_exact(spark, n, entries, rounds):
    rng = random.Random(n)
    centres = [[rng.gauss(0, 1) for _ in range(20)] for _ in range(7)]
    rows = vectors(rng, n, 20, 0.05, centres) + (ODD_ROWS if n > 1 else [])
    got, books, width = vector_codes.compress(frame(spark, rows), 16, entries, rounds)
    want, sha = brute_codes([r for r in rows if r[1] is None or len(r[1]) in (0, 20)], 16, entries, rounds)
    assert sorted((tuple(r) for r in got.select("vec_id", "code", "error", "label").collect()), key=str) == want
    assert books.digest(width) == sha
    assert vector_codes.compress(frame(spark, rows).limit(0))[0].count() == 0


def test_bounds_save_work_and_never_decide():
    rng = np.random.default_rng(4)
    x = (rng.normal(0, 60, (3000, 2, 4)) + rng.choice([-900, 0, 900], (3000, 2, 1))).round().astype(np.int64)
    books = vector_codes.Codebooks(x[:64].transpose(1, 0, 2).copy())
    near, bounds, best = books.scan(x, 8)
    work = []
    for _ in range(6):
        code = near[..., 0]
        sums, counts = np.zeros_like(books.entries), np.zeros(books.entries.shape[:2], np.int64)
        for p in range(2):
            np.add.at(sums[p], code[:, p], x[:, p])
            counts[p] = np.bincount(code[:, p], minlength=64)
        books = books.moved_to(sums, counts)
        near, bounds, best, seen = books.update(x, near, bounds)
        every = np.stack([((x[:, p, None] - books.entries[p]) ** 2).sum(2) for p in range(2)], 1)
        assert (near[..., 0] == every.argmin(2)).all() and (best == every.min(2)).all()
        listed = np.sqrt(np.take_along_axis(every, near[..., 1:].astype(np.int64), 2))
        assert (bounds[..., :-1] <= listed).all()
        rest = every.astype(float)
        np.put_along_axis(rest, near.astype(np.int64), np.inf, 2)
        assert (bounds[..., -1] <= np.sqrt(rest.min(2))).all()
        work.append((seen["scanned"], near.shape[2] - 1))
    assert sum(n for n, _ in work[1:]) < 0.1 * 5 * 6000 and 4 <= min(b for _, b in work) <= max(b for _, b in work) <= 16


def test_op13_on_the_given_vectors(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, sha = brute_codes(rows, 16, 64, 2)
    label = {}
    for _, _, error, own in want:
        label[own] = label.get(own, 0) + error
    assert sorted((tuple(r) for r in vector_codes.op13(spark, SF).collect()), key=str) == sorted(((i, c, e, label[own], sha) for i, c, e, own in want), key=str)


# ----------------------------------------------------------- hard negatives


def test_hilbert_visits_every_cell_by_single_steps():
    for m, bits in ((2, 4), (3, 3), (4, 2), (1, 5)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * m, indexing="ij"), -1).reshape(-1, m)
        place = hilbert(cells, bits)
        assert sorted(place.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_score_bounds_hold_and_are_reached():
    rng = np.random.default_rng(1)
    a, x = rng.integers(-90, 90, (20, 6)), rng.integers(-50, 70, (300, 6))
    least, most = score_bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
    score = a @ x.T
    assert (least[:, 0] <= score.min(axis=1)).all() and (most[:, 0] >= score.max(axis=1)).all()
    least, most = score_bounds(a, x[:1], x[:1])
    assert (least == score[:, :1]).all() and (most == score[:, :1]).all()


def brute_mine(rows, every=50):
    kept = [(i, [math.floor(256 * float(c)) for c in v], l) for i, v, l in rows if i is not None and l is not None and usable(v)]
    ids, x, label = np.array([r[0] for r in kept]), np.array([r[1] for r in kept], dtype=np.int64), np.array([r[2] for r in kept])
    out = []
    for a in np.flatnonzero(ids % every == 0):
        score = x @ x[a]
        order = np.lexsort((ids, -score))
        for p in [j for j in order if label[j] == label[a] and j != a][:5]:
            fit = [j for j in order if label[j] != label[a] and 50 * score[p] <= 100 * score[j] <= 95 * score[p]]
            out += [(int(ids[a]), int(ids[p]), n + 1, int(ids[j]), int(score[p]), int(score[j])) for n, j in enumerate(fit[:3])]
    return sorted(out)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 16)
    monkeypatch.setattr(hard_negatives, "ZONE_ROWS", 48)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 20)
    monkeypatch.setattr(hard_negatives, "FAN", 2)


def test_mining_is_exact(spark, small):
    rng = random.Random(9)
    centres = [[rng.gauss(0, 0.5) for _ in range(12)] for _ in range(6)]
    rows = vectors(rng, 700, 12, 0.1, centres)
    rows += [(i, v, l) for i, v, l in rows[100:160:50]] + [(900, rows[50][1], 1), (950, [0.0] * 12, 2), (951, [-x for x in rows[50][1]], 2)]
    rows += [(1000 + i, [0.25] * 12, 1 + i % 2) for i in range(60)]  # one very common vector
    odd = [(i, [x] * 12 if v is not None and len(v) == 20 and (x := v[0]) is not None else v, l) for i, v, l in ODD_ROWS]
    want = brute_mine([r for r in rows + odd if r[1] is not None and len(r[1]) == 12])
    got = hard_negatives.mine(frame(spark, rows + odd))
    assert sorted(tuple(r) for r in got.collect()) == want
    assert hard_negatives.mine(frame(spark, rows).limit(0)).count() == 0
    assert hard_negatives.mine(frame(spark, [(1, [0.5] * 12, 1)])).count() == 0


def test_zone_maps_prune(spark, small):
    rng = random.Random(2)
    centres = [[rng.gauss(0, 3) for _ in range(4)] for _ in range(12)]
    rows = [(i, v, i % 3) for i, v, _ in vectors(rng, 900, 4, 0.02, centres)]
    df = frame(spark, rows).selectExpr("vec_id", "cast(label as long) label", "embedding")
    blocks, _, _ = hard_negatives.write_blocks(df, 4)
    zones = sorted(r.zone for r in blocks.select("zone").distinct().collect())
    at = rows[50]
    x = np.array([[math.floor(256 * c) for c in at[1]]])
    top = int((x @ x.T)[0, 0])
    chunk = hard_negatives.Chunk(np.array([-1]), np.array([at[2]]), x, np.array([[top // 2]]), np.array([[top * 95 // 100]]), np.array([[top * 9 // 10]]), False, 3)
    need = hard_negatives.needed_zones(blocks, spark.sparkContext.broadcast(chunk), 4)
    q = {i: np.array([math.floor(256 * c) for c in v]) for i, v, _ in rows}
    holds = {r.zone for r in blocks.collect() for i in np.frombuffer(r.ids, np.int64)
             if rows[i][2] != at[2] and top * 9 // 10 <= int(x[0] @ q[i]) <= top * 95 // 100}
    assert holds <= set(need) and len(need) < len(zones) / 2
    assert hard_negatives._passes(list(range(40))) and sorted(z for p in hard_negatives._passes(list(range(40))) for z in p) == list(range(40))


def test_op12_on_the_given_vectors(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in hard_negatives.op12(spark, SF).collect()) == brute_mine(rows)
