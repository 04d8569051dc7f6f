"""Operator 7: quality rules - a hashed word and character n-gram logistic
regression, trained on labelled rows, calibrated, scored against fixed
thresholds.

Features of a whole text: hashed words, word pairs and character trigrams (as
written, so case and punctuation count), ``log(1 + count)``, scaled to unit
length.  Training takes at most ``SAMPLE`` labelled rows, those with the
smallest hashes of their ids; the bound is the only one, and it bounds the one
task that fits the weights.  Four fifths of the sample fit the weights; the
rest fits a two-parameter logistic calibration of the margin.  Every document
is then scored whole, in Arrow batches.

Fixed thresholds: fewer than ``MIN_WORDS`` words, or more than
``MAX_REPEAT`` percent of the words in repeated three-word windows, fail the
base rules; a calibrated probability of good quality below ``MIN_QUALITY``
fails the classifier.

Edge cases: a null text has no words and fails; without labels of both kinds
there is no classifier and the base rules decide; labels without a document,
null labels and null ids are skipped; a document labelled twice counts twice;
repeated rows are judged alike; an empty table gives no rows; further columns
are ignored by ``judge`` and kept by ``keep_good``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binyard.llm import kernel
from binyard.llm.common import ship, stage

SAMPLE = 4000
BUCKETS = 1 << 14
MIN_WORDS = 50
MAX_REPEAT = 50
MIN_QUALITY = 0.5
SYMBOLS = "#*$%&|<>"

_U = np.uint64
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_HAS_WORD = re.compile(r"[^\x20\x09-\x0D]")
_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _dup_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if _HAS_WORD.search(x)]
    return len(lines) - len(set(lines))


def _sums(flag: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flag, dtype=np.int64)))
    return total[off[1:]] - total[off[:-1]]


def measure(data: np.ndarray, offsets: np.ndarray, features: bool) -> Iterator[tuple[int, dict[str, np.ndarray], list[tuple[np.ndarray, np.ndarray]]]]:
    """Pieces of a batch: (first row, base counts but the line count, features of each row)."""
    for a, b in kernel.pieces(offsets):
        n = b - a
        part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        _, _, row, h = kernel.words(part, off, lower=False)
        sh, at, pos = kernel.shingles(h, row, n, 3, whole_short=False)
        key = kernel.mix(sh + at.astype(_U) * _U(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        inside = np.zeros(len(h) + 2, dtype=bool)
        for j in range(3):
            inside[pos[twice] + j] = True
        inside = inside[: len(h)]
        start = (part & 0xC0) != 0x80
        stats = {
            "n_words": np.bincount(row, minlength=n),
            "word_chars": _sums(start & ~kernel.IS_SEP[part], off),
            "n_symbols": _sums(_SYMBOL[part], off),
            "n_repeat_words": np.bincount(row[inside], minlength=n),
        }
        yield a, stats, _features(part, off, row, h, n) if features else []


def _features(part: np.ndarray, off: np.ndarray, row: np.ndarray, h: np.ndarray, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, weights) of each row, of unit length."""
    mask = _U(BUCKETS - 1)
    pairs, pair_row, _ = kernel.shingles(h, row, n, 2, whole_short=False)
    chars = np.frombuffer(part.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n_chars = _sums((part & 0xC0) != 0x80, off)
    char_row = np.repeat(np.arange(n), n_chars)
    if len(chars) >= 3 and len(chars) == len(char_row):
        c = chars.astype(_U)
        g = (c[:-2] * _U(0x9E3779B97F4A7C15)) ^ (c[1:-1] * _U(0xC2B2AE3D27D4EB4F)) ^ (c[2:] * _U(0x165667B19E3779F9))
        g = (g * _U(0x2545F4914F6CDD1D)) >> _U(40)
        keep = char_row[:-2] == char_row[2:]
        grams, gram_row = g[keep] & mask, char_row[:-2][keep]
    else:
        grams, gram_row = np.zeros(0, _U), np.zeros(0, np.int64)
    w, p = (h >> _U(7)) & mask, (pairs >> _U(9)) & mask
    edges = np.arange(n + 1)
    cuts = [np.searchsorted(r, edges) for r in (row, pair_row, gram_row)]
    w, p, grams = w.astype(np.int64), p.astype(np.int64), grams.astype(np.int64)
    out = []
    for r in range(n):
        own = np.concatenate([x[cut[r] : cut[r + 1]] for x, cut in zip((w, p, grams), cuts, strict=True)])
        count = np.bincount(own, minlength=BUCKETS)
        at = np.flatnonzero(count)
        x = np.log1p(count[at])
        out.append((at, x / max(np.sqrt((x * x).sum()), 1e-12)))
    return out


def _margin(model: dict, at: np.ndarray, x: np.ndarray) -> float:
    return float(model["w"][at] @ x + model["b"])


def fit(texts: list[str], good: np.ndarray, fold: np.ndarray, rounds: int = 150, decay: float = 1e-5) -> dict | None:
    """Weights and calibration; ``fold`` True: calibration rows."""
    if len(set(good[~fold].tolist())) < 2:
        return None
    data, offsets = kernel.buffers(pa.array(texts, pa.string()))
    rows = [f for _, _, part in measure(data, offsets, True) for f in part]
    use = np.flatnonzero(~fold)
    at = np.concatenate([rows[i][0] for i in use])
    x = np.concatenate([rows[i][1] for i in use])
    of = np.repeat(np.arange(len(use)), [len(rows[i][0]) for i in use])
    y = good[use].astype(np.float64)
    w, b, speed, speed_b = np.zeros(BUCKETS), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), np.full(BUCKETS, 1e-8), 1e-8
    for _ in range(rounds):  # full-batch AdaGrad
        z = np.bincount(of, weights=w[at] * x, minlength=len(use)) + b
        err = 1 / (1 + np.exp(-z)) - y
        grad = np.bincount(at, weights=x * err[of], minlength=BUCKETS) / len(use) + decay * w
        speed += grad * grad
        w -= 0.7 * grad / np.sqrt(speed)
        speed_b += err.mean() ** 2
        b -= 0.2 * err.mean() / np.sqrt(speed_b)
    model = {"w": w, "b": b, "scale": 1.0, "shift": 0.0}
    held = np.flatnonzero(fold)
    if len(set(good[held].tolist())) == 2:
        m, t = np.array([_margin(model, *rows[i]) for i in held]), good[held].astype(np.float64)
        n1, n0 = t.sum(), len(t) - t.sum()
        t = np.where(t > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        s, c = 1.0, 0.0
        for _ in range(50):  # Newton steps of the two-parameter logistic fit
            p = 1 / (1 + np.exp(-(s * m + c)))
            g = np.array([((p - t) * m).sum() + 1e-3 * (s - 1), (p - t).sum()])
            v = p * (1 - p) + 1e-9
            hess = np.array([[(v * m * m).sum() + 1e-3, (v * m).sum()], [(v * m).sum(), v.sum() + 1e-6]])
            step = np.linalg.solve(hess, g)
            s, c = s - float(np.clip(step[0], -1, 1)), c - float(np.clip(step[1], -2, 2))
            if np.abs(step).max() < 1e-9:
                break
        if s > 0:
            model["scale"], model["shift"] = s, c
    return model


def _fit_task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parts = [x for x in frames if len(x)]
    if parts:
        rows = pd.concat(parts, ignore_index=True).sort_values(["h", "quality"], ignore_index=True)
        model = fit(rows["text"].tolist(), rows["quality"].to_numpy() > 0, (rows["h"] % 5 == 0).to_numpy())
        if model is not None:
            yield pd.DataFrame({"w": [model["w"].astype(np.float64).tobytes()], "b": [model["b"]], "scale": [model["scale"]], "shift": [model["shift"]]})


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict | None:
    """The model from ``labels`` (doc_id, quality 0/1) and ``docs`` (doc_id,
    text); None without both kinds of label."""
    ship(docs.sparkSession)
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marked = marked.filter("doc_id is not null and quality in (0, 1)").withColumn("h", F.xxhash64("doc_id", F.lit(7)))
    marked = stage(marked.orderBy("h", "quality").limit(sample), "labelled")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    rows = stage(texts.join(marked, "doc_id").select("h", "quality", "text"), "sample")
    # rows of a repeated id may be more than were drawn
    rows = rows.orderBy("h", "quality").limit(sample)
    got = rows.repartition(1).mapInPandas(_fit_task, "w binary, b double, scale double, shift double").collect()
    if not got:
        return None
    return {"w": np.frombuffer(got[0]["w"]), "b": got[0]["b"], "scale": got[0]["scale"], "shift": got[0]["shift"]}


def _judged(model: dict | None, texts: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = kernel.buffers(texts)
    n = len(offsets) - 1
    out = {k: np.zeros(n, dtype=np.int64) for k in _STATS}
    quality = np.ones(n)
    for a, stats, rows in measure(data, offsets, model is not None):
        for k, v in stats.items():
            out[k][a : a + len(v)] = v
        for r, (at, x) in enumerate(rows):
            quality[a + r] = 1 / (1 + np.exp(-np.clip(model["scale"] * _margin(model, at, x) + model["shift"], -50, 50)))
    out["n_dup_lines"][:] = [0 if t is None else _dup_lines(t) for t in texts.to_pylist()]
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT * out["n_words"])
    out["quality"] = quality
    out["kept"] = ~out["base_failed"] & (quality >= MIN_QUALITY)
    return out


def judge(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, the base counts, base_failed, quality (probability), kept."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    names = [*_STATS, "base_failed", "quality", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = _judged(shared.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(got[k]) for k in names]], names=["doc_id", *names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{k} long" for k in _STATS) + ", base_failed boolean, quality double, kept boolean")


def keep_good(docs: DataFrame, model: dict | None) -> DataFrame:
    """The rows of ``docs`` that are kept, where they are."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_judged(shared.value, batch.column("text"))["kept"]))

    return docs.mapInArrow(run, docs.schema)


def op7(spark, sf_dir: str) -> DataFrame:
    """Every document judged."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = judge(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return out.select("doc_id", *_STATS, "base_failed", "kept", "quality")
