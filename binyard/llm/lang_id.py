"""Operator 5: language identification, multinomial naive Bayes over hashed
character n-grams.

Training counts n-grams of 1 to 3 characters (``str.lower`` applied, white
space runs as one space) per language and hash bucket in every task and sums
them with map-side partial aggregation; all training texts count, whole.  The
log-probability matrix (languages x buckets, float32) is broadcast: the bucket
count is chosen so that it never exceeds ``MATRIX_BYTES``.  Scoring sums the
matrix rows of a text's n-grams in numpy, batch by batch.

The score is the posterior of the winning language, after dividing the
log-likelihoods by the square root of the number of n-grams (n-grams of one
text are far from independent; undivided, every long text would score 1).

Edge cases: a null text or one without a letter gives ``und`` with score 0; so
does every text when nothing was learnt; a null id is neither held out nor
learnt from; ties go to the language first in code point order; repeated rows
are repeated evidence; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binyard.llm.common import crc_mod, ship, stage

ORDER = 3
BUCKETS = 1 << 15
MATRIX_BYTES = 32 << 20
ALPHA = 0.5

_SPACE = re.compile(r"\s+")
_U = np.uint32
_PIECE = 1 << 19


def _grams(texts: list[str], buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bucket, row) of the n-grams of pieces of the texts."""
    mask = _U(buckets - 1)
    a = 0
    while a < len(texts):
        b, size = a, 0
        while b < len(texts) and (b == a or size + len(texts[b]) <= _PIECE):
            size += len(texts[b])
            b += 1
        part = [_SPACE.sub(" ", t.lower()) for t in texts[a:b]]
        lens = np.array([len(t) for t in part])
        c = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), dtype=_U)
        row = np.repeat(np.arange(b - a, dtype=np.int32), lens)
        found, rows = [], []
        h = np.zeros(len(c), dtype=_U)
        for n in range(ORDER):
            m = len(c) - n
            if m <= 0:
                break
            h = h[:m] * _U(0x01000193) ^ (c[n:] * _U(0x9E3779B1))
            x = h ^ _U((n + 1) * 0x3C6EF372)
            x = x * _U(0x85EBCA6B)
            x ^= x >> _U(15)
            keep = row[:m] == row[n:]
            found.append((x & mask)[keep])
            rows.append(row[:m][keep])
        if found:
            yield a, b - a, np.concatenate(found), np.concatenate(rows)
        a = b


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            texts = batch.column("text").to_pylist()
            langs = batch.column("lang").to_pylist()
            for lang in set(langs):
                sums = total.setdefault(lang, np.zeros(buckets, dtype=np.int64))
                own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
                for _, _, bucket, _ in _grams(own, buckets):
                    sums += np.bincount(bucket, minlength=buckets)
        for lang, sums in total.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(sums[at])],
                                             names=["lang", "bucket", "n"])
    return run


class Model:
    """Languages in code point order, log priors, log probabilities."""

    def __init__(self, langs: list[str], prior: np.ndarray, matrix: np.ndarray) -> None:
        self.langs, self.prior, self.matrix = langs, prior, matrix


def train(labelled: DataFrame, buckets: int = BUCKETS) -> Model:
    """Learn from all rows of (text, lang); rows without either are skipped."""
    ship(labelled.sparkSession)
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(
        "text is not null and lang is not null")
    priors = rows.groupBy("lang").agg(F.count("*").alias("n"))
    # one row a language; the matrix bound holds for any number of them
    known = sorted((r["lang"], r["n"]) for r in priors.collect())
    while buckets > 256 and buckets * len(known) * 4 > MATRIX_BYTES:
        buckets //= 2
    if len(known) * buckets * 4 > MATRIX_BYTES:
        raise ValueError("more languages than the matrix bound allows")
    langs = [x for x, _ in known]
    counts = np.full((len(langs), buckets), ALPHA)
    place = {x: i for i, x in enumerate(langs)}
    sums = stage(rows.mapInArrow(_count(buckets), "lang string, bucket int, n long")
                 .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "ngrams")
    packed = sums.groupBy("lang").agg(F.collect_list("bucket").alias("bucket"), F.collect_list("n").alias("n"))
    for r in packed.toLocalIterator():
        counts[place[r["lang"]], r["bucket"]] += np.array(r["n"], dtype=np.float64)
    matrix = np.log(counts) - np.log(counts.sum(axis=1, keepdims=True))
    prior = np.log(np.array([n for _, n in known], dtype=np.float64) / max(sum(n for _, n in known), 1)) if known else np.zeros(0)
    return Model(langs, prior.astype(np.float32), np.ascontiguousarray(matrix.T.astype(np.float32)))


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text."""
    names, score = ["und"] * len(texts), np.zeros(len(texts))
    if not model.langs:
        return names, score
    use = [i for i, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))]  # numerals such as '½' are no letters
    own = [texts[i] for i in use]
    for a, n, bucket, row in _grams(own, len(model.matrix)):
        # a column at a time keeps the working set at one float per n-gram
        like = np.stack([np.bincount(row, weights=model.matrix[bucket, j], minlength=n) for j in range(len(model.langs))], axis=1)
        count = np.maximum(np.bincount(row, minlength=n), 1)
        like += model.prior
        best = like.argmax(axis=1)
        rel = (like - like.max(axis=1, keepdims=True)) / np.sqrt(count)[:, None]
        top = 1.0 / np.exp(rel).sum(axis=1)
        for r in range(n):
            names[use[a + r]] = model.langs[best[r]]
            score[use[a + r]] = top[r]
    return names, score


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast((model.langs, model.prior, model.matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            names, score = predict(own, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score)],
                                             names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def op5(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.filter(crc_mod(F.col("doc_id"), 5) != 0).select("text", "lang"))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
