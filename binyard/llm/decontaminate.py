"""Operator 6: benchmark decontamination by size-partitioned MinHash containment
search.

Items are partitioned by the size of their shingle set.  For a partition of
items of up to ``0.8 * step`` shingles, documents are seen as windows of two
steps, each step a run of ``step`` shingles: an item's passage lies inside one
window, and because window and item have like sizes, containment 0.8 means a
Jaccard similarity of 0.15 or more, however long the document is.  Item and
window sketches are one-permutation MinHashes of ``REGISTERS`` registers (the
top bits of a shingle's hash choose the register, which keeps the minimum);
one equal register makes a candidate.  The steps of one partition are pairs of
steps of the one before, so all sketches of a document cost little more than
the first.  Items of at most ``TINY`` shingles are searched with windows of a
single shingle, which misses nothing.

Candidates are verified at once on the document's full shingle set: shared
shingles / item shingles >= the threshold.

Items are broadcast in blocks of at most ``BLOCK_BYTES`` of text (one larger
item makes a block), each searched in all documents, so the benchmark may be
of any size; the documents are not shuffled.

Edge cases: null and blank texts, of documents or items, match nothing; an
item of fewer than k words matches a document that consists of the same
words; repeated documents and items give a row for each pair of rows; null
ids are returned as they are; an empty table on either side gives no rows;
further columns are ignored by ``find`` and kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binyard.llm import kernel
from binyard.llm.common import ship, stage

K = 5
THRESHOLD = 0.8
REGISTERS = 128
FIRST_STEP = 16
TINY = 6
BLOCK_BYTES = 4 << 20

_U = np.uint64
_SHIFT = _U(64 - (REGISTERS.bit_length() - 1))
_NONE = _U(0xFFFFFFFFFFFFFFFF)
_MAP_BITS = 20


class Index:
    """Sketches and shingle sets of a block of items."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sets = sets
        entries: dict[int, list[tuple[np.ndarray, int]]] = {}
        for i, x in enumerate(sets):
            if not len(x):
                continue
            if len(x) <= TINY:
                entries.setdefault(-1, []).append((x, i))
                continue
            level = 0
            while len(x) > 0.8 * (FIRST_STEP << level):
                level += 1
            bucket = x >> _SHIFT  # sorted, so a register's minimum comes first
            entries.setdefault(level, []).append((x[np.concatenate(([True], bucket[1:] != bucket[:-1]))], i))
        self.parts = {}
        for level, found in entries.items():
            value = np.concatenate([v for v, _ in found])
            item = np.concatenate([np.full(len(v), i) for v, i in found])
            order = np.argsort(value, kind="stable")
            seen = np.zeros(1 << _MAP_BITS, dtype=bool)
            seen[(value & _U((1 << _MAP_BITS) - 1)).astype(np.int64)] = True
            self.parts[level] = (value[order], item[order], seen)

    def items_with(self, level: int, values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, item) for every item register equal to one of the values."""
        value, item, _ = self.parts[level]
        a, b = np.searchsorted(value, values, "left"), np.searchsorted(value, values, "right")
        n = b - a
        at = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(rows, n), item[at]

    def may_have(self, level: int, values: np.ndarray) -> np.ndarray:
        return self.parts[level][2][(values & _U((1 << _MAP_BITS) - 1)).astype(np.int64)]


def candidates(index: Index, sh: np.ndarray, at: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, item) whose sketches meet, for shingles in row order."""
    rows, items = [], []
    if -1 in index.parts and len(sh):
        hit = np.flatnonzero(index.may_have(-1, sh))
        r, i = index.items_with(-1, sh[hit], at[hit])
        rows.append(r)
        items.append(i)
    levels = [x for x in index.parts if x >= 0]
    if levels and len(sh):
        count = np.bincount(at, minlength=n_rows)
        begin = np.cumsum(count) - count
        steps = -(-count // FIRST_STEP)
        row = np.repeat(np.arange(n_rows), steps)
        place = np.arange(len(row)) - np.repeat(np.cumsum(steps) - steps, steps)
        own = (np.cumsum(steps) - steps)[at] + (np.arange(len(sh)) - begin[at]) // FIRST_STEP
        key = own * REGISTERS + (sh >> _SHIFT).astype(np.int64)
        regs = np.full(len(row) * REGISTERS, _NONE, dtype=_U)
        np.minimum.at(regs, key, sh)
        regs = regs.reshape(-1, REGISTERS)
        for level in range(max(levels) + 1):
            if level:  # a step of this level is two of the last
                first = np.flatnonzero(place % 2 == 0)
                second = np.minimum(first + 1, len(row) - 1)
                second = np.where(row[second] == row[first], second, first)
                regs = np.minimum(regs[first], regs[second])
                row, place = row[first], place[first] // 2
            if level not in index.parts:
                continue
            s, r = np.nonzero(index.may_have(level, regs))
            v = regs[s, r]
            real = v != _NONE
            s, r, v = s[real], r[real], v[real]
            # a step's register is a window's unless the neighbour's is smaller, in both windows
            before, after = np.maximum(s - 1, 0), np.minimum(s + 1, len(row) - 1)
            holds = (s == 0) | (row[before] != row[s]) | (regs[before, r] >= v) | (row[after] != row[s]) | (regs[after, r] >= v)
            a, b = index.items_with(level, v[holds], row[s[holds]])
            rows.append(a)
            items.append(b)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = max(len(index.sets), 1)
    both = np.unique(np.concatenate(rows) * n + np.concatenate(items))
    return both // n, both % n


def search(index: Index, data: np.ndarray, offsets: np.ndarray, k: int, threshold: float) -> Iterator[tuple[int, int, int]]:
    """(row, item, shared shingles) of the pairs that reach the threshold."""
    for a, b in kernel.pieces(offsets):
        _, _, row, h = kernel.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        sh, at, _ = kernel.shingles(h, row, b - a, k)
        rows, items = candidates(index, sh, at, b - a)
        cut = np.searchsorted(at, np.arange(b - a + 1))
        done = 0
        while done < len(rows):
            r = int(rows[done])
            x = np.unique(sh[cut[r] : cut[r + 1]])
            while done < len(rows) and rows[done] == r:
                own = index.sets[int(items[done])]
                shared = int((x[np.minimum(np.searchsorted(x, own), len(x) - 1)] == own).sum())
                if shared >= threshold * len(own) - 1e-9:
                    yield a + r, int(items[done]), shared
                done += 1


def _blocks(items: DataFrame, k: int) -> Iterator[tuple[list[int | None], Index]]:
    """Blocks of items, of bounded size, as (ids, index)."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES) * 2 if total > BLOCK_BYTES else 1)
    items = stage(items.withColumn("b", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))), "items") if n > 1 else items.withColumn("b", F.lit(0))
    for block in range(n):
        own = items.filter(F.col("b") == block).select("item_id", "text").toArrow()  # ids stay integers beside nulls
        ids = own.column("item_id").to_pylist()
        data, offsets = kernel.buffers(own.column("text"))
        yield ids, Index([x for _, x in kernel.shingle_sets(data, offsets, k)])


def find(docs: DataFrame, items: DataFrame, k: int = K, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of every pair of a
    document (doc_id, text) and an item (item_id, text) found in it."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, n_item long, n_shared long"
    out = None
    for ids, index in _blocks(items, k):
        shared = spark.sparkContext.broadcast((ids, index))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own_ids, own = shared.value
            for batch in batches:
                data, offsets = kernel.buffers(batch.column("text"))
                got = list(search(own, data, offsets, k, threshold))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(pa.array([r for r, _, _ in got], pa.int64())),
                    pa.array([own_ids[i] for _, i, _ in got], pa.int64()),
                    pa.array([len(own.sets[i]) for _, i, _ in got], pa.int64()),
                    pa.array([n for _, _, n in got], pa.int64())], names=["doc_id", "item_id", "n_item", "n_shared"])

        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def clean(docs: DataFrame, items: DataFrame, k: int = K, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` in which no item is found, where they are: no text
    is shuffled."""
    spark = docs.sparkSession
    ship(spark)
    for _, index in _blocks(items, k):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = kernel.buffers(batch.column("text"))
                keep = np.ones(batch.num_rows, dtype=bool)
                for r, _, _ in search(shared.value, data, offsets, k, threshold):
                    keep[r] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op6(spark, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document."""
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_SETS = """
  SELECT id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]
    WHEN len(w) > 0 THEN ['short ' || array_to_string(w, ' ')] ELSE [] END) AS s
  FROM (SELECT {id} AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM {table} WHERE text IS NOT NULL)"""

ORACLE = f"""
WITH d AS (SELECT DISTINCT id, s FROM ({_SETS.format(id='doc_id', table='documents')})),
i AS (SELECT DISTINCT id, s FROM ({_SETS.format(id='item_id', table='benchmark')})),
n AS (SELECT id, count(*) AS n_item FROM i GROUP BY id),
m AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared FROM d JOIN i ON d.s = i.s GROUP BY d.id, i.id)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM m JOIN n ON m.item_id = n.id WHERE 10 * n_shared >= 8 * n_item
"""
