"""Operator 13: vector code compression, a product quantiser trained with
Drake and Hamerly's adaptive distance bounds.

Vectors are cut into equal parts; each part position has a codebook, and a
vector's code names the nearest entry of each.  Training alternates: every part
goes to its nearest entry, then entries move to the floored mean of their
parts.  All arithmetic that decides is on integers.

Between rounds each part keeps its ``b`` closest entries after its own, an
ordered lower bound of the distance to each, and one outer bound for all other
entries.  When entries move, a bound falls by the way that its entry moved (the
outer one by the longest way of any), and the distance to the part's own entry
is computed exactly.  Where that is strictly below every bound the part stays;
else the entries up to the first bound strictly above it are compared on exact
integers, ties to the lower index, and only where even the outer bound fails
are all entries compared again.  Bounds are kept in two bytes, rounded down;
rounding only ever makes a part be looked at again.  ``b`` adapts, batch by
batch: it shrinks to what nearly all parts needed, and doubles when more than
a tenth of them fell through.

Each round reads the state that the one before wrote to the shared folder and
writes its own; the older is then deleted.  The codebooks are the only thing
that passes through the driver: ``entries`` times the dimension, and the sums
behind them, summed map-side.

Edge cases: null vectors and those with a null, NaN, infinite or oversized
component (``vectors.LIMIT``) take no part, nor do those whose length is not
the most common one; a length that the parts do not divide is filled up with
zeros; with fewer vectors than entries the codebooks are shorter; a null id
sorts last among those that start the codebooks, repeated ids start as many
entries as they have rows, in the order of their vectors; a null label is a
label; an empty table gives no rows; further columns are ignored, whatever
their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binyard.llm.common import discard, ship, staged
from binyard.llm.vectors import common_dimension, finite, quantised

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Rows scored at once in a task.
ROWS = 4096
#: Labels whose sums are broadcast; more are joined by a shuffle.
LABELS = 100_000

_STATE = "vec_id long, label {label}, parts binary, code binary, near binary, bounds binary"
_RESULT = "vec_id long, label {label}, code string, error long"


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of points (n, d) to entries (k, d): exact integers."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    if 4 * top * top * x.shape[1] < 1 << 53:  # every sum is exact in doubles too
        a, b = x.astype(np.float64), book.astype(np.float64)
        d = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
        return d.astype(np.int64)
    return ((x[:, None, :] - book) ** 2).sum(axis=2)


def _down(x: np.ndarray) -> np.ndarray:
    """Two-byte lower bounds of ``x``, never negative."""
    x = np.clip(np.nextafter(x, -np.inf), 0, 65504)
    y = x.astype(np.float16)
    return np.where(y.astype(np.float64) > x, np.nextafter(y, np.float16(0)), y)


def _ranked(dist: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own and b closest entries, their distances, distance to the next) by
    distance and then index; ``dist`` has a column for each entry."""
    k = dist.shape[1]
    order = np.argsort(dist, axis=1, kind="stable")[:, : b + 2]
    d = np.take_along_axis(dist, order, axis=1)
    beyond = np.sqrt(d[:, b + 1].astype(np.float64)) if k > b + 1 else np.full(len(dist), np.inf)
    return order[:, : b + 1], d[:, : b + 1], beyond


class Codebooks:
    """Entries (parts, k, d) and how far each moved in the last round."""

    def __init__(self, entries: np.ndarray, moved: np.ndarray | None = None) -> None:
        self.entries = entries
        self.moved = moved

    @property
    def k(self) -> int:
        return self.entries.shape[1]

    def least(self) -> int:
        return min(max(self.k // 16, 1), self.k - 1)

    def most(self) -> int:
        return min(max(self.k // 4, 1), self.k - 1)

    def scan(self, x: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(near, bounds, squared distance to the nearest) of (n, parts, d)."""
        n, p, _ = x.shape
        near, bounds = np.empty((n, p, b + 1), np.uint8), np.empty((n, p, b + 1), np.float16)
        best = np.empty((n, p), np.int64)
        for j in range(p):
            own, d, beyond = _ranked(distances(x[:, j], self.entries[j]), b)
            near[:, j], best[:, j] = own, d[:, 0]
            bounds[:, j, :b] = _down(np.sqrt(d[:, 1:].astype(np.float64)))
            bounds[:, j, b] = _down(beyond)
        return near, bounds, best

    def update(self, x: np.ndarray, near: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict]:
        """The same as ``scan`` after entries moved, from the state before.
        Further what was needed: parts that stayed on their bounds alone, were
        settled among their closest, or had to be scanned."""
        n, p, _ = x.shape
        b = near.shape[2] - 1
        part = np.arange(p)[None, :]
        best = ((x - self.entries[part, near[..., 0]]) ** 2).sum(axis=2)
        own = np.nextafter(np.sqrt(best.astype(np.float64)), np.inf)
        low = bounds.astype(np.float64)
        low[..., :b] -= self.moved[part[..., None], near[..., 1:]]
        low[..., b] -= self.moved.max(axis=1)
        # a bound holds for all that stand behind it
        low = np.minimum.accumulate(low[..., ::-1], axis=2)[..., ::-1]
        need = (own[..., None] >= low).sum(axis=2)
        fell = need > b
        seen = {"stayed": int((need == 0).sum()), "settled": int(((need > 0) & ~fell).sum()), "scanned": int(fell.sum())}
        if fell.mean() > 0.1 and b < self.most():
            return *self.scan(x, min(2 * b, self.most())), seen
        near, bounds = near.copy(), _down(low)
        for z in np.unique(need[(need > 0) & ~fell]).tolist():
            i, j = np.nonzero(need == z)
            cand = near[i, j, : z + 1].astype(np.int64)
            d = ((x[i, j][:, None, :] - self.entries[j[:, None], cand]) ** 2).sum(axis=2)
            order = np.lexsort((cand, d), axis=1)
            d = np.take_along_axis(d, order, axis=1)
            near[i, j, : z + 1] = np.take_along_axis(cand, order, axis=1)
            bounds[i, j, :z] = _down(np.sqrt(d[:, 1:].astype(np.float64)))
            best[i, j] = d[:, 0]
        for j in np.flatnonzero(fell.any(axis=0)).tolist():
            i = np.flatnonzero(fell[:, j])
            ranked, d, beyond = _ranked(distances(x[i, j], self.entries[j]), b)
            near[i, j], best[i, j] = ranked, d[:, 0]
            bounds[i, j, :b] = _down(np.sqrt(d[:, 1:].astype(np.float64)))
            bounds[i, j, b] = _down(beyond)
        keep = int(np.quantile(need[~fell], 0.99, method="higher")) if not fell.all() else b
        keep = min(max(keep, self.least()), b)
        if keep < b:
            bounds[..., keep] = bounds[..., keep:].min(axis=2)
            near, bounds = near[..., : keep + 1], bounds[..., : keep + 1]
        return near, bounds, best, seen

    def moved_to(self, sums: np.ndarray, counts: np.ndarray) -> Codebooks:
        """Entries at the floored means of their parts; unused ones stay."""
        entries = np.where(counts[..., None] > 0, np.floor_divide(sums, np.maximum(counts, 1)[..., None]), self.entries)
        way = ((entries - self.entries) ** 2).sum(axis=2)
        return Codebooks(entries, np.where(way > 0, np.nextafter(np.sqrt(way.astype(np.float64)), np.inf), 0.0))

    def digest(self, width: int) -> str:
        """sha256 of all integers by part, entry and place, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entries[:, :, :width].ravel().tolist())).encode()).hexdigest()


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    rows = np.ascontiguousarray(rows).reshape(len(rows), -1)
    width = rows.shape[1] * rows.itemsize
    ends = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def _wide(column: pa.Array, dtype, shape: tuple[int, ...]) -> np.ndarray:
    """The rows' bytes as an array; all rows have the same length."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.view(dtype).reshape(len(column), *shape)


def _ints(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int16 if np.abs(x).max(initial=0) < 1 << 15 else np.int32)


def _state(batch: pa.RecordBatch, x: np.ndarray, near: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [batch.column("vec_id"), batch.column("label"), _binary(_ints(x)), _binary(near[..., 0]), _binary(near), _binary(bounds)],
        names=["vec_id", "label", "parts", "code", "near", "bounds"])


def _alike(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of the same widths together: ``b`` and the integers' size differ
    between batches that were written."""
    kinds = np.stack([np.array([len(x) for x in batch.column(c).to_pylist()]) for c in ("parts", "near")], axis=1)
    for kind in np.unique(kinds, axis=0):
        rows = np.flatnonzero((kinds == kind).all(axis=1))
        own = batch if len(rows) == batch.num_rows else batch.take(pa.array(rows))
        for a in range(0, own.num_rows, ROWS):
            yield own.slice(a, ROWS)


def _parts(batch: pa.RecordBatch, shape: tuple[int, int]) -> np.ndarray:
    size = len(batch.column("parts")[0].as_py()) // (shape[0] * shape[1])
    return _wide(batch.column("parts"), np.int16 if size == 2 else np.int32, shape).astype(np.int64)


def _sums(state: DataFrame, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """(sums, counts) of the parts of each entry."""
    p, k, d = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((p, k, d), np.int64), np.zeros((p, k), np.int64)
        for batch in batches:
            sizes = np.array([len(x) for x in batch.column("parts").to_pylist()])
            for size in np.unique(sizes):
                own = batch.take(pa.array(np.flatnonzero(sizes == size)))
                x, code = _parts(own, (p, d)), _wide(own.column("code"), np.uint8, (p,))
                for j in range(p):
                    count[j] += np.bincount(code[:, j], minlength=k)
                    for c in range(d):  # a batch's sums are exact in doubles
                        total[j, :, c] += np.bincount(code[:, j], weights=x[:, j, c], minlength=k).astype(np.int64)
        j, e = np.nonzero(count)
        j, e, c = (np.repeat(j, d), np.repeat(e, d), np.tile(np.arange(d), len(j)))
        yield pa.RecordBatch.from_arrays([pa.array((j * k + e) * d + c), pa.array(total[j, e, c]), pa.array(count[j, e])], names=["at", "total", "n"])

    rows = state.select("parts", "code").mapInArrow(run, "at long, total long, n long").groupBy("at").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    total, count = np.zeros(p * k * d, np.int64), np.zeros(p * k * d, np.int64)
    for r in rows.collect():  # one row for each integer of the codebooks
        total[r["at"]], count[r["at"]] = r["total"], r["n"]
    return total.reshape(p, k, d), count.reshape(p, k, d)[:, :, 0]


def compress(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks, int]:
    """(vec_id, label, code, error) of every vector of (vec_id, embedding,
    label), the final codebooks, and how many places of a part are real."""
    if not 2 <= entries <= 256:
        raise ValueError("an index has two hex digits: 2 to 256 entries")
    spark = df.sparkSession
    ship(spark)
    rows = finite(df.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding"), "embedding")
    dim = common_dimension(rows, "embedding")
    kind = rows.schema["label"].dataType.simpleString()
    rows = rows.filter(F.size("embedding") == dim)
    width = -(-dim // parts) if dim else 1
    shape = (parts, width)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()

    def cut(x: np.ndarray) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, parts * width - dim))).reshape(len(x), *shape)

    start = cut(quantised(pa.array([r["embedding"] for r in first], pa.list_(pa.float64())), dim)) if first else np.zeros((2, *shape), np.int64)
    if len(first) == 1:
        start = np.concatenate([start, start])  # a second, never the nearest by index
    books = Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)))
    state = old = None
    for turn in range(rounds + 1):
        last, own = turn == rounds, books

        def begin(batches: Iterator[pa.RecordBatch], books=own, last=last) -> Iterator[pa.RecordBatch]:
            b = min(max(books.k // 8, 1), books.k - 1)
            for batch in batches:
                for a in range(0, batch.num_rows, ROWS):
                    some = batch.slice(a, ROWS)
                    x = cut(quantised(some.column("embedding"), dim))
                    near, bounds, best = books.scan(x, b)
                    yield _final(some, near, best) if last else _state(some, x, near, bounds)

        def again(batches: Iterator[pa.RecordBatch], books=own, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for some in _alike(batch):
                    x = _parts(some, shape)
                    b = len(some.column("near")[0].as_py()) // parts
                    near, bounds, best, _ = books.update(x, _wide(some.column("near"), np.uint8, (parts, b)),
                                                         _wide(some.column("bounds"), np.float16, (parts, b)))
                    yield _final(some, near, best) if last else _state(some, x, near, bounds)

        source, step = (rows, begin) if state is None else (state, again)
        state, path = staged(source.mapInArrow(step, (_RESULT if last else _STATE).format(label=kind)), "codes" if last else "bounds", "zstd")
        if old:
            discard(spark, old)
        old = path
        if not last:
            books = books.moved_to(*_sums(state, books))
    if len(first) == 1:
        books = Codebooks(books.entries[:, :1])
    if not first:
        books = Codebooks(books.entries[:, :0])
    return state, books, width


def _final(batch: pa.RecordBatch, near: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    codes = [x.tobytes().hex() for x in np.ascontiguousarray(near[..., 0])]
    return pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(best.sum(axis=1))],
                                      names=["vec_id", "label", "code", "error"])


def op13(spark, sf_dir: str) -> DataFrame:
    """Every vector's code and error, and its label's error."""
    rows, books, width = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    sums, _ = staged(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "labels")
    sums = F.broadcast(sums) if sums.count() <= LABELS else sums
    out = rows.join(sums.withColumnRenamed("label", "of"), F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.digest(width)).alias("codebooks_sha256"))
