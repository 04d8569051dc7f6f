"""Operator 12: hard-negative mining over Hilbert-ordered candidate blocks with
zone maps.

Vectors become integers.  Candidates are ordered by label and, within it, along
a Hilbert curve through the dimensions of the largest variance, cut into blocks
and written as Parquet, a folder for each zone of neighbouring blocks.  A block
carries its zone map: the least and the largest integer of every dimension, and
of the labels.  For an anchor ``a`` interval arithmetic then bounds every inner
product in a block: ``sum max(a*lo, a*hi)`` above, ``sum min(a*lo, a*hi)``
below.

An anchor's positives are its best rows of the same label.  Each positive opens
a window of scores, from which the anchor takes its best rows of other labels.
A block must be read for an anchor only if a window's range meets the block's
bounds and the bound is not below the worst score the window already holds;
zones without such a block are pruned as partitions before the scan.  What a
window holds starts from the anchor's own block (positives) or from an eighth,
a sixty-fourth ... of the zones (windows), so that later passes read less and
emit little.  Blocks that are read are scored whole, as one matrix product.

Anchors come in chunks of bounded size, neighbours on the curve together; a
chunk's vectors, windows and scores so far are broadcast.  No candidates are
sent to another task, and what tasks emit is cut to the best per window before
and after the shuffle.  The number of pairs that are scored is at worst the
stated query set against all rows; no bound on partners is set.

Edge cases: rows with a null id, label or vector take no part, nor do vectors
with a null, NaN, infinite or oversized component (``vectors.LIMIT``) or
another length than the most common; rows are rows: a repeated id or a whole
repeated row is a candidate, and an anchor, of its own, only a row itself is
not its partner; ties go to the smaller id; negative positive scores open empty
windows; an empty table gives no rows; further columns are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from binyard.llm.common import discard, ship, staged
from binyard.llm.vectors import common_dimension, finite, quantised

#: Rows of a block; rows of a zone, at least, and zones, at most.
BLOCK = 1024
ZONE_ROWS = 4096
ZONES = 8192
#: Anchors of a chunk; a chunk may exceed this by the anchors of one zone.
ANCHORS = 16384
#: Dimensions of the curve and bits of each.
CURVE, BITS = 8, 7
#: Each pass over the zones takes so many times those of the one before.
FAN = 8
#: Anchors scored at once, and scores held before they are cut to the best.
SOME, HELD = 2048, 1 << 18

_LEAST = np.iinfo(np.int64).min


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points (n, m) with ``bits`` bits a
    dimension (m * bits < 63), by Skilling's transform."""
    x = x.astype(np.uint64).T.copy()
    m, one = len(x), np.uint64(1)
    for b in range(bits - 1, 0, -1):
        bit, below = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(m):
            on = (x[i] & bit) != 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(on, below, swap)
            x[i] ^= np.where(on, np.uint64(0), swap) if i else np.uint64(0)
    for i in range(1, m):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[m - 1] & np.uint64(1 << b)) != 0, np.uint64((1 << b) - 1), np.uint64(0))
    x ^= turn
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(m):
            place = (place << one) | ((x[i] >> np.uint64(b)) & one)
    return place.astype(np.int64)


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and of ``b``: exact integers, in the
    narrowest type whose sums are exact."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def score_bounds(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) possible inner product of anchors (n, d) with vectors
    inside boxes (m, d), as (n, m)."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return dot(up, lo) + dot(down, hi), dot(up, hi) + dot(down, lo)


class Best:
    """The best (score, id) of each slot, and the score that a further one must
    reach.  ``floor`` may start from what is known to exist elsewhere."""

    def __init__(self, floor: np.ndarray, keep: int) -> None:
        self.floor, self.keep = floor.copy(), keep
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, slot: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        if len(slot):
            self.held.append(np.stack([slot, score, ident]))
            self.size += len(slot)
            if self.size > HELD:
                self.cut()

    def cut(self) -> np.ndarray:
        """(slot, score, id) of the best, by slot and rank."""
        rows = np.concatenate(self.held, axis=1) if self.held else np.zeros((3, 0), np.int64)
        rows = rows[:, rows[1] >= self.floor[rows[0]]]
        rows = rows[:, np.lexsort((rows[2], -rows[1], rows[0]))]
        first = np.searchsorted(rows[0], rows[0], side="left")
        rank = np.arange(rows.shape[1]) - first
        rows = rows[:, rank < self.keep]
        full = rank[rank < self.keep] == self.keep - 1
        np.maximum.at(self.floor, rows[0][full], rows[1][full])
        self.held, self.size = [rows], rows.shape[1]
        return rows


# ------------------------------------------------------------------- blocks


def _stats(rows: DataFrame, dim: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(rows, variance, least, largest of each dimension), summed map-side."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = quantised(batch.column("embedding"), dim).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(np.full(dim, len(x))), pa.array(x.sum(axis=0)),
                                              pa.array((x * x).sum(axis=0)), pa.array(x.min(axis=0)), pa.array(x.max(axis=0))],
                                             names=["at", "n", "s", "q", "lo", "hi"])

    found = (rows.select("embedding").mapInArrow(run, "at int, n long, s double, q double, lo double, hi double").groupBy("at")
             .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
             .orderBy("at").collect())  # one row a dimension
    n = found[0]["n"]
    take = lambda c: np.array([r[c] for r in found])
    return n, take("q") / n - (take("s") / n) ** 2, take("lo"), take("hi")


def _placed(rows: DataFrame, dim: int, stats) -> DataFrame:
    """(label, place, vec_id, x): the integers, and their place on the curve."""
    n, spread, least, largest = stats
    use = np.sort(np.argsort(-spread, kind="stable")[:CURVE])
    lo, span = least[use], largest[use] - least[use] + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = quantised(batch.column("embedding"), dim)
            cell = np.clip((x[:, use] - lo) * (1 << BITS) // span, 0, (1 << BITS) - 1)
            data = np.ascontiguousarray(x.astype(np.int32))
            ends = np.arange(len(x) + 1, dtype=np.int32) * (4 * dim)
            packed = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(hilbert(cell, BITS)), batch.column("vec_id"), packed],
                                             names=["label", "place", "vec_id", "x"])

    return rows.select("label", "vec_id", "embedding").mapInArrow(run, "label long, place long, vec_id long, x binary")


_BLOCKS = "zone int, block long, n int, label_lo long, label_hi long, lo binary, hi binary, labels binary, ids binary, vectors binary"


def _narrow(x: np.ndarray) -> bytes:
    """Integers in two bytes where they fit, else four."""
    return x.astype(np.int16 if np.abs(x).max(initial=0) < 1 << 15 else np.int32).tobytes()


def _wide(data: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, np.int16 if len(data) == 2 * n * dim else np.int32).reshape(n, dim)


def _cut_blocks(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        done, last = 0, False
        batches = iter(batches)
        while not last:
            batch = next(batches, None)
            last = batch is None
            if batch is not None:
                own = pa.Table.from_batches([batch])
                rest = own if rest is None else pa.concat_tables([rest, own])
            out = []
            while rest is not None and rest.num_rows and (last or rest.num_rows >= BLOCK):
                part, rest = rest.slice(0, BLOCK).combine_chunks(), rest.slice(BLOCK)
                zone = part["zone"][0].as_py()
                x = np.frombuffer(b"".join(part["x"].to_pylist()), np.int32).reshape(part.num_rows, dim)
                labels, ids = (part[c].to_numpy().astype(np.int64) for c in ("label", "vec_id"))
                out.append((zone, (zone << 32) + done, part.num_rows, int(labels.min()), int(labels.max()), _narrow(x.min(axis=0)), _narrow(x.max(axis=0)),
                            labels.tobytes(), ids.tobytes(), _narrow(x)))
                done += 1
            if out:
                names = [c.split()[0] for c in _BLOCKS.split(", ")]
                kinds = {"zone": pa.int32(), "n": pa.int32(), "block": pa.int64(), "label_lo": pa.int64(), "label_hi": pa.int64()}
                yield pa.RecordBatch.from_arrays([pa.array(c, kinds.get(k, pa.binary())) for k, c in zip(names, zip(*out, strict=True), strict=True)], names=names)

    return run


def write_blocks(rows: DataFrame, dim: int) -> tuple[DataFrame, str, int]:
    """The candidate blocks of (vec_id, label, embedding), their folder, and
    the number of rows."""
    stats = _stats(rows, dim)
    zones = max(1, min(ZONES, -(-stats[0] // ZONE_ROWS)))
    ordered = _placed(rows, dim, stats).repartitionByRange(zones, "label", "place", "vec_id").sortWithinPartitions("label", "place", "vec_id")
    blocks = ordered.withColumn("zone", F.spark_partition_id()).mapInArrow(_cut_blocks(dim), _BLOCKS)
    _, path = staged(blocks, "blocks", by="zone")
    return rows.sparkSession.read.schema(_BLOCKS).parquet(path), path, stats[0]


def _block(row: dict, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row numbers, labels, ids, vectors) of a block."""
    n = row["n"]
    return (row["block"] * BLOCK + np.arange(n), np.frombuffer(row["labels"], np.int64), np.frombuffer(row["ids"], np.int64),
            _wide(row["vectors"], n, dim))


def _anchors(blocks: DataFrame, dim: int, every: int, positives: int) -> DataFrame:
    """(zone, uid, anchor_id, label, floor, x): the anchors, each with the
    score of its last positive inside its own block, if there are as many."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                uid, labels, ids, x = _block(row, dim)
                at = np.flatnonzero(ids % every == 0)
                if not len(at):
                    continue
                same = (labels[at][:, None] == labels) & (uid[at][:, None] != uid)
                score = np.where(same, dot(x[at], x), _LEAST)
                floor = np.partition(score, -positives, axis=1)[:, -positives] if len(x) >= positives else np.full(len(at), _LEAST)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), row["zone"], np.int32)), pa.array(uid[at]), pa.array(ids[at]), pa.array(labels[at]), pa.array(floor),
                     pa.array([v.tobytes() for v in x[at].astype(np.int32)], pa.binary())], names=["zone", "uid", "anchor_id", "label", "floor", "x"])

    return blocks.mapInArrow(run, "zone int, uid long, anchor_id long, label long, floor long, x binary")


# ------------------------------------------------------------------ windows


class Chunk:
    """Anchors and the windows of each: ``low <= score <= high`` of the rows of
    the same label or of other labels, of which ``keep`` are sought; ``floor``
    is the score that a row must reach to be among them."""

    def __init__(self, uid, labels, x, low, high, floor, same: bool, keep: int) -> None:
        self.uid, self.labels, self.x, self.low, self.high, self.same, self.keep = uid, labels, x, low, high, same, keep
        self.floor = np.maximum(floor, low)

    def must_read(self, row: dict, dim: int, floor: np.ndarray) -> np.ndarray:
        """Which anchors need a block, by its zone map."""
        lo, hi = _wide(row["lo"], 1, dim), _wide(row["hi"], 1, dim)
        if self.same:
            at = np.flatnonzero((self.labels >= row["label_lo"]) & (self.labels <= row["label_hi"]))
        else:
            at = np.flatnonzero((self.labels != row["label_lo"]) | (self.labels != row["label_hi"]))
        least, most = score_bounds(self.x[at], lo, hi)
        return at[((most >= floor[at]) & (least <= self.high[at]) & (floor[at] <= self.high[at])).any(axis=1)]


_MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_ZONE_MAP = ("zone", "label_lo", "label_hi", "lo", "hi")


def needed_zones(blocks: DataFrame, chunk, dim: int) -> list[int]:
    """The zones with a block that an anchor must read: one number a zone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, found = chunk.value, set()
        for batch in batches:
            for row in batch.to_pylist():
                if row["zone"] not in found and len(own.must_read(row, dim, own.floor)):
                    found.add(row["zone"])
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int32())], names=["zone"])

    return sorted(r["zone"] for r in blocks.select(*_ZONE_MAP).mapInArrow(run, "zone int").distinct().collect())


def _scan(blocks: DataFrame, chunk, dim: int) -> DataFrame:
    """(slot, score, id): the best of every task, for each window; a slot is
    an anchor's place times the windows of an anchor, plus the window's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Chunk = chunk.value
        windows = own.floor.shape[1]
        best = Best(own.floor.ravel(), own.keep)
        for batch in batches:
            for row in batch.to_pylist():
                floor = best.floor.reshape(-1, windows)
                need = own.must_read(row, dim, floor)
                if not len(need):
                    continue
                uid, labels, ids, x = _block(row, dim)
                for a in range(0, len(need), SOME):
                    at = need[a : a + SOME]
                    score = dot(own.x[at], x)
                    ok = (score >= floor[at].min(axis=1)[:, None]) & (score <= own.high[at].max(axis=1)[:, None])
                    ok &= (own.labels[at][:, None] == labels) == own.same
                    if own.same:
                        ok &= own.uid[at][:, None] != uid
                    i, j = np.nonzero(ok)
                    s = score[i, j]
                    for w in range(windows):
                        fits = np.flatnonzero((s >= floor[at[i], w]) & (s <= own.high[at[i], w]))
                        best.add(at[i[fits]] * windows + w, s[fits], ids[j[fits]])
        rows = best.cut()
        for a in range(0, rows.shape[1], 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c[a : a + (1 << 16)]) for c in rows], names=["slot", "score", "id"])

    return blocks.mapInArrow(run, "slot long, score long, id long")


def _top(rows: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def _search(blocks: DataFrame, zones: list[list[int]], chunk: Chunk, dim: int) -> tuple[DataFrame, str]:
    """(slot, score, id, rank) of the chunk's windows over all blocks, the
    zones of one list after those of another; staged, and the folder."""
    spark = blocks.sparkSession
    held, old = None, None
    for own in zones:
        shared = spark.sparkContext.broadcast(chunk)
        part = blocks.filter(F.col("zone").isin(own)) if len(zones) > 1 else blocks
        need = needed_zones(part, shared, dim)
        found = _scan(blocks.filter(F.col("zone").isin(need)), shared, dim)
        held, path = staged(_top(found if held is None else found.unionByName(held.drop("rank")), chunk.keep), "windows")
        if old:
            discard(spark, old)
        old = path
        if own is not zones[-1]:  # the last of each full window; at most one row a window
            floor = chunk.floor.ravel().copy()
            last = held.filter(F.col("rank") == chunk.keep).select("slot", "score").toArrow()
            slot, score = last["slot"].to_numpy(), last["score"].to_numpy()
            floor[slot] = np.maximum(floor[slot], score)
            chunk.floor = floor.reshape(chunk.floor.shape)
    return held, old


def _passes(zones: list[int]) -> list[list[int]]:
    """All zones, each once, in passes of growing size spread over the curve."""
    out, step = [], 1
    rest = zones
    while len(rest) > FAN:
        step *= FAN
        rest = zones[::step]
    seen: set[int] = set()
    while step:
        now = [z for z in zones[::step] if z not in seen]
        seen |= set(now)
        if now:
            out.append(now)
        step //= FAN
    return out or [[]]


def mine(df: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) of (vec_id, embedding, label).  Anchors are the rows whose
    id ``every`` divides; a window is ``low`` to ``high`` percent of a
    positive's score."""
    spark = df.sparkSession
    ship(spark)
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    rows = finite(rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull()), "embedding")
    dim = common_dimension(rows, "embedding")
    if not dim:
        return spark.createDataFrame([], _MINED)
    blocks, block_path, _ = write_blocks(rows.filter(F.size("embedding") == dim), dim)
    anchors, anchor_path = staged(_anchors(blocks, dim, every, positives), "anchors")
    counts = {r["zone"]: r["count"] for r in anchors.groupBy("zone").count().collect()}  # one row a zone
    zones = sorted(r["zone"] for r in blocks.select("zone").distinct().collect())
    chunks, size = [[]], 0
    for zone in sorted(counts):
        if size + counts[zone] > ANCHORS and chunks[-1]:
            chunks.append([])
            size = 0
        chunks[-1].append(zone)
        size += counts[zone]
    paths = [_mine_chunk(blocks, zones, anchors.filter(F.col("zone").isin(own)), dim, positives, negatives, low, high) for own in chunks if own]
    discard(spark, block_path)
    discard(spark, anchor_path)
    return spark.read.schema(_MINED).parquet(*paths) if paths else spark.createDataFrame([], _MINED)


def _mine_chunk(blocks, zones, anchors, dim, positives, negatives, low, high) -> str:
    """The folder of what a chunk of anchors mines."""
    spark = blocks.sparkSession
    some = anchors.orderBy("uid").toArrow()  # bounded: a chunk
    uid, ids, labels, floor = (some[c].to_numpy() for c in ("uid", "anchor_id", "label", "floor"))
    n = len(uid)
    x = np.frombuffer(b"".join(some["x"].to_pylist()), np.int32).reshape(n, dim).astype(np.int64)
    open_ = np.full((n, 1), _LEAST)
    near, near_path = _search(blocks, [zones], Chunk(uid, labels, x, open_, np.full((n, 1), np.iinfo(np.int64).max), floor[:, None], True, positives), dim)
    got = near.select("slot", "rank", "score").toArrow()  # bounded: a chunk's positives
    slot, rank, score = (got[c].to_numpy() for c in ("slot", "rank", "score"))
    least, most = np.ones((n, positives), np.int64), np.zeros((n, positives), np.int64)
    least[slot, rank - 1] = -(-low * score // 100)
    most[slot, rank - 1] = high * score // 100
    far, far_path = _search(blocks, _passes(zones), Chunk(uid, labels, x, least, most, least, False, negatives), dim)
    names = spark.createDataFrame(pa.table({"place": np.arange(n), "anchor_id": ids}))
    near = near.select(F.col("slot").alias("place"), (F.col("slot") * positives + F.col("rank") - 1).alias("slot"),
                       F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = (far.select("slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
           .join(near, "slot").join(F.broadcast(names), "place")
           .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
    _, path = staged(out, "mined")
    discard(spark, near_path)
    discard(spark, far_path)
    return path


def op12(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth row; every seventh has another label."""
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    return mine(df.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label")))


ORACLE = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS s
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5),
n AS (SELECT p.a AS anchor_id, p.b AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.s DESC, s.b) AS rank,
    s.b AS negative_id, p.s AS positive_score, s.s AS negative_score
  FROM p JOIN s ON p.a = s.a AND NOT s.same AND 50 * p.s <= 100 * s.s AND 100 * s.s <= 95 * p.s)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
