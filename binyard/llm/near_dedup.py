"""Operator 1: near-duplicate classes with HyperMinHash sketches.

Method
  1. One pass over the texts makes a sketch per document: the shingle hash's
     top bits choose one of ``REGISTERS`` buckets; a bucket keeps the minimum
     of the remaining bits, compressed to a leading-zero count and ten
     mantissa bits (16 bits a register).
  2. Documents with one and the same shingle set become one class
     (map-side partial minimum on a 128-bit set hash), so a group of exact
     copies of any size is one row from here on.
  3. The compressed registers are banded (empty registers are filled from
     the next non-empty one in a fixed random order, which keeps the match
     probability equal to the Jaccard similarity for short documents too).
  4. In a band bucket every class is paired with the bucket's smallest class
     only; pairs whose collision-corrected Jaccard estimate is far below the
     threshold go; the rest are confirmed on full shingle sets.
  5. Links become components.  In buckets that still hold several components,
     the classes outside the largest are tested against members of it drawn by
     hash, one for each bucket and round.
  6. What is still apart is settled pair by pair, so no link between classes
     is lost.  A pair is formed once (in its first common band), only between
     different components, and only if sizes, the classes' private shingles
     (those that no other open class has) and bitmaps of the two sets leave
     room for the threshold: a bit that one set alone fills is a shingle that
     the other lacks.  These are bounds, not estimates; a class with many edits
     of its own forms no pair at all, however large its group is.

With 128 registers in 25 bands of 5, a pair at similarity 0.85 shares no band
with probability 5e-7, one at 0.8 with 5e-5.

Edge cases: a null or blank text has an empty set and is linked with nothing
(its component is its own id); fewer than k words are one shingle; repeated
rows give one output row each, with the same component; rows with a null id
take part like others (a null is never the smallest id unless all are null,
then component_id is null and kept false); an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binyard.llm import kernel
from binyard.llm.common import components, free, merged, ship, stage

REGISTERS = 128
MANTISSA = 10
BANDS, ROWS = 25, 5
EMPTY = np.uint16(0xFFFF)
#: Standard errors below the threshold at which an estimate rules a pair out.
MARGIN = 5.0
#: Rounds of tests against drawn members of a bucket's largest component.
ROUNDS = 3
#: 64-bit words of a shingle set's bitmap.
BITMAP = 32
#: Stands for a null id: the largest.
_TOP = 2**63 - 1

_LOG = REGISTERS.bit_length() - 1
_U = np.uint64


def registers(x: np.ndarray) -> np.ndarray:
    """The sketch of a sorted set of 64-bit hashes."""
    out = np.full(REGISTERS, EMPTY, dtype=np.uint16)
    if not len(x):
        return out
    bucket = x >> _U(64 - _LOG)
    at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    rest = (x[at] << _U(_LOG)) | _U((1 << _LOG) - 1)
    zeros = np.uint64(63) - np.floor(np.log2(rest.astype(np.float64))).astype(_U)
    # log2 of a rounded double can be one too high just below a power of two
    zeros = np.where((rest << zeros) >> _U(63) == 0, zeros + _U(1), zeros)
    mantissa = (rest << zeros << _U(1)) >> _U(64 - MANTISSA)
    out[bucket[at].astype(np.int64)] = ((np.minimum(zeros, _U(62)) << _U(MANTISSA)) | mantissa).astype(np.uint16)
    return out


def _fill_order() -> np.ndarray:
    rng = np.random.RandomState(20011)
    order = np.stack([np.concatenate(([j], rng.permutation(np.delete(np.arange(REGISTERS), j)))) for j in range(REGISTERS)])
    return order


_ORDER = _fill_order()
_BAND_WEIGHTS = kernel.mix(np.arange(1, BANDS * ROWS + 1, dtype=_U)).reshape(BANDS, ROWS) | _U(1)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """(rows, BANDS) 64-bit keys; a row without any register is not allowed."""
    full = regs.copy()
    for a in range(0, len(regs), 256):
        part = regs[a : a + 256]
        empty = part == EMPTY
        some = np.flatnonzero(empty.any(axis=1))
        if len(some):
            first = (~empty[some])[:, _ORDER].argmax(axis=2)
            source = np.take_along_axis(_ORDER[None], first[:, :, None], axis=2)[:, :, 0]
            full[a + some] = np.take_along_axis(part[some], source, axis=1)
    used = full[:, : BANDS * ROWS].reshape(len(regs), BANDS, ROWS).astype(_U) + _U(1)
    return kernel.mix((used * _BAND_WEIGHTS).sum(axis=2, dtype=_U) + np.arange(BANDS, dtype=_U) * _U(0x9E3779B97F4A7C15))


def collision_rate(n: np.ndarray) -> np.ndarray:
    """Probability that a bucket's registers of two disjoint sets of ``n``
    elements each are equal, per size, by summing over the register values."""
    edges = [0.0]
    for z in range(62, -1, -1):
        low = 2.0 ** -(z + 1)
        edges.extend(low * (1 + np.arange(1, (1 << MANTISSA) + 1) / (1 << MANTISSA)))
    b = np.minimum(np.array(edges), 1.0)
    out = np.zeros(len(n))
    for i, size in enumerate(n):
        alive = np.exp(size * np.log1p(-b / REGISTERS))
        p = alive[:-1] - alive[1:]
        out[i] = float((p * p).sum())
    return out


_SIZES = 2.0 ** np.arange(0, 41)
_RATES = collision_rate(_SIZES)


def estimate(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimate of register rows, and the number
    of independent draws that it is worth."""
    used = (ra != EMPTY) | (rb != EMPTY)
    n = used.sum(axis=1).astype(np.float64)
    same = ((ra == rb) & used).sum(axis=1).astype(np.float64)
    by_chance = REGISTERS * np.interp(np.log2(np.maximum(np.minimum(na, nb), 1)), np.log2(_SIZES), _RATES)
    j = np.clip((same - by_chance) / np.maximum(n - by_chance, 1), 0, 1)
    # registers are drawn without replacement from the union of the sets
    union = np.maximum((na + nb) / 1.8, n)
    return j, n / np.maximum(1 - n / union, 0.05)


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = kernel.buffers(batch.column("text"))
            size, h1, h2, regs = [], [], [], []
            for _, x in kernel.shingle_sets(data, offsets, k):
                size.append(len(x))
                h1.append(int(x.sum(dtype=_U)))
                h2.append(int(kernel.mix(x ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U)))
                regs.append(registers(x).tobytes() if len(x) else None)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("t"), pa.array(size, pa.int64()),
                pa.array(np.array(h1, dtype=_U).view(np.int64)), pa.array(np.array(h2, dtype=_U).view(np.int64)),
                pa.array(regs, pa.binary())], names=["doc_id", "t", "n_shingles", "h1", "h2", "regs"])
    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        regs = np.frombuffer(b"".join(batch.column("regs").to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
        keys = band_keys(regs)
        cls = np.repeat(batch.column("cls").to_numpy(), BANDS)
        n = np.repeat(batch.column("n").to_numpy(), BANDS)
        band = np.tile(np.arange(BANDS, dtype=np.int32), len(regs))
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(band), pa.array(cls), pa.array(n)],
                                         names=["key", "band", "cls", "n"])


def _all_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            regs = np.frombuffer(b"".join(batch.column("regs").to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
            keys = pa.ListArray.from_arrays(pa.array(np.arange(len(regs) + 1, dtype=np.int32) * BANDS), pa.array(band_keys(regs).ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("cls"), keys], names=["cls", "keys"])


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.zeros((batch.num_rows, BITMAP * 64), dtype=bool)
        for r, x in enumerate(batch.column("shingles")):
            rows[r, (x.values.to_numpy().view(_U) >> _U(11)) % _U(BITMAP * 64)] = True
        words = np.packbits(rows, axis=1, bitorder="little").view(np.int64).reshape(-1, BITMAP)
        yield pa.RecordBatch.from_arrays([batch.column("cls"), *[pa.array(words[:, i].copy()) for i in range(BITMAP)]],
                                         names=["cls", *[f"b{i}_" for i in range(BITMAP)]])


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = kernel.buffers(batch.column("text"))
            sets = [x for _, x in kernel.shingle_sets(data, offsets, k)]
            own = np.array([int(x.sum(dtype=_U)) for x in sets], dtype=_U).view(np.int64) == batch.column("h1").to_numpy()
            sets = [x.view(np.int64) for x, mine in zip(sets, own, strict=True) if mine]
            lens = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)
            flat = pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("cls").filter(pa.array(own)), pa.ListArray.from_arrays(pa.array(lens), flat)],
                                             names=["cls", "shingles"])
    return run


def _likely(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
            j, n = estimate(ra, rb, batch.column("na").to_numpy(), batch.column("nb").to_numpy())
            near = j >= threshold - MARGIN * np.sqrt(threshold * (1 - threshold) / np.maximum(n, 1))
            yield batch.select(["lo", "hi"]).filter(pa.array(near))
    return run


def _sets_of(need: DataFrame, classes: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(cls, shingles) of the wanted classes (cls), read from their texts.
    The texts are shuffled whatever the number of classes, so that the work is
    of one kind at every size."""
    home = stage(classes.select("cls", "h1").join(need, "cls"), "need")
    named = home.select("cls", "h1", F.col("cls").alias("row")).hint("merge").join(texts, "row").select("cls", "h1", "text")
    sets = stage(named.mapInArrow(_sets(k), "cls long, shingles array<long>"), "sets")
    if sets.count() > home.count():  # repeated rows
        sets = sets.dropDuplicates(["cls"])
    return sets


def _likely_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (lo, hi) that sizes and sketches do not rule out."""
    side = lambda c: classes.select(F.col("cls").alias(c), F.col("regs").alias("ra" if c == "lo" else "rb"),
                                    F.col("n").alias("na" if c == "lo" else "nb"))
    near = pairs.join(side("lo"), "lo").join(side("hi"), "hi")
    near = near.filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return stage(near.select("lo", "hi", "ra", "rb", "na", "nb").mapInArrow(_likely(percent / 100), "lo long, hi long"), "likely")


def _confirmed(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (lo, hi) whose full shingle sets reach the threshold."""
    both = (near.join(sets.select(F.col("cls").alias("lo"), F.col("shingles").alias("a")), "lo")
            .join(sets.select(F.col("cls").alias("hi"), F.col("shingles").alias("b")), "hi"))
    common = F.size(F.array_intersect("a", "b"))
    return both.filter(100 * common >= percent * (F.size("a") + F.size("b") - common)).select("lo", "hi")


def _named(docs: DataFrame, k: int, percent: int, key: str) -> tuple[DataFrame, DataFrame]:
    """(sketch, classes): doc_id, t (the text's hash), n_shingles, h1, h2 of
    every row; and of every shingle set h1, h2, the smallest id and text of
    its rows, its component ``part``, and that component's smallest id."""
    spark = docs.sparkSession
    ship(spark)
    base = docs.select(F.col(key).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = stage(base.withColumn("t", F.xxhash64("text")).mapInArrow(
        _sketch(k), "doc_id long, t long, n_shingles long, h1 long, h2 long, regs binary"), "sketch")
    # one class per shingle set; a class is named by its smallest id
    classes = (sketch.filter("n_shingles > 0").groupBy("h1", "h2")
               .agg(F.min(F.struct(F.coalesce(F.col("doc_id"), F.lit(_TOP)).alias("id"), "t", "n_shingles", "regs")).alias("m"))
               .select(F.col("m.id").alias("id"), F.col("m.t").alias("t"), "h1", "h2", F.col("m.n_shingles").alias("n"), F.col("m.regs").alias("regs")))
    # an id shared by unlike texts may name several classes: number those apart
    classes = stage(classes, "classes")
    shared = classes.groupBy("id").agg(F.count("*").alias("c")).filter(f"c > 1 or id = {_TOP}").agg(F.count("*")).first()[0]
    if shared:
        classes, comp = _by_set(classes, base, k, percent)
    else:
        classes = classes.withColumn("cls", F.col("id"))
        comp = _components(classes, base.select(F.col("doc_id").alias("row"), "text"), k, percent)
    own = classes.join(comp.withColumnRenamed("node", "cls"), "cls", "left")
    own = own.select("h1", "h2", "id", "t", F.coalesce("component", "cls").alias("part"))
    if not shared:  # a component is named by its smallest id already
        return sketch, own.withColumn("component", F.col("part"))
    least = own.groupBy("part").agg(F.min("id").alias("component"))
    return sketch, own.join(least, "part")


def near_classes(docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs`` (key, text): doc_id, n_shingles,
    component_id, kept.  Links at ``percent`` Jaccard of k-word shingles."""
    sketch, own = _named(docs, k, percent, key)
    out = sketch.select("doc_id", "n_shingles", "h1", "h2").join(own.select("h1", "h2", "component"), ["h1", "h2"], "left")
    comp_id = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.when(F.col("component") < _TOP, F.col("component")))
    return out.select("doc_id", "n_shingles", comp_id.alias("component_id"),
                      F.coalesce(F.col("doc_id") == comp_id, F.lit(False)).alias("kept"))


def _by_set(classes, base, k, percent) -> tuple[DataFrame, DataFrame]:
    """(classes, components) where an id names several texts or none: classes
    are numbered by their set hash, and the texts are found by it."""
    classes = classes.withColumn("cls", F.xxhash64("h1", "h2"))
    def hashed(batches):
        for batch in batches:
            data, offsets = kernel.buffers(batch.column("text"))
            pair = [(int(x.sum(dtype=_U)), int(kernel.mix(x ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U)))
                    for _, x in kernel.shingle_sets(data, offsets, k)]
            a = np.array(pair, dtype=_U).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a[:, 0].copy()), pa.array(a[:, 1].copy()), batch.column("text")],
                                             names=["h1", "h2", "text"])
    texts = base.select("text").mapInArrow(hashed, "h1 long, h2 long, text string")
    texts = texts.groupBy("h1", "h2").agg(F.min("text").alias("text")).select(F.xxhash64("h1", "h2").alias("row"), "text")
    return classes, _components(classes.drop("id", "t"), texts, k, percent)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("lo").alias("cls")).unionByName(pairs.select(F.col("hi").alias("cls"))).distinct()


def _open(member: DataFrame, comp: DataFrame) -> DataFrame:
    """The members of buckets with several components, with their component
    and the bucket's largest one (main)."""
    member = member.join(comp.withColumnRenamed("node", "cls"), "cls", "left").select(
        "key", "band", "cls", "n", F.coalesce("component", "cls").alias("comp"))
    per = member.groupBy("key", "comp").agg(F.count("*").alias("c"))
    several = (per.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("m"), F.count("*").alias("comps"))
               .filter("comps > 1").select("key", F.col("m.comp").alias("main")))
    return stage(member.join(several, "key"), "open")


def _components(classes: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, component) of the classes that have a confirmed link."""
    rows = classes.select("cls", "n", "regs").mapInArrow(_bands, "key long, band int, cls long, n long")
    rows = stage(rows, "bands")
    many = rows.groupBy("key").agg(F.min("cls").alias("pivot"), F.max("cls").alias("most")).filter("pivot < most")
    member = stage(rows.join(many.select("key", "pivot"), "key"), "buckets")
    tested = stage(member.filter("cls > pivot").select(F.col("pivot").alias("lo"), F.col("cls").alias("hi")).distinct(), "stars")
    near = _likely_pairs(tested, classes, percent)
    links = _confirmed(near, _sets_of(_ends(near), classes, texts, k), percent)

    comp = stage(components(links), "components")
    rest = _open(member, comp)
    if rest.limit(1).count() == 0:
        return comp
    sets = _sets_of(rest.select("cls").distinct(), classes, texts, k)
    for draw in range(ROUNDS):
        pivot = rest.filter("comp = main").groupBy("key").agg(F.min(F.struct(F.xxhash64("cls", "key", F.lit(draw)), "cls")).alias("p"))
        pairs = rest.filter("comp <> main").select("key", "cls").join(pivot.select("key", F.col("p.cls").alias("p")), "key")
        pairs = pairs.select(F.least("cls", "p").alias("lo"), F.greatest("cls", "p").alias("hi")).distinct()
        pairs = stage(pairs.join(tested, ["lo", "hi"], "left_anti"), "drawn")
        found = stage(_confirmed(_likely_pairs(pairs, classes, percent), sets, percent), "drawnlinks")
        tested = tested.unionByName(pairs)
        if found.limit(1).count() == 0:
            break
        comp = merged(comp, found)
        rest = _open(rest.select("key", "band", "cls", "n"), comp)

    # shingles that one open class alone has cannot be shared with another
    shingles = sets.join(rest.select("cls").distinct(), "cls", "left_semi").select("cls", F.explode("shingles").alias("s"))
    own = (shingles.groupBy("s").agg(F.count("*").alias("c"), F.min("cls").alias("cls")).filter("c = 1")
           .groupBy("cls").agg(F.count("*").alias("own")))
    bands = classes.join(rest.select("cls").distinct(), "cls", "left_semi").select("cls", "regs").mapInArrow(_all_bands, "cls long, keys array<long>")
    words = [f"b{i}_" for i in range(BITMAP)]
    bits = sets.mapInArrow(_bitmaps, "cls long, " + ", ".join(f"{w} long" for w in words))
    facts = bands.join(own, "cls", "left").join(bits, "cls").select("cls", "keys", F.coalesce("own", F.lit(0)).alias("own"), *words)
    # a class whose own shingles alone keep it below the threshold links with nothing
    able = stage(rest.join(facts, "cls").filter(100 * F.col("own") <= (100 - percent) * F.col("n")), "able")
    left = able.filter("comp <> main").select("key", "band", *[F.col(c).alias(c + "x") for c in ("cls", "n", "comp", "own", "keys", *words)])
    right = able.select("key", "main", *[F.col(c).alias(c + "y") for c in ("cls", "n", "comp", "own", "keys", *words)])
    shared, whole = "least(nx - ownx, ny - owny)", "greatest(nx + owny, ny + ownx)"
    first = "array_position(zip_with(keysx, keysy, (a, b) -> a = b), true) = band + 1"
    lacks = lambda a, b: "(" + " + ".join(f"bit_count({w}{a} & ~{w}{b})" for w in words) + ")"
    room = " and ".join(f"{100 + percent} * (n{a} - {lacks(a, b)}) >= {percent} * (nx + ny)" for a, b in ("xy", "yx"))
    pairs = left.join(right, "key").filter(
        f"compx <> compy and (compy = main or clsx < clsy) and 100 * {shared} >= {percent} * {whole} and {room} and {first}")
    pairs = pairs.select(F.least("clsx", "clsy").alias("lo"), F.greatest("clsx", "clsy").alias("hi")).distinct()
    pairs = stage(pairs.join(tested, ["lo", "hi"], "left_anti"), "rest")
    return merged(comp, stage(_confirmed(_likely_pairs(pairs, classes, percent), sets, percent), "restlinks"))


def op1(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: 3-word shingles, 85 %."""
    return near_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=3, percent=85)


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]
    WHEN len(w) > 0 THEN ['short ' || array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT x, y FROM p JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * c >= 85 * (a.n + b.n - c)),
r(id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.y, r.c FROM r JOIN e ON r.id = e.x),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d JOIN m ON d.doc_id = m.id LEFT JOIN n ON d.doc_id = n.doc_id
"""


def near_dedup(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: of its rows the
    one with the smallest id, null ids last, and then the smallest set and text
    hash.  Decisions go by row, that is by id and text: unlike texts of one id
    are documents of their own.  Rows without words all stay."""
    cols = docs.columns
    doc, text = free(cols, "doc"), free(cols, "text_hash")
    sketch, own = _named(docs, k, percent, "doc_id")
    first = own.groupBy("part").agg(F.min(F.struct("id", "h1", "h2", "t")).alias("first"))
    rows = sketch.filter("n_shingles > 0").select(F.coalesce("doc_id", F.lit(_TOP)).alias(doc), F.col("t").alias(text), "h1", "h2")
    rows = rows.join(own.join(first, "part").select("h1", "h2", "first"), ["h1", "h2"])
    is_first = (F.col(doc) == F.col("first.id")) & (F.col("h1") == F.col("first.h1")) & (F.col("h2") == F.col("first.h2")) & (F.col(text) == F.col("first.t"))
    verdict = rows.groupBy(doc, text).agg(F.max(is_first).alias("stays"), F.count("*").alias("rows"))
    verdict = stage(verdict.filter("not stays or rows > 1"), "verdict")
    keyed = docs.withColumn(doc, F.coalesce(F.col("doc_id").cast("long"), F.lit(_TOP))).withColumn(text, F.xxhash64(F.col("text").cast("string")))
    # a merge join at every size: the verdicts grow with the corpus
    kept = keyed.join(verdict.select(doc, text).hint("merge"), [doc, text], "left_anti").select(*cols)
    again = verdict.filter("stays").select(doc, text)  # the row that stays is there several times
    if again.limit(1).count() == 0:
        return kept
    once = keyed.join(again, [doc, text], "left_semi").groupBy(doc, text).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), F.xxhash64(*_hashable(docs))).alias("row"))
    return kept.unionByName(once.select("row.*"))


def _hashable(docs: DataFrame) -> list[str]:
    """Columns that tell otherwise equal rows apart, in any order of them."""
    return [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
