"""Operator 4 (native): mixing sources to target weights by hash-threshold
histograms.

A source's target is reached in whole passes over it plus a part of one more.
The part is the documents whose hash lies below a threshold.  The threshold is
found without sorting: words are summed by source and by the top bits of the
hash; the bucket in which the running sum crosses the budget is refined by the
next bits, and so on, each level nested in the boundary bucket of the one
before.  At the end the cut is placed on the nearer side of the last bucket.

Only aggregates by (source, bucket) are shuffled, after map-side partial sums,
so a source with a third of all rows costs no task more than its buckets do.
The running sums go over at most ``2 ** BITS`` rows of a source.

Edge cases: a null or blank text has size 0; a null source is a source of its
own, the last; rows of one id share a hash and so a fate, and so do rows of one
text where the id is null;
sources without words get a target of 0; an empty table gives no rows;
further columns are ignored by ``mix`` and kept by ``mix_documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from binyard.llm.common import WORD, free, stage

#: Hash bits that each level resolves, and the number of levels.
BITS, LEVELS = 12, 4
WEIGHTS = (5, 2, 1)
#: Targets: this share of all sizes, and at most this many times a source.
SHARE, MOST = 1.5, 2.0


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size) to (source, source_size, target): weights go by
    source in code point order, null last, repeating; a target stops at
    ``most`` times its source and the excess is shared out again by weight."""
    # a sorted table's places: those of its partition, and what stands before it
    ordered = sources.select("source", "source_size").orderBy(F.col("source").asc_nulls_last())
    ordered = stage(ordered.select("source", "source_size", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "ordered")
    parts = ordered.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first"))  # one row a partition
    parts = parts.select("part", "first", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    sources = ordered.join(parts, "part")
    rank = F.col("before") + F.col("at") - F.col("first")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    s = stage(sources.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(float(most))).alias("limit")), "sources")
    budget, level = None, 0.0
    while True:  # the level rises with each round, and each but the last stops one source more at least
        stopped = F.col("weight") * F.lit(level) >= F.col("limit")
        row = s.agg(F.sum("source_size").alias("all"), F.sum(F.when(stopped, F.col("limit"))).alias("full"),
                    F.sum(F.when(~stopped, F.col("weight"))).alias("open")).first()
        budget = float(row["all"] or 0) * share if budget is None else budget
        if not row["open"]:
            break
        new = (budget - (row["full"] or 0.0)) / row["open"]
        if new <= level:
            break
        level = new
    return s.select("source", "source_size", F.least(F.col("weight") * F.lit(level), F.col("limit")).alias("target"))


def _thresholds(sizes: DataFrame, goal: DataFrame) -> DataFrame:
    """(source, passes, cut): whole passes, and the hash prefix (of
    ``BITS * LEVELS`` bits) below which documents are taken once more."""
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = goal.select("source", passes.cast("long").alias("passes"),
                        (F.col("target") - passes * F.col("source_size")).alias("need"), F.lit(0).cast("long").alias("prefix"))
    total = BITS * LEVELS
    for level in range(LEVELS):
        state = stage(state, "cuts")
        shift = total - BITS * (level + 1)
        inside = sizes.join(state.select(F.col("source").alias("s"), "prefix"), F.col("source").eqNullSafe(F.col("s")))
        if level:
            inside = inside.filter(F.shiftright("hash", shift + BITS) == F.col("prefix"))
        hist = inside.groupBy("s", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("words")).filter("words > 0")
        run = hist.join(state.withColumnRenamed("source", "t"), F.col("s").eqNullSafe(F.col("t")))
        run = run.withColumn("upto", F.sum("words").over(W.partitionBy("s").orderBy("bucket")))
        last = level == LEVELS - 1
        # the first bucket that reaches the need; on the last level the nearer side of it
        edge = run.filter("upto >= need").groupBy("s").agg(F.min(F.struct("bucket", "upto", "words")).alias("e"))
        found = state.join(edge, F.col("source").eqNullSafe(F.col("s")), "left")
        low = F.col("need") - (F.col("e.upto") - F.col("e.words"))
        none = F.col("e").isNull()
        if last:
            over = F.col("e.upto") - F.col("need")
            cut = F.when(none, F.shiftleft(F.col("prefix") + 1, BITS)).when(over < low, F.col("e.bucket") + 1).otherwise(F.col("e.bucket"))
            return found.select("source", "passes", F.when(F.col("need") > 0, cut).otherwise(F.lit(0)).cast("long").alias("cut"))
        state = found.select(
            "source", "passes", F.when(none, F.col("need")).otherwise(low).alias("need"),
            F.when(none, F.shiftleft(F.col("prefix") + 1, BITS) - 1).otherwise(F.col("e.bucket")).cast("long").alias("prefix"))
    raise AssertionError("no level")


def sizes_of(docs: DataFrame, seed: int = 4) -> DataFrame:
    """(doc_id, source, size, hash): words, and the hash's leading bits."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), _hash(seed).alias("hash"))


def _hash(seed: int):
    """The leading bits of a row's hash: by its id, or by its text without one."""
    h = F.when(F.col("doc_id").isNull(), F.xxhash64(F.col("text"), F.lit(seed), F.lit("text"))).otherwise(F.xxhash64(F.col("doc_id"), F.lit(seed)))
    return F.shiftrightunsigned(h, 64 - BITS * LEVELS)


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 4) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: how often
    the mix takes each document, never more than ``most`` times."""
    sizes = stage(sizes_of(docs, seed), "sizes")
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = stage(targets(per, weights, share, most), "targets")
    cuts = _thresholds(sizes, goal)
    plan = stage(goal.join(cuts.select(F.col("source").alias("s"), "passes", "cut"), F.col("source").eqNullSafe(F.col("s"))).drop("s"), "plan")
    out = sizes.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    copies = F.col("passes") + F.when(F.col("hash") < F.col("cut"), 1).otherwise(0)
    copies = F.least(copies, F.lit(int(most))).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def op4(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 4) -> DataFrame:
    """``docs`` with a column ``copies`` (how often the mix takes the row);
    rows that it never takes go.  The cut is applied to the rows where they
    are: no text is shuffled by it."""
    cols = docs.columns
    name = free(cols, "copies")
    own, passes, cut = (free([*cols, name], c) for c in ("mix_source", "mix_passes", "mix_cut"))
    sizes = stage(sizes_of(docs, seed), "sizes")
    goal = stage(targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "targets")
    plan = _thresholds(sizes, goal)
    plan = stage(plan.select(F.col("source").alias(own), F.col("passes").alias(passes), F.col("cut").alias(cut)), "plan")
    out = docs.join(plan, F.col("source").eqNullSafe(F.col(own)))
    copies = F.least(F.col(passes) + F.when(_hash(seed) < F.col(cut), 1).otherwise(0), F.lit(int(most))).cast("long")
    return out.withColumn(name, copies).filter(F.col(name) > 0).select(*cols, name)
