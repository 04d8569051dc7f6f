"""Operator 9: line dedup by distinct-site spread.

A line's spread is the number of different sites (``documents.source``) that
hold it.  HyperLogLog sketches of the sites per line hash are built and merged
by aggregation.  Lines whose estimate is near the threshold get an exact
distinct count; the sketch alone decides for the others.  A line on as many
sites as its bar asks is cross-site boilerplate and goes from every document
but the one with the smallest id that holds it, so a passage that many copies
share is not lost altogether.

The bar falls with the line's words: ``MIN_SITES`` for ``MIN_WORDS`` words, then
so many that sites times words is as large, and ``FEW_SITES`` for a passage of
ten words or more.  A line of fewer than ``MIN_WORDS`` words, which may recur by
chance, needs ``SHORT_STEP`` sites more for each word that it lacks.

Lines are compared without white space at their ends; blank lines do not
count.  Only hashes, ids and places of lines are shuffled for the counts; the
texts move once, to meet the places to be cut.

Edge cases: a null source is a site of its own; a null text has no lines and
stays null; blank lines stay; rows of one id hold a line together (if it is
kept for the id, it is kept in all its rows); null ids are the largest; a
repeated row is cut like the first; an empty table gives no rows; further
columns are ignored by ``spread_cut`` and kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binyard.llm.common import WORD, free, ship, stage

MIN_SITES = 10
MIN_WORDS = 4
#: Sites that even the longest passage needs: fewer are copies of one document.
FEW_SITES = 4
#: Sites more for each word below MIN_WORDS.
SHORT_STEP = 2
#: Sketch size (2**10 buckets: 3.25 % standard error) and the half-width of
#: the band around the threshold that is counted exactly (5 errors).
LG_K = 10
BAND = 0.17

_ENDS = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"
_TOP = 2**63 - 1

#: Words of a line to the sites it needs, null if it is never boilerplate.
Bar = Callable[[Column], Column]


def by_length(words: Column) -> Column:
    """The longer a line, the fewer sites; a line without words never counts."""
    product = F.ceil(F.lit(MIN_SITES * MIN_WORDS) / words).cast("int")
    short = (F.lit(MIN_SITES) + SHORT_STEP * (F.lit(MIN_WORDS) - words)).cast("int")
    return F.when(words >= MIN_WORDS, F.greatest(product, F.lit(FEW_SITES))).when(words >= 1, short)


def _lines(docs: DataFrame, bar: Bar) -> DataFrame:
    """(doc, text_hash, pos, line, site, need) of every line that may be boilerplate."""
    site = F.when(F.col("source").isNull(), F.lit(0)).otherwise(F.xxhash64("source"))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_TOP)).alias("doc"), F.xxhash64("text").alias("text_hash"),
                       site.alias("site"), F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    rows = rows.withColumn("need", bar(F.regexp_count("raw", F.lit(WORD)))).filter("need is not null")
    return rows.select("doc", "text_hash", "pos", F.xxhash64(F.regexp_replace("raw", _ENDS, "")).alias("line"), "site", "need")


def boilerplate(lines: DataFrame) -> DataFrame:
    """(line, keeper): boilerplate lines and the document that keeps each."""
    per = lines.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"),
                                    F.min("doc").alias("keeper"), F.max("need").alias("need"))
    per = stage(per.filter(F.col("sites") >= F.col("need") * (1 - BAND)), "spread")
    sure = F.col("sites") > F.col("need") * (1 + BAND)
    near = per.filter(~sure)
    exact = (lines.join(near.select("line"), "line", "left_semi").select("line", "need", "site").distinct()
             .groupBy("line").agg(F.count("*").alias("n"), F.max("need").alias("need")).filter("n >= need"))
    return per.filter(sure).select("line", "keeper").unionByName(
        near.join(exact.select("line"), "line", "left_semi").select("line", "keeper"))


def _cut(columns: list[str], places_: str, removed_: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = batch.column("text").to_pylist(), []
            for i, places in enumerate(batch.column(places_).to_pylist()):
                removed.append(0)
                if places:
                    gone = set(places)
                    lines = texts[i].split("\n")
                    texts[i] = "\n".join(x for j, x in enumerate(lines) if j not in gone)
                    removed[-1] = len(gone)
            arrays = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(removed, pa.int64())], names=[*columns, removed_])
    return run


def spread_cut(docs: DataFrame, bar: Bar = by_length, removed: str = "removed") -> DataFrame:
    """``docs`` with the boilerplate lines cut from ``text``, and a column
    ``removed`` (how many lines went), whose name must be free."""
    ship(docs.sparkSession)
    cols = docs.columns
    doc, text, places = (free([*cols, removed], c) for c in ("doc", "text_hash", "places"))
    docs = docs.withColumn("text", F.col("text").cast("string"))
    lines = stage(_lines(docs.select("doc_id", "source", "text"), bar), "lines")
    found = boilerplate(lines)
    # every row of an id that repeats a text has the same places: once is enough
    cuts = (lines.join(found, "line").filter("doc <> keeper").groupBy(F.col("doc").alias(doc), F.col("text_hash").alias(text))
            .agg(F.collect_set("pos").alias(places)))
    keyed = docs.withColumn(doc, F.coalesce(F.col("doc_id").cast("long"), F.lit(_TOP))).withColumn(text, F.xxhash64("text"))
    # a merge join at every size: the cuts grow with the corpus and are no broadcast
    out = keyed.join(cuts.hint("merge"), [doc, text], "left").select(*cols, places)
    schema = docs.select(*[F.col(c) for c in cols], F.lit(0).cast("long").alias(removed)).schema
    return out.mapInArrow(_cut(cols, places, removed), schema)


def clean(docs: DataFrame, bar: Bar = by_length) -> DataFrame:
    """``docs`` without boilerplate lines (``n_chars``, where there is such a
    column, follows); a document that loses all its words that way goes: each
    of its lines is kept elsewhere."""
    gone = free(docs.columns, "removed")
    out = spread_cut(docs, bar, gone)
    out = out.filter((F.col(gone) == 0) | F.col("text").rlike(WORD))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col(gone) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def op9(spark, sf_dir: str) -> DataFrame:
    """Every document without cross-site boilerplate lines."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    out = spread_cut(docs)
    n_lines = F.coalesce(F.regexp_count("text", F.lit("\n")) + 1, F.lit(0)) + F.col("removed")
    blank = (F.col("text") == "") & (F.col("removed") > 0)  # every line went
    return out.select("doc_id", F.when(blank, F.col("removed")).otherwise(n_lines).cast("long").alias("n_lines"),
                      F.col("removed").alias("n_removed"), "text")


ORACLE = r"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
w AS (SELECT doc_id, pos, raw, coalesce('s' || source, 'n') AS site, regexp_replace(raw, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line,
    len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) AS words FROM l),
b AS (SELECT line, min(doc_id) AS keeper FROM w WHERE words > 0 GROUP BY line
  HAVING count(DISTINCT site) >= max(CASE WHEN words >= 4 THEN greatest(ceil(40 / words), 4) ELSE 10 + 2 * (4 - words) END)),
f AS (SELECT w.doc_id, w.pos, w.raw, b.line IS NOT NULL AND w.doc_id <> b.keeper AS gone
  FROM w LEFT JOIN b ON w.line = b.line),
g AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(g.n_lines, 0)::BIGINT AS n_lines, coalesce(g.n_removed, 0)::BIGINT AS n_removed,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(g.text, d.text) END AS text
FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id
"""
