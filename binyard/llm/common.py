"""Shared helpers of the training-data operators: staging, worker imports,
connected components.

Nothing here collects documents, links or fingerprints to the driver: the
driver sees single aggregated rows only.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of every contract: runs of characters other than space and \t..\r.
WORD = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(col):
    """A-Z to a-z and nothing else (``lower`` would fold all of Unicode)."""
    return F.translate(col, _UPPER, _LOWER)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's checkout.

    On a cluster the package comes with ``--py-files``; where the checkout
    exists at the same path this adds it to the workers' PYTHONPATH."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([*have, root])


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset and the master is local (tests), a folder of the
    process's own is set, and removed at exit."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = getattr(shared_dir, "own", None)
    if path is None:
        path = shared_dir.own = tempfile.mkdtemp(prefix="binyard-llm-")
        atexit.register(shutil.rmtree, path, True)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, and a
    lost executor costs nothing, because the files are not its own."""
    return staged(df, label)[0]


_MADE: list[list[str]] = []


@contextmanager
def scratch() -> Iterator[list[str]]:
    """The folders of all tables staged inside the block, in order."""
    made: list[str] = []
    _MADE.append(made)
    try:
        yield made
    finally:
        _MADE.remove(made)


def staged(df: DataFrame, label: str, compression: str = "snappy", by: str | None = None) -> tuple[DataFrame, str]:
    """``stage`` and the table's folder, for ``discard``; with a folder for
    each value of ``by``."""
    path = f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}/{label}"
    write = df.write.option("compression", compression)
    for made in _MADE:
        made.append(path)
    (write.partitionBy(by) if by else write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more: what came from it is
    itself staged."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder.getParent(), True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(columns, name: str) -> str:
    """``name``, or with underscores after it, as none of ``columns`` is called
    (in any case: Spark compares names without it)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_mod(doc_id, m: int):
    """crc32 of the id as text, modulo ``m``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string")) % F.lit(m)


def _is_stars(edges: DataFrame) -> bool:
    """Every ``hi`` hangs on one ``lo`` and no ``lo`` is itself a ``hi``."""
    ends = edges.select(F.col("hi").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("lo").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    bad = per.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))
    return bad.agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """(lo, hi) links, lo < hi, to (node, component): the smallest node
    reachable.  Only nodes with a link are returned.

    Alternating large-star and small-star rounds; each is a grouped minimum
    (map-side partial, so a node with very many links costs no more) and an
    equi-join that adaptive execution may split.  Every round is staged; the
    number of rounds is logarithmic in the size of the largest component."""
    edges = stage(edges.select("lo", "hi").distinct(), "links")
    while not _is_stars(edges):
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(
            edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(least, "u")
                 .select(F.col("m").alias("lo"), F.col("v").alias("hi")).filter("lo < hi").distinct())
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        small = (small.select(F.col("m").alias("lo"), "hi").unionByName(
            small.select(F.col("m").alias("lo"), F.col("lo").alias("hi")))
            .filter("lo < hi").distinct())
        edges = stage(small, "links")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())


def merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    """``comp`` (node, component) after further links (lo, hi).  Only the
    components that the links join are worked on, each as one node, so what is
    known already is not computed again."""
    ends = links.select("lo", "hi")
    for c in ("lo", "hi"):
        own = comp.select(F.col("node").alias(c), F.col("component").alias("own"))
        ends = ends.join(own, c, "left").withColumn(c, F.coalesce("own", c)).drop("own")
    ends = ends.filter("lo <> hi").select(F.least("lo", "hi").alias("lo"), F.greatest("lo", "hi").alias("hi"))
    joined = stage(components(ends), "joined")
    now = joined.select(F.col("node").alias("component"), F.col("component").alias("now"))
    known = comp.join(now, "component", "left").select("node", F.coalesce("now", "component").alias("component"))
    return stage(known.unionByName(joined.join(comp, "node", "left_anti").select("node", "component")), "components")
