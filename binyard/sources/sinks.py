"""Sinks.

The reference returns its frame to the caller; here a report is a DataFrame
the caller writes, partitioned by season so later reads prune.

* ``publish_report`` / ``read_report`` - versioned: readers see a whole version
  or the one before it, never a half-written one (``sources.versions``).
* ``write_report`` - plain partitioned files for other tools; a reader beside
  it may see some seasons replaced and others not.
* ``write_catalog`` stages a whole ERP catalog as Parquet in the layout
  ``ParquetCatalog`` reads: tables with a season code partitioned by it, tables
  with a creation time by its year, so that the reports' season filters prune
  directories (``PartitionFilters``) instead of only row groups; keys checked,
  rows counted on the way into a manifest.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from binyard.config import CURRENT
from binyard.operators.joins import attach
from binyard.sources import versions
from binyard.sources.catalog import Catalog, ParquetCatalog
from binyard.sources.schemas import (
    BATCH_SEASON, BUCKETED, CREATED, CREATED_YEAR, EXPORT_BATCH, EXPORTED, KEYS, PALLET_SEASON, SCHEMAS,
)
from binyard.sources.storage import Folder


SEASON_COLUMNS = ("Season", "SeasonDesc")


def write_report(df: DataFrame, path: str, mode: str = "overwrite",
                 partition_col: str | None = None, fmt: str = "parquet",
                 seasons: Iterable[int] | None = None) -> None:
    """Write a report partitioned by its season column (``Season``;
    ``SeasonDesc`` for pack units).  Overwrites are dynamic: a run replaces
    only the seasons that it has rows of.  Pass the requested ``seasons`` so
    that one which has become empty is cleared too.

    Pack-out and defect share take fact seasons from the facts' own times, so
    a batch's figures depend on the set of seasons asked for together (T10):
    always ask for, and refresh, the same set, or keep a ``SeasonStore``."""
    if partition_col is None:
        partition_col = next((c for c in SEASON_COLUMNS if c in df.columns), None)
    if partition_col not in df.columns:
        raise ValueError(f"the report has no season column to partition by: {df.columns}")
    seen = Observation()
    df = df.observe(seen, F.collect_set(F.col(partition_col).cast("string")).alias("seasons"))
    (df.write.mode(mode).format(fmt).partitionBy(partition_col)
     .option("partitionOverwriteMode", "dynamic").save(path))
    if seasons is not None and mode == "overwrite":
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for season in sorted({str(s) for s in seasons} - set(seen.get["seasons"] or [])):
            folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{partition_col}={season}")
            folder.getFileSystem(conf).delete(folder, True)


REPORT = "report"


def publish_report(df: DataFrame, path: str, seasons: Iterable[int], partition_col: str | None = None) -> int:
    """Publish the report of ``seasons`` as a new version under ``path``; other
    seasons published before stay.  Returns the version's number.

    Pack-out, defect share and presize units depend on the set of seasons asked
    for together (T10); to refresh season by season, keep them in a
    ``plans.season_store.SeasonStore`` instead."""
    if partition_col is None:
        partition_col = next((c for c in SEASON_COLUMNS if c in df.columns), None)
    return versions.publish(df.sparkSession, path, {REPORT: (df, partition_col)}, seasons)


def read_report(spark: SparkSession, path: str, seasons: Iterable[int] | None = None,
                version: int | None = None) -> DataFrame:
    """A published report, by default its latest version and all its seasons."""
    return versions.read(spark, path, REPORT, seasons, version)


def check_key(df: DataFrame, key: str, label: str) -> None:
    """Raise if a non-NULL ``key`` occurs twice: a doubled lookup key multiplies
    every row that is joined to it, and voids the proof that a flattened
    dimension is no longer than its base table.  One grouped count, partial
    before its shuffle."""
    twice = (df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col(key).isNotNull() & (F.col("rows") > 1))
             .orderBy(F.desc("rows"), key).limit(3).collect())
    if twice:
        raise ValueError(f"{label}: {key} is not unique: " + ", ".join(f"{r[0]} ({r[1]} rows)" for r in twice))


def _layout(df: DataFrame) -> tuple[DataFrame, str | None]:
    """The frame with its partition column, if the table has one."""
    if "SeasonID" in df.columns:
        return df, "SeasonID"
    if CREATED in df.columns:
        return df.withColumn(CREATED_YEAR, F.year(CREATED)), CREATED_YEAR
    return df, None


def write_catalog(cat: Catalog, root: str, mode: str = "overwrite", check_keys: bool = True,
                  buckets: int | None = None) -> ParquetCatalog:
    """Write every ERP table of ``cat`` under ``root/<generation>/<table>``;
    beside them what the reports would otherwise join again and again: every
    current batch and its pallets by season text, every export row with the
    batch of its pallet, and on each pallet whether it was exported; and last
    the manifest, with the rows that each write observed.

    ``check_keys``: read each written key column back and raise if it is not
    unique (``schemas.KEYS``).  ``buckets``: deal the batch facts out by batch
    (``schemas.BUCKETED``) into so many files per partition, each sorted; what
    is grouped or joined by batch is then not exchanged.

    ``root`` must be shared storage on a cluster (for example a path under the
    cluster's ``spark.checkpoint.dir``), never an executor-local folder.
    """
    spark, root = cat.spark, root.rstrip("/")
    folder, counts = Folder(spark, root), {}
    folder.delete(ParquetCatalog.MANIFEST)  # a half-written catalog proves nothing
    out = ParquetCatalog(spark, root)
    out._manifest = counts  # grows as tables are written

    def write(gen: str, name: str, df: DataFrame, partition: str | None) -> None:
        seen, by = Observation(), BUCKETED.get((gen, name)) if buckets else None
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        w = (df.repartition(buckets, by) if by else df).write.mode(mode)
        w = w.partitionBy(partition) if partition else w
        if by:
            table = out.bucket_table(gen, name)
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            w.bucketBy(buckets, by).sortBy(by).option("path", f"{root}/{gen}/{name}").format("parquet").saveAsTable(table)
        else:
            w.parquet(f"{root}/{gen}/{name}")
        entry = {"rows": seen.get["rows"]}
        if by:
            order = [c for c in df.columns if c != partition] + [partition] * bool(partition)
            entry |= {"buckets": buckets, "by": by, "partition": partition, "schema": df.select(order).schema.jsonValue()}
        counts.setdefault(gen, {})[name] = entry

    for gen, tables in SCHEMAS.items():
        for name in tables:
            df, partition = _layout(cat.table(gen, name))
            if (gen, name) == (CURRENT, "ma_Pallet_DetailT"):
                flag = cat.table(CURRENT, "ma_Export_Bin_DetailT").select("PalletDetailID").distinct().withColumn(EXPORTED, F.lit(True))
                df = attach(df, flag, "PalletDetailID").withColumn(EXPORTED, F.col(EXPORTED).isNotNull())
            write(gen, name, df, partition)
            if check_keys and (gen, name) in KEYS:
                check_key(out.table(gen, name).select(KEYS[(gen, name)]), KEYS[(gen, name)], f"{gen}.{name}")
    season = out.table(CURRENT, "sw_SeasonT")
    batches = out.table(CURRENT, "ma_Grader_BatchT").select("GraderBatchID", "SeasonID").join(season, "SeasonID", "inner")
    batches = batches.select("GraderBatchID", "SeasonDesc")
    write(CURRENT, BATCH_SEASON, batches, "SeasonDesc")
    pallets = out.table(CURRENT, "ma_Pallet_DetailT").select("PalletDetailID", "GraderBatchID", "ProductID")
    write(CURRENT, PALLET_SEASON, pallets.join(batches, "GraderBatchID", "inner"), "SeasonDesc")
    exports = out.table(CURRENT, "ma_Export_Bin_DetailT").select("PalletDetailID", "KGWeight", CREATED)
    exports = exports.join(pallets.select("PalletDetailID", "GraderBatchID"), "PalletDetailID", "inner")
    write(CURRENT, EXPORT_BATCH, *_layout(exports.select("GraderBatchID", "PalletDetailID", "KGWeight", CREATED)))
    folder.replace(ParquetCatalog.MANIFEST, json.dumps({"tables": counts}))
    return ParquetCatalog(spark, root)
