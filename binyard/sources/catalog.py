"""Catalogs: resolve ``(generation, table)`` to a schema-checked DataFrame.

The reports never open a source themselves; they ask a catalog.  Three
implementations share one conform step:

* ``ParquetCatalog`` – ``<root>/<generation>/<table>`` Parquet datasets (the
  production layout; fact tables are best partitioned by ``SeasonID`` so the
  season filter prunes whole directories).
* ``JdbcCatalog`` – a live ERP database per generation over JDBC.  Options
  (URL, user, password, driver) come from the caller's configuration.
* ``FrameCatalog`` – DataFrames already in hand (tests, derived views).

``conform`` selects exactly the declared columns and casts them to the
declared types (a no-op Catalyst removes when types already agree; DECIMAL
from a server becomes double here), so column pruning still reaches the scan.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binyard.config import CURRENT, DEFAULT_CONFIG, ReportConfig
from binyard.functions.semantics import (
    season_bands, season_text_filter, timestamp_season_filter, year_season_filter,
)
from binyard.operators.joins import attach
from binyard.sources.schemas import (
    BATCH_SEASON, BOUNDED, CREATED, CREATED_YEAR, DERIVED, EXPORT_BATCH, EXPORTED, FACTS,
    PALLET_SEASON, schema_of,
)
from binyard.sources.storage import Folder


def conform(df: DataFrame, generation: str, name: str) -> DataFrame:
    schema = schema_of(generation, name)
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"{generation}.{name} lacks columns {missing}")
    if all(have[f.name] == f.dataType for f in schema.fields):
        return df.select([f.name for f in schema.fields])
    return df.select([F.col(f.name) if have[f.name] == f.dataType
                      else F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _sql_literal(v, dt: T.DataType) -> str:
    if v is None:
        return f"CAST(NULL AS {dt.simpleString()})"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(dt, T.DoubleType):
        return f"CAST('{float(v)!r}' AS DOUBLE)"
    return f"CAST({int(v)} AS {dt.simpleString()})"


def local_table(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A small literal table as an inline ``VALUES`` relation.

    Unlike ``createDataFrame`` (an RDD scan, one Spark job per use), an inline
    table is a local relation: broadcasting it runs no job and Catalyst can
    fold it.  Meant for code lists of a few dozen rows.
    """
    names = [f.name for f in schema.fields]
    values = ", ".join("(" + ", ".join(_sql_literal(v, f.dataType) for v, f in zip(r, schema.fields))
                       + ")" for r in rows)
    cols = ", ".join(f"CAST({n} AS {f.dataType.simpleString()}) AS {n}"
                     for n, f in zip(names, schema.fields))
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({', '.join(names)})")


# Row width per type; texts of the ERP's code and name columns stay below 64 bytes.
_WIDTHS = {T.LongType: 8, T.DoubleType: 8, T.IntegerType: 4, T.DateType: 4, T.BooleanType: 1,
           T.TimestampNTZType: 8, T.StringType: 64}
_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30,
          "gb": 1 << 30}


def _bytes(text: str) -> int:
    text = str(text).strip().lower()
    digits = text.rstrip("bkmg")
    unit = text[len(digits):] or "b"
    return int(float(digits) * _UNITS[unit])


class Catalog:
    """Base class: subclasses implement ``_load``."""

    spark: SparkSession

    def _load(self, generation: str, name: str) -> DataFrame:  # pragma: no cover
        raise NotImplementedError

    def table(self, generation: str, name: str) -> DataFrame:
        """Conformed table; built once per catalog (DataFrames are immutable plans)."""
        cache = self.__dict__.setdefault("_conformed", {})
        key = (generation, name)
        if key not in cache:
            cache[key] = conform(self._load(generation, name), generation, name)
        return cache[key]

    def created_in(self, generation: str, name: str, seasons, config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
        """Rows of a table created in the requested seasons' years."""
        return self.table(generation, name).filter(timestamp_season_filter(CREATED, seasons, config))

    def pallets_created_in(self, seasons, config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
        """Current pallets created in the seasons, with ``_exported``: whether
        an export row of any time names the pallet."""
        pallets = self.created_in(CURRENT, "ma_Pallet_DetailT", seasons, config)
        exported = (self.table(CURRENT, "ma_Export_Bin_DetailT").select("PalletDetailID").distinct()
                    .withColumn("_exported", F.lit(True)))
        return attach(pallets, exported, "PalletDetailID").withColumn("_exported", F.col("_exported").isNotNull())

    def export_batches(self, seasons, config: ReportConfig = DEFAULT_CONFIG) -> DataFrame | None:
        """(GraderBatchID, PalletDetailID, KGWeight, CreatedDateTime) of the
        export rows created in the seasons; None where they are not staged."""
        return None

    def batch_ids(self, seasons) -> DataFrame | None:
        """Ids of the current batches whose season text is requested, each
        once, as one scan; None where no such list is staged."""
        return None

    def batch_pallets(self, seasons) -> DataFrame | None:
        """(PalletDetailID, GraderBatchID, ProductID) of the pallets of those
        batches, as one scan; None where they are not staged."""
        return None

    #: Largest code list (rows) that is broadcast by hint.
    broadcast_row_limit: int = 100_000

    @staticmethod
    def is_bounded(name: str) -> bool:
        """True for code lists whose size does not grow with the data."""
        return name in BOUNDED

    def broadcast_ok(self, generation: str, name: str) -> bool:
        """Size check before a broadcast hint: the table must be a declared code
        list AND be known, without a Spark job, to hold at most
        ``broadcast_row_limit`` rows (``row_bound``).  Where no bound is known
        Spark decides from its own sizes."""
        if not self.is_bounded(name):
            return False
        rows = self.row_bound(generation, name)
        return rows is not None and rows <= self.broadcast_row_limit

    def known_rows(self) -> dict:
        """Exact row counts a catalog knows without reading (e.g. literal code
        lists); they stand as the size proof.  None known by default."""
        return {}

    def row_bound(self, generation: str, name: str) -> int | None:
        """An upper bound on a source table's rows, when known without a Spark
        job (e.g. from file metadata); None when unknown."""
        return self.known_rows().get((generation, name))

    def fits_broadcast(self, df: DataFrame, upper_rows: int | None) -> bool:
        """Proven size bound for broadcasting a derived frame: ``upper_rows``,
        a known upper bound on its rows (e.g. the base table of a flattened
        dimension whose lookups join on unique keys), times the row width of
        its schema stays under ``spark.sql.autoBroadcastJoinThreshold``.
        Needed because without CBO Spark estimates a join's output as the
        product of its inputs, so a flattened dimension or a filtered key list
        would never be broadcast automatically.  Without a bound the answer is
        no, and Spark plans by its own sizes; no job is ever started."""
        if upper_rows is None:
            return False
        threshold = _bytes(self.spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))
        width = sum(_WIDTHS.get(type(f.dataType), 64) for f in df.schema.fields) or 1
        return upper_rows * width <= threshold

    def broadcast_if_small(self, df: DataFrame, upper_rows: int | None) -> DataFrame:
        """``df`` with a broadcast hint if ``fits_broadcast``; else unchanged
        (Spark then plans a shuffle join)."""
        return F.broadcast(df) if self.fits_broadcast(df, upper_rows) else df

    def dim(self, generation: str, name: str) -> DataFrame:
        """A lookup table, broadcast-hinted only when ``broadcast_ok``; otherwise
        Spark decides from measured sizes (auto-broadcast threshold, AQE) and
        falls back to a shuffle join."""
        df = self.table(generation, name)
        return F.broadcast(df) if self.broadcast_ok(generation, name) else df


class ParquetCatalog(Catalog):
    """A staged catalog.  ``MANIFEST`` at its root, written by
    ``sinks.write_catalog``, holds every table's row count: size proofs read
    that one small file, whatever the storage and the number of data files.
    Without a manifest nothing is known, and Spark plans by its own sizes."""

    MANIFEST = "manifest.json"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _raw(self, generation, name):
        cache = self.__dict__.setdefault("_read", {})
        key = (generation, name)
        if key not in cache:
            if self.row_bound(generation, name) == 0:  # an empty partitioned table has no file
                cache[key] = self.spark.createDataFrame([], DERIVED.get(name) or schema_of(generation, name))
            else:
                cache[key] = self._open(generation, name)
        return cache[key]

    def _open(self, generation, name):
        path = f"{self.root}/{generation}/{name}"
        found = self.manifest().get(generation, {}).get(name, {})
        if "buckets" not in found:
            return self.spark.read.schema(DERIVED[name]).parquet(path) if name in DERIVED else self.spark.read.parquet(path)
        # bucketed files mean something only to a table that knows its buckets
        table = self.bucket_table(generation, name)
        if not self.spark.catalog.tableExists(table):
            schema = T.StructType.fromJson(found["schema"])
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            part = f"PARTITIONED BY ({found['partition']})" if found["partition"] else ""
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {part} CLUSTERED BY ({found['by']}) "
                           f"SORTED BY ({found['by']}) INTO {found['buckets']} BUCKETS LOCATION '{path}'")
            if part:
                self.spark.catalog.recoverPartitions(table)
        return self.spark.table(table)

    def bucket_table(self, generation, name) -> str:
        """The session's name for a bucketed table of this catalog."""
        return f"binyard_{hashlib.sha256(self.root.encode()).hexdigest()[:12]}_{generation}_{name}".lower()

    def _load(self, generation, name):
        # conform() restores the declared column order and types (a partition
        # column such as SeasonID comes back last, as discovered).
        return self._raw(generation, name)

    def created_in(self, generation, name, seasons, config=DEFAULT_CONFIG):
        """Where the table is staged by creation year, the bands are a filter
        of that partition column too: other years' folders are not listed."""
        raw = self._raw(generation, name)
        if CREATED_YEAR not in raw.columns:
            return super().created_in(generation, name, seasons, config)
        return conform(self._years(raw, seasons, config), generation, name)

    @staticmethod
    def _years(raw, seasons, config):
        return raw.filter(year_season_filter(CREATED_YEAR, seasons, config) & timestamp_season_filter(CREATED, seasons, config))

    def pallets_created_in(self, seasons, config=DEFAULT_CONFIG):
        """Where the pallets are staged with the flag, nothing is joined."""
        raw = self._raw(CURRENT, "ma_Pallet_DetailT")
        if EXPORTED not in raw.columns:
            return super().pallets_created_in(seasons, config)
        return self._years(raw, seasons, config).drop(CREATED_YEAR).withColumnRenamed(EXPORTED, "_exported")

    def export_batches(self, seasons, config=DEFAULT_CONFIG):
        if EXPORT_BATCH not in self.manifest().get(CURRENT, {}):
            return None
        return self._years(self._raw(CURRENT, EXPORT_BATCH), seasons, config).drop(CREATED_YEAR)

    def manifest(self) -> dict:
        """``{generation: {table: {"rows": n, ...}}}``, with the buckets of a
        bucketed table; read once, empty without one."""
        if "_manifest" not in self.__dict__:
            text = Folder(self.spark, self.root).read(self.MANIFEST)
            self._manifest = json.loads(text)["tables"] if text else {}
        return self._manifest

    def row_bound(self, generation, name):
        found = self.manifest().get(generation, {}).get(name)
        return None if found is None else found["rows"]

    def _derived(self, name, seasons):
        if name not in self.manifest().get(CURRENT, {}):
            return None
        return self._raw(CURRENT, name).filter(season_text_filter("SeasonDesc", seasons)).drop("SeasonDesc")

    def batch_ids(self, seasons):
        return self._derived(BATCH_SEASON, seasons)

    def batch_pallets(self, seasons):
        return self._derived(PALLET_SEASON, seasons)


class JdbcCatalog(Catalog):
    """One JDBC source per generation: ``options[generation]`` holds the
    reader options (``url``, ``user``, ``password``, ``driver``...).

    A plain JDBC read is ONE task over one connection, so a fact table is
    always read in splits.  They are planned from what the reports know:

    * a table with a season code is split by the season map, one predicate per
      code, and one for all other codes and NULL;
    * a table with a creation time is split by the years of the season bands,
      and one predicate for all other times and NULL;
    * ``ids[(generation, name)] = (lower, upper, parts)`` cuts each of these
      splits - or, for a table with neither, the whole - into ranges of the
      table's id column (``schemas.FACTS``), open at both ends, NULL ids in
      the first.

    The splits of a table are disjoint and cover every row.  Explicit
    ``partitioning``, keyed by table name or ``(generation, name)``, overrules
    the planner: ``{"partitionColumn": ..., "lowerBound": ..., "upperBound":
    ..., "numPartitions": ...}`` or ``{"predicates": [...]}``.  A fact table
    without any of these raises instead of becoming one task.

    Simple filters of the reports (season codes, flags, id ranges) are still
    pushed into each split's WHERE clause by Spark.
    """

    def __init__(self, spark: SparkSession, options: Mapping[str, Mapping[str, str]],
                 partitioning: Mapping | None = None, rows: Mapping | None = None,
                 ids: Mapping | None = None, config: ReportConfig = DEFAULT_CONFIG):
        """``rows``: upper bounds on tables' rows, keyed by (generation, name),
        which prove that a broadcast fits."""
        self.spark, self.options, self.rows = spark, options, dict(rows or {})
        self.partitioning, self.ids, self.config = dict(partitioning or {}), dict(ids or {}), config

    def known_rows(self) -> dict:
        return self.rows

    def splits(self, generation: str, name: str) -> list[str]:
        """Predicates that cut a fact table; none for a lookup."""
        if (generation, name) not in FACTS:
            return []
        columns = schema_of(generation, name).fieldNames()
        if "SeasonID" in columns:
            codes = sorted(self.config.season_codes[generation])
            first = [f"SeasonID = {c}" for c in codes]
            first.append(f"SeasonID IS NULL OR SeasonID NOT IN ({', '.join(map(str, codes))})")
        elif CREATED in columns:
            bands = [b for y in self.config.timestamp_seasons for b in season_bands([y], self.config)]
            day = "'{:04d}-01-01T00:00:00'".format
            first = [f"{CREATED} >= {day(a)} AND {CREATED} < {day(b)}" for a, b in bands]
            first.append(" AND ".join([f"NOT ({x})" for x in first]) + f" OR {CREATED} IS NULL")
        else:
            first = []
        ranges = id_ranges(FACTS[(generation, name)], *self.ids[(generation, name)]) if (generation, name) in self.ids else []
        if first and ranges:
            return [f"({a}) AND ({b})" for a in first for b in ranges]
        return first or ranges

    def read_plan(self, generation: str, name: str) -> dict:
        """Reader options for one table (exposed for inspection and tests)."""
        part = self.partitioning.get((generation, name), self.partitioning.get(name, {}))
        # the ERP's timestamps are wall-clock: never shifted by a zone
        opts = {"preferTimestampNTZ": "true", **self.options[generation], "dbtable": name}
        opts.update({k: str(v) for k, v in part.items() if k != "predicates"})
        predicates = list(part.get("predicates", []))
        if not part:
            predicates = self.splits(generation, name)
            if not predicates and (generation, name) in FACTS:
                raise ValueError(f"{generation}.{name} grows with the data and would be read by one task: "
                                 f"give the bounds of {FACTS[(generation, name)]} in ids, or its partitioning")
        return {"options": opts, "predicates": predicates}

    def _load(self, generation, name):
        plan = self.read_plan(generation, name)
        if plan["predicates"]:
            opts = dict(plan["options"])
            url, table = opts.pop("url"), opts.pop("dbtable")
            return self.spark.read.jdbc(url, table, predicates=plan["predicates"],
                                        properties=opts)
        return self.spark.read.format("jdbc").options(**plan["options"]).load()


def id_ranges(column: str, lower: int, upper: int, parts: int) -> list[str]:
    """``parts`` predicates on an integer column, near even between ``lower``
    and ``upper``; the outer two are open, and NULL is in the first."""
    if parts < 1 or upper < lower:
        raise ValueError(f"no ranges of {column}: {lower} to {upper} in {parts}")
    cuts = sorted({lower + (upper - lower + 1) * i // parts for i in range(1, parts)} - {lower})
    if not cuts:
        return [f"{column} IS NULL OR {column} IS NOT NULL"]
    return ([f"{column} < {cuts[0]} OR {column} IS NULL"]
            + [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
            + [f"{column} >= {cuts[-1]}"])


class FrameCatalog(Catalog):
    """Tables given as DataFrames or as zero-argument factories."""

    def __init__(self, spark: SparkSession,
                 tables: Mapping[tuple[str, str], DataFrame | Callable[[], DataFrame]]):
        self.spark, self._tables, self._cache = spark, dict(tables), {}

    def _load(self, generation, name):
        key = (generation, name)
        if key not in self._cache:
            src = self._tables[key]
            self._cache[key] = src() if callable(src) else src
        return self._cache[key]
