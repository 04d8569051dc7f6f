"""Versioned publishing: readers see whole versions only.

A publication is a folder of one or more tables, each partitioned by season:

* ``data/<run>/<table>/<column>=<season>/`` - what one run wrote, never changed
  afterwards;
* ``commits/<number>.json`` - the commit marker.  It names, for every table and
  season, the run that holds its rows (or none: the season is empty), with the
  tables' schemas.

``publish`` first writes the data of the seasons asked for, under a new run,
and then puts down the next marker in one step, which fails if another writer
took the number; it then merges into that writer's marker and tries again.
Readers follow the highest marker.  A run that dies before its marker leaves
files that no reader looks at; ``vacuum`` removes them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binyard.sources.storage import Folder

_TRIES = 50


def _number(name: str) -> int | None:
    stem = name.removesuffix(".json")
    return int(stem) if name.endswith(".json") and stem.isdigit() else None


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed versions, oldest first."""
    return sorted(n for name in Folder(spark, path).names("commits") if (n := _number(name)) is not None)


def marker(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The commit marker of a version; the latest by default."""
    if version is None:
        version = next(reversed(versions(spark, path)), None)
        if version is None:
            return None
    text = Folder(spark, path).read(f"commits/{version:012d}.json")
    if text is None:
        raise ValueError(f"{path} has no version {version}")
    return json.loads(text)


def publish(spark: SparkSession, path: str, tables: Mapping[str, tuple[DataFrame, str]],
            seasons: Iterable[int]) -> int:
    """Publish the rows of ``seasons`` of each ``name: (frame, season column)``
    as one version; other seasons stay as they are.  A season without rows
    becomes empty.  Rows of a season that was not asked for are an error: they
    would replace nothing.  Returns the version."""
    path, run = path.rstrip("/"), uuid.uuid4().hex
    asked = sorted({str(int(s)) for s in seasons})
    part = {}
    for name, (df, column) in tables.items():
        if column not in df.columns:
            raise ValueError(f"{name} has no season column {column}: {df.columns}")
        seen = Observation()
        text = F.col(column).cast("string")
        (df.observe(seen, F.collect_set(text).alias("seasons"), F.count(F.when(text.isNull(), 1)).alias("none"))
         .write.partitionBy(column).parquet(f"{path}/data/{run}/{name}"))
        found = seen.get
        if extra := sorted(set(found["seasons"] or []) - set(asked)) + ["no season"] * bool(found["none"]):
            raise ValueError(f"{name} has rows of {extra}, asked for {asked}")
        part[name] = {"column": column, "schema": df.schema.jsonValue(),
                      "seasons": {s: run if s in (found["seasons"] or []) else None for s in asked}}
    return _commit(spark, path, part, asked)


def _commit(spark: SparkSession, path: str, part: dict, asked: list[str]) -> int:
    for _ in range(_TRIES):
        last = marker(spark, path) or {"version": 0, "tables": {}}
        tables = dict(last["tables"])
        for name, new in part.items():
            old = tables.get(name, {"seasons": {}})
            rest = {s: run for s, run in old["seasons"].items() if s not in new["seasons"]}
            if any(rest.values()) and (old["schema"] != new["schema"] or old["column"] != new["column"]):
                raise ValueError(f"{name} has another schema in seasons {sorted(rest)}")
            tables[name] = {**new, "seasons": {**rest, **new["seasons"]}}
        version = last["version"] + 1
        try:
            Folder(spark, path).create(f"commits/{version:012d}.json",
                                       json.dumps({"version": version, "refreshed": asked, "tables": tables}))
            return version
        except FileExistsError:
            continue
    raise RuntimeError(f"{path}: other writers took {_TRIES} versions in a row")


def read(spark: SparkSession, path: str, name: str, seasons: Iterable[int] | None = None,
         version: int | None = None) -> DataFrame:
    """A table of a publication, as of a version: all seasons it has, or those
    asked for (each must have been published, be it empty)."""
    found = marker(spark, path, version)
    if found is None or name not in found["tables"]:
        raise ValueError(f"{path} has no published {name}")
    own = found["tables"][name]
    schema, column = T.StructType.fromJson(own["schema"]), own["column"]
    wanted = sorted(own["seasons"]) if seasons is None else sorted({str(int(s)) for s in seasons})
    if missing := [s for s in wanted if s not in own["seasons"]]:
        raise ValueError(f"{name}: seasons {missing} were never published")
    runs: dict[str, list[str]] = {}
    for s in wanted:
        if own["seasons"][s]:
            runs.setdefault(own["seasons"][s], []).append(s)
    out = None
    for run, held in sorted(runs.items()):
        df = spark.read.schema(schema).parquet(f"{path.rstrip('/')}/data/{run}/{name}")
        kind = schema[column].dataType
        df = df.filter(F.col(column).isin([s if isinstance(kind, T.StringType) else int(s) for s in held])).select(schema.names)
        out = df if out is None else out.unionByName(df)
    return spark.createDataFrame([], schema) if out is None else out


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the last ``keep`` versions and the runs that none of
    them names, runs that never committed included; returns the runs' names.
    No writer may be at work."""
    folder, have = Folder(spark, path), versions(spark, path)
    kept = have[-max(keep, 1):]
    used = {run for v in kept for t in marker(spark, path, v)["tables"].values() for run in t["seasons"].values() if run}
    gone = [run for run in folder.names("data") if run not in used]
    for v in have[: len(have) - len(kept)]:
        folder.delete(f"commits/{v:012d}.json")
    for run in gone:
        folder.delete(f"data/{run}")
    return gone
