"""Order-insensitive comparison of a Spark result with DuckDB SQL output."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())


def rows_of_duck(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(_norm(r[i]) for i in order) for r in cur.fetchall())


def compare(df, con, sql):
    """Return a list of differences (empty when equal)."""
    sc, sr = rows_of_spark(df)
    dc, dr = rows_of_duck(con, sql)
    problems = []
    if sc != dc:
        problems.append(f"columns differ: spark={sc} duck={dc}")
        return problems
    if sum(sr.values()) != sum(dr.values()):
        problems.append(f"row count spark={sum(sr.values())} duck={sum(dr.values())}")
    only_s, only_d = sr - dr, dr - sr
    if only_s or only_d:
        problems.append(f"{sum(only_s.values())} spark-only rows e.g. {list(only_s)[:2]}; "
                        f"{sum(only_d.values())} duck-only rows e.g. {list(only_d)[:2]}")
    return problems
