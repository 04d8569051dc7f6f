"""Join operators used by the reports.

* ``lookup`` – many-to-one left join that attaches dimension attributes (J1,
  J2).  The dimension is narrowed to its key and the wanted attributes before
  the join.  A code list comes with its broadcast hint from ``Catalog.dim``.
  A lookup that grows with the data is left to Spark: it is broadcast only if
  its measured or estimated size is under
  ``spark.sql.autoBroadcastJoinThreshold`` (static plan, and again by AQE at
  runtime); otherwise it is a shuffle join.
* ``anti`` / ``semi`` – existence tests written as such (J4, J6); Spark does
  not rewrite "left join then IS NULL" into an anti join itself.
* ``attach`` – fact-to-header / measure-to-header left join on a shared key
  (J3, J8, J9): plain shuffle-or-broadcast as Spark decides, no hint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, dim: DataFrame, on: str | tuple[str, str], cols: Sequence[str],
           *, how: str = "left",
           rename: dict[str, str] | None = None) -> DataFrame:
    """Left-join ``dim``'s ``cols`` onto ``df``.

    ``on`` is a shared key name, or ``(df_key, dim_key)`` when the names
    differ; the result keeps ``df``'s key name (dplyr semantics).
    ``rename`` renames attributes on the way in (e.g. CompanyName -> owner).
    """
    left_key, right_key = (on, on) if isinstance(on, str) else on
    rename = rename or {}
    right = dim.select(F.col(right_key).alias(left_key),
                       *[F.col(c).alias(rename.get(c, c)) for c in cols])
    return df.join(right, on=left_key, how=how)


def anti(df: DataFrame, other: DataFrame, on: str | tuple[str, str]) -> DataFrame:
    """Rows of ``df`` with no match in ``other`` (left anti join)."""
    left_key, right_key = (on, on) if isinstance(on, str) else on
    return df.join(other.select(F.col(right_key).alias(left_key)), on=left_key, how="left_anti")


def semi(df: DataFrame, other: DataFrame, on: str | tuple[str, str]) -> DataFrame:
    """Rows of ``df`` with at least one match in ``other`` (left semi join).

    Equal to the reference's inner join against a key-only projection when
    that key is unique on the other side.
    """
    left_key, right_key = (on, on) if isinstance(on, str) else on
    return df.join(other.select(F.col(right_key).alias(left_key)), on=left_key, how="left_semi")


def keep_keys(df: DataFrame, keys: DataFrame, key: str, *, small: bool) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``keys``, each once however often the
    key is listed: the same rows on either path.

    ``small`` (a proven size bound, ``Catalog.fits_broadcast``): a broadcast
    left-semi join, i.e. a map-side filter that Catalyst may push below
    aggregates.  Otherwise an inner join on the distinct keys, which Catalyst
    does NOT push below a preceding aggregation - call it after
    pre-aggregating ``df``, so only aggregated rows are shuffled and a hot key
    never sends its raw rows to one task.
    """
    keys = keys.select(key)
    if small:
        return df.join(F.broadcast(keys), on=key, how="left_semi")
    return df.join(keys.distinct(), on=key, how="inner")


def attach(df: DataFrame, measures: DataFrame, on: str | Sequence[str],
           how: str = "left") -> DataFrame:
    """Attach per-key measures (pre-aggregated, one row per key)."""
    return df.join(measures, on=on if isinstance(on, str) else list(on), how=how)
