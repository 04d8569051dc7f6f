"""Pack-category split: the reference's pivot + prefix row sums, re-expressed.

The reference pivots (batch x pack code) units to a wide frame with one
column per code, fills gaps with 0, then sums column ranges selected by name
prefix.  The wide frame is only an intermediate, so the same numbers come
from ONE grouped aggregation with conditional sums: the schema is fixed, the
number of pack codes is unbounded, and map-side partial aggregation absorbs
hot batches (no pivot, no ``collect`` of distinct codes).

Rules kept from the reference:
* the total counts every code, including a NULL code (its pivot column is
  named "NA"); NULL units are skipped and an all-NULL batch gives 0;
* prefixes match ignoring case;
* the Japan figure is rounded half-to-even *before* it is subtracted;
* the temporary-Z prefix only splits out from a configured batch id on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binyard.functions.semantics import half_even, nan_to_null, starts_with_ci


def _prefix_sum(code: Column, units: Column, prefix: str) -> Column:
    return F.coalesce(F.sum(F.when(starts_with_ci(code, prefix), nan_to_null(units))), F.lit(0.0))


def pack_split(rows: DataFrame, key: str, code: str, units: str, *, export_prefix: str,
               japan_prefix: str, tempz_prefix: str, tempz_first_key: int) -> DataFrame:
    """One row per ``key`` with tubePacks, exportBins, japanTrayPacks, tempZPacks."""
    c, u = F.col(code), F.col(units)
    agg = rows.groupBy(key).agg(
        F.coalesce(F.sum(nan_to_null(u)), F.lit(0.0)).alias("_total"),
        _prefix_sum(c, u, export_prefix).alias("exportBins"),
        half_even(_prefix_sum(c, u, japan_prefix), 0).alias("japanTrayPacks"),
        _prefix_sum(c, u, tempz_prefix).alias("_tempz"),
    )
    tempz = F.when(F.col(key) >= tempz_first_key, F.col("_tempz")).otherwise(F.lit(0.0))
    return agg.select(
        key,
        half_even(F.col("_total") - F.col("exportBins") - F.col("japanTrayPacks") - tempz, 0)
        .alias("tubePacks"),
        "exportBins", "japanTrayPacks", tempz.alias("tempZPacks"))
