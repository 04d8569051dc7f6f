"""``pack_units``: grower ready-to-eat units per grader batch by pack category.

Current generation only.  Seasons are matched on the season lookup's text
(``SeasonDesc``), as in the reference, so this report follows that lookup
rather than the code map.

* tube packs: pallet units with non-zero units summed per (batch, product)
  before any shuffle, restricted to the requested seasons' batches
  (``keep_keys``), joined once to the flattened tube-product dimension
  (non-presize, non-sample products with their pack code); units =
  NoOfUnits x TubesPerCarton x RTEConversion; split by pack-code prefix in
  one conditional aggregation (``operators.pack_split``) instead of the
  reference's data-dependent pivot.
* presize: presize bin deliveries of the requested seasons, non-juice
  product (inner); weight / tube weight x conversion, strict sum per batch
  (a NULL poisons the batch, except the configured product whose NULL
  weights are dropped), rounded half-to-even; then only batches that exist.
* repack: cartons counted per (pallet, repack), joined to the pallet,
  restricted to the season's batches, units x conversion, NULL-skipping sum,
  rounded half-to-even.

The four tube columns stay NULL for a batch without tube rows, and so does
the total; only the presize and repack columns are zero-filled.  The pallet
and seven lookups the reference joins without using any of their columns are
not joined.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binyard import config as C
from binyard.config import CURRENT, DEFAULT_CONFIG, ReportConfig
from binyard.functions.semantics import (
    fill_zero, half_even, ieee_div, season_text_filter, strict_sum, sum_or_zero,
)
from binyard.operators.joins import attach, keep_keys, lookup
from binyard.operators.pack_split import pack_split
from binyard.operators.unions import to_schema
from binyard.plans.dims import carton_product, presize_product, tube_product
from binyard.plans.schemas import PACK_UNITS
from binyard.sources.catalog import Catalog


def season_batches(cat: Catalog, seasons) -> DataFrame:
    """Batches whose season text is requested: GraderBatchID, FarmID, BlockID, SeasonDesc."""
    season = cat.dim(CURRENT, "sw_SeasonT").filter(season_text_filter("SeasonDesc", seasons))
    return (cat.table(CURRENT, "ma_Grader_BatchT")
            .select("GraderBatchID", "SeasonID", "FarmID", "BlockID")
            .join(season, "SeasonID", "inner")
            .drop("SeasonID"))


def season_batch_ids(cat: Catalog, seasons) -> tuple[DataFrame, bool]:
    """Batch ids of the requested seasons and whether they provably fit a
    broadcast (see ``operators.joins.keep_keys``)."""
    ids = season_batches(cat, seasons).select("GraderBatchID")
    return ids, cat.fits_broadcast(ids, cat.row_bound(CURRENT, "ma_Grader_BatchT"))


def in_season(df: DataFrame, cat: Catalog, seasons) -> DataFrame:
    """Rows, pre-aggregated, of the requested seasons' batches.

    A staged list of batch ids is one scan with a selective filter: Spark
    broadcasts it where it is small, and then filters before the aggregation;
    else it makes a runtime Bloom filter of it, which it pushes through the
    aggregation to the fact's scan, so that rows of other seasons are not
    shuffled either way."""
    staged = cat.batch_ids(seasons)
    if staged is not None:
        return df.join(staged, "GraderBatchID", "left_semi")
    ids, small = season_batch_ids(cat, seasons)
    return keep_keys(df, ids, "GraderBatchID", small=small)


def tube_rows(cat: Catalog, seasons) -> DataFrame:
    """(GraderBatchID, code, units) per batch and product in season.

    Pallet units are summed per (batch, product) first - map-side, before any
    shuffle - because the unit value is NoOfUnits times a per-product factor
    (TubesPerCarton x RTEConversion): a batch with a third of all pallets
    shrinks to one row per product before the join and lookups.
    """
    t = lambda n: cat.table(CURRENT, n)
    p = (t("ma_Pallet_DetailT").select("ProductID", "NoOfUnits", "GraderBatchID")
         .filter(F.col("NoOfUnits") != 0)
         .groupBy("GraderBatchID", "ProductID")
         .agg(F.sum(F.col("NoOfUnits").cast("double")).alias("NoOfUnits")))
    p = in_season(p, cat, seasons)
    p = p.join(tube_product(cat), "ProductID", "inner")
    units = F.col("NoOfUnits") * F.col("TubesPerCarton") * F.col("RTEConversion")
    return p.select("GraderBatchID", "code", units.alias("units"))


def tube_split(cat: Catalog, seasons, config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    """Pack split per batch of the requested seasons."""
    return pack_split(tube_rows(cat, seasons), "GraderBatchID", "code", "units",
                      export_prefix=C.EXPORT_BIN_PREFIX, japan_prefix=C.JAPAN_TRAY_PREFIX,
                      tempz_prefix=C.TEMPZ_PREFIX, tempz_first_key=config.tempz_first_batch_id)


def presize_rows(cat: Catalog, seasons, config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    """(GraderBatchID, SeasonDesc, _units): units of the presize bins of the
    requested seasons, by the batch that they came from."""
    w = F.col("TotalWeight")
    bins = (cat.table(CURRENT, "ma_Bin_DeliveryT")
            .select("TotalWeight", "PresizeProductID", "SeasonID",
                    "PresizeOutputFromGraderBatchID", "PresizeFlag")
            .filter(F.col("PresizeFlag")
                    & ~((w.isNull() | F.isnan(w))
                        & (F.col("PresizeProductID") == config.presize_skip_null_weight_product_id))))
    season = cat.dim(CURRENT, "sw_SeasonT").filter(season_text_filter("SeasonDesc", seasons))
    bins = bins.join(season.select("SeasonID", "SeasonDesc"), "SeasonID", "inner")
    p = lookup(bins, presize_product(cat), ("PresizeProductID", "ProductID"),
               ["PresizeAvgTubeWeight", "RTEConversion"], how="inner")
    ps = ieee_div("TotalWeight", "PresizeAvgTubeWeight") * F.col("RTEConversion")
    return p.select(F.col("PresizeOutputFromGraderBatchID").alias("GraderBatchID"), "SeasonDesc", ps.alias("_units"))


def presize_units(cat: Catalog, seasons, config: ReportConfig = DEFAULT_CONFIG,
                  exact: bool = True) -> DataFrame:
    per_batch = (presize_rows(cat, seasons, config).groupBy("GraderBatchID")
                 .agg(half_even(strict_sum("_units"), 0).alias("PSgrowerRTEs")))
    # Only output batches that exist (the reference's inner join with the
    # batch keys).  Filtering on the grouping key commutes with the
    # aggregation, so it is applied to the per-batch rows - and skipped
    # altogether for a caller that joins the result to its batches anyway.
    if not exact:
        return per_batch
    ids = cat.table(CURRENT, "ma_Grader_BatchT").select("GraderBatchID")
    return keep_keys(per_batch, ids, "GraderBatchID",
                     small=cat.fits_broadcast(ids, cat.row_bound(CURRENT, "ma_Grader_BatchT")))


def repack_units(cat: Catalog, seasons) -> DataFrame:
    t = lambda n: cat.table(CURRENT, n)
    # The factors are one per pallet, so cartons are counted per pallet: one
    # exchange serves the count and the join.
    cartons = (t("ma_Repack_Input_CartonT")
               .groupBy("FromPalletDetailID")
               .agg(F.count(F.lit(1)).alias("RepackedNoOfUnits")))
    # Staged pallets of the season's batches are one selective scan, of which
    # Spark makes a runtime filter for the cartons; else all cartons are
    # counted and the season is applied to the counts.
    staged = cat.batch_pallets(seasons)
    r = lookup(cartons, t("ma_Pallet_DetailT") if staged is None else staged,
               ("FromPalletDetailID", "PalletDetailID"), ["GraderBatchID", "ProductID"], how="inner")
    r = r.groupBy("GraderBatchID", "ProductID").agg(F.sum("RepackedNoOfUnits").alias("RepackedNoOfUnits"))
    if staged is None:
        r = in_season(r, cat, seasons)
    r = lookup(r, carton_product(cat), "ProductID", ["TubesPerCarton", "RTEConversion"])
    units = (F.col("RepackedNoOfUnits").cast("double") * F.col("TubesPerCarton")
             * F.col("RTEConversion"))
    return r.groupBy("GraderBatchID").agg(half_even(sum_or_zero(units), 0).alias("repackRTEs"))


def unit_header(cat: Catalog, seasons, config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    """The season's batches with all their units but the presize ones, which
    are the only ones that depend on the other seasons asked for (T10)."""
    hdr = season_batches(cat, seasons)
    hdr = lookup(hdr, cat.table(CURRENT, "sw_FarmT"), "FarmID", ["FarmName"])
    hdr = lookup(hdr, cat.table(CURRENT, "sw_Farm_BlockT"), "BlockID", ["BlockName"])
    # Every measure is left-joined to the season's batches, which restricts
    # it; the measures' own batch filters save work.
    out = attach(hdr, tube_split(cat, seasons, config), "GraderBatchID")
    return attach(out, repack_units(cat, seasons), "GraderBatchID")


def finish_units(out: DataFrame) -> DataFrame:
    """Presize and repack units zero-filled, and the total."""
    out = (out.withColumn("PSgrowerRTEs", fill_zero("PSgrowerRTEs"))
              .withColumn("repackRTEs", fill_zero("repackRTEs")))
    total = (F.col("tubePacks") + F.col("exportBins") + F.col("japanTrayPacks")
             + F.col("tempZPacks") + F.col("PSgrowerRTEs") + F.col("repackRTEs"))
    return out.withColumn("totalGrowerRTEs", total)


def pack_units(cat: Catalog, seasons: Iterable[int],
               config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    seasons = [int(s) for s in seasons]
    out = attach(unit_header(cat, seasons, config), presize_units(cat, seasons, config, exact=False), "GraderBatchID")
    return to_schema(finish_units(out), PACK_UNITS)
