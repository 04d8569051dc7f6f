"""``batch_packout``: one row per grader batch with its pack-out figures.

Grain (Season, GraderBatchID).  Legacy and current generations are built as
separate branches (only those whose seasons meet the request) and unioned by
name.

Current branch plan:

* header: batch table filtered on the raw season code (pushed to the scan),
  the presize-input flag and a present WasteOtherKgs; lookups attached.
* juice: bin deliveries of the juice product, summed per output batch.
* pallet measures, from two season-filtered fact streams:
  - sampleKgs: in-season sample pallets, units x net weight;
  - looseKgs: in-season weighed-pool pallets with no export-bin row
    (the reference's "left join, ExportBinDetailID IS NULL"), units x net
    weight, plus the in-season export-bin weight of every pallet.
* bins tipped: bin usage in season, summed per batch, 0 for an all-NULL batch.

All per-batch frames are aggregated on GraderBatchID, so the joins to the
header reuse that hash partitioning; AQE broadcasts any side that turns out
small and splits skewed partitions of the rest.

Legacy branch: header with farm and owner (one flattened dimension); bin
usage filtered map-side to the header's batches when that list provably fits
a broadcast (else aggregated whole and restricted by the left join), then max
BinID / SQL-sum BinQty per batch, and the representative bin's block,
storage type and maturity code.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binyard import config as C
from binyard.config import CURRENT, DEFAULT_CONFIG, LEGACY, ReportConfig
from binyard.functions.semantics import (
    days_between, fill_zero, ieee_div, map_label, norm_owner, season_code_filter,
    season_from_code, server_sum, sum_or_zero, to_int,
)
from binyard.operators.joins import attach, keep_keys, lookup
from binyard.operators.unions import union_all
from binyard.plans.dims import farm_with_owner, pallet_product, place
from binyard.plans.schemas import BATCH_PACKOUT
from binyard.sources.catalog import Catalog


def _t(cat: Catalog, gen: str):
    return lambda name: cat.table(gen, name)


def _d(cat: Catalog, gen: str):
    return lambda name: cat.dim(gen, name)


def _header_lookups(hdr: DataFrame, cat: Catalog, gen: str) -> DataFrame:
    t = _t(cat, gen)
    D = _d(cat, gen)
    hdr = lookup(hdr, t("sw_FarmT"), "FarmID", ["FarmCode", "FarmName"])
    hdr = lookup(hdr, place(cat, gen), "BlockID",
                 ["BlockCode", "BlockName", "SubdivisionCode", "SubdivisionDesc"])
    hdr = lookup(hdr, D("sw_MaturityT"), "MaturityID", ["MaturityCode"])
    hdr = lookup(hdr, t("sw_CompanyT"), ("GrowerCompanyID", "CompanyID"), ["CompanyName"],
                 rename={"CompanyName": "owner"})
    hdr = lookup(hdr, D("ma_ShiftT"), "ShiftID", ["ShiftCode"])
    return lookup(hdr, D("sw_Pick_NoT"), "PickNoID", ["PickNo"])


def juice_rows(cat: Catalog, seasons, config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    """The season's juice bins: GraderBatchID (the presize output batch), SeasonID, TotalWeight."""
    return (cat.table(CURRENT, "ma_Bin_DeliveryT")
            .filter((F.col("PresizeProductID") == config.juice_product_id)
                    & season_code_filter("SeasonID", seasons, CURRENT, config))
            .select(F.col("PresizeOutputFromGraderBatchID").alias("GraderBatchID"), "SeasonID", "TotalWeight"))


def juice_weight(cat: Catalog, seasons, config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    """Per presize output batch: juiceKgs of the season's juice bins (SQL sum)."""
    return (juice_rows(cat, seasons, config).groupBy("GraderBatchID")
            .agg(server_sum("TotalWeight").alias("juiceKgs")))


def exported_by_created(cat: Catalog, seasons, config: ReportConfig = DEFAULT_CONFIG, *by) -> DataFrame:
    """(GraderBatchID, _kg, *by): the season's export-bin weight of each pallet
    (per value of ``by``), a pallet of any season (T10); pallets without a
    weight give no row."""
    staged = cat.export_batches(seasons, config)
    if staged is not None:
        return (staged.groupBy("GraderBatchID", "PalletDetailID", *by)
                .agg(server_sum("KGWeight").alias("_kg")).filter(F.col("_kg").isNotNull()).drop("PalletDetailID"))
    weighed = (cat.created_in(CURRENT, "ma_Export_Bin_DetailT", seasons, config)
               .groupBy("PalletDetailID", *by)
               .agg(server_sum("KGWeight").alias("_kg")).filter(F.col("_kg").isNotNull()))
    pallets = cat.table(CURRENT, "ma_Pallet_DetailT").select("PalletDetailID", "GraderBatchID")
    return weighed.join(pallets, "PalletDetailID", "inner").drop("PalletDetailID")


def exported_rows(cat: Catalog, seasons, config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    """(GraderBatchID, _kg): ``exported_by_created`` over all seasons together."""
    return exported_by_created(cat, seasons, config).select("GraderBatchID", "_kg")


def export_weight(cat: Catalog, seasons, config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    """Per batch with a weighed export bin in season: exportKgs."""
    return (exported_rows(cat, seasons, config).groupBy("GraderBatchID")
            .agg(server_sum("_kg").alias("exportKgs")))


def pallets_by_product(cat: Catalog, seasons, config: ReportConfig = DEFAULT_CONFIG, *by) -> DataFrame:
    """The season's pallets as (GraderBatchID, ProductID, *by, _units,
    NetFruitWeight, SampleFlag, _is_loose), the last: of a weighed pool and
    without an export-bin row of any season.

    Units are summed per (batch, product) before the product lookup: the net
    weight is one per product, and a hot product is one row per batch."""
    p = (cat.pallets_created_in(seasons, config)
         .groupBy("GraderBatchID", "ProductID", (~F.col("_exported")).alias("_loose"), *by)
         .agg(F.sum(F.col("NoOfUnits").cast("double")).alias("_units")))
    p = lookup(p, pallet_product(cat), "ProductID",
               ["NetFruitWeight", "SampleFlag", "GradeDesc", "PoolByRule"])
    return p.withColumn("_is_loose", F.col("_loose") & (F.col("PoolByRule") == C.POOL_BY_WEIGHT)
                        & (F.col("GradeDesc") != C.EXCLUDED_LOOSE_GRADE))


def pallet_measures(cat: Catalog, seasons: Iterable[int],
                    config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    """Per batch: sampleKgs (SQL sum) and looseKgs (R na.rm sum).

    The season band is a filter of both fact scans: pallets of the season
    (with an existence test against the export keys) and export rows of the
    season.  Only the two key columns of pallets are read without it, for
    export rows of the season on pallets of any season (T10)."""
    p = pallets_by_product(cat, seasons, config)
    weight = F.col("_units") * F.col("NetFruitWeight")
    by_units = p.select("GraderBatchID", F.when(F.col("SampleFlag"), weight).alias("_sample"),
                        F.when(F.col("_is_loose"), weight).alias("_kg"))
    by_weight = exported_rows(cat, seasons, config).select(
        "GraderBatchID", F.lit(None).cast("double").alias("_sample"), "_kg")
    return (by_units.unionByName(by_weight).groupBy("GraderBatchID")
            .agg(server_sum("_sample").alias("sampleKgs"), sum_or_zero("_kg").alias("looseKgs")))


def current_header(cat: Catalog, seasons, config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    """The season's batches that the report shows, with their lookups."""
    hdr = cat.table(CURRENT, "ma_Grader_BatchT").filter(
        ~F.col("PresizeInputFlag")
        & season_code_filter("SeasonID", seasons, CURRENT, config)
        & F.col("WasteOtherKgs").isNotNull() & ~F.isnan("WasteOtherKgs"))
    return _header_lookups(hdr, cat, CURRENT)


def bins_tipped(cat: Catalog, seasons, config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    """Per batch with bin usage in season: fieldBinsTipped (R na.rm sum)."""
    return (cat.created_in(CURRENT, "ma_Bin_UsageT", seasons, config)
            .groupBy("GraderBatchID")
            .agg(sum_or_zero("BinQty").alias("fieldBinsTipped")))


def finish_current(out: DataFrame, config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    """The report's rows from the header with the measures attached."""
    reject = (F.col("WasteOtherKgs") + fill_zero("juiceKgs") + fill_zero("sampleKgs")
              + fill_zero("looseKgs"))
    return out.select(
        "GraderBatchID",
        to_int("GraderBatchNo").alias("GraderBatchNo"),
        season_from_code("SeasonID", CURRENT, config).alias("Season"),
        norm_owner("owner").alias("owner"),
        "FarmCode", "FarmName", "BlockCode", "BlockName", "SubdivisionCode", "SubdivisionDesc",
        "HarvestDate", "PackDate", "ShiftCode",
        days_between("PackDate", "HarvestDate").alias("storageDays"),
        "fieldBinsTipped", "InputKgs",
        reject.alias("rejectKgs"),
        (F.lit(1.0) - ieee_div(reject, "InputKgs")).alias("packOut"),
        "MaturityCode",
        map_label("StorageTypeID", C.STORAGE_TYPE_BY_ID, C.STORAGE_TYPE_DEFAULT).alias("StorageType"),
        "PickNo")


def _pallet_measures_attached(hdr: DataFrame, cat: Catalog, seasons, config: ReportConfig) -> DataFrame:
    """The header with sampleKgs and looseKgs.  Over staged export rows, which
    carry their batch, the two sources of loose weight are attached apart:
    over a bucketed catalog neither is then exchanged, as a union would be."""
    if cat.export_batches(seasons, config) is None:
        return attach(hdr, pallet_measures(cat, seasons, config), "GraderBatchID")
    weight = F.col("_units") * F.col("NetFruitWeight")
    units = (pallets_by_product(cat, seasons, config).groupBy("GraderBatchID")
             .agg(server_sum(F.when(F.col("SampleFlag"), weight)).alias("sampleKgs"),
                  sum_or_zero(F.when(F.col("_is_loose"), weight)).alias("_looseUnits")))
    exported = (exported_rows(cat, seasons, config).groupBy("GraderBatchID")
                .agg(sum_or_zero("_kg").alias("_looseExport")))
    out = attach(attach(hdr, units, "GraderBatchID"), exported, "GraderBatchID")
    return out.withColumn("looseKgs", fill_zero("_looseUnits") + fill_zero("_looseExport"))


def _current(cat: Catalog, seasons, config: ReportConfig) -> DataFrame:
    out = current_header(cat, seasons, config)
    out = attach(out, juice_weight(cat, seasons, config), "GraderBatchID")
    out = _pallet_measures_attached(out, cat, seasons, config)
    out = attach(out, bins_tipped(cat, seasons, config), "GraderBatchID")
    return finish_current(out, config)


def legacy_packout(cat: Catalog, seasons, config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    """The legacy branch; a batch's rows do not depend on the other seasons asked for."""
    t = _t(cat, LEGACY)
    D = _d(cat, LEGACY)
    batches = t("ma_Grader_BatchT").filter(season_code_filter("SeasonID", seasons, LEGACY, config))
    hdr = lookup(batches, farm_with_owner(cat, LEGACY), "FarmID", ["FarmCode", "FarmName", "owner"])

    # The reference aggregates all bin usage and keeps the header's batches by
    # the left join.  When the requested batch list provably fits a broadcast,
    # usage is first filtered map-side to those batches (same result, less
    # to aggregate); otherwise all usage is pre-aggregated map-side and the
    # left join restricts it, so a hot batch is never shuffled as raw rows.
    usage = t("ma_Bin_UsageT").filter(F.col("GraderBatchID").isNotNull())
    ids = batches.select("GraderBatchID")
    bins = (usage.groupBy("GraderBatchID")
            .agg(F.max("BinID").alias("BinID"), server_sum("BinQty").alias("BinQty")))
    bins = keep_keys(bins, ids, "GraderBatchID",
                     small=cat.fits_broadcast(ids, cat.row_bound(LEGACY, "ma_Grader_BatchT")))
    bins = lookup(bins, t("ma_BinT"), "BinID", ["HarvestDate", "BlockID", "StorageTypeID", "ESPID"])
    bins = lookup(bins, place(cat, LEGACY), "BlockID",
                  ["BlockCode", "BlockName", "SubdivisionCode", "SubdivisionDesc"])
    bins = lookup(bins, D("sw_Storage_TypeT"), "StorageTypeID", ["StorageTypeDesc"])
    bins = lookup(bins, D("sw_ESPT"), "ESPID", ["ESPCode"])

    out = attach(hdr, bins.drop("BinID"), "GraderBatchID")
    return out.select(
        "GraderBatchID",
        to_int("GraderBatchNo").alias("GraderBatchNo"),
        season_from_code("SeasonID", LEGACY, config).alias("Season"),
        norm_owner("owner").alias("owner"),
        "FarmCode", "FarmName", "BlockCode", "BlockName", "SubdivisionCode", "SubdivisionDesc",
        F.to_date("HarvestDate").alias("HarvestDate"), F.to_date("PackDate").alias("PackDate"),
        F.lit(C.LEGACY_SHIFT_CODE).alias("ShiftCode"),
        days_between("PackDate", "HarvestDate").alias("storageDays"),
        F.col("BinQty").alias("fieldBinsTipped"),
        "InputKgs",
        F.col("RejectKgs").alias("rejectKgs"),
        (F.lit(1.0) - ieee_div("RejectKgs", "InputKgs")).alias("packOut"),
        F.col("ESPCode").alias("MaturityCode"),
        map_label("StorageTypeDesc", C.STORAGE_TYPE_BY_TEXT, C.STORAGE_TYPE_DEFAULT)
        .alias("StorageType"),
        F.lit(None).cast("int").alias("PickNo"))


def batch_packout(cat: Catalog, seasons: Iterable[int],
                  config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    """Pack-out per grader batch for the requested seasons (both generations)."""
    seasons = [int(s) for s in seasons]
    build = {LEGACY: legacy_packout, CURRENT: _current}
    branches = [build[g](cat, seasons, config) for g in config.generations_for(seasons)]
    return union_all(cat.spark, branches, BATCH_PACKOUT)
