"""``bin_intake``: one row per non-presize bin consignment received.

Both generations, filtered to the requested seasons inside each branch on the
raw season code (so the filter reaches the scan).  Skipping a generation whose
seasons are not requested gives the same rows as the reference's "read both,
filter last".

The storage site comes from the bin's first storage company.  The reference
computes it in a second query and self-joins on the bin id; here it is the
same row's lookup, which is equal because the bin id is the table's key.
Company names are compared as the SQL server does (trailing blanks ignored).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binyard import config as C
from binyard.config import CURRENT, DEFAULT_CONFIG, LEGACY, ReportConfig
from binyard.functions.semantics import (
    map_label, norm_owner, season_code_filter, season_from_code, server_equals,
)
from binyard.operators.joins import lookup
from binyard.operators.unions import union_all
from binyard.plans.dims import farm_with_owner, place
from binyard.plans.schemas import BIN_INTAKE
from binyard.sources.catalog import Catalog

_SITE = "_site_company"


def _place_lookups(df: DataFrame, cat: Catalog, gen: str) -> DataFrame:
    df = lookup(df, farm_with_owner(cat, gen), "FarmID", ["FarmCode", "FarmName", "owner"])
    df = lookup(df, place(cat, gen), "BlockID",
                ["BlockCode", "BlockName", "SubdivisionCode", "SubdivisionDesc"])
    return lookup(df, cat.table(gen, "sw_CompanyT"), ("FirstStorageSiteCompanyID", "CompanyID"),
                  ["CompanyName"], rename={"CompanyName": _SITE})


def current_storage_site(config_split: int = C.CURRENT_SITE_SPLIT_SEASON_ID, collation: str | None = None):
    site, sid = F.col(_SITE), F.col("SeasonID")
    te_ipu = server_equals(site, C.CURRENT_SITE_COMPANY, collation)
    expr = (F.when(te_ipu & (sid > config_split), F.lit(C.CURRENT_SITE_NEW))
            .when(te_ipu & (sid <= config_split), F.lit(C.CURRENT_SITE_OLD)))
    for name, label in C.CURRENT_SITE_BY_NAME:
        expr = expr.when(server_equals(site, name, collation), F.lit(label))
    return expr.otherwise(F.lit(C.CURRENT_SITE_DEFAULT))


def _current(cat: Catalog, seasons, config: ReportConfig) -> DataFrame:
    t = lambda n: cat.table(CURRENT, n)
    D = lambda n: cat.dim(CURRENT, n)
    bins = t("ma_Bin_DeliveryT").filter(
        ~F.col("PresizeFlag") & season_code_filter("SeasonID", seasons, CURRENT, config))
    bins = _place_lookups(bins, cat, CURRENT)
    bins = lookup(bins, D("sw_Pick_NoT"), "PickNoID", ["PickNoDesc"])
    bins = lookup(bins, D("sw_TreatmentT"), "TreatmentID", ["TreatmentDesc"])
    bins = lookup(bins, D("sw_TagT"), "TagID", ["TagDesc"])
    bins = lookup(bins, D("sw_Growing_TypeT"), "GrowingTypeID", ["GrowingTypeDesc"])
    bins = lookup(bins, D("sw_MaturityT"), "MaturityID", ["MaturityCode"])
    return bins.select(
        "BinDeliveryID",
        F.col("BinDeliveryNo").alias("ConsignmentNumber"),
        season_from_code("SeasonID", CURRENT, config).alias("Season"),
        "HarvestDate", "NoOfBins", "Comment", "ReceivedDate", "BlockCode", "BlockName",
        "FarmCode", "FarmName", "SubdivisionCode", "SubdivisionDesc",
        norm_owner("owner").alias("owner"),
        "PickNoDesc", "TreatmentDesc", "TagDesc", "GrowingTypeDesc", "MaturityCode",
        map_label("StorageTypeID", C.STORAGE_TYPE_BY_ID, C.STORAGE_TYPE_DEFAULT).alias("StorageType"),
        current_storage_site(collation=config.server_collation).alias("StorageSite"))


def _legacy(cat: Catalog, seasons, config: ReportConfig) -> DataFrame:
    t = lambda n: cat.table(LEGACY, n)
    D = lambda n: cat.dim(LEGACY, n)
    season = season_from_code("SeasonID", LEGACY, config)
    bins = t("ma_BinT").filter(
        ~F.col("PresizeFlag") & season_code_filter("SeasonID", seasons, LEGACY, config)
        & (season == F.year("HarvestDate")))
    bins = _place_lookups(bins, cat, LEGACY)
    bins = lookup(bins, D("sw_ESPT"), "ESPID", ["ESPCode"])
    site = map_label(_SITE, C.LEGACY_SITE_BY_NAME, F.col(_SITE), server_side=True,
                     collation=config.server_collation)
    none = F.lit(None).cast("string")
    return bins.select(
        F.col("BinID").alias("BinDeliveryID"),
        F.col("BinNo").alias("ConsignmentNumber"),
        season.alias("Season"),
        F.to_date("HarvestDate").alias("HarvestDate"), "NoOfBins", "Comment",
        F.col("BinReceivedDate").alias("ReceivedDate"), "BlockCode", "BlockName",
        "FarmCode", "FarmName", "SubdivisionCode", "SubdivisionDesc",
        norm_owner("owner").alias("owner"),
        none.alias("PickNoDesc"), none.alias("TreatmentDesc"), none.alias("TagDesc"),
        none.alias("GrowingTypeDesc"),
        F.col("ESPCode").alias("MaturityCode"),
        map_label("StorageTypeID", C.STORAGE_TYPE_BY_ID, C.STORAGE_TYPE_DEFAULT).alias("StorageType"),
        site.alias("StorageSite"))


def bin_intake(cat: Catalog, seasons: Iterable[int],
               config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    seasons = [int(s) for s in seasons]
    build = {LEGACY: _legacy, CURRENT: _current}
    branches = [build[g](cat, seasons, config) for g in config.generations_for(seasons)]
    return union_all(cat.spark, branches, BIN_INTAKE)
