"""Registered queries: each operator of the blueprint and the four reports.

Every entry pairs a Spark plan (DataFrame API over the ERP catalog derived
from the driver's tables) with an independent DuckDB SQL body over the same
tables (``binyard.plans.oracle``) and an explicit output schema.  Both sides
are conformed to that schema; double columns are rounded to 6 decimals on
both sides because sums of doubles depend on summation order, in Spark from
run to run as well.

All queries read whole tables; none samples, caps or filters by id.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binyard import config as C
from binyard.config import CURRENT, LEGACY
from binyard.functions.semantics import (
    days_between, half_even, ieee_div, norm_owner, season_code_filter, season_from_code,
    season_from_timestamp, server_sum, strict_sum, sum_or_zero, timestamp_season_filter, to_int,
)
from binyard.operators.joins import anti, attach, lookup, semi
from binyard.operators.unions import schema_columns, union_all
from binyard.plans import oracle as O
from binyard.plans.batch_packout import (
    batch_packout, current_header, export_weight, finish_current, juice_weight, pallet_measures,
)
from binyard.plans.bin_intake import bin_intake
from binyard.plans.defect_share import _union, defect_share, sample_sizes
from binyard.plans.pack_units import pack_units, presize_units, repack_units, tube_split
from binyard.plans.schemas import BATCH_PACKOUT, BIN_INTAKE, DEFECT_SHARE, PACK_UNITS
from binyard.plans.season_store import STATE, measures, merge_state, packout_state, presize_state
from binyard.sources.catalog import Catalog
from binyard.sources.testdata import TestdataCatalog

L, I, D, S, B, DT = (T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(),
                     T.BooleanType(), T.DateType())
ALL_SEASONS = list(range(2016, 2024))
ROUND_DIGITS = 6


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


@dataclass(frozen=True)
class Check:
    name: str
    build: Callable[[Catalog], DataFrame]
    sql: Callable[[], str]          # CTEs after the views + final SELECT
    schema: T.StructType
    note: str = ""


def rounded(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Conform to ``schema`` and round double columns, in one projection."""
    cols = []
    for f, c in zip(schema.fields, schema_columns(df, schema)):
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(F.col(c) if isinstance(c, str) else c, ROUND_DIGITS).alias(f.name)
        cols.append(c)
    return df.select(cols)


def _body(sql: str) -> tuple[str, str]:
    """Split 'WITH a AS (...), b AS (...) SELECT ...' into (ctes, select)."""
    sql = sql.strip()
    if not sql.upper().startswith("WITH"):
        return "", sql
    depth, i = 0, 4
    while i < len(sql):
        ch = sql[i]
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif depth == 0 and sql[i:i + 6].upper() == "SELECT" and not sql[i - 1].isalnum() \
                and not sql[i - 1] == "_":
            return sql[4:i].strip().rstrip(","), sql[i:]
        i += 1
    raise ValueError("no final SELECT")


def full_sql(check: Check) -> str:
    ctes, select = _body(check.sql())
    return O.with_views(ctes, O.conform_sql(select, check.schema, ROUND_DIGITS))


# ------------------------------------------------------------------ builders


def _cur(cat, n):
    return cat.table(CURRENT, n)


def _leg(cat, n):
    return cat.table(LEGACY, n)


def scan_prune(cat):
    """2.1/2.2: scan of non-presize bins, only four columns, one renamed."""
    return (_cur(cat, "ma_Bin_DeliveryT").filter(~F.col("PresizeFlag"))
            .select("BinDeliveryID", F.col("BinDeliveryNo").alias("ConsignmentNumber"),
                    "HarvestDate", "NoOfBins"))


def lookup_chain(cat):
    """Five chained many-to-one lookups, unmatched keys kept with NULLs."""
    b = _cur(cat, "ma_Grader_BatchT").select("GraderBatchID", "FarmID", "BlockID",
                                            "GrowerCompanyID", "PickNoID")
    b = lookup(b, _cur(cat, "sw_FarmT"), "FarmID", ["FarmCode", "FarmName"])
    b = lookup(b, _cur(cat, "sw_Farm_BlockT"), "BlockID", ["BlockCode", "SubdivisionID"])
    b = lookup(b, cat.dim(CURRENT, "sw_SubdivisionT"), "SubdivisionID", ["SubdivisionDesc"])
    b = lookup(b, _cur(cat, "sw_CompanyT"), ("GrowerCompanyID", "CompanyID"), ["CompanyName"],
               rename={"CompanyName": "owner"})
    return lookup(b, cat.dim(CURRENT, "sw_Pick_NoT"), "PickNoID", ["PickNo"])


def fact_to_header(cat):
    """Every assessment defect with its assessment header (left join)."""
    d = _cur(cat, "qa_Assessment_DefectT").select("AssessmentDefectID", "AssessmentID", "DefectQty")
    a = _cur(cat, "qa_AssessmentT").select("AssessmentID", "GraderBatchID", "SampleQty", "SeasonID")
    return attach(d, a, "AssessmentID")


def anti_unweighed_pallets(cat):
    """Pallets without any export-bin row (left anti join)."""
    p = _cur(cat, "ma_Pallet_DetailT").select("PalletDetailID", "GraderBatchID", "NoOfUnits")
    return anti(p, _cur(cat, "ma_Export_Bin_DetailT"), "PalletDetailID")


def semi_presize_batches(cat):
    """Bin deliveries whose presize output batch exists (left semi join)."""
    b = _cur(cat, "ma_Bin_DeliveryT").select("BinDeliveryID", "PresizeOutputFromGraderBatchID",
                                            "TotalWeight")
    return semi(b, _cur(cat, "ma_Grader_BatchT"), ("PresizeOutputFromGraderBatchID", "GraderBatchID"))


def inner_repack_pallet(cat):
    """Cartons counted per (pallet, repack), inner-joined on a renamed key."""
    cartons = (_cur(cat, "ma_Repack_Input_CartonT").groupBy("FromPalletDetailID", "RepackID")
               .agg(F.count(F.lit(1)).alias("RepackedNoOfUnits")))
    return lookup(cartons, _cur(cat, "ma_Pallet_DetailT"), ("FromPalletDetailID", "PalletDetailID"),
                  ["GraderBatchID", "ProductID"], how="inner")


def _headers(cat, seasons=ALL_SEASONS):
    out = []
    for gen in (LEGACY, CURRENT):
        h = cat.table(gen, "ma_Grader_BatchT").filter(season_code_filter("SeasonID", seasons, gen))
        out.append(h.select("GraderBatchID", "GraderBatchNo",
                            season_from_code("SeasonID", gen).alias("Season"), "PackDate",
                            "InputKgs"))
    return out


def composite_key_join(cat):
    """Sample sizes of both generations joined on (Season, GraderBatchID)."""
    sq = sample_sizes(cat, LEGACY, ALL_SEASONS).unionByName(sample_sizes(cat, CURRENT, ALL_SEASONS))
    hdr = _headers(cat)
    hdr = hdr[0].unionByName(hdr[1]).select("Season", "GraderBatchID", "InputKgs")
    return attach(sq, hdr, ["Season", "GraderBatchID"])


CODE_MAP_SEASONS = [2017, 2021]


def code_map_season(cat):
    """2.8/§4: season code map, filtered on the inverted codes of both generations."""
    parts = []
    for gen in (LEGACY, CURRENT):
        b = cat.table(gen, "ma_Grader_BatchT").filter(
            season_code_filter("SeasonID", CODE_MAP_SEASONS, gen))
        parts.append(b.select("GraderBatchID", "SeasonID",
                              season_from_code("SeasonID", gen).alias("Season")))
    return parts[0].unionByName(parts[1])


TIMESTAMP_SEASONS_CHECK = [2020, 2022]


def timestamp_season(cat):
    """seasons from creation timestamps, filtered as half-open ranges."""
    return (_cur(cat, "ma_Pallet_DetailT")
            .filter(timestamp_season_filter("CreatedDateTime", TIMESTAMP_SEASONS_CHECK))
            .select("PalletDetailID", season_from_timestamp("CreatedDateTime").alias("Season")))


def strict_sum_by_group(cat):
    """Defect quantity per group, NULL as soon as one input is NULL."""
    return (_cur(cat, "qa_Assessment_DefectT").groupBy("AssessmentID", "DefectID")
            .agg(strict_sum("DefectQty").cast("bigint").alias("defectQty"),
                 F.count(F.lit(1)).alias("n_rows")))


def sum_or_zero_by_group(cat):
    """Bins tipped per batch, 0 for an all-NULL batch."""
    return (_cur(cat, "ma_Bin_UsageT").groupBy("GraderBatchID")
            .agg(sum_or_zero("BinQty").alias("fieldBinsTipped")))


def max_representative_bin(cat):
    """Max bin id and SQL-sum quantity per batch, then that bin's attributes."""
    u = (_leg(cat, "ma_Bin_UsageT").filter(F.col("GraderBatchID").isNotNull())
         .groupBy("GraderBatchID")
         .agg(F.max("BinID").alias("BinID"), server_sum("BinQty").alias("BinQty")))
    return lookup(u, _leg(cat, "ma_BinT"), "BinID", ["BlockID", "HarvestDate"])


PACK_SEASONS = [2020, 2021, 2022]


def prefix_pack_split(cat):
    """2.7: pack split by code prefix without a pivot (all current seasons)."""
    return tube_split(cat, sorted(C.CURRENT_SEASON_CODES.values()))


def union_generations(cat):
    """2.6: both generations' batch headers unioned by name with explicit types."""
    hdr = _headers(cat)
    return union_all(cat.spark, hdr, _UNION_SCHEMA)


def normalise_owner(cat):
    """2.8: owner company name trimmed, lower-cased, spaces deleted."""
    b = _cur(cat, "ma_Grader_BatchT").select("GraderBatchID", "GrowerCompanyID")
    b = lookup(b, _cur(cat, "sw_CompanyT"), ("GrowerCompanyID", "CompanyID"), ["CompanyName"])
    return b.select("GraderBatchID", F.col("CompanyName").alias("rawOwner"),
                    norm_owner("CompanyName").alias("owner"))


def half_even_round(cat):
    """Per-batch unit sums rounded half-to-even (many exact .5 ties)."""
    p = _cur(cat, "ma_Pallet_DetailT").select("GraderBatchID", "ProductID", "NoOfUnits")
    p = lookup(p, _cur(cat, "sw_ProductT"), "ProductID", ["TubeTypeID"])
    p = lookup(p, cat.dim(CURRENT, "sw_Tube_TypeT"), "TubeTypeID", ["RTEConversion"])
    u = F.col("NoOfUnits").cast("double") * F.col("RTEConversion")
    return (p.groupBy("GraderBatchID").agg(F.sum(u).alias("units"))
            .withColumn("roundedUnits", half_even("units", 0)))


def safe_ratio(cat):
    """T4: weight / tube weight with x/0 -> +-Inf, 0/0 -> NaN, reported as a class."""
    b = _cur(cat, "ma_Bin_DeliveryT").select("BinDeliveryID", "TotalWeight", "PresizeProductID")
    b = lookup(b, _cur(cat, "sw_ProductT"), ("PresizeProductID", "ProductID"), ["TubeTypeID"])
    b = lookup(b, cat.dim(CURRENT, "sw_Tube_TypeT"), "TubeTypeID", ["PresizeAvgTubeWeight"])
    r = ieee_div("TotalWeight", "PresizeAvgTubeWeight")
    cls = (F.when(r.isNull(), "null").when(F.isnan(r), "nan")
           .when(r == float("inf"), "pos_inf").when(r == float("-inf"), "neg_inf")
           .otherwise("finite"))
    finite = F.when(~F.isnan(r) & (F.abs(r) < float("inf")), r)
    return b.select("BinDeliveryID", cls.alias("ratio_class"), finite.alias("ratio"))


def _int_text():
    k = F.col("GraderBatchID")
    m = k % 4
    return (F.when(k % 20 == 2, F.concat(k.cast("string"), F.lit("d")))
            .when(k % 20 == 6, F.concat(k.cast("string"), F.lit("F")))
            .when(k % 20 == 10, F.concat(F.lit(" "), k.cast("string"), F.lit(" ")))
            .when(k % 20 == 14, F.concat(k.cast("string"), F.lit("e2")))
            .when(k % 20 == 18, F.concat(F.lit("0x"), F.lower(F.hex(k))))
            .when(k % 20 == 3, F.concat(F.lit("0X"), F.hex(k), F.lit(" ")))
            .when(k % 20 == 7, F.concat(F.lit("-"), k.cast("string"), F.lit(".")))
            .when(m == 0, k.cast("string"))
            .when(m == 1, F.concat(k.cast("string"), F.lit(".7")))
            .when(m == 2, F.concat(F.lit("abc"), k.cast("string")))
            .otherwise((k * 1000000).cast("string")))


def to_int_text(cat):
    """T5: tolerant text-to-integer ('12.7' -> 12, 'abc' -> NULL, overflow -> NULL)."""
    b = _cur(cat, "ma_Grader_BatchT").select("GraderBatchID").withColumn("rawText", _int_text())
    return b.select("GraderBatchID", "rawText", to_int("rawText").alias("asInt"))


def _each_season(build, cat):
    """State computed season by season, then merged."""
    return merge_state(*[build(cat, [s]) for s in CURRENT_ONLY])


def packout_from_state(cat):
    """The current pack-out from state that was computed season by season."""
    header = _union([current_header(cat, [s]) for s in CURRENT_ONLY])
    return finish_current(attach(header, measures(_each_season(packout_state, cat)), "GraderBatchID"))


def season_state(cat):
    """A1-A5 and A11 as (sum, non-NULL count, row count) per batch and fact season."""
    return packout_state(cat, CURRENT_ONLY).unionByName(presize_state(cat, CURRENT_ONLY))


def storage_days(cat):
    """Whole days from harvest to packing, as a double."""
    return _cur(cat, "ma_Grader_BatchT").select(
        "GraderBatchID", days_between("PackDate", "HarvestDate").alias("storageDays"))


def relabel_after_group(cat):
    """2.8: defects summed per (batch, label), Russet labels merged afterwards."""
    d = _cur(cat, "qa_Assessment_DefectT").select("AssessmentID", "DefectID", "DefectQty")
    d = lookup(d, _cur(cat, "qa_AssessmentT"), "AssessmentID", ["GraderBatchID"], how="inner")
    d = lookup(d, cat.dim(CURRENT, "qa_DefectT"), "DefectID", ["Defect"])
    g = d.groupBy("GraderBatchID", "Defect").agg(strict_sum("DefectQty").cast("bigint")
                                                 .alias("defectQty"))
    return g.withColumn("Defect", F.when(F.col("Defect").isin(list(C.RUSSET_SOURCE_LABELS)),
                                         C.RUSSET_LABEL).otherwise(F.col("Defect")))


def sample_weight(cat):
    """Sample kg per batch (SQL sum; batches without a weighed sample left out)."""
    return (pallet_measures(cat, ALL_SEASONS).select("GraderBatchID", "sampleKgs")
            .filter(F.col("sampleKgs").isNotNull()))


def loose_weight(cat):
    """F8/A4: loose kg of every batch with a pallet or a weighed export bin in season."""
    return pallet_measures(cat, ALL_SEASONS).select("GraderBatchID", "looseKgs")


_UNION_SCHEMA = _schema(("GraderBatchID", L), ("GraderBatchNo", S), ("Season", I),
                        ("PackDate", DT), ("InputKgs", D))

# ----------------------------------------------------------------- SQL side


def _sql_union_generations():
    parts = [f"""SELECT GraderBatchID, GraderBatchNo, {O.season_case('SeasonID', g)} AS Season,
               PackDate, InputKgs FROM {O.view_name(g, 'ma_Grader_BatchT')}
               WHERE {O.season_case('SeasonID', g)} IN {O.in_list(ALL_SEASONS)}"""
             for g in (LEGACY, CURRENT)]
    return " UNION ALL ".join(parts)


def _sql_sample_sizes():
    parts = []
    for gen, templates in ((LEGACY, C.LEGACY_TEMPLATES), (CURRENT, C.CURRENT_TEMPLATES)):
        p = O.view_name(gen, "")
        season = O.season_case("a.SeasonID", gen)
        parts.append(f"""SELECT {season} AS Season, a.GraderBatchID, sum(a.SampleQty) AS sampleQty
          FROM {p}qa_AssessmentT a LEFT JOIN {p}qa_TemplateT t ON a.TemplateID = t.TemplateID
          WHERE a.GraderBatchID IS NOT NULL AND t.TemplateName IN {O.in_list(templates)}
            AND {season} IN {O.in_list(ALL_SEASONS)}
          GROUP BY 1, 2""")
    return " UNION ALL ".join(parts)


def _sql_int_text():
    k = "GraderBatchID"
    return (f"CASE WHEN {k} % 20 = 2 THEN CAST({k} AS VARCHAR) || 'd' "
            f"WHEN {k} % 20 = 6 THEN CAST({k} AS VARCHAR) || 'F' "
            f"WHEN {k} % 20 = 10 THEN ' ' || CAST({k} AS VARCHAR) || ' ' "
            f"WHEN {k} % 20 = 14 THEN CAST({k} AS VARCHAR) || 'e2' "
            f"WHEN {k} % 20 = 18 THEN '0x' || printf('%x', {k}) "
            f"WHEN {k} % 20 = 3 THEN '0X' || printf('%X', {k}) || ' ' "
            f"WHEN {k} % 20 = 7 THEN '-' || CAST({k} AS VARCHAR) || '.' "
            f"WHEN {k} % 4 = 0 THEN CAST({k} AS VARCHAR) "
            f"WHEN {k} % 4 = 1 THEN CAST({k} AS VARCHAR) || '.7' "
            f"WHEN {k} % 4 = 2 THEN 'abc' || CAST({k} AS VARCHAR) "
            f"ELSE CAST({k} * 1000000 AS VARCHAR) END")


_SQL = {
    "scan_prune": lambda: """SELECT BinDeliveryID, BinDeliveryNo AS ConsignmentNumber, HarvestDate,
        NoOfBins FROM cur_ma_Bin_DeliveryT WHERE PresizeFlag = FALSE""",
    "lookup_chain": lambda: """SELECT b.GraderBatchID, f.FarmCode, f.FarmName, bl.BlockCode,
        sd.SubdivisionDesc, c.CompanyName AS owner, pn.PickNo
      FROM cur_ma_Grader_BatchT b
      LEFT JOIN cur_sw_FarmT f ON b.FarmID = f.FarmID
      LEFT JOIN cur_sw_Farm_BlockT bl ON b.BlockID = bl.BlockID
      LEFT JOIN cur_sw_SubdivisionT sd ON bl.SubdivisionID = sd.SubdivisionID
      LEFT JOIN cur_sw_CompanyT c ON b.GrowerCompanyID = c.CompanyID
      LEFT JOIN cur_sw_Pick_NoT pn ON b.PickNoID = pn.PickNoID""",
    "fact_to_header": lambda: """SELECT d.AssessmentDefectID, d.AssessmentID, d.DefectQty,
        a.GraderBatchID, a.SampleQty, a.SeasonID
      FROM cur_qa_Assessment_DefectT d LEFT JOIN cur_qa_AssessmentT a
        ON d.AssessmentID = a.AssessmentID""",
    "anti_unweighed_pallets": lambda: """SELECT p.PalletDetailID, p.GraderBatchID, p.NoOfUnits
      FROM cur_ma_Pallet_DetailT p LEFT JOIN cur_ma_Export_Bin_DetailT e
        ON p.PalletDetailID = e.PalletDetailID
      WHERE e.ExportBinDetailID IS NULL""",
    "semi_presize_batches": lambda: """SELECT bd.BinDeliveryID, bd.PresizeOutputFromGraderBatchID,
        bd.TotalWeight
      FROM cur_ma_Bin_DeliveryT bd JOIN (SELECT GraderBatchID FROM cur_ma_Grader_BatchT) b
        ON bd.PresizeOutputFromGraderBatchID = b.GraderBatchID""",
    "inner_repack_pallet": lambda: """SELECT r.FromPalletDetailID, r.RepackID,
        r.RepackedNoOfUnits, p.GraderBatchID, p.ProductID
      FROM (SELECT FromPalletDetailID, RepackID, count(*) AS RepackedNoOfUnits
            FROM cur_ma_Repack_Input_CartonT GROUP BY 1, 2) r
      JOIN cur_ma_Pallet_DetailT p ON r.FromPalletDetailID = p.PalletDetailID""",
    "composite_key_join": lambda: f"""WITH sq AS ({_sql_sample_sizes()}),
      hdr AS ({_sql_union_generations()})
      SELECT sq.Season, sq.GraderBatchID, sq.sampleQty, h.InputKgs
      FROM sq LEFT JOIN hdr h ON sq.Season = h.Season AND sq.GraderBatchID = h.GraderBatchID""",
    "code_map_season": lambda: " UNION ALL ".join(
        f"""SELECT GraderBatchID, SeasonID, {O.season_case('SeasonID', g)} AS Season
            FROM {O.view_name(g, 'ma_Grader_BatchT')}
            WHERE {O.season_case('SeasonID', g)} IN {O.in_list(CODE_MAP_SEASONS)}"""
        for g in (LEGACY, CURRENT)),
    "timestamp_season": lambda: f"""SELECT PalletDetailID, {O.ts_season('CreatedDateTime')} AS Season
      FROM cur_ma_Pallet_DetailT
      WHERE {O.ts_season('CreatedDateTime')} IN {O.in_list(TIMESTAMP_SEASONS_CHECK)}""",
    "strict_sum_by_group": lambda: """SELECT AssessmentID, DefectID,
        CASE WHEN count(DefectQty) = count(*) THEN sum(DefectQty) END AS defectQty,
        count(*) AS n_rows
      FROM cur_qa_Assessment_DefectT GROUP BY AssessmentID, DefectID""",
    "sum_or_zero_by_group": lambda: """SELECT GraderBatchID, coalesce(sum(BinQty), 0) AS fieldBinsTipped
      FROM cur_ma_Bin_UsageT GROUP BY GraderBatchID""",
    "max_representative_bin": lambda: """SELECT u.GraderBatchID, u.BinID, u.BinQty, b.BlockID,
        b.HarvestDate
      FROM (SELECT GraderBatchID, max(BinID) AS BinID, sum(BinQty) AS BinQty
            FROM leg_ma_Bin_UsageT WHERE GraderBatchID IS NOT NULL GROUP BY GraderBatchID) u
      LEFT JOIN leg_ma_BinT b ON u.BinID = b.BinID""",
    "prefix_pack_split": lambda: O.tube_split_sql(sorted(C.CURRENT_SEASON_CODES.values())),
    "union_generations": _sql_union_generations,
    "normalise_owner": lambda: f"""SELECT b.GraderBatchID, c.CompanyName AS rawOwner,
        {O.norm_owner('c.CompanyName')} AS owner
      FROM cur_ma_Grader_BatchT b LEFT JOIN cur_sw_CompanyT c ON b.GrowerCompanyID = c.CompanyID""",
    "half_even_round": lambda: """SELECT GraderBatchID, units, round_even(units, 0) AS roundedUnits
      FROM (SELECT p.GraderBatchID, sum(CAST(p.NoOfUnits AS DOUBLE) * tt.RTEConversion) AS units
            FROM cur_ma_Pallet_DetailT p
            LEFT JOIN cur_sw_ProductT pr ON p.ProductID = pr.ProductID
            LEFT JOIN cur_sw_Tube_TypeT tt ON pr.TubeTypeID = tt.TubeTypeID
            GROUP BY p.GraderBatchID) s""",
    "safe_ratio": lambda: """SELECT BinDeliveryID,
        CASE WHEN r IS NULL THEN 'null' WHEN isnan(r) THEN 'nan' WHEN r = 'inf'::DOUBLE THEN 'pos_inf'
             WHEN r = '-inf'::DOUBLE THEN 'neg_inf' ELSE 'finite' END AS ratio_class,
        CASE WHEN NOT isnan(r) AND abs(r) < 'inf'::DOUBLE THEN r END AS ratio
      FROM (SELECT bd.BinDeliveryID, bd.TotalWeight / tt.PresizeAvgTubeWeight AS r
            FROM cur_ma_Bin_DeliveryT bd
            LEFT JOIN cur_sw_ProductT pr ON bd.PresizeProductID = pr.ProductID
            LEFT JOIN cur_sw_Tube_TypeT tt ON pr.TubeTypeID = tt.TubeTypeID) s""",
    "to_int_text": lambda: f"""SELECT GraderBatchID, rawText, {O.to_int('rawText')} AS asInt
      FROM (SELECT GraderBatchID, {_sql_int_text()} AS rawText FROM cur_ma_Grader_BatchT) s""",
    "season_state": lambda: O.season_state_sql(CURRENT_ONLY),
    "storage_days": lambda: """SELECT GraderBatchID, CAST(PackDate - HarvestDate AS DOUBLE) AS storageDays
      FROM cur_ma_Grader_BatchT""",
    "juice_weight": lambda: f"""SELECT PresizeOutputFromGraderBatchID AS GraderBatchID,
        sum(TotalWeight) AS juiceKgs
      FROM cur_ma_Bin_DeliveryT
      WHERE PresizeProductID = {C.JUICE_PRODUCT_ID}
        AND {O.season_case('SeasonID', CURRENT)} IN {O.in_list(ALL_SEASONS)}
      GROUP BY 1""",
    "sample_weight": lambda: f"""SELECT p.GraderBatchID, sum(p.NoOfUnits * pr.NetFruitWeight) AS sampleKgs
      FROM cur_ma_Pallet_DetailT p JOIN cur_sw_ProductT pr ON p.ProductID = pr.ProductID
      WHERE {O.ts_season('p.CreatedDateTime')} IN {O.in_list(ALL_SEASONS)} AND pr.SampleFlag
      GROUP BY p.GraderBatchID HAVING sum(p.NoOfUnits * pr.NetFruitWeight) IS NOT NULL""",
    "export_weight": lambda: f"""SELECT p.GraderBatchID, sum(e.KGWeight) AS exportKgs
      FROM cur_ma_Export_Bin_DetailT e JOIN cur_ma_Pallet_DetailT p
        ON e.PalletDetailID = p.PalletDetailID
      WHERE {O.ts_season('e.CreatedDateTime')} IN {O.in_list(ALL_SEASONS)} AND e.KGWeight IS NOT NULL
      GROUP BY p.GraderBatchID""",
    "loose_weight": lambda: f"""SELECT GraderBatchID, coalesce(sum(kg), 0) AS looseKgs FROM (
        SELECT p.GraderBatchID, CASE WHEN pt.PoolByRule = {O.q(C.POOL_BY_WEIGHT)}
            AND g.GradeDesc <> {O.q(C.EXCLUDED_LOOSE_GRADE)}
            AND NOT EXISTS (SELECT 1 FROM cur_ma_Export_Bin_DetailT x
                            WHERE x.PalletDetailID = p.PalletDetailID)
          THEN p.NoOfUnits * pr.NetFruitWeight END AS kg
        FROM cur_ma_Pallet_DetailT p
        LEFT JOIN cur_sw_ProductT pr ON p.ProductID = pr.ProductID
        LEFT JOIN cur_sw_GradeT g ON pr.GradeID = g.GradeID
        LEFT JOIN cur_sys_fi_Pool_TypeT pt ON g.PoolTypeID = pt.PoolTypeID
        WHERE {O.ts_season('p.CreatedDateTime')} IN {O.in_list(ALL_SEASONS)}
        UNION ALL
        SELECT p.GraderBatchID, e.KGWeight AS kg
        FROM cur_ma_Export_Bin_DetailT e JOIN cur_ma_Pallet_DetailT p
          ON e.PalletDetailID = p.PalletDetailID
        WHERE {O.ts_season('e.CreatedDateTime')} IN {O.in_list(ALL_SEASONS)}
          AND e.KGWeight IS NOT NULL) u
      GROUP BY GraderBatchID""",
    "presize_units": lambda: f"""SELECT GraderBatchID,
        round_even(CASE WHEN count(v) = count(*) THEN sum(v) END, 0) AS PSgrowerRTEs
      FROM (SELECT bd.PresizeOutputFromGraderBatchID AS GraderBatchID,
                   bd.TotalWeight / tt.PresizeAvgTubeWeight * tt.RTEConversion AS v
            FROM cur_ma_Bin_DeliveryT bd
            JOIN cur_sw_SeasonT se ON bd.SeasonID = se.SeasonID
            JOIN cur_sw_ProductT pr ON bd.PresizeProductID = pr.ProductID
            JOIN cur_sw_GradeT g ON pr.GradeID = g.GradeID
            LEFT JOIN cur_sw_Tube_TypeT tt ON pr.TubeTypeID = tt.TubeTypeID
            WHERE bd.PresizeFlag AND NOT g.JuiceFlag
              AND se.SeasonDesc IN {O.in_list([str(x) for x in PACK_SEASONS])}
              AND (bd.TotalWeight IS NOT NULL
                   OR bd.PresizeProductID <> {C.PRESIZE_SKIP_NULL_WEIGHT_PRODUCT_ID})
              AND bd.PresizeOutputFromGraderBatchID IN
                (SELECT GraderBatchID FROM cur_ma_Grader_BatchT)) s
      GROUP BY GraderBatchID""",
    "repack_units": lambda: f"""SELECT p.GraderBatchID,
        round_even(coalesce(sum(CAST(pr.TubesPerCarton AS DOUBLE) * tt.RTEConversion), 0), 0) AS repackRTEs
      FROM cur_ma_Repack_Input_CartonT r
      JOIN cur_ma_Pallet_DetailT p ON r.FromPalletDetailID = p.PalletDetailID
      JOIN cur_ma_Grader_BatchT b ON p.GraderBatchID = b.GraderBatchID
      JOIN cur_sw_SeasonT se ON b.SeasonID = se.SeasonID
      LEFT JOIN cur_sw_ProductT pr ON p.ProductID = pr.ProductID
      LEFT JOIN cur_sw_Tube_TypeT tt ON pr.TubeTypeID = tt.TubeTypeID
      WHERE se.SeasonDesc IN {O.in_list([str(x) for x in PACK_SEASONS])}
      GROUP BY p.GraderBatchID""",
    "relabel_after_group": lambda: f"""SELECT GraderBatchID,
        CASE WHEN {' OR '.join(f"Defect = {O.q(x)}" for x in C.RUSSET_SOURCE_LABELS)}
             THEN {O.q(C.RUSSET_LABEL)} ELSE Defect END AS Defect, defectQty
      FROM (SELECT a.GraderBatchID, df.Defect,
                   CASE WHEN count(d.DefectQty) = count(*) THEN sum(d.DefectQty) END AS defectQty
            FROM cur_qa_Assessment_DefectT d
            JOIN cur_qa_AssessmentT a ON d.AssessmentID = a.AssessmentID
            LEFT JOIN cur_qa_DefectT df ON d.DefectID = df.DefectID
            GROUP BY a.GraderBatchID, df.Defect) g""",
}

LEGACY_ONLY, CURRENT_ONLY = [2017, 2018], [2021, 2022]

CHECKS: dict[str, Check] = {}


def _add(name, build, sql, schema, note=""):
    CHECKS[name] = Check(name, build, sql, schema, note)


_add("scan_prune", scan_prune, _SQL["scan_prune"],
     _schema(("BinDeliveryID", L), ("ConsignmentNumber", L), ("HarvestDate", DT), ("NoOfBins", I)))
_add("lookup_chain", lookup_chain, _SQL["lookup_chain"],
     _schema(("GraderBatchID", L), ("FarmCode", S), ("FarmName", S), ("BlockCode", S),
             ("SubdivisionDesc", S), ("owner", S), ("PickNo", I)))
_add("fact_to_header", fact_to_header, _SQL["fact_to_header"],
     _schema(("AssessmentDefectID", L), ("AssessmentID", L), ("DefectQty", I), ("GraderBatchID", L),
             ("SampleQty", I), ("SeasonID", I)))
_add("anti_unweighed_pallets", anti_unweighed_pallets, _SQL["anti_unweighed_pallets"],
     _schema(("PalletDetailID", L), ("GraderBatchID", L), ("NoOfUnits", I)))
_add("semi_presize_batches", semi_presize_batches, _SQL["semi_presize_batches"],
     _schema(("BinDeliveryID", L), ("PresizeOutputFromGraderBatchID", L), ("TotalWeight", D)))
_add("inner_repack_pallet", inner_repack_pallet, _SQL["inner_repack_pallet"],
     _schema(("FromPalletDetailID", L), ("RepackID", L), ("RepackedNoOfUnits", L),
             ("GraderBatchID", L), ("ProductID", L)))
_add("composite_key_join", composite_key_join, _SQL["composite_key_join"],
     _schema(("Season", I), ("GraderBatchID", L), ("sampleQty", L), ("InputKgs", D)))
_add("code_map_season", code_map_season, _SQL["code_map_season"],
     _schema(("GraderBatchID", L), ("SeasonID", I), ("Season", I)))
_add("timestamp_season", timestamp_season, _SQL["timestamp_season"],
     _schema(("PalletDetailID", L), ("Season", I)))
_add("strict_sum_by_group", strict_sum_by_group, _SQL["strict_sum_by_group"],
     _schema(("AssessmentID", L), ("DefectID", I), ("defectQty", L), ("n_rows", L)))
_add("sum_or_zero_by_group", sum_or_zero_by_group, _SQL["sum_or_zero_by_group"],
     _schema(("GraderBatchID", L), ("fieldBinsTipped", D)))
_add("max_representative_bin", max_representative_bin, _SQL["max_representative_bin"],
     _schema(("GraderBatchID", L), ("BinID", L), ("BinQty", D), ("BlockID", L), ("HarvestDate", DT)))
_add("prefix_pack_split", prefix_pack_split, _SQL["prefix_pack_split"],
     _schema(("GraderBatchID", L), ("tubePacks", D), ("exportBins", D), ("japanTrayPacks", D),
             ("tempZPacks", D)))
_add("union_generations", union_generations, _SQL["union_generations"], _UNION_SCHEMA)
_add("normalise_owner", normalise_owner, _SQL["normalise_owner"],
     _schema(("GraderBatchID", L), ("rawOwner", S), ("owner", S)))
_add("half_even_round", half_even_round, _SQL["half_even_round"],
     _schema(("GraderBatchID", L), ("units", D), ("roundedUnits", D)))
_add("safe_ratio", safe_ratio, _SQL["safe_ratio"],
     _schema(("BinDeliveryID", L), ("ratio_class", S), ("ratio", D)),
     note="+-Inf / NaN are reported as a class, the finite value separately")
_add("to_int_text", to_int_text, _SQL["to_int_text"],
     _schema(("GraderBatchID", L), ("rawText", S), ("asInt", I)))
_add("storage_days", storage_days, _SQL["storage_days"],
     _schema(("GraderBatchID", L), ("storageDays", D)))
_add("relabel_after_group", relabel_after_group, _SQL["relabel_after_group"],
     _schema(("GraderBatchID", L), ("Defect", S), ("defectQty", L)))
_add("juice_weight", lambda cat: juice_weight(cat, ALL_SEASONS), _SQL["juice_weight"],
     _schema(("GraderBatchID", L), ("juiceKgs", D)))
_add("sample_weight", sample_weight, _SQL["sample_weight"],
     _schema(("GraderBatchID", L), ("sampleKgs", D)))
_add("export_weight", lambda cat: export_weight(cat, ALL_SEASONS), _SQL["export_weight"],
     _schema(("GraderBatchID", L), ("exportKgs", D)))
_add("loose_weight", loose_weight, _SQL["loose_weight"],
     _schema(("GraderBatchID", L), ("looseKgs", D)))
_add("presize_units", lambda cat: presize_units(cat, PACK_SEASONS), _SQL["presize_units"],
     _schema(("GraderBatchID", L), ("PSgrowerRTEs", D)))
_add("repack_units", lambda cat: repack_units(cat, PACK_SEASONS), _SQL["repack_units"],
     _schema(("GraderBatchID", L), ("repackRTEs", D)))

_add("batch_packout", lambda cat: batch_packout(cat, ALL_SEASONS),
     lambda: O.batch_packout_sql(ALL_SEASONS), BATCH_PACKOUT)
_add("batch_packout_legacy", lambda cat: batch_packout(cat, LEGACY_ONLY),
     lambda: O.batch_packout_sql(LEGACY_ONLY), BATCH_PACKOUT)
_add("batch_packout_current", lambda cat: batch_packout(cat, CURRENT_ONLY),
     lambda: O.batch_packout_sql(CURRENT_ONLY), BATCH_PACKOUT)
_add("packout_from_state", packout_from_state,
     lambda: O.batch_packout_sql(CURRENT_ONLY), BATCH_PACKOUT,
     note="T10: the state of each season computed apart, then merged")
_add("season_state", season_state, _SQL["season_state"], STATE)
_add("defect_share", lambda cat: defect_share(cat, ALL_SEASONS),
     lambda: O.defect_share_sql(ALL_SEASONS), DEFECT_SHARE)
_add("pack_units", lambda cat: pack_units(cat, PACK_SEASONS),
     lambda: O.pack_units_sql(PACK_SEASONS), PACK_UNITS)
_add("bin_intake", lambda cat: bin_intake(cat, ALL_SEASONS),
     lambda: O.bin_intake_sql(ALL_SEASONS), BIN_INTAKE)


def run(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return run_on(TestdataCatalog.shared(spark, sf_dir), name)


def run_on(cat: Catalog, name: str) -> DataFrame:
    check = CHECKS[name]
    return rounded(check.build(cat), check.schema)
