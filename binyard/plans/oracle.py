"""DuckDB oracle SQL for the correctness gate.

Two parts:

* ``view_ctes()`` - the test-data mapping of ``binyard.sources.testdata`` in
  DuckDB SQL, one CTE per ERP table (``cur_<table>`` / ``leg_<table>``),
  conformed to the declared schemas.  The code lists are rendered from the
  very same Python rows the Spark side loads.
* report SQL - the four reports written the reference's way (three pallet
  queries, left join + IS NULL, pivot-free but per-code sums, self-join for
  the storage site...), independently of the Spark plans, so the Spark plans'
  rewrites are checked against the plain semantics.
"""

from __future__ import annotations

from pyspark.sql import types as T

from binyard import config as C
from binyard.config import CURRENT, LEGACY
from binyard.plans.schemas import BATCH_PACKOUT
from binyard.sources.schemas import SCHEMAS
from binyard.sources.testdata import (
    COMPANY_NAME_BY_MOD20, DEFECT_BY_EVENT_TYPE, GRADE_BY_PART_TYPE, LOOKUP_ROWS,
)

_DUCK_TYPES = {
    T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE",
    T.StringType: "VARCHAR", T.BooleanType: "BOOLEAN", T.DateType: "DATE",
    T.TimestampNTZType: "TIMESTAMP",
}


def duck_type(dt: T.DataType) -> str:
    return _DUCK_TYPES[type(dt)]


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def _lit(v, dt) -> str:
    if v is None:
        return f"CAST(NULL AS {duck_type(dt)})"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(dt, T.DoubleType):
        return f"CAST('{float(v)!r}' AS DOUBLE)"
    if isinstance(v, str):
        return q(v)
    return f"CAST({int(v)} AS {duck_type(dt)})"


def conform_sql(body: str, schema: T.StructType, round_doubles: int | None = None) -> str:
    cols = []
    for f in schema.fields:
        expr = f"CAST({f.name} AS {duck_type(f.dataType)})"
        if round_doubles is not None and isinstance(f.dataType, T.DoubleType):
            expr = f"round({expr}, {round_doubles})"
        cols.append(f"{expr} AS {f.name}")
    return f"SELECT {', '.join(cols)} FROM ({body}) AS _b"


def _values(gen: str, name: str) -> str:
    schema = SCHEMAS[gen][name]
    rows = ", ".join("(" + ", ".join(_lit(v, f.dataType) for v, f in zip(r, schema.fields)) + ")"
                     for r in LOOKUP_ROWS[(gen, name)])
    names = ", ".join(f.name for f in schema.fields)
    return f"SELECT * FROM (VALUES {rows}) AS _v({names})"


# ----------------------------------------------------------- derived tables

_CUR_ORDERS = "(SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00')"
_LEG_ORDERS = "(SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00')"
_DIGIT = "CAST(substr(o_orderpriority, 1, 1) AS INTEGER)"
_SEASON_ID = "CAST(year(o_orderdate) - 1993 AS INTEGER)"
_STORAGE_ID = "CASE WHEN o_orderstatus = 'F' THEN 4 WHEN o_orderstatus = 'O' THEN 7 ELSE 9 END"
_HARVEST = "CAST(CAST(o_orderdate AS DATE) + INTERVAL 21 YEAR AS DATE)"
_HARVEST_BIN = ("CASE WHEN o_orderkey % 19 = 0 "
                "THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 22 YEAR AS DATE) "
                f"ELSE {_HARVEST} END")
_BIN_QTY = "CASE WHEN l_orderkey % 23 <> 0 THEN CAST(l_linenumber AS DOUBLE) END"


def _case(col: str, pairs, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {col} = {q(k) if isinstance(k, str) else k} THEN "
                     f"{q(v) if isinstance(v, str) else v}" for k, v in pairs)
    return f"CASE {whens}" + (f" ELSE {default}" if default else "") + " END"


def _company_name() -> str:
    padded = ("CASE WHEN s_suppkey % 20 = 9 THEN '  ' || s_name || ' ' "
              "WHEN s_suppkey % 20 = 10 THEN s_name || chr(9) "
              "ELSE replace(s_name, '#', ' # ') END")
    return _case("s_suppkey % 20", COMPANY_NAME_BY_MOD20, padded)


def _assessments(orders: str) -> str:
    return f"""SELECT o_orderkey AS AssessmentID,
        CASE WHEN o_orderkey % 29 <> 0 THEN o_orderkey END AS GraderBatchID,
        {_DIGIT} AS TemplateID, o_custkey % 30 AS BlockID, o_custkey AS FarmID,
        CAST(o_orderkey % 6 + 1 AS INTEGER) AS GradeID,
        CASE WHEN o_orderkey % 37 <> 0
             THEN CAST(floor(o_totalprice / CAST('1000.0' AS DOUBLE)) AS INTEGER) END AS SampleQty,
        {_SEASON_ID} AS SeasonID
      FROM {orders}"""


def _bins_common() -> str:
    return f"""{_SEASON_ID} AS SeasonID, {_HARVEST_BIN} AS HarvestDate,
        CAST(o_orderkey % 20 + 1 AS INTEGER) AS NoOfBins, o_custkey AS FarmID,
        o_custkey % 30 AS BlockID, {_STORAGE_ID} AS StorageTypeID,
        (o_orderkey % 3 <> 1) AS PresizeFlag, o_orderkey % 12 AS FirstStorageSiteCompanyID,
        o_orderpriority AS Comment"""


_DERIVED = {
    "sw_FarmT": """SELECT c_custkey AS FarmID, c_mktsegment AS FarmCode,
        CASE WHEN c_custkey % 13 <> 0 THEN c_name END AS FarmName,
        c_custkey % 110 AS GrowerCompanyID FROM customer""",
    "sw_Farm_BlockT": """SELECT CAST(n_nationkey AS BIGINT) AS BlockID,
        'B' || CAST(n_nationkey AS VARCHAR) AS BlockCode, n_name AS BlockName,
        CAST(n_regionkey AS BIGINT) AS SubdivisionID FROM nation""",
    "sw_SubdivisionT": """SELECT CAST(r_regionkey AS BIGINT) AS SubdivisionID,
        'S' || CAST(r_regionkey AS VARCHAR) AS SubdivisionCode, r_name AS SubdivisionDesc
        FROM region""",
    "sw_CompanyT": f"SELECT s_suppkey AS CompanyID, {_company_name()} AS CompanyName FROM supplier",
    "qa_Assessment_DefectT": f"""SELECT event_id AS AssessmentDefectID,
        event_id // 4 AS AssessmentID,
        {_case('event_type', DEFECT_BY_EVENT_TYPE,
               'CASE WHEN event_id % 2 = 0 THEN 5 ELSE 6 END')} AS DefectID,
        CASE WHEN event_id % 17 <> 0 THEN CAST(floor(value) AS INTEGER) END AS DefectQty
      FROM events""",
}

_CURRENT_DERIVED = {
    "qa_AssessmentT": _assessments(_CUR_ORDERS),
    "ma_Grader_BatchT": f"""SELECT o_orderkey AS GraderBatchID,
        CAST(o_orderkey AS VARCHAR) AS GraderBatchNo, {_SEASON_ID} AS SeasonID,
        {_HARVEST} + CAST(o_orderkey % 120 AS INTEGER) AS PackDate, {_HARVEST} AS HarvestDate,
        o_totalprice AS InputKgs,
        CASE WHEN o_orderkey % 7 <> 0 THEN CAST('0.1' AS DOUBLE) * o_totalprice END AS WasteOtherKgs,
        (o_orderkey % 11 = 0) AS PresizeInputFlag, {_STORAGE_ID} AS StorageTypeID,
        {_DIGIT} AS ShiftID, {_DIGIT} AS PickNoID, o_custkey AS FarmID,
        o_custkey % 30 AS BlockID, {_DIGIT} AS MaturityID, o_custkey % 110 AS GrowerCompanyID,
        CAST(o_orderkey % 4 AS INTEGER) AS GraderLineID
      FROM {_CUR_ORDERS}""",
    "ma_Bin_DeliveryT": f"""SELECT o_orderkey AS BinDeliveryID, o_orderkey AS BinDeliveryNo,
        {_bins_common()}, {_DIGIT} AS MaturityID,
        CAST(o_orderkey % 5 AS INTEGER) AS TagID, CAST(o_orderkey % 4 AS INTEGER) AS TreatmentID,
        {_HARVEST_BIN} + CAST(o_orderkey % 3 AS INTEGER) AS ReceivedDate,
        {_DIGIT} AS PickNoID, CAST(o_orderkey % 3 AS INTEGER) AS GrowingTypeID,
        CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice END AS TotalWeight,
        CASE WHEN o_orderkey % 10 = 0 THEN 278 WHEN o_orderkey % 10 = 1 THEN 90
             ELSE o_orderkey % 180 END AS PresizeProductID,
        o_orderkey - o_orderkey % 8 AS PresizeOutputFromGraderBatchID
      FROM {_CUR_ORDERS}""",
    "ma_Pallet_DetailT": """SELECT l_orderkey * 10 + l_linenumber AS PalletDetailID,
        l_orderkey AS PalletID, min(l_partkey) AS ProductID,
        CAST(sum(l_quantity) AS INTEGER) AS NoOfUnits, l_orderkey % 110 AS GrowerCompanyID,
        l_orderkey AS GraderBatchID, min(l_shipdate) + INTERVAL 21 YEAR AS CreatedDateTime
      FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "ma_Export_Bin_DetailT": """SELECT
        l_orderkey * 100 + l_linenumber * 10 + l_suppkey % 10 AS ExportBinDetailID,
        l_orderkey * 10 + l_linenumber AS PalletDetailID, l_quantity AS KGWeight,
        l_shipdate + INTERVAL 21 YEAR AS CreatedDateTime
      FROM lineitem WHERE l_returnflag = 'A'""",
    "ma_Repack_Input_CartonT": """SELECT l_orderkey * 10 + l_linenumber AS FromPalletDetailID,
        l_suppkey % 5 AS RepackID, l_partkey AS CartonNo
      FROM lineitem WHERE l_returnflag = 'R'""",
    "ma_Bin_UsageT": f"""SELECT l_orderkey AS GraderBatchID, {_BIN_QTY} AS BinQty,
        l_shipdate + INTERVAL 21 YEAR AS CreatedDateTime FROM lineitem""",
    "sw_ProductT": f"""SELECT p_partkey AS ProductID, p_name AS ProductDesc,
        p_retailprice / CAST('1000.0' AS DOUBLE) AS NetFruitWeight,
        (p_type = 'SMALL') AS SampleFlag, (p_type = 'PROMO') AS PresizeFlag,
        {_case('p_type', GRADE_BY_PART_TYPE)} AS GradeID, p_size AS TubesPerCarton,
        p_size % 3 AS PackTypeID, CAST(substr(p_brand, 7, 10) AS INTEGER) AS TubeTypeID,
        p_size % 4 AS CountID, CAST(p_partkey % 6 AS INTEGER) AS DesignationID,
        p_size % 5 AS SizeID FROM part""",
}

_LEGACY_DERIVED = {
    "qa_AssessmentT": _assessments(_LEG_ORDERS),
    "ma_Grader_BatchT": f"""SELECT o_orderkey AS GraderBatchID,
        CAST(o_orderkey AS VARCHAR) AS GraderBatchNo, {_SEASON_ID} AS SeasonID,
        o_custkey AS FarmID, {_HARVEST} + CAST(o_orderkey % 120 AS INTEGER) AS PackDate,
        o_totalprice AS InputKgs, CAST('0.2' AS DOUBLE) * o_totalprice AS RejectKgs
      FROM {_LEG_ORDERS}""",
    "ma_BinT": f"""SELECT o_orderkey AS BinID, o_orderkey AS BinNo, {_bins_common()},
        CAST(o_custkey % 6 AS INTEGER) AS ESPID,
        {_HARVEST_BIN} + CAST(o_orderkey % 3 AS INTEGER) AS BinReceivedDate
      FROM {_LEG_ORDERS}""",
    "ma_Bin_UsageT": f"""SELECT CASE WHEN l_orderkey % 31 <> 0 THEN l_orderkey END AS GraderBatchID,
        (l_orderkey + 37 * l_linenumber) % 1500 AS BinID, {_BIN_QTY} AS BinQty FROM lineitem""",
}

_PREFIX = {CURRENT: "cur", LEGACY: "leg"}


def view_name(gen: str, name: str) -> str:
    return f"{_PREFIX[gen]}_{name}"


def _view_body(gen: str, name: str) -> str:
    if (gen, name) in LOOKUP_ROWS:
        return _values(gen, name)
    own = _CURRENT_DERIVED if gen == CURRENT else _LEGACY_DERIVED
    return own.get(name) or _DERIVED[name]


def view_ctes() -> str:
    """Every ERP table of both generations as a CTE list (no leading WITH)."""
    parts = []
    for gen in (LEGACY, CURRENT):
        for name, schema in SCHEMAS[gen].items():
            parts.append(f"{view_name(gen, name)} AS ({conform_sql(_view_body(gen, name), schema)})")
    return ",\n".join(parts)


def with_views(body_ctes: str, select: str) -> str:
    ctes = view_ctes() + (",\n" + body_ctes if body_ctes else "")
    return f"WITH {ctes}\n{select}"


# ------------------------------------------------------------ SQL snippets


def season_case(col: str, gen: str) -> str:
    codes = C.CURRENT_SEASON_CODES if gen == CURRENT else C.LEGACY_SEASON_CODES
    return _case(col, sorted(codes.items()))


def ts_season(col: str) -> str:
    whens = " ".join(
        f"WHEN {col} >= TIMESTAMP '{y}-01-01 00:00:00' AND {col} < TIMESTAMP '{y + 1}-01-01 00:00:00'"
        f" THEN {y}" for y in sorted(C.CURRENT_SEASON_CODES.values()))
    return f"CASE {whens} END"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) if isinstance(v, str) else str(int(v)) for v in values) + ")"


def norm_owner(col: str) -> str:
    return (f"replace(lower(regexp_replace(regexp_replace({col}, '^\\s+', ''), '\\s+$', '')),"
            f" ' ', '')")


def to_int(col: str) -> str:
    plain = f"lower(trim({col}))"
    d = (f"CASE WHEN starts_with({plain}, '0x') THEN CAST(TRY_CAST({plain} AS BIGINT) AS DOUBLE) "
         f"ELSE TRY_CAST({col} AS DOUBLE) END")
    return (f"CASE WHEN {d} > -2147483648.0 AND {d} < 2147483648.0 "
            f"THEN CAST(trunc({d}) AS INTEGER) END")


def num_text(col: str) -> str:
    d = f"CAST({col} AS DOUBLE)"
    return (f"CASE WHEN {d} = floor({d}) THEN CAST(CAST({d} AS BIGINT) AS VARCHAR) "
            f"ELSE CAST({col} AS VARCHAR) END")


def rtrim_eq(col: str, literal: str) -> str:
    return f"rtrim({col}, ' ') = {q(literal.rstrip(' '))}"


def storage_type_by_id(col: str) -> str:
    return _case(col, C.STORAGE_TYPE_BY_ID, q(C.STORAGE_TYPE_DEFAULT))


# ------------------------------------------------------------------ reports


def season_state_sql(seasons) -> str:
    """Sum, non-NULL count and row count per batch, measure and fact season.
    Sample and loose units are summed per product (and export row), export
    weights per pallet, before their rows are counted."""
    s = in_list(seasons)
    juice, made = season_case("b.SeasonID", CURRENT), ts_season("p.CreatedDateTime")
    return f"""WITH
pal AS (
  SELECT p.GraderBatchID, p.ProductID, {made} AS FactSeason, x.PalletDetailID IS NULL AS loose, sum(p.NoOfUnits) AS units
  FROM cur_ma_Pallet_DetailT p
  LEFT JOIN (SELECT DISTINCT PalletDetailID FROM cur_ma_Export_Bin_DetailT) x ON p.PalletDetailID = x.PalletDetailID
  WHERE {made} IN {s} GROUP BY 1, 2, 3, 4),
weighed AS (
  SELECT pal.*, pal.units * pr.NetFruitWeight AS v, pr.SampleFlag, g.GradeDesc, pt.PoolByRule
  FROM pal LEFT JOIN cur_sw_ProductT pr ON pal.ProductID = pr.ProductID
  LEFT JOIN cur_sw_GradeT g ON pr.GradeID = g.GradeID
  LEFT JOIN cur_sys_fi_Pool_TypeT pt ON g.PoolTypeID = pt.PoolTypeID),
exported AS (
  SELECT q.GraderBatchID, p.PalletDetailID, {made} AS FactSeason, sum(p.KGWeight) AS v
  FROM cur_ma_Export_Bin_DetailT p JOIN cur_ma_Pallet_DetailT q ON p.PalletDetailID = q.PalletDetailID
  WHERE {made} IN {s} GROUP BY 1, 2, 3 HAVING sum(p.KGWeight) IS NOT NULL),
presize AS (
  SELECT bd.PresizeOutputFromGraderBatchID AS GraderBatchID, CAST(se.SeasonDesc AS INTEGER) AS FactSeason,
         (bd.TotalWeight / tt.PresizeAvgTubeWeight) * tt.RTEConversion AS v
  FROM cur_ma_Bin_DeliveryT bd
  JOIN cur_sw_ProductT pr ON bd.PresizeProductID = pr.ProductID
  LEFT JOIN cur_sw_Tube_TypeT tt ON pr.TubeTypeID = tt.TubeTypeID
  LEFT JOIN cur_sw_GradeT g ON pr.GradeID = g.GradeID
  LEFT JOIN cur_sw_SeasonT se ON bd.SeasonID = se.SeasonID
  WHERE bd.PresizeFlag AND g.JuiceFlag = FALSE AND se.SeasonDesc IN {in_list([str(y) for y in seasons])}
    AND NOT (bd.TotalWeight IS NULL AND bd.PresizeProductID = {C.PRESIZE_SKIP_NULL_WEIGHT_PRODUCT_ID})),
rows_ AS (
  SELECT b.PresizeOutputFromGraderBatchID AS GraderBatchID, {juice} AS FactSeason, 'juice' AS measure, b.TotalWeight AS v
  FROM cur_ma_Bin_DeliveryT b WHERE b.PresizeProductID = {C.JUICE_PRODUCT_ID} AND {juice} IN {s}
  UNION ALL SELECT GraderBatchID, FactSeason, 'sample', v FROM weighed WHERE SampleFlag
  UNION ALL SELECT GraderBatchID, FactSeason, 'loose', v FROM weighed
    WHERE loose AND PoolByRule = {q(C.POOL_BY_WEIGHT)} AND GradeDesc <> {q(C.EXCLUDED_LOOSE_GRADE)}
  UNION ALL SELECT GraderBatchID, FactSeason, 'loose', v FROM exported
  UNION ALL SELECT p.GraderBatchID, {made}, 'tipped', p.BinQty FROM cur_ma_Bin_UsageT p WHERE {made} IN {s}
  UNION ALL SELECT GraderBatchID, FactSeason, 'presize', v FROM presize)
SELECT GraderBatchID, FactSeason, measure, sum(v) AS total, count(v) AS present, count(*) AS rows
FROM rows_ WHERE GraderBatchID IS NOT NULL GROUP BY GraderBatchID, FactSeason, measure"""


def batch_packout_sql(seasons) -> str:
    """Body (CTEs + SELECT) of the batch pack-out report for ``seasons``."""
    s = in_list(seasons)
    cur_season, leg_season = season_case("b.SeasonID", CURRENT), season_case("b.SeasonID", LEGACY)
    return f"""WITH
juice AS (
  SELECT PresizeOutputFromGraderBatchID AS GraderBatchID, sum(TotalWeight) AS juiceKgs
  FROM cur_ma_Bin_DeliveryT b
  WHERE PresizeProductID = {C.JUICE_PRODUCT_ID} AND {cur_season} IN {s}
  GROUP BY PresizeOutputFromGraderBatchID),
sample AS (
  SELECT p.GraderBatchID, sum(p.NoOfUnits * pr.NetFruitWeight) AS sampleKgs
  FROM cur_ma_Pallet_DetailT p LEFT JOIN cur_sw_ProductT pr ON p.ProductID = pr.ProductID
  WHERE {ts_season('p.CreatedDateTime')} IN {s} AND pr.SampleFlag
  GROUP BY p.GraderBatchID),
hdr AS (
  SELECT b.*, f.FarmCode, f.FarmName, bl.BlockCode, bl.BlockName, sd.SubdivisionCode,
         sd.SubdivisionDesc, m.MaturityCode, c.CompanyName AS owner, sh.ShiftCode, pn.PickNo,
         {cur_season} AS Season
  FROM cur_ma_Grader_BatchT b
  LEFT JOIN cur_sw_FarmT f ON b.FarmID = f.FarmID
  LEFT JOIN cur_sw_Farm_BlockT bl ON b.BlockID = bl.BlockID
  LEFT JOIN cur_sw_MaturityT m ON b.MaturityID = m.MaturityID
  LEFT JOIN cur_sw_CompanyT c ON b.GrowerCompanyID = c.CompanyID
  LEFT JOIN cur_ma_ShiftT sh ON b.ShiftID = sh.ShiftID
  LEFT JOIN cur_sw_SubdivisionT sd ON bl.SubdivisionID = sd.SubdivisionID
  LEFT JOIN cur_sw_Pick_NoT pn ON b.PickNoID = pn.PickNoID
  WHERE b.PresizeInputFlag = FALSE AND {cur_season} IN {s}),
loose1 AS (
  SELECT p.GraderBatchID, sum(e.KGWeight) AS looseKgs
  FROM cur_ma_Export_Bin_DetailT e
  JOIN (SELECT PalletDetailID, GraderBatchID FROM cur_ma_Pallet_DetailT) p
    ON e.PalletDetailID = p.PalletDetailID
  WHERE {ts_season('e.CreatedDateTime')} IN {s}
  GROUP BY p.GraderBatchID),
loose2 AS (
  SELECT p.GraderBatchID, p.NoOfUnits * pr.NetFruitWeight AS looseKgs
  FROM cur_ma_Pallet_DetailT p
  LEFT JOIN cur_sw_ProductT pr ON p.ProductID = pr.ProductID
  LEFT JOIN cur_sw_GradeT g ON pr.GradeID = g.GradeID
  LEFT JOIN cur_sys_fi_Pool_TypeT pt ON g.PoolTypeID = pt.PoolTypeID
  LEFT JOIN cur_ma_Export_Bin_DetailT e ON p.PalletDetailID = e.PalletDetailID
  WHERE {ts_season('p.CreatedDateTime')} IN {s}
    AND pt.PoolByRule = {q(C.POOL_BY_WEIGHT)} AND e.ExportBinDetailID IS NULL
    AND g.GradeDesc <> {q(C.EXCLUDED_LOOSE_GRADE)}),
loose AS (
  SELECT GraderBatchID, coalesce(sum(looseKgs), 0) AS looseKgs
  FROM (SELECT GraderBatchID, looseKgs FROM loose2
        UNION ALL SELECT GraderBatchID, looseKgs FROM loose1) u
  GROUP BY GraderBatchID),
tipped AS (
  SELECT GraderBatchID, coalesce(sum(BinQty), 0) AS fieldBinsTipped
  FROM cur_ma_Bin_UsageT WHERE {ts_season('CreatedDateTime')} IN {s}
  GROUP BY GraderBatchID),
cur AS (
  SELECT h.GraderBatchID, {to_int('h.GraderBatchNo')} AS GraderBatchNo, h.Season,
    {norm_owner('h.owner')} AS owner, h.FarmCode, h.FarmName, h.BlockCode, h.BlockName,
    h.SubdivisionCode, h.SubdivisionDesc, h.HarvestDate, h.PackDate, h.ShiftCode,
    CAST(h.PackDate - h.HarvestDate AS DOUBLE) AS storageDays, t.fieldBinsTipped, h.InputKgs,
    h.WasteOtherKgs + coalesce(j.juiceKgs, 0) + coalesce(sa.sampleKgs, 0)
      + coalesce(l.looseKgs, 0) AS rejectKgs,
    CAST(1 AS DOUBLE) - (h.WasteOtherKgs + coalesce(j.juiceKgs, 0) + coalesce(sa.sampleKgs, 0)
      + coalesce(l.looseKgs, 0)) / h.InputKgs AS packOut,
    h.MaturityCode, {storage_type_by_id('h.StorageTypeID')} AS StorageType, h.PickNo
  FROM hdr h
  LEFT JOIN juice j ON h.GraderBatchID = j.GraderBatchID
  LEFT JOIN sample sa ON h.GraderBatchID = sa.GraderBatchID
  LEFT JOIN loose l ON h.GraderBatchID = l.GraderBatchID
  LEFT JOIN tipped t ON h.GraderBatchID = t.GraderBatchID
  WHERE h.WasteOtherKgs IS NOT NULL),
lhdr AS (
  SELECT b.GraderBatchID, b.GraderBatchNo, {leg_season} AS Season, b.PackDate, b.InputKgs,
         b.RejectKgs, c.CompanyName AS owner, f.FarmCode, f.FarmName
  FROM leg_ma_Grader_BatchT b
  LEFT JOIN leg_sw_FarmT f ON b.FarmID = f.FarmID
  LEFT JOIN leg_sw_CompanyT c ON f.GrowerCompanyID = c.CompanyID
  WHERE {leg_season} IN {s}),
lbins AS (
  SELECT u.GraderBatchID, u.BinQty, bt.HarvestDate, bl.BlockCode, bl.BlockName,
         sd.SubdivisionCode, sd.SubdivisionDesc, st.StorageTypeDesc, es.ESPCode
  FROM (SELECT GraderBatchID, max(BinID) AS BinID, sum(BinQty) AS BinQty
        FROM leg_ma_Bin_UsageT GROUP BY GraderBatchID) u
  LEFT JOIN leg_ma_BinT bt ON u.BinID = bt.BinID
  LEFT JOIN leg_sw_Farm_BlockT bl ON bt.BlockID = bl.BlockID
  LEFT JOIN leg_sw_SubdivisionT sd ON bl.SubdivisionID = sd.SubdivisionID
  LEFT JOIN leg_sw_Storage_TypeT st ON bt.StorageTypeID = st.StorageTypeID
  LEFT JOIN leg_sw_ESPT es ON bt.ESPID = es.ESPID
  WHERE u.GraderBatchID IS NOT NULL),
leg AS (
  SELECT h.GraderBatchID, {to_int('h.GraderBatchNo')} AS GraderBatchNo, h.Season,
    {norm_owner('h.owner')} AS owner, h.FarmCode, h.FarmName, b.BlockCode, b.BlockName,
    b.SubdivisionCode, b.SubdivisionDesc, b.HarvestDate, h.PackDate,
    {q(C.LEGACY_SHIFT_CODE)} AS ShiftCode,
    CAST(h.PackDate - b.HarvestDate AS DOUBLE) AS storageDays, b.BinQty AS fieldBinsTipped,
    h.InputKgs, h.RejectKgs AS rejectKgs, CAST(1 AS DOUBLE) - h.RejectKgs / h.InputKgs AS packOut,
    b.ESPCode AS MaturityCode,
    {_case('b.StorageTypeDesc', C.STORAGE_TYPE_BY_TEXT, q(C.STORAGE_TYPE_DEFAULT))} AS StorageType,
    CAST(NULL AS INTEGER) AS PickNo
  FROM lhdr h LEFT JOIN lbins b ON h.GraderBatchID = b.GraderBatchID)
SELECT * FROM leg UNION ALL BY NAME SELECT * FROM cur"""


def defect_share_sql(seasons) -> str:
    s = in_list(seasons)
    parts = []
    for gen, templates in ((LEGACY, C.LEGACY_TEMPLATES), (CURRENT, C.CURRENT_TEMPLATES)):
        p = _PREFIX[gen]
        season = season_case("a.SeasonID", gen)
        t = in_list(templates)
        parts.append(f"""{p}_def AS (
  SELECT d.DefectQty, a.GraderBatchID, df.Defect, {season} AS Season
  FROM {p}_qa_Assessment_DefectT d
  LEFT JOIN {p}_qa_AssessmentT a ON d.AssessmentID = a.AssessmentID
  LEFT JOIN {p}_qa_TemplateT t ON a.TemplateID = t.TemplateID
  LEFT JOIN {p}_qa_DefectT df ON d.DefectID = df.DefectID
  WHERE t.TemplateName IN {t} AND {season} IN {s}),
{p}_sq AS (
  SELECT {season} AS Season, a.GraderBatchID, sum(a.SampleQty) AS sampleQty
  FROM {p}_qa_AssessmentT a LEFT JOIN {p}_qa_TemplateT t ON a.TemplateID = t.TemplateID
  WHERE a.GraderBatchID IS NOT NULL AND t.TemplateName IN {t} AND {season} IN {s}
  GROUP BY 1, 2)""")
    others = [f.name for f in BATCH_PACKOUT.fields if f.name not in ("Season", "GraderBatchID")]
    g_cols = ", ".join(f"g.{c}" for c in others)
    russet = " OR ".join(f"da.Defect = {q(x)}" for x in C.RUSSET_SOURCE_LABELS)
    return f"""WITH
{','.join(parts)},
gbd AS ({batch_packout_sql(seasons)}),
da AS (
  SELECT Season, GraderBatchID, Defect,
         CASE WHEN count(DefectQty) = count(*) THEN sum(DefectQty) END AS defectQty
  FROM (SELECT * FROM leg_def UNION ALL SELECT * FROM cur_def) u
  GROUP BY Season, GraderBatchID, Defect),
sq AS (SELECT * FROM leg_sq UNION ALL SELECT * FROM cur_sq)
SELECT da.Season, da.GraderBatchID,
  CASE WHEN {russet} THEN {q(C.RUSSET_LABEL)} ELSE da.Defect END AS Defect,
  da.defectQty, sq.sampleQty, {g_cols},
  (CAST(1 AS DOUBLE) - g.packOut) * da.defectQty / sq.sampleQty AS proportion
FROM da
LEFT JOIN sq ON da.Season = sq.Season AND da.GraderBatchID = sq.GraderBatchID
LEFT JOIN gbd g ON da.Season = g.Season AND da.GraderBatchID = g.GraderBatchID
WHERE g.FarmName IS NOT NULL"""


def tube_split_sql(seasons) -> str:
    sd = in_list([str(int(x)) for x in seasons])
    code = (f"dg.DesignationCode || cn.CountCode || {num_text('pr.TubesPerCarton')} || "
            f"{num_text('tt.FruitPerTube')} || {num_text('td.TubeDiameter')} || sz.SizeCode")

    def pref(p):
        return f"coalesce(sum(CASE WHEN starts_with(upper(code), {q(p.upper())}) THEN u END), 0)"

    return f"""WITH
tube AS (
  SELECT p.GraderBatchID, {code} AS code,
         CAST(p.NoOfUnits AS DOUBLE) * pr.TubesPerCarton * tt.RTEConversion AS units
  FROM cur_ma_Pallet_DetailT p
  LEFT JOIN cur_ma_Grader_BatchT b ON p.GraderBatchID = b.GraderBatchID
  LEFT JOIN cur_sw_ProductT pr ON p.ProductID = pr.ProductID
  LEFT JOIN cur_sw_Tube_TypeT tt ON pr.TubeTypeID = tt.TubeTypeID
  LEFT JOIN cur_sw_CountT cn ON pr.CountID = cn.CountID
  LEFT JOIN cur_sw_DesignationT dg ON pr.DesignationID = dg.DesignationID
  LEFT JOIN cur_sw_SizeT sz ON pr.SizeID = sz.SizeID
  LEFT JOIN cur_sw_Tube_DiameterT td ON tt.TubeDiameterID = td.TubeDiameterID
  LEFT JOIN cur_sw_SeasonT se ON b.SeasonID = se.SeasonID
  WHERE se.SeasonDesc IN {sd} AND p.NoOfUnits <> 0
    AND pr.PresizeFlag = FALSE AND pr.SampleFlag = FALSE),
bycode AS (
  SELECT GraderBatchID, code, coalesce(sum(units), 0) AS u FROM tube GROUP BY GraderBatchID, code),
wide AS (
  SELECT GraderBatchID, sum(u) AS total,
         {pref(C.EXPORT_BIN_PREFIX)} AS exportBins,
         round_even({pref(C.JAPAN_TRAY_PREFIX)}, 0) AS japanTrayPacks,
         CASE WHEN GraderBatchID >= {C.TEMPZ_FIRST_BATCH_ID} THEN {pref(C.TEMPZ_PREFIX)}
              ELSE CAST(0 AS DOUBLE) END AS tempZPacks
  FROM bycode GROUP BY GraderBatchID)
SELECT GraderBatchID,
       round_even(total - exportBins - japanTrayPacks - tempZPacks, 0) AS tubePacks,
       exportBins, japanTrayPacks, tempZPacks
FROM wide"""


def pack_units_sql(seasons) -> str:
    sd = in_list([str(int(x)) for x in seasons])
    return f"""WITH
split AS ({tube_split_sql(seasons)}),
ps AS (
  SELECT bd.PresizeOutputFromGraderBatchID AS GraderBatchID,
         (bd.TotalWeight / tt.PresizeAvgTubeWeight) * tt.RTEConversion AS v
  FROM cur_ma_Bin_DeliveryT bd
  JOIN (SELECT GraderBatchID FROM cur_ma_Grader_BatchT) b
    ON bd.PresizeOutputFromGraderBatchID = b.GraderBatchID
  JOIN cur_sw_ProductT pr ON bd.PresizeProductID = pr.ProductID
  LEFT JOIN cur_sw_Tube_TypeT tt ON pr.TubeTypeID = tt.TubeTypeID
  LEFT JOIN cur_sw_GradeT g ON pr.GradeID = g.GradeID
  LEFT JOIN cur_sw_SeasonT se ON bd.SeasonID = se.SeasonID
  WHERE bd.PresizeFlag AND g.JuiceFlag = FALSE AND se.SeasonDesc IN {sd}
    AND NOT (bd.TotalWeight IS NULL AND bd.PresizeProductID = {C.PRESIZE_SKIP_NULL_WEIGHT_PRODUCT_ID})),
psum AS (
  SELECT GraderBatchID, round_even(CASE WHEN count(v) = count(*) THEN sum(v) END, 0) AS PSgrowerRTEs
  FROM ps GROUP BY GraderBatchID),
rp AS (
  SELECT p.GraderBatchID, CAST(r.n AS DOUBLE) * pr.TubesPerCarton * tt.RTEConversion AS v
  FROM (SELECT FromPalletDetailID, RepackID, count(*) AS n
        FROM cur_ma_Repack_Input_CartonT GROUP BY FromPalletDetailID, RepackID) r
  JOIN cur_ma_Pallet_DetailT p ON r.FromPalletDetailID = p.PalletDetailID
  LEFT JOIN cur_ma_Grader_BatchT b ON p.GraderBatchID = b.GraderBatchID
  LEFT JOIN cur_sw_ProductT pr ON p.ProductID = pr.ProductID
  LEFT JOIN cur_sw_Tube_TypeT tt ON pr.TubeTypeID = tt.TubeTypeID
  LEFT JOIN cur_sw_SeasonT se ON b.SeasonID = se.SeasonID
  WHERE se.SeasonDesc IN {sd}),
rsum AS (
  SELECT GraderBatchID, round_even(coalesce(sum(v), 0), 0) AS repackRTEs
  FROM rp GROUP BY GraderBatchID),
hdr AS (
  SELECT b.GraderBatchID, f.FarmName, bl.BlockName, se.SeasonDesc
  FROM cur_ma_Grader_BatchT b
  LEFT JOIN cur_sw_FarmT f ON b.FarmID = f.FarmID
  LEFT JOIN cur_sw_Farm_BlockT bl ON b.BlockID = bl.BlockID
  LEFT JOIN cur_sw_SeasonT se ON b.SeasonID = se.SeasonID
  WHERE se.SeasonDesc IN {sd}),
joined AS (
  SELECT h.GraderBatchID, h.FarmName, h.BlockName, h.SeasonDesc, s.tubePacks, s.exportBins,
         s.japanTrayPacks, s.tempZPacks, coalesce(p.PSgrowerRTEs, 0) AS PSgrowerRTEs,
         coalesce(r.repackRTEs, 0) AS repackRTEs
  FROM hdr h
  LEFT JOIN split s ON h.GraderBatchID = s.GraderBatchID
  LEFT JOIN psum p ON h.GraderBatchID = p.GraderBatchID
  LEFT JOIN rsum r ON h.GraderBatchID = r.GraderBatchID)
SELECT *, tubePacks + exportBins + japanTrayPacks + tempZPacks + PSgrowerRTEs + repackRTEs
          AS totalGrowerRTEs
FROM joined"""


def bin_intake_sql(seasons) -> str:
    s = in_list(seasons)
    cur_season, leg_season = season_case("b.SeasonID", CURRENT), season_case("b.SeasonID", LEGACY)
    te_ipu = rtrim_eq("sc.CompanyName", C.CURRENT_SITE_COMPANY)
    cur_site = (f"CASE WHEN {te_ipu} AND b.SeasonID > {C.CURRENT_SITE_SPLIT_SEASON_ID} "
                f"THEN {q(C.CURRENT_SITE_NEW)} "
                f"WHEN {te_ipu} AND b.SeasonID <= {C.CURRENT_SITE_SPLIT_SEASON_ID} "
                f"THEN {q(C.CURRENT_SITE_OLD)} "
                + " ".join(f"WHEN {rtrim_eq('sc.CompanyName', k)} THEN {q(v)}"
                           for k, v in C.CURRENT_SITE_BY_NAME)
                + f" ELSE {q(C.CURRENT_SITE_DEFAULT)} END")
    leg_site = ("CASE " + " ".join(f"WHEN {rtrim_eq('sc.CompanyName', k)} THEN {q(v)}"
                                   for k, v in C.LEGACY_SITE_BY_NAME)
                + " ELSE sc.CompanyName END")
    return f"""WITH
cur_site AS (
  SELECT b.BinDeliveryID, {cur_site} AS StorageSite
  FROM cur_ma_Bin_DeliveryT b LEFT JOIN cur_sw_CompanyT sc ON b.FirstStorageSiteCompanyID = sc.CompanyID
  WHERE b.PresizeFlag = FALSE),
cur AS (
  SELECT b.BinDeliveryID, b.BinDeliveryNo AS ConsignmentNumber, {cur_season} AS Season,
    b.HarvestDate, b.NoOfBins, b.Comment, b.ReceivedDate, bl.BlockCode, bl.BlockName,
    f.FarmCode, f.FarmName, sd.SubdivisionCode, sd.SubdivisionDesc,
    {norm_owner('c.CompanyName')} AS owner, pn.PickNoDesc, tr.TreatmentDesc, tg.TagDesc,
    gt.GrowingTypeDesc, m.MaturityCode, {storage_type_by_id('b.StorageTypeID')} AS StorageType
  FROM cur_ma_Bin_DeliveryT b
  LEFT JOIN cur_sw_Farm_BlockT bl ON b.BlockID = bl.BlockID
  LEFT JOIN cur_sw_FarmT f ON b.FarmID = f.FarmID
  LEFT JOIN cur_sw_SubdivisionT sd ON bl.SubdivisionID = sd.SubdivisionID
  LEFT JOIN cur_sw_CompanyT c ON f.GrowerCompanyID = c.CompanyID
  LEFT JOIN cur_sw_Pick_NoT pn ON b.PickNoID = pn.PickNoID
  LEFT JOIN cur_sw_TreatmentT tr ON b.TreatmentID = tr.TreatmentID
  LEFT JOIN cur_sw_TagT tg ON b.TagID = tg.TagID
  LEFT JOIN cur_sw_Growing_TypeT gt ON b.GrowingTypeID = gt.GrowingTypeID
  LEFT JOIN cur_sw_MaturityT m ON b.MaturityID = m.MaturityID
  WHERE b.PresizeFlag = FALSE),
leg_site AS (
  SELECT b.BinID AS BinDeliveryID, {leg_site} AS StorageSite
  FROM leg_ma_BinT b LEFT JOIN leg_sw_CompanyT sc ON b.FirstStorageSiteCompanyID = sc.CompanyID
  WHERE b.PresizeFlag = FALSE),
leg AS (
  SELECT b.BinID AS BinDeliveryID, b.BinNo AS ConsignmentNumber, {leg_season} AS Season,
    b.HarvestDate, b.NoOfBins, b.Comment, b.BinReceivedDate AS ReceivedDate, bl.BlockCode,
    bl.BlockName, f.FarmCode, f.FarmName, sd.SubdivisionCode, sd.SubdivisionDesc,
    {norm_owner('c.CompanyName')} AS owner, CAST(NULL AS VARCHAR) AS PickNoDesc,
    CAST(NULL AS VARCHAR) AS TreatmentDesc, CAST(NULL AS VARCHAR) AS TagDesc,
    CAST(NULL AS VARCHAR) AS GrowingTypeDesc, es.ESPCode AS MaturityCode,
    {storage_type_by_id('b.StorageTypeID')} AS StorageType
  FROM leg_ma_BinT b
  LEFT JOIN leg_sw_FarmT f ON b.FarmID = f.FarmID
  LEFT JOIN leg_sw_Farm_BlockT bl ON b.BlockID = bl.BlockID
  LEFT JOIN leg_sw_SubdivisionT sd ON bl.SubdivisionID = sd.SubdivisionID
  LEFT JOIN leg_sw_CompanyT c ON f.GrowerCompanyID = c.CompanyID
  LEFT JOIN leg_sw_ESPT es ON b.ESPID = es.ESPID
  WHERE b.PresizeFlag = FALSE AND {leg_season} = year(b.HarvestDate)),
bh AS (
  SELECT l.*, ls.StorageSite FROM leg l LEFT JOIN leg_site ls ON l.BinDeliveryID = ls.BinDeliveryID
  UNION ALL BY NAME
  SELECT c.*, cs.StorageSite FROM cur c LEFT JOIN cur_site cs ON c.BinDeliveryID = cs.BinDeliveryID)
SELECT * FROM bh WHERE Season IN {s}"""

