"""Derive the ERP source tables from the driver's TPC-H-like tables.

The reports read an orchard ERP (two generations of a star schema).  The test
tables in ``/root/testdata/sf*/`` are ``region nation customer supplier part
orders lineitem events``; this module maps them onto the ERP schema so the
unmodified reports run on them and their work grows with the scale factor.

Mapping (orders are split at 1999: earlier years are the legacy generation,
later ones the current; ``season = calendar year + 21``):

* batches, bins, assessments  <- ``orders``  (id = o_orderkey)
* pallets                     <- ``lineitem`` grouped by (l_orderkey, l_linenumber)
* export bins, repack cartons <- ``lineitem`` rows with return flag A / R
* bin usage                   <- ``lineitem`` rows
* farms / blocks / subdivisions / companies / products
                              <- ``customer`` / ``nation`` / ``region`` / ``supplier`` / ``part``
* assessment defects          <- ``events``
* code lists                  <- the literal rows in ``LOOKUP_ROWS``

Modulus rules plant the NULLs, unmatched keys and mixed flags that the
driver's data lacks.  ``binyard.plans.oracle`` holds the same mapping in
DuckDB SQL for the correctness oracle; the two must stay identical.

``AssessmentID = event_id div 4`` (about four defects per assessment, and the
number of assessed batches grows with the data instead of staying at 500),
and the zero tube weight sits on the tube type whose conversion is NULL, so
the hashed ``pack_units`` output stays finite (``safe_ratio`` reports the
infinite ratios).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from binyard import config as C
from binyard.config import CURRENT, LEGACY
from binyard.sources.catalog import FrameCatalog, local_table
from binyard.sources.schemas import schema_of

SPLIT_YEAR = 1999          # first order year that belongs to the current ERP
SEASON_CODE_OFFSET = 1993  # SeasonID = year(o_orderdate) - 1993
YEARS_SHIFT_MONTHS = 252   # dates move forward 21 years

# --------------------------------------------------------------------------
# Code lists (fixture values).  Rows follow the declared schema's column order.
# Gaps are deliberate: ids the facts use but the list lacks (left joins must
# keep the fact row with NULL attributes).
# --------------------------------------------------------------------------
# Tube type 13 has a NULL conversion and a zero tube weight: presize weight /
# 0 gives +Inf (T4) and Inf x NULL gives NULL, so the division-by-zero path
# runs while the hashed pack_units output stays finite; ``safe_ratio`` reports
# the infinite ratios themselves as a class.
_TUBE_TYPES = [
    (i,
     None if i == 13 else 1.0 + (i % 4) * 0.25,      # one NULL conversion
     i % 4,                                           # diameter 3 is missing
     3 + i % 3,
     "A" if i % 2 == 0 else None,
     0.0 if i == 13 else (10 + i) / 20.0)             # one zero tube weight (T4)
    for i in range(1, 26)
]

LOOKUP_ROWS = {
    (CURRENT, "sw_Pick_NoT"): [(1, "Pick one", 1), (2, "Pick two", 2), (3, "Pick three", 3),
                               (4, "Spot pick", 4)],
    (CURRENT, "sw_TreatmentT"): [(0, "None"), (1, "Smartfresh"), (2, "DPA")],
    (CURRENT, "sw_TagT"): [(0, "Red"), (1, "Blue"), (2, "Green"), (3, "Yellow")],
    (CURRENT, "sw_Growing_TypeT"): [(0, "Conventional"), (1, "Organic")],
    (CURRENT, "sw_MaturityT"): [(1, "M1"), (2, "M2"), (3, "M3"), (4, "M4")],
    (CURRENT, "ma_ShiftT"): [(1, "Day"), (2, "Night"), (3, "Day"), (4, "Night")],
    (CURRENT, "sw_GradeT"): [(1, "Export", 1, False), (2, "Push Pack", 1, False),
                             (3, None, 1, False), (4, "Presize", 2, False),
                             (5, "Sample", 1, False), (6, "Juice", 2, True)],
    (CURRENT, "sys_fi_Pool_TypeT"): [(1, "KG"), (2, "UNIT")],
    (CURRENT, "sw_Tube_TypeT"): _TUBE_TYPES,
    (CURRENT, "sw_Tube_DiameterT"): [(0, 63.0), (1, 63.5), (2, 70.0)],
    (CURRENT, "sw_Pack_TypeT"): [(0, "Tray"), (1, "Bag"), (2, "Bulk")],
    (CURRENT, "sw_CountT"): [(0, "999"), (1, "999"), (2, "100"), (3, "120")],
    (CURRENT, "sw_DesignationT"): [(0, "ROC"), (1, "roc"), (2, "JAP"), (3, "RKT"), (4, "TUB")],
    (CURRENT, "sw_SizeT"): [(0, "S"), (1, "M"), (2, "L"), (3, "XL"), (4, "XXL")],
    (CURRENT, "sw_SeasonT"): [(code, str(code + 2014)) for code in range(2, 10)],
    (LEGACY, "sw_ESPT"): [(0, "E0"), (1, "E1"), (2, "E2"), (3, "E3"), (4, "E4")],
    (LEGACY, "sw_Storage_TypeT"): [(4, "CA & Smartfreshed"), (7, "Normal Air"), (9, "Other")],
}
_SHARED_LOOKUP_ROWS = {
    "qa_TemplateT": [(1, "Grade Analysis"), (2, "Reject Analysis"), (3, "Packer Rejects"),
                     (4, "Defect Sorter Rejects"), (5, "Class 1.5 Analysis")],
    "qa_DefectT": [(1, "Russet Cheek"), (2, "Russet Stem"), (3, "Bruise"), (4, "Hail Damage"),
                   (5, "Sunburn")],
}
for _gen in (LEGACY, CURRENT):
    for _name, _rows in _SHARED_LOOKUP_ROWS.items():
        LOOKUP_ROWS[(_gen, _name)] = _rows

# Company names (suppkey mod 20 -> name): every company the storage-site maps
# name, taken from the configuration, then the blank-trimmed form of any name
# that ends in a blank (the server ignores trailing blanks, T7); other
# suppliers keep their name with blanks/tabs added (owner normalisation).
_SITE_COMPANIES = [C.CURRENT_SITE_COMPANY] + [k for k, _ in C.CURRENT_SITE_BY_NAME] + \
    [k for k, _ in C.LEGACY_SITE_BY_NAME]
_SITE_COMPANIES += [k.rstrip(" ") for k in _SITE_COMPANIES if k != k.rstrip(" ")]
COMPANY_NAME_BY_MOD20 = tuple(enumerate(dict.fromkeys(_SITE_COMPANIES)))

GRADE_BY_PART_TYPE = (("ECONOMY", 1), ("LARGE", 2), ("MEDIUM", 3), ("PROMO", 4), ("SMALL", 5),
                      ("STANDARD", 6))
DEFECT_BY_EVENT_TYPE = (("click", 1), ("error", 2), ("purchase", 3), ("signup", 4))


# ------------------------------------------------------------------ helpers


def _ntz(text: str) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{text}'")


def _plus_years(ts: Column) -> Column:
    return ts + F.expr("INTERVAL 21 YEARS")


def _digit(c: str) -> Column:
    return F.substring(F.col(c), 1, 1).cast("int")


def _season_id() -> Column:
    return (F.year("o_orderdate") - SEASON_CODE_OFFSET).cast("int")


def _harvest(extra_year_mod: int | None = None) -> Column:
    months = F.lit(YEARS_SHIFT_MONTHS)
    if extra_year_mod:
        months = F.when(F.col("o_orderkey") % extra_year_mod == 0, YEARS_SHIFT_MONTHS + 12) \
                  .otherwise(YEARS_SHIFT_MONTHS)
    return F.add_months(F.to_date("o_orderdate"), months)


def _storage_type_id() -> Column:
    s = F.col("o_orderstatus")
    return F.when(s == "F", 4).when(s == "O", 7).otherwise(9)


def _null_when(mod_col: str, mod: int, value: Column) -> Column:
    return F.when(F.col(mod_col) % mod != 0, value)


def _by_pairs(c: Column, pairs, default=None) -> Column:
    expr = None
    for key, val in pairs:
        expr = F.when(c == key, F.lit(val)) if expr is None else expr.when(c == key, F.lit(val))
    return expr if default is None else expr.otherwise(default)


_SHARED: dict = {}

# Tables derived with at most one row per row of a driver table (lookups one
# to one; batches, bins and assessments are orders split by generation).
_AT_MOST_ONE_PER_ROW = {
    "sw_FarmT": "customer", "sw_Farm_BlockT": "nation", "sw_SubdivisionT": "region",
    "sw_CompanyT": "supplier", "sw_ProductT": "part", "ma_Grader_BatchT": "orders",
    "ma_Bin_DeliveryT": "orders", "ma_BinT": "orders", "qa_AssessmentT": "orders"}


class TestdataCatalog(FrameCatalog):
    """ERP catalog derived lazily from ``<sf_dir>/<table>.parquet``."""

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.sf_dir = sf_dir.rstrip("/")
        tables = {}
        for gen in (LEGACY, CURRENT):
            for name in ("sw_FarmT", "sw_Farm_BlockT", "sw_SubdivisionT", "sw_CompanyT",
                         "qa_Assessment_DefectT"):
                tables[(gen, name)] = getattr(self, "_" + name)
            tables[(gen, "qa_AssessmentT")] = (lambda g=gen: self._qa_AssessmentT(g))
        for (gen, name), rows in LOOKUP_ROWS.items():
            tables[(gen, name)] = (lambda g=gen, n=name, r=rows:
                                   local_table(spark, r, schema_of(g, n)))
        for name in ("ma_Grader_BatchT", "ma_Bin_DeliveryT", "ma_Pallet_DetailT",
                     "ma_Export_Bin_DetailT", "ma_Bin_UsageT", "ma_Repack_Input_CartonT",
                     "sw_ProductT"):
            tables[(CURRENT, name)] = getattr(self, "_cur_" + name)
        for name in ("ma_Grader_BatchT", "ma_BinT", "ma_Bin_UsageT"):
            tables[(LEGACY, name)] = getattr(self, "_leg_" + name)
        super().__init__(spark, tables)

    def known_rows(self) -> dict:
        """The code lists are literal rows: their size is known exactly."""
        return {key: len(rows) for key, rows in LOOKUP_ROWS.items()}

    def row_bound(self, generation: str, name: str) -> int | None:
        """Code lists: their literal size.  Tables derived from at most one
        row per row of a driver table: that file's row count from its Parquet
        footer (the driver reads metadata only, no Spark job)."""
        known = self.known_rows().get((generation, name))
        if known is not None:
            return known
        raw = _AT_MOST_ONE_PER_ROW.get(name)
        if raw is None:
            return None
        cache = self.__dict__.setdefault("_footer_rows", {})
        if raw not in cache:
            import pyarrow.parquet as pq
            cache[raw] = pq.ParquetFile(f"{self.sf_dir}/{raw}.parquet").metadata.num_rows
        return cache[raw]

    def raw(self, name: str) -> DataFrame:
        cache = self.__dict__.setdefault("_raw", {})
        if name not in cache:
            cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return cache[name]

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> "TestdataCatalog":
        """One catalog per (session, directory), reused by every query."""
        key = (id(spark), sf_dir.rstrip("/"))
        cat = _SHARED.get(key)
        if cat is None or cat.spark is not spark:
            cat = _SHARED[key] = cls(spark, sf_dir)
        return cat

    def _orders(self, generation: str) -> DataFrame:
        split = F.col("o_orderdate") >= _ntz(f"{SPLIT_YEAR}-01-01 00:00:00")
        return self.raw("orders").filter(split if generation == CURRENT else ~split)

    # ------------------------------------------------------- shared lookups

    def _sw_FarmT(self):
        return self.raw("customer").select(
            F.col("c_custkey").alias("FarmID"),
            F.col("c_mktsegment").alias("FarmCode"),
            _null_when("c_custkey", 13, F.col("c_name")).alias("FarmName"),
            (F.col("c_custkey") % 110).alias("GrowerCompanyID"))

    def _sw_Farm_BlockT(self):
        return self.raw("nation").select(
            F.col("n_nationkey").cast("bigint").alias("BlockID"),
            F.concat(F.lit("B"), F.col("n_nationkey").cast("string")).alias("BlockCode"),
            F.col("n_name").alias("BlockName"),
            F.col("n_regionkey").cast("bigint").alias("SubdivisionID"))

    def _sw_SubdivisionT(self):
        return self.raw("region").select(
            F.col("r_regionkey").cast("bigint").alias("SubdivisionID"),
            F.concat(F.lit("S"), F.col("r_regionkey").cast("string")).alias("SubdivisionCode"),
            F.col("r_name").alias("SubdivisionDesc"))

    def _sw_CompanyT(self):
        k, name = F.col("s_suppkey") % 20, F.col("s_name")
        padded = (F.when(k == 9, F.concat(F.lit("  "), name, F.lit(" ")))
                  .when(k == 10, F.concat(name, F.lit("\t")))
                  .otherwise(F.regexp_replace(name, "#", " # ")))
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("CompanyID"),
            _by_pairs(k, COMPANY_NAME_BY_MOD20, padded).alias("CompanyName"))

    def _qa_AssessmentT(self, generation):
        return self._orders(generation).select(
            F.col("o_orderkey").alias("AssessmentID"),
            _null_when("o_orderkey", 29, F.col("o_orderkey")).alias("GraderBatchID"),
            _digit("o_orderpriority").alias("TemplateID"),
            (F.col("o_custkey") % 30).alias("BlockID"),
            F.col("o_custkey").alias("FarmID"),
            (F.col("o_orderkey") % 6 + 1).cast("int").alias("GradeID"),
            _null_when("o_orderkey", 37,
                       F.floor(F.col("o_totalprice") / F.lit(1000.0)).cast("int")).alias("SampleQty"),
            _season_id().alias("SeasonID"))

    def _qa_Assessment_DefectT(self):
        e = F.col("event_id")
        other = F.when(e % 2 == 0, 5).otherwise(6)
        return self.raw("events").select(
            e.alias("AssessmentDefectID"),
            F.expr("event_id div 4").alias("AssessmentID"),
            _by_pairs(F.col("event_type"), DEFECT_BY_EVENT_TYPE, other).alias("DefectID"),
            _null_when("event_id", 17, F.floor("value").cast("int")).alias("DefectQty"))

    # ------------------------------------------------------ current facts

    def _cur_ma_Grader_BatchT(self):
        k = F.col("o_orderkey")
        harvest = _harvest()
        return self._orders(CURRENT).select(
            k.alias("GraderBatchID"),
            k.cast("string").alias("GraderBatchNo"),
            _season_id().alias("SeasonID"),
            F.date_add(harvest, (k % 120).cast("int")).alias("PackDate"),
            harvest.alias("HarvestDate"),
            F.col("o_totalprice").alias("InputKgs"),
            _null_when("o_orderkey", 7, F.lit(0.1) * F.col("o_totalprice")).alias("WasteOtherKgs"),
            (k % 11 == 0).alias("PresizeInputFlag"),
            _storage_type_id().alias("StorageTypeID"),
            _digit("o_orderpriority").alias("ShiftID"),
            _digit("o_orderpriority").alias("PickNoID"),
            F.col("o_custkey").alias("FarmID"),
            (F.col("o_custkey") % 30).alias("BlockID"),
            _digit("o_orderpriority").alias("MaturityID"),
            (F.col("o_custkey") % 110).alias("GrowerCompanyID"),
            (k % 4).cast("int").alias("GraderLineID"))

    def _bins_common(self, generation):
        k = F.col("o_orderkey")
        harvest = _harvest(extra_year_mod=19)
        return self._orders(generation), k, harvest, [
            _season_id().alias("SeasonID"),
            harvest.alias("HarvestDate"),
            (k % 20 + 1).cast("int").alias("NoOfBins"),
            F.col("o_custkey").alias("FarmID"),
            (F.col("o_custkey") % 30).alias("BlockID"),
            _storage_type_id().alias("StorageTypeID"),
            (k % 3 != 1).alias("PresizeFlag"),
            (k % 12).alias("FirstStorageSiteCompanyID"),
            F.col("o_orderpriority").alias("Comment"),
        ]

    def _cur_ma_Bin_DeliveryT(self):
        orders, k, harvest, common = self._bins_common(CURRENT)
        product = F.when(k % 10 == 0, 278).when(k % 10 == 1, 90).otherwise(k % 180)
        return orders.select(
            k.alias("BinDeliveryID"), k.alias("BinDeliveryNo"), *common,
            _digit("o_orderpriority").alias("MaturityID"),
            (k % 5).cast("int").alias("TagID"),
            (k % 4).cast("int").alias("TreatmentID"),
            F.date_add(harvest, (k % 3).cast("int")).alias("ReceivedDate"),
            _digit("o_orderpriority").alias("PickNoID"),
            (k % 3).cast("int").alias("GrowingTypeID"),
            _null_when("o_orderkey", 9, F.col("o_totalprice")).alias("TotalWeight"),
            product.alias("PresizeProductID"),
            (k - k % 8).alias("PresizeOutputFromGraderBatchID"))

    def _cur_ma_Pallet_DetailT(self):
        return (self.raw("lineitem")
                .groupBy("l_orderkey", "l_linenumber")
                .agg(F.min("l_partkey").alias("ProductID"),
                     F.sum("l_quantity").cast("int").alias("NoOfUnits"),
                     F.min("l_shipdate").alias("first_ship"))
                .select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("PalletDetailID"),
                        F.col("l_orderkey").alias("PalletID"),
                        "ProductID", "NoOfUnits",
                        (F.col("l_orderkey") % 110).alias("GrowerCompanyID"),
                        F.col("l_orderkey").alias("GraderBatchID"),
                        _plus_years(F.col("first_ship")).alias("CreatedDateTime")))

    def _cur_ma_Export_Bin_DetailT(self):
        k, n = F.col("l_orderkey"), F.col("l_linenumber")
        return (self.raw("lineitem").filter(F.col("l_returnflag") == "A")
                .select((k * 100 + n * 10 + F.col("l_suppkey") % 10).alias("ExportBinDetailID"),
                        (k * 10 + n).alias("PalletDetailID"),
                        F.col("l_quantity").alias("KGWeight"),
                        _plus_years(F.col("l_shipdate")).alias("CreatedDateTime")))

    def _cur_ma_Repack_Input_CartonT(self):
        return (self.raw("lineitem").filter(F.col("l_returnflag") == "R")
                .select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("FromPalletDetailID"),
                        (F.col("l_suppkey") % 5).alias("RepackID"),
                        F.col("l_partkey").alias("CartonNo")))

    @staticmethod
    def _bin_qty() -> Column:
        return _null_when("l_orderkey", 23, F.col("l_linenumber").cast("double"))

    def _cur_ma_Bin_UsageT(self):
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("GraderBatchID"),
            self._bin_qty().alias("BinQty"),
            _plus_years(F.col("l_shipdate")).alias("CreatedDateTime"))

    def _cur_sw_ProductT(self):
        size = F.col("p_size")
        return self.raw("part").select(
            F.col("p_partkey").alias("ProductID"),
            F.col("p_name").alias("ProductDesc"),
            (F.col("p_retailprice") / F.lit(1000.0)).alias("NetFruitWeight"),
            (F.col("p_type") == "SMALL").alias("SampleFlag"),
            (F.col("p_type") == "PROMO").alias("PresizeFlag"),
            _by_pairs(F.col("p_type"), GRADE_BY_PART_TYPE).alias("GradeID"),
            size.alias("TubesPerCarton"),
            (size % 3).alias("PackTypeID"),
            F.substring("p_brand", 7, 10).cast("int").alias("TubeTypeID"),
            (size % 4).alias("CountID"),
            (F.col("p_partkey") % 6).cast("int").alias("DesignationID"),
            (size % 5).alias("SizeID"))

    # ------------------------------------------------------- legacy facts

    def _leg_ma_Grader_BatchT(self):
        k = F.col("o_orderkey")
        return self._orders(LEGACY).select(
            k.alias("GraderBatchID"),
            k.cast("string").alias("GraderBatchNo"),
            _season_id().alias("SeasonID"),
            F.col("o_custkey").alias("FarmID"),
            F.date_add(_harvest(), (k % 120).cast("int")).alias("PackDate"),
            F.col("o_totalprice").alias("InputKgs"),
            (F.lit(0.2) * F.col("o_totalprice")).alias("RejectKgs"))

    def _leg_ma_BinT(self):
        orders, k, harvest, common = self._bins_common(LEGACY)
        return orders.select(
            k.alias("BinID"), k.alias("BinNo"), *common,
            (F.col("o_custkey") % 6).cast("int").alias("ESPID"),
            F.date_add(harvest, (k % 3).cast("int")).alias("BinReceivedDate"))

    def _leg_ma_Bin_UsageT(self):
        k, n = F.col("l_orderkey"), F.col("l_linenumber")
        return self.raw("lineitem").select(
            _null_when("l_orderkey", 31, k).alias("GraderBatchID"),
            ((k + 37 * n) % 1500).alias("BinID"),
            self._bin_qty().alias("BinQty"))
