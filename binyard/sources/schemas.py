"""Declared schemas of the ERP source tables (only the columns the reports use).

Keys are ``LongType``: ids are not bounded by 2^31 at the target scale.
``BOUNDED`` lists the code/label lookups whose size is fixed by the ERP's code
lists, not by the volume of fruit; only those are broadcast by hint.  Lookups
that grow with the business (farms, blocks, companies, products) go through
Spark's size-checked automatic broadcast (static estimate and AQE runtime
statistics against ``spark.sql.autoBroadcastJoinThreshold``), with a shuffle
join beyond it.
"""

from __future__ import annotations

from pyspark.sql import types as T

from binyard.config import CURRENT, LEGACY

L, I, D, S, B = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.BooleanType()
DT, TS = T.DateType(), T.TimestampNTZType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


_SHARED = {
    "sw_FarmT": _schema(("FarmID", L), ("FarmCode", S), ("FarmName", S), ("GrowerCompanyID", L)),
    "sw_Farm_BlockT": _schema(("BlockID", L), ("BlockCode", S), ("BlockName", S), ("SubdivisionID", L)),
    "sw_SubdivisionT": _schema(("SubdivisionID", L), ("SubdivisionCode", S), ("SubdivisionDesc", S)),
    "sw_CompanyT": _schema(("CompanyID", L), ("CompanyName", S)),
    "qa_AssessmentT": _schema(("AssessmentID", L), ("GraderBatchID", L), ("TemplateID", I),
                              ("BlockID", L), ("FarmID", L), ("GradeID", I), ("SampleQty", I),
                              ("SeasonID", I)),
    "qa_Assessment_DefectT": _schema(("AssessmentDefectID", L), ("AssessmentID", L),
                                     ("DefectID", I), ("DefectQty", I)),
    "qa_TemplateT": _schema(("TemplateID", I), ("TemplateName", S)),
    "qa_DefectT": _schema(("DefectID", I), ("Defect", S)),
}

_CURRENT = {
    "ma_Grader_BatchT": _schema(
        ("GraderBatchID", L), ("GraderBatchNo", S), ("SeasonID", I), ("PackDate", DT),
        ("HarvestDate", DT), ("InputKgs", D), ("WasteOtherKgs", D), ("PresizeInputFlag", B),
        ("StorageTypeID", I), ("ShiftID", I), ("PickNoID", I), ("FarmID", L), ("BlockID", L),
        ("MaturityID", I), ("GrowerCompanyID", L), ("GraderLineID", I)),
    "ma_Bin_DeliveryT": _schema(
        ("BinDeliveryID", L), ("BinDeliveryNo", L), ("SeasonID", I), ("FarmID", L), ("BlockID", L),
        ("HarvestDate", DT), ("NoOfBins", I), ("MaturityID", I), ("StorageTypeID", I),
        ("PresizeFlag", B), ("TagID", I), ("TreatmentID", I), ("Comment", S), ("ReceivedDate", DT),
        ("PickNoID", I), ("GrowingTypeID", I), ("FirstStorageSiteCompanyID", L),
        ("TotalWeight", D), ("PresizeProductID", L), ("PresizeOutputFromGraderBatchID", L)),
    "ma_Pallet_DetailT": _schema(
        ("PalletDetailID", L), ("PalletID", L), ("ProductID", L), ("NoOfUnits", I),
        ("GrowerCompanyID", L), ("GraderBatchID", L), ("CreatedDateTime", TS)),
    "ma_Export_Bin_DetailT": _schema(
        ("ExportBinDetailID", L), ("PalletDetailID", L), ("KGWeight", D), ("CreatedDateTime", TS)),
    "ma_Bin_UsageT": _schema(("GraderBatchID", L), ("BinQty", D), ("CreatedDateTime", TS)),
    "ma_Repack_Input_CartonT": _schema(("FromPalletDetailID", L), ("RepackID", L), ("CartonNo", L)),
    "sw_Pick_NoT": _schema(("PickNoID", I), ("PickNoDesc", S), ("PickNo", I)),
    "sw_TreatmentT": _schema(("TreatmentID", I), ("TreatmentDesc", S)),
    "sw_TagT": _schema(("TagID", I), ("TagDesc", S)),
    "sw_Growing_TypeT": _schema(("GrowingTypeID", I), ("GrowingTypeDesc", S)),
    "sw_MaturityT": _schema(("MaturityID", I), ("MaturityCode", S)),
    "ma_ShiftT": _schema(("ShiftID", I), ("ShiftCode", S)),
    "sw_ProductT": _schema(
        ("ProductID", L), ("ProductDesc", S), ("NetFruitWeight", D), ("SampleFlag", B),
        ("PresizeFlag", B), ("GradeID", I), ("TubesPerCarton", I), ("PackTypeID", I),
        ("TubeTypeID", I), ("CountID", I), ("DesignationID", I), ("SizeID", I)),
    "sw_GradeT": _schema(("GradeID", I), ("GradeDesc", S), ("PoolTypeID", I), ("JuiceFlag", B)),
    "sys_fi_Pool_TypeT": _schema(("PoolTypeID", I), ("PoolByRule", S)),
    "sw_Tube_TypeT": _schema(
        ("TubeTypeID", I), ("RTEConversion", D), ("TubeDiameterID", I), ("FruitPerTube", I),
        ("TubeCharacter", S), ("PresizeAvgTubeWeight", D)),
    "sw_Tube_DiameterT": _schema(("TubeDiameterID", I), ("TubeDiameter", D)),
    "sw_Pack_TypeT": _schema(("PackTypeID", I), ("PackTypeDesc", S)),
    "sw_CountT": _schema(("CountID", I), ("CountCode", S)),
    "sw_DesignationT": _schema(("DesignationID", I), ("DesignationCode", S)),
    "sw_SizeT": _schema(("SizeID", I), ("SizeCode", S)),
    "sw_SeasonT": _schema(("SeasonID", I), ("SeasonDesc", S)),
}

_LEGACY = {
    "ma_Grader_BatchT": _schema(
        ("GraderBatchID", L), ("GraderBatchNo", S), ("SeasonID", I), ("FarmID", L),
        ("PackDate", DT), ("InputKgs", D), ("RejectKgs", D)),
    "ma_BinT": _schema(
        ("BinID", L), ("BinNo", L), ("SeasonID", I), ("HarvestDate", DT), ("NoOfBins", I),
        ("FarmID", L), ("BlockID", L), ("StorageTypeID", I), ("PresizeFlag", B),
        ("FirstStorageSiteCompanyID", L), ("Comment", S), ("ESPID", I), ("BinReceivedDate", DT)),
    "ma_Bin_UsageT": _schema(("GraderBatchID", L), ("BinID", L), ("BinQty", D)),
    "sw_ESPT": _schema(("ESPID", I), ("ESPCode", S)),
    "sw_Storage_TypeT": _schema(("StorageTypeID", I), ("StorageTypeDesc", S)),
}

SCHEMAS = {
    CURRENT: {**_SHARED, **_CURRENT},
    LEGACY: {**_SHARED, **_LEGACY},
}

BOUNDED = frozenset({
    "sw_SubdivisionT", "qa_TemplateT", "qa_DefectT", "sw_Pick_NoT", "sw_TreatmentT", "sw_TagT",
    "sw_Growing_TypeT", "sw_MaturityT", "ma_ShiftT", "sw_GradeT", "sys_fi_Pool_TypeT",
    "sw_Tube_TypeT", "sw_Tube_DiameterT", "sw_Pack_TypeT", "sw_CountT", "sw_DesignationT",
    "sw_SizeT", "sw_SeasonT", "sw_ESPT", "sw_Storage_TypeT",
})


#: Tables that grow with the fruit, and the id column that splits a read of
#: each.  A read of one of them must not be a single task.
FACTS = {
    (CURRENT, "ma_Grader_BatchT"): "GraderBatchID", (CURRENT, "ma_Bin_DeliveryT"): "BinDeliveryID",
    (CURRENT, "ma_Pallet_DetailT"): "PalletDetailID",
    (CURRENT, "ma_Export_Bin_DetailT"): "ExportBinDetailID",
    (CURRENT, "ma_Bin_UsageT"): "GraderBatchID",
    (CURRENT, "ma_Repack_Input_CartonT"): "FromPalletDetailID",
    (CURRENT, "qa_AssessmentT"): "AssessmentID",
    (CURRENT, "qa_Assessment_DefectT"): "AssessmentDefectID",
    (LEGACY, "ma_Grader_BatchT"): "GraderBatchID", (LEGACY, "ma_BinT"): "BinID",
    (LEGACY, "ma_Bin_UsageT"): "GraderBatchID", (LEGACY, "qa_AssessmentT"): "AssessmentID",
    (LEGACY, "qa_Assessment_DefectT"): "AssessmentDefectID",
}

#: Tables that no report joins to many-to-one.
_NO_KEY = {"ma_Bin_UsageT", "ma_Repack_Input_CartonT", "ma_Export_Bin_DetailT",
           "qa_Assessment_DefectT"}

#: Column that must be unique in a table: every lookup and header is joined on
#: it many-to-one.  NULL keys are allowed (they match nothing).
KEYS = {(gen, name): schema.fieldNames()[0]
        for gen, tables in SCHEMAS.items() for name, schema in tables.items() if name not in _NO_KEY}

#: Column of a derived partition: the year a row was created in.
CREATED, CREATED_YEAR = "CreatedDateTime", "CreatedYear"

#: Derived tables of a staged catalog.  Partitioned by the season text of the
#: batch: every current batch, and every pallet of one.  Partitioned by
#: creation year: every export row with the batch of its pallet.
BATCH_SEASON, PALLET_SEASON, EXPORT_BATCH = "BatchSeason", "PalletSeason", "ExportBatch"
DERIVED = {
    BATCH_SEASON: _schema(("GraderBatchID", L), ("SeasonDesc", S)),
    PALLET_SEASON: _schema(("PalletDetailID", L), ("GraderBatchID", L), ("ProductID", L), ("SeasonDesc", S)),
    EXPORT_BATCH: _schema(("GraderBatchID", L), ("PalletDetailID", L), ("KGWeight", D), (CREATED, TS), (CREATED_YEAR, I)),
}

#: Derived column of the staged pallets: an export row of any time names it.
EXPORTED = "Exported"

#: Column that a bucketed catalog deals each batch fact out by.
BUCKETED = {
    (CURRENT, "ma_Grader_BatchT"): "GraderBatchID", (CURRENT, "ma_Bin_UsageT"): "GraderBatchID",
    (CURRENT, "ma_Pallet_DetailT"): "GraderBatchID", (CURRENT, EXPORT_BATCH): "GraderBatchID",
    (CURRENT, "ma_Bin_DeliveryT"): "PresizeOutputFromGraderBatchID",
    (LEGACY, "ma_Grader_BatchT"): "GraderBatchID", (LEGACY, "ma_Bin_UsageT"): "GraderBatchID",
}


def schema_of(generation: str, name: str) -> T.StructType:
    try:
        return SCHEMAS[generation][name]
    except KeyError as exc:
        raise KeyError(f"unknown source table {generation}.{name}") from exc
