"""Output contracts of the four reports (column order is the reference's)."""

from __future__ import annotations

from pyspark.sql import types as T

L, I, D, S, DT = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.DateType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


BATCH_PACKOUT = _schema(
    ("GraderBatchID", L), ("GraderBatchNo", I), ("Season", I), ("owner", S), ("FarmCode", S),
    ("FarmName", S), ("BlockCode", S), ("BlockName", S), ("SubdivisionCode", S),
    ("SubdivisionDesc", S), ("HarvestDate", DT), ("PackDate", DT), ("ShiftCode", S),
    ("storageDays", D), ("fieldBinsTipped", D), ("InputKgs", D), ("rejectKgs", D),
    ("packOut", D), ("MaturityCode", S), ("StorageType", S), ("PickNo", I))

DEFECT_SHARE = _schema(
    ("Season", I), ("GraderBatchID", L), ("Defect", S), ("defectQty", L), ("sampleQty", L),
    *[(f.name, f.dataType) for f in BATCH_PACKOUT.fields
      if f.name not in ("Season", "GraderBatchID")],
    ("proportion", D))

PACK_UNITS = _schema(
    ("GraderBatchID", L), ("FarmName", S), ("BlockName", S), ("SeasonDesc", S),
    ("tubePacks", D), ("exportBins", D), ("japanTrayPacks", D), ("tempZPacks", D),
    ("PSgrowerRTEs", D), ("repackRTEs", D), ("totalGrowerRTEs", D))

BIN_INTAKE = _schema(
    ("BinDeliveryID", L), ("ConsignmentNumber", L), ("Season", I), ("HarvestDate", DT),
    ("NoOfBins", I), ("Comment", S), ("ReceivedDate", DT), ("BlockCode", S), ("BlockName", S),
    ("FarmCode", S), ("FarmName", S), ("SubdivisionCode", S), ("SubdivisionDesc", S),
    ("owner", S), ("PickNoDesc", S), ("TreatmentDesc", S), ("TagDesc", S),
    ("GrowingTypeDesc", S), ("MaturityCode", S), ("StorageType", S), ("StorageSite", S))
