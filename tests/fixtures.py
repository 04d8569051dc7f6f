"""Hand-built ERP catalogs for the report trap tests (FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt

from binyard import config as C
from binyard.config import CURRENT, LEGACY
from binyard.sources.catalog import FrameCatalog
from binyard.sources.schemas import SCHEMAS

D = dt.date
TS = dt.datetime


def catalog(spark, tables: dict) -> FrameCatalog:
    """``tables`` maps (generation, table) to a list of dicts; absent tables are empty."""
    frames = {}
    for gen, by_name in SCHEMAS.items():
        for name, schema in by_name.items():
            rows = tables.get((gen, name), [])
            frames[(gen, name)] = (lambda rows=rows, schema=schema: spark.createDataFrame(
                [tuple(r.get(f.name) for f in schema.fields) for r in rows], schema))
    return FrameCatalog(spark, frames)


# the legacy site-map key that ends in a blank
_BLANK_KEY = next(k for k, _ in C.LEGACY_SITE_BY_NAME if k.endswith(" "))
BLANK_KEY_SITE = dict(C.LEGACY_SITE_BY_NAME)[_BLANK_KEY]


def _shared(gen):
    return {
        (gen, "sw_FarmT"): [dict(FarmID=1, FarmCode="F1", FarmName="Farm one", GrowerCompanyID=1),
                            dict(FarmID=2, FarmCode="F2", FarmName=None, GrowerCompanyID=2)],
        (gen, "sw_Farm_BlockT"): [
            dict(BlockID=1, BlockCode="B1", BlockName="Block one", SubdivisionID=1),
            dict(BlockID=2, BlockCode="B2", BlockName="Block two", SubdivisionID=1)],
        (gen, "sw_SubdivisionT"): [dict(SubdivisionID=1, SubdivisionCode="S1",
                                        SubdivisionDesc="North")],
        (gen, "sw_CompanyT"): [dict(CompanyID=1, CompanyName="  Foo Bar\t"),
                               dict(CompanyID=2, CompanyName="Other Growers"),
                               dict(CompanyID=7, CompanyName=_BLANK_KEY.rstrip(" ")),
                               dict(CompanyID=8, CompanyName="Unknown Co"),
                               dict(CompanyID=9, CompanyName=C.CURRENT_SITE_COMPANY)],
    }


def _batch(gid, **kw):
    row = dict(GraderBatchID=gid, GraderBatchNo=str(gid), SeasonID=7, PackDate=D(2021, 3, 10),
               HarvestDate=D(2021, 3, 1), InputKgs=100.0, WasteOtherKgs=10.0,
               PresizeInputFlag=False, StorageTypeID=4, ShiftID=1, PickNoID=1, FarmID=1,
               BlockID=1, MaturityID=1, GrowerCompanyID=1, GraderLineID=1)
    row.update(kw)
    return row


def packhouse(spark) -> FrameCatalog:
    """Scenario for batch_packout / defect_share (both generations)."""
    t = {**_shared(CURRENT), **_shared(LEGACY)}
    t[(CURRENT, "ma_Grader_BatchT")] = [
        _batch(1, GraderBatchNo="12.7"),
        _batch(2, GraderBatchNo="abc", InputKgs=0.0, WasteOtherKgs=5.0),
        _batch(3, GraderBatchNo="12", InputKgs=0.0, WasteOtherKgs=0.0),
        _batch(4, WasteOtherKgs=None),
        _batch(5, PresizeInputFlag=True),
        _batch(6, SeasonID=8, StorageTypeID=9),
    ]
    t[(CURRENT, "ma_ShiftT")] = [dict(ShiftID=1, ShiftCode="Day")]
    t[(CURRENT, "sw_MaturityT")] = [dict(MaturityID=1, MaturityCode="M1")]
    t[(CURRENT, "sw_Pick_NoT")] = [dict(PickNoID=1, PickNoDesc="First", PickNo=1)]
    t[(CURRENT, "sw_ProductT")] = [
        dict(ProductID=50, NetFruitWeight=0.5, SampleFlag=True, PresizeFlag=False, GradeID=1),
        dict(ProductID=60, NetFruitWeight=2.0, SampleFlag=False, PresizeFlag=False, GradeID=1),
        dict(ProductID=70, NetFruitWeight=2.0, SampleFlag=False, PresizeFlag=False, GradeID=3),
        dict(ProductID=80, NetFruitWeight=2.0, SampleFlag=False, PresizeFlag=False, GradeID=2),
    ]
    t[(CURRENT, "sw_GradeT")] = [dict(GradeID=1, GradeDesc="Export", PoolTypeID=1, JuiceFlag=False),
                                 dict(GradeID=2, GradeDesc="Push Pack", PoolTypeID=1, JuiceFlag=False),
                                 dict(GradeID=3, GradeDesc=None, PoolTypeID=1, JuiceFlag=False)]
    t[(CURRENT, "sys_fi_Pool_TypeT")] = [dict(PoolTypeID=1, PoolByRule="KG")]
    may = TS(2021, 5, 1)

    def pallet(pid, product, units, created=may, batch=1):
        return dict(PalletDetailID=pid, PalletID=pid, ProductID=product, NoOfUnits=units,
                    GrowerCompanyID=1, GraderBatchID=batch, CreatedDateTime=created)

    t[(CURRENT, "ma_Pallet_DetailT")] = [
        pallet(10, 50, 4),                       # sample: 2.0
        pallet(11, 60, 3),                       # loose by units: 6.0
        pallet(12, 60, 10),                      # has export rows: counts by KGWeight only
        pallet(13, 70, 5),                       # NULL grade description: excluded
        pallet(14, 80, 5),                       # Push Pack: excluded
        pallet(15, 50, 100, TS(2022, 1, 5)),     # sample created next year (T10)
    ]
    t[(CURRENT, "ma_Export_Bin_DetailT")] = [
        dict(ExportBinDetailID=1, PalletDetailID=12, KGWeight=1.5, CreatedDateTime=TS(2021, 6, 1)),
        dict(ExportBinDetailID=2, PalletDetailID=12, KGWeight=2.5, CreatedDateTime=TS(2021, 6, 1)),
    ]
    t[(CURRENT, "ma_Bin_DeliveryT")] = [
        dict(BinDeliveryID=1, SeasonID=7, PresizeProductID=278, TotalWeight=3.0,
             PresizeOutputFromGraderBatchID=1, PresizeFlag=True),
    ]
    t[(CURRENT, "ma_Bin_UsageT")] = [
        dict(GraderBatchID=1, BinQty=2.0, CreatedDateTime=TS(2021, 4, 1)),
        dict(GraderBatchID=1, BinQty=3.0, CreatedDateTime=TS(2021, 4, 2)),
        dict(GraderBatchID=1, BinQty=7.0, CreatedDateTime=TS(2020, 12, 31)),
        dict(GraderBatchID=3, BinQty=None, CreatedDateTime=TS(2021, 4, 1)),
    ]
    # legacy generation; batch 1 clashes with the current batch 1 on purpose
    t[(LEGACY, "ma_Grader_BatchT")] = [
        dict(GraderBatchID=1, GraderBatchNo="7", SeasonID=4, FarmID=1, PackDate=D(2018, 4, 10),
             InputKgs=50.0, RejectKgs=5.0),
        dict(GraderBatchID=2, GraderBatchNo="8", SeasonID=4, FarmID=2, PackDate=D(2018, 4, 10),
             InputKgs=0.0, RejectKgs=0.0),
    ]
    t[(LEGACY, "ma_Bin_UsageT")] = [
        dict(GraderBatchID=1, BinID=5, BinQty=1.0), dict(GraderBatchID=1, BinID=9, BinQty=2.0),
        dict(GraderBatchID=2, BinID=3, BinQty=None), dict(GraderBatchID=None, BinID=9, BinQty=4.0),
    ]
    t[(LEGACY, "ma_BinT")] = [
        dict(BinID=5, SeasonID=4, HarvestDate=D(2018, 3, 1), BlockID=1, StorageTypeID=7, ESPID=0),
        dict(BinID=9, SeasonID=4, HarvestDate=D(2018, 4, 1), BlockID=2, StorageTypeID=4, ESPID=1),
    ]
    t[(LEGACY, "sw_Storage_TypeT")] = [dict(StorageTypeID=4, StorageTypeDesc="CA & Smartfreshed"),
                                       dict(StorageTypeID=7, StorageTypeDesc="Normal Air")]
    t[(LEGACY, "sw_ESPT")] = [dict(ESPID=0, ESPCode="E0"), dict(ESPID=1, ESPCode="E1")]
    # QA (current): batch 1 has two assessments of the selected template
    for gen in (CURRENT, LEGACY):
        t[(gen, "qa_TemplateT")] = [dict(TemplateID=1, TemplateName="Grade Analysis"),
                                    dict(TemplateID=2, TemplateName="Reject Analysis"),
                                    dict(TemplateID=3, TemplateName="Packer Rejects")]
        t[(gen, "qa_DefectT")] = [dict(DefectID=1, Defect="Russet Cheek"),
                                  dict(DefectID=2, Defect="Russet Stem"),
                                  dict(DefectID=3, Defect="Bruise")]
    t[(CURRENT, "qa_AssessmentT")] = [
        dict(AssessmentID=1, GraderBatchID=1, TemplateID=1, SampleQty=10, SeasonID=7),
        dict(AssessmentID=2, GraderBatchID=1, TemplateID=1, SampleQty=10, SeasonID=7),
        dict(AssessmentID=3, GraderBatchID=None, TemplateID=1, SampleQty=5, SeasonID=7),
        dict(AssessmentID=4, GraderBatchID=1, TemplateID=3, SampleQty=99, SeasonID=7),
    ]
    t[(CURRENT, "qa_Assessment_DefectT")] = [
        dict(AssessmentDefectID=1, AssessmentID=1, DefectID=1, DefectQty=3),
        dict(AssessmentDefectID=2, AssessmentID=1, DefectID=2, DefectQty=4),
        dict(AssessmentDefectID=3, AssessmentID=1, DefectID=3, DefectQty=3),
        dict(AssessmentDefectID=4, AssessmentID=2, DefectID=3, DefectQty=None),
        dict(AssessmentDefectID=5, AssessmentID=4, DefectID=3, DefectQty=50),
        dict(AssessmentDefectID=6, AssessmentID=3, DefectID=3, DefectQty=1),
    ]
    t[(LEGACY, "qa_AssessmentT")] = [
        dict(AssessmentID=1, GraderBatchID=1, TemplateID=2, SampleQty=4, SeasonID=4)]
    t[(LEGACY, "qa_Assessment_DefectT")] = [
        dict(AssessmentDefectID=1, AssessmentID=1, DefectID=3, DefectQty=2)]
    return catalog(spark, t)


def pack_lines(spark) -> FrameCatalog:
    """Scenario for pack_units (current generation)."""
    t = dict(_shared(CURRENT))
    t[(CURRENT, "ma_Grader_BatchT")] = [
        _batch(g) for g in (2429, 2430, 100, 101, 102, 103, 104)] + [_batch(2431, SeasonID=8)]
    t[(CURRENT, "sw_SeasonT")] = [dict(SeasonID=7, SeasonDesc="2021"),
                                  dict(SeasonID=8, SeasonDesc="2022")]
    prod = dict(NetFruitWeight=1.0, SampleFlag=False, PresizeFlag=False, GradeID=1,
                TubesPerCarton=1, TubeTypeID=1, CountID=1, SizeID=1)
    t[(CURRENT, "sw_ProductT")] = [
        {**prod, "ProductID": 1, "DesignationID": 1},                   # ROC999...
        {**prod, "ProductID": 2, "DesignationID": 2},                   # roc999...
        {**prod, "ProductID": 3, "DesignationID": 3, "TubeTypeID": 3},  # JAP..., conversion 1.5
        {**prod, "ProductID": 4, "DesignationID": 4},                   # RKT...
        {**prod, "ProductID": 5, "DesignationID": 5, "SizeID": 9},      # size missing: NULL code
        {**prod, "ProductID": 6, "DesignationID": 1, "SampleFlag": True},
        {**prod, "ProductID": 7, "DesignationID": 1, "PresizeFlag": True},
        {**prod, "ProductID": 20, "TubeTypeID": 2, "GradeID": 1},
        {**prod, "ProductID": 21, "TubeTypeID": 2, "GradeID": 6},
        {**prod, "ProductID": 90, "TubeTypeID": 2, "GradeID": 1},
    ]
    t[(CURRENT, "sw_Tube_TypeT")] = [
        dict(TubeTypeID=1, RTEConversion=1.0, TubeDiameterID=1, FruitPerTube=3,
             PresizeAvgTubeWeight=1.0),
        dict(TubeTypeID=2, RTEConversion=1.0, TubeDiameterID=1, FruitPerTube=3,
             PresizeAvgTubeWeight=1.0),
        dict(TubeTypeID=3, RTEConversion=1.5, TubeDiameterID=1, FruitPerTube=3,
             PresizeAvgTubeWeight=1.0)]
    t[(CURRENT, "sw_Tube_DiameterT")] = [dict(TubeDiameterID=1, TubeDiameter=63.0)]
    t[(CURRENT, "sw_CountT")] = [dict(CountID=1, CountCode="999")]
    t[(CURRENT, "sw_SizeT")] = [dict(SizeID=1, SizeCode="S")]
    t[(CURRENT, "sw_DesignationT")] = [
        dict(DesignationID=1, DesignationCode="ROC"), dict(DesignationID=2, DesignationCode="roc"),
        dict(DesignationID=3, DesignationCode="JAP"), dict(DesignationID=4, DesignationCode="RKT"),
        dict(DesignationID=5, DesignationCode="TUB")]
    t[(CURRENT, "sw_GradeT")] = [dict(GradeID=1, GradeDesc="Export", PoolTypeID=1, JuiceFlag=False),
                                 dict(GradeID=6, GradeDesc="Juice", PoolTypeID=2, JuiceFlag=True)]
    pallets, pid = [], 0
    for batch in (2429, 2430):
        for product, units in ((1, 10), (2, 5), (3, 3), (4, 7), (5, 11), (1, 0), (6, 9), (7, 9)):
            pid += 1
            pallets.append(dict(PalletDetailID=pid, PalletID=pid, ProductID=product,
                                NoOfUnits=units, GraderBatchID=batch,
                                CreatedDateTime=TS(2021, 5, 1)))
    t[(CURRENT, "ma_Pallet_DetailT")] = pallets
    t[(CURRENT, "ma_Repack_Input_CartonT")] = [
        dict(FromPalletDetailID=1, RepackID=1, CartonNo=c) for c in range(3)]

    def ps(bid, batch, weight, product=20, season=7, flag=True):
        return dict(BinDeliveryID=bid, TotalWeight=weight, PresizeProductID=product,
                    SeasonID=season, PresizeOutputFromGraderBatchID=batch, PresizeFlag=flag)

    t[(CURRENT, "ma_Bin_DeliveryT")] = [
        ps(1, 100, 6.0), ps(2, 101, 2.5), ps(3, 102, 3.5), ps(4, 103, 1.0), ps(5, 103, None),
        ps(6, 104, 1.0, product=90), ps(7, 104, None, product=90),
        ps(8, 100, 50.0, product=21),          # juice grade: excluded
        ps(9, 999, 50.0),                      # output batch does not exist
        ps(10, 100, 50.0, season=8),           # other season
        ps(11, 100, 50.0, flag=False),         # not a presize bin
    ]
    return catalog(spark, t)


def bins(spark) -> FrameCatalog:
    """Scenario for bin_intake (both generations)."""
    t = {**_shared(CURRENT), **_shared(LEGACY)}

    def b(bid, season, harvest, site, presize=False, **kw):
        row = dict(SeasonID=season, HarvestDate=harvest, NoOfBins=1, FarmID=1, BlockID=1,
                   StorageTypeID=7, PresizeFlag=presize, FirstStorageSiteCompanyID=site,
                   Comment="c")
        row.update(kw)
        return row

    t[(LEGACY, "ma_BinT")] = [
        b(1, 4, D(2019, 2, 1), 7, BinID=1, BinNo=11),
        b(2, 4, D(2018, 2, 1), 7, BinID=2, BinNo=12),
        b(3, 4, D(2018, 2, 1), 7, presize=True, BinID=3, BinNo=13),
        b(5, 4, D(2018, 5, 1), 8, BinID=5, BinNo=15),
    ]
    t[(CURRENT, "ma_Bin_DeliveryT")] = [
        b(5, 7, D(2020, 12, 20), 9, BinDeliveryID=5, BinDeliveryNo=25, StorageTypeID=4),
        b(6, 6, D(2020, 3, 1), 9, BinDeliveryID=6, BinDeliveryNo=26),
        b(7, 6, D(2020, 3, 1), 9, BinDeliveryID=7, BinDeliveryNo=27),
    ]
    return catalog(spark, t)
