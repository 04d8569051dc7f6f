"""A bucketed catalog: what is grouped or joined by batch is not exchanged.
Collations: server-side literals."""

import duckdb
import pytest

from binyard import batch_packout, bin_intake, pack_units
from binyard.config import CURRENT, ReportConfig
from binyard.functions.semantics import server_equals, to_int
from binyard.sources.catalog import ParquetCatalog
from binyard.sources.sinks import write_catalog
from binyard.sources.testdata import TestdataCatalog
from tests import fixtures
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def cat(spark):
    return TestdataCatalog(spark, SF_SMALL)


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    return write_catalog(TestdataCatalog(spark, SF_SMALL), str(tmp_path_factory.mktemp("bucketed")), buckets=8)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_packout_exchanges_nothing_by_batch(bucketed, cat):
    df = batch_packout(bucketed, [2021])
    text = plan(df)
    assert "Bucketed: true" in text and "hashpartitioning(GraderBatchID" not in text and "hashpartitioning(PresizeOutput" not in text
    assert "hashpartitioning(GraderBatchID" in plan(batch_packout(cat, [2021]))
    assert "PartitionFilters: [" in text and "CreatedYear" in text              # pruning still works beside the buckets
    assert rows(df) == rows(batch_packout(cat, [2021]))
    assert rows(batch_packout(bucketed, [2018, 2022])) == rows(batch_packout(cat, [2018, 2022]))
    assert rows(pack_units(bucketed, [2020, 2021])) == rows(pack_units(cat, [2020, 2021]))
    assert rows(bin_intake(bucketed, [2017, 2021])) == rows(bin_intake(cat, [2017, 2021]))


def test_another_session_finds_the_buckets(spark, bucketed, cat):
    tables = [bucketed.bucket_table(g, n) for g, by in bucketed.manifest().items() for n, e in by.items() if "buckets" in e]
    assert len(tables) == 7
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS {t}")                                  # the tables are external: files stay
    again = ParquetCatalog(spark, bucketed.root)
    df = batch_packout(again, [2020, 2021])
    assert "hashpartitioning(GraderBatchID" not in plan(df)
    assert rows(df) == rows(batch_packout(cat, [2020, 2021]))


def test_staged_pallets_know_whether_they_were_exported(spark, bucketed, cat):
    for seasons in ([2020], [2021, 2022]):
        cols = ["PalletDetailID", "GraderBatchID", "NoOfUnits", "_exported"]
        assert rows(bucketed.pallets_created_in(seasons).select(cols)) == rows(cat.pallets_created_in(seasons).select(cols))
    plain = write_catalog(cat, bucketed.root + "-plain")
    text = plan(batch_packout(plain, [2021]))
    assert "ma_Export_Bin_DetailT" not in text and "hashpartitioning(PalletDetailID" not in text
    assert rows(batch_packout(plain, [2021])) == rows(batch_packout(cat, [2021]))


# ------------------------------------------------------------------ collation

TEXTS = ["Berl Property Ltd", "berl property ltd", "BERL PROPERTY LTD  ", "Berl Property Ltd ", " Berl Property Ltd", "Berl Property Ltd\t", "", None, "Berl"]


def test_server_literals_in_both_modes_against_duckdb(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT unnest(?) AS x", [TEXTS])
    df = spark.createDataFrame([(x,) for x in TEXTS], "x string")
    literal = "Berl Property Ltd "
    for collation, sql in ((None, "rtrim(x, ' ') = rtrim(?, ' ')"), ("UTF8_BINARY_RTRIM", "rtrim(x, ' ') = rtrim(?, ' ')"),
                           ("UTF8_LCASE_RTRIM", "lower(rtrim(x, ' ')) = lower(rtrim(?, ' '))")):
        want = sorted(con.execute(f"SELECT x, {sql} FROM t", [literal]).fetchall(), key=str)
        got = sorted((tuple(r) for r in df.select("x", server_equals("x", literal, collation)).collect()), key=str)
        assert got == want, collation


def test_reports_follow_the_servers_collation(spark):
    t = {(CURRENT, "ma_Bin_DeliveryT"): [dict(BinDeliveryID=1, SeasonID=7, PresizeFlag=False, FirstStorageSiteCompanyID=5),
                                         dict(BinDeliveryID=2, SeasonID=6, PresizeFlag=False, FirstStorageSiteCompanyID=6)],
         (CURRENT, "sw_CompanyT"): [dict(CompanyID=5, CompanyName="TE IPU PACKHOUSE (ro) "), dict(CompanyID=6, CompanyName="Te Ipu Packhouse (RO) ")]}
    cat = fixtures.catalog(spark, t)
    site = lambda config: [r.StorageSite for r in bin_intake(cat, [2020, 2021], config).orderBy("BinDeliveryID").collect()]
    assert site(ReportConfig()) == ["Raupare Rd", "Cooper Street"]
    assert site(ReportConfig(server_collation="UTF8_LCASE_RTRIM")) == ["Te Ipu", "Cooper Street"]


# ----------------------------------------------------------------- as.integer


def test_texts_that_r_reads_as_integers(spark):
    want = {"12": 12, "12.7": 12, "-3.9": -3, " 12 ": 12, "1e3": 1000, "0x1A": 26, "0XfF ": 255, "-0x10": -16, "0x00000000000000001": 1, "12d": None, "45F": None,
            "0x": None, "0xG": None, "1A": None, "0x80000000": None, "0x7fffffff": 2147483647, "0x123456789": None, "2147483648": None, "": None, None: None,
            "NaN": None, "Infinity": None, "+7": 7, ".5": 0, "5.": 5, "1 2": None, "1e400": None}
    df = spark.createDataFrame([(k,) for k in want], "x string")
    assert {r.x: r.v for r in df.select("x", to_int("x").alias("v")).collect()} == want
    assert [r.v for r in spark.createDataFrame([(12.9,), (-0.5,), (None,)], "x double").select(to_int("x").alias("v")).collect()] == [12, 0, None]
