"""Staged catalogs: creation-year partitions, manifest, key checks, staged
batch lists as runtime filters, and JDBC splits."""

import glob
import re

import duckdb
import pytest

from binyard import batch_packout, pack_units
from binyard.config import CURRENT, LEGACY
from binyard.plans.defect_share import defect_partials
from binyard.plans.pack_units import repack_units, tube_split
from binyard.sources.catalog import JdbcCatalog, ParquetCatalog, id_ranges
from binyard.sources.schemas import FACTS, KEYS, SCHEMAS
from binyard.sources.sinks import check_key, write_catalog
from binyard.sources.testdata import TestdataCatalog
from tests import fixtures
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def cat(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return TestdataCatalog(spark, SF_SMALL)


@pytest.fixture(scope="module")
def parquet_cat(spark, tmp_path_factory):
    return write_catalog(TestdataCatalog(spark, SF_SMALL), str(tmp_path_factory.mktemp("erp")))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


# ---------------------------------------------------------- creation years


def test_one_season_lists_one_year_of_three_fact_tables(parquet_cat, cat):
    df = batch_packout(parquet_cat, [2021])
    text = plan(df)
    for table in ("ma_Pallet_DetailT", "ExportBatch", "ma_Bin_UsageT"):
        scans = re.findall(rf"FileScan parquet \[[^\]]*\][^\n]*current/{table}[^\n]*", text)
        years = [s for s in scans if re.search(r"PartitionFilters: \[[^\]]*CreatedYear#\d+ >= 2021\)[^\]]*CreatedYear#\d+ < 2022", s)]
        assert years, (table, scans)
        assert all("GreaterThanOrEqual(CreatedDateTime,2021-01-01T00:00)" in s for s in years)
    assert rows(df) == rows(batch_packout(cat, [2021]))


def test_bands_of_several_seasons_and_rows_without_a_time(spark, tmp_path):
    t = {(CURRENT, "ma_Bin_UsageT"): [dict(GraderBatchID=1, BinQty=float(n), CreatedDateTime=when) for n, when in enumerate([
        fixtures.TS(2019, 12, 31, 23, 59, 59), fixtures.TS(2020, 1, 1), fixtures.TS(2020, 12, 31, 23, 59, 59), fixtures.TS(2021, 1, 1),
        fixtures.TS(2022, 6, 1), fixtures.TS(2023, 12, 31, 23), fixtures.TS(2024, 1, 1), None])]}
    plain = fixtures.catalog(spark, t)
    staged = write_catalog(plain, str(tmp_path / "erp"))
    for seasons, want in (([2020], [1, 2]), ([2020, 2021], [1, 2, 3]), ([2020, 2022, 2023], [1, 2, 4, 5]), ([2016], []), ([2024], [])):
        for c in (plain, staged):
            got = c.created_in(CURRENT, "ma_Bin_UsageT", seasons)
            assert got.columns == SCHEMAS[CURRENT]["ma_Bin_UsageT"].fieldNames()
            assert sorted(int(r.BinQty) for r in got.collect()) == want
    assert staged.table(CURRENT, "ma_Bin_UsageT").count() == 8


# ---------------------------------------------------- manifest and key check


def test_row_bounds_come_from_the_manifest_alone(spark, parquet_cat, cat, tmp_path, monkeypatch):
    fresh = ParquetCatalog(spark, parquet_cat.root)
    for gen, name in ((CURRENT, "sw_GradeT"), (LEGACY, "ma_Grader_BatchT"), (CURRENT, "ma_Pallet_DetailT")):
        assert fresh.row_bound(gen, name) == cat.table(gen, name).count()
    import pyarrow.parquet as pq
    monkeypatch.setattr(pq, "read_metadata", None)
    monkeypatch.setattr(pq, "ParquetFile", None)
    sc = spark.sparkContext
    sc.setJobGroup("bounds", "size proofs")
    try:
        fresh = ParquetCatalog(spark, parquet_cat.root)
        assert all(fresh.row_bound(g, n) is not None for g, tables in SCHEMAS.items() for n in tables)
        assert list(sc.statusTracker().getJobIdsForGroup("bounds")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    spark.range(3).write.parquet(str(tmp_path / "current/sw_GradeT"))
    assert ParquetCatalog(spark, str(tmp_path)).row_bound(CURRENT, "sw_GradeT") is None   # no manifest: nothing is known
    assert ParquetCatalog(spark, str(tmp_path)).batch_ids([2021]) is None


def test_a_bound_for_a_table_of_many_files(spark, tmp_path):
    t = {(CURRENT, "sw_SubdivisionT"): [dict(SubdivisionID=i, SubdivisionCode=str(i)) for i in range(400)]}
    plain = fixtures.catalog(spark, t)
    many = plain.table(CURRENT, "sw_SubdivisionT").repartition(200)
    plain._conformed[(CURRENT, "sw_SubdivisionT")] = many
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        staged = write_catalog(plain, str(tmp_path / "erp"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(glob.glob(f"{staged.root}/current/sw_SubdivisionT/*.parquet")) > 150
    assert staged.row_bound(CURRENT, "sw_SubdivisionT") == 400 and staged.broadcast_ok(CURRENT, "sw_SubdivisionT")


def test_a_doubled_key_raises_and_names_the_table(spark, tmp_path):
    t = {(CURRENT, "sw_CompanyT"): [dict(CompanyID=1, CompanyName="A"), dict(CompanyID=2, CompanyName="B"), dict(CompanyID=1, CompanyName="C"),
                                    dict(CompanyID=None, CompanyName="x"), dict(CompanyID=None, CompanyName="y")]}
    bad = fixtures.catalog(spark, t)
    with pytest.raises(ValueError, match=r"current\.sw_CompanyT: CompanyID is not unique: 1 \(2 rows\)"):
        write_catalog(bad, str(tmp_path / "erp"))
    assert ParquetCatalog(spark, str(tmp_path / "erp")).manifest() == {}        # no size proof from a broken catalog
    assert write_catalog(bad, str(tmp_path / "unchecked"), check_keys=False).row_bound(CURRENT, "sw_CompanyT") == 5
    check_key(spark.createDataFrame([(1,), (None,), (None,)], "k long"), "k", "nulls match nothing")
    assert (CURRENT, "ma_Bin_UsageT") not in KEYS and KEYS[(LEGACY, "ma_BinT")] == "BinID"


# ------------------------------------------------------------ runtime filter


@pytest.fixture
def shuffled(spark):
    """Every join shuffled, and facts of any size worth a runtime filter."""
    own = {"spark.sql.autoBroadcastJoinThreshold": "-1",
           "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    old = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def above(df, *columns):
    """The node right above each relation that has all of the columns."""
    lines, out = df._jdf.queryExecution().optimizedPlan().toString().splitlines(), []
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i, line in enumerate(lines):
        if "Relation [" in line and all(f"{c}#" in line for c in columns):
            out.append(next(x for x in reversed(lines[:i]) if depth(x) < depth(line)))
    return out


def exchanged(plan):
    """Rows written to all shuffles of an executed plan."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return exchanged(plan.executedPlan())
    if "QueryStage" in name:
        return exchanged(plan.plan())
    own = plan.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0
    return own + sum(exchanged(plan.children().apply(i)) for i in range(plan.children().size()) if name != "ReusedExchange")


def run(df):
    found = rows(df)
    return found, exchanged(df._jdf.queryExecution().executedPlan())


FACT = {"pallets": ("PalletDetailID", "CreatedDateTime", "NoOfUnits"), "cartons": ("FromPalletDetailID", "CartonNo"), "defects": ("AssessmentDefectID", "DefectQty")}


def test_staged_lists_filter_the_fact_scans(shuffled, parquet_cat):
    staged = ParquetCatalog(shuffled, parquet_cat.root)
    plain = TestdataCatalog(shuffled, SF_SMALL)
    for build, fact in ((lambda c, s: tube_split(c, s), "pallets"), (lambda c, s: repack_units(c, s), "cartons"),
                        (lambda c, s: defect_partials(c, CURRENT, s), "defects")):
        df = build(staged, [2021])
        assert any("might_contain" in x for x in above(df, *FACT[fact])), fact
        one, few = run(df)
        four, many = run(build(staged, [2020, 2021, 2022, 2023]))
        assert one == rows(build(plain, [2021])) and four == rows(build(plain, [2020, 2021, 2022, 2023])), fact
        assert few < 0.6 * many, (fact, few, many)


def test_small_lists_are_broadcast_and_filter_before_the_sum(spark, parquet_cat, cat):
    staged = ParquetCatalog(spark, parquet_cat.root)
    df = tube_split(staged, [2021])
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Aggregate [GraderBatchID") < text.index("Join LeftSemi")       # the semi join is below the sum
    assert rows(df) == rows(tube_split(cat, [2021]))
    assert rows(pack_units(staged, [2020, 2021])) == rows(pack_units(cat, [2020, 2021]))


# --------------------------------------------------------------- JDBC splits


class _Reader:
    def __init__(self, log):
        self.log, self.opts = log, {}

    def format(self, fmt):
        return self

    def options(self, **kw):
        self.opts = kw
        return self

    def load(self):
        self.log.append(("load", self.opts["dbtable"]))
        return "frame"

    def jdbc(self, url, table, predicates=None, properties=None):
        self.log.append(("jdbc", table, predicates))
        return "frame"


class _Session:
    def __init__(self):
        self.log = []

    @property
    def read(self):
        return _Reader(self.log)


OPTIONS = {g: {"url": f"jdbc:x://h/{g}", "user": "u"} for g in (CURRENT, LEGACY)}


def test_a_fact_is_never_one_task():
    session = _Session()
    cat = JdbcCatalog(session, OPTIONS)
    for gen, name in FACTS:
        columns = SCHEMAS[gen][name].fieldNames()
        if "SeasonID" in columns or "CreatedDateTime" in columns:
            cat._load(gen, name)
            kind, table, predicates = session.log[-1]
            assert (kind, table) == ("jdbc", name) and len(predicates) == 5
        else:
            with pytest.raises(ValueError, match=f"{gen}.{name} grows"):
                cat._load(gen, name)
    cat = JdbcCatalog(session, OPTIONS, ids={(CURRENT, "qa_Assessment_DefectT"): (1, 1000, 4)})
    cat._load(CURRENT, "qa_Assessment_DefectT")
    assert session.log[-1][2] == ["AssessmentDefectID < 251 OR AssessmentDefectID IS NULL", "AssessmentDefectID >= 251 AND AssessmentDefectID < 501",
                                  "AssessmentDefectID >= 501 AND AssessmentDefectID < 751", "AssessmentDefectID >= 751"]
    cat._load(CURRENT, "sw_GradeT")
    assert session.log[-1] == ("load", "sw_GradeT")                      # a code list is one small read
    given = JdbcCatalog(session, OPTIONS, partitioning={"ma_BinT": {"predicates": ["1 = 1"]}})
    assert given.read_plan(LEGACY, "ma_BinT")["predicates"] == ["1 = 1"]
    with pytest.raises(ValueError):
        id_ranges("k", 5, 4, 2)


def test_splits_are_disjoint_and_cover_every_row():
    """The predicates themselves, run as SQL over rows on both sides of every bound."""
    ids = {(CURRENT, "ma_Pallet_DetailT"): (10, 29, 3), (CURRENT, "ma_Bin_DeliveryT"): (10, 29, 2), (CURRENT, "ma_Repack_Input_CartonT"): (10, 29, 7),
           (LEGACY, "ma_Bin_UsageT"): (3, 3, 5)}
    cat = JdbcCatalog(_Session(), OPTIONS, ids=ids)
    con = duckdb.connect()
    con.execute("""CREATE TABLE t AS SELECT i AS id, s AS SeasonID, c AS CreatedDateTime FROM
        (SELECT unnest([NULL, -5, 3, 9, 10, 11, 16, 17, 20, 22, 23, 29, 30, 4000]) AS i),
        (SELECT unnest([NULL, 1, 2, 6, 7, 8, 9, 10]) AS s),
        (SELECT unnest([NULL, TIMESTAMP '2019-12-31 23:59:59', TIMESTAMP '2020-01-01', TIMESTAMP '2021-12-31 23:59:59', TIMESTAMP '2022-01-01',
                        TIMESTAMP '2023-12-31 23:59:59.9', TIMESTAMP '2024-01-01']) AS c)""")
    total = con.execute("SELECT count(*) FROM t").fetchone()[0]
    for gen, name in FACTS:
        try:
            predicates = cat.read_plan(gen, name)["predicates"]
        except ValueError:
            continue
        column = FACTS[(gen, name)]
        counts = [con.execute(f"SELECT count(*) FROM (SELECT *, id AS {column} FROM t) WHERE ({p})").fetchone()[0] for p in predicates]
        union = con.execute(f"SELECT count(*) FROM (SELECT *, id AS {column} FROM t) WHERE " + " OR ".join(f"({p})" for p in predicates)).fetchone()[0]
        assert sum(counts) == total == union, (gen, name, predicates)
