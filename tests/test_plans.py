"""Plan tests: what must reach the scan, which joins Spark must use, no Python."""

import re

import pytest

from binyard import batch_packout, bin_intake, defect_share, pack_units
from binyard.plans import checks
from binyard.sources.testdata import TestdataCatalog
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def cat(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return TestdataCatalog(spark, SF_SMALL)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def parquet_cat(spark, tmp_path_factory, cat):
    """The derived ERP tables written out as Parquet: the production layout."""
    from binyard.sources.sinks import write_catalog
    return write_catalog(TestdataCatalog(spark, SF_SMALL), str(tmp_path_factory.mktemp("erp")))


def test_season_code_filter_prunes_partitions(parquet_cat):
    text = plan(batch_packout(parquet_cat, [2021]))
    # the inverted code map becomes a partition filter on the SeasonID directories
    assert "PartitionFilters: [isnotnull(SeasonID" in text and "(SeasonID#" in text
    assert "= 7)" in text
    text = plan(bin_intake(parquet_cat, [2017, 2018]))
    assert "SeasonID" in text and "IN (3,4)" in text


def test_timestamp_band_filter_is_a_pushed_range(parquet_cat):
    text = plan(batch_packout(parquet_cat, [2021, 2022]))
    assert ("GreaterThanOrEqual(CreatedDateTime,2021-01-01T00:00), "
            "LessThan(CreatedDateTime,2023-01-01T00:00)") in text


def test_reports_match_on_parquet_catalog(parquet_cat, cat):
    """The staged, season-partitioned catalog gives the same reports."""
    def rows(df):
        return sorted(map(repr, map(tuple, df.collect())))
    for build in (lambda c: pack_units(c, [2020, 2021]),
                  lambda c: batch_packout(c, [2018, 2021]),
                  lambda c: defect_share(c, [2017, 2022]),
                  lambda c: bin_intake(c, [2016, 2023])):
        assert rows(build(parquet_cat)) == rows(build(cat))


def test_anti_join_is_left_anti(cat):
    text = plan(checks.CHECKS["anti_unweighed_pallets"].build(cat))
    assert "LeftAnti" in text


def test_semi_join_is_left_semi(cat):
    text = plan(checks.CHECKS["semi_presize_batches"].build(cat))
    assert "LeftSemi" in text


def test_code_lists_are_broadcast_local_tables(cat):
    text = plan(batch_packout(cat, [2021]))
    assert "BroadcastHashJoin" in text
    assert "Scan ExistingRDD" not in text          # code lists are local relations


@pytest.mark.parametrize("build", [
    lambda c: batch_packout(c, range(2016, 2024)),
    lambda c: defect_share(c, range(2016, 2024)),
    lambda c: pack_units(c, [2020, 2021]),
    lambda c: bin_intake(c, range(2016, 2024)),
])
def test_no_python_in_report_plans(cat, build):
    text = plan(build(cat))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                 "MapInPandas", "PythonUDF"):
        assert node not in text


def test_gating_drops_the_unrequested_generation(cat):
    text = optimized(batch_packout(cat, [2017]))
    assert "WasteOtherKgs" not in text             # the current branch is not built
    assert "Union" not in text


def test_season_band_reaches_both_fact_scans(parquet_cat):
    from binyard.plans.batch_packout import pallet_measures
    scans = [x for x in plan(pallet_measures(parquet_cat, [2021])).split("FileScan")[1:]]
    banded = [x for x in scans if "2021-01-01" in x and "2022-01-01" in x]
    assert sum("ma_Pallet_DetailT" in x for x in banded) == 1
    assert sum("ExportBatch" in x for x in banded) == 1                  # staged with their pallet's batch
    assert not any("ma_Export_Bin_DetailT" in x for x in scans)          # staged pallets know whether they were exported
    for x in scans:     # what is read without the band is keys only
        if x not in banded:
            assert "NoOfUnits" not in x.split("ReadSchema")[-1] and "KGWeight" not in x.split("ReadSchema")[-1]


def test_defects_meet_the_wanted_assessments_before_they_are_summed(cat):
    from binyard.plans.defect_share import defect_partials
    text = optimized(defect_partials(cat, "current", [2021]))
    assert "Aggregate [AssessmentID" not in text
    assert text.index("Aggregate [Season") < text.index("Join Inner")


def test_broadcast_hint_needs_a_size_check(spark):
    small = TestdataCatalog(spark, SF_SMALL)
    assert small.broadcast_ok("current", "sw_GradeT")            # 6 rows, declared code list
    assert not small.broadcast_ok("current", "sw_FarmT")         # grows with data: Spark decides
    tight = TestdataCatalog(spark, SF_SMALL)
    tight.broadcast_row_limit = 3
    assert not tight.broadcast_ok("current", "sw_GradeT")        # over the limit: no hint
    hinted = tight.dim("current", "sys_fi_Pool_TypeT")._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in hinted or "broadcast" in hinted.lower()


def test_jdbc_reads_are_partitioned_per_table(spark):
    """No database is started here; the reader options are checked instead."""
    from binyard.sources.catalog import JdbcCatalog
    cat = JdbcCatalog(spark, {"current": {"url": "jdbc:x://h/db", "user": "u"}},
                      partitioning={
                          "ma_Pallet_DetailT": {"partitionColumn": "PalletDetailID",
                                                "lowerBound": 1, "upperBound": 10**9,
                                                "numPartitions": 500},
                          ("current", "ma_Bin_UsageT"): {"predicates": [
                              "SeasonID = 6", "SeasonID = 7"]}})
    pallets = cat.read_plan("current", "ma_Pallet_DetailT")
    assert pallets["options"]["numPartitions"] == "500"
    assert pallets["options"]["dbtable"] == "ma_Pallet_DetailT"
    usage = cat.read_plan("current", "ma_Bin_UsageT")
    assert usage["predicates"] == ["SeasonID = 6", "SeasonID = 7"]
    assert "numPartitions" not in cat.read_plan("current", "sw_GradeT")["options"]


def test_large_key_lists_take_the_skew_safe_path(spark):
    """With broadcasting disabled no derived frame 'fits': distinct key lists
    are then inner-joined after pre-aggregation, so no raw rows of a hot batch
    are shuffled for a semi join; the results must not change."""
    from binyard.sources.testdata import TestdataCatalog
    default = TestdataCatalog(spark, SF_SMALL)
    want_pack = sorted(map(tuple, pack_units(default, [2020, 2021]).collect()))
    want_legacy = sorted(map(tuple, batch_packout(default, [2017, 2018]).collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cat = TestdataCatalog(spark, SF_SMALL)
        df = pack_units(cat, [2020, 2021])
        assert not cat.fits_broadcast(cat.table("current", "ma_Grader_BatchT"), 1500)
        text = optimized(df)
        # no semi join on a batch key (only the bounded season code list remains)
        assert not re.search(r"Join LeftSemi, \([^)]*GraderBatchID", text)
        assert sorted(map(tuple, df.collect())) == want_pack
        assert sorted(map(tuple, batch_packout(cat, [2017, 2018]).collect())) == want_legacy
        from binyard.plans.pack_units import tube_split
        split = tube_split(cat, [2020, 2021])
        assert re.search(r"Join Inner, \(GraderBatchID", optimized(split))   # exact standalone
        assert sorted(map(tuple, split.collect())) == \
            sorted(map(tuple, tube_split(default, [2020, 2021]).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_pairwise_joins_or_python_in_any_registered_query(spark, cat):
    import __spark_entry__ as entry
    from binyard.plans import checks
    for name, q in ((n, entry.queries()[n]) for n in checks.CHECKS):
        text = plan(q(spark, SF_SMALL))
        for node in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython",
                     "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert node not in text, (name, node)


def test_building_a_report_on_parquet_starts_no_job(parquet_cat, spark):
    from binyard.sources.catalog import ParquetCatalog
    from binyard.sources.schemas import SCHEMAS
    cat = ParquetCatalog(spark, parquet_cat.root)
    for gen, tables in SCHEMAS.items():
        for name in tables:
            cat.table(gen, name)        # reading a schema may start a job; deciding on broadcasts must not
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "plan building only")
    try:
        for build in (batch_packout, defect_share, pack_units, bin_intake):
            df = build(cat, [2021])
            assert list(tracker.getJobIdsForGroup("build")) == [], build.__name__
        assert "broadcast" in cat.dim("current", "sw_GradeT")._jdf.queryExecution().analyzed().toString().lower()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert df.count() >= 0
