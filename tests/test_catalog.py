"""Catalog unit tests: schema conform, size checks, inline code lists."""

import pytest
from pyspark.sql import types as T

from binyard.sources.catalog import FrameCatalog, _bytes, conform, local_table


def test_conform_selects_declared_columns_and_casts(spark):
    df = spark.createDataFrame([(1, "F1", "Farm", 7, "extra")],
                               "FarmID int, FarmCode string, FarmName string, "
                               "GrowerCompanyID int, Unused string")
    out = conform(df, "current", "sw_FarmT")
    assert out.columns == ["FarmID", "FarmCode", "FarmName", "GrowerCompanyID"]
    assert out.schema["FarmID"].dataType == T.LongType()            # widened to the key type
    assert out.first().FarmID == 1


def test_conform_rejects_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "FarmID long")
    with pytest.raises(ValueError, match="lacks columns"):
        conform(df, "current", "sw_FarmT")


def test_size_units():
    assert _bytes("10485760b") == _bytes("10MB") == _bytes("10m") == 10 * 1024 * 1024
    assert _bytes("-1") == -1 and _bytes("1g") == 1 << 30


def test_fits_broadcast_needs_a_known_bound(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    cat = FrameCatalog(spark, {})
    assert cat.fits_broadcast(df, 10)
    assert not cat.fits_broadcast(df, None)     # unknown: left to Spark's own sizes
    assert not cat.fits_broadcast(df, 10**9)    # a grown bound changes the verdict


def test_local_table_literals(spark):
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("s", T.StringType()),
                           T.StructField("d", T.DoubleType()), T.StructField("b", T.BooleanType())])
    df = local_table(spark, [(1, "it's", 0.55, True), (None, None, None, None)], schema)
    assert df.schema == schema
    assert df.collect()[0] == (1, "it's", 0.55, True)
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()


def test_known_row_counts_prove_code_list_sizes(spark):
    from binyard.sources.testdata import TestdataCatalog
    cat = TestdataCatalog(spark, "/root/testdata/sf0.001")
    assert cat.known_rows()[("current", "sw_GradeT")] == 6
    assert cat.broadcast_ok("current", "sw_GradeT")
    cat.broadcast_row_limit = 5
    assert not cat.broadcast_ok("current", "sw_GradeT")      # 6 rows > 5: no hint


def test_row_counts_from_metadata_bound_flattened_dimensions(spark):
    from binyard.sources.testdata import TestdataCatalog
    cat = TestdataCatalog(spark, "/root/testdata/sf0.001")
    assert cat.row_bound("current", "sw_FarmT") == 150           # customer footer
    assert cat.row_bound("current", "sw_GradeT") == 6            # literal code list
    assert cat.row_bound("current", "ma_Pallet_DetailT") is None  # aggregated: unknown
    assert cat.row_bound("legacy", "ma_Grader_BatchT") == 1500    # orders bound a split
    df = spark.range(10)
    assert cat.fits_broadcast(df, 10)                             # proof without a count


class _FakeReader:
    """Records how a JDBC read is issued (no database is contacted)."""

    def __init__(self, log):
        self.log, self.opts = log, {}

    def format(self, fmt):
        self.log.append(("format", fmt))
        return self

    def options(self, **kw):
        self.opts.update(kw)
        return self

    def load(self):
        self.log.append(("load", dict(self.opts)))
        return "frame"

    def jdbc(self, url, table, predicates=None, properties=None):
        self.log.append(("jdbc", url, table, list(predicates), dict(properties)))
        return "frame"


class _FakeSpark:
    def __init__(self):
        self.log = []

    @property
    def read(self):
        return _FakeReader(self.log)


def test_jdbc_load_issues_partitioned_reads():
    from binyard.sources.catalog import JdbcCatalog
    fake = _FakeSpark()
    cat = JdbcCatalog(fake, {"current": {"url": "jdbc:x://h/db", "user": "u"}},
                      partitioning={"ma_Bin_UsageT": {"predicates": ["SeasonID = 6"]},
                                    "ma_Pallet_DetailT": {"partitionColumn": "PalletDetailID",
                                                          "lowerBound": 1, "upperBound": 9,
                                                          "numPartitions": 3}})
    cat._load("current", "ma_Bin_UsageT")
    assert fake.log[-1] == ("jdbc", "jdbc:x://h/db", "ma_Bin_UsageT", ["SeasonID = 6"],
                            {"user": "u", "preferTimestampNTZ": "true"})
    cat._load("current", "ma_Pallet_DetailT")
    assert fake.log[-1] == ("load", {"url": "jdbc:x://h/db", "user": "u", "preferTimestampNTZ": "true",
                                     "dbtable": "ma_Pallet_DetailT",
                                     "partitionColumn": "PalletDetailID", "lowerBound": "1",
                                     "upperBound": "9", "numPartitions": "3"})
