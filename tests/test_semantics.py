"""Trap tests T1-T9 for the column-expression builders."""

import math

from pyspark.sql import functions as F

from binyard.config import CURRENT, LEGACY
from binyard.functions import semantics as s


def one(spark, expr, ddl="x double", rows=((None,),)):
    return [r[0] for r in spark.createDataFrame(list(rows), ddl).select(expr).collect()]


def test_half_even_rounding(spark):  # T1
    got = one(spark, s.half_even("x", 0), rows=[(0.5,), (1.5,), (2.5,), (3.5,), (-2.5,)])
    assert got == [0.0, 2.0, 2.0, 4.0, -2.0]


def test_strict_sum_poisons_on_null(spark):  # T2
    df = spark.createDataFrame([(1, 3), (1, None), (2, 4), (2, 5), (3, None)], "k int, v int")
    got = {r.k: r.s for r in df.groupBy("k").agg(s.strict_sum("v").alias("s")).collect()}
    assert got == {1: None, 2: 9, 3: None}


def test_sum_or_zero_and_server_sum(spark):  # T3, T8
    df = spark.createDataFrame([(1, None), (2, 1.0), (2, float("nan")), (2, None)], "k int, v double")
    got = {r.k: (r.a, r.b) for r in df.groupBy("k").agg(s.sum_or_zero("v").alias("a"),
                                                         s.server_sum("v").alias("b")).collect()}
    assert got[1] == (0.0, None)
    assert got[2][0] == 1.0 and math.isnan(got[2][1])


def test_ieee_division(spark):  # T4
    rows = [(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 0.0), (1.0, None), (6.0, 3.0),
            (float("nan"), 0.0)]
    got = one(spark, s.ieee_div("n", "d"), "n double, d double", rows)
    assert got[0] == math.inf and got[1] == -math.inf and math.isnan(got[2])
    assert got[3] is None and got[4] is None and got[5] == 2.0 and math.isnan(got[6])


def test_to_int_text(spark):  # T5
    got = one(spark, s.to_int("x"), "x string",
              [("12.7",), ("abc",), ("12",), ("9999999999",), ("-3.9",), (None,)])
    assert got == [12, None, 12, None, -3, None]


def test_days_between(spark):  # T6
    df = spark.sql("SELECT DATE'2021-03-10' AS p, DATE'2021-03-01' AS h")
    assert df.select(s.days_between("p", "h")).first()[0] == 9.0


def test_server_side_label_map_ignores_trailing_blanks(spark):  # T7
    pairs = (("Acme Fruit ", "Site A"), ("Beta Ltd", "Site B"))
    got = one(spark, s.map_label("x", pairs, F.col("x"), server_side=True), "x string",
              [("Acme Fruit",), ("Acme Fruit ",), ("Other Co",), ("beta ltd",), ("Beta Ltd  ",)])
    assert got == ["Site A", "Site A", "Other Co", "beta ltd", "Site B"]


def test_fill_zero_treats_nan_as_missing(spark):  # T8
    got = one(spark, s.fill_zero("x"), rows=[(None,), (float("nan"),), (2.0,)])
    assert got == [0.0, 0.0, 2.0]


def test_number_text_like_r(spark):  # T9
    got = one(spark, s.r_number_text("x"), rows=[(63.0,), (63.5,), (3.0,)])
    assert got == ["63", "63.5", "3"]


def test_norm_owner(spark):
    got = one(spark, s.norm_owner("x"), "x string", [("  Foo Bar\t",), (" T & G (Apollo) ",),
                                                      (None,)])
    assert got == ["foobar", "t&g(apollo)", None]


def test_season_code_map_and_inverse(spark):
    got = one(spark, s.season_from_code("x", CURRENT), "x int", [(6,), (9,), (5,), (None,)])
    assert got == [2020, 2023, None, None]
    assert s.season_codes([2017, 2021, 2030], LEGACY) == [3]
    assert s.season_codes([2017, 2021], CURRENT) == [7]


def test_timestamp_bands(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2020-12-31 23:59:59' AS t UNION ALL "
                   "SELECT TIMESTAMP_NTZ'2021-01-01 00:00:00' UNION ALL "
                   "SELECT TIMESTAMP_NTZ'2023-06-01 00:00:00' UNION ALL "
                   "SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00'")
    kept = [r.t.year for r in df.filter(s.timestamp_season_filter("t", [2020, 2021, 2023]))
            .orderBy("t").collect()]
    assert kept == [2020, 2021, 2023]
    seasons = [r[0] for r in df.orderBy("t").select(s.season_from_timestamp("t")).collect()]
    assert seasons == [2020, 2021, 2023, None]
