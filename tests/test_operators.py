"""Unit tests of the relational building blocks."""

from pyspark.sql import types as T

from binyard.operators.joins import anti, attach, keep_keys, lookup, semi
from binyard.operators.unions import to_schema, union_all


def test_lookup_keeps_fact_key_name_and_unmatched_rows(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, company int")
    dim = spark.createDataFrame([(10, "A"), (30, "C")], "CompanyID int, CompanyName string")
    out = lookup(fact, dim, ("company", "CompanyID"), ["CompanyName"],
                 rename={"CompanyName": "owner"})
    assert out.columns == ["company", "id", "owner"]
    got = {r.id: r.owner for r in out.collect()}
    assert got == {1: "A", 2: None, 3: None}       # unmatched and NULL keys kept, NULL attrs


def test_anti_and_semi(spark):
    left = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (2,), (4,)], "key int")
    assert sorted(r.k for r in semi(left, right, ("k", "key")).collect()) == [2]   # no duplication
    assert sorted((r.k for r in anti(left, right, ("k", "key")).collect()),
                  key=lambda v: (v is None, v)) == [1, 3, None]


def test_attach_left_and_composite(spark):
    hdr = spark.createDataFrame([(2021, 1), (2021, 2), (2022, 1)], "Season int, b int")
    m = spark.createDataFrame([(2021, 1, 5.0)], "Season int, b int, x double")
    got = {(r.Season, r.b): r.x for r in attach(hdr, m, ["Season", "b"]).collect()}
    assert got == {(2021, 1): 5.0, (2021, 2): None, (2022, 1): None}


def test_keep_keys_modes(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "k int, v double")
    keys = spark.createDataFrame([(1,), (3,)], "k int")
    for small in (True, False):
        assert sorted(r.k for r in keep_keys(df, keys, "k", small=small).collect()) == [1, 3]
    twice = keys.unionAll(keys)                 # a repeated key lists its rows once on either path
    for small in (True, False):
        assert sorted(r.k for r in keep_keys(df, twice, "k", small=small).collect()) == [1, 3]


def test_union_all_casts_and_fills(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("x", T.DoubleType())])
    a = spark.createDataFrame([(1, "a")], "id int, name string")             # no x, int id
    b = spark.createDataFrame([(2.5, 2, "b")], "x float, id long, name string")  # other order
    out = union_all(spark, [a, b], schema)
    assert [(f.name, f.dataType) for f in out.schema.fields] == \
        [(f.name, f.dataType) for f in schema.fields]
    assert sorted(map(tuple, out.collect())) == [(1, "a", None), (2, "b", 2.5)]
    empty = union_all(spark, [], schema)
    assert empty.count() == 0 and empty.schema == schema
    assert to_schema(a, schema).columns == ["id", "name", "x"]
