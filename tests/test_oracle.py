"""Every registered query against its DuckDB oracle (the driver's gate)."""

import os

import pytest

import __spark_entry__ as entry
from binyard.plans import checks
from tests.compare import compare, duck_connection
from tests.conftest import SF_ORACLE, SF_SMALL

NAMES = sorted(checks.CHECKS)


SF_BENCH = "/root/testdata/sf0.1"
SCALES = [SF_SMALL, SF_ORACLE] + ([SF_BENCH] if os.environ.get("BINYARD_SLOW") == "1" else [])


@pytest.fixture(scope="module")
def duck():
    return {sf: duck_connection(sf) for sf in SCALES}


def test_every_query_has_oracle_sql():
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("sf", SCALES)
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name, sf):
    df = entry.queries()[name](spark, sf)
    problems = compare(df, duck[sf], entry.oracle_sql()[name])
    assert not problems, "\n".join(problems)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["GraderBatchID", "GraderBatchNo", "Season"]


_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def test_column_types_match_the_oracle(spark, duck):
    for name, q in ((n, entry.queries()[n]) for n in NAMES):
        spark_types = {c: _DUCK[t] for c, t in q(spark, SF_SMALL).dtypes}
        duck_types = {r[0]: r[1] for r in
                      duck[SF_SMALL].execute("DESCRIBE " + entry.oracle_sql()[name]).fetchall()}
        assert spark_types == duck_types, name
