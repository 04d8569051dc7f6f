
import pytest
from pyspark.sql import functions as F

from binyard import batch_packout, bin_intake, defect_share, pack_units
from binyard.sources.testdata import TestdataCatalog
from tests.conftest import SF_ORACLE

LEGACY_SEASONS, CURRENT_SEASONS = [2016, 2017, 2018, 2019], [2020, 2021, 2022, 2023]


@pytest.fixture(scope="module")
def cat(spark):
    return TestdataCatalog(spark, SF_ORACLE)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_one_row_per_season_and_batch(cat):
    df = batch_packout(cat, LEGACY_SEASONS + CURRENT_SEASONS)
    dup = df.groupBy("Season", "GraderBatchID").count().filter("count > 1").count()
    assert dup == 0


def test_generation_row_counts_add_up(cat):
    whole = batch_packout(cat, LEGACY_SEASONS + CURRENT_SEASONS).count()
    assert whole == batch_packout(cat, LEGACY_SEASONS).count() + \
        batch_packout(cat, CURRENT_SEASONS).count()


def test_bin_intake_splits_by_season(cat):
    whole = rows(bin_intake(cat, LEGACY_SEASONS + CURRENT_SEASONS))
    parts = sorted(r for s in LEGACY_SEASONS + CURRENT_SEASONS for r in rows(bin_intake(cat, [s])))
    assert whole == parts


def test_legacy_packout_splits_by_season(cat):
    """No timestamp-banded facts in the legacy branch, so no T10 effect."""
    whole = rows(batch_packout(cat, LEGACY_SEASONS))
    parts = sorted(r for s in LEGACY_SEASONS for r in rows(batch_packout(cat, [s])))
    assert whole == parts


def test_current_packout_split_differs_only_in_values(cat):
    """The same batches, but facts created in another requested season count."""
    whole = batch_packout(cat, CURRENT_SEASONS)
    parts = None
    for s in CURRENT_SEASONS:
        part = batch_packout(cat, [s])
        parts = part if parts is None else parts.unionByName(part)
    keys = ["Season", "GraderBatchID"]
    assert rows(whole.select(keys)) == rows(parts.select(keys))
    changed = (whole.alias("w").join(parts.alias("p"), keys)
               .filter(~F.col("w.rejectKgs").eqNullSafe(F.col("p.rejectKgs"))).count())
    assert changed > 0


def test_defect_share_rows_are_a_subset_of_packout_batches(cat):
    d = defect_share(cat, CURRENT_SEASONS).select("Season", "GraderBatchID").distinct()
    p = batch_packout(cat, CURRENT_SEASONS).select("Season", "GraderBatchID")
    assert d.join(p, ["Season", "GraderBatchID"], "left_anti").count() == 0


def test_pack_units_has_one_row_per_batch_in_season(cat):
    df = pack_units(cat, [2020, 2021])
    assert df.count() == df.select("GraderBatchID").distinct().count()
    assert {r.SeasonDesc for r in df.select("SeasonDesc").distinct().collect()} == {"2020", "2021"}


def test_bin_intake_one_row_per_season_and_bin(cat):
    df = bin_intake(cat, LEGACY_SEASONS + CURRENT_SEASONS)
    assert df.groupBy("Season", "BinDeliveryID").count().filter("count > 1").count() == 0
    assert df.filter("StorageSite IS NULL").count() == \
        df.filter("Season < 2020 AND StorageSite IS NULL").count()   # current sites always set
