"""Season-by-season refresh from mergeable state, and versioned publishing."""

import json
import os

import pytest
from pyspark.sql import functions as F

from binyard import batch_packout, defect_share, pack_units
from binyard.plans import season_store
from binyard.plans.season_store import SeasonStore, measures, merge_state, packout_state, presize_state
from binyard.sources import versions
from binyard.sources.sinks import publish_report, read_report
from binyard.sources.storage import Folder
from binyard.sources.testdata import TestdataCatalog
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def cat(spark):
    return TestdataCatalog(spark, SF_SMALL)


def rows(df):
    """Rows with doubles rounded: sums depend on their order in the last bits."""
    cols = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return sorted(map(repr, map(tuple, df.select(cols).collect())))


@pytest.fixture(scope="module")
def store(spark, cat, tmp_path_factory):
    """Seasons refreshed one by one, out of order, one of them twice."""
    s = SeasonStore(spark, str(tmp_path_factory.mktemp("store")))
    for seasons in ([2021], [2019], [2020], [2018, 2022], [2020]):
        s.refresh(cat, seasons)
    return s


def test_seasons_refreshed_apart_equal_seasons_asked_together(store, cat):
    together = rows(batch_packout(cat, [2020, 2021]))
    assert rows(store.batch_packout([2020, 2021])) == together
    # the plain way differs: a batch's facts of the other year are missing
    apart = rows(batch_packout(cat, [2020]).unionByName(batch_packout(cat, [2021])))
    assert len(set(together) - set(apart)) > 50


@pytest.mark.parametrize("seasons", [[2020], [2021], [2018, 2019], [2019, 2020], [2018, 2019, 2020, 2021, 2022]])
def test_any_set_of_published_seasons(store, cat, seasons):
    assert rows(store.batch_packout(seasons)) == rows(batch_packout(cat, seasons))


def test_units_and_defects_from_the_store(store, cat):
    assert rows(store.pack_units([2020, 2021])) == rows(pack_units(cat, [2020, 2021]))
    assert rows(store.pack_units([2022])) == rows(pack_units(cat, [2022]))
    assert rows(store.defect_share(cat, [2019, 2021])) == rows(defect_share(cat, [2019, 2021]))


def test_state_merges_in_any_split(cat):
    seasons = [2020, 2021, 2022]
    for build in (packout_state, presize_state):
        whole = build(cat, seasons)
        parts = [build(cat, [s]) for s in seasons]
        assert rows(merge_state(*parts)) == rows(whole.select(parts[0].columns))
        assert whole.groupBy("GraderBatchID", "FactSeason", "measure").count().filter("count > 1").count() == 0


def test_measures_keep_each_sums_null_rule(spark):
    state = spark.createDataFrame([
        (1, 2020, "tipped", None, 0, 3), (1, 2020, "juice", None, 0, 2), (1, 2020, "loose", None, 0, 1),
        (2, 2020, "tipped", 2.0, 1, 1), (2, 2021, "tipped", 3.0, 1, 2), (2, 2021, "sample", 1.5, 1, 1),
        (3, 2020, "presize", 2.5, 1, 1), (3, 2021, "presize", 1.0, 1, 2)], season_store.STATE)
    got = {r.GraderBatchID: r for r in measures(state.filter("measure <> 'presize'")).collect()}
    assert (got[1].fieldBinsTipped, got[1].juiceKgs, got[1].looseKgs, got[1].sampleKgs) == (0.0, None, 0.0, None)
    assert (got[2].fieldBinsTipped, got[2].sampleKgs, got[2].looseKgs) == (5.0, 1.5, None)
    own = {r.GraderBatchID: r.PSgrowerRTEs for r in season_store.presize_units(state.filter("measure = 'presize'")).collect()}
    assert own == {3: None}                                       # one NULL in one season poisons the batch
    assert season_store.presize_units(state.filter("measure = 'presize' and FactSeason = 2020")).first().PSgrowerRTEs == 2.0


def test_a_refresh_is_one_version_for_all_its_tables(store, spark):
    have = versions.versions(spark, store.path)
    assert have == [1, 2, 3, 4, 5]
    found = versions.marker(spark, store.path)
    assert found["refreshed"] == ["2020"] and len(found["tables"]) == 5
    assert {len(t["seasons"]) for t in found["tables"].values()} == {5}
    with pytest.raises(ValueError, match="never published"):
        store.batch_packout([2023])


# ------------------------------------------------------------- publishing


def report(spark, *seasons, tag="a"):
    return spark.createDataFrame([(i, s, tag) for i, s in enumerate(seasons)], "GraderBatchID long, Season int, tag string")


def seen(spark, path, **kw):
    return sorted((r.Season, r.tag) for r in read_report(spark, path, **kw).collect())


def test_readers_follow_the_marker(spark, tmp_path):
    path = str(tmp_path / "r")
    with pytest.raises(ValueError, match="no published"):
        read_report(spark, path)
    assert publish_report(report(spark, 2020, 2021, 2021), path, [2020, 2021]) == 1
    assert publish_report(report(spark, 2021, tag="b"), path, [2021]) == 2
    assert seen(spark, path) == [(2020, "a"), (2021, "b")]
    assert seen(spark, path, seasons=[2021]) == [(2021, "b")]
    assert seen(spark, path, version=1) == [(2020, "a"), (2021, "a"), (2021, "a")]
    publish_report(report(spark, 2021).limit(0), path, [2021])              # the season has become empty
    assert seen(spark, path) == [(2020, "a")] and seen(spark, path, seasons=[2021]) == []
    assert read_report(spark, path).columns == ["GraderBatchID", "Season", "tag"]
    text = read_report(spark, path, seasons=[2020])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "2020" in text


def test_a_failure_before_the_marker_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "r")
    publish_report(report(spark, 2020, 2021), path, [2020, 2021])
    before = read_report(spark, path)

    def dies(self, name, text):
        raise OSError("the writer is gone")

    with monkeypatch.context() as m:
        m.setattr(Folder, "create", dies)
        with pytest.raises(OSError):
            publish_report(report(spark, 2020, tag="b"), path, [2020])
    assert len(os.listdir(f"{path}/data")) == 2                             # its files are there
    assert seen(spark, path) == [(2020, "a"), (2021, "a")]                  # and nobody sees them
    assert sorted(r.tag for r in before.collect()) == ["a", "a"]
    publish_report(report(spark, 2020, tag="c"), path, [2020])
    assert seen(spark, path) == [(2020, "c"), (2021, "a")]
    gone = versions.vacuum(spark, path, keep=2)
    assert len(gone) == 1 and seen(spark, path, version=1) == [(2020, "a"), (2021, "a")]
    versions.vacuum(spark, path, keep=1)
    assert seen(spark, path) == [(2020, "c"), (2021, "a")]
    with pytest.raises(ValueError, match="no version 1"):
        read_report(spark, path, version=1)


def test_two_writers_both_land(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "r")
    publish_report(report(spark, 2019), path, [2019])
    create, raced = Folder.create, []

    def other_first(self, name, text):
        if not raced:
            raced.append(name)
            publish_report(report(spark, 2021, tag="other"), path, [2021])
        return create(self, name, text)

    monkeypatch.setattr(Folder, "create", other_first)
    assert publish_report(report(spark, 2020, tag="mine"), path, [2020]) == 3
    assert seen(spark, path) == [(2019, "a"), (2020, "mine"), (2021, "other")]
    with pytest.raises(FileExistsError):
        create(Folder(spark, path), "commits/000000000003.json", "{}")
    assert json.loads(Folder(spark, path).read("commits/000000000003.json"))["version"] == 3
    assert not [n for n in Folder(spark, path).names("commits") if n.endswith(".tmp")]


def test_rows_outside_the_asked_seasons_are_refused(spark, tmp_path):
    path = str(tmp_path / "r")
    with pytest.raises(ValueError, match="2021"):
        publish_report(report(spark, 2020, 2021), path, [2020])
    with pytest.raises(ValueError, match="no season"):
        publish_report(spark.createDataFrame([(1, None, "x")], "GraderBatchID long, Season int, tag string"), path, [2020])
    assert versions.versions(spark, path) == []
    publish_report(report(spark, 2020), path, [2020])
    with pytest.raises(ValueError, match="another schema"):
        publish_report(report(spark, 2021).drop("tag"), path, [2021])
    assert publish_report(report(spark, 2020).drop("tag"), path, [2020]) == 2   # all seasons replaced: a new schema may come
