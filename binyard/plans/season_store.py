"""Season-by-season refresh of the reports whose figures depend on the seasons
asked for together.

A fact's season is its own (creation year, or the season code of its bin
delivery), its batch's season is another column (T10): packing in January
belongs to a batch of the year before.  A report of 2020 and 2021 therefore
holds more than the two reports written one after the other, and replacing one
season's rows cannot keep it right.

What is kept instead is mergeable state, one row for each batch, measure and
*fact* season: the sum, how many summed values were not NULL, and how many rows
there were.  Sums that skip NULLs, sums that an empty group makes 0 and sums
that a single NULL poisons all merge exactly from these three, in any order and
for any set of seasons.  Beside it the batches' own columns are kept by header
season.  Refreshing a season recomputes the state of facts of that season, for
all batches, and the headers of that season; a report for any set of published
seasons is then one grouped sum over the state and one join.

Everything a refresh writes becomes visible as one version (``versions``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binyard.config import CURRENT, DEFAULT_CONFIG, LEGACY, ReportConfig
from binyard.functions.semantics import half_even, nan_to_null, season_from_code, season_from_timestamp
from binyard.operators.joins import attach
from binyard.operators.unions import to_schema, union_all
from binyard.plans.batch_packout import (
    current_header, exported_by_created, finish_current, juice_rows, legacy_packout, pallets_by_product,
)
from binyard.plans.defect_share import defect_share
from binyard.plans.pack_units import finish_units, presize_rows, unit_header
from binyard.plans.schemas import BATCH_PACKOUT, DEFECT_SHARE, PACK_UNITS
from binyard.sources import versions
from binyard.sources.catalog import Catalog
from binyard.sources.schemas import CREATED

STATE = T.StructType([
    T.StructField("GraderBatchID", T.LongType()), T.StructField("FactSeason", T.IntegerType()),
    T.StructField("measure", T.StringType()), T.StructField("total", T.DoubleType()),
    T.StructField("present", T.LongType()), T.StructField("rows", T.LongType())])

JUICE, SAMPLE, LOOSE, TIPPED, PRESIZE = "juice", "sample", "loose", "tipped", "presize"


def _state(rows: DataFrame, measure: str, value, season) -> DataFrame:
    """State of one measure: ``value`` summed per (batch, fact season)."""
    return (rows.groupBy("GraderBatchID", season.cast("int").alias("FactSeason"))
            .agg(F.sum(value).alias("total"), F.count(value).alias("present"), F.count(F.lit(1)).alias("rows"))
            .select("GraderBatchID", "FactSeason", F.lit(measure).alias("measure"), "total", "present", "rows"))


def merge_state(*states: DataFrame) -> DataFrame:
    """One state from several: sums of sums and of counts."""
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    return (out.groupBy("GraderBatchID", "FactSeason", "measure")
            .agg(F.sum("total").alias("total"), F.sum("present").alias("present"), F.sum("rows").alias("rows")))


def packout_state(cat: Catalog, seasons, config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    """State of the four measures of the current pack-out (A1-A5), for the
    facts of the given seasons and every batch."""
    made = season_from_timestamp(CREATED, config)
    weight = F.col("_units") * F.col("NetFruitWeight")
    pallets = pallets_by_product(cat, seasons, config, made.alias("_season"))
    states = [
        _state(juice_rows(cat, seasons, config), JUICE, F.col("TotalWeight"), season_from_code("SeasonID", CURRENT, config)),
        _state(pallets.filter("SampleFlag"), SAMPLE, weight, F.col("_season")),
        # the two sources of loose weight skip NaN, as R does
        merge_state(_state(pallets.filter("_is_loose"), LOOSE, nan_to_null(weight), F.col("_season")),
                    _state(exported_by_created(cat, seasons, config, made.alias("_season")), LOOSE, nan_to_null("_kg"), F.col("_season"))),
        _state(cat.created_in(CURRENT, "ma_Bin_UsageT", seasons, config), TIPPED, nan_to_null("BinQty"), made),
    ]
    return union_all(cat.spark, [s.filter(F.col("GraderBatchID").isNotNull()) for s in states], STATE)


def presize_state(cat: Catalog, seasons, config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    """State of the presize units of ``pack_units`` (A11, a strict sum), for
    the deliveries of the given seasons and every batch."""
    rows = presize_rows(cat, seasons, config)
    return to_schema(_state(rows, PRESIZE, F.col("_units"), F.col("SeasonDesc")).filter(F.col("GraderBatchID").isNotNull()), STATE)


def _sum_of(measure: str):
    """SQL sum: NULL without a value."""
    return F.sum(F.when(F.col("measure") == measure, F.col("total")))


def measures(state: DataFrame) -> DataFrame:
    """juiceKgs, sampleKgs (SQL sums), looseKgs, fieldBinsTipped (0 for a batch
    whose values are all NULL, NULL for one without rows)."""
    def rows_of(measure):
        return F.sum(F.when(F.col("measure") == measure, F.col("rows")))

    def or_zero(measure):
        return F.when(rows_of(measure) > 0, F.coalesce(_sum_of(measure), F.lit(0.0)))

    return state.groupBy("GraderBatchID").agg(
        _sum_of(JUICE).alias("juiceKgs"), _sum_of(SAMPLE).alias("sampleKgs"),
        or_zero(LOOSE).alias("looseKgs"), or_zero(TIPPED).alias("fieldBinsTipped"))


def presize_units(state: DataFrame) -> DataFrame:
    """PSgrowerRTEs per batch: NULL as soon as one summed value was NULL."""
    strict = F.when(F.sum("present") == F.sum("rows"), F.sum("total"))
    return state.groupBy("GraderBatchID").agg(half_even(strict, 0).alias("PSgrowerRTEs"))


class SeasonStore:
    """The refreshable reports under one folder of shared storage."""

    HEADER, OLD, STATE, UNITS, PRESIZE = "packout_header", "packout_legacy", "packout_state", "units", "presize_state"

    def __init__(self, spark, path: str, config: ReportConfig = DEFAULT_CONFIG):
        self.spark, self.path, self.config = spark, path.rstrip("/"), config

    def refresh(self, cat: Catalog, seasons: Iterable[int]) -> int:
        """Recompute and publish the given seasons; the rest stays as it is."""
        seasons = sorted({int(s) for s in seasons})
        header = current_header(cat, seasons, self.config).withColumn("Season", season_from_code("SeasonID", CURRENT, self.config))
        return versions.publish(self.spark, self.path, {
            self.HEADER: (header, "Season"),
            self.OLD: (union_all(self.spark, [legacy_packout(cat, seasons, self.config)], BATCH_PACKOUT), "Season"),
            self.STATE: (packout_state(cat, seasons, self.config), "FactSeason"),
            self.UNITS: (unit_header(cat, seasons, self.config), "SeasonDesc"),
            self.PRESIZE: (presize_state(cat, seasons, self.config), "FactSeason"),
        }, seasons)

    def _read(self, name: str, seasons, version) -> DataFrame:
        return versions.read(self.spark, self.path, name, seasons, version)

    def batch_packout(self, seasons: Iterable[int], version: int | None = None) -> DataFrame:
        """``batch_packout`` of any set of published seasons."""
        seasons = [int(s) for s in seasons]
        branches = []
        for gen in self.config.generations_for(seasons):
            if gen == LEGACY:
                branches.append(self._read(self.OLD, seasons, version))
            else:
                state = self._read(self.STATE, seasons, version)
                out = attach(self._read(self.HEADER, seasons, version), measures(state), "GraderBatchID")
                branches.append(finish_current(out, self.config))
        return union_all(self.spark, branches, BATCH_PACKOUT)

    def defect_share(self, cat: Catalog, seasons: Iterable[int], version: int | None = None) -> DataFrame:
        """``defect_share`` over the stored pack-out; assessments carry their
        own season, so they are read from the catalog."""
        seasons = [int(s) for s in seasons]
        return to_schema(defect_share(cat, seasons, self.config, packout=self.batch_packout(seasons, version)), DEFECT_SHARE)

    def pack_units(self, seasons: Iterable[int], version: int | None = None) -> DataFrame:
        """``pack_units`` of any set of published seasons."""
        out = attach(self._read(self.UNITS, seasons, version), presize_units(self._read(self.PRESIZE, seasons, version)), "GraderBatchID")
        return to_schema(finish_units(out), PACK_UNITS)
