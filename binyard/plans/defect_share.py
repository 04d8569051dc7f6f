"""``defect_share``: defect quantity per (season, batch, defect) and its share
of the batch's rejected fruit.

Plan per generation (only generations whose seasons meet the request):

* assessments of the wanted template and seasons (template filter applied to
  the small template list, then a broadcast semi join);
* raw defects joined to those assessments in one exchange (Spark filters the
  defect scan by a runtime Bloom filter of the wanted assessments where that
  pays, and splits a hot assessment), then summed per (Season, GraderBatchID,
  DefectID) with map-side partial sums; the strict (NULL-poisoning) sum is
  carried as partial sum + counts so it can be combined again per (Season,
  GraderBatchID, Defect);
* sample size per (Season, GraderBatchID) as a SQL sum.

Then the union of both generations is joined to the sample sizes and to
``batch_packout`` on the composite key (Season, GraderBatchID).  The
"FarmName is present" filter makes that last join an inner join.  Russet
labels are merged *after* aggregation, so a batch can carry two "Russet" rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binyard import config as C
from binyard.config import DEFAULT_CONFIG, ReportConfig
from binyard.functions.semantics import (
    ieee_div, season_code_filter, season_from_code, server_equals, server_sum,
)
from binyard.operators.joins import attach, lookup
from binyard.operators.unions import to_schema
from binyard.plans.batch_packout import batch_packout
from binyard.plans.schemas import DEFECT_SHARE
from binyard.sources.catalog import Catalog


def _wanted_assessments(cat: Catalog, gen: str, seasons, config: ReportConfig) -> DataFrame:
    cond = F.lit(False)
    for name in config.templates[gen]:
        cond = cond | server_equals("TemplateName", name, config.server_collation)
    templates = cat.dim(gen, "qa_TemplateT").filter(cond).select("TemplateID")
    a = cat.table(gen, "qa_AssessmentT").filter(season_code_filter("SeasonID", seasons, gen, config))
    a = a.join(templates, "TemplateID", "left_semi")
    return a.withColumn("Season", season_from_code("SeasonID", gen, config))


def defect_partials(cat: Catalog, gen: str, seasons,
                    config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    """(Season, GraderBatchID, Defect) with partial sum, non-NULL and row counts."""
    a = _wanted_assessments(cat, gen, seasons, config).select("AssessmentID", "GraderBatchID",
                                                              "Season")
    # The wanted assessments restrict the raw rows in one exchange (a hot
    # assessment is split by AQE); sums are partial before the next one.
    d = (cat.table(gen, "qa_Assessment_DefectT").join(a, "AssessmentID", "inner")
         .groupBy("Season", "GraderBatchID", "DefectID")
         .agg(F.sum("DefectQty").alias("_sum"),
              F.count("DefectQty").alias("_nonnull"),
              F.count(F.lit(1)).alias("_rows")))
    d = lookup(d, cat.dim(gen, "qa_DefectT"), "DefectID", ["Defect"])
    return d.select("Season", "GraderBatchID", "Defect", "_sum", "_nonnull", "_rows")


def sample_sizes(cat: Catalog, gen: str, seasons,
                 config: ReportConfig = DEFAULT_CONFIG) -> DataFrame:
    return (_wanted_assessments(cat, gen, seasons, config)
            .filter(F.col("GraderBatchID").isNotNull())
            .groupBy("Season", "GraderBatchID")
            .agg(server_sum("SampleQty").cast("bigint").alias("sampleQty")))


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def defect_share(cat: Catalog, seasons: Iterable[int], config: ReportConfig = DEFAULT_CONFIG,
                 packout: DataFrame | None = None) -> DataFrame:
    """Defect share per (Season, GraderBatchID, Defect).

    ``packout`` may pass an already built ``batch_packout`` for the same
    seasons; by default it is built here (the reference calls it too).
    """
    seasons = [int(s) for s in seasons]
    gens = config.generations_for(seasons)
    if not gens:
        return cat.spark.createDataFrame([], DEFECT_SHARE)
    partials = _union([defect_partials(cat, g, seasons, config) for g in gens])
    samples = _union([sample_sizes(cat, g, seasons, config) for g in gens])

    # R's sum() without na.rm: NULL as soon as one quantity in the group is NULL.
    da = (partials.groupBy("Season", "GraderBatchID", "Defect")
          .agg(F.when(F.sum("_nonnull") == F.sum("_rows"), F.sum("_sum"))
               .cast("bigint").alias("defectQty")))
    da = attach(da, samples, ["Season", "GraderBatchID"])
    gbd = packout if packout is not None else batch_packout(cat, seasons, config)
    gbd = gbd.filter(F.col("FarmName").isNotNull())
    da = attach(da, gbd, ["Season", "GraderBatchID"], how="inner")
    da = da.withColumn(
        "proportion",
        ieee_div((F.lit(1.0) - F.col("packOut")) * F.col("defectQty"), "sampleQty"))
    da = da.withColumn(
        "Defect",
        F.when(F.col("Defect").isin(list(C.RUSSET_SOURCE_LABELS)), F.lit(C.RUSSET_LABEL))
        .otherwise(F.col("Defect")))
    return to_schema(da, DEFECT_SHARE)
