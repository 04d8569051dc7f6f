"""The corpus pipeline: quality rules, line dedup, MinHash near-dedup, benchmark
decontamination, mixing.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` whose result is
written as Parquet and read again as the next stage's ``docs``.  All stages but
the last return the columns of ``documents``; the mix adds ``copies``, how
often it takes a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from binyard.llm import decontaminate, line_dedup, mixing, near_dedup, quality
from binyard.llm.common import discard, scratch, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the classifier learns from ``labels``."""
    return quality.keep_good(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_spread(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites for their length go from all documents but one."""
    return line_dedup.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, 80 %."""
    return near_dedup.near_dedup(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies by source weight."""
    return mixing.mix_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_spread),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

#: The trained classifier and the sketches have no SQL form; the pipeline is
#: tested against brute-force stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  What a stage has staged goes once its
    result is written, and a result once the next one is."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, step in STAGES:
        with scratch() as made:
            docs, path = staged(step(spark, docs, sf_dir), name)
        for old in [p for p in made if p != path] + [before] * (before is not None):
            discard(spark, old)
        before = path
    return docs
