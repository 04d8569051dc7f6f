"""By-name union of report branches with explicit output types (``bind_rows``).

Each branch is projected to the report schema (missing columns become typed
NULLs, every column is cast to the declared type) before ``unionByName``, so
the result never depends on Spark's type widening.  With no branch left after
source gating, a typed empty frame is returned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def schema_columns(df: DataFrame, schema: T.StructType) -> list:
    """One projection item per declared field: the column itself when its type
    already matches, else a cast; a typed NULL when the column is missing."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        if f.name not in have:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == f.dataType:
            out.append(f.name)
        else:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return out


def to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(schema_columns(df, schema))


def union_all(spark: SparkSession, branches: Sequence[DataFrame],
              schema: T.StructType) -> DataFrame:
    branches = [to_schema(b, schema) for b in branches]
    if not branches:
        return spark.createDataFrame([], schema)
    out = branches[0]
    for b in branches[1:]:
        out = out.unionByName(b)
    return out
