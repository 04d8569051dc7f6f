"""What the vector operators share: which vectors take part, and their exact
integer form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 256
#: Components of this size and more would let integer sums leave 64 bits.
LIMIT = float(1 << 19)


def finite(df: DataFrame, vec: str) -> DataFrame:
    """Rows whose vector can take part: not null, not empty, and with no null,
    NaN, infinite or oversized (``LIMIT``) component."""
    ok = F.forall(F.col(vec), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < LIMIT))
    return df.filter(F.col(vec).isNotNull() & (F.size(vec) > 0) & ok)


def common_dimension(df: DataFrame, vec: str) -> int:
    """The length most vectors have, the longer on ties; 0 without vectors.
    One grouped count."""
    top = df.groupBy(F.size(vec).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return top["d"] if top else 0


def quantised(column: pa.Array, dim: int) -> np.ndarray:
    """``floor(256 * x)`` of every component, as (rows, dim) integers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values * SCALE).astype(np.int64).reshape(len(column), dim)
