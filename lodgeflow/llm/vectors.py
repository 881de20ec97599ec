"""Vectors that can be compared, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is neither null, empty nor zero and holds finite numbers only."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def dimension(vectors: DataFrame, vector: str) -> int | None:
    """The most frequent size, of several the largest; vectors of another size take no part."""
    found = vectors.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return None if found is None else found["d"]


def packed(rows, dtype=np.float64) -> bytes:
    """Vectors as the bytes of one matrix."""
    return np.array(list(rows), dtype=dtype).tobytes()
