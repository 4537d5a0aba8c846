"""What the vector operators share: valid vectors and the merge of partial results."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & (F.size(vector) > 0), F.lit(False))


def matrix(values, dtype=np.float64) -> np.ndarray:
    """Rows of equal length as one array."""
    return np.array([np.asarray(value, dtype=dtype) for value in values], dtype=dtype)


def best_of(partial: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of the partial results of each query; map tasks drop what cannot be among them before the shuffle."""
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
