"""Tables from given rows and number sequences."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def rows_table(spark: SparkSession, rows: Iterable[Sequence[object]], schema: str | StructType) -> DataFrame:
    """A table from rows in the program; a value of the wrong type raises at once."""
    return spark.createDataFrame(list(rows), schema=schema, verifySchema=True)


def sequence_table(spark: SparkSession, start: int, end: int, step: int = 1, name: str = "id") -> DataFrame:
    """Numbers ``start, start + step, …`` below ``end``, made by the tasks."""
    return spark.range(start, end, step).withColumnRenamed("id", name)
