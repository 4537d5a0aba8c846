"""Nested columns: struct expansion and array explosion."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def expand_struct(df: DataFrame, column: str) -> DataFrame:
    """Replace a struct column by its fields, after the other columns."""
    return df.select(*[F.col(f"`{name}`") for name in df.columns if name != column], f"{column}.*")


def explode_array(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row per array element in column ``name``; the array goes away. A null or empty array drops its row.

    Rows without elements are dropped by position after the explosion. For a plain explosion the optimizer infers a filter on the
    array and moves it down to the scan, where an array that comes out of parsed JSON would be parsed once more per condition.
    """
    others = [F.col(f"`{other}`") for other in df.columns if other != column]
    exploded = df.select(*others, F.posexplode_outer(column).alias("_position", name))
    return exploded.where(F.col("_position").isNotNull()).drop("_position")


def flatten(df: DataFrame, arrays: Mapping[str, str]) -> DataFrame:
    """One row per combination of the elements of several arrays: ``arrays`` names each array column and the column of its elements.

    An element that is a struct becomes its fields. The explosions follow each other and all stay in the map stage.
    """
    for column, name in arrays.items():
        df = explode_array(df, column, name)
        if isinstance(df.schema[name].dataType, StructType):
            df = expand_struct(df, name)
    return df
