"""Order, limit and unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from granary.operators.skew import as_list


def sort_rows(df: DataFrame, order: Sequence[str | Column], tiebreak: str | Sequence[str]) -> DataFrame:
    """Global sort. The tiebreak makes the order total and lets the range partitioning cut through a value held by many rows."""
    return df.orderBy(*order, *as_list(tiebreak))


def top_rows(df: DataFrame, order: Sequence[str | Column], n: int, tiebreak: str | Sequence[str]) -> DataFrame:
    """The first ``n`` rows in a total order; each task keeps only its own ``n`` best."""
    return sort_rows(df, order, tiebreak).limit(n)


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by position, duplicates kept, names and nullability from the first, types widened."""
    first, *rest = frames
    for frame in rest:
        first = first.unionAll(frame)
    return first


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by column name, whatever their column order."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by position, each once."""
    return union_all(*frames).distinct()
