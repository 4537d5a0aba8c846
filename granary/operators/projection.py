"""Columns: casts, additions, renames, removals, missing values and text predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Cast columns by type name. A value that does not fit becomes null, or raises at run time if ``strict``."""
    return df.withColumns({name: F.col(name).cast(kind) if strict else F.col(name).try_cast(kind) for name, kind in types.items()})


def whole_number(value: str | Column) -> Column:
    """A number rounded down to a bigint: one definite answer where engines differ in casting fractions."""
    return F.floor(value).cast("bigint")


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename ``old -> new``; new names may hold spaces. Unlike the built-in call an unknown old name raises."""
    unknown = set(names) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return df.withColumnsRenamed(dict(names))


def case_map(column: Column, values: Mapping[object, object], otherwise: object = None) -> Column:
    """``CASE column WHEN key THEN value …``: values without an entry give ``otherwise``."""
    (first, result), *rest = values.items()
    chain = F.when(column == F.lit(first), F.lit(result))
    for value, result in rest:
        chain = chain.when(column == F.lit(value), F.lit(result))
    return chain.otherwise(F.lit(otherwise))


def equals_ignore_case(column: Column, value: str) -> Column:
    """Case-insensitive equality with a value that is bound, not formatted into SQL."""
    return F.lower(column) == F.lower(F.lit(value))


def drop_rows_with_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any column, or in any of ``subset``; an empty string is not null."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def drop_empty_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which all columns, or all of ``subset``, are null."""
    return df.na.drop("all", subset=list(subset) if subset else None)
