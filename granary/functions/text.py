"""Text and JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def replace_pattern(column: str | Column, pattern: str, replacement: str) -> Column:
    """Replace every match of a regular expression."""
    return F.regexp_replace(column, pattern, replacement)


def joined_text(*parts: str | Column) -> Column:
    """Parts after each other, numbers as text; null if any part is null."""
    return F.concat(*parts)


def or_default(column: str | Column, default: object) -> Column:
    """The value, or ``default`` where it is null."""
    return F.coalesce(column, F.lit(default))


def parse_json(column: str | Column, schema: str) -> Column:
    """JSON text to a struct. Fields the schema leaves out are dropped; broken text gives a struct of nulls."""
    return F.from_json(column, schema)


def parse_variant(column: str | Column) -> Column:
    """JSON text of any shape to a variant, which keeps the types it finds; broken text and null give null."""
    return F.try_parse_json(column)


def variant_field(variant: str | Column, path: str, type: str) -> Column:
    """What stands at ``path`` of a variant, as ``type``; null if there is nothing, or nothing that fits."""
    return F.try_variant_get(F.col(variant) if isinstance(variant, str) else variant, path, type)


def variant_shape(variant: str | Column) -> Column:
    """``OBJECT``, ``ARRAY`` or the type of a single value; null for a null."""
    return F.regexp_extract(F.schema_of_variant(variant), "^[A-Z]+", 0)


def explode_variant(df: DataFrame, variant: str) -> DataFrame:
    """A row for each field of an object and each element of an array: ``pos``, ``key`` (null in arrays) and ``value``, beside the other
    columns. Rows whose variant is null, empty or a single value are gone."""
    kept = [F.col(f"`{name}`") for name in df.columns if name != variant]
    fields = df.sparkSession.tvf.variant_explode(F.col(f"`{variant}`").outer())
    return df.lateralJoin(fields).select(*kept, "pos", "key", "value")


def render_json(column: str | Column) -> Column:
    """Struct to compact JSON text; null fields are left out."""
    return F.to_json(column)
