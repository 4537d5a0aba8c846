"""JSON documents and plain text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_json(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """One JSON document per line. A declared schema may name a part of the fields and other types (numbers as text).

    Without it the fields are inferred by an extra pass over the files and come out sorted by name.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_json_document(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """Pretty-printed JSON, one document or array per file. A file cannot be split, so keep such files small."""
    reader = spark.read.option("multiLine", True)
    return (reader if schema is None else reader.schema(schema)).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines in column ``value``."""
    return spark.read.text(path)
