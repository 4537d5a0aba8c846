"""Parquet and ORC, nested directories, source files and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from granary.session import profile_session

TEXT_PARTITIONS = {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files; ``path`` may be a file, a directory with partitions or a glob."""
    return spark.read.parquet(path)


def read_footers(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files whose counts, minima and maxima come from their footers, without a look at the values.

    Serves ``count``, ``min`` and ``max`` over whole files, by partition column if grouped, without filters on other columns; anything
    else is computed as usual. Minima and maxima of numbers, dates and truth values are in the footers, those of text are not used. The
    read is planned in a sibling session.
    """
    session = profile_session(spark, {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
                                      "spark.sql.parquet.aggregatePushdown": True})
    return session.read.parquet(path)


def read_partitioned(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """Parquet files in partition directories, with the partition values as the text that stands in the path, or as ``schema`` says.

    A plain read guesses: it takes ``dept=001`` for the number 1.
    """
    session = profile_session(spark, TEXT_PARTITIONS)
    return (session.read if schema is None else session.read.schema(schema)).parquet(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def read_nested(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """All files below ``path``. Directory names are not read as partition columns."""
    return spark.read.option("recursiveFileLookup", True).format(format).load(path)


def with_source_file(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Each row with the name of the file it came from; ``df`` must still be a plain file read."""
    return df.withColumn(name, F.col("_metadata.file_name"))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the session catalog, with the bucketing it was saved with."""
    return spark.read.table(name)
