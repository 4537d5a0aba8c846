"""Parquet tables with a list of their files, so that a delete writes only those files anew that it changes."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from granary.operators.sizing import broadcast_if_small
from granary.operators.skew import as_list
from granary.session import scratch_path

# Spark skips names with an underscore when it looks for data files.
LISTS = "_lists"


def _versions(spark: SparkSession, root: str) -> list[str]:
    """The complete lists of a table, oldest first."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{LISTS}")
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = files.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place, "*/_SUCCESS")) or []
    return sorted(status.getPath().getParent().getName() for status in done)


def _all_files(spark: SparkSession, root: str) -> DataFrame:
    """The path of every data file below ``root``; none is opened."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(F.col("_metadata.file_path").alias("path"))


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """The paths of the files that make up the table now: those of its newest list, or all files below ``root`` without one."""
    versions = _versions(spark, root)
    return spark.read.schema("path string").parquet(f"{root.rstrip('/')}/{LISTS}/{versions[-1]}") if versions else _all_files(spark, root)


def _read(spark: SparkSession, root: str, paths: Sequence[str], schema: str | StructType | None) -> DataFrame:
    reader = spark.read.option("basePath", root)
    return (reader.schema(schema) if schema is not None else reader).parquet(*paths)


def read_listed(spark: SparkSession, root: str, schema: str | StructType | None = None) -> DataFrame:
    """The rows of the listed files. Their names come to the driver, as for every scan; files of later lists are not seen.

    State a ``schema`` where partition values are not to be guessed.
    """
    paths = [unquote(row["path"]) for row in listed_files(spark, root).collect()]
    # a table that has lost all rows has no files either
    return _read(spark, root, paths, schema) if paths else _read(spark, root, [root], schema).limit(0)


def delete_from_files(spark: SparkSession, root: str, ids: DataFrame, key: str, by: str | Sequence[str] = (),
                      schema: str | StructType | None = None) -> int:
    """Delete the rows whose ``key`` is among ``ids`` from the parquet table at ``root``; returns the number of files written anew.

    First the key column alone is read, to find the files that hold one of the keys. Their other rows are written as further files, in
    the same partition directories if ``by`` names some; all other files are not touched. Then a new list names the files that make up
    the table from now on. Readers through ``read_listed`` see the table before or after the delete, never between; nothing is removed, so
    queries that run meanwhile go on, and a call that ends early leaves files that no list names. Unknown ids change nothing, a null
    matches nothing. One delete at a time: two at once would each start from the same list.
    """
    gone = broadcast_if_small(ids.select(key).where(F.col(key).isNotNull()).distinct())
    scratch = scratch_path(spark, "file-lists")
    listed_files(spark, root).write.parquet(f"{scratch}/live")
    live = spark.read.parquet(f"{scratch}/live")
    rows = read_listed(spark, root, schema)
    held = rows.select(key, F.col("_metadata.file_path").alias("path")).join(gone, key, "left_semi")
    held.select("path").distinct().write.parquet(f"{scratch}/touched")
    touched = spark.read.parquet(f"{scratch}/touched")
    names = [unquote(row["path"]) for row in touched.collect()]
    if not names:
        return 0
    _all_files(spark, root).write.parquet(f"{scratch}/before")
    partitions = as_list(by)
    left = _read(spark, root, names, schema if schema is not None else rows.schema).join(gone, key, "left_anti").select(*rows.columns)
    left = left.hint("rebalance", *partitions) if partitions else left
    (left.write.mode("append").partitionBy(*partitions) if partitions else left.write.mode("append")).parquet(root)
    fresh = _all_files(spark, root).join(spark.read.parquet(f"{scratch}/before"), "path", "left_anti")
    following = live.join(touched, "path", "left_anti").unionAll(fresh)
    number = len(_versions(spark, root)) + 1
    following.coalesce(1).write.parquet(f"{root.rstrip('/')}/{LISTS}/{number:010d}")
    return len(names)
