"""Catalog tables: managed, partitioned, bucketed, and switching between versions."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators.sizing import scanned_bytes
from granary.operators.skew import PIECE, copy_rows, heavy_keys, salt_rows
from granary.session import profile_session


def save_table(df: DataFrame, name: str, mode: str = "error", path: str | None = None) -> None:
    """A parquet table; managed unless ``path`` is given."""
    writer = df.write.format("parquet").mode(mode)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def save_partitioned_table(df: DataFrame, name: str, by: str, path: str | None = None, mode: str = "error") -> None:
    """A table with one directory per value of ``by``, heavy values in several files."""
    writer = df.hint("rebalance", by).write.format("parquet").mode(mode).partitionBy(by)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def bucket_count(*frames: DataFrame, bytes_per_bucket: int = 512 * 1024 * 1024) -> int:
    """Buckets for tables that will be joined or grouped: one per core, more if the largest frame needs them, as many as Spark allows.

    A bucket is read by one task, so its size must not grow with the data. What counts is the size of what the frames read, not the
    optimizer's guess at a join's result, which is the product of its inputs.
    """
    largest = max(scanned_bytes(df) for df in frames)
    needed = math.ceil(largest / bytes_per_bucket) if math.isfinite(largest) else 0
    session = frames[0].sparkSession
    return min(max(session.sparkContext.defaultParallelism, needed, 2), int(session.conf.get("spark.sql.sources.bucketing.maxBuckets")))


def _save_buckets(df: DataFrame, name: str, buckets: int, columns: list[str], path: str | None, mode: str) -> None:
    # the write uses the hash of the buckets, so each bucket becomes one file
    writer = df.repartition(buckets, *columns).write.format("parquet").mode(mode).bucketBy(buckets, columns[0], *columns[1:])
    (writer.option("path", path) if path else writer).saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, buckets: int, key: str, path: str | None = None, mode: str = "error") -> bool:
    """A table hashed into ``buckets`` by ``key``, so that joins and groupings on it need no shuffle.

    If some key holds more rows than an average bucket, the buckets are cut by key and piece instead and True is returned.
    Groupings then shuffle one pre-aggregated row per key and task.
    """
    heavy = heavy_keys(df, key, buckets)
    if heavy.isEmpty():
        _save_buckets(df, name, buckets, [key], path, mode)
        return False
    _save_buckets(salt_rows(df, heavy, key, buckets, null_safe=True), name, buckets, [key, PIECE], path, mode)
    return True


def save_bucketed_pair(left: DataFrame, right: DataFrame, names: tuple[str, str], buckets: int, key: str,
                       paths: tuple[str | None, str | None] = (None, None), mode: str = "error") -> bool:
    """Two tables for joins on ``key`` with ``left`` as the big side.

    Heavy keys of ``left`` are spread over several buckets, and the matching rows of ``right`` are stored once per piece. Returns
    whether that was needed.
    """
    heavy = heavy_keys(left, key, buckets)
    if heavy.isEmpty():
        columns = [key]
    else:
        columns = [key, PIECE]
        left = salt_rows(left, heavy, key, buckets, null_safe=True)
        right = copy_rows(right, heavy, key, null_safe=True)
    for df, name, path in ((left, names[0], paths[0]), (right, names[1], paths[1])):
        _save_buckets(df, name, buckets, columns, path, mode)
    return PIECE in columns


def bucketed_join(spark: SparkSession, left: str, right: str, key: str, how: str = "inner") -> DataFrame:
    """Sort-merge join of two tables saved as a bucketed pair, without a shuffle; the key appears once.

    The tables may differ in their number of buckets if the greater is up to four times the lesser and a multiple of it: several
    buckets are then read by one task. Settings for that are those of a sibling session.
    """
    if how not in ("inner", "left_outer"):
        raise ValueError("a bucketed pair serves inner and left outer joins")
    session = profile_session(spark, {"spark.sql.bucketing.coalesceBucketsInJoin.enabled": True,
                                      "spark.sql.bucketing.coalesceBucketsInJoin.maxBucketRatio": 4})
    one, other = session.read.table(left), session.read.table(right)
    salted = {PIECE in one.columns, PIECE in other.columns}
    if len(salted) == 2:
        raise ValueError("the tables were not saved as a pair")
    on = [key, PIECE] if salted == {True} else [key]
    return one.hint("merge").join(other, on, how).drop(PIECE)


def publish_version(df: DataFrame, name: str, root: str, by: str | None = None) -> str:
    """Write a new version of a table below ``root`` and point the view ``name`` to it in one step.

    Readers see the old version or the new one, never a mixture, and ``df`` may be computed from the old one. Each version is a table
    of the catalog with the types of ``df``, so a partition value such as ``001`` stays text. An empty text cannot be told from null
    in a partition directory and raises. Returns the new path.
    """
    version = uuid.uuid4().hex
    path, table = f"{root.rstrip('/')}/version-{version}", f"{name}_{version}"
    if by and isinstance(df.schema[by].dataType, T.StringType):
        empty = F.raise_error(F.lit(f"an empty text in partition column {by}")).cast("string")
        df = df.withColumn(by, F.when(F.col(by) == "", empty).otherwise(F.col(by)))
    writer = df.hint("rebalance", by).write.partitionBy(by) if by else df.write
    writer.format("parquet").option("path", path).saveAsTable(table)
    columns = ", ".join(f"`{column}`" for column in df.columns)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {table}")
    return path


def drop_versions(spark: SparkSession, name: str) -> None:
    """Remove the view ``name`` and the catalog entries of all its versions; the files stay."""
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    for table in spark.catalog.listTables(pattern=f"{name}_*"):
        spark.sql(f"DROP TABLE {table.name}")
