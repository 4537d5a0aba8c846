"""Physical partitions of a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.skew import PIECE, heavy_keys, salt_rows


def repartition_even(df: DataFrame, partitions: int) -> DataFrame:
    """``partitions`` partitions of about equal size, by round robin."""
    return df.repartition(partitions)


def repartition_by_key(df: DataFrame, partitions: int, key: str) -> DataFrame:
    """Hash partitions by ``key``.

    All rows of a key share a partition, except for keys that hold more than an average partition: these are cut into as few
    pieces as bring each down to that size, in neighbouring partitions.
    """
    heavy = heavy_keys(df, key, partitions)
    salted = salt_rows(df, heavy, key, partitions, null_safe=True)
    place = ((F.pmod(F.xxhash64(key), F.lit(partitions)) + F.col(PIECE)) % partitions).cast("int")
    return salted.repartitionById(partitions, place).drop(PIECE)


def shrink_partitions(df: DataFrame, partitions: int) -> DataFrame:
    """At most ``partitions`` partitions without a shuffle; never more than there are."""
    return df.coalesce(partitions)


def with_partition(df: DataFrame, name: str = "partition_num") -> DataFrame:
    """Each row with the number of its physical partition."""
    return df.withColumn(name, F.spark_partition_id())


def partition_rows(df: DataFrame, number: int) -> DataFrame:
    """The rows of one physical partition."""
    return df.where(F.spark_partition_id() == number)
