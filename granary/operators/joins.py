"""Joins with a chosen strategy, lookups and row replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators.sizing import BROADCAST_BYTES, broadcast_if_small, proven_small
from granary.operators.skew import salted_join
from granary.session import profile_session

STRATEGIES = ("merge", "shuffle_hash", "broadcast")


def equi_join(left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str = "inner", strategy: str | None = None) -> DataFrame:
    """Join on ``left column -> right column`` pairs; both key columns stay.

    Raises if the result would carry one name twice: such columns can be seen but no longer selected. ``strategy`` is a hint for
    this join alone; ``broadcast`` is honoured only for a right side that is proven small.
    """
    twice = set(left.columns) & set(right.columns)
    if twice:
        raise ValueError(f"both sides have {sorted(twice)}: rename one side or join USING the column")
    if strategy is not None and strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    condition = F.lit(True)
    for one, other in on.items():
        condition = condition & (left[one] == right[other])
    if strategy == "broadcast":
        right = broadcast_if_small(right)
    elif strategy:
        right = right.hint(strategy)
    return left.join(right, condition, how)


def pruned_join(partitioned: DataFrame, dimension: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Inner join of a table in partition directories with a filtered ``dimension``, by partition columns.

    The filter of the dimension becomes one of the scan while the query runs: of the partitioned table only the directories whose
    values the dimension holds are read. That needs the dimension broadcast, which happens behind a check of its size; a larger one
    makes a plain join. ``partitioned`` must be a plain read, with the values of its partitions as columns.
    """
    return equi_join(partitioned, dimension, on, "inner", "broadcast")


def join_left_when(left: DataFrame, right: DataFrame, on: Mapping[str, str], when: Column) -> DataFrame:
    """Left outer join that only looks for partners of left rows fulfilling ``when``; every left row stays.

    ``when`` is part of the join condition, not a filter: rows that fail it keep an empty right side. Raises if the result would carry
    one name twice.
    """
    twice = set(left.columns) & set(right.columns)
    if twice:
        raise ValueError(f"both sides have {sorted(twice)}: rename one side")
    condition = when
    for one, other in on.items():
        condition = condition & (left[one] == right[other])
    return left.join(right, condition, "left_outer")


def replicate(df: DataFrame, copies: int, name: str) -> DataFrame:
    """Each row once for every number in ``[0, copies)``: the product with a fixed sequence, without a join."""
    if copies < 1:
        raise ValueError("copies must be positive")
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def unique_entries(table: DataFrame, key: str) -> DataFrame:
    """The rows of a lookup table without null keys; a key that is there twice raises when the job runs.

    Rows are counted by key and then joined with the table itself, so values of any type need no sort.
    """
    known = table.where(F.col(key).isNotNull())
    counts = known.groupBy(F.col(key).alias("_counted")).agg(F.count(F.lit(1)).alias("_entries"))
    twice = F.raise_error(F.concat(F.lit(f"duplicate lookup key in {key}: "), F.col(key).cast("string")))
    checked = known.join(counts, F.col(key) == F.col("_counted"))
    return checked.select(*[F.when(F.col("_entries") > 1, twice.cast(field.dataType)).otherwise(F.col(f"`{field.name}`")).alias(field.name)
                            if field.name != key else F.col(f"`{key}`") for field in table.schema])


def lookup(df: DataFrame, key: str, table: DataFrame, table_key: str, value: str, default: object = None,
           max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add column ``value`` of ``table`` to each row; a key without an entry gets ``default``.

    A key that ``table`` lists twice raises when the job runs. A proven small table is broadcast, a larger one joined with
    heavy keys spread.
    """
    entries = unique_entries(table.select(F.col(table_key).alias(key), value), key)
    if proven_small(table.select(table_key, value), max_bytes):
        joined = df.join(F.broadcast(entries), key, "left_outer").select(*df.columns, value)
    else:
        joined = salted_join(df, entries, key).select(*df.columns, value)
    if default is None:
        return joined
    return joined.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def lookup_literal(key: Column, entries: Mapping[object, object]) -> Column:
    """Look ``key`` up in a small mapping that is written into the plan; a missing key gives null."""
    pairs = [F.lit(part) for item in entries.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), key)


def adaptive_session(spark: SparkSession, partition_bytes: str = "64MB", skewed_bytes: str = "256MB", skew_factor: float = 5.0,
                     broadcast_bytes: str = "32MB") -> SparkSession:
    """A session for joins that are re-planned while they run.

    Small shuffle partitions are merged up to ``partition_bytes``. A partition beyond ``skewed_bytes`` and ``skew_factor`` times
    the median is split. A sort-merge join whose side turns out to be below ``broadcast_bytes`` becomes a broadcast join.
    """
    return profile_session(spark, {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": partition_bytes,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": skewed_bytes,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": skew_factor,
        "spark.sql.autoBroadcastJoinThreshold": broadcast_bytes,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": broadcast_bytes,
    })


def shuffle_hash_session(spark: SparkSession, map_bytes: str = "128MB") -> SparkSession:
    """A session that hashes instead of sorting where every partition of the build side is measured to be below ``map_bytes``.

    Unlike the plain hint it cannot run out of memory on a large or skewed build side: such joins stay sort-merge.
    """
    return profile_session(spark, {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": map_bytes,
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    })
