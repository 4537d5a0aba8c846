"""How large a frame is, before anything is broadcast or written as one file."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 * 1024 * 1024

_UNITS = {"B": 1, "KiB": 2**10, "MiB": 2**20, "GiB": 2**30, "TiB": 2**40, "PiB": 2**50, "EiB": 2**60}
_LEAF = re.compile(r"^[ :+-]*(Relation|LogicalRDD|LocalRelation|Range|InMemoryRelation)\b")
_ESTIMATE = re.compile(r"sizeInBytes=([0-9.]+(?:E[+-]?[0-9]+)?) ?([KMGTPE]?i?B)")


def estimated_bytes(df: DataFrame) -> float:
    """The optimizer's size estimate for ``df``; starts no job."""
    plan = df.sparkSession.sql("EXPLAIN COST SELECT * FROM {frame}", frame=df).head()[0]
    found = _ESTIMATE.search(plan)
    return float(found.group(1)) * _UNITS[found.group(2)] if found else float("inf")


def scanned_bytes(df: DataFrame) -> float:
    """The size of all files and local rows that ``df`` reads, each source once; starts no job."""
    plan = df.sparkSession.sql("EXPLAIN COST SELECT * FROM {frame}", frame=df).head()[0]
    logical = plan.split("== Physical Plan ==")[0]
    sizes = {}
    for line in logical.splitlines():
        found, leaf = _ESTIMATE.search(line), _LEAF.search(line)
        if found and leaf:
            sizes[line.split(", Statistics")[0].lstrip(" :+-")] = float(found.group(1)) * _UNITS[found.group(2)]
    return sum(sizes.values()) if sizes else estimated_bytes(df)


def row_bytes(df: DataFrame) -> Column:
    """Bytes one row takes: eight per column and the length of its variable-length values."""
    width = F.lit(8 * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))), F.lit(0))
    return width.cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows, by one aggregate job that returns a single number."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).head()["bytes"]


def proven_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is known to fit into ``max_bytes``.

    The estimate rules large inputs out without a job; only what passes it is measured, which then reads at most about
    ``max_bytes`` of files. The measure is needed because compressed files can unfold to many times their size.
    """
    return estimated_bytes(df) <= max_bytes and measured_bytes(df) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it is proven small, else ``df`` unchanged, which leaves the choice to the planner."""
    return F.broadcast(df) if proven_small(df, max_bytes) else df
