"""Appends and deletes by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.operators.sizing import broadcast_if_small, proven_small
from granary.operators.skew import hashable_columns
from granary.sources.columnar import read_partitioned


def new_rows(base: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key ``base`` does not hold yet.

    If ``new`` holds a key twice, the row with the greatest other columns is taken (maps and what holds them compare as JSON text).
    Null keys equal nothing: such rows are all new. Known keys are dropped first; then each task keeps one row of a key before the
    shuffle. Of the base only the key is read. With a proven small ``new`` it is not shuffled.
    """
    hashable = set(hashable_columns(new))
    if proven_small(new.select(key)):
        asked = F.broadcast(new.select(key).distinct())
        known = base.select(key).join(asked, key, "left_semi").distinct()
    else:
        known = base.select(key).distinct()
    fresh = new.join(known, key, "left_anti").select(*new.columns)
    order = [(F.col(f"`{name}`") if name in hashable else F.to_json(F.struct(F.col(f"`{name}`")))).desc() for name in new.columns if name != key]
    # each row without a key is a group of its own
    single = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    marked = fresh.withColumn("_single", single)
    place = F.row_number().over(Window.partitionBy(key, "_single").orderBy(*(order or [F.lit(1)])))
    return marked.withColumn("_place", place).where("_place = 1").select(*new.columns)


def keyed_append(base: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``base`` and the rows of ``new`` with keys that ``base`` does not hold."""
    return base.unionByName(new_rows(base, new, key))


def keyed_delete(base: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``base`` without the rows whose key is among ``ids``. Unknown ids change nothing; a null never matches."""
    gone = broadcast_if_small(ids.select(key).where(F.col(key).isNotNull()).distinct())
    return base.join(gone, key, "left_anti").select(*base.columns)


def append_files(path: str, new: DataFrame, key: str, by: str | None = None) -> None:
    """Add the new rows as further files of the parquet table at ``path``; what is there is read for its key and not rewritten."""
    base = read_partitioned(new.sparkSession, path)
    fresh = new_rows(base, new, key)
    if by:
        # rows come together by value first; adaptive execution cuts heavy ones while it runs
        fresh.hint("rebalance", by).write.mode("append").partitionBy(by).parquet(path)
    else:
        fresh.write.mode("append").parquet(path)
