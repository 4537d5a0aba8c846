"""Keeping an intermediate result for reuse."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


_kept: list[DataFrame] = []


def keep(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK_DESER) -> DataFrame:
    """``df`` kept at ``level`` for results that are read later, until ``release_kept``."""
    _kept.append(df.persist(level))
    return _kept[-1]


def release_kept() -> int:
    """Release what ``keep`` has kept, and nothing else; returns how many frames that were."""
    released = len(_kept)
    while _kept:
        _kept.pop().unpersist()
    return released


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK_DESER) -> Iterator[DataFrame]:
    """``df`` kept at ``level`` inside the block and released after it; other cached frames stay.

    The default level spills to disk what does not fit, and lost pieces are computed again.
    """
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
