"""Helpers that several operators share."""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def others(df: DataFrame, made: Sequence[str]) -> list[Column]:
    """The columns of ``df`` that an operator does not make itself; a column of the same name (in any case) gives way to the made one."""
    taken = {name.lower() for name in made}
    return [F.col(f"`{name}`") for name in df.columns if name.lower() not in taken]


def same_columns(docs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``docs`` with exactly ``columns``, in that order."""
    return docs.select(*[F.col(f"`{name}`") for name in columns])


def hash128(*columns: Column) -> list[Column]:
    """Two independent 64-bit hashes of some columns; nulls are told from every value."""
    parts = [part for column in columns for part in (column.isNull(), column)]
    return [F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)]


def is_held_out(doc_id: Column, parts: int = 5) -> Column:
    """Whether a document is kept away from training: the crc32 of its id as text is divisible by ``parts``. A null id never is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == 0, F.lit(False))


def blocks_for(rows: int, per_block: int) -> int:
    return max(1, math.ceil(rows / per_block))


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF
