"""File writers. ``mode`` is one of error (refuse an existing path), ignore, append and overwrite."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame

from granary.operators.sizing import measured_bytes


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "error") -> None:
    df.write.mode(mode).option("header", header).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def write_with_blooms(df: DataFrame, path: str, distinct: Mapping[str, int], mode: str = "error") -> None:
    """Parquet files whose row groups carry a Bloom filter for each column of ``distinct``.

    A lookup of a value that is absent from a row group then skips it, also where the value lies between its least and greatest one, as
    in a table that is not clustered by the column. ``distinct`` gives the values expected in a file, by which a filter is sized. These
    columns go without a dictionary, which a filter does the work of.
    """
    writer = df.write.mode(mode)
    for name, values in distinct.items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true").option(f"parquet.bloom.filter.expected.ndv#{name}", str(values))
        writer = writer.option(f"parquet.enable.dictionary#{name}", "false")
    writer.parquet(path)


def write_orc(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).orc(path)


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).json(path)


def write_partitioned(df: DataFrame, path: str, by: str, mode: str = "error", format: str = "parquet") -> None:
    """One directory per value of ``by``; the column itself leaves the data files.

    Rows are brought together by value first, so a directory holds one file and not one per task. While it runs, adaptive execution
    cuts the shuffle partition of a value that is larger than the advisory size, so a heavy value is written by several tasks.
    """
    df.hint("rebalance", by).write.mode(mode).partitionBy(by).format(format).save(path)


def write_files(df: DataFrame, path: str, files: int = 1, format: str = "csv", header: bool = True, mode: str = "error") -> None:
    """Exactly ``files`` files, however large; a frame without rows gives one. The tasks that compute ``df`` stay parallel."""
    writer = df.repartition(files).write.mode(mode).format(format)
    (writer.option("header", header) if format == "csv" else writer).save(path)


def write_few_files(df: DataFrame, path: str, format: str = "csv", header: bool = True, mode: str = "error",
                    bytes_per_file: int = 256 * 1024 * 1024) -> int:
    """A single file if the measured data fit into ``bytes_per_file``, else as few files of that size as needed.

    Returns the number of files asked for. The tasks that compute ``df`` stay parallel; only the writing is narrowed.
    """
    files = max(1, math.ceil(measured_bytes(df) / bytes_per_file))
    write_files(df, path, files, format, header, mode)
    return files


def run_fully(df: DataFrame) -> None:
    """Compute every row and column and keep nothing."""
    df.write.format("noop").mode("overwrite").save()
