"""One extract per value of a column."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.joins import lookup_literal
from granary.operators.sizing import row_bytes
from granary.operators.skew import spread

TARGET = "extract"


def select_extracts(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Rows whose ``key`` is one of ``values`` whatever the case, with the lower-case value in column ``extract``."""
    return df.where(F.lower(key).isin([value.lower() for value in values])).withColumn(TARGET, F.lower(key))


def multi_extract(df: DataFrame, key: str, values: Sequence[str], path: str, format: str = "csv", files_per_value: int = 1) -> None:
    """Write the rows of each value to its own directory ``extract=<lower-case value>``; ``key`` stays in the files.

    Exactly ``files_per_value`` files for each value, fewer only for one with fewer rows. One pass serves all values.
    """
    files = {value.lower(): files_per_value for value in values}
    _write_extracts(select_extracts(df, key, values), files, path, format, df.columns)


def multi_extract_by_size(df: DataFrame, key: str, values: Sequence[str], path: str, format: str = "csv",
                          bytes_per_file: int = 256 * 1024 * 1024) -> dict[str, int]:
    """``multi_extract`` with as many files for each value as its rows need at ``bytes_per_file``, by one pass that measures.

    Returns the number of files of each value that was found.
    """
    chosen = select_extracts(df, key, values)
    # at most one row per given value
    sizes = chosen.groupBy(TARGET).agg(F.sum(row_bytes(df)).alias("bytes")).orderBy(TARGET).collect()
    files = {row[TARGET]: max(1, math.ceil(row["bytes"] / bytes_per_file)) for row in sizes}
    _write_extracts(chosen, files, path, format, df.columns)
    return files


def _write_extracts(chosen: DataFrame, files: dict[str, int], path: str, format: str, columns: Sequence[str]) -> None:
    if not files:
        chosen.limit(0).write.partitionBy(TARGET).format(format).save(path)
        return
    first_slot = dict(zip(files, accumulate(files.values(), initial=0)))
    target = F.col(TARGET)
    slot = lookup_literal(target, first_slot) + spread(lookup_literal(target, files), columns)
    placed = chosen.withColumn("_slot", slot).repartitionById(sum(files.values()), F.col("_slot")).drop("_slot")
    writer = placed.write.partitionBy(TARGET).format(format)
    (writer.option("header", True) if format == "csv" else writer).save(path)
