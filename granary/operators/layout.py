"""File layout of parquet tables: sizes, ranges per file, compaction and clustering."""

from __future__ import annotations

import math
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators.sizing import measured_bytes
from granary.operators.skew import as_list
from granary.session import profile_session
from granary.sources.columnar import TEXT_PARTITIONS, read_partitioned

TASK_BYTES = 128 * 1024 * 1024


def file_stats(df: DataFrame, column: str, by: str | Sequence[str] = ()) -> DataFrame:
    """Minimum, maximum and rows of ``column`` per file (and per partition column in ``by``) of a plain file read."""
    groups = [F.col(name) for name in as_list(by)] + [F.col("_metadata.file_name").alias("file_name")]
    return df.groupBy(*groups).agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"),
                                   F.count(F.lit(1)).alias("rows"))


def file_bytes(spark: SparkSession, path: str, where: str | None = None) -> int:
    """Total size of the data files below ``path``, of the partitions chosen by ``where`` if given.

    Each file is one row of path and length; no file is opened, and names do not matter, beyond that Spark skips those that begin with
    a dot or an underscore. Files are packed into at most a thousand tasks.
    """
    settings = {"spark.sql.files.maxPartitionNum": 1000, **TEXT_PARTITIONS}
    files = profile_session(spark, settings).read.format("binaryFile").load(path)
    chosen = files.where(where) if where else files
    return chosen.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).head()["bytes"]


def _ordered(df: DataFrame, column: str) -> Column:
    """A value that orders like ``column`` and keeps every difference: numbers and text as they are, times as whole numbers."""
    kind = df.schema[column].dataType
    value = F.col(f"`{column}`")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(value)
    if isinstance(kind, (T.StringType, T.NumericType)):
        return value
    raise ValueError(f"cannot cluster by {column} of type {kind.simpleString()}")


def _bounds(values: DataFrame, name: str, buckets: int) -> list:
    """At most ``buckets - 1`` ascending values that cut the rows into ranges of about equal weight, whatever the type.

    Spark's own range partitioning finds them from a sample of whole values; only the greatest value of each range is collected.
    """
    ranged = values.select(name).where(F.col(name).isNotNull()).repartitionByRange(buckets, name)
    tops = ranged.groupBy(F.spark_partition_id().alias("range")).agg(F.max(name).alias("top"))
    return sorted({row["top"] for row in tops.collect()})[:-1]


def _with_bucket(df: DataFrame, value: str, bounds: Sequence[object], bits: int, name: str) -> DataFrame:
    """Add how many of the ascending bounds lie below ``value``; null counts as lowest.

    Bisection, one projection per bit: each looks one bound up in a constant array, so it compiles to a few instructions.
    """
    limits = F.array(*[F.lit(bound) for bound in bounds]).cast(T.ArrayType(df.schema[value].dataType))
    df = df.withColumn(name, F.lit(0))
    for bit in reversed(range(bits)):
        step = 2 ** bit
        above = F.get(limits, F.col(name) + (step - 1)) < F.col(value)
        df = df.withColumn(name, F.col(name) + F.when(above, step).otherwise(0))
    return df


def with_curve_key(df: DataFrame, columns: Sequence[str], bits: int = 8, name: str = "_curve") -> DataFrame:
    """Add a number that is close for rows close in all ``columns``: the interleaved bits of their range buckets.

    Each column has ``2**bits`` buckets of about as many rows, cut between whole values. The bounds come to the driver, at most
    ``2**bits - 1`` for each column.
    """
    if bits * len(columns) > 62:
        raise ValueError("too many bits for one 64-bit key")
    values = {f"_value{i}": _ordered(df, column) for i, column in enumerate(columns)}
    keyed = df.withColumns(values)
    limits = {value: _bounds(keyed, value, 2 ** bits) for value in values}
    key = F.lit(0).cast("bigint")
    for i, value in enumerate(values):
        keyed = _with_bucket(keyed, value, limits[value], bits, f"_bucket{i}")
        for bit in range(bits):
            taken = F.shiftright(F.col(f"_bucket{i}").cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(taken, bit * len(columns) + i))
    return keyed.withColumn(name, key).select(*[F.col(f"`{column}`") for column in df.columns], name)


def curve_bits(files: int, columns: int) -> int:
    """Bits per column that tell ``files`` files apart with some to spare; a 64-bit key is the only limit."""
    return min(max(math.ceil(math.log2(max(files, 2)) / columns) + 3, 4), 62 // columns)


def cluster(df: DataFrame, columns: str | Sequence[str], files: int, bits: int | None = None, within: Sequence[str] = (),
            spread_by: Sequence[str | Column] | None = None) -> DataFrame:
    """The rows of ``df`` in ``files`` partitions, so that each holds a narrow range of ``columns``.

    One column: range partitions, sorted inside. Several: ranges of ``with_curve_key``. ``within`` names partition columns of the
    table that come first. A value held by many rows is cut through by ``spread_by`` (by default a hash of the row), so no partition
    has to take all of it.
    """
    names = as_list(columns)
    ties = [F.xxhash64(*df.columns)] if spread_by is None else list(spread_by)
    leading = [F.col(name) for name in within]
    if len(names) == 1:
        order = [F.col(names[0])]
        ranged = df.repartitionByRange(files, *leading, *order, *ties)
        return ranged.sortWithinPartitions(*leading, *order)
    keyed = with_curve_key(df, names, bits or curve_bits(files, len(names)))
    ranged = keyed.repartitionByRange(files, *leading, "_curve", *ties)
    return ranged.sortWithinPartitions(*leading, "_curve").drop("_curve")


def _aimed_files(rows: DataFrame, packed_bytes: int, target_bytes: int, task_bytes: int) -> int:
    """How many files ``rows`` need, so that each has at most about ``target_bytes``, and about ``task_bytes`` of unpacked rows.

    One task reads, sorts and writes all rows of a file, and packed bytes say little of how many these are.
    """
    return max(1, math.ceil(packed_bytes / target_bytes), math.ceil(measured_bytes(rows) / task_bytes))


def optimize_files(spark: SparkSession, path: str, destination: str, partition_by: str | Sequence[str] = (), where: str | None = None,
                   target_bytes: int = 256 * 1024 * 1024, cluster_by: str | Sequence[str] = (), task_bytes: int = TASK_BYTES) -> int:
    """Write a parquet table anew at ``destination``, in files of about ``target_bytes``, clustered by ``cluster_by`` if given.

    Files are smaller where their rows unpack to more than ``task_bytes``, which one task would have to take and sort; a larger
    ``task_bytes`` gives larger files for more memory. A sort takes two to four times these bytes for narrow rows.

    The new table is complete: ``where`` selects the partitions that get new files, all others are copied row by row as they are
    read. The old table stays, so readers and a lost driver are no danger; switch to the new one when the call returns, for example
    by a view. Partition values are read as the text that stands in the path, so ``001`` stays ``001``. Returns the number of files
    aimed at for the selected partitions.
    """
    by = as_list(partition_by)
    table = read_partitioned(spark, path)
    # a filter on other columns would cut partitions in two
    if where is not None and not (by and _uses_only(spark, table, where, by)):
        raise ValueError(f"where may only use the partition columns {by}: {where}")
    chosen = F.coalesce(F.expr(where), F.lit(False)) if where else F.lit(True)
    placed = table.where(chosen).withColumn("_place", F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    files = _aimed_files(placed, file_bytes(spark, path, where), target_bytes, task_bytes)
    names = as_list(cluster_by)
    if names:
        placed = cluster(placed, names, files, within=by, spread_by=["_place"])
    else:
        placed = placed.repartitionByRange(files, *by, "_place")
    _writer(placed.drop("_place"), by).parquet(destination)
    if where:
        _writer(table.where(~chosen), by).mode("append").parquet(destination)
    return files


def compact_partitions(spark: SparkSession, table: str, destination: str, where: str | None = None, target_bytes: int = 256 * 1024 * 1024,
                       cluster_by: str | Sequence[str] = (), task_bytes: int = TASK_BYTES) -> int:
    """Give the partitions of a catalog table that ``where`` selects new files, of about ``target_bytes``, below ``destination``.

    As in ``optimize_files``, files are smaller where their rows unpack to more than ``task_bytes``.

    Each partition of the catalog has a location of its own. Only the selected ones are read; their rows are written to new
    directories, clustered by ``cluster_by`` if given, and then the catalog is told, partition by partition, where they are now. All other
    partitions are neither read nor written and keep their files. A reader sees a partition before or after its switch, and the old
    files stay, so a query that runs meanwhile and a lost driver are no danger; a call that ended early can be repeated with another
    destination. ``where`` may use partition columns only. Returns the number of partitions switched.
    """
    by = [column.name for column in spark.catalog.listColumns(table) if column.isPartition]
    rows = spark.table(table)
    if not by or where is not None and not _uses_only(spark, rows, where, by):
        raise ValueError(f"where may only use the partition columns {by}: {where}")
    chosen = rows.where(where) if where else rows
    files = chosen.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).distinct()
    packed = files.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).head()["bytes"]
    placed = chosen.withColumn("_place", F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    aimed = _aimed_files(placed, packed, target_bytes, task_bytes)
    names = as_list(cluster_by)
    placed = cluster(placed, names, aimed, within=by, spread_by=["_place"]) if names else placed.repartitionByRange(aimed, *by, "_place")
    placed.drop("_place").write.partitionBy(*by).parquet(destination)
    # directories as Spark named them, with values of the table's types
    written = spark.read.schema(rows.schema).parquet(destination)
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    switched = written.select(*by, folder.alias("_folder")).distinct().collect()
    for row in switched:
        spec = ", ".join(f"`{name}` = {_sql_literal(row[name])}" for name in by)
        spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION {_sql_literal(unquote(row['_folder']))}")
    spark.catalog.refreshTable(table)
    return len(switched)


def _sql_literal(value: object) -> str:
    if value is None:
        return "null"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _writer(df: DataFrame, by: Sequence[str]) -> DataFrameWriter:
    return df.write.partitionBy(*by) if by else df.write


def _uses_only(spark: SparkSession, table: DataFrame, where: str, columns: Sequence[str]) -> bool:
    """Whether a filter can be resolved with nothing but ``columns`` of ``table``."""
    known = T.StructType([field for field in table.schema if field.name in columns])
    try:
        spark.createDataFrame([], known).where(where)
    except AnalysisException:
        return False
    return True


def point_lookup(spark: SparkSession, path: str, equal: dict[str, object]) -> DataFrame:
    """Rows with the given values. Partition columns prune directories; min/max statistics skip row groups for the others.

    Partition values are text, as in ``optimize_files``.
    """
    rows = read_partitioned(spark, path)
    for name, value in equal.items():
        rows = rows.where(F.col(name) == F.lit(value))
    return rows
