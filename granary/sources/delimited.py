"""CSV: declared, inferred and header-less reads, and rows that do not fit the schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, mode: str = "PERMISSIVE",
             bad_column: str | None = None, options: Mapping[str, object] | None = None) -> DataFrame:
    """CSV files with a header line.

    Without ``schema`` the types are inferred by an extra pass over the files, in which a single odd value turns its whole column
    into text. ``bad_column`` (PERMISSIVE only) receives the raw line of a row that does not fit; its good fields stay.

    The parser looks only at the columns a query uses. A row with a bad field is noticed, dropped or refused only by queries that
    use that field, so count such frames with ``count_rows``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    reader = spark.read.option("header", True).option("mode", mode)
    if bad_column:
        if mode != "PERMISSIVE" or schema is None:
            raise ValueError("a column for bad lines needs a schema and the mode PERMISSIVE")
        declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if bad_column not in declared.fieldNames():
            declared = T.StructType([*declared.fields, T.StructField(bad_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", bad_column).schema(declared)
    elif schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.options(**dict(options or {})).csv(path)


def read_csv_plain(spark: SparkSession, path: str) -> DataFrame:
    """CSV without any option: every line is a row of text columns ``_c0``, ``_c1`` and so on."""
    return spark.read.csv(path)


def count_rows(df: DataFrame) -> int:
    """Rows of a parsed file with every field parsed, so that rows with bad fields are treated as their mode says.

    A bare ``count()`` reads no column and would miss them. The hash keeps all columns in the plan; nothing is cached.
    """
    return df.agg(F.count(F.lit(1)).alias("rows"), F.max(F.xxhash64(*df.columns)).alias("all_columns")).head()["rows"]


def mark_bad(df: DataFrame, bad_column: str, name: str = "is_bad") -> DataFrame:
    """Add whether a row does not fit the schema, the same verdict whatever other columns are used.

    The parser looks only at the columns a query needs, and would overlook a bad field in another. So the verdict depends on a hash
    of all fields in a way that is always true, which the optimizer does not know.
    """
    all_fields = F.pmod(F.xxhash64(*[F.col(f"`{column}`") for column in df.columns]), F.lit(2)) < 2
    return df.withColumn(name, F.col(bad_column).isNotNull() | ~all_fields)


def split_bad(df: DataFrame, bad_column: str) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema (without the bad-line column) and rows that do not (with it); together they are all rows.

    Each half that is used parses the files once. ``mark_bad`` serves both with one pass.
    """
    marked = mark_bad(df, bad_column, "_bad")
    return marked.where("NOT _bad").drop("_bad", bad_column), marked.where("_bad").drop("_bad")
