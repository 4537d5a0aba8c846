"""Grouped and global aggregates, distinct rows and skew reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from granary.operators.skew import as_list


def _decimal(value: str | Column, scale: int) -> Column:
    """A number as a decimal of ``scale`` digits after the point; one that has more, or is too large, raises instead of being cut."""
    column = F.col(value) if isinstance(value, str) else value
    exact = column.cast(f"decimal(38,{scale})")
    lost = F.raise_error(F.concat(F.lit(f"does not fit {scale} decimals: "), column.cast("string")))
    return F.when(column.isNull() | (exact.cast("double") == column.cast("double")), exact).otherwise(lost.cast(f"decimal(38,{scale})"))


def exact_sum(value: str | Column, scale: int) -> Column:
    """Sum of a number with at most ``scale`` decimals as a double that does not depend on the order of addition.

    For money and the like. A value with more decimals, or a sum beyond 38 digits, raises. Use a plain ``sum`` for measurements.
    """
    return F.sum(_decimal(value, scale)).cast("double")


def exact_avg(value: str | Column, scale: int) -> Column:
    """Average over the non-null values on top of ``exact_sum``."""
    column = F.col(value) if isinstance(value, str) else value
    return F.try_divide(exact_sum(column, scale), F.count(column))


def grouped(df: DataFrame, by: str | Sequence[str], aggregates: Mapping[str, Column], having: str | Column | None = None) -> DataFrame:
    """Aggregate by keys; ``having`` filters the groups."""
    result = df.groupBy(*as_list(by)).agg(*[column.alias(name) for name, column in aggregates.items()])
    return result if having is None else result.where(having)


def distinct_values(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Distinct combinations of some columns; only these are read."""
    return df.select(*as_list(columns)).distinct()


def rows_per_partition(df: DataFrame) -> DataFrame:
    """Rows in each physical partition of ``df`` as it is now."""
    return df.groupBy(F.spark_partition_id().alias("partition_num")).agg(F.count(F.lit(1)).alias("rows"))


def rows_per_key(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows and share of all rows for each key: where a join or grouping on ``key`` would be skewed."""
    counts = df.groupBy(*as_list(key)).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("total")).scalar()
    return counts.withColumn("share", F.col("rows") / total)


def sum_when(value: str, when: Column) -> Column:
    """Sum as a double over the rows that fulfil ``when``; zero if there are none."""
    return F.coalesce(F.sum(F.when(when, F.col(value).cast("double"))), F.lit(0.0))


def observed_sum(df: DataFrame, value: str, when: Column) -> tuple[DataFrame, Observation]:
    """``df`` itself plus an observation whose ``total`` is filled by whatever action runs first; no extra job."""
    observation = Observation()
    return df.observe(observation, sum_when(value, when).alias("total")), observation


def accumulated_sum(df: DataFrame, value: str, when: Column) -> float:
    """The total through a shared counter that the tasks add to, one partial sum per partition.

    Doubles are added in the order in which tasks end, so the last digits may differ from run to run.
    """
    counter = df.sparkSession.sparkContext.accumulator(0.0)

    def add_partition(rows):
        counter.add(sum(row[0] for row in rows))

    df.where(when & F.col(value).isNotNull()).select(F.col(value).cast("double")).foreachPartition(add_partition)
    return counter.value


def word_count(df: DataFrame, text: str) -> DataFrame:
    """Occurrences of each word: lower case, split at everything but letters and digits of any script."""
    words = df.select(F.explode(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+")).alias("word"))
    return words.where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("occurrences"))
