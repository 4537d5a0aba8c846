"""User-defined functions. All of them run on Arrow batches; a built-in expression is faster wherever one exists."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def batch_udf(function: Callable[[pd.Series], pd.Series], return_type: str):
    """A column function from a function on pandas series; the type is always stated, never the default string."""
    def apply(values: pd.Series) -> pd.Series:
        return function(values)

    return F.pandas_udf(apply, return_type)


def register_batch_udf(spark: SparkSession, name: str, function: Callable[[pd.Series], pd.Series], return_type: str):
    """Make a batch function callable by ``name`` in SQL text of this session."""
    return spark.udf.register(name, batch_udf(function, return_type))


def register_sql_function(spark: SparkSession, name: str, parameters: str, returns: str, body: str) -> None:
    """Make an SQL expression callable by ``name`` in this session.

    ``parameters`` are names with types, as in ``"salary DOUBLE"``. A call is replaced by the expression when the query is planned, so it
    runs where built-in functions do, without Python.
    """
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {returns} RETURN {body}")


def shared_lookup_udf(spark: SparkSession, entries: Mapping[object, object], return_type: str = "string"):
    """Look values up in a mapping that is sent to each executor once; a missing or null key gives null.

    Keys travel as text: in a batch with nulls whole numbers would arrive as floats, which cannot hold all 64 bits.
    """
    shared = spark.sparkContext.broadcast({str(key): value for key, value in entries.items()})

    def find(keys: pd.Series) -> pd.Series:
        return keys.map(shared.value).astype(object).where(lambda values: values.notna(), None)

    run = F.pandas_udf(find, return_type)
    return lambda key: run((F.col(key) if isinstance(key, str) else key).cast("string"))


def random_salt_udf(salts: int):
    """A random number in ``[0, salts)`` for each row of the given column.

    Marked as not deterministic: otherwise the optimizer may evaluate it a second time elsewhere in the plan.
    """
    def draw(rows: pd.Series) -> pd.Series:
        return pd.Series(np.random.default_rng().integers(0, salts, len(rows)), dtype="int32")

    return F.pandas_udf(draw, "int").asNondeterministic()


def bonus(salary: pd.Series) -> pd.Series:
    """A fifth of the salary."""
    return salary * 0.2
