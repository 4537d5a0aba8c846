"""SQL text over frames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from granary.operators.sizing import proven_small
from granary.session import profile_session


def view_session(spark: SparkSession) -> SparkSession:
    """A sibling session whose temporary views cannot clash with the caller's."""
    return profile_session(spark, {})


def sql_over(text: str, args: Mapping[str, object] | None = None, **frames: DataFrame) -> DataFrame:
    """Run SQL that names the given frames in braces; ``args`` bind ``:name`` markers as literals, never as text."""
    session = next(iter(frames.values())).sparkSession
    return session.sql(text, args=dict(args) if args else None, **frames)


def broadcast_hint(df: DataFrame, alias: str) -> str:
    """A broadcast hint for SQL text if ``df`` is proven small, else nothing, so the planner decides."""
    return f"/*+ BROADCAST({alias}) */" if proven_small(df) else ""
