"""Per-group maximum and n-th row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.operators.skew import PIECE, as_list, default_pieces, salted_join, spread


def group_max(df: DataFrame, by: str | Sequence[str], value: str, name: str) -> DataFrame:
    """Every row with the greatest ``value`` of its group in column ``name``; null keys form one group.

    A window would bring all rows of a group into one task. Here the maximum is aggregated, within the map tasks first, and joined
    back with heavy groups spread.
    """
    keys = as_list(by)
    top = df.groupBy(*keys).agg(F.max(value).alias(name))
    joined = salted_join(df, top, keys, null_safe=True)
    return joined.select(*df.columns, name)


def nth_per_group(df: DataFrame, by: str | Sequence[str], order: Sequence[Column], n: int, tiebreak: str | Sequence[str],
                  name: str = "rn") -> DataFrame:
    """The ``n``-th row of each group in ``order``; ``tiebreak`` (unique within a group) makes the answer definite.

    The filter on the row number lets each map task drop all but its first ``n`` rows per group before the shuffle, as long as ``n``
    is at most ``spark.sql.optimizer.windowGroupLimitThreshold``. For a greater ``n`` the groups are first cut into pieces by a hash
    of the row and each piece is limited by itself, so no task gets a heavy group whole before it is down to ``n`` rows a piece.
    """
    keys = as_list(by)
    sort = [*order, *[F.col(column) for column in as_list(tiebreak)]]
    session = df.sparkSession
    if n > int(session.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        pieced = df.withColumn(PIECE, spread(default_pieces(df), as_list(tiebreak)))
        first = F.row_number().over(Window.partitionBy(*keys, PIECE).orderBy(*sort))
        df = pieced.withColumn("_place", first).where(F.col("_place") <= n).drop(PIECE, "_place")
    ordered = Window.partitionBy(*keys).orderBy(*sort)
    return df.withColumn(name, F.row_number().over(ordered)).where(F.col(name) == n)
