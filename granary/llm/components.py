"""Connected components of a link table, with lineage cut by tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a fresh folder below ``spark.checkpoint.dir`` and read back: computed once, kept whoever is lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(links: DataFrame) -> DataFrame:
    """The smallest node of the component of each node of ``links`` (columns a and b): node, root. Nodes without a link are absent.

    Large star and small star in turn: every node hangs its greater neighbours, then its lesser ones and itself, on the least node
    it knows. Links stay at most as many as there were and the depth falls geometrically. Minima are pre-aggregated, and the rows of
    a hub are one side of an inner join, which adaptive execution may cut. Only a count comes to the driver.
    """
    edges = stored(_falling(links), "links")
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("near")).select("a", F.least("a", "near").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(_falling(large), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        following = stored(_falling(small.unionAll(least.select("a", F.col("m").alias("b")))), "links")
        if following.count() == edges.count() and following.join(edges, ["a", "b"], "left_anti").isEmpty():
            break
        edges = following
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())


def _falling(links: DataFrame) -> DataFrame:
    """Each link once, from the greater to the lesser node."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
