"""Lines that several documents share stay in the first of these documents only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import hash128, others
from granary.llm.components import stored

STRIPPED = "".join(map(chr, [0x20, *range(0x09, 0x0E)]))
UPPER = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
LOWER = UPPER.lower()
MADE = ("text", "n_lines", "n_dropped")


def line_key(line: Column) -> Column:
    """A line without white space of the ASCII range at its ends and with A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(STRIPPED)), UPPER, LOWER)


def drop_repeated_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = 10) -> DataFrame:
    """Drop every line whose key is in at least two documents, except in the document with the smallest id.

    Keys shorter than ``min_chars`` code points stay everywhere. A document is what carries one id: rows that repeat an id count as
    one document, and a line inside one document may repeat. A null id is one further document, greater than all others. A null text
    is one empty line and gives an empty text; so does a text that loses all lines. ``text`` is replaced, ``n_lines`` (before) and
    ``n_dropped`` are added; other columns stay, and a column already named like an added one gives way to it. No row is lost.

    Only hashes travel to find the repeated keys, pre-aggregated to one row per key and task. Each dropped line then sends its
    position to its document. The join of occurrences with repeated keys is an inner one, so adaptive execution may cut the rows of
    a line that a large part of all documents holds.
    """
    place = hash128(F.col("_id"), F.col("_text"))
    whole = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    lines = whole.select("_id", place[0].alias("_row1"), place[1].alias("_row2"), F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_line"))
    keyed = lines.withColumn("_key", line_key(F.col("_line"))).where(F.char_length("_key") >= min_chars)
    first, second = hash128(F.col("_key"))
    held = keyed.select("_id", "_row1", "_row2", "_pos", first.alias("_h1"), second.alias("_h2"))
    spread = held.groupBy("_h1", "_h2").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"), F.max(F.col("_id").isNull()).alias("_null"))
    repeated = spread.where((F.col("_first") < F.col("_last")) | (F.col("_null") & F.col("_first").isNotNull()))
    # a table of its own, or the join would take over the aggregate's partitions, and those of a line that many hold cannot be cut
    repeated = stored(repeated.select("_h1", "_h2", "_first"), "repeated-lines")
    gone = held.join(repeated, ["_h1", "_h2"]).where(~F.col("_id").eqNullSafe(F.col("_first")))
    positions = gone.groupBy("_row1", "_row2").agg(F.collect_set("_pos").alias("_gone"))

    rows = docs.withColumns({"_line_id": F.col(f"`{doc_id}`"), "_line_text": F.coalesce(F.col(f"`{text}`"), F.lit(""))})
    place = hash128(F.col("_line_id"), F.col("_line_text"))
    rows = rows.withColumns({"_line_row1": place[0], "_line_row2": place[1]})
    on = (F.col("_line_row1") == F.col("_row1")) & (F.col("_line_row2") == F.col("_row2"))
    joined = rows.join(positions, on, "left_outer")
    split = F.split("_line_text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("_gone"))
    shorter = F.array_join(F.transform(kept, lambda i: F.get(F.col("_line_list"), i)), "\n")
    made = joined.withColumn("_line_list", split).select(
        *others(docs, (text, "n_lines", "n_dropped")),
        F.when(F.col("_gone").isNull(), F.col("_line_text")).otherwise(shorter).alias(text),
        F.size("_line_list").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint").alias("n_dropped"))
    return made
