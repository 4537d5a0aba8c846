"""Documents spread over shards by descending a weighted tree of regions, racks and shards."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import others
from granary.llm.components import stored

OVERHEAD_BYTES = 16
# As many bits of a hash as a double holds exactly, half a step included.
DRAW_DIGITS = 13
LAW = "key"
MADE = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


@dataclass(frozen=True)
class Node:
    """A part of the tree: a shard with its number and weight, or a rack or region with parts and the sum of their weights.

    A label keeps its meaning for good: draws depend on the label and the document alone.
    """

    label: str
    weight: float
    shard: int = -1
    parts: tuple[Node, ...] = ()

    def shards(self) -> list[int]:
        return [shard for part in self.parts for shard in part.shards()] if self.parts else [self.shard]


def group(label: str, parts: Sequence[Node]) -> Node:
    """A rack of shards, a region of racks or the root of regions."""
    if not parts or any(not part.weight > 0 for part in parts):
        raise ValueError(f"{label!r} needs parts, all of a weight above zero")
    return Node(label, float(sum(part.weight for part in parts)), parts=tuple(parts))


def even_tree(shards: int, regions: int, racks: int) -> Node:
    """``shards`` of weight 1, numbered from 0, dealt over ``regions`` with ``racks`` each."""
    cells: dict[tuple[int, int], list[Node]] = {}
    for number in range(shards):
        rack = number * regions * racks // shards
        cells.setdefault((rack // racks, rack % racks), []).append(Node(f"shard {number}", 1.0, number))
    places: dict[int, list[Node]] = {}
    for (region, rack), members in cells.items():
        places.setdefault(region, []).append(group(f"rack {region}.{rack}", members))
    return group("root", [group(f"region {region}", members) for region, members in places.items()])


def grown(tree: Node, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region and rack of its own: no subtree that was there changes its weight."""
    number = max(tree.shards()) + 1
    shard = Node(f"shard {number}", float(weight), number)
    return group(tree.label, [*tree.parts, group(f"region of {number}", [group(f"rack of {number}", [shard])])])


def _literal(node: Node) -> Column:
    """The parts of a node as an array; the shard number of a group stands for its place among its siblings."""
    rows = []
    for place, part in enumerate(node.parts):
        fields = [F.lit(part.label).alias("label"), F.lit(part.weight).alias("weight"), F.lit(part.shard if not part.parts else place).alias("number")]
        rows.append(F.struct(*fields, *([_literal(part).alias("parts")] if part.parts else [])))
    return F.array(*rows)


def _drawn(parts: Column, key: Column) -> Column:
    """The part whose exponential draw, of a rate that is its weight, comes first; the least number of equal ones.

    A part of a greater weight draws earlier and the others as before, so it only gains rows, and a part of a lesser weight only
    loses some: what siblings hold among themselves stays where it is.
    """
    def draw(part: Column) -> Column:
        bits = F.conv(F.substring(F.md5(F.concat(key, F.lit("\n"), part["label"]).cast("binary")), 1, DRAW_DIGITS), 16, 10).cast("double")
        return F.struct((-F.ln((bits + 0.5) / float(16**DRAW_DIGITS)) / part["weight"]).alias("draw"), part["number"].alias("number"), part.alias("part"))

    return F.array_min(F.transform(parts, draw))["part"]


def shard_of(doc_id: Column, tree: Node) -> Column:
    """The shard of a document: a region, then a rack there, then a shard there, each by a draw. A null id counts as empty text."""
    levels, node = 0, tree
    while node.parts:
        levels, node = levels + 1, node.parts[0]
    key = F.coalesce(doc_id.cast("string"), F.lit(""))
    parts = _literal(tree)
    for level in range(levels):
        part = _drawn(parts, key)
        parts = part["parts"] if level < levels - 1 else parts
    return part["number"]


def place_documents(docs: DataFrame, tree: Node, text: str = "text", doc_id: str = "doc_id", following: Node | None = None) -> DataFrame:
    """Where each document goes: its columns but the text, with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    ``shard`` follows from the id and ``tree``, ``grown_shard`` from the id and ``following`` (the tree with one more shard unless
    given). A change of weights moves rows only into or out of the subtrees whose weights change; with a shard in a region of its own
    rows move to that shard alone. ``slot`` counts the rows of a shard from 0 without a gap, by id (null first), then crc32, then size;
    equal rows get slots in any order. ``size`` is the UTF-8 bytes of the text and 16; a null text has none and the crc32 of nothing.
    Rows that repeat an id share its shard. An empty table stays empty. Columns named like an added one give way, names that begin with
    ``_shard`` are refused.

    Rows without their texts are sorted once by shard and id, range by range, and cut anywhere, so no task holds a whole shard; the slots
    of a range begin where earlier ranges end. Those beginnings are one row for each range and shard in it, at most the number of
    ranges and shards together, and so are broadcast.
    """
    clashing = [name for name in docs.columns if name.lower().startswith("_shard")]
    if clashing:
        raise ValueError(f"rename the columns {clashing}: names that begin with _shard are used inside")
    if len(set(tree.shards())) < len(tree.shards()):
        raise ValueError("a shard stands twice in the tree")
    ident, content = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    kept = others(docs, (*MADE, text))
    placed = docs.select(
        *kept, F.coalesce(F.octet_length(content) + OVERHEAD_BYTES, F.lit(OVERHEAD_BYTES)).cast("bigint").alias("size"),
        F.crc32(F.coalesce(content, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit(LAW).alias("law"), shard_of(ident, tree).alias("shard"), shard_of(ident, following or grown(tree)).alias("grown_shard"))
    # stored, as a sort reads its input twice: once for the bounds of its ranges
    placed = stored(placed, "placed").withColumn("_shard_row", F.monotonically_increasing_id())
    ordered = placed.orderBy("shard", ident, "text_crc32", "size", "_shard_row").drop("_shard_row")
    place = F.monotonically_increasing_id()
    ordered = ordered.withColumns({"_shard_range": F.shiftright(place, 33), "_shard_place": place.bitwiseAND(F.lit(2**33 - 1))})
    ordered = stored(ordered, "sharded")
    ranges = ordered.groupBy(F.col("shard").alias("_shard_of"), F.col("_shard_range").alias("_shard_in")).agg(
        F.min("_shard_place").alias("_shard_first"), F.count(F.lit(1)).alias("_shard_rows"))
    # one row for each range, kept short by the number of ranges, so one task may add them up
    earlier = F.sum("_shard_rows").over(Window.partitionBy("_shard_of").orderBy("_shard_in").rowsBetween(Window.unboundedPreceding, -1))
    begins = ranges.withColumn("_shard_begin", F.coalesce(earlier, F.lit(0)) - F.col("_shard_first")).drop("_shard_first", "_shard_rows")
    on = (F.col("shard") == F.col("_shard_of")) & (F.col("_shard_range") == F.col("_shard_in"))
    joined = ordered.join(F.broadcast(begins), on)
    return joined.select(*kept, "size", "text_crc32", "law", "shard", (F.col("_shard_place") + F.col("_shard_begin")).alias("slot"), "grown_shard")
