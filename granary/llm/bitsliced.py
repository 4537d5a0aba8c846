"""Exact nearest rows by inner product of quantised vectors, on bit-sliced blocks of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import blocks_for
from granary.llm.vectors import best_of, finite

ROWS_PER_BLOCK = 65_536
QUERIES_PER_BLOCK = 256
LARGEST = 1 << 26
#: Numbers of 64 bits that the rows of one block, or the queries of one lane and what they find, may hold: 32 MiB.
NUMBERS = 1 << 22
#: Meetings of a block with a lane for each core, so that none is much busier than the others.
MEETINGS_PER_CORE = 8


class SlicedBlock:
    """The components of a block of rows as bit slices: slice ``b`` of a component holds bit ``b`` of every row.

    Components are shifted by their least value, so slices are unsigned; the shift is a constant for each query. The complement
    of a component serves negative weights.
    """

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        low, top = values.min(axis=0).astype(np.int64), values.max(axis=0).astype(np.int64)
        bits = [int(span).bit_length() for span in top - low]
        slices = np.zeros((sum(bits), -(-len(ids) // 64)), dtype=np.uint64)
        first = 0
        for d, n in enumerate(bits):
            # one component at a time, so that little is held beside the values
            unsigned = (values[order, d].astype(np.int64) - low[d]).astype(np.uint64)
            for b in range(n):
                slices[first + b] = self._packed(unsigned >> np.uint64(b) & np.uint64(1))
            first += n
        self._set(ids[order], low, np.array(bits, dtype=np.uint8), slices)

    @classmethod
    def restored(cls, ids: bytes, low: bytes, bits: bytes, slices: bytes) -> SlicedBlock:
        """The block whose ``parts`` are given."""
        block = cls.__new__(cls)
        sizes = np.frombuffer(bits, dtype=np.uint8)
        planes = np.frombuffer(slices, dtype=np.uint64).reshape(int(sizes.sum()), -(-len(ids) // 512))
        block._set(np.frombuffer(ids, dtype=np.int64), np.frombuffer(low, dtype=np.int64), sizes, planes)
        return block

    def _set(self, ids: np.ndarray, low: np.ndarray, bits: np.ndarray, slices: np.ndarray) -> None:
        self.ids, self.low, self.slices = ids, low, slices
        self.rows, self.width = len(ids), len(low)
        self.bits = bits.tolist()
        self.first = np.concatenate([[0], np.cumsum(self.bits)]).astype(int)
        self.every = self._packed(np.ones(self.rows, dtype=np.uint8))
        # the complements stand behind the slices
        self.turned = np.concatenate([slices, ~slices])

    def parts(self) -> tuple[bytes, bytes, bytes, bytes]:
        """What makes up the index: ids in their order, least values, bits of each component and the slices."""
        return self.ids.tobytes(), self.low.tobytes(), bytes(self.bits), self.slices.tobytes()

    @staticmethod
    def _packed(flags: np.ndarray) -> np.ndarray:
        words = np.zeros(-(-len(flags) // 64) * 8, dtype=np.uint8)
        packed = np.packbits(flags.astype(np.uint8), bitorder="little")
        words[:len(packed)] = packed
        return words.view(np.uint64)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the inner product with ``query``, least significant first, and a constant to be added."""
        size, less, bits = np.abs(query), query < 0, np.array(self.bits, dtype=np.int64)
        constant = int((query * self.low).sum()) - int((size[less] * ((1 << bits[less]) - 1)).sum())
        start = self.first[:-1] + less * len(self.slices)
        planes: dict[int, list[np.ndarray]] = {}
        for t in range(int(size.max()).bit_length()):
            weighted = size >> t & 1 == 1
            for b in range(max(self.bits)):
                if len(wanted := start[weighted & (bits > b)]):
                    planes.setdefault(t + b, []).append(wanted + b)
        own = [np.concatenate(planes[level]) if level in planes else np.zeros(0, dtype=np.int64) for level in range(max(planes, default=-1) + 1)]
        result, rows = [], np.take(self.turned, own[0] if own else [], axis=0)
        while len(result) < len(own) or len(rows):
            above = own[len(result) + 1] if len(result) + 1 < len(own) else own[0][:0]
            following, made = np.empty((len(rows) // 2 + len(above), len(self.every)), dtype=np.uint64), 0
            spare = np.empty((len(rows) // 3, len(self.every)), dtype=np.uint64)
            while len(rows) > 1:
                # full adders on three slices at a time, in place; what is left over waits for the next turn
                thirds = len(rows) // 3 or 1
                a, b, c = rows[:thirds], rows[thirds:2 * thirds], rows[2 * thirds:3 * thirds]
                carry = np.bitwise_and(a, b, out=following[made:made + thirds])
                if len(c):
                    either = np.bitwise_xor(a, b, out=spare[:thirds])
                    carry |= np.bitwise_and(either, c, out=a)
                    c ^= either
                    rows = rows[2 * thirds:]
                else:
                    b ^= a
                    rows = rows[thirds:]
                made += thirds
            result.append(rows[0].copy() if len(rows) else np.zeros(len(self.every), dtype=np.uint64))
            np.take(self.turned, above, axis=0, out=following[made:made + len(above)], mode="clip")
            rows = following[:made + len(above)]
        return result, constant

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows whose id is not ``own``; ties go to smaller ids."""
        slices, constant = self.scores(query)
        ties = self.every.copy()
        for row in range(np.searchsorted(self.ids, own, "left"), np.searchsorted(self.ids, own, "right")):
            ties[row >> 6] &= ~np.uint64(1 << (row & 63))
        sure = np.zeros_like(ties)
        for plane in reversed(slices):
            high = ties & plane
            n = int(np.bitwise_count(sure).sum() + np.bitwise_count(high).sum())
            if n > k:
                ties = high
            else:
                sure, ties = sure | high, ties & ~plane
                if n == k:
                    break
        rows = self._rows(sure)
        # rows are in the order of their ids, so the first of the boundary are those that win the ties
        rows = np.concatenate([rows, self._rows(ties)[:k - len(rows)]])
        scores = np.full(len(rows), constant, dtype=np.int64)
        for weight, plane in enumerate(slices):
            scores += (plane[rows >> 6] >> (rows & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64) << weight
        return self.ids[rows], scores

    def _rows(self, words: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little")[:self.rows])


def quantised(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def vectors_of(column: pa.Array, width: int) -> np.ndarray:
    """A list column of whole numbers, all of one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, vector: str = "embedding", vec_id: str = "vec_id",
                rows_per_block: int = ROWS_PER_BLOCK, queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """For each query row the ``k`` rows with the highest integer inner product of ``floor(scale * x)``: query_id, rank, vec_id, score.

    Rows are cut into blocks by a hash of their row, each block becomes a bit-sliced index of bounded size, and every block of
    queries meets every block of rows. A query's score slices are sums of component slices, added with bitmap arithmetic; the best
    rows are picked from the most significant slice downward, and rows equal in all slices by smaller ``vec_id``.

    Of the rows only the slices travel, once for each lane of queries. A lane holds many blocks of queries: as few lanes as keep all
    cores busy, and as many as keep a lane and what it finds small. Copies of an index are made one after another, where it is built,
    so a task never holds more than one. Long vectors get smaller blocks and lanes.

    Vectors that are null, empty or hold a null or a value that is not finite take no part, nor do rows without an id. Rows with the
    id of the query are the query's own. A repeated row counts as often as it is there, as a candidate and as a query. Vectors of
    another length than the query's are not compared with it. With fewer than ``k`` candidates all are returned; an empty table
    returns nothing. Components of ``2**26`` or more after scaling are refused.
    """
    valid = vectors.where(finite(F.col(f"`{vector}`")) & F.col(f"`{vec_id}`").isNotNull())
    rows = valid.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), quantised(F.col(f"`{vector}`"), scale).alias("v"), is_query.alias("q"))
    rows = rows.withColumns({"dim": F.size("v"), "key": F.xxhash64("vec_id", "v", F.spark_partition_id())})
    counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("q").alias("queries"), F.max("dim").alias("dim")).head()
    longest = counts["dim"] or 1
    most_rows = max(1, min(rows_per_block, NUMBERS // longest))
    row_blocks = blocks_for(counts["rows"], most_rows)
    meetings = MEETINGS_PER_CORE * vectors.sparkSession.sparkContext.defaultParallelism
    # four numbers for each row found, and as much again while they are put together
    lanes = max(blocks_for(counts["queries"], max(1, NUMBERS // max(longest, 8 * min(k, most_rows)))),
                min(blocks_for(counts["queries"], queries_per_block), blocks_for(meetings, row_blocks)))

    def index(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rb, width = key[0].as_py(), key[1].as_py()
        ids, values = [], []

        def copies() -> Iterator[pa.RecordBatch]:
            parts = SlicedBlock(np.concatenate(ids), np.concatenate(values)).parts()
            ids.clear()
            values.clear()
            for lane in range(lanes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rb], pa.int32()), pa.array([lane], pa.int32()), pa.array([width], pa.int32()), *(pa.array([part], pa.binary()) for part in parts)],
                    names=["rb", "lane", "dim", "ids", "low", "bits", "slices"])

        for batch in batches:
            block = vectors_of(batch.column("v"), width)
            if len(block) and (block.max() >= LARGEST or block.min() <= -LARGEST):
                raise ValueError("a component is too large for exact 64-bit scores")
            ids.append(batch.column("vec_id").to_numpy())
            values.append(block.astype(np.int32))
            # only many equal rows make a block this large
            if sum(map(len, ids)) >= 2 * most_rows:
                yield from copies()
        if ids:
            yield from copies()

    def search(one: pa.Table, queries: pa.Table) -> pa.Table:
        asked, rows_asked, best, scores = [], [], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for at in range(one.num_rows if queries.num_rows else 0):
            block = SlicedBlock.restored(*(one.column(name)[at].as_py() for name in ("ids", "low", "bits", "slices")))
            for batch in queries.to_batches(max_chunksize=queries_per_block):
                for query, row, values in zip(batch.column("vec_id").to_pylist(), batch.column("key").to_pylist(), vectors_of(batch.column("v"), block.width)):
                    found = block.top(values, query, k)
                    best.append(found[0])
                    scores.append(found[1])
                    asked.append(query)
                    rows_asked.append(row)
        counted = [len(found) for found in best[1:]]
        return pa.table({"query_id": np.repeat(np.array(asked, dtype=np.int64), counted), "query_row": np.repeat(np.array(rows_asked, dtype=np.int64), counted),
                         "vec_id": np.concatenate(best), "score": np.concatenate(scores)})

    dealt = rows.select("vec_id", "v", "dim", F.pmod("key", F.lit(row_blocks)).cast("int").alias("rb"))
    blocks = dealt.groupBy("rb", "dim").applyInArrow(index, "rb int, lane int, dim int, ids binary, low binary, bits binary, slices binary")
    # a repeated query row is asked for itself
    asked = rows.where("q").select("vec_id", "v", "dim", F.xxhash64("key", F.monotonically_increasing_id()).alias("key"))
    asked = asked.withColumn("lane", F.pmod(F.xxhash64("key"), F.lit(lanes)).cast("int"))
    asked = asked.withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    met = blocks.groupBy("rb", "lane", "dim").cogroup(asked.groupBy("rb", "lane", "dim")).applyInArrow(
        search, "query_id bigint, query_row bigint, vec_id bigint, score bigint")
    return best_of(met, k)
