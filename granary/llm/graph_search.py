"""Approximate nearest vectors by inner product, on robustly pruned directed graphs, one for each shard."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import blocks_for
from granary.llm.components import stored
from granary.llm.vectors import best_of, finite, matrix

ROWS_PER_SHARD = 4096
QUERIES_PER_BLOCK = 512
DEGREE = 24
BUILD_BEAM = 48
SEARCH_BEAM = 96
RELAXED = 1.2
STARTS = 24
EXPANDED_AT_ONCE = 4
NODES_AT_ONCE = 256


def lifted(vectors: np.ndarray) -> np.ndarray:
    """Vectors with one more component that makes all equally long: the nearest of them has the largest inner product with a query."""
    largest = np.abs(vectors).max(initial=0) or 1.0
    scaled = vectors / largest
    squares = (scaled ** 2).sum(axis=1)
    rest = np.sqrt(np.maximum(squares.max(initial=0) - squares, 0))
    return (np.hstack([scaled, rest[:, None]]) / np.sqrt(squares.max(initial=0) or 1.0)).astype(np.float32)


def beam_search(points: np.ndarray, graph: np.ndarray, starts: np.ndarray, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search of all queries side by side: the best ``width`` nodes found (-1 where fewer), and all nodes that were expanded.

    ``graph`` has one row more than ``points``, of -1, so that a missing node has no neighbours.
    """
    count, rows = len(queries), np.arange(len(queries))[:, None]
    seen = np.zeros((count, len(points) + 1), dtype=bool)
    seen[:, -1] = True
    width = max(width, len(starts))
    ids = np.full((count, width), -1)
    scores = np.full((count, width), -np.inf, dtype=np.float32)
    ids[:, :len(starts)] = starts
    scores[:, :len(starts)] = queries @ points[starts].T
    order = np.argsort(-scores, axis=1, kind="stable")
    ids, scores = np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)
    seen[:, starts] = True
    done = ids < 0
    history = []
    step = min(EXPANDED_AT_ONCE, width)
    while not done.all():
        turn = np.where(done, width, np.arange(width))
        picked = np.argpartition(turn, step - 1, axis=1)[:, :step]
        nodes = np.where(np.take_along_axis(done, picked, 1), -1, np.take_along_axis(ids, picked, 1))
        np.put_along_axis(done, picked, True, 1)
        history.append(nodes)
        near = np.sort(graph[nodes].reshape(count, -1), axis=1)
        fresh = ~seen[rows, near]
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        which, place = np.nonzero(fresh)
        found = near[which, place]
        seen[which, found] = True
        gained = np.full(near.shape, -np.inf, dtype=np.float32)
        gained[which, place] = np.einsum("ij,ij->i", points[found], queries[which])
        all_scores = np.hstack([scores, gained])
        order = np.argsort(-all_scores, axis=1, kind="stable")[:, :width]
        scores = np.take_along_axis(all_scores, order, 1)
        ids = np.where(np.isinf(scores), -1, np.take_along_axis(np.hstack([ids, near]), order, 1))
        done = np.take_along_axis(np.hstack([done, np.zeros_like(fresh)]), order, 1) | (ids < 0)
    return ids, np.hstack(history) if history else np.zeros((count, 0), dtype=int)


def robust_prune(points: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, relaxed: float, degree: int) -> np.ndarray:
    """For each node at most ``degree`` of its candidates (-1: none), nearest first and in different directions.

    A candidate goes if it is nearer, by the factor ``relaxed``, to one already kept than to the node itself.
    """
    vectors = points[candidates]
    scores = np.matmul(vectors, points[nodes][:, :, None])[:, :, 0]
    alive = (candidates >= 0) & (candidates != nodes[:, None])
    order = np.argsort(np.where(alive, -scores, np.inf), axis=1, kind="stable")
    candidates, scores, alive = (np.take_along_axis(values, order, 1) for values in (candidates, scores, alive))
    vectors = np.take_along_axis(vectors, order[:, :, None], 1)
    rows, kept = np.arange(len(nodes)), np.full((len(nodes), degree), -1)
    for place in range(degree):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        kept[some, place] = candidates[rows, first][some]
        alive[rows, first] = False
        between = np.matmul(vectors, vectors[rows, first][:, :, None])[:, :, 0]
        # on vectors of equal length the squared distance is 2 - 2 * product
        alive &= ~((relaxed ** 2 * (1 - between) <= 1 - scores) & some[:, None])
    return kept


def build_graph(points: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """A directed graph over the points and the nodes where searches start.

    From a random graph, each node searches for itself; what it meets and its neighbours are pruned to its new edges, and each of
    these gets the edge back, pruned again where a node has too many. The second round relaxes the pruning, for longer edges.
    """
    n = len(points)
    draw = np.random.default_rng(seed)
    degree = min(DEGREE, max(n - 1, 1))
    graph = np.full((n + 1, degree), -1)
    if n > 1:
        graph[:n] = (np.arange(n)[:, None] + draw.integers(1, n, (n, degree))) % n
    centre = int((points @ points.mean(axis=0)).argmax()) if n else 0
    starts = np.unique(np.concatenate([[centre], draw.permutation(n)[:STARTS]])) if n else np.zeros(0, dtype=int)
    for relaxed in (1.0, RELAXED):
        if n < 2:
            break
        turns = draw.permutation(n)
        for at in range(0, n, NODES_AT_ONCE):
            nodes = turns[at:at + NODES_AT_ONCE]
            found, met = beam_search(points, graph, starts, points[nodes], min(BUILD_BEAM, n))
            graph[nodes] = robust_prune(points, nodes, np.hstack([found, met, graph[nodes]]), relaxed, degree)
            _add_reverse(points, graph, nodes, relaxed, degree)
    return graph, starts


def _add_reverse(points: np.ndarray, graph: np.ndarray, nodes: np.ndarray, relaxed: float, degree: int) -> None:
    targets = graph[nodes].ravel()
    sources = np.repeat(nodes, degree)[targets >= 0]
    targets = targets[targets >= 0]
    order = np.argsort(targets, kind="stable")
    targets, sources = targets[order], sources[order]
    changed, first, counts = np.unique(targets, return_index=True, return_counts=True)
    added = np.full((len(changed), counts.max(initial=1)), -1)
    place = np.arange(len(targets)) - np.repeat(first, counts)
    added[np.repeat(np.arange(len(changed)), counts), place] = sources
    added[(added[:, :, None] == graph[changed][:, None, :]).any(axis=2)] = -1
    both = np.hstack([graph[changed], added])
    room = (both >= 0).sum(axis=1) <= degree
    packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, :degree]
    graph[changed[room]] = packed[room]
    if not room.all():
        graph[changed[~room]] = robust_prune(points, changed[~room], both[~room], relaxed, degree)


class GraphShard:
    """Different vectors of a shard with the ids that share each, and their graph."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.vectors, member = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, member.ravel()))
        self.ids = ids[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(member.ravel(), minlength=len(self.vectors)))]).astype(np.int64)

    def build(self) -> bytes:
        self.points = lifted(self.vectors)
        self.graph, self.starts = build_graph(self.points)
        return self.graph.astype(np.int32).tobytes()

    def restore(self, graph: bytes, starts: bytes) -> None:
        self.points = lifted(self.vectors)
        self.graph = np.frombuffer(graph, dtype=np.int32).reshape(len(self.vectors) + 1, -1).astype(np.int64)
        self.starts = np.frombuffer(starts, dtype=np.int64)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query ids and exact products of the ``k`` nearest found, without the query's own id."""
        scaled = queries / np.maximum(np.abs(queries).max(axis=1, keepdims=True), np.finfo(np.float64).tiny)
        lifted_queries = np.hstack([scaled, np.zeros((len(queries), 1))]).astype(np.float32)
        found, _ = beam_search(self.points, self.graph, self.starts, lifted_queries, min(max(width, 2 * k), len(self.vectors)))
        result = []
        for query, mine, nodes in zip(queries, own, found):
            nodes = nodes[nodes >= 0]
            exact = self.vectors[nodes] @ query
            counts = self.first[nodes + 1] - self.first[nodes]
            rows = np.repeat(self.first[nodes] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            ids, scores = self.ids[rows], np.repeat(exact, counts)
            ids, scores = ids[ids != mine], scores[ids != mine]
            best = np.lexsort((ids, -scores))[:k]
            result.append((ids[best], scores[best]))
        return result


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding", vec_id: str = "vec_id",
            rows_per_shard: int = ROWS_PER_SHARD, width: int = SEARCH_BEAM) -> DataFrame:
    """For each query row the ``k`` rows with the largest inner product that are found: query_id, rank, vec_id, score.

    Rows are dealt to shards by a hash of the vector; each shard of bounded size gets a graph, and every block of queries searches
    every shard with a beam of ``width``. Scores are inner products of the original vectors in double precision; ties go to smaller
    ids. All rows are indexed: rows with equal vectors are one node, of which the first ``k + 1`` different ids are kept, each with
    ``k`` rows at most, as no further one can be among a query's best, whoever asks.

    Vectors that are null, empty, zero or hold a null or a value that is not finite take no part, nor do rows without an id. Rows with
    the id of the query are the query's own. Repeated rows count each. Vectors of another length than the query's are not compared
    with it. With fewer than ``k`` candidates all that are found are returned; an empty table returns nothing.
    """
    v = F.col(f"`{vector}`")
    valid = vectors.where(finite(v) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)) & F.col(f"`{vec_id}`").isNotNull())
    rows = valid.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.transform(v, lambda x: x.cast("double")).alias("v"), is_query.alias("q"))
    rows = rows.withColumns({"dim": F.size("v"), "spread": F.xxhash64("v")})
    same = rows.groupBy("vec_id", "v", "dim", "spread").agg(F.count(F.lit(1)).alias("rows"))
    first = Window.partitionBy("dim", "spread", "v").orderBy("vec_id")
    kept = same.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    copies = F.sequence(F.lit(1), F.least(F.col("rows"), F.lit(k)).cast("int"))
    nodes = kept.select("vec_id", "v", "dim", "spread", F.explode(copies).alias("n"))
    counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("q").alias("queries")).head()
    shards, query_blocks = blocks_for(counts["rows"], rows_per_shard), blocks_for(counts["queries"], QUERIES_PER_BLOCK)

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ids, values = rows["vec_id"].to_numpy(), matrix(rows["v"])
        shard = GraphShard(ids, values)
        graph = shard.build()
        return pd.DataFrame({"shard": [key[0]], "dim": [key[1]], "ids": [ids.tobytes()], "vectors": [values.tobytes()],
                             "graph": [graph], "starts": [shard.starts.astype(np.int64).tobytes()]})

    def search(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"query_id": [], "query_row": [], "vec_id": []}, dtype="int64").assign(score=np.zeros(0))]
        for one in index.itertuples() if len(queries) else ():
            ids = np.frombuffer(one.ids, dtype=np.int64)
            shard = GraphShard(ids, np.frombuffer(one.vectors, dtype=np.float64).reshape(len(ids), -1))
            shard.restore(one.graph, one.starts)
            own = queries["vec_id"].to_numpy()
            for query, row, (best, scores) in zip(own, queries["key"], shard.search(matrix(queries["v"]), own, k, width)):
                found.append(pd.DataFrame({"query_id": query, "query_row": row, "vec_id": best, "score": scores}))
        return pd.concat(found)

    index = nodes.withColumn("shard", F.pmod("spread", F.lit(shards)).cast("int")).groupBy("shard", "dim").applyInPandas(
        build, "shard int, dim int, ids binary, vectors binary, graph binary, starts binary")
    index = stored(index, "graphs").withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    asked = rows.where("q").select("vec_id", "v", "dim", F.xxhash64("vec_id", "v", F.spark_partition_id(), F.monotonically_increasing_id()).alias("key"))
    asked = asked.withColumn("qb", F.pmod(F.xxhash64("key"), F.lit(query_blocks)).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    met = index.groupBy("shard", "qb", "dim").cogroup(asked.groupBy("shard", "qb", "dim")).applyInPandas(
        search, "query_id bigint, query_row bigint, vec_id bigint, score double")
    return best_of(met, k)
