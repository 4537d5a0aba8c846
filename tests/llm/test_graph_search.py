import numpy as np
from pyspark.sql import functions as F

from granary.llm.graph_search import nearest
from granary.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>"


def brute(ids, vectors, k, is_query):
    result = {}
    for row in np.flatnonzero(is_query(ids)):
        scores = vectors @ vectors[row]
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != ids[row]][:k]
        result[int(ids[row])] = [(int(ids[i]), float(scores[i])) for i in order]
    return result


def by_query(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    return found


def recall(found, expected):
    return sum(len({i for i, _ in found[q]} & {i for i, _ in best}) for q, best in expected.items()) / sum(map(len, expected.values()))


def test_recall_and_exact_scores_of_the_query(spark, data):
    table = spark.read.parquet(f"{data}/embeddings.parquet").toPandas()
    ids, vectors = table["vec_id"].to_numpy(), np.array(table["embedding"].tolist(), dtype=np.float64)
    found = by_query(QUERIES["op5_graph_search"](spark, data).collect())
    expected = brute(ids, vectors, 20, lambda i: i % 20 == 0)
    assert found.keys() == expected.keys() and all(len(best) == 20 for best in found.values())
    assert recall(found, expected) >= 0.9
    place = {int(i): row for row, i in enumerate(ids)}
    for q, best in found.items():
        assert np.allclose([score for _, score in best], [vectors[place[i]] @ vectors[place[q]] for i, _ in best], rtol=0, atol=1e-15)


def test_recall_over_several_shards_of_unequal_lengths(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(0, 1, (20, 16))
    vectors = (centres[draw.integers(0, 20, 3000)] + draw.normal(0, 0.6, (3000, 16))) * draw.uniform(0.2, 3, (3000, 1))
    ids = np.arange(3000)
    docs = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], SCHEMA)
    found = by_query(nearest(docs, F.col("vec_id") % 20 == 0, k=10, rows_per_shard=800).collect())
    assert recall(found, brute(ids, vectors, 10, lambda i: i % 20 == 0)) >= 0.9


def test_bad_vectors_ties_and_few_candidates(spark):
    rows = [(i, [1.0, 0.0]) for i in range(1, 40)] + [(40, [0.0, 1.0]), (41, None), (42, []), (43, [0.0, 0.0]), (44, [1.0, None]),
            (45, [float("nan"), 1.0]), (46, [float("inf"), 1.0]), (None, [1.0, 1.0]), (60, [1.0, 2.0, 3.0])]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).repartition(3)
    found = by_query(nearest(docs, F.col("vec_id") % 20 == 0, k=5).collect())
    assert found == {20: [(i, 1.0) for i in range(1, 6)], 40: [(i, 0.0) for i in range(1, 6)]}
    few = spark.createDataFrame([(20, [1.0]), (20, [1.0]), (21, [2.0])], SCHEMA)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in nearest(few, F.col("vec_id") == 20).collect()) == [(20, 1, 21, 2.0)] * 2
    assert nearest(docs.limit(0), F.col("vec_id") == 20).count() == 0


def test_other_ids_behind_many_rows_of_the_query(spark):
    rows = [(20, [1.0, 0.0])] * 25 + [(i, [1.0, 0.0]) for i in range(21, 30)] + [(21, [1.0, 0.0])] * 2 + [(1, [0.5, 0.0]), (40, [0.0, 1.0])]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = {}
    for r in nearest(docs, F.col("vec_id") % 20 == 0, k=5).collect():
        found.setdefault(r.query_id, {}).setdefault((r.rank, r.vec_id, r.score), []).append(r)
    assert found[20].keys() == {(1, 21, 1.0), (2, 21, 1.0), (3, 21, 1.0), (4, 22, 1.0), (5, 23, 1.0)} and {len(same) for same in found[20].values()} == {25}
    assert found[40].keys() == {(rank, vec_id, 0.0) for rank, vec_id in ((1, 1), *((n, 20) for n in range(2, 6)))}
