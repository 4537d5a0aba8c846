import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from granary.llm.queries import QUERIES
from granary.llm.sharding import Node, even_tree, group, grown, place_documents, shard_of


def brute_shard(doc_id, tree):
    key, node = "" if doc_id is None else str(doc_id), tree
    while node.parts:
        def draw(place):
            part = node.parts[place]
            bits = int(hashlib.md5(f"{key}\n{part.label}".encode()).hexdigest()[:13], 16)
            return -math.log((bits + 0.5) / 2**52) / part.weight, part.shard if not part.parts else place
        node = node.parts[min(range(len(node.parts)), key=draw)]
    return node.shard


def brute_rows(rows, tree):
    made, places = [], defaultdict(list)
    for number, (i, text) in enumerate(rows):
        data = (text or "").encode()
        shard = brute_shard(i, tree)
        made.append([i, len(data) + 16, zlib.crc32(data), "key", shard, None, brute_shard(i, grown(tree))])
        places[shard].append((i is not None, i or 0, zlib.crc32(data), len(data), number))
    for members in places.values():
        for slot, (*_, number) in enumerate(sorted(members)):
            made[number][5] = slot
    return Counter(map(tuple, made))


def test_placement_equals_brute_force(spark, data):
    rows = [tuple(row) for row in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    made = QUERIES["op12_sharding"](spark, data)
    assert made.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    found = [tuple(row) for row in made.collect()]
    assert Counter(found) == brute_rows(rows, even_tree(40, 5, 2))
    assert {row[6] for row in found if row[6] != row[4]} == {40}


def test_rows_of_every_kind(spark):
    rows = [(1, "a"), (1, "a"), (1, None), (2, ""), (None, "no id"), (None, None), (3, "ü" * 50_000), *[(7, "hot")] * 400, *[(i, "copy") for i in range(50, 90)]]
    tree = even_tree(6, 2, 1)
    docs = spark.createDataFrame([(*row, 5, "x") for row in rows], "doc_id long, text string, slot int, extra string").repartition(7)
    made = place_documents(docs, tree)
    assert made.columns == ["doc_id", "extra", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert Counter(tuple(row) for row in made.drop("extra").collect()) == brute_rows(rows, tree)
    assert place_documents(docs.limit(0), tree).count() == 0


def test_slots_across_ranges(spark):
    """Many ranges for few shards, and many shards in one range."""
    docs = spark.range(5_000).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"))
    for shards, partitions in ((2, 40), (40, 1)):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            slots = defaultdict(list)
            for row in place_documents(docs, even_tree(shards, 2, 1)).collect():
                slots[row.shard].append((row.slot, row.doc_id))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        for members in slots.values():
            assert [slot for slot, _ in sorted(members)] == list(range(len(members)))
            assert [i for _, i in sorted(members)] == sorted(i for _, i in members)


def test_weights_and_movement(spark):
    """Rows follow the weights, and a changed weight moves rows of its own subtrees only."""
    ids = spark.range(40_000).select(F.col("id").alias("doc_id"))

    def tree(weight):
        racks = [[group(f"rack {r}.{k}", [Node(f"shard {4 * r + 2 * k + s}", weight if (r, k, s) == (1, 1, 0) else 1.0, 4 * r + 2 * k + s) for s in range(2)])
                  for k in range(2)] for r in range(3)]
        return group("root", [group(f"region {r}", racks[r]) for r in range(3)])

    before, after = tree(1.0), tree(3.0)
    rows = ids.select(shard_of(F.col("doc_id"), before).alias("a"), shard_of(F.col("doc_id"), after).alias("b"),
                      shard_of(F.col("doc_id"), grown(before, 2.0)).alias("c")).collect()
    assert all(abs(n - 40_000 / 12) < 300 for n in Counter(row.a for row in rows).values())
    counts = Counter(row.b for row in rows)
    assert abs(counts[6] - 40_000 * 3 / 14) < 500
    moved = {(row.a, row.b) for row in rows if row.a != row.b}
    # into region 1 from others; inside it only into the rack, and inside that only into the shard
    assert all(b // 4 == 1 for _, b in moved)
    assert all(b // 2 == 3 for a, b in moved if a // 4 == 1) and all(b == 6 for a, b in moved if a // 2 == 3)
    assert {row.c for row in rows if row.c != row.a} == {12}
    assert abs(Counter(row.c for row in rows)[12] - 40_000 * 2 / 14) < 500


def test_shares_of_the_forty(spark):
    counts = Counter(row.s for row in spark.range(40_000).select(shard_of(F.col("id"), even_tree(40, 5, 2)).alias("s")).collect())
    assert set(counts) == set(range(40)) and max(counts.values()) < 1_150 and min(counts.values()) > 850


def test_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = docs.select(shard_of(F.col("doc_id"), even_tree(40, 5, 2)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_bad_trees_and_names(spark):
    with pytest.raises(ValueError):
        group("empty", [])
    with pytest.raises(ValueError):
        group("none", [Node("shard 0", 0.0, 0)])
    docs = spark.createDataFrame([(1, "a", 2)], "doc_id long, text string, _shard_range int")
    with pytest.raises(ValueError):
        place_documents(docs, even_tree(4, 1, 1))
