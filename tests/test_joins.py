import glob

import pytest
from pyspark.sql import functions as F

from granary.operators.joins import (
    adaptive_session,
    equi_join,
    join_left_when,
    lookup,
    lookup_literal,
    pruned_join,
    replicate,
    shuffle_hash_session,
)
from granary.operators.sizing import broadcast_if_small, estimated_bytes, measured_bytes, proven_small
from granary.operators.skew import PIECE, PIECES, copy_rows, heavy_keys, key_sketch, salt_rows, salted_join
from granary.operators.views import broadcast_hint, sql_over
from granary.plans.inspect import count_nodes, plan_text
from granary.queries.joining import skewed_events, users
from granary.queries.registry import Tables
from granary.session import profile_session, scoped_conf
from granary.sinks.tables import bucketed_join, save_bucketed, save_bucketed_pair
from tests.fixtures import DEPTS, DEPTS_SCHEMA, STAFF, STAFF_SCHEMA, rows

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": -1, "spark.sql.adaptive.autoBroadcastJoinThreshold": -1}


@pytest.fixture(scope="module")
def staff(spark):
    return spark.createDataFrame(STAFF, STAFF_SCHEMA).select("id", "dept", "salary")


@pytest.fixture(scope="module")
def depts(spark):
    return spark.createDataFrame(DEPTS, DEPTS_SCHEMA)


@pytest.fixture(scope="module")
def tables(spark, data):
    return Tables(spark, data)


def test_equi_join_kinds(staff, depts):
    right = depts.withColumnRenamed("dept", "d")
    inner = equi_join(staff, right, {"dept": "d"}).select("id", "dept_name")
    assert rows(inner) == [("a1", "Sales"), ("a2", "Sales"), ("a3", "Finance"), ("a4", "Finance")]
    left = equi_join(staff, right, {"dept": "d"}, "left_outer").select("id", "dept_name")
    assert rows(left) == rows(inner) + [("a5", None), ("a6", None)]


def test_equi_join_refuses_ambiguous_columns(staff, depts):
    with pytest.raises(ValueError, match="dept"):
        equi_join(staff, depts, {"dept": "dept"})
    with pytest.raises(ValueError, match="strategy"):
        equi_join(staff, depts.withColumnRenamed("dept", "d"), {"dept": "d"}, strategy="guess")


def test_join_left_when_keeps_all_left_rows(staff, depts):
    right = depts.withColumnRenamed("dept", "d")
    never = join_left_when(staff, right, {"dept": "d"}, F.col("id").isNull())
    assert never.count() == 6 and never.where("d is not null").count() == 0
    some = join_left_when(staff, right, {"dept": "d"}, F.col("dept") == "10")
    assert rows(some.select("id", "d")) == [("a1", "10"), ("a2", "10"), ("a3", None), ("a4", None), ("a5", None), ("a6", None)]


def test_join_using_keeps_one_key(staff, depts):
    assert staff.join(depts, on="dept").columns == ["dept", "id", "salary", "dept_name", "city"]


def test_replicate(staff):
    copies = replicate(staff.select("id"), 3, "salt")
    assert rows(copies)[:4] == [("a1", 0), ("a1", 1), ("a1", 2), ("a2", 0)]
    assert count_nodes(copies, "CartesianProduct") == count_nodes(copies, "BroadcastNestedLoopJoin") == 0
    with pytest.raises(ValueError):
        replicate(staff, 0, "salt")


def test_lookup_literal_and_table_agree(staff, depts):
    table = depts.where("dept is not null")
    found = lookup(staff, "dept", table, "dept", "dept_name")
    literal = staff.withColumn("dept_name", lookup_literal(F.col("dept"), {"10": "Sales", "20": "Finance", "40": "Legal"}))
    assert rows(found) == rows(literal)
    assert found.columns == ["id", "dept", "salary", "dept_name"]
    assert dict((row[0], row[-1]) for row in rows(lookup(staff, "dept", table, "dept", "dept_name", default="none")))["a6"] == "none"


def test_lookup_in_a_large_table_is_not_broadcast(spark, staff, depts, tmp_path):
    depts.write.parquet(str(tmp_path / "depts"))
    stored = spark.read.parquet(str(tmp_path / "depts"))
    with scoped_conf(spark, NO_BROADCAST):
        large = lookup(staff, "dept", stored, "dept", "dept_name", max_bytes=100)
        small = lookup(staff, "dept", stored, "dept", "dept_name")
        assert rows(large) == rows(small)
        assert count_nodes(large, "SortMergeJoin") == 2, "the entries with their counts, then the rows with the entries"
        assert count_nodes(small, "BroadcastHashJoin") == 1


def test_lookup_refuses_duplicate_keys(spark, staff, depts):
    twice = depts.unionAll(depts.where("dept = '20'"))
    with pytest.raises(Exception, match="duplicate lookup key"):
        lookup(staff, "dept", twice, "dept", "dept_name").collect()
    nulls = depts.unionAll(depts.where("dept is null"))
    assert lookup(staff, "dept", nulls, "dept", "dept_name").count() == 6


# sizes


def test_sizes(spark, data):
    nation = spark.read.parquet(f"{data}/nation.parquet")
    assert 0 < estimated_bytes(nation) < 10_000
    assert measured_bytes(nation) == sum(24 + len(row["n_name"]) for row in nation.collect())
    assert proven_small(nation) and not proven_small(nation, 100)
    assert measured_bytes(nation.limit(0)) == 0
    assert measured_bytes(spark.createDataFrame([(None, [1, 2])], "a string, b array<int>")) > 16


def test_compressed_rows_are_not_taken_for_small(spark, tmp_path):
    path = str(tmp_path / "same")
    spark.range(200_000).select(F.lit("x" * 200).alias("text")).coalesce(1).write.parquet(path)
    same = spark.read.parquet(path)
    assert estimated_bytes(same) < 1_000_000 < measured_bytes(same)
    assert not proven_small(same, 1_000_000)


def test_broadcast_only_when_small(spark, tables):
    with scoped_conf(spark, NO_BROADCAST):
        orders, nation = tables("orders"), tables("nation")
        small = tables("customer").join(broadcast_if_small(nation), F.col("c_nationkey") == F.col("n_nationkey"))
        large = tables("customer").join(broadcast_if_small(orders, 1000), F.col("c_custkey") == F.col("o_custkey"))
        assert (count_nodes(small, "BroadcastHashJoin"), count_nodes(large, "BroadcastHashJoin")) == (1, 0)
        assert broadcast_hint(nation, "n") == "/*+ BROADCAST(n) */"
        hinted = sql_over(f"select {broadcast_hint(nation, 'n')} * from {{c}} c left join {{n}} n on c_nationkey = n_nationkey",
                          c=tables("customer"), n=nation)
        assert count_nodes(hinted, "BroadcastHashJoin") == 1
        forced = equi_join(tables("customer"), nation, {"c_nationkey": "n_nationkey"}, strategy="broadcast")
        assert count_nodes(forced, "BroadcastHashJoin") == 1


# strategies


def test_strategy_hints_are_local(spark, tables):
    for strategy, node in (("merge", "SortMergeJoin"), ("shuffle_hash", "ShuffledHashJoin"), ("broadcast", "BroadcastHashJoin")):
        joined = equi_join(tables("customer"), tables("nation"), {"c_nationkey": "n_nationkey"}, "left_outer", strategy)
        assert count_nodes(joined, node) == 1, strategy
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"


def test_shuffle_hash_session_checks_partition_sizes(spark, tables):
    for limit, node in (("128MB", "ShuffledHashJoin"), ("1b", "SortMergeJoin")):
        hashed = tables.through(shuffle_hash_session(spark, limit))
        joined = equi_join(hashed("orders"), hashed("customer"), {"o_custkey": "c_custkey"}, "left_outer")
        joined.collect()
        assert count_nodes(joined, node) == 1, limit


def test_adaptive_session_splits_skew_and_switches_to_broadcast(spark, tables, tmp_path):
    path = str(tmp_path / "skewed")
    skewed_events(tables).repartition(8).write.parquet(path)
    session = adaptive_session(spark, "4KB", "8KB", 1.5, "-1")
    skewed = session.read.parquet(path).join(users(tables.through(session)), "user_key", "left_outer")
    expected = rows(skewed_events(tables).join(users(tables), "user_key", "left_outer"))
    assert rows(skewed) == expected
    assert "skew=true" in plan_text(skewed)

    # the planner cannot know that the filter leaves few customers; the run does
    session = profile_session(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB"})
    switched = session.read.parquet(path).join(users(tables.through(session)), "user_key")
    switched.collect()
    assert (count_nodes(switched, "BroadcastHashJoin"), count_nodes(switched, "SortMergeJoin")) == (1, 0)


# skew


@pytest.fixture(scope="module")
def hot(spark):
    """Two thirds in one key, a tenth without key, copies of one row, keys without partner."""
    key = F.expr("case when id % 10 = 0 then null when id % 3 < 2 then 7 else id % 50 end").cast("int")
    value = F.when(F.col("id") % 4 == 0, 0).otherwise(F.col("id"))
    return spark.range(3000).repartition(6).select(key.alias("k"), value.alias("v"))


@pytest.fixture(scope="module")
def side(spark):
    # two partners for key 7, none for keys above 40, one without key
    return spark.range(41).selectExpr("cast(id as int) as k", "concat('s', id) as s").unionAll(
        spark.createDataFrame([(7, "again"), (None, "null")], "k int, s string"))


@pytest.mark.parametrize("how", ["inner", "left_outer"])
@pytest.mark.parametrize("salts", [1, 7, 32])
def test_salted_join_equals_plain_join(spark, hot, side, how, salts):
    with scoped_conf(spark, NO_BROADCAST):
        assert rows(salted_join(hot, side, "k", salts, how)) == rows(hot.join(side, "k", how).select("k", "v", "s"))


def test_salted_join_null_safe(hot, side):
    plain = hot.join(side.withColumnRenamed("k", "r"), F.col("k").eqNullSafe(F.col("r")), "left_outer").select("k", "v", "s")
    assert rows(salted_join(hot, side, "k", 8, null_safe=True)) == rows(plain)


def test_salted_join_with_two_keys_and_of_a_table_with_itself(hot):
    both = hot.withColumn("j", F.col("v") % 2)
    right = both.groupBy("k", "j").agg(F.count(F.lit(1)).alias("n"))
    assert rows(salted_join(both, right, ["k", "j"], 8)) == rows(both.join(right, ["k", "j"], "left_outer").select("k", "v", "j", "n"))
    with pytest.raises(ValueError):
        salted_join(hot, hot, "k", how="full_outer")


def test_heavy_keys_are_few_and_their_pieces_bounded(hot):
    for pieces in (1, 2, 10, 100):
        found = rows(heavy_keys(hot, "k", pieces))
        assert len(found) < max(pieces, 2)
        assert sum(row[1] for row in found) <= 2 * pieces
    counts = dict(rows(hot.groupBy("k").count()))
    assert dict(rows(heavy_keys(hot, "k", 10))) == {7: -(-counts[7] * 10 // 3000)}
    assert set(dict(rows(heavy_keys(hot, "k", 11)))) == {7, None}


def test_heavy_key_is_spread_over_tasks(hot, side):
    heavy = heavy_keys(hot, "k", 32)
    salted = salt_rows(hot, heavy, "k", 32, salt_from=["v"])
    wanted = dict(heavy.collect())
    counts = {(row["k"], row[PIECE]): row["count"] for row in salted.groupBy("k", PIECE).count().collect()}
    assert len([key for key in counts if key[0] == 7]) == wanted[7] > 10
    assert len([key for key in counts if key[0] is None]) > 5, "null keys are spread too"
    assert all(piece == 0 for key, piece in counts if key not in wanted and key is not None)
    # copies of one row do not stay together: they are read by several tasks
    assert salted.where("k = 7 and v = 0").select(PIECE).distinct().count() > 1
    copied = copy_rows(side, heavy, "k")
    assert copied.where("k = 7").count() == 2 * wanted[7]
    assert copied.where("k = 8").count() == 1
    assert PIECES not in copied.columns and PIECES not in salted.columns


def test_heavy_key_is_spread_behind_a_shuffle_on_it(hot):
    placed = hot.repartition(8, "k")
    salted = salt_rows(placed, heavy_keys(placed, "k", 16), "k", 16)
    assert salted.where("k = 7").select(PIECE).distinct().count() > 5


@pytest.mark.parametrize("how", ["inner", "left_outer"])
def test_salted_join_with_a_heavy_key_on_the_right(hot, side, how):
    left = side.unionByName(side.selectExpr("k + 1000 as k", "s"))
    expected = rows(left.join(hot, "k", how).select("k", "s", "v"))
    assert rows(salted_join(left, hot, "k", 8, how, right_heavy=True)) == expected
    assert rows(salted_join(left, hot.repartition(4, "k"), "k", 8, how, right_heavy=True)) == expected


def test_joins_refuse_a_name_on_both_sides(hot, side):
    with pytest.raises(ValueError, match="both sides"):
        salted_join(hot, side.withColumn("v", F.lit(1)), "k")
    with pytest.raises(ValueError, match="both sides"):
        join_left_when(hot, side, {"k": "k"}, F.lit(True))


def test_salt_is_the_same_in_every_run(hot):
    heavy = heavy_keys(hot, "k", 16)
    salted = salt_rows(hot, heavy, "k", 16)
    assert rows(salted) == rows(salted)


# buckets


def exchanges(df):
    return count_nodes(df, "Exchange")


@pytest.fixture
def names(request, spark):
    base = "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name)
    made = [f"{base}_{i}" for i in range(3)]
    yield made
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_bucketed_join_has_no_exchange(spark, tables, names):
    orders = tables("orders").select(F.col("o_custkey").alias("k"), "o_orderkey")
    customers = tables("customer").select(F.col("c_custkey").alias("k"), "c_name")
    assert save_bucketed_pair(orders, customers, (names[0], names[1]), 4, "k") is False
    joined = bucketed_join(spark, names[0], names[1], "k", "left_outer")
    assert rows(joined) == rows(orders.join(customers, "k", "left_outer"))
    assert exchanges(joined) == 0 and count_nodes(joined, "SortMergeJoin") == 1


def test_bucket_rules(spark, tables, names):
    left = tables("orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("other"))
    right = tables("customer").select(F.col("c_custkey").alias("k"), F.col("c_custkey").alias("other"), "c_name")
    save_bucketed(left, names[0], 4, "k")
    save_bucketed(right, names[1], 8, "k")
    one, two = spark.table(names[0]), spark.table(names[1])
    with scoped_conf(spark, {**NO_BROADCAST, "spark.sql.adaptive.enabled": False}):
        assert exchanges(one.join(two, one.k == two.k)) == 1, "other number of buckets"
        assert exchanges(one.join(right, one.k == right.k)) == 1, "one side bucketed"
        assert exchanges(one.join(two, one.other == two.other)) == 2, "other column"


def test_bucketed_pair_with_a_heavy_key(spark, hot, side, names):
    assert save_bucketed_pair(hot, side, (names[0], names[1]), 8, "k") is True
    for how in ("inner", "left_outer"):
        joined = bucketed_join(spark, names[0], names[1], "k", how)
        assert rows(joined.select("k", "v", "s")) == rows(hot.join(side, "k", how).select("k", "v", "s"))
        assert exchanges(joined) == 0
    hot_files = spark.table(names[0]).where("k = 7").select("_metadata.file_name").distinct().count()
    assert hot_files > 1, "the heavy key is in several buckets"
    with pytest.raises(ValueError):
        bucketed_join(spark, names[0], names[1], "k", "full_outer")


def test_unpaired_tables_are_refused(spark, hot, side, names):
    save_bucketed_pair(hot, side, (names[0], names[1]), 8, "k")
    save_bucketed(side, names[2], 8, "k")
    with pytest.raises(ValueError):
        bucketed_join(spark, names[0], names[2], "k")


@pytest.mark.parametrize("at_once, steps", [(4_000_000, 1), (0, 2)])
def test_heavy_keys_come_from_a_sketch(spark, monkeypatch, at_once, steps):
    """What is shuffled is a sketch for each task, never the keys."""
    monkeypatch.setattr("granary.operators.skew.MERGED_AT_ONCE", at_once)
    df = spark.range(1_000).selectExpr("if(id % 3 = 0, 7, id) as k")
    sketch = key_sketch(df, "k", 16)
    text = plan_text(sketch)
    assert "hashpartitioning(k" not in text and "hashpartitioning(_hash" not in text
    assert count_nodes(sketch, "Exchange") == steps and "partial_approx_top_k_accumulate" in text
    assert sketch.count() == 1 and rows(heavy_keys(df, "k", 16)) == [(7, 6)]
    assert key_sketch(df.limit(0), "k", 16).count() == 0 and heavy_keys(df.limit(0), "k", 16).isEmpty()


@pytest.mark.parametrize("pieces", [2, 7, 64, 300])
def test_sketched_heavy_keys_equal_counts(spark, pieces):
    """Many ordinary keys, some heavy ones of any type, keys of two columns, none and nulls."""
    df = spark.range(60_000).select(F.expr("""case when id % 10 < 3 then 'hot' when id % 10 = 4 then null when id % 100 = 5 then 'warm'
                                              else concat('k', id) end""").alias("a"), F.expr("if(id % 4 = 0, 1.5D, id)").alias("b"))
    for key in ("a", "b", ["a", "b"]):
        names = [key] if isinstance(key, str) else key
        counted = df.groupBy(*names).count().where(F.col("count") * pieces > 60_000)
        expected = {tuple(row[:-1]): -(-row["count"] * pieces // 60_000) for row in counted.collect()}
        assert {tuple(row[:-1]): row[-1] for row in heavy_keys(df, key, pieces).collect()} == expected
    even = spark.range(5_000)
    assert heavy_keys(even, "id", pieces).isEmpty() and heavy_keys(even.limit(0), "id", pieces).isEmpty()


def test_tables_with_unequal_buckets_join_without_a_shuffle(spark, tables, names):
    left = tables("lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber")
    right = tables("orders").select(F.col("o_orderkey").alias("k"), "o_custkey")
    save_bucketed(left, names[0], 16, "k")
    save_bucketed(right, names[1], 8, "k")
    for how in ("inner", "left_outer"):
        joined = bucketed_join(spark, names[0], names[1], "k", how)
        assert exchanges(joined) == 0 and "Coalesced to 8" in plan_text(joined, "formatted")
        assert rows(joined) == rows(left.join(right, "k", how))
    assert spark.conf.get("spark.sql.bucketing.coalesceBucketsInJoin.enabled") == "false"


def test_a_joined_filter_prunes_partitions(spark, tables, tmp_path):
    path, schema = str(tmp_path / "customers"), "c_custkey bigint, c_nationkey int"
    customer = tables("customer").select("c_custkey", "c_nationkey")
    customer.write.partitionBy("c_nationkey").parquet(path)
    nations = tables("nation").where("n_regionkey = 2").select("n_nationkey", "n_name")
    wanted = {row.n_nationkey for row in nations.collect()}
    # directories of other nations hold what no reader could read
    for nation in set(range(25)) - wanted:
        for file in glob.glob(f"{path}/c_nationkey={nation}/*.parquet"):
            with open(file, "wb") as out:
                out.write(b"not parquet")
    joined = pruned_join(spark.read.schema(schema).parquet(path), nations, {"c_nationkey": "n_nationkey"})
    assert "dynamicpruning" in plan_text(joined, "formatted")
    assert rows(joined) == rows(customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")))
