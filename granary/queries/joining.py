"""Join, lookup and union queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions.udfs import random_salt_udf, shared_lookup_udf
from granary.operators.joins import (
    adaptive_session,
    equi_join,
    join_left_when,
    lookup,
    lookup_literal,
    replicate,
    shuffle_hash_session,
    unique_entries,
)
from granary.operators.setops import sort_rows, top_rows, union_all, union_by_name, union_distinct
from granary.operators.skew import salted_join
from granary.operators.sizing import proven_small
from granary.operators.views import broadcast_hint, sql_over
from granary.queries.registry import Tables, query
from granary.session import scratch_path
from granary.sinks.tables import bucket_count, bucketed_join, save_bucketed, save_bucketed_pair
from granary.sources.rows import sequence_table

CUSTOMER_NATION = "SELECT c_custkey, c_name, n_name FROM customer {} JOIN nation ON c_nationkey = n_nationkey"
CUSTOMER_ORDERS = "SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN orders ON c_custkey = o_custkey"


@query(CUSTOMER_NATION.format(""))
def join_inner(t: Tables) -> DataFrame:
    joined = t("customer").alias("c").join(t("nation").alias("n"), F.col("c.c_nationkey") == F.col("n.n_nationkey"), "inner")
    return joined.select("c.c_custkey", "c.c_name", "n.n_name")


@query(CUSTOMER_ORDERS)
def join_left_outer(t: Tables) -> DataFrame:
    joined = equi_join(t("customer"), t("orders"), {"c_custkey": "o_custkey"}, "left_outer")
    return joined.select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query("""SELECT c_custkey, c_mktsegment, n_name FROM customer LEFT JOIN nation
          ON c_nationkey = n_nationkey AND (c_mktsegment = 'BUILDING' OR c_mktsegment = 'MACHINERY') AND c_acctbal > 0""")
def join_left_compound(t: Tables) -> DataFrame:
    wanted = ((F.col("c_mktsegment") == "BUILDING") | (F.col("c_mktsegment") == "MACHINERY")) & (F.col("c_acctbal") > 0)
    joined = join_left_when(t("customer"), t("nation"), {"c_nationkey": "n_nationkey"}, wanted)
    return joined.select("c_custkey", "c_mktsegment", "n_name")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 2 = 0")
def join_using(t: Tables) -> DataFrame:
    last = t("orders").agg(F.max("o_orderkey").alias("last")).head()["last"]
    even = sequence_table(t.spark, 0, last + 1, 2, "o_orderkey")
    return t("orders").select("o_orderkey", "o_custkey").join(even, on="o_orderkey")


@query("SELECT n_nationkey, n_name, CAST(range AS INTEGER) AS salt FROM nation, range(32)")
def join_cross(t: Tables) -> DataFrame:
    return replicate(t("nation").select("n_nationkey", "n_name"), 32, "salt")


@query(CUSTOMER_NATION.format("LEFT"))
def join_broadcast(t: Tables) -> DataFrame:
    joined = equi_join(t("customer"), t("nation"), {"c_nationkey": "n_nationkey"}, "left_outer", strategy="broadcast")
    return joined.select("c_custkey", "c_name", "n_name")


@query(CUSTOMER_NATION.format("LEFT"))
def sql_join_hint(t: Tables) -> DataFrame:
    nation = t("nation")
    return sql_over(f"""
        select {broadcast_hint(nation, "n")} c_custkey, c_name, n.n_name
        from {{customer}} c left outer join {{nation}} n on c.c_nationkey = n.n_nationkey
    """, customer=t("customer"), nation=nation)


@query(CUSTOMER_ORDERS)
def join_sort_merge(t: Tables) -> DataFrame:
    joined = equi_join(t("customer"), t("orders"), {"c_custkey": "o_custkey"}, "left_outer", strategy="merge")
    return joined.select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_custkey, o_totalprice, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def join_shuffle_hash(t: Tables) -> DataFrame:
    hashed = t.through(shuffle_hash_session(t.spark))
    customer = hashed("customer").select("c_custkey", "c_name")
    joined = equi_join(hashed("orders"), customer, {"o_custkey": "c_custkey"}, "left_outer")
    return joined.select("o_orderkey", "o_custkey", "o_totalprice", "c_name")


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice, o_custkey, o_orderstatus
          FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""")
def join_bucketed(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "buckets")
    name = path.rpartition("/")[2].replace("-", "_")
    items, orders = f"{name}_items", f"{name}_orders"
    left = t("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    right = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
    save_bucketed_pair(left, right, (items, orders), bucket_count(left, right), "l_orderkey", (f"{path}/items", f"{path}/orders"))
    joined = bucketed_join(t.spark, items, orders, "l_orderkey", "left_outer")
    for table in (items, orders):
        t.spark.sql(f"DROP TABLE {table}")
    return joined


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice, o_custkey, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def join_buckets_coalesced(t: Tables) -> DataFrame:
    """Tables saved apart, one in twice as many buckets as the other."""
    path = scratch_path(t.spark, "buckets")
    name = path.rpartition("/")[2].replace("-", "_")
    items, orders = f"{name}_items", f"{name}_orders"
    left = t("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    right = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
    buckets = bucket_count(left, right)
    save_bucketed(left, items, 2 * buckets, "l_orderkey", f"{path}/items")
    save_bucketed(right, orders, buckets, "l_orderkey", f"{path}/orders")
    joined = bucketed_join(t.spark, items, orders, "l_orderkey")
    for table in (items, orders):
        t.spark.sql(f"DROP TABLE {table}")
    return joined


SKEWED_USER = "CASE WHEN event_type <> 'error' THEN 1 ELSE user_id END"
SKEWED_SQL = f"""SELECT event_id, value, {SKEWED_USER} AS user_key, c_name, c_mktsegment
                 FROM events LEFT JOIN customer ON c_custkey = {SKEWED_USER}"""


def skewed_events(t: Tables) -> DataFrame:
    """Events of which most belong to one user."""
    return t("events").select("event_id", "value", F.expr(SKEWED_USER).alias("user_key"))


def users(t: Tables) -> DataFrame:
    return t("customer").select(F.col("c_custkey").alias("user_key"), "c_name", "c_mktsegment")


@query(SKEWED_SQL)
def join_salted(t: Tables) -> DataFrame:
    return salted_join(skewed_events(t), users(t), "user_key", salt_from=["event_id"], strategy="merge")


@query(f"""SELECT c_custkey AS user_key, c_name, c_mktsegment, event_id, value
           FROM customer LEFT JOIN events ON c_custkey = {SKEWED_USER}""")
def join_skewed_right(t: Tables) -> DataFrame:
    """Customers with their events, most of which belong to one customer: the heavy key is on the right of an outer join."""
    return salted_join(users(t), skewed_events(t), "user_key", right_heavy=True)


@query(SKEWED_SQL)
def join_random_salt(t: Tables) -> DataFrame:
    """The skewed join with a random salt on one side and all salts on the other."""
    salted = skewed_events(t).withColumn("salt", random_salt_udf(8)("event_id"))
    copies = replicate(users(t), 8, "salt")
    return salted.join(copies, ["user_key", "salt"], "left_outer").drop("salt")


@query(SKEWED_SQL)
def join_adaptive(t: Tables) -> DataFrame:
    adaptive = t.through(adaptive_session(t.spark))
    return skewed_events(adaptive).join(users(adaptive), "user_key", "left_outer")


@query("SELECT s_suppkey, s_nationkey, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def lookup_map(t: Tables) -> DataFrame:
    return lookup(t("supplier").select("s_suppkey", "s_nationkey"), "s_nationkey", t("nation"), "n_nationkey", "n_name")


NULLABLE_KEY = "CASE WHEN s_suppkey % 3 <> 0 THEN CAST(s_nationkey AS BIGINT) END"


@query(f"SELECT s_suppkey, {NULLABLE_KEY} AS nation_key, n_name FROM supplier LEFT JOIN nation ON {NULLABLE_KEY} = n_nationkey")
def lookup_udf(t: Tables) -> DataFrame:
    """A lookup through a shared mapping, with keys that are null; a key listed twice raises at any size."""
    supplier = t("supplier").select("s_suppkey", F.expr(NULLABLE_KEY).alias("nation_key"))
    nation = t("nation").select(F.col("n_nationkey").cast("bigint").alias("nation_key"), "n_name")
    if not proven_small(nation):
        return lookup(supplier, "nation_key", nation, "nation_key", "n_name")
    names = dict(unique_entries(nation, "nation_key").collect())
    return supplier.withColumn("n_name", shared_lookup_udf(t.spark, names)("nation_key"))


STATUS_NAMES = {"F": "finished", "O": "open"}


@query("""SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status_name
          FROM orders""")
def lookup_constants(t: Tables) -> DataFrame:
    orders = t("orders").select("o_orderkey", "o_orderstatus")
    return orders.withColumn("status_name", lookup_literal(F.col("o_orderstatus"), STATUS_NAMES))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey")
def sort_asc(t: Tables) -> DataFrame:
    return sort_rows(t("orders").select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").asc()], "o_orderkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def limit_topk(t: Tables) -> DataFrame:
    return top_rows(t("orders").select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc()], 100, "o_orderkey")


@query("SELECT c_nationkey AS nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def union_duplicates(t: Tables) -> DataFrame:
    return union_all(t("customer").select(F.col("c_nationkey").alias("nationkey")), t("supplier").select("s_nationkey"))


@query("""SELECT CAST(sum(o_orderkey) AS BIGINT) AS total_sum FROM orders WHERE o_orderkey % 2 = 0
          UNION ALL SELECT CAST(c_nationkey AS BIGINT) FROM customer""")
def union_positional(t: Tables) -> DataFrame:
    return union_all(join_using(t).selectExpr("sum(o_orderkey) as total_sum"), t("customer").select("c_nationkey"))


@query("""SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
          UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""")
def union_named(t: Tables) -> DataFrame:
    customer = t("customer").selectExpr("c_custkey as id", "c_name as name", "c_acctbal as balance")
    supplier = t("supplier").selectExpr("s_acctbal as balance", "s_suppkey as id", "s_name as name")
    return union_by_name(customer, supplier)


@query("SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def union_unique(t: Tables) -> DataFrame:
    return union_distinct(t("customer").select(F.col("c_nationkey").alias("nationkey")), t("supplier").select("s_nationkey"))
