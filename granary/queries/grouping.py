"""Aggregate, distinct, window and word count queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.aggregates import (
    distinct_values,
    exact_avg,
    exact_sum,
    grouped,
    observed_sum,
    rows_per_key,
    sum_when,
    word_count,
)
from granary.operators.partitioning import repartition_by_key, with_partition
from granary.operators.skew import default_pieces
from granary.operators.windows import group_max, nth_per_group
from granary.queries.joining import skewed_events
from granary.queries.registry import Tables, query
from granary.session import scratch_path
from granary.sinks.files import run_fully
from granary.sinks.tables import bucket_count, save_bucketed
from granary.sources.rows import rows_table

PRICE_SUM = "CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE)"


@query("SELECT o_custkey, count(o_orderkey) AS orders FROM orders GROUP BY o_custkey")
def agg_count(t: Tables) -> DataFrame:
    return grouped(t("orders"), "o_custkey", {"orders": F.count("o_orderkey")})


@query("SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey")
def agg_sum(t: Tables) -> DataFrame:
    return grouped(t("orders"), "o_custkey", {"total": F.round(F.sum("o_totalprice"), 2)})


@query(f"SELECT o_orderpriority, {PRICE_SUM} / count(o_totalprice) AS average FROM orders GROUP BY o_orderpriority")
def agg_avg(t: Tables) -> DataFrame:
    return grouped(t("orders"), "o_orderpriority", {"average": exact_avg("o_totalprice", 2)})


@query(f"""SELECT o_custkey, {PRICE_SUM} / count(o_totalprice) AS average FROM orders GROUP BY o_custkey
           HAVING {PRICE_SUM} / count(o_totalprice) > 250000""")
def agg_having(t: Tables) -> DataFrame:
    return grouped(t("orders"), "o_custkey", {"average": exact_avg("o_totalprice", 2)}, having="average > 250000")


@query("SELECT event_type, count(*) AS rows FROM events GROUP BY event_type")
def agg_count_rows(t: Tables) -> DataFrame:
    return grouped(t("events"), "event_type", {"rows": F.count(F.lit(1))})


@query("SELECT CAST(sum(o_orderkey) AS BIGINT) AS total_sum FROM orders")
def agg_global(t: Tables) -> DataFrame:
    return t("orders").selectExpr("sum(o_orderkey) as total_sum")


@query(f"""SELECT o_orderstatus, CAST(trunc({PRICE_SUM}) AS BIGINT) AS total FROM orders WHERE o_orderstatus = 'F'
           GROUP BY o_orderstatus""")
def agg_sum_cast(t: Tables) -> DataFrame:
    wanted = t("orders").where(F.col("o_orderstatus") == "F")
    return grouped(wanted, "o_orderstatus", {"total": exact_sum("o_totalprice", 2).cast("bigint")})


@query("SELECT count(*) AS rows FROM orders")
def agg_table_count(t: Tables) -> DataFrame:
    return t("orders").agg(F.count(F.lit(1)).alias("rows"))


@query("""SELECT o_orderstatus, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders
          GROUP BY o_orderstatus ORDER BY first_key""")
def agg_min_max(t: Tables) -> DataFrame:
    ranges = {"first_key": F.min("o_orderkey"), "last_key": F.max("o_orderkey")}
    return grouped(t("orders"), "o_orderstatus", ranges).orderBy("first_key")


@query("""SELECT o_orderstatus, o_orderpriority, min(o_totalprice) AS lowest, max(o_totalprice) AS highest FROM orders
          GROUP BY o_orderstatus, o_orderpriority ORDER BY o_orderstatus, lowest""")
def agg_two_keys(t: Tables) -> DataFrame:
    ranges = {"lowest": F.min("o_totalprice"), "highest": F.max("o_totalprice")}
    return grouped(t("orders"), ["o_orderstatus", "o_orderpriority"], ranges).orderBy("o_orderstatus", "lowest")


@query(f"SELECT o_custkey, {PRICE_SUM} / count(o_totalprice) AS average FROM orders GROUP BY o_custkey")
def agg_prepartitioned(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders-by-customer")
    name = path.rpartition("/")[2].replace("-", "_")
    orders = t("orders").select("o_custkey", "o_totalprice")
    save_bucketed(orders, name, bucket_count(orders), "o_custkey", path=path)
    result = grouped(t.spark.read.table(name), "o_custkey", {"average": exact_avg("o_totalprice", 2)})
    t.spark.sql(f"DROP TABLE {name}")
    return result


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t("lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax").distinct()


@query("SELECT DISTINCT o_custkey FROM orders")
def distinct_column(t: Tables) -> DataFrame:
    return distinct_values(t("orders"), "o_custkey")


@query("""SELECT user_key, count(*) AS rows, round(count(*) / sum(count(*)) OVER (), 6) AS share
          FROM (SELECT CASE WHEN event_type <> 'error' THEN 1 ELSE user_id END AS user_key FROM events) GROUP BY user_key""")
def skew_report(t: Tables) -> DataFrame:
    return rows_per_key(skewed_events(t), "user_key").withColumn("share", F.round("share", 6))


@query("SELECT o_custkey, count(*) AS rows, 0 AS scattered FROM orders GROUP BY o_custkey")
def partition_by_key(t: Tables) -> DataFrame:
    """Rows per key after partitioning by it; a key that no partition is too small for must not be in two of them."""
    orders = t("orders").select("o_custkey")
    partitions = default_pieces(orders)
    placed = with_partition(repartition_by_key(orders, partitions, "o_custkey"))
    pieces = placed.groupBy("o_custkey", "partition_num").agg(F.count(F.lit(1)).alias("rows"))
    keys = pieces.groupBy("o_custkey").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("partitions"))
    light = F.col("rows") * partitions <= orders.agg(F.count(F.lit(1)).alias("total")).scalar()
    return keys.select("o_custkey", "rows", (light & (F.col("partitions") > 1)).cast("int").alias("scattered"))


FINISHED_SQL = "SELECT round(coalesce(sum(o_totalprice), 0), 2) AS total FROM orders WHERE o_orderstatus = 'F'"


@query(FINISHED_SQL)
def sum_where(t: Tables) -> DataFrame:
    return t("orders").agg(F.round(sum_when("o_totalprice", F.col("o_orderstatus") == "F"), 2).alias("total"))


@query(FINISHED_SQL)
def observe_sum(t: Tables) -> DataFrame:
    """The total that is observed while another result is computed in full."""
    orders, seen = observed_sum(t("orders"), "o_totalprice", F.col("o_orderstatus") == "F")
    run_fully(orders.select("o_orderkey", "o_totalprice"))
    return rows_table(t.spark, [(round(seen.get["total"], 2),)], "total double")


@query(r"""SELECT word, count(*) AS occurrences
           FROM (SELECT unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS word FROM documents)
           WHERE word <> '' GROUP BY word""", name="word_count")
def count_words(t: Tables) -> DataFrame:
    return word_count(t("documents"), "text")


@query("""SELECT o_orderkey, o_custkey, o_totalprice, max(o_totalprice) OVER (PARTITION BY o_custkey) AS max_price FROM orders""")
def win_max(t: Tables) -> DataFrame:
    return group_max(t("orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_custkey", "o_totalprice", "max_price")


SECOND_SQL = """SELECT o_orderkey, o_custkey, o_totalprice, CAST(rn AS INTEGER) AS rn FROM (
                    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
                WHERE rn = 2"""


@query(SECOND_SQL)
def win_nth(t: Tables) -> DataFrame:
    orders = t("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return nth_per_group(orders, "o_custkey", [F.col("o_totalprice").desc()], 2, "o_orderkey")


@query(SECOND_SQL)
def win_nth_sql(t: Tables) -> DataFrame:
    numbered = t("orders").select("o_orderkey", "o_custkey", "o_totalprice").withColumn(
        "rn", F.expr("row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey)"))
    return numbered.where("rn = 2")


@query(f"""WITH totals AS (SELECT o_custkey, {PRICE_SUM} AS total, {PRICE_SUM} / count(o_totalprice) AS average
                           FROM orders GROUP BY o_custkey HAVING {PRICE_SUM} > 100000),
                second AS ({SECOND_SQL})
           SELECT c_custkey, c_name, n_name, o_orderkey, o_totalprice, total, average
           FROM second JOIN totals USING (o_custkey) JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def second_order(t: Tables) -> DataFrame:
    """The second-highest order of each customer with the nation's name and the customer's total and average."""
    orders = t("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    totals = grouped(orders, "o_custkey", {"total": exact_sum("o_totalprice", 2), "average": exact_avg("o_totalprice", 2)},
                     having="total > 100000")
    second = nth_per_group(orders, "o_custkey", [F.col("o_totalprice").desc()], 2, "o_orderkey")
    named = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left_outer")
    joined = second.join(totals, "o_custkey").join(named, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("c_custkey", "c_name", "n_name", "o_orderkey", "o_totalprice", "total", "average")
