"""File layout and caching queries."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.caching import keep
from granary.operators.joins import pruned_join
from granary.operators.layout import compact_partitions, file_stats, optimize_files, point_lookup
from granary.operators.partitioning import partition_rows, repartition_even, shrink_partitions
from granary.queries.reading import stored_rows
from granary.queries.registry import Tables, query
from granary.session import scratch_path
from granary.sinks.files import write_partitioned, write_with_blooms
from granary.sinks.tables import save_partitioned_table
from granary.sources.columnar import read_footers, read_parquet, read_partitioned, read_table


@query("""SELECT 'orders.parquet' AS file_name, min(o_orderkey) AS min_value, max(o_orderkey) AS max_value, count(*) AS rows
          FROM orders""")
def file_minmax(t: Tables) -> DataFrame:
    return file_stats(t("orders"), "o_orderkey").orderBy("min_value")


def orders_by_status(t: Tables) -> str:
    """Orders in one directory per status, as the tasks happen to write them: a small file per task and status, twice."""
    path = scratch_path(t.spark, "orders-by-status")
    for half in ("o_orderpriority < '3'", "o_orderpriority >= '3'"):
        orders = t("orders").where(half).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
        orders.write.mode("append").partitionBy("o_orderstatus").parquet(path)
    return path


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def layout_compact(t: Tables) -> DataFrame:
    path = orders_by_status(t)
    optimize_files(t.spark, path, f"{path}-compact", "o_orderstatus", where="o_orderstatus = 'F'")
    return read_partitioned(t.spark, f"{path}-compact")


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def layout_compact_partition(t: Tables) -> DataFrame:
    """One partition of a catalog table gets new files, the others keep theirs."""
    path = scratch_path(t.spark, "orders-located")
    name = path.rpartition("/")[2].replace("-", "_")
    save_partitioned_table(t("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"), name, "o_orderstatus", path)
    compact_partitions(t.spark, name, f"{path}-compact", "o_orderstatus = 'F'", cluster_by="o_custkey")
    rows = stored_rows(read_table(t.spark, name))
    t.spark.sql(f"DROP TABLE {name}")
    return rows


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey = (SELECT max(o_custkey) - 1 FROM orders)""")
def layout_bloom_lookup(t: Tables) -> DataFrame:
    """A lookup in files that are not clustered by the column: those without the value are told by their Bloom filters."""
    path = scratch_path(t.spark, "orders-blooms")
    write_with_blooms(repartition_even(t("orders").select("o_orderkey", "o_custkey", "o_totalprice"), 16), path, {"o_custkey": 100_000})
    wanted = t("orders").agg(F.max("o_custkey").alias("key")).head()["key"] - 1
    return point_lookup(t.spark, path, {"o_custkey": wanted})


@query("SELECT count(*) AS rows, min(l_orderkey) AS first, max(l_orderkey) AS last, max(l_quantity) AS most FROM lineitem")
def scan_footer_aggregates(t: Tables) -> DataFrame:
    return read_footers(t.spark, t.path("lineitem")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("l_orderkey").alias("first"), F.max("l_orderkey").alias("last"), F.max("l_quantity").alias("most"))


@query("""SELECT c_custkey, c_name, c_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""")
def scan_dynamic_partitions(t: Tables) -> DataFrame:
    """Customers in a directory per nation, of which a filter on the region of the nation leaves a few."""
    path = scratch_path(t.spark, "customers-by-nation")
    write_partitioned(t("customer").select("c_custkey", "c_name", "c_nationkey"), path, "c_nationkey")
    nations = t("nation").join(t("region").where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    customers = read_partitioned(t.spark, path, "c_custkey bigint, c_name string, c_nationkey int")
    return pruned_join(customers, nations.select("n_nationkey", "n_name"), {"c_nationkey": "n_nationkey"}).drop("n_nationkey")


@query("SELECT o_orderkey, o_totalprice, lpad(CAST(o_custkey % 13 AS VARCHAR), 3, '0') AS dept FROM orders")
def layout_text_partitions(t: Tables) -> DataFrame:
    """Partition values such as 001 stay text through a write, the compaction of one of them and a read."""
    path = scratch_path(t.spark, "orders-by-dept")
    dept = F.lpad((F.col("o_custkey") % 13).cast("string"), 3, "0")
    write_partitioned(t("orders").select("o_orderkey", "o_totalprice", dept.alias("dept")), path, "dept")
    optimize_files(t.spark, path, f"{path}-compact", "dept", where="dept = '001'")
    return read_partitioned(t.spark, f"{path}-compact")


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def layout_cluster(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders-clustered")
    t("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus").write.parquet(f"{path}/plain")
    optimize_files(t.spark, f"{path}/plain", f"{path}/clustered", cluster_by=["o_custkey", "o_totalprice"])
    return read_parquet(t.spark, f"{path}/clustered")


@query("""SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders
          WHERE o_orderstatus = 'F' AND o_custkey = (SELECT max(o_custkey) FROM orders WHERE o_orderstatus = 'F')""")
def layout_lookup(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders-by-status")
    write_partitioned(t("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"), path, "o_orderstatus")
    optimize_files(t.spark, path, f"{path}-clustered", "o_orderstatus", cluster_by="o_custkey")
    wanted = t("orders").where(F.col("o_orderstatus") == "F").agg(F.max("o_custkey").alias("key")).head()["key"]
    return point_lookup(t.spark, f"{path}-clustered", {"o_orderstatus": "F", "o_custkey": wanted})


PARTS_SQL = """SELECT o_orderstatus, 'above 200000' AS part, count(*) AS rows FROM orders WHERE o_totalprice > 200000 GROUP BY o_orderstatus
               UNION ALL
               SELECT o_orderstatus, 'above 300000', count(*) FROM orders WHERE o_totalprice > 300000 GROUP BY o_orderstatus"""


def _parts(orders: DataFrame) -> DataFrame:
    parts = [orders.where(f"o_totalprice > {limit}").groupBy("o_orderstatus").agg(F.lit(f"above {limit}").alias("part"),
                                                                                F.count(F.lit(1)).alias("rows"))
             for limit in (200000, 300000)]
    return parts[0].unionAll(parts[1])


@query(PARTS_SQL)
def cache_reuse(t: Tables) -> DataFrame:
    return _parts(keep(t("orders").where("o_totalprice > 200000").select("o_orderstatus", "o_totalprice")))


@query(PARTS_SQL)
def persist_level(t: Tables) -> DataFrame:
    """The same with a frame that is kept on disk only."""
    kept = keep(t("orders").where("o_totalprice > 200000").select("o_orderstatus", "o_totalprice"), StorageLevel.DISK_ONLY)
    return _parts(kept)


@query("SELECT o_orderkey, o_custkey FROM orders")
def partition_even(t: Tables) -> DataFrame:
    """Rows stay the same through an even repartition and a reduction of partitions."""
    return shrink_partitions(repartition_even(t("orders").select("o_orderkey", "o_custkey"), 16), 3)


@query("SELECT count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders")
def partition_parts(t: Tables) -> DataFrame:
    """The rows of all single partitions add up to the table."""
    placed = repartition_even(t("orders").select("o_orderkey"), 4)
    parts = [partition_rows(placed, number) for number in range(4)]
    whole = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
    return whole.agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"))
