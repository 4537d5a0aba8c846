"""

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the local threads, BENCH_RUNS the timed runs per entry.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.udfs import batch_udf, bonus
from granary.operators.aggregates import exact_avg, grouped
from granary.operators.caching import cached, release_kept
from granary.operators.joins import adaptive_session, equi_join, replicate
from granary.operators.layout import optimize_files, point_lookup
from granary.operators.projection import equals_ignore_case
from granary.operators.skew import salted_join
from granary.operators.windows import group_max
from granary.queries import REGISTRY, Tables
from granary.session import build_session, drop_scratch, profile_session, scratch_path
from granary.sinks.extracts import multi_extract
from granary.sinks.files import run_fully
from granary.sinks.tables import bucketed_join, save_bucketed, save_bucketed_pair
from granary.sources.delimited import read_csv

HEADLINES = (
    "second_order", "src_parquet_scan", "src_csv_permissive", "src_json_inferred", "src_orc_roundtrip",
    "proj_tax", "filter_compound", "date_format", "case_when", "json_parse", "json_flatten", "array_explode",
    "join_inner", "join_left_outer", "join_broadcast", "join_sort_merge", "join_bucketed", "join_salted", "join_adaptive",
    "join_shuffle_hash", "lookup_map", "agg_sum", "agg_having", "agg_two_keys", "agg_prepartitioned", "distinct_rows", "word_count",
    "win_max", "win_nth", "sort_asc", "limit_topk", "union_unique", "udf_sql_bonus", "native_bonus", "sql_view_chain",
    "keyed_append_events", "keyed_delete_events", "multi_extract_nations", "layout_compact", "layout_cluster", "layout_lookup",
)
SKEW_COPIES = 8
EXTRACTS = ("nation_1", "nation_5", "nation_9", "nation_14")


def median_seconds(work: Callable[[], object], runs: int, budget: float = 15.0) -> float:
    """Median of ``runs`` after one warm-up; long entries stop once they have used their budget."""
    work()
    times = []
    while len(times) < runs and sum(times) < budget:
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 4)


def noop(build: Callable[[], DataFrame]) -> Callable[[], None]:
    return lambda: run_fully(build())


def pairs(spark: SparkSession, t: Tables) -> dict[str, dict[str, Callable[[], object]]]:
    """Naive against improved forms. Layouts are written here, outside the timed work."""
    base = scratch_path(spark, "bench")
    items, orders, customer = t("lineitem"), t("orders"), t("customer")

    save_bucketed(items.select("l_orderkey", "l_quantity"), "bench_grouped", 8, "l_orderkey", f"{base}/grouped")
    items.select("l_orderkey", "l_quantity").repartition(8).write.parquet(f"{base}/grouped-plain")
    plain_items = items.select(F.col("l_orderkey").alias("k"), "l_extendedprice", "l_quantity", "l_shipdate")
    plain_orders = orders.select(F.col("o_orderkey").alias("k"), "o_custkey", "o_totalprice")
    save_bucketed_pair(plain_items, plain_orders, ("bench_items", "bench_orders"), 8, "k", (f"{base}/items", f"{base}/orders"))
    plain_items.repartition(8).write.parquet(f"{base}/items-plain")
    plain_orders.repartition(8).write.parquet(f"{base}/orders-plain")

    # small tables hide what skew handling is for: each line item counts several times
    skewed = replicate(items, SKEW_COPIES, "copy").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag",
                          F.expr("if(pmod(xxhash64(l_orderkey, l_linenumber), 10) < 8, 1, l_partkey % 1000)").alias("user_key"))
    skewed.repartition(16).write.parquet(f"{base}/skewed")
    users = customer.select(F.col("c_custkey").alias("user_key"), "c_name", "c_mktsegment")
    rigid = profile_session(spark, {"spark.sql.adaptive.enabled": False, "spark.sql.autoBroadcastJoinThreshold": -1})
    adaptive = adaptive_session(spark, "1MB", "2MB", 2.0, "-1")

    named = customer.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "c_acctbal", "n_name")
    named.repartition(8).write.parquet(f"{base}/named")

    by_key = replicate(items, SKEW_COPIES, "copy").select("l_partkey", "l_orderkey", "l_extendedprice")
    by_key.repartition(64).write.parquet(f"{base}/shuffled")
    optimize_files(spark, f"{base}/shuffled", f"{base}/clustered", target_bytes=1024 * 1024, cluster_by="l_partkey")

    def bucketed_average():
        return grouped(spark.table("bench_grouped"), "l_orderkey", {"average": exact_avg("l_quantity", 2)})

    def loop_of_extracts():
        for i, value in enumerate(EXTRACTS):
            chosen = spark.read.parquet(f"{base}/named").where(equals_ignore_case(F.col("n_name"), value))
            chosen.coalesce(1).write.option("header", True).csv(scratch_path(spark, f"bench-loop-{i}"))

    sales = items.select("l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag")
    sales.repartition(8).write.option("header", True).csv(f"{base}/sales")

    def three_reports(kept: DataFrame):
        for flag in "ANR":
            run_fully(kept.where(F.col("l_returnflag") == flag).agg(exact_avg("l_extendedprice", 2)))

    def filtered():
        schema = "l_orderkey bigint, l_quantity double, l_extendedprice double, l_returnflag string"
        return read_csv(spark, f"{base}/sales", schema).where("l_quantity > 20").select("l_returnflag", "l_extendedprice")

    def with_cache():
        with cached(filtered()) as kept:
            three_reports(kept)

    row_udf = F.udf(lambda value: value * 0.2, "double")
    return {
        "grouped_average": {
            "plain": noop(lambda: grouped(spark.read.parquet(f"{base}/grouped-plain"), "l_orderkey", {"average": exact_avg("l_quantity", 2)})),
            "bucketed": noop(bucketed_average)},
        "small_dimension": {
            "sort_merge": noop(lambda: equi_join(items, t("supplier"), {"l_suppkey": "s_suppkey"}, "left_outer", "merge")),
            "broadcast": noop(lambda: equi_join(items, t("supplier"), {"l_suppkey": "s_suppkey"}, "left_outer", "broadcast"))},
        "big_with_big": {
            "sort_merge": noop(lambda: spark.read.parquet(f"{base}/items-plain").join(
                spark.read.parquet(f"{base}/orders-plain").hint("merge"), "k", "left_outer")),
            "bucketed": noop(lambda: bucketed_join(spark, "bench_items", "bench_orders", "k", "left_outer"))},
        "skewed_key": {
            "plain": noop(lambda: rigid.read.parquet(f"{base}/skewed").join(
                t.through(rigid)("customer").selectExpr("c_custkey as user_key", "c_name", "c_mktsegment"), "user_key", "left_outer")),
            "salted": noop(lambda: salted_join(spark.read.parquet(f"{base}/skewed"), users, "user_key", 16, strategy="merge")),
            "adaptive": noop(lambda: adaptive.read.parquet(f"{base}/skewed").join(
                t.through(adaptive)("customer").selectExpr("c_custkey as user_key", "c_name", "c_mktsegment"), "user_key", "left_outer"))},
        "skewed_maximum": {
            "window": noop(lambda: spark.read.parquet(f"{base}/skewed").withColumn(
                "top", F.expr("max(l_extendedprice) over (partition by user_key)"))),
            "joined": noop(lambda: group_max(spark.read.parquet(f"{base}/skewed"), "user_key", "l_extendedprice", "top"))},
        "bonus": {
            "row_udf": noop(lambda: items.select(row_udf("l_extendedprice").alias("bonus"))),
            "batch_udf": noop(lambda: items.select(batch_udf(bonus, "double")("l_extendedprice").alias("bonus"))),
            "native": noop(lambda: items.selectExpr("l_extendedprice * 0.2D as bonus"))},
        "extracts": {
            "one_job_each": loop_of_extracts,
            "one_scan": lambda: multi_extract(spark.read.parquet(f"{base}/named"), "n_name", EXTRACTS, scratch_path(spark, "bench-one"))},
        "point_lookup": {
            "shuffled": noop(lambda: point_lookup(spark, f"{base}/shuffled", {"l_partkey": 777})),
            "clustered": noop(lambda: point_lookup(spark, f"{base}/clustered", {"l_partkey": 777}))},
        "repeated_filter": {"recomputed": lambda: three_reports(filtered()), "cached": with_cache},
        "count": {
            "all_columns": noop(lambda: items.agg(F.count(F.lit(1)), F.max(F.xxhash64(*items.columns)))),
            "one_column": noop(lambda: items.select("l_orderkey").agg(F.count("l_orderkey")))},
    }


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = set(sys.argv[1:])
    spark = build_session("granary-bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": False, "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": f"/tmp/granary-bench-{os.getpid()}/warehouse"})
    spark.sparkContext.setLogLevel("ERROR")
    t = Tables(spark, directory)
    queries = {}
    for name in HEADLINES:
        if not only or name in only:
            queries[name] = median_seconds(noop(lambda name=name: REGISTRY[name].run(spark, directory)), runs)
            release_kept()
            drop_scratch(spark)
    compared = {}
    if not only or "pairs" in only:
        compared = {pair: {form: median_seconds(work, runs) for form, work in forms.items()} for pair, forms in pairs(spark, t).items()}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(queries.values()), 3), "unit": "sec",
                      "queries": queries, "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
                      "cpus": int(cpus), "pairs": compared}))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
