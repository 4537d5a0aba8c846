"""Physical plans of the registered queries: what is read, shuffled, broadcast and run in Python."""

import pytest

from __spark_entry__ import queries
from granary.queries import REGISTRY, Tables
from granary.plans.inspect import count_nodes, plan_text
from granary.sources.columnar import read_footers
from pyspark.sql import functions as F
from tests.fixtures import rows

QUERIES = {name: run for name, run in queries().items() if name in REGISTRY}

# fewest columns each scan may read, as Spark prints them
READS = {
    "scan_pruned_count": "struct<l_orderkey:bigint>",
    "agg_sum": "struct<o_custkey:bigint,o_totalprice:double>",
    "agg_count_rows": "struct<event_type:string>",
    "distinct_column": "struct<o_custkey:bigint>",
    "word_count": "struct<text:string>",
    "win_nth": "struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>",
    "json_parse": "struct<event_id:bigint,props:string>",
    "limit_topk": "struct<o_orderkey:bigint,o_totalprice:double>",
    "agg_table_count": "struct<>",
}

PUSHED = {
    "filter_numeric": "GreaterThan(o_totalprice,250000.0)",
    "filter_compound": "GreaterThan(o_totalprice,100000.0)",
    "sql_filter": "EqualTo(o_orderstatus,F)",
    "agg_sum_cast": "EqualTo(o_orderstatus,F)",
}

SHUFFLES = {"agg_count": 1, "agg_avg": 1, "agg_having": 1, "word_count": 1, "win_nth": 1, "win_nth_sql": 1, "distinct_rows": 1,
            "union_duplicates": 0, "json_flatten": 1, "proj_tax": 0, "sort_asc": 1, "limit_topk": 0, "join_cross": 0,
            "agg_prepartitioned": 0, "join_bucketed": 0, "udf_bonus": 0}


@pytest.mark.parametrize("name", sorted(READS))
def test_reads_only_needed_columns(spark, data, name):
    assert f"ReadSchema: {READS[name]}" in plan_text(QUERIES[name](spark, data), "formatted")


@pytest.mark.parametrize("name", sorted(PUSHED))
def test_filters_reach_the_scan(spark, data, name):
    assert PUSHED[name] in plan_text(QUERIES[name](spark, data), "formatted")


@pytest.mark.parametrize("name", sorted(SHUFFLES))
def test_number_of_shuffles(spark, data, name):
    assert count_nodes(QUERIES[name](spark, data), "Exchange") == SHUFFLES[name]


def test_python_only_where_the_query_is_about_it(spark, data):
    python = {name for name in QUERIES if "src_" not in name and "sink" not in name and "keyed" not in name and "layout" not in name
              and "multi" not in name and "Python" in plan_text(QUERIES[name](spark, data))}
    assert python == {"udf_bonus", "udf_sql_bonus", "lookup_udf", "join_random_salt"}


def test_no_products_and_no_nested_loops(spark, data):
    for name in ("join_cross", "join_salted", "win_max", "multi_extract_nations", "partition_by_key", "lookup_map"):
        text = plan_text(QUERIES[name](spark, data))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_partition_filter(spark, data):
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan_text(QUERIES["scan_partition_filter"](spark, data), "formatted")


def test_cache_is_read(spark, data):
    result = QUERIES["cache_reuse"](spark, data)
    try:
        assert count_nodes(result, "InMemoryTableScan") == 2
    finally:
        spark.catalog.clearCache()


def test_salted_query_salts(spark, data):
    result = QUERIES["join_salted"](spark, data)
    result.collect()
    text = plan_text(result)
    assert "SortMergeJoin [user_key" in text and "_piece" in text
    assert "LocalTableScan" in text, "the heavy keys are found once and are literals in the plan"


def test_aggregates_of_whole_files_read_footers(spark, data, tmp_path):
    query = QUERIES["scan_footer_aggregates"](spark, data)
    assert "PushedAggregation: [COUNT(*), MIN(l_orderkey), MAX(l_orderkey), MAX(l_quantity)]" in plan_text(query, "formatted")
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    path = str(tmp_path / "by-status")
    spark.read.parquet(f"{data}/orders.parquet").select("o_orderkey", "o_orderstatus").write.partitionBy("o_orderstatus").parquet(path)
    counts = read_footers(spark, path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"), F.max("o_orderkey").alias("last"))
    assert "PushedGroupBy: [o_orderstatus]" in plan_text(counts, "formatted")
    plain = spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"), F.max("o_orderkey").alias("last"))
    assert rows(counts) == rows(plain)
    # a filter on a column is no matter of footers
    some = read_footers(spark, path).where("o_orderkey > 100").agg(F.count(F.lit(1)))
    assert rows(some) == rows(spark.read.parquet(path).where("o_orderkey > 100").agg(F.count(F.lit(1))))


def test_joined_filter_prunes(spark, data):
    assert "dynamicpruningexpression(c_nationkey" in plan_text(QUERIES["scan_dynamic_partitions"](spark, data), "formatted")


def test_sql_function_is_an_expression(spark, data):
    text = plan_text(QUERIES["sql_function_bonus"](spark, data))
    assert "Python" not in text and "fifth_of" not in text and "* 0.2" in text


def test_unequal_buckets_need_no_exchange(spark, data):
    query = QUERIES["join_buckets_coalesced"](spark, data)
    assert count_nodes(query, "Exchange") == 0 and "Coalesced to" in plan_text(query, "formatted")


def test_schema_is_read_again_when_files_change(spark, tmp_path):
    path = f"{tmp_path}/orders.parquet"
    spark.range(3).write.parquet(path)
    tables = Tables(spark, str(tmp_path))
    assert tables("orders").columns == ["id"]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("schema", "schema")
    try:
        assert Tables(spark, str(tmp_path))("orders").columns == ["id"] and len(tracker.getJobIdsForGroup("schema")) == 0
        spark.range(2).selectExpr("id as other", "'x' as text").write.mode("overwrite").parquet(path)
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert tables("orders").columns == ["other", "text"] and tables("orders").count() == 2
