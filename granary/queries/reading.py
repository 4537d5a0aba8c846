"""Source and sink queries: tables written to scratch space in one form and read back in another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from granary.functions.text import parse_json, render_json
from granary.operators.nested import expand_struct
from granary.queries.registry import Tables, query
from granary.session import scratch_path
from granary.sinks.extracts import TARGET, multi_extract
from granary.sinks.files import write_csv, write_files, write_json, write_orc, write_parquet, write_partitioned
from granary.sinks.keyed import append_files, keyed_append, keyed_delete
from granary.sinks.listed import delete_from_files, read_listed
from granary.sinks.tables import drop_versions, publish_version, save_partitioned_table, save_table
from granary.sources.columnar import read_nested, read_orc, read_parquet, read_partitioned, read_table, with_source_file
from granary.sources.delimited import mark_bad, read_csv, read_csv_plain
from granary.sources.documents import read_json, read_json_document, read_lines
from granary.sources.rows import rows_table, sequence_table

REGION_RANKS = [(1, "first", 10.0), (2, None, None), (3, "third", 30.0), (3, "third", 30.0)]


@query("""SELECT r_regionkey, r_name, rank_name, weight FROM region
          JOIN (VALUES (1, 'first', CAST(10 AS DOUBLE)), (2, NULL, NULL), (3, 'third', 30), (3, 'third', 30)) v(r_regionkey, rank_name, weight)
          USING (r_regionkey)""")
def src_rows_ddl(t: Tables) -> DataFrame:
    given = rows_table(t.spark, REGION_RANKS, "r_regionkey int, rank_name string, weight double")
    return t("region").join(given, "r_regionkey")


@query("SELECT n_nationkey, n_name, label FROM nation JOIN (VALUES (0, 'zero'), (7, 'seven')) v(n_nationkey, label) USING (n_nationkey)")
def src_rows_struct(t: Tables) -> DataFrame:
    schema = StructType([StructField("n_nationkey", IntegerType(), False), StructField("label", StringType())])
    return t("nation").select("n_nationkey", "n_name").join(rows_table(t.spark, [(0, "zero"), (7, "seven")], schema), "n_nationkey")


@query("SELECT r_regionkey, r_name, CAST(count(n_nationkey) AS BIGINT) AS nations FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY ALL")
def src_json_multiline(t: Tables) -> DataFrame:
    """One pretty-printed document per region with its nations, each in a file of its own."""
    path = scratch_path(t.spark, "regions-json")
    nations = t("nation").groupBy("n_regionkey").agg(F.collect_list("n_name").alias("nations"))
    whole = t("region").join(nations, F.col("r_regionkey") == F.col("n_regionkey"))
    document = F.to_json(F.struct("r_regionkey", "r_name", "nations"), {"pretty": "true"}).alias("value")
    # a file cannot be split, so each small document gets its own
    whole.select("r_regionkey", document).write.partitionBy("r_regionkey").text(path)
    read = read_json_document(t.spark, f"{path}/*", "r_regionkey int, r_name string, nations array<string>")
    return read.select("r_regionkey", "r_name", F.size("nations").cast("bigint").alias("nations"))


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def sink_managed_table(t: Tables) -> DataFrame:
    """A managed table, read back through a copy of its rows before the table is dropped with its files."""
    name = scratch_path(t.spark, "supplier").rpartition("/")[2].replace("-", "_")
    save_table(t("supplier").select("s_suppkey", "s_name", "s_acctbal"), name)
    rows = stored_rows(read_table(t.spark, name))
    t.spark.sql(f"DROP TABLE {name}")
    return rows


def stored_rows(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "rows")
    write_parquet(df, path)
    return read_parquet(df.sparkSession, path)


CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@query("SELECT range AS id FROM range(0, (SELECT max(o_orderkey) + 1 FROM orders), 2)")
def src_range(t: Tables) -> DataFrame:
    last = t("orders").agg(F.max("o_orderkey").alias("last")).head()["last"]
    return sequence_table(t.spark, 0, last + 1, 2)


@query(CUSTOMER_SQL)
def src_csv_schema(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customer-csv")
    write_csv(t("customer"), path, header=True)
    return read_csv(t.spark, path, CUSTOMER_SCHEMA)


@query("SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_csv_inferred(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customer-csv")
    write_csv(t("customer"), path, header=True)
    inferred = read_csv(t.spark, path, options={"samplingRatio": 1.0})
    return inferred.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS _c0, c_name AS _c1, CAST(c_nationkey AS VARCHAR) AS _c2, c_mktsegment AS _c3
          FROM customer""")
def src_csv_plain(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customer-csv")
    write_csv(t("customer").drop("c_acctbal"), path)
    return read_csv_plain(t.spark, path)


ORDER_FIELDS = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate date"


def dirty_orders(t: Tables) -> str:
    """Orders as CSV in which some prices and some dates are words."""
    path = scratch_path(t.spark, "orders-dirty")
    dirty = t("orders").select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderpriority") == "5-LOW", "Low").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(F.col("o_orderstatus") == "P", "no date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"))
    write_csv(dirty, path, header=True)
    return path


@query("""SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS o_totalprice,
                 CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate,
                 CASE WHEN o_orderpriority = '5-LOW' OR o_orderstatus = 'P' THEN 1 ELSE 0 END AS bad
          FROM orders""")
def src_csv_permissive(t: Tables) -> DataFrame:
    parsed = read_csv(t.spark, dirty_orders(t), ORDER_FIELDS, bad_column="bad_record")
    # every kept line names its own key and customer
    kept_line = F.col("bad_record").startswith(F.concat_ws(",", "o_orderkey", "o_custkey", F.lit("")))
    rows = mark_bad(parsed, "bad_record").withColumn("bad", F.when(F.col("is_bad"), kept_line.cast("int")).otherwise(0))
    return rows.drop("is_bad", "bad_record").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query("""SELECT o_orderkey, o_orderpriority = '5-LOW' OR o_orderstatus = 'P' AS is_bad FROM orders""")
def src_csv_split_keys(t: Tables) -> DataFrame:
    """Only the keys of both halves: the verdict must not depend on the columns that are used."""
    parsed = read_csv(t.spark, dirty_orders(t), ORDER_FIELDS, bad_column="bad_record")
    return mark_bad(parsed, "bad_record").select("o_orderkey", "is_bad")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def src_csv_failfast(t: Tables) -> DataFrame:
    """Clean files in the mode that refuses any bad field."""
    path = scratch_path(t.spark, "orders-clean")
    write_csv(t("orders").select("o_orderkey", "o_custkey", "o_totalprice"), path, header=True)
    return read_csv(t.spark, path, "o_orderkey bigint, o_custkey bigint, o_totalprice double", mode="FAILFAST")


@query("""SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
          FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P'""")
def src_csv_dropmalformed(t: Tables) -> DataFrame:
    rows = read_csv(t.spark, dirty_orders(t), ORDER_FIELDS, mode="DROPMALFORMED")
    return rows.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def src_parquet_scan(t: Tables) -> DataFrame:
    return read_parquet(t.spark, t.path("orders"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def src_orc_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders-orc")
    write_orc(t("orders"), path)
    return read_orc(t.spark, f"{path}/*.orc")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def src_nested_dirs(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders-nested")
    write_partitioned(t("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"), path, "o_orderstatus")
    return read_nested(t.spark, path)


@query("SELECT event_id, event_type, user_id, value FROM events")
def src_json_inferred(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "events-json")
    write_json(t("events").select("event_id", "user_id", "event_type", "value"), path)
    return read_json(t.spark, path)


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, event_type FROM events")
def src_json_schema(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "events-json")
    write_json(t("events").select("event_id", "user_id", "event_type", "value"), path)
    return read_json(t.spark, path, "event_id string, event_type string")


@query("SELECT event_id, user_id, value FROM events")
def src_text_lines(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "events-text")
    t("events").select(render_json(F.struct("event_id", "user_id", "value")).alias("value")).write.text(path)
    parsed = read_lines(t.spark, path).select(parse_json("value", "event_id bigint, user_id bigint, value double").alias("parsed"))
    return expand_struct(parsed, "parsed")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def src_catalog_table(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customer-table")
    name = path.rpartition("/")[2].replace("-", "_")
    save_table(t("customer").select("c_custkey", "c_name", "c_acctbal"), name, path=path)
    rows = read_table(t.spark, name)
    # the frame is resolved; dropping the entry of an external table leaves its files
    t.spark.sql(f"DROP TABLE {name}")
    return rows


@query("SELECT count(*) AS rows FROM lineitem")
def scan_pruned_count(t: Tables) -> DataFrame:
    return t("lineitem").select("l_orderkey").agg(F.count("l_orderkey").alias("rows"))


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def scan_partition_filter(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders-by-status")
    write_partitioned(t("orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), path, "o_orderstatus")
    return read_parquet(t.spark, path).where(F.col("o_orderstatus") == "F")


@query("SELECT s_suppkey, s_name, 'supplier.parquet' AS file_name FROM supplier")
def src_file_name(t: Tables) -> DataFrame:
    return with_source_file(t("supplier").select("s_suppkey", "s_name"))


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def sink_csv_one_file(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "supplier-csv")
    write_files(t("supplier").drop("s_nationkey"), path, 1)
    return read_csv(t.spark, path, "s_suppkey bigint, s_name string, s_acctbal double")


@query("""SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier""")
def sink_modes(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "supplier-modes")
    supplier = t("supplier").select("s_suppkey", "s_name")
    write_parquet(t("supplier"), path)
    write_parquet(supplier, path, mode="overwrite")
    write_parquet(supplier, path, mode="append")
    write_parquet(supplier, path, mode="ignore")
    return read_parquet(t.spark, path)


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def sink_partitioned_table(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customer-by-segment")
    name = path.rpartition("/")[2].replace("-", "_")
    save_partitioned_table(t("customer").select("c_custkey", "c_name", "c_mktsegment"), name, "c_mktsegment", path=path)
    # partitions are listed by the catalog when a query runs, so the files are read by path once the entry is gone
    t.spark.sql(f"DROP TABLE {name}")
    return read_parquet(t.spark, path)


@query("SELECT event_id, user_id, value FROM events WHERE event_type <> 'error'")
def keyed_delete_events(t: Tables) -> DataFrame:
    events = t("events").select("event_id", "user_id", "value")
    return keyed_delete(events, t("events").where(F.col("event_type") == "error"), "event_id")


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN value + 1 ELSE value END AS value FROM events")
def keyed_append_events(t: Tables) -> DataFrame:
    base = t("events").where(F.col("event_type") != "error").select("event_id", "value")
    return keyed_append(base, t("events").select("event_id", (F.col("value") + 1).alias("value")), "event_id")


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN value + 1 ELSE value END AS value FROM events")
def keyed_append_files(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "events-keyed")
    write_parquet(t("events").where(F.col("event_type") != "error").select("event_id", "value"), path)
    append_files(path, t("events").select("event_id", (F.col("value") + 1).alias("value")), "event_id")
    return read_parquet(t.spark, path)


@query("SELECT event_id, event_type, value FROM events WHERE event_type <> 'error'")
def keyed_delete_version(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "events-versions")
    name = root.rpartition("/")[2].replace("-", "_")
    publish_version(t("events").select("event_id", "event_type", "value"), name, root, by="event_type")
    gone = t("events").where(F.col("event_type") == "error").select("event_id")
    path = publish_version(keyed_delete(read_table(t.spark, name), gone, "event_id"), name, root, by="event_type")
    # the files outlive the catalog entries
    drop_versions(t.spark, name)
    return read_partitioned(t.spark, path)


@query("SELECT event_id, event_type, value FROM events WHERE NOT (event_type = 'error' AND event_id % 1000 < 300)")
def keyed_delete_files(t: Tables) -> DataFrame:
    """A delete that writes anew only the files that hold a deleted key."""
    path = scratch_path(t.spark, "events-listed")
    write_partitioned(t("events").select("event_id", "event_type", "value"), path, "event_type")
    gone = t("events").where((F.col("event_type") == "error") & (F.col("event_id") % 1000 < 300))
    schema = "event_id bigint, value double, event_type string"
    delete_from_files(t.spark, path, gone.select("event_id"), "event_id", by="event_type", schema=schema)
    return read_listed(t.spark, path, schema).select("event_id", "event_type", "value")


EXTRACTED = ("Nation_3", "NATION_7", "nation_11", "Nation_19")


@query("""SELECT c_custkey, c_name, n_name, lower(n_name) AS extract FROM customer JOIN nation ON c_nationkey = n_nationkey
          WHERE lower(n_name) IN ('nation_3', 'nation_7', 'nation_11', 'nation_19')""")
def multi_extract_nations(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "extracts")
    rows = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "n_name")
    multi_extract(rows, "n_name", EXTRACTED, path)
    return read_csv(t.spark, path, f"c_custkey bigint, c_name string, n_name string, {TARGET} string")
