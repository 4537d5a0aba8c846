"""Projection, filter, scalar function, JSON, UDF and SQL view queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions.dates import format_date, in_zone, parse_date, year_text
from granary.functions.text import (
    explode_variant,
    joined_text,
    or_default,
    parse_json,
    parse_variant,
    render_json,
    replace_pattern,
    variant_field,
    variant_shape,
)
from granary.functions.udfs import batch_udf, bonus, register_batch_udf, register_sql_function
from granary.operators.nested import expand_struct, explode_array, flatten
from granary.operators.projection import (
    case_map,
    cast_columns,
    drop_empty_rows,
    drop_rows_with_null,
    equals_ignore_case,
    rename_columns,
    whole_number,
)
from granary.operators.views import sql_over, view_session
from granary.queries.registry import Tables, query

PRIORITY_LETTERS = {"1-URGENT": "U", "2-HIGH": "H"}


@query("SELECT c_custkey, c_name, c_acctbal, c_nationkey, c_mktsegment FROM customer")
def proj_select(t: Tables) -> DataFrame:
    customer = t("customer")
    return customer.select("c_custkey", F.col("c_name"), F.expr("c_acctbal"), customer.c_nationkey, customer["c_mktsegment"])


@query("SELECT CAST(c_custkey AS VARCHAR) AS key_text, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation_key FROM customer")
def proj_select_expr(t: Tables) -> DataFrame:
    return t("customer").selectExpr("cast(c_custkey as string) as key_text", "c_name as name", "cast(c_nationkey as bigint) as nation_key")


@query("""SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(floor(o_totalprice) AS BIGINT) AS whole_price,
                 TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level, TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number
          FROM orders""")
def proj_cast(t: Tables) -> DataFrame:
    orders = t("orders").select("o_orderkey", "o_custkey", whole_number("o_totalprice").alias("whole_price"),
                                F.substring("o_orderpriority", 1, 1).alias("level"), F.col("o_orderpriority").alias("not_a_number"))
    return cast_columns(orders, {"o_custkey": "string", "level": "int", "not_a_number": "int"})


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, l_extendedprice * CAST(0.2 AS DOUBLE) AS tax FROM lineitem")
def proj_tax(t: Tables) -> DataFrame:
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice").withColumn("tax", F.col("l_extendedprice") * F.lit(0.2))


@query("""SELECT o_orderkey, o_totalprice, o_totalprice * CAST(0.1 AS DOUBLE) AS discount, o_orderkey + 1 AS next_key,
                 lower(o_orderpriority) AS o_orderpriority FROM orders""")
def proj_with_columns(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", "o_totalprice", "o_orderpriority").withColumns({
        "discount": F.col("o_totalprice") * 0.1,
        "next_key": F.col("o_orderkey") + 1,
        "o_orderpriority": F.lower("o_orderpriority"),
    })


@query("""SELECT n_nationkey, n_name, 1 AS one, 'two' AS two, CAST(NULL AS VARCHAR) AS nothing, '2024-01-01 05:45' AS instant
          FROM nation""")
def proj_literals(t: Tables) -> DataFrame:
    instant = in_zone(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), "Asia/Kathmandu")
    return t("nation").select("n_nationkey", "n_name").withColumns({
        "one": F.lit(1), "two": F.lit("two"), "nothing": F.lit(None).cast("string"),
        "instant": F.date_format(instant, "yyyy-MM-dd HH:mm"),
    })


@query('SELECT c_custkey AS id, c_name AS "customer name", c_acctbal AS balance FROM customer')
def proj_rename(t: Tables) -> DataFrame:
    customer = t("customer").select("c_custkey", "c_name", "c_acctbal")
    return rename_columns(customer, {"c_custkey": "id", "c_name": "customer name", "c_acctbal": "balance"})


@query("SELECT p_partkey, p_name, p_brand, p_size FROM part")
def proj_drop(t: Tables) -> DataFrame:
    return t("part").drop("p_type", "p_retailprice")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def filter_numeric(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", "o_totalprice").where("o_totalprice > 250000")


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice * CAST(0.2 AS DOUBLE) AS tax FROM lineitem
          WHERE l_extendedprice * CAST(0.2 AS DOUBLE) > 10000""")
def filter_derived(t: Tables) -> DataFrame:
    taxed = t("lineitem").select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") * 0.2).alias("tax"))
    return taxed.where(F.col("tax") > 10000)


@query("""SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders
          WHERE (o_orderstatus = 'F' OR o_orderstatus = 'P') AND o_totalprice > 100000
            AND nullif(o_orderpriority, '5-LOW') IS NULL""")
def filter_compound(t: Tables) -> DataFrame:
    orders = t("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return orders.where(((F.col("o_orderstatus") == "F") | (F.col("o_orderstatus") == "P")) & (F.col("o_totalprice") > 100000)
                        & F.nullif("o_orderpriority", F.lit("5-LOW")).isNull())


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE lower(c_mktsegment) = lower('Machinery')")
def filter_ci(t: Tables) -> DataFrame:
    return t("customer").select("c_custkey", "c_name", "c_mktsegment").where(equals_ignore_case(F.col("c_mktsegment"), "Machinery"))


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'U' WHEN o_orderpriority = '2-HIGH' THEN 'H' END AS priority
          FROM orders""")
def case_when(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", case_map(F.col("o_orderpriority"), PRIORITY_LETTERS).alias("priority"))


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'U' WHEN o_orderpriority = '2-HIGH' THEN 'H' END AS priority
          FROM orders""")
def case_when_sql(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", F.expr("""
        case when o_orderpriority = '1-URGENT' then 'U' when o_orderpriority = '2-HIGH' then 'H' else null end as priority"""))


@query("SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '_', 'g') AS new_name FROM part")
def str_regexp_replace(t: Tables) -> DataFrame:
    return t("part").select("p_partkey", replace_pattern("p_name", "[aeiou]", "_").alias("new_name"))


@query("""SELECT c_custkey, CAST(c_nationkey AS VARCHAR) || '_' || c_mktsegment AS label,
                 CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment || '!' END AS with_null
          FROM customer""")
def str_concat(t: Tables) -> DataFrame:
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return t("customer").select("c_custkey", joined_text("c_nationkey", F.lit("_"), "c_mktsegment").alias("label"),
                                joined_text(segment, F.lit("!")).alias("with_null"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d') AS parsed, CAST(NULL AS VARCHAR) AS unparsed FROM orders""")
def date_parse(t: Tables) -> DataFrame:
    text = t("orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return text.select("o_orderkey", format_date(parse_date("day")).alias("parsed"),
                       format_date(parse_date(F.concat(F.lit("no date "), "day"))).alias("unparsed"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d') AS day, strftime(o_orderdate, '%Y') AS year FROM orders""")
def date_format(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", format_date("o_orderdate").alias("day"), year_text("o_orderdate").alias("year"))


@query("SELECT event_id, strftime(ts + INTERVAL 345 MINUTE, '%Y-%m-%d %H:%M:%S') AS local_time FROM events")
def date_zone(t: Tables) -> DataFrame:
    return t("events").select("event_id", format_date(in_zone("ts", "Asia/Kathmandu"), "yyyy-MM-dd HH:mm:ss").alias("local_time"))


@query("SELECT o_orderkey, 1 AS before_today, 1 AS before_now FROM orders")
def date_now(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", (F.to_date("o_orderdate") < F.current_date()).cast("int").alias("before_today"),
                              (F.col("o_orderdate") < F.current_timestamp()).cast("int").alias("before_now"))


@query("""SELECT o_orderkey, coalesce(CASE WHEN o_orderpriority = '1-URGENT' THEN 'U' WHEN o_orderpriority = '2-HIGH' THEN 'H' END, 'O')
          AS priority FROM orders""")
def null_coalesce(t: Tables) -> DataFrame:
    letters = t("orders").select("o_orderkey", case_map(F.col("o_orderpriority"), PRIORITY_LETTERS).alias("priority"))
    return letters.withColumn("priority", or_default("priority", "O"))


@query("""SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE o_orderpriority END AS priority
          FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""")
def na_drop_any(t: Tables) -> DataFrame:
    orders = t("orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise(F.nullif("o_orderpriority", F.lit("5-LOW"))).alias("priority"))
    return drop_rows_with_null(orders)


@query("""SELECT nullif(o_orderstatus, 'P') AS o_orderstatus, nullif(o_orderpriority, '5-LOW') AS priority
          FROM orders WHERE o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW'""")
def na_drop_all(t: Tables) -> DataFrame:
    orders = t("orders").select(F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
                                F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    return drop_empty_rows(orders)


@query("SELECT event_id, CAST(regexp_extract(props, '\"k\": *(-?[0-9]+)', 1) AS BIGINT) AS k FROM events")
def json_parse(t: Tables) -> DataFrame:
    parsed = t("events").select("event_id", parse_json("props", "k bigint").alias("parsed"))
    return expand_struct(parsed, "parsed")


@query("SELECT event_id, replace(props, ' ', '') AS unparsed FROM events")
def json_render(t: Tables) -> DataFrame:
    parsed = t("events").select("event_id", parse_json("props", "k bigint, missing string").alias("parsed"))
    return parsed.select("event_id", render_json("parsed").alias("unparsed"))


SHIPMENT_SCHEMA = ("shipment bigint, buyer struct<key bigint, segment string>, marks array<string>, "
                   "parcels array<struct<number int, part bigint, price double>>")


def shipment_documents(t: Tables) -> DataFrame:
    """JSON text of one document per order: its buyer, two marks and all its line items as parcels."""
    parcel = F.struct(F.col("l_linenumber").alias("number"), F.col("l_partkey").alias("part"), F.col("l_extendedprice").alias("price"))
    # an order has a handful of line items
    parcels = t("lineitem").groupBy("l_orderkey").agg(F.collect_list(parcel).alias("parcels"))
    orders = t("orders").join(parcels, F.col("o_orderkey") == F.col("l_orderkey"))
    buyers = t("customer").select("c_custkey", "c_mktsegment")
    whole = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    document = F.struct(F.col("o_orderkey").alias("shipment"),
                        F.struct(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment")).alias("buyer"),
                        F.array(F.col("o_orderstatus"), F.lower("o_orderpriority")).alias("marks"), "parcels")
    return whole.select(render_json(document).alias("value"))


@query("""SELECT o_orderkey AS shipment, c_custkey AS key, c_mktsegment AS segment, l_linenumber AS number, l_partkey AS part,
                 l_extendedprice AS price, CASE m.n WHEN 0 THEN o_orderstatus ELSE lower(o_orderpriority) END AS mark
          FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey, (VALUES (0), (1)) m(n)""")
def json_flatten(t: Tables) -> DataFrame:
    parsed = shipment_documents(t).select(parse_json("value", SHIPMENT_SCHEMA).alias("parsed"))
    return flatten(expand_struct(expand_struct(parsed, "parsed"), "buyer"), {"parcels": "parcel", "marks": "mark"})


@query("SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS component FROM embeddings")
def array_explode(t: Tables) -> DataFrame:
    exploded = explode_array(t("embeddings"), "embedding", "component")
    return exploded.withColumn("component", F.col("component").cast("double"))


@query("SELECT c_custkey, c_acctbal * CAST(0.2 AS DOUBLE) AS bonus FROM customer")
def udf_bonus(t: Tables) -> DataFrame:
    return t("customer").select("c_custkey", batch_udf(bonus, "double")("c_acctbal").alias("bonus"))


@query("SELECT c_custkey, c_acctbal * CAST(0.2 AS DOUBLE) AS bonus FROM customer")
def udf_sql_bonus(t: Tables) -> DataFrame:
    session = view_session(t.spark)
    register_batch_udf(session, "bonus", bonus, "double")
    return t.through(session)("customer").selectExpr("c_custkey", "bonus(c_acctbal) as bonus")


@query("SELECT c_custkey, c_acctbal * CAST(0.2 AS DOUBLE) AS bonus FROM customer")
def sql_function_bonus(t: Tables) -> DataFrame:
    """The bonus by a function that SQL text can call and that is an expression itself."""
    session = view_session(t.spark)
    register_sql_function(session, "fifth_of", "amount DOUBLE", "DOUBLE", "amount * 0.2D")
    return t.through(session)("customer").selectExpr("c_custkey", "fifth_of(c_acctbal) as bonus")


# events.props and other documents, of a shape that differs from row to row
MIXED_JSON = """CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN concat('[', user_id, ', "', event_type, '"]') WHEN 2 THEN concat('"', event_type, '"')
                WHEN 3 THEN concat('{"k": "', event_type, '", "who": {"user": ', user_id, '}}') WHEN 4 THEN concat('{"k": ', user_id) ELSE '[]' END"""


def _documents(t: Tables) -> DataFrame:
    return t("events").select("event_id", parse_variant(F.expr(MIXED_JSON)).alias("document"))


@query(f"""WITH d AS (SELECT event_id, {MIXED_JSON} AS p FROM events),
                v AS (SELECT event_id, CASE WHEN json_valid(p) THEN CAST(p AS JSON) END AS p FROM d)
           SELECT event_id, json_extract_string(p, '$.k') AS k, TRY_CAST(json_extract_string(p, '$.who.user') AS BIGINT) AS user_id,
                  json_extract_string(p, '$[1]') AS second, CASE json_type(p) WHEN 'VARCHAR' THEN 'STRING' ELSE json_type(p) END AS shape FROM v""")
def json_variant(t: Tables) -> DataFrame:
    return _documents(t).select("event_id", variant_field("document", "$.k", "string").alias("k"),
                                variant_field("document", "$.who.user", "bigint").alias("user_id"),
                                variant_field("document", "$[1]", "string").alias("second"), variant_shape("document").alias("shape"))


@query(f"""WITH d AS (SELECT event_id, {MIXED_JSON} AS p FROM events),
                v AS (SELECT event_id, CAST(p AS JSON) AS p FROM d WHERE json_valid(p)),
                o AS (SELECT event_id, p, unnest(json_keys(p)) AS key FROM v WHERE json_type(p) = 'OBJECT'),
                a AS (SELECT event_id, p, unnest(range(CAST(json_array_length(p) AS BIGINT))) AS pos FROM v WHERE json_type(p) = 'ARRAY')
           SELECT event_id, key, CASE WHEN json_type(p, '$.' || key) <> 'OBJECT' THEN json_extract_string(p, '$.' || key) END AS value FROM o
           UNION ALL SELECT event_id, NULL, json_extract_string(p, '$[' || pos || ']') FROM a""")
def json_variant_fields(t: Tables) -> DataFrame:
    """Each field and element of documents of any shape."""
    fields = explode_variant(_documents(t), "document")
    value = F.when(variant_shape("value") != "OBJECT", variant_field("value", "$", "string"))
    return fields.select("event_id", "key", value.alias("value"))


@query("SELECT c_custkey, c_acctbal * CAST(0.2 AS DOUBLE) AS bonus FROM customer")
def native_bonus(t: Tables) -> DataFrame:
    return t("customer").selectExpr("c_custkey", "c_acctbal * 0.2D as bonus")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def sql_filter(t: Tables) -> DataFrame:
    return sql_over("""
        select o_orderkey, o_custkey, o_totalprice from {orders}
        where o_orderstatus = :status and o_orderpriority = :priority
    """, {"status": "F", "priority": "1-URGENT"}, orders=t("orders"))


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y') AS order_year FROM orders""")
def sql_view_chain(t: Tables) -> DataFrame:
    session = view_session(t.spark)
    t.through(session)("orders").drop("o_orderpriority").createOrReplaceTempView("order_view")
    session.sql("select o.*, date_format(o_orderdate, 'yyyy') as order_year from order_view o").createOrReplaceTempView("order_year_view")
    return session.sql("select * from order_year_view").drop("o_orderdate")
