import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from granary.functions.text import explode_variant, parse_variant, variant_field, variant_shape
from granary.functions.udfs import batch_udf, bonus, random_salt_udf, register_batch_udf, register_sql_function, shared_lookup_udf
from granary.operators.joins import unique_entries
from granary.operators.skew import spread
from granary.operators.views import sql_over, view_session
from granary.plans.inspect import plan_text
from granary.session import build_session, profile_session, scoped_conf, scratch_path
from tests.fixtures import rows


@pytest.fixture(scope="module")
def pay(spark):
    return spark.createDataFrame([(1, 100.0), (2, None), (3, 55.5)], "id int, salary double")


def test_bonus_forms_agree(spark, pay):
    expected = rows(pay.selectExpr("id", "salary * 0.2D as bonus"))
    typed = pay.select("id", batch_udf(bonus, "double")("salary").alias("bonus"))
    assert rows(typed) == expected and dict(typed.dtypes)["bonus"] == "double"
    session = view_session(spark)
    register_batch_udf(session, "bonus_of", bonus, "double")
    pay.createOrReplaceTempView("pay")
    try:
        session.sql("create or replace temp view pay as select * from values (1, 100.0D), (2, null), (3, 55.5D) as t(id, salary)")
        assert rows(session.sql("select id, bonus_of(salary) as bonus from pay")) == expected
    finally:
        spark.catalog.dropTempView("pay")
    assert "ArrowEvalPython" in plan_text(typed)


def test_shared_lookup(spark, pay):
    find = shared_lookup_udf(spark, {1: "one", 3: "three"})
    assert rows(pay.select("id", find("id"))) == [(1, "one"), (2, None), (3, "three")]
    keys = spark.createDataFrame([(None,), (1,)], "k int")
    assert rows(keys.select(find("k"))) == [(None,), ("one",)]


def test_random_salt_is_in_range_and_not_repeated(spark):
    salted = spark.range(2000).withColumn("salt", random_salt_udf(4)("id"))
    assert {row[0] for row in salted.select("salt").distinct().collect()} == {0, 1, 2, 3}
    # with a deterministic mark the salt could be drawn again beyond the join and miss its partner
    numbers = spark.range(4).selectExpr("cast(id as int) as salt")
    assert salted.join(numbers, "salt").count() == 2000
    assert salted.where(F.col("salt") < 0).count() == 0


def test_spread_is_in_range(spark):
    df = spark.range(0, 5000, 1, 8).select(spread(5, ["id"]).alias("p"), spread(1).alias("one"))
    assert rows(df.groupBy("p").count())[0][1] > 800
    assert {row[0] for row in df.select("p").distinct().collect()} == set(range(5))
    assert {row[0] for row in df.select("one").distinct().collect()} == {0}


def test_scoped_conf_restores(spark):
    name = "spark.sql.shuffle.partitions"
    with pytest.raises(RuntimeError):
        with scoped_conf(spark, {name: 3, "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB"}):
            assert spark.conf.get(name) == "3"
            raise RuntimeError
    assert spark.conf.get(name) == "8"


def test_profile_session_leaves_the_caller_alone(spark, data):
    spark.conf.set("spark.sql.shuffle.partitions", 7)
    try:
        sibling = profile_session(spark, {"spark.sql.autoBroadcastJoinThreshold": -1})
        assert sibling.conf.get("spark.sql.shuffle.partitions") == "7"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    joined = sibling.read.parquet(f"{data}/customer.parquet").join(
        sibling.read.parquet(f"{data}/nation.parquet"), F.col("c_nationkey") == F.col("n_nationkey"))
    assert "SortMergeJoin" in plan_text(joined)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"


def test_scratch_follows_the_cluster_setting(spark, monkeypatch):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{base}/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_scratch_refuses_a_machine_folder_on_a_cluster():
    class Conf:
        def get(self, name, default):
            return default

    class Context:
        master = "spark://somewhere:7077"

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Session(), "x")
    Context.master = "local[2]"
    assert "/x-" in scratch_path(Session(), "x")


def test_build_session_reuses_the_running_one(spark):
    assert build_session("other").sparkContext is spark.sparkContext


def test_views_are_private_and_values_bound(spark, pay):
    session = view_session(spark)
    session.range(3).createOrReplaceTempView("private_view")
    assert not spark.catalog.tableExists("private_view")
    assert session.sql("select count(*) as n from private_view").head()["n"] == 3
    text = "select id from {pay} where id = :id"
    assert rows(sql_over(text, {"id": 3}, pay=pay)) == [(3,)]
    assert rows(sql_over("select id from {pay} where cast(id as string) = :id", {"id": "3 or 1 = 1"}, pay=pay)) == []


def test_shared_lookup_of_large_keys_with_nulls(spark):
    find = shared_lookup_udf(spark, {2**53: "even", 2**53 + 2: "next"})
    df = spark.createDataFrame([(2**53,), (2**53 + 1,), (2**53 + 2,), (None,)], "k bigint").coalesce(1)
    assert dict(df.select("k", find("k").alias("v")).collect()) == {2**53: "even", 2**53 + 1: None, 2**53 + 2: "next", None: None}


def test_lookup_entries_listed_twice_raise(spark):
    table = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    with pytest.raises(Exception, match="duplicate lookup key"):
        unique_entries(table, "k").collect()
    assert dict(unique_entries(table.where("v <> 'b'"), "k").collect()) == {1: "a", 2: "c"}


def test_sql_function_belongs_to_its_session(spark):
    one, other = spark.newSession(), spark.newSession()
    register_sql_function(one, "doubled", "x INT, y INT DEFAULT 2", "INT", "x * y")
    assert one.sql("SELECT doubled(21), doubled(21, 3), doubled(null)").collect() == [(42, 63, None)]
    with pytest.raises(AnalysisException):
        other.sql("SELECT doubled(21)").collect()
    register_sql_function(one, "doubled", "x INT", "INT", "x + x + 1")
    assert one.sql("SELECT doubled(21)").head()[0] == 43


def test_variants_of_any_shape(spark):
    given = [(1, '{"a": 1, "b": {"c": [1, "x"]}}'), (2, '[1, null, "t"]'), (3, '"text"'), (4, "broken {"), (5, None), (6, "{}"), (7, "[]"), (8, "3.5")]
    df = spark.createDataFrame(given, "id int, p string").select("id", parse_variant("p").alias("v"))
    found = {row.id: tuple(row)[1:] for row in df.select("id", variant_shape("v"), variant_field("v", "$.a", "int"),
                                                          variant_field("v", "$.b.c[1]", "string"), variant_field("v", "$[2]", "string")).collect()}
    assert {i: row[0] for i, row in found.items()} == {1: "OBJECT", 2: "ARRAY", 3: "STRING", 4: None, 5: None, 6: "OBJECT", 7: "ARRAY", 8: "DECIMAL"}
    assert found[1][1:] == (1, "x", None) and found[2][1:] == (None, None, "t") and found[3][1:] == (None, None, None)
    fields = explode_variant(df, "v").select("id", "pos", "key", variant_field("value", "$", "string")).collect()
    assert sorted((r[0], r[1], r[2]) for r in fields) == [(1, 0, "a"), (1, 1, "b"), (2, 0, None), (2, 1, None), (2, 2, None)]
    assert [r[3] for r in sorted(fields, key=lambda r: (r[0], r[1]))[2:]] == ["1", None, "t"]
