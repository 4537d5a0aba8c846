import glob
import os

import pytest
from pyspark.sql import functions as F

from granary.operators.layout import cluster, compact_partitions, curve_bits, file_bytes, file_stats, optimize_files, point_lookup, with_curve_key
from granary.plans.inspect import plan_text
from granary.sinks.files import write_with_blooms
from granary.sources.columnar import read_partitioned
from tests.fixtures import rows

STATUS = "o_orderstatus"


@pytest.fixture(scope="module")
def orders(spark, data):
    return spark.read.parquet(f"{data}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice", STATUS)


@pytest.fixture
def by_status(orders, tmp_path):
    path = str(tmp_path / "by-status")
    orders.repartition(12).write.partitionBy(STATUS).parquet(path)
    return path


def files(path, status):
    return set(glob.glob(f"{path}/{STATUS}={status}/*.parquet"))


def touched(spark, path, column):
    """Files whose range holds a value, on average over many values: what a point lookup would have to open."""
    stats = file_stats(spark.read.parquet(path), column).select("min_value", "max_value").collect()
    low, high = min(row[0] for row in stats), max(row[1] for row in stats)
    values = [low + (high - low) * i / 100 for i in range(101)]
    return sum(sum(row[0] <= value <= row[1] for row in stats) for value in values) / len(values)


def test_file_stats(spark, by_status):
    stats = file_stats(spark.read.parquet(by_status), "o_orderkey", STATUS)
    assert stats.columns == [STATUS, "file_name", "min_value", "max_value", "rows"]
    assert stats.agg(F.sum("rows")).head()[0] == spark.read.parquet(by_status).count()
    assert stats.count() == 36


def test_file_bytes(spark, by_status):
    real = sum(os.path.getsize(name) for name in files(by_status, "F"))
    assert file_bytes(spark, by_status, "o_orderstatus = 'F'") == real
    assert file_bytes(spark, by_status) > 2 * real
    assert file_bytes(spark, by_status, "o_orderstatus = 'none'") == 0


def test_compaction_of_one_partition_copies_the_others(spark, orders, by_status, tmp_path):
    before, target = {status: files(by_status, status) for status in "FOP"}, str(tmp_path / "target")
    assert optimize_files(spark, by_status, target, STATUS, where="o_orderstatus = 'F'") == 1
    assert len(files(target, "F")) == 1 and len(files(target, "O")) > 1
    assert {status: files(by_status, status) for status in "FOP"} == before
    assert rows(spark.read.parquet(by_status)) == rows(orders)
    assert rows(spark.read.parquet(target)) == rows(orders)


def test_compaction_to_a_file_size(spark, orders, by_status, tmp_path):
    bound, target = 40_000, str(tmp_path / "target")
    aimed = optimize_files(spark, by_status, target, STATUS, target_bytes=bound)
    made = [name for status in "FOP" for name in files(target, status)]
    assert 1 < aimed <= len(made) <= aimed + 3 < 36
    assert rows(spark.read.parquet(target)) == rows(orders)


def test_partition_values_stay_text(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    df = spark.createDataFrame([(1, "001"), (2, "1"), (3, "002"), (4, None)], "id int, dept string")
    df.write.partitionBy("dept").parquet(source)
    optimize_files(spark, source, target, "dept", where="dept = '001'")
    assert rows(read_partitioned(spark, target)) == rows(df)
    assert dict(read_partitioned(spark, target).dtypes)["dept"] == "string"
    assert dict(read_partitioned(spark, target, "id int, dept int").dtypes)["dept"] == "int"


def test_file_names_do_not_matter(spark, tmp_path):
    source = tmp_path / "source"
    spark.range(1000).write.parquet(str(source))
    for file in source.glob("*.parquet"):
        file.rename(file.with_suffix(".data"))
    assert file_bytes(spark, str(source)) == sum(file.stat().st_size for file in source.glob("*.data"))


def test_filters_that_would_lose_rows_are_refused(spark, orders, by_status, tmp_path):
    with pytest.raises(ValueError, match="o_custkey"):
        optimize_files(spark, by_status, str(tmp_path / "y"), STATUS, where="o_orderstatus = 'F' and o_custkey > 10")
    plain = str(tmp_path / "plain")
    orders.write.parquet(plain)
    with pytest.raises(ValueError):
        optimize_files(spark, plain, str(tmp_path / "x"), where="o_custkey > 10")
    assert rows(spark.read.parquet(by_status)) == rows(orders)


def test_one_column_gives_disjoint_files(spark, orders, by_status, tmp_path):
    target = str(tmp_path / "target")
    optimize_files(spark, by_status, target, STATUS, where="o_orderstatus = 'F'", target_bytes=20_000, cluster_by="o_custkey")
    stats = file_stats(spark.read.parquet(target).where("o_orderstatus = 'F'"), "o_custkey").orderBy("min_value").collect()
    assert len(stats) > 3
    assert all(one["max_value"] <= other["min_value"] for one, other in zip(stats, stats[1:]))
    assert rows(spark.read.parquet(target)) == rows(orders)


def test_two_columns_narrow_both(spark, orders, tmp_path):
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    orders.repartition(16).write.parquet(plain)
    cluster(spark.read.parquet(plain), ["o_custkey", "o_totalprice"], 16, bits=4).write.parquet(clustered)
    for column in ("o_custkey", "o_totalprice"):
        assert touched(spark, plain, column) > 14
        assert touched(spark, clustered, column) < 8
    assert rows(spark.read.parquet(clustered)) == rows(orders)


def test_curve_key_orders_each_column(spark):
    df = spark.range(256).select((F.col("id") % 16).alias("a"), F.expr("id div 16").alias("b"))
    keyed = with_curve_key(df, ["a", "b"], 4, "z")
    assert keyed.columns == ["a", "b", "z"]
    found = {(row["a"], row["b"]): row["z"] for row in keyed.collect()}
    assert len(set(found.values())) > 150
    for fixed in range(16):
        for values in ([found[(i, fixed)] for i in range(16)], [found[(fixed, i)] for i in range(16)]):
            assert values == sorted(values), "the key rises with each column alone"
    with pytest.raises(ValueError):
        with_curve_key(df, ["a", "b"], bits=32)
    assert [curve_bits(files, 2) for files in (1, 16, 1000, 10**6)] == [4, 5, 8, 13]


def test_curve_key_of_text_dates_and_nulls(spark):
    df = spark.createDataFrame([("alpha", "2020-01-01"), ("beta", "2021-01-01"), (None, None), ("zeta", "2022-01-01")], "t string, d string")
    df = df.select("t", F.to_date("d").alias("d"), F.to_timestamp("d").alias("s"))
    keys = dict(with_curve_key(df, ["t"], 4, "z").select("t", "z").collect())
    assert keys[None] <= keys["alpha"] < keys["beta"] < keys["zeta"]
    for column in ("d", "s"):
        ordered = [row[0] for row in with_curve_key(df, [column], 4, "z").orderBy(column).select("z").collect()]
        assert ordered == sorted(ordered)
    with pytest.raises(ValueError):
        with_curve_key(spark.createDataFrame([([1],)], "x array<int>"), ["x"])


def test_long_common_beginnings_and_large_ids_are_told_apart(spark):
    df = spark.range(20_000).select(F.concat(F.lit("https://example.org/page/"), F.lpad("id", 6, "0")).alias("url"),
                                    (F.col("id") + 2**60).alias("big"), "id")
    for column in ("url", "big"):
        keyed = with_curve_key(df, [column, "id"], 4, "z")
        assert keyed.select("z").distinct().count() >= 16
        single = with_curve_key(df, [column], 6, "z").groupBy("z").count().collect()
        assert len(single) > 48 and max(row["count"] for row in single) < 1000


def test_heavy_value_is_cut_into_several_files(spark, tmp_path):
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    # a third of all rows are copies of one row
    spark.range(9000).selectExpr("if(id % 3 = 0, 5, id) as a", "if(id % 3 = 0, 5, id % 100) as b").write.parquet(plain)
    for columns in ("a", ["a", "b"]):
        target = f"{clustered}-{len(columns)}"
        optimize_files(spark, plain, target, target_bytes=4_000, cluster_by=columns)
        df = spark.read.parquet(target)
        holding = file_stats(df.where("a = 5"), "a").select("rows").collect()
        assert len(holding) > 2 and max(row[0] for row in holding) < 2500
        assert rows(df) == rows(spark.read.parquet(plain))


def test_well_packed_rows_are_cut_by_what_a_task_takes(spark, tmp_path):
    """400 MB of rows that pack to a few: a task that writes a file takes the rows, not the packed bytes."""
    plain = str(tmp_path / "plain")
    spark.range(4000).selectExpr("id", "id % 50 as k", "repeat('x', 100000) as v").repartition(8).write.parquet(plain)
    assert file_bytes(spark, plain) < 100 * 1024 * 1024
    for columns in (["id"], ["id", "k"]):
        target = str(tmp_path / f"clustered-{len(columns)}")
        assert optimize_files(spark, plain, target, cluster_by=columns) == 3
        found = file_stats(spark.read.parquet(target), "id").collect()
        assert len(found) == 3 and max(row["rows"] for row in found) < 2000 and sum(row["rows"] for row in found) == 4000
        assert spark.read.parquet(target).where("length(v) = 100000").select("id").distinct().count() == 4000
    assert optimize_files(spark, plain, str(tmp_path / "large"), cluster_by="id", task_bytes=2**30) == 1


def test_empty_table(spark, orders, tmp_path):
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    orders.limit(0).write.parquet(plain)
    optimize_files(spark, plain, clustered, cluster_by=["o_custkey", "o_totalprice"])
    assert spark.read.parquet(clustered).count() == 0


def test_point_lookup_prunes(spark, orders, by_status):
    found = point_lookup(spark, by_status, {STATUS: "F", "o_custkey": 77})
    assert rows(found) == rows(orders.where("o_orderstatus = 'F' and o_custkey = 77"))
    text = plan_text(found, "formatted")
    assert "PartitionFilters: [isnotnull(o_orderstatus" in text
    assert "PushedFilters: [IsNotNull(o_custkey), EqualTo(o_custkey,77)]" in text


def test_well_packed_partitions_are_cut_by_what_a_task_takes(spark, tmp_path):
    """Two partitions of 200 MB of rows each, compacted as files and as a catalog table, and looked up after it."""
    plain, target = str(tmp_path / "plain"), str(tmp_path / "target")
    df = spark.range(4000).selectExpr("id", "repeat('x', 100000) as v", "if(id % 2 = 0, 'even', 'odd') as d").repartition(8)
    df.write.partitionBy("d").option("path", plain).saveAsTable("well_packed")
    assert optimize_files(spark, plain, target, "d", cluster_by="id") == 3
    assert max(row["rows"] for row in file_stats(read_partitioned(spark, target), "id", "d").collect()) < 2000
    found = point_lookup(spark, target, {"d": "odd", "id": 1777})
    assert found.selectExpr("id", "length(v)", "d").collect() == [(1777, 100000, "odd")]
    for columns in ("id", ()):
        compact_partitions(spark, "well_packed", f"{target}-{len(columns)}", "d = 'odd'", cluster_by=columns)
        odd = spark.table("well_packed").where("d = 'odd'")
        made = [row["rows"] for row in file_stats(odd, "id").collect()]
        assert len(made) == 2 and sum(made) == 2000 and max(made) < 1500
        assert odd.where("length(v) = 100000").select("id").distinct().count() == 2000
    assert spark.table("well_packed").select("id").distinct().count() == 4000
    spark.sql("DROP TABLE well_packed")


def stats(path):
    """Name, size, time and inode of every file, to tell whether it was written anew."""
    return {name: (os.stat(name).st_size, os.stat(name).st_mtime_ns, os.stat(name).st_ino)
            for name in glob.glob(f"{path}/**/*.parquet", recursive=True)}


@pytest.fixture
def located(spark, tmp_path):
    """A catalog table of small files with partition values that are hard to write down."""
    name, path = f"located_{os.path.basename(tmp_path).replace('-', '_')}", str(tmp_path / "table")
    df = spark.range(2_000).select("id", F.expr("id % 7").alias("v"),
                                   F.expr("element_at(array('001', '1', null, \"it's a b/ü\\\\\", '2020-01-01'), cast(id % 5 + 1 as int))").alias("d"))
    df.repartition(6).write.partitionBy("d").option("path", path).saveAsTable(name)
    yield name, path, rows(df.select("id", "v", "d"))
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("where", ["d = '001'", "d is null", "d like 'it%'", "d in ('1', '2020-01-01')"])
def test_compaction_leaves_other_partitions_alone(spark, located, tmp_path, where):
    name, path, expected = located
    before, target = stats(path), str(tmp_path / "new")
    chosen = spark.table(name).where(where)
    old, asked = set(chosen.inputFiles()), len(set(chosen.select("d").distinct().collect()))
    kept = set(spark.table(name).inputFiles()) - old
    assert compact_partitions(spark, name, target, where) == asked
    # not a file of the old table is gone or changed, and all new ones are of the partitions asked for
    assert stats(path) == before
    now = spark.table(name).where(where).inputFiles()
    assert len(now) < len(old) and all("/new/" in file for file in now)
    assert set(spark.table(name).inputFiles()) - set(now) == kept
    assert len(stats(target)) == len(now)
    assert rows(spark.table(name).select("id", "v", "d")) == expected


def test_compaction_reads_the_chosen_partitions_only(spark, located, tmp_path):
    """Files of another partition are no parquet files any more, which a read of them would notice."""
    name, path, expected = located
    for file in glob.glob(f"{path}/d=1/*.parquet"):
        with open(file, "wb") as out:
            out.write(b"not parquet")
    assert compact_partitions(spark, name, str(tmp_path / "new"), "d = '001'", cluster_by="id") == 1
    found = rows(spark.table(name).where("d = '001'").select("id", "v", "d"))
    assert found == [row for row in expected if row[2] == "001"]


def test_compaction_of_partitions_refuses_and_repeats(spark, located, tmp_path):
    name, path, expected = located
    with pytest.raises(ValueError):
        compact_partitions(spark, name, str(tmp_path / "x"), "v = 3")
    assert compact_partitions(spark, name, str(tmp_path / "none"), "d = 'absent'") == 0
    assert compact_partitions(spark, name, str(tmp_path / "all"), target_bytes=4_000) == 5
    assert compact_partitions(spark, name, str(tmp_path / "again"), "d is null") == 1
    assert rows(spark.table(name).select("id", "v", "d")) == expected
    spark.range(3).write.saveAsTable("unpartitioned_located")
    with pytest.raises(ValueError):
        compact_partitions(spark, "unpartitioned_located", str(tmp_path / "y"))
    spark.sql("DROP TABLE unpartitioned_located")


def scanned(df):
    """Rows and files that the scans of a finished query read."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    metrics = [leaves.apply(i).metrics() for i in range(leaves.size())]
    return [sum(m.apply(name).value() for m in metrics if m.contains(name)) for name in ("numOutputRows", "numFiles")]


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    ids = spark.range(0, 40_000, 2).select(F.xxhash64("id").alias("key"), "id")
    write_with_blooms(ids.repartition(8), str(tmp_path / "blooms"), {"key": 5_000})
    ids.repartition(8).write.option("parquet.enable.dictionary", "false").parquet(str(tmp_path / "plain"))
    low, high = ids.agg(F.min("key"), F.max("key")).head()
    present = [row.key for row in ids.limit(5).collect()]
    for key in (present[0], present[3]):
        found = point_lookup(spark, str(tmp_path / "blooms"), {"key": key})
        assert scanned(found)[0] <= 3 * 2_500 and found.count() == 1
    absent = [key for key in range(low // 2, low // 2 + 5)]
    for key in absent:
        assert low < key < high
        assert scanned(point_lookup(spark, str(tmp_path / "blooms"), {"key": key}))[0] == 0
        assert scanned(point_lookup(spark, str(tmp_path / "plain"), {"key": key}))[0] == 20_000
    assert rows(spark.read.parquet(str(tmp_path / "blooms"))) == rows(ids)
