import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.text import parse_json, render_json
from granary.operators.nested import expand_struct, flatten
from granary.plans.inspect import plan_text
from granary.sources.columnar import read_nested, read_orc, read_parquet, with_source_file
from granary.sources.delimited import count_rows, mark_bad, read_csv, read_csv_plain, split_bad
from granary.sources.documents import read_json, read_json_document, read_lines
from granary.sources.rows import rows_table, sequence_table
from tests.fixtures import (
    SHIPMENT_LINE,
    SHIPMENT_PRETTY,
    PEOPLE_FIELDS,
    PEOPLE_HEADER,
    PEOPLE_LINES,
    STAFF,
    STAFF_SCHEMA,
    rows,
    write_lines,
)

SHIPMENT_TYPES = ("buyer struct<key bigint, segment string>, marks array<bigint>, "
                  "parcels array<struct<number bigint, part bigint, price double>>, shipment bigint")


@pytest.fixture
def people(tmp_path):
    return write_lines(tmp_path / "people", [PEOPLE_HEADER, *PEOPLE_LINES])


@pytest.fixture
def clean_people(tmp_path):
    return write_lines(tmp_path / "clean", [PEOPLE_HEADER, *PEOPLE_LINES[:2], PEOPLE_LINES[3]])


def test_rows_with_ddl_and_struct_type(spark):
    by_ddl = rows_table(spark, STAFF, STAFF_SCHEMA)
    by_type = rows_table(spark, STAFF, T.StructType.fromDDL(STAFF_SCHEMA))
    assert by_ddl.schema == by_type.schema
    assert rows(by_ddl) == rows(by_type)
    assert all(field.nullable for field in by_ddl.schema)


def test_rows_of_wrong_type_raise(spark):
    with pytest.raises(Exception, match="(?i)type"):
        rows_table(spark, [("1",)], "id int").collect()


def test_sequence(spark):
    assert rows(sequence_table(spark, 4, 12, 2)) == [(10,), (4,), (6,), (8,)]
    assert sequence_table(spark, 0, 3, name="n").schema.simpleString() == "struct<n:bigint>"


def test_csv_inference(spark, clean_people, people):
    inferred = read_csv(spark, clean_people)
    assert inferred.schema.simpleString() == "struct<id:int,dept:int,name:string,age:int,gender:string,salary:double,hired:date>"
    # one odd value turns the whole column into text
    assert dict(read_csv(spark, people).dtypes)["salary"] == "string"


def test_csv_declared_schema(spark, clean_people):
    df = read_csv(spark, clean_people, PEOPLE_FIELDS)
    assert rows(df)[1] == (2, 10, "Jobs, Ann", 24, "Female", 9000.5, dt.date(2016, 7, 15))


def test_csv_permissive_keeps_good_fields_and_the_line(spark, people):
    df = read_csv(spark, people, PEOPLE_FIELDS, bad_column="bad_record")
    by_id = {row["id"]: row for row in df.collect()}
    assert len(by_id) == 5
    assert (by_id[3]["salary"], by_id[3]["age"], by_id[3]["bad_record"]) == (None, 45, PEOPLE_LINES[2])
    assert (by_id[5]["hired"], by_id[5]["salary"], by_id[5]["bad_record"]) == (None, 48000.0, PEOPLE_LINES[4])
    assert [by_id[i]["bad_record"] for i in (1, 2, 4)] == [None] * 3


def test_split_bad_adds_up(spark, people):
    good, bad = split_bad(read_csv(spark, people, PEOPLE_FIELDS, bad_column="bad_record"), "bad_record")
    assert [row[0] for row in rows(good)] == [1, 2, 4]
    assert [row[0] for row in rows(bad)] == [3, 5]
    assert "bad_record" not in good.columns
    # the same halves whatever is asked of them
    assert (good.count(), bad.count()) == (3, 2)
    assert [row[0] for row in rows(good.select("id"))] == [1, 2, 4]
    assert [row[0] for row in rows(bad.select("id"))] == [3, 5]
    assert rows(bad.select("bad_record")) == [(PEOPLE_LINES[2],), (PEOPLE_LINES[4],)]
    marked = mark_bad(read_csv(spark, people, PEOPLE_FIELDS, bad_column="bad_record"), "bad_record")
    assert rows(marked.select("id", "is_bad")) == [(1, False), (2, False), (3, True), (4, False), (5, True)]
    assert plan_text(marked.select("id", "is_bad")).count("FileScan") == 1


def test_csv_drop_malformed(spark, people):
    df = read_csv(spark, people, PEOPLE_FIELDS, mode="DROPMALFORMED")
    assert [row[0] for row in rows(df)] == [1, 2, 4]
    assert df.count() == 5, "a bare count parses no column and sees no bad field"
    assert count_rows(df) == 3
    cached = df.persist()
    assert cached.count() == 3
    cached.unpersist()


def test_csv_fail_fast_raises_at_the_action(spark, people):
    df = read_csv(spark, people, PEOPLE_FIELDS, mode="FAILFAST")
    with pytest.raises(Exception, match="(?i)malformed"):
        df.collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        count_rows(df)


def test_csv_options_and_checks(spark, clean_people):
    df = read_csv(spark, clean_people, PEOPLE_FIELDS, options={"nullValue": "Male"})
    assert {row["gender"] for row in df.collect()} == {None, "Female"}
    with pytest.raises(ValueError):
        read_csv(spark, clean_people, PEOPLE_FIELDS, mode="LENIENT")
    with pytest.raises(ValueError):
        read_csv(spark, clean_people, PEOPLE_FIELDS, mode="FAILFAST", bad_column="bad")


def test_csv_plain_has_the_header_as_a_row(spark, clean_people):
    df = read_csv_plain(spark, clean_people)
    assert df.columns == [f"_c{i}" for i in range(7)]
    assert df.count() == 4
    assert ("id", "dept") in [tuple(row)[:2] for row in df.collect()]


def test_parquet_and_orc_globs(spark, tmp_path):
    df = rows_table(spark, STAFF, STAFF_SCHEMA).repartition(3)
    df.write.parquet(str(tmp_path / "p"))
    df.write.orc(str(tmp_path / "o"))
    assert rows(read_parquet(spark, f"{tmp_path}/p/*.parquet")) == rows(read_orc(spark, f"{tmp_path}/o/*.orc")) == rows(df)


def test_nested_directories(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "n/one"))
    spark.range(3, 7).write.parquet(str(tmp_path / "n/one/kind=two"))
    df = read_nested(spark, str(tmp_path / "n"))
    assert df.columns == ["id"]
    assert sorted(row[0] for row in df.collect()) == list(range(7))


def test_json_lines_inferred(spark, tmp_path):
    df = read_json(spark, write_lines(tmp_path / "j", [SHIPMENT_LINE]))
    assert df.schema == T.StructType.fromDDL(SHIPMENT_TYPES)


def test_json_document_over_many_lines(spark, tmp_path):
    path = write_lines(tmp_path / "j", [SHIPMENT_PRETTY])
    single = read_json(spark, write_lines(tmp_path / "s", [SHIPMENT_LINE]))
    assert rows(read_json_document(spark, path)) == rows(single)


def test_json_declared_subset_and_override(spark, tmp_path):
    path = write_lines(tmp_path / "j", [SHIPMENT_LINE])
    assert read_json(spark, path, "shipment string, marks array<int>").head() == ("5", [7, 8])
    assert read_json(spark, path, "marks array<string>").head()[0] == ["7", "8"]


def test_lines_parsed_rendered_and_flattened(spark, tmp_path):
    lines = read_lines(spark, write_lines(tmp_path / "t", [SHIPMENT_LINE, "not json"]))
    assert lines.columns == ["value"]
    parsed = lines.withColumn("parsed", parse_json("value", SHIPMENT_TYPES.replace("marks array<bigint>", "marks array<string>")))
    assert parsed.where("value = 'not json'").head()["parsed"].shipment is None
    kept = parsed.where("value <> 'not json'")
    assert kept.select(render_json("parsed").alias("j")).head()["j"].startswith('{"buyer":{"key":12,"segment":"AUTO"},"marks":["7","8"]')
    flat = flatten(expand_struct(kept.select("parsed"), "parsed").select("shipment", "parcels", "marks"), {"parcels": "parcel", "marks": "mark"})
    assert flat.columns == ["shipment", "number", "part", "price", "mark"]
    assert rows(flat) == [(5, 1, 31, 2.5, "7"), (5, 1, 31, 2.5, "8"), (5, 2, 44, 90.0, "7"), (5, 2, 44, 90.0, "8")]


def test_null_and_empty_arrays_drop_their_row(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "id int, xs array<int>")
    assert rows(df.select("id", F.explode("xs").alias("x"))) == [(1, 1), (1, 2)]


def test_source_file(spark, data):
    df = with_source_file(spark.read.parquet(f"{data}/nation.parquet"))
    assert [row[0] for row in df.select("file_name").distinct().collect()] == ["nation.parquet"]


def test_catalog_table_unknown(spark):
    from granary.sources.columnar import read_table

    with pytest.raises(AnalysisException):
        read_table(spark, "no_such_table").collect()


def test_scan_reads_only_what_is_asked(spark, data):
    df = spark.read.parquet(f"{data}/lineitem.parquet").select("l_orderkey").agg(F.count("l_orderkey"))
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan_text(df)
