import datetime as dt

import pytest
from pyspark.sql import functions as F

from granary.functions.dates import format_date, in_zone, parse_date, year_text
from granary.functions.text import joined_text, or_default, replace_pattern
from granary.operators.projection import (
    case_map,
    cast_columns,
    drop_empty_rows,
    drop_rows_with_null,
    equals_ignore_case,
    rename_columns,
    whole_number,
)
from granary.session import scoped_conf
from tests.fixtures import STAFF, STAFF_SCHEMA, rows


@pytest.fixture(scope="module")
def staff(spark):
    return spark.createDataFrame(STAFF, STAFF_SCHEMA)


def test_cast_lenient_and_strict(spark, staff):
    typed = cast_columns(staff, {"age": "int", "salary": "double"})
    assert dict(typed.dtypes)["age"] == "int"
    bad = spark.createDataFrame([("7",), ("seven",)], "n string")
    assert rows(cast_columns(bad, {"n": "int"})) == [(None,), (7,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_columns(bad, {"n": "int"}, strict=True).collect()


def test_numbers_as_text_order_as_text_until_cast(staff):
    as_text = [row[0] for row in staff.where("salary is not null").orderBy("salary").select("id").collect()]
    as_number = [row[0] for row in cast_columns(staff, {"salary": "double"}).where("salary is not null").orderBy("salary", "id")
                 .select("id").collect()]
    assert as_text[-1] == "a2" and as_number[0] == "a2"


def test_whole_number_rounds_down(spark):
    df = spark.createDataFrame([(2.7,), (-2.1,)], "x double")
    assert [row[0] for row in df.select(whole_number("x")).collect()] == [2, -3]


def test_rename(staff):
    renamed = rename_columns(staff, {"name": "full name"})
    assert "full name" in renamed.columns and renamed.select("`full name`").count() == 6
    with pytest.raises(ValueError):
        rename_columns(staff, {"nome": "x"})


def test_case_map_equals_sql(staff):
    ours = staff.select("id", case_map(F.col("gender"), {"Male": "M", "Female": "F"}).alias("g"))
    sql = staff.select("id", F.expr("case when gender = 'Male' then 'M' when gender = 'Female' then 'F' else null end as g"))
    assert rows(ours) == rows(sql)
    assert dict(rows(ours))["a3"] is None
    assert dict(rows(staff.select("id", case_map(F.col("gender"), {"Male": "M"}, "?"))))["a6"] == "?"


def test_missing_values(staff):
    assert [row[0] for row in rows(drop_rows_with_null(staff))] == ["a1", "a2", "a3"], "an empty string is not null"
    assert [row[0] for row in rows(drop_rows_with_null(staff, ["gender"]))] == ["a1", "a2", "a3", "a4", "a5"]
    assert drop_empty_rows(staff).count() == 6
    assert [row[0] for row in rows(drop_empty_rows(staff, ["dept", "salary"]))] == ["a1", "a2", "a3", "a4", "a6"]
    assert dict(rows(staff.select("id", or_default("gender", "O"))))["a6"] == "O"


def test_text_functions(staff):
    assert dict(rows(staff.select("id", replace_pattern("name", "J", "Z"))))["a1"] == "Zo Zensen"
    joined = dict(rows(staff.select("id", joined_text("dept", F.lit("_"), F.lit(7)))))
    assert joined["a1"] == "10_7" and joined["a5"] is None
    assert [row[0] for row in rows(staff.where(equals_ignore_case(F.col("gender"), "fEMALE")))] == ["a2", "a4"]
    assert staff.where(equals_ignore_case(F.col("gender"), "x') or ('a' = 'a")).count() == 0


def test_dates(spark, staff):
    dated = staff.select("id", parse_date("hired").alias("d"))
    assert dict(rows(dated))["a5"] == dt.date(2020, 2, 29)
    assert dict(dated.dtypes)["d"] == "date"
    bad = spark.createDataFrame([("2021-02-30",), ("soon",)], "d string")
    assert rows(bad.select(parse_date("d"))) == [(None,), (None,)]
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|CAST_INVALID_INPUT"):
        bad.select(parse_date("d", strict=True)).collect()
    formatted = dict((row[0], row[1:]) for row in rows(dated.select("id", format_date("d"), year_text("d"))))
    assert formatted["a1"] == ("2015/03/01", "2015") and formatted["a6"] == (None, None)


def test_zones_and_now(spark):
    one = spark.range(1)
    shown = one.select(format_date(in_zone(F.lit("2024-06-30 20:00:00").cast("timestamp"), "Asia/Ho_Chi_Minh"), "yyyy-MM-dd HH").alias("t"))
    assert shown.head()["t"] == "2024-07-01 03"
    with scoped_conf(spark, {"spark.sql.session.timeZone": "UTC"}):
        assert one.select(format_date(F.current_timestamp(), "z").alias("z")).head()["z"] == "UTC"
    now = one.select(F.current_date().alias("d"), F.current_timestamp().alias("t"), F.lit(dt.datetime.now(dt.UTC)).alias("l"))
    assert [kind for _, kind in now.dtypes] == ["date", "timestamp", "timestamp"]
    # one value for the whole query
    assert spark.range(1000).repartition(8).select(F.current_timestamp().alias("t")).distinct().count() == 1
