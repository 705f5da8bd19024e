import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from stratum.functions import in_months, json_payload, row_json, to_day, to_double, to_int, undeclared_fields

DAY = dt.date(2024, 3, 4)


def _one(spark, values, expression, column="v string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], column).select(expression).collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_dates(spark, ansi):
    values = [
        "2024-03-04",
        "2024-03-04T12:34:56.123456",
        "2024-03-04T23:30:00-05:00",
        "2024-03-04 01:02:03",
        "2024-3-4",
        "04/03/2024",
        "",
        "garbage",
        None,
    ]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert _one(spark, values, to_day(F.col("v"))) == [DAY] * 5 + [None] * 4
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_day_of_dates_and_timestamps(spark):
    assert _one(spark, [DAY], to_day(F.col("v")), "v date") == [DAY]
    assert _one(spark, [dt.datetime(2024, 3, 4, 23, 59)], to_day(F.col("v")), "v timestamp") == [DAY]
    assert _one(spark, [dt.datetime(2024, 3, 4, 23, 59)], to_day(F.col("v")), "v timestamp_ntz") == [DAY]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_ints(spark, ansi):
    values = ["3", "3.7", " 4 ", "-2.9", "+5", "3. ", "abc", "", "99999999999", "1e3", "..", "+", ".5x", None]
    values += [".5", "-.5", " .5 ", ".", "-.", "-0.9"]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert _one(spark, values, to_int(F.col("v"))) == [3, 3, 4, -2, 5, 3] + [None] * 8 + [0] * 6
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_ints_from_numbers(spark):
    assert _one(spark, [3.7, -2.9, 1e12, None], to_int(F.col("v"), from_text=False), "v double") == [3, -2, None, None]


def test_doubles(spark):
    values = ["1e3", "12.50", " 7 ", "abc", "12,5", "", None]
    assert _one(spark, values, to_double(F.col("v"))) == [1000.0, 12.5, 7.0] + [None] * 4


def test_json_payload(spark):
    schema = StructType([StructField("id", StringType()), StructField("n", IntegerType()), StructField("x", DoubleType())])
    values = ['{"id":"a","n":1,"x":2.5}', '{"id":"b","n":"many"}', '{"id":"c","other":9}', "not json", None]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    rows = frame.select(json_payload(F.col("v").cast("binary"), schema, "bad").alias("d")).select("d.*").collect()
    assert [tuple(r) for r in rows] == [
        ("a", 1, 2.5, None),
        ("b", None, None, '{"id":"b","n":"many"}'),
        ("c", None, None, None),
        (None, None, None, "not json"),
        (None, None, None, None),
    ]
    bare = frame.select(json_payload(F.col("v"), schema).alias("d")).select("d.*")
    assert bare.columns == ["id", "n", "x"]


def test_row_json_leaves_nulls_out(spark):
    rows = spark.createDataFrame([(1, None, dt.datetime(2024, 1, 1))], "a int, b string, c timestamp")
    assert rows.select(row_json()).first()[0] == '{"a":1,"c":"2024-01-01T00:00:00.000Z"}'
    assert rows.select(row_json(["a"])).first()[0] == '{"a":1}'


def test_in_months(spark):
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 12, 31), dt.date(2025, 1, 1), None]
    frame = spark.createDataFrame([(d,) for d in days], "d date")

    def kept(*months):
        return [r.d for r in frame.where(in_months(F.col("d"), months)).collect()]

    assert kept(dt.date(2024, 1, 1), dt.date(2024, 12, 1)) == days[1:3]
    assert kept(dt.date(2024, 12, 1), None) == [days[2], None]
    assert kept(None) == [None] and kept() == []


def test_fields_beside_those_read_are_found_whatever_their_text(spark):
    schema = StructType([StructField(n, StringType()) for n in ("a", "b")])
    # Repeated, escaped and nested fields must not hide another one.
    lines = [
        ('{"a":"x","b":"1:2"}', None),
        ('{"a":"x"}', None),
        ('{"a":null,"b":7}', None),
        ('{"a":{"c":"d:e"},"b":[{"f":1}]}', None),
        ("{}", None),
        ("", None),
        ("a:b", None),
        (None, None),
        ('{"a":"1:2","a":"x"}', None),
        ('{"a":"x","c":"y"}', {"c": "y"}),
        ('{"a":"\\u003a","c":"y"}', {"c": "y"}),
        ('{"a":"x:","A":null,"c:":"y"}', {"c:": "y"}),
        ('{"a":null,"c":"y"}', {"c": "y"}),
        ('{"a":{"b":"2"},"c":"y"}', {"c": "y"}),
        ('{"a":"1:2","a":"x","c":"y"}', {"c": "y"}),
    ]
    rows = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(lines)], "i int, v string")
    parsed = rows.select("i", "v", json_payload(F.col("v"), schema, "_corrupt_record").alias("data"))
    found = parsed.select("i", undeclared_fields(F.col("v"), schema, F.col("data")).alias("new"), undeclared_fields(F.col("v"), schema).alias("old"))
    for r in found.collect():
        assert r.new == r.old, lines[r.i]
        expected = lines[r.i][1]
        kept = {k: v for k, v in json.loads(r.new).items() if v is not None} if r.new else None
        assert kept == expected, lines[r.i]


def test_whole_numbers_without_a_pattern(spark):
    values = ["17", "17.0", "5.", "007.9", "2147483647", "2147483648", "1.2.3", "1.a", "a.1", "-1.5", " 3.0\t", ".5", ".", "", "٣", "1e3", None]
    expected = [17, 17, 5, 7, 2147483647, None, None, None, None, -1, 3, 0, 0, None, None, None, None]
    assert _one(spark, values, to_int(F.col("v"))) == expected
