import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from stratum.operators import (
    Summary,
    apply_types,
    decode_value,
    encode_value,
    enrich_lineage,
    latest_by_aggregate,
    latest_per_key,
    refresh_summary,
    split_null_keys,
    stamp_date,
    summarize,
    upsert_frames,
)
from stratum.plans import daily_sales


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# lineage


def test_lineage_of_messages(spark):
    rows = enrich_lineage(spark.createDataFrame([("one",), ("two",)], "value string"), "kafka")
    assert rows.columns == ["value", "ingest_timestamp", "source_system", "source_file"]
    assert dict(rows.dtypes)["source_file"] == "string"
    first = rows.first()
    assert first.source_system == "kafka" and first.source_file is None and first.ingest_timestamp is not None
    assert rows.select("ingest_timestamp").distinct().count() == 1


def test_lineage_of_files(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    rows = enrich_lineage(spark.read.parquet(str(tmp_path / "in")), "file").collect()
    assert {r.source_system for r in rows} == {"file"}
    assert all(r.source_file.startswith("file:") and r.source_file.endswith(".parquet") for r in rows)
    named = enrich_lineage(spark.read.parquet(str(tmp_path / "in")), "erp", file_metadata=True).first()
    assert named.source_system == "erp" and named.source_file


def test_lineage_of_files_needs_files(spark):
    with pytest.raises(ValueError, match="reads files"):
        enrich_lineage(spark.range(1), "file")


# payloads

MESSAGE = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"


def _messages(spark, *values):
    at = dt.datetime(2024, 1, 1)
    rows = [(b"k", v, "t", 0, i, at, 0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE)


def test_decode_without_schema(spark):
    rows = decode_value(_messages(spark, b"abc", None))
    assert rows.dtypes == [("value", "string")]
    assert [r.value for r in rows.collect()] == ["abc", None]


def test_decode_with_schema(spark):
    schema = StructType([StructField("timestamp", StringType()), StructField("n", IntegerType())])
    messages = _messages(spark, b'{"timestamp":"x","n":1,"more":2}', b"oops", None)
    rows = decode_value(messages, schema)
    assert rows.columns == ["timestamp", "n", "_corrupt_record"]
    assert [tuple(r) for r in rows.collect()] == [("x", 1, None), (None, None, "oops"), (None, None, None)]
    assert decode_value(messages, schema, corrupt_column=None).columns == ["timestamp", "n"]
    kept = decode_value(messages, schema, keep_source_columns=True)
    assert kept.columns == ["timestamp", "n", "_corrupt_record", "message"]
    assert [r.message.offset for r in kept.collect()] == [0, 1, 2]


def test_encode_decode_round_trip(spark):
    rows = spark.createDataFrame([("a", 1), ("b", None)], "id string, n int")
    assert decode_value(encode_value(rows), rows.schema, corrupt_column=None).collect() == rows.collect()


# types and rejects


def test_apply_types_replaces_in_place(spark):
    raw = spark.createDataFrame([("a", "2024-03-04T10:00:00", "1.5", "2.0", "7")], "id string, d string, p string, q string, n string")
    typed = stamp_date(apply_types(raw, {"d": "date", "p": "double", "q": "int", "n": "bigint"}))
    assert typed.dtypes == [
        ("id", "string"), ("d", "date"), ("p", "double"), ("q", "int"), ("n", "bigint"), ("ingest_date", "date"),
    ]
    assert tuple(typed.first())[:5] == ("a", dt.date(2024, 3, 4), 1.5, 2, 7)
    assert apply_types(raw, {}).columns == raw.columns


def test_split_null_keys(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (2, None), (None, None)], "k int, l string")
    keyed, rejects = split_null_keys(rows, ["k", "l"])
    assert _sorted(keyed) == [(1, "a")] and rejects.count() == 3


# latest per key

SALES = "order_id string, quantity int, ingest_timestamp timestamp, source_file string"


def test_latest_by_time_then_tie_breakers(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = [
        ("a", 9, t1, "f9"), ("a", 1, t2, "f1"), ("a", 2, t2, "f1"), ("a", 5, t2, "f0"),
        ("b", 3, t1, "f1"), ("b", 4, None, "f9"), ("c", None, t1, None), ("c", 0, t1, None),
    ]
    expected = [("a", 2, t2, "f1"), ("b", 3, t1, "f1"), ("c", 0, t1, None)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, SALES).repartition(seed + 1)
        assert _sorted(latest_per_key(df, ["order_id"], ["ingest_timestamp"])) == expected
        assert _sorted(latest_by_aggregate(df, ["order_id"], ["ingest_timestamp"])) == expected


def test_both_forms_of_latest_agree(spark, plan):
    rng = random.Random(8)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, 1.5, float("nan"), -0.0, 0.0]), rng.choice([None, "x", "y"]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "`k.1` int, t double, `0` string, row int").repartition(4)
    by_rank, by_aggregate = (f(df, ["k.1"], ["t"], ["0", "row"]) for f in (latest_per_key, latest_by_aggregate))
    assert by_rank.columns == by_aggregate.columns == df.columns
    assert sorted(map(repr, by_rank.collect())) == sorted(map(repr, by_aggregate.collect()))
    text = plan(latest_by_aggregate(spark.range(100).selectExpr("id % 3 as k", "id as t"), ["k"], ["t"]))
    assert "partial_max_by" in text and text.count("Exchange") == 1
    maps = spark.sql("select 1 as k, 1 as t, map('a', 1) as m union all select 1, 2, map('b', 2)")
    assert latest_by_aggregate(maps, ["k"], ["t"]).first().m == {"b": 2}


def test_latest_ignores_columns_without_an_order(spark):
    df = spark.sql("select 1 as k, 1 as t, map('a', 1) as m union all select 1, 2, map('b', 2)")
    assert latest_per_key(df, ["k"], ["t"]).first().t == 2


def test_latest_limits_groups_before_the_shuffle(spark, plan):
    df = spark.range(100).selectExpr("id % 3 as k", "id as t")
    text = plan(latest_per_key(df, ["k"], ["t"]))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    assert text.count("Exchange") == 1


# upsert


def _pairs(spark, rows):
    return spark.createDataFrame(rows, "k int, l string, v int")


def test_upsert_replaces_inserts_and_keeps(spark):
    target = _pairs(spark, [(1, "a", 1), (1, "b", 1), (2, "a", 1)])
    source = _pairs(spark, [(1, "b", 2), (3, "a", 2)])
    assert _sorted(upsert_frames(target, source, ["k", "l"])) == [(1, "a", 1), (1, "b", 2), (2, "a", 1), (3, "a", 2)]


def test_upsert_null_keys_match_nothing(spark):
    target = _pairs(spark, [(None, "a", 1), (1, None, 1)])
    source = _pairs(spark, [(None, "a", 2), (1, None, 2)])
    assert upsert_frames(target, source, ["k", "l"]).count() == 4


def test_upsert_source_must_be_unique_where_it_matches(spark):
    target = _pairs(spark, [(1, "a", 1)])
    twice = _pairs(spark, [(1, "a", 2), (1, "a", 3)])
    with pytest.raises(Exception, match="several source rows"):
        upsert_frames(target, twice, ["k", "l"]).collect()
    elsewhere = _pairs(spark, [(2, "a", 2), (2, "a", 3)])
    assert upsert_frames(target, elsewhere, ["k", "l"]).count() == 3


_ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 99)), max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=_ROWS, source=_ROWS)
def test_upsert_against_a_dict(spark, target, source):
    source = list({k: (k, v) for k, v in source if k is not None}.values()) + [r for r in source if r[0] is None]
    target = list({k: (k, v) for k, v in target if k is not None}.values()) + [r for r in target if r[0] is None]
    current = {k: v for k, v in target if k is not None} | {k: v for k, v in source if k is not None}
    expected = list(current.items()) + [r for r in target + source if r[0] is None]
    frame = upsert_frames(
        spark.createDataFrame(target, "k int, v int"), spark.createDataFrame(source, "k int, v int"), ["k"]
    )
    assert _sorted(frame) == sorted(expected, key=repr)


# sums


def _silver(spark, rows):
    return spark.createDataFrame(rows, "order_id string, order_date date, region string, quantity int, price double")


D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


def test_daily_sales_nulls(spark):
    rows = [
        ("a", D1, "ES", None, 2.0), ("b", D1, "ES", None, 3.0),
        ("c", D1, "FR", 2, 5.0), ("d", D1, "FR", 3, None),
        ("e", D1, None, 1, 1.0), ("f", None, "ES", 4, 0.5),
    ]
    sums = summarize(_silver(spark, rows), daily_sales())
    assert sums.dtypes == [
        ("order_day", "date"), ("region", "string"), ("total_revenue", "double"), ("total_units", "bigint"),
    ]
    assert set(map(tuple, sums.collect())) == {
        (D1, "ES", None, None), (D1, "FR", 10.0, 5), (D1, None, 1.0, 1), (None, "ES", 2.0, 4),
    }


def test_refresh_equals_recompute(spark):
    old = [("a", D1, "ES", 1, 1.0), ("b", D2, "ES", 2, 1.0), ("c", D2, "FR", 3, 1.0), ("d", None, "ES", 1, 1.0)]
    new = [("a", D2, "ES", 1, 1.0), ("b", D2, "ES", 2, 1.0), ("c", None, "FR", 3, 1.0), ("d", D3, "ES", 1, 1.0)]
    touched = spark.createDataFrame([(D1,), (D2,), (D3,), (None,)], "day date")
    before = summarize(_silver(spark, old), daily_sales())
    after = _silver(spark, new)
    refreshed = refresh_summary(before, after, daily_sales(), "order_day", touched)
    assert _sorted(refreshed) == _sorted(summarize(after, daily_sales()))
    assert D1 not in {r.order_day for r in refreshed.collect()}


def test_sums_read_only_their_columns_and_combine_first(spark, tmp_path, plan):
    _silver(spark, [("a", D1, "ES", 1, 1.0)]).write.parquet(str(tmp_path / "s"))
    text = plan(summarize(spark.read.parquet(str(tmp_path / "s")), daily_sales()))
    schema = text.split("ReadSchema: ")[1].splitlines()[0]
    assert schema == "struct<order_date:date,region:string,quantity:int,price:double>"
    assert text.count("HashAggregate") == 2 and "partial_sum" in text


def test_summary_of_other_columns(spark):
    rows = spark.range(4).selectExpr("id % 2 as g", "id as v")
    sums = summarize(rows, Summary({"g": F.col("g")}, {"twice": F.col("v") * 2}))
    assert _sorted(sums) == [(0, 4), (1, 8)]
