import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.plans import ingest_all, ingest_files, ingest_messages
from stratum.session import remove_scratch, scratch_dir, shared_dir
from stratum.sources import (
    load_schema,
    message_options,
    read_layer,
    sasl_plain_options,
    stream_files,
    stream_messages,
    track_schema,
)
from stratum.sources.messages import client_options
from stratum.streaming import append_stream, queries, wait_all
from stratum.sinks import export_json, publish_messages

DECLARED = {
    "type": "struct",
    "fields": [
        {"name": "order_id", "type": "string", "nullable": True},
        {"name": "quantity", "type": "integer", "nullable": True},
        {"name": "price", "type": "double", "nullable": True},
    ],
}
WAIT = 90


def _land(tmp_path, file, *lines):
    folder = tmp_path / "landing"
    folder.mkdir(exist_ok=True)
    (folder / file).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def _spec(tmp_path, **more):
    return {
        "name": "sales",
        "type": "file",
        "landing_path": str(tmp_path / "landing"),
        "bronze_path": str(tmp_path / "bronze"),
        "autoloader": {"schemaLocation": str(tmp_path / "schema"), "checkpointLocation": str(tmp_path / "checkpoint")},
        "batch": {"enabled": True, "trigger": "availableNow"},
        **more,
    }


def _declare(tmp_path):
    path = tmp_path / "declared.json"
    path.write_text(json.dumps(DECLARED, indent=1))
    return str(path)


def _ingest(spark, spec):
    query = ingest_files(spark, spec)
    assert wait_all([query], WAIT)
    return spark.read.parquet(spec["bronze_path"])


def test_each_file_is_read_once(spark, tmp_path):
    spec = _spec(tmp_path)
    _land(tmp_path, "1.json", {"order_id": "a", "quantity": 1, "price": 2.5}, {"order_id": "b", "quantity": 2})
    bronze = _ingest(spark, spec)
    assert bronze.count() == 2
    assert dict(bronze.dtypes) | {"quantity": "string", "source_file": "string"} == dict(bronze.dtypes)
    assert _ingest(spark, spec).count() == 2
    _land(tmp_path, "2.json", {"order_id": "c", "quantity": 3})
    bronze = _ingest(spark, spec)
    assert sorted(r.order_id for r in bronze.collect()) == ["a", "b", "c"]
    by_file = bronze.groupBy(F.regexp_extract("source_file", "[^/]+$", 0).alias("f")).count()
    assert {r.f: r["count"] for r in by_file.collect()} == {"1.json": 2, "2.json": 1}
    assert bronze.select("ingest_timestamp").distinct().count() == 2


def test_malformed_and_undeclared_json(spark, tmp_path):
    _land(tmp_path, "1.json", {"order_id": "a", "colour": "red", "deep": {"x": 1}}, "broken", {"order_id": "b"})
    spec = _spec(tmp_path, schema=_declare(tmp_path), rescue=True)
    rows = {r.order_id: r for r in _ingest(spark, spec).collect()}
    assert rows[None]._corrupt_record == "broken"
    assert json.loads(rows["a"]._rescued) == {"colour": "red", "deep": '{"x":1}'}
    assert rows["b"]._rescued is None and rows["b"]._corrupt_record is None
    assert rows["b"].source_file.endswith("1.json")
    assert "_metadata" not in rows["b"].asDict()


def test_malformed_json_without_rescue(spark, tmp_path):
    _land(tmp_path, "1.json", {"order_id": "a", "quantity": 1, "colour": "red"}, "broken")
    rows = {r.order_id: r for r in _ingest(spark, _spec(tmp_path, schema=_declare(tmp_path))).collect()}
    assert rows["a"].quantity == "1" and rows[None]._corrupt_record == "broken"


def test_files_of_any_age_are_read(spark, tmp_path):
    """A file that keeps the time it was made at, as a restored one does, is as new as any other."""
    spec = _spec(tmp_path)
    _land(tmp_path, "a.json", {"order_id": "a"})
    assert _ingest(spark, spec).count() == 1
    _land(tmp_path, "b.json", {"order_id": "b"})
    _land(tmp_path, "late.json", {"order_id": "late"})
    month_ago = time.time() - 30 * 86_400
    os.utime(tmp_path / "landing" / "late.json", (month_ago, month_ago))
    assert sorted(r.order_id for r in _ingest(spark, spec).collect()) == ["a", "b", "late"]


def test_fields_that_appear_later_are_kept_and_taken_up(spark, tmp_path):
    spec = _spec(tmp_path)
    _land(tmp_path, "1.json", {"order_id": "a"})
    _ingest(spark, spec)
    _land(tmp_path, "2.json", {"order_id": "b", "colour": "red", "Size": 2})
    rows = {r.order_id: r.asDict() for r in _ingest(spark, spec).collect()}
    assert json.loads(rows["b"]["_rescued"]) == {"colour": "red", "Size": "2"}
    _land(tmp_path, "3.json", {"order_id": "c", "colour": "blue"})
    _ingest(spark, spec)
    rows = {r.order_id: r for r in read_layer(spark, spec["bronze_path"]).collect()}
    assert rows["c"].colour == "blue" and rows["c"]._rescued is None and rows["a"].colour is None
    assert json.loads(rows["b"]._rescued)["colour"] == "red"


def test_a_grown_layer_is_read_with_all_columns(spark, tmp_path):
    path = str(tmp_path / "layer")
    for i in range(6):
        spark.range(1).selectExpr("id", f"id as c{i}").coalesce(1).write.mode("append").parquet(path)
        assert {*read_layer(spark, path).columns} == {"id", *(f"c{j}" for j in range(i + 1))}
    assert read_layer(spark, path, schema=StructType.fromDDL("c3 long")).columns == ["c3"]
    landed = track_schema(spark, path, str(tmp_path / "tracked"), "parquet")
    assert set(landed.fieldNames()) == {"id", *(f"c{j}" for j in range(6))}


def test_unknown_spec_keys_raise(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown keys: rescu"):
        ingest_files(spark, _spec(tmp_path, rescu=True))


def test_a_timeout_is_heard(spark, tmp_path):
    _land(tmp_path, "1.json", {"order_id": "a"})
    spec = _spec(tmp_path, batch={"enabled": True, "trigger": "1 second"})
    with pytest.raises(TimeoutError, match=str(spec["name"])):
        ingest_all(spark, [spec], timeout=3)
    for query in spark.streams.active:
        query.stop()


def test_csv_files(spark, tmp_path):
    _land(tmp_path, "1.csv", "order_id,quantity", "a,1", "b,x")
    spec = _spec(tmp_path, format="csv", options={"header": "true"})
    assert sorted(tuple(r)[:2] for r in _ingest(spark, spec).collect()) == [("a", "1"), ("b", "x")]


def test_partitioned_bronze(spark, tmp_path):
    _land(tmp_path, "1.json", {"order_id": "a"})
    bronze = _ingest(spark, _spec(tmp_path, partition_cols=["ingest_date"]))
    assert dict(bronze.dtypes)["ingest_date"] == "date"
    assert any(p.name.startswith("ingest_date=") for p in (tmp_path / "bronze").iterdir())


def test_micro_batches_are_bounded(spark, tmp_path):
    for i in range(3):
        _land(tmp_path, f"{i}.json", {"order_id": str(i)})
    bronze = _ingest(spark, _spec(tmp_path, options={"maxFilesPerTrigger": "1"}))
    assert bronze.select("ingest_timestamp").distinct().count() == 3


def test_schema_is_tracked(spark, tmp_path):
    _land(tmp_path, "1.json", {"order_id": "a", "quantity": 1})
    landing, location = str(tmp_path / "landing"), str(tmp_path / "schema")
    first = track_schema(spark, landing, location)
    assert first.simpleString() == "struct<order_id:string,quantity:string>"
    _land(tmp_path, "2.json", {"order_id": "b", "colour": "red"})
    assert track_schema(spark, landing, location) == first
    more = StructType.fromDDL("order_id string, colour int")
    grown = track_schema(spark, landing, location, declared=more)
    assert grown.fieldNames() == ["order_id", "quantity", "colour"] and grown["colour"].dataType.simpleString() == "string"
    assert track_schema(spark, landing, location) == grown


def test_schema_of_typed_files_is_kept(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "landing"))
    schema = track_schema(spark, str(tmp_path / "landing"), str(tmp_path / "schema"), "parquet")
    assert schema.simpleString() == "struct<id:bigint>"


def test_nothing_to_infer(spark, tmp_path):
    _land(tmp_path, "1.json", "broken")
    with pytest.raises(ValueError, match="no columns"):
        track_schema(spark, str(tmp_path / "landing"), str(tmp_path / "schema"))


def test_declared_schema(spark, tmp_path):
    assert load_schema(spark, _declare(tmp_path)).simpleString() == "struct<order_id:string,quantity:int,price:double>"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_schema(spark, str(tmp_path / "missing.json"))
    (tmp_path / "bad.json").write_text("{")
    with pytest.raises(ValueError):
        load_schema(spark, str(tmp_path / "bad.json"))


def test_rescue_is_for_json(spark, tmp_path):
    with pytest.raises(ValueError, match="JSON"):
        stream_files(spark, str(tmp_path), StructType.fromDDL("a int"), "csv", rescue=True)


# messages


def _stream_of(spark, tmp_path, *values):
    path = str(tmp_path / "messages")
    rows = [(v, "topic-1", i) for i, v in enumerate(values)]
    spark.createDataFrame(rows, "value binary, topic string, offset long").write.mode("append").parquet(path)
    return spark.readStream.schema("value binary, topic string, offset long").parquet(path)


def _message_spec(tmp_path, **more):
    return {
        "name": "events",
        "type": "kafka",
        "bronze_path": str(tmp_path / "message_bronze"),
        "checkpointLocation": str(tmp_path / "message_checkpoint"),
        "streaming": {"enabled": True, "trigger": "availableNow"},
        **more,
    }


def test_raw_messages(spark, tmp_path):
    query = ingest_messages(spark, _message_spec(tmp_path), _stream_of(spark, tmp_path, b"x", None))
    assert wait_all([query], WAIT)
    rows = spark.read.parquet(str(tmp_path / "message_bronze"))
    assert rows.columns == ["value", "ingest_timestamp", "source_system", "source_file"]
    assert {(r.value, r.source_system, r.source_file) for r in rows.collect()} == {("x", "kafka", None), (None, "kafka", None)}


def test_json_messages_with_their_source_columns(spark, tmp_path):
    stream = _stream_of(spark, tmp_path, b'{"order_id":"a","quantity":1}', b"oops")
    spec = _message_spec(tmp_path, schema=_declare(tmp_path), keep_source_columns=True)
    assert wait_all([ingest_messages(spark, spec, stream)], WAIT)
    rows = {r.order_id: r for r in spark.read.parquet(str(tmp_path / "message_bronze")).collect()}
    assert rows["a"].quantity == 1 and rows["a"].message.offset == 0
    assert rows[None]._corrupt_record == "oops"


def test_unreadable_declared_schema_raises(spark, tmp_path):
    spec = _message_spec(tmp_path, schema=str(tmp_path / "missing.json"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        ingest_messages(spark, spec, _stream_of(spark, tmp_path, b"x"))


def test_continuous_micro_batches_until_stopped(spark, tmp_path):
    stream = _stream_of(spark, tmp_path, b"x")
    query = append_stream(stream, str(tmp_path / "out"), str(tmp_path / "check"), trigger="100 milliseconds")
    query.processAllAvailable()
    _stream_of(spark, tmp_path, b"y")
    query.processAllAvailable()
    assert not wait_all([query], 0.2)
    query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_message_options():
    kafka = {"bootstrapServers": "h:1", "subscribePattern": "a.*", "kafka.security.protocol": "SASL_SSL", "api_key": "k"}
    assert message_options(kafka) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribePattern": "a.*",
        "startingOffsets": "earliest",
        "kafka.security.protocol": "SASL_SSL",
    }
    assert message_options({**kafka, "startingOffsets": "latest"})["startingOffsets"] == "latest"
    assert message_options({**kafka, "maxOffsetsPerTrigger": 9})["maxOffsetsPerTrigger"] == "9"
    more = message_options({**kafka, "failOnDataLoss": False, "minPartitions": 4, "includeHeaders": "true"})
    assert (more["failOnDataLoss"], more["minPartitions"], more["includeHeaders"]) == ("false", "4", "true")
    assert "api_key" not in more
    assert client_options(kafka) == {"kafka.bootstrap.servers": "h:1", "kafka.security.protocol": "SASL_SSL"}
    with pytest.raises(ValueError, match="subscribePattern"):
        message_options({"bootstrapServers": "h:1"})


def test_login_options():
    options = sasl_plain_options("me", "secret", "some.LoginModule")
    assert options["kafka.sasl.jaas.config"] == 'some.LoginModule required username="me" password="secret";'
    assert options["kafka.security.protocol"] == "SASL_SSL" and options["kafka.sasl.mechanism"] == "PLAIN"


def test_connector_comes_from_the_cluster(spark):
    kafka = {"bootstrapServers": "h:1", "subscribePattern": "a"}
    with pytest.raises(Exception, match="kafka"):
        stream_messages(spark, kafka)
    with pytest.raises(Exception, match="kafka"):
        publish_messages(spark.range(1), kafka, "a")


# several datasets


def test_all_enabled_datasets_run(spark, tmp_path):
    _land(tmp_path, "1.json", {"order_id": "a"})
    specs = [
        _spec(tmp_path),
        _message_spec(tmp_path),
        _message_spec(tmp_path / "off", name="off", streaming={"enabled": False}),
        _spec(tmp_path / "off", batch={"enabled": False}),
    ]
    queries = ingest_all(spark, specs, WAIT, {"events": _stream_of(spark, tmp_path, b"x")})
    assert len(queries) == 2 and not any(q.isActive for q in queries)
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 1
    assert spark.read.parquet(str(tmp_path / "message_bronze")).count() == 1


def test_a_spec_that_lacks_a_path_raises(spark, tmp_path):
    spec = _spec(tmp_path)
    del spec["bronze_path"]
    _land(tmp_path, "1.json", {"order_id": "a"})
    with pytest.raises(ValueError, match="'sales' lacks bronze_path"):
        ingest_all(spark, [spec])


def test_one_failure_does_not_keep_the_others_from_ending(spark, tmp_path):
    bad = _stream_of(spark, tmp_path / "bad", b"x").select(F.raise_error(F.lit("bad row")).alias("v"))
    good = _stream_of(spark, tmp_path / "good", b"x")
    queries = [
        append_stream(bad.select(F.col("v").cast("string")), str(tmp_path / "b"), str(tmp_path / "cb")),
        append_stream(good, str(tmp_path / "g"), str(tmp_path / "cg")),
    ]
    with pytest.raises(Exception, match="bad row"):
        wait_all(queries, WAIT)
    assert spark.read.parquet(str(tmp_path / "g")).count() == 1


def test_a_failure_is_heard_while_another_query_runs_on(spark, tmp_path):
    bad = _stream_of(spark, tmp_path / "bad", b"x").select(F.raise_error(F.lit("bad row")).cast("string").alias("v"))
    endless = append_stream(
        _stream_of(spark, tmp_path / "good", b"x"), str(tmp_path / "g"), str(tmp_path / "cg"), trigger=None
    )
    failing = append_stream(bad, str(tmp_path / "b"), str(tmp_path / "cb"))
    with pytest.raises(Exception, match="bad row"):
        wait_all([endless, failing], WAIT, fail_fast=True)
    assert endless.isActive
    endless.stop()


# working folders


def test_working_folders_are_where_the_session_says(spark):
    assert scratch_dir(spark, "x").startswith(shared_dir(spark) + "/stratum-x-")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_scratch_is_removed(spark):
    path, kept = scratch_dir(spark, "gone"), scratch_dir(spark, "kept")
    for folder in (path, kept):
        spark.range(3).write.parquet(f"{folder}/files")
    spark.range(3).write.option("path", f"{path}/table").saveAsTable("stratum_gone")
    assert remove_scratch(spark, "gone") == 1
    assert not spark.catalog.tableExists("stratum_gone")
    assert spark.read.parquet(f"{kept}/files").count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{path}/files")
    assert remove_scratch(spark, "gone") == 0


def test_the_setting_decides_and_not_the_master():
    class Conf(dict):
        def get(self, k, default=None):
            return dict.get(self, k, default)

    class Session:
        conf = Conf({"spark.master": "local[2]"})

    own = shared_dir(Session())
    Session.conf = Conf({"spark.master": "yarn"})
    assert shared_dir(Session()) == own
    Session.conf = Conf({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///jobs/"})
    assert shared_dir(Session()) == "hdfs:///jobs"


def test_raw_files_have_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(queries.RAW_FILES, "maxRecordsPerFile", 3)
    spark.range(0, 10, 1, 1).write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    assert wait_all([append_stream(rows, str(tmp_path / "out"), str(tmp_path / "c"))], 90)
    assert len(list((tmp_path / "out").glob("part-*"))) == 4
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


def test_compressed_landing_files_are_read(spark, tmp_path):
    export_json(spark.range(7), str(tmp_path / "landing"), max_records_per_file=2, compression="snappy")
    assert {f.suffix for f in (tmp_path / "landing").glob("part-*")} == {".snappy"}
    rows = stream_files(spark, str(tmp_path / "landing"), StructType.fromDDL("id long"), rescue=True)
    assert wait_all([append_stream(rows.drop("_metadata"), str(tmp_path / "out"), str(tmp_path / "c"))], 90)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(7))
