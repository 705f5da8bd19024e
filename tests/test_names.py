"""No name of a field or column destroys data or stops a layer."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratum.functions import field_of, free_name, free_names, quoted
from stratum.operators import Summary, latest_per_key, refresh_summary, summarize, upsert_frames
from stratum.plans import ingest_files, ingest_messages, refine_to_silver
from stratum.sinks import publish_table, read_current, upsert_table
from stratum.sources import named_columns, read_layer, recorded_layer, track_schema
from stratum.sources.schemas import read_record
from stratum.streaming import wait_all

WAIT = 120
# What the library calls its own columns on the way, and folders and columns of tables.
OWN = (
    "slot", "key_bucket", "_from_source", "_piece", "_task", "_rank", "_change", "_was", "_had", "_new", "_matches",
    "_touched", "SLOT_2", "Key_Bucket_2", "data", "row", "value", "part", "values", "missing",
)


def _spec(home, **more):
    return {
        "name": "odd",
        "type": "file",
        "landing_path": f"{home}/landing",
        "bronze_path": f"{home}/bronze",
        "autoloader": {"schemaLocation": f"{home}/schema", "checkpointLocation": f"{home}/checkpoint"},
        **more,
    }


def _land(home, file, *rows):
    Path(home, "landing").mkdir(exist_ok=True)
    Path(home, "landing", file).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")


def _ingest(spark, spec):
    assert wait_all([ingest_files(spark, spec)], WAIT)
    return read_layer(spark, spec["bronze_path"], schema=recorded_layer(spark, spec["autoloader"]["schemaLocation"]))


def _refine(spark, home, table, **more):
    query = refine_to_silver(
        spark, f"{home}/bronze", table, ["id"], {}, f"{home}/silver_checkpoint", f"{home}/rejects",
        schema_location=f"{home}/schema", path=f"{home}/silver", buckets=4, **more,
    )
    assert wait_all([query], WAIT)
    return read_current(spark, table)


def test_names_of_columns():
    fields = ["region", "Region", "REGION", "region_2", "_rescued", "Source_File", "_metadata", "a.b", "a`b", "", "x y", "ümlaut"]
    schema = named_columns(StructField(f, StringType()) for f in fields)
    assert schema.fieldNames() == [
        "region", "Region_2", "REGION_3", "region_2_2", "_rescued_2", "Source_File_2", "_metadata_2", "a_b", "a_b_2", "_", "x y", "ümlaut",
    ]
    assert [field_of(f) for f in schema.fields] == fields
    again = named_columns([StructField("Region", StringType()), StructField("new", StringType())], schema)
    assert again.fieldNames() == [*schema.fieldNames(), "new"]
    assert named_columns(StructType.fromJson(json.loads(again.json())).fields) == again
    assert free_name("a", ["A", "a_2"]) == "a_3" and free_names(["a", "b"], ["a"]) == ["a_2", "b"]
    assert quoted("a`b") == "`a``b`"


def test_late_fields_of_any_name(spark, tmp_path, name):
    odd = ["Region", "_rescued", "_metadata", "source_file", "ingest_timestamp", "_corrupt_record", "slot", "key_bucket", "a.b"]
    spec = _spec(tmp_path)
    for i in range(4):
        _land(tmp_path, f"{i}.json", {"id": str(i), "region": f"r{i}", **({f: f"{f}{i}" for f in odd} if i else {})}, "broken")
        layer = _ingest(spark, spec)
        current = _refine(spark, tmp_path, name)
    column = {field_of(f): quoted(f.name) for f in read_record(spark, f"{tmp_path}/schema").schema.fields}
    kept = F.from_json("_rescued", "map<string,string>")
    values = [F.coalesce(F.col(column[f]), F.element_at(kept, f)).alias(f"v{i}") for i, f in enumerate(odd)]
    want = {str(i): (f"r{i}", *(f"{f}{i}" if i else None for f in odd)) for i in range(4)}
    for rows in (layer.where("id is not null"), current):
        assert {r.id: tuple(r)[1:] for r in rows.select("id", "region", *values).collect()} == want
        assert rows.where("source_file like '%/landing/%' and ingest_timestamp is not null").count() == 4
    assert {r._corrupt_record for r in layer.where("id is null").collect()} == {"broken"}
    # Whoever reads the layer without its record can do so too.
    assert read_layer(spark, f"{tmp_path}/bronze").count() == 8


def test_declared_fields_of_any_name(spark, tmp_path):
    declared = StructType([StructField(f, StringType()) for f in ("id", "ID", "source_file", "_rescued", "_metadata")])
    (tmp_path / "declared.json").write_text(declared.json())
    _land(tmp_path, "1.json", {"id": "a", "ID": "b", "source_file": "c", "_rescued": "d", "_metadata": "e"})
    rows = _ingest(spark, _spec(tmp_path, schema=f"{tmp_path}/declared.json")).collect()
    assert [(r.id, r.ID_2, r.source_file_2, r._rescued_2, r._metadata_2, r._rescued) for r in rows] == [("a", "b", "c", "d", "e", None)]


def test_fields_that_differ_in_case_are_inferred(spark, tmp_path):
    _land(tmp_path, "1.json", {"id": 1, "Id": 2, "ID": 3})
    row = _ingest(spark, _spec(tmp_path)).first().asDict()
    fields = {f.name: field_of(f) for f in read_record(spark, f"{tmp_path}/schema").schema.fields}
    assert {fields[c]: row[c] for c in fields} == {"id": "1", "Id": "2", "ID": "3"}


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_typed_files_and_files_without_rescue(spark, tmp_path, fmt):
    rows = spark.sql("select 1 as id, 'a' as source_file, 'b' as _rescued, 'c' as `a.b`")
    rows.write.format(fmt).save(f"{tmp_path}/landing")
    more = {"format": fmt, "rescue": False}
    got = _ingest(spark, _spec(tmp_path, **more)).first()
    assert (got.source_file_2, got._rescued_2, got.a_b) == ("a", "b", "c") and "/landing/" in got.source_file


def test_ten_thousand_names_give_no_ten_thousand_columns(spark, tmp_path):
    spec = _spec(tmp_path, max_columns=20)
    _land(tmp_path, "1.json", {"id": "0"})
    _ingest(spark, spec)
    many = [{"id": str(i), "often": "x", **{f"k{i}_{j}": j for j in range(100)}} for i in range(100)]
    _land(tmp_path, "2.json", *many)
    _ingest(spark, spec)
    _land(tmp_path, "3.json", {"id": "z", "often": "y", "other": "w"})
    rows = {r.id: r for r in _ingest(spark, spec).collect()}
    record = read_record(spark, f"{tmp_path}/schema").schema
    assert len(record.fields) == 20 and "often" in record.fieldNames()
    assert rows["z"].often == "y" and json.loads(rows["z"]._rescued) == {"other": "w"}
    assert len(json.loads(rows["7"]._rescued)) == 101
    # A full record is not added to, and a first look at the files keeps to the bound as well.
    _land(tmp_path, "4.json", {"id": "q", "new": 1})
    assert json.loads({r.id: r for r in _ingest(spark, spec).collect()}["q"]._rescued) == {"new": "1"}
    first = track_schema(spark, f"{tmp_path}/landing", f"{tmp_path}/other", most=5)
    assert len(first.fields) == 5 and {"id", "often"} <= set(first.fieldNames())


def test_starts_open_no_old_file(spark, tmp_path, name):
    """Files that were refined and looked at for names are spoiled; later starts of ingest and refinement never notice."""
    spec = _spec(tmp_path)
    for i in range(2):
        _land(tmp_path, f"{i}.json", {"id": str(i), "late" if i else "id": str(i)})
        _ingest(spark, spec)
        _refine(spark, tmp_path, name)
    assert wait_all([ingest_files(spark, spec)], WAIT)  # has seen the names of the last files
    old = list((tmp_path / "bronze").glob("*.parquet"))
    for file in old:
        file.write_bytes(b"spoiled")
        (tmp_path / "bronze" / f".{file.name}.crc").unlink(missing_ok=True)
    _land(tmp_path, "9.json", {"id": "9", "late": "x", "later": "y"})
    assert wait_all([ingest_files(spark, spec)], WAIT)
    assert {r.id: r.late for r in _refine(spark, tmp_path, name).collect()} == {"0": None, "1": None, "9": "x"}
    _land(tmp_path, "10.json", {"id": "10", "later": "z"})
    assert wait_all([ingest_files(spark, spec)], WAIT)
    rows = {r.id: r for r in _refine(spark, tmp_path, name).collect()}
    assert rows["10"].later == "z" and len(old) >= 2
    with pytest.raises(Exception, match="(?i)footer|seek|parquet"):
        read_layer(spark, f"{tmp_path}/bronze").count()


def test_names_seen_by_a_start_that_was_lost_are_heard_of(spark, tmp_path, monkeypatch):
    from stratum.plans import ingest as plan

    spec = _spec(tmp_path, partition_cols=["ingest_date"])
    _land(tmp_path, "1.json", {"id": "1"})
    _ingest(spark, spec)
    _land(tmp_path, "2.json", {"id": "2", "late": "x"})
    _ingest(spark, spec)

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(plan, "write_record", lost)
    with pytest.raises(RuntimeError, match="lost"):
        ingest_files(spark, spec)
    monkeypatch.undo()
    _land(tmp_path, "3.json", {"id": "3", "late": "y"})
    rows = {r.id: r for r in _ingest(spark, spec).collect()}
    assert rows["3"].late == "y" and rows["3"]._rescued is None and rows["2"].ingest_date == rows["3"].ingest_date


def test_undeclared_fields_of_messages_are_kept(spark, tmp_path):
    declared = StructType.fromDDL("id string, message string, source_file string, payload string")
    (tmp_path / "declared.json").write_text(declared.json())
    (tmp_path / "in").mkdir()
    lines = [{"id": "a", "message": "m", "source_file": "s", "payload": "p", "Id": 2, "deep": {"x": [1, 2]}}, "broken", {"id": "b"}]
    (tmp_path / "in" / "1").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    messages = spark.readStream.text(str(tmp_path / "in")).selectExpr("cast(value as binary) as value", "'t' as topic")
    spec = {
        "name": "m", "type": "kafka", "bronze_path": f"{tmp_path}/bronze", "checkpointLocation": f"{tmp_path}/checkpoint",
        "schema": f"{tmp_path}/declared.json", "keep_source_columns": True, "keep_payload": True,
        "streaming": {"trigger": "availableNow"},
    }
    assert wait_all([ingest_messages(spark, spec, messages)], WAIT)
    bronze = spark.read.parquet(f"{tmp_path}/bronze")
    deep = F.try_variant_get("payload", "$.deep.x[1]", "int").alias("deep")
    rows = {r.id: r for r in bronze.select("*", deep).collect()}
    a = rows["a"]
    assert (a.message_2, a.source_file_2, a.payload_2, a.message.topic, a.source_file, a.deep) == ("m", "s", "p", "t", None, 2)
    assert json.loads(a._rescued) == {"Id": "2", "deep": '{"x":[1,2]}'}
    assert rows["b"]._rescued is None and rows["b"].deep is None
    assert rows[None]._corrupt_record == "broken" and rows[None].payload is None


def _named_rows(spark, rows, names):
    return spark.createDataFrame([(k, v, *(f"{n}{k}{v}" for n in names)) for k, v in rows], ["id", "v", *names])


def _values(frame):
    return {r["id"]: tuple(r[c] for c in frame.columns if c != "id") for r in frame.collect()}


@pytest.mark.parametrize("order, tracked", [(None, False), (["v"], True)])
def test_a_merge_keeps_columns_of_any_name(spark, name, tmp_path, order, tracked):
    note = {"track": "_new", "note": lambda frame: seen.append({r[0] for r in frame.collect()})} if tracked else {}
    seen = []
    want = {}
    for rows in ([("a", 1), ("b", 1), ("c", 1)], [("b", 2), ("d", 2)], [("a", 3), ("d", 3), ("e", 3)]):
        frame = _named_rows(spark, rows, OWN)
        upsert_table(frame, name, ["id"], order, buckets=2, path=str(tmp_path / "t"), **note)
        want |= _values(frame)
        current = read_current(spark, name)
        assert {*current.columns} == {"id", "v", *OWN} and _values(current.select("id", "v", *OWN)) == want
    if tracked:
        assert seen[1] == {"_newb2", "_newd2", "_newb1"}
    publish_table(read_current(spark, name), f"{name}_gold", ["slot"], str(tmp_path / "g"))
    publish_table(read_current(spark, name), f"{name}_gold", ["slot"], str(tmp_path / "g"))
    assert _values(spark.table(f"{name}_gold").select("id", "v", *OWN)) == want


@pytest.mark.parametrize("late", ["_new", "Slot"])
def test_a_column_that_comes_later_may_have_any_name(spark, name, tmp_path, late):
    merge = lambda frame: upsert_table(frame, name, ["id"], ["v"], buckets=2, path=str(tmp_path / "t"), add_columns=True, track="v", note=lambda f: f.count())
    merge(_named_rows(spark, [("a", 1), ("b", 1), ("c", 1)], ()))
    merge(_named_rows(spark, [("a", 2)], [late]))
    merge(_named_rows(spark, [("b", 3)], [late]))
    merge(_named_rows(spark, [("a", 4)], [late]))
    assert _values(read_current(spark, name).select("id", "v", late)) == {"a": (4, f"{late}a4"), "b": (3, f"{late}b3"), "c": (1, None)}


def test_a_later_column_of_the_layouts_own_name_is_refused(spark, name, tmp_path):
    merge = lambda frame: upsert_table(frame, name, ["id"], buckets=2, path=str(tmp_path / "t"), add_columns=True)
    merge(_named_rows(spark, [("a", 1)], ()))
    with pytest.raises(ValueError, match="of its own called key_bucket"):
        merge(_named_rows(spark, [("a", 2)], ["Key_Bucket"]))
    assert _values(read_current(spark, name)) == {"a": (1,)}


@pytest.mark.parametrize("part", ["slot", "region"])
def test_a_publication_keeps_columns_of_any_name(spark, name, tmp_path, part):
    for version in range(3):
        rows = spark.createDataFrame([("x", 7 + version, "s7", "m"), ("y", 8, "s8", "m")], ["region", "slot", "values", "missing"])
        publish_table(rows, name, [part], str(tmp_path / "t"))
        got = spark.table(name).select(*rows.columns)
        assert sorted(got.collect()) == sorted(rows.collect())


def test_rank_upsert_and_refresh_keep_columns_of_any_name(spark):
    frame = _named_rows(spark, [("a", 1), ("a", 2), ("b", 1)], OWN)
    latest = latest_per_key(frame, ["id"], ["v"])
    assert latest.columns == frame.columns and _values(latest) == _values(frame.where("not (id = 'a' and v = 1)"))
    merged = upsert_frames(latest, _named_rows(spark, [("b", 5), ("c", 5)], OWN), ["id"])
    assert merged.columns == frame.columns
    assert _values(merged) == _values(latest.where("id = 'a'")) | _values(_named_rows(spark, [("b", 5), ("c", 5)], OWN))
    sums = Summary(dims={"_touched": F.col("_touched")}, sums={"total": F.col("v")})
    old = summarize(frame.where("v = 1"), sums)
    refreshed = refresh_summary(old, frame, sums, "_touched", frame.where("v = 2").select("_touched"))
    assert sorted(refreshed.collect()) == sorted(summarize(frame, sums).collect())
