"""Landing files and message topics to the raw layer."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from stratum.functions.payload import field_of
from stratum.operators import decode_value, enrich_lineage
from stratum.operators.lineage import FILE_SYSTEM, MESSAGE_SYSTEM
from stratum.operators.payload import MESSAGE, RESCUED, VARIANT
from stratum.sources import load_schema, stream_files, stream_messages
from stratum.sources.files import ANY_AGE
from stratum.sources.schemas import (
    MOST_COLUMNS,
    RESERVED,
    SchemaRecord,
    grown_schema,
    named_columns,
    read_record,
    rescued_names,
    write_record,
)
from stratum.streaming import append_stream, start_batches, wait_all
from stratum.streaming.queries import AVAILABLE_NOW, with_partitions

Spec = Mapping[str, Any]


def _required(spec: Spec, *names: str) -> Any:
    value: Any = spec
    for name in names:
        value = value.get(name) if isinstance(value, Mapping) else None
        if value is None:
            raise ValueError(f"dataset {spec.get('name')!r} lacks {'.'.join(names)}")
    return value


# The keys of a dataset spec.
_BOTH_KEYS = {"name", "type", "bronze_path", "silver_path", "gold_path", "schema", "format", "partition_cols", "table_format", "batch", "streaming"}
_FILE_KEYS = _BOTH_KEYS | {"landing_path", "options", "rescue", "max_columns", "archive", "autoloader"}
_MESSAGE_KEYS = _BOTH_KEYS | {"kafka", "checkpointLocation", "keep_source_columns", "keep_payload", "rescue"}


_NOTED = "name string, n long"


def _known(spec: Spec, keys: set[str]) -> None:
    unknown = sorted(spec.keys() - keys)
    if unknown:
        raise ValueError(f"dataset {spec.get('name')!r} has unknown keys: {', '.join(unknown)}")


def _declared(spark: SparkSession, spec: Spec):
    return load_schema(spark, spec["schema"]) if spec.get("schema") else None


def ingest_files(spark: SparkSession, spec: Spec) -> StreamingQuery:
    """Start the ingest of a file dataset; by default it reads every new file and stops.

    Spec: ``landing_path``, ``bronze_path``, ``autoloader.schemaLocation``, ``autoloader.checkpointLocation``; optional
    ``format`` (json), ``schema`` (declared columns), ``partition_cols``, ``batch.trigger``, ``options`` for the
    reader, ``rescue``, ``table_format`` (parquet).

    JSON fields that the schema does not name are kept in ``_rescued`` unless ``rescue`` is false, and the next start
    takes them up as columns, the commonest first, up to ``max_columns`` (1,000) columns; the others stay there. Rows from
    before keep theirs in ``_rescued``. Fields of any name are read: where a column cannot have a field's name, because
    another has it in another case or the raw layer needs it, a number is appended, and the record at ``schemaLocation``
    says which column is which field. It also lists all columns of the raw layer, for whoever reads that.

    With ``archive`` files that were ingested are moved below that folder, which must be on the same storage and not below
    ``landing_path``: those of a batch when the next one has come. Listing the landing folder then costs what is new.
    ``source_file`` names the place where a file was read.

    A start looks at the files that the raw layer has got since the last one, for the names kept aside, and at no others.
    """
    rows = file_rows(spark, spec)
    return append_stream(
        rows,
        _required(spec, "bronze_path"),
        _required(spec, "autoloader", "checkpointLocation"),
        spec.get("batch", {}).get("trigger", AVAILABLE_NOW),
        spec.get("partition_cols", ()),
        spec.get("table_format", "parquet"),
    )


def file_rows(spark: SparkSession, spec: Spec) -> DataFrame:
    """The stream that :func:`ingest_files` appends: new files as rows of the raw layer, whose columns are recorded."""
    _known(spec, _FILE_KEYS)
    landing, bronze = _required(spec, "landing_path"), _required(spec, "bronze_path")
    fmt, stored = spec.get("format", "json"), spec.get("table_format", "parquet")
    location = _required(spec, "autoloader", "schemaLocation")
    _required(spec, "autoloader", "checkpointLocation")
    options, partition_by = spec.get("options"), spec.get("partition_cols", ())
    rescue, most = bool(spec.get("rescue", fmt == "json")), int(spec.get("max_columns", MOST_COLUMNS))
    known = read_record(spark, location)
    found = _new_names(spark, bronze, location, stored, known, most) if rescue and known else ()
    schema = grown_schema(spark, known, landing, fmt, _declared(spark, spec), options, found, most)
    moved = {"cleanSource": "archive", "sourceArchiveDir": spec["archive"]} if spec.get("archive") else {}
    files = stream_files(spark, landing, schema, fmt, {**(options or {}), **moved}, rescue)
    rows = enrich_lineage(files, FILE_SYSTEM)
    write_record(spark, location, known, schema, with_partitions(rows, partition_by).schema)
    return rows


def _new_names(spark: SparkSession, bronze: str, location: str, fmt: str, known: SchemaRecord, most: int) -> list[str]:
    """Fields kept aside in files of the raw layer that were not looked at before.

    A stream of its own remembers which were. It reads one column, and of it only row groups that have any value. Names
    are handed over as the stream goes and recorded by the caller; what a start that is lost in between has seen is noted
    in the folder of this stream, so that the next one still hears of it.
    """
    room = most - len(known.schema.fields)
    if room <= 0:
        return []
    read = [field_of(f) for f in known.schema.fields]
    noted = f"{location}/_names/found"

    def note(batch: DataFrame, batch_id: int) -> None:
        names = rescued_names(batch, read, room)
        if names:
            batch.sparkSession.createDataFrame(names, _NOTED).coalesce(1).write.mode("append").json(noted)

    try:
        kept = spark.readStream.schema(f"{RESCUED} string").options(**ANY_AGE).format(fmt).load(bronze)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []  # recorded, but nothing was ever written
        raise
    wait_all([start_batches(kept, note, f"{location}/_names/checkpoint")])
    try:
        rows = spark.read.schema(_NOTED).json(noted).filter(~F.col("name").isin(read))
        commonest = rows.groupBy("name").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "name").limit(room)
        return [r.name for r in commonest.collect()]
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def ingest_messages(spark: SparkSession, spec: Spec, messages: DataFrame | None = None) -> StreamingQuery:
    """Start the ingest of a message dataset; by default it runs until it is stopped.

    Spec: ``kafka`` (see :func:`stratum.sources.message_options`), ``bronze_path``, ``checkpointLocation``; optional
    ``schema``, ``keep_source_columns``, ``keep_payload``, ``rescue``, ``partition_cols``, ``streaming.trigger``,
    ``table_format``. ``messages`` takes the place of the topic: any stream with a ``value`` column.

    With a ``schema``, fields that it does not name are kept in ``_rescued``, as those of files are, unless ``rescue`` is
    false; ``keep_payload`` keeps the whole message as a VARIANT in ``payload``, for queries by path. Declared fields that
    clash with other columns get a number, as those of files do.
    """
    _known(spec, _MESSAGE_KEYS)
    bronze, checkpoint = _required(spec, "bronze_path"), _required(spec, "checkpointLocation")
    if messages is None:
        messages = stream_messages(spark, _required(spec, "kafka"))
    declared, keep, payload = _declared(spark, spec), bool(spec.get("keep_source_columns")), bool(spec.get("keep_payload"))
    if declared is not None:
        own = [name for name, wanted in ((MESSAGE, keep), (VARIANT, payload)) if wanted]
        declared = named_columns(declared.fields, reserved={*RESERVED, *own})
    rows = decode_value(messages, declared, keep, rescue=bool(spec.get("rescue", True)), keep_payload=payload)
    return append_stream(
        enrich_lineage(rows, MESSAGE_SYSTEM),
        bronze,
        checkpoint,
        spec.get("streaming", {}).get("trigger"),
        spec.get("partition_cols", ()),
        spec.get("table_format", "parquet"),
    )


def ingest_all(
    spark: SparkSession,
    specs: Iterable[Spec],
    timeout: float | None = None,
    messages: Mapping[str, DataFrame] | None = None,
) -> list[StreamingQuery]:
    """Start every enabled dataset, then wait for all of them.

    File datasets are those with ``batch.enabled``, message datasets those of type ``kafka`` with
    ``streaming.enabled``. ``messages`` replaces topics by dataset name. Should a dataset fail to start, the ones
    already running are stopped. One that fails later raises its error after the others have ended, or at once when
    some of them never do. After ``timeout`` seconds a TimeoutError names the datasets that still run; they are left
    running.
    """
    started: list[StreamingQuery] = []
    names: list[Any] = []
    endless = False
    try:
        for spec in specs:
            if spec.get("batch", {}).get("enabled", False):
                started.append(ingest_files(spark, spec))
                names.append(spec.get("name"))
            if spec.get("streaming", {}).get("enabled", False) and spec.get("type") == MESSAGE_SYSTEM:
                started.append(ingest_messages(spark, spec, (messages or {}).get(spec.get("name"))))
                names.append(spec.get("name"))
                endless |= spec["streaming"].get("trigger") != AVAILABLE_NOW
    except Exception:
        for query in started:
            query.stop()
        raise
    if not wait_all(started, timeout, fail_fast=endless):
        running = [str(name) for name, query in zip(names, started) if query.isActive]
        raise TimeoutError(f"still running after {timeout} s: {', '.join(running)}")
    return started
