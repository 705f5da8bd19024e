"""Files as an unbounded table: each one is read once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratum.functions.names import free_name, quoted
from stratum.functions.payload import FIELD, field_of, json_payload, undeclared_fields
from stratum.operators.payload import CORRUPT, RESCUED

_LINE = "value"
# The file source forgets files older than this, counted back from the newest, and never reads them.
ANY_AGE = {"maxFileAge": "36500d"}


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "json",
    options: Mapping[str, str] | None = None,
    rescue: bool = False,
) -> DataFrame:
    """Stream of the files under ``path`` not seen before (the query's checkpoint keeps the list).

    Age does not decide: a file that arrives with an old modification time is read like any other. The price is that
    the checkpoint remembers every file ever read; name ``maxFileAge`` in the options to bound that memory. JSON keeps
    malformed lines in ``_corrupt_record``. With ``rescue`` it also keeps fields that the schema does not name, as a
    JSON object in ``_rescued`` (NULL when there are none). ``options`` go to the reader: ``maxFilesPerTrigger`` or
    ``maxBytesPerTrigger`` bound a micro-batch, ``pathGlobFilter`` selects files.

    A column of ``schema`` whose metadata names a field is read from that field (see
    :func:`stratum.sources.schemas.named_columns`). With ``rescue`` JSON fields may differ in case alone.
    """
    reader = spark.readStream.options(**ANY_AGE | dict(options or {}))
    if fmt != "json":
        if rescue:
            raise ValueError("rescue applies to JSON files")
        return _renamed(reader.schema(_fields(schema)).format(fmt).load(path), schema)
    if rescue:
        return _rescuing(reader.format("text").load(path), schema, options)
    fields, corrupt = _fields(schema), CORRUPT
    if CORRUPT not in schema.fieldNames():
        corrupt = free_name(CORRUPT, fields.fieldNames())
        fields = StructType([*fields.fields, StructField(corrupt, StringType())])
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType(), True, {FIELD: corrupt})])
    return _renamed(reader.schema(fields).option("columnNameOfCorruptRecord", corrupt).format("json").load(path), schema)


def _fields(schema: StructType) -> StructType:
    return StructType([StructField(field_of(f), f.dataType, f.nullable) for f in schema.fields])


def _renamed(rows: DataFrame, schema: StructType) -> DataFrame:
    """Columns by their names in the layer, beside the scan's own metadata; untouched where no name differs."""
    if all(f.name == field_of(f) for f in schema.fields):
        return rows
    columns = [F.col(quoted(field_of(f))).alias(f.name) for f in schema.fields]
    return rows.select(*columns, rows.metadataColumn("_metadata"))


def _rescuing(lines: DataFrame, schema: StructType, options: Mapping[str, str] | None) -> DataFrame:
    parsed = json_payload(F.col(_LINE), schema, CORRUPT, options)
    # _metadata stays available to the lineage operator because it is selected through.
    kept = lines.where(F.trim(_LINE) != "").select(parsed.alias("data"), _LINE, "_metadata")
    return kept.select("data.*", undeclared_fields(F.col(_LINE), schema, F.col("data")).alias(RESCUED), "_metadata")
