"""Declared schemas, and the record of a raw layer: which field of the input is which column, and all columns it has.

Input fields may have any name. Columns are told apart without regard to case, and the raw layer has some of its own. So
the record keeps, for each column, the field it is read from: a struct field whose metadata names the input field where
the two differ.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from stratum.functions.names import free_name
from stratum.functions.payload import FIELD, field_of
from stratum.operators.lineage import LINEAGE_COLUMNS
from stratum.operators.payload import CORRUPT, RESCUED
from stratum.operators.typed import INGEST_DATE

_TRACKED = StructType(
    [StructField("version", IntegerType()), StructField("schema", StringType()), StructField("layer", StringType())]
)
_TEXT_FORMATS = ("json", "csv")
# Names that a raw layer and the table of current rows behind it have for themselves, and what no column name may hold:
# what separates or quotes names in SQL, or is refused by catalogs and file formats.
RESERVED = frozenset((*LINEAGE_COLUMNS, INGEST_DATE, RESCUED, CORRUPT, "_metadata", "key_bucket"))
_REFUSED = re.compile(r"[.`,;{}()=\x00-\x1f]")
# A record grows to so many columns by what is found; more are only declared.
MOST_COLUMNS = 1_000


@dataclass(frozen=True)
class SchemaRecord:
    """``schema``: the columns read from the input. ``layer``: all columns of the raw layer's files, once it has any."""

    version: int
    schema: StructType
    layer: StructType | None = None


def load_schema(spark: SparkSession, path: str) -> StructType:
    """A StructType from its JSON document, wherever Spark can read it. A missing or broken document raises.

    A field with the metadata ``{"field": name}`` is a column that is read from the input field of that name.
    """
    text = spark.read.text(path, wholetext=True).first()
    if text is None:
        raise ValueError(f"schema document is empty: {path}")
    return StructType.fromJson(json.loads(text[0]))


def text_first(schema: StructType) -> StructType:
    """The same columns, all as text: nothing is lost on the way in, typing happens in the next layer."""
    return StructType([StructField(f.name, StringType(), True, f.metadata) for f in schema.fields])


def named_columns(
    fields: Iterable[StructField], schema: StructType = StructType(), reserved: Iterable[str] = RESERVED
) -> StructType:
    """``schema`` with a column for each of ``fields`` that it does not read yet.

    A column has the field's name unless another column has it in any case, the raw layer needs it, or it holds a
    character that names may not have: those are replaced, and a number is appended until the name is free.
    """
    columns = list(schema.fields)
    read = {field_of(f) for f in columns}
    taken = {f.name for f in columns} | set(reserved)
    for f in fields:
        field = field_of(f)
        if field in read:
            continue
        name = free_name(_REFUSED.sub("_", f.name) or "_", taken)
        columns.append(StructField(name, f.dataType, True, {} if name == field else {FIELD: field}))
        read.add(field)
        taken.add(name)
    return StructType(columns)


def read_record(spark: SparkSession, location: str) -> SchemaRecord | None:
    try:
        newest = spark.read.schema(_TRACKED).json(location).orderBy(F.desc("version")).first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if newest is None:
        return None
    struct = lambda text: StructType.fromJson(json.loads(text))
    return SchemaRecord(newest.version, struct(newest.schema), struct(newest.layer) if newest.layer else None)


def write_record(spark: SparkSession, location: str, known: SchemaRecord | None, schema: StructType, layer: StructType | None) -> None:
    """Add the next version to the record, if it differs from ``known``. Columns of the layer are never taken back."""
    if known is not None and known.layer is not None:
        names = set(known.layer.fieldNames())
        layer = StructType([*known.layer.fields, *(f for f in layer.fields if f.name not in names)]) if layer else known.layer
    if known is not None and (schema, layer) == (known.schema, known.layer):
        return
    version = 0 if known is None else known.version + 1
    row = spark.createDataFrame([(version, schema.json(), layer.json() if layer else None)], _TRACKED)
    row.coalesce(1).write.mode("append").json(location)


def recorded_layer(spark: SparkSession, location: str) -> StructType:
    """All columns of the raw layer recorded at ``location``; none of its files is looked at."""
    record = read_record(spark, location)
    if record is None or record.layer is None:
        raise ValueError(f"no raw layer is recorded at {location}")
    return record.layer


def rescued_names(rows: DataFrame, known: Sequence[str], most: int) -> list[tuple[str, int]]:
    """The commonest fields kept in ``_rescued`` that are not ``known``, and in how many rows: at most so many, whatever
    there are."""
    names = rows.filter(F.col(RESCUED).isNotNull()).select(F.explode(F.json_object_keys(RESCUED)).alias("name"))
    return _commonest(names.filter(~F.col("name").isin(list(known))), most)


def _commonest(names: DataFrame, most: int) -> list[tuple[str, int]]:
    counted = names.groupBy("name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name").limit(most)
    return [(r.name, r.n) for r in counted.collect()]


def track_schema(
    spark: SparkSession,
    landing: str,
    location: str,
    fmt: str = "json",
    declared: StructType | None = None,
    options: Mapping[str, str] | None = None,
    found: Sequence[str] = (),
    most: int = MOST_COLUMNS,
) -> StructType:
    """The schema recorded at ``location``, recorded there on first use.

    First use takes ``declared``, or infers the columns from the files present; for text formats all of them as text.
    Later uses never look at the files again; columns newly declared, and the text columns that ``found`` names, are
    appended and recorded as the next version, those that are found up to ``most`` columns in all.
    """
    known = read_record(spark, location)
    schema = grown_schema(spark, known, landing, fmt, declared, options, found, most)
    write_record(spark, location, known, schema, known.layer if known else None)
    return schema


def grown_schema(
    spark: SparkSession,
    known: SchemaRecord | None,
    landing: str,
    fmt: str = "json",
    declared: StructType | None = None,
    options: Mapping[str, str] | None = None,
    found: Sequence[str] = (),
    most: int = MOST_COLUMNS,
) -> StructType:
    """What :func:`track_schema` records, from what is ``known``."""
    if declared is not None and fmt in _TEXT_FORMATS:
        declared = text_first(declared)
    if known is None:
        inferred = _infer(spark, landing, fmt, options or {}, most) if declared is None else declared
        schema = named_columns(inferred.fields)
    else:
        schema = named_columns(declared.fields, known.schema) if declared is not None else known.schema
    room = max(0, most - len(schema.fields))
    read = {field_of(f) for f in schema.fields}
    more = [StructField(name, StringType()) for name in dict.fromkeys(found) if name not in read]
    return named_columns(more[:room], schema)


def _infer(spark: SparkSession, landing: str, fmt: str, options: Mapping[str, str], most: int) -> StructType:
    reader = spark.read.options(**options).format(fmt)
    if fmt in ("parquet", "orc"):
        reader = reader.option("mergeSchema", True)
    if fmt == "json":
        reader = reader.option("primitivesAsString", True)
    try:
        fields = [f for f in reader.load(landing).schema.fields if f.name != CORRUPT]
    except AnalysisException as e:
        if fmt != "json" or e.getCondition() != "COLUMN_ALREADY_EXISTS":
            raise
        fields = None  # names that differ in their case alone
    if fmt == "json" and (fields is None or len(fields) > most):
        lines = spark.read.options(**options).text(landing)
        names = _commonest(lines.select(F.explode(F.json_object_keys("value")).alias("name")), most)
        fields = [StructField(name, StringType()) for name, _ in sorted(names)]
    if not fields:
        raise ValueError(f"no columns to infer from {landing}")
    return StructType(fields)
