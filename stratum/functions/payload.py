"""Message payloads: bytes to text, JSON text to a struct, rows to JSON text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratum.functions.names import free_name

# The metadata of a column that names the input field it is read from.
FIELD = "field"


def field_of(column: StructField) -> str:
    """The input field that a column is read from: the one that its metadata names, or that of its own name."""
    return column.metadata.get(FIELD, column.name)


def text_payload(value: Column) -> Column:
    return value.cast("string")


def json_payload(
    value: Column, schema: StructType, corrupt_column: str | None = None, options: Mapping[str, str] | None = None
) -> Column:
    """Parse a JSON payload. With ``corrupt_column`` the text of a malformed payload is kept in that field.

    Fields are told apart by their exact names, so two may differ in case alone; columns that are named otherwise than
    the fields they are read from get their names afterwards, by position. ``options`` go to the parser.
    """
    text = text_payload(value)
    wanted, how = list(schema.fields), dict(options or {})
    fields = [StructField(field_of(f), f.dataType) for f in wanted]
    if corrupt_column is not None and corrupt_column in schema.fieldNames():
        how["columnNameOfCorruptRecord"] = corrupt_column
    elif corrupt_column is not None:
        how["columnNameOfCorruptRecord"] = free_name(corrupt_column, [f.name for f in fields])
        fields.append(StructField(how["columnNameOfCorruptRecord"], StringType()))
        wanted.append(StructField(corrupt_column, StringType()))
    parsed = F.from_json(text, StructType(fields), how)
    if [f.name for f in fields] == [f.name for f in wanted]:
        return parsed
    return parsed.cast(StructType([StructField(f.name, f.dataType) for f in wanted]))


def undeclared_fields(value: Column, schema: StructType, read: Column | None = None) -> Column:
    """A JSON object of the fields of a JSON payload that ``schema`` does not read; NULL where there are none.

    With ``read``, what :func:`json_payload` made of it, payloads that hold nothing else are told by that and not parsed again.
    """
    text = text_payload(value)
    # Field names are compared on the Spark side: nothing here depends on which fields a payload happens to have.
    # Only payloads with other names are parsed a second time.
    declared = F.array(*[F.lit(field_of(f)) for f in schema.fields])
    extra = F.map_filter(F.from_json(text, "map<string,string>"), lambda name, _: ~F.array_contains(declared, name))
    others = F.array_except(F.json_object_keys(text), declared)
    found = F.when(F.array_size(others) > 0, F.to_json(extra))
    return found if read is None else F.when(~_read_whole(text, schema, read), found)


def _read_whole(text: Column, schema: StructType, read: Column) -> Column:
    """The payload surely has no field beside those read; not the other way round.

    Every field has a colon after its name. Where nothing is escaped, the colons in a text that was read are in the
    payload as well, so if they and one for each value read are all there are, none is left for another field.
    """
    names = schema.fieldNames()
    texts = [f.name for f in schema.fields if isinstance(f.dataType, StringType)]
    fields = sum((read.getField(n).isNotNull().cast("int") for n in names), F.lit(0))
    inside = _colons(F.concat_ws("", *(read.getField(n) for n in texts))) if texts else F.lit(0)
    return ~F.contains(text, F.lit("\\")) & (_colons(text) == fields + inside)


def _colons(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(":"), F.lit("")))


def row_json(columns: Sequence[str | Column] = ("*",)) -> Column:
    """One JSON object per row; NULL fields are left out."""
    return F.to_json(F.struct(*columns))
