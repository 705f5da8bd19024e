"""Decode message values into columns, encode rows into message values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from stratum.functions.payload import json_payload, row_json, text_payload, undeclared_fields

VALUE = "value"
CORRUPT = "_corrupt_record"
MESSAGE = "message"
RESCUED = "_rescued"
VARIANT = "payload"


def decode_value(
    df: DataFrame,
    schema: StructType | None = None,
    keep_source_columns: bool = False,
    corrupt_column: str | None = CORRUPT,
    rescue: bool = False,
    keep_payload: bool = False,
) -> DataFrame:
    """Payload columns of a message frame.

    With a schema the JSON payload becomes top-level columns, without one ``value`` becomes text. The other columns of
    the frame (key, topic, offset, ...) are dropped, or kept together in a struct ``message`` so that they cannot clash
    with payload names. With a schema, ``rescue`` keeps the fields that it does not name as a JSON object in ``_rescued``,
    and ``keep_payload`` the whole payload, well-formed or not, as a VARIANT in ``payload``: NULL where it is no JSON.
    """
    text = text_payload(F.col(VALUE))
    if schema is None:
        payload = [text.alias(VALUE)]
    else:
        payload = [json_payload(text, schema, corrupt_column).alias("data")]
        payload += [undeclared_fields(text, schema).alias(RESCUED)] if rescue else []
        payload += [F.try_parse_json(text).alias(VARIANT)] if keep_payload else []
    others = [c for c in df.columns if c != VALUE]
    if keep_source_columns and others:
        payload.append(F.struct(*others).alias(MESSAGE))
    decoded = df.select(*payload)
    if schema is None:
        return decoded
    return decoded.select("data.*", *(c for c in decoded.columns if c != "data"))


def encode_value(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A frame with one column ``value``: the row as JSON text."""
    return df.select(row_json(columns or ("*",)).alias(VALUE))
