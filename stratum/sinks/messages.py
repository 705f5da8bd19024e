"""Publish rows as JSON messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from stratum.operators.payload import encode_value
from stratum.sources.messages import MESSAGE_FORMAT, client_options


def publish_messages(
    df: DataFrame, kafka: Mapping[str, str], topic: str, columns: Sequence[str] | None = None
) -> None:
    """``topic`` is a plain name: the pattern a reader subscribes with is no topic."""
    (
        encode_value(df, columns)
        .write.format(MESSAGE_FORMAT)
        .options(**client_options(kafka))
        .option("topic", topic)
        .save()
    )
