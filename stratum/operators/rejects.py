"""Rows without a usable key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def has_null_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a full key, rows with a NULL in it). Two filters over the same scan, both pushed down to it."""
    missing = has_null_key(keys)
    return df.where(~missing), df.where(missing)
