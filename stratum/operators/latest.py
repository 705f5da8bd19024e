"""Keep the newest row of every key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from stratum.functions.names import free_name, quoted
from stratum.operators.lineage import LINEAGE_COLUMNS, SOURCE_FILE
from stratum.operators.typed import INGEST_DATE


def _orderable(t: DataType) -> bool:
    if isinstance(t, (MapType, VariantType)):
        return False
    if isinstance(t, ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return True


def decided_by(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], tie_breakers: Sequence[str] | None = None
) -> list[str]:
    """The columns that decide, in turn and descending, which row of a key is the newest.

    All rows of one ingest batch carry the same ingest time, so ``order_by`` alone would leave the choice open. The
    default tie-breakers are the source file and then the payload columns themselves: rows that still tie are equal in
    everything that matters.
    """
    if tie_breakers is None:
        settled = {*keys, *order_by, *LINEAGE_COLUMNS, INGEST_DATE}
        payload = [f.name for f in df.schema.fields if f.name not in settled and _orderable(f.dataType)]
        files = [SOURCE_FILE] if SOURCE_FILE in df.columns and SOURCE_FILE not in order_by else []
        tie_breakers = [*files, *payload]
    return [*order_by, *tie_breakers]


def newest_first(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], tie_breakers: Sequence[str] | None = None
) -> list[Column]:
    """:func:`decided_by` as sort order."""
    return [F.col(quoted(c)).desc() for c in decided_by(df, keys, order_by, tie_breakers)]


def first_of(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group. The rank's column is called what no other one is."""
    rank = free_name("_rank", df.columns)
    ranked = F.row_number().over(Window.partitionBy(*(F.col(quoted(c)) for c in group)).orderBy(*order))
    return df.withColumn(rank, ranked).where(F.col(rank) == 1).drop(rank)


def latest_by_aggregate(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], tie_breakers: Sequence[str] | None = None
) -> DataFrame:
    """The rows of :func:`latest_per_key` by a partial aggregate: ``max_by`` of whole rows, combined before the exchange.

    Sorted by key alone where the rank sorts by key and order, but every row is put together as a value first. Measured
    """
    order = [F.col(quoted(c)) for c in decided_by(df, keys, order_by, tie_breakers)]
    row, names = F.struct(*(F.col(quoted(c)) for c in df.columns)), [F.col(quoted(k)) for k in keys]
    # NULL is the smallest inside a struct, as it is last in a descending order.
    best = df.groupBy(*(k.alias(f"{i}") for i, k in enumerate(names))).agg(F.max_by(row, F.struct(*order)).alias("row"))
    return best.select("row.*")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], tie_breakers: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the first by ``order_by`` and then ``tie_breakers``, all descending.

    ``rank = 1`` over ``row_number`` is planned as a group limit on both sides of the exchange: every map task keeps
    one row per key before the shuffle, so a key that holds a large share of the rows sends one row per map task.
    """
    return first_of(df, keys, newest_first(df, keys, order_by, tie_breakers))
