"""Current rows to published sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stratum.operators import Summary, summarize
from stratum.sinks import publish_table, read_current, tables
from stratum.streaming import start_batches
from stratum.streaming.queries import AVAILABLE_NOW


def publish_gold(
    detail: DataFrame, table: str, summary: Summary, partition_by: Sequence[str] = (), path: str | None = None
) -> None:
    """Summarize the whole of ``detail`` and publish it as ``table``."""
    publish_table(summarize(detail, summary), table, partition_by, path)


def refresh_gold(
    spark: SparkSession,
    silver: str,
    table: str,
    summary: Summary,
    dim: str,
    changes: str,
    checkpoint: str,
    trigger: str | None = AVAILABLE_NOW,
) -> StreamingQuery:
    """Recompute the partitions of ``table`` that the values listed at ``changes``, and not handled before, fall in.

    ``table`` must be published with ``dim`` as its only partition column, and ``dim`` be computed from the tracked
    column alone: the day itself, or its month where days would make many tiny partitions. Partitions that no longer
    have rows are dropped, the others are not touched. Run it after the silver refresh, not alongside: the changes of
    a batch are listed before the batch is merged. Repeating a batch gives the same partitions again.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        touched = batch.select(summary.dims[dim].alias(dim))
        refresh_partitions(batch.sparkSession, read_current(batch.sparkSession, silver), table, summary, dim, touched)

    # Files of the tracked column alone: the others are NULL, and there may be no files yet.
    schema = read_current(spark, silver).schema
    spark.createDataFrame([], schema).write.mode("append").parquet(changes)
    return start_batches(spark.readStream.schema(schema).parquet(changes), refresh, checkpoint, trigger)


def refresh_partitions(
    spark: SparkSession, detail: DataFrame, table: str, summary: Summary, dim: str, touched: DataFrame
) -> None:
    """One refresh: ``touched`` is a one-column frame of ``dim`` values."""
    # One value per partition to rewrite; the catalog is told about each of them in any case.
    values = [r[0] for r in touched.distinct().collect()]
    if not values:
        return
    tables.replace_partitions(summarize(rows_of(detail, summary, dim, values), summary), table, dim, values)


def rows_of(detail: DataFrame, summary: Summary, dim: str, values: Sequence[tables.Value]) -> DataFrame:
    """Detail rows with one of the values. Files sorted by the column behind the dimension skip row groups."""
    rows = detail.where(tables.listed(summary.dims[dim], values))
    return rows.where(summary.within[dim](values)) if dim in summary.within else rows
