"""Start streaming queries and wait for them."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence
from threading import Lock
from typing import Any

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from stratum.operators.lineage import INGEST_TIMESTAMP
from stratum.operators.typed import INGEST_DATE

AVAILABLE_NOW = "availableNow"
_POLL_SECONDS = 0.2
# A raw file is what a task reads at least: small enough for one that sorts its rows, however much a batch brings.
RAW_FILES = {"maxRecordsPerFile": 1_000_000}


def _triggered(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """``availableNow`` drains what is there and stops, an interval paces micro-batches, None runs them back to back."""
    if trigger is None:
        return writer
    if trigger == AVAILABLE_NOW:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def with_partitions(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The frame with the partition column ``ingest_date``, if it is one and not there yet."""
    if INGEST_DATE in partition_by and INGEST_DATE not in df.columns:
        return df.withColumn(INGEST_DATE, F.to_date(INGEST_TIMESTAMP))
    return df


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = AVAILABLE_NOW,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append a stream to the table at ``path``, exactly once per row as long as the checkpoint is kept.

    A partition column ``ingest_date`` that the frame lacks is taken from its ingest time.
    """
    writer = (
        with_partitions(df, partition_by)
        .writeStream.format(fmt)
        .options(**RAW_FILES)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
    )
    return _triggered(writer, trigger).start(path)


def start_batches(
    df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, trigger: str | None = AVAILABLE_NOW
) -> StreamingQuery:
    """Hand every micro-batch to ``each``; a batch may come again after a crash, so ``each`` must bear repetition."""
    writer = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return _triggered(writer, trigger).start()


class SettledQuery:
    """A streaming query that leaves something to be done: who waits for its end has that done once it has ended well."""

    def __init__(self, query: StreamingQuery, settle: Callable[[], None]):
        self._query, self._settle, self._lock = query, settle, Lock()

    def __getattr__(self, name: str) -> Any:
        return getattr(self._query, name)

    def awaitTermination(self, timeout: float | None = None) -> bool | None:  # noqa: N802 - as Spark's query calls it
        ended = self._query.awaitTermination(timeout)
        with self._lock:
            if ended is not False and self._settle is not None:
                self._settle()
                self._settle = None
        return ended


def wait_all(queries: Iterable[StreamingQuery], timeout: float | None = None, fail_fast: bool = False) -> bool:
    """Wait for every query; True when all have ended in time.

    A query that failed raises its error: once the others have ended, or at once with ``fail_fast``, which is the way
    to hear of it when some of the others run forever. Those are left running.
    """
    deadline = None if timeout is None else time.monotonic() + timeout
    running = list(queries)
    failure: Exception | None = None
    while running and (deadline is None or time.monotonic() < deadline):
        for query in list(running):
            try:
                if query.awaitTermination(_POLL_SECONDS):
                    running.remove(query)
            except Exception as e:  # noqa: BLE001 - raised below
                running.remove(query)
                failure = failure or e
        if failure is not None and fail_fast:
            break
    if failure is not None:
        raise failure
    return not running
