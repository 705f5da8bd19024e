"""Raw layer to the current row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stratum.operators import apply_types, split_null_keys, stamp_date
from stratum.operators.lineage import INGEST_TIMESTAMP
from stratum.session import small_splits
from stratum.sinks import append_rows, fold_large, pending_files, settle_rows, tables, upsert_table
from stratum.sinks.images import mark_done, write_images
from stratum.sinks.keyed import merged_rows
from stratum.sources import read_layer, recorded_layer
from stratum.sources.files import ANY_AGE
from stratum.sources.tables import table_exists
from stratum.streaming import start_batches
from stratum.streaming.queries import AVAILABLE_NOW, SettledQuery


def _columns(spark: SparkSession, schema: StructType | None, schema_location: str | None) -> StructType | None:
    return recorded_layer(spark, schema_location) if schema is None and schema_location else schema


def refine_to_silver(
    spark: SparkSession,
    bronze: str,
    table: str,
    keys: Sequence[str],
    types: Mapping[str, str],
    checkpoint: str,
    rejects: str,
    order_by: Sequence[str] = (INGEST_TIMESTAMP,),
    tie_breakers: Sequence[str] | None = None,
    changes: str | None = None,
    track: str | None = None,
    trigger: str | None = AVAILABLE_NOW,
    options: Mapping[str, str] | None = None,
    fmt: str = "parquet",
    schema: StructType | None = None,
    add_columns: bool = True,
    schema_location: str | None = None,
    fold_after: int | None = None,
    images: Sequence[str] | None = None,
    **layout,
) -> StreamingQuery:
    """Merge what is new in the raw layer into ``table``; start the query and return it.

    Each micro-batch is typed, rows without a key go to ``rejects``, the rest is merged so that the newest row of each
    key wins. The cost follows the new rows and the buckets they fall in, the result equals a full recompute, and a
    batch that is repeated after a crash changes nothing. ``rejects`` has a folder for every run and batch.

    The raw layer is read with ``schema``, or with the columns recorded at ``schema_location`` by the ingest, or else with
    all columns that any of its files has when the query starts, for which the footer of every file is read. Columns that
    the table lacks are added to it, unless ``add_columns`` is false.

    A batch of fewer rows than the table holds is appended beside it; what is pending is merged when it has as many rows
    as the table, and at last by whoever waits for the query's end. So a run of many small batches does not rewrite the
    table with each of them. :func:`read_current` shows pending rows too; their ``changes`` are listed when they are merged.
    A run that is lost leaves them pending for the next one.

    With ``fold_after`` every batch is appended beside the table, what is pending is merged only if it has more files than
    that as well, and the end leaves it pending: see :mod:`stratum.sinks.pending`. Then there is no telling what a batch
    takes away, so ``changes`` cannot be listed.

    With ``changes`` and ``track`` the values of the tracked column that a batch adds *or takes away* are appended at
    ``changes``, for :func:`stratum.plans.gold.refresh_gold`. ``layout`` goes to
    :func:`stratum.sinks.keyed.upsert_table` (``path``, ``buckets``, ``pieces``, ``sort_by``).

    With ``changes`` and ``images`` the named columns of all rows that a batch adds or takes away are written there
    instead, once and only once whatever is lost, for :func:`stratum.plans.sums.refresh_sums`.
    """
    if fold_after is not None and changes:
        raise ValueError("changes are listed by merges, not where batches are appended")
    columns = _columns(spark, schema, schema_location) or read_layer(spark, bronze, fmt).schema
    raw = spark.readStream.schema(columns).options(**ANY_AGE | dict(options or {})).format(fmt)

    def list_changes(values: DataFrame) -> None:
        # Appended, never replaced: when a batch is repeated after a crash, the first attempt may have switched buckets
        # whose previous values only it could list. A value listed too often only costs time.
        values.write.mode("append").parquet(changes)

    tracking = {"track": track, "note": list_changes} if changes and track else {}
    # Images are of batches: each is merged for itself.
    appends = bool(order_by) and not (changes and images)

    def fewer_than_stored(session: SparkSession, rows: int) -> bool:
        if not table_exists(session, table) or tables.table_provider(session, table) != "parquet":
            return False
        return rows < merged_rows(session, table).count()

    def merge(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        keyed, _ = split_null_keys(stamp_date(apply_types(batch, types)), keys)
        # Counted as it is read: no filter passes the count, so types come after it, for the rows without a key alone.
        counted = batch.observe(seen, F.count("*").alias("rows"))
        _, without_key = split_null_keys(stamp_date(apply_types(counted, types)), keys)
        # The query's id belongs to its checkpoint: another checkpoint never replaces what this one set aside.
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        without_key.write.mode("overwrite").parquet(f"{rejects}/run={run}/batch={batch_id}")
        if fold_after is not None:
            append_rows(keyed, table, keys, order_by, tie_breakers, add_columns, **layout)
            if pending_files(batch.sparkSession, table) > fold_after:
                fold_large(batch.sparkSession, table)
            return
        if appends and fewer_than_stored(batch.sparkSession, seen.get.get("rows", 0)):
            append_rows(keyed, table, keys, order_by, tie_breakers, add_columns, **layout)
            fold_large(batch.sparkSession, table, **tracking)
            return
        noting = tracking
        if changes and images:
            noting = {"images": images, "note": partial(write_images, changes=changes, run=run, batch=batch_id)}
        upsert_table(keyed, table, keys, order_by, tie_breakers, add_columns=add_columns, **noting, **layout)
        if changes and images:
            mark_done(batch.sparkSession, changes, run, batch_id)

    with small_splits(spark):
        query = start_batches(raw.load(bronze), merge, checkpoint, trigger)
    return query if fold_after is not None or not appends else SettledQuery(query, partial(settle_rows, spark, table, **tracking))


def refresh_silver(
    spark: SparkSession,
    bronze: str,
    table: str,
    keys: Sequence[str],
    types: Mapping[str, str],
    rejects: str,
    order_by: Sequence[str] = (INGEST_TIMESTAMP,),
    tie_breakers: Sequence[str] | None = None,
    fmt: str = "parquet",
    schema: StructType | None = None,
    add_columns: bool = True,
    schema_location: str | None = None,
    raw: DataFrame | None = None,
    **layout,
) -> None:
    """The same merge from the whole raw layer at once: every row it holds is written and stamped anew.

    ``raw`` is the layer's rows where they lie in several places (:func:`stratum.plans.volumes.read_volumes`).

    Its rejects are all rows without a key, under a run of their own that each full refresh replaces: count either
    ``run='full'`` or the other runs.
    """
    if raw is None:
        raw = read_layer(spark, bronze, fmt, _columns(spark, schema, schema_location))
    typed = stamp_date(apply_types(raw, types))
    keyed, without_key = split_null_keys(typed, keys)
    with small_splits(spark):
        without_key.write.mode("overwrite").parquet(f"{rejects}/run=full/batch=0")
        upsert_table(keyed, table, keys, order_by, tie_breakers, add_columns=add_columns, source_wins_ties=True, **layout)
