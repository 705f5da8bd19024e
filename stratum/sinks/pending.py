"""Small batches beside a keyed table: appended as they come, ranked when they are read, folded in when there are many.

A merge into buckets rewrites every bucket it touches, and a batch of a few thousand hashed keys touches all of them.
Appending costs what the batch costs, however large the table is. The price is paid by readers, who join what is pending,
and is kept small by folding: one ordinary merge of all pending rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratum.functions.names import free_name, quoted
from stratum.operators.latest import decided_by, first_of, newest_first
from stratum.operators.rejects import split_null_keys
from stratum.sinks import keyed, tables
from stratum.sources.tables import table_exists


def append_rows(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_breakers: Sequence[str] | None = None,
    add_columns: bool = False,
    **layout,
) -> None:
    """Make ``source`` part of ``table`` as :func:`stratum.sinks.upsert_table` with this order would, without a merge.

    The rows are appended to a table of their own next to it; nothing else is read or written. :func:`read_current` shows
    the newest row of each key from both. An order is required, since rows are compared long after they came; the first
    batch fixes it for all later writes. Appending the same batch twice changes nothing, rows without a key apart, which
    are inserted every time. A missing table is created by an ordinary merge, for which ``layout`` is.
    """
    spark = source.sparkSession
    if not table_exists(spark, table):
        keyed.upsert_table(source, table, keys, order_by, tie_breakers, **layout)
        return
    order = keyed.pending_order(keys, order_by, tie_breakers)
    had = keyed.layout_of(spark, table, keys)
    if had.pending not in (None, order):
        raise ValueError(f"{table} has had rows appended in another order: {had.pending}")
    rows = keyed.conformed(source, table, add_columns, had.bucket)
    pending = keyed.pending_name(table)
    if not table_exists(spark, pending):
        root = f"{tables.table_location(spark, table)}__pending"
        tables.create_table(rows.limit(0), pending, (), f"{root}/{tables.SLOT}=0")
    if had.pending is None:
        keyed.set_properties(spark, table, {keyed.PENDING_PROPERTY: order})
    # A key that repeats within the batch is settled here, so that at most one row per key and batch is kept.
    with_key, without_key = split_null_keys(rows, keys)
    newest = first_of(with_key, keys, newest_first(rows, keys, order_by, tie_breakers))
    _conformed(newest.unionByName(without_key), spark, pending).write.insertInto(pending)


def _conformed(rows: DataFrame, spark: SparkSession, pending: str) -> DataFrame:
    """``rows`` in the columns of the pending table, to which those that the table has got meanwhile are added."""
    spark.catalog.refreshTable(pending)
    had = spark.table(pending).columns
    new = [f for f in rows.schema.fields if f.name not in had]
    if new:
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {pending} ADD COLUMNS ({columns})")
    return rows.select(*map(quoted, [*had, *(f.name for f in new)]))


def fold_rows(
    spark: SparkSession, table: str, track: str | None = None, note: Callable[[DataFrame], None] | None = None
) -> None:
    """Merge all pending rows into ``table``, then forget them. One writer at a time, appending or folding.

    With ``track`` and ``note``, ``note`` is given the values of the tracked column that the merge adds or takes away, as
    :func:`stratum.sinks.upsert_table` gives them, and those of all pending rows, which may have been read meanwhile.

    A job lost in between has merged rows that are still pending: they lose against their equals, so what is read is
    right all the time, and folding again completes it. Only rows without a key, which match nothing, come twice then.
    """
    pending = keyed.pending_name(table)
    order = keyed.properties_of(spark, table).get(keyed.PENDING_PROPERTY)
    if order is None or not table_exists(spark, pending):
        return
    spark.catalog.refreshTable(pending)
    keys, order_by, tie_breakers = json.loads(order)
    rows = _aligned(spark.table(pending), keyed.merged_rows(spark, table))
    if track and note:
        note(rows.select(quoted(track)).distinct())
    keyed.upsert_table(rows, table, keys, order_by, tie_breakers, track=track, note=note)
    tables.publish_table(spark.table(pending).limit(0), pending)


def pending_files(spark: SparkSession, table: str) -> int:
    """How many files are pending, for a job to decide whether to fold."""
    pending = keyed.pending_name(table)
    if not table_exists(spark, pending):
        return 0
    spark.catalog.refreshTable(pending)
    return len(spark.table(pending).inputFiles())


def fold_large(
    spark: SparkSession, table: str, track: str | None = None, note: Callable[[DataFrame], None] | None = None
) -> None:
    """:func:`fold_rows` once as many rows are pending as the table holds.

    However many batches come, the rows that all folds together rewrite so stay in proportion to those that came.
    """
    if pending_rows(spark, table) >= keyed.merged_rows(spark, table).count():
        fold_rows(spark, table, track, note)


def pending_rows(spark: SparkSession, table: str) -> int:
    """How many rows are pending. It stands in the footers of the files, as the number of stored rows does."""
    pending = keyed.pending_name(table)
    if not table_exists(spark, pending):
        return 0
    spark.catalog.refreshTable(pending)
    return spark.table(pending).count()


def settle_rows(
    spark: SparkSession, table: str, track: str | None = None, note: Callable[[DataFrame], None] | None = None
) -> None:
    """:func:`fold_rows` of whatever is pending; after that the table is open to merges in any order again."""
    if not table_exists(spark, table) or keyed.PENDING_PROPERTY not in keyed.properties_of(spark, table):
        return
    if pending_rows(spark, table):
        fold_rows(spark, table, track, note)
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{keyed.PENDING_PROPERTY}')")


def read_current(spark: SparkSession, table: str) -> DataFrame:
    """The current row of every key, as of now, without the layout column.

    Where rows are pending, they take part: the stored rows are neither ranked nor, if what is pending is small enough
    for Spark to broadcast by its size, shuffled.
    """
    rows = keyed.merged_rows(spark, table)
    order = keyed.properties_of(spark, table).get(keyed.PENDING_PROPERTY)
    pending = keyed.pending_name(table)
    if order is None or not table_exists(spark, pending):
        return rows
    spark.catalog.refreshTable(pending)
    beside = spark.table(pending)
    return rows if beside.isEmpty() else _with_pending(rows, beside, order)


def _aligned(pending: DataFrame, stored: DataFrame) -> DataFrame:
    """Pending rows in the columns of the table, which may have got more since they came."""
    had = pending.columns
    return pending.select(
        *(F.col(quoted(f.name)) if f.name in had else F.lit(None).cast(f.dataType).alias(f.name) for f in stored.schema.fields)
    )


def _with_pending(stored: DataFrame, pending: DataFrame, order: str) -> DataFrame:
    keys, order_by, tie_breakers = json.loads(order)
    pending = _aligned(pending, stored)
    with_key, without_key = split_null_keys(pending, keys)
    newest = first_of(with_key, keys, newest_first(pending, keys, order_by, tie_breakers))
    present = free_name("_present", stored.columns)
    same = keyed.all_equal("stored", "newer", keys)
    joined = stored.alias("stored").join(newest.withColumn(present, F.lit(True)).alias("newer"), same, "left")
    deciding = decided_by(stored, keys, order_by, tie_breakers)
    wins = F.col(f"newer.{present}").isNotNull() & keyed.newer("newer", "stored", deciding, False)
    side = lambda name, c: F.col(f"{name}.{quoted(c)}")
    replaced = joined.select(*(F.when(wins, side("newer", c)).otherwise(side("stored", c)).alias(c) for c in stored.columns))
    # The stored keys that are pending are looked for from the stored side: there, too, the small side can be broadcast.
    names = list(map(quoted, keys))
    known = stored.select(*names).alias("stored").join(newest.select(*names).alias("newer"), same, "left_semi")
    added = newest.alias("newer").join(known.alias("stored"), same, "left_anti")
    return replaced.unionByName(added).unionByName(without_key)
