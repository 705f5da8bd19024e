"""A table that holds the current row of every key."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stratum.functions.names import free_name, free_names, quoted
from stratum.operators.latest import decided_by, first_of, newest_first
from stratum.operators.rejects import has_null_key, split_null_keys
from stratum.session import enough_partitions
from stratum.sinks import tables
from stratum.sources.tables import table_exists

# The partition column; a number follows where the rows have a column of that name when the table is created.
BUCKET = "key_bucket"
KEYLESS = -1
UNPLACED = -2
# Buckets below zero for keys that ``bucket_by`` has no number for.
UNPLACED_BUCKETS = 64
# A merge that touches more buckets than this raises: each costs the driver a catalog statement.
MOST_TOUCHED = 100_000
# Stored and new rows that one task of a merge ranks and writes, and how many tasks a merge may have whatever its rows.
TASK_ROWS = 500_000
FEW_TASKS = 200
_KEYS_PROPERTY = "stratum.keys"
_BUCKET_PROPERTY = "stratum.bucket"
_COLUMN_PROPERTY = "stratum.bucket_column"
_PIECES_PROPERTY = "stratum.pieces"
_SORT_PROPERTY = "stratum.sort"
PENDING_PROPERTY = "stratum.pending"
# What images of changed rows have besides their own columns.
SIGN, IMAGE_BUCKET = "_sign", "_bucket"
# The one format that the keyed layout is written in; others must have row-level operations.
_FILES = "parquet"
_REPEATED = "several source rows have one key"


@dataclass(frozen=True)
class Layout:
    """How a keyed table was created: partition column, expression over the keys, tasks a bucket, order inside files."""

    bucket: str
    expression: str
    pieces: int
    sort_by: Sequence[str]
    pending: str | None = None


class DuplicateSourceKeys(ValueError):
    """Several source rows share a key, so it is open which one a target row should become."""


def hash_bucket(keys: Sequence[str], buckets: int) -> str:
    """SQL expression that spreads keys evenly over ``buckets``."""
    return f"cast(pmod(xxhash64({', '.join(map(quoted, keys))}), {buckets}) as int)"


def key_bucket(keys: Sequence[str], expression: str) -> Column:
    """Bucket of a row. Rows without a full key have one that is only ever appended to.

    Keys that the expression gives NULL for are hashed to buckets of their own.
    """
    unplaced = UNPLACED - F.expr(hash_bucket(keys, UNPLACED_BUCKETS))
    return F.when(has_null_key(keys), KEYLESS).otherwise(F.coalesce(F.expr(expression).cast("int"), unplaced))


def merged_rows(spark: SparkSession, table: str) -> DataFrame:
    """The table's own rows, as of now, without the layout column and without what is pending beside it."""
    # Another session (a stream has its own) may have moved partitions since this one last looked.
    spark.catalog.refreshTable(table)
    return spark.table(table).drop(properties_of(spark, table).get(_COLUMN_PROPERTY, BUCKET))


def pending_name(table: str) -> str:
    """The table that holds rows which are not merged yet (see :mod:`stratum.sinks.pending`)."""
    return f"{table}__pending"


def upsert_table(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    tie_breakers: Sequence[str] | None = None,
    buckets: int = 64,
    bucket_by: str | None = None,
    pieces: int | None = None,
    sort_by: Sequence[str] | None = None,
    path: str | None = None,
    fmt: str = _FILES,
    add_columns: bool = False,
    source_wins_ties: bool = False,
    track: str | None = None,
    note: Callable[[DataFrame], None] | None = None,
    images: Sequence[str] | None = None,
) -> None:
    """Merge ``source`` into ``table`` on equal keys; the table is created when missing.

    Without ``order_by`` the source wins: matched rows are replaced, others inserted, and a source that repeats a key
    raises :class:`DuplicateSourceKeys` before anything is changed. With ``order_by`` the newest row of each key wins,
    whichever side it is on, and repeated source keys are settled the same way. Of equal rows the stored one stays, so
    that the same merge again changes nothing, or with ``source_wins_ties`` the new one. Rows with a NULL key match
    nothing and are inserted every time.

    Formats with row-level operations, named by ``fmt`` when the table is created, get a real merge. Parquet does not
    have one: the table is partitioned by a bucket of the key, only the buckets that the source touches are rewritten
    (next to the old files, see :func:`stratum.sinks.tables.point_partitions`) and the rest is not read at all. By
    default a key is hashed to one of ``buckets``. Where new rows come with new keys, ``bucket_by``, a SQL expression
    over the keys that gives a whole number from 0 (say ``order_id div 10000000``), keeps the rewriting to the recent
    buckets; a merge that touches more than a hundred thousand of them raises. A bucket's rows are split over as many tasks and files as their number asks for, and over at least ``pieces``;
    small buckets share a task. ``sort_by`` orders rows inside the files, so that filters on those columns skip row groups. All of these are
    fixed when the table is created and remembered with it. Give the table a ``path`` on shared storage unless the
    warehouse is there.

    Source columns that the table lacks are ignored, or added to it with ``add_columns``; columns that the source lacks
    raise. With ``track`` and ``note``, ``note`` is given a frame of the values of the tracked column that the merge adds
    or takes away, after the new files are written and before they are read by anyone. With ``images`` and ``note`` it is
    given those columns of every row that the merge adds (``SIGN`` 1) or takes away (-1), with the bucket they are in: a
    merge that is repeated after it was lost halfway gives the rows of a bucket again, all of them, or none.
    """
    keys = list(keys)
    spark = source.sparkSession
    if table_exists(spark, table):
        # Which slots are free is read off the catalog: never from what this session remembers of it.
        spark.catalog.refreshTable(table)
        if tables.table_provider(spark, table) != _FILES:
            if images:
                raise ValueError("images are taken by merges into Parquet alone")
            merge_rows(source, table, keys, order_by, tie_breakers, add_columns, source_wins_ties, track, note)
            return
    elif fmt != _FILES:
        tables.create_table(source.limit(0), table, (), path, fmt)
        merge_rows(source, table, keys, order_by, tie_breakers, add_columns, source_wins_ties, track, note)
        return
    else:
        _create(source, table, keys, bucket_by or hash_bucket(keys, buckets), pieces or 1, sort_by or (), path)
    layout = layout_of(spark, table, keys, pieces, sort_by)
    source = conformed(source, table, add_columns, layout.bucket)
    if layout.pending not in (None, pending_order(keys, order_by, tie_breakers)):
        raise ValueError(f"{table} has had rows appended in another order: {layout.pending}")
    source = source.withColumn(layout.bucket, key_bucket(keys, layout.expression))
    buckets_of = source.groupBy(quoted(layout.bucket)).agg(F.count("*")).limit(MOST_TOUCHED + 1)
    touched = dict(map(tuple, buckets_of.collect()))  # a small row per bucket
    if len(touched) > MOST_TOUCHED:
        raise ValueError(f"rows for {table} fall in more than {MOST_TOUCHED} buckets: make them wider, or fewer")
    keyed, without_key = split_null_keys(source, keys)
    with_key = [b for b in touched if b != KEYLESS]
    if with_key:
        # The literal list prunes partitions: the other buckets are not even listed.
        target = spark.table(table).where(tables.listed(F.col(quoted(layout.bucket)), with_key))
        occupied = tables.occupied_slots(spark, table, layout.bucket, with_key, target)
        # No column is read for the number of stored rows: it stands in the footers.
        rows = sum(touched[b] for b in with_key) + (target.count() if occupied else 0)
        pieces, tasks = _dealt(rows, len(with_key), layout.pieces)
        newest = newest_first(keyed.drop(layout.bucket), keys, order_by, tie_breakers) if order_by else []
        stored_first = bool(newest) and not source_wins_ties
        slot = tables.slot_column(source.columns)
        # No two merges call it the same, so it is no column of the data, now or later.
        change, noted = f"_change_{uuid.uuid4().hex}", (images or track) if note else None
        merged = _merged(
            target, keyed, keys, newest, stored_first, occupied, len(with_key), pieces, layout.sort_by, noted,
            layout.bucket, slot, change, tasks,
        )
        root = tables.table_location(spark, table)
        try:
            # New rows are ranked by key first, in a shuffle of the session's: its tasks are bounded like those of the merge.
            with enough_partitions(spark, -(-rows // TASK_ROWS)):
                tables.write_slots(merged, root, layout.bucket, slot)
        except PySparkException as e:
            if _REPEATED in str(e):
                raise DuplicateSourceKeys(f"source rows are not unique on {keys}") from e
            raise
        if noted:
            paths = [tables.slot_folder(root, slot, layout.bucket, b, occupied) for b in with_key]
            changed = _signed_images if images else _changed_values
            note(changed(spark, table, paths, change, noted))
        tables.point_partitions(spark, table, root, layout.bucket, occupied, with_key)
    if KEYLESS in touched:
        # A plain append, not shuffled: however many rows lack a key, they stay spread over the tasks that read them.
        without_key.select(*map(quoted, spark.table(table).columns)).write.insertInto(table)
        if images and note:
            note(_image(without_key, images, 1, F.lit(KEYLESS)))
        elif track and note:
            note(without_key.select(quoted(track)).distinct())


def _create(
    source: DataFrame, table: str, keys: Sequence[str], expression: str, pieces: int, sort_by: Sequence[str], path: str | None
) -> None:
    bucket = free_name(BUCKET, source.columns)
    empty = source.withColumn(bucket, F.lit(KEYLESS)).limit(0)
    tables.create_table(empty, table, [bucket], path)
    properties = {
        _KEYS_PROPERTY: ",".join(keys),
        _COLUMN_PROPERTY: bucket,
        _BUCKET_PROPERTY: expression,
        _PIECES_PROPERTY: str(pieces),
        _SORT_PROPERTY: ",".join(sort_by),
    }
    set_properties(source.sparkSession, table, properties)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def properties_of(spark: SparkSession, table: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def set_properties(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    listed = ", ".join(f"'{k}'='{_quoted(v)}'" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def pending_order(keys: Sequence[str], order_by: Sequence[str] | None, tie_breakers: Sequence[str] | None) -> str | None:
    """How pending rows are ranked, as text that a table's properties hold."""
    return json.dumps([list(keys), list(order_by), None if tie_breakers is None else list(tie_breakers)]) if order_by else None


def layout_of(
    spark: SparkSession, table: str, keys: Sequence[str], pieces: int | None = None, sort_by: Sequence[str] | None = None
) -> Layout:
    properties = properties_of(spark, table)
    if properties.get(_KEYS_PROPERTY) != ",".join(keys):
        raise ValueError(f"{table} is not laid out by the keys {list(keys)}")
    stored_pieces = int(properties.get(_PIECES_PROPERTY, 1))
    stored_sort = [c for c in properties.get(_SORT_PROPERTY, "").split(",") if c]
    if pieces not in (None, stored_pieces) or (sort_by is not None and list(sort_by) != stored_sort):
        raise ValueError(f"{table} was created with pieces={stored_pieces} and sort_by={stored_sort}")
    return Layout(
        properties.get(_COLUMN_PROPERTY, BUCKET),
        properties[_BUCKET_PROPERTY],
        stored_pieces,
        stored_sort,
        properties.get(PENDING_PROPERTY),
    )


def conformed(source: DataFrame, table: str, add_columns: bool, bucket: str | None = None) -> DataFrame:
    """The source with the columns and types of the table: files of another type could not be read next to the rest."""
    spark = source.sparkSession
    stored = merged_rows(spark, table).schema
    new = [f for f in source.schema.fields if f.name not in stored.fieldNames()]
    if new and add_columns:
        if bucket and bucket.lower() in {f.name.lower() for f in new}:
            raise ValueError(f"{table} is partitioned by a column of its own called {bucket}: give the new one another name")
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
        stored = merged_rows(spark, table).schema
    missing = [n for n in stored.fieldNames() if n not in source.columns]
    if missing:
        raise ValueError(f"source of {table} lacks {missing}")
    have = source.schema
    column = lambda f: F.col(quoted(f.name))
    return source.select(
        *(
            column(f) if have[f.name].dataType == f.dataType else column(f).cast(f.dataType).alias(f.name)
            for f in stored.fields
        )
    )


def _dealt(rows: int, buckets: int, pieces: int) -> tuple[int, int]:
    """(pieces of each bucket, tasks) for a merge of so many rows: neither grow with the table nor with its buckets alone."""
    wanted = -(-rows // TASK_ROWS)
    pieces = max(pieces, -(-wanted // buckets))
    return pieces, min(buckets * pieces, max(wanted, FEW_TASKS))


def _merged(
    target: DataFrame,
    keyed: DataFrame,
    keys: Sequence[str],
    newest: Sequence[Column],
    stored_first: bool,
    occupied: dict[int, int | None],
    buckets: int,
    pieces: int,
    sort_by: Sequence[str],
    track: str | Sequence[str] | None = None,
    bucket_column: str = BUCKET,
    slot: str = tables.SLOT,
    change: str = "_change",
    tasks: int | None = None,
) -> DataFrame:
    """Touched buckets after the merge, each row with the slot its bucket goes to.

    Without an order, a second source row of a key raises while the rows are ranked. With ``track``, ``change`` says of
    each row whether it is new, whether it replaces a stored one, and which tracked values that had. The columns that are
    only here on the way have names that no column of the data has.
    """
    if newest:
        # Repeated keys leave before the rows meet the target: at most one row per key and map task is shuffled.
        keyed = first_of(keyed, [bucket_column, *keys], newest)
    bucket = F.col(quoted(bucket_column))
    from_source, piece, task, rank = free_names(("_from_source", "_piece", "_task", "_rank"), [*target.columns, slot])
    both = target.withColumn(from_source, F.lit(0)).unionByName(keyed.withColumn(from_source, F.lit(1)))
    side = F.col(from_source).asc() if stored_first else F.col(from_source).desc()
    folders = [F.col(slot), bucket, F.col(piece)]
    tasks = tasks or max(1, buckets * pieces)
    columns = [F.col(quoted(k)) for k in keys]
    placed = both.withColumns(
        {slot: tables.free_slot(bucket_column, occupied), piece: F.pmod(F.hash(*columns), F.lit(pieces))}
    ).withColumn(task, F.pmod(bucket.cast("long") * pieces + F.col(piece), F.lit(tasks)).cast("int"))
    # Keys are unique on either side by now, so buckets are even, and each piece of a bucket is in one task. This one
    # exchange serves the ranking and the layout of the files: the window's order starts with the folders written. The
    # task, which the others decide, is only named for the exchange to be taken as it is.
    key = Window.partitionBy(*folders, *columns, task)
    ranked = placed.repartitionById(tasks, F.col(task)).withColumn(rank, F.row_number().over(key.orderBy(*newest, side)))
    if track:
        stored = F.col(from_source) == 0
        old = F.struct(*(F.col(quoted(c)) for c in ([track] if isinstance(track, str) else track)))
        was = F.first(F.when(stored, old), ignorenulls=True).over(key)
        ranked = ranked.withColumn(change, F.struct(F.max(stored).over(key).alias("had"), was.alias("was"), (~stored).alias("new")))
    first = F.col(rank) == 1
    if not newest:
        again = (F.col(rank) > 1) & (F.col(from_source) == 1)
        first = F.when(again, F.raise_error(F.lit(_REPEATED)).cast("boolean")).otherwise(first)
    merged = ranked.where(first)
    if sort_by:
        merged = merged.sortWithinPartitions(*folders, *(F.col(quoted(c)) for c in sort_by))
    return merged.drop(from_source, piece, task, rank)


def _changes(spark: SparkSession, table: str, paths: Sequence[str], change: str, columns: Sequence[str]) -> DataFrame:
    """The new rows among the files just written: the named columns and what the merge has noted about them."""
    schema = spark.table(table).schema
    kinds = ", ".join(f"{quoted(c)} {schema[c].dataType.simpleString()}" for c in columns)
    old = ", ".join(f"{quoted(c)}: {schema[c].dataType.simpleString()}" for c in columns)
    fields = f"{kinds}, {change} struct<had: boolean, was: struct<{old}>, new: boolean>"
    return spark.read.schema(fields).parquet(*paths).where(f"{change}.new")


def _changed_values(spark: SparkSession, table: str, paths: Sequence[str], change: str, track: str) -> DataFrame:
    """Tracked values that the files just written add or take away, read off those files: two of their columns."""
    rows = _changes(spark, table, paths, change, [track])
    before = rows.where(f"{change}.had").select(F.col(change)["was"][track].alias(track))
    return rows.select(quoted(track)).unionByName(before).distinct()


def _signed_images(
    spark: SparkSession, table: str, paths: Sequence[str], change: str, images: Sequence[str]
) -> DataFrame:
    """The rows that the files just written add and take away, read off those files."""
    rows = _changes(spark, table, paths, change, images)
    folder = F.regexp_extract("_metadata.file_path", r"=(-?\d+)/[^/]*$", 1).cast("int")
    rows = rows.select("*", folder.alias(IMAGE_BUCKET))
    before = rows.where(f"{change}.had").select(f"{change}.was.*", IMAGE_BUCKET)
    return _image(rows, images, 1, F.col(IMAGE_BUCKET)).unionByName(_image(before, images, -1, F.col(IMAGE_BUCKET)))


def _image(rows: DataFrame, images: Sequence[str], sign: int, bucket: Column) -> DataFrame:
    return rows.select(*map(quoted, images), F.lit(sign).alias(SIGN), bucket.alias(IMAGE_BUCKET))


def merge_rows(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    tie_breakers: Sequence[str] | None = None,
    add_columns: bool = False,
    source_wins_ties: bool = False,
    track: str | None = None,
    note: Callable[[DataFrame], None] | None = None,
) -> None:
    """The same merge for table formats that have row-level operations."""
    spark = source.sparkSession
    source = conformed(source, table, add_columns)
    matched = None
    if order_by:
        newest = newest_first(source, keys, order_by, tie_breakers)
        keyed, without_key = split_null_keys(source, keys)
        source = first_of(keyed, keys, newest).unionByName(without_key)
        deciding = decided_by(source, keys, order_by, tie_breakers)
        matched = newer("source", table, deciding, source_wins_ties)
    if track and note:
        # Ahead of the merge, which overwrites the previous values; a value listed too often only costs time.
        replaced = spark.table(table).join(source.select(*keys).distinct(), list(keys), "left_semi")
        note(source.select(track).unionByName(replaced.select(track)).distinct())
    merge = source.alias("source").mergeInto(table, all_equal("source", table, keys))
    when = merge.whenMatched() if matched is None else merge.whenMatched(matched)
    when.updateAll().whenNotMatched().insertAll().merge()


def all_equal(one: str, other: str, keys: Sequence[str]) -> Column:
    return reduce(and_, (F.col(f"{one}.{quoted(k)}") == F.col(f"{other}.{quoted(k)}") for k in keys))


def newer(source: str, table: str, columns: Sequence[str], or_equal: bool) -> Column:
    """The row of ``source`` comes before that of ``table`` by the columns in turn, descending; NULL is the oldest."""
    new = F.struct(*(F.col(f"{source}.{quoted(c)}") for c in columns))
    old = F.struct(*(F.col(f"{table}.{quoted(c)}") for c in columns))
    return new >= old if or_equal else new > old
