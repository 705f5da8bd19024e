"""Catalog tables, whole and partition by partition."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from stratum.functions.names import free_name, quoted
from stratum.sinks.files import gather
from stratum.sources.tables import table_exists

# The folder of a slot; a number follows where the rows have a column of that name.
SLOT = "slot"
_IN_SLOT = re.compile(rf"/{SLOT}(?:_\d+)?=([01])/[^/]*$")
_NULL_DIR = "__HIVE_DEFAULT_PARTITION__"
_SPECS_PER_STATEMENT = 200
_STATEMENTS_AT_A_TIME = 8

Value = bool | int | str | dt.date | None
# Types of partition columns that can be switched one by one, and how their values are read from a folder's name.
_VALUE_OF: dict[str, Callable[[str], Value]] = {
    "string": str,
    "date": dt.date.fromisoformat,
    "boolean": lambda text: text == "true",
    **dict.fromkeys(("tinyint", "smallint", "int", "bigint"), int),
}
# The characters that Spark escapes in the folder of a partition value.
_ESCAPED = {chr(i) for i in range(1, 32)} | set("\"#%'*/:=?\\{[]^\x7f")


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")


def publish_table(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    path: str | None = None,
    fmt: str = "parquet",
    place: Callable[[DataFrame, Sequence[str]], DataFrame] = gather,
) -> None:
    """Make a whole frame the content of a catalog table; table and namespace are created when missing.

    Rows are always written aside first, so a publication that fails leaves the table as it was. A table that already is
    partitioned in the same way, by one column, then has its partitions switched one by one; one without partitions and
    with the same columns is pointed to the new files in one step; any other is dropped and declared anew over them.
    ``place`` distributes the rows over tasks by their partition.
    """
    spark = df.sparkSession
    if not table_exists(spark, table):
        if path and not partition_by:
            _declare(_written(df, (), f"{path}/{SLOT}=0", fmt, place), table, (), f"{path}/{SLOT}=0", fmt)
        else:
            create_table(df, table, partition_by, path, fmt, "errorifexists", place)
        return
    stored = {c.name: c.isPartition for c in spark.catalog.listColumns(table)}
    alike = (
        stored == {c: c in partition_by for c in df.columns}
        and set(df.dtypes) == set(spark.table(table).dtypes)
        and table_provider(spark, table) == fmt
    )
    if alike and fmt == "parquet" and len(partition_by) == 1 and _switchable(df, partition_by[0]):
        replace_partitions(df, table, partition_by[0], place=place)
        return
    aside = _free_location(table_location(spark, table))
    _written(df, partition_by, aside, fmt, place)
    if alike and not partition_by and spark.table(table).columns == df.columns:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{aside}'")
    else:
        spark.sql(f"DROP TABLE {table}")
        _declare(df, table, partition_by, aside, fmt)
    spark.catalog.refreshTable(table)


# So many versions of a published view lie side by side; a reader keeps its files until the one it reads comes round again.
VERSIONS = 3
_VERSION_PROPERTY = "stratum.version"


def publish_view(
    df: DataFrame,
    view: str,
    partition_by: Sequence[str] = (),
    path: str | None = None,
    fmt: str = "parquet",
    place: Callable[[DataFrame, Sequence[str]], DataFrame] = gather,
) -> None:
    """Make a whole frame the content of ``view``, whatever columns and partitions it had, in one step of the catalog.

    The rows become a table of their own, ``view`` with ``__v`` and a number, which the view then reads instead of the one
    before. Readers see the former content or the new one, never none and no mixture; a publication that fails leaves
    the view as it was. Filters reach the partitions of the table through the view.
    """
    spark = df.sparkSession
    current = None
    if table_exists(spark, view):
        if spark.catalog.getTable(view).tableType != "VIEW":
            raise ValueError(f"{view} is a table: publish it with publish_table, or under another name")
        properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}
        if _VERSION_PROPERTY not in properties:
            raise ValueError(f"{view} is a view of somebody else")
        current = int(properties[_VERSION_PROPERTY])
    version = 0 if current is None else (current + 1) % VERSIONS
    table = f"{view}__v{version}"
    namespace, _, _ = view.rpartition(".")
    if namespace:
        ensure_namespace(spark, namespace)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    if path:
        _declare(_written(df, partition_by, f"{path}/version={version}", fmt, place), table, partition_by, f"{path}/version={version}", fmt)
    else:
        create_table(df, table, partition_by, None, fmt, "overwrite", place)
    columns = ", ".join(map(quoted, df.columns))
    spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{_VERSION_PROPERTY}'='{version}') AS SELECT {columns} FROM {table}")
    spark.catalog.refreshTable(view)


def _written(
    df: DataFrame, partition_by: Sequence[str], location: str, fmt: str, place: Callable[[DataFrame, Sequence[str]], DataFrame]
) -> DataFrame:
    place(df, partition_by).write.format(fmt).mode("overwrite").partitionBy(*partition_by).save(location)
    return df


def _declare(df: DataFrame, table: str, partition_by: Sequence[str], location: str, fmt: str) -> None:
    """A table over files that are there."""
    spark = df.sparkSession
    namespace, _, _ = table.rpartition(".")
    if namespace:
        ensure_namespace(spark, namespace)
    columns = df.select(*(c for c in df.columns if c not in partition_by), *partition_by).schema.toDDL()
    parts = f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING {fmt}{parts} LOCATION '{location}'")
    if partition_by:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def _free_location(location: str) -> str:
    """Where a table that lies at ``location`` may be written to: the other of its two slots."""
    slot = re.search(rf"^(.*)/{SLOT}=([01])$", location)
    return f"{slot[1]}/{SLOT}={1 - int(slot[2])}" if slot else f"{location}__slots/{SLOT}=0"


def _switchable(df: DataFrame, part: str) -> bool:
    """Whether partition values of this type can be told to the catalog one by one."""
    return dict(df.dtypes)[part] in _VALUE_OF


def create_table(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    path: str | None = None,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    place: Callable[[DataFrame, Sequence[str]], DataFrame] = gather,
) -> None:
    namespace, _, _ = table.rpartition(".")
    if namespace:
        ensure_namespace(df.sparkSession, namespace)
    writer = place(df, partition_by).write.format(fmt).mode(mode).partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.where("col_name = 'Location'").first().data_type


def table_provider(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.where("col_name = 'Provider'").first().data_type.lower()


def listed(column: Column, values: Iterable[Value]) -> Column:
    """``column`` is one of ``values``, where NULL may be one."""
    known = [v for v in values if v is not None]
    missing = column.isNull() if None in values else F.lit(False)
    return (column.isin(known) | missing) if known else missing


def occupied_slots(
    spark: SparkSession, table: str, part: str, values: Sequence[Value], read: DataFrame | None = None
) -> dict[Value, int | None]:
    """Slot that each of the named partitions lies in; None for a partition still at its first place.

    Told by the paths of the files in ``read``, a frame of those partitions that is going to be read in any case; the
    catalog is asked for the others, a statement for each partition.
    """
    existing = _existing(spark, table)
    there = [v for v in values if _directory(part, v) in existing]
    folders = {f.rpartition("/")[0] for f in read.inputFiles()} if read is not None and there else set()
    seen = {unquote(f.rpartition("/")[2]): f for f in folders}
    locations = {v: seen[_directory(part, v)] for v in there if _directory(part, v) in seen}
    asked = [v for v in there if v not in locations]
    locations |= zip(asked, _each(lambda v: _partition_location(spark, table, part, v), asked))
    slots = {v: _IN_SLOT.search(location) for v, location in locations.items()}
    return {v: int(slots[v][1]) if slots[v] else None for v in there}


def _existing(spark: SparkSession, table: str) -> set[str]:
    return {r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator()}


def _partition_location(spark: SparkSession, table: str, part: str, value: Value) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({quoted(part)}={_literal(value)})").collect()
    start = next(i for i, r in enumerate(rows) if r.col_name == "# Detailed Partition Information")
    return next(r.data_type for r in rows[start:] if r.col_name == "Location").rstrip("/")


def _each(task: Callable[[Any], Any], items: Sequence[Any]) -> list[Any]:
    """Small catalog statements side by side; the first error is raised after all have ended."""
    with ThreadPoolExecutor(_STATEMENTS_AT_A_TIME) as pool:
        return list(pool.map(task, items))


def free_slot(part: str, occupied: dict[Value, int | None]) -> Column:
    """For each row the slot its partition may be written to: the one that nobody reads."""
    return F.when(listed(F.col(quoted(part)), [v for v, slot in occupied.items() if slot == 0]), 1).otherwise(0)


def slot_column(columns: Iterable[str]) -> str:
    """What the column is called that rows with these columns carry their slot in, and so the slot's folder."""
    return free_name(SLOT, columns)


def write_slots(rows: DataFrame, root: str, part: str, slot: str) -> None:
    """Write rows, which carry their free slot in ``slot``, below ``root``. Only the directories written to are replaced."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(slot, part)
        .parquet(root)
    )


def replace_partitions(
    rows: DataFrame,
    table: str,
    part: str,
    values: Sequence[Value] | None = None,
    place: Callable[[DataFrame, Sequence[str]], DataFrame] = gather,
) -> None:
    """Make ``rows`` the content of the named partitions (default all); those that get no rows are dropped."""
    spark = rows.sparkSession
    spark.catalog.refreshTable(table)
    if values is None:
        read = _VALUE_OF[dict(spark.table(table).dtypes)[part]]
        values = [_named(directory, read) for directory in _existing(spark, table)]
    occupied = occupied_slots(spark, table, part, values)
    # Which partitions were written is noted while they are: one value per partition.
    seen = Observation()
    columns = spark.table(table).columns
    noted = rows.select(*map(quoted, columns)).observe(
        seen, F.collect_set(quoted(part)).alias("values"), F.max(F.col(quoted(part)).isNull()).alias("missing")
    )
    root, slot = table_location(spark, table), slot_column(columns)
    write_slots(place(noted.withColumn(slot, free_slot(part, occupied)), [slot, part]), root, part, slot)
    found = seen.get
    written = {v for v in found["values"] if v != ""} | ({None} if found["missing"] or "" in found["values"] else set())
    emptied = {*values} - written
    point_partitions(spark, table, root, part, occupied, written, emptied)


def slot_folder(root: str, slot: str, part: str, value: Value, occupied: dict[Value, int | None]) -> str:
    """Where a partition's rows are written that the slot nobody reads is meant for."""
    return f"{root}/{slot}={1 if occupied.get(value) == 0 else 0}/{_directory(part, value)}"


def point_partitions(
    spark: SparkSession,
    table: str,
    root: str,
    part: str,
    occupied: dict[Value, int | None],
    written: Iterable[Value],
    emptied: Iterable[Value] = (),
) -> None:
    """Make the catalog read the freshly written slots: each partition switches at once, the others stay as they are.

    A job lost before this point has changed nothing that is read. One lost in between leaves whole partitions in
    their old or new state; running it again completes it. The slot left behind is overwritten by the next write to
    the same partition, so at most two copies of a partition exist and running readers keep theirs until then.
    """
    existing, slot = _existing(spark, table), slot_column(spark.table(table).columns)
    switched, added = [], []
    for value in written:
        location = f"LOCATION '{_quoted(slot_folder(root, slot, part, value, occupied))}'"
        spec = f"PARTITION ({quoted(part)}={_literal(value)})"
        if _directory(part, value) in existing:
            switched.append(f"ALTER TABLE {table} {spec} SET {location}")
        else:
            added.append(f"{spec} {location}")
    _each(spark.sql, switched)
    for chunk in _chunks(added):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(chunk)}")
    for chunk in _chunks([f"PARTITION ({quoted(part)}={_literal(v)})" for v in emptied]):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(chunk)}")
    spark.catalog.refreshTable(table)


def _directory(part: str, value: Value) -> str:
    """The folder that Spark writes a partition value to."""
    if value is None or value == "":
        return f"{_escaped(part)}={_NULL_DIR}"
    return f"{_escaped(part)}={_escaped(str(value).lower() if isinstance(value, bool) else str(value))}"


def _escaped(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in text)


def _named(directory: str, read: Callable[[str], Value]) -> Value:
    """The value that a folder of :func:`_directory` stands for."""
    text = directory.split("=", 1)[1]
    return None if text == _NULL_DIR else read(unquote(text))


def _chunks(items: list[str]) -> Iterable[Sequence[str]]:
    return (items[i : i + _SPECS_PER_STATEMENT] for i in range(0, len(items), _SPECS_PER_STATEMENT))


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _literal(value: Value) -> str:
    if value is None or value == "":
        return "NULL"
    if isinstance(value, (bool, int)):
        return str(value).lower()
    if isinstance(value, (dt.date, str)) and not isinstance(value, dt.datetime):
        return f"'{_quoted(str(value))}'"
    raise ValueError(f"not usable as a partition value: {value!r}")
