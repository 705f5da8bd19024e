"""Where a job may put working files."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
_PARTITIONS = "spark.sql.shuffle.partitions"
_BATCHES = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch")
# What a task that sorts the rows it reads may read: Parquet grows manyfold when it becomes rows.
_SORTED_BYTES = 16 << 20
# What a task that parses text may read: compressed text grows as much, and the last tasks are waited for by all cores.
PARSED_BYTES = 64 << 20
_UNITS = {"": 1, "b": 1, **{u + b: 1 << 10 * i for i, u in enumerate("kmgt", 1) for b in ("", "b")}}


@contextmanager
def small_splits(spark: SparkSession, most: int = _SORTED_BYTES) -> Iterator[None]:
    """Scans planned in here, also those of streams that run in here, give a task no more than ``most`` bytes, however
    large the input: by default what it can sort in memory."""
    had = spark.conf.get(_SPLIT_BYTES)
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-z]*)\s*", had.lower()).groups()
    if int(number) * _UNITS[unit] <= most:
        yield
        return
    spark.conf.set(_SPLIT_BYTES, str(most))
    try:
        yield
    finally:
        spark.conf.set(_SPLIT_BYTES, had)


@contextmanager
def enough_partitions(spark: SparkSession, least: int) -> Iterator[None]:
    """Shuffles planned in here have at least so many partitions, whatever the session gives them; adaptive execution
    puts small ones together."""
    had = spark.conf.get(_PARTITIONS)
    if int(had) >= least:
        yield
        return
    spark.conf.set(_PARTITIONS, str(least))
    try:
        yield
    finally:
        spark.conf.set(_PARTITIONS, had)


@contextmanager
def small_batches(spark: SparkSession, most: int = 500) -> Iterator[None]:
    """What runs in here reads, and hands to Python, no more than so many rows at once: their texts are in memory
    together, several times over, in each task."""
    had = {name: spark.conf.get(name) for name in _BATCHES}
    large = [name for name, rows in had.items() if not 0 < int(rows) <= most]
    try:
        for name in large:
            spark.conf.set(name, str(most))
        yield
    finally:
        for name in large:
            spark.conf.set(name, had[name])


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``, which all executors share.

    Where the setting is missing, as in a test, it is a folder of this process's own: that only serves a driver and
    executors on one machine.
    """
    return (spark.conf.get(CHECKPOINT_DIR, None) or _own_dir()).rstrip("/")


@lru_cache(maxsize=1)
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="stratum-shared-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nobody else uses."""
    return f"{shared_dir(spark)}/stratum-{label}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession, label: str) -> int:
    """Remove the folders that :func:`scratch_dir` has given out for ``label``, and the tables that lie in them.

    Frames read from them are gone with them. Returns how many folders there were.
    """
    for found in spark.catalog.listTables():
        if found.tableType == "MANAGED" or found.isTemporary or not found.name.startswith("stratum_"):
            continue
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {found.name}").where("col_name = 'Location'").first()
        if described and f"/stratum-{label}-" in described.data_type:
            spark.sql(f"DROP TABLE {found.name}")
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/stratum-{label}-*")
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = [status.getPath() for status in files.globStatus(pattern) or []]
    return sum(files.delete(folder, True) for folder in folders)
