"""A raw layer in volumes: one is open and grows by small files, those before are closed, refined, and rewritten large.

A stream that reads a layer knows its files by their paths, so files of a layer that is read cannot be replaced. A volume
can: the ingest moves on to the next one, the refinement reads each to its end under a checkpoint of its own, and only
then is it rewritten into the archive and its small files removed. No row is read twice by the refinement and none is
missed, and what is listed at a start stays as small as the volumes that are not archived.

In a volume every batch of the ingest has a folder, which a batch that is repeated after a crash replaces.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from stratum.plans.ingest import file_rows
from stratum.plans.silver import refine_to_silver
from stratum.session import PARSED_BYTES, small_splits
from stratum.sinks.files import write_layer
from stratum.sources import read_layer, recorded_layer
from stratum.streaming import start_batches, wait_all
from stratum.streaming.queries import RAW_FILES, with_partitions

Spec = Mapping[str, Any]
# What a volume is, in this order; it never goes back.
OPEN, CLOSED, REFINED, ARCHIVED = range(4)
_STATES = "volume int, state int"


def volume_path(bronze: str, volume: int) -> str:
    return f"{bronze}/v{volume:06}"


def _batches(bronze: str, volume: int) -> str:
    """The batches of a volume, as a pattern."""
    return f"{volume_path(bronze, volume)}/b*"


def archive_path(bronze: str, volume: int) -> str:
    return f"{bronze}/archive/v{volume:06}"


def volumes(spark: SparkSession, bronze: str) -> dict[int, int]:
    """The state of each volume; the last one is open. A layer that was never written to has the volume 0."""
    try:
        rows = spark.read.schema(_STATES).json(f"{bronze}/_volumes/states")
        found = {r.volume: r.state for r in rows.groupBy("volume").agg(F.max("state").alias("state")).collect()}
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = {}
    return dict(sorted(found.items())) or {0: OPEN}


def _note(spark: SparkSession, bronze: str, *states: tuple[int, int]) -> None:
    """One file, so that all of the states are noted or none."""
    spark.createDataFrame(list(states), _STATES).coalesce(1).write.mode("append").json(f"{bronze}/_volumes/states")


def _over_all(spec: Spec) -> dict[str, Any]:
    """The dataset with all its volumes, where new names are looked for."""
    return {**spec, "bronze_path": f"{spec['bronze_path']}/v*/b*"}


def ingest_volume(spark: SparkSession, spec: Spec, timeout: float | None = None) -> None:
    """Read every new file of a dataset into the open volume. ``spec`` is that of :func:`ingest_files`; one run at a time."""
    bronze = spec["bronze_path"]
    volume = max(volumes(spark, bronze))
    rows = file_rows(spark, _over_all(spec))
    parts, fmt = spec.get("partition_cols", ()), spec.get("table_format", "parquet")

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = with_partitions(batch, parts).write.mode("overwrite").format(fmt).partitionBy(*parts)
        writer.options(**RAW_FILES).save(f"{volume_path(bronze, volume)}/b{batch_id:09}")

    with small_splits(spark, PARSED_BYTES):
        ended = wait_all([start_batches(rows, write, spec["autoloader"]["checkpointLocation"])], timeout)
    if not ended:
        raise TimeoutError(f"dataset {spec.get('name')!r} is still running after {timeout} s")


def close_volume(spark: SparkSession, spec: Spec, timeout: float | None = None) -> int:
    """Close the open volume and open the next one, whose number is returned.

    The ingest is run to its end first. A batch that was lost before its checkpoint was written is so completed where
    it was begun, and could not come again in the next volume.
    """
    ingest_volume(spark, spec, timeout)
    file_rows(spark, _over_all(spec))  # the last fields that were kept aside are heard of before they are archived
    last = max(volumes(spark, spec["bronze_path"]))
    _note(spark, spec["bronze_path"], (last, CLOSED), (last + 1, OPEN))
    return last + 1


def refine_volumes(
    spark: SparkSession,
    bronze: str,
    table: str,
    keys: Sequence[str],
    types: Mapping[str, str],
    checkpoint: str,
    rejects: str,
    schema_location: str,
    timeout: float | None = None,
    **options,
) -> None:
    """:func:`refine_to_silver` over all volumes that are not archived, one after the other, each to its end.

    A closed volume that was read to its end is noted as refined. ``options`` go to the refinement.
    """
    if options.get("trigger", "availableNow") != "availableNow":
        raise ValueError("volumes are refined to their end, one after the other")
    for volume, state in volumes(spark, bronze).items():
        if state in (REFINED, ARCHIVED) or not _written(spark, volume_path(bronze, volume)):
            if state == CLOSED:
                _note(spark, bronze, (volume, REFINED))  # closed with nothing in it
            continue
        query = refine_to_silver(
            spark, _batches(bronze, volume), table, keys, types, f"{checkpoint}/v{volume:06}", rejects,
            schema_location=schema_location, **options,
        )
        if not wait_all([query], timeout):
            raise TimeoutError(f"{table} is still being refined after {timeout} s")
        if state == CLOSED:
            _note(spark, bronze, (volume, REFINED))


def compact_layer(spark: SparkSession, bronze: str, schema_location: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> int:
    """Rewrite every refined volume into the archive and remove its small files. Returns how many were rewritten.

    A volume is noted as archived once its rows are there and counted, and removed after that: a run that is lost leaves
    it readable in one place or in both, and the next run completes it. Whoever still reads the volume itself, as a
    full read that has begun, must start again.
    """
    done = 0
    for volume, state in volumes(spark, bronze).items():
        small, large = volume_path(bronze, volume), archive_path(bronze, volume)
        if state == REFINED:
            if _written(spark, small):
                schema = recorded_layer(spark, schema_location)
                rows = read_layer(spark, _batches(bronze, volume), fmt, schema)
                write_layer(rows.hint("rebalance"), large, partition_by, fmt)
                kept, had = read_layer(spark, large, fmt, schema).count(), rows.count()
                if kept != had:
                    raise RuntimeError(f"{large} has {kept} rows of {had}")
            _note(spark, bronze, (volume, ARCHIVED))
            done += 1
        if state in (REFINED, ARCHIVED):
            _remove(spark, small)
    return done


def read_volumes(spark: SparkSession, bronze: str, schema_location: str, fmt: str = "parquet") -> DataFrame:
    """The whole layer, archived volumes from the archive, with the columns that its record names."""
    schema: StructType = recorded_layer(spark, schema_location)
    rows = spark.createDataFrame([], schema)
    for volume, state in volumes(spark, bronze).items():
        archived = state == ARCHIVED
        if _written(spark, archive_path(bronze, volume) if archived else volume_path(bronze, volume)):
            path = archive_path(bronze, volume) if archived else _batches(bronze, volume)
            rows = rows.unionByName(read_layer(spark, path, fmt, schema))
    return rows


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _written(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def _remove(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)
