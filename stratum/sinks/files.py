"""Plain files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Replace what is at ``path``, laid out by ``partition_by``."""
    gather(df, partition_by).write.format(fmt).mode("overwrite").partitionBy(*partition_by).save(path)


def gather(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring rows of one partition value together so that it gets few files, without forcing them into one task.

    Rebalancing is adaptive: small values share a task, a value that holds most of the rows is split over many.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def export_json(df: DataFrame, path: str, max_records_per_file: int = 0, compression: str = "none") -> None:
    """Append rows as JSON files, in parallel; ``max_records_per_file`` bounds the size of each.

    Compressed files take a fraction of the space, but each is read by one task: bound their records then.
    """
    df.write.mode("append").option("maxRecordsPerFile", max_records_per_file).option("compression", compression).json(path)
