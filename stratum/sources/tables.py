"""Stored layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_layer(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """The layer at ``path`` with ``schema``, or with all columns that any of its files has.

    Files of a layer that has grown differ in their columns. Finding them all reads the footer of every file: give the
    schema where there are very many.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        return reader.schema(schema).load(path)
    return (reader.option("mergeSchema", True) if fmt in ("parquet", "orc") else reader).load(path)


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)
