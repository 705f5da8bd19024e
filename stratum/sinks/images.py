"""What merges add and take away, a folder a batch, each change once whatever is lost and repeated.

A batch that is repeated gives the rows of a bucket again if the first attempt had not switched that bucket, and none if it
had. So each bucket's rows have a folder of their own within the batch's, and only the folders that get rows are replaced.
A mark, written after the merge, says that a batch is whole.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from stratum.sinks.keyed import IMAGE_BUCKET


def write_images(images: DataFrame, changes: str, run: str, batch: int) -> None:
    """Note for :func:`stratum.sinks.upsert_table`: the rows of the buckets that have any, in place of their former ones."""
    writer = images.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(IMAGE_BUCKET)
    writer.parquet(batch_folder(changes, run, batch))


def mark_done(spark: SparkSession, changes: str, run: str, batch: int) -> None:
    """Say that a batch is whole, unless that was said already: a second file would be a second mark to who reads them."""
    path = f"{marks_folder(changes)}/run={run}/batch={batch}"
    try:
        if not spark.read.schema("done boolean").json(path).isEmpty():
            return
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    spark.createDataFrame([(True,)], "done boolean").coalesce(1).write.mode("overwrite").json(path)


def read_images(spark: SparkSession, changes: str, batches: list[tuple[str, int]], schema: StructType) -> DataFrame:
    """The rows that the named batches have added and taken away."""
    paths = []
    for run, batch in batches:
        folder = batch_folder(changes, run, batch)
        try:
            spark.read.schema(schema).parquet(folder)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise  # a batch that changed nothing has no folder
        else:
            paths.append(folder)
    return spark.read.schema(schema).option("basePath", f"{changes}/rows").parquet(*paths) if paths else spark.createDataFrame([], schema)


def batch_folder(changes: str, run: str, batch: int) -> str:
    return f"{changes}/rows/run={run}/batch={batch}"


def marks_folder(changes: str) -> str:
    return f"{changes}/done"
