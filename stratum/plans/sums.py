"""Sums kept up to date from what merges add and take away: the table of current rows is not read.

A group's sums are exact decimals, so that what is taken away again leaves nothing behind; beside them stand the number of
terms that are not NULL and the number of rows, so that sums become NULL and groups vanish as in a full recompute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from stratum.functions.names import free_names, quoted
from stratum.operators import Summary
from stratum.sinks import tables
from stratum.sinks.images import marks_folder, read_images
from stratum.sinks.keyed import SIGN, merged_rows
from stratum.sources.tables import table_exists
from stratum.streaming import start_batches
from stratum.streaming.queries import AVAILABLE_NOW

EXACT = "decimal(38, 6)"
_MARK = "run string, batch long, done boolean"


def refresh_sums(
    spark: SparkSession,
    silver: str,
    table: str,
    summary: Summary,
    dim: str,
    changes: str,
    images: Sequence[str],
    checkpoint: str,
    exact: str = EXACT,
    path: str | None = None,
    trigger: str | None = AVAILABLE_NOW,
) -> StreamingQuery:
    """Add to ``table`` what the batches at ``changes`` that were not handled before add, and subtract what they take away.

    ``changes`` and ``images`` are those that :func:`stratum.plans.silver.refine_to_silver` fills, from the first row of
    ``silver`` on; the summary's expressions use the columns of ``images`` alone. ``table`` is created when missing, with a
    partition for each value of ``dim``; only partitions that get changes are read and switched. Terms are cast to
    ``exact`` one by one. :func:`read_sums` gives the sums as a full recompute would.

    Each partition remembers the last batch of this query that it has: one that is repeated after a crash passes over
    the partitions that were switched already. The checkpoint and the table belong together.
    """
    schema = merged_rows(spark, silver).schema
    rows = StructType([*(schema[c] for c in images), StructField(SIGN, IntegerType())])
    names = _state_names(summary)
    if not table_exists(spark, table):
        empty = _summed(spark.createDataFrame([], rows), summary, exact).withColumn(names[-1], F.lit(""))
        tables.create_table(empty, table, [dim], path)

    def add(marks: DataFrame, batch_id: int) -> None:
        session = marks.sparkSession
        batches = sorted((r.run, r.batch) for r in marks.select("run", "batch").distinct().collect())  # a row a batch
        delta = _summed(read_images(session, changes, batches, rows), summary, exact)
        run = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        _add(session, delta, table, summary, dim, f"{run} {batch_id:019}")

    # The folder exists from the first batch that is whole; before, there is nothing to do but to wait for one.
    spark.createDataFrame([], _MARK).write.mode("append").partitionBy("run", "batch").json(marks_folder(changes))
    marks = spark.readStream.schema(_MARK).json(marks_folder(changes))
    return start_batches(marks, add, checkpoint, trigger)


def _state_names(summary: Summary) -> list[str]:
    """The columns beside dimensions and sums: terms of each sum, rows, and the last batch."""
    return free_names([*(f"{name}_terms" for name in summary.sums), "rows", "applied"], [*summary.dims, *summary.sums])


def _summed(images: DataFrame, summary: Summary, exact: str) -> DataFrame:
    """Signed sums, terms and rows per group."""
    *terms, rows, _ = _state_names(summary)
    sign = F.col(SIGN)
    sums: list[Column] = []
    for (name, expression), counted in zip(summary.sums.items(), terms):
        term = expression.cast(exact)
        sums.append(F.sum(F.when(sign > 0, term).otherwise(-term)).cast(exact).alias(name))
        sums.append(F.sum(F.when(term.isNotNull(), sign).otherwise(0)).alias(counted))
    dims = [c.alias(name) for name, c in summary.dims.items()]
    return images.groupBy(*dims).agg(*sums, F.sum(sign).alias(rows))


def _add(spark: SparkSession, delta: DataFrame, table: str, summary: Summary, dim: str, batch: str) -> None:
    *terms, rows, applied = _state_names(summary)
    spark.catalog.refreshTable(table)
    # One value per partition to rewrite; the catalog is told about each of them in any case.
    values = [r[0] for r in delta.select(quoted(dim)).distinct().collect()]
    stored = spark.table(table).where(tables.listed(F.col(quoted(dim)), values))
    mine = F.col(applied).startswith(batch.split(" ")[0]) & (F.col(applied) >= batch)
    done = {r[0] for r in stored.where(mine).select(quoted(dim)).distinct().collect()}
    values = [v for v in values if v not in done]
    if not values:
        return
    within = tables.listed(F.col(quoted(dim)), values)
    dims = [quoted(name) for name in summary.dims]
    kinds = dict(stored.dtypes)
    both = stored.where(within).drop(applied).unionByName(delta.where(within))
    sums = [F.sum(quoted(n)).cast(kinds[n]).alias(n) for n in (*summary.sums, *terms, rows)]
    whole = both.groupBy(*dims).agg(*sums).where(F.col(rows) > 0).withColumn(applied, F.lit(batch))
    tables.replace_partitions(whole, table, dim, values)


def read_sums(spark: SparkSession, table: str, summary: Summary) -> DataFrame:
    """Dimensions and sums, as :func:`stratum.operators.summarize` over the current rows has them, in decimals."""
    *terms, _, _ = _state_names(summary)
    spark.catalog.refreshTable(table)
    sums = [F.when(F.col(counted) > 0, F.col(quoted(name))).alias(name) for name, counted in zip(summary.sums, terms)]
    return spark.table(table).select(*map(quoted, summary.dims), *sums)
