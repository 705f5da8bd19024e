"""What several operators of this package need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratum.functions import quoted
from stratum.session import scratch_dir

# Space, tab, line feed, vertical tab, form feed, carriage return: what separates words here.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str, tasks: int | None = None) -> DataFrame:
    """The frame written below the shared folder and read again: its lineage ends there and survives lost executors.

    At most `tasks` tasks write it, a file each; else as many as Spark deals it to, even if they have a few rows each.
    """
    path = scratch_dir(frame.sparkSession, label)
    (frame.coalesce(tasks) if tasks else frame).write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_key(column: str = "text") -> Column:
    """A hash that tells rows with the same doc_id apart by their texts."""
    return F.xxhash64(text_of(column))


def row_struct(docs: DataFrame) -> Column:
    """A whole row as one value: the caller's columns, whatever they are called, beside those of an operator."""
    return F.struct(*(F.col(quoted(c)) for c in docs.columns))


def row_key(docs: DataFrame) -> Column:
    """A hash of all columns that can be hashed: rows that share it are alike, or differ in maps and variants alone."""
    plain = [f.name for f in docs.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    return F.xxhash64(*(F.col(quoted(c)) for c in plain))


def chosen_rows(docs: DataFrame, chosen: DataFrame, key: Column | None = None, times: str | None = None) -> DataFrame:
    """The rows of `docs` that `chosen` (doc_id, key) names by doc_id, which may be null, and `key` (`text_key`); each once.

    Of several such rows that with the smallest `row_key` is taken, so the same one in every run. `times`: a column of
    `chosen` that says how often a row is returned.
    """
    own = docs.select(
        row_struct(docs).alias("row"),
        F.col("doc_id").cast("long").alias("id"),
        (text_key() if key is None else key).alias("key"),
        row_key(docs).alias("order"),
    )
    often = [F.col(times).alias("times")] if times else []
    keep = chosen.select(F.col("doc_id").alias("chosen_id"), F.col("key").alias("chosen_key"), *often)
    same = F.col("id").eqNullSafe(F.col("chosen_id")) & (F.col("key") == F.col("chosen_key"))
    joined = own.join(keep, same, "inner" if times else "left_semi")
    first = joined.groupBy("id", "key", *(["times"] if times else [])).agg(F.min_by("row", "order").alias("row"))
    if times:
        first = first.select("row", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return first.select("row.*")
