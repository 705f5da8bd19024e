"""Queries that are one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from stratum.operators import (
    apply_types,
    decode_value,
    encode_value,
    enrich_lineage,
    latest_by_aggregate,
    latest_per_key,
    refresh_summary,
    split_null_keys,
    summarize,
    upsert_frames,
)
from stratum.operators.lineage import FILE_SYSTEM, MESSAGE_SYSTEM
from stratum.plans.sales import SALES_KEYS, SALES_TYPES, daily_sales
from stratum.queries import data
from stratum.queries.data import daily_lines, in_cents, table

SALES_COLUMNS = ("order_day", "region", "total_revenue", "total_units")
LINE_COLUMNS = ("order_day", "l_returnflag", "total_revenue", "total_units")


def medallion_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines to daily revenue by region: type, keep the latest line of each order, look up its region, sum.

    The region is looked up after one line per order is left, on the partitioning by order that is already there.
    """
    typed = apply_types(data.raw_lines(spark, sf_dir), SALES_TYPES)
    current = latest_per_key(
        typed, SALES_KEYS, ["ingest_timestamp"], ["l_linenumber", "l_partkey", "l_suppkey"]
    ).select("order_id", "order_date", "quantity", "price")
    regions = data.regions(spark, sf_dir)
    sales = current.join(regions, current.order_id == regions.o_orderkey)
    return in_cents(summarize(sales, daily_sales()), SALES_COLUMNS)


def lineage_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich_lineage(table(spark, sf_dir, "events"), FILE_SYSTEM)
    return rows.select(
        "event_id",
        "event_type",
        "source_system",
        # The table's own name, whether it is a file or a folder of files.
        F.regexp_extract("source_file", r"[^/]+\.parquet", 0).alias("source_file"),
        F.col("ingest_timestamp").isNotNull().alias("stamped"),
    )


def lineage_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich_lineage(table(spark, sf_dir, "events"), MESSAGE_SYSTEM)
    return rows.select(
        "event_id",
        "event_type",
        "source_system",
        "source_file",
        F.col("ingest_timestamp").isNotNull().alias("stamped"),
    )


def decode_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = data.event_payload(table(spark, sf_dir, "events"))
    messages = encode_value(events).select(F.col("value").cast("binary").alias("value"))
    return decode_value(messages)


def decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "events").select("event_id", F.col("props").cast("binary").alias("value"))
    schema = StructType([StructField("k", IntegerType())])
    rows = decode_value(messages, schema, keep_source_columns=True)
    return rows.select("message.event_id", "k", F.col("_corrupt_record").isNull().alias("well_formed"))


def encode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_value(table(spark, sf_dir, "events"), ["event_id", "user_id", "event_type", "value"])


def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text with values that do not parse: a bad day, price or number depending on the priority."""
    priority = F.col("o_orderpriority")
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(priority == "1-URGENT", "n/a").otherwise(data.iso_text(F.col("o_orderdate"))).alias("order_date"),
        F.when(priority == "2-HIGH", "12,5").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(priority == "3-MEDIUM", "")
        .when(priority == "4-NOT SPECIFIED", ".5")
        .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".7")))
        .alias("quantity"),
    )
    return apply_types(raw, SALES_TYPES)


def split_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of which the urgent ones have lost their key: both sides of the split, told apart by a flag."""
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderkey")).alias("order_id"), "o_totalprice"
    )
    keyed, rejects = split_null_keys(orders, ["order_id"])
    return keyed.withColumn("rejected", F.lit(False)).unionByName(rejects.withColumn("rejected", F.lit(True)))


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", *data.LINE_ORDER, "l_quantity", "l_extendedprice", "l_returnflag"
    )
    return latest_per_key(lines, ["l_orderkey"], ["l_shipdate"], ["l_linenumber", "l_partkey", "l_suppkey"])


def dedup_latest_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows by a partial aggregate instead of a rank."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", *data.LINE_ORDER, "l_quantity", "l_extendedprice", "l_returnflag"
    )
    return latest_by_aggregate(lines, ["l_orderkey"], ["l_shipdate"], ["l_linenumber", "l_partkey", "l_suppkey"])


def upsert_one_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert_frames(data.order_prices(spark, sf_dir), data.revised_orders(spark, sf_dir), ["o_orderkey"])


def upsert_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert_frames(
        data.unique_lines(spark, sf_dir), data.shifted_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"]
    )


def daily_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_cents(summarize(table(spark, sf_dir, "lineitem"), daily_lines()), LINE_COLUMNS)


def daily_gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums taken before the returned lines came in, refreshed for the days on which there are any."""
    lines = table(spark, sf_dir, "lineitem")
    before = summarize(lines.where("l_returnflag <> 'R'"), daily_lines())
    touched = lines.where("l_returnflag = 'R'").select(F.col("l_shipdate").cast("date").alias("day"))
    return in_cents(refresh_summary(before, lines, daily_lines(), "order_day", touched), LINE_COLUMNS)


FRAME_QUERIES = {
    f.__name__: f
    for f in (
        medallion_sales,
        lineage_file,
        lineage_stream,
        decode_raw,
        decode_json,
        encode_json,
        typed_projection,
        split_rejects,
        dedup_latest,
        dedup_latest_aggregate,
        upsert_one_key,
        upsert_two_keys,
        daily_gold,
        daily_gold_refresh,
    )
}
