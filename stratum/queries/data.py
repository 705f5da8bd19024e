"""The driver's tables in the shapes the layers work on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratum.operators import Summary, latest_per_key

LINE_ORDER = ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_path(sf_dir: str, name: str) -> str:
    """The table as a stream source: a pattern, since a stream reads folders or patterns but no single file."""
    return f"{sf_dir}/{name}.parque[t]"


def event_payload(events: DataFrame) -> DataFrame:
    return events.select("event_id", "user_id", "event_type", "value")


def iso_text(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss")


def code(prefix: str, key: Column, digits: int) -> Column:
    """A key as text: the prefix and at least so many digits."""
    text = key.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(digits), F.length(text)), F.lit("0")))


def order_name(key: Column) -> Column:
    return code("ORD-", key, 8)


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region of every order. The small tables are left to the optimizer, which broadcasts by their size on disk."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("region"))
    named = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(named, customer.c_nationkey == named.n_nationkey)
        .select("o_orderkey", "region")
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a raw layer holds them: measures and dates as text, arrival time as lineage."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_quantity").cast("string").alias("quantity"),
        F.col("l_extendedprice").cast("string").alias("price"),
        iso_text(F.col("l_shipdate")).alias("order_date"),
        F.col("l_shipdate").alias("ingest_timestamp"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
    )


def line_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as sales for the landing folder: every line is a later version of its order."""
    return (
        table(spark, sf_dir, "lineitem")
        .join(regions(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            order_name(F.col("l_orderkey")).alias("order_id"),
            code("P", F.col("l_partkey"), 12).alias("product_id"),
            code("S", F.col("l_suppkey"), 12).alias("supplier_id"),
            F.col("l_linenumber").alias("line"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("price"),
            iso_text(F.col("l_shipdate")).alias("order_date"),
            "region",
        )
    )


def order_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sales: line 0, one unit at the order's total, on the order's own day."""
    return (
        table(spark, sf_dir, "orders")
        .drop("o_custkey")
        .join(regions(spark, sf_dir), "o_orderkey")
        .select(
            order_name(F.col("o_orderkey")).alias("order_id"),
            F.lit("P").alias("product_id"),
            F.lit("S").alias("supplier_id"),
            F.lit(0).alias("line"),
            F.lit(1).alias("quantity"),
            F.col("o_totalprice").alias("price"),
            iso_text(F.col("o_orderdate")).alias("order_date"),
            "region",
        )
    )


def arrivals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders a year late, then the even ones on their own, older day; some rows of the second have no key."""
    orders = order_sales(spark, sf_dir)
    number = F.substring("order_id", 5, 20).cast("long")
    first = orders.withColumn("order_date", iso_text(F.add_months(F.to_date("order_date"), 12).cast("timestamp")))
    second = orders.where(number % 2 == 0).withColumn("order_id", F.when(number % 10 != 0, F.col("order_id")))
    return first, second


def spoiled_lines(sales: DataFrame) -> DataFrame:
    """Sales as JSON text, every seventh line broken, and of every five others one with a bad number, price or day."""
    number = F.substring("order_id", 5, 20).cast("long")
    spoiled = sales.withColumns(
        {
            "quantity": F.when(number % 5 == 1, "many").otherwise("3.7"),
            "price": F.when(number % 5 == 2, "12,5").otherwise(F.col("price").cast("string")),
            "order_date": F.when(number % 5 == 3, "no day").otherwise(F.col("order_date")),
        }
    )
    line = F.to_json(F.struct(*spoiled.columns))
    return spoiled.select(F.when(number % 7 == 0, F.concat(F.lit("{broken "), "order_id")).otherwise(line).alias("value"))


def unique_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (order, line number)."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_ORDER, "l_orderkey", "l_quantity", "l_returnflag")
    keys = ["l_orderkey", "l_linenumber"]
    ties = ["l_partkey", "l_suppkey"]
    return latest_per_key(lines, keys, ["l_shipdate"], ties).select(*keys, "l_quantity", "l_returnflag")


def shifted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A revision of all lines under the next line number: some exist, some are new, the first ones are left alone."""
    return unique_lines(spark, sf_dir).select(
        "l_orderkey",
        (F.col("l_linenumber") + 1).alias("l_linenumber"),
        F.lit(0.0).alias("l_quantity"),
        F.lit("X").alias("l_returnflag"),
    )


def order_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")


def revised_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A revision of as many orders under doubled keys: even keys exist, those past the end are new."""
    return table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") * 2).alias("o_orderkey"),
        F.lit("REVISED").alias("o_orderpriority"),
        F.lit(-1.0).alias("o_totalprice"),
    )


def later_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A revision of as many orders under keys that begin later: the last ones exist, the others are new."""
    return table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + 10_000).alias("o_orderkey"),
        F.lit("LATER").alias("o_orderpriority"),
        F.col("o_totalprice"),
    )


def regional_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return orders.join(regions(spark, sf_dir), "o_orderkey")


def daily_orders() -> Summary:
    return Summary(
        dims={"order_day": F.col("o_orderdate").cast("date"), "region": F.col("region")},
        sums={"total_revenue": F.col("o_totalprice"), "total_units": F.lit(1)},
    )


def daily_lines(by_month: bool = False) -> Summary:
    day = F.col("l_shipdate").cast("date")
    month = {"order_month": F.trunc(day, "MM")} if by_month else {}
    return Summary(
        dims={"order_day": day, "l_returnflag": F.col("l_returnflag"), **month},
        sums={
            "total_revenue": F.col("l_quantity") * F.col("l_extendedprice"),
            "total_units": F.col("l_quantity").cast("int"),
        },
    )


def daily_events() -> Summary:
    return Summary(
        dims={"event_day": F.col("ts").cast("date"), "event_type": F.col("event_type")},
        sums={"total_revenue": F.col("value"), "total_units": F.col("user_id").cast("int")},
    )


def in_cents(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sums of doubles depend on the order of addition in their last digits: compare them to the cent."""
    return df.withColumn("total_revenue", F.round("total_revenue", 2)).select(*columns)
