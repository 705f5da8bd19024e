"""Queries that go through files, tables and streams.

Each run works in a folder of its own below the shared folder of the session and returns a frame that reads the stored
result, so nothing is kept in memory or passed through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from stratum.functions import field_of, quoted
from stratum.operators import encode_value, summarize
from stratum.operators.lineage import INGEST_TIMESTAMP
from stratum.plans import (
    SALES_KEYS,
    SALES_TYPES,
    close_volume,
    compact_layer,
    daily_sales,
    ingest_all,
    ingest_files,
    ingest_messages,
    publish_gold,
    read_sums,
    read_volumes,
    refine_to_silver,
    refine_volumes,
    refresh_gold,
    refresh_silver,
    refresh_sums,
)
from stratum.queries import data
from stratum.queries.data import daily_lines, in_cents, table
from stratum.queries.frames import LINE_COLUMNS, SALES_COLUMNS
from stratum.session import PARSED_BYTES, scratch_dir, small_splits
from stratum.sinks import (
    append_rows,
    ensure_namespace,
    export_json,
    fold_rows,
    publish_table,
    publish_view,
    read_current,
    upsert_table,
    write_layer,
)
from stratum.sources import read_layer
from stratum.sources.schemas import read_record
from stratum.streaming import wait_all

_EVENT_COLUMNS = ("event_id", "user_id", "event_type", "value")
_TYPES = {**SALES_TYPES, "line": "int"}
# Days order the versions of a sale; line numbers and codes settle the rest.
_NEWEST = ("order_date", "line", "product_id", "supplier_id")
_SILVER_COLUMNS = ("order_id", "order_date", "quantity", "price", "region")


def _names(spark: SparkSession, label: str) -> tuple[str, str]:
    """(working folder, table name), both used by nobody else."""
    home = scratch_dir(spark, label)
    return home, "stratum_" + home.rsplit("stratum-", 1)[1].replace("-", "_")


def _event_spec(home: str, sf_dir: str) -> dict[str, Any]:
    return {
        "name": "events",
        "type": "file",
        "format": "parquet",
        "landing_path": data.stream_path(sf_dir, "events"),
        "bronze_path": f"{home}/bronze",
        "autoloader": {"schemaLocation": f"{home}/schema", "checkpointLocation": f"{home}/checkpoint"},
        "batch": {"enabled": True, "trigger": "availableNow"},
    }


def _message_spec(home: str) -> dict[str, Any]:
    return {
        "name": "messages",
        "type": "kafka",
        "bronze_path": f"{home}/bronze",
        "checkpointLocation": f"{home}/checkpoint",
        "schema": f"{home}/declared",
        "streaming": {"enabled": True, "trigger": "availableNow"},
    }


def _event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of binary JSON messages."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(data.stream_path(sf_dir, "events"))
    return encode_value(data.event_payload(events)).select(F.col("value").cast("binary").alias("value"))


def _declare(spark: SparkSession, sf_dir: str, path: str) -> None:
    _write_schema(spark, data.event_payload(table(spark, sf_dir, "events")).schema, path)


def _write_schema(spark: SparkSession, schema: StructType, path: str) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").write.mode("overwrite").text(path)


def ingest_files_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    home, _ = _names(spark, "ingest")
    wait_all([ingest_files(spark, _event_spec(home, sf_dir))])
    return read_layer(spark, f"{home}/bronze").select(
        "event_id", "user_id", "event_type", "value", "props", "source_system"
    )


def ingest_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ingest started a second time finds nothing new."""
    home, _ = _names(spark, "restart")
    for _ in range(2):
        wait_all([ingest_files(spark, _event_spec(home, sf_dir))])
    return read_layer(spark, f"{home}/bronze").select("event_id", "event_type", "value")


def ingest_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw layer partitioned by the day of ingest."""
    home, _ = _names(spark, "partitioned")
    spec = {**_event_spec(home, sf_dir), "partition_cols": ["ingest_date"]}
    wait_all([ingest_files(spark, spec)])
    return read_layer(spark, f"{home}/bronze").select(
        "event_id", "value", (F.col("ingest_date") == F.to_date("ingest_timestamp")).alias("same_day")
    )


def ingest_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in three arrivals, of which the last two have a field that the first has not: kept aside once, then taken up."""
    home, _ = _names(spark, "evolving")
    spec = {**_event_spec(home, sf_dir), "format": "json", "landing_path": f"{home}/landing"}
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    for part, columns in enumerate((["event_id", "event_type"], events.columns, events.columns)):
        export_json(events.where(F.col("event_id") % 3 == part).select(*columns), f"{home}/landing")
        wait_all([ingest_files(spark, spec)])
    layer = read_layer(spark, f"{home}/bronze")
    value = F.coalesce("value", F.get_json_object("_rescued", "$.value"))
    return layer.select(F.col("event_id").cast("long").alias("event_id"), "event_type", value.cast("double").alias("value"))


def _spelled(frame: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Lines of JSON with the values of the columns as text, under fields of any name."""
    pairs = [x for field, column in names.items() for x in (F.lit(field), F.col(column).cast("string"))]
    return frame.select(F.to_json(F.create_map(*pairs)).alias("value"))


def ingest_archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in three arrivals; files that were ingested leave the landing folder, and a start after that finds only its own."""
    home, _ = _names(spark, "archived")
    spec = {**_event_spec(home, sf_dir), "format": "json", "landing_path": f"{home}/landing", "archive": f"{home}/archive"}
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    for part in range(3):
        export_json(events.where(F.col("event_id") % 3 == part), f"{home}/landing")
        for _ in range(2):
            wait_all([ingest_files(spark, spec)])
    layer = read_layer(spark, f"{home}/bronze")
    return layer.select(F.col("event_id").cast("long").alias("event_id"), "event_type", F.col("value").cast("double").alias("value"))


def ingest_odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in four arrivals. From the second on they have fields whose names another column has in another case, the
    raw layer needs for itself, or no column may have: kept aside once, then columns, and all of them current rows."""
    home, name = _names(spark, "odd")
    spec = {**_event_spec(home, sf_dir), "format": "json", "landing_path": f"{home}/landing"}
    events = table(spark, sf_dir, "events")
    plain = {"event_id": "event_id", "event_type": "event_type"}
    odd = {"Event_Type": "value", "_rescued": "user_id", "_metadata": "event_type", "source_file": "event_id", "slot": "user_id", "a.`b`": "value"}
    for part in range(4):
        lines = _spelled(events.where(F.col("event_id") % 4 == part), plain if part == 0 else plain | odd)
        lines.write.mode("append").text(f"{home}/landing")
        wait_all([ingest_files(spark, spec)])
        query = refine_to_silver(
            spark,
            f"{home}/bronze",
            name,
            ["event_id"],
            {},
            checkpoint=f"{home}/checkpoints/silver",
            rejects=f"{home}/rejects",
            schema_location=f"{home}/schema",
            path=f"{home}/silver",
            buckets=8,
        )
        wait_all([query])
    column = {field_of(f): quoted(f.name) for f in read_record(spark, f"{home}/schema").schema.fields}
    kept = lambda field: F.coalesce(F.col(column[field]), F.element_at(F.from_json("_rescued", "map<string,string>"), field))
    return read_current(spark, name).select(
        F.col("event_id").cast("long").alias("event_id"),
        "event_type",
        kept("Event_Type").cast("double").alias("value"),
        kept("_rescued").cast("long").alias("user_id"),
        kept("_metadata").alias("event_type_again"),
        kept("source_file").cast("long").alias("event_id_again"),
        kept("slot").cast("long").alias("user_id_again"),
        kept("a.`b`").cast("double").alias("value_again"),
        F.col("source_file").contains("/landing/").alias("from_landing"),
    )


def stream_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message dataset without a trigger: micro-batches follow one another until the query is stopped."""
    home, _ = _names(spark, "continuous")
    _declare(spark, sf_dir, f"{home}/declared")
    spec = {**_message_spec(home), "streaming": {"enabled": True}}
    query = ingest_messages(spark, spec, _event_messages(spark, sf_dir))
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return read_layer(spark, f"{home}/bronze").select(*_EVENT_COLUMNS, "source_system")


def ingest_messages_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    home, _ = _names(spark, "messages")
    _declare(spark, sf_dir, f"{home}/declared")
    wait_all([ingest_messages(spark, _message_spec(home), _event_messages(spark, sf_dir))])
    return read_layer(spark, f"{home}/bronze").select(*_EVENT_COLUMNS, "source_system", "source_file")


def ingest_messages_undeclared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which a schema names two fields: the others are kept aside, and can be asked of the whole payload."""
    home, _ = _names(spark, "undeclared")
    _write_schema(spark, StructType.fromDDL("event_id long, event_type string"), f"{home}/declared")
    spec = {**_message_spec(home), "keep_payload": True}
    wait_all([ingest_messages(spark, spec, _event_messages(spark, sf_dir))])
    return read_layer(spark, f"{home}/bronze").select(
        "event_id",
        "event_type",
        F.get_json_object("_rescued", "$.user_id").cast("long").alias("user_id"),
        F.try_variant_get("payload", "$.value", "double").alias("value"),
        F.array_join(F.array_sort(F.json_object_keys("_rescued")), ",").alias("kept_aside"),
    )


def ingest_messages_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    home, _ = _names(spark, "messages")
    spec = {k: v for k, v in _message_spec(home).items() if k != "schema"}
    wait_all([ingest_messages(spark, spec, _event_messages(spark, sf_dir))])
    return read_layer(spark, f"{home}/bronze").select("value", "source_system")


def ingest_all_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two datasets side by side: the events as files and as messages."""
    home, _ = _names(spark, "specs")
    _declare(spark, sf_dir, f"{home}/b/declared")
    specs = [_event_spec(f"{home}/a", sf_dir), _message_spec(f"{home}/b")]
    ingest_all(spark, specs, messages={"messages": _event_messages(spark, sf_dir)})
    layers = [read_layer(spark, f"{home}/{part}/bronze") for part in "ab"]
    wanted = ("event_id", "event_type", "source_system")
    return layers[0].select(*wanted).unionByName(layers[1].select(*wanted))


def export_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    home, _ = _names(spark, "export")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    export_json(orders, home, max_records_per_file=1_000_000)
    return spark.read.schema(orders.schema).json(home)


def overwrite_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    home, _ = _names(spark, "layer")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    for _ in range(2):
        write_layer(orders, home, ["o_orderstatus"])
    return read_layer(spark, home)


def overwrite_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    home, _ = _names(spark, "layer")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    for _ in range(2):
        write_layer(orders, home)
    return read_layer(spark, home)


def upsert_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    home, name = _names(spark, "create")
    upsert_table(data.order_prices(spark, sf_dir), name, ["o_orderkey"], buckets=8, path=home)
    return read_current(spark, name)


def upsert_stored_one_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    home, name = _names(spark, "one")
    upsert_table(data.order_prices(spark, sf_dir), name, ["o_orderkey"], buckets=8, path=home)
    upsert_table(data.revised_orders(spark, sf_dir), name, ["o_orderkey"])
    return read_current(spark, name)


def upsert_stored_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    home, name = _names(spark, "two")
    keys = ["l_orderkey", "l_linenumber"]
    upsert_table(data.unique_lines(spark, sf_dir), name, keys, buckets=8, pieces=2, path=home)
    upsert_table(data.shifted_lines(spark, sf_dir), name, keys)
    return read_current(spark, name)


def upsert_own_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of current rows whose columns are called what the library calls its own: merged twice, published twice."""
    home, name = _names(spark, "own")

    def odd(orders: DataFrame) -> DataFrame:
        own = {"slot": "o_orderpriority", "key_bucket": "o_orderkey", "_rank": "o_totalprice", "_from_source": "o_orderpriority"}
        own |= {"_piece": "o_totalprice", "_task": "o_orderkey", "_change": "o_orderpriority", "_new": "o_totalprice"}
        return orders.select("o_orderkey", "o_orderpriority", *(F.col(c).alias(n) for n, c in own.items()))

    for orders in (data.order_prices(spark, sf_dir), data.revised_orders(spark, sf_dir)):
        upsert_table(odd(orders), name, ["o_orderkey"], buckets=8, path=f"{home}/silver")
        publish_table(read_current(spark, name), f"{name}_gold", ["slot"], f"{home}/gold")
    return spark.table(f"{name}_gold")


def upsert_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later versions of order lines in small batches beside the table: one folded in, one still pending when it is read."""
    home, name = _names(spark, "appended")
    keys, newest = ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]
    lines = table(spark, sf_dir, "lineitem").select(*keys, *newest, "l_quantity", "l_returnflag")
    upsert_table(lines.where("l_quantity <= 25"), name, keys, newest, [], buckets=8, path=home)
    append_rows(lines.where("l_quantity > 40"), name, keys, newest, [])
    fold_rows(spark, name)
    append_rows(lines.where("l_quantity > 25"), name, keys, newest, [])
    return read_current(spark, name).select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


def silver_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, then their lines as later versions, in micro-batches that are appended and folded in now and then."""
    home, name = _names(spark, "appending")
    for sales in (data.order_sales(spark, sf_dir), data.line_sales(spark, sf_dir)):
        _land(spark, sales, home)
        query = refine_to_silver(
            spark, f"{home}/bronze", name, SALES_KEYS, _TYPES, f"{home}/checkpoints/silver", f"{home}/rejects", _NEWEST,
            options={"maxFilesPerTrigger": "4"}, schema_location=f"{home}/schema", fold_after=12, path=f"{home}/silver", buckets=8,
        )
        wait_all([query])
    return read_current(spark, name).select(*_SILVER_COLUMNS)


def upsert_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that grow, in buckets of neighbouring keys: a merge of the newest leaves the older buckets alone."""
    home, name = _names(spark, "recent")
    upsert_table(data.order_prices(spark, sf_dir), name, ["o_orderkey"], bucket_by="o_orderkey div 2000", path=home)
    upsert_table(data.later_orders(spark, sf_dir), name, ["o_orderkey"])
    return read_current(spark, name)


def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sums as a catalog table, in a namespace of its own, with one partition per day."""
    home, name = _names(spark, "gold")
    ensure_namespace(spark, name, home)
    publish_gold(table(spark, sf_dir, "events"), f"{name}.daily", data.daily_events(), ["event_day"])
    return in_cents(spark.table(f"{name}.daily"), ("event_day", "event_type", "total_revenue", "total_units"))


def gold_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published twice in one step each: first with other columns and no partitions, then by region and month."""
    home, name = _names(spark, "view")
    orders = data.regional_orders(spark, sf_dir)
    publish_view(orders.limit(0).select("region"), name, (), f"{home}/gold")
    sums = summarize(orders, data.daily_orders()).withColumn("order_month", F.trunc("order_day", "MM"))
    publish_view(sums, name, ["region", "order_month"], f"{home}/gold")
    return in_cents(spark.table(name), SALES_COLUMNS)


def gold_table_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sums with a partition per region, published twice: the second time partition by partition."""
    home, name = _names(spark, "gold")
    for _ in range(2):
        publish_gold(data.regional_orders(spark, sf_dir), name, data.daily_orders(), ["region"], home)
    return in_cents(spark.table(name), SALES_COLUMNS)


def gold_table_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sums over years, where a partition per day would be thousands of tiny files: one per month instead."""
    home, name = _names(spark, "gold")
    publish_gold(table(spark, sf_dir, "lineitem"), name, daily_lines(by_month=True), ["order_month"], home)
    return in_cents(spark.table(name), LINE_COLUMNS)


def _sales_spec(home: str) -> dict[str, Any]:
    return {
        "name": "sales",
        "type": "file",
        "schema": f"{home}/declared",
        "landing_path": f"{home}/landing",
        "bronze_path": f"{home}/bronze",
        "autoloader": {"schemaLocation": f"{home}/schema", "checkpointLocation": f"{home}/checkpoints/bronze"},
        "batch": {"enabled": True},
    }


def _export(spark: SparkSession, sales: DataFrame, home: str) -> None:
    """The sales as files in the landing folder. As plain text they would be most of what a query writes."""
    _write_schema(spark, sales.schema, f"{home}/declared")
    export_json(sales, f"{home}/landing", max_records_per_file=250_000, compression="snappy")


def _land(spark: SparkSession, sales: DataFrame, home: str) -> None:
    _export(spark, sales, home)
    # A file stream plans its batches by the session it was read with, so this holds until the ingest has ended.
    with small_splits(spark, PARSED_BYTES):
        ingest_all(spark, [_sales_spec(home)])


def _refine(
    spark: SparkSession,
    home: str,
    silver: str,
    options: Mapping[str, str] | None = None,
    order_by: Sequence[str] = _NEWEST,
) -> None:
    query = refine_to_silver(
        spark,
        f"{home}/bronze",
        silver,
        SALES_KEYS,
        _TYPES,
        checkpoint=f"{home}/checkpoints/silver",
        rejects=f"{home}/rejects",
        order_by=order_by,
        changes=f"{home}/changes",
        track="order_date",
        options=options,
        schema_location=f"{home}/schema",
        path=f"{home}/silver",
        buckets=8,
        sort_by=["order_date"],
    )
    wait_all([query])


def medallion_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as JSON files through all layers: raw files, current rows, published daily sums."""
    home, name = _names(spark, "layers")
    _land(spark, data.line_sales(spark, sf_dir), home)
    _refine(spark, home, f"{name}_silver")
    publish_gold(read_current(spark, f"{name}_silver"), f"{name}_gold", daily_sales(), (), f"{home}/gold")
    return in_cents(spark.table(f"{name}_gold"), SALES_COLUMNS)


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders first, their lines as later versions second, in two runs of several micro-batches each."""
    home, name = _names(spark, "silver")
    for sales in (data.order_sales(spark, sf_dir), data.line_sales(spark, sf_dir)):
        _land(spark, sales, home)
        _refine(spark, home, name, {"maxFilesPerTrigger": "4"})
    return read_current(spark, name).select(*_SILVER_COLUMNS)


def silver_by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the default order the later arrival wins, though its order dates are older; rows without a key are set aside."""
    home, name = _names(spark, "arrival")
    first, second = data.arrivals(spark, sf_dir)
    for sales in (first, second):
        _land(spark, sales, home)
        _refine(spark, home, name, order_by=(INGEST_TIMESTAMP,))
    current, rejects = read_current(spark, name), spark.read.parquet(f"{home}/rejects")
    stamped = F.datediff(F.current_date(), "ingest_date").between(0, 1).alias("stamped")
    columns = (*_SILVER_COLUMNS, stamped)
    return current.select(*columns, F.lit(False).alias("rejected")).unionByName(
        rejects.select(*columns, F.lit(True).alias("rejected"))
    )


def silver_bad_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no JSON are set aside; values of the wrong type become NULL and their rows stay."""
    home, name = _names(spark, "bad")
    sales = data.order_sales(spark, sf_dir)
    _write_schema(spark, sales.schema, f"{home}/declared")
    data.spoiled_lines(sales).write.text(f"{home}/landing")
    ingest_all(spark, [_sales_spec(home)])
    _refine(spark, home, name)
    columns = (*_SILVER_COLUMNS, F.col("_corrupt_record").isNotNull().alias("malformed"))
    current, rejects = read_current(spark, name), spark.read.parquet(f"{home}/rejects")
    return current.select(*columns, F.lit(False).alias("rejected")).unionByName(
        rejects.select(*columns, F.lit(True).alias("rejected"))
    )


def silver_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two arrivals, refined from the whole raw layer both times."""
    home, name = _names(spark, "full")
    for sales in (data.order_sales(spark, sf_dir), data.line_sales(spark, sf_dir)):
        _land(spark, sales, home)
        refresh_silver(
            spark,
            f"{home}/bronze",
            name,
            SALES_KEYS,
            _TYPES,
            rejects=f"{home}/rejects",
            order_by=_NEWEST,
            schema_location=f"{home}/schema",
            path=f"{home}/silver",
            buckets=8,
        )
    return read_current(spark, name).select(*_SILVER_COLUMNS)


def silver_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals in two volumes of the raw layer; the first is refined, archived and removed before the second comes."""
    home, name = _names(spark, "volumes")
    spec = _sales_spec(home)
    for sales in (data.order_sales(spark, sf_dir), data.line_sales(spark, sf_dir)):
        _export(spark, sales, home)
        close_volume(spark, spec)
        refine_volumes(
            spark, f"{home}/bronze", name, SALES_KEYS, _TYPES, f"{home}/checkpoints/silver", f"{home}/rejects", f"{home}/schema",
            order_by=_NEWEST, path=f"{home}/silver", buckets=8,
        )
        compact_layer(spark, f"{home}/bronze", f"{home}/schema")
    current = read_current(spark, name).select(*_SILVER_COLUMNS)
    raw = read_volumes(spark, f"{home}/bronze", f"{home}/schema")
    return current.join(raw.groupBy("order_id").agg(F.count("*").alias("versions")), "order_id")


def gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sums published after the orders, then refreshed for the days that the lines add to or take from."""
    home, name = _names(spark, "refresh")
    silver, gold = f"{name}_silver", f"{name}_gold"
    _land(spark, data.order_sales(spark, sf_dir), home)
    _refine(spark, home, silver)
    sums = daily_sales(by_month=True)
    publish_gold(read_current(spark, silver), gold, sums, ["order_month"], f"{home}/gold")
    _land(spark, data.line_sales(spark, sf_dir), home)
    _refine(spark, home, silver)
    wait_all([refresh_gold(spark, silver, gold, sums, "order_month", f"{home}/changes", f"{home}/checkpoints/gold")])
    spark.catalog.refreshTable(gold)
    return in_cents(spark.table(gold), SALES_COLUMNS)


def gold_from_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sums by month, first of the orders, then of what their lines add and take away: the current rows are not read."""
    home, name = _names(spark, "signed")
    silver, gold = f"{name}_silver", f"{name}_gold"
    images = ["order_date", "region", "quantity", "price"]
    sums = daily_sales(by_month=True)
    for sales in (data.order_sales(spark, sf_dir), data.line_sales(spark, sf_dir)):
        _land(spark, sales, home)
        query = refine_to_silver(
            spark, f"{home}/bronze", silver, SALES_KEYS, _TYPES, f"{home}/checkpoints/silver", f"{home}/rejects", _NEWEST,
            changes=f"{home}/changes", images=images, schema_location=f"{home}/schema", path=f"{home}/silver", buckets=8,
        )
        wait_all([query])
        wait_all([refresh_sums(spark, silver, gold, sums, "order_month", f"{home}/changes", images, f"{home}/checkpoints/gold", path=f"{home}/gold")])
    exact = read_sums(spark, gold, sums)
    return in_cents(exact.withColumn("total_revenue", F.col("total_revenue").cast("double")), SALES_COLUMNS).withColumn(
        "total_units", F.col("total_units").cast("long")
    )


STORED_QUERIES = {
    "ingest_files": ingest_files_once,
    **{
        f.__name__: f
        for f in (
            ingest_archived,
            ingest_evolving,
            ingest_odd_names,
            ingest_restart,
            stream_continuous,
            ingest_partitioned,
            ingest_messages_json,
            ingest_messages_raw,
            ingest_messages_undeclared,
            ingest_all_specs,
            export_landing,
            overwrite_partitioned,
            overwrite_plain,
            upsert_appended,
            upsert_create,
            upsert_own_names,
            upsert_recent,
            upsert_stored_one_key,
            upsert_stored_two_keys,
            gold_table,
            gold_table_by_region,
            gold_table_monthly,
            gold_view,
            medallion_files,
            silver_appended,
            silver_bad_input,
            silver_by_arrival,
            silver_incremental,
            silver_full,
            silver_volumes,
            gold_refresh,
            gold_from_changes,
        )
    },
}
