"""How cost grows: a copy of the order lines at several sizes, with one hot order, merged in full and in part.

Usage: python tools/scaling.py [copies ...]   (default 4 16; 600,000 lines per copy at sf0.1)

For every size it prints seconds and, from Spark's event log, the longest task against the median of its stage, for:
the latest row per order when a third of all lines belong to one order; the upsert of frames when a third of the stored
rows has no key; merges into a stored table of a batch that touches all key buckets or one of them; and daily sums of
the stored table, all of them or those of one month. Everything is written below a folder of its own.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from stratum.functions import in_months  # noqa: E402
from stratum.operators import Summary, latest_by_aggregate, latest_per_key, upsert_frames  # noqa: E402
from stratum.plans.gold import publish_gold, refresh_partitions  # noqa: E402
from stratum.sinks import append_rows, fold_rows, read_current, upsert_table  # noqa: E402

KEYS = ["l_orderkey"]
TIES = ["l_linenumber", "l_partkey", "l_suppkey"]


def daily_lines() -> Summary:
    day = F.col("l_shipdate")
    return Summary(
        dims={"order_day": day, "order_month": F.trunc(day, "MM")},
        sums={"total_revenue": F.col("l_quantity") * F.col("l_extendedprice")},
        within={"order_month": lambda months: in_months(day, months)},
    )


def session(home: str) -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{home}/warehouse")
        .config("spark.checkpoint.dir", f"{home}/shared")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.eventLog.dir", f"file:{home}/log")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def copies_of(spark: SparkSession, lines: DataFrame, copies: int) -> DataFrame:
    """The lines ``copies`` times over, each copy with orders of its own."""
    width = lines.agg(F.max("l_orderkey")).first()[0] + 1
    many = lines.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return many.withColumn("l_orderkey", F.col("l_orderkey") + F.col("copy") * width).drop("copy")


def a_third(column: str, value):
    """``column`` with ``value`` in every third row."""
    return F.when(F.pmod(F.xxhash64("l_orderkey", *TIES), F.lit(3)) == 0, value).otherwise(F.col(column))


def timed(spark: SparkSession, label: str, rows: int, run) -> None:
    spark.sparkContext.setJobDescription(label)
    start = time.perf_counter()
    run()
    spark.sparkContext.setLocalProperty("spark.job.description", None)
    print(f"{label:34}{rows:>12,} rows {time.perf_counter() - start:8.2f} s", flush=True)


def longest_tasks(log: Path) -> None:
    """Longest task and median of the widest stage that belongs to each label."""
    label_of, times = {}, defaultdict(list)
    for line in log.read_text().splitlines():
        event = json.loads(line)
        if event["Event"] == "SparkListenerJobStart":
            label = event["Properties"].get("spark.job.description")
            label_of.update({s["Stage ID"]: label for s in event["Stage Infos"]})
        elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
            times[event["Stage ID"]].append(event["Task Metrics"]["Executor Run Time"])
    worst = {}
    for stage, ms in times.items():
        label = label_of.get(stage)
        if label and len(ms) > 1 and sum(ms) > 500:
            worst.setdefault(label, []).append((max(ms), statistics.median(ms), len(ms), stage))
    for label, stages in worst.items():
        for longest, median, tasks, _ in sorted(stages, reverse=True)[:1]:
            print(f"{label:34} longest task {longest / 1000:7.2f} s, median {median / 1000:6.2f} s of {tasks}")


def measure(spark: SparkSession, sf_dir: str, home: str, copies: int) -> None:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", *TIES, F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_quantity", "l_extendedprice"
    )
    base = f"{home}/lines-{copies}"
    copies_of(spark, lines, copies).repartition(32).write.parquet(base)
    stored = spark.read.parquet(base)
    n = stored.count()

    def noop(df: DataFrame):
        return lambda: df.write.format("noop").mode("overwrite").save()

    hot = stored.withColumn("l_orderkey", a_third("l_orderkey", F.lit(-1)))
    timed(spark, f"latest x{copies}", n, noop(latest_per_key(stored, KEYS, ["l_shipdate"], TIES)))
    timed(spark, f"latest, hot order x{copies}", n, noop(latest_per_key(hot, KEYS, ["l_shipdate"], TIES)))
    timed(spark, f"latest by aggregate x{copies}", n, noop(latest_by_aggregate(stored, KEYS, ["l_shipdate"], TIES)))
    timed(spark, f"the same, hot order x{copies}", n, noop(latest_by_aggregate(hot, KEYS, ["l_shipdate"], TIES)))

    keyless = stored.withColumn("l_orderkey", a_third("l_orderkey", F.lit(None)))
    source = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("l_orderkey"))
    source = source.select("l_orderkey", *(F.lit(None).cast(t).alias(c) for c, t in stored.dtypes if c != "l_orderkey"))
    timed(spark, f"upsert frames, third keyless x{copies}", n, noop(upsert_frames(keyless, source, KEYS)))

    table = f"lines_{copies}"
    order = {"order_by": ["l_shipdate"], "tie_breakers": TIES}
    timed(
        spark, f"table from all x{copies}", n,
        lambda: upsert_table(hot, table, KEYS, buckets=64, sort_by=["l_shipdate"], path=f"{home}/{table}", **order),
    )
    everywhere = lines
    one_order = everywhere.withColumn("l_orderkey", F.lit(7).cast("long"))
    for label, batch in (("merge into all buckets", everywhere), ("merge into one bucket", one_order)):
        batch = batch.withColumn("l_shipdate", F.add_months("l_shipdate", 120))
        timed(spark, f"{label} x{copies}", batch.count(), lambda b=batch: upsert_table(b, table, KEYS, **order))
    later = everywhere.withColumn("l_shipdate", F.add_months("l_shipdate", 240))
    timed(spark, f"append to all buckets x{copies}", later.count(), lambda: append_rows(later, table, KEYS, **order))
    timed(spark, f"read with pending x{copies}", n, noop(read_current(spark, table)))
    timed(spark, f"fold x{copies}", later.count(), lambda: fold_rows(spark, table))
    timed(spark, f"read without pending x{copies}", n, noop(read_current(spark, table)))
    # The same number of lines under the newest orders, where buckets hold neighbouring orders: old buckets stay.
    width = lines.agg(F.max("l_orderkey")).first()[0] + 1
    by_number, newest = f"numbered_{copies}", lines.withColumn("l_orderkey", F.col("l_orderkey") + (copies - 1) * width)
    buckets = {"bucket_by": f"l_orderkey div {width // 4 + 1}", "path": f"{home}/{by_number}"}
    upsert_table(stored, by_number, KEYS, **buckets, **order)
    newest = newest.withColumn("l_shipdate", F.add_months("l_shipdate", 120))
    timed(spark, f"merge into newest buckets x{copies}", newest.count(), lambda: upsert_table(newest, by_number, KEYS, **order))
    n = read_current(spark, table).count()
    sums, gold = daily_lines(), f"gold_{copies}"
    detail, month = read_current(spark, table), "order_month"
    one = spark.sql("select date'1996-05-01' as order_month")
    timed(spark, f"gold from all x{copies}", n, lambda: publish_gold(detail, gold, sums, [month], f"{home}/{gold}"))
    timed(spark, f"gold of one month x{copies}", n, lambda: refresh_partitions(spark, detail, gold, sums, month, one))


def main() -> None:
    home = tempfile.mkdtemp(prefix="stratum-scaling-")
    os.mkdir(f"{home}/log")
    spark = session(home)
    for copies in [int(a) for a in sys.argv[1:]] or [4, 16]:
        measure(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), home, copies)
    spark.stop()
    for log in Path(home, "log").iterdir():
        longest_tasks(log)


if __name__ == "__main__":
    main()
