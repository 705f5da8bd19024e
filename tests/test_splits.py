"""How much of their input tasks are given."""

from stratum.queries import stored
from stratum.session import small_splits
from stratum.sinks import keyed, tables, upsert_table

SPLIT, PARTITIONS = "spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions"


def test_splits_are_bounded_and_given_back(spark):
    had = spark.conf.get(SPLIT)
    with small_splits(spark, 1 << 20):
        assert spark.conf.get(SPLIT) == str(1 << 20)
        with small_splits(spark, 2 << 20):
            assert spark.conf.get(SPLIT) == str(1 << 20)
    assert spark.conf.get(SPLIT) == had


def test_an_ingest_is_spread_by_what_it_parses(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "PARSED_BYTES", 1, raising=False)
    sales = spark.range(0, 60, 1, 6).selectExpr(
        "concat('ORD-', id) as order_id", "'P' as product_id", "1 as line", "2.0 as price", "'2024-01-02T00:00:00' as order_date"
    )
    stored._land(spark, sales, str(tmp_path))
    raw = spark.read.parquet(f"{tmp_path}/bronze")
    assert raw.count() == 60 and raw.where("order_id is null or price is null").count() == 0
    assert len(raw.inputFiles()) == 6  # each file a task of its own


def test_new_rows_are_ranked_in_bounded_tasks(spark, name, tmp_path, monkeypatch, plan):
    plans = []
    write = tables.write_slots

    def noted(rows, *where):
        plans.append(plan(rows))
        write(rows, *where)

    monkeypatch.setattr(tables, "write_slots", noted)
    monkeypatch.setattr(keyed, "TASK_ROWS", 10)
    had = spark.conf.get(PARTITIONS)
    rows = spark.range(0, 100, 1, 3).selectExpr("id % 40 as k", "id as v")
    upsert_table(rows, name, ["k"], ["v"], path=str(tmp_path / "t"), buckets=2)
    assert "hashpartitioning(key_bucket" in plans[0] and ", 10), ENSURE_REQUIREMENTS" in plans[0]
    assert spark.conf.get(PARTITIONS) == had
    assert {(r.k, r.v) for r in spark.table(name).collect()} == {(v % 40, v) for v in range(60, 100)}


def test_a_merge_sorts_its_rows_once(spark, name, tmp_path, monkeypatch, plan):
    plans = []
    write = tables.write_slots

    def noted(rows, root, part, slot):
        plans.append(plan(rows.sortWithinPartitions(slot, part)))
        write(rows, root, part, slot)

    monkeypatch.setattr(tables, "write_slots", noted)
    rows = spark.range(100).selectExpr("id as k", "id * 2 as v")
    for _ in range(2):
        upsert_table(rows, name, ["k"], ["v"], path=str(tmp_path / "t"), buckets=8)
    # What the files are laid out by is how the window sorted already.
    after, exchange, _ = plans[1].partition("REPARTITION_BY_NUM")
    assert exchange and after.count("Sort [") == 1
