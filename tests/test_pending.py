"""Rows appended beside a keyed table read as if they had been merged."""

import random

import pytest
from pyspark.sql import functions as F

from stratum.plans import refine_to_silver
from stratum.sinks import append_rows, fold_rows, pending_files, read_current, tables, upsert_table
from stratum.sinks import pending as pending_sink


def _frame(spark, rows, more=()):
    return spark.createDataFrame(rows, ["id", "at", "_present", *more])


def _rows(spark, name, *columns):
    frame = read_current(spark, name)
    return sorted(map(tuple, frame.select(*(columns or ("id", "at", "_present"))).collect()), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_random_batches_against_a_dict(spark, name, tmp_path, seed):
    rng = random.Random(seed)
    want, keyless = {}, 0
    for step in range(6):
        rows = [(rng.choice([None, *(f"k{i}" for i in range(15))]), rng.randrange(6), rng.randrange(100)) for _ in range(8)]
        for k, at, v in rows:
            if k is None:
                keyless += 1
            else:
                want[k] = max(want.get(k, (-1, -1)), (at, v))
        act = rng.choice(["append", "append", "merge", "fold"]) if step else "merge"
        if act == "merge":
            upsert_table(_frame(spark, rows), name, ["id"], ["at"], ["_present"], buckets=3, path=str(tmp_path / "t"))
        else:
            append_rows(_frame(spark, rows), name, ["id"], ["at"], ["_present"])
        if act == "fold":
            fold_rows(spark, name)
            assert spark.table(f"{name}__pending").isEmpty()
        got = _rows(spark, name)
        assert {k: (at, v) for k, at, v in got if k is not None} == want
        assert sum(k is None for k, _, _ in got) == keyless and len(got) == len(want) + keyless


def test_an_append_neither_reads_nor_writes_the_table(spark, name, tmp_path):
    upsert_table(_frame(spark, [(f"k{i}", 1, 0) for i in range(40)]), name, ["id"], ["at"], buckets=4, path=str(tmp_path / "t"))
    files = sorted((tmp_path / "t").rglob("*.parquet"))
    kept = {f: f.read_bytes() for f in files}
    for f in files:
        f.write_bytes(b"spoiled")
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    append_rows(_frame(spark, [(f"k{i}", 2, 7) for i in range(0, 50, 10)]), name, ["id"], ["at"])
    assert sorted((tmp_path / "t").rglob("*.parquet")) == files and pending_files(spark, name) > 0
    for f in files:
        f.write_bytes(kept[f])
    assert sum(v for _, _, v in _rows(spark, name)) == 5 * 7 and len(_rows(spark, name)) == 41


def test_equal_rows_and_repeated_batches(spark, name, tmp_path):
    batch = lambda v: _frame(spark, [("a", 1, 1), ("b", 2, 2)]).withColumn("note", F.lit(v))
    upsert_table(batch("stored"), name, ["id"], ["at"], ["_present"], buckets=2, path=str(tmp_path / "t"))
    for _ in range(2):
        append_rows(batch("again"), name, ["id"], ["at"], ["_present"])
    assert {r[0] for r in _rows(spark, name, "note")} == {"stored"} and len(_rows(spark, name)) == 2
    fold_rows(spark, name)
    fold_rows(spark, name)
    assert {r[0] for r in _rows(spark, name, "note")} == {"stored"} and len(_rows(spark, name)) == 2


@pytest.mark.parametrize("lost", ["before", "after"])
def test_a_fold_that_is_lost_halfway(spark, name, tmp_path, monkeypatch, lost):
    upsert_table(_frame(spark, [("a", 1, 1)]), name, ["id"], ["at"], buckets=2, path=str(tmp_path / "t"))
    append_rows(_frame(spark, [("a", 2, 2), ("b", 2, 2)]), name, ["id"], ["at"])
    real = tables.publish_table

    def dies(*args):
        if lost == "after":
            real(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(pending_sink.tables, "publish_table", dies)
    with pytest.raises(RuntimeError, match="lost"):
        fold_rows(spark, name)
    monkeypatch.undo()
    want = [("a", 2, 2), ("b", 2, 2)]
    assert _rows(spark, name) == want
    fold_rows(spark, name)
    assert _rows(spark, name) == want


def test_columns_that_come_later(spark, name, tmp_path):
    upsert_table(_frame(spark, [("a", 1, 1)]), name, ["id"], ["at"], [], buckets=2, path=str(tmp_path / "t"))
    append_rows(_frame(spark, [("b", 1, 1)]), name, ["id"], ["at"], [])
    append_rows(_frame(spark, [("c", 1, 1, "x")], ["more"]), name, ["id"], ["at"], [], add_columns=True)
    upsert_table(_frame(spark, [("d", 1, 1, "y", "z")], ["more", "last"]), name, ["id"], ["at"], [], add_columns=True)
    want = [("a", None, None), ("b", None, None), ("c", "x", None), ("d", "y", "z")]
    assert _rows(spark, name, "id", "more", "last") == want
    fold_rows(spark, name)
    assert _rows(spark, name, "id", "more", "last") == want


def test_the_order_is_fixed(spark, name, tmp_path):
    upsert_table(_frame(spark, [("a", 1, 1)]), name, ["id"], ["at"], buckets=2, path=str(tmp_path / "t"))
    append_rows(_frame(spark, [("a", 2, 1)]), name, ["id"], ["at"])
    with pytest.raises(ValueError, match="another order"):
        append_rows(_frame(spark, [("a", 2, 1)]), name, ["id"], ["_present"])
    for order in (None, ["_present"]):
        with pytest.raises(ValueError, match="another order"):
            upsert_table(_frame(spark, [("a", 2, 1)]), name, ["id"], order)
    with pytest.raises(ValueError, match="not laid out"):
        append_rows(_frame(spark, [("a", 2, 1)]), name, ["at"], ["at"])
    with pytest.raises(ValueError, match="listed by merges"):
        refine_to_silver(spark, "x", name, ["id"], {}, "c", "r", changes="y", fold_after=1)


def test_stored_rows_are_not_shuffled(spark, name, tmp_path, plan):
    upsert_table(_frame(spark, [(f"k{i}", 1, 0) for i in range(40)]), name, ["id"], ["at"], buckets=4, path=str(tmp_path / "t"))
    append_rows(_frame(spark, [("k1", 2, 7)]), name, ["id"], ["at"])
    text = plan(read_current(spark, name))
    lines = text.splitlines()
    assert any("BroadcastHashJoin" in x and "LeftOuter, BuildRight" in x for x in lines)
    assert any("BroadcastHashJoin" in x and "LeftSemi, BuildRight" in x for x in lines)
    # What is exchanged or sorted is pending, or a key that is: the scans of the table feed broadcast joins alone.
    read_current(spark, name).collect()


def test_large_folds(spark, name, tmp_path):
    """What is pending is merged when it has as many rows as the table, not before."""
    upsert_table(_frame(spark, [(f"k{i}", 1, 0) for i in range(10)]), name, ["id"], ["at"], [], buckets=2, path=str(tmp_path / "t"))
    for at, pending in ((2, 4), (3, 8), (4, 0), (5, 4)):
        append_rows(_frame(spark, [(f"k{i}", at, at) for i in range(4)]), name, ["id"], ["at"], [])
        pending_sink.fold_large(spark, name)
        assert pending_sink.pending_rows(spark, name) == pending
    assert _rows(spark, name) == sorted([(f"k{i}", 5, 5) if i < 4 else (f"k{i}", 1, 0) for i in range(10)], key=repr)
    pending_sink.settle_rows(spark, name)
    assert pending_sink.pending_rows(spark, name) == 0
    upsert_table(_frame(spark, [("k0", 0, 9)]), name, ["id"])  # in any order again
    assert ("k0", 0, 9) in _rows(spark, name)


def test_a_fold_tells_all_pending_values(spark, name, tmp_path):
    """Those, too, that another pending row has replaced: a reader may have seen them."""
    upsert_table(_frame(spark, [("a", 1, 10), ("b", 1, 11)]), name, ["id"], ["at"], [], buckets=2, path=str(tmp_path / "t"))
    for at in (2, 3):
        append_rows(_frame(spark, [("a", at, 10 + at)]), name, ["id"], ["at"], [])
    told = []
    fold_rows(spark, name, "_present", lambda values: told.extend(r[0] for r in values.collect()))
    assert set(told) == {10, 12, 13}
