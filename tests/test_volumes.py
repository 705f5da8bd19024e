"""A raw layer whose closed volumes are rewritten while it is ingested and refined."""

import json
from pathlib import Path

import pytest

from stratum.operators import latest_per_key
from stratum.plans import close_volume, compact_layer, ingest_volume, read_volumes, refine_volumes, refresh_silver
from stratum.plans import volumes as plan
from stratum.sinks import read_current

WAIT = 90


class Lake:
    def __init__(self, spark, home, name):
        self.spark, self.home, self.table = spark, str(home), name
        self.spec = {
            "name": "s", "landing_path": f"{home}/landing", "bronze_path": f"{home}/bronze",
            "autoloader": {"schemaLocation": f"{home}/schema", "checkpointLocation": f"{home}/c1"},
        }
        self.landed = []
        Path(home, "landing").mkdir()

    def land(self, *rows):
        self.landed += rows
        file = Path(self.home, "landing", f"{len(self.landed)}.json")
        file.write_text("\n".join(json.dumps(r) for r in rows))

    def ingest(self):
        ingest_volume(self.spark, self.spec, WAIT)

    def close(self):
        return close_volume(self.spark, self.spec, WAIT)

    def refine(self):
        refine_volumes(
            self.spark, f"{self.home}/bronze", self.table, ["id"], {"v": "int"}, f"{self.home}/c2", f"{self.home}/rejects",
            f"{self.home}/schema", WAIT, path=f"{self.home}/silver", buckets=2,
        )

    def compact(self):
        return compact_layer(self.spark, f"{self.home}/bronze", f"{self.home}/schema")

    def check(self):
        raw = read_volumes(self.spark, f"{self.home}/bronze", f"{self.home}/schema")
        assert sorted((r.id, int(r.v)) for r in raw.collect()) == sorted((r["id"], r["v"]) for r in self.landed)
        want = latest_per_key(raw.where("id is not null"), ["id"], ["ingest_timestamp"])
        got = read_current(self.spark, self.table)
        assert sorted((r.id, r.v) for r in got.collect()) == sorted((r.id, int(r.v)) for r in want.collect())


@pytest.fixture
def lake(spark, tmp_path, name):
    return Lake(spark, tmp_path, name)


def test_compaction_between_refreshes(lake):
    for i in range(4):
        lake.land({"id": "a", "v": i}, {"id": f"k{i}", "v": i})
        lake.ingest()
        lake.refine()
        lake.land({"id": f"late{i}", "v": i, **({"more": "x"} if i else {})})
        assert lake.close() == i + 1
        lake.refine()
        lake.check()
        assert lake.compact() == 1 and lake.compact() == 0
        lake.check()
    bronze = Path(lake.home, "bronze")
    assert not list(bronze.glob("v*")) and len(list((bronze / "archive").glob("v*"))) == 4
    assert all(len(list(v.glob("*.parquet"))) == 1 for v in (bronze / "archive").glob("v*"))  # of two batches
    assert {r.more for r in read_volumes(lake.spark, str(bronze), f"{lake.home}/schema").collect()} == {None, "x"}
    # A full refresh over archive and open volume gives the same.
    lake.land({"id": "open", "v": 9})
    lake.ingest()
    lake.refine()
    raw = read_volumes(lake.spark, str(bronze), f"{lake.home}/schema")
    refresh_silver(
        lake.spark, str(bronze), f"{lake.table}_full", ["id"], {"v": "int"}, f"{lake.home}/r2", raw=raw, path=f"{lake.home}/full", buckets=2
    )
    rows = lambda t: sorted((r.id, r.v) for r in read_current(lake.spark, t).collect())
    assert rows(f"{lake.table}_full") == rows(lake.table)


def test_a_volume_that_is_not_refined_stays(lake):
    lake.land({"id": "a", "v": 1})
    lake.close()
    lake.land({"id": "b", "v": 2})
    lake.ingest()
    assert lake.compact() == 0 and Path(lake.home, "bronze", "v000000").exists()
    lake.refine()
    assert lake.compact() == 1 and Path(lake.home, "bronze", "v000001").exists()
    lake.check()


def test_an_empty_volume(lake):
    lake.land({"id": "a", "v": 1})
    assert (lake.close(), lake.close(), lake.close()) == (1, 2, 3)
    lake.refine()
    assert lake.compact() == 3
    lake.check()


@pytest.mark.parametrize("lost", ["_note", "_remove", "write_layer"])
def test_a_compaction_that_is_lost(lake, monkeypatch, lost):
    lake.land({"id": "a", "v": 1}, {"id": None, "v": 2})
    lake.close()
    lake.refine()
    real = getattr(plan, lost)

    def dies(*args, **more):
        if lost == "write_layer":
            real(args[0].limit(1), *args[1:], **more)  # a part of it
        raise RuntimeError("lost")

    monkeypatch.setattr(plan, lost, dies)
    with pytest.raises(RuntimeError, match="lost"):
        lake.compact()
    monkeypatch.undo()
    raw = read_volumes(lake.spark, f"{lake.home}/bronze", f"{lake.home}/schema")
    assert raw.count() == 2
    lake.compact()
    assert not Path(lake.home, "bronze", "v000000").exists()
    assert read_volumes(lake.spark, f"{lake.home}/bronze", f"{lake.home}/schema").count() == 2


def test_an_ingest_that_is_lost_after_its_batch_was_written(lake, monkeypatch):
    real = plan.start_batches

    def dying(rows, write, checkpoint):
        def dies(batch, batch_id):
            write(batch, batch_id)
            raise RuntimeError("lost")

        return real(rows, dies, checkpoint)

    lake.land({"id": "a", "v": 1})
    lake.ingest()
    lake.land({"id": "b", "v": 2}, {"id": "c", "v": 3})
    monkeypatch.setattr(plan, "start_batches", dying)
    with pytest.raises(Exception, match="lost"):
        lake.ingest()
    monkeypatch.undo()
    assert lake.close() == 1
    lake.refine()
    lake.check()


def test_rows_that_do_not_arrive_are_noticed(lake, monkeypatch):
    lake.land({"id": "a", "v": 1}, {"id": "b", "v": 2})
    lake.close()
    lake.refine()
    real = plan.write_layer
    monkeypatch.setattr(plan, "write_layer", lambda rows, *args: real(rows.limit(1), *args))
    with pytest.raises(RuntimeError, match="1 rows of 2"):
        lake.compact()
    assert Path(lake.home, "bronze", "v000000").exists()
