"""Sums from signed changes against a full recompute."""

from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratum.operators import Summary, summarize
from stratum.plans import SALES_KEYS, SALES_TYPES, daily_sales, read_sums, refine_to_silver, refresh_sums
from stratum.sinks import read_current, tables, upsert_table
from stratum.sinks.keyed import IMAGE_BUCKET, SIGN
from stratum.streaming import wait_all
from test_layers import FIRST, SECOND, THIRD, WAIT, Layers

IMAGES = ["order_date", "region", "quantity", "price"]


class Signed(Layers):
    def refine(self, **more):
        query = refine_to_silver(
            self.spark, f"{self.home}/bronze", self.silver, SALES_KEYS, SALES_TYPES, f"{self.home}/c2", f"{self.home}/rejects",
            changes=f"{self.home}/changes", images=IMAGES, path=f"{self.home}/silver", buckets=4, **more,
        )
        assert wait_all([query], WAIT)

    def refresh(self):
        query = refresh_sums(
            self.spark, self.silver, self.gold, daily_sales(), "order_day", f"{self.home}/changes", IMAGES, f"{self.home}/c3",
            path=f"{self.home}/gold",
        )
        assert wait_all([query], WAIT)

    def check(self):
        exact = daily_sales()
        exact = Summary(exact.dims, {n: c.cast("decimal(38, 6)") for n, c in exact.sums.items()})
        want = self._rows(summarize(read_current(self.spark, self.silver), exact))
        got = self._rows(read_sums(self.spark, self.gold, daily_sales()))
        assert got == want and self.silver_rows() == self.recomputed_rows()
        assert not got or all(v is None or isinstance(v, Decimal) for v in got[0][2:])


@pytest.fixture
def signed(spark, tmp_path, name):
    return Signed(spark, tmp_path, name)


FOURTH = [("a", None, "10.0", "2024-01-03T08:00:00", "ES"), ("b", "5", "0.1", "2024-01-02T08:00:00", "DE"), ("f", "3", "0.1", "2024-01-02T08:00:00", "DE")]


def test_rounds_equal_recompute(signed):
    signed.land("0.json", FIRST[4])  # no row with a key
    signed.refine()
    signed.refresh()
    assert read_sums(signed.spark, signed.gold, daily_sales()).isEmpty()
    for i, rows in enumerate((FIRST, SECOND, THIRD, FOURTH)):
        signed.land(f"{i + 1}.json", *rows)
        signed.refine()
        if i != 1:  # two batches at once
            signed.refresh()
            signed.check()
    signed.refresh()
    signed.check()


def test_silver_is_not_read(signed):
    signed.land("0.json", *FIRST)
    signed.refine()
    signed.refresh()
    signed.land("1.json", *SECOND)
    signed.refine()
    kept = {f: f.read_bytes() for f in Path(signed.home, "silver").rglob("*.parquet")}
    for f in kept:
        f.write_bytes(b"spoiled")
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    signed.refresh()
    for f, data in kept.items():
        f.write_bytes(data)
    signed.check()


def _dying(monkeypatch, done):
    real = tables.point_partitions

    def dies(session, table, root, part, occupied, written, emptied=()):
        real(session, table, root, part, occupied, list(written)[:done], ())
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "point_partitions", dies)


@pytest.mark.parametrize("done, between", [(0, True), (1, False), (1, True), (100, True)])
def test_a_merge_that_is_lost_halfway(signed, monkeypatch, done, between):
    signed.land("0.json", *FIRST)
    signed.refine()
    signed.refresh()
    signed.land("1.json", *SECOND)
    _dying(monkeypatch, done)
    with pytest.raises(Exception, match="lost"):
        signed.refine()
    monkeypatch.undo()
    if between:
        signed.refresh()
    signed.refine()
    signed.refresh()
    signed.check()


@pytest.mark.parametrize("done", [0, 1])
def test_a_refresh_that_is_lost_halfway(signed, monkeypatch, done):
    signed.land("0.json", *FIRST)
    signed.refine()
    signed.refresh()
    signed.land("1.json", *SECOND)
    signed.refine()
    _dying(monkeypatch, done)
    with pytest.raises(Exception, match="lost"):
        signed.refresh()
    monkeypatch.undo()
    signed.refresh()
    signed.check()
    signed.land("2.json", *THIRD)
    signed.refine()
    signed.refresh()
    signed.check()


def test_a_merge_marked_but_not_checkpointed(signed, monkeypatch):
    """The batch comes again after its mark was written: nothing is changed, and there is one mark."""
    from stratum.plans import silver as plan

    signed.land("0.json", *FIRST)
    real = plan.mark_done

    def dies(*args):
        real(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(plan, "mark_done", dies)
    with pytest.raises(Exception, match="lost"):
        signed.refine()
    monkeypatch.undo()
    signed.refresh()
    signed.refine()
    signed.refresh()
    signed.check()
    assert len(list(Path(signed.home, "changes", "done").rglob("part-*.json"))) == 1


def test_images_of_a_merge(spark, name, tmp_path):
    seen = []

    def merge(rows):
        frame = spark.createDataFrame(rows, "id string, v int, `a b` string")
        upsert_table(frame, name, ["id"], ["v"], ["a b"], buckets=2, path=str(tmp_path / "t"), images=["v", "a b"], note=lambda f: seen.append(f.collect()))

    merge([("a", 1, "x"), ("b", 1, None)])
    merge([("a", 2, "y"), ("b", 0, "old"), ("c", None, "z"), (None, 5, "w")])
    assert sorted(((r["v"], r["a b"], r[SIGN]) for r in seen[0]), key=repr) == [(1, "x", 1), (1, None, 1)]
    assert sorted((r["v"], r["a b"], r[SIGN]) for r in seen[1] if r["v"] is not None) == [(1, "x", -1), (2, "y", 1)]
    assert [(r["v"], r["a b"], r[SIGN]) for r in seen[1] if r["v"] is None] == [(None, "z", 1)]
    assert [(r["v"], r["a b"], r[SIGN], r[IMAGE_BUCKET]) for r in seen[2]] == [(5, "w", 1, -1)]
    assert {r[IMAGE_BUCKET] for r in seen[0]} <= {0, 1}


def test_names_of_the_state_give_way(spark, name, tmp_path):
    summary = Summary(dims={"rows": F.col("v"), "applied": F.col("w")}, sums={"total": F.col("x")})
    silver = f"{name}_s"
    frame = spark.createDataFrame([("a", 1, 2, 3)], "id string, v int, w int, x int")
    upsert_table(frame, silver, ["id"], ["v"], buckets=2, path=str(tmp_path / "s"))
    query = refresh_sums(spark, silver, name, summary, "rows", str(tmp_path / "c"), ["v", "w", "x"], str(tmp_path / "k"), path=str(tmp_path / "g"))
    assert wait_all([query], WAIT)
    assert read_sums(spark, name, summary).columns == ["rows", "applied", "total"]
