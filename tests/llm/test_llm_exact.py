import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import oracle_rows, spark_rows
from odd_rows import no_documents, odd_documents
from stratum.llm import exact

SF_DIR = "/root/testdata/sf0.001"


def test_agrees_with_its_sql(spark):
    assert spark_rows(exact.op6_exact_dedup(spark, SF_DIR)) == oracle_rows(SF_DIR, exact.ORACLE)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 1000, 30_000])
def test_filter_has_no_false_negatives(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, n).astype(np.uint64)
    made = exact.FuseFilter.of(np.concatenate([keys, keys]))
    assert made.maybe(keys).all()
    assert made.maybe(rng.integers(0, 1 << 63, 20_000).astype(np.uint64)).mean() < 0.01


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("large", [1000, 2])
def test_any_split_gives_the_same(spark, monkeypatch, large):
    monkeypatch.setattr(exact, "LARGE", large)
    texts = ["alpha", "ALPHA", "Älpha", "älpha", "", None, "beta", "beta", "BETA ", "gamma"] * 3
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    splits = [F.lit(True), F.lit(False), F.col("doc_id") % 2 == 0, F.col("doc_id") > 20, F.lit(None).cast("boolean")]
    results = [rows_of(exact.dedup(docs, s)) for s in splits]
    assert all(r == results[0] for r in results)
    kept = {r[1] for r in results[0]}
    assert kept == {21, 22, 23, 25, 27, 28, 29}  # Ä and ä differ: only A-Z are lowered
    assert sum(r[3] for r in results[0]) == len(kept)


@pytest.mark.parametrize("shard", [50_000, 300])
def test_screening_joins_only_positives(spark, monkeypatch, shard):
    monkeypatch.setattr(exact, "SHARD_DIGESTS", shard)
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("digest"), F.col("id").alias("key"))
    snapshot = exact.take_snapshot(rows.filter("doc_id < 2000"))
    screened = exact.screen(exact.group_rows(rows.filter("doc_id >= 1000")), snapshot).collect()
    sure = [r for r in screened if r.best.doc_id < 2000]
    assert len(screened) == 3000 and all(r.maybe for r in sure)
    assert sum(r.maybe for r in screened) - len(sure) < 60


def test_clashing_digests_are_split_by_their_bytes(spark):
    weak = lambda text: F.rpad(F.hex(F.length(text)), 64, "0")
    texts = ["aaa", "bbb", "AAA", "cccc", "cccc", "ddddd", "bbb"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in exact.dedup(docs, F.col("doc_id") % 2 == 0, weak).collect()}
    assert [got[i].keep_id for i in range(7)] == [2, 6, 2, 4, 4, 5, 6]
    assert [got[i].group_size for i in range(7)] == [2, 2, 2, 2, 2, 1, 2]
    assert [i for i in range(7) if got[i].kept] == [2, 4, 5, 6]
    assert got[0].split and not got[3].split


def test_odd_rows(spark):
    odd = odd_documents(spark)
    rows = exact.dedup(odd, exact.half()).collect()
    assert len(rows) == odd.count()
    same = [r for r in rows if r.doc_id in (5, 6)]
    assert {r.keep_id for r in same} == {6} and {r.group_size for r in same} == {3} and sum(r.kept for r in same) == 1
    empty = [r for r in rows if r.group_size == 3 and r.keep_id == 2]
    assert sorted((r.doc_id is None, r.kept) for r in empty) == [(False, False), (False, True), (True, False)]
    kept = exact.latest_rows(odd, exact.half())
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in rows)
    assert exact.dedup(no_documents(spark), exact.half()).count() == 0
