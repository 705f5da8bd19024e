import hashlib
import random

import pytest

from compare import oracle_rows, spark_rows
from stratum.llm import warc
from stratum.session import scratch_dir

SF_DIR = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


def record(body):
    return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: {len(body.encode())}\r\n\r\n{body}\r\n\r\n"


def tricky_pages():
    rng = random.Random(3)
    rows = [(1, "http://a\nb", "x" * 50), (2, None, None), (3, "u", "é" * 700), (4, "u", "é" * 700), (5, "u", "é" * 700)]
    rows += [(6, "u", "WARC/1.1\r\nhello"), (7, "u", "a" + record("inner") + "tail"), (8, "u", record("x")), (9, "u", record("y") + record("z"))]
    rows += [(10, "u", "\r\n\r\nWARC/1.1\r\n\r\n\r\nWARC/1.1\r\n"), (None, "u", "q" * 2000), (12, "u", "q" * 2000), (13, "u", "WARC/1.1\r\n")]
    parts = ["WARC/1.1\r\n", "abc", "é\r\n", "\r\n\r\n"]
    for i in range(80):
        pick = lambda: rng.choice([*parts, record("k" * rng.randint(0, 30))])
        rows.append((100 + i, f"u{i}", "".join(pick() for _ in range(rng.randint(0, 12)))))
    return rows


def sha1(text):
    return hashlib.sha1((text or "").encode()).hexdigest()


@pytest.mark.parametrize("split, compression", [("128m", "none"), ("700", "none"), ("3001", "none"), ("128m", "gzip")])
def test_round_trip_of_payloads_that_look_like_records(spark, split, compression):
    pages = tricky_pages()
    path = scratch_dir(spark, "test-archives")
    warc.write_archives(spark.createDataFrame(pages, PAGES).repartition(3), path, compression=compression)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = warc.read_archives(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = sorted(repr((i, len((h or "").encode()), sha1(h))) for i, _, h in pages)
    assert sorted(repr((r.page_id, r.payload_bytes, r.payload_digest)) for r in got) == want
    assert all(r.intact for r in got)
    revisits = {(r.page_id, r.refers_to) for r in got if r.record_type == "revisit"}
    assert revisits == {(3, 5), (4, 5), (None, 12)}


def test_splits_may_differ_between_two_scans(spark, monkeypatch):
    pages = tricky_pages()
    path = scratch_dir(spark, "test-archives")
    warc.write_archives(spark.createDataFrame(pages, PAGES).repartition(3), path)
    put_together = warc._joined

    def later(*args):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1100")
        return put_together(*args)

    monkeypatch.setattr(warc, "_joined", later)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3001")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = warc.read_archives(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(repr((r.page_id, r.payload_digest)) for r in got) == sorted(repr((i, sha1(h))) for i, _, h in pages)
    assert all(r.intact for r in got)


def test_agrees_with_its_sql(spark):
    assert spark_rows(warc.op7_warc_round_trip(spark, SF_DIR)) == oracle_rows(SF_DIR, warc.ORACLE)


def test_a_cut_archive_and_a_changed_payload(spark):
    path = scratch_dir(spark, "test-archives")
    good = record("first").replace("response\r\n", f"response\r\nWARC-Payload-Digest: sha1:{sha1('first')}\r\n")
    bad = record("second").replace("response\r\n", f"response\r\nWARC-Payload-Digest: sha1:{sha1('other')}\r\n")
    cut = record("z" * 500)[:300]
    spark.createDataFrame([(good + bad + cut,)], "value string").write.option("lineSep", "\r\n\r\n").text(path)
    rows = warc.read_archives(spark, path).collect()
    assert sorted((r.payload_bytes, r.payload_digest or "", r.intact) for r in rows) == sorted(
        [(5, sha1("first"), True), (6, sha1("second"), False), (500, "", False)]
    )


def test_odd_rows(spark):
    rows = [(None, None, None), (1, "u", ""), (2, "u", "p" * 1000), (2, "u", "p" * 1000), (1, "u", "p" * 1000), (3, "u", "p" * 999), (4, "u", "p" * 999)]
    frame = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 as payload", "2 as value", "3 as refers_to")
    path = scratch_dir(spark, "test-archives")
    warc.write_archives(frame, path)
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_archives(spark, path).collect())
    want = [(0, 0, "response", None), (1, 0, "response", None), (1, 1000, "revisit", 2), (2, 1000, "response", None)]
    assert got == [*want, (2, 1000, "response", None), (3, 999, "response", None), (4, 999, "response", None)]
    path = scratch_dir(spark, "test-archives")
    warc.write_archives(spark.createDataFrame([], PAGES), path)
    assert warc.read_archives(spark, path).count() == 0
