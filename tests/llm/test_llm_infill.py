import hashlib
import random
import re

import pytest

from compare import oracle_rows, spark_rows
from odd_rows import no_documents, odd_documents
from stratum.llm import infill

SF_DIR = "/root/testdata/sf0.001"


def by_hand(doc_id, text):
    """The same by a loop over the units."""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return n, "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


def texts():
    rng = random.Random(5)
    parts = ["a", "Word", " ", "\n", "\r\n", "\x00", "é", "日本", "\U0001f600", "<", "P>", "<S", "M", "<P", ">", "9", "ﬁ", "İ"]
    for i in range(400):
        yield i, "".join(rng.choice(parts) for _ in range(rng.randrange(30)))
    yield 1000, "word, " * 60_000
    yield 1001, "x" * 300_000
    yield 1002, "\n" * 100_000
    for i, mark in enumerate(("<P>", "<S>", "<M>")):
        yield 2000 + i, f"before {mark} after"


def test_all_forms_against_a_loop(spark):
    rows = list(texts())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = infill.fill_in_middle(docs).withColumn("back", infill.restored()).collect()
    want = {i: by_hand(i, t) for i, t in rows}
    assert {r.doc_id: (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got} == want
    assert {r.doc_id: r.back for r in got} == dict(rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_markers_half_written_at_the_cuts(spark):
    rows = [(i, "<P" * (i % 4) + "<S" + ">" * (i % 3) + "<" * (i % 5) + "M>" * (i % 2)) for i in range(500)]
    rows = [(i, t) for i, t in rows if not any(m in t for m in ("<P>", "<S>", "<M>"))]
    got = infill.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("back", infill.restored())
    assert {r.doc_id: r.back for r in got.collect()} == dict(rows)


def test_query_agrees_with_sql(spark):
    got = spark_rows(infill.op13_fill_in_middle(spark, SF_DIR))
    assert got == oracle_rows(SF_DIR, infill.ORACLE)


@pytest.mark.parametrize("seed", [1, 7])
def test_odd_rows(spark, seed):
    odd = odd_documents(spark)
    got = infill.fill_in_middle(odd, seed).withColumn("back", infill.restored()).collect()
    assert sorted(repr((r.doc_id, r.back)) for r in got) == sorted(repr((r.doc_id, r.text or "")) for r in odd.collect())
    if seed == 1:
        want = [repr((r.doc_id, *by_hand(r.doc_id, r.text or ""))) for r in odd.collect()]
        assert sorted(repr((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in got) == sorted(want)
    assert infill.fill_in_middle(no_documents(spark)).count() == 0
