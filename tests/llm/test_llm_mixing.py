from collections import defaultdict

import pytest

from compare import oracle_rows, spark_rows
from odd_rows import no_documents, odd_documents
from stratum.llm import mixing

SF_DIR = "/root/testdata/sf0.001"


def test_agrees_with_its_sql(spark):
    assert spark_rows(mixing.op1_mix_sources(spark, SF_DIR)) == oracle_rows(SF_DIR, mixing.ORACLE)


def plain_targets(sizes, weights=(5, 2, 1), epochs=3):
    """Shares given out again until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(epochs * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {s: epochs * sizes[s] if s in full else rest * weight[s] / open_weight for s in names}
        over = {s for s in names if s not in full and target[s] > epochs * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 2000, "c": 900, "d": 5}, {"a": 700, "B": 1, "ä": 3, None: 4000}, {"a": 50}])
def test_targets_and_takes(spark, sizes):
    rows = []
    for s, n in sizes.items():
        at = 0
        while at < n:
            size = min(n - at, 1 + (at * 7) % 40)
            rows.append((len(rows), "w " * size, s))
            at += size
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = sorted(mixing.mix(frame, block_words=4).collect())
    assert first == sorted(mixing.mix(frame.repartition(7), block_words=4).collect())
    want, taken = plain_targets(sizes), defaultdict(int)
    for r in first:
        assert r.target == pytest.approx(want[r.source])
        assert r.source_size == sizes[r.source]
        assert r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 4 * 8


def test_small_sources_of_a_large_table_take_their_targets(spark):
    # Tail sources of 10 words; the first source is repeated, and no target is above its limit for the others.
    rows = [(i, "w " * 1000, "a") for i in range(2000)] + [(10_000 + i, "w " * 10, f"t{i:03}") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    quota, taken = {}, defaultdict(int)
    for r in mixing.mix(frame).collect():
        quota[r.source] = round(r.target)
        taken[r.source] += r.taken
    assert {s: taken[s] for s in quota} == quota
    slots = mixing.mixed_blocks(frame).select("slot", "source", "block").distinct().collect()
    assert len({r.slot for r in slots}) == len(slots) == sum(-(-q // 64) for q in quota.values())


def test_blocks_of_the_mix_are_even(spark):
    rows = [(i, "w " * 10, "abc"[i % 3]) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    blocks = mixing.mixed_blocks(frame, block_words=5).collect()
    taken = {(r.doc_id): r.taken for r in mixing.mix(frame, block_words=5).collect()}
    by_doc, by_slot = defaultdict(int), defaultdict(int)
    for b in blocks:
        by_doc[b.doc_id] += b.words
        by_slot[b.slot] += b.words
    assert all(by_doc[d] == n for d, n in taken.items())
    assert set(by_slot.values()) == {5}
    share = sum(b.words for b in blocks if b.slot < 200 and b.source == "a") / sum(b.words for b in blocks if b.slot < 200)
    assert share == pytest.approx(5 / 8, abs=0.02)


def test_points_are_even_and_stay_in_64_bits(spark):
    slots = spark.range(2000).selectExpr("id + 8000000000000 as id")
    points = sorted(r[0] for r in slots.select(mixing.point(slots["id"])).collect())
    gaps = [b - a for a, b in zip(points, points[1:])]
    assert all(0 <= p < 1 << 40 for p in points)
    assert max(gaps) <= 3 * min(gaps)


def test_odd_rows(spark):
    odd = odd_documents(spark)
    rows = mixing.mix(odd, block_words=8).collect()
    assert len(rows) == odd.count()
    assert all(r.taken == 0 for r in rows if r.size == 0)
    assert sum(r.size for r in rows if r.source is None) == 8
    assert mixing.mix(no_documents(spark)).count() == 0
    assert mixing.mixed_rows(odd).columns == odd.columns
