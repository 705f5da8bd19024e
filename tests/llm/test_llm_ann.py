import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, asks, k=5):
    """Exact answers: query -> [(score, vec_id)]."""
    fine = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            fine[i] = np.array(v, np.float32).astype(float)
    out = {}
    for q in filter(asks, fine):
        score = lambda i: fine[q] @ fine[i] / (np.linalg.norm(fine[q]) * np.linalg.norm(fine[i]))  # noqa: E731, B023
        others = sorted((-score(i), i) for i in fine if i != q and len(fine[i]) == len(fine[q]))
        out[q] = [(-s, i) for s, i in others[:k]]
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_of_the_query(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = plain(rows, lambda i: i % 50 == 0)
    got = {}
    for r in ann.op3_nearest_neighbours(spark, sf_dir).collect():
        got.setdefault(r.query_id, []).append(r)
    assert got.keys() == want.keys()
    exact = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q, found in got.items():
        found.sort(key=lambda r: r.rank)
        assert [r.rank for r in found] == list(range(1, len(found) + 1))
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        for r in found:
            a, b = exact[q], exact[r.vec_id]
            assert r.score == pytest.approx(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)), abs=1e-12)
    hits = sum(len({r.vec_id for r in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_a_hot_vector_and_ties(spark):
    """A third of all rows share a vector; buckets are split; nothing is lost."""
    rng = np.random.default_rng(0)
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(0, 900, 3)]
    rows += [(i, [float(x) for x in rng.standard_normal(3).round(1)]) for i in range(900) if i % 3]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    spec = ann.Tables(tables=4, hashes=2, probes=60, width=2.0, most=16)
    got = {}
    for r in ann.nearest(frame, F.col("vec_id") % 50 == 0, spec=spec).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = plain([(i, list(np.array(v, np.float32))) for i, v in rows], lambda i: i % 50 == 0)
    hits = total = 0
    for q, answers in want.items():
        mine = [i for _, i, _ in sorted(got.get(q, []))]
        hits += len(set(mine) & {i for _, i in answers})
        total += len(answers)
        if q % 3 == 0:
            assert mine == [i for i in range(0, 900, 3) if i != q][:5]
    assert hits >= 0.9 * total


def test_perturbations_come_in_order_of_cost():
    place = np.array([0.1, 0.55, 0.9])
    cost = lambda steps: sum(place[s] ** 2 if s < 3 else (1 - place[s - 3]) ** 2 for s in steps)
    sets = ann.perturbations(place, 100)
    assert sets[0] == () and len({frozenset(s) for s in sets}) == len(sets) == 27
    costs = [cost(s) for s in sets]
    assert costs == pytest.approx(sorted(costs))


def test_all_candidates_of_a_small_table(spark):
    """Probes may lead nowhere; a query still gets all there are, and the best of them."""
    rng = np.random.default_rng(3)
    for n in (1, 3, 6, 9):
        rows = [(50 * i, [float(x) for x in rng.standard_normal(32)]) for i in range(n)]
        frame = spark.createDataFrame(rows, SCHEMA)
        got = {}
        for r in ann.nearest(frame, F.col("vec_id") % 50 == 0, spec=ann.Tables(tables=1, probes=1)).collect():
            got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
        want = plain([(i, list(np.array(v, np.float32))) for i, v in rows], lambda i: True)
        for q, answers in want.items():
            assert [i for _, i in sorted(got.get(q, []))] == [i for _, i in answers]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [1.0, 1.0])]
    rows += [(7, [2.0, 0.1]), (7, [2.0, 0.1]), (8, [1.0, 2.0, 3.0]), (9, [-1.0, 0.0]), (50, [0.0, 1.0]), (100, [0.0, 0.0])]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("vector", "point", "bucket", "score", "rank", "label"):
        frame = frame.withColumn(name, F.lit(None).cast("int"))
    spec = ann.Tables(tables=8, hashes=1, probes=10, width=4.0)
    got = sorted((r.query_id, r.rank, r.vec_id) for r in ann.nearest(frame, F.col("vec_id") % 50 == 0, spec=spec).collect())
    assert got == [(0, 1, 7), (0, 2, 50), (0, 3, 9), (50, 1, 7), (50, 2, 0), (50, 3, 9)]
    assert ann.nearest(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
