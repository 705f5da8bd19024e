"""Approximate nearest neighbours by multiprobe p-stable hashing.

A hash of a vector is floor((a.v + b) / w) with a normal `a`: near vectors agree often. A table joins several hashes to a
bucket. A query looks into its own bucket and then into perturbed ones, a hash one step up or down at a time, in the
order of estimated success: the smaller the sum of squared distances to the steps taken, the sooner. What the tables
find is merged and ranked by the exact cosine of the original vectors.

Equal vectors are one point, whose smallest ids stand for it; k + 1 of them are enough for an exact answer. Index and
probes meet in parts by hash of the bucket. A bucket beyond `most` points is split into several, and its probes go to all
of them, so a hot bucket is neither cut nor held in one task. A part returns the best k + 1 points of a query.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from stratum.llm.common import stored, table

PART_ROWS = 20_000


@dataclass(frozen=True)
class Tables:
    """How many tables, hashes a table, probes a table; the width of a hash for vectors of length one."""

    tables: int = 6
    hashes: int = 5
    probes: int = 120
    width: float = 1.2
    most: int = 4096
    seed: int = 5

    def hashed(self, vectors: np.ndarray) -> np.ndarray:
        """Positions on the hash lines in units of the width: rows x tables x hashes."""
        rng = np.random.default_rng([self.seed, vectors.shape[1]])
        lines = rng.standard_normal((vectors.shape[1], self.tables * self.hashes))
        shift = rng.random(self.tables * self.hashes)
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return (unit @ lines / self.width + shift).reshape(len(vectors), self.tables, self.hashes)

    def codes(self, cells: np.ndarray, size: int) -> np.ndarray:
        """A number for the bucket of cells (... x tables x hashes); different vector lengths do not meet."""
        rng = np.random.default_rng(self.seed)
        odd = rng.integers(0, 1 << 62, (self.tables, self.hashes)) * 2 + 1
        with np.errstate(over="ignore"):
            return (cells.astype(np.int64) * odd).sum(axis=-1) * 31 + size


def perturbations(place: np.ndarray, most: int) -> list[tuple[int, ...]]:
    """Sets of steps, the likeliest first: j < len(place) steps hash j down, j + len(place) steps it up.

    place: where the query lies in its cells, 0 to 1. The cost of a step is the square of the way to the next cell. A heap
    grows the sets by adding the next cheapest step or by trading the last one for it.
    """
    n = len(place)
    cost = np.concatenate([place**2, (1 - place) ** 2])
    order = np.argsort(cost, kind="stable")
    sorted_cost = cost[order]
    found: list[tuple[int, ...]] = [()]
    heap = [(sorted_cost[0], (0,))]
    while heap and len(found) < most:
        total, picks = heapq.heappop(heap)
        steps = tuple(int(order[i]) for i in picks)
        if len({s % n for s in steps}) == len(steps):
            found.append(steps)
        last = picks[-1]
        if last + 1 < 2 * n:
            heapq.heappush(heap, (total + sorted_cost[last + 1], (*picks, last + 1)))
            heapq.heappush(heap, (total - sorted_cost[last] + sorted_cost[last + 1], (*picks[:-1], last + 1)))
    return found


def usable(vector: str) -> Column:
    """Not null, not zero, every component there and finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_list()).astype(np.float64)


def _by_length(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for _, part in batch.groupby(batch["vector"].map(len)):
        yield part


def nearest(rows: DataFrame, is_query: Column, k: int = 5, spec: Tables = Tables()) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of `rows` (vec_id, embedding) for which `is_query` holds.

    Nearest first by cosine in double precision, ties to the smaller vec_id; the candidates are all other ids. Rows
    whose id is null or whose vector is null, zero, or holds null or non-finite components take no part; vectors of
    different lengths are not compared; rows that repeat an id and its vector count once. Other columns are not looked
    at. A query whose probes lead to fewer than k others is asked of all points, so it gets k answers or all there are.
    """
    given = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    ).filter(usable("vector") & F.col("vec_id").isNotNull())
    given = given.groupBy("vec_id", "vector").agg(F.max("asks").alias("asks"))
    first = W.partitionBy("vector").orderBy("vec_id")
    members = given.withColumn("_nth", F.row_number().over(first)).filter(F.col("_nth") <= k + 1)
    points = members.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    points = stored(points.select(F.monotonically_increasing_id().alias("point"), "vector", "ids"), "ann-points")
    asking = given.filter("asks").select("vec_id", "vector").withColumnRenamed("vec_id", "query_id")
    asking = stored(asking.join(points.select("point", "vector"), "vector").select("query_id", "point"), "ann-asking")
    wanted = points.join(asking.select("point").distinct(), "point", "left_semi").select("point", "vector")

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _by_length(batch):
                vectors = _matrix(part["vector"])
                cells = np.floor(spec.hashed(vectors)).astype(np.int64)
                codes = spec.codes(cells, vectors.shape[1])
                for t in range(spec.tables):
                    yield pd.DataFrame({"table": np.int32(t), "bucket": codes[:, t], "point": part["point"].to_numpy()})

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _by_length(batch):
                vectors = _matrix(part["vector"])
                places = spec.hashed(vectors)
                cells = np.floor(places).astype(np.int64)
                for point, place, cell in zip(part["point"], places - cells, cells):
                    for t in range(spec.tables):
                        sets = perturbations(place[t], spec.probes)
                        moved = np.repeat(cell[None], len(sets), axis=0)
                        for i, steps in enumerate(sets):
                            for s in steps:
                                moved[i, t, s % spec.hashes] += 1 if s >= spec.hashes else -1
                        codes = np.unique(spec.codes(moved, vectors.shape[1])[:, t])
                        yield pd.DataFrame({"table": np.int32(t), "bucket": codes, "point": point})

    schema = "table int, bucket long, point long"
    entries = points.select("point", "vector").mapInPandas(index, schema)
    probes = wanted.mapInPandas(probe, schema)
    large = stored(
        entries.groupBy("table", "bucket").count().filter(F.col("count") > spec.most).select(
            "table", "bucket", F.ceil(F.col("count") / spec.most).cast("int").alias("_splits")
        ),
        "ann-large",
    )
    parts = max(1, math.ceil(points.count() * spec.tables / PART_ROWS))
    part = F.pmod(F.xxhash64("table", "bucket", "_split"), F.lit(parts)).cast("int")
    splits = F.coalesce(F.col("_splits"), F.lit(1))
    placed = (
        entries.join(large, ["table", "bucket"], "left")
        .withColumn("_split", F.pmod(F.xxhash64("point"), splits))
        .select(part.alias("part"), "table", "bucket", "point")
    )
    asked = (
        probes.join(large, ["table", "bucket"], "left")
        .withColumn("_split", F.explode(F.sequence(F.lit(0).cast("long"), splits.cast("long") - 1)))
        .select(part.alias("part"), "table", "bucket", "point")
        .groupBy("part", "point")
        .agg(F.collect_set(F.struct("table", "bucket")).alias("buckets"))
    )
    index_side = placed.join(points.select("point", "vector", F.col("ids")[0].alias("least")), "point")
    query_side = asked.join(wanted, "point")

    def search(there: pd.DataFrame, here: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(there) and len(here):
            where = {key: rows.to_numpy() for key, rows in there.reset_index().groupby(["table", "bucket"])["index"]}
            points_of, least = there["point"].to_numpy(), there["least"].to_numpy()
            size = there["vector"].map(len).to_numpy()
            flat = {n: np.zeros((len(there), n)) for n in np.unique(size)}
            for n, matrix in flat.items():
                matrix[size == n] = _matrix(there["vector"][size == n])
            norms = {n: np.linalg.norm(m, axis=1) for n, m in flat.items()}
            for point, vector, buckets in zip(here["point"], here["vector"], here["buckets"]):
                found = [where[key] for b in buckets if (key := (b["table"], b["bucket"])) in where]
                vector = np.asarray(vector, np.float64)
                if not found or len(vector) not in flat:
                    continue
                rows = np.concatenate(found)
                rows = rows[size[rows] == len(vector)]
                _, once = np.unique(points_of[rows], return_index=True)
                rows = rows[once]
                own = np.linalg.norm(vector)
                rough = flat[len(vector)][rows] @ vector / (norms[len(vector)][rows] * own)
                if len(rows) > 4 * k:
                    edge = np.partition(rough, len(rough) - k - 1)[len(rough) - k - 1]
                    rows = rows[rough >= edge - 1e-9]
                score = (flat[len(vector)][rows] * vector).sum(axis=1) / (norms[len(vector)][rows] * own)
                best = np.lexsort((least[rows], -score))[: k + 1]
                out += [(point, points_of[rows[i]], score[i]) for i in best]
        return pd.DataFrame(out, columns=["asked", "found", "score"])

    def searched(there: DataFrame, here: DataFrame) -> DataFrame:
        found = there.groupBy("part").cogroup(here.groupBy("part")).applyInPandas(search, "asked long, found long, score double")
        return found.groupBy("asked", "found").agg(F.max("score").alias("score"))

    best = stored(searched(index_side, query_side), "ann-found")
    # Ids that a query has found, its own among them.
    sizes = points.select(F.col("point").alias("found"), F.size("ids").alias("_ids"))
    ids = best.join(sizes, "found").groupBy("asked").agg(F.sum("_ids").alias("_ids"))
    few = wanted.join(ids, wanted["point"] == ids["asked"], "left").filter(F.coalesce("_ids", F.lit(0)) <= k)
    few = stored(few.select("point", "vector"), "ann-few")
    if not few.isEmpty():
        everywhere = points.select(
            F.pmod(F.xxhash64("point"), F.lit(parts)).cast("int").alias("part"),
            F.lit(0).alias("table"), F.lit(0).cast("long").alias("bucket"), "point", "vector", F.col("ids")[0].alias("least"),
        )
        one = F.array(F.struct(F.lit(0).alias("table"), F.lit(0).cast("long").alias("bucket"))).alias("buckets")
        again = few.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "point", one, "vector")
        best = best.join(few.select(F.col("point").alias("asked")), "asked", "left_anti").unionByName(searched(everywhere, again))
    near = best.join(points.select(F.col("point").alias("found"), "ids"), "found")
    by_rank = W.partitionBy("asked").orderBy(F.desc("score"), F.col("ids")[0])
    near = near.withColumn("_nth", F.row_number().over(by_rank)).filter(F.col("_nth") <= k + 1).drop("_nth")
    answers = (
        asking.join(near.withColumnRenamed("asked", "point"), "point")
        .select("query_id", F.explode("ids").alias("vec_id"), "score")
        .filter("vec_id != query_id")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op3_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """Every 50th vector against all others."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
