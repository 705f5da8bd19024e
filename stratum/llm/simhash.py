"""SimHash near-duplicates by vantage-point trees.

Fingerprints are grouped first, so equal ones are one point however many documents share it. A shallow vantage-point
tree, made from a bounded sample, splits Hamming space into shards: a point is at home in one, and visits every shard
that a ball of the search radius around it reaches, by the triangle bounds of the nodes on the way. Of evenly spread points a
shard's visitors grow with the table though its home points do not, so the visitors are split: each piece has all home
points and a bounded part of those that ask. A piece builds a tree of the home points and runs its own part down it,
pruning by the same bounds; what is left in the leaves is compared bit by bit. A piece reports a spanning forest of the links it finds, never all pairs, and the
forests are joined into components by labels that spread along edges and jump along themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from stratum.llm.common import chosen_rows, stored, table, text_key, text_of

SEED = 42
BITS = 64
# Sampled points per shard of the tree, home points of a shard, and of a leaf inside a shard.
SAMPLE, SHARD, LEAF = 200, 25_000, 192
# Points that ask in a piece of a shard, about.
ASKED = 50_000
MOST_SAMPLED = 100_000
# Shingles hashed at a time, and links gathered before they are reduced to a forest.
BLOCK, LINKS = 1 << 15, 1 << 20


def fingerprint(text: str, words: int = 3) -> int:
    """The fingerprint as a signed 64-bit number; of text without words it is zero."""
    from xxhash import xxh64_intdigest

    parts = text.encode().lower().split()  # bytes: only A-Z and only ASCII white space
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, BLOCK):
        some = parts[at : at + BLOCK + words - 1]
        shingles = map(b" ".join, zip(*(some[i:] for i in range(words)))) if len(parts) >= words else [b" ".join(parts)]
        hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, key, point for every row of `docs`."""

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    point = F.pandas_udf(of, "long")(text_of())
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), point.alias("point"))


def _distance(points: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ point)


def _split(points: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, int] | None:
    """A vantage point and a radius that part the points most evenly; none if no candidate parts them."""
    best = None
    for candidate in rng.choice(points, min(8, len(points)), replace=False):
        d = _distance(points, candidate)
        radius = int(np.median(d))
        for r in (radius, radius - 1):
            inside = int((d <= r).sum())
            # Points near the radius are asked on both sides, so few of them are as good as an even split.
            worst = max(inside, len(d) - inside) + int((np.abs(d - r - 0.5) < 2).sum()) / 2
            if 0 < inside < len(d) and (best is None or worst < best[0]):
                best = (worst, candidate, r)
    return best and (best[1], best[2])


class Tree:
    """Vantage points and radii of a shallow tree over a sample; its leaves are shards.

    A part is split until it holds no more than one and a half times its share of the sample, so an uneven split leaves
    no large shard behind.
    """

    def __init__(self, sample: np.ndarray, shards: int):
        self.nodes: list[tuple[int, int, int, int]] = []  # point, radius, inner, outer; children < 0 are shards
        self.shards = 0
        self.root = self._grow(sample, 1.5 * len(sample) / shards, np.random.default_rng(7))

    def _grow(self, sample: np.ndarray, most: float, rng: np.random.Generator) -> int:
        cut = _split(sample, rng) if len(sample) > max(1, most) else None
        if cut is None:
            self.shards += 1
            return -self.shards
        d = _distance(sample, cut[0])
        at = len(self.nodes)
        self.nodes.append((0, 0, 0, 0))
        inner = self._grow(sample[d <= cut[1]], most, rng)
        outer = self._grow(sample[d > cut[1]], most, rng)
        self.nodes[at] = (int(cut[0]), cut[1], inner, outer)
        return at

    def reach(self, points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, indexes of points whose ball reaches it, which of them are at home there)."""
        todo = [(self.root, np.arange(len(points)), np.ones(len(points), bool))]
        while todo:
            at, rows, home = todo.pop()
            if not len(rows):
                continue
            if at < 0:
                yield -at - 1, rows, home
                continue
            point, r, inner, outer = self.nodes[at]
            d = _distance(points[rows], np.uint64(point)).astype(int)
            near, far = d <= r + radius, d > r - radius
            todo.append((inner, rows[near], (home & (d <= r))[near]))
            todo.append((outer, rows[far], (home & (d > r))[far]))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For n points and links a-b, the smallest index of each point's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
        if (label == before).all():
            return label


def close_pairs(home: np.ndarray, asked: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (of `home`, of `asked`) within the radius, found by a tree over `home`, in parts."""
    rng = np.random.default_rng(11)
    todo = [(np.arange(len(home)), np.arange(len(asked)))]
    while todo:
        mine, rows = todo.pop()
        if not len(mine) or not len(rows):
            continue
        cut = _split(home[mine], rng) if len(mine) > LEAF else None
        if cut is None:
            step = max(1, (1 << 21) // len(mine))
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                i, j = np.nonzero(np.bitwise_count(asked[some][:, None] ^ home[mine][None, :]) <= radius)
                yield mine[j], some[i]
            continue
        d, e = _distance(home[mine], cut[0]).astype(int), _distance(asked[rows], cut[0]).astype(int)
        todo.append((mine[d <= cut[1]], rows[e <= cut[1] + radius]))
        todo.append((mine[d > cut[1]], rows[e > cut[1] - radius]))


def pieces_of(tree: Tree, sample: np.ndarray, n: int, radius: int) -> np.ndarray:
    """Into how many pieces each shard is split, from how many of the sampled points visit it."""
    visits = np.zeros(tree.shards, np.int64)
    for shard, rows, _ in tree.reach(sample, radius):
        visits[shard] += len(rows)
    return np.maximum(1, np.ceil(visits * (n / max(1, len(sample))) / ASKED)).astype(np.int64)


def shard_links(points: np.ndarray, home: np.ndarray, radius: int, asking: np.ndarray | None = None) -> np.ndarray:
    """For every point of a shard the smallest index of those linked to it, directly or through others, in the shard.

    Links of the `asking` points (all, if not given) to the home points are looked for."""
    mine = np.flatnonzero(home)
    asked = np.arange(len(points)) if asking is None else np.flatnonzero(asking)
    a, b, held = [], [], 0
    label = np.arange(len(points))

    def reduce() -> None:
        nonlocal label, held
        joined = np.flatnonzero(label != np.arange(len(points)))
        label = forest(len(points), np.concatenate([joined, *a]), np.concatenate([label[joined], *b]))
        a.clear(), b.clear()
        held = 0

    for i, j in close_pairs(points[mine], points[asked], radius):
        apart = mine[i] != asked[j]
        a.append(mine[i][apart])
        b.append(asked[j][apart])
        held += int(apart.sum())
        if held > LINKS:
            reduce()
    reduce()
    return label


def links(points: DataFrame, radius: int) -> DataFrame:
    """point, root: a spanning forest for every shard, over the distinct points of `points` (a stored frame)."""
    n = points.count()
    shards = max(1, math.ceil(n / SHARD))
    wanted = min(MOST_SAMPLED, SAMPLE * shards)
    sample = np.array([], "<i8")
    if shards > 1:
        rate = max(1, n // wanted)
        picked = points.filter(F.pmod(F.xxhash64("point"), F.lit(rate)) == 0).limit(MOST_SAMPLED)
        sample = np.sort(picked.toPandas()["point"].to_numpy("<i8"))
    tree = Tree(sample.view(np.uint64), shards)

    pieces = pieces_of(tree, sample.view(np.uint64), n, radius)
    first = np.concatenate([[0], np.cumsum(pieces)])

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own, spread = batch["point"].to_numpy("<i8"), batch["spread"].to_numpy()
            for shard, rows, home in tree.reach(own.view(np.uint64), radius):
                mine = spread[rows] % pieces[shard]
                # A home point goes to all pieces to be found, and asks in one of them.
                for piece in range(pieces[shard]):
                    here = home | (mine == piece)
                    yield pd.DataFrame(
                        {
                            "piece": np.int64(first[shard] + piece),
                            "point": own[rows[here]],
                            "home": home[here],
                            "asks": mine[here] == piece,
                        }
                    )

    def find(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("point")
        own = part["point"].to_numpy("<i8")
        label = shard_links(own.view(np.uint64), part["home"].to_numpy(bool), radius, part["asks"].to_numpy(bool))
        moved = label != np.arange(len(own))
        return pd.DataFrame({"point": own[moved], "root": own[label[moved]]})

    spread = F.pmod(F.xxhash64("point"), F.lit(1 << 40)).alias("spread")
    dealt = points.select("point", spread).mapInPandas(deal, "piece long, point long, home boolean, asks boolean")
    return dealt.groupBy("piece").applyInPandas(find, "point long, root long")


def components(edges: DataFrame) -> DataFrame:
    """point, label for every point of `edges` (point, root): the smallest point that can be reached."""
    edges = stored(edges.distinct(), "simhash-edges")
    both = edges.unionByName(edges.select(F.col("root").alias("point"), F.col("point").alias("root")))
    labels = stored(both.groupBy("point").agg(F.least(F.col("point"), F.min("root")).alias("label")), "simhash-labels")
    total = None
    while True:
        jump = labels.select(F.col("point").alias("_at"), F.col("label").alias("_next"))
        seen = both.join(jump, both["root"] == jump["_at"]).select("point", F.col("_next").alias("label"))
        lowest = labels.unionByName(seen).groupBy("point").agg(F.min("label").alias("label"))
        labels = stored(
            lowest.join(jump, lowest["label"] == jump["_at"]).select("point", F.least("label", "_next").alias("label")), "simhash-labels"
        )
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return labels
        total = now


def _grouped(docs: DataFrame, words: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key, point) and points (point, label): equal labels are one component."""
    rows = stored(fingerprints(docs, words), "simhash-rows")
    points = stored(rows.groupBy("point").agg(F.min("doc_id").alias("smallest")), "simhash-points")
    labels = components(links(points, radius))
    named = points.join(labels.withColumnRenamed("point", "_point"), F.col("point") == F.col("_point"), "left").select(
        "point", "smallest", F.coalesce("label", "point").alias("label")
    )
    return rows, stored(named, "simhash-named")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id for every row of `docs` (doc_id, text).

    Documents are linked if their fingerprints differ in at most `radius` bits; component_id is the smallest doc_id that
    links reach, the document's own included. A null text is empty; text without words has fingerprint zero, linked like
    any other. A null doc_id never is a component_id unless the component has no other. Repeated rows are returned each.
    Other columns are not looked at.
    """
    rows, named = _grouped(docs, words, radius)
    least = named.groupBy("label").agg(F.min("smallest").alias("component_id"))
    of = stored(named.select("point", "label").join(least, "label").select(F.col("point").alias("_point"), "component_id"), "simhash-of")
    return rows.join(of, F.col("point") == F.col("_point")).select(
        "doc_id", F.lpad(F.lower(F.hex("point")), 16, "0").alias("fingerprint"), "component_id"
    )


def first_rows(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """One row of `docs` of each component, with all its columns: that with the smallest doc_id."""
    rows, named = _grouped(docs, words, radius)
    of = named.select(F.col("point").alias("_point"), "label")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key"))
    best = rows.join(of, F.col("point") == F.col("_point")).groupBy("label").agg(first.alias("first"))
    return chosen_rows(docs, best.select("first.doc_id", "first.key"))


def op8_simhash_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
