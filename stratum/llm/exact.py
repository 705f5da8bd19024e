"""Exact deduplication against immutable snapshots that carry binary-fuse filters.

A snapshot is a table of text groups by digest and, for every shard of digests, a static binary-fuse filter: about nine
bits per digest, no false negatives, one false positive in 256. An incoming batch is grouped by itself first. Its
digests are screened by the filters; only positives are joined with the exact groups of the snapshot. Groups of more
than one row are then compared byte by byte; a digest that stands for different texts is split by text.

Filters live in the shards of a stored table and meet the digests of their shard there: none is collected or broadcast.
Rows are counted into groups before they are shuffled, so a text that a third of all rows share is one row per task.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from stratum.llm.common import LOWER, UPPER, chosen_rows, stored, table, text_of

SHARD_DIGESTS = 50_000
# Rows from which on a group is a large one.
LARGE = 1000
_GOLD, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = keys + _GOLD * np.uint64(seed + 1)
        h = (h ^ (h >> np.uint64(30))) * _MIX1
        h = (h ^ (h >> np.uint64(27))) * _MIX2
        return h ^ (h >> np.uint64(31))


@dataclass(frozen=True)
class FuseFilter:
    """A three-way binary-fuse filter of 64-bit keys with 8-bit fingerprints."""

    seed: int
    segment: int
    starts: int
    cells: bytes

    @staticmethod
    def _places(h: np.ndarray, segment: int, starts: int) -> np.ndarray:
        first = (((h >> np.uint64(32)) * np.uint64(starts)) >> np.uint64(32)).astype(np.int64)
        mask = np.uint64(segment - 1)
        second = (first + segment) ^ ((h >> np.uint64(18)) & mask).astype(np.int64)
        third = (first + 2 * segment) ^ (h & mask).astype(np.int64)
        return np.stack([first, second, third])

    @staticmethod
    def _print(h: np.ndarray) -> np.ndarray:
        return (h ^ (h >> np.uint64(32)) ^ (h >> np.uint64(56))).astype(np.uint8)

    @classmethod
    def of(cls, keys: np.ndarray) -> FuseFilter:
        """Built by peeling, a whole round of singly used cells at a time; another seed is tried if that gets stuck."""
        keys = np.unique(keys.astype(np.uint64))
        n = max(len(keys), 2)
        segment = min(1 << 18, 1 << max(2, int(math.log(n) / math.log(3.33) + 2.25)))
        wanted = int(n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n)))
        starts = max(1, math.ceil(wanted / segment) - 2) * segment
        for seed in range(1000):
            h = _mixed(keys, seed)
            cells = cls._built(h, cls._places(h, segment, starts), starts + 2 * segment)
            if cells is not None:
                return cls(seed, segment, starts, cells.tobytes())
        raise RuntimeError("no filter found")

    @classmethod
    def _built(cls, h: np.ndarray, places: np.ndarray, size: int) -> np.ndarray | None:
        index = np.arange(len(h))
        uses = np.bincount(places.ravel(), minlength=size)
        sums = np.zeros(size, np.int64)
        for row in places:
            np.add.at(sums, row, index)
        gone = np.zeros(len(h), bool)
        rounds = []
        single = np.flatnonzero(uses == 1)
        while len(single):
            keys, at = np.unique(sums[single], return_index=True)
            rounds.append((keys, single[at]))
            gone[keys] = True
            for row in places[:, keys]:
                np.subtract.at(uses, row, 1)
                np.subtract.at(sums, row, keys)
            touched = np.unique(places[:, keys])
            single = touched[uses[touched] == 1]
        if not gone.all():
            return None
        cells = np.zeros(size, np.uint8)
        prints = cls._print(h)
        for keys, own in reversed(rounds):
            cells[own] = 0
            a, b, c = places[:, keys]
            cells[own] = prints[keys] ^ cells[a] ^ cells[b] ^ cells[c]
        return cells

    def maybe(self, keys: np.ndarray) -> np.ndarray:
        """False for keys that were certainly not put in."""
        h = _mixed(keys.astype(np.uint64), self.seed)
        a, b, c = self._places(h, self.segment, self.starts)
        cells = np.frombuffer(self.cells, np.uint8)
        return (cells[a] ^ cells[b] ^ cells[c]) == self._print(h)


def normal(text: Column) -> Column:
    """The text with A-Z lowered."""
    return F.translate(text, UPPER, LOWER)


def sha256_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _keys(digest: pd.Series) -> np.ndarray:
    return digest.str[:16].map(lambda x: int(x, 16)).to_numpy(np.uint64)


@dataclass(frozen=True)
class Snapshot:
    """Groups of equal texts (digest, best, n) and the filter of each shard of their digests."""

    groups: DataFrame
    filters: DataFrame
    shards: int

    def shard(self, digest: str) -> Column:
        return F.pmod(F.xxhash64(digest), F.lit(self.shards)).cast("int")


def group_rows(rows: DataFrame) -> DataFrame:
    """digest, best (the largest doc_id, and of rows that share it the smallest key), n."""
    return rows.groupBy("digest").agg(
        F.max(F.struct("doc_id", F.negative(F.col("key").cast("decimal(20,0)")).alias("down"))).alias("best"),
        F.count(F.lit(1)).alias("n"),
    )


def take_snapshot(rows: DataFrame) -> Snapshot:
    """The snapshot of `rows` (doc_id, digest, key)."""
    groups = stored(group_rows(rows), "exact-groups")
    shards = max(1, math.ceil(groups.count() / SHARD_DIGESTS))
    empty = Snapshot(groups, groups, shards)

    def build(part: pd.DataFrame) -> pd.DataFrame:
        made = FuseFilter.of(_keys(part["digest"]))
        row = (part["shard"].iloc[0], made.seed, made.segment, made.starts, made.cells)
        return pd.DataFrame([row], columns=["shard", "seed", "segment", "starts", "cells"])

    filters = (
        groups.select("digest", empty.shard("digest").alias("shard"))
        .groupBy("shard")
        .applyInPandas(build, "shard int, seed int, segment int, starts int, cells binary")
    )
    return Snapshot(groups, stored(filters, "exact-filters"), shards)


def screen(groups: DataFrame, snapshot: Snapshot) -> DataFrame:
    """`groups` (digest, best, n), a stored frame, with `maybe`: false if the snapshot certainly has no such digest.

    Where the batch is the larger one, the digests of a shard are tested in several parts by copies of its filter.
    """
    splits = max(1, math.ceil(groups.count() / (snapshot.shards * SHARD_DIGESTS)))
    part = F.pmod(F.hash("digest"), F.lit(splits))
    incoming = groups.withColumns({"shard": snapshot.shard("digest"), "part": part})
    filters = snapshot.filters.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))

    def test(part: pd.DataFrame, made: pd.DataFrame) -> pd.DataFrame:
        out = part[["digest"]].copy()
        if len(made) and len(part):
            row = made.iloc[0]
            made_filter = FuseFilter(int(row["seed"]), int(row["segment"]), int(row["starts"]), row["cells"])
            out["maybe"] = made_filter.maybe(_keys(part["digest"]))
        else:
            out["maybe"] = False
        return out

    screened = (
        incoming.select("shard", "part", "digest")
        .groupBy("shard", "part")
        .cogroup(filters.groupBy("shard", "part"))
        .applyInPandas(test, "digest string, maybe boolean")
    )
    return groups.join(screened, "digest")


def merge_batch(batch: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Groups (digest, best, n) of the snapshot and the batch's rows together."""
    own = stored(group_rows(batch), "exact-batch")
    screened = stored(screen(own, snapshot), "exact-screened")
    known = (
        screened.filter("maybe")
        .join(snapshot.groups.select("digest", F.col("best").alias("_best"), F.col("n").alias("_n")), "digest")
        .select("digest", F.greatest("best", "_best").alias("best"), (F.col("n") + F.col("_n")).alias("n"))
    )
    known = stored(known, "exact-known")
    fresh = screened.filter("not maybe").select("digest", "best", "n").unionByName(
        screened.filter("maybe").select("digest", "best", "n").join(known, "digest", "left_anti")
    )
    return known.unionByName(fresh).unionByName(snapshot.groups.join(known, "digest", "left_anti"))


def dedup(docs: DataFrame, is_new: Column, digest: Callable[[Column], Column] = sha256_of) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256, split.

    Rows for which `is_new` holds are the incoming batch, the others the snapshot; how rows are split changes no result.
    Texts are equal when they are identical after lowering A-Z only; null is the empty text. Of equal texts the largest
    doc_id stays, of rows that repeat it just one. Null ids come last: keep_id is null only if a group has no other.
    Other columns are not looked at. `split` is true for rows whose digest stood for several texts. `digest` gives hex
    of 16 digits or more and is a parameter for tests of that case.
    """
    return _dedup(docs, is_new, digest).drop("key")


def _dedup(docs: DataFrame, is_new: Column, digest: Callable[[Column], Column]) -> DataFrame:
    text = text_of()
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            digest(normal(text)).alias("digest"),
            F.xxhash64(text).alias("key"),
            F.coalesce(is_new, F.lit(False)).alias("is_new"),
        ),
        "exact-rows",
    )
    snapshot = take_snapshot(rows.filter("not is_new"))
    groups = stored(merge_batch(rows.filter("is_new"), snapshot), "exact-merged")
    clash = stored(_clashing(docs, rows, groups, digest), "exact-clash")
    counted = rows.groupBy("doc_id", "digest", "key").agg(F.count(F.lit(1)).alias("_rows"))
    sound = counted.join(clash, "digest", "left_anti")
    # The groups of many rows are few: where their stored size is small, their rows are not dealt by digest at all.
    large = stored(groups.filter(F.col("n") > LARGE), "exact-large")
    rest = groups.filter(F.col("n") <= LARGE)
    by_size = _labelled(sound, large, "digest").unionByName(_labelled(sound.join(large, "digest", "left_anti"), rest, "digest"))
    whole = by_size.select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"), F.lit(False).alias("split"), "key"
    )
    if not clash.isEmpty():
        whole = whole.unionByName(_by_text(docs, clash, digest))
    return whole


def latest_rows(docs: DataFrame, is_new: Column) -> DataFrame:
    """The rows of `docs` that `dedup` keeps, with all their columns."""
    labelled = _dedup(docs, is_new, sha256_of)
    return chosen_rows(docs, labelled.filter("kept").select("doc_id", "key"))


def _clashing(docs: DataFrame, rows: DataFrame, groups: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Digests whose rows differ in their bytes. Only texts that share a digest with another row are compared."""
    several = groups.filter("n > 1").select("digest")
    # Copies are folded before the join: a text that a third of all rows share is one row there.
    wanted = rows.select(F.col("key").alias("_key"), "digest").distinct().join(several, "digest", "left_semi")
    wanted = wanted.withColumnRenamed("digest", "_digest")
    texts = docs.select(text_of().alias("text")).withColumn("_key", F.xxhash64("text"))
    return (
        texts.join(stored(wanted, "exact-wanted").hint("shuffle_hash"), "_key")
        .select(F.col("_digest").alias("digest"), normal(F.col("text")).alias("text"))
        .groupBy("digest")
        .agg(F.min("text").alias("low"), F.max("text").alias("high"))
        .filter("low != high")
        .select("digest")
    )


def _labelled(counted: DataFrame, groups: DataFrame, by: str) -> DataFrame:
    """`counted` (doc_id, key, _rows, `by`) as one row per row it counts, with keep_id, group_size and kept."""
    best = (F.col("doc_id").eqNullSafe(F.col("best.doc_id"))) & (F.negative(F.col("key").cast("decimal(20,0)")) == F.col("best.down"))
    return (
        counted.join(groups.select(F.col(by).alias("_by"), "best", "n"), F.col(by) == F.col("_by"))
        .withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))))
        .withColumn("keep_id", F.col("best.doc_id"))
        .withColumn("group_size", F.col("n"))
        .withColumn("kept", best & (F.col("_nth") == 1))
    )


def _by_text(docs: DataFrame, clash: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """The rows of clashing digests, grouped by their texts themselves."""
    text = text_of()
    mine = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        normal(text).alias("text"),
        F.xxhash64(text).alias("key"),
        digest(normal(text)).alias("_digest"),
    ).join(clash.withColumnRenamed("digest", "_digest"), "_digest", "left_semi")
    counted = mine.groupBy("doc_id", "text", "key").agg(F.count(F.lit(1)).alias("_rows"))
    groups = group_rows(mine.withColumnRenamed("text", "digest")).withColumnRenamed("digest", "text")
    return _labelled(counted, groups, "text").select(
        "doc_id", "keep_id", "group_size", "kept", sha256_of(F.col("text")).alias("text_sha256"), F.lit(True).alias("split"), "key"
    )


def half() -> Column:
    """Splits a table into a snapshot and a batch that follows it, by a hash of the id."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1


def op6_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """The first half of `documents` is the snapshot, the second the batch that comes in."""
    return dedup(table(spark, sf_dir, "documents"), half()).drop("split")


ORACLE = """
with texts as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept,
  sha256(t) as text_sha256
from texts window w as (partition by t)
"""
