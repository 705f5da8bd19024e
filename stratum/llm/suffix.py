"""Removal of repeated passages, by suffix arrays over shards that hold every pair of equal strings together.

A string of `least` bytes has a content-defined place: the gram in it whose hash is smallest. Equal strings have equal
places, so the gram is the key by which they meet. Strings whose starts follow one another and that share a place are
one segment; all strings of a text are in exactly one segment each.

1. Equal texts are one text with a count; repeated whole, they need no further look.
2. Segments are dealt by key as fingerprints. Keys that occur once cannot repeat. Segments that are equal throughout
   are folded: all their strings repeat.
3. What is left are keys with segments that differ somewhere. Their bytes are put into shards, key by key, and a suffix
   array is induced over each shard, with permuted longest common prefixes: strings repeat where a prefix of `least`
   bytes is shared with a neighbour in the array.
4. A key with more than `MANY` different segments does not go to one shard: its strings are dealt one by one, by
   fingerprints of their own, and meet only if they are equal.

Fingerprints are 128 bits of two independent hashes (key and segment). Texts move twice, when equal ones are folded into
a table that is bucketed by digest, and never again: later steps bring small rows to that table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from stratum.llm.common import stored, table, text_of
from stratum.llm.induced import permuted_lcp, suffix_array
from stratum.session import scratch_dir

LEAST = 200
GRAM = 96
# Different segments of one key in a shard, bytes of a shard, and bytes of text looked at together.
MANY, SHARD_BYTES, BLOCK_BYTES = 4096, 1 << 20, 1 << 19
# A place in a block takes 20 bits of a word; a block with its seams must fit.
PLACE_BITS = np.uint64(20)
_EDGE = 256
_WHOLE = hashlib.sha256(b"").hexdigest()

_rng = np.random.default_rng(20_240)
_BYTE = _rng.integers(0, 1 << 64, 257, dtype=np.uint64)
_ODD = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULTIPLY = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MULTIPLY
    return h ^ (h >> np.uint64(32))


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` values in a row."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[: len(values) - span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if span < width else values


def _hashes(symbols: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all strings of `width` symbols, a multiple of 32; the second result is that of 32 symbols."""
    h, span = _BYTE[symbols], 1
    while span < 32:
        h = h[: len(h) - span] * _ODD[span] + h[span:]
        span *= 2
    n = len(symbols) - width + 1
    whole = h[:n].copy()
    for at in range(32, width, 32):
        whole = whole * _ODD[40] + h[at : at + n]
    return _mixed(whole), h


def segments(block: list[np.ndarray], least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """key, print, text (index in the block), at (first start), more (further starts) of all segments of the texts."""
    edge = np.full(least, _EDGE, np.uint16)
    symbols = np.concatenate([x for text in block for x in (edge, text)] + [edge])
    lengths = np.array([len(t) for t in block])
    begins = np.cumsum(lengths + least) - lengths
    grams, parts = _hashes(symbols, gram)
    n = len(symbols) - least + 1
    tagged = (grams >> PLACE_BITS << PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
    place = (_window_min(tagged, least - gram + 1)[:n] & np.uint64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
    outside = np.concatenate([[0], np.cumsum(symbols == _EDGE)])
    inside = outside[least:] == outside[: n]
    place[~inside] = -1
    turn = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([turn[1:], [n]]) - 1
    real = place[turn] >= 0
    first, last = turn[real], last[real]
    spot = place[first]
    length = last - first + least
    mark = _mixed((spot - first).astype(np.uint64) + (length.astype(np.uint64) << np.uint64(32)))
    for j in range((2 * least - gram) // 32 + 1):
        whole = 32 * j + 32 <= length
        mark[whole] += _mixed(parts[first[whole] + 32 * j]) * _ODD[j]
    mark += _mixed(parts[last + least - 32]) * _ODD[41]
    text = np.searchsorted(begins, first, side="right") - 1
    return grams[spot].view(np.int64), _mixed(mark).view(np.int64), text, first - begins[text], last - first


def _blocks(ids: np.ndarray, texts: list[bytes], least: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Pieces of texts gathered to blocks: the texts' ids, where in its text a piece starts, and the pieces.

    A long text is cut into pieces that overlap by `least` - 1 bytes: each string of `least` bytes is in one of them.
    """
    own: list[int] = []
    starts: list[int] = []
    pieces: list[np.ndarray] = []
    size = 0
    for i, text in zip(ids, texts):
        data = np.frombuffer(text, np.uint8)
        for at in range(0, max(1, len(data) - least + 1), BLOCK_BYTES):
            piece = data[at : at + BLOCK_BYTES + least - 1].astype(np.uint16)
            if pieces and size + len(piece) + least > BLOCK_BYTES + 3 * least:
                yield np.array(own), np.array(starts), pieces
                own, starts, pieces, size = [], [], [], 0
            own.append(i)
            starts.append(at)
            pieces.append(piece)
            size += len(piece) + least
    if pieces:
        yield np.array(own), np.array(starts), pieces


_SEGMENT = "key long, mark long, id long, at int, more smallint"


def _find(least: int, gram: int):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for own, starts, pieces in _blocks(batch["id"].to_numpy(), batch["text"].to_list(), least):
                key, mark, text, at, more = segments(pieces, least, gram)
                place = {"at": (starts[text] + at).astype(np.int32), "more": more.astype(np.int16)}
                yield _folded(pd.DataFrame({"key": key, "mark": mark, "id": own[text], **place}))

    return find


def _folded(found: pd.DataFrame) -> pd.DataFrame:
    """Equal segments of one text as one row, with the further places in `again`: a line may be repeated all through."""
    first = ~found.duplicated(["key", "mark", "id"])
    kept = found[first].copy()
    kept["again"] = None
    if not first.all():
        lists = found[~first].groupby(["key", "mark", "id"])["at"].agg(list).rename("again")
        kept = kept.drop(columns="again").merge(lists.reset_index(), on=["key", "mark", "id"], how="left")
        kept["again"] = kept["again"].astype(object).where(kept["again"].notna(), None)
    return kept


def shard_repeats(texts: list[bytes], more: np.ndarray, least: int = LEAST) -> list[np.ndarray]:
    """For segments with `more` + 1 string starts each: which of the strings also start elsewhere in the shard."""
    edge = np.array([1], np.uint16)
    strings = (np.frombuffer(t, np.uint8).astype(np.uint16) + 2 for t in texts)
    symbols = np.concatenate([*(x for s in strings for x in (s, edge)), np.zeros(1, np.uint16)])
    lengths = np.array([len(t) + 1 for t in texts])
    begins = np.cumsum(lengths) - lengths
    order = suffix_array(symbols)
    starts = np.repeat(begins - np.cumsum(more + 1) + more + 1, more + 1) + np.arange((more + 1).sum())
    shared = permuted_lcp(symbols, order, starts, least) >= least
    with_before = np.zeros(len(symbols), bool)
    with_before[starts] = shared
    # A string repeats if it shares with the one before it in the array, or the one after shares with it.
    repeats = with_before.copy()
    repeats[order[:-1][with_before[order[1:]]]] = True
    return np.split(repeats[starts], np.cumsum(more + 1)[:-1])


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last indexes of the runs of true values."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1


def _compare(least: int):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come ordered by key; a shard ends between two keys."""

        def work(rows: pd.DataFrame) -> pd.DataFrame:
            out = []
            flags = shard_repeats(rows["bytes"].to_list(), rows["more"].to_numpy().astype(np.int64), least)
            for i, at, flag in zip(rows["id"], rows["at"], flags):
                for a, b in zip(*_runs(flag)):
                    out.append((i, at + a, at + b + least))
            return pd.DataFrame(out, columns=["id", "low", "high"])

        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += int(batch["bytes"].map(len).sum())
            if size < SHARD_BYTES:
                continue
            rows = pd.concat(held, ignore_index=True)
            keys = rows["key"].to_numpy()
            fills = np.cumsum(rows["bytes"].map(len).to_numpy())
            ends = np.concatenate([np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(rows)]])
            done = 0
            for end in ends[:-1]:  # the last key may go on in the next batch
                if fills[end - 1] - (fills[done - 1] if done else 0) >= SHARD_BYTES:
                    yield work(rows.iloc[done:end])
                    done = int(end)
            held = [rows.iloc[done:]]
            size = int(fills[-1] - (fills[done - 1] if done else 0))
        if held:
            rows = pd.concat(held, ignore_index=True)
            if len(rows):
                yield work(rows)

    return compare


def _cut(least: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i, text, spots in zip(batch["id"], batch["text"], batch["spots"]):
                yield pd.DataFrame(
                    [(s["key"], i, s["at"], s["more"], text[s["at"] : s["at"] + s["more"] + least]) for s in spots],
                    columns=["key", "id", "at", "more", "bytes"],
                )

    return cut


def _strings(least: int):
    """Fingerprints of single strings, for keys with too many segments."""

    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i, text, spots in zip(batch["id"], batch["text"], batch["spots"]):
                out = []
                for s in spots:
                    for at in range(s["at"], s["at"] + s["more"] + 1):
                        digest = hashlib.blake2b(text[at : at + least], digest_size=16).digest()
                        out.append((digest, i, at))
                yield pd.DataFrame(out, columns=["digest", "id", "at"])

    return strings


def _removed(text: bytes, spans: list) -> tuple[int, int, str]:
    """Bytes removed, spans removed, and the digest of what stays."""
    order = sorted((s["low"], s["high"]) for s in spans)
    kept = hashlib.sha256()
    gone = runs = upto = 0
    started = None
    for low, high in order:
        if started is None or low > upto:
            if started is not None:
                gone, runs = gone + upto - started, runs + 1
                kept.update(text[upto:low])
            else:
                kept.update(text[:low])
            started, upto = low, high
        else:
            upto = max(upto, high)
    if started is not None:
        gone, runs = gone + upto - started, runs + 1
    kept.update(text[upto:])
    return gone, runs, kept.hexdigest()


def _apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = [(d, *_removed(text, spans)) for d, text, spans in zip(batch["digest"], batch["text"], batch["spans"])]
        yield pd.DataFrame(out, columns=["digest", "n_removed", "n_spans", "kept_sha256"])


def _texts(spark: SparkSession, docs: DataFrame, least: int) -> DataFrame:
    """digest, text, copies of the distinct texts of `least` bytes or more, in a table bucketed by digest."""
    home = scratch_dir(spark, "suffix-texts")
    name = "stratum_" + home.rsplit("stratum-", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = text_of()
    distinct = (
        docs.select(F.sha2(text.cast("binary"), 256).alias("digest"), text.cast("binary").alias("text"))
        .filter(F.octet_length("text") >= least)
        .groupBy("digest")
        .agg(F.any_value("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    )
    distinct.write.bucketBy(buckets, "digest").option("compression", "zstd").option("path", home).saveAsTable(name)
    return spark.table(name)


def repeated_passages(docs: DataFrame, least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of `docs` (doc_id, text).

    Texts are bytes of UTF-8; a null text is empty. Removed are all bytes that a string of `least` bytes covers which
    also starts anywhere else in the table, the same text included; strings never reach into another text, and are judged
    on the input. A text shorter than `least` loses nothing. Repeated rows are texts of their own, so both are removed;
    a null doc_id stays null. Other columns are not looked at. `gram` is a multiple of 32 below `least`.
    """
    spark = docs.sparkSession
    text = text_of()
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.octet_length(text).cast("long").alias("n_bytes"),
            F.sha2(text.cast("binary"), 256).alias("digest"),
        ),
        "suffix-rows",
    )
    texts = _texts(spark, docs, least)
    ids = stored(texts.select("digest", F.monotonically_increasing_id().alias("id")), "suffix-ids")
    numbered = texts.join(ids.hint("shuffle_hash"), "digest")
    found = numbered.select("id", "text").mapInPandas(_find(least, gram), f"{_SEGMENT}, again array<int>")

    by_key, by_both = W.partitionBy("key"), W.partitionBy("key", "mark")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = (
        found.repartition(partitions, "key")
        .withColumn("times", F.lit(1) + F.coalesce(F.array_size("again"), F.lit(0)))
        .withColumn("equal", F.sum("times").over(by_both))
        .withColumn("nth", F.row_number().over(by_both.orderBy("id", "at")))
        .withColumn("all", F.sum("times").over(by_key))
        .filter(F.col("all") > 1)
        .withColumn("kinds", F.sum((F.col("nth") == 1).cast("long")).over(by_key))
        .withColumn("open", F.max(F.col("equal") == 1).over(by_key))
    )
    met = stored(met.select("key", "id", "at", "again", "more", "equal", "nth", "kinds", "open"), "suffix-met")
    every = F.explode(F.concat(F.array("at"), F.coalesce("again", F.array().cast("array<int>"))))
    alike = met.filter("equal > 1").select("id", "more", every.alias("low"))
    alike = alike.select("id", "low", (F.col("low") + F.col("more") + least).alias("high"))

    def spots(which: DataFrame) -> DataFrame:
        """digest, id and text of the texts that have the segments, with the segments."""
        lists = which.groupBy("id").agg(F.collect_list(F.struct("key", "at", "more")).alias("spots"))
        return texts.select("digest", "text").join(lists.join(ids, "id").hint("shuffle_hash"), "digest").select("id", "text", "spots")

    differ = met.filter("open and nth = 1 and kinds > 1")
    cut = spots(differ.filter(F.col("kinds") <= MANY)).mapInPandas(_cut(least), "key long, id long, at int, more smallint, bytes binary")
    compared = (
        cut.repartition(partitions, "key")
        .sortWithinPartitions("key")
        .mapInPandas(_compare(least), "id long, low int, high int")
    )
    spans = alike.unionByName(compared)
    hot = differ.filter(F.col("kinds") > MANY)
    if not hot.isEmpty():
        single = spots(hot).mapInPandas(_strings(least), "digest binary, id long, at int")
        again = single.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("digest").alias("_digest"))
        repeated = single.join(again, F.col("digest") == F.col("_digest"), "left_semi")
        spans = spans.unionByName(repeated.select("id", F.col("at").alias("low"), (F.col("at") + least).alias("high")))
    spans = stored(spans, "suffix-spans")
    lists = spans.groupBy("id").agg(F.collect_set(F.struct("low", "high")).alias("spans")).join(ids, "id")
    touched = (
        texts.filter("copies = 1")
        .join(lists.hint("shuffle_hash"), "digest")
        .select("digest", "text", "spans")
        .mapInPandas(_apply, "digest string, n_removed long, n_spans long, kept_sha256 string")
    )
    gone = texts.filter("copies > 1").select(
        "digest",
        F.lit(None).cast("long").alias("n_removed"),
        F.lit(1).cast("long").alias("n_spans"),
        F.lit(_WHOLE).alias("kept_sha256"),
    )
    result = stored(touched.unionByName(gone), "suffix-result").withColumnRenamed("digest", "_digest")
    nothing = F.lit(0).cast("long")
    hit = F.col("_digest").isNotNull()
    return rows.join(result, F.col("digest") == F.col("_digest"), "left").select(
        "doc_id",
        "n_bytes",
        F.when(hit, F.coalesce("n_removed", "n_bytes")).otherwise(nothing).alias("n_removed"),
        F.when(hit, F.col("n_spans")).otherwise(nothing).alias("n_spans"),
        F.when(hit, F.col("kept_sha256")).otherwise(F.col("digest")).alias("kept_sha256"),
    )


def op5_repeated_passages(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
