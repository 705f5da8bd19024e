"""Mixing sources to target weights by a low-discrepancy schedule.

Every source is a stream of words: its documents in shuffled order, repeated for as many epochs as its target asks for,
cut into blocks of equally many words. Slots of the mix are dealt to sources by golden-ratio points: the fractional
parts of n times the golden ratio fall evenly into the cumulative weights of the sources, so that every stretch of the
mix has nearly the target proportions. The r-th slot of a source carries the r-th block of its stream; blocks for which
the points are too few, a few of a small source, have slots of their own at the end.

Only DataFrame functions are used. No step holds a whole source in one task: positions in a stream and ranks of slots
are sums over small parts plus a running sum over the parts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from stratum.llm.common import WORD, chosen_rows, row_key, stored, table, text_key

# The fraction of the golden ratio in 40 bits, odd, so that 2**40 slots get different points.
GOLDEN = 679535556991
POINT_BITS = 40
# Rows of one part of a stream, and slots of one part of the schedule.
PART_ROWS = 1 << 15
PART_SLOTS = 1 << 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[int] = (5, 2, 1), epochs: int = 3) -> DataFrame:
    """source, place (order by code point, null last), source_size, target, quota (target in whole words).

    The targets share the sum of all sizes by weight. One that exceeds `epochs` times the size of its source stops
    there, and the rest is shared again by weight, until none exceeds it. In the order of that limit per weight this is
    one pass: a source is full if its limit is within what all from there on would get.
    The frame has a row per source, and only such frames are sorted in one task.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    shares = F.array(*[F.lit(float(w)) for w in weights])
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("place", F.row_number().over(order) - 1).select(
        "*",
        F.element_at(shares, (F.col("place") % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * epochs).cast("double").alias("most"),
    )
    by_limit = W.orderBy(F.col("most") / F.col("weight"), "place")
    everything = W.partitionBy()
    level = (
        ranked.withColumn("_all", F.sum("source_size").over(everything).cast("double"))
        .withColumn("_given", F.sum("most").over(by_limit) - F.col("most"))
        .withColumn("_weights", F.sum("weight").over(by_limit) - F.col("weight"))
        .withColumn("_level", (F.col("_all") - F.col("_given")) / (F.sum("weight").over(everything) - F.col("_weights")))
        .withColumn("_full", F.col("most") <= F.col("_level") * F.col("weight"))
        .withColumn("_limit", F.when(~F.col("_full"), F.col("most") / F.col("weight")))
        .withColumn("_open", F.min_by(F.when(~F.col("_full"), F.col("_level")), F.col("_limit")).over(everything))
    )
    target = F.when(F.col("_full"), F.col("most")).otherwise(F.col("_open") * F.col("weight"))
    return level.select("source", "place", "source_size", target.alias("target")).withColumn(
        "quota", F.least(F.round("target").cast("long"), F.col("source_size") * epochs)
    )


def _running(frame: DataFrame, key: str, part: str, order: Sequence[Column], value: Column, name: str) -> DataFrame:
    """The sum of `value` over the rows of the same key before this one: within the part, plus all earlier parts."""
    inside = W.partitionBy(key, part).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = W.partitionBy(key).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    sums = frame.groupBy(key, part).agg(F.sum(value).alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(earlier), F.lit(0))
    base = sums.select(F.col(key).alias("_key"), F.col(part).alias("_part"), before.alias("_base"))
    return (
        frame.withColumn("_in", F.sum(value).over(inside) - value)
        .join(base, F.col(key).eqNullSafe(F.col("_key")) & (F.col(part) == F.col("_part")))
        .withColumn(name, F.col("_base") + F.col("_in"))
        .drop("_in", "_key", "_part", "_base")
    )


def point(slot: Column) -> Column:
    """The slot's golden-ratio point as a whole number below 2**40, without leaving 64 bits."""
    half = 1 << (POINT_BITS // 2)
    low = (slot % half) * GOLDEN
    high = (F.floor(slot / half) * GOLDEN) % half
    return (low + high * half) % (1 << POINT_BITS)


def schedule(targets: DataFrame, words: int, sources: int, block_words: int) -> DataFrame:
    """slot, place, rank: the slots of the mix, for each the source it is dealt to and its rank there.

    The points run on for a quarter more slots than the mix needs, since a source can be late by a few of them; ranks
    beyond a source's quota are left out, so a slot number may be missing towards the end. Ranks that a source lacks
    even so are appended as further slots.
    """
    spark = targets.sparkSession
    scale = 1 << POINT_BITS
    slots = math.ceil(words / block_words * 1.25) + 64 if words else 0
    bits = max(12, math.ceil(math.log2(4 * sources + 1)))
    cell = scale >> bits
    whole = F.sum("quota").over(W.partitionBy()).cast("double")
    upto = F.sum("quota").over(W.orderBy("place")).cast("double")
    spans = (
        targets.withColumn("_to", F.floor(upto / whole * scale).cast("long"))
        .withColumn("_from", F.lag("_to", 1, 0).over(W.orderBy("place")))
        .filter("_from < _to")
        .withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_from") / cell), F.floor((F.col("_to") - 1) / cell))))
        .select("place", "_from", "_to", "_cell", F.ceil(F.col("quota") / block_words).alias("_blocks"))
    )
    dealt = (
        spark.range(slots)
        .select(F.col("id").alias("slot"), point(F.col("id")).alias("_point"))
        .withColumn("_cell", F.floor(F.col("_point") / cell))
        .join(spans, "_cell")
        .filter("_from <= _point and _point < _to")
        .select("slot", "place", "_blocks", F.floor(F.col("slot") / PART_SLOTS).alias("_at"))
    )
    ranked = _running(dealt, "place", "_at", [F.col("slot")], F.lit(1).cast("long"), "rank")
    ranked = stored(ranked.filter("rank < _blocks").select("slot", "place", "rank"), "mix-slots")
    counts = ranked.groupBy(F.col("place").alias("_place")).agg(F.count(F.lit(1)).alias("_dealt"))
    lacking = (
        targets.select("place", F.ceil(F.col("quota") / block_words).alias("_blocks"))
        .join(counts, F.col("place") == F.col("_place"), "left")
        .withColumn("_dealt", F.coalesce("_dealt", F.lit(0).cast("long")))
        .filter("_dealt < _blocks")
        .withColumn("_from", slots + F.sum(F.col("_blocks") - F.col("_dealt")).over(W.orderBy("place")) - F.col("_blocks"))
        .withColumn("rank", F.explode(F.sequence("_dealt", F.col("_blocks") - 1)))
    )
    return ranked.unionByName(lacking.select((F.col("_from") + F.col("rank")).alias("slot"), "place", "rank"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), epochs: int = 3, block_words: int = 64) -> DataFrame:
    """One row per row of `docs` (doc_id, text, source): doc_id, source, size, source_size, target, taken.

    taken: how many of its words the mix takes, repetitions counted. Sources without words have target 0; documents
    without words have taken 0; a null source is a source of its own; rows that repeat a document each take part.
    Other columns of `docs` are not looked at. An empty table gives an empty result. The order within a source is that
    of md5(doc_id), so reruns agree.
    """
    return _taken(docs, weights, epochs, block_words).drop("text_key")


def mixed_rows(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), epochs: int = 3, block_words: int = 64) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, with all their columns; a part of a document counts as whole.

    Rows are told apart by all their columns: those of one document in two sources are taken as often as each source says.
    """
    taken = _taken(docs, weights, epochs, block_words, row_key(docs)).filter("taken > 0")
    times = F.sum(F.ceil(F.col("taken") / F.col("size"))).cast("int")
    chosen = taken.groupBy("doc_id", F.col("text_key").alias("key")).agg(times.alias("times"))
    return chosen_rows(docs, chosen, row_key(docs), "times")


def _taken(docs: DataFrame, weights: Sequence[int], epochs: int, block_words: int, key: Column | None = None) -> DataFrame:
    placed, slots = _placed(docs, weights, epochs, block_words, key)
    pieces = _pieces(placed.filter("size > 0"), block_words)
    row = ["doc_id", "text_key", "source", "size", "source_size", "target", "place", "start"]
    taken = (
        pieces.join(slots, (pieces["place"] == slots["_place"]) & (pieces["block"] == slots["rank"]), "left")
        .groupBy(*row)
        .agg(F.sum(F.when(F.col("slot").isNotNull(), F.col("words")).otherwise(0)).alias("taken"))
    )
    out = ["doc_id", "text_key", "source", "size", "source_size", "target"]
    nothing = placed.filter("size = 0").select(*out, F.lit(0).cast("long").alias("taken"))
    return taken.select(*out, "taken").unionByName(nothing)


def mixed_blocks(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), epochs: int = 3, block_words: int = 64) -> DataFrame:
    """The mix itself: slot, source, block, doc_id, epoch, from_word, words; a row per document part in a slot."""
    placed, slots = _placed(docs, weights, epochs, block_words)
    pieces = _pieces(placed.filter("size > 0"), block_words)
    return pieces.join(slots, (pieces["place"] == slots["_place"]) & (pieces["block"] == slots["rank"])).select(
        "slot", "source", "block", "doc_id", "epoch", "from_word", "words"
    )


def _placed(
    docs: DataFrame, weights: Sequence[int], epochs: int, block_words: int, key: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Documents with their place in the stream of their source, and the slots of the mix. `key` tells rows of a doc_id
    apart, as `text_key` does."""
    sized = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"),
            (text_key() if key is None else key).alias("text_key"),
        ).withColumn("key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))),
        "mix-sizes",
    )
    rows, words, sources = sized.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0)), F.approx_count_distinct(F.coalesce("source", F.lit("")))
    ).first()
    digits = max(1, math.ceil(math.log(max(1, rows / PART_ROWS), 16)))
    targets = stored(source_targets(sized, weights, epochs), "mix-targets")
    parted = sized.withColumn("_at", F.substring("key", 1, digits))
    streams = _running(parted, "source", "_at", [F.col("key"), F.col("doc_id"), F.col("size"), F.col("text_key")], F.col("size"), "start")
    goal = targets.withColumnRenamed("source", "_source")
    placed = streams.join(goal, streams["source"].eqNullSafe(goal["_source"])).drop("_source", "_at", "key")
    slots = schedule(targets, words, sources, block_words).withColumnRenamed("place", "_place")
    return placed, slots


def _pieces(placed: DataFrame, block_words: int) -> DataFrame:
    """A row per epoch and block that a document has words in, within the quota; one without if there are none."""
    last = F.ceil(F.col("quota") / F.col("source_size")).cast("long") - 1
    epoch = F.when(last >= 0, F.sequence(F.lit(0).cast("long"), last))
    first = F.col("epoch") * F.col("source_size") + F.col("start")
    end = F.least(first + F.col("size"), F.col("quota"))
    return (
        placed.withColumn("epoch", F.explode_outer(epoch))
        .withColumn("_first", first)
        .withColumn("_end", end)
        .withColumn(
            "block",
            F.explode_outer(
                F.when(
                    F.col("_first") < F.col("_end"),
                    F.sequence(F.floor(F.col("_first") / block_words), F.floor((F.col("_end") - 1) / block_words)),
                )
            ),
        )
        .withColumn("_low", F.greatest(F.col("_first"), F.col("block") * block_words))
        .withColumn("words", F.least(F.col("_end"), (F.col("block") + 1) * block_words) - F.col("_low"))
        .withColumn("from_word", F.col("_low") - F.col("_first"))
    )


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken for all documents."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = f"""
with sized as (
  select doc_id, source, length(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size from documents
), totals as (
  select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source asc nulls last) - 1 as place
  from sized group by source
), ranked as (
  select *, case place % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as weight,
    (source_size * 3)::double as most from totals
), level as (
  select *, (sum(source_size) over ())::double as whole,
    coalesce(sum(most) over (order by most / weight, place rows between unbounded preceding and 1 preceding), 0) as given,
    coalesce(sum(weight) over (order by most / weight, place rows between unbounded preceding and 1 preceding), 0) as used,
    sum(weight) over () as weights from ranked
), filled as (
  select *, (whole - given) / (weights - used) as height, most <= (whole - given) / (weights - used) * weight as is_full from level
), open as (
  select height from filled where not is_full order by most / weight, place limit 1
), targets as (
  select source, place, source_size,
    case when is_full then most else (select height from open) * weight end as target,
    least(cast(round(case when is_full then most else (select height from open) * weight end) as bigint), source_size * 3) as quota
  from filled
), spans as (
  select place, quota, source_size,
    cast(floor(sum(quota) over (order by place) / (sum(quota) over ())::double * {1 << POINT_BITS}) as bigint) as upto from targets
), bounds as (
  select *, lag(upto, 1, 0) over (order by place) as since from spans
), points as (
  select n, cast((n::hugeint * {GOLDEN}) % {1 << POINT_BITS} as bigint) as point
  from (select unnest(range((select cast(ceil(sum(size) / 64.0 * 1.25) as bigint) + 64 from sized))) as n)
), slots as (
  select * from (
    select p.n, b.place, b.quota, row_number() over (partition by b.place order by p.n) - 1 as rank
    from points p join bounds b on b.since <= p.point and p.point < b.upto)
  where rank * 64 < quota
), streams as (
  select s.doc_id, s.size, t.place, t.source_size, t.target, t.quota,
    cast(sum(s.size) over (partition by t.place order by md5(coalesce(s.doc_id::varchar, '')), s.doc_id, s.size
                           rows unbounded preceding) as bigint) - s.size as start
  from sized s join targets t on s.source is not distinct from t.source
), pieces as (
  select doc_id, size, place, start, source_size, target, e * source_size + start as first,
    least(e * source_size + start + size, quota) as upto
  from streams cross join (values (0), (1), (2)) epochs(e) where size > 0
), parts as (
  select *, unnest(range(first // 64, (upto - 1) // 64 + 1)) as block from pieces where first < upto
), used as (
  select p.place, p.start, p.doc_id,
    cast(sum(least(p.upto, (p.block + 1) * 64) - greatest(p.first, p.block * 64)) as bigint) as taken
  from parts p join slots s on s.place = p.place and s.rank = p.block group by all
)
select d.doc_id, cast(d.size as bigint) as size, d.source_size, d.target, coalesce(u.taken, 0) as taken
from streams d left join used u on d.place = u.place and d.start = u.start and d.doc_id is not distinct from u.doc_id and d.size > 0
"""
