"""How far the sources of a language differ in their words: pairs of sources, and the terms that mark a source.

Counts decide everything here, and few counts are shared by many terms. So terms are grouped into cells: by their counts
in two sources for a pair, by their counts in a source and in the whole language for the marking terms. A value is
evaluated once a cell and weighed by how many terms the cell has. The cells of a source are ranked by the terms before
them, cells of equal value are merged, and only those that reach the wanted ranks are expanded into terms again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stratum.llm.common import stored, table, text_of

# What is added to every count, and the unit of the shares.
SMOOTHING, UNIT = 5, 1_000_000_000
# So many different terms are held by a task before they are handed to Spark, and so many bytes are split at once.
HELD_TERMS, SLICE = 200_000, 1 << 20

# A term is a run of letters A-Z, lower-cased, and of characters beyond ASCII, whose UTF-8 bytes are all above 127.
_TERM_BYTES = bytes(b if b > 127 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms_of(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, a slice at a time."""
    clean = data.translate(_TERM_BYTES)
    start = 0
    while start < len(clean):
        end = clean.find(b" ", start + SLICE)
        end = len(clean) if end < 0 else end
        yield clean[start:end].split()
        start = end


_COUNTS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())]
)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            names = [pa.repeat(pa.scalar(name, pa.string()), len(n)) for name in (lang, source)]
            terms, counts = pa.array(n.keys(), pa.binary()), pa.array(n.values(), pa.int64())
            yield pa.RecordBatch.from_arrays([*names, terms, counts, pa.array(map(docs.__getitem__, n), pa.int64())], schema=_COUNTS)

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, batch.column("data")):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(n), set()
            for some in terms_of(text.as_py()):
                n.update(some)
                seen.update(some)
            docs.update(seen)
            size += len(n) - before
            if size >= HELD_TERMS:
                yield from out()
                held, size = {}, 0
    yield from out()


def kept_counts(docs: DataFrame, least_docs: int) -> DataFrame:
    """lang, source, term, n, lang_n: the occurrences of each kept term in a source that has it, and in its language.

    Tasks hand over counts, not occurrences, so a term costs a row a source and task however common it is. One exchange
    by language and term serves the sums by source and those of the language.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    read = docs.select(name("lang"), name("source"), text_of().cast("binary").alias("data"))
    counted = read.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long")
    sums = counted.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    both = sums.withColumns({"lang_n": F.sum("n").over(whole), "lang_docs": F.sum("docs").over(whole)})
    kept = both.filter(F.col("lang_docs") >= least_docs)
    return kept.select("lang", "source", F.col("term").cast("string").alias("term"), "n", "lang_n")


def _share(count: str, total: str) -> str:
    """SQL for 1 + floor(UNIT * (count + SMOOTHING) / (total + SMOOTHING * terms)), exact beyond 64 bits in between."""
    above = f"cast({UNIT} as decimal(10, 0)) * cast({count} + {SMOOTHING} as decimal(20, 0))"
    return f"(1 + ({above}) div cast({total} + {SMOOTHING} * terms as decimal(20, 0)))"


def _gap(one: str, other: str) -> str:
    """SQL for the difference of the shares that counts give in the two sources of a pair."""
    return f"abs({_share(one, 'one_total')} - {_share(other, 'other_total')})"


def _pair_values(kept: DataFrame, cells: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, one, other, value for every two sources of a language, one < other.

    Terms that both have are counted by cells of two counts, those that one has by cells of its count; with the rest,
    which neither has, the sum is whole without a row per absent term.
    """
    left = groups.select("lang", F.col("source").alias("one"), F.col("total").alias("one_total"), "terms")
    right = groups.select("lang", F.col("source").alias("other"), F.col("total").alias("other_total"))
    pairs = left.join(right, "lang").filter("one < other")
    a = kept.select("lang", "term", F.col("source").alias("one"), F.col("n").alias("a"))
    b = kept.select("lang", "term", F.col("source").alias("other"), F.col("n").alias("b"))
    shared = a.join(b, ["lang", "term"]).filter("one < other").groupBy("lang", "one", "other", "a", "b").agg(F.count(F.lit(1)).alias("m"))
    single = cells.groupBy("lang", "source", "n").agg(F.sum("m").alias("m"))
    none = _gap("0", "0")
    own = ["lang", "one", "other"]

    def part(frame: DataFrame, value: str) -> DataFrame:
        return frame.select(*own, F.expr(value).alias("value")).groupBy(*own).agg(F.sum("value").alias("value"))

    parts = [
        # Without terms there is no share either.
        pairs.select(*own, F.expr(f"if(terms = 0, 0, terms * {none})").alias("value")),
        part(pairs.join(single.withColumnRenamed("source", "one"), ["lang", "one"]), f"m * ({_gap('n', '0')} - {none})"),
        part(pairs.join(single.withColumnRenamed("source", "other"), ["lang", "other"]), f"m * ({_gap('0', 'n')} - {none})"),
        part(pairs.join(shared, own), f"m * ({_gap('a', 'b')} - {_gap('a', '0')} - {_gap('0', 'b')} + {none})"),
    ]
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy(*own).agg(F.sum("value").alias("value"))


def _pairs(kept: DataFrame, cells: DataFrame, groups: DataFrame) -> DataFrame:
    values = stored(_pair_values(kept, cells, groups), "divergence-pairs")
    both = values.select("lang", F.col("one").alias("source"), F.col("other").alias("item"), "value").unionByName(
        values.select("lang", F.col("other").alias("source"), F.col("one").alias("item"), "value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _marking_terms(kept: DataFrame, cells: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    group = ["lang", "source"]
    over = F.expr(f"{_share('n', 'total')} - {_share('lang_n', 'lang_total')}")
    valued = cells.join(groups, group).withColumn("value", over).filter("value > 0")
    merged = valued.groupBy(*group, "value").agg(F.sum("m").alias("m"))
    downward = Window.partitionBy(*group).orderBy(F.desc("value"))
    # A value has a term at least, so the first `top` values are enough to reach that rank.
    first = merged.withColumn("place", F.row_number().over(downward)).filter(F.col("place") <= top)
    before = F.sum("m").over(downward.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("m")
    reached = first.withColumn("before", before).filter(F.col("before") < top).select(*group, "value", "before")
    chosen = valued.join(reached, [*group, "value"]).select(*group, "n", "lang_n", "value", "before")
    expanded = kept.join(chosen, [*group, "n", "lang_n"])
    equal = Window.partitionBy(*group, "value").orderBy("term")
    placed = expanded.withColumn("place", F.row_number().over(equal)).filter(F.col("place") <= top)
    rank: Column = (F.col("before") + F.col("place")).cast("int")
    return placed.select(*group, F.lit("term").alias("part"), F.col("term").alias("item"), "value", rank.alias("rank")).filter(
        F.col("rank") <= top
    )


def source_divergence(docs: DataFrame, least_docs: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank for `docs` (text, lang, source); nulls count as ''.

    A language keeps the terms that `least_docs` of its rows have. A share is 1 + floor(10^9 (count + 5) / (N + 5 V)).
    Part `pair`: for each source every other one of its language, with the sum of the differences of their shares over
    the V kept terms; without kept terms it is 0. Part `term`: the terms of a source with a larger share there than in
    the language, by that difference, up to rank `top`. Ranks go from 1, values downward, ties by the item's UTF-8.
    Repeated rows count each; ids and other columns are not looked at; no documents give no rows.
    """
    kept = stored(kept_counts(docs, least_docs), "divergence-kept")
    cells = stored(kept.groupBy("lang", "source", "n", "lang_n").agg(F.count(F.lit(1)).alias("m")), "divergence-cells")
    # The language's count of a term is that of its sources, so the language's sizes follow from theirs and the terms.
    sizes = cells.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("m")).alias("total"))
    terms = kept.groupBy("lang").agg(F.count_distinct("term").alias("terms"), F.sum("n").alias("lang_total"))
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    groups = docs.select(name("lang"), name("source")).distinct().join(sizes, ["lang", "source"], "left").join(terms, "lang", "left")
    groups = stored(groups.fillna(0, ["total", "terms", "lang_total"]), "divergence-groups")
    return _pairs(kept, cells, groups).unionByName(_marking_terms(kept, cells, groups, top))


def op12_source_divergence(spark, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
    FROM documents
), words AS (
    SELECT id, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs
), kept AS (
    SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 30
), grouped AS (
    SELECT DISTINCT lang, source FROM docs
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM words GROUP BY lang, source, term
), dense AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.lang_n,
           sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total,
           sum(k.lang_n) OVER (PARTITION BY g.lang, g.source) AS lang_total,
           count(*) OVER (PARTITION BY g.lang, g.source) AS v
    FROM grouped g JOIN kept k ON g.lang = k.lang
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
    SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v) AS p,
           1 + (1000000000::HUGEINT * (lang_n + 5)) // (lang_total + 5 * v) AS q
    FROM dense
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
    FROM grouped a JOIN grouped b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY a.lang, a.source, b.source
), ranked AS (
    SELECT lang, source, 'pair' AS part, item, value,
           row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank
    FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, p - q, row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term)
    FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
