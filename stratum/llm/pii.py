"""Personal data: fixed kinds by their form, and unseen identifiers by bootstrapped contextual extraction.

What the forms find are the seeds. Every token that looks like an identifier is an instance, and so is every run of
numbers as phones and cards are written; the two words before it are its pattern, marks at the start of a text included. Patterns and instances make a graph, which Spark scores in rounds: a pattern is as sure of a kind as
the share of the different instances and ordinary words that follow it that is of this kind; an instance that is no seed is of a kind by
the patterns it follows. Patterns that enough different instances support and that are nearly always right discover the
other instances behind them, in all documents.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from stratum.llm.common import stored, table, text_of
from stratum.session import small_batches

# The kinds in their order, and the forms.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_HINT = re.compile(r"[0-9@]")

# An instance: a run of tokens of digits, brackets, dots, dashes and plus signs with single spaces between them, or
# another token with a digit or an at sign; of this many characters at least without the punctuation around it.
SHORTEST = 5
# Longer instances and words are told apart by digests.
LONGEST = 64
_TOKEN = re.compile(r"\S*[0-9@]\S*")
_RUN = re.compile(r"(?<!\S)[\"'<{]*+([0-9()\[\].+-]++(?:\x20[0-9()\[\].+-]++)*+)([^\s]*)")
_CLOSING = {"(": ")", "[": "]"}
# Stands for what the forms have found; no text holds it. What stands before the first word; no word is like it.
_GONE, _START = "\udc00", "\n"
# A word that may be the first of a pattern, before one that may be the second.
_BOTH = re.compile(rb"[\x01\x03](?=[\x02\x03])")
_SPACED = re.compile(r"\S+")
_TRIM = ".,;:!?()[]{}<>\"'"
# A pattern discovers if so many different instances of its kind support it and this share of what follows it is right.
SUPPORT, CONFIDENCE, ROUNDS = 3, 0.8, 3
# Bits a pattern in the filters that travel to the tasks, and the least and the most that a filter has.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 24
# What Spark's bitmaps hold each.
PART_BITS = 1 << 15
# The first look at what follows patterns takes one text in so many, by a hash of the text.
FIRST_LOOK = 16
# A task remembers so many texts, to pass over their copies.
REMEMBERED = 500_000
# So many different followers are kept before they are handed to Spark.
FOLLOWERS = 50_000
# A task writes so many instances, on average and at least, of what is stored of the graph: else each of its frames
# becomes a file for every shuffle partition, however few rows it has.
EACH_TASK = 100_000


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches; a match is found from its at sign, since the local part holds none."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers at a time of every chain of numbers; a chain always starts where a match must."""
    for chain in _CHAIN.finditer(text):
        if chain.end() - chain.start() < 7:
            continue
        at = chain.start()
        parts = chain.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            yield m.start(), m.end()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.findall(m.group())) <= 15:
            yield m.start(), m.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the forms find."""
    if not _HINT.search(text):
        return []
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    found += [(a, 1, b) for a, b in addresses(text)]
    found += [(a, 2, b) for a, b in cards(text)]
    found += [(a, 3, b) for a, b in phones(text)] if "+" in text else []
    return sorted(found)


def _name(text: str) -> str:
    return text if len(text) <= LONGEST else hashlib.sha256(text.encode()).hexdigest() + "\n"


def _word(token: str) -> str:
    return _name(token.strip(_TRIM).lower())


def _patterns(text: str, places: list[int]) -> list[str]:
    """For each place the two whole words before the one it is in, or marks where a text begins."""
    starts = [m.start() for m in _SPACED.finditer(text)] if places else []
    known: dict[int, str] = {}
    out = []
    for place in places:
        i = bisect_right(starts, place) - 1
        if i not in known:
            before = [_word(text[starts[j] : starts[j + 1]].rstrip()) if j >= 0 else _START for j in (i - 2, i - 1)]
            known[i] = " ".join(before)
        out.append(known[i])
    return out


def _without(text: str, base: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for start, _, end in base:
        if end > at:
            out += [text[at : max(at, start)], _GONE * (end - max(at, start))]
            at = end
    return "".join([*out, text[at:]])


def _runs(text: str) -> Iterator[tuple[int, int]]:
    """Runs of numbers from their first digit to their last, with a bracket whose other side is between, and a plus."""
    for m in _RUN.finditer(text):
        start, end = m.span(1)
        if m.group(2).strip(_TRIM):  # the last token goes on otherwise
            end = text.rfind(" ", start, end)
        first = _DIGITS.search(text, start, max(start, end))
        if not first:
            continue
        last = end - 1
        while not "0" <= text[last] <= "9":
            last -= 1
        a, b = first.start(), last + 1
        if b < end and text[b] in ")]" and text.rfind("(" if text[b] == ")" else "[", a, b) >= 0:
            b += 1
        if a > start and text[a - 1] in _CLOSING and text.find(_CLOSING[text[a - 1]], a, b) >= 0:
            a -= 1
        if a > start and text[a - 1] == "+":
            a -= 1
        if b - a >= SHORTEST:
            yield a, b


def found_instances(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, kind) of all instances; kind is -1 for those that are no seeds, which overlap no others."""
    out = [(a, b, k) for a, k, b in base]
    if not _HINT.search(text):
        return out
    rest = _without(text, base)
    runs = list(_runs(rest))
    out += [(a, b, -1) for a, b in runs]
    i = 0
    for token in _TOKEN.finditer(rest):
        if _GONE in token.group():
            continue
        word = token.group().rstrip(_TRIM)
        start = token.start() + len(word) - len(word.lstrip(_TRIM))
        end = token.start() + len(word)
        while i < len(runs) and runs[i][1] <= start:
            i += 1
        if end - start >= SHORTEST and not (i < len(runs) and runs[i][0] < end):
            out.append((start, end, -1))
    return out


def instances(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, str, str, int]]:
    """(start, end, pattern, instance, kind) of all instances."""
    found = found_instances(text, base)
    patterns = _patterns(text, [a for a, _, _ in found])
    return [(a, b, p, _name(text[a:b].lower()), k) for (a, b, k), p in zip(found, patterns)]


SPAN = "array<struct<start:int,kind:int,end:int>>"
_FOUND = f"doc_id long, digest string, base {SPAN}, seen array<struct<start:int,end:int,pattern:string,instance:string,kind:int>>"


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        base = [base_spans(t) for t in batch["text"]]
        seen = [instances(t, b) for t, b in zip(batch["text"], base)]
        yield pd.DataFrame(
            {
                "doc_id": batch["doc_id"].astype("Int64"),
                "digest": batch["digest"],
                "base": [[dict(zip(("start", "kind", "end"), s)) for s in b] for b in base],
                "seen": [[dict(zip(("start", "end", "pattern", "instance", "kind"), s)) for s in x] for x in seen],
            }
        )


def _covered(text: str) -> set[int]:
    """The numbers of the words that what the forms find or an instance overlaps."""
    spans = {(a, b) for a, b, _ in found_instances(text, base_spans(text))}
    starts = [m.start() for m in _SPACED.finditer(text)] if spans else []
    return {i for a, b in spans for i in range(bisect_right(starts, a) - 1, bisect_left(starts, b))}


def _at(text: str, bits: int) -> int:
    return zlib.crc32(text.encode()) % bits


def _filter(patterns: DataFrame, column: Column, bits: int) -> bytes:
    """The hashes of a column as bits, put together in Spark: 4 kB reach the driver for every PART_BITS of them."""
    at = F.crc32(column.cast("binary")) % bits
    part = F.floor(at / PART_BITS).cast("int").alias("part")
    made = patterns.groupBy(part).agg(F.bitmap_construct_agg(at % PART_BITS).alias("bits"))
    whole = np.zeros((bits // PART_BITS, PART_BITS // 8), np.uint8)
    for row in made.toLocalIterator():
        whole[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return whole.tobytes()


def followed(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """pattern, n: how many different ordinary words follow each of `patterns` (pattern) in `texts` (text); none if no word does.

    Copies of a text add nothing. The patterns and their words go to the tasks as filters, sized by how many there are;
    what these let pass by mistake the join drops.
    """
    words_of = F.split("pattern", " ")
    wanted = BITS_EACH * max(1, patterns.count())
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (wanted - 1).bit_length()))
    packed = [_filter(patterns, column, bits) for column in (F.col("pattern"), words_of[0], words_of[1])]

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both, first, second = (np.unpackbits(np.frombuffer(x, np.uint8), bitorder="little").tobytes() for x in packed)
        known: dict[str, int] = {}  # by token: 1 if its word may be the first of a pattern, plus 2 if the second
        mark = lambda word: first[_at(word, bits)] + 2 * second[_at(word, bits)]
        frame = lambda pairs: pd.DataFrame(list(pairs), columns=["pattern", "word"])
        seen: set[tuple[str, str]] = set()
        read: set[str] = set()
        for batch in batches:
            for text, digest in zip(batch["text"], batch["digest"]):
                if digest in read:
                    continue
                read.add(digest)
                tokens = text.split()
                for token in set(tokens).difference(known):
                    known[token] = mark(_word(token))
                marks = bytes([mark(_START)] * 2) + bytes(map(known.__getitem__, tokens))
                hits = []
                for m in _BOTH.finditer(marks, 0, max(0, len(marks) - 1)):
                    i = m.start()  # of the word that follows, since two marks stand before the text
                    p = " ".join(_word(tokens[j]) if j >= 0 else _START for j in (i - 2, i - 1))
                    if both[_at(p, bits)]:
                        hits.append((p, i))
                if hits:
                    covered = _covered(text)
                    seen.update((p, _word(tokens[i])) for p, i in hits if i not in covered)
                if len(seen) >= FOLLOWERS:
                    yield frame(seen)
                    seen = set()
                if len(known) >= FOLLOWERS:
                    known = {}
                if len(read) >= REMEMBERED:
                    read = set()
        yield frame(seen)

    named = texts.select("text", F.md5(F.col("text").cast("binary")).alias("digest"))
    pairs = named.mapInPandas(find, "pattern string, word string").distinct()
    return pairs.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).join(patterns, "pattern", "left_semi")


def score_patterns(
    graph: DataFrame, follow: DataFrame, rounds: int = ROUNDS, least: float = CONFIDENCE, tasks: int | None = None
) -> DataFrame:
    """pattern, kind, confidence, support for `graph` (pattern, instance, seed: the kind or -1).

    In a round, a pattern's confidence in a kind is the sum of its instances' scores for it, over all different instances
    and ordinary words that follow it; an instance's score is that of the best pattern before it, for seeds always one.
    Instances with a score of `least` support it. `tasks`: at most so many write each of the frames that are stored.
    """
    kinds = range(len(KINDS))
    per_pattern = graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("kinds_of"))
    weight = per_pattern.join(follow, "pattern", "left").select(
        "pattern", (F.col("kinds_of") + F.coalesce("n", F.lit(0))).cast("double").alias("all")
    )
    graph = stored(graph.join(weight, "pattern"), "pii-graph", tasks)
    seed = [(F.col("seed") == k).cast("double") for k in kinds]
    edges = graph.withColumn("score", F.array(*seed))
    patterns = None
    for i in range(rounds):
        sums = [F.sum(F.col("score")[k]) / F.max("all") for k in kinds]
        sure = [F.sum((F.col("score")[k] >= least).cast("long")) for k in kinds]
        scored = edges.groupBy("pattern").agg(F.array(*sums).alias("sure"), F.array(*sure).alias("support"))
        patterns = stored(scored, "pii-patterns", tasks)
        if i + 1 < rounds:
            trusted = [F.max(F.when(F.col("support")[k] >= SUPPORT, F.col("sure")[k]).otherwise(0.0)) for k in kinds]
            open_ = graph.filter("seed < 0").select("pattern", "instance").join(patterns, "pattern")
            best = open_.groupBy("instance").agg(F.array(*trusted).alias("better"))
            own = F.array(*seed)
            score = F.when(F.col("seed") >= 0, own).otherwise(F.coalesce("better", own))
            edges = graph.join(best, "instance", "left").withColumn("score", score)
    each = patterns.select("pattern", F.posexplode(F.arrays_zip("sure", "support")).alias("kind", "s"))
    return each.select("pattern", "kind", F.col("s.sure").alias("confidence"), F.col("s.support").alias("support"))


def _high(scored: DataFrame, least: float = CONFIDENCE) -> DataFrame:
    return scored.filter((F.col("confidence") >= least) & (F.col("support") >= SUPPORT))


def needed_patterns(
    graph: DataFrame, rounds: int = ROUNDS, follow: DataFrame | None = None, tasks: int | None = None
) -> DataFrame:
    """pattern: those of `graph` that may discover, and those whose scores reach them by open instances that they share.

    Ordinary words only lower the scores. So scores without them, or with only some of those that `follow` each pattern
    (pattern, n), are bounds, here with room for rounding.
    """
    least = CONFIDENCE - 1e-9
    some = graph.select("pattern").distinct().withColumn("n", F.lit(0)) if follow is None else follow
    high = _high(score_patterns(graph, some, rounds, least, tasks), least)
    needed = stored(high.select("pattern").distinct(), "pii-needed", tasks)
    open_ = graph.filter("seed < 0").select("pattern", "instance")
    for _ in range(rounds - 1):
        near = open_.join(needed, "pattern", "left_semi").select("instance").distinct()
        more = open_.join(near, "instance", "left_semi").select("pattern")
        needed = stored(needed.unionByName(more).distinct(), "pii-needed", tasks)
    return needed


def _stored_of_texts(frame: DataFrame, label: str, tasks: int | None = None) -> DataFrame:
    with small_batches(frame.sparkSession):
        return stored(frame, label, tasks)


def _joined(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.sort_array(spans), one), ",")


def find_personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_discovered.

    The four counts and base_sha256 are of the spans that the forms find; spans has the discovered ones too, which never
    overlap them. Spans are kind:start:end in code points, the end exclusive, ordered by start and then kind. A null text
    is empty. Texts that repeat are looked at each, but give no further support. Other columns are not looked at.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn(
        "digest", F.sha2(F.col("text").cast("binary"), 256)
    )
    rows = _stored_of_texts(read.mapInPandas(_extract, _FOUND), "pii-rows")
    seen = rows.filter(F.size("seen") > 0).select("digest", F.explode("seen").alias("s")).select("digest", "s.*")
    graph = seen.groupBy("pattern", "instance").agg(F.max("kind").alias("seed"))
    # No frame of the graph has more rows than there are instances.
    tasks = 1 + seen.count() // EACH_TASK
    graph = stored(graph, "pii-edges", tasks)
    # Only a pattern with that many seeds can start, and one with as many instances of a kind can join later. One with
    # seeds alone neither discovers nor tells other patterns anything.
    open_ = F.sum((F.col("seed") < 0).cast("int"))
    most = F.greatest(*[F.sum((F.col("seed") == k).cast("int")) for k in range(len(KINDS))])
    wide = graph.groupBy("pattern").agg(open_.alias("open"), most.alias("seeds"))
    wide = stored(wide.filter((F.col("open") > 0) & (F.col("seeds") + F.col("open") >= SUPPORT)), "pii-wide", tasks)
    found = needed = None
    if not wide.filter(F.col("seeds") >= SUPPORT).isEmpty():
        needed = needed_patterns(graph.join(wide, "pattern", "left_semi"), rounds, tasks=tasks)
    texts = docs.select(text_of().alias("text"))
    if needed is not None and not needed.isEmpty():
        # Words that follow a pattern in some of the texts follow it in all of them. What they refute already is not
        # looked for in the others.
        some = texts.filter(F.pmod(F.xxhash64("text"), F.lit(FIRST_LOOK)) == 0)
        follow = _stored_of_texts(followed(some, needed), "pii-follow", tasks)
        needed = needed_patterns(graph.join(needed, "pattern", "left_semi"), rounds, follow, tasks)
    if needed is not None and not needed.isEmpty():
        follow = _stored_of_texts(followed(texts, needed), "pii-follow", tasks)
        high = _high(score_patterns(graph.join(needed, "pattern", "left_semi"), follow, rounds, tasks=tasks))
        high = high.groupBy("pattern").agg(F.max_by("kind", F.struct("confidence", F.negative("kind"))).alias("new_kind"))
        found = (
            seen.filter("kind < 0")
            .join(high, "pattern")
            .groupBy("digest")
            .agg(F.collect_set(F.struct("start", F.col("new_kind").alias("kind"), "end")).alias("more"))
            .withColumnRenamed("digest", "_digest")
        )
        found = stored(found, "pii-found", tasks)
    none = F.array().cast(SPAN)
    all_rows = rows.withColumn("more", none) if found is None else rows.join(found, F.col("digest") == F.col("_digest"), "left")
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k))
    counts = [of_kind(k).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return all_rows.withColumn("more", F.coalesce(F.col("more").cast(SPAN), none)).withColumn("all", F.concat("base", "more")).select(
        "doc_id",
        *counts,
        F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"),
        _joined("all").alias("spans"),
        F.size("more").cast("long").alias("n_discovered"),
    )


def op2_personal_data(spark, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))
