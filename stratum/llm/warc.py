"""WARC archives: written from pages, read back by boundary-chain verification.

Written, an archive is text with a record per row, since a record ends in two line ends. Read, a file is split wherever
the version line stands, which also happens inside payloads. Every such place is a candidate record: its header says
where its successor must begin. From the start of a file the chain of successors is followed by pointer jumping, and
what the chain does not reach is payload, whatever it looks like. Positions come from running sums: within a split of a
file in the order it is read, and over the splits before it.

Chains are first shortened: candidates of a split whose successor is the very next candidate form a run, and pointers
jump from run to run. Payloads never are shuffled, except those that hold version lines, whose parts are put together;
they are found again by their digests, since the splits may differ when the archive is read a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from stratum.llm.common import stored, table
from stratum.session import scratch_dir

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
SMALLEST = 1000
# The names of header fields and record types.
RESPONSE, REVISIT = "response", "revisit"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    """A header line; none if the value is null. Control characters of the value become spaces."""
    clean = F.regexp_replace(value.cast("string"), r"[\x00-\x1F\x7F]", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def with_types(pages: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """page_id, url, payload, and refers_to: of equal payloads of at least `smallest` bytes the largest page_id, for others."""
    plain = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    )
    long_enough = F.octet_length("payload") >= smallest
    sha = F.when(long_enough, F.sha2(F.col("payload").cast("binary"), 256))
    repeated = (
        plain.filter(long_enough)
        .select(sha.alias("_sha"), "page_id")
        .groupBy("_sha")
        .agg(
            F.max("page_id").alias("_first"),
            F.min("page_id").alias("_last"),
            F.count("page_id").alias("_ids"),
            F.count(F.lit(1)).alias("_n"),
        )
        .filter("_n > 1 and (_first != _last or _ids != _n)")
        .select("_sha", "_first")
    )
    # Stored, so that its size is known when the join with the payloads is planned.
    joined = plain.withColumn("_sha", sha).join(stored(repeated, "warc-repeated"), "_sha", "left")
    other = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.select("page_id", "url", "payload", F.when(other, F.col("_first")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, smallest: int = SMALLEST, compression: str = "none") -> None:
    """Archives below `path` with a record per row of `pages` (page_id, url, html).

    A null html is an empty payload; a null url or page_id leaves its field out. Rows that repeat a page with its
    payload are written alike. Other columns are not looked at. An empty table gives an archive without records.
    """
    payload = F.col("payload")
    revisit = F.col("refers_to").isNotNull()
    size = F.octet_length(payload)
    header = F.concat(
        F.lit(VERSION),
        _line("WARC-Type", F.when(revisit, F.lit(REVISIT)).otherwise(F.lit(RESPONSE))),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id"), F.lit(">"))),
        _line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1(payload.cast("binary")))),
        _line("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("refers_to"), F.lit(">")))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("X-Payload-Length", size),
        _line("Content-Type", F.lit("text/html")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(size)),
        F.lit("\r\n"),
    )
    record = F.concat(header, F.when(revisit, F.lit("")).otherwise(payload))
    typed = with_types(pages, smallest)
    typed.select(record.alias("value")).write.option("lineSep", END).option("compression", compression).text(path)


def _field(name: str, pattern: str) -> Column:
    found = F.regexp_extract("header", rf"(?im)^{name}:[ \t]*{pattern}[ \t]*\r?$", 1)
    return F.when(found != "", found)


def _scan(spark: SparkSession, path: str, version: str) -> DataFrame:
    """file, block, nth, content: what follows each version line, and what stands before the first, as it is read."""
    return (
        spark.read.option("lineSep", version)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("nth"),
            F.col("value").alias("content"),
        )
    )


def _candidates(spark: SparkSession, path: str, version: str) -> DataFrame:
    """A stored row per version line with its position, its fields, and its payload's digest if it is all there."""
    m = len(version)
    content = F.col("content")
    head = F.when(F.instr(content, END) > 0, F.substring_index(content, END, 1))
    rows = _scan(spark, path, version).select(
        "file", "block", "nth", "content", F.octet_length(content).cast("long").alias("bytes"), head.alias("header")
    )
    body = F.col("content").cast("binary")
    at = F.octet_length("header") + len(END)
    rows = rows.withColumn("length", F.try_to_number(_field("Content-Length", r"(\d{1,15})"), F.lit("9" * 15)).cast("long"))
    whole = F.col("bytes") >= at + F.col("length") + len(END)
    fields = rows.select(
        "file",
        "block",
        "nth",
        "bytes",
        F.sha2(content, 256).alias("print"),
        (F.lit(m) + at + F.col("length") + len(END)).alias("reach"),
        F.coalesce(whole, F.lit(False)).alias("whole"),
        F.when(whole, F.sha1(F.substring(body, at + 1, F.col("length").cast("int")))).alias("digest"),
        "length",
        _field("WARC-Type", r"(\S+)").alias("type"),
        _field("WARC-Record-ID", r"<urn:page:(-?\d+)>").cast("long").alias("page_id"),
        _field("WARC-Refers-To", r"<urn:page:(-?\d+)>").cast("long").alias("refers_to"),
        _field("WARC-Payload-Digest", r"sha1:(\S+)").alias("stated"),
        _field("X-Payload-Length", r"(\d{1,15})").cast("long").alias("stated_bytes"),
    )
    fields = stored(fields, "warc-scanned")
    inside = W.partitionBy("file", "block").orderBy("nth")
    span = F.col("bytes") + m
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    base = fields.groupBy("file", "block").agg(F.sum(span).alias("_sum")).select(
        F.col("file").alias("_file"), F.col("block").alias("_block"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base")
    )
    placed = (
        fields.withColumn("_before", F.sum(span).over(inside) - span)
        .join(base, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
        .withColumn("offset", F.col("_base") + F.col("_before") - m)
        .filter("offset >= 0")
        .withColumn("next", F.col("offset") + F.col("reach"))
    )
    return stored(placed.drop("_file", "_block", "_base", "_before", "reach"), "warc-candidates")


def _reached(candidates: DataFrame) -> DataFrame:
    """The candidates on the chain from the start of their file."""
    following = W.partitionBy("file", "block").orderBy("offset")
    after, before = F.lead("offset").over(following), F.lag("next").over(following)
    near = candidates.select("file", "block", "offset", "next", after.alias("_after"), before.alias("_from"))
    near = stored(near, "warc-near")
    # A run begins where the candidate before does not lead, and where a jump from elsewhere arrives.
    jumps = near.filter("next is not null and not next <=> _after").select("file", F.col("next").alias("offset"))
    jumps = jumps.distinct().withColumn("_hit", F.lit(True))
    started = near.join(jumps, ["file", "offset"], "left").withColumn(
        "_start", (~F.col("_from").eqNullSafe(F.col("offset")) | F.col("_hit").isNotNull() | (F.col("offset") == 0)).cast("int")
    )
    numbered = stored(
        started.withColumn("_run", F.sum("_start").over(following)).select("file", "block", "offset", "next", "_run"), "warc-runs"
    )
    runs = numbered.groupBy("file", "block", "_run").agg(F.min("offset").alias("at"), F.max_by("next", "offset").alias("to"))
    runs = stored(runs, "warc-chain")
    hops = runs.select("file", "at", "to")
    seen = hops.filter("at = 0").select("file", "at")
    found = seen.count()
    while True:
        step = hops.filter("to is not null").select(F.col("file").alias("_file"), F.col("at").alias("_at"), F.col("to").alias("_to"))
        ahead = seen.join(step, (F.col("file") == F.col("_file")) & (F.col("at") == F.col("_at"))).select("file", F.col("_to").alias("at"))
        ahead = ahead.join(runs.select("file", "at"), ["file", "at"], "left_semi")
        seen = stored(seen.unionByName(ahead).distinct(), "warc-seen")
        now = seen.count()
        if now == found:
            break
        found = now
        onward = hops.join(step, (F.col("file") == F.col("_file")) & (F.col("to") == F.col("_at")), "left")
        hops = stored(onward.select("file", "at", F.col("_to").alias("to")), "warc-hops")
    kept = runs.join(seen, ["file", "at"], "left_semi").select("file", "block", "_run")
    on_chain = numbered.join(kept, ["file", "block", "_run"], "left_semi").select("file", "offset")
    return candidates.join(on_chain, ["file", "offset"], "left_semi")


def _joined(spark: SparkSession, path: str, version: str, candidates: DataFrame, broken: DataFrame) -> DataFrame:
    """file, offset, digest of records whose payload holds version lines: their parts read again and put together.

    Records do not overlap, so a part can only belong to the last broken one that begins at it or before.
    """
    begin = broken.select("file", "offset", F.col("offset").alias("_begin"))
    parts = candidates.select("file", "block", "offset", "print").join(begin, ["file", "offset"], "left")
    upto = W.partitionBy("file", "block").orderBy("offset")
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    last = parts.groupBy("file", "block").agg(F.max("_begin").alias("_last"))
    last = last.select("file", "block", F.max("_last").over(earlier).alias("_carried"))
    placed = parts.join(last, ["file", "block"]).select(
        "file", F.col("offset").alias("part"), "print", F.coalesce(F.max("_begin").over(upto), "_carried").alias("record")
    )
    ranges = broken.select("file", F.col("offset").alias("record"), F.col("next").alias("_end"), "length")
    wanted = stored(placed.join(ranges, ["file", "record"]).filter("part < _end").drop("_end"), "warc-parts")
    prints = wanted.select("print").distinct()
    scanned = _scan(spark, path, version).select(F.sha2("content", 256).alias("print"), "content")
    found = stored(scanned.join(prints, "print", "left_semi").dropDuplicates(["print"]), "warc-contents")
    texts = wanted.join(found, "print")
    part = F.struct("part", F.col("content").cast("binary").alias("content"))
    whole = texts.groupBy("file", "record", "length").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    between = F.lit(version).cast("binary")
    body = F.aggregate("parts", F.lit(b""), lambda all_, p: F.concat(all_, between, p["content"]))
    text = F.col("body").cast("string")
    at = F.octet_length(F.substring_index(text, END, 1)) + len(END)
    payload = F.substring(F.col("body"), at + 1, F.col("length").cast("int"))
    digest = F.when(F.octet_length("body") >= at + F.col("length"), F.sha1(payload))
    return whole.withColumn("body", body).select("file", F.col("record").alias("offset"), digest.alias("joined"))


def read_archives(spark: SparkSession, path: str, version: str = VERSION) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, intact; a row per record of the archives.

    payload_digest is computed from the payload for responses, and the stated one for revisits, whose payload is with the
    record they refer to. intact: the computed digest is the stated one. A record that the end of its file cuts off has
    no digest and is not intact; what follows a broken header is not on the chain.
    """
    candidates = _candidates(spark, path, version)
    records = stored(_reached(candidates), "warc-records")
    broken = records.filter("not whole")
    joined = records.withColumn("joined", F.lit(None).cast("string"))
    if not broken.isEmpty():
        joined = records.join(_joined(spark, path, version, candidates, broken), ["file", "offset"], "left")
    revisit = F.col("type") == REVISIT
    digest = F.coalesce(F.when(revisit, F.col("stated")), "digest", "joined")
    return joined.select(
        "page_id",
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("length")).alias("payload_bytes"),
        digest.alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(revisit, F.col("refers_to")).alias("refers_to"),
        F.coalesce(digest == F.col("stated"), F.lit(False)).alias("intact"),
    )


def op7_warc_round_trip(spark, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc-archive")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path)


ORACLE = """
with p as (
  select page_id, coalesce(html, '') as body, strlen(coalesce(html, '')) as payload_bytes from pages
), g as (
  select *, max(page_id) over (partition by body) as top from p
)
select page_id, payload_bytes, sha1(body) as payload_digest,
  case when payload_bytes >= 1000 and page_id <> top then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id <> top then top end as refers_to, true as intact
from g
"""
