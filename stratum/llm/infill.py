"""Fill-in-the-middle: texts cut into prefix, middle and suffix, and put together in the order that a model is trained on.

One fullmatch of a repeated unit keeps every repetition of the group, so the ends of its captures give both the number
of units and the places of all cuts; nothing runs over the text a second time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

from stratum.llm.common import table, text_of

# The markers, the forms, a unit, and the shares of documents in a hundred.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
UNIT = r"[A-Za-z]+|[^A-Za-z]"
FORMED, SUFFIX_FIRST = 90, 20

# The greedy way through the units is the one that matches, so no way back has to be remembered.
_UNITS = regex.compile(f"({UNIT})*+")
_CUT = "doc_id long, text string, n long, form string, prefix_chars long, middle_chars long, output string"


def unit_ends(text: str) -> list[int]:
    """Where each unit ends, in code points."""
    return _UNITS.fullmatch(text).ends(1)


def draws(doc_id: str = "doc_id", seed: int = 1) -> list[Column]:
    """Four numbers below 2^32 that depend on the id alone; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def arrange(text: str, h: tuple[int, int, int, int]) -> tuple[int, str, int | None, int | None, str]:
    """(n, form, prefix_chars, middle_chars, output) of a text and the four numbers drawn for it."""
    ends = unit_ends(text)
    n = len(ends)
    if not text or h[2] % 100 >= FORMED or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, PLAIN, None, None, text
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = (ends[i - 1] if i else 0 for i in (first, second))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < SUFFIX_FIRST:
        return n, SPM, a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, PSM, a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _arranged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["n", "form", "prefix_chars", "middle_chars", "output"]
    for batch in batches:
        numbers = zip(*(batch[f"h{i}"] for i in range(1, 5)))
        rows = [arrange(text, h) for text, h in zip(batch["text"], numbers)]
        out = pd.DataFrame(rows, columns=names, index=batch.index)
        kinds = {"prefix_chars": "Int64", "middle_chars": "Int64"}
        yield pd.concat([batch[["doc_id", "text"]].astype({"doc_id": "Int64"}), out.astype(kinds)], axis=1)


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, text, n, form, prefix_chars, middle_chars, output.

    A null text is empty; an empty text and one that holds a marker stay as they are (form `plain`, both lengths null),
    as does a share of the others. The id and `seed` decide all draws: rows of one id are cut by the same numbers, those
    without an id by the numbers of an empty one. Other columns are not looked at. A text is held by one task with the
    places of its units, some 40 bytes each.
    """
    h = [x.alias(f"h{i}") for i, x in enumerate(draws(seed=seed), 1)]
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), *h)
    return read.mapInPandas(_arranged, _CUT)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made from. No part holds a marker, so the three markers split it into its parts."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    second, third, fourth = (F.get(parts, i) for i in (1, 2, 3))
    return (
        F.when(F.col(form) == PSM, F.concat(second, fourth, third))
        .when(F.col(form) == SPM, F.concat(third, fourth, second))
        .otherwise(F.col(output))
    )


def op13_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and digests of the output and of the text rebuilt from it."""
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return fill_in_middle(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(restored()).alias("restored_sha256"),
    )


ORACLE = """
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
           sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
), drawn AS (
    SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
           ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
    FROM cut
), parts AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), spelled AS (
    SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS prefix, coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
           coalesce(array_to_string(units[b + 1:n], ''), '') AS suffix
    FROM parts
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM spelled
"""
