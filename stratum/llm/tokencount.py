"""Token counts of whole texts, huge ones included, by overlap resynchronisation.

A short text is given to the tokenizer as it is. A long one is cut into chunks that overlap; every chunk is tokenized
on its own, with the offsets of its tokens, and two neighbours are spliced at a position in their overlap that is a
token boundary of both and that no token of the vocabulary can span: in pieces of this kind a word's leading space starts
a piece, and no piece holds a space after another character, so merges never cross such a place. The library puts a
space before every text, so the right chunk begins after the space of the splice. If the overlap
has no such place, as in a text without spaces, it is widened until there is one or the text ends, which is the whole
text given to the tokenizer. The count is therefore the library's, and memory follows the chunk, not the text, wherever
the text has spaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from stratum.llm.common import table, text_of

CHUNK = 32_768
OVERLAP = 256
VOCABULARY = "piece_bpe_32k.model"


@lru_cache(maxsize=4)
def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _stable(data: bytes, low: int, high: int) -> list[int]:
    """Places of a space between two ASCII letters or digits in data[low:high]; normalisation changes nothing there."""
    found, at = [], data.find(b" ", low, high)
    while at >= 0:
        if data[at - 1 : at].isalnum() and data[at + 1 : at + 2].isalnum():
            found.append(at)
        at = data.find(b" ", at + 1, high)
    return found


def _begins(model, data: bytes) -> list[int]:
    """Offsets at which the tokens of `data` begin."""
    return [p.begin for p in model.encode(data, return_type="proto").pieces]


def _whole(data: bytes, at: int) -> int:
    """The last place up to `at` that is not inside a character."""
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def count_tokens(model, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The number of tokens that `model` gives for the whole text."""
    data = text.encode()
    total = start = 0  # a chunk starts at the beginning of the text or after a splice
    while len(data) - start > 2 * chunk:
        splice = None
        reach = overlap
        while splice is None and start + chunk + reach < len(data):
            end = _whole(data, start + chunk + reach)
            left = [start + x for x in _begins(model, data[start:end])]
            for at in _stable(data, end - reach, end - reach // 2):
                right = _begins(model, data[at + 1 : end])
                if at in left and _agree(left, [at, *(at + 1 + x for x in right[1:])], at, end):
                    splice = at
                    break
            reach *= 2
        if splice is None:
            break
        total += sum(1 for x in left if x < splice)
        start = splice + 1
    return total + len(model.encode(data[start:]))


def _agree(left: list[int], ahead: list[int], at: int, end: int) -> bool:
    """Both chunks cut the overlap alike, from the splice up to its last quarter, where the left one ends abruptly."""
    stop = at + 3 * (end - at) // 4
    return [x for x in left if at <= x < stop] == [x for x in ahead if x < stop]


def token_counts(docs: DataFrame, path: str, limit: int = 4096, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) for every row of `docs` (doc_id, text).

    A null text is empty and has no tokens. Rows are counted one by one, so repeated ones and null ids make no
    difference; other columns are not looked at. `path` names the vocabulary file, which every executor must have.
    """

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _model(path)
        for texts in batches:
            yield pd.Series([count_tokens(model, t, chunk, overlap) for t in texts], dtype="int64")

    counted = F.pandas_udf(count, "long")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.octet_length(text_of()).cast("long").alias("n_bytes"),
        counted(text_of()).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary_path())
