"""Packing of examples into sequences under several limits at once: tokens, segments and loss-bearing tokens.

This is vector bin packing by the dot-product heuristic. A sequence is open at a time; of the items that fit it in every
dimension, the one whose demand has the largest dot product with what is left of the limits is placed, each dimension
weighted by its share of the whole demand; when none fits, the next sequence is opened. Items of equal demand are one
kind, so that a step looks at kinds and not at items.

Items are dealt to shards of bounded size at random but repeatably, and every shard packs its own; with thousands of
items in a shard the few half-full sequences at its end do not matter.
"""

from __future__ import annotations

import math
import os
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from stratum.llm.common import stored, table, text_of

SHARD_ITEMS = 20_000
VOCABULARY = "word_bpe_49k.json"
END = 1
# Different words that are tokenized at a time, and ids that are copied at a time.
REMEMBERED = 600_000
COPIED_IDS = 1 << 20
# Words that are tokenized as one text.
WORDS_OF_A_TEXT = 100
# Texts whose words are told apart together: words that return later are tokenized again.
BLOCK_CHARACTERS = 1 << 24
# Letters of ASCII and the Latin blocks: one word to the tokenizer, whose last token says so.
WORD_OF_LETTERS = r"^[A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]+$"


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold at most."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


def pack_kinds(demand: np.ndarray, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """For items with rows (tokens, 1, loss): the sequence of each, and its turn there.

    Every item must fit an empty sequence. Items of one kind are interchangeable and placed in their order.
    """
    n = len(demand)
    most = np.array([limits.tokens, limits.segments, limits.loss], float)
    kinds, kind_of, left = np.unique(demand, axis=0, return_inverse=True, return_counts=True)
    kind_of = kind_of.ravel()
    if (kinds > most).any():
        raise ValueError("an item exceeds the limits")
    by_kind = np.argsort(kind_of, kind="stable")
    taken = np.cumsum(left) - left
    # The weight of a dimension over its limit squared: both vectors of the dot product are shares of the limits.
    scale = (kinds.T @ left) / max(n, 1) / most**3
    tokens, loss = np.ascontiguousarray(kinds[:, 0]), np.ascontiguousarray(kinds[:, 2])
    sequence, turn = np.empty(n, np.int64), np.empty(n, np.int64)
    opened, placed, turns = 0, 0, 0
    room_tokens, room_segments, room_loss = most
    gone = 0
    while placed < n:
        upto = int(np.searchsorted(tokens, room_tokens, "right")) if room_segments else 0
        score = scale[0] * room_tokens * tokens[:upto] + scale[2] * room_loss * loss[:upto]
        score[(loss[:upto] > room_loss) | (left[:upto] == 0)] = -1
        best = int(score.argmax()) if upto else -1
        if best < 0 or score[best] < 0:
            opened, turns = opened + 1, 0
            room_tokens, room_segments, room_loss = most
            continue
        item = by_kind[taken[best]]
        sequence[item], turn[item] = opened, turns
        taken[best] += 1
        left[best] -= 1
        room_tokens, room_segments, room_loss = room_tokens - tokens[best], room_segments - 1, room_loss - loss[best]
        turns, placed = turns + 1, placed + 1
        gone += left[best] == 0
        if 2 * gone > len(left):
            stay = left > 0
            tokens, loss, left, taken, gone = tokens[stay], loss[stay], left[stay], taken[stay], 0
    return sequence, turn


def pack(items: DataFrame, order: list[str], limits: Limits = Limits(), shard_items: int = SHARD_ITEMS) -> DataFrame:
    """The rows of `items` (with `tokens` and `loss`, both within the limits) with sequence_id and offset.

    `items` should be a stored frame: it is counted first. `order` names columns that tell its rows apart, so that
    reruns agree; rows that repeat in all of them are interchangeable. An empty frame gives an empty result.
    """
    shards = max(1, math.ceil(items.count() / shard_items))
    columns = [f.name for f in items.schema]

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order, kind="stable", na_position="first").reset_index(drop=True)
        shard = int(rows["_shard"].iloc[0])
        demand = np.column_stack([rows["tokens"], np.ones(len(rows)), rows["loss"]]).astype(float)
        sequence, turn = pack_kinds(demand, limits)
        rows["sequence_id"] = sequence + (shard << 32)
        rows["_turn"] = turn
        rows = rows.sort_values(["sequence_id", "_turn"], kind="stable")
        rows["offset"] = rows.groupby("sequence_id")["tokens"].cumsum() - rows["tokens"]
        return rows[[*columns, "sequence_id", "offset"]]

    schema = items.schema.add("sequence_id", "long").add("offset", "long")
    dealt = items.withColumn("_shard", F.pmod(F.xxhash64(*order), F.lit(shards)))
    return dealt.groupBy("_shard").applyInPandas(place, schema)


@dataclass(frozen=True)
class _Ids:
    """The ids of several strings, one after the other, and how many each has."""

    ids: np.ndarray
    lengths: np.ndarray

    @staticmethod
    def of(found: list[list[int]]) -> _Ids:
        return _Ids(np.fromiter(chain.from_iterable(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)))

    @staticmethod
    def joined(parts: list[_Ids]) -> _Ids:
        empty = _Ids.of([])
        return _Ids(np.concatenate([empty.ids, *(p.ids for p in parts)]), np.concatenate([empty.lengths, *(p.lengths for p in parts)]))

    def take(self, which: np.ndarray) -> _Ids:
        """The strings at the given places."""
        lengths = self.lengths[which]
        shift = (np.cumsum(self.lengths) - self.lengths)[which] - (np.cumsum(lengths) - lengths)
        return _Ids(self.ids[np.repeat(shift, lengths) + np.arange(lengths.sum())], lengths)


class Words:
    """Token ids of whole texts, through those of their different words.

    The tokenizer drops white space, and none of its steps looks across it, so the ids of a text are those of its words
    one after the other. ASCII capitals are lowered by it anyway and share an entry, unless a text may hold a special
    string, which is matched as it is written.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._model = Tokenizer.from_file(path)
        # The same vocabulary for words of letters, which the other steps before it leave as they are.
        self._letters = Tokenizer.from_file(path)
        self._letters.normalizer = normalizers.Lowercase()
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), level])
        vocabulary = self._model.get_vocab(with_added_tokens=False)
        self._ends_word = np.zeros(self._model.get_vocab_size() + 1, bool)
        self._ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        lowered = pa.array([t if "<|" in t else t.encode().lower() for t in texts], pa.large_string())
        split = pc.ascii_split_whitespace(lowered)
        words = split.values.dictionary_encode()
        different = words.dictionary
        parts = [self._ids_of(different.slice(at, REMEMBERED)) for at in range(0, len(different), REMEMBERED)]
        memory = _Ids.joined(parts)
        which, upto = words.indices.to_numpy(), split.offsets.to_numpy()
        ends = np.append(0, np.cumsum(memory.lengths[which]))[upto]
        out, first = [], 0
        while first < len(texts):
            # Some texts at a time, whose ids are copied out together.
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + COPIED_IDS, "right")) - 1)
            data = memory.take(which[upto[first] : upto[last]]).ids.tobytes()
            bounds = (4 * (ends[first : last + 1] - ends[first])).tolist()
            out += [data[start:end] for start, end in zip(bounds, bounds[1:])]
            first = last
        return out

    def _ids_of(self, words: pa.Array) -> _Ids:
        """The ids of different words."""
        # ASCII punctuation after letters is tokenized apart from them. What has other characters goes whole to the model.
        stems = pc.utf8_rtrim(words, string.punctuation)
        lettered = pc.match_substring_regex(stems, WORD_OF_LETTERS)
        stems = pc.if_else(lettered, stems, "")
        after = pc.utf8_length(stems)
        ended = pc.less(after, pc.utf8_length(words))
        tails = [w[n:] for w, n in zip(words.filter(ended).to_pylist(), after.filter(ended).to_pylist())]
        stems, tails = stems.dictionary_encode(), pa.array(tails, pa.large_string()).dictionary_encode()
        stem_ids = self._of_letters(stems.dictionary).take(stems.indices.to_numpy())
        tail_ids = self._of_any(tails.dictionary.to_pylist()).take(tails.indices.to_numpy())
        tail_lengths = np.zeros(len(words), np.int64)
        tail_lengths[ended.to_numpy(zero_copy_only=False)] = tail_ids.lengths
        tail_ids = _Ids(tail_ids.ids, tail_lengths)
        n = len(words)
        both = _Ids.joined([stem_ids, tail_ids]).take(np.arange(2 * n).reshape(2, n).T.ravel())
        return _Ids(both.ids, both.lengths.reshape(n, 2).sum(axis=1))

    def _of_any(self, words: list[str]) -> _Ids:
        found = [e.ids for e in self._model.encode_batch_fast(words, add_special_tokens=False)]
        return _Ids.of(found)

    def _of_letters(self, words: pa.Array) -> _Ids:
        """Words of letters, or empty, many in one text, which costs half as much as each on its own."""
        some = np.append(np.arange(0, len(words), WORDS_OF_A_TEXT), len(words)).astype(np.int32)
        texts = pc.binary_join(pa.ListArray.from_arrays(some, words), pa.scalar(" ", words.type)).to_pylist()
        found = []
        for at in range(0, len(texts), 100):
            found += [np.array(e.ids, "<u4") for e in self._letters.encode_batch_fast(texts[at : at + 100], add_special_tokens=False)]
        ids = np.concatenate([_Ids.of([]).ids, *found])
        ends = np.flatnonzero(self._ends_word[ids]) + 1
        lengths = pc.not_equal(words, "").to_numpy(zero_copy_only=False).astype(np.int64)
        if len(ends) != lengths.sum():
            raise ValueError("the vocabulary does not mark the ends of words")
        lengths[lengths > 0] = np.diff(ends, prepend=0)
        return _Ids(ids, lengths)


@lru_cache(maxsize=2)
def _words(path: str) -> Words:
    return Words(path)


def _ids(words: Words, texts: list[str]) -> Iterator[bytes]:
    """The ids of the texts, a block of texts at a time."""
    start = size = 0
    for at, text in enumerate(texts):
        size += len(text)
        if size >= BLOCK_CHARACTERS or at + 1 == len(texts):
            yield from words.ids(texts[start : at + 1])
            start, size = at + 1, 0


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, tokens long, loss long, part long"


def document_pieces(docs: DataFrame, path: str, most: int = 2048) -> DataFrame:
    """Pieces of at most `most` tokens of every row of `docs` (doc_id, text): its ids, then END.

    doc_id, start, length, ids_crc32, doc_tokens; `tokens` and `loss` for packing (the first token of a document has
    nothing before it and bears no loss), and `part`, which tells rows with the same doc_id apart within a task.
    """
    end = np.array([END], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _words(path)
        row = 0
        for batch in batches:
            out = []
            for doc_id, ids in zip(batch["doc_id"], _ids(words, batch["text"].to_list())):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, most):
                    piece = ids[4 * start : 4 * (start + most)]
                    length = len(piece) // 4
                    loss = length - (start == 0)
                    out.append((doc_id, start, length, zlib.crc32(piece), n, length, loss, row))
                row += 1
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return read.mapInPandas(cut, PIECES)


def pack_documents(docs: DataFrame, path: str, limits: Limits = Limits()) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: every token of `docs` in exactly one piece.

    A null or empty text is its END alone; repeated rows are packed each; null ids stay null; other columns are not
    looked at. Tokenized once: the pieces, a few numbers each, are stored before they are dealt out.
    """
    pieces = stored(document_pieces(docs, path, min(limits.tokens, limits.loss)), "pack-pieces")
    packed = pack(pieces, ["doc_id", "start", "ids_crc32", "part"], limits)
    return packed.drop("tokens", "loss", "part")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_pack_sequences(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary_path())
