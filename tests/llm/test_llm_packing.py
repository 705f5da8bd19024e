import string
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from odd_rows import no_documents, odd_documents
from stratum.llm import packing
from stratum.llm.packing import Limits

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(packing.vocabulary_path())


def check(rows, docs, model, limit=2048):
    """Every token in one piece, sequences gapless and within the limits."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert by_doc.keys() == docs.keys()
    for doc_id, text in docs.items():
        ids = np.array(model.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert zlib.crc32(ids[at : at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limit
    return by_sequence


def test_round_trip(spark, model):
    rows = packing.op9_pack_sequences(spark, SF_DIR).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    sequences = check(rows, docs, model)
    used = sum(r.length for r in rows)
    assert used >= 0.98 * (len(sequences) - 1) * 2048


@pytest.mark.parametrize(
    "text",
    ["a naïve ÉCOLE, größe straße ŒUVRE ŉ ǅ ſ ﬁ ª º µ ʼn ɐɑ x² ½", "It's <|endoftext|> a<|ENDOFTEXT|>b CAFÉ., x́ ́y a b,. ...", "\x1c\x1f q\x85r Σίσυφος ΣΑΣ İstanbul 12,345.67", " ", "", "'s 'S it'S.", "a,b. c!, ,."],
)
def test_words_give_the_ids_of_the_whole_text(model, text):
    words = packing.Words(packing.vocabulary_path())
    for _ in range(2):
        assert np.frombuffer(words.ids([text])[0], "<u4").tolist() == model.encode(text, add_special_tokens=False).ids


def test_a_full_memory_forgets(model, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 4)
    words = packing.Words(packing.vocabulary_path())
    texts = ["one two three", "four five, six. seven", "one, two six five four three", "eight nine ten eleven", "one two, eight"]
    for text in texts * 2:
        assert np.frombuffer(words.ids([text])[0], "<u4").tolist() == model.encode(text, add_special_tokens=False).ids


class Counted:
    """A tokenizer that notes the texts it is given."""

    def __init__(self, model):
        self.model, self.given = model, []

    def encode_batch_fast(self, texts, **options):
        self.given += texts
        return self.model.encode_batch_fast(texts, **options)


def test_words_of_letters_are_spared_the_steps_of_the_whole_model(model):
    words = packing.Words(packing.vocabulary_path())
    words._model = Counted(words._model)
    latin = [chr(c) for c in range(0x250) if chr(c).isalpha()]
    texts = [f"one two{end} Größe{end} {' '.join(latin)} a12{end} x-y" for end in string.punctuation] * 2 + ["", " one  "]
    for text, ids in zip(texts, words.ids(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == model.encode(text, add_special_tokens=False).ids
    letters = [t for t in words._model.given if t.isalpha() and "\u0130" not in t]
    assert letters == [] and len(words._model.given) == len(set(words._model.given)) < 90


@pytest.mark.parametrize("some", [1, 3])
def test_ids_are_copied_in_parts(model, monkeypatch, some):
    monkeypatch.setattr(packing, "COPIED_IDS", some)
    monkeypatch.setattr(packing, "WORDS_OF_A_TEXT", some)
    monkeypatch.setattr(packing, "BLOCK_CHARACTERS", 9)
    texts = ["one two, three. four", "", "five###", "...", "six two", " ", "one"]
    for text, ids in zip(texts, packing._ids(packing.Words(packing.vocabulary_path()), texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == model.encode(text, add_special_tokens=False).ids


def test_all_limits_hold(spark):
    rng = np.random.default_rng(1)
    tokens = rng.integers(1, 101, 3000)
    loss = (tokens * rng.random(3000)).astype(int)
    limits = Limits(tokens=256, segments=6, loss=100)
    loss = np.minimum(loss, limits.loss)
    frame = spark.createDataFrame([(i, int(t), int(x)) for i, (t, x) in enumerate(zip(tokens, loss))], "item long, tokens long, loss long")
    rows = packing.pack(frame, ["item"], limits, shard_items=700).toPandas()
    assert sorted(rows["item"]) == list(range(3000))
    sums = rows.groupby("sequence_id").agg(tokens=("tokens", "sum"), loss=("loss", "sum"), segments=("item", "size"))
    assert (sums["tokens"] <= 256).all() and (sums["loss"] <= 100).all() and (sums["segments"] <= 6).all()
    bound = max(tokens.sum() / 256, loss.sum() / 100, 3000 / 6)
    assert len(sums) <= 1.1 * bound + 5
    with pytest.raises(ValueError):
        packing.pack_kinds(np.array([[300.0, 1, 0]]), limits)


def test_odd_rows(spark, model):
    odd = odd_documents(spark)
    rows = packing.pack_documents(odd, packing.vocabulary_path()).collect()
    texts = defaultdict(list)
    for r in odd.collect():
        texts[r.doc_id].append(len(model.encode(r.text or "", add_special_tokens=False).ids) + 1)
    for doc_id, lengths in texts.items():
        assert sum(r.length for r in rows if r.doc_id == doc_id) == sum(lengths)
    assert rows == packing.pack_documents(odd, packing.vocabulary_path()).collect()
    assert packing.pack_documents(no_documents(spark), packing.vocabulary_path()).count() == 0
