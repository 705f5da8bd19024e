import random

import pytest
import sentencepiece

from odd_rows import no_documents, odd_documents
from stratum.llm import tokencount

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=tokencount.vocabulary_path())


def texts():
    rng = random.Random(2)
    words = ["the", "naïve", "über", "x", "<s>", "</s>", "日本", "1,234.5", "antidisestablishment", "é", "½"]
    yield " ".join(rng.choice(words) for _ in range(6000))
    yield "   ".join(rng.choice(words) for _ in range(3000))
    yield "".join(rng.choice(words) for _ in range(4000))
    yield "a" * 20_000
    yield " " * 20_000
    yield "line one\nline two\r\n\tthree " * 900
    yield "日本語のテキスト" * 2000
    yield "a b " * 6000


@pytest.mark.parametrize("chunk, overlap", [(512, 64), (3000, 16), (4096, 256)])
def test_spliced_counts_are_those_of_the_whole(model, chunk, overlap):
    for text in texts():
        assert tokencount.count_tokens(model, text, chunk, overlap) == len(model.encode(text))


def test_huge_texts_are_never_encoded_whole(model):
    longest = []

    class Watched:
        def encode(self, data, **kind):
            longest.append(len(data))
            return model.encode(data, **kind)

    text = "some words that go on and on, " * 3000
    assert tokencount.count_tokens(Watched(), text, 2000, 128) == len(model.encode(text))
    assert max(longest) <= 2 * 2000


def test_query(spark, model):
    rows = tokencount.op10_token_counts(spark, SF_DIR).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        n = len(model.encode(docs[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 4096)


def test_odd_rows(spark, model):
    odd = odd_documents(spark)
    got = sorted(map(repr, ((r.doc_id, r.n_bytes, r.n_tokens) for r in tokencount.token_counts(odd, tokencount.vocabulary_path()).collect())))
    want = sorted(repr((r.doc_id, len((r.text or "").encode()), len(model.encode(r.text or "")))) for r in odd.collect())
    assert got == want
    assert tokencount.token_counts(no_documents(spark), tokencount.vocabulary_path()).count() == 0
