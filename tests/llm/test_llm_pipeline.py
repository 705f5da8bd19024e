import random
from collections import Counter

import pytest

import corpus_pipeline
from odd_rows import DOCS, no_documents, odd_documents
from stratum.llm import mixing
from stratum.session import scratch_dir
from test_llm_simhash import plain_fingerprint, plain_labels


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(9)
    letters = {"en": "the and of ing tion er", "de": "der die ung sch ein ich", "es": "el que ción los as ar"}
    word = lambda lang: "".join(rng.choice(letters[lang].split()) for _ in range(rng.randint(1, 3)))
    rows = []
    for i in range(150):
        lang = rng.choice(sorted(letters))
        text = " ".join(word(lang) for _ in range(rng.randint(30, 200)))
        rows.append((i, text, lang, rng.choice(["a", "b", "c", None]), len(text)))
    rows += [(200 + i, rows[i][1].upper(), rows[i][2], "a", 1) for i in range(20)]
    rows += [(300 + i, rows[40 + i][1] + " " + word("en"), "en", "b", 1) for i in range(30)]
    rows += [(400, None, "en", "a", 0), (401, "12 34", "en", "a", 5), (402, "", None, None, 0), (403, rows[5][1], "en", "a", 1)]
    return spark.createDataFrame(rows, DOCS)


def staged(spark, docs):
    """(name, what went in, what came out), rows collected."""
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_dir(spark, "test-stage")
        stage(spark, docs, "").write.parquet(path)
        out = spark.read.parquet(path)
        yield name, docs, out
        docs = out


def test_stages_against_plain_versions(spark, corpus):
    for name, before, after in staged(spark, corpus):
        rows, kept = before.collect(), after.collect()
        if name != "pack":
            assert after.columns == corpus.columns
            assert set(kept) <= set(rows)
        if name == "language":
            assert {r.doc_id for r in rows} - {r.doc_id for r in kept} == {400, 401, 402}
        elif name == "exact_duplicates":
            last = {}
            for r in rows:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text)
                last[text] = max(last.get(text, -1), r.doc_id)
            assert sorted(r.doc_id for r in kept) == sorted(last.values())
        elif name == "near_duplicates":
            ids = sorted(r.doc_id for r in rows)
            texts = {r.doc_id: r.text for r in rows}
            labels = plain_labels([plain_fingerprint(texts[i]) for i in ids])
            assert sorted(r.doc_id for r in kept) == [ids[i] for i in sorted(set(labels))]
            assert len(kept) < len(rows)
        elif name == "mix":
            taken = {r.doc_id: -(-r.taken // r.size) for r in mixing.mix(before).collect() if r.taken}
            assert Counter(r.doc_id for r in kept) == taken
            words = sum(len(r.text.split()) for r in rows)
            assert 0.8 * words <= sum(len(r.text.split()) for r in kept) <= 1.3 * words
        else:
            from tokenizers import Tokenizer

            from stratum.llm import packing

            model = Tokenizer.from_file(packing.vocabulary_path())
            times = Counter(r.doc_id for r in rows)
            assert all(n == times[d] for (d, _), n in Counter((r.doc_id, r.start) for r in kept).items())
            ids = {r.doc_id: len(model.encode(r.text, add_special_tokens=False).ids) + 1 for r in rows}
            assert {r.doc_id: r.doc_tokens for r in kept} == ids
            fill = Counter()
            for r in kept:
                fill[r.sequence_id] += r.length
            assert max(fill.values()) <= 2048


def test_run_is_all_stages(spark, corpus, tmp_path):
    corpus.filter("doc_id < 60").write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert got.count() > 0


def test_odd_rows_and_no_rows(spark):
    for docs in (odd_documents(spark), no_documents(spark)):
        for name, before, after in staged(spark, docs):
            if name != "pack":
                assert after.columns == docs.columns
                # Whole rows, the columns with names of the operators' own included.
                assert {repr(r) for r in after.collect()} <= {repr(r) for r in before.collect()}
            assert before.count() or not after.count()


def test_a_document_in_two_sources_is_taken_as_each_says(spark):
    rng = random.Random(1)
    text = lambda n: " ".join(rng.choice(["ab", "cd", "ef"]) for _ in range(n))
    rows = [(i, text(300), "en", "a", 1) for i in range(40)] + [(100 + i, text(900), "en", "b", 1) for i in range(40)]
    rows += [(i, t, "en", "b", 1) for i, t, _, _, _ in rows[:40]]
    docs = spark.createDataFrame(rows, DOCS)
    taken = Counter()
    for r in mixing.mix(docs).collect():
        taken[r.doc_id, r.source] += -(-r.taken // r.size)
    assert any(taken[i, "a"] != taken[i, "b"] for i in range(40))
    for some in (docs, docs.repartition(5)):
        assert Counter((r.doc_id, r.source) for r in mixing.mixed_rows(some).collect()) == +taken


def test_of_rows_alike_in_id_and_text_the_same_one_stays(spark):
    rows = [(1, "one text", "en", s, n) for s in ("a", "b", None) for n in (1, 2)] + [(2, "other text", "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    for name, stage in corpus_pipeline.STAGES[1:3]:
        first, again = (sorted(stage(spark, d, "").collect(), key=repr) for d in (docs, docs.repartition(6)))
        assert first == again and len(first) == 2 and set(first) <= set(docs.collect()), name
