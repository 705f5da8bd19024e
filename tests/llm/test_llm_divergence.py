import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from compare import oracle_rows, spark_rows
from odd_rows import no_documents, odd_documents
from stratum.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def by_hand(rows, least, top):
    """The definition, term by term, from (text, lang, source)."""
    counts, docs, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        sources[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, names in sources.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        v = len(kept)

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * v) for t in kept}

        whole = Counter()
        for s in names:
            whole.update(counts[lang, s])
        p, q = {s: shares(counts[lang, s]) for s in names}, shares(whole)
        for s in names:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in names if o != s]
            marks = [(q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(marks)[:top])):
                out |= {(lang, s, part, item.decode(), -value, i) for i, (value, item) in enumerate(found, 1)}
    return out


def result(frame):
    rows = frame.select("lang", "source", "part", "item", "value", "rank").collect()
    assert len(rows) == len({tuple(r) for r in rows})
    return {tuple(r) for r in rows}


@pytest.mark.parametrize("seed, least, top", [(0, 1, 3), (1, 2, 50), (2, 5, 4), (3, 30, 7)])
def test_small_documents_against_the_definition(spark, seed, least, top):
    rng = random.Random(seed)
    words = [w + x for w in ("a", "Ab", "é", "É", "\U0001f600", "z", "日本", "ﬁ", "q") for x in ("", "x", "Y", "ß", "\x80")]
    rows = [
        (
            rng.choice([" ", "-", "\x7f", "[", "_"]).join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.randrange(9))),
            rng.choice(["en", "de", "", None]),
            rng.choice(["s", "t", "ü", "\U0001f600", "", None]),
        )
        for _ in range(120)
    ]
    rows += [("only here", "xx", "alone"), (None, "yy", "a"), ("", "yy", "b"), ("one two", "zz", None), ("one", "zz", "c")]
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    assert result(divergence.source_divergence(frame, least, top)) == by_hand(rows, least, top)


def test_ties_that_cross_the_last_rank(spark):
    words = [f"w{i:03}" for i in range(200)]
    rows = [(" ".join(words[:120]), "en", "a"), (" ".join(words[80:]), "en", "b"), ("w000 w000 w001", "en", "c")]
    frame = spark.createDataFrame(rows * 2, "text string, lang string, source string")
    assert result(divergence.source_divergence(frame, 1, 50)) == by_hand(rows * 2, 1, 50)


def test_a_long_text_is_split_in_slices(spark, monkeypatch):
    text = "Wort " * 50 + "x" * 300 + " -- " * 30 + "Ende"
    want = [t.lower().encode() for t in TERM.findall(text)]
    monkeypatch.setattr(divergence, "SLICE", 16)
    assert [t for some in divergence.terms_of(text.encode()) for t in some] == want
    assert list(divergence.terms_of(b"")) == []


def test_counts_handed_over_in_parts_are_whole(monkeypatch):
    monkeypatch.setattr(divergence, "HELD_TERMS", 3)
    names = {"lang": ["a"] * 4, "source": ["s", "s", "t", "s"], "data": [b"a b a", b"a c d", b"a", b"a"]}
    batch = pa.RecordBatch.from_pydict(names)
    rows = [r for part in divergence._counted(iter([batch, batch])) for r in part.to_pylist()]
    n, docs = Counter(), Counter()
    for r in rows:
        n[r["source"], r["term"]] += r["n"]
        docs[r["source"], r["term"]] += r["docs"]
    assert len(rows) > len(n)
    assert (n["s", b"a"], docs["s", b"a"], n["t", b"a"], docs["t", b"a"]) == (8, 6, 2, 2)


def test_counts_beyond_64_bits_are_exact(spark):
    frame = spark.createDataFrame([(3 * 10**14 + 1, 10**15 + 7, 9)], "n long, total long, terms long")
    got = frame.selectExpr(divergence._share("n", "total")).first()[0]
    assert got == 1 + 10**9 * (3 * 10**14 + 6) // (10**15 + 7 + 45)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_agrees_with_sql(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    assert spark_rows(divergence.op12_source_divergence(spark, sf_dir)) == oracle_rows(sf_dir, divergence.ORACLE)


def test_odd_rows(spark):
    odd = odd_documents(spark)
    rows = [(r.text, r.lang, r.source) for r in odd.collect()]
    for least in (1, 2):
        assert result(divergence.source_divergence(odd, least)) == by_hand(rows, least, 50)
    assert divergence.source_divergence(no_documents(spark)).count() == 0
