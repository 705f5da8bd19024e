import hashlib
import random
import re
import time

import pytest

from odd_rows import no_documents, odd_documents
from stratum.llm import pii

SF_DIR = "/root/testdata/sf0.001"


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def plain_spans(text):
    """The forms taken literally."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def joined(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_forms_find_what_their_patterns_find():
    rng = random.Random(1)
    parts = ["1", "2.", "25", "0", "a", "@", ".", "b.c", "-", " ", "+", "+1", "(9", ")", "é", "@x.y", "255.", "4111 1111 1111 1111", "12345678", "%_", "\n"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_long_runs_take_linear_time():
    start = time.perf_counter()
    pii.base_spans("a" * 10**6 + " " + "1" * 500_000 + "." + "@" * 300_000 + "+1" + "-" * 300_000 + "1.1." * 100_000)
    assert time.perf_counter() - start < 20


def test_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = pii.op2_personal_data(spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = plain_spans(docs[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in base) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        assert set(joined(base).split(",")) <= set(r.spans.split(","))


@pytest.fixture
def cues(spark):
    rng = random.Random(4)
    words = "lorem ipsum dolor amet quis nisi velit esse sint anim".split()
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, f"{some(20)} write to user{i}@mail.example.com, {some(9)}") for i in range(12)]
    rows += [(20, f"{some(7)} write to user7(at)mail. {some(5)}"), (21, f"{some(7)} write to user8(at)mail {some(5)}")]
    # The same instances behind another cue, which only the second round can trust.
    rows += [(30 + i, f"{some(4)} reachable under user{7 + i}(at)mail {some(3)}") for i in range(2)]
    rows += [(40, f"{some(3)} reachable under user3@mail.example.com"), (41, f"{some(3)} reachable under user9(dot)net {some(2)}")]
    # A cue that ordinary words follow as well proves nothing.
    rows += [(50 + i, f"{some(3)} lorem ipsum user{i}@mail.example.com {some(3)}") for i in range(4)]
    rows += [(60 + i, "so lorem ipsum dolor and lorem ipsum amet") for i in range(20)] + [(90, "and lorem ipsum X12345 " + some(3))]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_contexts_discover_unseen_identifiers(cues):
    docs = {r.doc_id: r.text for r in cues.collect()}
    found = {}
    for r in pii.find_personal_data(cues).collect():
        base = set(joined(plain_spans(docs[r.doc_id])).split(","))
        new = [s.split(":") for s in r.spans.split(",") if s and s not in base]
        assert len(new) == r.n_discovered
        for kind, a, b in new:
            found[r.doc_id] = (kind, docs[r.doc_id][int(a) : int(b)])
    assert found == {
        20: ("email", "user7(at)mail"),
        21: ("email", "user8(at)mail"),
        30: ("email", "user7(at)mail"),
        31: ("email", "user8(at)mail"),
        41: ("email", "user9(dot)net"),
    }


@pytest.mark.parametrize("first_look, bits", [(1, 1 << 15), (1 << 40, 1 << 24)])
def test_the_first_look_and_the_size_of_filters_change_nothing(spark, cues, monkeypatch, first_look, bits):
    want = sorted(map(repr, pii.find_personal_data(cues).collect()))
    monkeypatch.setattr(pii, "FIRST_LOOK", first_look)
    monkeypatch.setattr(pii, "LEAST_BITS", bits)
    monkeypatch.setattr(pii, "REMEMBERED", 2)
    assert sorted(map(repr, pii.find_personal_data(cues).collect())) == want


@pytest.fixture
def writes(spark, monkeypatch):
    """(label, files, rows that a task reads and hands to Python at once) of what is stored, with many partitions that Spark leaves apart."""
    many = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    had = {k: spark.conf.get(k) for k in many}
    seen, plain = [], pii.stored

    def stored(frame, label, *more):
        at_once = [int(spark.conf.get(f"spark.sql.{k}")) for k in ("parquet.columnarReaderBatchSize", "execution.arrow.maxRecordsPerBatch")]
        out = plain(frame, label, *more)
        seen.append((label, len(out.inputFiles()), *at_once))
        return out

    monkeypatch.setattr(pii, "stored", stored)
    for k, v in many.items():
        spark.conf.set(k, v)
    yield seen
    for k, v in had.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("each, tasks", [(100_000, 1), (8, 3)])
def test_files_follow_the_instances(spark, cues, writes, monkeypatch, each, tasks):
    monkeypatch.setattr(pii, "EACH_TASK", each)
    found = {r.doc_id for r in pii.find_personal_data(cues).collect() if r.n_discovered}
    assert found == {20, 21, 30, 31, 41}
    files = [x[1] for x in writes if x[0] != "pii-rows"]
    assert len(files) > 8 and max(files) == tasks


def test_texts_are_read_in_small_batches(spark, cues, writes):
    default = (4096, 10_000)
    pii.find_personal_data(cues)
    assert {x[2:] for x in writes if x[0] in ("pii-rows", "pii-follow")} == {(500, 500)}
    assert {x[2:] for x in writes if x[0] in ("pii-edges", "pii-found")} == {default}


def test_followers_against_a_loop(spark):
    rng = random.Random(6)
    words = ["a", "b,", "C", "d.", "12345", "x@y.zz", "(e)"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(12))) for _ in range(60)]
    clean = lambda w: w.strip(".,;:!?()[]{}<>\"'").lower()
    want = {}
    for t in texts:
        tokens = t.split()
        before = ["\n", "\n", *map(clean, tokens)]
        for i, w in enumerate(tokens):
            if not any(c.isdigit() or c == "@" for c in w):
                want.setdefault(f"{before[i]} {before[i + 1]}", set()).add(clean(w))
    patterns = spark.createDataFrame([(p,) for p in [*want, "no such"]], "pattern string")
    got = pii.followed(spark.createDataFrame([(t,) for t in texts * 3], "text string"), patterns)
    assert {r.pattern: r.n for r in got.collect()} == {p: len(w) for p, w in want.items()}


def test_one_round_knows_the_first_cue_only(cues):
    found = {r.doc_id for r in pii.find_personal_data(cues, rounds=1).collect() if r.n_discovered}
    assert found == {20, 21}


def test_copies_do_not_count_against_a_pattern(spark):
    rows = [(i, f"please write to user{i}@mail.example.com today") for i in range(30)]
    rows += [(100, "please write to user7(at)mail today")] + [(1000 + i, "you may write to me instead") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.find_personal_data(frame).collect() if r.n_discovered}
    assert found == {100: "email:16:29"}
    # The same number of different ordinary words does count.
    rows = rows[:31] + [(1000 + i, "you may write to " + "abcdefghij"[i] * 3) for i in range(10)]
    assert not any(r.n_discovered for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect())


@pytest.mark.parametrize(
    "text, found",
    [
        ("call (555) 123-4567, now", ["(555) 123-4567"]),
        ("a (555 123 4567) b", ["555 123 4567"]),
        ("card 4111 1111 1111 1112.", ["4111 1111 1111 1112"]),
        ("4111 1111 1111 1112", ["4111 1111 1111 1112"]),
        ("no 555 1234  5678 90 12x345 7", ["555 1234", "5678 90", "12x345"]),
        ("at 12 345 67abc9 (1) - 22", ["12 345", "67abc9", "(1) - 22"]),
        ("x +(44) 20-7946 [1] y", ["+(44) 20-7946 [1]"]),
        ("k " + "z9" * 100 + " a1", ["z9" * 100]),
        ("to a@b.cd 555 1234", ["555 1234"]),
        ("a - . () 12 b", []),
    ],
)
def test_instances(text, found):
    assert [text[a:b] for a, b, k in sorted(pii.found_instances(text, pii.base_spans(text))) if k < 0] == found


def test_spaced_and_long_identifiers_are_discovered(spark):
    phones = [(i, f"You can call me +1 555 010 {1000 + i} soon") for i in range(30)]
    rows = phones + [(100, "You can call me (555) 123-4567 soon")]
    # After one word, after none, behind very long words, and longer than 64 characters.
    rows += [(200 + i, f"Phone: +1 555 020 {1000 + i} at work") for i in range(5)] + [(210, "Phone: 555 123 4567 at work")]
    rows += [(300 + i, f"+1 555 030 {1000 + i} is mine") for i in range(150)] + [(310_000, "[555] 123.4567 is mine")]
    far = "u" * 200
    rows += [(400 + i, f"so {far} {far} me{i}@mail.example.com") for i in range(5)] + [(410, f"so {far} {far} me7(at)mail")]
    rows += [(500 + i, f"we mail this me{i}@mail.example.com") for i in range(5)] + [(510, f"we mail this {'m' * 80}(at)mail1")]
    got = {}
    texts = dict(rows)
    for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        if r.n_discovered:
            kind, a, b = r.spans.split(":")
            got[r.doc_id] = (kind, texts[r.doc_id][int(a) : int(b)])
    assert got == {
        100: ("phone", "(555) 123-4567"),
        210: ("phone", "555 123 4567"),
        310_000: ("phone", "[555] 123.4567"),
        410: ("email", "me7(at)mail"),
        510: ("email", "m" * 80 + "(at)mail1"),
    }


def test_instances_take_linear_time():
    start = time.perf_counter()
    for text in ("(" * 300_000, "1 " * 300_000, "1" * 500_000 + "x", "((1" * 100_000 + "))", ") " * 200_000 + "1", "a@b.c " * 50_000, "- " * 200_000 + "x"):
        pii.instances(text, pii.base_spans(text))
    assert time.perf_counter() - start < 20


def test_odd_rows(spark):
    odd = odd_documents(spark)
    rows = pii.find_personal_data(odd).collect()
    assert len(rows) == odd.count()
    assert {r.spans for r in rows} == {""} and {r.base_sha256 for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert pii.find_personal_data(no_documents(spark)).count() == 0
    repeated = spark.createDataFrame([(None, "é a@b.cd"), (None, "é a@b.cd"), (1, "é a@b.cd")], "doc_id long, text string")
    assert [r.spans for r in pii.find_personal_data(repeated).collect()] == ["email:2:8"] * 3
