"""Operator 11 against the definition of a run."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import periodic_runs as pr


def brute_runs(words, min_length, min_exponent):
    """Maximal stretches of every period; the smallest period of each."""
    out, n = {}, len(words)
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_length, min_exponent * q):
                out.setdefault((i, j + q - i), q)  # periods ascend: the smallest stays
            i = j
    return sorted(((s, length, q) for (s, length), q in out.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=70), min_size=1, max_size=4),
       st.sampled_from([(24, 3), (6, 2), (9, 3)]))
def test_runs_of_random_words(texts, least):
    assert pr.runs_of(texts, *least) == [brute_runs(t, *least) for t in texts]


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_planted_periods(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(6):
        words = [b"%d" % rng.randrange(30) for _ in range(rng.randrange(40))]
        for _ in range(4):
            unit = [b"%d" % rng.randrange(3) for _ in range(rng.randint(1, 14))]
            words += (unit * 8)[:rng.randint(1, 8 * len(unit))] + [b"x"] * rng.randrange(3)
        texts.append(words)
    assert pr.runs_of(texts, 24, 3) == [brute_runs(t, 24, 3) for t in texts]


def test_long_texts_of_one_word_and_of_a_repeated_passage():
    assert pr.runs_of([[b"a"] * 200_000], 24, 3) == [[(0, 200_000, 1)]]
    passage = [b"%d" % i for i in range(500)]
    assert pr.runs_of([passage * 100 + [b"z"] + passage], 24, 3) == [[(0, 50_000, 500)]]
    apart = [w for i in range(300) for w in [*passage[:20], b"s%d" % i]]
    assert pr.runs_of([apart], 24, 3) == [[]]


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]
    runs = brute_runs(words, 24, 3)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    digest = hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
    left = hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], digest, left)


def test_query_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["a", "b", "cc", "é", "日本"]) + rng.choice(["", ".", "\t", "\n"])
                         for _ in range(rng.randrange(150))), "en", 1.0) for i in range(150)]
    rows += [(150, None, None, None), (151, "", "x", 2.0), (152, " \n\t ", "x", 2.0), (153, "a\x1cb\x85 c " * 30, None, 1.0),
             (154, "one " * 5000, "x", 1.0), (154, "one " * 5000, "x", 1.0), (None, "u v " * 20, "x", 1.0), (-7, "w " * 24, "x", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, length double").repartition(3)
    got = pr.run_digests(pr.find_runs(pr.with_periodic_tails(docs)))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    assert sorted(map(tuple, got.collect()), key=str) == sorted((expected(*r[:2]) for r in rows), key=str)
    empty = docs.limit(0)
    assert pr.run_digests(pr.find_runs(pr.with_periodic_tails(empty))).count() == 0


def test_whole_table_against_brute_force(spark):
    from corpusmill.llm.queries import QUERIES
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_periodic_runs"](spark, "/root/testdata/sf0.001").collect()
    short = {r.doc_id for r in docs if len((r.text or "").split()) <= 1500}
    assert len(got) == len(docs) and len(short) > 100
    assert sorted(tuple(r) for r in got if r.doc_id in short) == sorted(expected(*r) for r in docs if r.doc_id in short)
    assert sum(r.n_runs > 0 for r in got) > 10
