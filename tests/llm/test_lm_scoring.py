"""Operator 12: counts and base score by definition, model by hand."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import gru, lm_scoring, word_counts

SCHEMA = "doc_id long, text string, score string, n_tokens double, word int"


def split(text):
    return (text or "").encode().lower().split()


def expected_base(rows):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score by the formula."""
    def held(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter()
    for r in rows:
        if not held(r[0]):
            c.update([*split(r[1]), None])
    total, types = sum(c.values()), len(c)
    out = []
    for r in rows:
        tokens = [*split(r[1]), None]
        base = sum(math.log10((c[w] + 1) / (total + types + 1)) for w in tokens)
        out.append((r[0], held(r[0]), len(tokens), sum(c[w] > 0 for w in tokens), total, base))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)] + ["É", "été", "x" * 100, "a\x1cb", "日本"]
    out = [(i, " ".join(rng.choice(words[:1 + rng.randrange(405)]).title() + rng.choice(["", "\n", "\t\x0b"])
                        for _ in range(rng.randrange(60)))) for i in range(120)]
    out += [(120, None), (121, ""), (122, " \n"), (123, "one two " * 4000), (124, "unseen-%d " % 1), (None, "No id"), (3, out[3][1]), (3, out[3][1])]
    return [(*r, "extra", 0.5, 1) for r in out]


@pytest.mark.parametrize("head", [1 << 18, 20, 0])
def test_scores_by_definition(spark, rows, head):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = lm_scoring.score_documents(docs, head)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert [t for _, t in got.dtypes] == ["bigint", "boolean", "bigint", "bigint", "bigint", "double", "double"]
    got = sorted(map(tuple, got.collect()), key=str)
    want = sorted(expected_base(rows), key=str)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=1e-9)
    assert all(r[6] < 0 and math.isfinite(r[6]) for r in got)


def test_no_rows_and_no_training_rows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    assert lm_scoring.score_documents(docs.limit(0)).count() == 0
    held = lm_scoring.score_documents(docs.where(lm_scoring.remainder() == 2)).collect()
    assert held and all((r.held_out, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 0, 0, 0.0, 0.0) for r in held)
    assert sorted(r.n_tokens for r in held) == sorted(r[2] for r in expected_base(rows) if r[1])


def small_model(seed=1):
    """A model with weights that are not zero, in double precision."""
    rng = np.random.default_rng(seed)
    p = gru.fresh(np.arange(100, 0, -1) + 1.0, 30.0)
    return {k: v.astype(np.float64) + (rng.normal(0, 0.3, v.shape) if k not in ("word_b",) else 0) for k, v in p.items()}


def by_hand(p, text):
    """Log probability of one text, one token at a time."""
    h, total, other = np.zeros(gru.HIDDEN), 0.0, len(p["x"]) - 2
    for before, now in zip([-1, *text[:-1]], text):
        x, a, n = p["x"][before], h @ p["h"], gru.HIDDEN
        z, r = 1 / (1 + np.exp(-(x[:n] + a[:n]))), 1 / (1 + np.exp(-(x[n:2 * n] + a[n:2 * n])))
        c = np.tanh(x[2 * n:] + r * (a[2 * n:] + p["hn"]))
        h = (1 - z) * c + z * h
        logits = h @ p["class_w"] + p["class_b"]
        cls = gru.CLASSES if now == other else now // gru.SLOTS
        total += logits[cls] - np.log(np.exp(logits).sum())
        if now != other:
            inside = h @ p["word_w"][cls] + p["word_b"][cls]
            total += inside[now % gru.SLOTS] - np.log(np.exp(inside).sum())
    return total


def random_texts(rng, n, longest=90):
    return [np.append(rng.integers(1, 101, rng.integers(0, longest)), 0).astype(np.int32) for _ in range(n)]


@pytest.mark.parametrize("window,widest", [(1, 1), (7, 5), (32, 64), (1000, 2)])
def test_state_is_carried_across_windows_and_not_across_texts(window, widest):
    p, texts = small_model(), random_texts(np.random.default_rng(2), 30)
    assert gru.score(p, texts, window, widest) == pytest.approx([by_hand(p, t.tolist()) for t in texts], rel=1e-5)


def test_next_token_probabilities_add_up_to_one():
    p = small_model()
    hidden = np.random.default_rng(3).normal(size=(4, gru.HIDDEN))
    every = np.arange(101)  # the end, 99 words, all other words
    total = [np.exp(gru.output(p, np.repeat(h[:, None], 101, axis=1), every)[0]).sum() for h in hidden]
    assert total == pytest.approx([1.0] * 4, rel=1e-6)


def test_gradient_against_differences():
    p, rng = small_model(), np.random.default_rng(5)
    ids, ins, owner = gru.lanes(random_texts(rng, 6, 12), 3)
    mask, h = owner >= 0, rng.normal(0, 0.5, (gru.HIDDEN, ids.shape[1]))
    grad, (at, rows), _ = gru.gradient(p, ins, ids, mask, h)
    grad["x"] = np.zeros_like(p["x"])
    grad["x"][at] = rows

    def loss():
        return -gru.output(p, gru.columns(gru.states(p, ins, h), mask), ids[mask])[0].mean()

    for name in ("h", "hn", "class_w", "class_b", "word_w", "word_b", "x"):
        flat, g = p[name].ravel(), grad[name].ravel()
        for k in np.argsort(-np.abs(g))[:4]:
            was = flat[k]
            flat[k] = was + 1e-4
            up = loss()
            flat[k] = was - 1e-4
            down = loss()
            flat[k] = was
            assert (up - down) / 2e-4 == pytest.approx(g[k], rel=1e-5, abs=1e-9), name


def test_head_is_bounded_and_whole(spark):
    docs = spark.createDataFrame([(" ".join(f"w{i}" for i in range(k)),) for k in range(1, 60)], "text string")
    for head in (0, 5, 100):
        found = word_counts.corpus(docs, head)
        rest = {bytes(r.word): r.n for r in found.rest.collect()}
        counts = {b"w%d" % i: 59 - i for i in range(59)}
        assert len(found.head) == min(head, 59) and {**dict(zip(found.head, found.head_n)), **rest} == counts
        assert (found.texts, found.total, found.types) == (59, sum(counts.values()) + 59, 60)


def test_model_beats_the_base_on_held_out_texts(spark):
    from corpusmill.llm.queries import QUERIES
    got = QUERIES["op12_recurrent_scores"](spark, "/root/testdata/sf0.01")
    sums = got.where("held_out").agg(F.count("*"), F.sum("n_tokens"), F.sum("base_score"), F.sum("score")).first()
    assert sums[0] > 100 and sums[3] / sums[1] > sums[2] / sums[1] + 0.05
