"""Joins, repeats, searches and the pipeline against brute force."""

import hashlib
import math
import random
import re
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusmill.llm import cover_tree, jaccard, nn_descent, repeats
from corpusmill.llm.common import cut
from corpusmill.llm.components import components
from corpusmill.llm.shingles import shingle_sets

DOCS = "doc_id long, text string, lang string, source string, n_chars int, n long, h1 long, k long, component string"


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None, 1, 2, 3, "x") for i, t in rows], DOCS).repartition(4)


def _words(rng, n, pool=4000):
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def _merge(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] \
        + [(500, i) for i in range(501, 600)] + [(7, 7), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame([*pairs, (None, 3), (4, None)], "a long, b long")).collect()}
    want = _merge({x for p in pairs for x in p}, pairs)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: want[x] for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_component_rounds_of_a_rising_chain(spark, monkeypatch):
    rounds = []
    module = sys.modules[components.__module__]
    monkeypatch.setattr(module, "cut", lambda df, name: rounds.append(name) or cut(df, name))
    chain = spark.range(1, 65).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components(chain).collect()
    assert len(got) == 65 and {r.component for r in got} == {1}
    assert rounds.count("component-map") <= 12


def _near_rows(rng):
    rows, i = [(0, None), (1, ""), (2, " \t\n "), (3, "One two"), (4, "one TWO"), (5, "one two three"), (6, "x")], 10
    for n in (4, 12, 20, 60, 200, 200, 900):
        base = _words(rng, n)
        for edits in (0, 0, 1, 2, 3, 5, 8, max(1, n // 60)):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(n)] = f"e{rng.randrange(10 ** 6)}"
            rows.append((i, " ".join(copy)))
            i += 1
    for _ in range(60):  # a group of near copies of near copies
        copy = rows[39][1].split(" ")
        copy[rng.randrange(len(copy))] = f"e{rng.randrange(10 ** 6)}"
        rows.append((i, "\n".join(copy).upper()))
        i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80)])
def test_jaccard_join_against_all_pairs(spark, words, percent):
    rows = _near_rows(random.Random(words))
    got = {r.doc_id: r for r in jaccard.join_components(_frame(spark, [*rows, (None, "no id"), rows[0]]), words, percent).collect()}
    split = re.compile(r"[^\x20\x09-\x0D]+")
    sets = {}
    for i, t in rows:
        w = split.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    ids = sorted(sets)
    pairs = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = _merge(ids, pairs)
    assert len(set(want.values())) < len(ids) - 60
    assert {i: got[i].component_id for i in ids} == want
    assert {i: got[i].n_shingles for i in ids} == {i: len(s) for i, s in sets.items()}
    assert got[None].component_id is None and got[None].n_shingles == 1


def test_jaccard_empty_and_representatives(spark):
    assert jaccard.join_components(_frame(spark, [])).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (3, "other text here"), (None, "a b c d e f"),
            (4, None), (5, "")]
    left = jaccard.representatives(_frame(spark, rows), 5, 80)
    assert left.columns == _frame(spark, rows).columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == [1, 3, 4, 5, None]


def test_jaccard_sets_to_verify_are_not_shuffled_by_rows_that_occur_once(spark, monkeypatch):
    plans, rows = [], _near_rows(random.Random(3))

    def watched(df, name):
        if name == "members":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, name)
    monkeypatch.setattr(jaccard, "cut", watched)
    once = {r.doc_id: r.component_id for r in jaccard.join_components(_frame(spark, rows)).collect()}
    assert plans and not any("first(members" in p for p in plans)
    plans.clear()
    again = jaccard.join_components(_frame(spark, rows + rows[:40] * 3)).collect()
    assert plans and any("first(members" in p for p in plans)  # only sets of repeated rows
    assert len(again) == len(rows) + 120 and {r.doc_id: r.component_id for r in again} == once


def test_shingles_of_short_and_mixed_texts():
    texts = [b"A b\tc", b"", b"a b", b"a  b ", "É é a".encode(), b"x y z x y z"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    sets = shingle_sets(data, np.cumsum([0, *map(len, texts)]), 3)
    assert [len(s) for s in sets] == [1, 0, 1, 1, 1, 3]
    assert (sets[2] == sets[3]).all() and sets[2] != sets[0]


def _brute_repeats(rows, length):
    seen = {}
    for t in rows:
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] = seen.get(t[i:i + length], 0) + 1
    out = []
    for t in rows:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1).sum())
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return out


@pytest.mark.parametrize("in_task", [0, 2000])
def test_repeated_strings_against_brute_force(spark, monkeypatch, in_task):
    monkeypatch.setattr(repeats, "IN_TASK", in_task)
    rng = random.Random(4)
    passages = [" ".join(_words(rng, 30)) for _ in range(4)]
    texts = [None, "", "short", "a" * 700, "ab" * 300, passages[0] + "é" * 90, passages[0][5:] + "é" * 300]
    for _ in range(50):
        parts = [rng.choice(passages)[rng.randrange(40):] if rng.random() < 0.6 else " ".join(_words(rng, 25)) for _ in range(4)]
        texts.append("".join(parts))
    texts += [texts[10], texts[10], texts[11] + "!"]
    rows = list(enumerate(texts))
    got = repeats.without_repeats(_frame(spark, [*rows]), length=100, v=64, digest=True).collect()
    want = _brute_repeats([(t or "").encode() for t in texts], 100)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == dict(enumerate(want))
    assert sum(w[1] > 0 for w in want) > 20


def test_common_phrases_do_not_look_up_their_counts(spark, monkeypatch):
    """However many texts hold a phrase, no join deals its rows out by it; a
    context that occurs once counts only where its windows occur elsewhere."""
    plans, rng = {}, random.Random(12)

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return cut(df, name)
    monkeypatch.setattr(repeats, "cut", watched)
    common = " ".join(_words(rng, 90))
    texts = [" ".join(_words(rng, 12)) + common + " ".join(_words(rng, 12)) for _ in range(40)] + [common, common, "ab" * 400]
    for at in range(150, 350, 20):  # every window of x occurs again, in two parts
        x = " ".join(_words(rng, 120))[:500]
        texts += [x, "<" + x[:at + 100] + ">", "[" + x[at + 1:] + "]"]
    got = repeats.without_repeats(_frame(spark, list(enumerate(texts))), length=100, v=64, digest=True).collect()
    want = _brute_repeats([t.encode() for t in texts], 100)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == dict(enumerate(want))
    assert all(w[1] == 500 for w in want[43::3])
    assert "Aggregate" in plans["covered"] and not re.search(r"Join \[s#\w+, c#\w+\]", plans["covered"])


def test_common_phrases_have_no_row_in_each_text(spark, monkeypatch):
    """A phrase that stands again and again in every text is counted in the
    tasks; places are told by run, and single contexts and edges come off."""
    made, rng = {}, random.Random(14)

    def watched(df, name):
        made[name] = cut(df, name)
        return made[name]
    monkeypatch.setattr(repeats, "cut", watched)
    monkeypatch.setattr(repeats, "HELD", 500)
    common = " ".join(_words(rng, 90))
    texts = [" ".join(_words(rng, 20)) + common + str(i) + "-" * 300 + common[i:] + " ".join(_words(rng, 20)) for i in range(60)]
    texts += ["-" * 900, "-" * 900, "-" * 99, None, texts[0]]
    got = repeats.without_repeats(_frame(spark, list(enumerate(texts))), length=100, v=64, digest=True).collect()
    want = _brute_repeats([(t or "").encode() for t in texts], 100)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == dict(enumerate(want))
    phrases = made["parse"].where("runs is null").agg(F.count("*").alias("n"), F.sum("w").alias("w")).first()
    assert phrases.w > 60 * 200 and phrases.n < 4000
    runs = made["parse"].where("runs is not null").select("k", F.size("runs").alias("n")).collect()
    assert len(runs) == len({r.k for r in runs}) == 59 and max(r.n for r in runs) < 8


def test_repeats_of_400_bytes_go_and_shorter_passages_stay(spark):
    """A passage of over 50 words that has less than 400 bytes is no repeated
    string of 400 bytes, in how many texts it may stand."""
    rng = random.Random(13)
    short, long = ("word " + " ".join(f"{rng.randrange(10 ** 5):06d}" for _ in range(57)))[:394], "".join(_words(rng, 200))[:400]
    texts = [f"{i}<{passage}>{i}" for passage in (short, long) for i in range(10, 15)]
    got = repeats.without_repeats(_frame(spark, list(enumerate(texts))), digest=True).collect()
    want = _brute_repeats([t.encode() for t in texts], 400)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == dict(enumerate(want))
    assert len(short.split()) > 50 and [w[1] > 0 for w in want] == [False] * 5 + [True] * 5


def test_repeats_small_segments_and_edge_rows(spark):
    rng = random.Random(9)
    text = ("".join(_words(rng, 120)) + "".join(_words(rng, 120)) * 2).encode()
    whole = list(repeats.groups(np.frombuffer(text, np.uint8), 100, 64))
    parts = list(repeats.groups(np.frombuffer(text, np.uint8), 100, 64, segment=150))
    cover = np.concatenate([np.arange(f, e) + at for _, at, _, first, end in parts for f, e in zip(first, end)])
    assert (cover == np.arange(len(text) - 99)).all()
    anchors = {at + w: at + a for _, at, anchor, first, end in parts for a, f, e in zip(anchor, first, end) for w in range(f, e)}
    assert anchors == {w: a for _, _, anchor, first, end in whole for a, f, e in zip(anchor, first, end) for w in range(f, e)}
    assert repeats.without_repeats(_frame(spark, []), digest=True).count() == 0
    same = repeats.without_repeats(_frame(spark, [(1, "z" * 50), (1, "z" * 50), (None, "q" * 500), (2, None)]))
    assert same.columns == DOCS.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    assert {(r.doc_id, r.text) for r in same.collect()} == {(1, "z" * 50), (None, ""), (2, None)}


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, c, 1) for i, v, c in rows],
                                 "vec_id long, embedding array<float>, label int, node int").repartition(3)


def _vector_rows(n=300, dim=8):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(n, dim))
    base[100:160] = base[100]
    base[160:200] = base[160] + rng.normal(size=(40, dim)) * 0.01
    rows = [(i, [float(x) for x in base[i]], int(i % 3)) for i in range(n)]
    rows += [(900, None, 1), (901, [None] + [1.0] * (dim - 1), 1), (902, [float("nan")] * dim, 1), (903, [0.0] * dim, 1),
             (904, [float("inf")] * dim, 2), (905, rows[5][1], None), (906, [1.0, 2.0], 0), (907, [], 0), (920, rows[5][1], 2)]
    return rows


def test_top_k_against_brute_force(spark):
    rows = _vector_rows()
    got = {}
    for r in cover_tree.top_k(_vectors(spark, [*rows, rows[7], (None, [1.0] * 8, 1)]), "vec_id % 20 = 0", k=20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    points = {}
    for i, v, _ in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            points[i] = np.zeros(8)
            points[i][:len(v)] = np.floor(64 * np.array(v, np.float32).astype(float))
    for q in (i for i in points if i % 20 == 0):
        best = sorted((-int(points[q] @ v), i) for i, v in points.items() if i != q)[:20]
        assert sorted(got.pop(q)) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert not got


def test_top_k_few_rows(spark):
    few = cover_tree.top_k(_vectors(spark, [(0, [1.0, 2.0], 0), (1, [1.0, 0.0], 0), (20, [2.0, 2.0], 0)]), "vec_id % 20 = 0", k=20)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in few.collect()) == [(0, 1, 20), (0, 2, 1), (20, 1, 0), (20, 2, 1)]
    assert cover_tree.top_k(_vectors(spark, []), "vec_id % 20 = 0").count() == 0
    assert cover_tree.top_k(_vectors(spark, [(1, [1.0], 0)]), "vec_id % 20 = 0").count() == 0


def test_top_k_over_several_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "CHUNK", 64)
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(12, 6))[rng.integers(0, 12, 600)] + 0.05 * rng.normal(size=(600, 6)),
                        rng.normal(size=(300, 6))])
    x[100:160] = x[7]  # copies: ties beyond k
    points = np.floor(64 * x.astype(np.float32).astype(float)).astype(int)
    got = {}
    for r in cover_tree.top_k(_vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)]), "vec_id % 20 = 0", k=20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert len(got) == 45
    for q, rows in got.items():
        best = sorted((-int(points[q] @ points[i]), i) for i in range(900) if i != q)[:20]
        assert sorted(rows) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]


def test_top_k_range_of_scores_and_ids(spark):
    schema = "vec_id STRING, embedding ARRAY<DOUBLE>"
    large = spark.createDataFrame([("0", [2.0 ** 24, 2.0 ** 20]), ("1", [-(2.0 ** 24), 1.0]), ("x", [1.0, 1.0])], schema)
    assert [tuple(r) for r in cover_tree.top_k(large, "vec_id = 0").collect()] == [(0, 1, 1, -(2 ** 60) + 2 ** 32)]
    beyond = spark.createDataFrame([("0", [1e20, 0.0]), ("1", [1.0, 0.0])], schema)
    with pytest.raises(Exception, match="vector 0 is too long"):
        cover_tree.top_k(beyond, "vec_id = 0").collect()


def test_cover_tree_covers_and_separates():
    x = np.random.default_rng(1).normal(size=(700, 2))
    todo = [cover_tree.cover_tree(x, leaf=8)]
    while todo:
        node = todo.pop()
        assert (np.linalg.norm(x[node.points] - node.centre, axis=1) <= node.radius + 1e-9).all()
        if node.children:
            assert sorted(p for c in node.children for p in c.points) == sorted(node.points)
            todo.extend(node.children)


def test_near_duplicate_vectors_against_all_pairs(spark):
    rows = _vector_rows()
    got = {r.vec_id: r for r in nn_descent.near_duplicates(_vectors(spark, rows), 0.93).collect()}
    use = {i: (np.array(v, np.float32).astype(float), c) for i, v, c in rows
           if v and c is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    use = {i: (np.pad(v, (0, 8 - len(v))), c) for i, (v, c) in use.items()}
    pairs = [(a, b) for a, (x, c) in use.items() for b, (y, d) in use.items()
             if a < b and c == d and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93]
    want = _merge([i for i, _, _ in rows], pairs)
    links = {i: sum(i in p for p in pairs) for i in want}
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == {i: (links[i], want[i]) for i in want}
    assert all(r.kept == (r.component_id == r.vec_id) for r in got.values())
    assert nn_descent.near_duplicates(_vectors(spark, [])).count() == 0


def _exact_links(spark, rows, **how):
    """Result rows and what all pairs give, for usable rows of distinct ids."""
    got = {r.vec_id: r for r in nn_descent.near_duplicates(_vectors(spark, rows), 0.93, **how).collect()}
    x = np.array([v for _, v, _ in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([c for _, _, c in rows])
    linked = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    ids = [i for i, _, _ in rows]
    want = _merge(ids, [(ids[a], ids[b]) for a, b in np.argwhere(linked).tolist()])
    return got, {i: (int(n), want[i]) for i, n in zip(ids, linked.sum(axis=1))}


def _around(rng, centre, n, spread=0.1):
    noise = rng.normal(size=(n, len(centre)))
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    return centre + spread * noise


def test_rows_of_one_id_with_different_vectors(spark):
    a, b = [1.0] + [0.0] * 7, [0.0, 1.0] + [0.0] * 6
    rows = [(1, a, 0), (1, b, 0), (2, b, 0), (3, a, 0), (4, b, 0), (5, a, 1)]
    got = sorted(map(tuple, nn_descent.near_duplicates(_vectors(spark, rows)).collect()))
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 1, False), (4, 2, 1, False), (5, 0, 5, True)]


def test_links_between_two_dense_groups(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "BLOCK", 16)
    monkeypatch.setattr(nn_descent, "GROUP", 8)
    rng = np.random.default_rng(5)
    a, b = np.eye(64)[0], np.eye(64)[0] * 0.955 + np.eye(64)[1] * math.sqrt(1 - 0.955 ** 2)
    far = np.eye(64)[2]
    x = np.concatenate([_around(rng, a, 40), _around(rng, b, 40), _around(rng, far, 40)])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(200, x[0].tolist(), 1)]
    got, want = _exact_links(spark, rows)
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == want
    assert {want[i][1] for i in range(80)} == {0} and want[0][0] > 70 and want[200] == (0, 200)


def test_links_that_the_lists_miss_are_found(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    for k in range(0, 300, 2):
        x[k + 1] = _around(rng, x[k], 1, 0.385)[0]
    got, want = _exact_links(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)], tables=1, rounds=1)
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == want
    assert 100 < sum(n for n, _ in want.values())


def test_pipeline_stages_keep_the_columns_and_empty_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES][:2] == ["language", "quality"]
    extra = docs.withColumn("score", F.lit(1)).withColumn("k", F.lit("x"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, extra.limit(0), "/root/testdata/sf0.001").columns == extra.columns
        extra = stage(spark, extra, "/root/testdata/sf0.001").cache()
        assert extra.columns == [*docs.columns, "score", "k"] and extra.count() > 100
    assert extra.where("text is null or text = ''").count() == 0


def test_pipeline_packs_what_its_stages_keep(spark, tmp_path):
    """End to end: planted rows go where they should, every token of the
    others is packed once, gapless and within the capacity."""
    import public_tokenizers
    from tokenizers import Tokenizer
    source = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = source.where("length(text) between 900 and 1500 and lang = 'en'").orderBy("doc_id").first().text
    planted = [(10 ** 6, text), (10 ** 6 + 1, None), (10 ** 6 + 2, "12 34 !! ??"), (None, text + " and one more line")]
    source.unionByName(spark.createDataFrame([(i, t, "en", "s", 9) for i, t in planted], source.schema)) \
          .write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet("/root/testdata/sf0.01/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), None
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
    kept = docs.select("doc_id", "text").collect()
    assert {10 ** 6 + k for k in range(3)}.isdisjoint(r.doc_id for r in kept) and 700 < len(kept) < source.count()
    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    lengths = {}
    for p in pieces:
        lengths[p.doc_id] = lengths.get(p.doc_id, 0) + p.length
    assert lengths == {r.doc_id: len(bpe.encode(r.text, add_special_tokens=False).ids) + 1 for r in kept}
    bins = {}
    for p in pieces:
        bins.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


def test_pipeline_without_labels(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.quality(spark, docs, str(tmp_path)).count() == docs.count()


def test_pipeline_catches_planted_rows(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    good = [r.text for r in docs.where("length(text) between 900 and 1500 and lang = 'en'").orderBy("doc_id").limit(3).collect()]
    planted = [(10 ** 6, good[0] + " more"), (10 ** 6 + 1, None), (10 ** 6 + 2, "12 34 !! ??"), (10 ** 6 + 3, good[1])]
    with_planted = docs.unionByName(spark.createDataFrame(
        [(i, t, "en", "s", len(t or "")) for i, t in planted], docs.schema))
    first = corpus_pipeline.language(spark, with_planted, "/root/testdata/sf0.01")
    kept = {r.doc_id for r in first.select("doc_id").collect()}
    assert 10 ** 6 + 1 not in kept and 10 ** 6 + 2 not in kept and 10 ** 6 in kept
    assert len(kept) >= 0.99 * docs.count()
    near = corpus_pipeline.near_duplicates(spark, first, "")
    left = {r.doc_id for r in near.select("doc_id").collect()}
    assert 10 ** 6 not in left and 10 ** 6 + 3 not in left
