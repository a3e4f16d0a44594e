"""Operator 13 against a plain tree."""

import hashlib
import random
import zlib

import pytest

from corpusmill.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes, fanout=3):
    """(root, siblings of each node as one list of digests)."""
    proofs, at = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, owners = [], []
        for k in range(0, len(nodes), fanout):
            run = nodes[k:k + fanout]
            for i in range(len(run)):
                for leaf in at[k + i]:
                    proofs[leaf].append((run[:i], run[i + 1:]))
            up.append(sha(*run))
            owners.append([leaf for x in at[k:k + fanout] for leaf in x])
        nodes, at = up, owners
    return nodes[0], proofs


def leaf_of(row, text):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[1], row[2], row[3], text)))


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    inner, out = {}, []
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[4])))
        inner[s] = plain_tree([leaf_of(r, r[4]) for r in groups[s]])
    root, upper = plain_tree([inner[s][0] for s in names])
    for s, above in zip(names, upper):
        for r, proof in zip(groups[s], inner[s][1]):
            leaf, text = leaf_of(r, r[4]), r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            node = leaf_of(r, text)
            for left, right in proof + above:
                node = sha(*left, node, *right)
            out.append((r[0], leaf, inner[s][0], root, sha(*(h for a, b in proof + above for h in [*a, *b])), node, node == root))
    return sorted(out, key=str)


def sample(rng, sizes):
    rows, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "a\nb", "zwei\n\n", "日本 é", "x" * rng.randrange(20)])
            rows.append((i * 7 % 1009, s, rng.choice([None, "en", ""]), rng.choice([None, 3]), text, "extra", i))
            i += 1
    return rows


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, root long"


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_against_plain_tree(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rng = random.Random(levels)
    rows = sample(rng, {None: 4, "": 1, "a": 100, "b": 9, "B": 27, "é": 28, "hot": 250, "one": 1, "two": 2, "日": 10})
    rows += [rows[40], rows[40], (None, "a", None, None, None, None, None), (None, None, None, None, "t", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = merkle.verify(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


@pytest.mark.parametrize("n", [1, 4])
def test_few_groups_and_rows(spark, n):
    rows = sample(random.Random(n), {f"s{i}": 1 + i % 4 for i in range(n)})
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, merkle.verify(docs).collect()), key=str) == expected(rows)
    assert merkle.verify(docs.limit(0)).count() == 0


def test_proofs_fold_and_extra_columns_stay(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    leaves = spark.range(40).selectExpr("id", "cast(id % 2 as string) as g", "sha2(cast(id as string), 256) as leaf", "'k' as root__x")
    got = merkle.manifest(leaves, group="g", key="id", fanout=4)
    assert got.columns == ["id", "g", "leaf", "root__x", "subroot", "root", "proof"]
    assert got.where(merkle.fold("leaf", "proof") == got.root).count() == 40


def test_whole_table(spark):
    from corpusmill.llm.queries import QUERIES
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    got = QUERIES["op13_merkle_butterfly"](spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.collect()), key=str) == expected([tuple(r) for r in docs.collect()])
