"""Near-duplicate vectors by NN-descent (operator 7).

Vectors that are equal under one label are one node with a count, named by a
hash of label and vector; rows get their results through label and vector, so
rows of one vec_id may hold different vectors. Neighbour lists of ``width`` entries start from random hyperplanes: nodes of a label
with the same signs form a group, which is split by hash where it is large;
each node takes its best neighbours of the group. A round then joins every
list with the lists it appears in: the members of a node's list and those that
list the node meet each other (neighbours of neighbours), in parts of at most
``PART`` members, so a node that many list is split too. Rounds go on while
more than ``quiet`` of the entries change.

The lists are not the result: a list holds ``width`` entries however many links
a node has, and a link may never be met. They tell which nodes lie together.
The members of a component of listed links are dealt into blocks of at most
about ``BLOCK``, the others of the label are dealt by hash. Every block is then
compared with every block of its label, except where the angle between their
centres exceeds their radii and the threshold's angle together, so that no link
can be between them. All links are counted; of those that connect, a spanning
forest per block and chunk goes on to the components. Only links of at least
``threshold`` count; the cosine is computed in double precision for each.

Defined results: a vector that is null, zero, or holds a null or non-finite
component, and one with a null label, has no link and is its own component.
Equal vectors of one label link with each other. A repeated row counts as a
vector of its own in the number of links, and so does a row that shares its
vec_id with another vector: each has its own links and component, named after
the smallest vec_id in it. A null vec_id takes no part and has null results.
Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import cut, python_ready
from corpusmill.llm.components import components
from corpusmill.llm.vectors import blobs, dense, matrix
from corpusmill.session import work_path

PART = 64
BLOCK = 1024
#: Members from which a component of listed links has blocks of its own.
GROUP = 128
#: Bytes of vectors that are broadcast at a time.
CHUNK = 32 << 20
EDGES = "a long, b long, sim double"


def units(vectors: DataFrame, width: int) -> DataFrame:
    """(vec_id, label, unit) of every row: its unit vector in double precision,
    null where the row takes no part."""
    label = vectors.schema["label"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows, x = dense(batch.column(2), width)
            top = np.abs(x).max(axis=1, initial=0)
            rows, x = rows[top > 0], x[top > 0] / top[top > 0][:, None]
            x = x / np.linalg.norm(x, axis=1)[:, None]
            at = np.full(batch.num_rows, -1)
            at[rows] = np.arange(len(rows))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), blobs(x).take(pa.array(at, mask=at < 0))],
                                             names=["vec_id", "label", "unit"])

    takes_part = F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.when(takes_part, F.col("embedding")).alias("embedding")) \
        .mapInArrow(run, f"vec_id long, label {label}, unit binary")


def _best(ids: np.ndarray, x: np.ndarray, width: int):
    """Edges from every row to its ``width`` best others."""
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    take = min(width, len(ids) - 1)
    if take < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    near = np.argpartition(-sims, take - 1, axis=1)[:, :take]
    return np.repeat(ids, take), ids[near].ravel(), np.take_along_axis(sims, near, axis=1).ravel()


def meet(groups: DataFrame, dim: int, width: int) -> DataFrame:
    """Best edges within each row's ``members`` (node, unit)."""
    def run(batches):
        for batch in batches:
            found = []
            for members in batch.column(0).to_pylist():
                seen = {m["node"]: m["unit"] for m in members}
                if len(seen) > 1:
                    found.append(_best(np.array(list(seen)), matrix(list(seen.values()), dim, "<f8"), width))
            if found:
                a, b, sim = (np.concatenate(c) for c in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(sim)], names=["a", "b", "sim"])

    return groups.select("members").mapInArrow(run, EDGES)


def hyperplanes(nodes: DataFrame, dim: int, sizes: dict, tables: int, seed: int, width: int) -> DataFrame:
    """Edges from groups of equal signs, ``tables`` groupings."""
    bits = {k: max(0, round(math.log2(max(1, n / 24)))) for k, n in sizes.items()}
    planes = np.random.default_rng(seed).normal(size=(tables, max([1, *bits.values()]), dim))
    shared = nodes.sparkSession.sparkContext.broadcast((planes, bits))

    def sign(batches):
        planes, bits = shared.value
        for batch in batches:
            x = matrix(batch.column(2), dim, "<f8")
            for t in range(tables):
                raised = (x @ planes[t].T > 0).astype(np.int64)
                keep = np.array([bits[v] for v in batch.column(1).to_pylist()])
                code = (raised * (np.arange(raised.shape[1]) < keep[:, None]) << np.arange(raised.shape[1])).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(np.full(len(x), t)), pa.array(code)],
                    names=["node", "label", "unit", "t", "code"])

    label = nodes.schema["label"].dataType.simpleString()
    coded = nodes.select("node", "label", "unit").mapInArrow(
        sign, f"node long, label {label}, unit binary, t long, code long")
    return meet(in_parts(coded, ["label", "t", "code"], seed), dim, width)


def in_parts(rows: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """Members (node, unit) by key, in parts of about ``PART`` by hash."""
    size = rows.groupBy(*keys).agg(F.ceil(F.count("*") / PART).alias("parts"))
    rows = rows.join(size, keys).withColumn("part", F.pmod(F.xxhash64("node", F.lit(seed)), F.col("parts")))
    return rows.groupBy(*keys, "part").agg(F.collect_list(F.struct("node", "unit")).alias("members"))


def kept_lists(edges: DataFrame, width: int) -> DataFrame:
    """(a, list): each node's ``width`` best neighbours, best first."""
    return edges.groupBy("a").agg(
        F.slice(F.sort_array(F.collect_set(F.struct("sim", "b")), asc=False), 1, width).alias("list"))


def unfolded(lists: DataFrame) -> DataFrame:
    return lists.select("a", F.explode("list").alias("e")).select("a", F.col("e.b").alias("b"), F.col("e.sim").alias("sim"))


def descent(lists: DataFrame, nodes: DataFrame, dim: int, width: int, rounds: int, quiet: float, seed: int) -> DataFrame:
    """Improve the lists until few entries change."""
    total = max(1, nodes.count())
    for r in range(rounds):
        edges = unfolded(lists)
        about = edges.select(F.col("a").alias("centre"), F.col("b").alias("node")) \
            .unionByName(edges.select(F.col("b").alias("centre"), F.col("a").alias("node"))) \
            .unionByName(nodes.select(F.col("node").alias("centre"), "node")).distinct() \
            .join(nodes.select("node", "unit"), "node")
        found = meet(in_parts(about, ["centre"], seed + r), dim, width)
        better = cut(kept_lists(edges.unionByName(found), width), "lists")
        was = lists.select("a", F.col("list.b").alias("old"))
        changed = better.join(was, "a", "left").agg(
            F.sum(F.size(F.array_except("list.b", F.coalesce("old", F.array().cast("array<bigint>")))))).first()[0] or 0
        lists = better
        if changed <= quiet * total * width:
            break
    return lists


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest row that each row of a symmetric link matrix is connected to."""
    root = np.arange(len(linked))
    while True:
        low = np.minimum(root, np.where(linked, root[None, :], len(root)).min(axis=1, initial=len(root)))
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _centre(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Direction of the middle of unit vectors and the largest angle to it."""
    middle = x.sum(axis=0)
    length = np.linalg.norm(middle)
    middle = middle / length if length > 1e-9 else x[0]
    return middle, float(np.arccos(np.clip(x @ middle, -1, 1)).max())


def packed_blocks(nodes: DataFrame, near: DataFrame, dim: int, threshold: float, parts: int) -> DataFrame:
    """One row per block: id, label, n, its nodes, units and copies, the node
    that each is connected to inside the block, centre and radius."""
    label = nodes.schema["label"].dataType.simpleString()
    large = near.groupBy("component").agg(F.count("*").alias("size")).where(F.col("size") >= GROUP).select("component")
    grouped = nodes.join(near.join(large, "component", "left_semi"), "node", "left")
    blocks = grouped.groupBy("label", "component").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    same = (F.col("g.label") == F.col("s.label")) & F.col("g.component").eqNullSafe(F.col("s.component"))
    dealt = grouped.alias("g").join(blocks.alias("s"), same).select("g.*", F.pmod(F.xxhash64("g.node"), F.col("blocks")).alias("block"))
    gathered = dealt.groupBy("label", "component", "block").agg(F.collect_list(F.struct("node", "unit", "copies")).alias("members"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                members = batch.column(1)[i].as_py()
                x = matrix([m["unit"] for m in members], dim, "<f8")
                ids = np.array([m["node"] for m in members], "<i8")
                copies = np.array([m["copies"] for m in members], "<i8")
                middle, radius = _centre(x)
                root = ids[_roots(x @ x.T >= threshold)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([len(ids)]),
                     *(pa.array([v.tobytes()], pa.binary()) for v in (ids, x, copies, root, middle)), pa.array([radius])],
                    names=["label", "n", "ids", "x", "copies", "root", "centre", "radius"])

    made = gathered.select("label", "members").mapInArrow(
        run, f"label {label}, n long, ids binary, x binary, copies binary, root binary, centre binary, radius double")
    return cut(made.repartition(parts).withColumn("id", F.monotonically_increasing_id()), "blocks")


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Those of the pairs that connect what the pairs before them did not."""
    up: dict[int, int] = {}

    def top(v):
        while up.setdefault(v, v) != v:
            up[v] = up[up[v]]
            v = up[v]
        return v

    kept = []
    for p, q in zip(a.tolist(), b.tolist()):
        s, t = top(p), top(q)
        if s != t:
            up[max(s, t)] = min(s, t)
            kept.append((p, q))
    return kept


def chunk_links(blocks: DataFrame, chunk: list, dim: int, threshold: float) -> DataFrame:
    """Links of every block to the blocks of a broadcast chunk: (node, n, null)
    counts a node's, (node, null, other) connects two."""
    theirs = {}
    for r in chunk:
        theirs.setdefault(r.label, []).append((
            np.frombuffer(r.ids, "<i8"), np.frombuffer(r.x, "<f8").reshape(-1, dim), np.frombuffer(r.copies, "<i8"),
            np.frombuffer(r.root, "<i8"), np.frombuffer(r.centre, "<f8"), r.radius))
    shared = blocks.sparkSession.sparkContext.broadcast(theirs)
    angle = math.acos(max(-1.0, min(1.0, threshold))) + 1e-6

    def run(batches):
        of_label = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                label, raw = batch.column(0)[i].as_py(), [batch.column(k)[i].as_py() for k in range(1, 7)]
                others = of_label.get(label, [])
                if not others:
                    continue
                ids, root, weights = (np.frombuffer(raw[k], "<i8") for k in (0, 2, 3))
                x, centre, radius = np.frombuffer(raw[1], "<f8").reshape(-1, dim), np.frombuffer(raw[4], "<f8"), raw[5]
                apart = np.arccos(np.clip(np.array([o[4] for o in others]) @ centre, -1, 1))
                n = np.zeros(len(ids), np.int64)
                ends = [np.stack([ids, root])[:, ids != root]]
                for k in np.flatnonzero(apart <= angle + radius + np.array([o[5] for o in others])):
                    theirs, y, copies, top = others[k][:4]
                    linked = x @ y.T >= threshold
                    if theirs[0] == ids[0]:  # the block itself
                        np.fill_diagonal(linked, False)
                        n += linked @ copies
                        continue
                    if not linked.any():
                        continue
                    n += linked @ copies
                    p, q = np.nonzero(linked)
                    ends.append(np.unique(np.stack([root[p], top[q]]), axis=1))
                some = n > 0
                pairs = np.concatenate(ends, axis=1)
                pairs = np.array(_forest(pairs[0], pairs[1]), np.int64).reshape(-1, 2)
                count, joined = int(some.sum()), len(pairs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([ids[some], pairs[:, 0]])),
                     pa.array([*n[some].tolist(), *[None] * joined], pa.int64()),
                     pa.array([*[None] * count, *pairs[:, 1].tolist()], pa.int64())], names=["node", "n", "other"])

    return blocks.select("label", "ids", "x", "root", "copies", "centre", "radius") \
        .mapInArrow(run, "node long, n long, other long")


def all_links(blocks: DataFrame, dim: int, threshold: float) -> DataFrame:
    """``chunk_links`` of all chunks, written one after the other. The driver
    holds one chunk (``CHUNK`` bytes of vectors) and a number per block."""
    spark = blocks.sparkSession
    path = work_path(spark, "block-links")
    spark.createDataFrame([], "node long, n long, other long").write.parquet(path)
    waiting: list = []
    known = blocks.select("id", "label", "n").orderBy("label", "id").collect()
    for k, r in enumerate(known):
        waiting.append(r)
        if k + 1 == len(known) or (sum(w.n for w in waiting) + known[k + 1].n) * dim * 8 > CHUNK:
            chunk = blocks.where(F.col("id").isin([w.id for w in waiting])).collect()
            mine = blocks.where(F.col("label").isin(list({w.label for w in waiting})))
            chunk_links(mine, chunk, dim, threshold).write.mode("append").parquet(path)
            waiting = []
    return spark.read.schema("node long, n long, other long").parquet(path)


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, width: int = 10, tables: int = 6, rounds: int = 4,
                    quiet: float = 0.01, seed: int = 11) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row."""
    spark = vectors.sparkSession
    python_ready(spark)
    dim = max(1, vectors.agg(F.max(F.size("embedding"))).first()[0] or 0)
    rows = cut(units(vectors, dim), "units")
    nodes = cut(rows.where("unit is not null").groupBy("label", "unit").agg(F.count("*").alias("copies"))
                .withColumn("node", F.xxhash64("label", "unit")), "nodes")
    sizes = {r.label: r.n for r in nodes.groupBy("label").agg(F.count("*").alias("n")).collect()}
    edges = hyperplanes(nodes, dim, sizes, tables, seed, width)
    lists = descent(cut(kept_lists(edges, width), "lists"), nodes, dim, width, rounds, quiet, seed)
    listed = unfolded(lists).where(F.col("sim") >= threshold).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    parts = max(1, sum(sizes.values()) // (2 * BLOCK))
    blocks = packed_blocks(nodes, components(listed), dim, threshold, parts)
    links = all_links(blocks, dim, threshold)
    near = components(links.where("other is not null"), "node", "other")
    counted = links.where("n is not null").groupBy("node").agg(F.sum("n").alias("n"))
    of_node = nodes.select("node", "label", "unit", "copies").join(near, "node", "left").join(counted, "node", "left") \
        .select("label", "unit", F.coalesce("component", "node").alias("component"),
                (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    found = cut(rows.join(of_node, ["label", "unit"], "left").select("vec_id", "component", "n_links"), "members")
    names = found.where("component is not null").groupBy("component").agg(F.min("vec_id").alias("name"))
    component_id = F.coalesce("name", "vec_id")
    return found.join(names, "component", "left").select(
        "vec_id", F.when(F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        component_id.alias("component_id"), (component_id == F.col("vec_id")).alias("kept"))
