"""Exact top-k inner products with a dual-tree cover-tree search (operator 6).

Vectors are quantised to integers, equal ones become one point that keeps its
``k + 1`` smallest ids (no list can hold more of them; each task keeps that
many before the shuffle). Points are dealt to blocks by their nearest of at
most ``CENTRES`` centres (points taken by hash); a block of more than
``CHUNK`` points is split by hash, so one dense region does not make one task.
Every chunk, of data as of queries, is indexed by a cover tree: a node covers
its points within its radius, its children are points of it more than half
that radius apart which cover it within half. A subtree of at most ``LEAF``
points is not divided further, and one whose points do not gather (sixteen
children with fewer than four points each) is cut into runs of ``LEAF``.

Search of a query chunk against a data chunk descends both trees at once. A
pair of nodes with centres q and d and radii r and s has no inner product
above ``q.d + |q| s + |d| r + r s``; it is pruned where that is below the
worst k-th score of the node's queries. First each query chunk meets the
chunks of its own block, which gives every query a k-th score; then the pairs
of chunks that these scores do not rule out, by block and by chunk, are
joined and searched, and the lists are merged. Scores are integers, bounds
are rounded up, and equality is never pruned, so results and ties are exact.

Defined results: a vector that is null or holds a null or non-finite
component takes no part; a shorter one is filled up with zeros; fewer than k
candidates give fewer rows; a repeated id counts once per vector; a null id
takes no part. Other columns are not read. Scores are 64-bit integers, so a
vector whose quantised length is ``MAX_LENGTH`` or more fails the query, which
names its id: below that, no score and no sum on the way to it can overflow.
Ids are cast to long; one that is no number is null and takes no part.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import cut, python_ready
from corpusmill.llm.vectors import blobs, dense, matrix

CENTRES = 1024
CHUNK = 8192
BLOCKS = 16
LEAF = 128


class Node:
    __slots__ = ("centre", "norm", "radius", "children", "points")

    def __init__(self, centre, radius, points):
        self.centre, self.norm, self.radius = centre, float(np.linalg.norm(centre)), radius
        self.points, self.children = points, []


def cover_tree(x: np.ndarray, leaf: int = LEAF) -> Node:
    """Tree over the rows of ``x``; a node's points are row numbers."""
    def node(points, centre):
        away = np.linalg.norm(x[points] - x[centre], axis=1)
        return Node(x[centre], float(away.max()), points)

    root = node(np.arange(len(x)), 0)
    todo = [root]
    while todo:
        at = todo.pop()
        if len(at.points) <= leaf or at.radius == 0:
            continue
        free, groups = at.points, []
        while len(free):
            # the first free point covers all within half the radius
            near = np.linalg.norm(x[free] - x[free[0]], axis=1) <= at.radius / 2
            groups.append(free[near])
            free = free[~near]
            if len(groups) >= 16 and len(at.points) - len(free) < 4 * len(groups):
                # the points do not gather at this scale: runs of them will do
                groups = np.array_split(at.points, -(-len(at.points) // leaf))
                break
        if len(groups) > 1:
            at.children = [node(g, g[0]) for g in groups if len(g)]
            todo.extend(at.children)
    return root


class Lists:
    """The k best (score, id) of each query, best first."""

    def __init__(self, ids, k):
        self.ids, self.k = ids, k
        self.best = [[] for _ in ids]
        self.kth = np.full(len(ids), -np.inf)

    def offer(self, rows, scores, owners):
        """Scores of some queries against points with the given id lists."""
        hit = scores >= self.kth[rows][:, None]
        for i in np.flatnonzero(hit.any(axis=1)):
            row = rows[i]
            cols = np.flatnonzero(hit[i])
            if len(cols) > 4 * self.k:
                low = np.partition(scores[i, cols], len(cols) - self.k - 1)[len(cols) - self.k - 1]
                cols = cols[scores[i, cols] >= low]
            found = [(-int(scores[i, c]), o) for c in cols for o in owners[c] if o != self.ids[row]]
            best = sorted({*self.best[row], *found})[:self.k]
            self.best[row] = best
            if len(best) == self.k:
                self.kth[row] = -best[-1][0]


def dual_search(queries: Node, q: np.ndarray, data: Node, d: np.ndarray, owners: list, lists: Lists) -> None:
    """Search two trees together."""
    def bounds(a, nodes):
        centres = np.stack([n.centre for n in nodes])
        radius, norm = np.array([n.radius for n in nodes]), np.array([n.norm for n in nodes])
        top = centres @ a.centre + a.norm * radius + norm * a.radius + a.radius * radius
        return top + 1e-6 * (1 + np.abs(top))

    def visit(a, nodes):
        top = bounds(a, nodes)
        order = np.argsort(-top, kind="stable")
        left = [nodes[i] for i in order if top[i] >= lists.kth[a.points].min()]
        if not left:
            return
        if a.children:
            for child in a.children:
                visit(child, left)
            return
        for node in left:
            if bounds(a, [node])[0] < lists.kth[a.points].min():
                continue
            if node.children:
                visit(a, node.children)
            else:
                lists.offer(a.points, q[a.points] @ d[node.points].T, [owners[p] for p in node.points])

    visit(queries, [data])


MAX_LENGTH = 2.0 ** 31  # of a quantised vector; |q.d| <= |q||d| < 2^62


def quantised(vectors: DataFrame, scale: int, width: int) -> DataFrame:
    """(vec_id, point): usable vectors as little-endian 64-bit integers."""
    def run(batches):
        for batch in batches:
            rows, x = dense(batch.column(1), width)
            x = np.floor(scale * x)
            with np.errstate(over="ignore"):
                long = np.flatnonzero((x * x).sum(axis=1) >= MAX_LENGTH ** 2)
            if len(long):
                raise ValueError(f"vector {batch.column(0)[int(rows[long[0]])]} is too long for 64-bit scores")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), blobs(x.astype("<i8"))], names=["vec_id", "point"])

    return vectors.where("vec_id is not null and embedding is not null") \
        .select(F.expr("try_cast(vec_id as long)").alias("vec_id"), "embedding").where("vec_id is not null") \
        .mapInArrow(run, "vec_id long, point binary")


def points(rows: DataFrame, k: int) -> DataFrame:
    """Distinct points with their k + 1 smallest ids."""
    def few(batches):
        for batch in batches:
            seen: dict[bytes, list[int]] = {}
            for i, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.setdefault(p, []).append(i)
            ids = [sorted(set(v))[:k + 1] for v in seen.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(ids, pa.list_(pa.int64()))],
                                             names=["point", "ids"])

    return rows.mapInArrow(few, "point binary, ids array<long>").groupBy("point").agg(
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"))


def placed(rows: DataFrame, centres: np.ndarray, width: int) -> DataFrame:
    """Adds the block: the nearest centre. The centres are broadcast."""
    shared = rows.sparkSession.sparkContext.broadcast(centres)
    schema = rows.select("*").schema.add("block", "integer")
    name = schema.names

    def run(batches):
        c = shared.value
        for batch in batches:
            x = matrix(batch.column("point"), width, "<i8").astype(np.float64)
            block = np.argmin((c * c).sum(axis=1) - 2 * (x @ c.T), axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block)], names=name)

    return rows.mapInArrow(run, schema)


def indexed(rows: DataFrame, width: int, ids: str, chunk: int) -> DataFrame:
    """One row per chunk: block, part, its cover tree and points, a centre
    and radius that cover it."""
    sizes = rows.groupBy("block").agg(F.ceil(F.count("*") / chunk).alias("parts"))
    rows = rows.join(F.broadcast(sizes), "block")  # at most CENTRES rows
    rows = rows.withColumn("part", F.pmod(F.xxhash64("point", ids), F.col("parts")).cast("int"))

    def build(key, table):
        x = matrix(table.column("point"), width, "<i8").astype(np.float64)
        tree = cover_tree(x)
        blob = pickle.dumps((tree, x, table.column(ids).to_pylist()))
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()),
                         "centre": [tree.centre.tolist()], "radius": [tree.radius], "tree": pa.array([blob], pa.binary())})

    return rows.groupBy("block", "part").applyInArrow(
        build, "block int, part int, centre array<double>, radius double, tree binary")


def searched(pairs: DataFrame, k: int) -> DataFrame:
    """Lists of (query_id, vec_id, score) for rows (queries, tree[, known])."""
    def run(batches):
        for batch in batches:
            for mine, theirs, known in zip(*(c.to_pylist() for c in batch.columns)):
                qtree, q, ids = pickle.loads(mine)
                dtree, d, owners = pickle.loads(theirs)
                lists = Lists(ids, k)
                if known:
                    floor = {r["query_id"]: r["kth"] for r in known}
                    lists.kth = np.array([floor.get(i, -np.inf) for i in ids], dtype=np.float64)
                exact = np.abs(q).max(initial=1) * np.abs(d).max(initial=1) * q.shape[1] < 2 ** 53
                dual_search(qtree, q if exact else q.astype(np.int64), dtree, d if exact else d.astype(np.int64),
                            owners, lists)
                rows = [(i, v, -s) for i, best in zip(ids, lists.best) for s, v in best]
                cols = np.array(rows, dtype=np.int64).reshape(-1, 3).T
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["query_id", "vec_id", "score"])

    return pairs.select("queries", "tree", "known").mapInArrow(run, "query_id long, vec_id long, score long")


def best(found: DataFrame, k: int) -> DataFrame:
    """(query_id, best): each query's k best, from bounded partial lists."""
    return found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_set(
        F.struct((-F.col("score")).alias("neg"), "vec_id"))), 1, k).alias("best"))


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` largest inner products of
    the rows that satisfy ``is_query`` with all other rows."""
    spark = vectors.sparkSession
    python_ready(spark)
    width = vectors.agg(F.max(F.size("embedding"))).first()[0]
    width = max(1, width or 0)
    rows = cut(quantised(vectors, scale, width), "quantised")
    data = cut(points(rows, k), "points")
    n = data.count()
    wanted = min(CENTRES, max(-(-n // CHUNK), min(BLOCKS, n // 512 + 1)))
    # the centres come from a bounded sample: the first points by hash
    sample = data.orderBy(F.xxhash64("point"), "point").limit(wanted).select("point").collect()
    centres = matrix([bytes(r.point) for r in sample], width, "<i8").astype(np.float64) if sample else np.zeros((1, width))
    chunks = cut(indexed(placed(data, centres, width), width, "ids", CHUNK), "data-chunks")
    asked = rows.where(is_query).select("vec_id", "point").distinct()
    groups = cut(indexed(placed(asked, centres, width), width, "vec_id", CHUNK // 2)
                 .select(F.col("block").alias("q_block"), F.col("part").alias("q_part"),
                         F.col("centre").alias("q_centre"), F.col("radius").alias("q_radius"),
                         F.col("tree").alias("queries")), "query-chunks")
    none = F.lit(None).cast("array<struct<query_id:long,kth:long>>")
    home = groups.join(chunks.select(F.col("block").alias("q_block"), "tree"), "q_block").withColumn("known", none)
    first = cut(best(searched(home, k), k), "home-lists")

    # k-th scores known so far, by query chunk
    def members(batches):
        for batch in batches:
            for b, p, blob in zip(*(c.to_pylist() for c in batch.columns)):
                ids = pickle.loads(blob)[2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b] * len(ids), pa.int32()), pa.array([p] * len(ids), pa.int32()), pa.array(ids, pa.int64())],
                    names=["q_block", "q_part", "query_id"])

    of_chunk = groups.select("q_block", "q_part", "queries").mapInArrow(members, "q_block int, q_part int, query_id long")
    kth = F.when(F.size("best") == k, -F.element_at("best", -1)["neg"])
    known = of_chunk.join(first.select("query_id", kth.alias("kth")), "query_id", "left").groupBy("q_block", "q_part").agg(
        F.min(F.coalesce("kth", F.lit(-(1 << 62)))).alias("worst"),
        F.filter(F.collect_list(F.struct("query_id", "kth")), lambda r: r["kth"].isNotNull()).alias("known"))
    groups = cut(groups.join(known, ["q_block", "q_part"]), "bounded-queries")
    blocks = chunks.groupBy("block").agg(F.count("*").alias("parts")).select("block").collect()  # at most CENTRES
    every = F.explode(F.array(*[F.lit(r.block) for r in blocks]).cast("array<int>")) if blocks \
        else F.explode(F.array().cast("array<int>"))
    meta = groups.select("q_block", "q_part", "q_centre", "q_radius", "worst", every.alias("block")) \
                 .where("block <> q_block") \
                 .join(chunks.select("block", "part", "centre", "radius"), "block")
    dot = F.aggregate(F.zip_with("q_centre", "centre", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    norm = lambda c: F.sqrt(F.aggregate(F.col(c), F.lit(0.0), lambda s, v: s + v * v))
    top = dot + norm("q_centre") * F.col("radius") + norm("centre") * F.col("q_radius") + F.col("radius") * F.col("q_radius")
    pairs = cut(meta.where(top + 1 + 1e-6 * F.abs(top) >= F.col("worst")).select("q_block", "q_part", "block", "part"),
                "pairs")
    rest = pairs.join(groups.select("q_block", "q_part", "queries", "known"), ["q_block", "q_part"]) \
                .join(chunks.select("block", "part", "tree"), ["block", "part"])
    late = searched(rest, k)
    early = first.select("query_id", F.explode("best").alias("b")).select(
        "query_id", F.col("b.vec_id").alias("vec_id"), (-F.col("b.neg")).alias("score"))
    return best(early.unionByName(late), k).select("query_id", F.posexplode("best").alias("pos", "b")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"),
        (-F.col("b.neg")).alias("score"))
