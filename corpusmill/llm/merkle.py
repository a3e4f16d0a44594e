"""Merkle manifest by butterfly exchange (operator 13).

Leaves are ordered by key within their group; every ``fanout`` consecutive
nodes become their parent until one is left. The tree is built in blocks of
``fanout ** LEVELS`` leaves, aligned so that a block is a subtree:

1. Places: a range shuffle puts the leaves of all groups in order, each task
   numbers its leaves by group, and the tasks' counts are added up. A group of
   any size is spread over as many tasks as its rows need.
2. Blocks: each block's subtree is built in one step of bounded size, which
   gives every leaf its siblings inside the block, and the block its root.
3. Butterfly: in round ``r`` the ``fanout`` blocks whose numbers differ in
   digit ``r`` (base ``fanout``) alone meet. Each brings the root of its
   aligned run of ``fanout ** r`` blocks, takes the others' as siblings and
   hashes the parent itself. Blocks of one run so hash the same ancestors
   redundantly, and after the last round each holds its whole upper proof and
   the group's root; nothing goes back down. Numbers up to the next power that
   no block has are stood in for by blocks without a root, which learn the
   roots of the runs they belong to and pass them on (fewer than ``fanout``
   times the blocks).
4. The groups' roots, ordered by group, are the leaves of a tree of the same
   make, whose proofs end the leaves' proofs.

H is the lowercase hex SHA-256 of its inputs' concatenation. A proof is an
array of (left, right), from the leaf up: the siblings before and after the
node, concatenated.

Defined results: a null field is ``-``, which no value encodes to. Rows of
equal key are ordered by leaf; repeated rows are leaves each. A null key sorts
first, a null group first of groups and apart from the empty one. A group of
one leaf has the leaf as its root and adds no sibling. An empty table has no
rows. Extra columns are carried along; names of work columns end in ``__``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import cut, python_ready

#: Levels of a block's subtree: 3 ** 7 leaves with the fanout of the manifest.
LEVELS = 7
PROOF = "array<struct<left:string,right:string>>"
_SIBLINGS = pa.struct([("left", pa.string()), ("right", pa.string())])


def leaf_hash(fields: list[Column]) -> Column:
    """H of the fields: ``-`` if null, else UTF-8 length, ``:`` and value."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*map(one, fields)), 256)


def fold(leaf: str, proof: str) -> Column:
    """The root that a leaf and its siblings give."""
    return F.expr(f"aggregate({proof}, {leaf}, (node, s) -> sha2(concat(s.left, node, s.right), 256))")


def proof_hash(proof: str) -> Column:
    return F.expr(f"sha2(array_join(transform({proof}, s -> concat(s.left, s.right)), ''), 256)")


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` (group__, key__, leaf, ...) with pos__, the place in the
    group, and size__, the group's number of leaves."""
    columns = leaves.columns
    once = cut(leaves.withColumn("row__", F.monotonically_increasing_id()), "leaves")
    order = ["group__", "key__", "leaf", "row__"]
    schema = once.withColumn("task__", F.lit(0)).withColumn("nth__", F.lit(0).cast("long")).schema

    def number(batches):
        task, group, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            names = batch.column(batch.schema.get_field_index("group__"))
            new = np.ones(len(names), bool)
            new[1:] = np.array(names.slice(1).to_pylist(), object) != np.array(names.slice(0, max(0, len(names) - 1)).to_pylist(), object)
            if not len(names):
                continue
            if names[0].as_py() != group:
                at = 0
            index = np.arange(len(names))
            first = np.maximum.accumulate(np.where(new, index, 0))
            nth = index - first + np.where(first == 0, at, 0)
            group, at = names[-1].as_py(), int(nth[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(names), task, np.int32)), pa.array(nth)],
                                             names=[*batch.schema.names, "task__", "nth__"])

    made = cut(once.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(number, schema), "numbered")
    counts = made.groupBy("group__", "task__").agg(F.count("*").alias("n"))
    group = Window.partitionBy("group__")
    before = group.orderBy("task__").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("group__", "task__", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base__"),
                         F.sum("n").over(group).alias("size__"))
    return made.join(base, ["group__", "task__"]) \
        .select(*columns, (F.col("base__") + F.col("nth__")).alias("pos__"), "size__")


def subtree(leaves: list[str], fanout: int, levels: int | None) -> tuple[list[list[tuple[str, str]]], str]:
    """(siblings of every node level by level, root). All ``levels`` are
    built, or until one node is left if that is None."""
    siblings, nodes = [], leaves
    while len(nodes) > 1 if levels is None else len(siblings) < levels:
        of, up = [], []
        for k in range(0, len(nodes), fanout):
            run = nodes[k:k + fanout]
            of += [("".join(run[:i]), "".join(run[i + 1:])) for i in range(len(run))]
            up.append(_hash("".join(run)))
        siblings.append(of)
        nodes = up
    return siblings, nodes[0]


def blocks(rows: DataFrame, fanout: int) -> DataFrame:
    """``rows`` (placed) with block__, proof (inside the block) and top__, the
    block's root."""
    width = fanout ** LEVELS
    rows = rows.withColumn("block__", F.expr(f"pos__ div {width}"))
    schema = rows.withColumn("proof", F.array().cast(PROOF)).withColumn("top__", F.lit("")).schema

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos__").combine_chunks()
        n = table.num_rows
        levels = LEVELS if table.column("size__")[0].as_py() > width else None
        siblings, top = subtree(table.column("leaf").to_pylist(), fanout, levels)
        depth = len(siblings)
        flat = pa.array([{"left": a, "right": b} for of in siblings for a, b in of], _SIBLINGS)
        start = np.cumsum([0, *map(len, siblings)])
        at = np.arange(n)[:, None] // np.array([fanout ** k for k in range(depth)], np.int64)[None, :] + start[None, :depth]
        proof = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * depth), flat.take(pa.array(at.ravel().astype(np.int64))))
        return table.append_column("proof", proof).append_column("top__", pa.array([top] * n, pa.string()))

    return rows.groupBy("group__", "block__").applyInArrow(build, schema)


def butterfly(tops: DataFrame, fanout: int) -> DataFrame:
    """(group__, block__, upper__, root__) from (group__, block__, blocks__,
    node): every block's siblings above it and the group's root."""
    rounds = F.expr(f"case when blocks__ > 1 then cast(ceil(round(ln(blocks__) / ln({fanout}), 9)) as int) else 0 end")
    state = tops.withColumn("rounds__", rounds)
    power = F.pow(F.lit(fanout), F.col("rounds__")).cast("long")
    state = state.withColumn("turn__", F.explode(F.array(*map(F.lit, range(fanout))))) \
        .withColumn("node", F.when(F.col("turn__") == 0, F.col("node"))) \
        .withColumn("block__", F.col("block__") + F.col("turn__") * F.col("blocks__")) \
        .where((F.col("turn__") == 0) | (F.col("block__") < power)).drop("turn__") \
        .withColumn("upper__", F.array().cast(PROOF))
    state = cut(state, "butterfly")
    last = state.agg(F.max("rounds__")).first()[0] or 0
    for r in range(last):
        low = fanout ** r
        meet = Window.partitionBy("group__", F.expr(f"block__ div {low * fanout}"), F.expr(f"block__ % {low}"))
        run = F.array_sort(F.collect_list(F.struct(F.col("block__").alias("b"), F.col("node").alias("h"))).over(meet))
        state = state.withColumn("run__", F.when(F.col("rounds__") > r, run))
        said = "array_join(transform(filter(run__, x -> {}), x -> x.h), '')"
        pair = F.expr(f"named_struct('left', {said.format('x.b < block__')}, 'right', {said.format('x.b > block__')})")
        every = F.expr(said.format("true"))
        state = state.withColumn("upper__", F.when(F.col("run__").isNull(), F.col("upper__")).otherwise(F.array_append("upper__", pair))) \
            .withColumn("node", F.when(F.col("run__").isNull(), F.col("node")).when(every != "", F.sha2(every, 256))).drop("run__")
        state = cut(state, "butterfly")
    return state.where("block__ < blocks__").select("group__", "block__", "upper__", F.col("node").alias("root__"))


def tree(leaves: DataFrame, fanout: int) -> DataFrame:
    """``leaves`` (group__, key__, leaf, ...) with proof (up to the group's
    root) and root__."""
    columns = leaves.columns
    built = cut(blocks(placed(leaves), fanout), "blocks")
    width = fanout ** LEVELS
    tops = built.where(f"pos__ % {width} = 0").select(
        "group__", "block__", F.expr(f"(size__ + {width - 1}) div {width}").alias("blocks__"), F.col("top__").alias("node"))
    upper = butterfly(tops, fanout)
    return built.join(upper, ["group__", "block__"]).select(
        *columns, F.concat("proof", "upper__").alias("proof"), "root__")


def manifest(leaves: DataFrame, group: str = "source", key: str = "doc_id", fanout: int = 3) -> DataFrame:
    """``leaves`` (with a column ``leaf``) and, per row, subroot, root and
    proof up to it."""
    python_ready(leaves.sparkSession)
    columns = leaves.columns
    # no group, then the empty one, then the others in the order of their bytes
    named = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    inner = tree(leaves.withColumn("group__", named).withColumn("key__", F.col(key)), fanout)
    inner = cut(inner.select(*columns, "group__", "proof", F.col("root__").alias("subroot")), "subtrees")
    tops = inner.groupBy("group__").agg(F.min("subroot").alias("leaf"))
    outer = tree(tops.select(F.lit("").alias("group__"), F.col("group__").alias("key__"), "leaf"), fanout)
    outer = outer.select(F.col("key__").alias("group__"), F.col("proof").alias("outer__"), F.col("root__").alias("root"))
    return inner.join(outer, "group__").select(
        *columns, "subroot", "root", F.concat("proof", "outer__").alias("proof"))


def verify(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` and, per row, whether the row as offered still
    folds to the root. Of every second document by crc32 of its id, the row
    offered has lost the line breaks of its text."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    even = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0, F.lit(False))
    offered = F.when(even & F.contains("text", F.lit("\n")), leaf_hash([*fields, F.replace("text", F.lit("\n"), F.lit(""))]))
    leaves = docs.select("doc_id", "source", leaf_hash([*fields, F.col("text")]).alias("leaf"), offered.alias("offered"))
    made = manifest(leaves).withColumn("offered", F.coalesce("offered", "leaf"))
    found = made.select("doc_id", "leaf", "subroot", "root", proof_hash("proof").alias("proof_sha256"),
                        fold("offered", "proof").alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
