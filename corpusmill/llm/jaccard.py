"""N-gram Jaccard join with rare-first prefix filtering (operator 2).

1. Counters: every task hashes its texts' distinct shingles into ``SLOTS``
   counters, which are added up over all documents. They give one order of
   shingles for all texts, rarest first (ties by hash). The order is the same
   everywhere, so a collision of counters only costs a little speed.
2. Sets: per text the set's size and hash, the prefix (the first
   ``n - ceil(t n) + 1`` shingles in that order) and a signature (how many
   shingles fall in each of ``PARTS`` ranges of the hash). Equal sets become
   one class, represented from here on by one row, however many copies.
3. Prefix join: classes meet on a prefix shingle that several hold, under the
   length filter, the positional filter (what can still be common after the
   two positions) and, once per pair, the suffix filter (the sum of the
   smaller counts of two signatures bounds the overlap). First every class meets one pivot of each of its
   shingles, the class that holds it at the smallest position; the links found
   are joined to components. Then only classes in different components meet:
   those outside a shingle's largest component against all of that shingle's.
   Pairs inside a component would not change it. So a large group of near
   copies costs about a pair per row, not a pair per two rows, and no link
   between components is lost.
4. Verification: each pair is taken once, whichever shingles produced it, and
   the two whole sets are intersected.

Nothing is capped: a shingle with very many rows is a skewed join key, split
by Spark. The only broadcast besides the counters (a fixed size) is the list
of texts to verify while it has at most ``BROADCAST_ROWS`` rows.

Defined results: a null or empty text, or one of separators only, has 0
shingles and its own doc_id as component. A null doc_id takes no part and has
a null component. Repeated rows give a row each. Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import cut, python_ready, slices, start_task, text_buffers
from corpusmill.llm.components import components
from corpusmill.llm.shingles import set_hash, shingle_sets

SLOTS = 1 << 20
SLICES = 64
PARTS = 16
BROADCAST_ROWS = 1_000_000


def _slot(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(SLOTS - 1)).astype(np.int64)


def counters(docs: DataFrame, words: int) -> np.ndarray:
    """How many texts hold a shingle, by counter; all documents count."""
    each = SLOTS // SLICES

    def count(batches):
        start_task()
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                for s in shingle_sets(*text_buffers(part.column(0)), words):
                    np.add.at(total, _slot(s), 1)
        if total.any():
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict({
                "slice": list(range(SLICES)), "task": [task] * SLICES,
                "counts": [zlib.compress(total[i * each:(i + 1) * each].tobytes(), 1) for i in range(SLICES)]})

    def add(key, rows):
        total = np.zeros(each, np.int64)
        for blob in rows.column("counts"):
            total += np.frombuffer(zlib.decompress(blob.as_py()), np.int64)
        return pa.table({"slice": [key[0].as_py()], "task": [key[1].as_py()],
                         "counts": [zlib.compress(total.tobytes(), 1)]})

    shape = "slice long, task long, counts binary"
    per_task = docs.select("text").mapInArrow(count, shape)
    for group in (F.col("task") % 64, F.lit(0).cast("long")):  # many tasks are added up in two steps
        per_task = per_task.withColumn("task", group).groupBy("slice", "task").applyInArrow(add, shape)
    out = np.zeros(SLOTS, np.int64)
    for r in per_task.collect():  # SLICES rows, SLOTS numbers in all
        out[r.slice * each:(r.slice + 1) * each] = np.frombuffer(zlib.decompress(r.counts), np.int64)
    return out


def sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Per row: doc_id, n_shingles, two set hashes, prefix, signature."""
    spark = docs.sparkSession
    order = spark.sparkContext.broadcast(np.minimum(counters(docs, words), np.iinfo(np.int32).max).astype(np.int32))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        start_task()
        for batch in batches:
            for part in slices(batch, 1):
                n, h1, h2, prefix, sig = [], [], [], [], []
                for s in shingle_sets(*text_buffers(part.column(1)), words):
                    n.append(len(s))
                    h1.append(set_hash(s, 1))
                    h2.append(set_hash(s, 2))
                    rare = np.argsort(order.value[_slot(s)], kind="stable")
                    prefix.append(s[rare[:len(s) + percent * len(s) // -100 + 1]].view(np.int64) if len(s) else s.view(np.int64))
                    sig.append(np.bincount((s >> np.uint64(60)).astype(np.int64), minlength=PARTS).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                     pa.array(prefix, pa.list_(pa.int64())), pa.array(sig, pa.list_(pa.int32()))],
                    names=["doc_id", "n", "h1", "h2", "prefix", "sig"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n long, h1 long, h2 long, prefix array<long>, sig array<int>")


def could_link(x: str, y: str, percent: int) -> Column:
    """Length and positional filter for two postings of one shingle."""
    return F.expr(f"""
        100 * least({x}.n, {y}.n) >= {percent} * greatest({x}.n, {y}.n)
        and {100 + percent} * (1 + least({x}.n - {x}.pos - 1, {y}.n - {y}.pos - 1)) >= {percent} * ({x}.n + {y}.n)""")


def suffix_filtered(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose signatures leave room for the overlap they need."""
    of = {c: classes.select(F.col("h1").alias(c), F.struct("n", "sig").alias(f"of_{c}")) for c in "ab"}
    return pairs.join(of["a"], "a").join(of["b"], "b").where(F.expr(f"""
        {100 + percent} * aggregate(zip_with(of_a.sig, of_b.sig, (p, q) -> least(p, q)), 0, (s, v) -> s + v)
            >= {percent} * (of_a.n + of_b.n)""")).select("a", "b")


def verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, twice: DataFrame, words: int,
             percent: int) -> DataFrame:
    """The pairs whose whole sets reach the similarity, each looked at once.
    ``twice``: the (doc_id, h1) that several rows have; only their sets are
    grouped, all others stay where they are read."""
    spark = docs.sparkSession
    needed = pairs.select(F.col("a").alias("h1")).union(pairs.select(F.col("b").alias("h1"))).distinct()
    wanted = cut(classes.select("h1", "doc_id").join(needed, "h1", "left_semi"), "to-verify")
    few = wanted.count() <= BROADCAST_ROWS
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        start_task()
        for batch in batches:
            for part in slices(batch, 1):
                got = shingle_sets(*text_buffers(part.column(1)), words)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([set_hash(s, 1) for s in got], pa.int64()),
                     pa.array([s.tobytes() for s in got], pa.binary())], names=["doc_id", "h1", "members"])

    def sets_of(chosen: DataFrame) -> DataFrame:
        ids, keys = chosen.select("doc_id").distinct(), chosen.select("doc_id", "h1")
        return docs.select("doc_id", "text").join(F.broadcast(ids) if few else ids, "doc_id", "left_semi") \
                   .mapInArrow(run, f"doc_id {id_type}, h1 long, members binary") \
                   .join(F.broadcast(keys) if few else keys, ["doc_id", "h1"], "left_semi").select("h1", "members")

    repeated = cut(wanted.join(twice, ["doc_id", "h1"], "left_semi"), "repeated-to-verify")
    members = sets_of(wanted.join(repeated, ["doc_id", "h1"], "left_anti"))
    if not repeated.isEmpty():
        members = members.unionByName(sets_of(repeated).dropDuplicates(["h1"]))
    members = cut(members, "members")
    both = pairs.join(members.select(F.col("h1").alias("a"), F.col("members").alias("x")), "a") \
                .join(members.select(F.col("h1").alias("b"), F.col("members").alias("y")), "b")

    def check(batches):
        start_task()
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                y = np.frombuffer(y.as_buffer(), np.uint64)
                place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int(np.count_nonzero(y[place] == x))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")],
                                             names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def ordered(found: DataFrame) -> DataFrame:
    return found.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def linked_classes(docs: DataFrame, made: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(classes, (node, component) of linked classes by set hash)."""
    named = made.where("n > 0 and doc_id is not null")
    classes = cut(named.groupBy("h1").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("prefix").alias("prefix"),
        F.first("sig").alias("sig")), "classes")
    twice = cut(named.groupBy("doc_id", "h1").count().where("count > 1").select("doc_id", "h1"), "repeated-rows")
    postings = classes.select("h1", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "token"))
    several = postings.groupBy("token").agg(F.count("*").alias("rows")).where("rows > 1").select("token")
    shared = cut(postings.join(several, "token", "left_semi"), "postings")
    pivots = shared.groupBy("token").agg(F.min(F.struct("pos", "h1", "n")).alias("pivot"))
    x = shared.select("token", F.struct("h1", "n", "pos").alias("x")).join(pivots, "token")
    star = ordered(x.where("x.h1 <> pivot.h1").where(could_link("x", "pivot", percent))
                   .select(F.col("x.h1").alias("p"), F.col("pivot.h1").alias("q")))
    star = cut(suffix_filtered(star, classes, percent), "star-pairs")
    links = cut(verified(docs, star, classes, twice, words, percent), "star-links")
    near = components(links)
    rows = shared.join(near.withColumnRenamed("node", "h1"), "h1", "left") \
                 .withColumn("component", F.coalesce("component", "h1"))
    rows = cut(rows, "component-postings")
    main = rows.groupBy("token", "component").agg(F.count("*").alias("k")) \
               .groupBy("token").agg(F.max(F.struct("k", "component")).alias("m"), F.count("*").alias("parts")) \
               .where("parts > 1").select("token", F.col("m.component").alias("main"))
    mixed = rows.join(main, "token")
    record = F.struct("h1", "n", "pos", "component")
    outside = mixed.where("component <> main").select("token", record.alias("x"))
    others = mixed.select("token", record.alias("y"))
    more = outside.join(others, "token").where("x.component <> y.component").where(could_link("x", "y", percent)) \
                  .select(F.col("x.h1").alias("p"), F.col("y.h1").alias("q"))
    more = suffix_filtered(ordered(more).join(star, ["a", "b"], "left_anti"), classes, percent)
    more = cut(more, "more-pairs")
    if not more.isEmpty():
        extra = verified(docs, more, classes, twice, words, percent)
        near = components(links.unionByName(extra))
    return classes, near


def join_components(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs``."""
    python_ready(docs.sparkSession)
    made = cut(sets(docs, words, percent), "sets")
    classes, near = linked_classes(docs, made, words, percent)
    grouped = classes.select("h1", "doc_id").join(near.withColumnRenamed("node", "h1"), "h1", "left") \
                     .withColumn("component", F.coalesce("component", "h1"))
    smallest = grouped.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = grouped.join(smallest, "component").select("h1", "component_id")
    return made.join(of_class, "h1", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
         .alias("component_id"))


def representatives(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without all but one document of each component: the one with
    the smallest doc_id (of several rows with it, the one of smallest text
    hash). Documents without a word or an id stay. The ids that go are
    broadcast while they are at most ``BROADCAST_ROWS``."""
    found = cut(join_components(docs, words, percent).where("n_shingles > 0 and doc_id is not null"), "components")
    gone = cut(found.where("doc_id <> component_id").select("doc_id").distinct(), "copies")
    few = gone.count() <= BROADCAST_ROWS
    left = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*docs.columns)
    twice = cut(found.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1").select("doc_id"),
                "repeated-ids")
    if twice.isEmpty():
        return left
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    repeated = left.join(twice, "doc_id", "left_semi").withColumn("n__", F.row_number().over(order)) \
                   .where("n__ = 1").select(*docs.columns)
    return left.join(twice, "doc_id", "left_anti").select(*docs.columns).unionByName(repeated)
