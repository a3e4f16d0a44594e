"""Removal of repeated byte strings by prefix-free parsing (operator 10).

A position opens a phrase when its rolling hash is the smallest (leftmost on
ties) among ``V`` neighbouring positions; that trigger depends on the text
only, so equal strings are parsed alike, and every window of ``LENGTH`` bytes
holds a trigger among its first ``V`` positions. A window's first smallest
trigger is its anchor, and the windows of one anchor are neighbours: they form
the anchor's group. Two equal windows have the same anchor at the same
distance, which lets phrases stand for all positions:

1. Dictionary: the ``LENGTH - V + 1`` bytes from each trigger on (which any
   window of its group holds) are hashed and counted over all texts. Only
   triggers whose entry occurs again can anchor a repeated window.
2. Parse: for those, the whole context of the group (first byte of its first
   window to last byte of its last) is hashed and counted. Where a context
   occurs again, all windows of the group do; in repetitive text that settles
   nearly everything. A task counts the contexts that it meets before it passes
   them on, and tells the places of a text's phrases as runs: no phrase has a
   row of its own, however common it is. A context that occurs once is known
   with its place from the count, so each text leaves those out of its runs.
3. Order: what is left are the phrases at the ends of repeated passages. Per
   dictionary entry the distinct contexts (one text each) bring their bytes,
   and their windows are put in order; the corpus order is needed only as far
   as ``LENGTH`` bytes, so windows are ordered by the hash of those bytes, and
   neighbours that are equal are repeated. Entries with at most
   ``IN_TASK`` contexts are settled many to a task; a larger one is split and
   counted by shuffles with partial sums, first by blocks of windows.

Strings are judged on the input; copies of a text count as occurrences but
are worked on once. Hashes have 64 bits. Broadcasts: the keys of the texts to
read again, while they are at most ``BROADCAST_ROWS``; a join otherwise.

Defined results: a null text counts as empty and is not repeated; a text
under ``LENGTH`` bytes stays whole; a copy of another text of ``LENGTH`` bytes
or more goes whole. Repeated rows are copies. A null doc_id is kept and other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import cut, python_ready, slices, start_task
from corpusmill.llm.hashing import Ranges

LENGTH = 400
V = 256
TRIGGER = 8
SEGMENT = 1 << 22
IN_TASK = 2000
BLOCK = 16
BROADCAST_ROWS = 1_000_000
HELD = 1 << 17
RANGES = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
PARSED = ["s", "c", "w", "k", "lo", "hi", "t", "runs"]


def groups(data: np.ndarray, length: int = LENGTH, v: int = V, segment: int = SEGMENT):
    """Yield per segment (range hashes of the segment, its place, anchors,
    first windows, window ends), places within the segment."""
    for at in range(0, max(0, len(data) - length + 1), segment):
        part = data[at:at + segment + length - 1]
        ranges, windows = Ranges(part), len(part) - length + 1
        place = np.arange(windows + v - 1, dtype=np.uint64)
        where = place.astype(np.int64)
        key = (ranges.hash(where, where + min(TRIGGER, length - v)) & ~np.uint64(0xFFFFFF)) | place
        width = 1
        while width < v:
            step = min(width, v - width)
            key = np.minimum(key[:-step], key[step:])
            width += step
        anchor = (key & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(anchor)) + 1))
        yield ranges, at, anchor[first], first, np.concatenate((first[1:], [windows]))


def _bytes(text) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("k", F.xxhash64(F.coalesce("text", F.lit(""))))


def dictionary(docs: DataFrame, length: int, v: int) -> DataFrame:
    """(h, k, n): dictionary entries by text and how often each occurs there,
    copies of the text included."""
    entry = length - v + 1

    def run(batches):
        start_task()
        for batch in batches:
            for part in slices(batch, 1):
                hs, ks, ns = [], [], []
                for k, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for ranges, _, anchor, _, _ in groups(_bytes(text), length, v):
                        h, n = np.unique(ranges.hash(anchor, anchor + entry), return_counts=True)
                        hs.append(h)
                        ns.append(n)
                        ks.append(np.full(len(h), k))
                if hs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.concatenate(ks)),
                         pa.array(np.concatenate(ns))], names=["h", "k", "n"])

    return keyed(docs).where(F.octet_length("text") >= length).select("k", "text") \
        .mapInArrow(run, "h long, k long, n long").groupBy("h", "k").agg(F.sum("n").alias("n"))


def texts(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(k, text) of the texts with these keys, one row each."""
    keys = cut(keys.select("k").distinct(), "text-keys")
    few = keys.count() <= BROADCAST_ROWS
    return keyed(docs).select("k", "text").join(F.broadcast(keys) if few else keys, "k", "left_semi") \
        .dropDuplicates(["k"])


def _counted(groups_: list[tuple]) -> pa.RecordBatch:
    """One row per entry and context of these groups: its copies and its first place."""
    s, c, k, copies, lo, hi, t = (np.concatenate(x) for x in zip(*groups_))
    order = np.lexsort((lo, k, c, s))
    s, c, copies = s[order], c[order], copies[order]
    opens = np.flatnonzero(np.concatenate(([True], (s[1:] != s[:-1]) | (c[1:] != c[:-1]))))
    first = order[opens]
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (s[opens], c[opens], np.add.reduceat(copies, opens), k[first], lo[first], hi[first], t[first])]
        + [pa.nulls(len(opens), RANGES)], names=PARSED)


def contexts(found: DataFrame, length: int, v: int) -> DataFrame:
    """Groups whose anchor's entry occurs again, in two kinds of rows. With
    ``runs`` null (s, c, w, k, lo, hi, t): a context with its hash c, how often
    a task met it (copies included) and the first place there. With ``runs``
    (k, runs): where a text that occurs once has such groups, neighbours
    joined."""
    entry = length - v + 1

    def run(batches):
        start_task()
        held, size = [], 0
        for part in (p for batch in batches for p in slices(batch, 3)):
            ks, runs = [], []
            for k, copies, known, text in zip(*(c.to_pylist() for c in part.columns)):
                known = np.sort(np.array(known, np.int64).view(np.uint64))
                places = []
                for ranges, at, anchor, first, end in groups(_bytes(text), length, v):
                    h = ranges.hash(anchor, anchor + entry)
                    seen = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
                    ok = np.flatnonzero(seen)
                    if len(ok):
                        lo, hi = first[ok], end[ok]
                        n = len(ok)
                        held.append((h[ok].view(np.int64), ranges.hash(lo, hi - 1 + length).view(np.int64),
                                     np.full(n, k), np.full(n, copies), lo + at, hi + at, anchor[ok] + at))
                        opens = np.concatenate(([True], lo[1:] != hi[:-1]))
                        places.append((lo[opens] + at, hi[np.append(opens[1:], True)] + at))
                        size += n
                        if size >= HELD:
                            yield _counted(held)
                            held, size = [], 0
                if copies == 1 and places:
                    ks.append(k)
                    runs.append([{"lo": a, "hi": b} for lo, hi in places for a, b in zip(lo.tolist(), hi.tolist())])
            if ks:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ks) if x == "k" else pa.array(runs, RANGES) if x == "runs" else pa.nulls(len(ks), pa.int64())
                     for x in PARSED], names=PARSED)
        if held:
            yield _counted(held)

    return found.select("k", "copies", "known", "text").mapInArrow(
        run, "s long, c long, w long, k long, lo long, hi long, t long, runs array<struct<lo: long, hi: long>>")


def with_bytes(docs: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """The bytes of each asked context."""
    wanted = asked.groupBy("k").agg(F.collect_list(F.struct("s", "c", "w", "lo", "hi", "t")).alias("asked"))

    def run(batches):
        start_task()
        for part in (p for batch in batches for p in slices(batch, 1)):
            for k, text, rows in zip(*(c.to_pylist() for c in part.columns)):
                data = (text or "").encode()
                yield pa.RecordBatch.from_pylist(
                    [{**r, "k": k, "context": data[r["lo"]:r["hi"] - 1 + length]} for r in rows],
                    schema=pa.schema([(x, pa.int64()) for x in ("s", "c", "w", "lo", "hi", "t", "k")]
                                     + [("context", pa.binary())]))

    return texts(docs, wanted).join(wanted, "k").select("k", "text", "asked").mapInArrow(
        run, "s long, c long, w long, lo long, hi long, t long, k long, context binary")


def _windows(rows: list[dict], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row index, hash) of every window of every row, in order of places."""
    size = np.array([len(r["context"]) for r in rows])
    start = np.cumsum(size) - size
    ranges = Ranges(np.frombuffer(b"".join(r["context"] for r in rows), np.uint8))
    count = size - length + 1
    owner = np.repeat(np.arange(len(rows)), count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + start[owner]
    return owner, ranges.hash(place, place + length)


def _runs(rows: list[dict], owner: np.ndarray, again: np.ndarray):
    """Intervals of windows marked ``again``, for rows that occur once."""
    begin = np.searchsorted(owner, np.arange(len(rows) + 1))
    k, lo, hi = [], [], []
    for i, r in enumerate(rows):
        if r["w"] < 2:
            marked = np.concatenate(([0], again[begin[i]:begin[i + 1]].astype(np.int8), [0]))
            edge = np.flatnonzero(np.diff(marked))
            for a, b in edge.reshape(-1, 2).tolist():
                k.append(r["k"])
                lo.append(r["lo"] + a)
                hi.append(r["lo"] + b)
    return pa.table({"k": pa.array(k, pa.int64()), "lo": pa.array(lo, pa.int64()), "hi": pa.array(hi, pa.int64())})


def settle(found: DataFrame, length: int, tasks: int) -> DataFrame:
    """Repeated windows (k, lo, hi) of contexts that occur once."""
    sizes = found.groupBy("s").agg(F.count("*").alias("members"))
    found = cut(found.join(sizes, "s"), "contexts")

    def in_order(key, table):
        rows = table.to_pylist()
        owner, h = _windows(rows, length)
        weight = np.array([r["w"] for r in rows])
        order = np.argsort(h, kind="stable")
        opens = np.concatenate(([True], h[order][1:] != h[order][:-1]))
        run = np.cumsum(opens) - 1
        total = np.bincount(run, weights=weight[owner[order]])
        again = np.zeros(len(h), bool)
        again[order] = total[run] >= 2
        return _runs(rows, owner, again)

    small = found.where(f"members <= {IN_TASK}") \
        .groupBy(F.pmod(F.xxhash64("s"), F.lit(tasks)).alias("part")).applyInArrow(in_order, "k long, lo long, hi long")

    return small.unionByName(_settle_large(found.where(f"members > {IN_TASK}"), length))


def _settle_large(found: DataFrame, length: int) -> DataFrame:
    """The same for entries of many contexts, without a task for an entry.
    Windows are taken in blocks of ``BLOCK`` by their distance to the anchor.
    Where a block's bytes from its first to its last window occur again, all
    its windows do; where the bytes that all of them share do not, none does.
    Only what is left, one context for each content, is counted window by
    window."""
    def in_blocks(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ranges = Ranges(np.frombuffer(r["context"], np.uint8))
                place = np.arange(r["lo"], r["hi"])
                block = (r["t"] - place) // BLOCK
                first = np.flatnonzero(np.append(True, np.diff(block) != 0))
                last = np.append(first[1:], len(place)) - 1
                shared = r["t"] - block[first] * BLOCK - r["lo"]
                n = len(first)
                out.append([np.full(n, r[x]) for x in ("s", "c", "k", "w")] + [
                    block[first], place[first], place[last] + 1,
                    ranges.hash(shared, shared - BLOCK + 1 + length).view(np.int64),
                    ranges.hash(first, last + length).view(np.int64)])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)],
                                                 names=["s", "c", "k", "w", "b", "lo", "hi", "core", "full"])

    shape = "s long, c long, k long, w long, b long, lo long, hi long, core long, full long"
    blocks = cut(found.mapInArrow(in_blocks, shape), "blocks")
    alike = cut(blocks.groupBy("s", "b", "core", "full").agg(F.sum("w").alias("times"), F.min("c").alias("c")), "alike-blocks")
    whole = blocks.where("w < 2").join(alike.where("times > 1").select("s", "b", "core", "full"),
                                       ["s", "b", "core", "full"], "left_semi").select("k", "lo", "hi")
    left = alike.groupBy("s", "b", "core").agg(F.sum("times").alias("n"), F.min("times").alias("least")) \
                .where("n > 1 and least < 2").select("s", "b", "core")
    asked = alike.join(left, ["s", "b", "core"], "left_semi").groupBy("s", "c").agg(
        F.collect_list(F.struct("b", F.least("times", F.lit(2)).alias("w"))).alias("asked"))

    def single(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ranges = Ranges(np.frombuffer(r["context"], np.uint8))
                place = np.arange(r["lo"], r["hi"])
                block = (r["t"] - place) // BLOCK
                weight = np.zeros(len(place), np.int64)
                for x in r["asked"]:
                    weight[block == x["b"]] = x["w"]
                at = np.flatnonzero(weight)
                out.append([ranges.hash(at, at + length).view(np.int64), weight[at], np.full(len(at), r["k"]), place[at]])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["h", "w", "k", "lo"])

    windows = cut(found.join(asked, ["s", "c"]).mapInArrow(single, "h long, w long, k long, lo long"), "windows")
    again = windows.groupBy("h").agg(F.sum("w").alias("w")).where("w > 1").select("h")
    ones = windows.where("w < 2").join(again, "h", "left_semi").select("k", "lo", (F.col("lo") + 1).alias("hi"))
    return whole.unionByName(ones)


def repeated(docs: DataFrame, length: int = LENGTH, v: int = V) -> tuple[DataFrame, DataFrame]:
    """((k, copies) of all texts, (k, covered) with the byte ranges that
    repeated strings cover, for texts that occur once)."""
    spark = docs.sparkSession
    python_ready(spark)
    counted = cut(keyed(docs).groupBy("k").agg(F.count("*").alias("copies"), F.sum(F.octet_length("text")).alias("b")),
                  "copies")
    total = counted.agg(F.sum("b")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, int(total // (4 << 20)) + 1)
    entries = cut(dictionary(docs, length, v), "dictionary")
    again = entries.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    known = entries.join(again, "h", "left_semi").groupBy("k").agg(F.collect_list("h").alias("known"))
    known = cut(known.join(counted.select("k", "copies"), "k"), "known")
    parsed = cut(contexts(texts(docs, known).join(known, "k"), length, v), "parse")
    alike = parsed.where("runs is null").groupBy("s", "c").agg(F.sum("w").alias("w"), F.min(F.struct("k", "lo", "hi", "t")).alias("one"))
    alike = cut(alike, "alike")
    open_entries = alike.where("w < 2").select("s").distinct()
    asked = alike.join(open_entries, "s", "left_semi").select("s", "c", F.least("w", F.lit(2)).alias("w"), "one.*")
    edges = settle(with_bytes(docs, cut(asked, "asked"), length), length, tasks)
    alone = alike.where("w < 2").select("one.k", "one.lo", "one.hi", F.lit(False).alias("again"))
    marked = alone.unionByName(edges.withColumn("again", F.lit(True))).groupBy("k").agg(
        F.collect_list(F.struct("lo", "hi", "again")).alias("marked"))
    covered = cover(parsed.where("runs is not null").select("k", "runs").join(marked, "k", "left"), length)
    return counted.select("k", "copies"), cut(covered, "covered")


def cover(found: DataFrame, length: int) -> DataFrame:
    """(k, covered): the runs of groups of each text, without the groups whose
    context occurs once and with those of their windows that occur again."""
    def run(batches):
        for batch in batches:
            ks, out = [], []
            for k, runs, marked in zip(*(c.to_pylist() for c in batch.columns)):
                windows = _without(runs, [m for m in marked or [] if not m["again"]]) \
                    + [(m["lo"], m["hi"]) for m in marked or [] if m["again"]]
                if windows:
                    ks.append(k)
                    out.append([{"lo": lo, "hi": hi - 1 + length} for lo, hi in sorted(windows)])
            yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int64()), pa.array(out, RANGES)], names=["k", "covered"])

    return found.select("k", "runs", "marked").mapInArrow(run, "k long, covered array<struct<lo: long, hi: long>>")


def _without(runs: list[dict], alone: list[dict]) -> list[tuple[int, int]]:
    """What is left of the sorted ``runs`` without the ranges ``alone`` in them."""
    out, holes, i = [], sorted((r["lo"], r["hi"]) for r in alone), 0
    for lo, hi in ((r["lo"], r["hi"]) for r in runs):
        while i < len(holes) and holes[i][0] < hi:
            if lo < holes[i][0]:
                out.append((lo, holes[i][0]))
            lo = holes[i][1]
            i += 1
        if lo < hi:
            out.append((lo, hi))
    return out


def spans(covered: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of the sorted ranges (touching ranges join)."""
    out: list[list[int]] = []
    for r in covered:
        if out and r["lo"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r["hi"])
        else:
            out.append([r["lo"], r["hi"]])
    return [tuple(x) for x in out]


def _kept(data: bytes, cuts: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in cuts:
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]])


def without_repeats(docs: DataFrame, length: int = LENGTH, v: int = V, digest: bool = False) -> DataFrame:
    """``docs`` with the remaining text (characters cut apart are left out)
    and its n_chars; with ``digest`` the counts and the hash of the remaining
    bytes instead."""
    copies, covered = repeated(docs, length, v)

    def run(batches):
        start_task()
        for part in (p for batch in batches for p in slices(batch, 1)):
            k, n, m, kept = [], [], [], []
            for key, text, ranges in zip(*(c.to_pylist() for c in part.columns)):
                data, cuts = (text or "").encode(), spans(ranges)
                left = _kept(data, cuts)
                k.append(key)
                n.append(len(data) - len(left))
                m.append(len(cuts))
                kept.append(hashlib.sha256(left).hexdigest() if digest else left.decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(n, pa.int64()), pa.array(m, pa.int64()),
                                              pa.array(kept, pa.string())], names=["k", "removed", "spans", "kept"])

    changed = texts(docs, covered).join(covered, "k").select("k", "text", "covered") \
        .mapInArrow(run, "k long, removed long, spans long, kept string")
    text = F.coalesce("text", F.lit(""))
    rows = keyed(docs)
    if digest:
        rows = rows.select("doc_id", "k", F.octet_length(text).cast("long").alias("n_bytes"),
                           F.sha2(text.cast("binary"), 256).alias("whole"))
    else:
        rows = rows.withColumn("__bytes", F.octet_length(text))
    size = F.col("n_bytes") if digest else F.col("__bytes")
    rows = rows.join(copies.where("copies > 1"), "k", "left").join(changed, "k", "left")
    gone = F.col("copies").isNotNull() & (size >= length)
    if digest:
        return rows.select(
            "doc_id", "n_bytes",
            F.when(gone, size).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(gone, 1).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(gone, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept", "whole")).alias("kept_sha256"))
    left = F.when(gone, F.lit("")).otherwise(F.coalesce("kept", "text"))
    return rows.withColumn("text", left).select(*[
        F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])
