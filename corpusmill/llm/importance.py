"""Quality classification by importance resampling (operator 9).

Two bag-of-n-grams models over ``BUCKETS`` hashed features: the target model
counts labelled rows of good quality (at most ``LABELLED`` of them, taken by a
hash of their id: a documented bound), the raw model counts every document. A
document's log weight is the sum of ``log p_target - log p_raw`` over its
features. Documents are drawn without replacement by Gumbel top-k: the k
largest sums of log weight and Gumbel noise, which is a function of the seed
and the document's id and text, so a repeated run draws the same ones.

Features are words and marks, pairs of neighbours (a word that follows itself
is one feature whatever the word), and pairs of their shapes. ``k`` is given,
or estimated: how many documents weigh at least as much as the ``lower``
quantile of labelled good ones that the model has not seen; where there are labelled bad ones, at least the
middle between them if that is lower.

The k-th largest key is found in a few counting passes over the written keys,
each of which narrows the range to one of ``WAYS`` parts, so neither a sort
nor a task holds all keys. Ties at the k-th key are all drawn.

Defined results: a null or empty text, or one without a word or mark, has a
null weight and is never drawn. Labels that are null or of unknown documents
are ignored. Without a good label every weight is 0. Repeated rows get the
same key. Other columns are not read by ``weights``.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import batch_of, cut, python_ready, slices, start_task, text_buffers
from corpusmill.llm.hashing import Ranges, combine, mix

BUCKETS = 1 << 15
LABELLED = 20_000
WAYS = 4096
BROADCAST_ROWS = 1_000_000

_KIND = np.full(256, 3, np.uint8)
_KIND[[32, *range(9, 14)]] = 0
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text index) of every feature of the texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _KIND[data]
    new = np.ones(len(data), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(data))
    word = kind[starts] > 0
    starts, ends = starts[word], ends[word]
    owner = np.searchsorted(offsets[1:], starts, side="right")
    h = Ranges(_LOWER[data]).hash(starts, ends)
    upper = np.concatenate(([0], np.cumsum((data >= 65) & (data <= 90))))
    capitals, size = upper[ends] - upper[starts], ends - starts
    shape = np.where((capitals * 2 > size) & (size > 1), 4, np.where(capitals > 0, 5, kind[starts])).astype(np.uint64)
    shape = np.where(kind[starts] == 3, 16 + data[starts].astype(np.uint64), shape)
    same = owner[1:] == owner[:-1]
    again = h[1:] == h[:-1]
    pair = np.where(again, np.uint64(7), combine([h[:-1], h[1:]]))
    shapes = combine([shape[:-1], shape[1:], again.astype(np.uint64)])
    bucket = np.concatenate([mix(h + np.uint64(1)), mix(pair[same] + np.uint64(2)), mix(shapes[same] + np.uint64(3))])
    return ((bucket & np.uint64(BUCKETS - 1)).astype(np.int64),
            np.concatenate([owner, owner[1:][same], owner[1:][same]]))


def labelled(labels: DataFrame, label: str = "quality") -> DataFrame:
    """At most about ``LABELLED`` labelled ids: (doc_id, good, fit); two thirds
    are for fitting, the others for estimating ``k``."""
    known = labels.where(f"doc_id is not null and {label} is not null") \
                  .groupBy("doc_id").agg(F.max(label).alias("good"))
    n = known.count()
    spread = 1 << 20
    return known.where(F.pmod(F.xxhash64("doc_id"), F.lit(spread)) < int(spread * min(1.0, LABELLED / max(n, 1)))) \
                .withColumn("fit", F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(3)) < 2)


def model(docs: DataFrame, sample: DataFrame) -> np.ndarray:
    """Log ratio by bucket. One pass: every document counts as raw text, and
    the good ones of the (broadcast, bounded) sample as target too."""
    marked = docs.select("doc_id", "text").join(F.broadcast(sample.where("fit").select("doc_id", "good")), "doc_id", "left") \
                 .select("good", "text")
    shape = pa.schema([("half", pa.int64()), ("counts", pa.binary())])

    def count(batches):
        start_task()
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for part in slices(batch, 1):
                bucket, owner = features(*text_buffers(part.column(1)))
                good = np.array([g == 1 for g in part.column(0).to_pylist()], bool)
                total[0] += np.bincount(bucket, minlength=BUCKETS)
                total[1] += np.bincount(bucket[good[owner]], minlength=BUCKETS)
        if total.any():
            yield batch_of(shape, [0, 1], [zlib.compress(t.tobytes(), 1) for t in total])

    def add(batches):
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for half, blob in zip(*(c.to_pylist() for c in batch.columns)):
                total[half] += np.frombuffer(zlib.decompress(blob), np.int64)
        if total.any():
            yield batch_of(shape, [0, 1], [zlib.compress(t.tobytes(), 1) for t in total])

    counted = marked.mapInArrow(count, "half long, counts binary")
    # a few tasks add up what the others counted: fixed-size rows, two for each task
    counted = counted.repartition(16).mapInArrow(add, "half long, counts binary")
    total = np.zeros((2, BUCKETS), np.float64)
    for r in counted.collect():  # at most 32 rows of BUCKETS numbers
        total[r.half] += np.frombuffer(zlib.decompress(r.counts), np.int64)
    if not total[1].any():
        return np.zeros(BUCKETS)
    share = (total + 1) / (total.sum(axis=1, keepdims=True) + BUCKETS)
    return np.log(share[1] / share[0])


def weights(docs: DataFrame, ratio: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep`` columns, log_weight and n_features, one row per row."""
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(ratio)
    schema = docs.select(*keep).schema.add("log_weight", "double").add("n_features", "long")

    def run(batches):
        start_task()
        for batch in batches:
            for part in slices(batch, len(keep)):
                bucket, owner = features(*text_buffers(part.column(len(keep))))
                n = np.bincount(owner, minlength=part.num_rows)
                w = np.bincount(owner, weights=shared.value[bucket], minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(keep)], pa.array(w, mask=n == 0), pa.array(n.astype(np.int64))],
                    names=[*keep, "log_weight", "n_features"])

    return docs.select(*keep, "text").mapInArrow(run, schema)


def threshold(keys: DataFrame, column: str, k: int) -> float:
    """The k-th largest value (-inf if there are fewer)."""
    known = keys.where(F.col(column).isNotNull()).select(F.col(column).alias("v"))
    lo, hi, n = known.agg(F.min("v"), F.max("v"), F.count("v")).first()
    if k >= (n or 0):
        return -math.inf
    if k <= 0:
        return math.inf
    above = 0
    for _ in range(8):
        width = (hi - lo) / WAYS
        if width <= 0 or lo + width == lo:
            break
        part = F.least(F.floor((F.col("v") - lo) / width), F.lit(WAYS - 1))
        got = known.where((F.col("v") >= lo) & (F.col("v") <= hi)).groupBy(part.alias("part")) \
                   .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        for r in sorted(got.collect(), key=lambda r: -r.part):  # at most WAYS rows
            if above + r.n >= k:
                lo, hi = r.lo, r.hi
                break
            above += r.n
        if lo == hi:
            break
    return lo


def estimate(scored: DataFrame, sample: DataFrame, lower: float) -> int:
    """How many documents weigh like labelled good ones that were not fitted."""
    known = scored.join(F.broadcast(sample.where("not fit").select("doc_id", "good")), "doc_id").where("log_weight is not null")
    rows = known.groupBy("good").agg(F.percentile_approx("log_weight", [lower, 0.5, 0.95], 10_000).alias("q")).collect()
    q = {r.good: r.q for r in rows}
    if 1 not in q:
        return scored.where("log_weight is not null").count()
    least = q[1][0] if 0 not in q else min(q[1][0], (q[1][1] + q[0][2]) / 2)
    return scored.where(F.col("log_weight") >= least).count()


def scores(docs: DataFrame, labels: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(labelled sample, (doc_id, key, log_weight, gumbel_key) per row)."""
    python_ready(docs.sparkSession)
    sample = cut(labelled(labels), "labelled")
    ratio = model(docs, sample)
    hashed = docs.select("doc_id", "text", F.xxhash64(F.lit(seed), "doc_id", "text").alias("key__"))
    scored = weights(hashed, ratio, ["doc_id", "key__"])
    uniform = (F.shiftrightunsigned("key__", 12) + 0.5) / float(1 << 52)
    return sample, cut(scored.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform))), "weights")


def draw(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 7, lower: float = 0.005) -> DataFrame:
    """doc_id, key__, log_weight, gumbel_key, selected: one row per row."""
    sample, scored = scores(docs, labels, seed)
    at = threshold(scored, "gumbel_key", estimate(scored, sample, lower) if k is None else k)
    return scored.select("doc_id", "key__", "log_weight", "gumbel_key",
                         F.coalesce(F.col("gumbel_key") >= F.lit(at), F.lit(False)).alias("selected"))


def drawn(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` that are drawn. Texts are not shuffled where the
    keys of those that are not drawn fit a broadcast (at most
    ``BROADCAST_ROWS``)."""
    out = cut(draw(docs, labels, k, seed).where("not selected").select("key__").distinct(), "not-drawn")
    few = out.count() <= BROADCAST_ROWS
    keyed = docs.withColumn("key__", F.xxhash64(F.lit(seed), "doc_id", "text"))
    return keyed.join(F.broadcast(out) if few else out, "key__", "left_anti").select(*docs.columns)
