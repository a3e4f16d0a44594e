"""Periodic runs of words by descending-LCP Kruskal (operator 11).

A run is a stretch of words with smallest period ``q`` that no neighbouring
word extends. Let ``s`` be its start and ``e`` its end: the suffixes at ``s``
and ``s + q`` share ``e - s - q`` words, at least ``q`` from two periods on,
and no position between them shares as many (by the periodicity lemma the
period would be smaller). So the suffixes of a text are put in order, and
neighbours in that order are united from the longest common prefix (LCP)
down, as Kruskal unites the ends of edges: a union-find over classes, each
with its ordered set of positions. Two positions, one of either class, that
become neighbours at a distance of at most the LCP ``l`` are a seed: the words
from the first one on have that period up to the second one's position plus
``l``. The seeds of one run agree in period and end; the smallest of their
positions is its start.

Runs have at least ``min_length`` words and ``min_exponent`` periods, so the
LCP of interest has a lower bound, ``floor_of``. The descent ends there, and
only positions whose next ``floor_of`` words occur again in their text are put
in order. Texts without such a position (by word hashes, which can only
name a text too many) are done at once. Words are compared exactly.

Each text is one row's work; tasks share nothing, and nothing is shuffled.

Defined results: a null or empty text, or one of separators only, has no run
and an empty collapsed text. Repeated rows give a row each. Null ids are kept.
Columns besides those asked for are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import python_ready, slices, text_buffers
from corpusmill.llm.hashing import Ranges, mix

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
WORD = r"[^\x20\x09-\x0D]+"
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15  # odd
_INVERSE = pow(_BASE, -1, 1 << 64)


def floor_of(min_length: int, min_exponent: int) -> int:
    """Least LCP of the two first periods of a run: its length without one
    period, for the period where that is least."""
    return min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 1))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every word."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~_SEPARATOR[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    open_, close = inside.copy(), inside.copy()
    open_[1:] &= ~inside[:-1] | first[1:-1]
    close[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(open_), np.flatnonzero(close) + 1
    return Ranges(data).hash(starts, ends), np.searchsorted(offsets[1:], starts, side="right")


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


def texts_with_repeats(word: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """Texts of which ``size`` consecutive words may occur twice."""
    n = len(word) - size + 1
    if n < 2:
        return np.zeros(0, np.int64)
    sums = np.zeros(len(word) + 1, np.uint64)
    np.cumsum(word * _powers(_BASE, len(word)), out=sums[1:])
    keys = mix((sums[size:] - sums[:-size]) * _powers(_INVERSE, n) + mix(owner[:n].astype(np.uint64) + np.uint64(1)))
    at = np.flatnonzero(owner[size - 1:] == owner[:n])
    keys = keys[at]
    ranked = np.sort(keys)
    again = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(again):
        return np.zeros(0, np.int64)
    again = np.unique(again)
    hit = again[np.minimum(np.searchsorted(again, keys), len(again) - 1)] == keys
    return np.unique(owner[at[hit]])


def _ranks(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Place of every pair in the order of pairs; equal pairs share theirs."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    out = np.empty(len(a), np.int64)
    out[order] = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
    return out


def suffix_order(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, previous): the positions that share ``least`` or more words
    with another, in ascending order, and each one's neighbour before it in
    suffix order (-1 where that shares fewer). Prefix doubling; the last
    element of ``ids`` and of every text must be unique."""
    n = len(ids)
    rank, known = _ranks(ids, np.zeros(n, np.int64)), 1
    group = None
    live = np.arange(n)
    while True:
        if known < least:
            step = min(known, least - known)
            ahead = np.full(n, -1, np.int64)
            ahead[:max(0, n - step)] = rank[step:]
            rank = _ranks(rank, ahead)
            known += step
            continue
        if group is None:
            group = rank.copy()
            several = np.bincount(rank, minlength=n) > 1
            live = found = np.flatnonzero(several[rank])
        if not len(live):
            break
        order = live[np.lexsort((rank[live + known], rank[live]))]
        a, b = rank[order], rank[order + known]
        at = np.arange(len(order))
        old, new = np.ones(len(order), bool), np.ones(len(order), bool)
        old[1:] = a[1:] != a[:-1]
        new[1:] = old[1:] | (b[1:] != b[:-1])
        place = np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(old, at, 0))
        rank[order] = a + place
        alone = new & np.append(new[1:], True)
        live = np.sort(order[~alone])
        known *= 2
    order = found[np.argsort(rank[found], kind="stable")]
    previous = np.full(n, -1, np.int64)
    if len(order):
        same = group[order[1:]] == group[order[:-1]]
        previous[order[1:][same]] = order[:-1][same]
    return found, previous[found]


def common_prefixes(ids: list[int], positions: list[int], previous: list[int], least: int) -> list[int]:
    """LCP of each position with its neighbour; the next position's is at
    least one less, so all comparisons together are linear."""
    out, last, h = [], -2, 0
    for p, q in zip(positions, previous):
        if q < 0:
            out.append(0)
            last, h = p, 0
            continue
        h = max(least, h - 1) if p == last + 1 else least
        while ids[p + h] == ids[q + h]:
            h += 1
        out.append(h)
        last = p
    return out


def kruskal(positions: list[int], previous: list[int], lcp: list[int]) -> dict[tuple[int, int], int]:
    """(period, end) -> start of every run whose two first periods share an
    LCP among those given."""
    up: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    seeds: dict[tuple[int, int], int] = {}

    def top(v: int) -> int:
        while (u := up.get(v, v)) != v:
            up[v] = v = up.get(u, u)
        return v

    def seed(i: int, j: int, shared: int) -> None:
        if j - i <= shared:
            key = (j - i, j + shared)
            if seeds.get(key, i) >= i:
                seeds[key] = i

    for k in sorted((k for k, q in enumerate(previous) if q >= 0), key=lcp.__getitem__, reverse=True):
        shared, a, b = lcp[k], top(positions[k]), top(previous[k])
        small, large = members.pop(a, None) or [a], members.pop(b, None) or [b]
        if len(small) > len(large):
            small, large, a, b = large, small, b, a
        before, lo = -1, 0
        for x, after in zip(small, [*small[1:], 1 << 62]):
            lo = bisect_left(large, x, lo)
            if lo and large[lo - 1] > before:
                seed(large[lo - 1], x, shared)
            if lo < len(large) and large[lo] < after:
                seed(x, large[lo], shared)
            before = x
        if 16 * len(small) < len(large):
            for x in small:
                insort(large, x)
        else:
            large = sorted(large + small)
        up[a] = b
        members[b] = large
    return seeds


def runs_of(texts: list[list[bytes]], min_length: int, min_exponent: int) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each text's runs, by start, then period."""
    least = floor_of(min_length, min_exponent)
    names: dict[bytes, int] = {}
    ids: list[int] = []
    base = []
    for i, words in enumerate(texts):
        base.append(len(ids))
        ids.extend([names.setdefault(w, len(names)) for w in words])
        ids.append(-1 - i)  # no other text ends alike
    found, previous = suffix_order(np.array(ids, np.int64), least)
    positions, before = found.tolist(), previous.tolist()
    lcp = common_prefixes(ids, positions, before, least)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (period, end), start in kruskal(positions, before, lcp).items():
        if end - start >= max(min_length, min_exponent * period):
            i = int(np.searchsorted(base, start, side="right")) - 1
            out[i].append((start - base[i], end - start, period))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def collapsed_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def find_runs(docs: DataFrame, min_length: int = 24, min_exponent: int = 3) -> DataFrame:
    """doc_id, runs (array of start, length, period in words, by start, then
    period) and ``collapsed``: the words left, joined by one space."""
    python_ready(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    least = floor_of(min_length, min_exponent)
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                data, offsets = text_buffers(part.column(1))
                some = texts_with_repeats(*word_hashes(data, offsets), least).tolist()
                words = [data[a:b].tobytes().split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                runs: list = [[] for _ in words]
                for i, r in zip(some, runs_of([words[i] for i in some], min_length, min_exponent)):
                    runs[i] = r
                left = [b" ".join(collapsed_words(w, r)) for w, r in zip(words, runs)]
                flat = np.array([x for r in runs for x in r], np.int64).reshape(-1, 3)
                ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                values = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(struct))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(ends), values),
                     pa.array(left, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, runs {RUNS}, collapsed string")


def strongest(runs: str) -> Column:
    """The run with the greatest exact length / period; ties go to the
    smallest start, then period. Null without a run."""
    better = "x.length * best.period > best.length * x.period"
    return F.expr(f"aggregate(slice({runs}, 2, greatest(size({runs}) - 1, 0)), try_element_at({runs}, 1), "
                  f"(best, x) -> if({better}, x, best))")


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run's columns, and the two digests."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return found.withColumn("best", strongest("runs")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """Stand-in input: of every tenth document by crc32 of its id, the words
    from one of its places on are replaced by repetitions of the words there."""
    h = F.crc32(F.col("doc_id").cast("string"))
    mine = F.coalesce(F.pmod(h, F.lit(10)) == 0, F.lit(False))
    split = docs.select("doc_id", "text", F.floor(h / 10).cast("long").alias("g"),
                        F.when(mine, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("w"))
    placed = split.withColumn("a", F.when(F.size("w") > 0, F.pmod("g", F.size("w"))))
    ready = placed.withColumn("p", F.expr("1 + (size(w) - a) div (3 + g % 8)"))
    tail = "array_join(transform(w, (x, i) -> if(i < a, x, get(w, cast(a + (i - a) % p as int)))), ' ')"
    return ready.select("doc_id", F.expr(f"if(a is null, text, {tail})").alias("text"))
