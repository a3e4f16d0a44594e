"""Best-fit packing by minimum bin slack (operator 4).

A document's ids (tokenizer ids, then an end id) are cut only where they
exceed the capacity: into full pieces, of which the first may be shorter. All
that packing needs is how many pieces there are of each length, at most
``capacity`` numbers. On these the driver builds bins: the longest length
left opens a bin, and a subset-sum dynamic programme over the lengths left
(one bitset of reachable sums per step, lengths in falling order, counts
split into powers of two) finds the fullest feasible combination. That
combination is then removed as often as the counts allow, so each step uses
up a length and the number of patterns does not grow with the documents.

Pieces get their places without a group by length: a task numbers its pieces
of each length as it emits them, the tasks' counts are added up in task order
(one row per task and length), and a piece's number says which repetition of
which pattern it falls into. However many pieces share one length, no task
gathers them. The numbered pieces are written once to the checkpoint folder,
so a lost executor cannot renumber them.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each; a null doc_id is kept; an empty table gives no piece; other
columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm import byte_bpe
from corpusmill.llm.common import cut, python_ready, slices, start_task

Pattern = tuple[list[tuple[int, int]], int]


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum <= ``room``."""
    limit = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            steps.append((length * take, length, take, reach))
            reach |= (reach << (length * take)) & limit
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, Counter()
    for size, length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= size
            chosen[length] += take
    return chosen


def minimum_bin_slack(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns ((length, how many) pairs, longest first) with their number
    of repetitions; together they use up ``counts``."""
    left = {x: n for x, n in counts.items() if n > 0}
    plan: list[Pattern] = []
    while left:
        seed = max(left)
        left[seed] -= 1
        chosen = fullest(left, capacity - seed)
        left[seed] += 1
        chosen[seed] += 1
        times = min(left[x] // n for x, n in chosen.items())
        plan.append((sorted(chosen.items(), reverse=True), times))
        for x, n in chosen.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return plan


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int, end_id: int) -> DataFrame:
    """One row per piece, with its task and its number there by length."""
    python_ready(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        start_task("byte_bpe")
        bpe, task, seen = byte_bpe.load(tokenizer_file), TaskContext.get().partitionId(), Counter()
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            for part in slices(batch, 1):
                rows = []
                for k, text in enumerate(part.column(1).to_pylist()):
                    ids = bpe.encode(text) + end
                    n = len(ids) // 4
                    starts = [0, *range(n % capacity or capacity, n, capacity)]
                    for i, (a, b) in enumerate(zip(starts, [*starts[1:], n])):
                        rows.append((k, i, a, b - a, zlib.crc32(ids[4 * a:4 * b]), task, seen[b - a]))
                        seen[b - a] += 1
                cols = np.array(rows, dtype=np.int64).reshape(-1, 7)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(cols[:, 0])), pa.array(cols[:, 1].astype(np.int32)),
                     *(pa.array(cols[:, i]) for i in range(2, 5)), pa.array(cols[:, 5].astype(np.int32)),
                     pa.array(cols[:, 6])],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, task int, nth long")


class Places:
    """Sequence and offset of the ``nth`` piece of a length."""

    def __init__(self, plan: list[Pattern]):
        self.rows: dict[int, list[tuple[int, int, int, int]]] = {}
        used: Counter = Counter()
        bins = 0
        for pattern, times in plan:
            offset = 0
            for length, n in pattern:
                self.rows.setdefault(length, []).append((used[length], bins, n, offset))
                used[length] += n * times
                offset += n * length
            bins += times
        self.tables = {x: np.array(r, dtype=np.int64).T for x, r in self.rows.items()}

    def of(self, length: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for x in np.unique(length):
            here = np.flatnonzero(length == x)
            first, bin0, per_bin, at = self.tables[int(x)]
            row = np.searchsorted(first, nth[here], side="right") - 1
            k = nth[here] - first[row]
            sequence[here] = bin0[row] + k // per_bin[row]
            offset[here] = at[row] + (k % per_bin[row]) * x
        return sequence, offset


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset."""
    spark = docs.sparkSession
    made = cut(pieces(docs, tokenizer_file, capacity, end_id), "pieces")
    per_task = made.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.sparkContext.broadcast(Places(minimum_bin_slack(counts, capacity)))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    numbered = made.join(base, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("base")).alias("nth"))
    keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = numbered.select(*keep).schema.add("sequence_id", "long").add("offset", "long")

    def run(batches):
        for batch in batches:
            sequence, offset = places.value.of(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                             names=[*keep, "sequence_id", "offset"])

    return numbered.mapInArrow(run, schema)
