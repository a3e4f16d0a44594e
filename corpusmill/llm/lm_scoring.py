"""Language-model scores of whole documents (operator 12).

1. Counts: the words of all training texts are counted (``word_counts``). They
   give the base score, and order the words: the commonest are ids of the
   model, a bounded head is held by every task, all others stay a table.
2. Training: a gated recurrent model with a class-factored softmax (``gru``)
   learns by truncated backpropagation from every training text once. Training
   goes in ``ROUNDS`` shares of the texts (by hash, growing): each task starts
   from the round's model and works through its texts of that share, and the
   tasks' models are averaged, weighted by their tokens, in slices and in steps
   of at most ``FAN`` models. Work and what is gathered grow with the corpus;
   the driver receives one model per round.
3. Scores: each task runs the model over its whole texts, the state carried from
   window to window. Words outside the model's ids get the probability of
   their class times their share ``(c + 1)`` of that class, in which one place is
   kept for all words never seen; so the probabilities of all words seen, the
   end and the unknown add up to one. Words outside the head are looked up by a
   join, one row per text and word.

Defined results: a null or empty text is the end alone. A null doc_id counts as
the empty string: it is learnt from, and not held out. Without training rows
both scores are 0. Repeated rows give a row each and are learnt from each. An
empty table has no rows. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import gru
from corpusmill.llm.common import cut, python_ready, slices
from corpusmill.llm.word_counts import HEAD, Corpus, corpus, tokens

#: Ends of the shares of texts (of 64) that the rounds learn from.
ROUNDS = (8, 64)
FAN = 64
SLICES = 32
RATE = 0.2
WINDOW, SCORE_WINDOW = 48, 96
#: Texts side by side when learning and when scoring.
LEARN_LANES, SCORE_LANES = 128, 256
#: Text bytes of which one step holds the ids.
STEP_BYTES = 16 << 20
_LN10 = float(np.log(10))


def remainder() -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7))


class _Places(dict):
    """Numbers of words, and one for all words that it does not hold."""

    def __init__(self, places: dict[bytes, int], absent: int):
        super().__init__(places)
        self.absent = absent

    def __missing__(self, word):
        return self.absent

    def __reduce__(self):
        return _Places, (dict(self), self.absent)

    def of(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers, and 0 for the end."""
        out = np.zeros(len(words) + 1, np.int32)
        out[:-1] = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        return out


class Words:
    """Ids and counts of the head's words."""

    def __init__(self, found: Corpus):
        model = min(len(found.head), gru.CLASSES * gru.SLOTS - 1)
        self.model_place = _Places({w: i + 1 for i, w in enumerate(found.head[:model])}, model + 1)
        self.place = _Places({w: i + 1 for i, w in enumerate(found.head)}, -1)
        self.counts = np.array([found.texts, *found.head_n], np.int64)
        self.mass, self.other = found.mass, model + 1
        self.known = found.mass - int((self.counts[:self.other] + 1).sum())  # the other words' and the unknown's
        self.base = np.log10(self.counts + 1) - np.log10(self.mass)

    def model(self) -> gru.Params:
        return gru.fresh(self.counts[:self.other] + 1.0, float(max(1, self.known)))

    def model_ids(self, places: np.ndarray) -> np.ndarray:
        return np.where((places < 0) | (places >= self.other), np.int32(self.other), places)


def _pack(p: gru.Params) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def _unpack(flat: np.ndarray, like: gru.Params) -> gru.Params:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _averaged(models: DataFrame, tasks: int) -> np.ndarray | None:
    """Mean of (slice, task, tokens, blob) weighted by tokens."""
    def mean(key, rows):
        tokens = np.array(rows.column("tokens").to_pylist(), float)
        total = sum(np.frombuffer(zlib.decompress(b.as_py()), np.float32) * np.float32(t / tokens.sum())
                    for b, t in zip(rows.column("blob"), tokens))
        return pa.table({"slice": [key[0].as_py()], "task": [key[1].as_py()], "tokens": [int(tokens.sum())],
                         "blob": [zlib.compress(total.astype(np.float32).tobytes(), 1)]})

    shape = "slice long, task long, tokens long, blob binary"
    while True:
        tasks = -(-tasks // FAN)
        models = models.withColumn("task", F.expr(f"task div {FAN}")).groupBy("slice", "task").applyInArrow(mean, shape)
        if tasks <= 1:
            break
    found = sorted(models.collect(), key=lambda r: r.slice)  # SLICES rows: one model
    return np.concatenate([np.frombuffer(zlib.decompress(r.blob), np.float32) for r in found]) if found else None


def learn(docs: DataFrame, words: Words) -> gru.Params:
    """The model after all rounds over ``docs``."""
    spark = docs.sparkSession
    model = words.model()
    second = {k: np.full(v.shape, 1e-4, np.float32) for k, v in model.items()}
    share = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    shared_words = spark.sparkContext.broadcast(words)
    for low, high in zip((0, *ROUNDS), ROUNDS):
        start = spark.sparkContext.broadcast((model, second))

        def run(batches):
            words, task = shared_words.value, TaskContext.get().partitionId()
            p, s = ({k: v.copy() for k, v in part.items()} for part in start.value)
            seen = 0
            for batch in batches:
                for part in slices(batch, 0, STEP_BYTES):
                    texts = [words.model_place.of(w) for w in tokens(part, 0)]
                    seen += gru.train(p, s, texts, RATE, WINDOW, LEARN_LANES)
            if seen:
                flat = np.concatenate([_pack(p), _pack(s)])
                yield pa.RecordBatch.from_pydict({
                    "slice": list(range(SLICES)), "task": [task] * SLICES, "tokens": [seen] * SLICES,
                    "blob": [zlib.compress(b.tobytes(), 1) for b in np.array_split(flat, SLICES)]})

        mine = docs.where((share >= low) & (share < high))
        models = cut(mine.select("text").mapInArrow(run, "slice long, task long, tokens long, blob binary"), "models")
        tasks = (models.agg(F.max("task")).first()[0] or 0) + 1
        flat = _averaged(models, tasks)
        if flat is not None:
            half = len(flat) // 2
            model, second = _unpack(flat[:half], model), _unpack(flat[half:], second)
    return model


def scores(docs: DataFrame, found: Corpus, words: Words, model: gru.Params) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((words, model))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shape = (f"doc_id {id_type}, held_out boolean, row long, n_tokens long, n_known long, base double, score double, "
             "rare array<struct<word:binary,n:int>>")

    def run(batches):
        words, model = shared.value
        row = TaskContext.get().partitionId() << 40
        # by place in the head, the last for words outside it
        base_of, seen = np.append(words.base, 0), np.append(words.counts > 0, False)
        extra = np.append(words.base + np.log10(words.mass) - np.log10(max(1, words.known)), 0)
        extra[:words.other] = 0
        for batch in batches:
            for part in slices(batch, 1, STEP_BYTES):
                places, rare = [], []
                for w in tokens(part, 1):
                    places.append(words.place.of(w))
                    out = np.flatnonzero(places[-1] < 0).tolist()
                    rare.append(list(Counter([w[k] for k in out]).items()) if out else [])
                every, sizes = np.concatenate(places), np.array(list(map(len, places)))
                first = np.cumsum(sizes) - sizes
                known, base = np.add.reduceat(seen[every].astype(np.int64), first), np.add.reduceat(base_of[every], first)
                extras, ids = np.add.reduceat(extra[every], first), np.split(words.model_ids(every), first[1:])
                logp = gru.score(model, ids, SCORE_WINDOW, SCORE_LANES) / _LN10
                ends = np.cumsum([0, *map(len, rare)]).astype(np.int32)
                flat = [x for r in rare for x in r]
                items = pa.StructArray.from_arrays([pa.array([x[0] for x in flat], pa.binary()), pa.array([x[1] for x in flat], pa.int32())],
                                                   names=["word", "n"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(np.arange(row, row + len(ids))), pa.array(sizes),
                     pa.array(known), pa.array(base), pa.array(logp + extras), pa.ListArray.from_arrays(pa.array(ends), items)],
                    names=["doc_id", "held_out", "row", "n_tokens", "n_known", "base", "score", "rare"])
                row += len(ids)

    made = cut(docs.select("doc_id", "text", (remainder() == 2).alias("held_out")).mapInArrow(run, shape), "scored")
    rare = made.select("row", F.explode("rare").alias("w")).select("row", "w.word", F.col("w.n").alias("times"))
    c = F.coalesce("n", F.lit(0))
    of_row = rare.join(found.rest, "word", "left").groupBy("row").agg(
        F.sum("times").alias("times"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("seen"),
        F.sum(F.col("times") * F.log10(c + 1)).alias("logs"))
    mass, rest = float(np.log10(words.mass)), float(np.log10(max(1, words.known)))
    times, logs = F.coalesce("times", F.lit(0)), F.coalesce("logs", F.lit(0.0))
    return made.join(of_row, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(found.total).cast("long").alias("train_tokens"), (F.col("base") + logs - times * mass).alias("base_score"),
        (F.col("score") + logs - times * rest).alias("score"))


def score_documents(docs: DataFrame, head: int = HEAD) -> DataFrame:
    """Scores of all ``docs``, learnt from those that are not held out. Tasks
    hold at most ``head`` words, the others are looked up by a join."""
    python_ready(docs.sparkSession, 2 * STEP_BYTES)  # long lanes need many texts at a time
    training = docs.where(remainder() != 2).select("doc_id", "text")
    found = corpus(training, head)
    words = Words(found)
    if not found.texts:  # nothing is known: the unknown token has probability one
        n = F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))) + 1
        zero = F.lit(0).cast("long")
        return docs.select("doc_id", (remainder() == 2).alias("held_out"), n.cast("long").alias("n_tokens"), zero.alias("n_known"),
                           zero.alias("train_tokens"), F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score"))
    return scores(docs, found, words, learn(training, words))
