"""Language identification with language-bitmask n-gram filters (operator 1).

Training counts byte n-grams of lower-cased text (runs of non-letters become
one space) per language, over at most ``train_docs`` texts of each language
(a documented bound: texts are taken by a hash of their content, so the
sample is the same wherever it is drawn, and copies count once). An n-gram belongs to a language
when its share of that language's n-grams is at least ``min_share``; a
language therefore has at most ``len(SIZES) / min_share`` n-grams, which
bounds what the driver collects and what is broadcast.

The filter is one bit-sliced Bloom filter for all languages: position ``p``
holds a mask with one bit per language, an n-gram sets its language's bit at
``HASHES`` positions, and a lookup ANDs the masks at those positions, which
gives every language that contains the n-gram at once. A text's hits are
counted per language; ``fill ** HASHES`` of a language's misses are expected
to be false positives, and the count is corrected by that rate. The language
with the largest corrected count wins; ties go to the more frequent language
of the sample, then to the smaller name.

Defined results: a null text, or one without a letter, gives ``und`` and
score 0. A text with letters but no n-gram hit gives the most frequent
language with score 0. Without any training row every text is ``und``.
Repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import batch_of, python_ready, slices, start_task, text_buffers
from corpusmill.llm.hashing import mix

SIZES = (3, 4, 5)
HASHES = 2
_WINDOW = 1 << 19
_LETTER = regex.compile(r"\p{L}")


def _letters_only(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes with every run of non-letters as one space, and the
    text's bounds: each text starts and ends with a space."""
    low = [(" " + t.lower() + " ").encode("utf-8", "replace") for t in texts]
    raw = np.frombuffer(b"".join(low), dtype=np.uint8)
    ends = np.cumsum([len(b) for b in low])
    letter = (raw >= 128) | ((raw >= 97) & (raw <= 122))
    first = np.zeros(len(raw), bool)
    first[np.concatenate(([0], ends[:-1])).astype(np.int64)] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep |= first
    kept = np.where(letter, raw, np.uint8(32))[keep]
    counts = np.concatenate(([0], np.cumsum(keep)))
    return kept, np.concatenate(([0], counts[ends])).astype(np.int64)


def _grams(data: np.ndarray, bounds: np.ndarray):
    """Yield (text index, n-gram hash) arrays, window by window; no n-gram
    spans two texts."""
    owner_end = bounds[1:]
    for at in range(0, len(data), _WINDOW):
        part = data[at:at + _WINDOW + max(SIZES)].astype(np.uint64)
        value = part[:-1] + (part[1:] << np.uint64(8)) if len(part) > 1 else part[:0]
        for n in SIZES:
            m = min(len(part) - n + 1, _WINDOW)
            if m <= 0:
                continue
            value = value[:len(part) - n + 1] + (part[n - 1:] << np.uint64(8 * (n - 1)))
            owner = np.searchsorted(owner_end, np.arange(at, at + m), side="right")
            inside = np.arange(at, at + m) + n <= owner_end[np.minimum(owner, len(owner_end) - 1)]
            yield owner[inside], mix(value[:m][inside] + np.uint64(n << 56))


@dataclass
class Model:
    languages: list[str]      # more frequent ones first
    masks: np.ndarray         # position -> words of language bits
    fill: np.ndarray          # share of positions set, by language

    def positions(self, grams: np.ndarray):
        size = np.uint64(len(self.masks) - 1)
        for k in range(HASHES):
            yield ((grams >> np.uint64(31 * k)) & size).astype(np.int64)


def build_filter(languages: list[str], grams: dict[str, np.ndarray]) -> Model:
    total = max(1, sum(len(g) for g in grams.values()))
    size = 1 << max(10, int(16 * total / max(1, len(languages)) - 1).bit_length())
    masks = np.zeros((size, (len(languages) + 7) // 8 or 1), dtype=np.uint8)
    model = Model(languages, masks, np.zeros(len(languages)))
    for i, lang in enumerate(languages):
        for p in model.positions(grams.get(lang, np.zeros(0, np.uint64))):
            masks[p, i // 8] |= np.uint8(1 << (i % 8))
        model.fill[i] = np.mean((masks[:, i // 8] >> (i % 8)) & 1)
    return model


def classify(model: Model | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Predicted language and score (corrected share of n-grams found)."""
    lettered = [bool(t) and _LETTER.search(t) is not None for t in texts]
    if model is None or not any(lettered):
        return ["und"] * len(texts), [0.0] * len(texts)
    data, bounds = _letters_only([t if ok else "" for t, ok in zip(texts, lettered)])
    n_lang = len(model.languages)
    hits, total = np.zeros((len(texts), n_lang)), np.zeros(len(texts))
    for owner, grams in _grams(data, bounds):
        found = None
        for p in model.positions(grams):
            found = model.masks[p] if found is None else found & model.masks[p]
        total += np.bincount(owner, minlength=len(texts))
        for i in range(n_lang):
            bit = (found[:, i // 8] >> np.uint8(i % 8)) & np.uint8(1)
            hits[:, i] += np.bincount(owner, weights=bit, minlength=len(texts))
    false = np.minimum(model.fill ** HASHES, 0.999)
    fixed = np.maximum(0, (hits - total[:, None] * false) / (1 - false))
    best = np.argmax(fixed, axis=1)
    score = np.clip(fixed[np.arange(len(texts)), best] / np.maximum(total, 1), 0, 1)
    return ([model.languages[b] if ok else "und" for b, ok in zip(best, lettered)],
            [float(s) if ok else 0.0 for s, ok in zip(score, lettered)])


def train(docs: DataFrame, train_docs: int = 3000, min_share: float = 2e-5) -> Model | None:
    """Fit on rows with non-null ``text`` and ``lang`` (the caller selects
    them). One aggregate over distinct texts, then one pass over the sample."""
    spark = docs.sparkSession
    python_ready(spark)
    rows = docs.where("text is not null and lang is not null").select("lang", "text")
    texts = rows.select("lang", F.xxhash64("text").alias("h")).distinct()
    per_lang = {r.lang: r.n for r in texts.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not per_lang:
        return None
    spread = 1 << 20
    share = F.create_map(*[F.lit(x) for k, n in per_lang.items()
                           for x in (k, int(min(1.0, train_docs / n) * spread))])
    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(spread)) < share[F.col("lang")]) \
                 .dropDuplicates(["lang", "text"])
    schema = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())])

    def count(batches):
        start_task()
        for batch in batches:
            for part in slices(batch, 1):
                langs, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                data, bounds = _letters_only(texts)
                code = np.array([langs.index(x) for x in langs])
                for owner, grams in _grams(data, bounds):
                    for c in np.unique(code):
                        got, n = np.unique(grams[code[owner] == c], return_counts=True)
                        k = len(got)
                        yield batch_of(schema, [langs[c]] * k, [0] * k, got.view(np.int64), n)

    counts = sample.mapInArrow(count, "lang string, size int, gram long, n long") \
                   .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = counts.join(F.broadcast(counts.groupBy("lang").agg(F.sum("n").alias("total"))), "lang") \
                   .where(F.col("n") >= F.greatest(F.lit(2.0), F.col("total") * min_share / len(SIZES)))
    found = counts.select("lang", "gram").toPandas()
    languages = sorted(per_lang, key=lambda x: (-per_lang[x], x))
    return build_filter(languages, {k: g["gram"].to_numpy(np.int64).view(np.uint64)
                                    for k, g in found.groupby("lang")})


def predict(docs: DataFrame, model: Model | None, keep: list[str], with_text: bool = False) -> DataFrame:
    """``keep`` columns plus ``lang_pred`` and ``score``, one row per row;
    ``with_text`` keeps the text as well and names the two ``lang_pred__`` and
    ``score__``, which clash with no column. The model (bounded, see above)
    is broadcast."""
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(model)
    shown = [*keep, "text"] if with_text else keep
    names = ["lang_pred__", "score__"] if with_text else ["lang_pred", "score"]
    schema = docs.select(*shown).schema.add(names[0], "string").add(names[1], "double")

    def run(batches):
        start_task()
        for batch in batches:
            for part in slices(batch, len(keep)):
                lang, score = classify(shared.value, part.column(len(keep)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(shown)], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    names=[*shown, *names])

    return docs.select(*keep, "text").mapInArrow(run, schema)


def held_out(doc_id="doc_id"):
    """Rows never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def identify(docs: DataFrame) -> DataFrame:
    """Train on the rows that are not held out and predict every row."""
    model = train(docs.where(~held_out()))
    return predict(docs.withColumn("held_out", held_out()), model, ["doc_id", "held_out"])
