"""Counts of all words of a corpus, and the words that are commonest.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z lower-cased,
then one end. Tasks add up words before the shuffle, so a word that is in every
text is one row per task and flush.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import cut, slices, text_buffers

#: Different words that a task adds up before it passes them on.
FLUSH = 400_000
#: Words that a driver and every task may hold, and their greatest length.
HEAD = 1 << 18
HEAD_BYTES = 64


def tokens(batch: pa.RecordBatch, column: int) -> Iterator[list[bytes]]:
    """The words of every text of a slice (without the end), one after the other."""
    data, offsets = text_buffers(batch.column(column))
    ends = offsets.tolist()
    raw = data.tobytes().lower()  # of bytes: A-Z only
    return (raw[a:b].split() for a, b in zip(ends[:-1], ends[1:]))  # of bytes: at \x20 and \x09-\x0D


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over whole texts, written once."""
    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for part in slices(batch, 0):
                for words in tokens(part, 0):
                    seen.update(words)
                if len(seen) >= FLUSH:
                    yield pa.RecordBatch.from_pydict({"word": pa.array(seen.keys(), pa.binary()), "n": pa.array(seen.values(), pa.int64())})
                    seen = Counter()
        yield pa.RecordBatch.from_pydict({"word": pa.array(seen.keys(), pa.binary()), "n": pa.array(seen.values(), pa.int64())})

    made = docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return cut(made, "word-counts")


@dataclass
class Corpus:
    texts: int                # ends
    total: int                # tokens, ends included
    types: int                # different tokens, the end included
    head: list[bytes]         # commonest words first
    head_n: list[int]
    rest: DataFrame           # (word, n) of the other words

    @property
    def mass(self) -> int:
        """Denominator of the add-one estimate."""
        return self.total + self.types + 1


def corpus(docs: DataFrame, head: int = HEAD) -> Corpus:
    """Counts of ``docs``. The head takes all words of at most ``HEAD_BYTES``
    bytes from a count on that keeps them to ``head`` or fewer; that count is
    found from how many words there are of each magnitude (a bounded table)."""
    counts = word_counts(docs)
    texts = docs.count()
    size = F.when(F.length("word") <= HEAD_BYTES,
                  F.when(F.col("n") < 1024, F.col("n")).otherwise(F.floor(F.log2("n") * 64) + (1024 - 640)))
    by_size = counts.groupBy(size.alias("size")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()
    least, room = 1 << 30, head
    for r in sorted((r for r in by_size if r["size"] is not None), key=lambda r: -r["size"]):
        room -= r["words"]
        if room < 0:
            break
        least = r["size"]
    common = F.coalesce(size >= least, F.lit(False))
    top = sorted(((r.n, bytes(r.word)) for r in counts.where(common).collect()), key=lambda r: (-r[0], r[1]))
    return Corpus(texts, sum(r.n for r in by_size) + texts, sum(r.words for r in by_size) + (texts > 0),
                  [w for _, w in top], [n for n, _ in top], counts.where(~common))
