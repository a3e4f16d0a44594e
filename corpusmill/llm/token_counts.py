"""Token counts with overlap resynchronisation (operator 5).

A document of more than ``CHUNK`` characters is encoded by the library in
overlapping chunks, with offsets. Two neighbouring chunks are spliced at a
white-space character of their overlap: the pre-tokenizer drops white space
and neither the merges nor the normalisation reach across it, so what follows
it is encoded alike in both; the tokens' offsets from there to the overlap's
last white space are compared as well. Where the overlap holds no two such
characters, or the offsets differ, the left chunk is encoded again with twice
its length (and so a wider overlap) until they agree or the document ends.

Shorter documents are cut at white space straight away, and each worker
remembers the counts of recent words (at most ``CACHE_ENTRIES``); new words
go to the library in one call per batch. Special strings hold no white space,
so the library sees each of them whole and treats it as its default.

Defined results: a null text counts as empty (0 bytes, 0 tokens); a null
doc_id is kept; rows repeat as in the input; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame

from corpusmill.llm.common import batch_of, python_ready, slices, text_buffers
from corpusmill.llm.recent import Recent

CHUNK = 65_536
OVERLAP = 512
CACHE_ENTRIES = 1_000_000
_SPACE = re.compile(r"[ \n\t\r]")
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_TAIL = ".,;:!?&$%*#"


class Counter:
    def __init__(self, tokenizer_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(tokenizer_file)
        self.library.no_truncation()
        self.library.no_padding()
        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [x["type"] for key, inner in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))
                 for x in (spec.get(key) or {}).get(inner, [])]
        self.plain = kinds == ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.shown = {chr(b): chr(b) for b in shown} | {chr(b): chr(256 + i) for i, b in enumerate(hidden)}
        self.shown = str.maketrans(self.shown)
        self.words = Recent(self.word, CACHE_ENTRIES)
        self.words[""] = 0

    def word(self, word: str) -> int:
        """A trailing run of marks after an ASCII letter is a word of its own
        to the pre-tokenizer; a word of Latin-1 letters goes to the merges
        directly, lower-cased and with its bytes written as characters."""
        head = word.rstrip(_TAIL)
        if head and len(head) < len(word) and head[-1].isascii() and head[-1].isalpha():
            return self.words[head] + self.words[word[len(head):]]
        if self.plain and _LETTERS.fullmatch(word):
            low = word.lower()
            if not low.isascii():
                low = low.encode().decode("latin-1").translate(self.shown)
            return len(self.library.model.tokenize(low))
        return len(self.library.encode(word, add_special_tokens=False))

    def short(self, text: str) -> int:
        return sum(map(self.words.__getitem__,
                       text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")))

    def starts(self, text: str, at: int, size: int) -> list[int]:
        """Where each token of the chunk begins, as places in the document."""
        got = self.library.encode(text[at:at + size], add_special_tokens=False)
        return [at + a for a, _ in got.offsets]

    def long(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        total, begin, size, counted_to = 0, 0, chunk + overlap, 0
        left = self.starts(text, 0, size)
        while begin + size < len(text):
            right_at = begin + size - overlap
            right = self.starts(text, right_at, chunk + overlap)
            marks = [m.start() for m in _SPACE.finditer(text, right_at, begin + size)]
            place = self.stable(left, right, marks, counted_to)
            if place is None:
                size = 2 * size
                overlap_left = min(size, len(text) - begin)
                left = self.starts(text, begin, overlap_left)
                overlap = min(2 * overlap, chunk)
                continue
            total += bisect_left(left, place) - bisect_left(left, counted_to)
            counted_to, left, begin, size = place, right, right_at, chunk + overlap
        return total + len(left) - bisect_left(left, counted_to)

    @staticmethod
    def stable(left: list[int], right: list[int], marks: list[int], after: int) -> int | None:
        """First white space from which both chunks' tokens agree."""
        marks = [m for m in marks if m >= after]
        if len(marks) < 2:
            return None
        first, last = marks[0], marks[-1]
        mine = left[bisect_left(left, first):bisect_left(left, last)]
        return first if mine == right[bisect_left(right, first):bisect_left(right, last)] else None

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        return self.short(text) if len(text) <= CHUNK else self.long(text)


_LOADED: dict[str, Counter] = {}


def load(tokenizer_file: str) -> Counter:
    if tokenizer_file not in _LOADED:
        _LOADED[tokenizer_file] = Counter(tokenizer_file)
    return _LOADED[tokenizer_file]


def count_tokens(docs: DataFrame, tokenizer_file: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row, whole texts."""
    python_ready(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        counter = load(tokenizer_file)
        for batch in batches:
            for part in slices(batch, 1):
                n = [counter.count(t) for t in part.column(1).to_pylist()]
                size = text_buffers(part.column(1))[1]
                schema = pa.schema([("doc_id", part.schema[0].type), ("n_bytes", pa.int64()),
                                    ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])
                yield batch_of(schema, part.column(0), size[1:] - size[:-1], n, [x > limit for x in n])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
