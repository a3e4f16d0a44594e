"""SentencePiece BPE encoding and decoding with a prefix table (operator 3).

For every prefix of a chunk the table stores the one token that ends the
prefix's encoding. Candidates are the vocabulary pieces that end there (all
found by one pass of an Aho-Corasick automaton); a candidate is right when it
is compatible with the token stored where it begins, that is, when merging
the two pieces' joined text gives exactly these two pieces. The ids are then
read off backwards from the end of the table. Pair tests are remembered.

A text is cut between two characters that stand side by side in no piece of
the vocabulary, since no piece can lie across: before a space mark that
follows another character, around line breaks (a vocabulary where this does
not hold gets its texts as one chunk), and inside words. Chunks repeat, so
each worker remembers the ids of recent chunks, up to ``CACHE_ENTRIES``.

Runs of space marks share one score, for which the pair test is not decisive;
chunks that hold two marks in a row, and any chunk for which the table finds
no token, are merged directly with a heap.

Defined results: a null or empty text has begin and end id only and decodes
to the empty text. Rows repeat as often as in the input, and other columns
are not read; a null doc_id is kept.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from array import array
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusmill.llm.common import batch_of, python_ready, slices
from corpusmill.llm.recent import Recent

MARK = "▁"
CACHE_ENTRIES = 1_200_000
PAIR_ENTRIES = 2_000_000
_RUNS = re.compile(r"\n| +[^ \n]*|[^ \n]+")

codecs.register_error("one_mark_per_byte", lambda e: ("�" * (e.end - e.start), e.end))


class PieceBpe:
    """Tables of one model file (read once per worker)."""

    def __init__(self, model_file: str):
        from sentencepiece import sentencepiece_model_pb2
        proto = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            proto.ParseFromString(f.read())
        norm, spec = proto.normalizer_spec, proto.trainer_spec
        if (norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix
                or spec.model_type != 2 or not spec.byte_fallback):
            raise ValueError("only BPE models with byte fallback and identity normalisation are supported")
        normal, byte = 1, 6
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == normal}
        self.score = {p.piece: p.score for p in proto.pieces if p.type == normal}
        self.text = [p.piece for p in proto.pieces]
        self.byte_id = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == byte}
        of_byte = {i: bytes([b]) for b, i in self.byte_id.items()}
        self.raw = [of_byte.get(i, p.piece.replace(MARK, " ").encode() if p.type == normal else b"")
                    for i, p in enumerate(proto.pieces)]
        self.raw_flat = np.frombuffer(b"".join(self.raw), np.uint8)
        self.raw_size = np.array([len(r) for r in self.raw])
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.bos = next(i for i, p in enumerate(proto.pieces) if p.piece == "<s>")
        self.eos = next(i for i, p in enumerate(proto.pieces) if p.piece == "</s>")
        #: character pairs inside some piece; between any other two a text may be cut
        self.inner = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.cuttable = not any("\n" in p or (p[0] != MARK and p[1] == MARK) for p in self.inner)
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.length = [len(p) for p in self.text]
        self.known = set("".join(self.ids))
        self.pairs: dict[int, bool] = {}
        self.spaced = Recent(partial(self.word_ids, MARK), CACHE_ENTRIES)
        self.plain = Recent(partial(self.word_ids, ""), CACHE_ENTRIES)

    def merge(self, s: str) -> list[str]:
        """Pieces of ``s`` by merging the best-scored neighbours, leftmost first."""
        parts = list(s)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap = []

        def offer(i):
            j = after[i]
            if j < len(parts) and (score := self.score.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-score, i, j, len(parts[i]) + len(parts[j])))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, j, size = heapq.heappop(heap)
            if not parts[i] or after[i] != j or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i] += parts[j]
            parts[j] = ""
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [p for p in parts if p]

    def compatible(self, left: int, right: int) -> bool:
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is None:
            a, b = self.text[left], self.text[right]
            known = self.merge(a + b) == [a, b]
            if len(self.pairs) >= PAIR_ENTRIES:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def table(self, chunk: str) -> list[int] | None:
        """Last token of each prefix's encoding; None where the table does
        not decide. A character outside the vocabulary is -1, which any
        token may follow, as is the start."""
        last = [-2] * (len(chunk) + 1)
        last[0] = -1
        if not self.known.issuperset(chunk):
            for i, c in enumerate(chunk):
                if c not in self.known:
                    last[i + 1] = -1
        known_pair, length = self.pairs.get, self.length
        for end, token in self.automaton.iter(chunk):
            if last[end + 1] == -2:
                left = last[end + 1 - length[token]]
                if left >= 0:
                    fits = known_pair(left << 20 | token)
                    if fits or fits is None and self.compatible(left, token):
                        last[end + 1] = token
                elif left == -1:
                    last[end + 1] = token
        return None if -2 in last else last

    def chunk_ids(self, chunk: str) -> bytes:
        """Ids of a chunk with space marks, as unsigned 32-bit integers."""
        last = None if MARK + MARK in chunk else self.table(chunk)
        out = array("I")
        if last is None:
            for piece in self.merge(chunk):
                i = self.ids.get(piece)
                out.extend([i] if i is not None else [self.byte_id[b] for b in piece.encode()])
            return out.tobytes()
        at = len(chunk)
        while at:
            token = last[at]
            if token < 0:
                at -= 1
                out.extend(self.byte_id[b] for b in reversed(chunk[at].encode()))
            else:
                out.append(token)
                at -= self.length[token]
        out.reverse()
        return out.tobytes()

    def word_ids(self, prefix: str, word: str) -> bytes:
        """Ids of ``prefix + word``, cut where no piece can lie across."""
        full, skip = prefix + word.replace(" ", MARK), len(prefix)
        for at in range(len(full) - 1, 0, -1):
            if full[at - 1:at + 1] not in self.inner:
                same = self.spaced if prefix else self.plain
                left = same[word[:at - skip]] if at > skip and at <= 64 else self.chunk_ids(full[:at])
                return left + (self.plain[full[at:]] if len(full) - at <= 64 else self.chunk_ids(full[at:]))
        return self.chunk_ids(full)

    def encode(self, text: str | None) -> bytes:
        """Ids without begin and end, as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        text = " " + (text.replace(MARK, " ") if MARK in text else text)
        if not self.cuttable:
            return self.chunk_ids(text.replace(" ", MARK))
        out = []
        if "  " in text:
            out.extend(map(self.plain.__getitem__, _RUNS.findall(text)))
        else:
            for k, line in enumerate(text.split("\n")):
                if k:
                    out.append(self.plain["\n"])
                words = line.split(" ")
                if words[0]:
                    out.append(self.plain[words[0]])
                out.extend(map(self.spaced.__getitem__, words[1:]))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of ids: control pieces vanish, one leading space goes, byte
        pieces are read as UTF-8 (one U+FFFD per byte that is not)."""
        tokens = np.frombuffer(ids, "<u4")
        size = self.raw_size[tokens]
        place = np.repeat(self.raw_start[tokens] - np.cumsum(size) + size, size)
        raw = self.raw_flat[place + np.arange(len(place))].tobytes()
        return raw[raw[:1] == b" ":].decode("utf-8", "one_mark_per_byte")


_LOADED: dict[str, PieceBpe] = {}


def load(model_file: str) -> PieceBpe:
    if model_file not in _LOADED:
        _LOADED[model_file] = PieceBpe(model_file)
    return _LOADED[model_file]


def encode_decode(docs: DataFrame, model_file: str, digest: bool = True) -> DataFrame:
    """doc_id, n_tokens and either the ids and the decoded text, or (with
    ``digest``) their SHA-256, with begin and end id."""
    python_ready(docs.sparkSession)
    names = ["ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"]
    kinds = ["string", "string"] if digest else ["binary", "string"]
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        bpe = load(model_file)
        bos, eos = (int(i).to_bytes(4, "little") for i in (bpe.bos, bpe.eos))
        for batch in batches:
            for part in slices(batch, 1):
                counts, first, second = [], [], []
                for text in part.column(1).to_pylist():
                    ids = bos + bpe.encode(text) + eos
                    back = bpe.decode(ids)
                    counts.append(len(ids) // 4)
                    first.append(hashlib.sha256(ids).hexdigest() if digest else ids)
                    second.append(hashlib.sha256(back.encode()).hexdigest() if digest else back)
                schema = pa.schema([("doc_id", part.schema[0].type), ("n_tokens", pa.int64()),
                                    (names[0], pa.string() if digest else pa.binary()), (names[1], pa.string())])
                yield batch_of(schema, part.column(0), counts, first, second)

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_tokens long, {names[0]} {kinds[0]}, {names[1]} {kinds[1]}")
