"""Ids of a byte-level BPE tokenizer, word by word.

A text without two spaces in a row is cut before each space: the
pre-tokenizer never lets a piece run across such a place. Words repeat, so
each worker remembers the ids of recent ones (at most ``CACHE_ENTRIES``). A
new word is cut further between a Latin letter and one of a few marks or a
line break, where the pre-tokenizer always cuts too; such plain parts are
merged by rank with ``tiktoken`` (the ranks are read from the same file, which
is checked to list its merges in the order of their ids). Everything else,
special strings and texts with runs of spaces included, goes to the
tokenizer's own library.
"""

from __future__ import annotations

import json
import os
import re
from array import array

from corpusmill.llm.common import holds
from corpusmill.llm.recent import Recent

CACHE_ENTRIES = 400_000
_LETTERS = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
_PLAIN = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[.,;:!?&$%*#]+|\n(?!\n)")


class ByteBpe:
    def __init__(self, tokenizer_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(tokenizer_file)
        self.library.no_truncation()
        self.library.no_padding()
        self.ranks = self._by_rank(tokenizer_file)
        self.spaced = Recent(lambda w: self.word(" " + w), CACHE_ENTRIES)
        self.parts = Recent(self.part, CACHE_ENTRIES)

    @staticmethod
    def _by_rank(tokenizer_file: str):
        """A rank encoder for plain parts, or None if ids are no ranks."""
        import tiktoken
        with open(tokenizer_file, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in vocab.items()
                 if i < 256 + len(merges) and all(c in byte_of for c in t)}
        return tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def part(self, text: str) -> bytes:
        return array("I", self.ranks.encode_ordinary(text)).tobytes()

    def word(self, text: str) -> bytes:
        if self.ranks is not None and _LETTERS.fullmatch(text):  # the most common word is one part
            return self.part(text)
        parts = _PLAIN.findall(text) if self.ranks is not None else ()
        if sum(map(len, parts)) != len(text):  # something else in between
            return self.whole(text)
        return self.part(text) if len(parts) == 1 else b"".join(map(self.parts.__getitem__, parts))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if "  " in text:
            return self.whole(text)
        first, *rest = text.split(" ")
        return b"".join([self.word(first) if first else b"", *map(self.spaced.__getitem__, rest)])


_LOADED: dict[str, ByteBpe] = {}


def load(tokenizer_file: str) -> ByteBpe:
    if tokenizer_file not in _LOADED:
        _LOADED[tokenizer_file] = ByteBpe(tokenizer_file)
    holds("byte_bpe", _LOADED.clear)
    return _LOADED[tokenizer_file]
