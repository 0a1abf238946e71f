"""Token ids and token counts from public tokenizers, through bounded caches in the workers.

A tokenizer of this kind splits a text into pre-tokens and encodes each by itself, so the
result for a text is the concatenation over its pre-tokens. Natural text repeats few of
them, and most of the library's time can be saved by a dictionary. What is cached here are
*chunks* (what stands between blanks, with the blank where the tokenizer keeps it); a new
chunk is split into pre-tokens with the tokenizer's own pattern, and new pre-tokens go to
the library in one batch.

Chunks of white-space-free vocabularies are found by Arrow: a slice of texts is split and
dictionary-encoded at once, so that Python sees each distinct chunk of a slice once, not each word.

A text only takes this way if it is made of characters for which the split and the
normal form are known to agree with the library's (``ORDINARY``); any other text goes to
the library whole. Results are the library's in every case.
"""

from __future__ import annotations

import os
import re
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# The patterns by which the two vocabularies split text.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Characters with one lower-case form, one normal form, and the same class everywhere.
ODD = re.compile(r"[^\t-\r\x20-\x7e\xa1-\xac\xae-įı-ž‐-‧€]")
WIDE_GAP = re.compile(r"\s\s")
#: Special tokens of the vocabularies begin like this.
SPECIAL = "<|"
#: Entries of one generation of a worker's cache, besides those that a single slice of texts needs.
CACHE_ENTRIES = 250_000
#: Longest entry of a table of frequent pre-tokens.
CACHE_CHARS = 48

_tokenizers: dict = {}


def tokenizer(path: str):
    """The library's tokenizer, loaded once per process."""
    if path not in _tokenizers:
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself where it is visible."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in visible}
    hidden = [b for b in range(256) if b not in letters]
    letters.update({b: chr(256 + i) for i, b in enumerate(hidden)})
    return [letters[b] for b in range(256)]


LETTERS = _byte_letters()


def encode_parts(path: str, parts: list[str], made=list) -> list:
    """Ids of pre-tokens, from the library's model itself; ``made`` holds those of each."""
    tokenize = tokenizer(path).model.tokenize
    written = LETTERS.__getitem__
    # ASCII letters and digits are written as they are.
    return [
        made([t.id for t in tokenize(p if p.isascii() and p.isalnum() else "".join(map(written, p.encode())))])
        for p in parts
    ]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def encode_all(path: str, texts: list[str]) -> list:
    return [e.ids for e in tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]


class Bounded:
    """A cache of two generations: a full one grows old, and what is used from it is kept."""

    def __init__(self):
        self.young: dict = {}
        self.old: dict = {}

    def fill(self, keys: set, compute) -> dict:
        """A mapping that holds all ``keys``; ``compute`` finds what is in neither generation."""
        missing = keys.difference(self.young)
        if missing:
            old = self.old
            again = {k: old[k] for k in missing if k in old}
            fresh = compute([k for k in missing if k not in again])
            if len(self.young) + len(missing) > CACHE_ENTRIES:
                self.old, self.young = self.young, {k: self.young[k] for k in keys if k in self.young}
            self.young.update(again)
            self.young.update(fresh)
        return self.young


class WordIds:
    """Ids of texts for a vocabulary that drops white space and letter case."""

    def __init__(self, path: str):
        self.path = path
        self.split = regex.compile(WORD_PATTERN).findall
        self.parts, self.chunks = Bounded(), Bounded()

    def _encode(self, parts: list[str]) -> dict:
        return dict(zip(parts, encode_parts(self.path, parts, _packed)))

    def _split(self, chunk: str) -> list[str]:
        if chunk.isalpha() or not chunk:  # Arrow's split gives empty chunks at the ends of a text
            return [chunk]
        word = chunk[:-1]
        if chunk[-1] in ".,;:!?" and word.isalpha():
            return [word, chunk[-1]]
        return self.split(chunk)

    def _join(self, chunks: list[str]) -> dict:
        # One flat list: the interpreter's garbage collector walks over every small one that is kept.
        parts, ends = [], []
        for c in chunks:
            parts += self._split(c)
            ends.append(len(parts))
        ids = list(map(self.parts.fill(set(parts), self._encode).__getitem__, parts))
        return {c: b"".join(ids[a:b]) for c, a, b in zip(chunks, chain((0,), ends), ends)}

    def _plain(self, texts: list[str]) -> list[bytes]:
        """As a call, for texts of ordinary characters."""
        split = pc.ascii_split_whitespace(pc.utf8_lower(pa.array(texts, pa.string())))
        words = pc.dictionary_encode(pc.list_flatten(split))
        chunks = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.chunks.fill(set(chunks), self._join)
        ids = np.array([known[c] for c in chunks] or [b""], dtype=object)
        words, ends = words.indices.to_numpy(), split.offsets.to_numpy().tolist()
        return [b"".join(ids[words[a:b]].tolist()) for a, b in zip(ends, ends[1:])]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """For each text its ids, as little-endian unsigned 32-bit numbers."""
        odd = [bool(ODD.search(t)) or SPECIAL in t for t in texts]
        plain = iter(self._plain([t for t, o in zip(texts, odd) if not o]))
        others = iter(encode_all(self.path, [t for t, o in zip(texts, odd) if o]))
        return [np.asarray(next(others), dtype="<u4").tobytes() if o else next(plain) for o in odd]


class ByteCounts:
    """Numbers of tokens for a byte-level vocabulary that keeps white space.

    ``frequent`` holds the lengths of frequent pre-tokens and never changes; other
    pre-tokens are encoded once and cached.
    """

    def __init__(self, path: str, frequent: dict[str, int]):
        self.path, self.frequent = path, frequent
        self.split = regex.compile(BYTE_PATTERN).findall
        self.parts, self.chunks = Bounded(), Bounded()

    def _encode(self, parts: list[str]) -> dict:
        return {p: len(i) for p, i in zip(parts, encode_parts(self.path, parts))}

    def _sum(self, chunks: list[str]) -> dict:
        split = [self.split(c) for c in chunks]
        misses = set(chain.from_iterable(split)).difference(self.frequent)
        known, frequent = self.parts.fill(misses, self._encode), self.frequent
        return {c: sum(frequent[p] if p in frequent else known[p] for p in s) for c, s in zip(chunks, split)}

    def pieces(self, text: str) -> list[str] | None:
        """Chunks of which the pre-tokens of the text are made; None: leave it to the library."""
        if ODD.search(text) or SPECIAL in text:
            return None
        if WIDE_GAP.search(text):
            return self.split(text)
        first, *rest = text.split(" ")
        return [first, *map(" ".__add__, rest)]

    def __call__(self, texts: list[str]) -> list[int]:
        plain = [self.pieces(t) for t in texts]
        known = self.chunks.fill(set(chain.from_iterable(p for p in plain if p)), self._sum).__getitem__
        odd = iter(encode_all(self.path, [t for t, p in zip(texts, plain) if p is None]))
        return [len(next(odd)) if p is None else sum(map(known, p)) for p in plain]
