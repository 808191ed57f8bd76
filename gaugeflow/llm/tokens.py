"""Exact token ids of whole texts from the ``tokenizers`` library, one call per distinct word.

A byte-level BPE with the usual pattern never lets a token cross the place
between a non-space and a single space (or line feed) before another non-space.
Texts are cut there and only pieces not met before are handed to the library; the
pieces' ids, in order, are the text's ids. Texts that hold a special token, and
tokenizers of another build, go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from functools import lru_cache

CACHE = 600_000  # pieces of a generation; a worker remembers two
LONGEST = 256  # characters of a piece that is remembered

_WORD = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ]+")  # surely letters in every version of Unicode
_CUT = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


_LETTERS = dict(enumerate(byte_letters()))


class _Uneven(Exception):
    """Spaces in a row, or a space next to a line feed."""


class _Memory(dict):
    """Piece to ids; what is missing is worked out and kept.

    When a generation is full it becomes the old one; pieces met again move over.
    """

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, piece):
        ids = self.old.get(piece)
        if ids is None:
            ids, keep = self.make(piece)
            if not keep or len(piece) > LONGEST:
                return ids
        self[piece] = ids
        return ids

    def age(self) -> None:
        if len(self) > CACHE:
            self.old = dict(self)
            self.clear()


class TextEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the task's core only
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.special = [t["content"] for t in spec["added_tokens"]]
        before = spec["pre_tokenizer"] or {}
        self.by_piece = (
            spec["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex")
            and not before.get("add_prefix_space")
            and spec["model"].get("end_of_word_suffix") is None
            and not spec["model"].get("dropout")
        )
        self.pieces = _Memory(self._piece)
        self.after_space = _Memory(self._after_space)  # the piece " " + key

    def _library(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        """A word of letters, with or without the space before it, is one unit of the library's merges."""
        return _packed([t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(_LETTERS))])

    def _spaced(self, word: str) -> bytes:
        if not word.isascii():
            return self._word(" " + word)
        return _packed([t.id for t in self.model.tokenize(_LETTERS[32] + word)])

    def _piece(self, piece: str) -> tuple[bytes, bool]:
        return (self._word(piece) if _WORD.fullmatch(piece) else self._library(piece)), True

    def _after_space(self, piece: str) -> tuple[bytes, bool]:
        if _WORD.fullmatch(piece):
            return self._spaced(piece), True
        if piece == "" or piece[0].isspace() or piece[-1].isspace():
            raise _Uneven
        if piece[-1] in ".,;:!?" and _WORD.fullmatch(piece, 0, len(piece) - 1):
            return self.after_space[piece[:-1]] + self.pieces[piece[-1]], True
        if "\n" in piece:
            lines = piece.split("\n")
            if not any(x == "" or x[0].isspace() or x[-1].isspace() for x in lines):
                return self.pieces["\n"].join([self.after_space[lines[0]], *map(self.pieces.__getitem__, lines[1:])]), False
        return self._library(" " + piece), True

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self.by_piece or any(s in text for s in self.special):
            return self._library(text)
        self.pieces.age()
        self.after_space.age()
        first, _, rest = text.partition(" ")
        if rest and first and not first[-1].isspace() and not rest[-1].isspace():
            try:
                return self._cut(first) + b"".join(map(self.after_space.__getitem__, rest.split(" ")))
            except _Uneven:
                pass
        return self._cut(text)

    def _cut(self, text: str) -> bytes:
        return b"".join([self.pieces[p] for p in _CUT.split(text)]) if text else b""


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


@lru_cache(maxsize=4)
def encoder(path: str) -> TextEncoder:
    """The worker's own encoder; it lives as long as the worker."""
    return TextEncoder(path)
