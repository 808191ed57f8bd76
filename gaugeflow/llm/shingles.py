"""Words and five-word shingles of whole texts as 64-bit hashes, a batch at a time.

A word is a run of bytes other than space and ``\\x09-\\x0D``; A-Z count as a-z.
A word's hash is a sum of random values per byte times powers of an odd base, so
one pass over a batch hashes all its words. Two words, or two shingles of one
document, that collide would be taken for equal; at 64 bits that is the only
deviation from comparing strings (below 1e-9 for a document of 100,000 words).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS_PER_SHINGLE = 5
PIECE = 1 << 18  # bytes hashed at once
LONG_WORD = 1 << 12  # bytes of a word whose powers are kept

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True


def _byte_values() -> np.ndarray:
    values = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64)
    values = values * np.uint64(2) + np.uint64(1)
    values[65:91] = values[97:123]
    values[_SPACE] = 0
    return values


_VALUE = _byte_values()
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACE = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    steps = np.full(n, _BASE, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_POWERS = _powers(LONG_WORD)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits; a bijection."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def text_pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row borders) of runs of rows with at most ``PIECE`` bytes or one row; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    borders = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(borders, borders[row] + PIECE, side="right")) - 1)
        yield row, data[borders[row] : borders[stop]], borders[row : stop + 1] - borders[row]
        row = stop


def word_hashes(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for every row border the words before it."""
    space = _SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    inner = borders[1:-1]
    inner = inner[inner < len(data)]
    first[inner] = ~space[inner]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(borders), np.int64)
    # What lies before the first word or between words is space and adds nothing.
    at = np.arange(len(data)) - np.repeat(np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [len(data)]))))
    at[space] = 0
    longest = int(at.max()) + 1
    power = _POWERS if longest <= LONG_WORD else _powers(longest)
    sums = np.add.reduceat(_VALUE[data] * power[at], starts)
    return mix(sums), np.searchsorted(starts, borders)


def _words_in_parts(data: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, hashed part by part, each ending at a space."""
    out, start = [], 0
    while start < len(data):
        stop = min(len(data), start + PIECE)
        while stop < len(data) and not _SPACE[data[stop - 1]]:
            more = np.flatnonzero(_SPACE[data[stop : stop + PIECE]])
            stop = stop + int(more[0]) + 1 if len(more) else min(len(data), stop + PIECE)
        part = data[start:stop]
        out.append(word_hashes(part, np.array([0, len(part)]))[0])
        start = stop
    return np.concatenate(out)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every row.

    With one to four words the whole sequence is the only shingle; without words
    or text the set is empty.
    """
    k = WORDS_PER_SHINGLE
    for _, data, borders in text_pieces(column):
        if len(borders) == 2 and len(data) > PIECE:
            words = _words_in_parts(data)
            ends = np.array([0, len(words)])
        else:
            words, ends = word_hashes(data, borders)
        rolled = np.zeros(max(0, len(words) - k + 1), dtype=np.uint64)
        for j in range(k):
            rolled += words[j : j + len(rolled)] * _PLACE[j]
        rolled = mix(rolled)
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            if b - a >= k:
                yield np.unique(rolled[a : b - k + 1])
            elif b > a:
                short = np.uint64(b - a) + (words[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64)
                yield mix(np.array([short], dtype=np.uint64))
            else:
                yield np.zeros(0, dtype=np.uint64)
