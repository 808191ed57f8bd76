"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

Merging pair by pair is not simulated. An Aho-Corasick automaton lists the tokens
that start at each place of a word; the longest is taken if it may stand beside
the token before it, else a shorter one, else the token before it is taken back.
Two tokens may be neighbours exactly if the merges that build them never join
symbols across their border earlier; each place of a word is given up at most
once, so the work is linear, and the result is the one of the merge order.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.tokens import _Memory, byte_letters

_BASE = -1  # rank of single symbols
_NEVER = 1 << 60
PAIRS = 2_000_000  # remembered neighbour checks of a worker


class BytePairCodec:
    """A vocabulary of words with an end-of-word mark, lower-cased, white space dropped."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split, letters = spec["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix") or steps != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or not split["invert"] or letters["use_regex"] or spec["decoder"] or spec["post_processor"]:
            raise ValueError("not a lower-casing word vocabulary")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_or_text = re.compile("|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None

        suffix = model["end_of_word_suffix"]
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}

        def symbols(token: str) -> str:
            # One character for each symbol: a byte, or 256 more for a byte that ends a word.
            last = token.endswith(suffix) and token != suffix
            codes = [byte_of[c] for c in (token[: -len(suffix)] if last else token)]
            return "".join(map(chr, codes[:-1])) + chr(codes[-1] + 256 * last)

        vocab = model["vocab"]
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.rank = [_BASE] * self.size
        self.parts: list[tuple[int, int]] = [(-1, -1)] * self.size
        self.merged: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            self.merged[a, b] = rank
            if self.rank[whole] == _BASE:
                self.rank[whole], self.parts[whole] = rank, (a, b)
        self.pairs: dict[int, bool] = {}

        self.length = [0] * self.size
        trie = ahocorasick.Automaton()
        reachable: set[int] = set()
        for token, i in sorted(vocab.items(), key=lambda x: self.rank[x[1]]):
            # A token whose parts are never left to its own merge cannot occur.
            a, b = self.parts[i]
            if a < 0 or (a in reachable and b in reachable and self._stay_apart(a, b, self.rank[i])):
                reachable.add(i)
                text = symbols(token)
                self.length[i] = len(text)
                trie.add_word(text, i)
        trie.make_automaton()
        self.trie = trie

        names = [b""] * self.size
        for token, i in [*vocab.items(), *self.special.items()]:
            names[i] = token.encode() + b" "  # decoding puts a blank between tokens
        self.table = np.frombuffer(b"".join(names), dtype=np.uint8)
        self.offsets = np.concatenate(([0], np.cumsum([len(n) for n in names])))
        self.memory = _Memory(self._chunk)
        self.word_memory = _Memory(lambda w: (self._word(w), True))

    def _stay_apart(self, left: int, right: int, own: int = _NEVER) -> bool:
        """Whether no merge with a rank below ``own`` joins the two tokens across their border.

        Goes back in time: of the pieces at the border the one built last is taken
        apart. A merge of the pieces happens if it is due before either is built
        into something larger; at equal ranks the left one comes first.
        """
        until_left = until_right = _NEVER
        while True:
            due = self.merged.get((left, right), _NEVER)
            if due < own and due < until_left and due <= until_right:
                return False
            a, b = self.rank[left], self.rank[right]
            if a == _BASE and b == _BASE:
                return True
            if b >= a:
                until_right, right = b, self.parts[right][0]
            else:
                until_left, left = a, self.parts[left][1]

    def _neighbours(self, left: int, right: int) -> bool:
        key = left * self.size + right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = self._stay_apart(left, right)
        return found

    def _word(self, word: str) -> bytes:
        raw = word.encode("utf-8", "surrogatepass")
        text = raw[:-1].decode("latin-1") + chr(raw[-1] + 256)
        n, length = len(text), self.length
        starts: list[list[int]] = [[] for _ in range(n + 1)]
        for end, token in self.trie.iter(text):
            starts[end + 1 - length[token]].append(token)
        # For one start the automaton reports shorter tokens first.
        alive = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        tries: list[int] = []
        at, k = 0, len(starts[0]) - 1
        while at < n:
            here = starts[at]
            while k >= 0 and not (alive[at + length[here[k]]] and (not out or self._neighbours(out[-1], here[k]))):
                k -= 1
            if k >= 0:
                out.append(here[k])
                tries.append(k)
                at += length[here[k]]
                k = len(starts[at]) - 1
            else:
                alive[at] = 0
                at -= length[out.pop()]
                k = tries.pop() - 1
        return np.array(out, dtype="<u4").tobytes()

    def _chunk(self, chunk: str) -> tuple[bytes, bool]:
        if chunk.isascii() and chunk.isalpha():
            return self._word(chunk), True
        return b"".join([self.word_memory[w] for w in self.words.findall(chunk)]), True

    def _plain(self, text: str) -> bytes:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # One character at a time, so a sigma stays the same wherever it stands.
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        # Separators that only Python takes for white space do not cut words here.
        chunks = re.split(r"[^\S\x1c-\x1f]+", text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()
        return b"".join(map(self.memory.__getitem__, chunks))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; null is empty."""
        text = text or ""
        self.memory.age()
        self.word_memory.age()
        if not any(s in text for s in self.special):
            return self._plain(text)
        out, at = [], 0
        for hit in self.special_or_text.finditer(text):
            out += [self._plain(text[at : hit.start()]), int(self.special[hit.group()]).to_bytes(4, "little")]
            at = hit.end()
        return b"".join([*out, self._plain(text[at:])])

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The tokens' texts with blanks between them, copied by place and length from one table."""
        if not len(ids):
            return b""
        first, size = self.offsets[ids], self.offsets[ids.astype(np.int64) + 1] - self.offsets[ids]
        before = np.cumsum(size) - size
        return self.table[np.repeat(first - before, size) + np.arange(int(size.sum()))].tobytes()[:-1]

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(np.asarray(ids, dtype=np.int64)).decode()


@lru_cache(maxsize=2)
def codec(path: str) -> BytePairCodec:
    """The worker's own codec; it lives as long as the worker."""
    return BytePairCodec(path)


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row; null text has no ids."""

    @F.arrow_udf("array<int>")
    def ids(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(vocabulary)
        for column in columns:
            yield pa.array([np.frombuffer(c.encode(x.as_py()), "<u4").astype(np.int32) for x in column], type=pa.list_(pa.int32()))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), ids(F.col(text_col).cast("string")).alias("ids"))


def decode_documents(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of every row; null ids give null."""

    @F.arrow_udf("string")
    def text(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(vocabulary)
        for column in columns:
            yield pa.array([None if not x.is_valid else c.decode(x.values.to_numpy()) for x in column], type=pa.string())

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), text(F.col(ids_col)).alias("text"))


def round_trip_digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Every document encoded and decoded again: (doc_id, n_tokens, ids_sha256, decoded_sha256)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch in batches:
            n, first, second = [], [], []
            for x in batch.column(1):
                ids = c.encode(x.as_py())
                n.append(len(ids) // 4)
                first.append(hashlib.sha256(ids).hexdigest())
                second.append(hashlib.sha256(c.decode_bytes(np.frombuffer(ids, "<u4"))).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(first), pa.array(second)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
