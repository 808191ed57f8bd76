"""Conversations as a prefix tree of formatted tokens: what several share stands there once.

A turn becomes one segment: ``<s>text</s>`` if the assistant speaks, else
``[INST]role<s>text[/INST]``. The control strings have ids of their own beyond the
vocabulary; inside roles and texts they are broken by a backslash after their first
character (a backslash is doubled), so the formatted string reads back as well.

Conversations that begin with the same turns share the segments of those turns. A
node of the tree is known by a digest chained over the turns before it. Segments lie
in depth-first order, which is the order of the conversations sorted by the digests of
their turns: a segment belongs to the first conversation through it, and that one
gives its place. Only narrow rows are sorted, ranked and counted; a first turn that a
third of all conversations share is folded before the shuffle, and no tree is ever in
one task. A position id counts the tokens of the conversation before, not of the
stream; ``attends`` lists, as merged half-open intervals of the stream, the tokens of
the ancestors and of the segment itself (there up to the own token only).
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.tokens import byte_letters, encoder
from gaugeflow.session import materialise

# The control strings, and the vocabulary's own, which are broken too.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
RESERVED = (*CONTROL, "<|endoftext|>")
BEGIN, END, ASK, ASKED = range(4)
ASSISTANT = "assistant"
BATCH_BYTES = 1 << 22

_BREAK = re.compile(r"\\|" + "|".join(f"{re.escape(s[0])}(?={re.escape(s[1:])})" for s in RESERVED))
_JOIN = re.compile(r"\\(\\?)")


def escaped(text: str) -> str:
    return _BREAK.sub(lambda m: m.group() + "\\", text)


def unescaped(text: str) -> str:
    return _JOIN.sub(r"\1", text)


class ChatCodec:
    """Segments to ids and back."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.encoder = encoder(vocabulary)
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        tokens = {i: bytes(map(byte_of.__getitem__, t)) for t, i in vocab.items() if all(c in byte_of for c in t)}
        self.control = max([*vocab.values(), *self.encoder_specials()]) + 1
        size = [len(tokens.get(i, b"")) for i in range(self.control)]
        self.offsets = np.concatenate(([0], np.cumsum(size)))
        self.table = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(self.control)), dtype=np.uint8)

    def encoder_specials(self) -> list[int]:
        return [self.encoder.tokenizer.token_to_id(s) for s in self.encoder.special]

    def _text(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encoder.encode(escaped(text)), "<u4")

    def segment(self, role: str, text: str) -> tuple[np.ndarray, int, int]:
        """Ids, and the ids under the loss mask as (first, end)."""
        ids = self._text(text)
        mark = np.arange(self.control, self.control + len(CONTROL), dtype="<u4")
        if role == ASSISTANT:
            return np.concatenate((mark[[BEGIN]], ids, mark[[END]])), 1, 1 + len(ids)
        return np.concatenate((mark[[ASK]], self._text(role), mark[[BEGIN]], ids, mark[[ASKED]])), 0, 0

    def string(self, ids: np.ndarray) -> str:
        """The text of ids without control ids, still escaped."""
        ids = ids.astype(np.int64)
        first, size = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        before = np.cumsum(size) - size
        return self.table[np.repeat(first - before, size) + np.arange(int(size.sum()))].tobytes().decode() if len(ids) else ""

    def turn(self, ids: np.ndarray) -> tuple[bool, str, str]:
        """Whether the assistant speaks, and role and text of a segment, still escaped; the assistant's role is not written."""
        begin = int(np.flatnonzero(ids == self.control + BEGIN)[0])
        return begin == 0, self.string(ids[1:begin]), self.string(ids[begin + 1 : -1])


def spoken(turn: tuple[bool, str, str]) -> tuple[str, str]:
    """Role and text of a turn."""
    reply, role, text = turn
    return (ASSISTANT if reply else unescaped(role)), unescaped(text)


def formatted(turn: tuple[bool, str, str]) -> str:
    """The turn as it is written."""
    reply, role, text = turn
    return f"<s>{text}</s>" if reply else f"[INST]{role}<s>{text}[/INST]"


@lru_cache(maxsize=2)
def codec(vocabulary: str) -> ChatCodec:
    """The worker's own codec."""
    return ChatCodec(vocabulary)


class _Rows:
    """Collects output rows and hands them over as batches of bounded size."""

    def __init__(self, names: list[str], kinds: list[pa.DataType]):
        self.names, self.kinds, self.rows, self.size = names, kinds, [], 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += 100 + size
        if self.size > BATCH_BYTES:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*self.rows), self.kinds)], names=self.names)
        self.rows, self.size = [], 0


def _parts(batches: Iterator[pa.RecordBatch], n: int = 1000) -> Iterator[list]:
    for batch in batches:
        for start in range(0, batch.num_rows, n):
            yield [c.to_pylist() for c in batch.slice(start, n).columns]


_NONE = object()


def conversation_turns(conversations: DataFrame, vocabulary: str) -> DataFrame:
    """Every turn with its place, node, ids and position; after a conversation's turns one row with its path.

    Rows are taken by turn (null first), role, text. The path is the digests of all turns, one after another.
    """
    names = ["conv_id", "place", "node", "tokens", "n_tokens", "position", "loss_from", "loss_to", "path"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, out = codec(vocabulary), _Rows(names, kinds)
        now, place, node, position, path = _NONE, 0, b"", 0, bytearray()
        for part in _parts(batches):
            c.encoder.pieces.age()
            for conv_id, role, text in zip(*part):
                if conv_id != now:
                    if now is not _NONE:
                        yield from out.add((now, *[None] * 7, bytes(path)), len(path))
                    now, place, node, position, path = conv_id, 0, b"", 0, bytearray()
                own = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
                node = hashlib.sha256(node + own).digest()[:16]
                path += own
                ids, loss_from, loss_to = c.segment(role, text)
                yield from out.add((conv_id, place, node, ids.tobytes(), len(ids), position, loss_from, loss_to, None), ids.nbytes)
                place += 1
                position += len(ids)
        if now is not _NONE:
            yield from out.add((now, *[None] * 7, bytes(path)), len(path))
        yield from out.rest()

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in ("role", "text")))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return rows.mapInArrow(run, "conv_id long, place long, node binary, tokens binary, n_tokens long, position long, loss_from long, loss_to long, path binary")


def chat_tree(conversations: DataFrame, vocabulary: str) -> tuple[DataFrame, DataFrame]:
    """(segments, members) of all conversations.

    ``segments``: start (its place in the stream of all tokens), position (of its first
    token), tokens (little-endian unsigned 32-bit ids), loss_from, loss_to (its ids under
    the loss mask), attends. ``members``: conv_id, place, start of each turn's segment.
    Null roles and texts are empty; rows without a conversation id are one conversation;
    no rows give two empty tables.
    """
    turns = materialise(conversation_turns(conversations, vocabulary), "turns")
    # Sorted by path, conversations are in depth-first order; this id keeps that order.
    paths = turns.where("place is null").select("conv_id", "path").repartitionByRange(F.col("path"), F.col("conv_id")).sortWithinPartitions("path", "conv_id")
    ranks = materialise(paths.select(F.col("conv_id").alias("ranked"), F.monotonically_increasing_id().alias("rank")), "ranks")
    narrow = turns.where("place is not null").select("conv_id", "place", "node", "n_tokens")
    narrow = narrow.join(ranks, F.col("conv_id").eqNullSafe(F.col("ranked"))).drop("ranked")
    nodes = narrow.groupBy("node").agg(F.min("rank").alias("owner"), F.min("place").alias("node_place"), F.min("n_tokens").alias("n"))
    # The upper bits of a rank are the range it lies in: sums of ranges first, then inside each.
    nodes = materialise(nodes.withColumn("range", F.shiftright("owner", 33)), "nodes")
    totals = nodes.groupBy("range").agg(F.sum("n").alias("total"))
    totals = totals.select(F.col("range").alias("total_range"), (F.sum("total").over(Window.orderBy("range")) - F.col("total")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("range").orderBy("owner", "node_place")) - F.col("n")
    layout = nodes.join(totals, F.col("range") == F.col("total_range")).select(F.col("node").alias("laid"), "owner", (F.col("before") + inside).alias("start"))
    placed = narrow.join(layout, F.col("node") == F.col("laid")).select("conv_id", "place", "start", "n_tokens", (F.col("rank") == F.col("owner")).alias("owned"))

    def attended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("from", pa.int64()), ("to", pa.int64())])
        out = _Rows(["conv_id", "place", "start", "owned", "attends"], [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(span)])
        now, spans = _NONE, []
        for part in _parts(batches):
            for conv_id, place, start, n, owned in zip(*part):
                if conv_id != now:
                    now, spans = conv_id, []
                if spans and spans[-1]["to"] == start:
                    spans[-1] = {"from": spans[-1]["from"], "to": start + n}
                else:
                    spans.append({"from": start, "to": start + n})
                yield from out.add((conv_id, place, start, owned, list(spans) if owned else None), 16 * len(spans) * owned)
        yield from out.rest()

    ordered = placed.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    lists = materialise(ordered.mapInArrow(attended, "conv_id long, place long, start long, owned boolean, attends array<struct<from:long,to:long>>"), "members")
    own = lists.where("owned").select(F.col("conv_id").alias("own_conv"), F.col("place").alias("own_place"), "start", "attends")
    segments = turns.join(own, F.col("conv_id").eqNullSafe(F.col("own_conv")) & (F.col("place") == F.col("own_place")))
    segments = materialise(segments.select("start", "position", "tokens", "loss_from", "loss_to", "attends"), "segments")
    return segments, lists.select("conv_id", "place", "start")


def read_back(segments: DataFrame, members: DataFrame, vocabulary: str) -> DataFrame:
    """One row per conversation, from the written segments alone: its turns, what is under the loss mask, its formatted length."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        out = _Rows([f.split()[0] for f in schema.split(", ")], [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()])
        now, n, loss_chars, chars, turns, loss = _NONE, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
        for part in _parts(batches):
            for conv_id, tokens, loss_from, loss_to in zip(*part):
                if conv_id != now:
                    if now is not _NONE:
                        yield from out.add((now, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars), 200)
                    now, n, loss_chars, chars, turns, loss = conv_id, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                ids = np.frombuffer(tokens, "<u4")
                turn = c.turn(ids)
                role, text = spoken(turn)
                learned = unescaped(c.string(ids[loss_from:loss_to]))
                n += 1
                turns.update(f"{role}\n{text}\n".encode())
                loss.update(learned.encode())
                loss_chars += len(learned)
                chars += len(formatted(turn))
        if now is not _NONE:
            yield from out.add((now, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars), 200)
        yield from out.rest()

    both = members.withColumnRenamed("start", "at").join(segments, F.col("at") == F.col("start"))
    rows = both.select("conv_id", "place", "tokens", "loss_from", "loss_to").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return rows.select("conv_id", "tokens", "loss_from", "loss_to").mapInArrow(run, schema)


def chat_digest(conversations: DataFrame, vocabulary: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings, formatted and read back."""
    says = "</s>[INST] ok [/INST]"
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    more = conversations.sparkSession.createDataFrame([(-7, 0, "user", says), (-7, 1, ASSISTANT, says)], "conv_id long, turn long, role string, text string")
    segments, members = chat_tree(rows.unionByName(more), vocabulary)
    return read_back(segments, members, vocabulary)


def oracle() -> str:
    """The digests in SQL, by the template's rules alone."""

    def length(x: str) -> str:
        """Characters of an escaped string: one more for each backslash and each reserved string."""
        marks = "|".join([r"\\", *(re.escape(s) for s in RESERVED)])
        return f"(length({x}) + len(regexp_extract_all({x}, '{marks}')))"

    ask, reply = len("[INST]<s>[/INST]"), len("<s></s>")
    return f"""
    WITH said AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
           sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
           CAST(sum(CASE WHEN role = 'assistant' THEN {reply} ELSE {ask} + {length('role')} END + {length('text')}) AS BIGINT) AS formatted_chars
    FROM said GROUP BY conv_id
    """
