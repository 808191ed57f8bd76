"""Conversation structure repair by generalised LR parsing with weighted edits.

The roles of a conversation must form ``Conversation -> Head Pairs | empty`` with
``Head -> s | empty``, ``Pairs -> Pairs Pair | Pair`` and ``Pair -> u a``. Rows come
in order as a stream; the parser keeps a graph-structured stack whose tops are
linked to what lies below. For every row each top may shift it as it is (keep),
shift it as another role (rerole) or stay (delete); between rows it may shift a role
that is not there (insert). Reductions follow at once. Equal tops are merged by the
minimum of (cost, audit), where the audit is the string of edits so far; the rest of
a parse depends on the top alone, so nothing cheaper is lost.

What all tops have done alike is decided and leaves the parser, so its memory is the
undecided stretch and not the conversation, however long that is. All edits of one
conversation depend on each other and its digest is one hash, so its rows pass
through one task, in order; different conversations are spread over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3  # costs; CUT is for a truncated row that stays
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

# States of the LR automaton, named by what lies on top of the stack.
START, SYSTEM, HEAD, PAIRS, USER, ASSISTANT = range(6)
SHIFT = {START: {"s": SYSTEM}, HEAD: {"u": USER}, PAIRS: {"u": USER}, USER: {"a": ASSISTANT}}
#: State in which a rule is complete: its length and where its symbol leads from the state below.
REDUCE = {
    START: (0, {START: HEAD}),  # Head -> empty
    SYSTEM: (1, {START: HEAD}),  # Head -> s
    ASSISTANT: (2, {HEAD: PAIRS, PAIRS: PAIRS}),  # Pair -> u a, and with it Pairs
}
ACCEPT = (START, PAIRS)

SCHEMA = "conv_id long, place long, edit string, role string, text string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


@dataclass(frozen=True)
class Top:
    """A stack top: what it cost, the undecided edits, and the top it stands on."""

    cost: int
    audit: str
    state: int
    below: "Top | None" = None


def _pop(top: Top, n: int) -> Top:
    for _ in range(n):
        top = top.below
    return top


def _add(tops: dict[int, Top], new: Top) -> bool:
    """Merge a top and what it reduces to; true if it is a better one."""
    old = tops.get(new.state)
    if old is not None and (old.cost, old.audit) <= (new.cost, new.audit):
        return False
    if new.state not in (SYSTEM, ASSISTANT):  # those can only be reduced
        tops[new.state] = new
    if new.state in REDUCE:
        size, onward = REDUCE[new.state]
        base = _pop(new, size)
        # A symbol of "Pairs" stands in the place of the one below it, if there is one.
        ground = base.below if base.state == PAIRS else base
        _add(tops, Top(new.cost, new.audit, onward[base.state], ground))
    return True


def _shifted(top: Top, role: str, cost: int, edit: str) -> Top | None:
    state = SHIFT.get(top.state, {}).get(role)
    return None if state is None else Top(top.cost + cost, top.audit + edit, state, top)


def _with_inserts(tops: dict[int, Top]) -> dict[int, Top]:
    open_states = list(tops)
    while open_states:
        top = tops[open_states.pop()]
        for role in ROLES:
            new = _shifted(top, role, INSERT, "I")
            if new is not None:
                before = dict(tops)
                _add(tops, new)
                open_states += [s for s in tops if before.get(s) is not tops[s]]
    return tops


def _pruned(tops: dict[int, Top]) -> dict[int, Top]:
    """Without tops that cannot win: whatever follows them may follow full pairs for less."""
    pairs = tops.get(PAIRS)
    if pairs is not None:
        if HEAD in tops and (pairs.cost, pairs.audit) < (tops[HEAD].cost, tops[HEAD].audit):
            del tops[HEAD]
        if START in tops and pairs.cost + DELETE < tops[START].cost:  # at most a system row has to go
            del tops[START]
    return tops


class Parser:
    """The stack tops of one conversation; ``decided`` takes the edits all tops agree on."""

    def __init__(self):
        tops: dict[int, Top] = {}
        _add(tops, Top(0, "", START))
        self.tops = _with_inserts(tops)

    def row(self, initial: str, removed: bool, cut: bool) -> None:
        tops: dict[int, Top] = {}
        extra = CUT if cut else 0
        for top in self.tops.values():
            _add(tops, Top(top.cost + DELETE, top.audit + "D", top.state, top.below))
            if not removed:
                for role in ("s", *ROLES):
                    new = _shifted(top, role, extra + (KEEP if role == initial else REROLE), "K" if role == initial else "R")
                    if new is not None and (role == initial or role in ROLES):
                        _add(tops, new)
        self.tops = _pruned(_with_inserts(tops))

    def decided(self) -> str:
        same = commonprefix([t.audit for t in self.tops.values()])
        if same:
            self.tops = {s: _without(t, len(same)) for s, t in self.tops.items()}
        return same

    def best(self) -> Top:
        return min((self.tops[s] for s in ACCEPT if s in self.tops), key=lambda t: (t.cost, t.audit))


def _without(top: Top, n: int) -> Top:
    # Audits of the tops below are never read again; only their states are.
    return Top(top.cost, top.audit[n:], top.state, top.below)


@dataclass
class _Conversation:
    conv_id: int | None
    parser: Parser = field(default_factory=Parser)
    waiting: list[tuple[str, str] | None] = field(default_factory=list)  # rows without a decision; None has to go
    at: int = 0  # of them, the next one
    expects: str = "u"
    place: int = 0
    audit: list[str] = field(default_factory=list)
    first: int | None = None
    last: int | None = None
    turns: int = 0
    counts: dict[str, int] = field(default_factory=lambda: {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0})
    before: str | None = None
    row: tuple | None = None

    def add(self, turn: int | None, role: str, text: str, digest: bytes, fault: str, again: bool) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        # Rows of one order key and content stand next to each other; all but the first are repeats.
        if fault != "blank" and (again or self.row == (turn, digest)):
            fault = "duplicate"
        self.row = (turn, digest)
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.before = initial
        removed = fault in ("blank", "duplicate")
        self.waiting.append(None if removed else (role, text))
        self.parser.row(initial, removed, fault == "truncated")

    def repaired(self, edits: str) -> Iterator[tuple[int, str, str, str]]:
        for edit in edits:
            role, text = ROLES[self.expects], ""
            if edit != "I":
                own = self.waiting[self.at]
                self.at += 1
                if edit == "D":
                    continue
                role, text = (own[0] if edit == "K" else role), own[1]
            if not (edit == "K" and role[:1] == "s"):
                self.expects = "a" if self.expects == "u" else "u"
            yield self.place, edit, role, text
            self.place += 1
        del self.waiting[: self.at]
        self.at = 0
        self.audit.append(edits)

    def report(self, cost: int) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (gaps, *self.counts.values(), cost, "".join(self.audit))


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.int64()] * 6, pa.string()]
    out: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        nonlocal size
        columns = list(zip(*out)) or [()] * len(names)
        out.clear()
        size = 0
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def turns(conversation: _Conversation, edits: str) -> None:
        nonlocal size
        for t in conversation.repaired(edits):
            out.append((conversation.conv_id, *t, *[None] * 7))
            size += 100 + len(t[3])

    def close(conversation: _Conversation) -> None:
        nonlocal size
        best = conversation.parser.best()
        turns(conversation, best.audit)
        out.append((conversation.conv_id, None, None, None, None, *conversation.report(best.cost)))
        size += 100

    now: _Conversation | None = None
    for rows in batches:
        for start in range(0, rows.num_rows, 1000):
            part = rows.slice(start, 1000)
            for conv_id, turn, role, text, digest, fault, again in zip(*(c.to_pylist() for c in part.columns)):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        close(now)
                    now = _Conversation(conv_id)
                if digest is not None:
                    now.add(turn, role, text, digest, fault, again)
                    turns(now, now.parser.decided())
                if size > 1 << 22:
                    yield batch()
    if now is not None:
        close(now)
    if out:
        yield batch()


def repaired_turns(rows: DataFrame) -> DataFrame:
    """Repaired conversations: one row per turn, and one per conversation with its report.

    ``rows`` has (conv_id, turn, role, text, present): a row that is not present only
    makes its conversation known. Null roles and texts count as one space. Rows are
    ordered by turn (null first), role, text. A turn of the result has its place, the
    edit that made it (K kept, R other role, I inserted), role and text; the report has
    a null place, the counts of faults, the cost and all edits (D deleted). Turns of a
    conversation stand in order, its report after them, all in one partition. Rows
    without a conversation id are one conversation; no rows give none.
    """
    text, solid = F.col("text"), r"[^\x20\x09-\x0D]"
    fault = F.when(~text.rlike(solid), "blank").when(text.rlike(r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z"), "truncated").otherwise("")
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *filled, F.col("present").cast("boolean").alias("present"))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), text), 256))
    rows = rows.select("conv_id", "turn", *(F.when(F.col("present"), F.col(c)).alias(c) for c in ("role", "text")), F.when(F.col("present"), digest).alias("digest"), fault.alias("fault"))
    # Where a content comes more than once, its first turn; minima are combined before the shuffle.
    key = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = rows.where("digest is not null").groupBy("conv_id", "digest").agg(F.min(key).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = firsts.select(F.col("conv_id").alias("first_conv"), F.col("digest").alias("first_digest"), "first")
    marked = rows.join(firsts, F.col("conv_id").eqNullSafe(F.col("first_conv")) & (F.col("digest") == F.col("first_digest")), "left")
    again = F.coalesce(key > F.col("first"), F.lit(False))
    marked = marked.select("conv_id", "turn", "role", "text", "digest", "fault", again.alias("again"))
    return marked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_repaired, SCHEMA)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults that a checksum of ``conv_id:turn`` (null: one space) deals out to one row in four.

    Of twenty remainders 0 drops a row (it stays as not present), 1 empties its text, 2 takes its ``.!?`` out, 3 repeats it, 4 makes its role user.
    """
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *named)
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(name.cast("binary")) % 20
    text: Column = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(kind == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(kind != 0))
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("present"))


def repair_digest(conversations: DataFrame) -> DataFrame:
    """Damaged and repaired again: one row per conversation with its report and ``repaired_sha256``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, going = hashlib.sha256(), False
        for batch in batches:
            digests = []
            reports = batch.column(1).is_null()
            for place, role, text in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                if place is None:
                    digests.append(held.hexdigest())
                    held, going = hashlib.sha256(), False
                else:
                    held.update(f"{chr(10) if going else ''}{role}:{text}".encode())
                    going = True
            last = batch.filter(reports)
            yield pa.RecordBatch.from_arrays([last.column(0), *last.columns[5:], pa.array(digests, pa.string())], names=[last.schema.names[0], *last.schema.names[5:], "repaired_sha256"])

    schema = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return repaired_turns(damaged(conversations)).mapInArrow(run, schema)
