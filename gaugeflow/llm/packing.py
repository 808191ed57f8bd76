"""Best-fit packing of token pieces into sequences of a fixed length.

Pieces of equal length are interchangeable, so the packing is planned on the
histogram of lengths, which has no more entries than a sequence has tokens,
whatever the input: for every length, longest first, one, two or three shorter
lengths that exactly fill the gap are looked up among those still available and
taken as often as they last; what finds no exact complement goes, longest first,
to the fullest open sequence with room. The plan is a list of patterns with
multiplicities. Spark numbers the pieces of each length and reads their sequences
off the plan.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeflow.llm.frames import id_and_text
from gaugeflow.llm.tokens import encoder
from gaugeflow.session import materialise

Pattern = tuple[tuple[int, ...], int]


def _exact(gap: int, left: np.ndarray, used: int, most: int) -> tuple[int, ...] | None:
    """One to ``most`` (three at most) available lengths that sum to ``gap``; longest first, so that short ones stay for later."""
    if left[gap] > (gap == used):
        return (gap,)
    if most < 2:
        return None
    free = left.copy()
    free[used] -= 1

    def pair(total: int, free: np.ndarray) -> tuple[int, int] | None:
        # Index of pair sums: where both halves of ``total`` are available.
        long = np.arange(total - 1, (total - 1) // 2, -1)
        ok = (free[long] > 0) & (free[total - long] > (long * 2 == total))
        hit = np.flatnonzero(ok)
        return (int(long[hit[0]]), int(total - long[hit[0]])) if len(hit) else None

    if gap > 1 and (two := pair(gap, free)):
        return two
    if most < 3:
        return None
    for a in np.flatnonzero(free[1 : gap - 1] > 0)[::-1] + 1:
        if 3 * a < gap:
            break
        free[a] -= 1
        two = pair(gap - int(a), free)
        free[a] += 1
        if two and two[0] <= a:
            return (int(a), *two)
    return None


def plan(counts: np.ndarray) -> list[Pattern]:
    """Patterns with multiplicities that use every piece once; ``counts[n]`` pieces have n tokens.

    Exact triples can use up short lengths that best fit would need, so the plans
    with singles only, with pairs and with triples are compared.
    """
    return min((_plan(counts, most) for most in (3, 2, 1)), key=lambda p: sum(times for _, times in p))


def _plan(counts: np.ndarray, most: int) -> list[Pattern]:
    size = len(counts) - 1
    left = counts.astype(np.int64).copy()
    out: list[Pattern] = []
    rest = np.zeros_like(left)
    if left[size]:
        out.append(((size,), int(left[size])))
        left[size] = 0
    for n in range(size - 1, 0, -1):
        while left[n]:
            found = _exact(size - n, left, n, most)
            if not found:
                rest[n], left[n] = left[n], 0
                break
            items = (n, *found)
            need = np.bincount(items, minlength=size + 1)
            times = int((left[need > 0] // need[need > 0]).min())
            left -= need * times
            out.append((items, times))
    open_: dict[int, list[Pattern]] = defaultdict(list)  # free tokens -> sequences with that room
    for n in range(size, 0, -1):
        todo = int(rest[n])
        while todo:
            room = next((g for g in range(n, size) if open_.get(g)), None)
            if room is None:
                fit = size // n
                if todo >= fit:
                    open_[size - fit * n].append(((n,) * fit, todo // fit))
                    todo %= fit
                else:
                    open_[size - todo * n].append(((n,) * todo, 1))
                    todo = 0
                continue
            items, times = open_[room].pop()
            take = min(times, todo)
            if times > take:
                open_[room].append((items, times - take))
            open_[room - n].append(((*items, n), take))
            todo -= take
    return out + [p for group in open_.values() for p in group]


def slots(patterns: list[Pattern], size: int) -> list[np.ndarray]:
    """Per length, rows (first rank, first sequence, offset) in order of rank."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(size + 1)]
    ranks, sequence = [0] * (size + 1), 0
    for items, times in patterns:
        at = 0
        for n in items:
            out[n].append((ranks[n], sequence, at))
            ranks[n] += times
            at += n
        sequence += times
    return [np.array(rows, dtype=np.int64).reshape(-1, 3) for rows in out]


def token_pieces(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents with their end id, cut only if longer than ``size``.

    The first piece of a cut document takes what is left over, so all others are full.
    """
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = encoder(tokenizer)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = make.encode(text.as_py() or "") + end
                n = len(ids) // 4
                start, stop = 0, n % size or min(n, size)
                piece = 0
                while start < n:
                    rows.append((doc, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
                    start, stop, piece = stop, stop + size, piece + 1
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit_packing(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; no piece is lost, no sequence exceeds ``size``.

    Null text is empty, so such a document is one piece holding its end id. Rows
    that repeat an id or have none are packed like any other. No rows give no rows.
    """
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    pieces = token_pieces(docs, tokenizer, size, end_id, id_col, text_col).withColumn("bucket", bucket.cast("int"))
    # The narrow rows are exchanged first, so that their files follow their size and not the number of input partitions:
    # where Hadoop's native library is missing, an executor starts a child process for every file it makes.
    pieces = materialise(pieces.repartition("bucket"), "pieces")
    # Ranks within a length, which may hold most pieces: counts per (length, bucket), then numbers inside those.
    counts = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    counts = materialise(counts.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))), "counts")
    histogram = np.zeros(size + 1, dtype=np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # at most ``size`` rows
        histogram[length] = n
    table = slots(plan(histogram), size)

    number = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = pieces.withColumn("number", number).join(counts.select("length", "bucket", "before"), ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("number")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                rows, t = np.flatnonzero(length == n), table[n]
                slot = np.searchsorted(t[:, 0], rank[rows], side="right") - 1
                sequence[rows] = t[slot, 1] + rank[rows] - t[slot, 0]
                offset[rows] = t[slot, 2]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
