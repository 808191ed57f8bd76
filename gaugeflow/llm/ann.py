"""Nearest neighbours by inner product: collision counting over query-centred windows.

Every vector is projected on single random directions, which are orthogonal to
each other; each projection is one sorted array. A query opens a window around its
own projection in every array and widens all windows by the same step, round by
round, as if everything were hashed anew with larger buckets. A vector gains a
collision for each round in which it lies inside a window; those with the most
collisions, at least a given share of the range, are verified on the original
vectors in double precision.

Largest inner product becomes smallest distance by one more coordinate that
brings all vectors to the same norm. Windows fit only vectors of similar norms, so
each range of norms has arrays of its own; a query searches the ranges from the
largest norms down, until none can hold a better inner product. The index is cut into blocks of bounded
size that hold every vector; queries come in blocks as well, and each query block
meets each index block in a task of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeflow.session import materialise

BLOCK = 32_768  # vectors of an index block
QUERIES = 512  # queries of a block
RATIO = 1.15  # of the largest to the smallest norm of a range
ROUNDS = 3
STEP = 0.6  # window step, in standard deviations of a projection
SHARE = 0.08  # of a range's vectors that are verified at least
LEAST = 400  # vectors of a range of norms that are verified at least
SEED = 11


@lru_cache(maxsize=2)
def directions(dim: int) -> np.ndarray:
    """Random orthogonal directions as columns, the same everywhere."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(SEED)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


class CollisionIndex:
    """Sorted projections of the vectors of a block in one range of norms."""

    def __init__(self, vectors: np.ndarray, largest: float):
        self.vectors = vectors  # float64, one a row
        lift = np.sqrt(np.maximum(0.0, largest**2 - np.einsum("ij,ij->i", vectors, vectors)))
        dim = vectors.shape[1] + 1
        self.turn = directions(dim)
        self.largest, self.unit = largest, STEP * largest / math.sqrt(dim)
        projected = np.ascontiguousarray((np.column_stack([vectors, lift]) @ self.turn).T.astype(np.float32))
        order = np.argsort(projected, axis=1)
        self.sorted = np.take_along_axis(projected, order, axis=1)
        # Where each vector stands in each array. 16 bits, unless very many rows repeat one id.
        self.place = np.empty(order.shape, dtype=np.uint16 if len(vectors) <= 1 << 16 else np.uint32)
        np.put_along_axis(self.place, order, np.arange(len(vectors), dtype=self.place.dtype)[None, :], axis=1)

    def candidates(self, query: np.ndarray, least: int) -> np.ndarray:
        """Places of at least ``least`` vectors with the most collisions."""
        n = len(self.vectors)
        if least >= n:
            return np.arange(n)
        scaled = np.append(query * (self.largest / math.sqrt(float(query @ query))), 0.0)
        centres = scaled @ self.turn
        reach = self.unit * np.arange(1, ROUNDS + 1)
        counts = np.zeros(n, dtype=np.uint8 if ROUNDS * len(centres) < 256 else np.uint16)
        kind = self.place.dtype.type
        from_low, inside = np.empty(n, dtype=self.place.dtype), np.empty(n, dtype=bool)
        for place, values, centre in zip(self.place, self.sorted, centres):
            lows, highs = np.searchsorted(values, centre - reach).tolist(), np.searchsorted(values, centre + reach).tolist()
            for low, high in zip(lows, highs):
                if high - low == n:
                    counts += 1
                elif high > low:
                    # Unsigned: what stands before the window comes out large.
                    np.subtract(place, kind(low), out=from_low)
                    np.less(from_low, kind(high - low), out=inside)
                    np.add(counts, inside.view(np.uint8), out=counts)
        seen = np.cumsum(np.bincount(counts)[::-1])[::-1]
        threshold = int(np.flatnonzero(seen >= least)[-1])
        return np.flatnonzero(counts >= threshold)


def norm_ranges(vectors: np.ndarray, ids: np.ndarray) -> list[tuple[CollisionIndex, np.ndarray]]:
    """(index, ids) of each range of norms of a block, the largest norms first.

    A range has at least ``LEAST`` vectors, which are all verified if it has no more.
    """
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    order = np.argsort(-norms, kind="stable")
    falling, start, made = norms[order], 0, []
    while start < len(order):
        end = max(start + LEAST, int(np.searchsorted(-falling, -falling[start] / RATIO, side="right")))
        members = order[start:end]
        made.append((CollisionIndex(vectors[members], float(falling[start])), ids[members]))
        start = end
    return made


def _products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, each summed in the same order wherever its row stands, so that equal vectors tie."""
    return (vectors * query).sum(axis=1)


def nearest_in(ranges: list[tuple[CollisionIndex, np.ndarray]], queries: np.ndarray, query_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query ids, vector ids, inner products) of the best ``k`` of a block for each query, its own row left out."""
    out_q, out_v, out_s = [], [], []
    for query, own in zip(queries, query_ids):
        length, border = math.sqrt(float(query @ query)), -math.inf
        all_ids, all_scores = np.empty(0, dtype=np.int64), np.empty(0)
        for index, ids in ranges:
            # With room for rounding.
            if index.largest * length * (1 + 1e-9) < border:
                break
            found = index.candidates(query, max(LEAST, k + 1, math.ceil(SHARE * len(ids))))
            found = found[ids[found] != own]
            all_ids, all_scores = np.append(all_ids, ids[found]), np.append(all_scores, _products(index.vectors[found], query))
            if len(all_ids) > k:
                border = np.partition(all_scores, len(all_ids) - k)[len(all_ids) - k]
                close = all_scores >= border
                all_ids, all_scores = all_ids[close], all_scores[close]
        best = np.lexsort((all_ids, -all_scores))[:k]
        out_q.append(np.full(len(best), own))
        out_v.append(all_ids[best])
        out_s.append(all_scores[best])
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def _packed(rows: DataFrame, key: str) -> DataFrame:
    """(dim, key, ids binary, vectors binary): one row for each block."""

    def pack(table: pa.Table) -> pa.Table:
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("<f8")
        ids = table.column("vec_id").to_numpy().astype("<i8")
        return pa.table({"dim": table.column("dim").slice(0, 1), key: table.column(key).slice(0, 1), "ids": pa.array([ids.tobytes()]), "vectors": pa.array([flat.tobytes()])})

    return rows.groupBy("dim", key).applyInArrow(pack, f"dim int, {key} int, ids binary, vectors binary")


def nearest_neighbours(embeddings: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose id is divisible by ``every`` the ``k`` nearest found.

    Ties go to the smaller id. Rows without id, and vectors that are null, empty,
    zero or hold a null or non-finite component, take no part; vectors are compared
    with those of their own length. A query finds no row that repeats its own id; of
    other ids that are repeated, equal vectors count once and different ones each.
    """
    vector = F.col("vector")
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).where("vec_id is not null and vector is not null")
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.where(finite & F.exists(vector, lambda x: x != 0)).withColumn("dim", F.size("vector"))
    stats = rows.groupBy("dim").agg(F.count("*").alias("n"))
    # One row for each length of vectors. Blocks grow in number, not in size.
    stats = materialise(stats.select("dim", F.ceil(F.col("n") / (0.9 * BLOCK)).cast("int").alias("blocks"), F.ceil(F.col("n") / (0.9 * every * QUERIES)).cast("int").alias("query_blocks")), "vector-stats")
    rows = rows.join(stats, "dim")

    def dealt(count: str):
        return F.pmod(F.xxhash64("vec_id"), F.col(count)).cast("int")

    index = materialise(_packed(rows.withColumn("block", dealt("blocks")), "block"), "vector-blocks")
    # By quotient, since all query ids have a factor in common.
    asking = rows.where(F.col("vec_id") % every == 0).withColumn("query_block", F.pmod(F.xxhash64(F.col("vec_id") + 1), F.col("query_blocks")).cast("int"))
    asking = materialise(_packed(asking, "query_block").select("dim", "query_block", F.col("ids").alias("query_ids"), F.col("vectors").alias("queries")), "query-blocks")
    meet = index.join(stats, "dim").withColumn("query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
    meet = meet.join(asking, ["dim", "query_block"]).select("dim", "ids", "vectors", "query_ids", "queries", "block", "query_block")
    tasks = max(1, index.select("dim", "block").count() * asking.count())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                dim = batch.column(0)[row].as_py()
                ids, vectors, query_ids, queries = (np.frombuffer(batch.column(i)[row].as_buffer(), "<i8" if i % 2 == 1 else "<f8") for i in range(1, 5))
                q, v, s = nearest_in(norm_ranges(vectors.reshape(-1, dim), ids), queries.reshape(-1, dim), query_ids, k)
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(s)], names=["query_id", "vec_id", "score"])

    found = meet.repartition(min(tasks, 10_000), "block", "query_block").mapInArrow(search, "query_id long, vec_id long, score double")
    # Rows that repeat a vector's id count once.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.distinct().withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
