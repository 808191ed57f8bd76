"""Gradient boosting on binned rows, for several models at once.

The features are cut into bins once. Packed blocks of binned rows with what each model
has left over (its residuals) stay cached, one small part for each core. A level of the
trees of all models takes one job: every part counts weights and residuals by node,
feature and bin, and the driver, which gets these sums only, picks the splits. The job
of a first level also applies the trees of the round before and measures the errors of
the validation rows. Of two siblings only the lighter one is counted. Every ``run``
rounds the blocks are written to the shared folder, where their lineage ends.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from gaugeflow.functions.columns import col
from gaugeflow.session import materialise, shared_dir

# Rounds at most, seed.
MAX_ROUNDS = 1000
SEED = 42

BINS = 256  # of a feature; cuts are looked for in about BINS * BINS rows, as Spark ML does
BLOCK = 1 << 16  # rows that are counted together
PART = 1 << 16  # rows below which another part is not worth a task
LONGEST = 1 << 21  # rows of a part, however few cores there are
SUMS = 1 << 24  # bytes of sums that a job returns from a part, and that are kept for the next level
SAME = 1e-12  # share by which gains may differ through rounding alone
NEAR = 16  # parts whose sums the driver adds itself

FEATURES = "__features"


@dataclass(frozen=True)
class BoostParams:
    rounds: int = MAX_ROUNDS
    step: float = 0.1
    depth: int = 5
    leaf_rows: int = 1
    feature_share: float = 1.0
    row_share: float = 1.0


@dataclass(frozen=True)
class Target:
    """What one model learns: its label, the weights of the rows and the features it may use (all by default)."""

    label: str
    weight: str
    columns: Sequence[int] | None = None


@dataclass(frozen=True)
class Tree:
    """Nodes in preorder; ``feature`` is -1 at a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        at, every = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
        while (inner := self.feature[at] >= 0).any():
            go = np.where(rows[every, np.maximum(self.feature[at], 0)] <= self.cut[at], self.left[at], self.right[at])
            at = np.where(inner, go, at)
        return self.value[at]


@dataclass(frozen=True)
class Boosted:
    """One model: trees of all rounds and the errors of the validation rows after each."""

    base: float
    trees: list[Tree] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)


def best_round(errors: Sequence[float], patience: int) -> int:
    """Number of rounds (1-based) with the lowest error, not looking further
    once ``patience`` rounds in a row brought no gain."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


# -- bins ---------------------------------------------------------------------


def cuts_between(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Cuts halfway between all values, or where they part the weight evenly if that are too many."""
    values, at = np.unique(values, return_inverse=True)
    halfway = (values[1:] + values[:-1]) / 2
    if len(values) <= BINS:
        return halfway
    upto = np.cumsum(np.bincount(at, weights=weights))
    stride, wanted, found = upto[-1] / BINS, upto[-1] / BINS, []
    for i in range(1, len(values)):
        if abs(upto[i - 1] - wanted) < abs(upto[i] - wanted):
            found.append(i - 1)
            wanted += stride
    return halfway[found[: BINS - 1]]


def _find_cuts(rows: DataFrame, weights: Sequence[str], count: int) -> dict[tuple[str, int], np.ndarray]:
    """Cuts of every feature for rows of each kind of weight."""
    few = rows.sample(False, BINS * BINS / count, SEED) if count > BINS * BINS else rows
    cells = few.select(F.posexplode(vector_to_array(FEATURES)).alias("f", "x"), *(col(w).cast("double").alias(f"w{i}") for i, w in enumerate(weights)))

    def of(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        found = [cuts_between(cells["x"].to_numpy(), cells[f"w{i}"].to_numpy()) for i in range(len(weights))]
        return pd.DataFrame({"f": key[0], "w": range(len(weights)), "cuts": found})

    made = cells.groupBy("f").applyInPandas(of, "f int, w int, cuts array<double>").collect()
    return {(weights[r["w"]], r["f"]): np.array(r["cuts"], dtype=float) for r in made}


@dataclass(frozen=True)
class Block:
    """Rows side by side: ``bins`` by binned column, ``weight`` by kind of weight, ``rest`` by model."""

    number: int
    val: bool
    bins: np.ndarray
    weight: np.ndarray
    rest: np.ndarray


def _pack(rows: DataFrame, cuts: Sequence[tuple[int, np.ndarray]]) -> DataFrame:
    """Rows (val, x, w, r) as blocks; ``cuts`` has the feature and the cuts of each binned column."""

    def matrix(parts: list[pa.RecordBatch], name: str) -> np.ndarray:
        return np.concatenate([p.column(name).flatten().to_numpy(zero_copy_only=False).reshape(p.num_rows, -1) for p in parts]).T

    def blocks(parts: list[pa.RecordBatch], number: int) -> Iterator[pa.RecordBatch]:
        val = np.concatenate([p.column("val").to_numpy(zero_copy_only=False) for p in parts])
        x, w, r = (matrix(parts, name) for name in "xwr")
        if not all(np.isfinite(m).all() for m in (x, w, r)) or (w < 0).any():
            raise ValueError("features, targets and weights must be finite, and no weight negative")
        bins = np.stack([np.searchsorted(c, x[f]).astype(np.uint8) for f, c in cuts])
        for i, flag in enumerate((False, True)):
            if (val == flag).any():
                cells = {n: [np.ascontiguousarray(m[:, val == flag]).tobytes()] for n, m in (("bins", bins), ("weight", w), ("rest", r))}
                yield pa.RecordBatch.from_pydict({"number": [number + i], "val": [flag], "n": [int((val == flag).sum())], **cells})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, parts = TaskContext.get().partitionId() << 32, 0, []
        for batch in batches:
            held, parts = held + batch.num_rows, [*parts, batch]
            if held >= BLOCK:
                yield from blocks(parts, number)
                number, held, parts = number + 2, 0, []
        if held:
            yield from blocks(parts, number)

    return rows.mapInArrow(pack, "number long, val boolean, n long, bins binary, weight binary, rest binary")


def _block(row: Row) -> Block:
    def matrix(cells: bytes, kind: type) -> np.ndarray:
        return np.frombuffer(bytes(cells), kind).reshape(-1, row["n"])

    return Block(row["number"], row["val"], matrix(row["bins"], np.uint8), matrix(row["weight"], float), matrix(row["rest"], float))


# -- in the tasks ---------------------------------------------------------------


@dataclass(frozen=True)
class Grown:
    """Nodes of a tree on binned columns, in the order they were made; ``column`` is -1 where it ends."""

    column: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaves(self, bins: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Every leaf with the places of its rows."""
        ahead = [(0, np.arange(bins.shape[1]))]
        while ahead:
            node, at = ahead.pop()
            if self.column[node] < 0:
                yield node, at
            elif len(at):
                lower = np.take(bins[self.column[node]], at) <= self.bin[node]
                ahead += [(self.right[node], at[~lower]), (self.left[node], at[lower])]


@dataclass(frozen=True)
class Wanted:
    """Sums that a job makes for one model: ``slot`` is the place of each node's sums, or -1."""

    model: int
    weight: int
    columns: np.ndarray
    tree: Grown
    slot: np.ndarray
    nodes: int


def _advanced(block: Block, trees: dict[int, Grown], step: float) -> Block:
    rest = block.rest.copy()
    for model, tree in trees.items():
        for leaf, at in tree.leaves(block.bins):
            rest[model, at] -= step * tree.value[leaf]
    return replace(block, rest=rest)


def _drawn(block: Block, round_no: int, share: float) -> np.ndarray:
    return np.random.default_rng([SEED, round_no, block.number]).random(block.bins.shape[1]) < share


def _count(block: Block, want: Wanted, sums: np.ndarray, drawn: np.ndarray | None) -> None:
    """Add weights and weighted residuals by node, column and bin."""
    found = [(want.slot[leaf], at) for leaf, at in want.tree.leaves(block.bins) if want.slot[leaf] >= 0]
    if not found:
        return
    slot, at = np.repeat([s for s, _ in found], [len(x) for _, x in found]), np.concatenate([x for _, x in found])
    if drawn is not None:
        slot, at = slot[drawn[at]], at[drawn[at]]
    weight, width = block.weight[want.weight][at], sums.shape[-1]
    moved, place, whole = weight * block.rest[want.model][at], slot * width, len(at) == block.bins.shape[1] and len(found) == 1
    for i, c in enumerate(want.columns):
        key = place + (block.bins[c] if whole else np.take(block.bins[c], at))
        for part, of in enumerate((weight, moved)):
            sums[part, :, i] += np.bincount(key, of, want.nodes * width).reshape(want.nodes, width)


def _measured(blocks: Iterable[Block], wants: Sequence[Wanted], kinds: Sequence[int], width: int, round_no: int, share: float) -> Iterator[list[np.ndarray]]:
    """One list for a part: absolute errors and weights of validation rows by model (if ``kinds`` names the models' weights), then the sums."""
    off = np.zeros((2, len(kinds)))
    sums = [np.zeros((2, w.nodes, len(w.columns), width)) for w in wants]
    for block in blocks:
        if block.val:
            for m, kind in enumerate(kinds):
                off[:, m] += (np.abs(block.rest[m]) @ block.weight[kind], block.weight[kind].sum())
            continue
        drawn = _drawn(block, round_no, share) if share < 1 else None
        for want, s in zip(wants, sums, strict=True):
            _count(block, want, s, drawn)
    yield [off, *sums]


def _added(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    return [x + y for x, y in zip(a, b, strict=True)]


def _summed(parts: RDD) -> list[np.ndarray]:
    if parts.getNumPartitions() > NEAR:
        return parts.treeReduce(_added)
    first, *others = parts.collect()
    for other in others:
        for x, y in zip(first, other, strict=True):
            x += y
    return first


# -- in the driver ----------------------------------------------------------------


class _Growth:
    """A tree while it grows."""

    def __init__(self, model: int, weight: int, columns: np.ndarray, ends: np.ndarray, params: BoostParams, least: float, round_no: int):
        self.model, self.weight, self.columns, self.ends = model, weight, columns, ends
        self.params, self.least, self.round_no = params, least, round_no
        self.nodes: list[list[float]] = [[-1, 0, 0, 0, 0.0]]
        self.totals: list[tuple[float, float]] = [(0.0, 0.0)]
        self.sums: dict[int, np.ndarray] = {}  # of nodes whose children may be counted by difference
        self.pairs: list[tuple[int, int, int]] = []  # (parent, lighter, heavier), where one may be split

    def tree(self) -> Grown:
        columns = list(zip(*self.nodes, strict=True))
        return Grown(*(np.array(c, dtype=np.int64) for c in columns[:4]), np.array(columns[4], dtype=float))

    def wanted(self, nodes: Sequence[int]) -> Wanted:
        slot = np.full(len(self.nodes), -1, dtype=np.int64)
        slot[list(nodes)] = np.arange(len(nodes))
        return Wanted(self.model, self.weight, self.columns, self.tree(), slot, len(nodes))

    def root(self, sums: np.ndarray) -> None:
        sums = sums[:, 0]
        weight, moved = sums[0, 0].sum(), sums[1, 0].sum()
        self.totals[0] = (weight, moved)
        self.nodes[0][4] = moved / weight if weight else 0.0
        if self.params.depth:
            self.split(0, sums)

    def _allowed(self, node: int) -> np.ndarray:
        n, share = len(self.columns), self.params.feature_share
        few = np.random.default_rng([SEED, self.round_no, self.model, node]).permutation(n)[: int(np.ceil(share * n))]
        return np.isin(np.arange(n), few)

    def split(self, node: int, sums: np.ndarray) -> None:
        """Split a node where the squared error falls most, if it falls."""
        weight, moved = self.totals[node]
        sums[:, sums[0] <= 1e-12 * weight] = 0.0  # a difference leaves traces in empty bins
        left, below = np.cumsum(sums[0], axis=1), np.cumsum(sums[1], axis=1)
        right, above = weight - left, moved - below
        fits = (left >= self.least) & (right >= self.least) & (left > 0) & (right > 0) & (np.arange(sums.shape[-1]) < self.ends[:, None])
        if self.params.feature_share < 1:
            fits &= self._allowed(node)[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(fits, below * below / left + above * above / right, -np.inf)
        most = gain.max()
        if not most - moved * moved / weight > max(SAME * most, np.finfo(float).eps * weight):
            return
        best = int(np.argmax(gain >= most - SAME * most))  # the first of equal ones, whatever the order of the sums
        column, cut = divmod(best, sums.shape[-1])
        halves = [(left[column, cut], below[column, cut]), (right[column, cut], above[column, cut])]
        at = len(self.nodes)
        self.nodes[node][:4] = [int(self.columns[column]), cut, at, at + 1]
        for w, s in halves:
            self.nodes.append([-1, 0, 0, 0, s / w])
            self.totals.append((w, s))
        if max(w for w, _ in halves) >= 2 * self.least:
            lighter = int(halves[1][0] < halves[0][0])
            self.pairs.append((node, at + lighter, at + 1 - lighter))
            self.sums[node] = sums


def _finished(grown: Grown, cuts: Sequence[tuple[int, np.ndarray]]) -> Tree:
    """The same tree on the features themselves, in preorder."""
    order, ahead = [], [0]
    while ahead:
        node = ahead.pop()
        order.append(node)
        if grown.column[node] >= 0:
            ahead += [grown.right[node], grown.left[node]]
    place = {int(n): i for i, n in enumerate(order)}
    inner = [grown.column[n] >= 0 for n in order]
    feature = [cuts[grown.column[n]][0] if i else -1 for n, i in zip(order, inner, strict=True)]
    cut = [cuts[grown.column[n]][1][grown.bin[n]] if i else np.nan for n, i in zip(order, inner, strict=True)]
    left, right = ([place[int(side[n])] if i else 0 for n, i in zip(order, inner, strict=True)] for side in (grown.left, grown.right))
    value = [np.nan if i else grown.value[n] for n, i in zip(order, inner, strict=True)]
    return Tree(np.array(feature), np.array(cut, dtype=float), np.array(left), np.array(right), np.array(value, dtype=float))


def boost(train: DataFrame, val: DataFrame | None, targets: Sequence[Target], params: BoostParams, patience: int, run: int) -> list[Boosted]:
    """Boost all targets side by side on assembled rows; a model ends ``patience`` rounds after its best one.

    A leaf holds at least ``leaf_rows`` of the weight. Errors are weighted mean absolute errors.
    """
    spark = train.sparkSession
    shared_dir(spark)
    sums = [s for t in targets for s in (F.sum(col(t.weight).cast("double")), F.sum(col(t.weight) * col(t.label)))]
    count, *totals = train.agg(F.count("*"), *(s.alias(f"s{i}") for i, s in enumerate(sums))).first()
    if not count or not all(totals[::2]):
        raise ValueError("no training rows, or none with a weight")
    models = [Boosted(moved / weight) for weight, moved in zip(totals[::2], totals[1::2], strict=True)]
    least = [min(float(params.leaf_rows), 0.49 * weight) for weight in totals[::2]]

    kinds = list(dict.fromkeys(t.weight for t in targets))
    found = _find_cuts(train, kinds, count)
    features = 1 + max(f for _, f in found)
    cuts = [(f, found[w, f]) for w in kinds for f in range(features)]
    ends, width = np.array([len(c) for _, c in cuts]), 1 + max(len(c) for _, c in cuts)
    kind = [kinds.index(t.weight) for t in targets]
    columns = [k * features + np.array(range(features) if t.columns is None else t.columns, dtype=np.int64) for k, t in zip(kind, targets, strict=True)]

    def plain(rows: DataFrame, flag: bool) -> DataFrame:
        left = F.array(*(col(t.label) - F.lit(m.base) for t, m in zip(targets, models, strict=True)))
        return rows.select(F.lit(flag).alias("val"), vector_to_array(FEATURES).alias("x"), F.array(*(col(w).cast("double") for w in kinds)).alias("w"), left.alias("r"))

    rows = plain(train, False) if val is None else plain(train, False).unionByName(plain(val, True))
    size = max(1, min(spark.sparkContext.defaultParallelism, -(-count // PART)), -(-count // LONGEST))
    table = materialise(_pack(rows.repartition(size), cuts), "binned")
    state = table.rdd.map(_block).coalesce(size).persist(StorageLevel.MEMORY_AND_DISK)

    def measure(round_no: int, wants: Sequence[Wanted], errors: bool = False) -> list[np.ndarray]:
        names, share = kind if errors else [], params.row_share
        return _summed(state.mapPartitions(lambda blocks: _measured(blocks, wants, names, width, round_no, share)))

    def level(growing: Sequence[_Growth], round_no: int) -> None:
        """Split the children made last, in one job unless their sums are too many."""
        pairs = [(g, *p) for g in growing for p in g.pairs]
        parents = [g.sums for g in growing]
        for g in growing:
            g.pairs, g.sums = [], {}
        place = {g.model: i for i, g in enumerate(growing)}
        size = 2 * 8 * width * max(len(g.columns) for g in growing)
        few = 2 * len(pairs) * size <= SUMS and all(parent in parents[place[g.model]] for g, parent, _, _ in pairs)
        nodes = [(g, lighter) for g, _, lighter, _ in pairs] if few else [(g, child) for g, _, *both in pairs for child in both]
        step = len(nodes) if few else max(1, SUMS // size)
        for first in range(0, len(nodes), step):
            group = nodes[first : first + step]
            asked = {g.model: [n for h, n in group if h is g] for g, _ in group}
            _, *made = measure(round_no, [growing[place[m]].wanted(ns) for m, ns in asked.items()])
            sums = {(m, n): s[:, i] for (m, ns), s in zip(asked.items(), made, strict=True) for i, n in enumerate(ns)}
            if few:
                for g, parent, lighter, heavier in pairs:
                    sums[g.model, heavier] = parents[place[g.model]][parent] - sums[g.model, lighter]
            for (m, n), s in sums.items():
                growing[place[m]].split(n, s)
                if not few:
                    growing[place[m]].sums = {}

    active, done, older = list(range(len(targets))), 0, None
    while active and (val is not None or done < params.rounds):
        more = done < params.rounds
        growing = [_Growth(m, kind[m], columns[m], ends[columns[m]], params, least[m], done) for m in active] if more else []
        (off, weights), *made = measure(done, [g.wanted([0]) for g in growing], val is not None)
        if val is not None and done:
            for m in active:
                models[m].errors.append(float(off[m] / weights[m]) if weights[m] else float("nan"))
            active = [m for m in active if len(models[m].errors) - best_round(models[m].errors, patience) < patience]
        if not more or not active:
            break
        for g, s in zip(growing, made, strict=True):
            g.root(s)
        growing = [g for g in growing if g.model in active]
        for _ in range(params.depth - 1):
            if any(g.pairs for g in growing):
                level(growing, done)
        grown = {g.model: g.tree() for g in growing}
        for m, tree in grown.items():
            models[m].trees.append(_finished(tree, cuts))
        done += 1
        if older:
            older.unpersist()
        older, state = state, _following(state, grown, params.step, done % run == 0)
    for kept in (older, state):
        if kept:
            kept.unpersist()
    return models


def _following(state: RDD, grown: dict[int, Grown], step: float, write: bool) -> RDD:
    """The blocks after a round; written to the shared folder from time to time."""
    out = state.map(lambda block: _advanced(block, grown, step)).persist(StorageLevel.MEMORY_AND_DISK)
    if write:
        out.checkpoint()
    return out
