"""Outlier flags of single columns by isolation forest, and their repair.

On one column an isolation tree is a set of cut points on a line, and the whole
forest is one step function of the value. The forest is grown from a bounded
random sample; scoring all rows is then a binary search in that step function,
with no shuffle, and the threshold is a quantile of at most as many distinct
scores as the function has steps.

Samples and cuts are drawn by MD5 digests of row, tree and node instead of a random
state, and mean path lengths are rounded, so a forest does not depend on partitions,
order or library, and SQL can grow the same one.

Method: Liu, Ting, Zhou, "Isolation Forest", ICDM 2008.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.columns import col, finite, nan_to_null, unpivot
from gaugeflow.operators.chunks import WEEK, interpolate_rows, interpolate_time
from gaugeflow.session import materialise

# Share of rows taken to be outliers, trees, sample per tree, seed.
CONTAMINATION = 0.03
TREES = 100
SAMPLE = 256
SEED = 42

EULER_GAMMA = 0.5772156649015329
HASH_RANGE = 1 << 28
PATH_DIGITS = 9  # a mean path length is rounded to these, so that no order of summing shows


@dataclass(frozen=True)
class StepScores:
    """Score of a value: ``scores[i]`` up to and including ``cuts[i]``.

    About trees × sample cuts, whatever the size of the table.
    """

    cuts: np.ndarray
    scores: np.ndarray

    def score(self, values: np.ndarray) -> np.ndarray:
        return self.scores[np.searchsorted(self.cuts, values, side="left")]


def _mean_depth(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n values."""
    n = np.asarray(n, dtype=float)
    big = 2.0 * (np.log(np.maximum(n, 2) - 1) + EULER_GAMMA) - 2.0 * (n - 1) / np.maximum(n, 1)
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, big))


def draw(key: str, tree: int, node: int) -> float:
    """A number in [0, 1) for a node of a tree; children of node n are 2n and 2n + 1."""
    return int(hashlib.md5(f"{key}:{tree}:{node}".encode()).hexdigest()[:8], 16) / 2.0**32


def _grow(values: np.ndarray, key: str, tree: int, limit: int) -> tuple[list[float], list[float]]:
    """Cut points of one tree, ascending, and the path length between them."""
    cuts: list[float] = []
    depths: list[float] = []

    def descend(part: np.ndarray, node: int, depth: int) -> None:
        if depth < limit and len(part) > 1 and part[0] < part[-1]:
            cut = float(part[0]) + draw(key, tree, node) * (float(part[-1]) - float(part[0]))
            left = int(np.searchsorted(part, cut, side="right"))
            descend(part[:left], 2 * node, depth + 1)
            cuts.append(cut)
            descend(part[left:], 2 * node + 1, depth + 1)
        else:
            depths.append(depth + float(_mean_depth(len(part))))

    descend(np.sort(values), 1, 0)
    return cuts, depths


def grow_forest(samples: Mapping[int, np.ndarray], key: str, sample: int = SAMPLE) -> StepScores:
    """Forest with one tree per sample, as one step function."""
    size = int(round(float(np.mean([len(s) for s in samples.values()]))))
    limit = int(np.ceil(np.log2(max(sample, 2))))
    grown = [_grow(s, key, tree, limit) for tree, s in samples.items()]
    cuts = np.unique(np.concatenate([np.asarray(c) for c, _ in grown] or [np.empty(0)]))
    total = np.zeros(len(cuts) + 1)
    # The value right at a cut stands for the whole step that ends there.
    probes = np.append(cuts, np.inf)
    for c, d in grown:
        total += np.asarray(d)[np.searchsorted(np.asarray(c), probes, side="left")]
    mean = max(float(_mean_depth(size)), np.finfo(float).tiny)
    return StepScores(cuts, -np.power(2.0, -np.round(total / len(grown), PATH_DIGITS) / mean))


def forest_table(spark: SparkSession, forests: Mapping[str, StepScores]) -> DataFrame:
    """The forests as rows (column, cut, score): the score of values up to and including the cut, the last cut infinite."""
    rows = [(c, float(cut), float(score)) for c, f in forests.items() for cut, score in zip(np.append(f.cuts, np.inf), f.scores)]
    return spark.createDataFrame(rows, "column string, cut double, score double")


def forests_of(table: DataFrame) -> dict[str, StepScores]:
    """The forests of a table of steps; bounded like the forests themselves."""
    pdf = table.toPandas().sort_values(["column", "cut"])
    return {c: StepScores(part["cut"].to_numpy()[:-1], part["score"].to_numpy()) for c, part in pdf.groupby("column")}


def fit_isolation(
    df: DataFrame, cols: Sequence[str], row_id: Sequence[str], trees: int = TREES, sample: int = SAMPLE, seed: int = SEED
) -> dict[str, StepScores]:
    """Grow one forest per column, one task per column.

    Every tree draws its own sample: a hash of (row, tree) decides whether the
    tree sees the row, with a share that makes ``sample`` rows in the mean, so
    the samples do not depend on how the table is partitioned. A group, and what
    comes back to the driver, is about trees × sample values.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[col(c).cast("string") for c in row_id]))
    first, second = (F.conv(F.substring(digest, at, 7), 16, 10).cast("long").alias(n) for at, n in ((1, "__first"), (8, "__second")))
    known = df.select(first, second, *[finite(col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])
    counts = known.agg(*[F.count(f"c{i}").alias(f"c{i}") for i in range(len(cols))]).first()
    limits = {f"c{i}": int(min(1.0, sample / max(counts[f"c{i}"], 1)) * HASH_RANGE) for i in range(len(cols))}
    # One digest a row: the trees step through it by its second half.
    drawn = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit(trees - 1)),
            lambda t: F.struct(t.alias("tree"), F.pmod(F.col("__first") + t * (2 * F.col("__second") + 1), F.lit(HASH_RANGE)).alias("h")),
        ),
        lambda x: x.h < max(limits.values(), default=0),
    )
    draws = known.select(*limits, F.explode(drawn).alias("d"))
    narrow = draws.select(F.col("d.tree").alias("tree"), *[F.when(F.col("d.h") < limits[c], F.col(c)).alias(c) for c in limits])
    cells = unpivot(narrow, ["tree"], list(limits), "name", "value").where("value is not null")

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        name = pdf["name"].iloc[0]
        samples = {int(tree): part.to_numpy() for tree, part in pdf.groupby("tree", sort=True)["value"]}
        forest = grow_forest(samples, f"{seed}:{name}", sample)
        return pd.DataFrame({"name": [name], "cuts": [forest.cuts], "scores": [forest.scores]})

    grown = cells.groupBy("name").applyInPandas(grow, "name string, cuts array<double>, scores array<double>").collect()
    forests = {r["name"]: StepScores(np.asarray(r["cuts"], dtype=float), np.asarray(r["scores"], dtype=float)) for r in grown}
    return {c: forests[f"c{i}"] for i, c in enumerate(cols) if f"c{i}" in forests}


def isolation_scores(df: DataFrame, forests: dict[str, StepScores], suffix: str = "_score") -> DataFrame:
    """Add each column's score (the lower, the more isolated)."""
    sc = df.sparkSession.sparkContext

    def scorer(forest: StepScores):
        # Bounded: about trees × sample steps.
        shared = sc.broadcast((forest.cuts, forest.scores))

        @F.pandas_udf("double")
        def score(values: pd.Series) -> pd.Series:
            cuts, scores = shared.value
            out = scores[np.searchsorted(cuts, values.to_numpy(dtype=float), side="left")]
            return pd.Series(np.where(values.isna(), np.nan, out))

        return score

    return df.withColumns({c + suffix: nan_to_null(scorer(f)(col(c).cast("double"))) for c, f in forests.items()})


def isolation_flags(
    df: DataFrame,
    cols: Sequence[str],
    ts: str = "datetime",
    contamination: float = CONTAMINATION,
    keys: Sequence[str] = (),
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = SEED,
    suffix: str = "_outlier",
    chunk: int = WEEK,
) -> DataFrame:
    """Add a boolean per column: score strictly below its ``contamination``
    quantile over the table. Nulls, NaN and infinities are interpolated by row
    beforehand, for the flags only; the columns themselves stay as they are."""
    cols = [c for c in cols if c in df.columns]
    kept = df.select("*", *[finite(col(c).cast("double")).alias(f"__x{i}") for i, c in enumerate(cols)])
    xs = [f"__x{i}" for i in range(len(cols))]
    # Read three times: to grow the forests, for the thresholds, for the flags.
    full = materialise(interpolate_rows(kept, keys, ts, xs, chunk), "isolation")
    forests = fit_isolation(full, xs, [*keys, ts], trees, sample, seed)
    scored = isolation_scores(full, forests)
    # Exact: a column has at most as many distinct scores as its forest has steps.
    limits = scored.agg(*[F.percentile(f"{x}_score", F.lit(contamination)).alias(x) for x in forests]).first() if forests else {}

    def flag(i: int) -> Column:
        x = f"__x{i}"
        return F.coalesce(F.col(f"{x}_score") < F.lit(limits[x]), F.lit(False)) if x in forests else F.lit(False)

    return scored.select(*[col(c) for c in df.columns], *[flag(i).alias(c + suffix) for i, c in enumerate(cols)])


def repair(
    flagged: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), ts: str = "datetime", suffix: str = "_outlier", chunk: int = WEEK
) -> DataFrame:
    """Replace flagged and missing values by interpolation over time; the ends
    take the nearest value. The flag columns are consumed."""
    marks = {c + suffix for c in cols}
    blanked = flagged.select(
        *[
            F.when(~F.coalesce(col(c + suffix), F.lit(False)), finite(col(c).cast("double"))).alias(c) if c in cols else col(c)
            for c in flagged.columns
            if c not in marks
        ]
    )
    return interpolate_time(blanked, keys, ts, list(cols), chunk)
