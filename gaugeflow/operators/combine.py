"""Joins and unions of whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.columns import col


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack by name; a column absent from a table is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_common(frames: Sequence[DataFrame], always: Sequence[str] = ("source_file",)) -> DataFrame:
    """Stack the columns that all tables share, in sorted order."""
    shared = set(frames[0].columns)
    for f in frames[1:]:
        shared &= set(f.columns)
    names = sorted(shared | set(always))
    picked = [
        f.select(*[col(c) if c in f.columns else F.lit(None).cast("string").alias(c) for c in names]) for f in frames
    ]
    return reduce(DataFrame.unionByName, picked)


def _suffixed(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Give same-named value columns of two tables the suffixes _x and _y."""
    both = {c for c in a.columns if c in b.columns and c not in keys}

    def rename(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(*[col(c).alias(c + suffix) if c in both else col(c) for c in df.columns])

    return rename(a, "_x"), rename(b, "_y")


def align_outer(frames: Sequence[DataFrame], keys: Sequence[str] = ("datetime",), unique: bool = True) -> DataFrame:
    """Full outer alignment of many tables on their key.

    With unique keys all tables are stacked and folded by one aggregation, that
    is one shuffle however many tables there are. ``unique=False`` joins them
    one after another instead and keeps every pairing of repeated keys. Should
    keys repeat nevertheless, the smallest known value of a column is taken.
    """
    if not unique:
        def outer(a: DataFrame, b: DataFrame) -> DataFrame:
            x, y = _suffixed(a, b, keys)
            return x.join(y, list(keys), "full_outer")

        return reduce(outer, frames)
    # Same-named columns of different tables get the suffixes _x and _y first,
    # as a chain of pairwise merges would.
    widths: list[DataFrame] = [frames[0]]
    for f in frames[1:]:
        taken = {c for w in widths for c in w.columns} - set(keys)
        clash = [c for c in f.columns if c in taken]
        if clash:
            widths = [w.select(*[col(c).alias(c + "_x") if c in clash else col(c) for c in w.columns]) for w in widths]
            f = f.select(*[col(c).alias(c + "_y") if c in clash else col(c) for c in f.columns])
        widths.append(f)
    stacked = union_frames(widths)
    values = [c for c in stacked.columns if c not in keys]
    folded = stacked.groupBy(*[col(k) for k in keys]).agg(*[F.min(col(c)).alias(c) for c in values])
    return folded.select(*[col(k) for k in keys], *[col(c) for c in values])


def enrich_left(levels: DataFrame, rain: DataFrame, keys: Sequence[str] = ("datetime",)) -> DataFrame:
    """Add the rain columns to the level rows.

    Several rain tables may be stacked in ``rain``; they are folded to one row
    per key first (the smallest known value of each column), so the number of
    level rows never changes. Columns that both have get the suffixes _x and _y.
    """
    values = [c for c in rain.columns if c not in keys]
    per_key = rain.groupBy(*[col(k) for k in keys]).agg(*[F.min(col(c)).alias(c) for c in values])
    x, y = _suffixed(levels, per_key, keys)
    return x.join(y, list(keys), "left").select(*[col(c) for c in x.columns], *[col(c) for c in y.columns if c not in keys])


def join_xy(x: DataFrame, y: DataFrame, keys: Sequence[str] = ("datetime",)) -> DataFrame:
    """Inner join of features and targets; columns that both have come from ``x``."""
    own = [c for c in y.columns if c in keys or c not in x.columns]
    return x.join(y.select(*[col(c) for c in own]), list(keys), "inner").select(
        *[col(c) for c in x.columns], *[col(c) for c in own if c not in keys]
    )
