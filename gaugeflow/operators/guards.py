"""Key uniqueness, exact ranks and size-checked lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions.columns import col
from gaugeflow.session import materialise, shared_dir


def unique_key(df: DataFrame, keys: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per key: every column's first known value by ``tiebreak`` (nulls
    last), then by the value itself.

    Repeats of a key may each know a part of the readings, so none is lost to a
    null of another. An aggregate rather than ``row_number() = 1``; ``repeats``
    tells what was folded.
    """
    rest = [c for c in df.columns if c not in keys and c not in tiebreak]
    order = [e for t in tiebreak for e in (col(t).isNull(), col(t))]
    picked = [F.min(F.struct(*[e.alias(f"o{i}") for i, e in enumerate(order)])).alias("__order")] if tiebreak else []
    picked += [F.min(F.when(col(c).isNotNull(), F.struct(*[e.alias(f"o{i}") for i, e in enumerate(order)], col(c).alias("v")))).alias(f"__v{i}") for i, c in enumerate(rest)]
    folded = df.groupBy(*[col(k) for k in keys]).agg(*picked) if picked else df.select(*[col(k) for k in keys]).distinct()
    made = {t: F.col("__order").getField(f"o{2 * i + 1}") for i, t in enumerate(tiebreak)}
    made |= {c: F.col(f"__v{i}").getField("v") for i, c in enumerate(rest)}
    return folded.select(*[made[c].alias(c) if c in made else col(c) for c in df.columns])


def repeats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once: (keys, n_rows)."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def dedup(df: DataFrame) -> DataFrame:
    """Distinct rows over all columns; null equals null."""
    return df.dropDuplicates()


def lookup_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join a large table to a per-key table.

    The per-key table is written to the shared folder first, so the planner
    knows its size in bytes: it is broadcast below the session's threshold, and
    above it the join shuffles and adaptive execution splits the hot keys.
    """
    return big.join(materialise(small, "lookup"), list(keys), how)


def exact_ranks(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """1-based rank of every row within its group by a total order.

    Rows are range-partitioned over (group, order), so one group, or one value
    of the first order column, may span many partitions; a row's rank is the
    number of rows of its group in earlier partitions plus its place in its own.
    The partitioning is pinned by a checkpoint because range bounds are sampled
    anew by every execution.
    """
    shared_dir(df.sparkSession)
    sort = [col(c) for c in (*group, *order)]
    pinned = (
        df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("__id", F.monotonically_increasing_id()).checkpoint()
    ).withColumn("__part", F.shiftright("__id", 33))
    earlier = Window.partitionBy(*[col(g) for g in group]).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        pinned.groupBy(*[col(g) for g in group], "__part")
        .agg(F.count("*").alias("__n"), F.min("__id").alias("__first"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
        .drop("__n")
    )
    ranked = lookup_join(pinned, parts, [*group, "__part"], "inner")
    return ranked.withColumn(out, F.col("__before") + F.col("__id") - F.col("__first") + 1).drop(
        "__before", "__id", "__first", "__part"
    )


def exact_quantile(df: DataFrame, column: str, share: float) -> float | None:
    """Quantile with linear interpolation between neighbours, null without values.

    By exact ranks over range partitions; no task gets all distinct values.
    """
    known = df.select(col(column).cast("double").alias("v")).where("v is not null and not isnan(v)")
    ranked = exact_ranks(known, [], ["v"], "r")
    n = ranked.count()
    if not n:
        return None
    at = (n - 1) * share
    low = int(at)
    near = {r["r"] - 1: r["v"] for r in ranked.where(F.col("r").isin(low + 1, low + 2)).collect()}
    return near[low] if at == low else near[low] + (near[low + 1] - near[low]) * (at - low)
