"""Min-max scaling and class-balanced replication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.columns import col, q, text
from gaugeflow.functions.numbers import CLASS_COPIES

# Fixed value: width given to a column with a single value.
MIN_WIDTH = 1e-6

Scaler = Mapping[str, tuple[float, float]]


def fit_minmax(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, min, max) in one pass over ``df``.

    NaN is left out; an infinite end is replaced by the other end's magnitude; a
    column without values gets 0…1; equal ends are moved apart a little.
    """
    cols = list(cols)
    known = [f"CAST({q(c)} AS DOUBLE)" for c in cols]
    wide = df.selectExpr(
        *[f"min(nullif({x}, double('NaN'))) AS lo{i}" for i, x in enumerate(known)],
        *[f"max(nullif({x}, double('NaN'))) AS hi{i}" for i, x in enumerate(known)],
    )
    rows = ", ".join(f"named_struct('feature', {text(c)}, 'lo', lo{i}, 'hi', hi{i})" for i, c in enumerate(cols))
    ends = wide.selectExpr(f"inline(array({rows}))")
    inf = F.lit(float("inf"))
    lo, hi = F.col("lo"), F.col("hi")
    hi1 = F.when(hi == inf, F.abs(lo)).otherwise(hi)
    lo1 = F.when(lo == -inf, -F.abs(hi1)).otherwise(lo)
    settled = ends.select(
        "feature", F.coalesce(lo1, F.lit(0.0)).alias("min"), F.when(lo1.isNull() | hi1.isNull(), F.lit(1.0)).otherwise(hi1).alias("max")
    )
    return settled.withColumn("max", F.when(F.col("max") == F.col("min"), F.col("min") + MIN_WIDTH).otherwise(F.col("max")))


def load_scaler(table: DataFrame) -> dict[str, tuple[float, float]]:
    """The fitted ends as a dict; one row per column, so the schema bounds it."""
    return {r["feature"]: (r["min"], r["max"]) for r in table.collect()}


def _ends(scaler: Scaler, name: str) -> tuple[float, float]:
    lo, hi = scaler[name]
    return (lo, hi) if hi != lo else (lo, lo + MIN_WIDTH)


def normalised(c: str, scaler: Scaler, name: str, out: str | None = None) -> Column:
    """The column expression ``c`` (SQL text) mapped to 0…1 by the ends of ``name``."""
    lo, hi = _ends(scaler, name)
    return F.expr(f"({c} - ({lo!r}D)) / ({hi - lo!r}D) AS {q(out or name)}")


def denormalised(c: str, scaler: Scaler, name: str, out: str | None = None) -> Column:
    """Inverse of :func:`normalised`."""
    lo, hi = _ends(scaler, name)
    return F.expr(f"{c} * ({hi - lo!r}D) + ({lo!r}D) AS {q(out or name)}")


def normalise(df: DataFrame, scaler: Scaler, cols: Sequence[str]) -> DataFrame:
    wanted = set(cols)
    return df.select(*[normalised(q(c), scaler, c) if c in wanted else q(c) for c in df.columns])


def denormalise(df: DataFrame, scaler: Scaler, cols: Sequence[str]) -> DataFrame:
    wanted = set(cols)
    return df.select(*[denormalised(q(c), scaler, c) if c in wanted else q(c) for c in df.columns])


def class_weight(cls: Column) -> Column:
    """How many rows a row of this class stands for in training."""
    weight = F.lit(1)
    for size, copies in sorted(CLASS_COPIES.items()):
        weight = F.when(F.abs(cls) == size, copies).otherwise(weight)
    return weight


def replicate_by_class(df: DataFrame, cls: str) -> DataFrame:
    """Repeat rows so that larger changes weigh more (copies made in place, no
    shuffle). Models that take a weight column use ``class_weight`` instead."""
    copies = F.sequence(F.lit(1), class_weight(col(cls)))
    return df.withColumn("__copy", F.explode(copies)).drop("__copy")
