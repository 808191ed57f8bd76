"""Small column helpers used everywhere."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def q(name: str) -> str:
    """A column name as SQL text, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def qs(names: Iterable[str]) -> list[str]:
    return [q(n) for n in names]


def text(value: str) -> str:
    """A string as an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def col(name: str) -> Column:
    """Column by exact name."""
    return F.col(q(name))


def drop_like(df: DataFrame, substr: str) -> DataFrame:
    """Drop the columns whose name contains ``substr``."""
    return df.select(*qs(c for c in df.columns if substr not in c))


def cols_like(df: DataFrame, substr: str) -> list[str]:
    """Names of the columns that contain ``substr``."""
    return [c for c in df.columns if substr in c]


def round_half_even(c: Column, digits: int) -> Column:
    """Scale, round to the nearest even integer, scale back (the IEEE rule)."""
    scale = 10.0**digits
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def nan_to_null(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def finite(c: Column) -> Column:
    """The value, null for NaN and the infinities."""
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def known_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """NaN counts as no reading in the floating-point columns among ``cols``."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: nan_to_null(col(c)) for c in cols if kinds[c] in ("float", "double")})


def unpivot(df: DataFrame, keys: list[str], cols: list[str], name: str, value: str) -> DataFrame:
    """Wide to long: one row per (row, column)."""
    return df.unpivot(qs(keys), qs(cols), name, value)
