"""Row filters and key comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.columns import col, q, qs


def season_filter(df: DataFrame, ts: str = "datetime", start_year: int = 2018, months: tuple[int, int] = (4, 9)) -> DataFrame:
    """From ``start_year`` on, the given months of each year; null times go.

    The first year is a comparison of the timestamp itself, which the scan can
    use to skip row groups.
    """
    start = F.lit(f"{start_year:04d}-01-01 00:00:00").cast("timestamp_ntz")
    return df.where((col(ts) >= start) & F.month(col(ts)).between(*months))


def on_grid(df: DataFrame, ts: str = "datetime", step: int = 10) -> DataFrame:
    """Rows whose minute is a multiple of ``step`` (seconds are not looked at)."""
    return df.where(F.minute(col(ts)) % step == 0)


def drop_null_ts(df: DataFrame, ts: str = "datetime") -> DataFrame:
    return df.where(col(ts).isNotNull())


def valid_targets(df: DataFrame, cols: Sequence[str], lo: float = -1.0, hi: float = 1.0) -> DataFrame:
    """Rows whose every given column is known, finite and within [lo, hi].

    One conjunction: null, NaN and infinities all fail the comparison.
    """
    return df.where(" AND ".join(f"{c} BETWEEN {lo!r}D AND {hi!r}D" for c in qs(cols)) or "true")


def complete_cases(df: DataFrame, cols: Sequence[str], strict: bool = True) -> DataFrame:
    """Rows with no null or NaN in the given columns.

    ``strict`` makes an absent column an error; otherwise it is left out.
    """
    absent = [c for c in cols if c not in df.columns]
    if absent and strict:
        raise KeyError(f"columns not found: {absent}")
    types = dict(df.dtypes)
    present = [c for c in dict.fromkeys(cols) if c in types]
    known = [f"{q(c)} IS NOT NULL" + (f" AND NOT isnan({q(c)})" if types[c] in ("double", "float") else "") for c in present]
    return df.where(" AND ".join(known) or "true")


def fill_const(df: DataFrame, value: float = 0.0, cols: Sequence[str] | None = None) -> DataFrame:
    """Replace nulls (and NaN) of numeric columns by a constant."""
    wanted = set(df.columns if cols is None else cols)
    filled = {}
    for name, kind in df.dtypes:
        if name in wanted and kind in ("double", "float"):
            filled[name] = F.nanvl(F.coalesce(col(name), F.lit(float(value))), F.lit(float(value))).cast(kind)
        elif name in wanted and kind in ("int", "bigint", "smallint", "tinyint"):
            filled[name] = F.coalesce(col(name), F.lit(int(value)).cast(kind))
    return df.withColumns(filled) if filled else df


def sort_ts(df: DataFrame, ts: str = "datetime", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Global order for a sink; nulls last."""
    return df.orderBy(col(ts).asc_nulls_last(), *[col(c) for c in tiebreak])


def semi_align(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key also occurs in ``right``."""
    return left.join(right.select(*qs(keys)).distinct(), list(keys), "left_semi")


def common_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys present on both sides.

    Repeats are removed before the join, so a hot key reaches it once.
    """
    return left.select(*qs(keys)).distinct().join(right.select(*qs(keys)).distinct(), list(keys), "left_semi")


def lost_keys(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``before`` that no longer occur in ``after``."""
    return before.select(*qs(keys)).distinct().join(after.select(*qs(keys)).distinct(), list(keys), "left_anti")


def first_lost(before: DataFrame, after: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first few lost keys, for a log line."""
    return lost_keys(before, after, keys).orderBy(*[col(k) for k in keys]).limit(n)
