"""Zone-free time arithmetic and calendar columns.

All timestamps are TIMESTAMP_NTZ: the readings carry local wall-clock times
with no zone, so no expression here may depend on the session time zone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.columns import col

# Accepted spellings of the date and time cells, each with year, month and day in this order.
DATE_PATTERNS = (
    r"^\s*(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})\s*$",
    r"^\s*(\d{4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日\s*$",
    r"^\s*(\d{4})(\d{2})(\d{2})\s*$",
)
TIME_PATTERN = r"^\s*(\d{1,2}):(\d{2})(?::(\d{2}))?\s*$"

MINUTE = 60
DAY = 86_400


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a zone-free timestamp."""
    return F.unix_timestamp(ts)


def at_seconds(seconds: Column) -> Column:
    """Inverse of :func:`epoch_seconds`."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def shift_minutes(ts: Column, minutes: Column | int) -> Column:
    return ts + F.make_dt_interval(mins=F.lit(minutes) if isinstance(minutes, int) else minutes)


def floor_minutes(ts: Column, step: int) -> Column:
    """Start of the ``step``-minute slot (step divides 60)."""
    return ts - F.make_dt_interval(
        mins=(F.minute(ts) % step).cast("int"), secs=F.date_part(F.lit("SECOND"), ts).cast("decimal(18,6)")
    )


def floor_hour(ts: Column) -> Column:
    return floor_minutes(ts, 60)


def second_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, without going through a time zone."""
    return F.substring(ts.cast("string"), 1, 19)


def parse_date_time(date: Column, time: Column, dates: Sequence[str] = DATE_PATTERNS) -> Column:
    """Timestamp of a date text and a time text, null when either is empty,
    malformed or out of range (``24:00`` is out of range). The first of the
    ``dates`` that fits counts."""
    h, mi = (F.regexp_extract(time, TIME_PATTERN, i).try_cast("int") for i in (1, 2))
    # Absent seconds are empty text, whose cast raises and catches an error in every row; with a zero before it none.
    second = F.concat(F.lit("0"), F.regexp_extract(time, TIME_PATTERN, 3)).try_cast("int").cast("decimal(16,6)")

    def at(pattern: str) -> Column:
        y, mo, d = (F.regexp_extract(date, pattern, i).try_cast("int") for i in (1, 2, 3))
        return F.try_make_timestamp_ntz(y, mo, d, h, mi, second)

    first, *others = dates
    found = F.when(date.rlike(first), at(first))
    for pattern in others:
        found = found.when(date.rlike(pattern), at(pattern))
    return F.when(time.rlike(TIME_PATTERN), found)


def compose_ts(df: DataFrame, date: str = "日付", time: str = "時刻", ts: str = "datetime", dates: Sequence[str] = DATE_PATTERNS) -> DataFrame:
    """Replace the date and time text columns by one timestamp column.

    A table that lacks either column is not a readings table: that is an error
    here, so that the caller can send the file to the rejects.
    """
    missing = [c for c in (date, time) if c not in df.columns]
    if missing:
        raise ValueError(f"no date/time columns {missing}")
    rest = [col(c) for c in df.columns if c not in (date, time, ts)]
    # One time a row, as a generator: a filter on it stays above, where an expression would be parsed once more in the filter.
    return df.select(F.explode(F.array(parse_date_time(col(date), col(time), dates))).alias(ts), *rest)


def calendar_features(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """Add Hour, Weekday (Monday = 0) and Month unless already present."""
    made = {"Hour": F.hour(col(ts)), "Weekday": F.weekday(col(ts)), "Month": F.month(col(ts))}
    return df.withColumns({k: v for k, v in made.items() if k not in df.columns})
