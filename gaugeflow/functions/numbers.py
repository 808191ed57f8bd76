"""Text-to-number coercion and the classes of change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.columns import col, nan_to_null

# Number spellings accepted by coercion, the marks that stand for
# "no reading", and what counts as garbled text.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?\s*$"
ASTERISKS = ("*", "＊")
GARBLED_PATTERN = r"[^\x00-\x7F]+"
EDGE_SPACE_PATTERN = r"(?U)^\s+|\s+$"

# Limits (metres) of "no change" and "small change", and how many
# rows each class of change contributes to training.
NO_CHANGE = 0.005
SMALL_CHANGE = 0.015
CLASSES = (-2, -1, 0, 1, 2)
CLASS_COPIES = {0: 1, 1: 4, 2: 11}


def to_number(c: Column) -> Column:
    """Double of a text cell, null for anything that is not a plain number.

    The pattern keeps out spellings that Java accepts and the data never means
    (``1d``, ``0x1p3``, ``NaN``).
    """
    return nan_to_null(F.when(c.rlike(NUMBER_PATTERN), F.trim(c).try_cast("double")))


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: to_number(col(c)) for c in cols})


def is_asterisk(c: Column) -> Column:
    return F.regexp_replace(c, EDGE_SPACE_PATTERN, "").isin(*ASTERISKS)


def garbled_runs(c: Column) -> Column:
    return F.regexp_count(c, F.lit(GARBLED_PATTERN))


def change_class(x: Column) -> Column:
    """-2, -1, 0, 1 or 2 by size and sign of a level change; null for null."""
    sign = F.when(x > 0, 1).otherwise(-1)
    return (
        F.when(F.abs(x) <= NO_CHANGE, F.lit(0))
        .when(F.abs(x) <= SMALL_CHANGE, sign)
        .when(x.isNotNull() & ~F.isnan(x), sign * 2)
        .cast("int")
    )


def level_after(level: Column, rate: Column) -> Column:
    """Level that a relative change leads to."""
    return level + level * rate
