"""Column statistics of raw and cleaned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gaugeflow.functions.columns import col, unpivot
from gaugeflow.functions.numbers import garbled_runs, is_asterisk, to_number

# Columns the profile leaves out.
UNPROFILED = ("datetime", "Year", "Month", "Day", "Hour", "Minute")


def quality_profile(df: DataFrame, source: str, skip: Sequence[str] = UNPROFILED) -> DataFrame:
    """One row per (source, column): how many cells there are, are null, are
    zero, hold only an asterisk, hold runs of non-ASCII text, fail to parse as a
    number, and how many distinct values there are.

    Cells are counted per distinct value first, but no cell crosses the network: a
    value stands as its SHA-256 digest beside what the patterns say of it, so the rows
    that are shuffled have a fixed width and repeats are folded before.
    """
    cols = [c for c in df.columns if c != source and c not in skip]
    cells = unpivot(df.select(col(source), *[col(c).cast("string").alias(c) for c in cols]), [source], cols, "column", "value")
    value, n = F.col("value"), F.col("n")
    marks = {
        "digest": F.unhex(F.sha2(value, 256)),
        "zero": F.coalesce(to_number(value) == 0, F.lit(False)),
        "asterisk": F.coalesce(is_asterisk(value), F.lit(False)),
        "garbled": F.coalesce(garbled_runs(value), F.lit(0)),
        "coerced_null": value.isNotNull() & to_number(value).isNull(),
    }
    counted = cells.select(col(source), "column", *[c.alias(name) for name, c in marks.items()]).groupBy(col(source), "column", *marks).agg(F.count("*").alias("n"))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    return counted.groupBy(col(source), "column").agg(
        F.sum(n).alias("total"),
        total(F.col("digest").isNull()).alias("null"),
        total(F.col("zero")).alias("zero"),
        total(F.col("asterisk")).alias("asterisk"),
        F.coalesce(F.sum(F.col("garbled") * n), F.lit(0)).alias("garbled"),
        F.count("digest").alias("unique"),
        total(F.col("coerced_null")).alias("coerced_null"),
    )


def yearly_trend(df: DataFrame, ts: str, cols: Sequence[str]) -> DataFrame:
    """Per (column, year): number of values, smallest, largest and mean."""
    return _yearly(df, ts, cols).groupBy("column", "year").agg(
        F.count("value").alias("n"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.avg("value").alias("mean_value"),
    )


def daily_trend(df: DataFrame, ts: str, cols: Sequence[str]) -> DataFrame:
    """Per (column, day): mean value, the points of a yearly line chart."""
    long = unpivot(df.select(F.to_date(col(ts)).alias("day"), *[col(c).cast("double").alias(c) for c in cols]), ["day"], list(cols), "column", "value")
    return long.groupBy("column", "day").agg(F.avg("value").alias("mean_value"))


def _yearly(df: DataFrame, ts: str, cols: Sequence[str]) -> DataFrame:
    return unpivot(
        df.select(F.year(col(ts)).alias("year"), *[col(c).cast("double").alias(c) for c in cols]), ["year"], list(cols), "column", "value"
    )


def yearly_histogram(df: DataFrame, ts: str, cols: Sequence[str], bins: int = 30) -> DataFrame:
    """Counts in ``bins`` equal bins from the smallest to the largest value of
    each (column, year); the last bin is closed; bins with no value are absent.

    A constant column gets the range value ± 0.5.
    """
    long = _yearly(df, ts, cols).where(F.col("value").isNotNull() & ~F.isnan("value"))
    ranges = (
        long.groupBy("column", "year")
        .agg(F.min("value").alias("__lo"), F.max("value").alias("__hi"))
        .select(
            "column",
            "year",
            F.when(F.col("__lo") == F.col("__hi"), F.col("__lo") - 0.5).otherwise(F.col("__lo")).alias("lo"),
            F.when(F.col("__lo") == F.col("__hi"), F.col("__hi") + 0.5).otherwise(F.col("__hi")).alias("hi"),
        )
    )
    # One row for each column and year; Spark broadcasts it while it is small.
    placed = long.join(ranges, ["column", "year"])
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    bin_no = F.least(F.floor((F.col("value") - F.col("lo")) / width) + 1, F.lit(bins)).cast("int")
    return placed.groupBy("column", "year", "lo", "hi", bin_no.alias("bin")).agg(F.count("*").alias("n"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per column: number of null (or NaN) cells, in one pass."""
    types = dict(df.dtypes)
    cols = list(df.columns if cols is None else cols)

    def missing(c: str):
        return col(c).isNull() | F.isnan(col(c)) if types[c] in ("double", "float") else col(c).isNull()

    wide = df.agg(*[F.count_if(missing(c)).alias(c) for c in cols])
    return wide.unpivot([], [col(c) for c in cols], "column", "missing")


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that flow past this point, with no scan of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias(name)), seen


def stage_counts(stages: Sequence[Observation], result: DataFrame) -> DataFrame:
    """Run ``result`` once and return (stage, rows) for every observed stage."""
    result.write.format("noop").mode("overwrite").save()
    rows = [(name, int(n)) for seen in stages for name, n in seen.get.items()]
    return result.sparkSession.createDataFrame(rows, "stage string, n_rows bigint")
