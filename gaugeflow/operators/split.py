"""Chronological split by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from gaugeflow.functions.columns import qs
from gaugeflow.functions.times import DAY
from gaugeflow.operators.chunks import CHUNK, with_chunk
from gaugeflow.operators.guards import exact_ranks, lookup_join
from gaugeflow.session import shared_dir

# Share of the rows after training, and share of those for testing.
REST_SHARE = 0.25
TEST_SHARE = 0.5


def chrono_split(
    df: DataFrame,
    ts: str,
    tiebreak: Sequence[str] = (),
    keys: Sequence[str] = (),
    rest_share: float = REST_SHARE,
    test_share: float = TEST_SHARE,
    out: str = "split",
    chunk: int = DAY,
) -> DataFrame:
    """Add ``train``, ``val`` or ``test`` by position in (ts, tiebreak) order.

    Of n rows, ⌈rest_share·n⌉ come after training and ⌈test_share·rest⌉ of those
    are the test rows. (ts, tiebreak) must be unique within a key.

    Only two rows per key matter: the last training row and the last validation
    row. A histogram over time chunks finds the chunks that hold them, exact
    ranks are worked out inside those chunks only, and all rows are then
    labelled by comparison; the table as a whole is never sorted or shuffled.
    """
    shared_dir(df.sparkSession)
    group = list(keys)
    order = [ts, *tiebreak]
    hist = with_chunk(df, ts, chunk).groupBy(*qs(group), CHUNK).agg(F.count("*").alias("__n"))
    in_order = Window.partitionBy(*qs(group)).orderBy(CHUNK)
    total = F.sum("__n").over(Window.partitionBy(*qs(group)))
    rest = F.ceil(total * F.lit(rest_share))
    train = total - rest
    upto_val = train + rest - F.ceil(rest * F.lit(test_share))
    sized = hist.select(
        *qs(group),
        CHUNK,
        (F.sum("__n").over(in_order) - F.col("__n")).alias("__before"),
        F.sum("__n").over(in_order).alias("__upto"),
        F.array(train, upto_val).alias("__cuts"),
    )
    cuts = (
        sized.select("*", F.posexplode("__cuts").alias("__cut", "__rank"))
        .where((F.col("__before") < F.col("__rank")) & (F.col("__rank") <= F.col("__upto")))
        .select(*qs(group), CHUNK, "__cut", (F.col("__rank") - F.col("__before")).alias("__rank"))
    )
    placed = with_chunk(df, ts, chunk).select(*qs(group), CHUNK, *qs(order))
    at = F.struct(*qs(order))
    if not group:
        return df.select("*", _label(at, *_two_borders(placed, cuts.collect(), order)).alias(out))
    cuts = cuts.checkpoint()
    near = lookup_join(placed, cuts.select(*qs(group), CHUNK).distinct(), [*group, CHUNK], "inner")
    borders = (
        exact_ranks(near, [*group, CHUNK], order, "__rank")
        .join(cuts, [*group, CHUNK, "__rank"])
        .groupBy(*qs(group))
        .agg(F.max(F.when(F.col("__cut") == 0, at)).alias("__train_end"), F.max(F.when(F.col("__cut") == 1, at)).alias("__val_end"))
        .checkpoint()
    )
    marked = lookup_join(df, borders, group)
    return marked.select(*qs(df.columns), _label(at, F.col("__train_end"), F.col("__val_end")).alias(out))


def _label(at: Column, train_end: Column, val_end: Column) -> Column:
    return F.when(at <= train_end, "train").when(at <= val_end, "val").otherwise("test")


def _two_borders(placed: DataFrame, cuts: list[Row], order: Sequence[str]) -> list[Column]:
    """The last training row and the last validation row of the whole table, as
    literals (null where a part is empty). ``cuts`` has at most two rows."""
    near = placed.where(F.col(CHUNK).isin([c[CHUNK] for c in cuts]))
    wanted = F.lit(False)
    for c in cuts:
        wanted = wanted | ((F.col(CHUNK) == c[CHUNK]) & (F.col("__rank") == c["__rank"]))
    found = {(r[CHUNK], r["__rank"]): r for r in exact_ranks(near, [CHUNK], order, "__rank").where(wanted).collect()} if cuts else {}
    types = {f.name: f.dataType for f in placed.schema}
    ends = []
    for number in (0, 1):
        row = next((found[c[CHUNK], c["__rank"]] for c in cuts if c["__cut"] == number), None)
        ends.append(F.struct(*[F.lit(row[c]).cast(types[c]).alias(c) for c in order]) if row else F.lit(None))
    return ends
