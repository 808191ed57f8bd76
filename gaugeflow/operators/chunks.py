"""Series operators that never put a whole series into one task.

A series may be long and one series may hold a large share of all rows, so no
window here is partitioned by the series key alone. Time is cut into chunks
(one week by default: about a thousand rows on a ten-minute grid) and windows
run over (series, chunk), which spreads a hot series over all executors.

What crosses a chunk border is supplied in one of two ways:

* a fixed reach (lags and leads): every row is also sent to the neighbouring
  chunks that can see it, a few percent of extra rows;
* an open reach (fills, interpolation, positions, gaps): the rows are dealt to
  (series, chunk) once. That exchange is read by two sides: one reduces each chunk
  to a summary row, a window walks over the summaries, and the result is joined
  back to the rows of the other side, which stay where they are. A series has at
  most (time span / chunk length) summaries, a number the calendar bounds
  whatever the volume of readings.

Timestamps must not be null and must be unique within a series (see
``guards``); dense series take a shorter chunk. Null keys form a series of their
own. NaN counts as a missing reading.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions.columns import col, known_values, q, qs
from gaugeflow.functions.times import DAY, MINUTE, at_seconds, epoch_seconds

WEEK = 7 * DAY

SEC = "__sec"
CHUNK = "__chunk"
OWN = "__own"
SLICE = "__slice"


def with_chunk(df: DataFrame, ts: str, chunk: int = WEEK) -> DataFrame:
    sec = epoch_seconds(col(ts))
    return df.withColumns({SEC: sec, CHUNK: F.floor(sec / F.lit(chunk))})


def _dealt(df: DataFrame, keys: Sequence[str], ts: str, chunk: int, without: Sequence[str] = ()) -> DataFrame:
    """The rows with ``SEC``, dealt by ``SLICE`` = (series, chunk); columns that nothing reads later stay behind.

    The key is one struct: structs are equal where both hold nulls, so rows of a
    null series find their summary.
    """
    chunked = with_chunk(df, ts, chunk)
    return chunked.withColumn(SLICE, F.struct(*[col(k) for k in keys], F.col(CHUNK))).drop(CHUNK, *without).repartition(SLICE)


def _summary(dealt: DataFrame, aggregates: Sequence[Column], made: Sequence[str] = ()) -> DataFrame:
    """One row per slice, worked out from the same exchange as the rows.

    Spark reads an exchange twice only if both sides want the same columns of it, so
    the summary touches all of them but those ``made`` after it.
    """
    whole = [F.col(f"`{c.replace('`', '``')}`") for c, kind in dealt.dtypes if c not in made and "map<" not in kind]
    summary = dealt.groupBy(SLICE).agg(F.max(F.xxhash64(*whole)).alias("__whole"), *aggregates)
    return summary.where("__whole IS NOT NULL").drop("__whole")


def _key(keys: Sequence[str]) -> list[Column]:
    return [F.col(SLICE).getField(k) for k in keys]


def _walk(keys: Sequence[str], backward: bool = False) -> Window:
    """Over the summaries of a series, in the order of their chunks."""
    chunk = F.col(SLICE).getField(CHUNK)
    return Window.partitionBy(*_key(keys)).orderBy(chunk.desc() if backward else chunk)


def at_offsets(
    df: DataFrame, keys: Sequence[str], ts: str, wanted: Sequence[tuple[str, int, str]], chunk: int = WEEK
) -> DataFrame:
    """Add, for each (column, minutes, name), the column's value at exactly
    ``ts + minutes``, null where the series has no row at that time.

    One shuffle, one sort and one window node for any number of lookups.
    """
    back = MINUTE * max([0] + [-m for _, m, _ in wanted])
    ahead = MINUTE * max([0] + [m for _, m, _ in wanted])
    sec = F.col(SEC)
    sent = (
        df.withColumn(SEC, epoch_seconds(col(ts)))
        .withColumn(OWN, F.floor(sec / F.lit(chunk)))
        .withColumn(
            CHUNK, F.explode(F.sequence(F.floor((sec - ahead) / F.lit(chunk)), F.floor((sec + back) / F.lit(chunk))))
        )
    )
    series = ", ".join(qs([*keys, CHUNK]))
    looked_up = [
        F.expr(f"max({q(c)}) OVER (PARTITION BY {series} ORDER BY {SEC} RANGE BETWEEN {_bound(m)} AND {_bound(m)}) AS {q(name)}")
        for c, m, name in wanted
    ]
    return (
        sent.select("*", *looked_up)
        .where(F.col(CHUNK) == F.col(OWN))
        .select(*qs(df.columns), *qs(name for _, _, name in wanted))
    )


def _bound(minutes: int) -> str:
    """Window frame bound at an offset in minutes."""
    return f"{abs(minutes) * MINUTE} {'PRECEDING' if minutes < 0 else 'FOLLOWING'}"


UP_TO_HERE = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _over(keys: Sequence[str], order: str, frame: str = "") -> str:
    """An OVER clause; without keys it may only be used on chunk summaries."""
    partition = f"PARTITION BY {', '.join(qs(keys))} " if keys else ""
    return f"OVER ({partition}ORDER BY {order} {frame})"


def _nearest_known(
    dealt: DataFrame, keys: Sequence[str], cols: Sequence[str], order: str, placed: bool = False
) -> tuple[DataFrame, dict[str, tuple[str, str, str, str]]]:
    """For each column, as SQL text, the last known value at or before the row
    and the first one at or after it, each with its position in ``order``:
    (earlier value, its position, later value, its position).

    ``order`` is a long column of the dealt rows. With ``placed`` it counts within
    the slice, and is counted on from slice to slice here.
    """
    numbered = list(enumerate(cols))
    known_at = {c: f"CASE WHEN {q(c)} IS NOT NULL THEN {order} END" for c in cols}
    picks = [
        F.expr(f"{pick}({q(c)}, {known_at[c]}) AS __{side}v{i}") for i, c in numbered for pick, side in (("max_by", "l"), ("min_by", "f"))
    ] + [F.expr(f"{pick}({known_at[c]}) AS __{side}t{i}") for i, c in numbered for pick, side in (("max", "l"), ("min", "f"))]
    summary = _summary(dealt, [*picks, *([F.count("*").alias("__n")] if placed else [])], [order] if placed else [])
    if placed:
        before = F.coalesce(F.sum("__n").over(_walk(keys).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        summary = summary.withColumn("__before", before)
        summary = summary.withColumns({f"__{side}t{i}": F.col(f"__{side}t{i}") + F.col("__before") for i, _ in numbered for side in "lf"})
    earlier, later = (_walk(keys, back).rowsBetween(Window.unboundedPreceding, -1) for back in (False, True))
    carried = summary.select(
        SLICE,
        *(["__before"] if placed else []),
        *[F.last(f"__l{x}{i}", True).over(earlier).alias(f"__p{x}{i}") for i, _ in numbered for x in "vt"],
        *[F.last(f"__f{x}{i}", True).over(later).alias(f"__n{x}{i}") for i, _ in numbered for x in "vt"],
    )
    joined = dealt.join(carried, SLICE, "left")
    if placed:
        joined = joined.withColumn(order, F.col(order) + F.col("__before"))
    # Both directions use a growing frame (linear); "rows following" frames
    # would be re-evaluated from scratch for every row.
    upto, downto = _over([SLICE], order, UP_TO_HERE), _over([SLICE], f"{order} DESC", UP_TO_HERE)
    picked = {
        c: (
            f"coalesce(last({q(c)}, true) {upto}, __pv{i})",
            f"coalesce(last({known_at[c]}, true) {upto}, __pt{i})",
            f"coalesce(last({q(c)}, true) {downto}, __nv{i})",
            f"coalesce(last({known_at[c]}, true) {downto}, __nt{i})",
        )
        for i, c in numbered
    }
    return joined, picked


def ffill_bfill(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    cols: Sequence[str] | None = None,
    chunk: int = WEEK,
    backward: bool = True,
) -> DataFrame:
    """Last known value; where there is none yet, the first later one."""
    cols = [c for c in df.columns if c != ts and c not in keys] if cols is None else list(cols)
    joined, picked = _nearest_known(_dealt(known_values(df, cols), keys, ts, chunk), keys, cols, SEC)
    filled = {c: f"coalesce({p[0]}, {p[2]})" if backward else p[0] for c, p in picked.items()}
    return joined.selectExpr(*[f"{filled[c]} AS {q(c)}" if c in filled else q(c) for c in df.columns])


def _interpolated(dealt: DataFrame, keys: Sequence[str], cols: Sequence[str], order: str, out: Sequence[str], placed: bool = False) -> DataFrame:
    joined, picked = _nearest_known(dealt, keys, cols, order, placed)
    names = {c: [f"__{x}{i}" for x in ("pv", "pt", "nv", "nt")] for i, c in enumerate(cols)}
    found = joined.selectExpr(
        *qs(c for c in dict.fromkeys([*out, order]) if c not in cols), *qs(cols), *[f"{e} AS {n}k" for c in cols for e, n in zip(picked[c], names[c], strict=True)]
    )
    filled = {}
    for c, (pv, pt, nv, nt) in names.items():
        between = f"{pv}k + ({nv}k - {pv}k) * try_divide(CAST({order} - {pt}k AS DOUBLE), CAST({nt}k - {pt}k AS DOUBLE))"
        filled[c] = f"coalesce({q(c)}, {between}, {pv}k, {nv}k) AS {q(c)}"
    return found.selectExpr(*[filled.get(c, q(c)) for c in out])


def interpolate_time(df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str], chunk: int = WEEK) -> DataFrame:
    """Linear in elapsed time; before the first and after the last known value
    the nearest one."""
    return _interpolated(_dealt(known_values(df, cols), keys, ts, chunk), keys, cols, SEC, df.columns)


def _numbered(dealt: DataFrame, out: str) -> DataFrame:
    """0-based position of each row in its slice."""
    return dealt.withColumn(out, (F.row_number().over(Window.partitionBy(SLICE).orderBy(SEC)) - 1).cast("long"))


def row_positions(df: DataFrame, keys: Sequence[str], ts: str, out: str, chunk: int = WEEK) -> DataFrame:
    """0-based position of each row in its series, in time order."""
    dealt = _dealt(df, keys, ts, chunk)
    before = F.coalesce(F.sum("__n").over(_walk(keys).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = _summary(dealt, [F.count("*").alias("__n")]).select(SLICE, before.alias("__before"))
    placed = _numbered(dealt.join(offsets, SLICE, "left"), out)
    return placed.withColumn(out, F.col(out) + F.col("__before")).select(*qs([*df.columns, out]))


def interpolate_rows(df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str], chunk: int = WEEK) -> DataFrame:
    """Linear in row position (every step weighs the same); nearest at the ends."""
    numbered = _numbered(_dealt(known_values(df, cols), keys, ts, chunk), "__pos")
    return _interpolated(numbered, keys, cols, "__pos", df.columns, placed=True)


def with_next_second(df: DataFrame, keys: Sequence[str], ts: str, out: str, chunk: int = WEEK) -> DataFrame:
    """Add ``SEC`` and the second of the next row of the series (null at its end); the time itself is dropped."""
    dealt = _dealt(df, keys, ts, chunk, [ts])
    starts = _summary(dealt, [F.min(SEC).alias("__start")]).select(SLICE, F.lead("__start").over(_walk(keys)).alias("__next_start"))
    within = Window.partitionBy(SLICE).orderBy(SEC)
    return dealt.join(starts, SLICE, "left").withColumn(out, F.coalesce(F.lead(SEC).over(within), F.col("__next_start"))).drop("__next_start", SLICE)


def regularise(
    df: DataFrame, keys: Sequence[str], ts: str, step: int = 10, chunk: int = WEEK, hold: bool = False
) -> DataFrame:
    """Rows every ``step`` minutes from the first to the last row of each
    series; added rows have nulls, or with ``hold`` the values of the row before
    the gap. Rows must already lie on the grid.

    The missing slots are generated from the row before the gap, so there is no
    grid table to shuffle and join.
    """
    seconds = step * MINUTE
    values = [c for c in df.columns if c != ts and c not in keys]
    last_slot = F.greatest(F.coalesce(F.col("__next") - seconds, F.col(SEC)), F.col(SEC))
    slots = with_next_second(df, keys, ts, "__next", chunk).select(
        *qs(c for c in df.columns if c != ts),
        F.posexplode(F.sequence(F.col(SEC), last_slot, F.lit(seconds).cast("long"))).alias("__k", "__slot"),
    )
    made = {c: col(c) if hold else F.when(F.col("__k") == 0, col(c)) for c in values}
    made[ts] = at_seconds(F.col("__slot"))
    return slots.select(*[made[c].alias(c) if c in made else q(c) for c in df.columns])


def upsample_split(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    parts: int = 6,
    step: int = 10,
    months: tuple[int, int] | None = (4, 9),
    full_tail: bool = False,
    chunk: int = WEEK,
) -> DataFrame:
    """Spread each (hourly) value over ``parts`` slots of ``step`` minutes.

    A slot gets value / parts (null stays null); slots with no source row get 0;
    only the given months are kept. The grid ends at the last source timestamp,
    so the last row fills one slot unless ``full_tail``.
    """
    seconds = step * MINUTE
    values = [c for c in df.columns if c != ts and c not in keys]
    tail = F.col(SEC) + ((parts - 1) * seconds if full_tail else 0)
    last_slot = F.greatest(F.coalesce(F.col("__next") - seconds, tail), F.col(SEC))
    slots = with_next_second(df, keys, ts, "__next", chunk).select(
        *qs(c for c in df.columns if c != ts),
        F.posexplode(F.sequence(F.col(SEC), last_slot, F.lit(seconds).cast("long"))).alias("__k", "__slot"),
    )
    made = {c: F.when(F.col("__k") < parts, col(c) / F.lit(float(parts))).otherwise(F.lit(0.0)) for c in values}
    made[ts] = at_seconds(F.col("__slot"))
    out = slots.select(*[made[c].alias(c) if c in made else q(c) for c in df.columns])
    return out if months is None else out.where(F.month(col(ts)).between(*months))


def upsample_by_position(
    df: DataFrame, keys: Sequence[str], ts: str, parts: int = 6, step: int = 10, months: tuple[int, int] = (4, 9), chunk: int = WEEK
) -> DataFrame:
    """The same split, but the i-th source row goes to grid slots
    ``i·parts … i·parts+parts-1`` whatever its timestamp says: one missing hour
    moves all later values. Kept to compare with files made that way.
    """
    values = [c for c in df.columns if c != ts and c not in keys]
    grid = regularise(df, keys, ts, step, chunk).where(F.month(col(ts)).between(*months))
    slots = row_positions(grid, keys, ts, "__slot", chunk).withColumn("__row", F.floor(F.col("__slot") / parts))
    placed = {c: f"__placed{i}" for i, c in enumerate(values)}
    place = F.struct(*[col(k) for k in keys], F.col("__row")).alias("__place")
    rows = row_positions(df, keys, ts, "__row", chunk).select(
        place, F.lit(True).alias("__hit"), *[col(c).alias(p) for c, p in placed.items()]
    )
    out = slots.select("*", place).join(rows, "__place", "left")
    # Slots past the last source row keep what the grid has at their own time.
    made = {
        c: F.when(F.col("__hit"), F.col(p) / F.lit(float(parts))).otherwise(F.coalesce(col(c), F.lit(0.0))).alias(c)
        for c, p in placed.items()
    }
    return out.select(*[made[c] if c in made else q(c) for c in df.columns])
