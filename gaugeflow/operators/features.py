"""Lag features, horizon targets and lagged targets.

Everything a row needs from other times is fetched by one ``at_offsets`` call
(one shuffle, one sort, one window node); the rest is projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.columns import q, qs
from gaugeflow.functions.hydraulics import derived_flows
from gaugeflow.functions.times import calendar_features
from gaugeflow.operators.chunks import WEEK, at_offsets
from gaugeflow.operators.filters import complete_cases, valid_targets
from gaugeflow.sources.spec import StationSpec, change_name, feature_columns, lag_name, rate_name


def time_lag(
    df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str], lags: Sequence[int], chunk: int = WEEK
) -> DataFrame:
    """Add ``{col}_{L}lag``: the value exactly L minutes earlier, else null."""
    return at_offsets(df, keys, ts, [(c, -lag, lag_name(c, lag)) for c in cols for lag in lags], chunk)


def time_lead(
    df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str], leads: Sequence[int], chunk: int = WEEK
) -> DataFrame:
    """Add ``{col}_{h}lead``: the value exactly h minutes later, else null."""
    return at_offsets(df, keys, ts, [(c, h, f"{c}_{h}lead") for c in cols for h in leads], chunk)


def _at(minutes: int) -> str:
    return f"__at{minutes}"


def _level_at(level: str, minutes: int) -> str:
    return q(level if minutes == 0 else _at(minutes))


def _change(level: str, start: int, horizon: int, name: str) -> Column:
    """Change of the level over ``horizon`` minutes from ``start``."""
    return F.expr(f"{_level_at(level, start + horizon)} - {_level_at(level, start)} AS {q(name)}")


def _rate(level: str, start: int, horizon: int, name: str) -> Column:
    """The same change relative to the level at ``start``; null over zero."""
    now, then = _level_at(level, start), _level_at(level, start + horizon)
    return F.expr(f"try_divide({then} - {now}, {now}) AS {q(name)}")


def horizon_targets(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    level: str,
    horizons: Sequence[int],
    names=lambda h: (f"rate_{h}", f"change_{h}"),
    chunk: int = WEEK,
) -> DataFrame:
    """Add, per horizon, the relative and the absolute change of ``level``.

    A rate over a zero level is null.
    """
    looked = at_offsets(df, keys, ts, [(level, h, _at(h)) for h in horizons], chunk)
    made = [e for h in horizons for e in (_rate(level, 0, h, names(h)[0]), _change(level, 0, h, names(h)[1]))]
    return looked.select(*qs(df.columns), *made)


def _target_offsets(windows: dict[int, Sequence[int]]) -> set[int]:
    return {m for h, lags in windows.items() for lag in lags for m in (-lag, h - lag)} - {0}


def lagged_targets(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    level: str,
    windows: dict[int, Sequence[int]],
    names=lambda h: (f"rate_{h}", f"change_{h}"),
    chunk: int = WEEK,
) -> DataFrame:
    """Add the targets of horizon h as they were L minutes ago (L ≥ h, so they
    are known now). They are computed from the level at t-L and t-L+h; the
    targets themselves are never looked up."""
    for h, lags in windows.items():
        if min(lags) < h:
            raise ValueError(f"a lag of horizon {h} would look past the present")
    looked = at_offsets(df, keys, ts, [(level, m, _at(m)) for m in sorted(_target_offsets(windows))], chunk)
    return looked.select(*qs(df.columns), *_lagged(level, windows, names))


def _lagged(level: str, windows: dict[int, Sequence[int]], names) -> list[Column]:
    return [
        e
        for h, lags in windows.items()
        for lag in lags
        for e in (
            _rate(level, -lag, h, lag_name(names(h)[0], lag)),
            _change(level, -lag, h, lag_name(names(h)[1], lag)),
        )
    ]


def station_features(
    df: DataFrame, spec: StationSpec, keys: Sequence[str] = (), ts: str = "datetime", strict: bool = False, chunk: int = WEEK, outcomes: bool = True
) -> DataFrame:
    """Wide readings to the station's training table.

    Adds derived flows and calendar columns, lag features, targets and lagged
    targets; keeps the rows whose rates are all valid and that have no gap.
    ``keys`` must hold the split (and the basin), since no value may cross it.
    Without ``outcomes`` there are no targets, and the newest rows stay: the
    table that a forecast starts from.
    """
    base = calendar_features(derived_flows(df), ts)
    lagged = [f for f in spec.lagged if f in base.columns]
    wanted = [(f, -lag, lag_name(f, lag)) for f in lagged for lag in spec.lags]
    has_level = spec.level in base.columns
    windows = {h: spec.lag_windows[h] for h in spec.horizons if h in spec.lag_windows}
    if has_level:
        offsets = _target_offsets(windows) | (set(spec.horizons) if outcomes else set())
        wanted += [(spec.level, m, _at(m)) for m in sorted(offsets)]
    looked = at_offsets(base, keys, ts, wanted, chunk)
    if not has_level:
        return complete_cases(looked, feature_columns(spec), strict)

    def names(h: int) -> tuple[str, str]:
        return rate_name(spec.station, h), change_name(spec.station, h)

    targets = [
        e
        for h in (spec.horizons if outcomes else ())
        for e in (_rate(spec.level, 0, h, names(h)[0]), _change(spec.level, 0, h, names(h)[1]))
    ]
    kept = [c for c in looked.columns if not c.startswith("__at")]
    made = looked.select(*qs(kept), *targets, *_lagged(spec.level, windows, names))
    lagged_rates, _ = spec.lagged_target_columns()
    rates = [rate_name(spec.station, h) for h in spec.horizons] if outcomes else []
    valid = valid_targets(made, rates + lagged_rates)
    return complete_cases(valid, [*feature_columns(spec), *(spec.target_columns() if outcomes else ()), spec.level], strict)


def live_rows(df: DataFrame, spec: StationSpec, ts: str = "datetime", newest: int = 60) -> DataFrame:
    """The readings that the features of the newest ``newest`` minutes need.

    The newest time is the last one at which every input of the station has been
    read; older readings than the longest look back are left to the scan.
    """
    inputs = [c for c in dict.fromkeys([*spec.lagged, spec.level]) if c in df.columns]
    last = df.agg(*[F.max(F.when(F.col(q(c)).isNotNull(), F.col(q(ts)))).alias(f"t{i}") for i, c in enumerate(inputs)]).first()
    if any(t is None for t in last):
        return df.limit(0)
    back = max([0, *spec.lags, *(lag for h in spec.horizons for lag in spec.lag_windows.get(h, ()))])
    first = min(last) - timedelta(minutes=back + newest)
    return df.where((F.col(q(ts)) >= F.lit(first).cast("timestamp_ntz")) & (F.col(q(ts)) <= F.lit(min(last)).cast("timestamp_ntz")))


def select_x(df: DataFrame, spec: StationSpec, keys: Sequence[str] = (), ts: str = "datetime") -> DataFrame:
    return df.select(*qs(c for c in feature_columns(spec) if c in df.columns), *qs([*keys, ts]))


def select_y(df: DataFrame, spec: StationSpec, keys: Sequence[str] = (), ts: str = "datetime") -> DataFrame:
    names = [*spec.target_columns(), spec.level]
    return df.select(*qs(c for c in names if c in df.columns), *qs([*keys, ts]))


def split_xy(
    df: DataFrame, spec: StationSpec, keys: Sequence[str] = (), ts: str = "datetime"
) -> tuple[DataFrame, DataFrame]:
    """Features and targets of the same rows, both with the time."""
    return select_x(df, spec, keys, ts), select_y(df, spec, keys, ts)


def check_xy(x: DataFrame, y: DataFrame, keys: Sequence[str]) -> None:
    """Fail unless both sides hold the same keys equally often."""
    k = qs(keys)
    sides = x.select(*k).withColumn("__d", F.lit(1)).unionByName(y.select(*k).withColumn("__d", F.lit(-1)))
    if not sides.groupBy(*k).agg(F.sum("__d").alias("__d")).where("__d <> 0").isEmpty():
        raise AssertionError("features and targets differ in their rows")
