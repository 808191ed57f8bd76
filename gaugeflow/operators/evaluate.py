"""Forecast error by class of change, and the forecast report."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.columns import col, q, qs, round_half_even
from gaugeflow.functions.numbers import CLASSES
from gaugeflow.functions.times import second_text, shift_minutes

# Fixed value: factor from a scaled rate error to centimetres.
ERROR_SCALE = 259.0

# Column and field names of the report handed to users.
REPORT_NAMES = {
    "target_time": "時間",
    "predicted_level": "予測の水位 (m)",
    "actual_level": "実測の水位 (m)",
    "predicted_rate_pct": "予測の水位変動率 (%)",
    "actual_rate_pct": "実測の水位変動率 (%)",
}
SUMMARY_NAMES = ("基準時刻", "現在の水位", "予測の一時間後の水位")


def mae_by_class(
    results: DataFrame,
    horizons: Sequence[int],
    ranges: Mapping[int, float] | None = None,
    keys: Sequence[str] = (),
    names: Callable[[int], tuple[str, str, str]] = lambda h: (f"rate_{h}_pred", f"rate_{h}_actual", f"class_{h}"),
    scale: float = ERROR_SCALE,
    classes: Sequence[int] = CLASSES,
) -> DataFrame:
    """One row per (keys, horizon, class): rows, mean absolute rate error, and
    that error times ``scale`` times the horizon's target range.

    All (horizon, class) cells are conditional aggregates of one pass, so the
    rows are never multiplied and every cell is there, empty ones with null.
    """
    aggs, cells = [], []
    for h in horizons:
        pred, actual, cls = qs(names(h))
        factor = scale * (1.0 if ranges is None else ranges[h])
        for k in classes:
            cell = q(f"{h}|{k}")
            aggs.append(
                F.expr(
                    f"named_struct('horizon', {h}, 'change_class', {k}, 'n', count(CASE WHEN {cls} = {k} THEN 1 END),"
                    f" 'mae', avg(CASE WHEN {cls} = {k} THEN abs({actual} - {pred}) END),"
                    f" 'scaled_mae', {factor!r}D * avg(CASE WHEN {cls} = {k} THEN abs({actual} - {pred}) END)) AS {cell}"
                )
            )
            cells.append(cell)
    wide = results.groupBy(*qs(keys)).agg(*aggs)
    return wide.select(*qs(keys), F.explode(F.array(*cells)).alias("cell")).select(*qs(keys), "cell.*")


def mae_matrix(by_class: DataFrame, keys: Sequence[str] = (), value: str = "scaled_mae") -> DataFrame:
    """Horizon by class, one column per class."""
    return by_class.groupBy(*[col(k) for k in keys], "horizon").pivot("change_class", list(CLASSES)).agg(F.first(value))


def forecast_at(
    forecasts: DataFrame,
    bases: DataFrame,
    horizons: Sequence[int],
    keys: Sequence[str] = (),
    ts: str = "datetime",
    level: str = "level",
    names: Callable[[int], tuple[str, str, str]] = lambda h: (f"level_{h}", f"rate_{h}_pred", f"rate_{h}_actual"),
) -> DataFrame:
    """Forecast against outcome for each base time and horizon.

    ``bases`` holds (keys, ts); a base time with no forecast row yields nothing.
    Levels and rates (in %) are rounded to two decimals.
    """
    k = [col(c) for c in keys]
    base_rows = forecasts.join(bases.select(*k, col(ts)).distinct(), [*keys, ts], "left_semi")
    per_horizon = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(h).alias("horizon"),
                    col(names(h)[0]).alias("predicted_level"),
                    col(names(h)[1]).alias("predicted_rate"),
                    col(names(h)[2]).alias("actual_rate"),
                )
                for h in horizons
            ]
        )
    )
    asked = base_rows.select(*k, col(ts).alias("base_time"), per_horizon.alias("f")).select(
        *k, "base_time", "f.*", shift_minutes(F.col("base_time"), F.col("f.horizon")).alias("target_time")
    )
    outcome = forecasts.select(*k, col(ts).alias("target_time"), col(level).alias("__outcome"))
    return asked.join(outcome, [*keys, "target_time"], "left").select(
        *k,
        "base_time",
        "horizon",
        "target_time",
        round_half_even(F.col("predicted_level"), 2).alias("predicted_level"),
        round_half_even(F.col("__outcome"), 2).alias("actual_level"),
        round_half_even(F.col("predicted_rate") * 100, 2).alias("predicted_rate_pct"),
        round_half_even(F.col("actual_rate") * 100, 2).alias("actual_rate_pct"),
    )


def report_table(lookup: DataFrame) -> DataFrame:
    """The lookup under the names, and with the time format, that users see."""
    rest = [c for c in lookup.columns if c not in REPORT_NAMES]
    shown = {c: col(c) for c in REPORT_NAMES}
    shown["target_time"] = second_text(F.col("target_time"))
    return lookup.select(*[col(c) for c in rest], *[shown[c].alias(name) for c, name in REPORT_NAMES.items()])


def forecast_json(
    forecasts: DataFrame, keys: Sequence[str] = (), ts: str = "datetime", level: str = "level", hour_ahead: str = "level_60"
) -> DataFrame:
    """One JSON record per row: base time, level now, level in an hour (the text
    ``N/A`` when there is no forecast)."""
    at, now, ahead = SUMMARY_NAMES

    def record(forecast: Column) -> Column:
        return F.to_json(
            F.struct(
                second_text(col(ts)).alias(at),
                round_half_even(col(level), 2).alias(now),
                forecast.alias(ahead),
            )
        )

    message = F.when(col(hour_ahead).isNull(), record(F.lit("N/A"))).otherwise(record(round_half_even(col(hour_ahead), 2)))
    return forecasts.select(*[col(k) for k in keys], col(ts), message.alias("message"))
