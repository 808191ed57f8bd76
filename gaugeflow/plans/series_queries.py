"""Queries over series: grid, fills, lags, targets, anomalies, split, scaling."""

from __future__ import annotations

from datetime import timedelta
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.columns import col, cols_like, qs
from gaugeflow.functions.numbers import change_class, level_after
from gaugeflow.operators import chunks, combine, evaluate, features, filters, guards, isolation, scaling
from gaugeflow.operators.forecast import BoostParams, fit_forecasters, forecast, load_forecaster, save_forecaster
from gaugeflow.operators.split import chrono_split
from gaugeflow.plans import fixtures as fx
from gaugeflow.plans.registry import query
from gaugeflow.session import fresh_path, materialise
from gaugeflow.sources.spec import (
    FORECAST_HORIZONS,
    HORIZONS,
    LAGS,
    StationSpec,
    change_name,
    feature_columns,
    from_json,
    lag_name,
    lag_window,
    merge,
    model_columns,
    model_inputs,
    rate_name,
    target_column,
    to_json,
)

KEY = ["sid"]


def shifted(view: str, value: str, offsets: list[int]) -> str:
    """SQL joins that fetch ``value`` of ``view`` at minute offsets as a{n}/b{n}."""
    return "\n".join(
        f"LEFT JOIN {view} {_tag(m)} ON {_tag(m)}.sid = r.sid AND {_tag(m)}.ts = r.ts + INTERVAL '{m} minutes'" for m in offsets
    )


def _tag(m: int) -> str:
    return f"b{-m}" if m < 0 else f"a{m}"


# -- grid and fills -------------------------------------------------------------


@query("regularise", f"WITH {fx.GRID} SELECT sid, ts, v FROM grid")
def regularise(spark: SparkSession, sf: str) -> DataFrame:
    return fx.grid(spark, sf)


@query(
    "ffill_bfill",
    f"""WITH {fx.HOLES} SELECT sid, ts, coalesce(
      last_value(v IGNORE NULLS) OVER (PARTITION BY sid ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value(v IGNORE NULLS) OVER (PARTITION BY sid ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v
    FROM holes""",
)
def ffill_bfill(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.ffill_bfill(fx.holes(spark, sf), KEY, "ts", ["v"])


@query("fill_zero", f"WITH {fx.GRID} SELECT sid, ts, coalesce(v, 0) AS v FROM grid")
def fill_zero(spark: SparkSession, sf: str) -> DataFrame:
    return filters.fill_const(fx.grid(spark, sf), 0.0, ["v"])


def interpolation_sql(cte: str, view: str, position: str) -> str:
    return f"""WITH {cte}, p AS (SELECT sid, ts, v, {position} AS pos FROM {view}), k AS (
      SELECT *,
        last_value(v IGNORE NULLS) OVER up AS pv, last_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) OVER up AS pp,
        first_value(v IGNORE NULLS) OVER dn AS nv, first_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) OVER dn AS np
      FROM p WINDOW up AS (PARTITION BY sid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                    dn AS (PARTITION BY sid ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT sid, ts, CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv
      ELSE pv + (nv - pv) * (CAST(pos - pp AS DOUBLE) / CAST(np - pp AS DOUBLE)) END AS v FROM k"""


@query("interp_time", interpolation_sql(fx.HOLES, "holes", "epoch(ts)::BIGINT"))
def interp_time(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.interpolate_time(fx.holes(spark, sf), KEY, "ts", ["v"])


@query("interp_rows", interpolation_sql(fx.HOLES, "holes", "row_number() OVER (PARTITION BY sid ORDER BY ts)"))
def interp_rows(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.interpolate_rows(fx.holes(spark, sf), KEY, "ts", ["v"])


@query(
    "rain_upsample",
    f"""WITH {fx.HOURLY_ORDERS}, slots AS (
      SELECT unnest(generate_series(min(ts), max(ts), INTERVAL '10 minutes')) AS ts FROM hourly)
    SELECT s.ts, CASE WHEN h.ts IS NULL THEN 0.0 ELSE h.r / 6.0::DOUBLE END AS r
    FROM slots s LEFT JOIN hourly h ON h.ts = date_trunc('hour', s.ts) WHERE month(s.ts) BETWEEN 4 AND 9""",
)
def rain_upsample(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.upsample_split(fx.hourly_orders(spark, sf), [], "ts")


@query(
    "rain_by_position",
    f"""WITH {fx.HOURLY_ORDERS}, slots AS (
      SELECT unnest(generate_series(min(ts), max(ts), INTERVAL '10 minutes')) AS ts FROM hourly),
    s AS (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS pos FROM slots WHERE month(ts) BETWEEN 4 AND 9),
    h AS (SELECT r, row_number() OVER (ORDER BY ts) - 1 AS pos FROM hourly)
    SELECT s.ts, CASE WHEN h.pos IS NOT NULL THEN h.r / 6.0::DOUBLE ELSE coalesce(o.r, 0.0) END AS r
    FROM s LEFT JOIN h ON h.pos = s.pos // 6 LEFT JOIN hourly o ON o.ts = s.ts""",
)
def rain_by_position(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.upsample_by_position(fx.hourly_orders(spark, sf), [], "ts")


OUTLIER_SHARE = 0.97


@query(
    "anomaly_repair",
    interpolation_sql(
        fx.GRID
        + f""", lim AS (SELECT quantile_cont(v, {OUTLIER_SHARE}) AS q FROM readings),
        blanked AS (SELECT sid, ts, CASE WHEN v <= (SELECT q FROM lim) THEN v END AS v FROM grid)""",
        "blanked",
        "epoch(ts)::BIGINT",
    ),
)
def anomaly_repair(spark: SparkSession, sf: str) -> DataFrame:
    limit = guards.exact_quantile(fx.readings(spark, sf), "v", OUTLIER_SHARE)
    flagged = fx.grid(spark, sf).withColumn("v_outlier", F.col("v") > limit)
    return isolation.repair(flagged, ["v"], KEY, "ts")


# -- lags and targets ------------------------------------------------------------


@query(
    "time_lag",
    f"WITH {fx.READINGS} SELECT r.sid, r.ts, r.v, {', '.join(f'{_tag(-m)}.v AS v_{m}lag' for m in LAGS)} FROM readings r "
    + shifted("readings", "v", [-m for m in LAGS]),
)
def time_lag(spark: SparkSession, sf: str) -> DataFrame:
    return features.time_lag(fx.readings(spark, sf), KEY, "ts", ["v"], LAGS)


def rate_sql(end: str, start: str) -> str:
    return f"CASE WHEN {start} <> 0 THEN ({end} - {start}) / {start} END"


TARGETS = ", ".join(
    f"{rate_sql(f'a{h}.v', 'r.v')} AS rate_{h}, a{h}.v - r.v AS change_{h}" for h in HORIZONS
)


@query(
    "horizon_targets",
    f"WITH {fx.READINGS} SELECT r.sid, r.ts, r.v, {TARGETS} FROM readings r " + shifted("readings", "v", list(HORIZONS)),
)
def horizon_targets(spark: SparkSession, sf: str) -> DataFrame:
    return features.horizon_targets(fx.readings(spark, sf), KEY, "ts", "v", HORIZONS)


LAGGED = {h: lag_window(h) for h in HORIZONS}
LAGGED_AT = sorted({m for h, lags in LAGGED.items() for lag in lags for m in (-lag, h - lag)} - {0})
LAGGED_SQL = ", ".join(
    f"{rate_sql(end, f'b{lag}.v')} AS rate_{h}_{lag}lag, {end} - b{lag}.v AS change_{h}_{lag}lag"
    for h, lags in LAGGED.items()
    for lag in lags
    for end in [f"{_tag(h - lag)}.v" if h != lag else "r.v"]
)


@query(
    "lagged_targets",
    f"WITH {fx.READINGS} SELECT r.sid, r.ts, r.v, {LAGGED_SQL} FROM readings r "
    + shifted("readings", "v", LAGGED_AT),
)
def lagged_targets(spark: SparkSession, sf: str) -> DataFrame:
    return features.lagged_targets(fx.readings(spark, sf), KEY, "ts", "v", LAGGED)


VALID_SQL = f"""WITH {fx.READINGS}, t AS (
  SELECT r.sid, r.ts, r.v, {rate_sql('a10.v', 'r.v')} AS rate_10, a10.v - r.v AS change_10
  FROM readings r {shifted('readings', 'v', [10])}), valid AS (SELECT * FROM t WHERE rate_10 BETWEEN -1 AND 1)"""


def valid_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.horizon_targets(fx.readings(spark, sf), KEY, "ts", "v", [10])
    return filters.valid_targets(rows, ["rate_10"])


@query("valid_targets", VALID_SQL + " SELECT * FROM valid")
def valid_targets(spark: SparkSession, sf: str) -> DataFrame:
    return valid_rows(spark, sf)


@query("lost_keys", VALID_SQL + " SELECT sid, ts FROM readings EXCEPT SELECT sid, ts FROM valid")
def lost_keys(spark: SparkSession, sf: str) -> DataFrame:
    return filters.lost_keys(fx.readings(spark, sf), valid_rows(spark, sf), ["sid", "ts"])


@query(
    "complete_cases",
    f"""WITH {fx.READINGS} SELECT r.sid, r.ts, r.v, b10.v AS v_10lag, b20.v AS v_20lag FROM readings r
    {shifted('readings', 'v', [-10, -20])} WHERE b10.v IS NOT NULL AND b20.v IS NOT NULL""",
)
def complete_cases(spark: SparkSession, sf: str) -> DataFrame:
    lagged = features.time_lag(fx.readings(spark, sf), KEY, "ts", ["v"], [10, 20])
    return filters.complete_cases(lagged, ["v", "v_10lag", "v_20lag"])


# -- a whole station ----------------------------------------------------------------

SPEC = fx.STATION
LEVEL = SPEC.level


SPLIT_WIDE = """, numbered AS (SELECT *, row_number() OVER (ORDER BY ts) AS pos, count(*) OVER () AS n FROM wide_all),
wide AS (SELECT * EXCLUDE (pos, n), CASE WHEN pos <= n - ceil(n * 0.25::DOUBLE) THEN 'train'
  WHEN pos <= n - ceil(ceil(n * 0.25::DOUBLE) * 0.5::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM numbered)"""


def station_sql(split: bool = False, spec: StationSpec = SPEC, wide: str = fx.WIDE_STATION, outcomes: bool = True) -> str:
    """A station's training table, by self-joins (within each split)."""
    offsets = sorted({-lag for lag in spec.lags} | {h for h in spec.horizons} | {m for h, w in spec.lag_windows.items() for x in w for m in (-x, h - x)} - {0})
    same = " AND {0}.split = r.split" if split else ""
    joins = "\n".join(
        f"LEFT JOIN wide {_tag(m)} ON {_tag(m)}.ts = r.ts + INTERVAL '{m} minutes'" + same.format(_tag(m)) for m in offsets
    )
    views = wide.replace("wide AS", "wide_all AS") + SPLIT_WIDE if split else wide

    def level(m: int) -> str:
        return f'r."{spec.level}"' if m == 0 else f'{_tag(m)}."{spec.level}"'

    cols = ["r.split"] if split else []
    cols += ["hour(r.ts)::INTEGER AS \"Hour\"", "(isodow(r.ts) - 1)::INTEGER AS \"Weekday\"", "month(r.ts)::INTEGER AS \"Month\""]
    cols += [f'r."{c}"' for c in spec.lagged]
    cols += [f'b{lag}."{c}" AS "{lag_name(c, lag)}"' for c in spec.lagged for lag in spec.lags]
    rates = []
    for h in spec.horizons:
        rate, change = rate_name(spec.station, h), change_name(spec.station, h)
        cols += [f'({level(h)} - {level(0)}) / {level(0)} AS "{rate}"', f'{level(h)} - {level(0)} AS "{change}"']
        rates += [rate] if outcomes else []
        for lag in spec.lag_windows[h]:
            a, b = level(-lag), level(h - lag)
            cols += [f'({b} - {a}) / {a} AS "{lag_name(rate, lag)}"', f'{b} - {a} AS "{lag_name(change, lag)}"']
            rates.append(lag_name(rate, lag))
    complete = [*feature_columns(spec), *(spec.target_columns() if outcomes else ()), spec.level]
    where = " AND ".join([f'"{c}" BETWEEN -1 AND 1' for c in rates] + [f'"{c}" IS NOT NULL' for c in complete])
    return f"WITH {views}, made AS (SELECT r.ts, {', '.join(cols)} FROM wide r {joins}), station AS (SELECT * FROM made WHERE {where})"


def station_table(spark: SparkSession, sf: str) -> DataFrame:
    return features.station_features(fx.wide_station(spark, sf), SPEC, [], "ts")


def quoted(names: list[str]) -> str:
    return ", ".join(f'"{n}"' for n in names)


@query("station_select", f"{station_sql()} SELECT ts, {quoted(feature_columns(SPEC))} FROM station")
def station_select(spark: SparkSession, sf: str) -> DataFrame:
    return features.select_x(station_table(spark, sf), SPEC, [], "ts")


@query("split_xy", f"{station_sql()} SELECT ts, {quoted([*SPEC.target_columns(), LEVEL])} FROM station")
def split_xy(spark: SparkSession, sf: str) -> DataFrame:
    _, y = features.split_xy(station_table(spark, sf), SPEC, [], "ts")
    return y


# -- the whole default specification ---------------------------------------------------

FULL = fx.FULL_STATION
FULL_SQL = station_sql(spec=FULL, wide=fx.FULL_WIDE)


def full_table(spark: SparkSession, sf: str) -> DataFrame:
    return features.station_features(fx.full_station(spark, sf), FULL, [], "ts", strict=True)


@query("full_station_xy", f"{FULL_SQL} SELECT ts, {quoted(list(dict.fromkeys([*feature_columns(FULL), *FULL.target_columns(), FULL.level])))} FROM station")
def full_station_xy(spark: SparkSession, sf: str) -> DataFrame:
    """All features and targets of a default station, checked to belong to the same rows, side by side."""
    made = materialise(full_table(spark, sf), "features")
    x, y = features.split_xy(made, FULL, [], "ts")
    features.check_xy(x, y, ["ts"])
    return x.join(y.drop(*(c for c in y.columns if c in x.columns and c != "ts")), "ts")


MODEL = "60min_rate"


@query("model_select", f"{FULL_SQL} SELECT ts, {quoted(model_columns(FULL, MODEL))}, \"{target_column(FULL, MODEL)}\" AS target FROM station")
def model_select(spark: SparkSession, sf: str) -> DataFrame:
    """Inputs and target of one model, as a specification read back from its JSON says."""
    spec = from_json(to_json(merge({}, {FULL.station: FULL})))[FULL.station]
    rows = features.station_features(fx.full_station(spark, sf), spec, [], "ts", strict=True)
    return rows.select("ts", *qs(model_columns(spec, MODEL)), col(target_column(spec, MODEL)).alias("target"))


# -- small operators ----------------------------------------------------------------------


@query("time_lead", f"WITH {fx.READINGS} SELECT r.sid, r.ts, r.v, {', '.join(f'a{h}.v AS v_{h}lead' for h in HORIZONS)} FROM readings r " + shifted("readings", "v", list(HORIZONS)))
def time_lead(spark: SparkSession, sf: str) -> DataFrame:
    return features.time_lead(fx.readings(spark, sf), KEY, "ts", ["v"], HORIZONS)


@query("columns_like", f"WITH {fx.WIDE_STATION} SELECT ts, {quoted([c for c in fx.STATION_COLUMNS.values() if '取水量' in c])} FROM wide")
def columns_like(spark: SparkSession, sf: str) -> DataFrame:
    wide = fx.wide_station(spark, sf)
    return wide.select("ts", *qs(cols_like(wide, "取水量")))


@query("first_lost", VALID_SQL + " SELECT sid, ts FROM (SELECT sid, ts FROM readings EXCEPT SELECT sid, ts FROM valid) ORDER BY sid, ts LIMIT 5")
def first_lost(spark: SparkSession, sf: str) -> DataFrame:
    return filters.first_lost(fx.readings(spark, sf), valid_rows(spark, sf), ["sid", "ts"])


@query(
    "level_from_rate",
    f"WITH {fx.LEVELS} SELECT r.sid, r.ts, round(r.lv + r.lv * ((a60.lv - r.lv) / r.lv), 9) AS level_60 FROM lvl r {shifted('lvl', 'lv', [60])}",
)
def level_from_rate(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.horizon_targets(fx.levels(spark, sf), KEY, "ts", "lv", [60])
    return rows.select("sid", "ts", F.round(level_after(F.col("lv"), F.col("rate_60")), 9).alias("level_60"))


# -- split, scaling, classes ---------------------------------------------------------


@query(
    "chrono_split",
    """WITH n AS (SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS pos, count(*) OVER () AS n FROM orders),
    c AS (SELECT *, n - ceil(n * 0.25::DOUBLE) AS train, ceil(n * 0.25::DOUBLE) - ceil(ceil(n * 0.25::DOUBLE) * 0.5::DOUBLE) AS val FROM n)
    SELECT o_orderkey, o_orderdate, CASE WHEN pos <= train THEN 'train' WHEN pos <= train + val THEN 'val' ELSE 'test' END AS split FROM c""",
)
def split_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return chrono_split(orders, "o_orderdate", ["o_orderkey"])


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def scaled_input(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", *NUMBERS)
    return rows.withColumns(
        {"same": F.lit(2.5), "gappy": F.when(F.col("l_linenumber") == 1, F.lit(float("nan"))).otherwise(F.col("l_quantity"))}
    )


SCALED = """x AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, 2.5::DOUBLE AS same,
  CASE WHEN l_linenumber <> 1 THEN l_quantity END AS gappy FROM lineitem)"""
MINMAX_SQL = f"WITH {SCALED}, ends AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, min({c}) AS lo, max({c}) AS hi FROM x" for c in [*NUMBERS, "same", "gappy"]
) + '), scaler AS (SELECT feature, lo AS "min", CASE WHEN hi = lo THEN lo + 1e-6::DOUBLE ELSE hi END AS "max" FROM ends)'


@query("minmax_fit", MINMAX_SQL + ' SELECT feature, "min", "max" FROM scaler')
def minmax_fit(spark: SparkSession, sf: str) -> DataFrame:
    return scaling.fit_minmax(scaled_input(spark, sf), [*NUMBERS, "same", "gappy"])


@query(
    "minmax_apply",
    MINMAX_SQL
    + " SELECT l_orderkey, l_partkey, l_linenumber, "
    + ", ".join(
        f"({c} - (SELECT \"min\" FROM scaler WHERE feature = '{c}')) / (SELECT \"max\" - \"min\" FROM scaler WHERE feature = '{c}') AS {c}"
        for c in NUMBERS
    )
    + ", round(l_extendedprice, 4) AS back, 0.0::DOUBLE AS same FROM x",
)
def minmax_apply(spark: SparkSession, sf: str) -> DataFrame:
    rows = scaled_input(spark, sf)
    cols = [*NUMBERS, "same"]
    scaler = scaling.load_scaler(scaling.fit_minmax(rows, cols))
    unit = scaling.normalise(rows.drop("gappy"), scaler, cols)
    back = scaling.denormalised("l_extendedprice", scaler, "l_extendedprice")
    return unit.withColumn("back", F.round(back, 4))


HOUR_CHANGE = f"""WITH {fx.LEVELS}, c AS (
  SELECT r.sid, r.ts, a60.lv - r.lv AS x FROM lvl r {shifted('lvl', 'lv', [60])}), k AS (
  SELECT sid, ts, CASE WHEN x IS NULL THEN NULL WHEN abs(x) <= 0.005::DOUBLE THEN 0 WHEN abs(x) <= 0.015::DOUBLE THEN sign(x)::INTEGER
    ELSE (2 * sign(x))::INTEGER END AS change_class FROM c)"""


def hour_classes(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.horizon_targets(fx.levels(spark, sf), KEY, "ts", "lv", [60])
    return rows.select("sid", "ts", change_class(F.col("change_60")).alias("change_class"))


@query("change_class", HOUR_CHANGE + " SELECT sid, ts, change_class FROM k")
def classes(spark: SparkSession, sf: str) -> DataFrame:
    return hour_classes(spark, sf)


@query(
    "class_replicate",
    HOUR_CHANGE
    + """ SELECT k.sid, k.ts, k.change_class FROM k,
    LATERAL unnest(generate_series(1, CASE abs(k.change_class) WHEN 1 THEN 4 WHEN 2 THEN 11 ELSE 1 END)) AS u(i)""",
)
def class_replicate(spark: SparkSession, sf: str) -> DataFrame:
    return scaling.replicate_by_class(hour_classes(spark, sf), "change_class")


# -- evaluation and report with a persistence forecast -----------------------------------


def persistence(spark: SparkSession, sf: str) -> DataFrame:
    """A forecast of no change, in the shape of a model's forecast."""
    rows = features.horizon_targets(fx.levels(spark, sf), KEY, "ts", "lv", FORECAST_HORIZONS)
    per_horizon = [
        e
        for h in FORECAST_HORIZONS
        for e in (
            F.lit(0.0).alias(f"rate_{h}_pred"),
            F.col(f"rate_{h}").alias(f"rate_{h}_actual"),
            F.col("lv").alias(f"level_{h}"),
            change_class(F.col(f"change_{h}")).alias(f"class_{h}"),
        )
    ]
    return rows.select("sid", "ts", F.col("lv").alias("level"), *per_horizon)


def _class_sql(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN abs({x}) <= 0.005::DOUBLE THEN 0 WHEN abs({x}) <= 0.015::DOUBLE THEN sign({x})::INTEGER ELSE (2 * sign({x}))::INTEGER END"


ERROR_SQL = (
    f"WITH {fx.LEVELS}, hs AS (SELECT unnest([10, 20, 30, 40, 50, 60])::INTEGER AS horizon), x AS ("
    " SELECT r.sid, hs.horizon, (a.lv - r.lv) / r.lv AS rate, a.lv - r.lv AS change FROM lvl r CROSS JOIN hs"
    " JOIN lvl a ON a.sid = r.sid AND a.ts = r.ts + to_minutes(hs.horizon)),"
    " w AS (SELECT horizon, max(rate) - min(rate) AS width FROM x GROUP BY horizon),"
    f" c AS (SELECT sid, horizon, {_class_sql('change')} AS change_class, avg(abs(rate)) AS mae, count(*) AS n FROM x GROUP BY 1, 2, 3),"
    " spine AS (SELECT s.sid, hs.horizon, k.change_class FROM (SELECT DISTINCT sid FROM lvl) s CROSS JOIN hs"
    " CROSS JOIN (SELECT unnest([-2, -1, 0, 1, 2])::INTEGER AS change_class) k)"
    " SELECT p.sid, p.horizon, p.change_class, coalesce(c.n, 0)::BIGINT AS n, round(c.mae, 9) AS mae,"
    " round(259 * w.width * c.mae, 6) AS scaled_mae"
    " FROM spine p JOIN w USING (horizon) LEFT JOIN c USING (sid, horizon, change_class)"
)


def error_by_class(spark: SparkSession, sf: str) -> DataFrame:
    # Read twice: for the ranges and for the errors.
    rows = materialise(persistence(spark, sf), "forecasts")
    rates = {h: f"rate_{h}_actual" for h in FORECAST_HORIZONS}
    scaler = scaling.load_scaler(scaling.fit_minmax(rows, list(rates.values())))
    ranges = {h: scaler[c][1] - scaler[c][0] for h, c in rates.items()}
    out = evaluate.mae_by_class(rows, FORECAST_HORIZONS, ranges, KEY)
    return out.withColumns({"mae": F.round("mae", 9), "scaled_mae": F.round("scaled_mae", 6)})


@query("mae_by_class", ERROR_SQL)
def mae_by_class(spark: SparkSession, sf: str) -> DataFrame:
    return error_by_class(spark, sf)


@query(
    "forecast_lookup",
    f"""WITH {fx.LEVELS}, hs AS (SELECT unnest([10, 20, 30, 40, 50, 60])::INTEGER AS horizon), b AS (
      SELECT l.sid, l.ts AS base_time, hs.horizon, l.ts + to_minutes(hs.horizon) AS target_time, l.lv FROM lvl l CROSS JOIN hs)
    SELECT b.sid, b.base_time, b.horizon, b.target_time, round_even(b.lv * 100, 0) / 100 AS predicted_level,
      round_even(a.lv * 100, 0) / 100 AS actual_level, 0.0::DOUBLE AS predicted_rate_pct,
      round_even((a.lv - b.lv) / b.lv * 100 * 100, 0) / 100 AS actual_rate_pct
    FROM b LEFT JOIN lvl a ON a.sid = b.sid AND a.ts = b.target_time""",
)
def forecast_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = materialise(persistence(spark, sf), "forecasts")
    bases = rows.select("sid", "ts")
    return evaluate.forecast_at(rows, bases, FORECAST_HORIZONS, KEY, "ts")


@query(
    "forecast_json",
    f"""WITH {fx.LEVELS} SELECT sid, ts, strftime(ts, '%Y-%m-%d %H:%M:%S') AS base_time,
      round_even(lv * 100, 0) / 100 AS level_now, round_even(lv * 100, 0) / 100 AS level_ahead FROM lvl""",
)
def forecast_json(spark: SparkSession, sf: str) -> DataFrame:
    message = evaluate.forecast_json(persistence(spark, sf), KEY, "ts")
    at, now, ahead = evaluate.SUMMARY_NAMES
    fields = F.from_json("message", f"`{at}` string, `{now}` double, `{ahead}` double")
    return message.select("sid", "ts", fields.alias("m")).select(
        "sid", "ts", F.col("m").getField(at).alias("base_time"), F.col("m").getField(now).alias("level_now"), F.col("m").getField(ahead).alias("level_ahead")
    )


# -- alignment --------------------------------------------------------------------------

SIDS = ["click", "error", "purchase", "signup", "view"]


@query(
    "outer_align",
    f"WITH {fx.READINGS} SELECT ts, " + ", ".join(f"max(CASE WHEN sid = '{s}' THEN v END) AS {s}" for s in SIDS) + " FROM readings GROUP BY ts",
)
def outer_align(spark: SparkSession, sf: str) -> DataFrame:
    r = fx.readings(spark, sf)
    return combine.align_outer([r.where(F.col("sid") == s).select("ts", F.col("v").alias(s)) for s in SIDS], ["ts"])


@query(
    "rain_enrich",
    f"WITH {fx.READINGS}, {fx.HOURLY} SELECT r.sid, r.ts, r.v, h.r FROM readings r LEFT JOIN hourly h ON h.sid = r.sid AND h.ts = r.ts",
)
def rain_enrich(spark: SparkSession, sf: str) -> DataFrame:
    return combine.enrich_left(fx.readings(spark, sf), fx.hourly(spark, sf), ["sid", "ts"])


@query(
    "semi_align",
    f"WITH {fx.READINGS}, {fx.HOURLY} SELECT r.sid, r.ts, r.v FROM readings r WHERE EXISTS (SELECT 1 FROM hourly h WHERE h.sid = r.sid AND h.ts = r.ts)",
)
def semi_align(spark: SparkSession, sf: str) -> DataFrame:
    return filters.semi_align(fx.readings(spark, sf), fx.hourly(spark, sf), ["sid", "ts"])


@query(
    "join_xy",
    f"WITH {fx.READINGS}, {fx.LEVELS.replace(fx.READINGS + ', ', '')} SELECT r.sid, r.ts, r.v, l.lv FROM readings r JOIN lvl l ON l.sid = r.sid AND l.ts = r.ts",
)
def join_xy(spark: SparkSession, sf: str) -> DataFrame:
    y = fx.levels(spark, sf).withColumn("v", F.lit(-1.0))
    return combine.join_xy(fx.readings(spark, sf), y, ["sid", "ts"])


@query("unique_key", "SELECT event_type, time_bucket(INTERVAL '10 minutes', ts) AS slot, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY 1, 2")
def unique_key(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.table(spark, sf, "events").select("event_type", fx.floor_minutes(F.col("ts"), 10).alias("slot"), "event_id", "value")
    return guards.unique_key(e, ["event_type", "slot"], ["event_id"])


# -- models -----------------------------------------------------------------------------


def forest_sql() -> str:
    """Isolation forests of the aligned columns, grown level by level, and the flags they give."""
    names = " UNION ALL ".join(f"SELECT 'c{i}' AS name, '{s}' AS sid" for i, s in enumerate(SIDS))
    digits = "('0x' || substr(md5({0}), {1}, {2}))::BIGINT"
    draw = digits.format(f"'{isolation.SEED}:' || name || ':' || tree || ':' || node", 1, 8) + " / 4294967296.0::DOUBLE"
    row = f"'{isolation.SEED}:' || strftime(ts, '%Y-%m-%d %H:%M:%S')"
    depth = f"CASE WHEN n <= 1 THEN 0.0 WHEN n = 2 THEN 1.0 ELSE 2 * (ln(n - 1) + {isolation.EULER_GAMMA}) - 2.0 * (n - 1) / n END"
    levels = (isolation.SAMPLE - 1).bit_length()
    grown = [
        f"""n{k} AS (SELECT name, tree, node, any_value(below) AS below, any_value(upto) AS upto, count(*) AS n, min(x) AS lo, max(x) AS hi FROM l{k} GROUP BY 1, 2, 3),
        s{k} AS (SELECT *, CASE WHEN {k} < {levels} AND n > 1 AND lo < hi THEN lo + {draw} * (hi - lo) END AS cut FROM n{k})"""
        + (
            f""", l{k + 1} AS (SELECT l.name, l.tree, 2 * l.node + (l.x > s.cut)::INTEGER AS node, CASE WHEN l.x > s.cut THEN s.cut ELSE l.below END AS below,
        CASE WHEN l.x > s.cut THEN l.upto ELSE s.cut END AS upto, l.x FROM l{k} l JOIN s{k} s USING (name, tree, node) WHERE s.cut IS NOT NULL)"""
            if k < levels
            else ""
        )
        for k in range(levels + 1)
    ]
    leaves = " UNION ALL ".join(f"SELECT name, tree, below, upto, {k} + {depth} AS depth FROM s{k} WHERE cut IS NULL" for k in range(levels + 1))
    flags = ", ".join(f"bool_or(sid = '{s}' AND outlier) AS {s}_outlier" for s in SIDS)
    values = ", ".join(f"max(CASE WHEN sid = '{s}' THEN raw END) AS {s}" for s in SIDS)
    filled = interpolation_sql(
        fx.READINGS + f", names AS ({names}), aligned AS (SELECT n.sid, t.ts, r.v FROM names n CROSS JOIN (SELECT DISTINCT ts FROM readings) t LEFT JOIN readings r ON r.sid = n.sid AND r.ts = t.ts)",
        "aligned",
        "row_number() OVER (PARTITION BY sid ORDER BY ts)",
    )
    return f"""WITH names AS ({names}), filled AS ({filled}),
    x AS (SELECT n.name, f.sid, f.ts, f.v AS x FROM filled f JOIN names n USING (sid)),
    sized AS (SELECT name, floor(least(1.0::DOUBLE, {isolation.SAMPLE}::DOUBLE / count(x)) * {isolation.HASH_RANGE}) AS most FROM x GROUP BY name),
    hashed AS (SELECT name, x, {digits.format(row, 1, 7)} AS h1, {digits.format(row, 8, 7)} AS h2 FROM x WHERE x IS NOT NULL),
    l0 AS (SELECT h.name, t.tree, 1::BIGINT AS node, '-inf'::DOUBLE AS below, 'inf'::DOUBLE AS upto, h.x FROM hashed h JOIN sized s USING (name),
      (SELECT unnest(generate_series(0, {isolation.TREES - 1})) AS tree) t WHERE (h.h1 + t.tree * (2 * h.h2 + 1)) % {isolation.HASH_RANGE} < s.most),
    {", ".join(grown)},
    leaves AS ({leaves}),
    steps AS (SELECT name, upto, lag(upto, 1, '-inf'::DOUBLE) OVER (PARTITION BY name ORDER BY upto) AS below FROM (SELECT DISTINCT name, upto FROM leaves)),
    paths AS (SELECT s.name, s.below, s.upto, round(sum(l.depth) / count(*), {isolation.PATH_DIGITS}) AS path FROM steps s
      JOIN leaves l ON l.name = s.name AND l.below < s.upto AND s.upto <= l.upto GROUP BY 1, 2, 3),
    scored AS (SELECT x.name, x.sid, x.ts, p.path FROM x JOIN paths p ON p.name = x.name AND p.below < x.x AND x.x <= p.upto),
    limits AS (SELECT name, quantile_cont(path, {isolation.CONTAMINATION}) AS most FROM scored GROUP BY name),
    flagged AS (SELECT s.sid, s.ts, s.path < l.most AS outlier FROM scored s JOIN limits l USING (name)),
    {fx.READINGS.replace("readings AS", "raws AS")}
    SELECT ts, {values}, {flags} FROM (SELECT f.sid, f.ts, f.outlier, r.v AS raw FROM flagged f LEFT JOIN raws r ON r.sid = f.sid AND r.ts = f.ts) GROUP BY ts"""


@query("isolation_flags", forest_sql())
def flag_outliers(spark: SparkSession, sf: str) -> DataFrame:
    wide = outer_align(spark, sf)
    return isolation.isolation_flags(wide, SIDS, "ts")


KINDS = ("rate", "change")


def _fitted(spark: SparkSession, sf: str):
    """All horizons and both targets of the station, each fitted until validation stagnates; (models, test rows).

    Fitted once for a session and folder of tables: the models and the features lie
    in the shared folder, and every query reads them from there.
    """
    root, path = _fit_and_save(spark.sparkContext.applicationId, sf)
    table = spark.read.parquet(path)
    return load_forecaster(spark, SPEC.station, [root], SPEC.horizons, KINDS), table.where(F.col("split") == "test")


@lru_cache(maxsize=8)
def _fit_and_save(application: str, sf: str) -> tuple[str, str]:
    spark = SparkSession.active()
    rows = chrono_split(materialise(fx.wide_station(spark, sf), "station"), "ts")
    path, root = fresh_path(spark, "features"), fresh_path(spark, "models")
    features.station_features(rows, SPEC, ["split"], "ts").write.parquet(path)
    table = spark.read.parquet(path)
    names = feature_columns(SPEC)
    train, val = (table.where(F.col("split") == s) for s in ("train", "val"))
    scaler = scaling.load_scaler(scaling.fit_minmax(train, [*names, *SPEC.target_columns()]))
    fitted = fit_forecasters(train, val, SPEC, names, scaler, BoostParams(), SPEC.horizons, KINDS, used=model_inputs(SPEC))
    save_forecaster(spark, fitted, root)
    return root, path


@query("gbt_fit")
def gbt_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Features that the fitted models use, with their share of the splits."""
    fitted, _ = _fitted(spark, sf)
    rows = []
    for (horizon, kind), model in sorted(fitted.models.items()):
        splits = model.splits(len(fitted.features))
        rows += [(horizon, kind, f, float(n) / max(1, int(splits.sum())), len(model.trees)) for f, n in zip(fitted.features, splits, strict=True)]
    return spark.createDataFrame(rows, "horizon int, kind string, feature string, importance double, trees int")


@query("batch_forecast")
def batch_forecast(spark: SparkSession, sf: str) -> DataFrame:
    fitted, test = _fitted(spark, sf)
    return forecast(test, fitted, SPEC, [], "ts")


@query(
    "model_roundtrip",
    station_sql(split=True) + " SELECT count(*) AS n_rows, 0.0::DOUBLE AS largest_difference FROM station WHERE split = 'test'",
)
def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Forecast before saving against forecast after loading."""
    fitted, test = _fitted(spark, sf)
    root = fresh_path(spark, "models")
    save_forecaster(spark, fitted, root)
    loaded = load_forecaster(spark, SPEC.station, [root + "-absent", root], SPEC.horizons, KINDS)
    before = forecast(test, fitted, SPEC, [], "ts").select("ts", *(F.col(f"rate_{h}_pred").alias(f"p{h}") for h in SPEC.horizons))
    after = forecast(test, loaded, SPEC, [], "ts").select("ts", *(F.col(f"rate_{h}_pred").alias(f"q{h}") for h in SPEC.horizons))
    off = F.array(*(F.abs(F.col(f"p{h}") - F.col(f"q{h}")) for h in SPEC.horizons))
    both = before.join(after, "ts", "full_outer").select(F.when(F.forall(off, lambda x: x.isNotNull()), F.array_max(off)).alias("off"))
    return both.agg(F.count("off").alias("n_rows"), F.max("off").alias("largest_difference"))


ZERO = ", ".join(f"0.0::DOUBLE AS off_{h}, NULL::DOUBLE AS rate_{h}_actual, NULL::INTEGER AS class_{h}" for h in SPEC.horizons)


@query(
    "live_forecast",
    station_sql(outcomes=False) + f""" SELECT ts, "{LEVEL}" AS level, {ZERO} FROM station WHERE ts > (SELECT max(ts) FROM station) - INTERVAL '60 minutes'""",
)
def live_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """Forecast of the newest hour, whose outcome nobody knows: only the readings it needs are turned into features."""
    fitted, _ = _fitted(spark, sf)
    rows = features.live_rows(fx.wide_station(spark, sf), SPEC, "ts")
    ahead = materialise(features.station_features(rows, SPEC, [], "ts", outcomes=False), "live")
    last = ahead.agg(F.max("ts")).first()[0]
    out = forecast(ahead.where(F.col("ts") > F.lit(last - timedelta(minutes=60)).cast("timestamp_ntz")), fitted, SPEC, [], "ts")
    off = [F.round(F.col(f"level_{h}") - level_after(F.col("level"), F.col(f"rate_{h}_pred")), 9).alias(f"off_{h}") for h in SPEC.horizons]
    return out.select("ts", "level", *off, *(c.format(h) for h in SPEC.horizons for c in ("rate_{}_actual", "class_{}")))
