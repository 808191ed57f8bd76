"""Gradient-boosted forecasters: fit, keep, load, apply.

The models of a horizon are boosted together (``boosting``): no round is ever fitted or
scored twice. An ensemble is a table of nodes; applying it needs no model class.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.columns import col, q, qs
from gaugeflow.functions.numbers import change_class, level_after
from gaugeflow.operators import boosting
from gaugeflow.operators.boosting import FEATURES, BoostParams, Target, Tree, boost
from gaugeflow.operators.scaling import Scaler, class_weight, denormalised, normalised
from gaugeflow.session import materialise
from gaugeflow.sources.spec import FORECAST_HORIZONS, StationSpec, change_name, rate_name
from gaugeflow.sources.tables import first_existing

# Fixed value: rounds without gain before fitting stops.
PATIENCE = 30

RUN = 10  # rounds before residuals are written

WEIGHT = "__weight"
LABEL = "__label"


# Tuned settings of each station.
STATION_PARAMS = {
    "A頭首工": BoostParams(rounds=838, step=0.02662681660026451, depth=9, leaf_rows=41, feature_share=0.6448917630775342),
    "B頭首工": BoostParams(rounds=581, step=0.039082987515792166, depth=6, leaf_rows=60, feature_share=0.7055101281937456),
    "C頭首工": BoostParams(rounds=878, step=0.01604524647433422, depth=10, leaf_rows=57, feature_share=0.5392368246127326),
    "D頭首工": BoostParams(rounds=779, step=0.0300142962906802, depth=10, leaf_rows=24, feature_share=0.5517225948674603),
}


def station_params(station: str) -> BoostParams:
    if station not in STATION_PARAMS:
        raise ValueError(f"no training settings for station {station!r}")
    return STATION_PARAMS[station]


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One vector column; feature columns are renamed first since the assembler
    does not take arbitrary names."""
    plain = {c: f"__f{i}" for i, c in enumerate(features)}
    named = df.selectExpr("*", *[f"CAST({q(c)} AS DOUBLE) AS {p}" for c, p in plain.items()])
    packed = VectorAssembler(inputCols=list(plain.values()), outputCol=FEATURES, handleInvalid="error").transform(named)
    return packed.drop(*plain.values())


@dataclass(frozen=True)
class Ensemble:
    """``base`` plus ``step`` times what the trees say; ``errors`` are those of the validation rows, round by round."""

    base: float
    step: float
    trees: tuple[Tree, ...]
    errors: tuple[float, ...] = field(default=(), compare=False)

    def predict(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.base)
        for tree in self.trees:
            out += self.step * tree.predict(rows)
        return out

    def splits(self, features: int) -> np.ndarray:
        """How many splits use each feature."""
        used = np.concatenate([np.zeros(0, np.int64), *(t.feature[t.feature >= 0] for t in self.trees)])
        return np.bincount(used, minlength=features)

    def rows(self) -> pd.DataFrame:
        """The ensemble as nodes; its own row has tree -1, the step in ``cut`` and the base in ``value``."""
        head = pd.DataFrame({"tree": [-1], "node": [0], "feature": [-1], "cut": [self.step], "left": [0], "right": [0], "value": [self.base]})
        parts = [
            pd.DataFrame({"tree": i, "node": range(len(t.feature)), "feature": t.feature, "cut": t.cut, "left": t.left, "right": t.right, "value": t.value})
            for i, t in enumerate(self.trees)
        ]
        return pd.concat([head, *parts], ignore_index=True)


NODES = "tree int, node int, feature int, cut double, left int, right int, value double"


def ensemble_of(nodes: pd.DataFrame) -> Ensemble:
    """Inverse of :meth:`Ensemble.rows`."""
    nodes = nodes.sort_values(["tree", "node"])
    head = nodes.iloc[0]
    parts = [tuple(p[c].to_numpy() for c in ("feature", "cut", "left", "right", "value")) for _, p in nodes.iloc[1:].groupby("tree")]
    return Ensemble(float(head["value"]), float(head["cut"]), tuple(Tree(*p) for p in parts))


def scored(spark: SparkSession, ensemble: Ensemble) -> Callable[[Column], Column]:
    """A function from a column of feature arrays to the column of predictions.

    What is sent to the executors is bounded by the settings: rounds times the nodes of a tree.
    """
    shared = spark.sparkContext.broadcast(ensemble)

    @F.arrow_udf("double")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in columns:
            matrix = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
            yield pa.array(shared.value.predict(matrix))

    return score


def best_round(errors: Sequence[float], patience: int = PATIENCE) -> int:
    """Number of rounds with the lowest error; see ``boosting.best_round``."""
    return boosting.best_round(errors, patience)


def _fit(train: DataFrame, val: DataFrame | None, targets: Sequence[Target], params: BoostParams, patience: int) -> list[Ensemble]:
    fitted = boost(train, val, targets, params, patience, RUN)
    kept = [best_round(m.errors, patience) if m.errors else len(m.trees) for m in fitted]
    return [Ensemble(m.base, params.step, tuple(m.trees[:n]), tuple(m.errors)) for m, n in zip(fitted, kept, strict=True)]


def fit_one(
    train: DataFrame, val: DataFrame | None, params: BoostParams, label: str, patience: int = PATIENCE, columns: Sequence[int] | None = None
) -> Ensemble:
    """Boost on assembled, weighted rows; the number of rounds is chosen by the
    weighted mean absolute error on the validation rows.

    It ends ``patience`` rounds after the best one. ``columns`` picks the features of
    the matrix that may be used.
    """
    return _fit(train, val, [Target(label, WEIGHT, columns)], params, patience)[0]


@dataclass(frozen=True)
class Forecaster:
    """Models of one station by (horizon, kind), kind being rate or change."""

    station: str
    features: tuple[str, ...]
    scaler: Mapping[str, tuple[float, float]]
    models: Mapping[tuple[int, str], Ensemble]


def _row_weight(change: str, replicate: bool) -> Column:
    return (class_weight(change_class(col(change))) if replicate else F.lit(1)).cast("double")


def _training_rows(df: DataFrame, change: str, target: str, replicate: bool) -> DataFrame:
    return df.select(FEATURES, col(target).alias(LABEL), _row_weight(change, replicate).alias(WEIGHT))


def fit_forecasters(
    train: DataFrame,
    val: DataFrame | None,
    spec: StationSpec,
    features: Sequence[str],
    scaler: Scaler,
    params: BoostParams | None = None,
    horizons: Sequence[int] = FORECAST_HORIZONS,
    kinds: Sequence[str] = ("rate", "change"),
    replicate_val: bool = True,
    patience: int = PATIENCE,
    parallel: int = 4,
    used: Mapping[tuple[int, str], Sequence[str]] | None = None,
) -> Forecaster:
    """One model per horizon and kind on normalised features and targets.

    All models share one assembled matrix, and those of a horizon, whose rows have the
    same weights, are boosted in the same jobs; ``used`` names the features of those
    that do not take all (``spec.model_inputs`` has them of a specification).

    Rows of larger changes carry the weight of the copies they stand for, which
    leaves the table at its size. ``parallel`` horizons are fitted at a time, since
    the jobs of a round are short and wait for each other.
    """
    params = params or station_params(spec.station)
    names = {"rate": rate_name, "change": change_name}
    label_cols = [names[k](spec.station, h) for h in horizons for k in ("rate", "change")]

    def prepare(df: DataFrame, replicate: bool) -> DataFrame:
        scaled = df.select(
            *[normalised(q(f), scaler, f) for f in features],
            *[normalised(q(c), scaler, c, "norm " + c) for c in label_cols],
            *[_row_weight(change_name(spec.station, h), replicate).alias(f"{WEIGHT}{h}") for h in horizons],
        )
        return assemble(scaled, features).drop(*features)

    # Written once: several jobs read these tables, and losing an executor costs no more than its task.
    ready = materialise(prepare(train, True), "training")
    ready_val = materialise(prepare(val, replicate_val), "validation") if val is not None else None

    place = {f: i for i, f in enumerate(features)}

    def fit(h: int) -> dict[tuple[int, str], Ensemble]:
        picked = {k: [place[f] for f in used[h, k] if f in place] if used and (h, k) in used else None for k in kinds}
        targets = [Target("norm " + names[k](spec.station, h), f"{WEIGHT}{h}", c) for k, c in picked.items()]
        return {(h, k): e for k, e in zip(kinds, _fit(ready, ready_val, targets, params, patience), strict=True)}

    with ThreadPoolExecutor(parallel) as pool:
        models = {task: e for made in pool.map(fit, horizons) for task, e in made.items()}
    ends = {c: tuple(scaler[c]) for c in [*features, *label_cols]}
    return Forecaster(spec.station, tuple(features), ends, models)


def _model_path(root: str, station: str, horizon: int, kind: str) -> str:
    return f"{root}/{station}/{horizon}min_{kind}"


def _scaler_path(root: str, station: str) -> str:
    return f"{root}/{station}/minmax"


def save_forecaster(spark: SparkSession, f: Forecaster, root: str) -> None:
    for (h, kind), model in f.models.items():
        spark.createDataFrame(model.rows(), NODES).coalesce(1).write.mode("overwrite").parquet(_model_path(root, f.station, h, kind))
    order = {c: i for i, c in enumerate(f.features)}
    rows = [(c, lo, hi, order.get(c)) for c, (lo, hi) in f.scaler.items()]
    table = spark.createDataFrame(rows, "feature string, min double, max double, position int")
    table.coalesce(1).write.mode("overwrite").parquet(_scaler_path(root, f.station))


def load_forecaster(
    spark: SparkSession, station: str, roots: Sequence[str], horizons: Sequence[int] = FORECAST_HORIZONS, kinds: Sequence[str] = ("rate",)
) -> Forecaster:
    """Load from the first of ``roots`` that has each part; absent parts are an error."""
    rows = spark.read.parquet(first_existing(spark, [_scaler_path(r, station) for r in roots])).collect()
    used = sorted((r for r in rows if r["position"] is not None), key=lambda r: r["position"])
    models = {
        (h, k): ensemble_of(spark.read.parquet(first_existing(spark, [_model_path(r, station, h, k) for r in roots])).toPandas())
        for h in horizons
        for k in kinds
    }
    return Forecaster(station, tuple(r["feature"] for r in used), {r["feature"]: (r["min"], r["max"]) for r in rows}, models)


def forecast(df: DataFrame, f: Forecaster, spec: StationSpec, keys: Sequence[str] = (), ts: str = "datetime") -> DataFrame:
    """Rates, levels and classes per horizon for every row.

    Columns: keys, ts, ``level`` and per horizon ``rate_{h}_pred``,
    ``rate_{h}_actual``, ``level_{h}``, ``class_{h}``. Missing features count as
    zero, as in training tables read back without a check. Where the outcome is
    not known, for a row or for the whole table, the actual rate and the class
    are null.
    """
    horizons = sorted(h for h, kind in f.models if kind == "rate")
    packed = [f"__n{i}" for i in range(len(f.features))]
    zeroed = df.select(
        *qs([*keys, ts]),
        col(spec.level).alias("level"),
        *[
            (col(n(spec.station, h)) if n(spec.station, h) in df.columns else F.lit(None).cast("double")).alias(a)
            for h in horizons
            for n, a in ((rate_name, f"rate_{h}_actual"), (change_name, f"change_{h}"))
        ],
        *[
            normalised(f"coalesce(nullif(CAST({q(c)} AS DOUBLE), double('NaN')), 0D)", f.scaler, c, n)
            for c, n in zip(f.features, packed, strict=True)
        ],
    )
    rows = zeroed.withColumn("__x", F.array(*packed)).drop(*packed)
    rows = rows.withColumns({f"__p{h}": scored(df.sparkSession, f.models[h, "rate"])(F.col("__x")) for h in horizons})
    out = []
    for h in horizons:
        rate = denormalised(f"__p{h}", f.scaler, rate_name(spec.station, h), f"rate_{h}_pred")
        out += [
            rate,
            F.col(f"rate_{h}_actual"),
            level_after(F.col("level"), rate).alias(f"level_{h}"),
            change_class(F.col(f"change_{h}")).alias(f"class_{h}"),
        ]
    return rows.select(*qs([*keys, ts]), "level", *out)
