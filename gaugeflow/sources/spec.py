"""What is forecast where: the feature specification of each station."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

LEVEL = "河川水位"
RATE = "変動率"
CHANGE = "変動"

# Calendar features, rain gauges and, per forecast station, the
# columns that predict it.
BASE_FEATURES = ("Hour", "Weekday", "Month")

RAIN_FEATURES = (
    "第１段揚水機場 累計雨量",
    "管網系１０号分水工 累計雨量",
    "第２段揚水機場 累計雨量",
    "第３段揚水機場 累計雨量",
    "第４段揚水機場 累計雨量",
    "山本新田支線揚水機場 累計雨量",
    "蔵王ダム 累計雨量",
)

STATION_FEATURES = {
    "A頭首工": (
        "Dダム 全放流量",
        "E頭首工 右岸１取水量",
        "E頭首工 右岸２取水量",
        "A頭首工 河川水位",
        "A頭首工 右岸取水量",
        "A頭首工 越流流量",
        "A頭首工 魚道流量",
        "A頭首工 取水量",
        "E頭首工 取水量",
    ),
    "B頭首工": (
        "Dダム 全放流量",
        "E頭首工 河川水位",
        "E頭首工 右岸１取水量",
        "E頭首工 右岸２取水量",
        "A頭首工 河川水位",
        "A頭首工 右岸取水量",
        "F頭首工 河川水位",
        "F頭首工 右岸取水量",
        "B頭首工 河川水位",
        "B頭首工 左岸取水量",
    ),
    "C頭首工": (
        "G頭首工 河川水位",
        "G頭首工 左岸取水量",
        "H頭首工 河川水位",
        "H頭首工 左岸取水量",
        "C頭首工 右岸取水量",
        "C頭首工 河川水位",
        "C頭首工 左岸取水量",
        "C頭首工 取水量",
        "H頭首工 取水量",
    ),
    "D頭首工": (
        "Dダム 全放流量",
        "E頭首工 河川水位",
        "E頭首工 右岸１取水量",
        "E頭首工 右岸２取水量",
        "A頭首工 河川水位",
        "A頭首工 右岸取水量",
        "F頭首工 河川水位",
        "F頭首工 右岸取水量",
        "C頭首工 河川水位",
        "C頭首工 左岸取水量",
        "G頭首工 河川水位",
        "G頭首工 左岸取水量",
        "H頭首工 河川水位",
        "H頭首工 左岸取水量",
        "H頭首工 右岸取水量",
        "C頭首工 右岸取水量",
        "D頭首工 河川水位",
        "D頭首工 左岸取水量",
        "A頭首工 越流流量",
        "A頭首工 魚道流量",
        "A頭首工 取水量",
        "E頭首工 取水量",
        "C頭首工 取水量",
        "H頭首工 取水量",
    ),
}

# Minutes of the feature lags and of the forecast horizons, and
# the number and spacing of the lagged targets of each horizon.
LAGS = (10, 20, 30, 40, 50, 60)
HORIZONS = (10, 20, 30, 40, 50, 60, 120)
FORECAST_HORIZONS = (10, 20, 30, 40, 50, 60)
TARGET_LAGS, TARGET_LAG_STEP = 6, 10


def lag_window(horizon: int) -> tuple[int, ...]:
    """Lags of a horizon's own target: they start at the horizon, so the target
    at ``t - lag`` is already known at ``t``."""
    return tuple(horizon + TARGET_LAG_STEP * i for i in range(TARGET_LAGS))


def lag_name(feature: str, lag: int) -> str:
    return f"{feature}_{lag}lag"


def rate_name(station: str, horizon: int) -> str:
    return f"{horizon}分後{RATE}_{station}_{LEVEL}"


def change_name(station: str, horizon: int) -> str:
    return f"{horizon}分後{CHANGE}_{station}_{LEVEL}"


@dataclass(frozen=True)
class ModelSpec:
    """Which parts of the station's features one model uses, and its target."""

    horizon: int = 60
    target: str = RATE
    base: bool = True
    rain: bool = True
    specific: bool = True
    lags: tuple[int, ...] = LAGS


@dataclass(frozen=True)
class StationSpec:
    station: str
    base: tuple[str, ...] = BASE_FEATURES
    rain: tuple[str, ...] = RAIN_FEATURES
    specific: tuple[str, ...] = ()
    lags: tuple[int, ...] = LAGS
    horizons: tuple[int, ...] = HORIZONS
    lag_windows: dict[int, tuple[int, ...]] = field(default_factory=lambda: {h: lag_window(h) for h in HORIZONS})
    models: dict[str, ModelSpec] = field(default_factory=lambda: {f"{h}min_rate": ModelSpec(h) for h in HORIZONS})

    @property
    def level(self) -> str:
        return f"{self.station} {LEVEL}"

    @property
    def lagged(self) -> tuple[str, ...]:
        """Raw columns that get lag features, each once."""
        return tuple(dict.fromkeys([*self.rain, *self.specific]))

    def without_rain(self) -> StationSpec:
        return StationSpec(
            self.station, self.base, (), self.specific, self.lags, self.horizons, self.lag_windows, self.models
        )

    def lag_columns(self) -> list[str]:
        return [lag_name(f, lag) for f in self.lagged for lag in self.lags]

    def target_columns(self) -> list[str]:
        return [rate_name(self.station, h) for h in self.horizons] + [change_name(self.station, h) for h in self.horizons]

    def lagged_target_columns(self) -> tuple[list[str], list[str]]:
        pairs = [(h, lag) for h in self.horizons for lag in self.lag_windows.get(h, ())]
        return (
            [lag_name(rate_name(self.station, h), lag) for h, lag in pairs],
            [lag_name(change_name(self.station, h), lag) for h, lag in pairs],
        )


def feature_columns(spec: StationSpec) -> list[str]:
    """All feature names of a station, in order, each once."""
    rates, changes = spec.lagged_target_columns()
    return list(dict.fromkeys([*spec.base, *spec.lagged, *spec.lag_columns(), *rates, *changes]))


def _model(spec: StationSpec, model: str) -> ModelSpec:
    if model not in spec.models:
        raise ValueError(f"no model {model!r} for station {spec.station!r}")
    return spec.models[model]


def model_columns(spec: StationSpec, model: str) -> list[str]:
    """Feature names of one model, sorted: the parts its switches ask for, the lags
    it names, and the lagged targets of every horizon that has a window."""
    m = _model(spec, model)
    raw = [c for use, part in ((m.base, spec.base), (m.rain, spec.rain), (m.specific, spec.specific)) if use for c in part]
    lagged = [lag_name(c, lag) for c in spec.lagged for lag in m.lags]
    used = {h: spec.lag_windows[h] for h in {*spec.horizons, m.horizon} if h in spec.lag_windows}
    targets = [lag_name(name(spec.station, h), lag) for h, window in used.items() for lag in window for name in (rate_name, change_name)]
    return sorted({*raw, *lagged, *targets})


def target_column(spec: StationSpec, model: str) -> str:
    m = _model(spec, model)
    return rate_name(spec.station, m.horizon) if m.target == RATE else change_name(spec.station, m.horizon)


def model_inputs(spec: StationSpec) -> dict[tuple[int, str], list[str]]:
    """Inputs of the specified models by (horizon, kind)."""
    return {(m.horizon, "rate" if m.target == RATE else "change"): model_columns(spec, name) for name, m in spec.models.items()}


def station(specs: dict[str, StationSpec], name: str) -> StationSpec:
    if name not in specs:
        raise ValueError(f"station {name!r} is not in the specification")
    return specs[name]


def default_specs() -> dict[str, StationSpec]:
    return {name: StationSpec(name, specific=features) for name, features in STATION_FEATURES.items()}


def to_json(specs: dict[str, StationSpec]) -> str:
    """The JSON layout users keep their specifications in. Its keys."""
    out = {}
    for name, s in specs.items():
        out[name] = {
            "base_features": list(s.base),
            "rainfall_features": list(s.rain),
            "specific_features": list(s.specific),
            "lag_times": list(s.lags),
            "prediction_horizons": list(s.horizons),
            "lag_windows": {str(h): list(w) for h, w in s.lag_windows.items()},
            "model_feature_combos": {
                m: {
                    "base_features": p.base,
                    "rainfall_features": p.rain,
                    "specific_features": p.specific,
                    "lag_times": list(p.lags),
                    "target": p.target,
                    "prediction_horizon": p.horizon,
                }
                for m, p in s.models.items()
            },
        }
    return json.dumps(out, ensure_ascii=False, indent=2)


def from_json(text: str) -> dict[str, StationSpec]:
    specs = {}
    for name, c in json.loads(text).items():
        models = {
            m: ModelSpec(
                horizon=int(p.get("prediction_horizon", 60)),
                target=p.get("target", RATE),
                base=bool(p.get("base_features", False)),
                rain=bool(p.get("rainfall_features", False)),
                specific=bool(p.get("specific_features", False)),
                lags=tuple(p.get("lag_times", ())),
            )
            for m, p in c.get("model_feature_combos", {}).items()
        }
        specs[name] = StationSpec(
            station=name,
            base=tuple(c["base_features"]),
            rain=tuple(dict.fromkeys(c["rainfall_features"])),
            specific=tuple(dict.fromkeys(c["specific_features"])),
            lags=tuple(c["lag_times"]),
            horizons=tuple(c["prediction_horizons"]),
            lag_windows={int(h): tuple(w) for h, w in c["lag_windows"].items()},
            models=models,
        )
    return specs


def merge(existing: dict[str, StationSpec], newer: dict[str, StationSpec]) -> dict[str, StationSpec]:
    """Station by station, the newer specification wins."""
    return {**existing, **newer}


def spec_table(spark: SparkSession, specs: dict[str, StationSpec]) -> DataFrame:
    """The specification as rows (station, position, feature)."""
    rows = [(s.station, i, f) for s in specs.values() for i, f in enumerate(feature_columns(s))]
    return spark.createDataFrame(rows, "station string, position int, feature string")
