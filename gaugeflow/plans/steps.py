"""From archives of logger files to forecasts, one function per step.

Steps hand over Parquet tables below one root folder, so each can be run again
alone. ``run_all`` chains them.

    merged (by family)  columns  filtered/{family}  cleaned/{family}
    stats/{family}/profile  stats/{family}/trend  stats/{family}/histogram
    levels/raw  levels/repaired  inputs/with_rainfall  inputs/without_rainfall
    features/{station}  models/{station}  forecasts/{station}  errors/{station}  matrix/{station}
    rejects/files  rejects/lines  rejects/times/{family}  rejects/repeats/{family}  stats/encodings
    counts/{step}/{name}

Every step leaves a row of counts, read by ``counts``: the rows that it was given and
that it wrote (both from the footers of the tables) and the anomalies that it found.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.columns import col, cols_like, drop_like
from gaugeflow.functions.numbers import coerce_numeric
from gaugeflow.functions.times import compose_ts, parse_date_time
from gaugeflow.operators import chunks, combine, evaluate, filters, guards, profile, scaling
from gaugeflow.operators.features import check_xy, station_features, split_xy
from gaugeflow.operators.forecast import BoostParams, fit_forecasters, forecast, load_forecaster, save_forecaster
from gaugeflow.operators.isolation import isolation_flags, repair
from gaugeflow.operators.split import chrono_split
from gaugeflow.session import materialise
from gaugeflow.sources import legacy_csv
from gaugeflow.sources.spec import FORECAST_HORIZONS, StationSpec, feature_columns, model_inputs, rate_name
from gaugeflow.sources.tables import read_table, write_table

# What the names of level files, level columns and rain files hold.
LEVEL_FILES, LEVEL_COLUMNS, RAIN_FILES = "頭首工", "水位", "雨量"
TS = "datetime"
T = TypeVar("T")
SOURCE = legacy_csv.SOURCE


COUNTS = "step string, name string, rows_in bigint, rows_out bigint, anomalies bigint"


def _count(spark: SparkSession, root: str, step: str, name: str, rows_in: int, rows_out: int, anomalies: int = 0) -> None:
    row = spark.createDataFrame([(step, name, rows_in, rows_out, anomalies)], COUNTS)
    write_table(row.coalesce(1), f"{root}/counts/{step}/{name}")


def counts(spark: SparkSession, root: str) -> DataFrame:
    """(step, name, rows_in, rows_out, anomalies) of all steps that have run."""
    return spark.read.schema(COUNTS).option("recursiveFileLookup", "true").parquet(f"{root}/counts")


def ingest(spark: SparkSession, archives: str, root: str) -> list[str]:
    """Unite the yearly files of each family; returns the family names.

    One scan of the archives and one write for any number of families: rows lie in
    ``merged`` by family, their cells in the order of ``columns``.

    ``rejects/files`` lists archives and members that cannot be read, with the
    reason, ``rejects/lines`` the lines with too many fields, and
    ``stats/encodings`` the encoding of every member.
    """
    scan = legacy_csv.scan_archives(spark, archives)
    columns = materialise(legacy_csv.family_columns(scan), "columns")
    write_table(legacy_csv.zip_families(scan, columns), f"{root}/merged", ["family"])
    write_table(columns, f"{root}/columns")
    write_table(scan.catalogue.where(F.col("encoding").isNull()).select("archive", "entry", "member", "size", "error"), f"{root}/rejects/files")
    write_table(scan.report, f"{root}/stats/encodings")
    write_table(legacy_csv.zip_rejects(scan), f"{root}/rejects/lines")
    lost = read_table(spark, f"{root}/rejects/lines").count()
    _count(spark, root, "ingest", "all", legacy_csv.zip_lines(scan).count(), read_table(spark, f"{root}/merged").count(), lost)
    return sorted(r["family"] for r in columns.select("family").collect())


def merged(spark: SparkSession, root: str, family: str) -> DataFrame:
    """The united files of one family, with a column for each of its names."""
    names = read_table(spark, f"{root}/columns").where(F.col("family") == family).first()["columns"]
    return legacy_csv.family_table(read_table(spark, f"{root}/merged").where(F.col("family") == family), names)


def _side_by_side(job: Callable[[str], T], families: Sequence[str]) -> list[T]:
    """Submit one Spark job per family, a few at a time."""
    with ThreadPoolExecutor(8) as pool:
        return list(pool.map(job, families))


def filter_seasons(spark: SparkSession, root: str, family: str, start_year: int = 2018, months: tuple[int, int] = (4, 9)) -> bool:
    """Compose the timestamps and keep the seasons. False, with nothing written,
    for a table without date and time columns. Rows without a valid time go to
    ``rejects/times``."""
    rows = merged(spark, root, family)
    if not {"日付", "時刻"} <= set(rows.columns):
        return False
    write_table(filters.season_filter(compose_ts(rows, ts=TS), TS, start_year, months), f"{root}/filtered/{family}")
    write_table(rows.where(parse_date_time(col("日付"), col("時刻")).isNull()), f"{root}/rejects/times/{family}")
    kept, lost = (read_table(spark, f"{root}/{part}/{family}").count() for part in ("filtered", "rejects/times"))
    _count(spark, root, "filter_seasons", family, rows.count(), kept, lost)
    return True


def clean(spark: SparkSession, root: str, family: str) -> None:
    """Profile the text, turn it into numbers on the grid, split hourly rain,
    and summarise the numbers by year.

    Repeated timestamps are folded to one row (the first source file that has a
    value wins); ``rejects/repeats`` lists them.
    """
    rows = read_table(spark, f"{root}/filtered/{family}")
    values = [c for c in rows.columns if c not in (TS, SOURCE)]
    cells = rows.drop(SOURCE).withColumn("family", F.lit(family))
    write_table(profile.quality_profile(cells, "family"), f"{root}/stats/{family}/profile")
    write_table(guards.repeats(rows, [TS]), f"{root}/rejects/repeats/{family}")
    numbers = guards.unique_key(coerce_numeric(rows, values), [TS], [SOURCE]).drop(SOURCE)
    if RAIN_FILES in family:
        numbers = chunks.upsample_split(numbers, [], TS)
    write_table(filters.on_grid(numbers, TS), f"{root}/cleaned/{family}")
    cleaned = read_table(spark, f"{root}/cleaned/{family}")
    _count(spark, root, "clean", family, rows.count(), cleaned.count(), read_table(spark, f"{root}/rejects/repeats/{family}").count())
    write_table(profile.yearly_trend(cleaned, TS, values), f"{root}/stats/{family}/trend")
    write_table(profile.yearly_histogram(cleaned, TS, values), f"{root}/stats/{family}/histogram")


def repair_levels(spark: SparkSession, root: str, families: Sequence[str], contamination: float = 0.03) -> None:
    """Align the level tables of all stations and repair the outliers."""
    tables = [
        drop_like(filters.drop_null_ts(read_table(spark, f"{root}/cleaned/{f}"), TS), SOURCE) for f in families if LEVEL_FILES in f
    ]
    write_table(combine.align_outer(tables, [TS]), f"{root}/levels/raw")
    raw = read_table(spark, f"{root}/levels/raw")
    levels = cols_like(raw, LEVEL_COLUMNS)
    flagged = materialise(isolation_flags(raw, levels, TS, contamination), "flagged")
    write_table(repair(flagged, levels, [], TS), f"{root}/levels/repaired")
    marks = [F.count_if(col(f"{c}_outlier")) for c in levels]
    found = sum(flagged.agg(*[m.alias(f"n{i}") for i, m in enumerate(marks)]).first()) if marks else 0
    _count(spark, root, "repair_levels", "all", raw.count(), read_table(spark, f"{root}/levels/repaired").count(), found)


def prepare_inputs(spark: SparkSession, root: str, families: Sequence[str]) -> None:
    """Add the rain, fill the gaps, split by time."""
    # Read several times each by the split.
    levels = materialise(chunks.ffill_bfill(read_table(spark, f"{root}/levels/repaired"), [], TS), "levels")
    rains = [chunks.ffill_bfill(read_table(spark, f"{root}/cleaned/{f}"), [], TS) for f in families if RAIN_FILES in f]
    write_table(chrono_split(levels, TS), f"{root}/inputs/without_rainfall", ["split"])
    _count(spark, root, "prepare_inputs", "without_rainfall", levels.count(), read_table(spark, f"{root}/inputs/without_rainfall").count())
    if rains:
        rain = guards.dedup(combine.union_frames(rains))
        both = materialise(chunks.ffill_bfill(combine.enrich_left(levels, rain, [TS]), [], TS), "inputs")
        write_table(chrono_split(both, TS), f"{root}/inputs/with_rainfall", ["split"])
        _count(spark, root, "prepare_inputs", "with_rainfall", levels.count(), read_table(spark, f"{root}/inputs/with_rainfall").count())


def build_features(spark: SparkSession, root: str, spec: StationSpec, with_rainfall: bool = True) -> None:
    """Training table of one station; no value crosses the border of a split."""
    inputs = read_table(spark, f"{root}/inputs/{'with' if with_rainfall else 'without'}_rainfall")
    spec = spec if with_rainfall else spec.without_rain()
    write_table(station_features(inputs, spec, ["split"], TS), f"{root}/features/{spec.station}", ["split"])
    _count(spark, root, "build_features", spec.station, inputs.count(), read_table(spark, f"{root}/features/{spec.station}").count())


def check_features(spark: SparkSession, root: str, spec: StationSpec) -> None:
    x, y = split_xy(read_table(spark, f"{root}/features/{spec.station}"), spec, ["split"], TS)
    check_xy(x, y, ["split", TS])


def train(
    spark: SparkSession,
    root: str,
    spec: StationSpec,
    params: BoostParams | None = None,
    horizons: Sequence[int] = FORECAST_HORIZONS,
    kinds: Sequence[str] = ("rate", "change"),
) -> None:
    """Fit the scaler on the training rows, then the models, each on the inputs that the specification names."""
    table = read_table(spark, f"{root}/features/{spec.station}")
    names = [c for c in feature_columns(spec) if c in table.columns]
    rows, checks = (table.where(F.col("split") == s) for s in ("train", "val"))
    scaler = scaling.load_scaler(scaling.fit_minmax(rows, [*names, *[c for c in spec.target_columns() if c in table.columns]]))
    fitted = fit_forecasters(rows, checks, spec, names, scaler, params, horizons, kinds, used=model_inputs(spec))
    save_forecaster(spark, fitted, f"{root}/models")
    _count(spark, root, "train", spec.station, table.count(), rows.count() + checks.count())


def predict(
    spark: SparkSession, root: str, spec: StationSpec, horizons: Sequence[int] = FORECAST_HORIZONS, fallback: Sequence[str] = ()
) -> None:
    """Forecast the test rows and tabulate the errors by class of change."""
    fitted = load_forecaster(spark, spec.station, [f"{root}/models", *fallback], horizons)
    test = read_table(spark, f"{root}/features/{spec.station}").where(F.col("split") == "test")
    write_table(forecast(test, fitted, spec, [], TS), f"{root}/forecasts/{spec.station}")
    ranges = {h: fitted.scaler[rate_name(spec.station, h)][1] - fitted.scaler[rate_name(spec.station, h)][0] for h in horizons}
    done = read_table(spark, f"{root}/forecasts/{spec.station}")
    _count(spark, root, "predict", spec.station, test.count(), done.count())
    errors = materialise(evaluate.mae_by_class(done, horizons, ranges), "errors")
    write_table(errors, f"{root}/errors/{spec.station}")
    write_table(evaluate.mae_matrix(errors), f"{root}/matrix/{spec.station}")


def report(spark: SparkSession, root: str, station: str, bases: DataFrame, horizons: Sequence[int] = FORECAST_HORIZONS) -> DataFrame:
    """Forecast and outcome for every base time in ``bases`` (one time column)."""
    done = read_table(spark, f"{root}/forecasts/{station}")
    return evaluate.report_table(evaluate.forecast_at(done, bases.toDF(TS), horizons, [], TS))


def run_all(
    spark: SparkSession,
    archives: str,
    root: str,
    specs: Mapping[str, StationSpec],
    params: BoostParams | None = None,
    horizons: Sequence[int] = FORECAST_HORIZONS,
    kinds: Sequence[str] = ("rate", "change"),
    with_rainfall: bool = True,
) -> list[str]:
    families = ingest(spark, archives, root)

    def tidy(family: str) -> bool:
        usable = filter_seasons(spark, root, family)
        if usable:
            clean(spark, root, family)
        return usable

    usable = _side_by_side(tidy, families)
    families = [f for f, ok in zip(families, usable, strict=True) if ok]
    repair_levels(spark, root, families)
    prepare_inputs(spark, root, families)
    for spec in specs.values():
        build_features(spark, root, spec, with_rainfall)
        used = spec if with_rainfall else spec.without_rain()
        train(spark, root, used, params, horizons, kinds)
        predict(spark, root, used, horizons)
    return families
