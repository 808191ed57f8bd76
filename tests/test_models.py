"""Outlier flags, forecasters and the whole pipeline, by their properties."""

from __future__ import annotations

import zipfile

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from gaugeflow.operators import features, forecast, isolation, scaling
from gaugeflow.operators.split import chrono_split
from gaugeflow.plans import series_queries, steps
from gaugeflow.sources.spec import ModelSpec, StationSpec, change_name, feature_columns, rate_name
from gaugeflow.sources.tables import read_table


def timed(spark, pdf: pd.DataFrame, ts: str = "datetime"):
    df = spark.createDataFrame(pdf.assign(**{ts: pdf[ts].astype(str)})).withColumn(ts, F.col(ts).cast("timestamp_ntz"))
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c, t in df.dtypes if t == "double"})


# -- isolation ---------------------------------------------------------------------


def test_tree_partition_matches_its_cuts():
    values = np.random.default_rng(0).normal(size=256)
    cuts, depths = isolation._grow(values, "k", 3, 8)
    assert cuts == sorted(cuts) and len(depths) == len(cuts) + 1
    assert min(values) <= cuts[0] and cuts[-1] <= max(values)
    assert max(depths) <= 8 + isolation._mean_depth(256)
    assert (cuts, depths) == isolation._grow(values[::-1], "k", 3, 8) != isolation._grow(values, "k", 4, 8)


def test_mean_depth_is_the_known_constant():
    assert isolation._mean_depth(1) == 0 and isolation._mean_depth(2) == 1
    assert isolation._mean_depth(256) == pytest.approx(2 * (np.log(255) + 0.5772156649015329) - 2 * 255 / 256)


def test_forest_score_is_the_mean_over_the_trees(spark):
    """The single step function equals walking every tree, also after it was a table."""
    pool = np.random.default_rng(2).normal(size=1000).round(2)
    drawn = np.random.default_rng(3)
    samples = {i: drawn.choice(pool, 64, replace=False) for i in range(20)}
    forest = isolation.grow_forest(samples, "k", 64)
    trees = [isolation._grow(s, "k", i, 6) for i, s in samples.items()]
    again = isolation.forests_of(isolation.forest_table(spark, {"v": forest}).repartition(3))["v"]
    for x in (-3.0, -0.5, 0.0, 0.07, 2.5, 99.0):
        path = np.mean([d[sum(c < x for c in cuts)] for cuts, d in trees])
        assert forest.score(np.array([x]))[0] == pytest.approx(-(2 ** (-path / isolation._mean_depth(64))))
        assert again.score(np.array([x]))[0] == forest.score(np.array([x]))[0]


def test_infinite_readings_do_not_stop_the_forest(spark):
    times = pd.date_range("2021-04-01", periods=300, freq="10min")
    df = timed(spark, pd.DataFrame({"datetime": times, "v": [float("inf"), *np.linspace(1, 2, 298), float("-inf")]}))
    flagged = isolation.isolation_flags(df, ["v"])
    assert flagged.count() == 300
    repaired = isolation.repair(flagged, ["v"]).toPandas()
    assert repaired["v"].between(1, 2).all()


def test_trees_draw_about_their_sample(spark):
    """Every tree sees its own rows, and a small table is seen whole by all."""
    df = spark.range(20_000).select("id", F.rand(1).alias("v"))
    forest = isolation.fit_isolation(df, ["v"], ["id"], 10, 256)["v"]
    assert 1000 < len(forest.cuts) < 3000
    small = isolation.fit_isolation(df.limit(3), ["v"], ["id"], 10, 256)["v"]
    assert 0 < len(small.cuts) <= 20


def test_flags_are_few_extreme_and_repeatable(spark):
    rng = np.random.default_rng(4)
    n = 4000
    v = rng.normal(2, 0.1, n)
    spikes = rng.choice(n, 60, replace=False)
    v[spikes] = rng.choice([-9.0, 9.0, 14.0], 60) + rng.normal(0, 0.2, 60)
    v[100:110] = np.nan
    df = timed(spark, pd.DataFrame({"datetime": pd.date_range("2021-04-01", periods=n, freq="10min"), "水位": v, "const": 1.0}))
    flagged = isolation.isolation_flags(df, ["水位", "const", "absent"], chunk=86_400).toPandas().sort_values("datetime")
    again = isolation.isolation_flags(df.repartition(7), ["水位", "const"]).toPandas().sort_values("datetime")
    assert flagged["水位_outlier"].tolist() == again["水位_outlier"].tolist()
    assert not flagged["const_outlier"].any()
    share = flagged["水位_outlier"].mean()
    assert 0.02 < share <= 0.03
    kept_spikes = np.setdiff1d(spikes, np.arange(100, 110))
    assert flagged["水位_outlier"].to_numpy()[kept_spikes].all()
    assert flagged["水位"].isna().sum() == 10

    repaired = isolation.repair(spark.createDataFrame(flagged).withColumn("datetime", F.col("datetime").cast("timestamp_ntz")), ["水位", "const"])
    out = repaired.toPandas().sort_values("datetime")
    assert out["水位"].notna().all() and out["水位"].between(1, 3).all()
    untouched = ~flagged["水位_outlier"].to_numpy() & flagged["水位"].notna().to_numpy()
    np.testing.assert_array_equal(out["水位"].to_numpy()[untouched], v[untouched])
    assert set(out.columns) == {"datetime", "水位", "const"}


def test_registered_flags_cover_all_rows(spark, sf_dir):
    flagged = series_queries.flag_outliers(spark, sf_dir)
    wide = series_queries.outer_align(spark, sf_dir)
    assert flagged.count() == wide.count()


# -- forecasters ----------------------------------------------------------------------


SPEC = StationSpec(
    "S", rain=(), specific=("S 河川水位",), lags=(10, 20), horizons=(10, 20), lag_windows={10: (10, 20), 20: (20, 30)},
    models={"10min_rate": ModelSpec(10), "20min_change": ModelSpec(20, target="変動")},
)


@pytest.fixture(scope="module")
def waves(spark):
    """A level that a model can learn: two tides and a little noise."""
    t = np.arange(2600)
    level = 2 + 0.3 * np.sin(t / 9) + 0.1 * np.sin(t / 3) + np.random.default_rng(1).normal(0, 0.001, len(t))
    df = timed(spark, pd.DataFrame({"datetime": pd.date_range("2021-05-01", periods=len(t), freq="10min"), "S 河川水位": level}))
    table = features.station_features(chrono_split(df, "datetime"), SPEC, ["split"]).persist()
    yield table
    table.unpersist()


def test_features_stay_within_their_split(waves):
    """Each split loses its first 30 and last 20 minutes."""
    counts = {r["split"]: r["count"] for r in waves.groupBy("split").count().collect()}
    assert counts == {"train": 1950 - 5, "val": 325 - 5, "test": 325 - 5}


@pytest.fixture(scope="module")
def fitted(spark, waves):
    names = feature_columns(SPEC)
    train, val = (waves.where(F.col("split") == s) for s in ("train", "val"))
    scaler = scaling.load_scaler(scaling.fit_minmax(train, [*names, *SPEC.target_columns()]))
    params = forecast.BoostParams(rounds=12, step=0.3, depth=4, leaf_rows=2)
    return forecast.fit_forecasters(train, val, SPEC, names, scaler, params, (10, 20), ("rate",))


def test_forecast_beats_no_change_and_is_consistent(waves, fitted):
    out = forecast.forecast(waves.where(F.col("split") == "test"), fitted, SPEC).toPandas()
    assert len(out) == 320
    for h in (10, 20):
        error = (out[f"rate_{h}_pred"] - out[f"rate_{h}_actual"]).abs().mean()
        assert error < 0.5 * out[f"rate_{h}_actual"].abs().mean()
        np.testing.assert_allclose(out[f"level_{h}"], out["level"] * (1 + out[f"rate_{h}_pred"]))
        assert set(out[f"class_{h}"]) <= {-2, -1, 0, 1, 2}


def test_forecast_without_outcomes_keeps_the_newest_rows(spark, fitted):
    """A table without targets is forecast; what cannot be known is null."""
    level = 2 + 0.3 * np.sin(np.arange(200) / 9)
    times = pd.date_range("2021-08-01", periods=200, freq="10min")
    live = timed(spark, pd.DataFrame({"datetime": times, "S 河川水位": level}))
    ahead = features.station_features(live, SPEC, outcomes=False)
    assert ahead.count() == 200 - 3
    assert not set(SPEC.target_columns()) & set(ahead.columns)
    out = forecast.forecast(ahead, fitted, SPEC)
    newest, h = str(times[-1]), 10
    last = out.where(F.col("datetime") == F.lit(newest).cast("timestamp_ntz")).collect()
    assert len(last) == 1 and last[0][f"rate_{h}_pred"] is not None
    assert last[0][f"rate_{h}_actual"] is None and last[0][f"class_{h}"] is None
    assert last[0][f"level_{h}"] == pytest.approx(last[0]["level"] * (1 + last[0][f"rate_{h}_pred"]))


def test_saved_models_need_all_parts(spark, fitted, tmp_path):
    forecast.save_forecaster(spark, fitted, str(tmp_path / "models"))
    loaded = forecast.load_forecaster(spark, "S", [str(tmp_path / "none"), str(tmp_path / "models")], (10, 20))
    assert loaded.features == fitted.features and loaded.scaler == dict(fitted.scaler)
    with pytest.raises(FileNotFoundError):
        forecast.load_forecaster(spark, "S", [str(tmp_path / "models")], (60,))


def matrix_of(rows):
    pdf = rows.toPandas()
    return np.stack([v.toArray() for v in pdf[forecast.FEATURES]]), pdf


def test_weights_stand_for_copies(spark, waves, fitted):
    """A weighted fit is as good on the copied rows as a fit on those copies."""
    names = feature_columns(SPEC)
    train = waves.where(F.col("split") == "train")
    rows = forecast.assemble(scaling.normalise(train, fitted.scaler, names), names)
    weighted = forecast._training_rows(rows, change_name("S", 10), rate_name("S", 10), True)
    copied = weighted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(forecast.WEIGHT).cast("int")))).drop("copy").withColumn(forecast.WEIGHT, F.lit(1.0))
    assert copied.count() == weighted.agg(F.sum(forecast.WEIGHT)).first()[0]
    params = forecast.BoostParams(rounds=2, step=0.3, depth=3)
    x, pdf = matrix_of(copied)
    errors = [np.abs(forecast.fit_one(d, None, params, forecast.LABEL).predict(x) - pdf[forecast.LABEL]).mean() for d in (weighted, copied)]
    assert errors[0] == pytest.approx(errors[1], rel=0.15)


def test_runs_continue_from_the_residuals(spark, waves, monkeypatch):
    """Rounds in runs are the rounds of one long run, a shorter fit is their beginning, and errors count every tree once."""
    names = feature_columns(SPEC)
    made = forecast.assemble(waves.where(F.col("split") != "test"), names)
    made = made.select("split", forecast.FEATURES, F.col(f"`{rate_name('S', 10)}`").alias(forecast.LABEL), F.lit(1.0).alias(forecast.WEIGHT)).persist()
    rows, checks = (made.where(F.col("split") == s) for s in ("train", "val"))
    params = forecast.BoostParams(rounds=7, step=0.3, depth=3, leaf_rows=20)
    whole = forecast.fit_one(rows, checks, params, forecast.LABEL)
    monkeypatch.setattr(forecast, "RUN", 3)
    cut = forecast.fit_one(rows, checks, params, forecast.LABEL)
    x, pdf = matrix_of(checks)
    assert len(cut.errors) == 7 and len(cut.trees) == forecast.best_round(cut.errors)
    np.testing.assert_allclose(cut.errors, whole.errors, rtol=1e-9)
    np.testing.assert_allclose(cut.predict(x), whole.predict(x), rtol=1e-9)
    for n in (1, 4, len(cut.trees)):
        part = forecast.Ensemble(cut.base, cut.step, cut.trees[:n])
        assert np.abs(part.predict(x) - pdf[forecast.LABEL]).mean() == pytest.approx(cut.errors[n - 1], rel=1e-9)
    # Every leaf holds the least number of rows, and an ensemble survives being a table.
    x, _ = matrix_of(rows)
    for tree in cut.trees:
        found = np.unique(tree.predict(x), return_counts=True)[1]
        assert found.min() >= 20
    again = forecast.ensemble_of(spark.createDataFrame(cut.rows(), forecast.NODES).repartition(3).toPandas())
    np.testing.assert_array_equal(again.predict(x), cut.predict(x))
    # Only the named features are used.
    few = forecast.fit_one(rows, None, forecast.BoostParams(rounds=2, depth=3), forecast.LABEL, columns=[1, 4])
    assert set(np.flatnonzero(few.splits(len(names)))) <= {1, 4} and few.splits(len(names)).sum()
    made.unpersist()


@pytest.fixture(scope="module")
def noisy(spark):
    """Assembled rows with three features, one of few values, and weights of one to three."""
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=3000), rng.integers(0, 7, 3000), rng.random(3000)])
    pdf = pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], forecast.WEIGHT: rng.integers(1, 4, 3000).astype(float)})
    pdf[forecast.LABEL] = np.sin(3 * x[:, 0]) + (x[:, 1] == 4) + rng.normal(0, 0.1, 3000)
    made = forecast.assemble(spark.createDataFrame(pdf).repartition(3), ["a", "b", "c"]).persist()
    yield made
    made.unpersist()


def test_trees_are_those_of_spark_ml(noisy):
    """The first tree says what a tree of Spark ML says with the same settings."""
    params = forecast.BoostParams(rounds=1, step=1.0, depth=4, leaf_rows=30)
    ours = forecast.fit_one(noisy, None, params, forecast.LABEL)
    weight = noisy.agg(F.sum(forecast.WEIGHT)).first()[0]
    model = RandomForestRegressor(
        featuresCol=forecast.FEATURES, labelCol=forecast.LABEL, weightCol=forecast.WEIGHT, predictionCol="said", numTrees=1, bootstrap=False,
        maxDepth=4, maxBins=256, minWeightFractionPerNode=30 / weight, featureSubsetStrategy="all", seed=1,
    ).fit(noisy)
    x, pdf = matrix_of(model.transform(noisy))
    np.testing.assert_allclose(ours.predict(x), pdf["said"], rtol=1e-9, atol=1e-12)


def test_a_level_of_all_models_is_one_job(spark, noisy):
    """More rounds cost one job a level, and no more for a second model."""
    sc = spark.sparkContext

    def jobs(group: str, rounds: int, models: int) -> int:
        sc.setJobGroup(group, group)
        targets = [forecast.Target(forecast.LABEL, forecast.WEIGHT) for _ in range(models)]
        forecast.boost(noisy, noisy.limit(500), targets, forecast.BoostParams(rounds=rounds, depth=3), 30, 100)
        sc.setLocalProperty("spark.jobGroup.id", None)
        return len(sc.statusTracker().getJobIdsForGroup(group))

    few, more, both = jobs("few", 2, 1), jobs("more", 6, 1), jobs("both", 6, 2)
    assert more - few <= 4 * 3 and both <= more


def test_many_nodes_and_parts_do_not_change_trees(noisy, monkeypatch):
    """Sums in groups, sums added in stages and small blocks give the same trees; shares of rows and features are drawn alike."""
    params = forecast.BoostParams(rounds=3, step=0.3, depth=5, leaf_rows=5)
    x, _ = matrix_of(noisy)
    whole = forecast.fit_one(noisy, noisy, params, forecast.LABEL)
    for name, value in (("SUMS", 40_000), ("PART", 400), ("BLOCK", 100), ("NEAR", 2)):
        monkeypatch.setattr(forecast.boosting, name, value)
    parts = forecast.fit_one(noisy, noisy, params, forecast.LABEL)
    np.testing.assert_allclose(parts.errors, whole.errors, rtol=1e-9)
    np.testing.assert_allclose(parts.predict(x), whole.predict(x), rtol=1e-9)
    drawn = forecast.BoostParams(rounds=3, depth=5, leaf_rows=5, feature_share=0.6, row_share=0.5)
    once, again = (forecast.fit_one(noisy, None, drawn, forecast.LABEL) for _ in range(2))
    np.testing.assert_array_equal(once.predict(x), again.predict(x))
    assert np.abs(once.predict(x) - forecast.fit_one(noisy, None, forecast.BoostParams(rounds=3, depth=5, leaf_rows=5), forecast.LABEL).predict(x)).max() > 0


def test_best_round_stops_after_patience():
    assert forecast.best_round([3, 2, 1, 2, 2], 5) == 3
    assert forecast.best_round([3, 2, 2.5, 2.5, 2.5, 1], 3) == 2
    assert forecast.best_round([1.0]) == 1


def test_settings_of_unknown_stations_are_an_error():
    assert forecast.station_params("A頭首工").rounds == 838
    with pytest.raises(ValueError):
        forecast.station_params("Z")


# -- the whole pipeline ------------------------------------------------------------------


def test_pipeline_from_archives_to_report(spark, tmp_path):
    times = pd.date_range("2019-05-01", periods=144 * 9, freq="10min")
    t = np.arange(len(times))
    rng = np.random.default_rng(6)
    level = (2.6 + 0.2 * np.sin(t / 9)).round(3)
    level[[300, 700]] = 90.0
    intake = (1 + 0.1 * np.cos(t / 15)).round(3)
    cells = level.astype(str).astype(object)
    cells[50], cells[51] = "*", "欠測"
    lines = [f"{x:%Y/%m/%d},{x:%H:%M},{a},{b}" for x, a, b in zip(times, cells, intake)]
    winter = ["2019/12/01,0:00,1.0,1.0", "2017/05/01,0:00,1.0,1.0", "2019/05/01,0:05,7.0,7.0"]
    half = len(lines) // 2
    rain = [f"{x:%Y/%m/%d},{x:%H:%M},{v}" for x, v in zip(times[::6], rng.integers(0, 4, len(times[::6])))]
    (tmp_path / "in").mkdir()
    with zipfile.ZipFile(tmp_path / "in" / "logger.zip", "w") as z:
        z.writestr("A頭首工2019.csv", "\n".join(["日付,時刻,A頭首工 河川水位,A頭首工 右岸取水量", *lines[:half], *winter]).encode("cp932"))
        z.writestr("A頭首工2020.csv", "\n".join(["日付,時刻,A頭首工 河川水位,A頭首工 右岸取水量", *lines[half:]]).encode("utf-8"))
        z.writestr("雨量2019.csv", "\n".join(["日付,時刻,蔵王ダム 累計雨量", *rain]).encode("cp932"))
    spec = StationSpec(
        "A頭首工", rain=("蔵王ダム 累計雨量",), specific=("A頭首工 河川水位", "A頭首工 右岸取水量", "A頭首工 取水量"),
        lags=(10,), horizons=(10, 20), lag_windows={10: (10,), 20: (20,)},
    )
    params = forecast.BoostParams(rounds=3, step=0.3, depth=3)
    root = str(tmp_path / "out")
    families = steps.run_all(spark, str(tmp_path / "in"), root, {"A頭首工": spec}, params, (10, 20), ("rate",))
    assert families == ["A頭首工", "雨量"]

    stats = {r["column"]: r for r in read_table(spark, f"{root}/stats/A頭首工/profile").collect()}
    assert stats["A頭首工 河川水位"]["total"] == len(times) + 1
    assert stats["A頭首工 河川水位"]["asterisk"] == 1 and stats["A頭首工 河川水位"]["coerced_null"] == 2
    histogram = read_table(spark, f"{root}/stats/A頭首工/histogram").where("`column` = 'A頭首工 右岸取水量'")
    assert histogram.agg(F.sum("n")).first()[0] == len(times)

    repaired = read_table(spark, f"{root}/levels/repaired").toPandas().sort_values("datetime")
    assert len(repaired) == len(times)
    assert repaired["A頭首工 河川水位"].between(2.3, 2.9).all()

    rows = read_table(spark, f"{root}/inputs/with_rainfall").toPandas()
    assert sorted(rows["split"].value_counts().tolist()) == [162, 162, 972]
    assert rows["蔵王ダム 累計雨量"].notna().all()
    steps.check_features(spark, root, spec)

    assert read_table(spark, f"{root}/matrix/A頭首工").count() == 2
    encodings = {r["member"]: r["encoding"] for r in read_table(spark, f"{root}/stats/encodings").collect()}
    assert encodings == {"A頭首工2019.csv": "shift_jis", "A頭首工2020.csv": "utf-8", "雨量2019.csv": "shift_jis"}
    assert read_table(spark, f"{root}/rejects/files").count() == 0
    errors = read_table(spark, f"{root}/errors/A頭首工").toPandas()
    done = read_table(spark, f"{root}/forecasts/A頭首工")
    assert len(errors) == 10 and errors.groupby("horizon")["n"].sum().tolist() == [done.count()] * 2
    base = done.agg(F.min("datetime").alias("t"))
    assert steps.report(spark, root, "A頭首工", base, (10, 20)).count() == 2

    counts = {(r.step, r.name): (r.rows_in, r.rows_out, r.anomalies) for r in steps.counts(spark, root).collect()}
    n = len(times)
    assert counts["ingest", "all"] == (n + 3 + len(rain), n + 3 + len(rain), 0)
    assert counts["filter_seasons", "A頭首工"] == (n + 3, n + 1, 0) and counts["clean", "A頭首工"][:2] == (n + 1, n)
    assert counts["repair_levels", "all"][:2] == (n, n) and counts["repair_levels", "all"][2] >= 2
    assert counts["prepare_inputs", "with_rainfall"][1] == n
    features_in, features_out, _ = counts["build_features", "A頭首工"]
    assert features_in == n and features_out == read_table(spark, f"{root}/features/A頭首工").count()
    assert counts["train", "A頭首工"][0] == features_out and counts["predict", "A頭首工"][1] == done.count()

    steps.build_features(spark, root, spec, with_rainfall=False)
    assert "蔵王ダム 累計雨量_10lag" not in read_table(spark, f"{root}/features/A頭首工").columns


def test_gbt_fit_has_all_horizons_and_targets(spark, sf_dir):
    from gaugeflow.plans import series_queries as q

    got = {(r.horizon, r.kind) for r in q.gbt_fit(spark, sf_dir).select("horizon", "kind").distinct().collect()}
    assert got == {(h, k) for h in q.SPEC.horizons for k in ("rate", "change")}
