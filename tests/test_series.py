"""Series operators against pandas and against their own definitions."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugeflow.operators import chunks, features
from gaugeflow.operators.guards import exact_quantile, exact_ranks, lookup_join, repeats, unique_key
from gaugeflow.operators.split import chrono_split

DAY = 86_400


def frame(spark, pdf: pd.DataFrame):
    pdf = pdf.copy()
    df = spark.createDataFrame(pdf.assign(ts=pdf["ts"].astype(str)))
    df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    doubles = [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles}) if doubles else df


def back(df) -> pd.DataFrame:
    return df.toPandas().sort_values([c for c in ("sid", "ts") if c in df.columns]).reset_index(drop=True)


@pytest.fixture(scope="module")
def gappy() -> pd.DataFrame:
    """Two series over forty days; runs of nulls and of absent rows longer than a chunk."""
    rng = np.random.default_rng(7)
    parts = []
    for sid in ("a", "b"):
        ts = pd.date_range("2021-03-27 22:00", periods=144 * 40, freq="10min")
        v = rng.normal(5, 1, len(ts)).round(3)
        v[rng.random(len(ts)) < 0.3] = np.nan
        v[:150] = np.nan
        v[1000:2500] = np.nan
        v[-300:] = np.nan
        keep = rng.random(len(ts)) > 0.2
        keep[3000:4200] = False
        parts.append(pd.DataFrame({"sid": sid, "ts": ts, "v": v, "w": rng.integers(0, 9, len(ts)).astype(float)})[keep])
    return pd.concat(parts, ignore_index=True)


def per_series(pdf: pd.DataFrame, f) -> pd.DataFrame:
    parts = []
    for _, g in pdf.sort_values(["sid", "ts"]).groupby("sid"):
        g = g.copy()
        g["v"] = f(g.set_index("ts")["v"]).to_numpy()
        parts.append(g)
    return pd.concat(parts, ignore_index=True)


@pytest.mark.parametrize("chunk", [DAY // 4, chunks.WEEK, 400 * DAY])
@pytest.mark.parametrize(
    ("operator", "mirror"),
    [
        (lambda d, c: chunks.interpolate_time(d, ["sid"], "ts", ["v"], c), lambda s: s.interpolate("time").ffill().bfill()),
        (lambda d, c: chunks.interpolate_rows(d, ["sid"], "ts", ["v"], c), lambda s: s.interpolate("linear").ffill().bfill()),
        (lambda d, c: chunks.ffill_bfill(d, ["sid"], "ts", ["v"], c), lambda s: s.ffill().bfill()),
        (lambda d, c: chunks.ffill_bfill(d, ["sid"], "ts", ["v"], c, backward=False), lambda s: s.ffill()),
    ],
)
def test_fills_equal_pandas(spark, gappy, operator, mirror, chunk):
    got = back(operator(frame(spark, gappy), chunk))
    want = per_series(gappy, mirror)
    assert len(got) == len(want)
    np.testing.assert_allclose(got["v"].astype(float), want["v"], rtol=1e-12, atol=1e-12)
    np.testing.assert_array_equal(got["w"], want["w"])


def test_fill_of_text_and_without_key(spark):
    ts = pd.date_range("2020-01-01", periods=6, freq="10min").astype(str)
    rows = [(t, s, None) for t, s in zip(ts, [None, "x", None, None, "y", None])]
    df = spark.createDataFrame(rows, "ts string, s string, n double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out = [r["s"] for r in chunks.ffill_bfill(df, [], "ts", chunk=600).orderBy("ts").collect()]
    assert out == ["x", "x", "x", "x", "y", "y"]


@pytest.mark.parametrize("chunk", [1200, DAY, chunks.WEEK])
def test_offsets_equal_shifted_merges(spark, gappy, chunk):
    wanted = [("v", -10, "b10"), ("v", -170, "b170"), ("w", 120, "a120"), ("v", 0, "same")]
    got = back(chunks.at_offsets(frame(spark, gappy), ["sid"], "ts", wanted, chunk))
    want = gappy.sort_values(["sid", "ts"]).reset_index(drop=True)
    for c, minutes, name in wanted:
        other = gappy[["sid", "ts", c]].rename(columns={c: name})
        other = other.assign(ts=other["ts"] - pd.Timedelta(minutes=minutes))
        want = want.merge(other, on=["sid", "ts"], how="left")
    assert len(got) == len(gappy)
    for name in ("b10", "b170", "a120", "same"):
        np.testing.assert_array_equal(got[name].astype(float), want[name].astype(float))


def test_offsets_need_one_window_and_one_shuffle(spark, gappy):
    spec = {h: tuple(range(h, h + 51, 10)) for h in (10, 20, 30, 40, 50, 60, 120)}
    out = features.lagged_targets(frame(spark, gappy), ["sid"], "ts", "v", spec)
    plan = out._jdf.queryExecution().sparkPlan().toString() if hasattr(out, "_jdf") else ""
    assert plan.count("Window [") + plan.count("Window[") == 1
    executed = out._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 1


def test_lagged_targets_refuse_the_future(spark, gappy):
    with pytest.raises(ValueError, match="past the present"):
        features.lagged_targets(frame(spark, gappy), ["sid"], "ts", "v", {60: (50,)})


def test_lag_of_shifted_series_is_the_series(spark):
    ts = pd.date_range("2021-10-31 00:00", periods=500, freq="10min")
    df = frame(spark, pd.DataFrame({"ts": ts, "v": np.arange(500.0)}))
    out = back(features.time_lag(df, [], "ts", ["v"], [60], chunk=7200))
    assert out["v_60lag"].isna().sum() == 6
    np.testing.assert_array_equal(out["v_60lag"][6:], out["v"][:-6])


def test_times_do_not_depend_on_the_session_zone(spark):
    """02:30 does not exist in this zone on that day; the wall clock keeps it."""
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        ts = pd.date_range("2024-03-10 01:00", periods=13, freq="10min")
        df = frame(spark, pd.DataFrame({"ts": ts.delete(6), "v": np.arange(12.0)}))
        out = chunks.regularise(df, [], "ts").select(F.col("ts").cast("string").alias("t"), "v").orderBy("t").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r["t"] for r in out] == [str(t) for t in ts]
    assert [i for i, r in enumerate(out) if r["v"] is None] == [6]


@pytest.mark.parametrize("chunk", [3600, chunks.WEEK])
def test_regularise_equals_asfreq(spark, gappy, chunk):
    got = back(chunks.regularise(frame(spark, gappy), ["sid"], "ts", 10, chunk))
    want = pd.concat(
        [g.set_index("ts")[["v", "w"]].asfreq("10min").reset_index().assign(sid=s) for s, g in gappy.groupby("sid")], ignore_index=True
    ).sort_values(["sid", "ts"])
    assert list(got["ts"]) == list(want["ts"])
    np.testing.assert_array_equal(got["v"].astype(float), want["v"])
    np.testing.assert_array_equal(got["w"].astype(float), want["w"])


def rain_by_position(pdf: pd.DataFrame) -> pd.DataFrame:
    grid = pdf.set_index("ts").resample("10min").asfreq()
    grid = grid[(grid.index.month >= 4) & (grid.index.month <= 9)].fillna(0)
    for i, v in enumerate(pdf["r"].to_numpy()):
        grid.iloc[i * 6 : (i + 1) * 6, 0] = v / 6
    return grid.reset_index()


def test_rain_split_modes(spark):
    hours = pd.date_range("2022-04-02", periods=400, freq="h")
    rng = np.random.default_rng(3)
    full = pd.DataFrame({"ts": hours, "r": rng.integers(0, 5, 400).astype(float)})
    full.loc[5, "r"] = np.nan
    want = rain_by_position(full)
    for op in (chunks.upsample_split, chunks.upsample_by_position):
        got = back(op(frame(spark, full), [], "ts", chunk=DAY))
        assert list(got["ts"]) == list(want["ts"])
        np.testing.assert_allclose(got["r"].astype(float), want["r"])
    holey = full.drop(index=[100, 101, 250]).reset_index(drop=True)
    want = rain_by_position(holey)
    got = back(chunks.upsample_by_position(frame(spark, holey), [], "ts", chunk=DAY))
    np.testing.assert_allclose(got["r"].astype(float), want["r"])
    aligned = back(chunks.upsample_split(frame(spark, holey), [], "ts", chunk=DAY)).set_index("ts")
    assert (aligned.loc["2022-04-06 04:00":"2022-04-06 05:50", "r"] == 0).all()
    assert aligned["r"].sum() == pytest.approx(holey["r"].sum() - holey["r"].iloc[-1] * 5 / 6)
    tail = back(chunks.upsample_split(frame(spark, holey), [], "ts", full_tail=True))
    assert tail["r"].sum() == pytest.approx(holey["r"].sum())


def test_season_edges_of_rain(spark):
    hours = pd.to_datetime(["2022-03-31 23:00", "2022-09-30 23:00", "2022-10-01 00:00"])
    out = back(chunks.upsample_split(frame(spark, pd.DataFrame({"ts": hours, "r": [6.0, 12.0, 18.0]})), [], "ts"))
    assert out["ts"].min() == dt.datetime(2022, 4, 1) and out["ts"].max() == dt.datetime(2022, 9, 30, 23, 50)
    assert out["r"].sum() == pytest.approx(12.0)


@pytest.mark.parametrize("n", [8, 9, 1000, 1001, 1003])
def test_split_sizes_and_order(spark, n):
    ts = pd.date_range("2020-01-01", periods=n, freq="7h")
    out = back(chrono_split(frame(spark, pd.DataFrame({"ts": ts.to_series().sample(frac=1, random_state=1).to_numpy()})), "ts"))
    rest = int(np.ceil(0.25 * n))
    test = int(np.ceil(0.5 * rest))
    assert out["split"].value_counts().reindex(["train", "val", "test"], fill_value=0).tolist() == [n - rest, rest - test, test]
    spans = out.groupby("split")["ts"].agg(["min", "max"])
    assert spans.loc["train", "max"] < spans.loc["test", "min"]
    if rest > test:
        assert spans.loc["train", "max"] < spans.loc["val", "min"] and spans.loc["val", "max"] < spans.loc["test", "min"]


def test_split_per_key_with_one_hot_timestamp(spark):
    """Most rows share one time, so the cut falls inside it."""
    rows = [("a", "2020-01-01 00:00:00", i) for i in range(3000)] + [("a", "2020-01-02 00:00:00", 3000 + i) for i in range(200)]
    rows += [("b", f"2020-01-{1 + i % 28:02d} 00:00:00", i) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, ts string, id int").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out = chrono_split(df, "ts", ["id"], ["k"]).toPandas()
    for k, n in (("a", 3200), ("b", 100)):
        part = out[out["k"] == k].sort_values(["ts", "id"])
        rest = int(np.ceil(0.25 * n))
        test = int(np.ceil(0.5 * rest))
        assert part["split"].tolist() == ["train"] * (n - rest) + ["val"] * (rest - test) + ["test"] * test


def test_exact_ranks_over_many_partitions(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.lit(1).alias("hot"), F.xxhash64("id").alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = exact_ranks(df, ["g"], ["hot", "x"], "rank").toPandas()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = out.sort_values(["g", "hot", "x"]).groupby("g").cumcount() + 1
    assert (out["rank"] == want.reindex(out.index)).all()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_equals_plain_join(spark, how):
    big = spark.range(2000).select((F.col("id") % 7).alias("k"), F.col("id").alias("n"))
    small = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))
    plain = lookup_join(big, small, ["k"], how).collect()
    salted = big.join(small, ["k"], how).collect()
    assert sorted(map(str, plain)) == sorted(map(str, salted))


def test_unique_key_keeps_known_values(spark):
    df = spark.createDataFrame([(1, None, "b"), (1, None, "a"), (1, 5, "c"), (2, None, None)], "k int, t int, s string")
    assert sorted(map(tuple, unique_key(df, ["k"], ["t"]).collect())) == [(1, 5, "c"), (2, None, None)]
    rows = spark.createDataFrame([(1, "t1", "f1", None, 7.0), (1, "t1", "f2", 2.5, 8.0), (1, "t1", "f3", 3.5, None)], "id int, t string, f string, v double, w double")
    assert [tuple(r) for r in unique_key(rows, ["t"], ["f"]).select("t", "f", "v", "w").collect()] == [("t1", "f1", 2.5, 7.0)]
    assert [tuple(r) for r in repeats(rows, ["t"]).collect()] == [("t1", 3)]


def test_exact_quantile_equals_numpy(spark):
    values = np.random.default_rng(8).integers(0, 50, 501).astype(float)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    for share in (0.0, 0.3, 0.97, 1.0):
        assert exact_quantile(df, "v", share) == pytest.approx(np.quantile(values, share))
    assert exact_quantile(df.limit(0), "v", 0.5) is None


def test_null_series_and_nan_are_carried_over_chunks(spark):
    """A null key is a series; NaN is a gap."""
    times = pd.date_range("2019-01-01", periods=5, freq="1D")
    rows = [(k, str(t), v) for k in (None, "a") for t, v in zip(times, [1.0, float("nan"), None, None, 5.0])]
    df = spark.createDataFrame(rows, "k string, ts string, v double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))

    def values(out, c="v"):
        return {k: [r[c] for r in out.where(F.col("k").eqNullSafe(k)).orderBy("ts").collect()] for k in (None, "a")}

    for k, got in values(chunks.ffill_bfill(df, ["k"], "ts", ["v"], DAY)).items():
        assert got == [1, 1, 1, 1, 5], k
    for op in (chunks.interpolate_time, chunks.interpolate_rows):
        for k, got in values(op(df, ["k"], "ts", ["v"], DAY)).items():
            assert got == pytest.approx([1, 2, 3, 4, 5]), k
    for k, got in values(chunks.row_positions(df, ["k"], "ts", "p", DAY), "p").items():
        assert got == [0, 1, 2, 3, 4], k
    assert chunks.regularise(df, ["k"], "ts", 60 * 12, DAY).count() == 18
    assert chunks.upsample_by_position(df, ["k"], "ts", months=(1, 12)).where("k is null and v > 0").count() > 0


def test_one_long_series_is_spread_over_the_tasks(spark):
    """All rows belong to one series; no task may get them all."""
    df = frame(spark, pd.DataFrame({"ts": pd.date_range("2019-01-01", periods=144 * 200, freq="10min"), "v": 1.0}))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for out in (
            chunks.ffill_bfill(df, [], "ts", ["v"], DAY),
            features.time_lag(df, [], "ts", ["v"], [60], DAY),
            chunks.regularise(df, [], "ts", 10, DAY),
        ):
            # The hash keeps the optimizer from leaving the operator out.
            tasks = out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max(F.hash(*out.columns)))
            sizes = [r["n"] for r in tasks.collect()]
            assert len(sizes) == 4 and max(sizes) < 0.5 * sum(sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("name", ["ffill_bfill", "interp_time", "interp_rows", "regularise", "rain_upsample"])
def test_rows_are_read_and_dealt_once(spark, sf_dir, name):
    """Summaries and rows come from one exchange: one scan, and the exchange by slice is used again."""
    import __spark_entry__ as e

    df = e.queries()[name](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = [x for x in plan.split("\n") if "REPARTITION_BY_COL" in x]
    assert plan.count("FileScan parquet") == 1
    assert [("ReusedExchange" in x) for x in lines].count(False) == 1 and any("ReusedExchange" in x for x in lines)
