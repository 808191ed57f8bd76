"""Sources, column functions, filters, joins, scaling, evaluation, report."""

from __future__ import annotations

import json
import math
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugeflow.functions.columns import col, round_half_even
from gaugeflow.functions.hydraulics import derived_flows, weir_discharge
from gaugeflow.functions.numbers import change_class, to_number
from gaugeflow.functions.times import compose_ts
from gaugeflow.operators import combine, evaluate, filters, profile, scaling
from gaugeflow.plans import steps
from gaugeflow.sources import legacy_csv, spec, tables
from gaugeflow.sources.storage import member_name

# -- sources ---------------------------------------------------------------------


class OldStyleInfo(zipfile.ZipInfo):
    """Entry whose name is stored as cp932 bytes, without the UTF-8 flag."""

    def _encodeFilenameFlags(self):  # noqa: N802
        return self.filename.encode("cp932"), self.flag_bits & ~0x800


@pytest.fixture(scope="module")
def archives(tmp_path_factory):
    root = tmp_path_factory.mktemp("archives")
    files = {
        "水位2019.csv": "\n日付,時刻, A 河川水位 \n2019/5/1,0:00,1.25\n2019/5/1,0:10,1.5,9\n2019/5/1,0:20\n\n2019/5/1,0:30,NA\n".encode("cp932"),
        "水位2020.csv": "﻿日付,A 河川水位,時刻,備考\r\n2020/5/1,2.5,0:00,欠測\r\n2020/5/1,*,0:10,\"a\"\r\n".encode(),
        "sub/雨量.CSV": "日付,時刻,雨\n2019/5/1,0:00,3\n".encode("euc_jp"),
        "readme.txt": b"no table",
    }
    for name, new_style in (("old.zip", False), ("new.zip", True)):
        with zipfile.ZipFile(root / name, "w") as z:
            for member, data in files.items():
                info = (zipfile.ZipInfo if new_style else OldStyleInfo)(member)
                z.writestr(info, data)
    plain = root / "plain"
    plain.mkdir()
    for member, data in files.items():
        if member.startswith("水位"):
            (plain / member).write_bytes(data)
    return root


def test_zip_names_and_encodings(spark, archives):
    cat = legacy_csv.zip_catalogue(spark, str(archives)).toPandas()
    assert sorted(zip(cat["archive"], cat["member"], cat["encoding"])) == sorted(
        (a, m, e)
        for a in ("old.zip", "new.zip")
        for m, e in (("水位2019.csv", "shift_jis"), ("水位2020.csv", "utf-8"), ("雨量.CSV", "euc_jp"))
    )
    assert list(cat[cat["member"] == "水位2019.csv"]["header"].iloc[0]) == ["日付", "時刻", "A 河川水位"]


def test_member_name_that_is_neither_code_page():
    info = zipfile.ZipInfo("plain.csv")
    assert member_name(info) == "plain.csv"
    info.filename = "日本.csv"
    assert member_name(info) == "日本.csv"


WANTED = {
    ("水位2019.csv", "2019/5/1", "0:00", "1.25", None),
    ("水位2019.csv", "2019/5/1", "0:20", None, None),
    ("水位2019.csv", "2019/5/1", "0:30", None, None),
    ("水位2020.csv", "2020/5/1", "0:00", "2.5", "欠測"),
    ("水位2020.csv", "2020/5/1", "0:10", "*", '"a"'),
}


def test_zip_and_plain_readers_agree(spark, archives):
    columns = ["日付", "時刻", "A 河川水位", "備考"]
    zipped = legacy_csv.read_zip_csv(spark, str(archives / "new.zip"), columns)
    assert "雨" not in zipped.columns
    rows = {tuple(r) for r in zipped.where(F.col("source_file") != "雨量.CSV").select("source_file", *columns).collect()}
    assert rows == WANTED
    plain = legacy_csv.read_legacy_csv(spark, str(archives / "plain"))
    assert plain.columns == ["source_file", *columns]
    assert {tuple(r) for r in plain.collect()} == WANTED


def test_plain_reader_takes_files_in_several_pieces(spark, tmp_path):
    lines = [f"{i},値{i % 10}" for i in range(4000)]
    (tmp_path / "a2001.csv").write_bytes("\n".join(["番号,内容", *lines]).encode("cp932"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        df = legacy_csv.read_legacy_csv(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 4
        got = sorted((int(r["番号"]), r["内容"]) for r in df.collect())
        known = legacy_csv.read_legacy_csv(spark, str(tmp_path), encodings=["cp932"])
        assert sorted((int(r["番号"]), r["内容"]) for r in known.collect()) == got
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(i, f"値{i % 10}") for i in range(4000)]


def test_encoding_guess():
    assert legacy_csv.guess_encoding([b"a,b\n1,2"]) == ("ascii", 1.0)
    assert legacy_csv.guess_encoding([]) == ("ascii", 1.0)
    assert legacy_csv.guess_encoding(["日付,時刻".encode()]) == ("utf-8", 1.0)
    assert legacy_csv.guess_encoding(["日付,時刻".encode("cp932")]) == ("shift_jis", 1.0)
    # All bytes count, and a character may lie across two pieces.
    assert legacy_csv.guess_encoding([b"x" * 2000, "水位".encode("cp932")]) == ("shift_jis", 1.0)
    data = ("x" + "水" * 700).encode()
    assert legacy_csv.guess_encoding([data[:1024], data[1024:]]) == ("utf-8", 1.0)
    encoding, share = legacy_csv.guess_encoding([b"\x81\x01\x82\x01abc"])
    assert 0 < share < 1


def test_equal_names_and_broken_archives(spark, tmp_path):
    """Nothing overwrites another file, and what cannot be read is a reject."""
    source = tmp_path / "in"
    (source / "x").mkdir(parents=True)
    (source / "y").mkdir()
    for folder in "xy":
        with zipfile.ZipFile(source / folder / "log.zip", "w") as z:
            z.writestr("a/m2019.csv", f"n,v\n{folder}1,1\n{folder}2,2\n")
            z.writestr("b/m2019.csv", f"n,v\n{folder}3,3\n")
            with pytest.warns(UserWarning):
                z.writestr("b/m2019.csv", f"n,v\n{folder}4,4\n")
            z.writestr("odd.csv", b"n,v\n\x81\x01\x82\x01,1\n")
    (source / "bad.zip").write_bytes(b"no archive at all")
    (source / "cut.zip").write_bytes((source / "x" / "log.zip").read_bytes()[:-40])
    catalogue = legacy_csv.zip_catalogue(spark, str(source))
    failed = sorted((r["archive"], r["member"]) for r in catalogue.where("encoding is null").collect() if r["error"])
    assert failed == [("bad.zip", None), ("cut.zip", None), ("log.zip", "odd.csv"), ("log.zip", "odd.csv")]
    names = sorted(f"{f}{i}" for f in "xy" for i in range(1, 5))
    assert sorted(r["n"] for r in legacy_csv.read_zip_csv(spark, str(source)).collect()) == names
    copied = legacy_csv.extract_members(catalogue, str(tmp_path / "out")).collect()
    assert len({r["target"] for r in copied}) == len(copied) == 6
    assert sorted(r["n"] for r in legacy_csv.read_legacy_csv(spark, str(tmp_path / "out")).collect()) == names
    report = {(r["archive"], r["member"], r["encoding"]) for r in legacy_csv.encoding_report(spark, str(source)).collect()}
    assert ("log.zip", "m2019.csv", "ascii") in report


def test_members_are_inflated_once_and_directories_read_once_a_range(tmp_path, monkeypatch):
    """Counted in this process: the scan's own function over one archive."""
    path = tmp_path / "many.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(40):
            z.writestr(f"m{i}.csv", ("\n\n 日付 ,v\r\n" + "".join(f"{i},値{j}\r\n" for j in range(300))).encode("cp932" if i % 2 else "utf-8"))
    opened = []
    real = zipfile.ZipFile.open
    monkeypatch.setattr(zipfile.ZipFile, "open", lambda self, name, *a, **b: (opened.append(name), real(self, name, *a, **b))[1])
    monkeypatch.setattr(legacy_csv, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(legacy_csv, "pieces_of", lambda stream: iter(lambda: stream.read(700), b""))
    with zipfile.ZipFile(path) as archive:
        for k, (info, _) in enumerate(legacy_csv._csv_entries(archive)):
            *blocks, last = legacy_csv._scanned(archive, info, legacy_csv.ENCODINGS)
            assert last[1:5] == (("shift_jis" if k % 2 else "utf-8"), ["日付", "v"], "shift_jis" if k % 2 else "utf-8", 1.0)
            text = "\n".join(b[-1].decode(last[1]) for b in blocks)
            assert text.split("\n") == [f"{k},値{j}" for j in range(300)]
            starts = [b[-2] for b in blocks]
            assert len(blocks) >= 2 and starts == [1 + sum(x[-1].count(b"\n") + 1 for x in blocks[:i]) for i in range(len(blocks))]
    assert len(opened) == 40


def test_line_ends_of_all_kinds(monkeypatch):
    monkeypatch.setattr(legacy_csv, "BLOCK_BYTES", 8)
    for end in ("\n", "\r\n", "\r"):
        data = (end + "a,b" + end + end.join(f"{i},{i}" for i in range(50))).encode()
        for size in (1, 3, 7, 1000):
            cut = legacy_csv.LineBlocks()
            blocks = [b for i in range(0, len(data), size) for b in cut.feed(data[i : i + size])] + list(cut.rest())
            assert cut.header == b"a,b"
            assert b"\n".join(b[2] for b in blocks).decode().split("\n") == [f"{i},{i}" for i in range(50)]


def test_one_write_holds_all_families(spark, tmp_path):
    """Two hundred families with their own columns: a bounded number of jobs, right cells."""
    with zipfile.ZipFile(tmp_path / "all.zip", "w") as z:
        for i in range(200):
            z.writestr(f"観測{i}号2001.csv", f"n,c{i}\n{i},x{i}\n{i},*,zuviel\n".encode("cp932"))
            z.writestr(f"観測{i}号2002.csv", f"c{i},m,n\ny{i},z,{i}\n{i}\n".encode())
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("families", "")
    names = steps.ingest(spark, str(tmp_path), str(tmp_path / "out"))
    jobs = len(tracker.getJobIdsForGroup("families"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(names) == 200 and jobs < 60
    for i in (0, 7, 199):
        rows = steps.merged(spark, str(tmp_path / "out"), f"観測{i}号")
        assert rows.columns == ["source_file", "n", f"c{i}", "m"]
        got = {tuple(r)[1:] for r in rows.collect()}
        assert got == {(str(i), f"x{i}", None), (str(i), f"y{i}", "z"), (None, str(i), None)}


def test_long_lines_of_plain_files_are_rejects(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("名,v\nあ,1\nい,2,3\n".encode("cp932"))
    assert [tuple(r) for r in legacy_csv.csv_rejects(spark, str(tmp_path)).collect()] == [("a.csv", "い,2,3")]


def test_header_cells():
    assert legacy_csv.header_cells("﻿ a ,,a,b\r\n") == ["a", "Unnamed: 1", "a.1", "b"]


def test_families(spark):
    df = spark.createDataFrame([("水位2019.csv",), ("雨量.CSV",), ("x/y_20.csv",), ("2020.csv",)], "source_file string")
    rows = {r["source_file"]: (r["family"], r["year"]) for r in legacy_csv.group_file_family(df).collect()}
    assert rows == {"水位2019.csv": ("水位", "2019"), "雨量.CSV": ("雨量", "雨量"), "x/y_20.csv": ("y_20", "y_20"), "2020.csv": ("", "2020")}


def test_csv_starts_with_a_mark_that_reading_removes(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    tables.write_table(spark.createDataFrame([("値", 1.5)], "`名` string, v double"), path, fmt="csv")
    data = [p.read_bytes() for p in (tmp_path / "out.csv").glob("part*.csv")]
    assert data[0].startswith("﻿名,v".encode())
    assert tables.read_table(spark, path, fmt="csv").collect() == [("値", "1.5")]
    assert tables.read_table(spark, [path + "x", path], "`名` string, v double").collect() == [("値", 1.5)]
    with pytest.raises(FileNotFoundError):
        tables.first_existing(spark, [path + "x"])


# -- columns -----------------------------------------------------------------------


def test_compose_ts_cases(spark):
    cases = [
        ("2019/5/1", "0:10", "2019-05-01 00:10:00"),
        ("2019-05-01", "23:50:30", "2019-05-01 23:50:30"),
        ("2019/5/1", "24:00", None),
        ("2019/2/30", "1:00", None),
        ("2019/5/1", "", None),
        (None, "1:00", None),
        ("令和元年", "1:00", None),
        ("2024/3/10", "2:30", "2024-03-10 02:30:00"),
    ]
    df = compose_ts(spark.createDataFrame([(i, d, t) for i, (d, t, _) in enumerate(cases)], "i int, `日付` string, `時刻` string"))
    got = [r["t"] for r in df.select("i", F.col("datetime").cast("string").alias("t")).orderBy("i").collect()]
    assert got == [w for _, _, w in cases]
    with pytest.raises(ValueError, match="date/time"):
        compose_ts(spark.range(1).toDF("x"))


def test_dates_are_parsed_once_a_row(spark):
    """A filter on the composed time used to repeat the whole parse, and absent seconds to raise an error inside every row."""
    rows = spark.createDataFrame([("2019/5/1", "9:05"), ("2019/5/1", "24:00"), ("", "9:05"), ("2019/5/1", "9:05:07")], "`日付` string, `時刻` string")
    got = filters.drop_null_ts(compose_ts(rows.where("length(`時刻`) > 0")))
    assert [str(r[0]) for r in got.orderBy("datetime").collect()] == ["2019-05-01 09:05:00", "2019-05-01 09:05:07"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("try_make_timestamp_ntz(") == 3  # one for each spelling of the date


def test_numbers_as_pandas_reads_them(spark):
    cells = ["1", " 12.5 ", "-.5", "5.", "1e3", "+2", "inf", "-Infinity", "1d", "1f", "0x10", "1_000", "1,000", "１２", "*", "", "nan", None, "欠測"]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in cells], "c string").select(to_number(F.col("c"))).collect()]
    want = pd.to_numeric(pd.Series([c if c is None else c for c in cells]), errors="coerce")
    for cell, g, w in zip(cells, got, want):
        assert (g is None and math.isnan(w)) or g == w, cell


def test_change_class_limits(spark):
    x = [0.0, 0.005, -0.005, 0.0051, -0.0051, 0.015, -0.015, 0.0151, -0.0151, None, float("nan")]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in x], "x double").select(change_class(F.col("x"))).collect()]
    assert got == [0, 0, 0, 1, -1, 1, -1, 2, -2, None, None]


def weir(h: float, b: float, w: float) -> float:
    if w >= h:
        return 0.0
    head, end = h - w, 0.0 if w <= 1 else 0.55 * (w - 1)
    return (1.785 + (0.00295 / head + 0.237 * head / w) * (1 + end)) * b * head**1.5


def test_weirs(spark):
    levels = [0.0, 0.8, 0.81, 2.1, 2.7, 3.5, None]
    df = spark.createDataFrame([(h,) for h in levels], "h double")
    for b, w in ((29.35, 2.1), (0.6, 0.8)):
        for (got,), h in zip(df.select(weir_discharge(F.col("h"), b, w)).collect(), levels):
            assert got is None if h is None else got == pytest.approx(weir(h, b, w), rel=1e-12)


def test_derived_flows_need_their_inputs(spark):
    df = spark.createDataFrame([(3.0, 1.0, None, 2.0)], "`A頭首工 河川水位` double, `A頭首工 右岸取水量` double, `C頭首工 右岸取水量` double, `C頭首工 左岸取水量` double")
    out = derived_flows(df)
    row = out.first()
    overflow = weir(2.5, 29.35, 2.1) + weir(3.0, 10.85, 2.6)
    fishway = weir(1.4, 0.6, 0.8) + weir(1.4, 1.4, 0.9)
    assert row["A頭首工 越流流量"] == pytest.approx(overflow)
    assert row["A頭首工 取水量"] == pytest.approx(1 + overflow + fishway)
    assert row["C頭首工 取水量"] is None
    assert "E頭首工 取水量" not in out.columns and "H頭首工 取水量" not in out.columns


def test_rounding_is_half_even_on_the_scaled_value(spark):
    df = spark.createDataFrame([(1.005,), (0.125,), (0.375,), (-0.125,), (None,)], "x double")
    assert [r[0] for r in df.select(round_half_even(F.col("x"), 2)).collect()] == [1.0, 0.12, 0.38, -0.12, None]


def test_names_with_dots_and_backticks(spark):
    df = spark.createDataFrame([(1.0, None)], "`a.b` double, `c``d` double")
    assert df.select(col("a.b"), col("c`d")).first() == (1.0, None)
    assert {tuple(r) for r in profile.null_counts(df).collect()} == {("a.b", 0), ("c`d", 1)}


# -- filters, joins, scaling -------------------------------------------------------


def test_valid_targets_drop_null_nan_and_infinite(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 1.0, 1.0000001, float("nan"), float("inf"), None)], "r double")
    assert [r[0] for r in filters.valid_targets(df, ["r"]).collect()] == [-1.0, 1.0]


def test_complete_cases_strict_and_lenient(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (2.0, None)], "x double, s string")
    assert filters.complete_cases(df, ["x", "s"]).collect() == [(1.0, "a")]
    with pytest.raises(KeyError):
        filters.complete_cases(df, ["x", "y"])
    assert filters.complete_cases(df, ["x", "y"], strict=False).count() == 2


def test_outer_alignment_of_unique_and_repeated_keys(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "t int, v double")
    b = spark.createDataFrame([(2, 20.0), (3, 30.0)], "t int, v double")
    c = spark.createDataFrame([(3, 300.0)], "t int, w double")
    for unique in (True, False):
        out = combine.align_outer([a, b, c], ["t"], unique)
        assert out.columns == ["t", "v_x", "v_y", "w"]
        assert sorted(map(tuple, out.collect())) == [(1, 1.0, None, None), (2, 2.0, 20.0, None), (3, None, 30.0, 300.0)]
    twice = combine.align_outer([a.union(a), b.union(b)], ["t"], unique=False)
    assert twice.where("t = 2").count() == 4


def test_enrich_keeps_shared_columns_apart(spark):
    levels = spark.createDataFrame([(1, 1.0)], "t int, v double")
    rain = spark.createDataFrame([(1, 9.0), (1, 7.0)], "t int, v double")
    out = combine.enrich_left(levels, rain, ["t"])
    assert out.columns == ["t", "v_x", "v_y"] and [tuple(r) for r in out.collect()] == [(1, 1.0, 7.0)]


def test_enrich_folds_stacked_rain(spark):
    levels = spark.createDataFrame([(1, 1.0), (2, 2.0)], "t int, v double")
    rain = spark.createDataFrame([(1, 5.0, None), (1, None, 6.0), (3, 9.0, 9.0)], "t int, g double, h double")
    assert sorted(map(tuple, combine.enrich_left(levels, rain, ["t"]).collect())) == [(1, 1.0, 5.0, 6.0), (2, 2.0, None, None)]


def test_minmax_rules(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(1.0, -3.0, nan, 2.0, -inf), (4.0, inf, None, 2.0, 5.0)], "a double, b double, c double, d double, e double")
    got = scaling.load_scaler(scaling.fit_minmax(df, df.columns))
    assert got == {"a": (1.0, 4.0), "b": (-3.0, 3.0), "c": (0.0, 1.0), "d": (2.0, 2.0 + 1e-6), "e": (-5.0, 5.0)}
    unit = scaling.normalise(df, got, ["a"])
    assert [r["a"] for r in unit.collect()] == [0.0, 1.0]
    assert [r["a"] for r in scaling.denormalise(unit, got, ["a"]).collect()] == [1.0, 4.0]


def test_copies_per_class(spark):
    df = spark.createDataFrame([(c,) for c in (-2, -1, 0, 1, 2, None)], "c int")
    got = {r["c"]: r["count"] for r in scaling.replicate_by_class(df, "c").groupBy("c").count().collect()}
    assert got == {-2: 11, -1: 4, 0: 1, 1: 4, 2: 11, None: 1}


# -- evaluation and report -----------------------------------------------------------


def test_empty_classes_stay_in_the_error_table(spark):
    rows = spark.createDataFrame([(0.0, 0.5, 2), (0.0, 0.25, 2), (0.0, 1.0, None)], "rate_10_pred double, rate_10_actual double, class_10 int")
    out = {r["change_class"]: r for r in evaluate.mae_by_class(rows, [10], {10: 2.0}).collect()}
    assert sorted(out) == [-2, -1, 0, 1, 2]
    assert (out[2]["n"], out[2]["mae"], out[2]["scaled_mae"]) == (2, 0.375, 259 * 2.0 * 0.375)
    assert (out[0]["n"], out[0]["mae"]) == (0, None)
    matrix = evaluate.mae_matrix(evaluate.mae_by_class(rows, [10], {10: 2.0}))
    assert matrix.columns == ["horizon", "-2", "-1", "0", "1", "2"]
    assert evaluate.mae_by_class(rows.limit(0), [10]).count() == 5


def test_report_for_a_table_of_base_times(spark):
    rows = [("2021-05-01 00:00:00", 1.0, 1.1, 0.1, 0.02), ("2021-05-01 00:10:00", 1.02, 1.2, 0.2, None)]
    df = spark.createDataFrame(rows, "ts string, level double, level_10 double, rate_10_pred double, rate_10_actual double").withColumn("datetime", F.col("ts").cast("timestamp_ntz"))
    bases = spark.createDataFrame([("2021-05-01 00:00:00",), ("2021-05-02 00:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("datetime"))
    out = evaluate.report_table(evaluate.forecast_at(df, bases, [10])).collect()
    assert len(out) == 1
    assert out[0]["時間"] == "2021-05-01 00:10:00"
    assert [out[0][c] for c in ("予測の水位 (m)", "実測の水位 (m)", "予測の水位変動率 (%)", "実測の水位変動率 (%)")] == [1.1, 1.02, 10.0, 2.0]


def test_json_record(spark):
    rows = [("2021-05-01 00:00:00", 1.005, 1.111), ("2021-05-01 00:10:00", 2.0, None)]
    df = spark.createDataFrame(rows, "t string, level double, level_60 double").withColumn("datetime", F.col("t").cast("timestamp_ntz"))
    got = [json.loads(r["message"]) for r in evaluate.forecast_json(df).orderBy("datetime").collect()]
    assert got == [
        {"基準時刻": "2021-05-01 00:00:00", "現在の水位": 1.0, "予測の一時間後の水位": 1.11},
        {"基準時刻": "2021-05-01 00:10:00", "現在の水位": 2.0, "予測の一時間後の水位": "N/A"},
    ]


# -- specification ----------------------------------------------------------------------


def test_default_specification():
    specs = spec.default_specs()
    assert {n: len(spec.feature_columns(s)) for n, s in specs.items()} == {"A頭首工": 199, "B頭首工": 206, "C頭首工": 199, "D頭首工": 304}
    a = spec.station(specs, "A頭首工")
    assert spec.model_columns(a, "60min_rate") == sorted(spec.feature_columns(a))
    assert spec.target_column(a, "60min_rate") == "60分後変動率_A頭首工_河川水位"
    assert a.lag_windows[60] == (60, 70, 80, 90, 100, 110)
    with pytest.raises(ValueError):
        spec.station(specs, "Z")
    with pytest.raises(ValueError):
        spec.target_column(a, "5min_rate")


def test_specification_json_roundtrip_and_merge(spark):
    specs = spec.default_specs()
    assert spec.from_json(spec.to_json(specs)) == specs
    newer = {"A頭首工": specs["A頭首工"].without_rain()}
    merged = spec.merge(specs, newer)
    assert len(merged) == 4 and merged["A頭首工"].rain == ()
    table = spec.spec_table(spark, newer)
    assert table.count() == len(spec.feature_columns(newer["A頭首工"]))
