"""Series views over the given tables, in Spark and in SQL.

The tables hold no gauge data, so ``events`` plays the readings: an event type
is a station, its values per ten-minute slot are the levels.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.times import floor_hour, floor_minutes, shift_minutes
from gaugeflow.operators.chunks import regularise
from gaugeflow.session import fresh_path
from gaugeflow.sources.spec import StationSpec, default_specs
from gaugeflow.sources.storage import write_binary

STEP = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- series ------------------------------------------------------------------


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sid, ts, v): largest value per station and slot; slots may be absent."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("sid"), floor_minutes(F.col("ts"), STEP).alias("ts")).agg(F.max("value").alias("v"))


READINGS = """readings AS (
  SELECT event_type AS sid, time_bucket(INTERVAL '10 minutes', ts) AS ts, max(value) AS v
  FROM events GROUP BY 1, 2)"""


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sid, ts, v) on the full ten-minute grid, null in the gaps."""
    return regularise(readings(spark, sf_dir), ["sid"], "ts", STEP)


GRID = (
    READINGS
    + """, slots AS (
  SELECT sid, unnest(generate_series(min(ts), max(ts), INTERVAL '10 minutes')) AS ts FROM readings GROUP BY sid),
grid AS (SELECT s.sid, s.ts, r.v FROM slots s LEFT JOIN readings r ON r.sid = s.sid AND r.ts = s.ts)"""
)


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sid, ts, lv): a gap-free level whose hourly changes meet every class."""
    held = regularise(readings(spark, sf_dir), ["sid"], "ts", STEP, hold=True)
    return held.select("sid", "ts", (F.lit(1.0) + F.col("v") / F.lit(10000.0)).alias("lv"))


LEVELS = (
    GRID
    + """, lvl AS (
  SELECT sid, ts, 1 + last_value(v IGNORE NULLS) OVER (
    PARTITION BY sid ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / 10000.0 AS lv FROM grid)"""
)


def holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings at irregular times with every fifth hour's value missing."""
    return readings(spark, sf_dir).withColumn("v", F.when(F.hour("ts") % 5 != 0, F.col("v")))


HOLES = READINGS + ", holes AS (SELECT sid, ts, CASE WHEN hour(ts) % 5 <> 0 THEN v END AS v FROM readings)"


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sid, ts, r): largest value per station and hour."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("sid"), floor_hour(F.col("ts")).alias("ts")).agg(F.max("value").alias("r"))


HOURLY = """hourly AS (
  SELECT event_type AS sid, date_trunc('hour', ts) AS ts, max(value) AS r FROM events GROUP BY 1, 2)"""


def hourly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ts, r): one gauge over seven years, to meet the edges of the seasons."""
    o = table(spark, sf_dir, "orders")
    hour = shift_minutes(F.col("o_orderdate"), (F.col("o_orderkey") % 24 * 60).cast("int"))
    return o.groupBy(hour.alias("ts")).agg(F.max("o_totalprice").alias("r"))


HOURLY_ORDERS = """hourly AS (
  SELECT o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS ts, max(o_totalprice) AS r FROM orders GROUP BY 1)"""


# -- a small station ----------------------------------------------------------

STATION = StationSpec(
    "A",
    rain=("error 累計雨量", "purchase 累計雨量"),
    specific=("A 河川水位", "view 取水量", "signup 取水量"),
    lags=(10, 60),
    horizons=(10, 60),
    lag_windows={10: (10, 20), 60: (60, 110)},
)

STATION_COLUMNS = {
    "click": "A 河川水位",
    "view": "view 取水量",
    "signup": "signup 取水量",
    "error": "error 累計雨量",
    "purchase": "purchase 累計雨量",
}


def wide_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ts, one column per input of the small station), one row per time."""
    lv = levels(spark, sf_dir)
    return lv.groupBy("ts").agg(*[F.max(F.when(F.col("sid") == s, F.col("lv"))).alias(c) for s, c in STATION_COLUMNS.items()])


WIDE_STATION = (
    LEVELS
    + ", wide AS (SELECT ts, "
    + ", ".join(f"max(CASE WHEN sid = '{s}' THEN lv END) AS \"{c}\"" for s, c in STATION_COLUMNS.items())
    + " FROM lvl GROUP BY ts)"
)


# -- a station with the whole default specification -----------------------------

#: Four users' share of an event type each play one input.
SHARES = 4
FULL_STATION = default_specs()["B頭首工"]
FULL_SIDS = {c: f"{t}-{i}" for c, (t, i) in zip(FULL_STATION.lagged, [(t, i) for i in range(SHARES) for t in STATION_COLUMNS])}


def full_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ts, one column per input of the station), one row per time."""
    e = table(spark, sf_dir, "events")
    sid = F.concat_ws("-", "event_type", (F.col("user_id") % SHARES).cast("string"))
    read = e.groupBy(sid.alias("sid"), floor_minutes(F.col("ts"), STEP).alias("ts")).agg(F.max("value").alias("v"))
    held = regularise(read, ["sid"], "ts", STEP, hold=True).select("sid", "ts", (F.lit(1.0) + F.col("v") / F.lit(10000.0)).alias("lv"))
    return held.groupBy("ts").agg(*[F.max(F.when(F.col("sid") == s, F.col("lv"))).alias(c) for c, s in FULL_SIDS.items()])


FULL_WIDE = (
    LEVELS.replace("SELECT event_type AS sid", f"SELECT event_type || '-' || (user_id % {SHARES}) AS sid")
    + ", wide AS (SELECT ts, "
    + ", ".join(f"max(CASE WHEN sid = '{s}' THEN lv END) AS \"{c}\"" for c, s in FULL_SIDS.items())
    + " FROM lvl GROUP BY ts)"
)


# -- raw text -----------------------------------------------------------------

# Rows per file, files per archive, and the rows of a file that get one field
# too many or stop after the first field.
FILE_ROWS, ARCHIVE_FILES, LONG_ROW, SHORT_ROW = 500, 4, 7, 11


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as a logger would write them: text dates, text times, marks."""
    e, n = table(spark, sf_dir, "events"), F.col("event_id")
    text = F.col("ts").cast("string")
    return e.select(
        n,
        "event_type",
        "user_id",
        F.when(n % 29 == 0, "").otherwise(F.regexp_replace(F.substring(text, 1, 10), "-", "/")).alias("日付"),
        F.when(n % 31 == 0, "24:00").otherwise(F.substring(text, 12, 5)).alias("時刻"),
        F.when(n % 17 == 0, "*").when(n % 19 == 0, "　＊").when(n % 23 == 0, "欠測").otherwise(F.col("value").cast("string")).alias("cell"),
    )


RAW = """raw AS (
  SELECT event_id, event_type, user_id,
         CASE WHEN event_id % 29 = 0 THEN '' ELSE strftime(ts, '%Y/%m/%d') END AS "日付",
         CASE WHEN event_id % 31 = 0 THEN '24:00' ELSE strftime(ts, '%H:%M') END AS "時刻",
         CASE WHEN event_id % 17 = 0 THEN '*' WHEN event_id % 19 = 0 THEN '　＊'
              WHEN event_id % 23 = 0 THEN '欠測' ELSE CAST(value AS VARCHAR) END AS cell
  FROM events)"""

RAW_FILES = f"""{RAW}, files AS (
  SELECT *, event_id // {FILE_ROWS} AS file_no, event_id // {FILE_ROWS * ARCHIVE_FILES} AS archive_no,
         '観測' || (event_id // {FILE_ROWS * ARCHIVE_FILES}) || '号' || (2001 + event_id // {FILE_ROWS} % {ARCHIVE_FILES}) || '.csv' AS source_file,
         'logger' || (event_id // {FILE_ROWS * ARCHIVE_FILES}) || '.zip' AS archive,
         event_id % {FILE_ROWS} = {LONG_ROW} AS too_long, event_id % {FILE_ROWS} = {SHORT_ROW} AS too_short
  FROM raw)"""

HEADS = ("event_id,日付,時刻, cell ", "event_id,日付,cell,時刻,user_id")


def write_logger_files(spark: SparkSession, sf_dir: str) -> str:
    """Write ``raw_rows`` as ZIP archives and as plain CSV files and return their
    folder (``zip/`` and ``csv/`` inside).

    Even files are cp932, odd ones UTF-8 with a byte order mark and another
    column order. A file has a fixed number of rows, so more data means more
    files and archives, each written by one task unit.
    """
    root = fresh_path(spark, "logger")
    rows = raw_rows(spark, sf_dir)
    n = F.col("event_id")
    even = F.concat_ws(",", n.cast("string"), "日付", "時刻", "cell")
    odd = F.concat_ws(",", n.cast("string"), "日付", "cell", "時刻", F.col("user_id").cast("string"))
    full = F.when(F.floor(n / FILE_ROWS) % 2 == 0, even).otherwise(odd)
    lines = rows.select(
        "event_id",
        F.floor(n / (FILE_ROWS * ARCHIVE_FILES)).alias("archive_no"),
        F.floor(n / FILE_ROWS).alias("file_no"),
        F.when(n % FILE_ROWS == LONG_ROW, F.concat(full, F.lit(",spare,spare")))
        .when(n % FILE_ROWS == SHORT_ROW, n.cast("string"))
        .otherwise(full)
        .alias("line"),
    )

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        packed = io.BytesIO()
        archive_no = int(pdf["archive_no"].iloc[0])
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            for file_no, part in pdf.sort_values("event_id").groupby("file_no"):
                text = "\r\n".join([HEADS[file_no % 2], *part["line"], ""])
                data = text.encode("cp932") if file_no % 2 == 0 else text.encode("utf-8-sig")
                name = f"観測{archive_no}号{2001 + file_no % ARCHIVE_FILES}.csv"
                archive.writestr(name, data)
                write_binary(f"{root}/csv/{name}", iter([data]))
        write_binary(f"{root}/zip/logger{archive_no}.zip", iter([packed.getvalue()]))
        return pd.DataFrame({"files": [pdf["file_no"].nunique()]})

    lines.groupBy("archive_no").applyInPandas(write, "files bigint").write.format("noop").mode("overwrite").save()
    return root

