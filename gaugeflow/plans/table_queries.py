"""Queries over raw and cleaned tables: reading, filtering, profiling, uniting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.columns import drop_like
from gaugeflow.functions.hydraulics import FISHWAY_A, LEVEL_A, OVERFLOW_A, derived_flows, weir_discharge
from gaugeflow.functions.numbers import coerce_numeric
from gaugeflow.functions.times import calendar_features, compose_ts, floor_hour
from gaugeflow.operators import combine, filters, guards, profile
from gaugeflow.plans import fixtures as fx
from gaugeflow.plans.registry import query
from gaugeflow.session import fresh_path, materialise
from gaugeflow.sources import legacy_csv, tables

# -- sources and sinks ------------------------------------------------------------


@query(
    "zip_scan",
    f"WITH {fx.RAW_FILES} SELECT archive, source_file AS member, count(*) AS n_lines FROM files GROUP BY 1, 2",
)
def zip_scan(spark: SparkSession, sf: str) -> DataFrame:
    scan = legacy_csv.scan_archives(spark, fx.write_logger_files(spark, sf) + "/zip")
    counts = legacy_csv.zip_lines(scan).groupBy("file_id").agg(F.count("*").alias("n_lines"))
    named = scan.catalogue.select(legacy_csv.file_id().alias("file_id"), "archive", "member")
    return named.join(counts, "file_id").select("archive", "member", "n_lines")


@query(
    "encoding_report",
    f"""WITH {fx.RAW_FILES} SELECT DISTINCT archive, source_file AS member,
    CASE WHEN file_no % 2 = 0 THEN 'shift_jis' ELSE 'utf-8' END AS encoding, 1.0::DOUBLE AS confidence FROM files""",
)
def encoding_report(spark: SparkSession, sf: str) -> DataFrame:
    return legacy_csv.encoding_report(spark, fx.write_logger_files(spark, sf) + "/zip")


SCANNED = """CAST(event_id AS VARCHAR) AS event_id, CASE WHEN NOT too_short THEN nullif("日付", '') END AS "日付",
  CASE WHEN NOT too_short THEN "時刻" END AS "時刻", CASE WHEN NOT too_short THEN cell END AS cell,
  CASE WHEN NOT too_short AND file_no % 2 = 1 THEN CAST(user_id AS VARCHAR) END AS user_id, source_file"""


@query("legacy_csv_scan", f"WITH {fx.RAW_FILES} SELECT {SCANNED} FROM files WHERE NOT too_long")
def legacy_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    return legacy_csv.read_legacy_csv(spark, fx.write_logger_files(spark, sf) + "/csv")


@query("zip_csv_scan", f"WITH {fx.RAW_FILES} SELECT archive, {SCANNED} FROM files WHERE NOT too_long")
def zip_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    return legacy_csv.read_zip_csv(spark, fx.write_logger_files(spark, sf) + "/zip")


@query(
    "rejected_lines",
    f"""WITH {fx.RAW_FILES} SELECT archive, source_file, event_id % {fx.FILE_ROWS} + 1 AS line_no FROM files WHERE too_long""",
)
def rejected_lines(spark: SparkSession, sf: str) -> DataFrame:
    scan = legacy_csv.scan_archives(spark, fx.write_logger_files(spark, sf) + "/zip")
    return legacy_csv.zip_rejects(scan).select("archive", "source_file", "line_no")


@query(
    "extracted_members",
    f"WITH {fx.RAW_FILES} SELECT archive, source_file, count(*) AS n_rows FROM files WHERE NOT too_long GROUP BY 1, 2",
)
def extracted_members(spark: SparkSession, sf: str) -> DataFrame:
    """Unpack the archives, then read the unpacked files."""
    root = fx.write_logger_files(spark, sf)
    catalogue = legacy_csv.zip_catalogue(spark, root + "/zip")
    copied = materialise(legacy_csv.extract_members(catalogue, root + "/unpacked"), "copied")
    rows = legacy_csv.read_legacy_csv(spark, root + "/unpacked", ["event_id"]).groupBy("source_file").agg(F.count("*").alias("n_rows"))
    return copied.select("archive", F.col("member").alias("source_file")).join(rows, "source_file").select("archive", "source_file", "n_rows")


@query(
    "file_family",
    f"""WITH {fx.RAW_FILES} SELECT '観測' || archive_no || '号' AS family, CAST(2001 + file_no % {fx.ARCHIVE_FILES} AS VARCHAR) AS year,
    count(*) AS n_rows FROM files WHERE NOT too_long GROUP BY 1, 2""",
)
def file_family(spark: SparkSession, sf: str) -> DataFrame:
    rows = legacy_csv.read_legacy_csv(spark, fx.write_logger_files(spark, sf) + "/csv", ["event_id"])
    return legacy_csv.group_file_family(rows).groupBy("family", "year").agg(F.count("*").alias("n_rows"))


ORDER_SCHEMA = "o_orderkey bigint, o_orderdate timestamp_ntz, o_totalprice double, o_orderpriority string"


@query("typed_scan", "SELECT o_orderkey, o_orderdate, o_totalprice, o_orderpriority FROM orders")
def typed_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "orders") + ".csv"
    columns = ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority"]
    tables.write_table(fx.table(spark, sf, "orders").select(*columns), path, fmt="csv")
    return tables.read_table(spark, [path + "-absent", path], ORDER_SCHEMA)


@query("roundtrip_sink", "SELECT o_orderkey, o_totalprice, o_orderstatus, year(o_orderdate)::INTEGER AS year FROM orders")
def roundtrip_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "orders")
    rows = fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", F.year("o_orderdate").alias("year"))
    tables.write_table(rows, path, ["o_orderstatus", "year"])
    return tables.read_table(spark, path)


# -- filters and text ----------------------------------------------------------------

COMPOSED = f"""WITH {fx.RAW}, composed AS (
  SELECT event_id, cell, try_strptime(nullif("日付", '') || ' ' || "時刻", '%Y/%m/%d %H:%M') AS ts FROM raw)"""


def composed(spark: SparkSession, sf: str) -> DataFrame:
    return compose_ts(fx.raw_rows(spark, sf).select("event_id", "cell", "日付", "時刻"), ts="ts")


@query("compose_ts", COMPOSED + " SELECT event_id, cell, ts FROM composed")
def composed_ts(spark: SparkSession, sf: str) -> DataFrame:
    return composed(spark, sf)


@query("date_spellings", "SELECT event_id, date_trunc('minute', ts) AS ts FROM events")
def date_spellings(spark: SparkSession, sf: str) -> DataFrame:
    """The same dates in four spellings."""
    e, n = fx.table(spark, sf, "events"), F.col("event_id") % 4
    y, m, d = (F.date_format("ts", p) for p in ("yyyy", "M", "d"))
    date = F.when(n == 0, F.concat_ws("-", y, m, d)).when(n == 1, F.concat(y, F.lit("年"), m, F.lit("月"), d, F.lit("日"))).when(n == 2, F.date_format("ts", "yyyyMMdd")).otherwise(F.date_format("ts", " yyyy/MM/dd "))
    return compose_ts(e.select("event_id", date.alias("日付"), F.date_format("ts", "H:mm").alias("時刻")), ts="ts").select("event_id", "ts")


@query("drop_null_ts", COMPOSED + " SELECT event_id, cell, ts FROM composed WHERE ts IS NOT NULL")
def drop_null_ts(spark: SparkSession, sf: str) -> DataFrame:
    return filters.drop_null_ts(composed(spark, sf), "ts")


@query(
    "numeric_coerce",
    f"WITH {fx.RAW} SELECT event_id, TRY_CAST(cell AS DOUBLE) AS cell FROM raw",
)
def numeric_coerce(spark: SparkSession, sf: str) -> DataFrame:
    return coerce_numeric(fx.raw_rows(spark, sf).select("event_id", "cell"), ["cell"])


@query("season_filter", "SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) >= 1998 AND month(o_orderdate) BETWEEN 4 AND 9")
def season_filter(spark: SparkSession, sf: str) -> DataFrame:
    return filters.season_filter(fx.table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", 1998)


@query("grid_filter", "SELECT event_id, ts, value FROM events WHERE minute(ts) % 10 = 0")
def grid_filter(spark: SparkSession, sf: str) -> DataFrame:
    return filters.on_grid(fx.table(spark, sf, "events").select("event_id", "ts", "value"), "ts")


@query("drop_like", "SELECT ts, user_id, value, props FROM events")
def drop_like_query(spark: SparkSession, sf: str) -> DataFrame:
    return drop_like(fx.table(spark, sf, "events"), "event")


@query("sort_ts", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey")
def sort_ts(spark: SparkSession, sf: str) -> DataFrame:
    return filters.sort_ts(fx.table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", ["o_orderkey"])


@query("calendar_feats", 'SELECT event_id, hour(ts)::INTEGER AS "Hour", (isodow(ts) - 1)::INTEGER AS "Weekday", month(ts)::INTEGER AS "Month" FROM events')
def calendar_feats(spark: SparkSession, sf: str) -> DataFrame:
    return calendar_features(fx.table(spark, sf, "events").select("event_id", "ts"), "ts").drop("ts")


# -- statistics -----------------------------------------------------------------------

PROFILED = ["日付", "時刻", "cell"]
NUMBER_SQL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _profile_sql(c: str) -> str:
    number = f"CASE WHEN regexp_matches(\"{c}\", '{NUMBER_SQL}') THEN TRY_CAST(\"{c}\" AS DOUBLE) END"
    return f"""SELECT event_type, '{c}' AS "column", count(*) AS total, count_if("{c}" IS NULL) AS "null",
      count(*) FILTER (WHERE {number} = 0) AS zero, count_if(trim("{c}", ' 　') IN ('*', '＊')) AS asterisk,
      sum(len(regexp_extract_all("{c}", '[^\\x00-\\x7F]+')))::BIGINT AS garbled, count(DISTINCT "{c}") AS "unique",
      count_if("{c}" IS NOT NULL AND {number} IS NULL) AS coerced_null FROM cells GROUP BY event_type"""


@query(
    "quality_profile",
    f"WITH {fx.RAW}, cells AS (SELECT event_type, nullif(\"日付\", '') AS \"日付\", \"時刻\", cell FROM raw) "
    + " UNION ALL ".join(_profile_sql(c) for c in PROFILED),
)
def quality_profile(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.raw_rows(spark, sf).select("event_type", F.nullif("日付", F.lit("")).alias("日付"), "時刻", "cell")
    return profile.quality_profile(rows, "event_type")


@query(
    "null_counts",
    f"""WITH {fx.RAW}, cells AS (SELECT nullif("日付", '') AS "日付", "時刻", cell, TRY_CAST(cell AS DOUBLE) AS number FROM raw)
    UNPIVOT (SELECT count_if("日付" IS NULL) AS "日付", count_if("時刻" IS NULL) AS "時刻", count_if(cell IS NULL) AS cell,
      count_if(number IS NULL) AS number FROM cells) ON "日付", "時刻", cell, number INTO NAME "column" VALUE missing""",
)
def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.raw_rows(spark, sf).select(F.nullif("日付", F.lit("")).alias("日付"), "時刻", "cell", F.col("cell").alias("number"))
    return profile.null_counts(coerce_numeric(rows, ["number"]))


# Whole cents, so that sums, and with them the means, are exact in any order.
LONG_ORDERS = """long AS (SELECT 'cents' AS "column", o_orderdate AS ts, round(o_totalprice * 100) AS value FROM orders
  UNION ALL SELECT 'o_custkey', o_orderdate, o_custkey::DOUBLE FROM orders
  UNION ALL SELECT 'same', o_orderdate, 7.0::DOUBLE FROM orders)"""
MEASURED = ["cents", "o_custkey", "same"]


def measured_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = fx.table(spark, sf, "orders")
    return orders.select("o_orderdate", F.round(F.col("o_totalprice") * 100).alias("cents"), "o_custkey", F.lit(7.0).alias("same"))


@query(
    "yearly_trend",
    f"""WITH {LONG_ORDERS} SELECT "column", year(ts)::INTEGER AS year, count(value) AS n, min(value) AS min_value, max(value) AS max_value,
    avg(value) AS mean_value FROM long GROUP BY 1, 2""",
)
def yearly_trend(spark: SparkSession, sf: str) -> DataFrame:
    return profile.yearly_trend(measured_orders(spark, sf), "o_orderdate", MEASURED)


@query("daily_trend", f"""WITH {LONG_ORDERS} SELECT "column", ts::DATE AS day, avg(value) AS mean_value FROM long GROUP BY 1, 2""")
def daily_trend(spark: SparkSession, sf: str) -> DataFrame:
    return profile.daily_trend(measured_orders(spark, sf), "o_orderdate", MEASURED)


@query(
    "yearly_histogram",
    f"""WITH {LONG_ORDERS}, y AS (SELECT "column", year(ts)::INTEGER AS year, value FROM long),
    ends AS (SELECT "column", year, min(value) AS a, max(value) AS b FROM y GROUP BY 1, 2),
    r AS (SELECT "column", year, CASE WHEN a = b THEN a - 0.5::DOUBLE ELSE a END AS lo, CASE WHEN a = b THEN b + 0.5::DOUBLE ELSE b END AS hi FROM ends)
    SELECT "column", year, lo, hi, least(floor((value - lo) / ((hi - lo) / 30.0::DOUBLE))::INTEGER + 1, 30) AS bin, count(*) AS n
    FROM y JOIN r USING ("column", year) GROUP BY ALL""",
)
def yearly_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return profile.yearly_histogram(measured_orders(spark, sf), "o_orderdate", MEASURED)


@query(
    "stage_counts",
    """SELECT 'read' AS stage, count(*) AS n_rows FROM orders UNION ALL
    SELECT 'in_season', count(*) FROM orders WHERE year(o_orderdate) >= 1998 AND month(o_orderdate) BETWEEN 4 AND 9""",
)
def stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows, read = profile.counted(fx.table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "read")
    kept, in_season = profile.counted(filters.season_filter(rows, "o_orderdate", 1998), "in_season")
    return profile.stage_counts([read, in_season], kept)


# -- sets -------------------------------------------------------------------------------


@query("dedup_rows", "SELECT DISTINCT event_type, user_id, date_trunc('hour', ts) AS hour FROM events")
def dedup_rows(spark: SparkSession, sf: str) -> DataFrame:
    return guards.dedup(fx.table(spark, sf, "events").select("event_type", "user_id", floor_hour(F.col("ts")).alias("hour")))


def partners(spark: SparkSession, sf: str) -> list[DataFrame]:
    c = fx.table(spark, sf, "customer")
    s = fx.table(spark, sf, "supplier")
    return [
        c.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("source_file")),
        s.select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("source_file")),
    ]


@query(
    "union_by_name",
    """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, 'customer' AS source_file, NULL::INTEGER AS nation FROM customer
    UNION ALL SELECT s_name, s_acctbal, NULL, 'supplier', s_nationkey FROM supplier""",
)
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    return combine.union_frames(partners(spark, sf))


@query(
    "union_common",
    "SELECT c_acctbal AS balance, c_name AS name, 'customer' AS source_file FROM customer UNION ALL SELECT s_acctbal, s_name, 'supplier' FROM supplier",
)
def union_common(spark: SparkSession, sf: str) -> DataFrame:
    return combine.union_common(partners(spark, sf))


@query("common_keys", "SELECT o_orderkey AS orderkey FROM orders INTERSECT SELECT l_orderkey FROM lineitem")
def common_keys(spark: SparkSession, sf: str) -> DataFrame:
    orders = fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey"))
    lines = fx.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey"))
    return filters.common_keys(orders, lines, ["orderkey"])


# -- hydraulics -----------------------------------------------------------------------------


def weir_sql(h: str, b: float, w: float) -> str:
    end = 0.0 if w <= 1 else 0.55 * (w - 1)
    head = f"(({h}) - {w}::DOUBLE)"
    return (
        f"CASE WHEN ({h}) <= {w}::DOUBLE THEN 0.0::DOUBLE ELSE (1.785::DOUBLE + (0.00295::DOUBLE / {head} + 0.237::DOUBLE * {head} / {w}::DOUBLE)"
        f" * {1 + end!r}::DOUBLE) * {b}::DOUBLE * pow({head}, 1.5::DOUBLE) END"
    )


WEIRS = {"q_long": (29.35, 2.1), "q_short": (10.85, 2.6), "q_low": (0.6, 0.8)}


@query(
    "weir_discharge",
    f"WITH {fx.READINGS} SELECT sid, ts, " + ", ".join(f"round({weir_sql('v / 100.0::DOUBLE', b, w)}, 6) AS {n}" for n, (b, w) in WEIRS.items()) + " FROM readings",
)
def weirs(spark: SparkSession, sf: str) -> DataFrame:
    h = F.col("v") / 100.0
    return fx.readings(spark, sf).select("sid", "ts", *[F.round(weir_discharge(h, b, w), 6).alias(n) for n, (b, w) in WEIRS.items()])


_H = '"A頭首工 河川水位"'
_FLOW_SQL = {
    OVERFLOW_A: f"{weir_sql(_H + ' - 0.5::DOUBLE', 29.35, 2.1)} + {weir_sql(_H, 10.85, 2.6)}",
    FISHWAY_A: f"{weir_sql(_H + ' - 1.6::DOUBLE', 0.6, 0.8)} + {weir_sql(_H + ' - 1.6::DOUBLE', 1.4, 0.9)}",
}
FLOW_INPUTS = {"click": LEVEL_A, "view": "A頭首工 右岸取水量", "error": "C頭首工 右岸取水量", "signup": "C頭首工 左岸取水量", "purchase": "E頭首工 右岸１取水量"}


@query(
    "derived_flows",
    f"WITH {fx.READINGS}, w AS (SELECT ts, "
    + ", ".join(f"max(CASE WHEN sid = '{s}' THEN v / 100.0::DOUBLE END) AS \"{c}\"" for s, c in FLOW_INPUTS.items())
    + " FROM readings GROUP BY ts), f AS (SELECT *, "
    + ", ".join(f'CASE WHEN {_H} IS NOT NULL THEN {e} END AS "{c}"' for c, e in _FLOW_SQL.items())
    + ' FROM w) SELECT ts, '
    + ", ".join(f'round("{c}", 6) AS "{c}"' for c in [*FLOW_INPUTS.values(), *_FLOW_SQL])
    + f', round("A頭首工 右岸取水量" + "{OVERFLOW_A}" + "{FISHWAY_A}", 6) AS "A頭首工 取水量"'
    + ', round("C頭首工 右岸取水量" + "C頭首工 左岸取水量", 6) AS "C頭首工 取水量" FROM f',
)
def flows(spark: SparkSession, sf: str) -> DataFrame:
    """Station E lacks one of its two intakes here, so it gets no total."""
    wide = fx.readings(spark, sf).groupBy("ts").agg(
        *[F.max(F.when(F.col("sid") == s, F.col("v") / 100.0)).alias(c) for s, c in FLOW_INPUTS.items()]
    )
    made = derived_flows(wide)
    return made.select("ts", *[F.round(F.col(f"`{c}`"), 6).alias(c) for c in made.columns if c != "ts"])
