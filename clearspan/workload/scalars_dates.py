"""Date and time functions (I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clearspan import fixtures
from clearspan.functions import dates
from clearspan.workload.registry import query, scalar

DOY = "lpad(CAST(dayofyear(purchase_date) AS STRING), 3, '0')"
YEAR = "CAST(year(purchase_date) AS STRING)"


def _with_bad(text: str) -> str:
    return (
        f"CASE WHEN merchant_nation = 1 THEN '0000' WHEN merchant_nation = 2 THEN '9999' WHEN merchant_nation = 3 THEN '12 4' "
        f"WHEN merchant_nation = 4 THEN NULL ELSE {text} END"
    )


def _year_day(year: str, day: str) -> str:
    """Date of a day in a year, null outside it."""
    first = f"make_date({year}, 1, 1)"
    return (
        f"CASE WHEN {day} BETWEEN 1 AND 366 AND year({first} + CAST({day} - 1 AS INTEGER)) = {year} "
        f"THEN {first} + CAST({day} - 1 AS INTEGER) END"
    )


_FULL = "(SELECT CASE WHEN yy >= 69 THEN 1900 + yy ELSE 2000 + yy END FROM (SELECT CAST(substr(CAST(year(ref) AS VARCHAR), 3, 1) || substr({c}, 1, 1) AS INTEGER) AS yy))"
_YDDD = _year_day(_FULL.format(c="yddd"), "CAST(substr(yddd, 2, 3) AS INTEGER)")

scalar(
    "date_parse_julian_family",
    {
        "mmdd": _with_bad("substr(CAST(purchase_date AS STRING), 6, 2) || substr(CAST(purchase_date AS STRING), 9, 2)"),
        "yddd": _with_bad(f"substr({YEAR}, 4, 1) || {DOY}"),
        "yyyyddd": _with_bad(f"{YEAR} || CASE WHEN file_no = 0 THEN '400' ELSE {DOY} END"),
        "iso": _with_bad("CAST(purchase_date AS STRING)"),
        "ref": "processing_date",
    },
    lambda: [
        dates.parse_clearing_date(F.col("mmdd"), "MMDD", F.col("ref")).alias("from_mmdd"),
        dates.parse_clearing_date(F.col("yddd"), "YDDD", F.col("ref")).alias("from_yddd"),
        dates.parse_clearing_date(F.col("yddd"), "YDDD_MAX", F.col("ref")).alias("from_yddd_max"),
        dates.parse_clearing_date(F.col("yyyyddd"), "YYYYDDD", F.col("ref")).alias("from_yyyyddd"),
        dates.parse_clearing_date(F.col("iso"), "yyyy-MM-dd", F.col("ref")).alias("from_iso"),
    ],
    {
        "from_mmdd": "CASE WHEN mmdd = '0000' THEN ref ELSE TRY_CAST(CAST(year(ref) - CASE WHEN TRY_CAST(substr(mmdd, 1, 2) AS INTEGER) > month(ref) "
        "THEN 1 ELSE 0 END AS VARCHAR) || '-' || substr(mmdd, 1, 2) || '-' || substr(mmdd, 3, 2) AS DATE) END",
        "from_yddd": f"CASE WHEN yddd = '0000' THEN ref WHEN regexp_matches(yddd, '^[0-9]{{4}}$') THEN {_YDDD} END",
        "from_yddd_max": f"CASE WHEN yddd = '0000' THEN ref WHEN regexp_matches(yddd, '^[0-9]{{4}}$') THEN "
        f"CASE WHEN {_YDDD} > ref THEN CAST({_YDDD} - INTERVAL 1 YEAR AS DATE) ELSE {_YDDD} END END",
        "from_yyyyddd": "CASE WHEN length(yyyyddd) > 4 THEN make_date(CAST(substr(yyyyddd, 1, 4) AS INTEGER), 1, 1) + CAST(CAST(substr(yyyyddd, 5) AS INTEGER) - 1 AS INTEGER) END",
        "from_iso": "TRY_CAST(CASE WHEN length(iso) = 10 THEN iso END AS DATE)",
    },
)

scalar(
    "date_parse_yyddd",
    {"s": f"CASE WHEN file_no = 0 THEN '24' WHEN file_no = 1 THEN '21366' ELSE substr({YEAR}, 3, 2) || {DOY} END", "file_no": "file_no", "d": "purchase_date"},
    lambda: [dates.parse_yyddd(F.col("s")).alias("day")],
    {"day": "CASE WHEN file_no > 1 THEN d END"},
)

scalar(
    "date_parse_multi",
    {
        "s": "CASE file_no % 4 WHEN 0 THEN CAST(purchase_date AS STRING) WHEN 1 THEN replace(CAST(purchase_date AS STRING), '-', '') "
        "WHEN 2 THEN 'soon' ELSE ' ' || CAST(purchase_date AS STRING) || ' ' END",
        "bad": "file_no % 4",
        "d": "purchase_date",
    },
    lambda: [dates.parse_any(F.col("s"), "yyyy-MM-dd", "yyyyMMdd", "ddMMyyyy").alias("day")],
    {"day": "CASE WHEN bad <> 2 THEN d END"},
)

scalar(
    "date_parse_yymmdd",
    {
        "s": "CASE WHEN file_no = 0 THEN CAST(processing_date AS STRING) WHEN file_no = 1 THEN '20' || substr(replace(CAST(processing_date AS STRING), '-', ''), 3) "
        "WHEN file_no = 2 THEN '209999' ELSE substr(replace(CAST(processing_date AS STRING), '-', ''), 3) END",
        "file_no": "file_no",
        "d": "processing_date",
    },
    lambda: [dates.parse_file_date(F.col("s")).alias("day")],
    {
        "day": "CASE WHEN file_no = 0 THEN d WHEN file_no = 2 THEN NULL ELSE "
        "TRY_CAST('20' || right(CAST(year(d) AS VARCHAR), 2) || substr(CAST(d AS VARCHAR), 5) AS DATE) END"
    },
)


@query(
    "date_from_epoch_nanos",
    "SELECT event_id, CAST(ts AS DATE) AS day FROM events",
)
def _nanos(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return events.select("event_id", (micros * 1000).alias("ns")).select("event_id", dates.date_from_nanos(F.col("ns")).alias("day"))


scalar(
    "date_parse_day_hour",
    {
        "s": f"CASE WHEN file_no = 0 THEN 'x' WHEN file_no = 1 THEN '9800199' ELSE substr({YEAR}, 3, 2) || {DOY} || lpad(CAST(merchant_nation % 24 AS STRING), 2, '0') END",
        "file_no": "file_no",
        "hour": "merchant_nation % 24",
        "d": "purchase_date",
    },
    lambda: [dates.timestamp_text(dates.parse_day_hour(F.col("s"))).alias("valid_from")],
    {"valid_from": "CASE WHEN file_no > 1 THEN CAST(d AS VARCHAR) || ' ' || right('0' || CAST(hour AS VARCHAR), 2) || ':00:00.000' END"},
)

scalar(
    "date_timeliness",
    {"a": "purchase_date", "b": "CASE WHEN file_no = 0 THEN NULL WHEN file_no = 1 THEN purchase_date ELSE processing_date END"},
    lambda: [
        dates.timeliness(F.col("a"), F.col("b")).alias("working_days"),
        dates.plain_timeliness(F.col("a"), F.col("b")).alias("plain_days"),
    ],
    {
        "working_days": "CASE WHEN b IS NULL THEN NULL ELSE (SELECT count(*) FROM (SELECT unnest(generate_series(a + 1, b - 1, INTERVAL 1 DAY)) AS g) "
        "WHERE dayofweek(g) <> 0) END",
        "plain_days": "CAST(b - a AS BIGINT)",
    },
)

scalar(
    "date_month_keys",
    {"d": "purchase_date"},
    lambda: [
        dates.month_key(F.col("d"), "-").alias("month_text"),
        dates.month_key(F.col("d")).cast("int").alias("month_number"),
        dates.month_bounds(F.col("d"))[0].alias("month_first"),
        dates.month_bounds(F.col("d"))[1].alias("month_last"),
    ],
    {
        "month_text": "left(CAST(d AS VARCHAR), 7)",
        "month_number": "CAST(year(d) * 100 + month(d) AS INTEGER)",
        "month_first": "make_date(year(d), month(d), 1)",
        "month_last": "CAST(last_day(d) AS DATE)",
    },
)


@query(
    "date_range_generate",
    """SELECT file_no, CAST(unnest(generate_series(min(purchase_date), max(processing_date), INTERVAL 1 DAY)) AS DATE) AS day
       FROM txn GROUP BY file_no""",
    ("txn",),
)
def _range(spark, sf_dir):
    spans = fixtures.txn(spark, sf_dir).groupBy("file_no").agg(F.min("purchase_date").alias("a"), F.max("processing_date").alias("b"))
    return spans.select("file_no", dates.day_sequence(F.col("a"), F.col("b")).alias("day"))


scalar(
    "date_minus_unit",
    {"d": "purchase_date", "t": "CAST(purchase_date AS TIMESTAMP)"},
    lambda: [
        dates.closed_before(F.col("d")).alias("day_before"),
        dates.timestamp_text(dates.closed_before(F.col("t"), "second")).alias("second_before"),
    ],
    {"day_before": "CAST(d - INTERVAL 1 DAY AS DATE)", "second_before": "CAST(d - 1 AS VARCHAR) || ' 23:59:59.000'"},
)
