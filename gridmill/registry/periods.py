"""Period slices."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from gridmill import feeds
from gridmill.feeds import AS_OF, AS_OF_SATURDAY
from gridmill.functions.timecols import to_local, with_calendar_parts
from gridmill.operators import periods as P
from gridmill.registry.base import berlin, query

_KEYED = "SELECT event_id, strftime({b}, '{f}') AS period_key FROM load_raw WHERE {w}"
_B = berlin("date")


@query("slice_last_days", "load_raw", sql=_KEYED.format(
    b=_B, f="%Y-%m-%d", w=f"CAST({_B} AS DATE) BETWEEN DATE '2024-01-12' AND DATE '2024-01-16'"))
def _(spark, sf):
    return P.slice_last_days(feeds.load_raw(spark, sf), "date", AS_OF).select("event_id", "period_key")


@query("slice_same_day", "publish_raw", sql="""
SELECT seq, strftime(date, '%Y-%m-%d') AS period_key FROM publish_raw
WHERE CAST(date AS DATE) IN (DATE '2000-02-29', DATE '1996-02-29')""")
def _(spark, sf):
    leap_day = datetime(2000, 2, 29, 12, tzinfo=timezone.utc)
    return P.slice_same_day(feeds.publish_raw(spark, sf), "date", leap_day, 5).select("seq", "period_key")


@query("slice_next_days", "load_raw", sql=_KEYED.format(
    b=_B, f="%Y-%m-%d", w=f"CAST({_B} AS DATE) BETWEEN DATE '2024-01-18' AND DATE '2024-01-20'"))
def _(spark, sf):
    return P.slice_next_days(feeds.load_raw(spark, sf), "date", AS_OF, 3).select("event_id", "period_key")


@query("slice_closed_hours", "load_raw", sql=_KEYED.format(
    b=_B, f="%Y-%m-%d-%H", w=f"CAST({_B} AS DATE) = DATE '2024-01-17' AND hour({_B}) < 16"))
def _(spark, sf):
    return P.slice_closed_hours(feeds.load_raw(spark, sf), "date", AS_OF).select("event_id", "period_key")


@query("slice_trading_hours", "load_raw", sql=_KEYED.format(
    b=_B, f="%Y-%m-%d-%H", w=f"CAST({_B} AS DATE) = DATE '2024-01-19' AND hour({_B}) <= 22"))
def _(spark, sf):
    return P.slice_trading_hours(feeds.load_raw(spark, sf), "date", AS_OF_SATURDAY).select("event_id", "period_key")


def _with_parts(spark, sf):
    rows = feeds.load_raw(spark, sf).select("event_id", "date", "load")
    return with_calendar_parts(rows, to_local("date"), ("year", "month", "day", "hour")).drop("date")


_PARTS = f"""CAST(year({_B}) AS SMALLINT) AS year, CAST(month({_B}) AS TINYINT) AS month,
CAST(day({_B}) AS TINYINT) AS day, CAST(hour({_B}) AS TINYINT) AS hour"""


@query("slice_by_hour", "load_raw", sql=f"""
SELECT event_id, load, {_PARTS} FROM load_raw
WHERE CAST({_B} AS DATE) = DATE '2024-01-17' AND hour({_B}) < 16""")
def _(spark, sf):
    keys = spark.createDataFrame([(2024, 1, 17, h) for h in range(16)], "year int, month int, day int, hour int")
    return P.slice_by_period(_with_parts(spark, sf), keys, "hour")


@query("slice_by_day", "load_raw", sql=f"""
SELECT event_id, load, {_PARTS} FROM load_raw
WHERE CAST({_B} AS DATE) BETWEEN DATE '2024-01-12' AND DATE '2024-01-16'""")
def _(spark, sf):
    keys = spark.createDataFrame([(2024, 1, d) for d in range(12, 17)], "year int, month int, day int")
    return P.slice_by_period(_with_parts(spark, sf), keys, "day")


@query("missing_periods", "load_raw", sql=f"""
, wanted AS (SELECT unnest(generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '2024-02-02', INTERVAL 1 HOUR)) AS h)
SELECT CAST(year(h) AS INTEGER) AS year, CAST(month(h) AS INTEGER) AS month, CAST(day(h) AS INTEGER) AS day,
       CAST(hour(h) AS INTEGER) AS hour
FROM wanted WHERE h NOT IN (SELECT date_trunc('hour', {_B}) FROM load_raw)""")
def _(spark, sf):
    first = datetime(2023, 12, 31)
    hours = [first + timedelta(hours=i) for i in range(33 * 24 + 1)]
    keys = spark.createDataFrame([(h.year, h.month, h.day, h.hour) for h in hours], "year int, month int, day int, hour int")
    return P.missing_periods(keys, _with_parts(spark, sf), ["year", "month", "day", "hour"])
