"""Union, dedup, sort, aggregates, reshapes and ordered operators."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from gridmill import feeds
from gridmill.feeds import GENERATION_GIVEN
from gridmill.functions.columns import coerce_numeric, row_mean
from gridmill.functions.timecols import to_local, with_calendar_parts
from gridmill.operators import ordered as O, shape as S
from gridmill.operators.skew import CALENDAR_DAYS
from gridmill.registry.base import berlin, query, rounded

ELEMENTS = ["TTT", "FF", "Rad1h", "SunD1", "N"]


@query("union_sources", "climate_recent", "climate_historical", sql="""
SELECT event_id, stations_id, ts, tt_tu, eor, src_rank FROM climate_recent
UNION ALL SELECT event_id, stations_id, ts, tt_tu, eor, src_rank FROM climate_historical""")
def _(spark, sf):
    return S.union_sources([feeds.climate_recent(spark, sf), None, feeds.climate_historical(spark, sf)])


@query("dedup_prefer_recent", "climate_recent", "climate_historical", sql="""
, both_tables AS (SELECT * FROM climate_recent UNION ALL SELECT * FROM climate_historical)
SELECT event_id, stations_id, date_trunc('hour', ts) AS hour_start, tt_tu, src_rank FROM both_tables
QUALIFY row_number() OVER (PARTITION BY stations_id, date_trunc('hour', ts) ORDER BY src_rank, event_id) = 1""")
def _(spark, sf):
    rows = S.union_sources([feeds.climate_recent(spark, sf), feeds.climate_historical(spark, sf)])
    hourly = rows.select("event_id", "stations_id", F.date_trunc("hour", "ts").alias("hour_start"), "tt_tu", "src_rank")
    return S.dedup_prefer(hourly, ["stations_id", "hour_start"], ["src_rank", "event_id"])


@query("sort_by_time", "publish_raw", sql="SELECT date, seq, source_id, load FROM publish_raw ORDER BY date, seq")
def _(spark, sf):
    return O.sort_by(feeds.publish_raw(spark, sf).select("date", "seq", "source_id", "load"), "date", "seq")


@query("last_n_days", "load_raw", sql="""
, d AS (SELECT CAST(date AS DATE) AS day, CAST(sum(CAST(load AS DECIMAL(18,2))) AS DOUBLE) AS load
        FROM load_raw GROUP BY 1)
SELECT day, load FROM d ORDER BY day DESC LIMIT 3""")
def _(spark, sf):
    rows = feeds.load_raw(spark, sf).select(F.to_date("date").alias("day"), "load")
    return O.last_n(S.total_by(rows, ["day"], "load", 2), "day", 3)


# -- aggregates --------------------------------------------------------------------

@query("mean_all_by_day", "gas_raw", sql="""
SELECT CAST(date AS DATE) AS day, round(avg(open_price), 6) AS open_price, round(avg(close_price), 6) AS close_price
FROM gas_raw GROUP BY 1""")
def _(spark, sf):
    rows = feeds.gas_raw(spark, sf).select(F.to_date("date").alias("day"), "open_price", "close_price")
    return rounded(S.mean_all_by(rows, "day"), "open_price", "close_price")


@query("sum_by_month_day", "generation_raw", sql=f"""
SELECT CAST(month({berlin('date')}) AS TINYINT) AS month, CAST(day({berlin('date')}) AS TINYINT) AS day,
""" + ", ".join(f"coalesce(CAST(sum(CAST(TRY_CAST({c} AS DOUBLE) AS DECIMAL(18,2))) AS DOUBLE), 0) AS {c}"
                for c in GENERATION_GIVEN) + " FROM generation_raw GROUP BY 1, 2")
def _(spark, sf):
    rows = with_calendar_parts(feeds.generation_raw(spark, sf), to_local("date"), ("month", "day"))
    return S.sum_columns_by(coerce_numeric(rows, GENERATION_GIVEN), ["month", "day"], GENERATION_GIVEN, 2)


@query("total_load_by_date", "load_raw", sql="""
SELECT CAST(date AS DATE) AS day, CAST(sum(CAST(load AS DECIMAL(18,2))) AS DOUBLE) AS load FROM load_raw GROUP BY 1""")
def _(spark, sf):
    return S.total_by(feeds.load_raw(spark, sf).select(F.to_date("date").alias("day"), "load"), ["day"], "load", 2)


@query("mean_prices_by_date", "gas_raw", sql="""
SELECT CAST(date AS DATE) AS day,
       round(CAST(sum(CAST(open_price AS DECIMAL(18,2))) AS DOUBLE) / count(open_price), 6) AS open_price,
       round(CAST(sum(CAST(close_price AS DECIMAL(18,2))) AS DOUBLE) / count(close_price), 6) AS close_price
FROM gas_raw GROUP BY 1""")
def _(spark, sf):
    rows = feeds.gas_raw(spark, sf).select(F.to_date("date").alias("day"), "open_price", "close_price")
    daily = S.means_by(rows, ["day"], ["open_price", "close_price"], value=lambda c: S.exact_mean(c, 2))
    return rounded(daily, "open_price", "close_price")


@query("current_mark", "publish_raw", sql="SELECT source_id, max(date) AS date FROM publish_raw GROUP BY source_id")
def _(spark, sf):
    return S.current_mark(feeds.publish_raw(spark, sf), "date", ["source_id"])


# -- reshapes ----------------------------------------------------------------------

@query("generation_long", "generation_raw", sql=" UNION ALL ".join(
    f"SELECT event_id, '{c}' AS series, TRY_CAST({c} AS DOUBLE) AS value FROM generation_raw" for c in GENERATION_GIVEN))
def _(spark, sf):
    return S.to_long(coerce_numeric(feeds.generation_raw(spark, sf), GENERATION_GIVEN), ["event_id"], GENERATION_GIVEN)


@query("forecast_wide", "forecast_long", sql="SELECT station, step, " + ", ".join(
    f'max(CASE WHEN element = \'{e}\' THEN value END) AS "{e}"' for e in ELEMENTS)
    + " FROM forecast_long GROUP BY station, step")
def _(spark, sf):
    return S.series_to_wide(feeds.forecast_long(spark, sf), ["station", "step"], ELEMENTS)


# -- ordered -----------------------------------------------------------------------

@query("price_pct_change", "gas_raw", sql="""
, d AS (SELECT event_id % 5 AS market, CAST(date AS DATE) AS day,
               CAST(sum(CAST(open_price AS DECIMAL(18,2))) AS DOUBLE) / count(open_price) AS o,
               CAST(sum(CAST(close_price AS DECIMAL(18,2))) AS DOUBLE) / count(close_price) AS c
        FROM gas_raw GROUP BY 1, 2),
  a AS (SELECT market, day, (o + c) / 2 AS average_price FROM d)
SELECT market, day, round(average_price, 6) AS average_price, round((average_price / nullif(lag(average_price)
       OVER (PARTITION BY market ORDER BY day), 0) - 1) * 100, 6) AS change_pct FROM a""")
def _(spark, sf):
    rows = feeds.gas_raw(spark, sf).select((F.col("event_id") % 5).alias("market"), F.to_date("date").alias("day"),
                                           "open_price", "close_price")
    daily = S.means_by(rows, ["market", "day"], ["open_price", "close_price"], value=lambda c: S.exact_mean(c, 2))
    averaged = daily.select("market", "day", row_mean(["open_price", "close_price"]).alias("average_price"))
    changed = O.pct_change(averaged, ["day"], "average_price", ["market"], "change_pct", group_bound=CALENDAR_DAYS)
    return rounded(changed, "average_price", "change_pct")


ADVANCE_SQL = """SELECT source_id, seq, date, load FROM
(SELECT *, max(date) OVER (PARTITION BY source_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
 FROM publish_raw {where}) WHERE top IS NULL OR date > top"""


@query("advance_only", "publish_raw", sql=ADVANCE_SQL.format(where=""))
def _(spark, sf):
    return O.advance_only(feeds.publish_raw(spark, sf), ["seq"], "date", ["source_id"])


@query("advance_only_from_mark", "publish_raw", sql=ADVANCE_SQL.format(where="WHERE date > TIMESTAMP '1997-01-01'"))
def _(spark, sf):
    rows = feeds.publish_raw(spark, sf)
    start = F.lit(datetime(1997, 1, 1, tzinfo=timezone.utc)).alias("date")
    return O.advance_only(rows, ["seq"], "date", ["source_id"], rows.select("source_id", start).distinct())


@query("number_records", "publish_raw", sql="""
SELECT source_id, seq, 'record_' || CAST(row_number() OVER (PARTITION BY source_id ORDER BY seq) - 1 AS VARCHAR) AS key_id
FROM publish_raw""")
def _(spark, sf):
    return O.number_records(feeds.publish_raw(spark, sf).select("source_id", "seq"), ["seq"], ["source_id"])
