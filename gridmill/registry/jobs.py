"""End-to-end jobs and marts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from gridmill import feeds
from gridmill.feeds import AS_OF, AS_OF_LEDGER, AS_OF_SATURDAY, GENERATION_GIVEN
from gridmill.functions.columns import rename
from gridmill.functions.timecols import instant
from gridmill.operators.shape import series_to_wide
from gridmill.plans import jobs as J, marts as M
from gridmill.registry import feeds as files
from gridmill.registry.base import berlin, query, rounded
from gridmill.plans.refresh import read_mart, refresh_mart
from gridmill.registry.ingest import PARTS, lake_rows
from gridmill.schemas import FORECAST_ELEMENTS
from gridmill.session import scratch
from gridmill.sources.climate import read_climate_text
from gridmill.sinks.lake import write_once
from gridmill.streaming.sinks import load_incremental, read_loaded

_B = berlin("date")
_PARTS_BIG = ", ".join(f"CAST({p}({_B}) AS BIGINT) AS {p}" for p in PARTS)

# -- jobs --------------------------------------------------------------------------


def _element(code: str, kelvin: bool) -> str:
    value = f"max(CASE WHEN p.element = '{code}' THEN CAST(p.value AS FLOAT) END)"
    if kelvin:
        value = f"CAST({value} - CAST(273.15 AS FLOAT) AS FLOAT)"
    return f"CAST({value} AS DOUBLE) AS {FORECAST_ELEMENTS[code]}"


_FT = berlin("forecast_time")


@query("job_weather_forecast", "forecast_long", sql=f"""{files.FORECAST_FILES_SQL},
 spans AS (SELECT bucket, issue, max(step) AS last FROM placed GROUP BY 1, 2),
 steps AS (SELECT bucket, issue, unnest(generate_series(issue * {files.ISSUE_STEPS}, last)) AS step FROM spans),
 stations AS (SELECT DISTINCT bucket, issue, station FROM placed),
 times AS (SELECT s.station, t.step, {files.STEP_TIME_SQL.replace('step', 't.step')} AS forecast_time
           FROM stations s JOIN steps t ON s.bucket = t.bucket AND s.issue = t.issue)
SELECT t.station, CAST(forecast_time AS DATE) AS forecast_time,
       {", ".join(_element(e, c.startswith('temperature')) for e, c in FORECAST_ELEMENTS.items())},
       CAST(day({_FT}) AS BIGINT) AS day, CAST(month({_FT}) AS BIGINT) AS month, CAST(year({_FT}) AS BIGINT) AS year
FROM times t LEFT JOIN placed p ON p.station = t.station AND p.step = t.step
WHERE CAST({_FT} AS DATE) BETWEEN DATE '2024-01-18' AND DATE '2024-01-20'
GROUP BY t.station, t.forecast_time""")
def _(spark, sf):
    work = scratch(spark, "job-forecast")
    files.forecast_files(feeds.forecast_long(spark, sf), f"{work}/in", whole=True)
    J.weather_forecast_job(spark, f"{work}/in", f"{work}/lake", f"{work}/table", f"{work}/state", AS_OF)
    return read_loaded(spark, f"{work}/table")


@query("job_generation", "generation_raw", sql=f"""
SELECT event_id, CAST(date AS DATE) AS date, {", ".join(GENERATION_GIVEN)}, {_PARTS_BIG} FROM generation_raw
WHERE CAST({_B} AS DATE) BETWEEN DATE '2024-01-12' AND DATE '2024-01-16'""")
def _(spark, sf):
    work = scratch(spark, "job-generation")
    headers = ["event_id", ("Date", ""), ("Biomass", "Actual Aggregated"), ("Fossil Gas", "Actual Aggregated"),
               ("Solar", "Actual Consumption"), ("Wind Onshore", "Actual Aggregated")]
    J.generation_job(spark, feeds.generation_raw(spark, sf), f"{work}/lake", f"{work}/table", f"{work}/state", AS_OF,
                     month=(2024, 1), headers=headers)
    return read_loaded(spark, f"{work}/table")


@query("job_generation_days", "generation_raw", sql=f"""
SELECT event_id, CAST(date AS DATE) AS date, {", ".join(GENERATION_GIVEN)}, {_PARTS_BIG} FROM generation_raw
WHERE CAST({_B} AS DATE) BETWEEN DATE '2024-01-11' AND DATE '2024-01-16'""")
def _(spark, sf):
    """Two runs on following days, the second one repeated: the union of their slices, every row once."""
    work = scratch(spark, "job-generation-days")
    headers = ["event_id", ("Date", ""), *[(c.replace("_", " "), "") for c in GENERATION_GIVEN]]
    for as_of in (AS_OF - timedelta(days=1), AS_OF, AS_OF):
        J.generation_job(spark, feeds.generation_raw(spark, sf), f"{work}/lake", f"{work}/table", f"{work}/state", as_of, headers=headers)
    return read_loaded(spark, f"{work}/table")


@query("job_generation_kept", "generation_raw", sql=f"""
SELECT event_id, CAST(date AS DATE) AS date, {", ".join(GENERATION_GIVEN)}, {_PARTS_BIG} FROM generation_raw
WHERE CAST({_B} AS DATE) BETWEEN DATE '2024-01-09' AND DATE '2024-01-16' AND CAST(date AS DATE) >= DATE '2024-01-12'""")
def _(spark, sf):
    """Two runs, the table's days older than five dropped by the load."""
    work = scratch(spark, "job-generation-kept")
    headers = ["event_id", ("Date", ""), *[(c.replace("_", " "), "") for c in GENERATION_GIVEN]]
    for as_of in (AS_OF - timedelta(days=3), AS_OF):
        J.generation_job(spark, feeds.generation_raw(spark, sf), f"{work}/lake", f"{work}/table", f"{work}/state", as_of, headers=headers, keep_days=5)
    return read_loaded(spark, f"{work}/table")


_MT = berlin("hour_start")


@query("job_historical_weather", "climate_recent", "climate_historical", sql=f"""
, both_tables AS (SELECT * FROM climate_recent UNION ALL SELECT * FROM climate_historical),
  chosen AS (SELECT stations_id, date_trunc('hour', ts) AS hour_start, tt_tu FROM both_tables
    QUALIFY row_number() OVER (PARTITION BY stations_id, date_trunc('hour', ts) ORDER BY src_rank, tt_tu) = 1)
SELECT CAST(hour_start AS DATE) AS measurement_time, CAST(CAST(tt_tu AS FLOAT) AS DOUBLE) AS "TT_TU",
       CAST(day({_MT}) AS BIGINT) AS day, CAST(month({_MT}) AS BIGINT) AS month, CAST(year({_MT}) AS BIGINT) AS year,
       CAST(hour({_MT}) AS BIGINT) AS hour, CAST(stations_id AS VARCHAR) AS station
FROM chosen WHERE CAST({_MT} AS DATE) = DATE '2024-01-17'""")
def _(spark, sf):
    work = scratch(spark, "job-climate")
    files.climate_text(feeds.climate_recent(spark, sf), f"{work}/recent")
    files.climate_text(feeds.climate_historical(spark, sf), f"{work}/historical")
    J.historical_weather_job(spark, read_climate_text(spark, f"{work}/recent"), read_climate_text(spark, f"{work}/historical"),
                             "TU", f"{work}/lake", f"{work}/table", f"{work}/state", AS_OF)
    return read_loaded(spark, f"{work}/table")


_PARTS_UTC = ", ".join(f"CAST({p}(date) AS BIGINT) AS {p}" for p in PARTS)


@query("job_load", "load_raw", sql=f"""
SELECT CAST(date AS DATE) AS date, CAST(CAST(load AS FLOAT) AS DOUBLE) AS load, {_PARTS_UTC} FROM load_raw
WHERE CAST({_B} AS DATE) = DATE '2024-01-17' AND hour({_B}) < 16""")
def _(spark, sf):
    work = scratch(spark, "job-load")
    files.load_messages(spark, sf, f"{work}/in")
    J.load_job(spark, f"{work}/in", f"{work}/lake", f"{work}/table", f"{work}/state", AS_OF)
    return read_loaded(spark, f"{work}/table")


@query("job_load_deliveries", "load_raw", sql=f"""
SELECT CAST(date AS DATE) AS date, CAST(CAST(load AS FLOAT) AS DOUBLE) AS load, {_PARTS_UTC} FROM load_raw
WHERE {_B} >= TIMESTAMP '2024-01-17 00:00:00' AND {_B} < TIMESTAMP '2024-01-18 16:00:00'""")
def _(spark, sf):
    """Three deliveries and runs over midnight: every hour once, those that were open at a run included."""
    work = scratch(spark, "job-load-deliveries")
    rows = feeds.load_raw(spark, sf)
    cuts = [AS_OF, AS_OF + timedelta(hours=8), AS_OF + timedelta(days=1)]
    for last, as_of in zip([None, *cuts[:2]], cuts):
        part = F.col("date") < instant(as_of) if last is None else (F.col("date") >= instant(last)) & (F.col("date") < instant(as_of))
        files.load_messages(spark, sf, f"{work}/in", rows.filter(part), mode="append")
        J.load_job(spark, f"{work}/in", f"{work}/lake", f"{work}/table", f"{work}/state", as_of)
    return read_loaded(spark, f"{work}/table")


@query("job_gas", "gas_raw", sql=f"""
SELECT CAST(date AS DATE) AS date, CAST(CAST(open_price AS FLOAT) AS DOUBLE) AS open_price,
       CAST(CAST(close_price AS FLOAT) AS DOUBLE) AS close_price, {_PARTS_UTC} FROM gas_raw
WHERE CAST({_B} AS DATE) = DATE '2024-01-19' AND hour({_B}) <= 22""")
def _(spark, sf):
    work = scratch(spark, "job-gas")
    files.gas_messages(spark, sf, f"{work}/in")
    J.gas_job(spark, f"{work}/in", f"{work}/lake", f"{work}/table", f"{work}/state", AS_OF_SATURDAY)
    return read_loaded(spark, f"{work}/table")


@query("job_cleanup", "processed_files", sql="""
SELECT s3_key, CAST((row_number() OVER (ORDER BY s3_key COLLATE "C") - 1) // 1000 AS BIGINT) AS batch,
       'expired' AS status FROM (SELECT DISTINCT s3_key FROM processed_files
                                 WHERE processed_at < TIMESTAMP '1998-01-01 00:00:00')""")
def _(spark, sf):
    return J.cleanup_job(feeds.processed_files(spark, sf), AS_OF_LEDGER, 7).drop("error")


@query("gas_feed", "gas_raw", sql=f"""
SELECT date, open_price, close_price, {_B} AS date_local FROM gas_raw""")
def _(spark, sf):
    quotes = feeds.gas_raw(spark, sf).select(F.col("date").alias("Datetime"), F.col("open_price").alias("Open"),
                                             F.col("close_price").alias("Close"))
    return J.gas_feed(quotes)


@query("load_feed", "load_raw", sql="SELECT event_id, date, load FROM load_raw WHERE load >= 5 ORDER BY date, event_id")
def _(spark, sf):
    history = feeds.load_raw(spark, sf).select("event_id", F.col("date").alias("index"),
                                               F.when(F.col("load") >= 5, F.col("load")).alias("Actual Load"))
    return J.load_feed(history, ["event_id"])


# -- marts -------------------------------------------------------------------------

MEANS = """CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE) / count({0})"""


@query("mart_gas_prices", "gas_raw", sql=f"""
, d AS (SELECT CAST(date AS DATE) AS day, {MEANS.format('open_price')} AS open_price,
               {MEANS.format('close_price')} AS close_price FROM gas_raw WHERE date IS NOT NULL GROUP BY 1),
  l AS (SELECT * FROM d ORDER BY day DESC LIMIT 3),
  a AS (SELECT day, open_price, close_price, (open_price + close_price) / 2 AS average_price FROM l),
  p AS (SELECT *, (average_price / lag(average_price) OVER (ORDER BY day) - 1) * 100 AS pct FROM a)
SELECT day, strftime(day, '%b %d') AS day_label, round(open_price, 6) AS open_price,
       round(close_price, 6) AS close_price, round(average_price, 6) AS average_price, round(pct, 6) AS price_change_pct,
       CASE WHEN pct IS NULL THEN '' ELSE printf('%.2f', pct) || '%' END AS price_change_text FROM p ORDER BY day""")
def mart_gas_prices(spark, sf):
    mart = M.mart_gas_prices(feeds.gas_raw(spark, sf), scale=2)
    return rounded(mart, "open_price", "close_price", "average_price", "price_change_pct")


@query("mart_load_days", "load_raw", sql="""
SELECT CAST(date AS DATE) AS day, strftime(CAST(date AS DATE), '%b %d') AS day_label,
       CAST(sum(CAST(load AS DECIMAL(18,2))) AS DOUBLE) AS load FROM load_raw GROUP BY 1, 2""")
def _(spark, sf):
    return M.mart_load_days(feeds.load_raw(spark, sf), scale=2)


@query("mart_refreshed", "load_raw", sql="""
SELECT CAST(date AS DATE) AS day, strftime(CAST(date AS DATE), '%b %d') AS day_label,
       CAST(sum(CAST(CAST(load AS FLOAT) AS DECIMAL(18,2))) AS DOUBLE) AS load FROM load_raw GROUP BY 1, 2""")
def _(spark, sf):
    """The mart of load days kept up to date over three loads, the last of them late rows of days that were there."""
    lake, work = scratch(spark, "refresh-lake"), scratch(spark, "refresh")
    rows = lake_rows(spark, sf).drop("area")
    schema, late = rows.drop("period_key").schema, F.col("event_id") % 50 == 0
    early = F.col("date") < F.lit("2024-01-15").cast("timestamp")
    for batch, part in (("a", early & ~late), ("b", ~early & ~late), ("late", late)):
        keyed = rows.filter(part).withColumn("period_key", F.concat_ws("-", "period_key", F.lit(batch)))
        write_once(keyed, lake, "electricity/load", batch)
        load_incremental(spark, lake, "electricity/load", schema, f"{work}/table", f"{work}/state", "date", AS_OF)
        refresh_mart(spark, lake, "electricity/load", f"{work}/table", f"{work}/state/ledger", f"{work}/mart", f"{work}/refreshed",
                     lambda df: M.mart_load_days(df, scale=2))
    return read_mart(spark, f"{work}/mart").select("day", "day_label", "load")


@query("mart_load_last_days", "load_raw", sql="""
SELECT CAST(date AS DATE) AS day, strftime(CAST(date AS DATE), '%b %d') AS day_label,
       CAST(sum(CAST(load AS DECIMAL(18,2))) AS DOUBLE) AS load FROM load_raw
WHERE CAST(date AS DATE) BETWEEN DATE '2024-01-12' AND DATE '2024-01-16' GROUP BY 1, 2""")
def _(spark, sf):
    return M.mart_load_days(feeds.load_raw(spark, sf), scale=2, last_days=5, as_of=AS_OF)


def _mix_sql(day: str) -> str:
    def title(c: str) -> str:
        return c.replace("_", " ").title()

    return " UNION ALL ".join(f"""SELECT day, strftime(day, '%b %d') AS day_label, '{c}' AS energy_type,
      '{title(c)}' AS energy_title,
      coalesce(CAST(sum(CAST(TRY_CAST({c} AS DOUBLE) AS DECIMAL(18,2))) AS DOUBLE), 0) AS generated
    FROM (SELECT *, {day} AS day FROM generation_raw) GROUP BY day""" for c in GENERATION_GIVEN)


@query("mart_generation_mix", "generation_raw", sql=_mix_sql("CAST(date AS DATE)"))
def _(spark, sf):
    return M.mart_generation_mix(feeds.generation_raw(spark, sf), GENERATION_GIVEN, scale=2)


@query("mart_generation_calendar", "generation_raw", sql=_mix_sql(f"make_date(2024, month({_B}), day({_B}))"))
def _(spark, sf):
    return M.mart_generation_mix(feeds.generation_raw(spark, sf), GENERATION_GIVEN, calendar=True, scale=2, tz="Europe/Berlin")


@query("mart_weather_days", "forecast_long", sql=f"""
, t AS (SELECT *, CAST({files.STEP_TIME_SQL} AS DATE) AS day FROM forecast_long),
  d AS (SELECT day, {", ".join(
      f"CAST(sum(CASE WHEN element = '{e}' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) / "
      f"nullif(count(CASE WHEN element = '{e}' THEN value END), 0) AS {FORECAST_ELEMENTS[e]}"
      for e in ("FF", "Rad1h", "SunD1"))}
    FROM t WHERE day BETWEEN DATE '2024-01-17' AND DATE '2024-01-19' GROUP BY day)
SELECT day, strftime(day, '%b %d') AS day_label, {", ".join(f"round({c}, 6) AS {c}" for c in M.OUTLOOK)},
       {", ".join(f"CASE WHEN {c} IS NULL THEN '' ELSE printf('%.2f', {c}) END AS {c}_text" for c in M.OUTLOOK)} FROM d""")
def _(spark, sf):
    wide = series_to_wide(feeds.forecast_long(spark, sf), ["station", "step"], list(FORECAST_ELEMENTS))
    table = rename(wide.withColumn("forecast_time", files.step_time(F.col("step"))), FORECAST_ELEMENTS)
    return rounded(M.mart_weather_days(table, AS_OF, 3, scale=2), *M.OUTLOOK)
