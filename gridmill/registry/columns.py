"""Filters, projections and scalar functions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F, types as T

from gridmill import feeds
from gridmill.feeds import AS_OF, GENERATION_GIVEN
from gridmill.functions import columns as C, timecols as X
from gridmill.operators.stations import for_stations
from gridmill.registry.base import berlin, query, rounded

# -- filters -----------------------------------------------------------------------


@query("filter_all_of", "load_raw", sql="""
SELECT event_id, load, area FROM load_raw WHERE load >= 50 AND area = 'click' AND date >= TIMESTAMP '2024-01-10'""")
def _(spark, sf):
    wanted = {
        "high": F.col("load") >= 50,
        "clicks": F.col("area") == "click",
        "recent": F.col("date") >= X.instant(datetime(2024, 1, 10)),
    }
    return feeds.load_raw(spark, sf).filter(C.all_of(*wanted.values())).select("event_id", "load", "area")


@query("filter_on_day", "load_raw", sql="""
SELECT event_id, date, load FROM load_raw WHERE CAST(date AS DATE) = DATE '2024-01-17'""")
def _(spark, sf):
    return feeds.load_raw(spark, sf).filter(X.on_day("date", AS_OF)).select("event_id", "date", "load")


@query("filter_next_days", "load_raw", sql="""
SELECT event_id, date, load FROM load_raw
WHERE CAST(date AS DATE) BETWEEN DATE '2024-01-17' AND DATE '2024-01-19'""")
def _(spark, sf):
    return feeds.load_raw(spark, sf).filter(X.within_days("date", AS_OF, 3)).select("event_id", "date", "load")


@query("filter_stations", "forecast_long", sql="""
SELECT station, element, step, value FROM forecast_long
WHERE station IN (SELECT station FROM forecast_long WHERE value >= 150)""")
def _(spark, sf):
    long = feeds.forecast_long(spark, sf)
    return for_stations(long, long.filter(F.col("value") >= 150).select("station"))


@query("drop_any_null", "forecast_long", sql="""
SELECT station, element, step, value FROM forecast_long
WHERE station IS NOT NULL AND element IS NOT NULL AND step IS NOT NULL AND value IS NOT NULL""")
def _(spark, sf):
    return C.drop_any_null(feeds.forecast_long(spark, sf))


@query("drop_bad_dates", "load_raw", sql="""
SELECT event_id, date_trunc('second', date) AS date, load FROM load_raw WHERE area <> 'error'""")
def _(spark, sf):
    text = F.when(F.col("area") == "error", "n/a").otherwise(F.date_format("date", "yyyy-MM-dd HH:mm:ss"))
    rows = feeds.load_raw(spark, sf).select("event_id", text.alias("date"), "load")
    return C.drop_null_dates(rows, "date")


@query("filter_after_mark", "publish_raw", sql="""
SELECT source_id, seq, date, load FROM publish_raw WHERE date > TIMESTAMP '1997-01-01'""")
def _(spark, sf):
    return feeds.publish_raw(spark, sf).filter(C.after_mark("date", datetime(1997, 1, 1, tzinfo=timezone.utc)))


@query("filter_month", "publish_raw", sql="""
SELECT source_id, seq, date FROM publish_raw
WHERE date_trunc('month', ((date AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Brussels')) = TIMESTAMP '1997-12-01'""")
def _(spark, sf):
    return feeds.publish_raw(spark, sf).filter(X.in_month("date", 1997, 12)).select("source_id", "seq", "date")


# -- projections -------------------------------------------------------------------

@query("rename_columns", sql="""
SELECT event_id AS id, ts AS forecast_time, value AS wind_speed FROM events""")
def _(spark, sf):
    e = feeds.table(spark, sf, "events").select("event_id", "ts", "value")
    return C.rename(e, {"event_id": "id", "ts": "forecast_time", "value": "wind_speed"})


@query("drop_parameter_columns", "climate_all", sql="""
SELECT event_id, stations_id, ts, tt_tu, src_rank FROM climate_all""")
def _(spark, sf):
    return C.drop_for_parameter(feeds.climate_all(spark, sf), "TU")


@query("select_fields", "load_raw", sql="SELECT date, load FROM load_raw")
def _(spark, sf):
    return C.select_fields(feeds.load_raw(spark, sf), ["date", "load"])


_HEADERS = [("Event", "ID"), ("Date", ""), ("Fossil Gas", "Actual Aggregated"), "Hydro Run-of-river/Poundage"]


@query("normalize_headers", "gas_raw", sql="""
SELECT event_id, date, open_price AS fossil_gas_actual_aggregated, close_price AS "hydro_run-of-river_poundage"
FROM gas_raw""")
def _(spark, sf):
    return C.normalize_headers(feeds.gas_raw(spark, sf), _HEADERS)


# -- times -------------------------------------------------------------------------

@query("parse_iso_timestamp", "load_raw", sql="""
SELECT event_id, CASE area WHEN 'click' THEN date WHEN 'view' THEN date_trunc('second', date) - INTERVAL 1 HOUR
                 WHEN 'signup' THEN date_trunc('second', date) END AS instant FROM load_raw""")
def _(spark, sf):
    area = F.col("area")
    text = (F.when(area == "click", F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
            .when(area == "view", F.date_format("date", "yyyy-MM-dd HH:mm:ss'+01:00'"))
            .when(area == "signup", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))
            .otherwise("not a date"))
    return feeds.load_raw(spark, sf).select("event_id", X.parse_iso(text).alias("instant"))


@query("parse_hour_stamp", "load_raw", sql="""
SELECT event_id, date_trunc('hour', date) AS measurement_time FROM load_raw""")
def _(spark, sf):
    stamp = F.when(F.col("area") == "view", F.date_format("date", "yyyyMMddHH:mm")) \
        .otherwise(F.date_format("date", "yyyyMMddHH"))
    return feeds.load_raw(spark, sf).select("event_id", X.parse_hour_stamp(stamp).alias("measurement_time"))


@query("parse_forecast_step", "load_raw", sql="""
SELECT event_id, date_trunc('second', date) AS forecast_time FROM load_raw""")
def _(spark, sf):
    text = F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'.000Z'")
    return feeds.load_raw(spark, sf).select("event_id", X.parse_step(text).alias("forecast_time"))


@query("to_local_time", "load_raw", sql=f"SELECT event_id, {berlin('date')} AS local_time FROM load_raw")
def _(spark, sf):
    return feeds.load_raw(spark, sf).select("event_id", X.to_local("date").alias("local_time"))


PARTS_SQL = """CAST(day({0}) AS TINYINT) AS day, CAST(month({0}) AS TINYINT) AS month,
CAST(year({0}) AS SMALLINT) AS year, CAST(hour({0}) AS TINYINT) AS hour, CAST(minute({0}) AS TINYINT) AS minute"""


@query("calendar_parts", "load_raw", sql=f"SELECT event_id, {PARTS_SQL.format(berlin('date'))} FROM load_raw")
def _(spark, sf):
    return X.with_calendar_parts(feeds.load_raw(spark, sf).select("event_id", "date"), X.to_local("date")).drop("date")


@query("day_label", "load_raw", sql="SELECT event_id, strftime(date, '%b %d') AS label FROM load_raw")
def _(spark, sf):
    return feeds.load_raw(spark, sf).select("event_id", X.day_label("date").alias("label"))


@query("iso_text", "load_raw", "publish_raw", sql="""
SELECT event_id AS id, strftime(date, '%Y-%m-%d %H:%M:%S.%f') || '+00:00' AS text FROM load_raw
UNION ALL SELECT seq, strftime(date, '%Y-%m-%d %H:%M:%S') || '+00:00' FROM publish_raw""")
def _(spark, sf):
    fine = feeds.load_raw(spark, sf).select(F.col("event_id").alias("id"), X.iso_text("date").alias("text"))
    return fine.unionAll(feeds.publish_raw(spark, sf).select("seq", X.iso_text("date")))


@query("period_path", "load_raw", sql=f"""
SELECT event_id,
 'electricity/generation/generation_' || strftime({berlin('date')}, '%d_%m_%Y') AS generation,
 'electricity/load/load_' || strftime({berlin('date')}, '%Y_%m_%d_%H') AS load,
 'others/gas/gas_price_' || strftime({berlin('date')}, '%Y_%m_%d_%H') AS gas,
 'weather_forecast/' || area || '/' || strftime({berlin('date')}, '%d_%m_%Y') AS forecast,
 'historical_weather/air_temperature/' || area || '/' || strftime({berlin('date')}, '%d_%m_%Y') AS history
FROM load_raw""")
def _(spark, sf):
    local = X.to_local("date")
    return feeds.load_raw(spark, sf).select(
        "event_id",
        X.period_path(local, "generation").alias("generation"),
        X.period_path(local, "load").alias("load"),
        X.period_path(local, "gas").alias("gas"),
        X.period_path(local, "weather_forecast", station=F.col("area")).alias("forecast"),
        X.period_path(local, "historical_weather", station=F.col("area"), category="air_temperature").alias("history"))


# -- numbers -----------------------------------------------------------------------

@query("narrow_types", sql="""
SELECT TRY_CAST(l_orderkey AS SMALLINT) AS l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber,
       CAST(l_extendedprice AS FLOAT) AS l_extendedprice, CAST(l_discount AS FLOAT) AS l_discount, l_returnflag
FROM lineitem""")
def _(spark, sf):
    cols = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag"]
    return C.narrow(feeds.table(spark, sf, "lineitem").select(*cols))


@query("kelvin_to_celsius", "load_raw", sql="""
SELECT event_id, CAST(CAST(load AS FLOAT) - CAST(273.15 AS FLOAT) AS FLOAT) AS temperature_2m FROM load_raw""")
def _(spark, sf):
    rows = feeds.load_raw(spark, sf).select("event_id", F.col("load").alias("temperature_2m"))
    return C.kelvin_to_celsius(C.narrow(rows, ints="bigint"), ["temperature_2m"])


@query("coerce_numeric", "generation_raw", sql="SELECT event_id, " + ", ".join(
    f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in GENERATION_GIVEN) + " FROM generation_raw")
def _(spark, sf):
    return C.coerce_numeric(feeds.generation_raw(spark, sf).drop("date"), GENERATION_GIVEN)


@query("warehouse_cast", "load_raw", sql=f"""
SELECT event_id, CAST(date AS DATE) AS date, CAST(CAST(load AS FLOAT) AS DOUBLE) AS load, area,
       CAST(day({berlin('date')}) AS BIGINT) AS day, CAST(month({berlin('date')}) AS BIGINT) AS month,
       CAST(year({berlin('date')}) AS BIGINT) AS year, load > 100 AS high FROM load_raw""")
def _(spark, sf):
    rows = feeds.load_raw(spark, sf).withColumn("high", F.col("load") > 100).withColumn("load", F.col("load").cast("float"))
    parts = X.with_calendar_parts(rows.drop("key_id"), X.to_local("date"), ("day", "month", "year"))
    return C.warehouse_cast(parts, "date")


@query("row_mean", "gas_raw", sql="""
SELECT event_id, round((coalesce(o,0) + coalesce(c,0)) / nullif((CASE WHEN o IS NULL THEN 0 ELSE 1 END)
       + (CASE WHEN c IS NULL THEN 0 ELSE 1 END), 0), 6) AS average_price
FROM (SELECT event_id, CASE WHEN open_price >= 5 THEN open_price END AS o,
             CASE WHEN close_price >= 5 THEN close_price END AS c FROM gas_raw)""")
def _(spark, sf):
    prices = [F.when(F.col(c) >= 5, F.col(c)) for c in ("open_price", "close_price")]
    return rounded(feeds.gas_raw(spark, sf).select("event_id", C.row_mean(prices).alias("average_price")), "average_price")


# -- text --------------------------------------------------------------------------

@query("series_title", sql="""
SELECT p_partkey, array_to_string(list_transform(range(1, length(name) + 1), lambda i:
         CASE WHEN i > 1 AND regexp_matches(name[i - 1 : i - 1], '[a-z]') THEN name[i : i] ELSE upper(name[i : i]) END), '') AS title
FROM (SELECT p_partkey, replace(lower(p_brand || '_run-of_2b/' || p_partkey || 'x_' || p_type), '_', ' ') AS name FROM part)""")
def _(spark, sf):
    name = F.lower(F.concat("p_brand", F.lit("_run-of_2b/"), F.col("p_partkey").cast("string"), F.lit("x_"), "p_type"))
    return feeds.table(spark, sf, "part").select("p_partkey", C.series_title(name).alias("title"))


@query("format_fixed2", "forecast_long", sql="""
SELECT station, element, step, CASE WHEN value IS NULL THEN '' ELSE printf('%.2f', value / 3) END AS text,
       CASE WHEN value IS NULL THEN '' ELSE printf('%.2f', value / 8) || '%' END AS percent FROM forecast_long""")
def _(spark, sf):
    return feeds.forecast_long(spark, sf).select(
        "station", "element", "step", C.fixed2(F.col("value") / 3).alias("text"),
        C.fixed2(F.col("value") / 8, "%").alias("percent"))


@query("json_roundtrip", "load_raw", sql="""
SELECT event_id, strftime(date, '%Y-%m-%d %H:%M:%S.%f') || '+00:00' AS date, load, key_id, area FROM load_raw""")
def _(spark, sf):
    rows = feeds.load_raw(spark, sf).withColumn("date", X.iso_text("date"))
    return C.from_json_value(C.to_json_value(rows), T.StructType([*rows.schema.fields]))


@query("split_series", sql="""
SELECT event_id, CAST(p AS INTEGER) AS pos, CASE p WHEN 0 THEN value WHEN 2 THEN CAST(user_id AS DOUBLE) END AS value
FROM events, (SELECT unnest([0, 1, 2, 3]) AS p)""")
def _(spark, sf):
    text = F.concat(F.lit("  "), F.col("value").cast("string"), F.lit(" -   "), F.col("user_id").cast("string"),
                    F.lit(" n/e "))
    return feeds.table(spark, sf, "events").select("event_id", F.posexplode(C.split_series(text)).alias("pos", "value"))


@query("parse_coordinates", sql="""
SELECT event_id, CAST(-user_id AS DOUBLE) AS lng, value AS lat, CAST(event_id AS DOUBLE) AS ele FROM events""")
def _(spark, sf):
    text = F.concat_ws(",", (-F.col("user_id")).cast("string"), F.col("value").cast("string"),
                       F.col("event_id").cast("string"))
    return feeds.table(spark, sf, "events").select("event_id", C.parse_coordinates(text).alias("p")) \
        .select("event_id", "p.*")
