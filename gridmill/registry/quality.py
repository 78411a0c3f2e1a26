"""Data-quality operators over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmill import feeds
from gridmill.functions.timecols import with_calendar_parts
from gridmill.operators import quality as Q
from gridmill.operators.shape import row_counts
from gridmill.operators.stations import missing_stations
from gridmill.registry.base import query


@query("partition_audit", "load_raw", sql="""
SELECT area, count(*) AS rows, CAST(count_if(area = 'error') AS BIGINT) AS null_dates,
       CAST(count_if(area = 'signup') AS BIGINT) AS mismatched
FROM load_raw GROUP BY area""")
def _(spark, sf):
    rows = with_calendar_parts(feeds.load_raw(spark, sf), "date", ("year", "month"))
    broken = rows.withColumns({
        "date": F.when(F.col("area") != "error", F.col("date")),
        "year": F.when(F.col("area") == "signup", F.col("year") + 1).otherwise(F.col("year")),
    })
    return Q.partition_audit(broken, "date", "area")


@query("row_counts", "load_raw", sql="""
SELECT a.area, count(l.event_id) AS rows
FROM (SELECT unnest(['click', 'view', 'purchase', 'signup', 'error', 'outage']) AS area) a
LEFT JOIN load_raw l ON l.area = a.area GROUP BY a.area""")
def _(spark, sf):
    return row_counts(feeds.load_raw(spark, sf), "area", ["click", "view", "purchase", "signup", "error", "outage"])


@query("missing_stations", "forecast_long", sql="""
SELECT concat('U', CAST(c_custkey AS VARCHAR)) AS station FROM customer
WHERE concat('U', CAST(c_custkey AS VARCHAR)) NOT IN (SELECT station FROM forecast_long)""")
def _(spark, sf):
    wanted = feeds.table(spark, sf, "customer").select(F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("station"))
    return missing_stations(feeds.forecast_long(spark, sf), wanted)


@query("unknown_parameters", sql="""
SELECT event_id, CASE event_type WHEN 'view' THEN 'XX' ELSE NULL END AS parameter FROM events
WHERE event_type IN ('view', 'error')""")
def _(spark, sf):
    kind = F.col("event_type")
    parameter = F.when(kind == "click", "TU").when(kind == "purchase", "ST").when(kind == "signup", "R1") \
        .when(kind == "view", "XX")
    return Q.unknown_parameters(feeds.table(spark, sf, "events").select("event_id", parameter.alias("parameter")))


@query("malformed_rows", sql="""
SELECT * FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'description'
         WHEN event_type = 'view' AND value < 10 THEN 'name'
         WHEN event_type = 'signup' THEN 'coordinates'
         WHEN event_type = 'click' AND value >= 20 THEN 'element'
         WHEN event_type = 'purchase' THEN 'values' END AS problem FROM events) WHERE problem IS NOT NULL""")
def _(spark, sf):
    e = feeds.table(spark, sf, "events")
    kind, value = F.col("event_type"), F.col("value")
    series = F.struct(
        F.when(~((kind == "click") & (value >= 20)), F.lit("TTT")).alias("element"),
        F.when(kind != "purchase", value.cast("string")).otherwise("").alias("text"))
    placemarks = e.select(
        "event_id",
        F.when(kind != "error", kind).alias("station"),
        F.when((kind == "view") & (value < 10), "").otherwise(F.col("user_id").cast("string")).alias("name"),
        F.when(kind == "signup", F.concat_ws(",", value.cast("string"), F.lit("48.2")))
        .otherwise(F.concat_ws(",", value.cast("string"), F.lit("48.2"), F.lit("100"))).alias("coordinates"),
        F.array(series).alias("elements"))
    return Q.malformed_rows(placemarks).select("event_id", "problem")
