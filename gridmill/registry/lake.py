"""Sources, sinks and table lifecycle: written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from gridmill import feeds
from gridmill.feeds import AS_OF, AS_OF_LEDGER
from gridmill.functions.columns import warehouse_cast
from gridmill.functions.timecols import iso_text, parse_hour_stamp, to_local, with_calendar_parts
from gridmill.operators import retention as R
from gridmill.operators.stations import attach_steps
from gridmill.registry import feeds as files
from gridmill.registry.base import berlin, query
from gridmill.schemas import LOAD_MESSAGE
from gridmill.session import checkpointed, scratch
from gridmill.sinks import lake as K
from gridmill.sources import climate, forecast, lake as S

_B = berlin("date")


def _daily(rows):
    return rows.withColumn("period_key", F.date_format("date", "yyyy-MM-dd"))


def _hourly(rows):
    return rows.withColumn("period_key", F.date_format("date", "yyyy-MM-dd-HH"))


# -- sources -----------------------------------------------------------------------

@query("scan_lake", "load_raw", sql="SELECT event_id, date, load, area FROM load_raw")
def _(spark, sf):
    lake = scratch(spark, "scan-lake")
    load = _daily(feeds.load_raw(spark, sf).select("event_id", "date", "load", "area")
                  .withColumn(S.PANDAS_INDEX, F.col("event_id")))
    gas = _daily(feeds.gas_raw(spark, sf))
    K.write_once(load, lake, "electricity/load", "first")
    K.write_once(gas, lake, "others/gas", "first")
    return S.read_lake(spark, lake, "electricity/load/").drop("file_path", K.KEY)


@query("scan_table", sql="SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def _(spark, sf):
    return S.read_table(spark, f"{sf}/orders.parquet")


@query("list_objects", "load_raw", sql="""
SELECT DISTINCT strftime(date, '%Y-%m-%d') AS period_key, true AS has_objects FROM load_raw""")
def _(spark, sf):
    lake = scratch(spark, "list-objects")
    K.write_once(_daily(feeds.load_raw(spark, sf)), lake, "electricity/load", "first")
    objects = S.list_objects(spark, lake, "electricity/load/")
    key = F.regexp_extract("path", "period=([^/]+)/", 1).alias("period_key")
    return objects.groupBy(key).agg((F.sum("length") > 0).alias("has_objects"))


@query("scan_csv", "load_raw", sql="""
SELECT strftime(date, '%Y-%m-%d %H:%M:%S.%f') || '+00:00' AS date, load, key_id FROM load_raw""")
def _(spark, sf):
    folder = scratch(spark, "scan-csv")
    K.export_csv(feeds.load_raw(spark, sf).select(iso_text("date").alias("date"), "load", "key_id"), folder)
    return S.read_records_csv(spark, folder, LOAD_MESSAGE)


@query("climate_text_scan", "climate_all", sql="""
SELECT CAST(stations_id AS INTEGER) AS "STATIONS_ID", date_trunc('hour', ts) AS measurement_time, 3.0::DOUBLE AS "QN_9",
       tt_tu AS "TT_TU", 55.0::DOUBLE AS "RF_TU", eor FROM climate_all""")
def _(spark, sf):
    folder = scratch(spark, "climate-text")
    # Two deliveries, the second with its columns in another order.
    rows = feeds.climate_all(spark, sf)
    files.climate_text(rows.filter("event_id % 2 = 0"), f"{folder}/a")
    files.climate_text(rows.filter("event_id % 2 = 1"), f"{folder}/b", swapped=True)
    return climate.read_climate_text(spark, [f"{folder}/a", f"{folder}/b"]).select(
        "STATIONS_ID", parse_hour_stamp("MESS_DATUM").alias("measurement_time"), "QN_9", "TT_TU", "RF_TU", "eor")


@query("climate_archive_scan", "climate_all", sql="""
SELECT CAST(stations_id AS INTEGER) AS "STATIONS_ID", date_trunc('hour', ts) AS measurement_time, 3.0::DOUBLE AS "QN_9",
       tt_tu AS "TT_TU", 55.0::DOUBLE AS "RF_TU", eor FROM climate_all""")
def _(spark, sf):
    folder = scratch(spark, "climate-archives")
    files.climate_archives(feeds.climate_all(spark, sf), folder)
    return climate.read_climate_archives(spark, f"{folder}/*.zip", "TU").select(
        "STATIONS_ID", parse_hour_stamp("MESS_DATUM").alias("measurement_time"), "QN_9", "TT_TU", "RF_TU", "eor")


@query("forecast_kmz_scan", "forecast_long", sql=f"""
SELECT station, element, CAST(step % {files.ISSUE_STEPS} AS INTEGER) AS step, value, {files.STEP_TIME_SQL} AS forecast_time
FROM forecast_long""")
def _(spark, sf):
    folder = scratch(spark, "forecast-kmz")
    files.forecast_files(feeds.forecast_long(spark, sf), f"{folder}/kml")
    files.as_kmz(f"{folder}/kml", f"{folder}/kmz", spark)
    return forecast.read_forecast_xml(spark, f"{folder}/kmz", zipped=True).drop("file")


@query("forecast_xml_scan", "forecast_long", sql=f"""
SELECT station, element, CAST(step % {files.ISSUE_STEPS} AS INTEGER) AS step, value, {files.STEP_TIME_SQL} AS forecast_time
FROM forecast_long""")
def _(spark, sf):
    folder = scratch(spark, "forecast-xml")
    files.forecast_files(feeds.forecast_long(spark, sf), folder)
    return forecast.read_forecast_xml(spark, folder).drop("file")


@query("forecast_stations", "forecast_long", sql=f"""
SELECT station, substr(station, 2) AS name, 48.25::DOUBLE AS lat, CAST(substr(station, 2) AS DOUBLE) + 0.5 AS lng,
       100.0::DOUBLE AS ele, count(DISTINCT step // {files.ISSUE_STEPS}) AS issues
FROM forecast_long GROUP BY station""")
def _(spark, sf):
    folder = scratch(spark, "forecast-stations")
    files.forecast_files(feeds.forecast_long(spark, sf), folder)
    return forecast.station_table(forecast.read_placemarks(spark, folder)) \
        .groupBy("station", "name", "lat", "lng", "ele").agg(F.count(F.lit(1)).alias("issues"))


@query("forecast_attach_steps", "forecast_long", sql=f"""
SELECT station, element, step, value, {files.STEP_TIME_SQL} AS forecast_time FROM forecast_long""")
def _(spark, sf):
    long = feeds.forecast_long(spark, sf)
    last = long.agg(F.max("step")).first()[0]
    steps = spark.range(0, (last or 0) + 1).select(F.col("id").cast("int").alias("step")) \
        .withColumn("forecast_time", files.step_time(F.col("step")))
    return attach_steps(long, steps, ["step"]).select("station", "element", "step", "value", "forecast_time")


# -- write once --------------------------------------------------------------------

@query("lake_write_once", "load_raw", sql="""
, keyed AS (SELECT event_id, load, area, strftime(date, '%Y-%m-%d-%H') AS period_key FROM load_raw)
SELECT event_id, load, period_key FROM keyed WHERE area <> 'error'
UNION ALL SELECT event_id, load, period_key FROM keyed
WHERE area = 'error' AND period_key NOT IN (SELECT period_key FROM keyed WHERE area <> 'error')""")
def _(spark, sf):
    lake = scratch(spark, "write-once")
    rows = _hourly(feeds.load_raw(spark, sf).select("event_id", "load", "area", "date"))
    first, second = rows.filter("area <> 'error'"), rows.filter("area = 'error'")
    K.write_once(first, lake, "electricity/load", "a")
    K.write_once(second, lake, "electricity/load", "b")
    K.write_once(second, lake, "electricity/load", "b")
    return S.read_lake(spark, lake, "electricity/load/").select("event_id", "load", "period_key")


@query("lake_existing_keys", "load_raw", sql="SELECT DISTINCT strftime(date, '%Y-%m-%d-%H') AS period_key FROM load_raw")
def _(spark, sf):
    lake = scratch(spark, "existing-keys")
    K.write_once(_hourly(feeds.load_raw(spark, sf)), lake, "electricity/load", "a")
    return K.existing_keys(spark, lake, "electricity/load")


# -- tables ------------------------------------------------------------------------

def _loadable(spark, sf):
    rows = feeds.load_raw(spark, sf).select("event_id", "date", "load", "area")
    return warehouse_cast(with_calendar_parts(rows, to_local("date"), ("day", "month", "year")), "date")


_TABLE_SQL = f"""SELECT event_id, CAST(date AS DATE) AS date, load, area, CAST(day({_B}) AS BIGINT) AS day,
CAST(month({_B}) AS BIGINT) AS month, CAST(year({_B}) AS BIGINT) AS year FROM load_raw"""


@query("append_partitioned", "load_raw", sql=_TABLE_SQL)
def _(spark, sf):
    path = scratch(spark, "append")
    rows = _loadable(spark, sf)
    K.append_partitioned(rows.filter("area <> 'click'"), path, "date")
    K.append_partitioned(rows.filter("area = 'click'"), path, "date")
    return spark.read.parquet(path)


@query("load_replaced", "load_raw", sql=_TABLE_SQL)
def _(spark, sf):
    path = scratch(spark, "load-replaced")
    rows = _loadable(spark, sf)
    for load_id, part in (("one", "area <> 'click'"), ("two", "area = 'click'"), ("two", "area = 'click'")):
        K.load_partitioned(rows.filter(part), path, "date", load_id)
    return spark.read.parquet(path).drop("load_id")


@query("ensure_table", "load_raw", sql=_TABLE_SQL)
def _(spark, sf):
    rows = _loadable(spark, sf)
    location = scratch(spark, "ensure-table")
    name = f"gridmill_{location.rsplit('-', 1)[-1]}"
    ordered = rows.select(*[c for c in rows.columns if c != "date"], "date")
    for _ in range(2):
        K.ensure_table(spark, name, ordered.schema, "date", location)
    K.balanced(ordered, "date").write.insertInto(name)
    return S.read_table(spark, name)


@query("publish_json", "load_raw", sql="""
SELECT date, load, key_id FROM (SELECT strftime(date, '%Y-%m-%d %H:%M:%S.%f') || '+00:00' AS date, load, key_id
FROM load_raw)""")
def _(spark, sf):
    folder = scratch(spark, "publish")
    files.load_messages(spark, sf, folder)
    return spark.read.text(folder).select(F.from_json("value", LOAD_MESSAGE).alias("m")).select("m.*")


@query("export_csv", "gas_raw", sql="SELECT event_id, date, open_price, close_price FROM gas_raw")
def _(spark, sf):
    folder = scratch(spark, "export")
    rows = feeds.gas_raw(spark, sf)
    K.export_csv(rows, folder)
    schema = T.StructType([f for f in rows.schema.fields])
    return spark.read.schema(schema).option("header", "true") \
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSSxxx").csv(folder)


@query("ledger_append", "lake_objects", sql="""
SELECT DISTINCT s3_key, TIMESTAMP '2024-01-17 15:30:00' AS processed_at FROM lake_objects""")
def _(spark, sf):
    path = scratch(spark, "ledger")
    keys = feeds.lake_objects(spark, sf)
    K.record_processed(path, keys, AS_OF, "load-0")
    K.record_processed(path, keys, AS_OF, "load-0")
    return K.read_ledger(spark, path)


@query("read_lake_days", "load_raw", sql="""
SELECT event_id, load FROM load_raw WHERE date >= TIMESTAMP '2024-01-10 00:00:00' AND date < TIMESTAMP '2024-01-13 00:00:00'""")
def _(spark, sf):
    lake = scratch(spark, "lake-days")
    K.write_once(_daily(feeds.load_raw(spark, sf).select("event_id", "date", "load")), lake, "electricity/load", "first")
    return S.read_lake(spark, lake, "electricity/load", days=("2024-01-10", "2024-01-12")).select("event_id", "load")


# -- retention ---------------------------------------------------------------------

_EXPIRED = "SELECT DISTINCT s3_key FROM processed_files WHERE processed_at < TIMESTAMP '1998-01-01 00:00:00'"


@query("retention_candidates", "processed_files", sql=_EXPIRED)
def _(spark, sf):
    return R.expired_objects(feeds.processed_files(spark, sf), AS_OF_LEDGER, 7)


@query("retention_batches", "processed_files", sql=f"""
SELECT s3_key, CAST((row_number() OVER (ORDER BY s3_key COLLATE "C") - 1) // 1000 AS BIGINT) AS batch FROM ({_EXPIRED})""")
def _(spark, sf):
    return R.delete_batches(R.expired_objects(feeds.processed_files(spark, sf), AS_OF_LEDGER, 7))


@query("purge_lake", "load_raw", sql="""
SELECT strftime(date, '%Y-%m-%d') AS period_key, date < TIMESTAMP '2024-01-10 00:00:00' AS deleted, count(*) AS rows
FROM load_raw GROUP BY 1, 2""")
def _(spark, sf):
    """Objects of old days are deleted, the others stay."""
    lake = scratch(spark, "purge-lake")
    rows = _daily(feeds.load_raw(spark, sf).select("event_id", "date"))
    K.write_once(rows, lake, "electricity/load", "first")
    day = F.regexp_extract("path", "period=([^/]+)/", 1).alias("day")
    old = S.list_objects(spark, lake, "electricity/load/").select(F.col("path").alias("s3_key"), day).filter("day < '2024-01-10'")
    report = R.purge(old.select("s3_key"), dry_run=False)
    gone = report.select(F.regexp_extract("s3_key", "period=([^/]+)/", 1).alias("period_key"), (F.col("status") == "deleted").alias("deleted")).distinct()
    gone = checkpointed(gone)
    left = S.read_lake(spark, lake, "electricity/load/").select("period_key").distinct()
    counts = rows.groupBy("period_key").agg(F.count(F.lit(1)).alias("rows"))
    there = gone.unionByName(left.withColumn("deleted", F.lit(False)))
    return counts.join(there, "period_key").select("period_key", "deleted", "rows")


@query("ttl_retained", "load_raw", sql=f"SELECT * FROM ({_TABLE_SQL}) WHERE date >= DATE '2024-01-10'")
def _(spark, sf):
    path = scratch(spark, "ttl")
    K.append_partitioned(_loadable(spark, sf), path, "date")
    return R.expire_partitions(spark.read.parquet(path), "date", AS_OF, 7)


@query("ttl_dropped", "load_raw", sql=f"SELECT * FROM ({_TABLE_SQL}) WHERE date >= DATE '2024-01-10'")
def _(spark, sf):
    path = scratch(spark, "ttl-drop")
    K.append_partitioned(_loadable(spark, sf), path, "date")
    R.drop_expired_partitions(spark, path, "date", AS_OF, 7)
    return spark.read.parquet(path)
