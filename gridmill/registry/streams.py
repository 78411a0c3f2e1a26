"""Streaming operators: files derived from the given tables, run to the end, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmill import feeds
from gridmill.feeds import AS_OF
from gridmill.functions.timecols import iso_text
from gridmill.registry import feeds as files
from gridmill.registry.base import query
from gridmill.registry.ingest import lake_rows, table_sql
from gridmill.registry.shape import ADVANCE_SQL
from gridmill.schemas import LOAD_MESSAGE
from gridmill.session import scratch
from gridmill.sinks.lake import late_counts, publish, write_once
from gridmill.sources.lake import read_lake
from gridmill.sources.messages import RAW, read_messages
from gridmill.sources.topic import commit_group
from gridmill.streaming import feeds as T, sinks as K
from gridmill.streaming.highwater import stream_high_water
from gridmill.streaming.hours import stream_hours


@query("stream_read_messages", "load_raw", sql="""
SELECT CASE WHEN area <> 'error' THEN strftime(date, '%Y-%m-%d %H:%M:%S.%f') || '+00:00' END AS date,
       CASE WHEN area <> 'error' THEN load END AS load, CASE WHEN area <> 'error' THEN key_id END AS key_id,
       area = 'error' AS malformed FROM load_raw""")
def _(spark, sf):
    work = scratch(spark, "read-messages")
    rows = feeds.load_raw(spark, sf)
    files.load_messages(spark, sf, f"{work}/in", rows.filter("area <> 'error'"))
    # Cut off messages arrive in between.
    cut = rows.filter("area = 'error'").select(F.concat(F.lit('{"date": "'), F.col("date").cast("string")).alias("value"))
    cut.write.mode("append").text(f"{work}/in")
    T.to_files(read_messages(spark, f"{work}/in", LOAD_MESSAGE), f"{work}/out", f"{work}/checkpoint")
    bad = F.col(RAW).isNotNull()
    return spark.read.parquet(f"{work}/out").select(
        *[F.when(~bad, F.col(c)).alias(c) for c in ("date", "load", "key_id")], bad.alias("malformed"))


_PARTS = """CAST(day(date) AS TINYINT) AS day, CAST(month(date) AS TINYINT) AS month, CAST(year(date) AS SMALLINT) AS year,
CAST(hour(date) AS TINYINT) AS hour, CAST(minute(date) AS TINYINT) AS minute"""


@query("stream_load", "load_raw", sql=f"SELECT date, CAST(load AS FLOAT) AS load, {_PARTS} FROM load_raw")
def _(spark, sf):
    work = scratch(spark, "stream-load")
    files.load_messages(spark, sf, f"{work}/in")
    T.to_files(T.stream_load(spark, f"{work}/in"), f"{work}/out", f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/out")


@query("stream_load_with_bad", "load_raw", sql=f"""
, l AS (SELECT date_trunc('second', date) AS date, load, key_id, area FROM load_raw)
SELECT date, CAST(load AS FLOAT) AS load, {_PARTS}, NULL AS problem, NULL AS message FROM l WHERE area NOT IN ('error', 'click')
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'no such JSON object', '{{"date": "' || strftime(date, '%Y-%m-%d %H:%M:%S') FROM l WHERE area = 'error'
UNION ALL SELECT date, NULL, {_PARTS}, 'no value in load', '{{"date":"' || strftime(date, '%Y-%m-%d %H:%M:%S') || '+00:00"}}' FROM l WHERE area = 'click'""")
def _(spark, sf):
    """Good messages and bad ones in one stream: nothing is lost on the way."""
    work = scratch(spark, "load-with-bad")
    rows = feeds.load_raw(spark, sf).withColumn("date", F.date_trunc("second", "date"))
    files.load_messages(spark, sf, f"{work}/in", rows.filter("area NOT IN ('error', 'click')"))
    stamp = F.date_format("date", "yyyy-MM-dd HH:mm:ss")
    rows.filter("area = 'error'").select(F.concat(F.lit('{"date": "'), stamp).alias("value")).write.mode("append").text(f"{work}/in")
    rows.filter("area = 'click'").select(F.concat(F.lit('{"date":"'), stamp, F.lit('+00:00"}')).alias("value")).write.mode("append").text(f"{work}/in")
    T.to_files(T.stream_load(spark, f"{work}/in", bad="keep"), f"{work}/out", f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/out")


@query("stream_topic", "load_raw", sql=f"""
SELECT reader, date, CAST(load AS FLOAT) AS load, {_PARTS} FROM load_raw, (VALUES ('one'), ('two')) r(reader)""")
def _(spark, sf):
    """A topic read by two consumer groups, the first of them between deliveries and then with a new checkpoint."""
    work = scratch(spark, "topic").removeprefix("file://").replace("file:/", "/")
    rows = feeds.load_raw(spark, sf)
    records = rows.select(iso_text("date").alias("date"), "load", "key_id", "area")
    for n, part in enumerate(("area <> 'error'", "area = 'error'")):
        publish(records.filter(part).drop("area"), {"topic": f"{work}/topic"})
        read = T.to_files(T.stream_load(spark, {"topic": f"{work}/topic", "group": "one"}), f"{work}/out/reader=one/part={n}", f"{work}/one-{n}")
        commit_group(read, f"{work}/topic", "one")
    T.to_files(T.stream_load(spark, {"topic": f"{work}/topic", "group": "two"}), f"{work}/out/reader=two/part=0", f"{work}/two")
    parts = [spark.read.parquet(f"{work}/out/reader={r}/part={n}").withColumn("reader", F.lit(r)) for r, n in (("one", 0), ("one", 1), ("two", 0))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("stream_gas", "gas_raw", sql=f"""
SELECT date, CAST(open_price AS FLOAT) AS open_price, CAST(close_price AS FLOAT) AS close_price, {_PARTS} FROM gas_raw""")
def _(spark, sf):
    work = scratch(spark, "stream-gas")
    files.gas_messages(spark, sf, f"{work}/in")
    T.to_files(T.stream_gas(spark, f"{work}/in"), f"{work}/out", f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/out")


@query("stream_quarantine", "load_raw", sql="""
SELECT 'no such JSON object' AS problem, '{"date": "' || strftime(date, '%Y-%m-%d %H:%M:%S') AS message FROM load_raw WHERE area = 'error'
UNION ALL SELECT 'no time in date', '{"date":"never","load":1.0,"key_id":"' || key_id || '"}' FROM load_raw WHERE area = 'click'""")
def _(spark, sf):
    """Cut off messages and messages without a time, among good ones."""
    work = scratch(spark, "quarantine")
    rows = feeds.load_raw(spark, sf)
    files.load_messages(spark, sf, f"{work}/in", rows.filter("area = 'view'"))
    cut = F.concat(F.lit('{"date": "'), F.date_format("date", "yyyy-MM-dd HH:mm:ss"))
    rows.filter("area = 'error'").select(cut.alias("value")).write.mode("append").text(f"{work}/in")
    untimed = rows.filter("area = 'click'").select(F.lit("never").alias("date"), F.lit(1.0).cast("double").alias("load"), "key_id")
    publish(untimed, f"{work}/in")
    K.land_messages(spark, f"{work}/in", LOAD_MESSAGE, ["load"], ("day", "month", "year", "hour", "minute"), f"{work}/landed",
                    f"{work}/quarantine", f"{work}/checkpoint")
    return K.read_quarantine(spark, f"{work}/quarantine")


@query("stream_closed_hours", "load_raw", sql="""
SELECT date_trunc('hour', date) AS hour_start, count(*) AS rows,
       CAST(sum(CAST(load AS DECIMAL(18,2))) AS DOUBLE) AS load
FROM load_raw GROUP BY 1
HAVING date_trunc('hour', date) + INTERVAL 1 HOUR <= (SELECT max(date) FROM load_raw) - INTERVAL 1 HOUR""")
def _(spark, sf):
    work = scratch(spark, "closed-hours")
    feeds.load_raw(spark, sf).write.parquet(f"{work}/in")
    schema = "event_id BIGINT, date TIMESTAMP, load DOUBLE, key_id STRING, area STRING"
    rows = spark.readStream.schema(schema).parquet(f"{work}/in")
    T.to_files(T.stream_closed_hours(rows, "date", "load"), f"{work}/out", f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/out")


@query("stream_hours_with_late", "load_raw", sql="""
, h AS (SELECT date_trunc('hour', date) AS hour_start, CAST(load AS DECIMAL(18,2)) AS load, area = 'error' AS second FROM load_raw),
  w AS (SELECT (max(date) FILTER (WHERE area <> 'error')) - INTERVAL 1 HOUR AS first, max(date) - INTERVAL 1 HOUR AS last FROM load_raw),
  r AS (SELECT h.*, second AND hour_start + INTERVAL 1 HOUR <= first AS late, last FROM h, w)
SELECT hour_start, CAST(count_if(NOT late) AS BIGINT) AS rows, CAST(count_if(late) AS BIGINT) AS late_rows,
       coalesce(CAST(sum(load) FILTER (WHERE NOT late) AS DOUBLE), 0) AS load
FROM r WHERE late OR hour_start + INTERVAL 1 HOUR <= last GROUP BY hour_start""")
def _(spark, sf):
    """Two deliveries: of the second, what belongs to hours closed by then is given as late."""
    work = scratch(spark, "hours-with-late")
    rows = feeds.load_raw(spark, sf).select("date", "load", "area")
    for part in ("area <> 'error'", "area = 'error'"):
        rows.filter(part).write.mode("append").parquet(f"{work}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{work}/in")
        T.to_files(stream_hours(stream, "date", "load"), f"{work}/out", f"{work}/checkpoint")
    found = spark.read.parquet(f"{work}/out")
    return found.groupBy("hour_start").agg(
        F.coalesce(F.sum(F.when(~F.col("late"), F.col("rows"))), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("late"), F.col("rows"))), F.lit(0)).alias("late_rows"),
        F.coalesce(F.sum(F.when(~F.col("late"), F.col("load"))), F.lit(0.0)).alias("load"))


@query("stream_write_once", "load_raw", sql="""
, keyed AS (SELECT area = 'error' AS second, strftime((date AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin',
                   '%Y-%m-%d-%H') AS period_key FROM load_raw),
  first AS (SELECT DISTINCT period_key FROM keyed WHERE NOT second)
SELECT k.period_key, CAST(count_if(NOT second OR f.period_key IS NULL) AS BIGINT) AS rows,
       CAST(count_if(second AND f.period_key IS NOT NULL) AS BIGINT) AS late_rows
FROM keyed k LEFT JOIN first f ON f.period_key = k.period_key GROUP BY k.period_key""")
def _(spark, sf):
    work = scratch(spark, "stream-write-once")
    rows = lake_rows(spark, sf)
    for part in ("area <> 'error'", "area = 'error'"):
        rows.filter(part).write.mode("append").parquet(f"{work}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{work}/in")
        K.stream_write_once(stream, f"{work}/lake", "electricity/load", f"{work}/checkpoint")
    written = read_lake(spark, f"{work}/lake", "electricity/load/").groupBy("period_key") \
        .agg(F.count(F.lit(1)).alias("rows"))
    late = late_counts(spark, f"{work}/lake", "electricity/load").groupBy("period_key") \
        .agg(F.sum("late_rows").alias("late_rows"))
    return written.join(late, "period_key", "left").select(
        "period_key", "rows", F.coalesce("late_rows", F.lit(0)).alias("late_rows"))


@query("stream_advance_only", "publish_raw", sql=ADVANCE_SQL.format(where=""))
def _(spark, sf):
    work = scratch(spark, "stream-advance")
    rows = feeds.publish_raw(spark, sf)
    # Two deliveries in order; the marks of the first one carry over to the second.
    early = F.col("seq") <= F.lit(rows.agg(F.expr("max(seq) div 2")).first()[0])
    for part in (early, ~early):
        rows.filter(part).write.mode("append").parquet(f"{work}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{work}/in")
        K.stream_advance_only(stream, f"{work}/out", f"{work}/marks", f"{work}/checkpoint", ["seq"], "date", ["source_id"])
    return spark.read.parquet(f"{work}/out").drop("batch_id")


@query("stream_high_water", "publish_raw", sql=ADVANCE_SQL.format(where=""))
def _(spark, sf):
    """The marks as keyed state: two deliveries in order, the second after a restart."""
    work = scratch(spark, "stream-high-water")
    rows = feeds.publish_raw(spark, sf)
    early = F.col("seq") <= F.lit(rows.agg(F.expr("max(seq) div 2")).first()[0])
    for part in (early, ~early):
        rows.filter(part).write.mode("append").parquet(f"{work}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{work}/in")
        T.to_files(stream_high_water(stream, ["seq"], "date", ["source_id"]), f"{work}/out", f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/out").drop("notice")


@query("stream_load_files", "load_raw", sql=table_sql())
def _(spark, sf):
    lake, work = scratch(spark, "load-files-lake"), scratch(spark, "load-files")
    rows = lake_rows(spark, sf).withColumn("period_key", F.date_format("date", "yyyy-MM-dd"))
    schema = rows.drop("period_key").schema
    for batch, part in (("a", "area <> 'error'"), ("b", "area = 'error'")):
        keyed = rows.filter(part).withColumn("period_key", F.concat_ws("-", "period_key", F.lit(batch)))
        write_once(keyed, lake, "electricity/load", batch)
        K.stream_load_files(spark, lake, "electricity/load", schema, f"{work}/table", f"{work}/ledger",
                            f"{work}/checkpoint", "date", AS_OF)
    return K.read_loaded(spark, f"{work}/table")
