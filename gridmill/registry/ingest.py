"""Ledger joins and the publisher."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import functions as F

from gridmill import feeds
from gridmill.feeds import AS_OF
from gridmill.functions.timecols import to_local, with_calendar_parts
from gridmill.operators import ingest as I
from gridmill.registry.base import berlin, query
from gridmill.session import scratch
from gridmill.plans.jobs import publish_from_lake, publish_incremental
from gridmill.sinks.lake import write_once
from gridmill.streaming.sinks import load_incremental, read_loaded


@query("ledger_unprocessed", "lake_objects", "processed_files", sql="""
SELECT s3_key FROM lake_objects WHERE s3_key NOT IN (SELECT s3_key FROM processed_files)""")
def _(spark, sf):
    return I.unprocessed(feeds.lake_objects(spark, sf), feeds.processed_files(spark, sf))


@query("ledger_count", "processed_files", sql="""
SELECT count(*) AS count FROM processed_files WHERE s3_key = 'electricity/load/1.parquet'""")
def _(spark, sf):
    return I.ledger_count(feeds.processed_files(spark, sf), "electricity/load/1.parquet")


PARTS = ("day", "month", "year", "hour", "minute")


def lake_rows(spark, sf):
    rows = feeds.load_raw(spark, sf).select("event_id", "date", F.col("load").cast("float").alias("load"), "area")
    return with_calendar_parts(rows, to_local("date"), PARTS) \
        .withColumn("period_key", F.date_format(to_local("date"), "yyyy-MM-dd-HH"))


def table_sql(extra: str = "") -> str:
    b = berlin("date")
    parts = ", ".join(f"CAST({p}({b}) AS BIGINT) AS {p}" for p in PARTS)
    return f"""SELECT event_id, CAST(date AS DATE) AS date, CAST(CAST(load AS FLOAT) AS DOUBLE) AS load, area, {parts}
    FROM load_raw {extra}"""


@query("load_incremental", "load_raw", sql=table_sql())
def _(spark, sf):
    # Two rounds: the second one must load only the objects that came after the first.
    lake, work = scratch(spark, "incremental-lake"), scratch(spark, "incremental")
    rows = lake_rows(spark, sf)
    early = F.col("date") < F.lit("2024-01-15").cast("timestamp")
    schema = rows.drop("period_key").schema
    for batch, part in (("a", early), ("b", ~early)):
        write_once(rows.filter(part), lake, "electricity/load", batch)
        load_incremental(spark, lake, "electricity/load", schema, f"{work}/table", f"{work}/state", "date", AS_OF)
    return read_loaded(spark, f"{work}/table")


@query("load_failures", "load_raw", sql=table_sql())
def _(spark, sf):
    """A batch whose rows have no date is not recorded; written again in order, it is loaded by the next run, and only then."""
    lake, work = scratch(spark, "failures-lake"), scratch(spark, "failures")
    rows = lake_rows(spark, sf)
    schema = rows.drop("period_key").schema
    go = lambda: load_incremental(spark, lake, "electricity/load", schema, f"{work}/table", f"{work}/state", "date", AS_OF)
    late = rows.filter("area = 'error'").withColumn("period_key", F.concat("period_key", F.lit("-late")))
    write_once(rows.filter("area <> 'error'"), lake, "electricity/load", "a")
    write_once(late.withColumn("date", F.lit(None).cast("timestamp")), lake, "electricity/load", "b")
    go()
    write_once(late, lake, "electricity/load", "b")
    go()
    return read_loaded(spark, f"{work}/table")


@query("load_two_feeds", "load_raw", sql=table_sql())
def _(spark, sf):
    """Two feeds into one table, one of them with a batch written and loaded twice: every row once."""
    lake, work = scratch(spark, "feeds-lake"), scratch(spark, "feeds")
    rows = lake_rows(spark, sf)
    schema = rows.drop("period_key").schema
    for feed, part in (("electricity/load", "area <> 'error'"), ("electricity/other", "area = 'error'"), ("electricity/load", "area <> 'error'")):
        write_once(rows.filter(part), lake, feed, "a")
        load_incremental(spark, lake, feed, schema, f"{work}/table", f"{work}/{feed}", "date", AS_OF)
    return read_loaded(spark, f"{work}/table")


@query("load_two_writers", "load_raw", sql=table_sql())
def _(spark, sf):
    """Two writers of one feed at once, with hours in common, and a load that finds what both have committed."""
    lake, work = scratch(spark, "writers-lake"), scratch(spark, "writers")
    rows = lake_rows(spark, sf)
    parts = {"a": F.col("period_key") < "2024-01-20", "b": F.col("period_key") >= "2024-01-10"}
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda x: write_once(rows.filter(x[1]), lake, "electricity/load", x[0]), parts.items()))
    load_incremental(spark, lake, "electricity/load", rows.drop("period_key").schema, f"{work}/table", f"{work}/state", "date", AS_OF)
    return read_loaded(spark, f"{work}/table")


@query("publish_old_run", "publish_raw", sql="""
, ahead AS (SELECT * FROM (SELECT *, max(date) OVER (PARTITION BY source_id ORDER BY seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM publish_raw) WHERE top IS NULL OR date > top)
SELECT source_id, strftime(date, '%Y-%m-%d %H:%M:%S') || '+00:00' AS date, load,
       'record_' || CAST(row_number() OVER (PARTITION BY source_id ORDER BY seq) - 1 AS VARCHAR) AS key_id FROM ahead""")
def _(spark, sf):
    """Twelve runs, then the second one again: the same messages, numbered as before."""
    folder = scratch(spark, "publish-old-run")
    rows = feeds.publish_raw(spark, sf)
    half = rows.agg(F.expr("max(seq) div 2")).first()[0]
    for run in [*range(12), 1]:
        part = rows if run else rows.filter(F.col("seq") <= half)
        publish_incremental(part, f"{folder}/sent", f"{folder}/state", run, ["seq"], "date", ["date", "load"], ["source_id"])
    schema = "source_id BIGINT, date STRING, load DOUBLE, key_id STRING"
    return spark.read.text(f"{folder}/sent").select(F.from_json("value", schema).alias("m")).select("m.*")


@query("publish_incremental", "publish_raw", sql="""
, ahead AS (SELECT * FROM (SELECT *, max(date) OVER (PARTITION BY source_id ORDER BY seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
            FROM publish_raw WHERE date > TIMESTAMP '1997-01-01') WHERE top IS NULL OR date > top)
SELECT source_id, strftime(date, '%Y-%m-%d %H:%M:%S') || '+00:00' AS date, load,
       'record_' || CAST(row_number() OVER (PARTITION BY source_id ORDER BY seq) - 1 AS VARCHAR) AS key_id FROM ahead""")
def _(spark, sf):
    folder = scratch(spark, "publish-incremental")
    rows = feeds.publish_raw(spark, sf)
    start = F.lit(datetime(1997, 1, 1, tzinfo=timezone.utc)).alias("date")
    marks = rows.select("source_id", start).distinct()
    # Published twice from the stored marks: the second run has nothing left to send.
    for run in (0, 1):
        publish_incremental(rows, f"{folder}/sent", f"{folder}/marks", run, ["seq"], "date", ["date", "load"],
                            ["source_id"], marks)
    schema = "source_id BIGINT, date STRING, load DOUBLE, key_id STRING"
    return spark.read.text(f"{folder}/sent").select(F.from_json("value", schema).alias("m")).select("m.*")


@query("publish_from_lake", "publish_raw", sql="""
, late AS (SELECT *, date >= TIMESTAMP '1996-01-01' AS second FROM publish_raw),
  ahead AS (SELECT * FROM (SELECT *, max(date) OVER (PARTITION BY source_id ORDER BY second, seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM late) WHERE top IS NULL OR date > top)
SELECT source_id, strftime(date, '%Y-%m-%d %H:%M:%S') || '+00:00' AS date, load,
       'record_' || CAST(row_number() OVER (PARTITION BY source_id ORDER BY second, seq) - 1 AS VARCHAR) AS key_id FROM ahead""")
def _(spark, sf):
    """Two batches of a lake feed, a run after each: the second run reads the files that zones and marks leave."""
    folder, lake = scratch(spark, "publish-from-lake"), scratch(spark, "publish-lake")
    rows = feeds.publish_raw(spark, sf)
    # Folders by month: years of orders in one batch.
    keyed = rows.withColumn("period_key", F.concat_ws("-", F.date_format("date", "yyyy-MM-'01'"), "source_id", "seq"))
    second = F.col("date") >= F.lit("1996-01-01").cast("timestamp")
    for run, part in enumerate((~second, second)):
        write_once(keyed.filter(part), lake, "history", f"b{run}", zones=(["source_id"], "date"))
        publish_from_lake(spark, lake, "history", rows.schema, f"{folder}/sent", f"{folder}/marks", run, ["seq"], "date",
                          ["date", "load"], ["source_id"])
    schema = "source_id BIGINT, date STRING, load DOUBLE, key_id STRING"
    return spark.read.text(f"{folder}/sent").select(F.from_json("value", schema).alias("m")).select("m.*")


@query("merged_marks", "publish_raw", sql="""
SELECT source_id, greatest(max(date), TIMESTAMP '1997-01-01') AS date FROM publish_raw GROUP BY source_id""")
def _(spark, sf):
    rows = feeds.publish_raw(spark, sf)
    start = F.lit(datetime(1997, 1, 1, tzinfo=timezone.utc)).alias("date")
    marks = rows.select("source_id", start).distinct()
    return I.merged_marks(marks, rows, "date", ["source_id"])
