"""Files of the feeds, written from the given tables, as input of the source queries."""

from __future__ import annotations

import hashlib
import io
import zipfile
from collections.abc import Callable

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridmill import feeds
from gridmill.functions.timecols import iso_text
from gridmill.operators.retention import store_uri
from gridmill.sinks.lake import balanced, publish

STEP_HOURS = 6
ISSUE_STEPS = 240
STATIONS_PER_FILE = 100

# The same files as SQL: file number, station, issue, element and step inside the issue.
FORECAST_FILES_SQL = f""", placed AS (
 SELECT station, element, step, value, CAST(substr(station, 2) AS BIGINT) // {STATIONS_PER_FILE} AS bucket,
        step // {ISSUE_STEPS} AS issue FROM forecast_long)"""
STEP_TIME_SQL = f"(TIMESTAMP '2024-01-17 00:00:00' + to_hours(CAST(step * {STEP_HOURS} AS INTEGER)))"


def step_time(step):
    start = F.lit("2024-01-17 00:00:00").cast("timestamp")
    return F.timestamp_add("HOUR", step * STEP_HOURS, start)


def load_messages(spark: SparkSession, sf: str, folder: str, rows: DataFrame | None = None, mode: str = "append") -> None:
    records = (feeds.load_raw(spark, sf) if rows is None else rows).select(iso_text("date").alias("date"), "load", "key_id")
    publish(records, folder, mode)


def gas_messages(spark: SparkSession, sf: str, folder: str) -> None:
    records = feeds.gas_raw(spark, sf).select(
        iso_text("date").alias("date"), "open_price", "close_price",
        F.concat(F.lit("record_"), F.col("event_id").cast("string")).alias("key_id"))
    publish(records, folder)


def climate_text(rows: DataFrame, folder: str, swapped: bool = False) -> None:
    """Station tables as published: ``;``, latin-1, padded numbers; ``swapped`` exchanges two columns."""
    table = rows.select(
        F.format_string("%11d", "stations_id").alias("STATIONS_ID"),
        F.date_format("ts", "yyyyMMddHH").alias("MESS_DATUM"),
        F.lit("    3").alias("QN_9"),
        F.concat(F.lit("  "), F.col("tt_tu").cast("string")).alias("TT_TU"),
        F.lit("   55.0").alias("RF_TU"),
        F.col("eor"))
    if swapped:
        table = table.select("STATIONS_ID", "MESS_DATUM", "TT_TU", "QN_9", "RF_TU", "eor")
    (table.write.option("sep", ";").option("encoding", "ISO-8859-1").option("header", "true")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(folder))


def climate_archives(rows: DataFrame, folder: str) -> None:
    """Station tables as zip archives with a data member and another one; a station may have several.

    Rows of a station go to one task, or to a few if they are many, so there are about as many archives as stations. A task
    writes the rows it is given at a time, so no station has to fit into one. Names follow from the task, so one that is
    repeated replaces its archives.
    """
    text = rows.select(
        F.format_string("%05d", "stations_id").alias("station"),
        F.concat_ws(";", F.format_string("%11d", "stations_id"), F.date_format("ts", "yyyyMMddHH"), F.lit("    3"),
                    F.concat(F.lit("  "), F.col("tt_tu").cast("string")), F.lit("   55.0"), F.col("eor")).alias("line"))

    def write(parts):
        task, put = TaskContext.get().partitionId(), _zips(folder)
        for n, part in enumerate(parts):
            for station, lines in part.groupby("station")["line"]:
                body = "\r\n".join(["STATIONS_ID;MESS_DATUM;QN_9;TT_TU;RF_TU;eor", *lines]) + "\r\n"
                put(f"stundenwerte_TU_{station}_{task}_{n}.zip", {
                    f"Metadaten_Geographie_{station}.txt": "Größe;Höhe\r\n".encode("latin-1"),
                    f"produkt_tu_stunde_20240101_20240131_{station}.txt": body.encode("latin-1")})
            yield pd.DataFrame({"n": [len(part)]})

    # The archives are written by this action.
    balanced(text, "station").sortWithinPartitions("station", "line").mapInPandas(write, "n long").agg(F.sum("n")).collect()


def as_kmz(folder: str, target: str, spark: SparkSession) -> None:
    """Every file of a folder as a KMZ archive of one member."""
    def write(parts):
        put = _zips(target)
        for part in parts:
            for path, content in zip(part["path"], part["content"], strict=True):
                name = hashlib.sha256(path.encode()).hexdigest()[:24]
                put(f"{name}.kmz", {f"{name}.kml": content})
            yield pd.DataFrame({"n": [len(part)]})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(folder).select("path", "content")
    files.mapInPandas(write, "n long").agg(F.sum("n")).collect()


def _zips(folder: str) -> Callable[[str, dict[str, bytes]], None]:
    """What writes an archive of a folder, whose store is opened once."""
    root, base = store_uri(folder)
    store = fs.FileSystem.from_uri(root)[0]
    store.create_dir(base, recursive=True)

    def put(name: str, members: dict[str, bytes]) -> None:
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
            for member, content in members.items():
                z.writestr(member, content)
        with store.open_output_stream(f"{base}/{name}") as out:
            out.write(held.getvalue())

    return put


def forecast_files(long: DataFrame, folder: str, whole: bool = False) -> None:
    """One KML file per 100 stations and issue. A series holds at most one issue; ``whole`` fills it up to the file's last step."""
    placed = long.withColumns({
        "bucket": F.floor(F.substring("station", 2, 20).cast("long") / STATIONS_PER_FILE),
        "issue": F.floor(F.col("step") / ISSUE_STEPS),
    })
    word = F.coalesce(F.col("value").cast("string"), F.lit("-"))
    series = placed.groupBy("bucket", "issue", "station", "element").agg(
        F.array_sort(F.collect_list(F.struct("step", word.alias("word")))).alias("points"))
    # An issue may start without every station, its times still start at its first step.
    span = placed.groupBy("bucket", "issue").agg(F.max("step").alias("last"))
    words = F.transform("points", lambda p: p["word"])
    if whole:
        series = series.join(span, ["bucket", "issue"])
        missing = F.col("last") - F.col("issue") * ISSUE_STEPS + 1 - F.size("points")
        words = F.concat(words, F.array_repeat(F.lit("-"), missing.cast("int")))
    forecast = F.concat(
        F.lit('<dwd:Forecast dwd:elementName="'), F.col("element"), F.lit('"><dwd:value>   '),
        F.array_join(words, "   "), F.lit("</dwd:value></dwd:Forecast>"))
    number = F.substring("station", 2, 20)
    placemarks = (
        series.groupBy("bucket", "issue", "station")
        .agg(F.array_join(F.array_sort(F.collect_list(forecast)), "").alias("body"))
        .select("bucket", "issue", F.lit(1).alias("place"), F.concat(
            F.lit("<kml:Placemark><kml:name>"), number, F.lit("</kml:name><kml:description>"), F.col("station"),
            F.lit("</kml:description><kml:ExtendedData>"), F.col("body"),
            F.lit("</kml:ExtendedData><kml:Point><kml:coordinates>"), number,
            F.lit(".5,48.25,100.0</kml:coordinates></kml:Point></kml:Placemark>")).alias("line"))
    )
    steps = F.transform(F.sequence(F.col("issue") * ISSUE_STEPS, F.col("last").cast("long")), lambda s: F.concat(
        F.lit("<dwd:TimeStep>"), F.date_format(step_time(s.cast("int")), "yyyy-MM-dd'T'HH:mm:ss'.000Z'"),
        F.lit("</dwd:TimeStep>")))
    head = span.select("bucket", "issue", F.lit(0).alias("place"), F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><kml:kml xmlns:kml="http://www.opengis.net/kml/2.2" '
              'xmlns:dwd="https://opendata.dwd.de/weather/lib/pointforecast_dwd_extension_V1_0.xsd">'
              "<kml:Document><kml:ExtendedData><dwd:ProductDefinition><dwd:ForecastTimeSteps>"),
        F.array_join(steps, ""),
        F.lit("</dwd:ForecastTimeSteps></dwd:ProductDefinition></kml:ExtendedData>")).alias("line"))
    foot = span.select("bucket", "issue", F.lit(2).alias("place"), F.lit("</kml:Document></kml:kml>").alias("line"))
    lines = head.unionAll(placemarks).unionAll(foot)
    # A file is a row, of at most 100 stations by 240 steps. Lines that are only repartitioned may be dealt anew when a join before
    # them turns out to be small, and a file would come in parts.
    (lines.groupBy("bucket", "issue").agg(F.array_sort(F.collect_list(F.struct("place", "line"))).alias("lines"))
     .select(F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("text"), "bucket", "issue")
     .write.partitionBy("bucket", "issue").text(folder))
