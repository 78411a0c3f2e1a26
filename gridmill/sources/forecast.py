"""Station forecasts: KML files, each read by as many tasks as its size needs, or single-member KMZ archives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridmill.functions.columns import parse_coordinates, split_series
from gridmill.functions.timecols import parse_step
from gridmill.operators.quality import forecast_problem
from gridmill.operators.skew import keyed_join
from gridmill.operators.stations import attach_steps, for_stations
from gridmill.sources import archives

# Element names of the forecast files.
PLACEMARK_TAG = "kml:Placemark"
STEPS_TAG = "dwd:ForecastTimeSteps"
_PLACEMARK = (
    "`kml:name` string, `kml:description` string, `kml:Point` struct<`kml:coordinates`: string>, "
    "`kml:ExtendedData` struct<`dwd:Forecast`: array<struct<`_dwd:elementName`: string, `dwd:value`: string>>>"
)
_STEPS = "`dwd:TimeStep` array<string>"


def _xml(spark: SparkSession, paths, tag: str, schema: str) -> DataFrame:
    """Elements of plain files. A file is read as records that end with a placemark, so a large one is cut over many tasks.

    The forecast times stand before the first placemark, in the record that ends with it.
    """
    closing = f"</{PLACEMARK_TAG}>"
    records = spark.read.option("lineSep", closing).text(paths).select(
        F.concat("value", F.lit(closing)).alias("value"), F.col("_metadata.file_path").alias("file"))
    start, end = F.locate(f"<{tag}", F.col("value")), F.locate(f"</{tag}>", F.col("value"))
    fragment = F.substr("value", start, end - start + len(tag) + 3)
    return (records.filter((start > 0) & (end > start)).select("file", F.from_xml(fragment, schema, {"rowTag": tag}).alias("x"))
            .select("x.*", "file"))


def _zipped(spark: SparkSession, paths, tag: str, schema: str) -> DataFrame:
    fragments = archives.xml_fragments(archives.archives(spark, paths), [tag])
    return (fragments.select("file", F.from_xml("fragment", schema, {"rowTag": tag}).alias("x"))
            .select("x.*", "file"))


def read_placemarks(spark: SparkSession, paths: str | list[str], zipped: bool = False) -> DataFrame:
    """One row per station and file, values still as text: see ``malformed_rows``."""
    raw = (_zipped if zipped else _xml)(spark, paths, PLACEMARK_TAG, _PLACEMARK)
    return raw.select(
        "file",
        F.col("`kml:description`").alias("station"),
        F.col("`kml:name`").alias("name"),
        F.col("`kml:Point`.`kml:coordinates`").alias("coordinates"),
        F.transform(
            F.col("`kml:ExtendedData`.`dwd:Forecast`"),
            lambda f: F.struct(f["_dwd:elementName"].alias("element"), f["dwd:value"].alias("text")),
        ).alias("elements"),
    )


def read_steps(spark: SparkSession, paths: str | list[str], zipped: bool = False) -> DataFrame:
    """Forecast times, one row per file."""
    raw = (_zipped if zipped else _xml)(spark, paths, STEPS_TAG, _STEPS)
    return raw.select("file", F.transform("`dwd:TimeStep`", parse_step).alias("steps"))


def station_table(placemarks: DataFrame) -> DataFrame:
    """Station name and position."""
    return placemarks.select("station", "name", parse_coordinates("coordinates").alias("p")) \
        .select("station", "name", "p.lat", "p.lng", "p.ele")


def forecast_long(placemarks: DataFrame, strict: bool = False) -> DataFrame:
    """One row per station, element and step."""
    return (
        placemarks.select("file", "station", F.explode("elements").alias("e"))
        .select("file", "station", F.col("e.element").alias("element"),
                F.posexplode(split_series("e.text", strict=strict)).alias("step", "value"))
    )


def step_table(steps: DataFrame) -> DataFrame:
    return steps.select("file", F.posexplode("steps").alias("step", "forecast_time"))


def forecast_wide(placemarks: DataFrame, steps: DataFrame, elements: Sequence[str],
                  stations=None, strict: bool = False) -> DataFrame:
    """One row per station and forecast time, one column per element.

    A placemark already holds all series of its station, so they are zipped
    inside the row and nothing is grouped. Values beyond the forecast times
    have no time. ``strict`` fails on the first malformed placemark instead.
    """
    def series(element: str):
        # A repeated element counts with its last series.
        matching = F.filter("elements", lambda e: e["element"] == element)
        values = split_series(F.try_element_at(matching, F.lit(-1))["text"])
        return F.coalesce(values, F.array().cast("array<double>")).alias(element)

    chosen = for_stations(placemarks, stations)
    rows = keyed_join(chosen, steps, ["file"], "left")
    times = F.col("steps")
    if strict:
        problem = forecast_problem("steps")
        message = F.concat(F.lit("malformed forecast ("), problem, F.lit(") of station "), F.coalesce("station", F.lit("?")), F.lit(" in "), F.col("file"))
        times = F.when(problem.isNotNull(), F.raise_error(message).cast("array<timestamp>")).otherwise(times)
    zipped = rows.select("file", "station", F.coalesce(times, F.array().cast("array<timestamp>")).alias("forecast_time"), *[series(e) for e in elements])
    return (zipped.select("file", "station", F.explode(F.arrays_zip("forecast_time", *elements)).alias("r"))
            .select("file", "station", "r.forecast_time", *[f"r.{e}" for e in elements]))


def read_forecast_xml(spark: SparkSession, paths: str | list[str], stations=None, zipped: bool = False) -> DataFrame:
    """Forecast values with their times, long form."""
    placemarks = for_stations(read_placemarks(spark, paths, zipped), stations)
    return attach_steps(forecast_long(placemarks), step_table(read_steps(spark, paths, zipped)))
