"""Checks over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from gridmill.functions.columns import quoted
from gridmill.schemas import WEATHER_PARAMETERS


def check_partition_column(schema: T.StructType, partition_col: str) -> None:
    """What a table must have before it can be loaded."""
    fields = {f.name: f.dataType for f in schema.fields}
    if partition_col not in fields:
        raise ValueError(f"partition column {partition_col!r} does not exist")
    if not isinstance(fields[partition_col], (T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"partition column {partition_col!r} must be a timestamp")
    missing = {"year", "month"} - fields.keys()
    if missing:
        raise ValueError(f"clustering columns are missing: {', '.join(sorted(missing))}")


def partition_audit(df: DataFrame, partition_col: str, by: str = "file_path") -> DataFrame:
    """Rows per file, those without a date, and those whose year or month disagrees with the date."""
    check_partition_column(df.schema, partition_col)
    date = quoted(partition_col)
    differs = (F.year(date) != F.col("year")) | (F.month(date) != F.col("month")) \
        | F.col("year").isNull() | F.col("month").isNull()
    return df.groupBy(quoted(by)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(date.isNull()).alias("null_dates"),
        F.count_if(date.isNotNull() & differs).alias("mismatched"),
    )


def unknown_parameters(df: DataFrame, col: str = "parameter") -> DataFrame:
    """Rows whose weather parameter is not in the catalogue (a fixed list of seven)."""
    return df.filter(quoted(col).isNull() | ~quoted(col).isin(list(WEATHER_PARAMETERS)))


def forecast_problem(steps: str | None = None) -> Column:
    """The first thing that is wrong with a placemark, or null. ``steps`` names the column of forecast times, if at hand."""
    def empty(c):
        return c.isNull() | (c == "")

    coords = F.split("coordinates", ",")
    bad_number = F.exists(coords, lambda p: p.try_cast("double").isNull())
    words = lambda e: F.split(F.trim(F.regexp_replace(e["text"], r"\s+", " ")), " ")
    problem = (
        F.when(empty(F.col("station")), "description")
        .when(empty(F.col("name")), "name")
        .when(empty(F.col("coordinates")) | (F.size(coords) != 3) | bad_number, "coordinates")
        .when(F.exists("elements", lambda e: empty(e["element"])), "element")
        .when(F.exists("elements", lambda e: empty(e["text"])), "values")
        .when(F.exists("elements", lambda e: F.exists(words(e), lambda w: (w != "-") & w.try_cast("double").isNull())), "number")
    )
    if steps:
        times = F.coalesce(F.size(steps), F.lit(0))
        problem = problem.when(times <= 0, "no forecast times").when(F.exists("elements", lambda e: F.size(words(e)) != times), "length")
    return problem


def malformed_rows(placemarks: DataFrame, steps: DataFrame | None = None) -> DataFrame:
    """Placemarks the parser must not accept, with the first thing that is wrong.

    With ``steps`` (file, steps) the number of values is compared with the number of forecast times.
    """
    rows = placemarks if steps is None else placemarks.join(steps, "file", "left")
    found = rows.withColumn("problem", forecast_problem(None if steps is None else "steps")).filter(F.col("problem").isNotNull())
    return found.select(*placemarks.columns, "problem")
