"""Daily marts that are kept up to date: a refresh recomputes the days that loads have changed, and reads nothing else.

The commit log of the feed says which batches have come since the refresh before; a batch's load shows in the table as a folder
``<day>/load_id=<load>``. Those days are computed again from the whole day of the table and replaced in the mart, so a late row
corrects its day, and a mart that was refreshed by steps equals one computed at once.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridmill.functions.columns import quoted
from gridmill.sinks.commits import CommitLog, read_position, write_position
from gridmill.sinks.lake import balanced, overwrite_partitions
from gridmill.sources.lake import delete_folder, escaped, path_exists
from gridmill.streaming.sinks import load_name, position_path


def changed_days(spark: SparkSession, table: str, partition_col: str, prefix: str, batches: list[tuple[str, list[str]]]) -> list[str]:
    """Days of the table that hold rows of these lake batches. A batch's days are local; the table's may be one off."""
    found = set()
    for batch_id, days in batches:
        near = {date.fromisoformat(d) + timedelta(days=k) for d in days if _is_day(d) for k in (-1, 0, 1)}
        load = escaped(load_name(prefix, batch_id))
        found |= {d.isoformat() for d in near if path_exists(spark, f"{table}/{partition_col}={d.isoformat()}/load_id={load}")}
    return sorted(found)


def _is_day(text: str) -> bool:
    try:
        date.fromisoformat(text)
    except ValueError:
        return False
    return True


def read_days(spark: SparkSession, table: str, days: list[str], partition_col: str = "date") -> DataFrame:
    """The rows of some days of a loaded table; other folders are not even listed."""
    paths = [f"{table}/{partition_col}={d}" for d in days]
    return spark.read.option("basePath", table).parquet(*paths).drop("load_id")


def refresh_mart(spark: SparkSession, lake: str, prefix: str, table: str, ledger: str, mart: str, state: str, daily: Callable[[DataFrame], DataFrame],
                 partition_col: str = "date") -> list[str]:
    """Bring a mart up to the last load of a feed; returns the days computed.

    ``daily`` maps rows of the table to rows of the mart with a date column ``day``; the rows of a day must depend on that day's
    rows alone. Batches that are committed but not loaded yet, or not wholly, are looked at again by the next refresh.
    """
    loaded, place = read_position(spark, position_path(ledger)), read_position(spark, state)
    commits = [c for c in CommitLog(spark, lake, prefix).after(place["number"]) if c["number"] <= loaded["number"]]
    batches = {b: days for b, days in place["again"]} | {c["batch_id"]: c["days"] for c in commits}
    days = changed_days(spark, table, partition_col, prefix, list(batches.items()))
    if days:
        rows = daily(read_days(spark, table, days, partition_col)).withColumn("day", F.col("day").cast("string"))
        # Days that come out without rows leave nothing behind.
        for day in days:
            delete_folder(spark, f"{mart}/day={day}")
        overwrite_partitions(balanced(rows, "day"), mart, "day")
    number = max([place["number"], *[c["number"] for c in commits]])
    write_position(spark, state, {"number": number, "again": [[b, d] for b, d in loaded["again"]]})
    return days


def read_mart(spark: SparkSession, mart: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """A mart, or its days from ``first`` to ``last``; days outside are pruned."""
    rows = spark.read.parquet(mart)
    day = quoted("day").cast("date")
    if first is not None:
        rows = rows.filter(day >= F.lit(first))
    if last is not None:
        rows = rows.filter(day <= F.lit(last))
    return rows.withColumn("day", day)
