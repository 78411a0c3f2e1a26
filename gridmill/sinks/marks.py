"""State by source that grows run by run: high-water marks and counts, stored as what each run has changed.

Version v of a state is a table of the sources that run v has touched. The state before a run is the merged versions before it.
Every ``EVERY`` versions the whole is written once, so few versions are merged; all versions stay, so a run that is repeated
after later ones still starts from what it had at first. What a run writes follows the sources in it, not all there are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from gridmill.functions.columns import quoted
from gridmill.sources.lake import delete_folder, folders, path_exists

EVERY = 16


def _numbers(names: list[str], kind: str) -> list[int]:
    return sorted(int(n.removeprefix(kind)) for n in names if n.startswith(kind))


def _parts(spark: SparkSession, path: str, version: int) -> list[str]:
    """Folders that make up the state before ``version``: at most one whole state, and the versions behind it.

    Versions follow each other as a rule, and then nothing is listed.
    """
    found, v = [], version - 1
    while v >= 0 and len(found) <= 2 * EVERY:
        if path_exists(spark, f"{path}/whole={v}/_SUCCESS"):
            return [*found, f"{path}/whole={v}"]
        if not path_exists(spark, f"{path}/version={v}"):
            break
        found.append(f"{path}/version={v}")
        v -= 1
    if v < 0:
        return found
    names = folders(spark, path)
    whole = [n for n in _numbers(names, "whole=") if n < version and path_exists(spark, f"{path}/whole={n}/_SUCCESS")]
    base = whole[-1] if whole else -1
    return [f"{path}/version={n}" for n in _numbers(names, "version=") if base < n < version] + ([f"{path}/whole={base}"] if whole else [])


def read_state(spark: SparkSession, path: str, version: int, schema: T.StructType, merge: Callable[[Column], Column]) -> DataFrame | None:
    """The state before ``version``, or None if there is none. The last column of the schema is the value, the others name a source."""
    parts = _parts(spark, path, version)
    if not parts:
        return None
    *by, value = schema.names
    rows = spark.read.schema(schema).parquet(*parts)
    return rows.groupBy(*[quoted(c) for c in by]).agg(merge(quoted(value)).alias(value)).select(*[quoted(c) for c in schema.names])


def write_state(changes: DataFrame, path: str, version: int, merge: Callable[[Column], Column]) -> None:
    """Store what run ``version`` has changed. A repeated run replaces its own changes."""
    spark = changes.sparkSession
    changes.write.mode("overwrite").parquet(f"{path}/version={version}")
    if len(_parts(spark, path, version + 1)) > EVERY:
        whole = read_state(spark, path, version + 1, changes.schema, merge)
        whole.write.mode("overwrite").parquet(f"{path}/whole={version}")
        for old in _numbers(folders(spark, path), "whole=")[:-2]:
            delete_folder(spark, f"{path}/whole={old}")


def read_marks(spark: SparkSession, path: str, version: int, schema: T.StructType) -> DataFrame | None:
    """The highest value of every source before run ``version``."""
    return read_state(spark, path, version, schema, F.max)


def write_marks(marks: DataFrame, path: str, version: int) -> None:
    """Store the marks that run ``version`` has raised."""
    write_state(marks, path, version, F.max)


def read_counts(spark: SparkSession, path: str, version: int, schema: T.StructType) -> DataFrame | None:
    """The sum of every source's counts before run ``version``."""
    return read_state(spark, path, version, schema, F.sum)


def write_counts(counts: DataFrame, path: str, version: int) -> None:
    """Store what run ``version`` has counted."""
    write_state(counts, path, version, F.sum)


def last_row(spark: SparkSession, path: str, version: int, schema: T.StructType):
    """The row of the newest version before ``version``, for a state of one row."""
    earlier = [v for v in _numbers(folders(spark, path), "version=") if v < version]
    return spark.read.schema(schema).parquet(f"{path}/version={earlier[-1]}").first() if earlier else None


def write_row(row: DataFrame, path: str, version: int) -> None:
    row.write.mode("overwrite").parquet(f"{path}/version={version}")
