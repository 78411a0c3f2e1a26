"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gridmill.feeds import with_feeds
from gridmill.functions.columns import quoted
from gridmill.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain_times(df: DataFrame) -> DataFrame:
    """Instants as UTC wall time, which is how SQL engines without zones show them."""
    return df.select(*[
        quoted(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else quoted(f.name)
        for f in df.schema.fields])


def query(name: str, *feeds: str, sql: str | None = None):
    """Register a query; ``sql`` is its oracle over the named feeds."""
    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain_times(fn(configure(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_feeds(sql, *feeds)
        return fn

    return add


def berlin(col: str) -> str:
    """Local wall time of a UTC column, as SQL."""
    return f"(({col} AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin')"


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(quoted(c), digits) for c in cols})
