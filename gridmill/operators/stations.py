"""Station filters and station checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, types as T

from gridmill.functions.columns import quoted
from gridmill.operators.skew import keyed_join


def for_stations(df: DataFrame, ids: Sequence[str] | DataFrame | None, col: str = "station") -> DataFrame:
    """Rows of the named stations; ``None`` keeps all."""
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        return keyed_join(df, ids.select(quoted(col)).distinct(), [col], "left_semi")
    return df.filter(quoted(col).isin(list(ids)))


def missing_stations(df: DataFrame, ids: Sequence[str] | DataFrame, col: str = "station") -> DataFrame:
    """Requested stations without any row."""
    if not isinstance(ids, DataFrame):
        ids = df.sparkSession.createDataFrame([(i,) for i in ids], T.StructType([
            T.StructField(col, df.schema[col].dataType)]))
    return ids.join(df.select(quoted(col)).distinct(), col, "left_anti")


def attach_steps(series: DataFrame, steps: DataFrame, on: Sequence[str] = ("file", "step")) -> DataFrame:
    """Give each value the forecast time of its position; a value without one keeps its row. Steps are unique on ``on``."""
    return keyed_join(series, steps, list(on), "left")
