"""Union, dedup, aggregation and reshaping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from gridmill.functions.columns import quoted


def union_sources(sources: Sequence[DataFrame | None], rank: str = "src_rank") -> DataFrame:
    """Stack the sources that exist, each with its rank; fail when none does."""
    found = [(i, s) for i, s in enumerate(sources) if s is not None]
    if not found:
        raise FileNotFoundError("no source table was found")
    ranked = [s if rank in s.columns else s.withColumn(rank, F.lit(i)) for i, s in found]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)


def dedup_prefer(df: DataFrame, key: Sequence[str], prefer: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``prefer`` order.

    Spark keeps one row per key in every map task before the shuffle, so many
    copies of a key do not meet in one task.
    """
    w = Window.partitionBy(*[quoted(k) for k in key]).orderBy(*[quoted(p) for p in prefer])
    return df.withColumn("_place", F.row_number().over(w)).filter(F.col("_place") == 1).drop("_place")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def mean_all_by(df: DataFrame, *keys: str) -> DataFrame:
    """Mean of every numeric column per key; rows without a key are left out."""
    cols = [c for c in numeric_columns(df) if c not in keys]
    return _with_keys(df, keys).groupBy(*[quoted(k) for k in keys]).agg(
        *[F.avg(quoted(c)).alias(c) for c in cols])


def means_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str], value=F.avg) -> DataFrame:
    return _with_keys(df, keys).groupBy(*[quoted(k) for k in keys]).agg(
        *[value(quoted(c)).alias(c) for c in cols])


def sum_columns_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str], scale: int | None = None) -> DataFrame:
    """Sums per key; a group without any value gives 0.

    ``scale`` sums as fixed-point numbers, so the result does not depend on
    the order in which partitions are added up.
    """
    return _with_keys(df, keys).groupBy(*[quoted(k) for k in keys]).agg(
        *[F.coalesce(exact_sum(quoted(c), scale), F.lit(0.0)).alias(c) for c in cols])


def total_by(df: DataFrame, keys: Sequence[str], col: str, scale: int | None = None) -> DataFrame:
    return sum_columns_by(df, keys, [col], scale)


def exact_sum(col: Column, scale: int | None = None) -> Column:
    if scale is None:
        return F.sum(col.cast("double"))
    return F.sum(col.cast(T.DecimalType(28, scale))).cast("double")


def exact_mean(col: Column, scale: int | None = None) -> Column:
    return F.avg(col) if scale is None else F.try_divide(exact_sum(col, scale), F.count(col))


def _with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.na.drop("any", subset=list(keys))


def to_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "series",
            value: str = "value") -> DataFrame:
    """One row per (row, column)."""
    return df.unpivot([quoted(i) for i in ids], [quoted(c) for c in cols], name, value)


def series_to_wide(long: DataFrame, keys: Sequence[str], elements: Sequence[str],
                   element: str = "element", value: str = "value") -> DataFrame:
    """Element rows to one column per listed element, in one aggregation."""
    picks = [F.max(F.when(quoted(element) == F.lit(e), quoted(value))).alias(e) for e in elements]
    return long.groupBy(*[quoted(k) for k in keys]).agg(*picks)


def row_counts(df: DataFrame, by: str, expected: Sequence | None = None, required: bool = False) -> DataFrame:
    """Rows per source, expected sources without rows included as 0.

    ``required`` turns a source without rows into an error when the result is
    read.
    """
    counts = df.groupBy(quoted(by)).agg(F.count(F.lit(1)).alias("rows"))
    if expected is not None:
        wanted = df.sparkSession.createDataFrame([(e,) for e in expected], T.StructType([
            T.StructField(by, df.schema[by].dataType)]))
        counts = wanted.join(counts, by, "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    if required:
        empty = F.raise_error(F.concat(F.lit("no rows from source "), quoted(by).cast("string"))).cast("long")
        counts = counts.withColumn("rows", F.when(F.col("rows") > 0, F.col("rows")).otherwise(empty))
    return counts


def current_mark(df: DataFrame, field: str, by: Sequence[str] = ()) -> DataFrame:
    """Newest value per source."""
    return df.groupBy(*[quoted(b) for b in by]).agg(F.max(quoted(field)).alias(field))
