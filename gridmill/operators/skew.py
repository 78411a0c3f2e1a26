"""Joins and ordered scans that hold when one key owns a large part of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from gridmill.functions.columns import quoted
from gridmill.session import checkpointed

# A DATE has no more values than this, which bounds the groups of a daily series.
CALENDAR_DAYS = 3_652_059


def keyed_join(large: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join of any large side with a side that is unique on ``on``.

    Adaptive execution broadcasts the small side if its measured bytes allow.
    Otherwise both sides are shuffled and the partition of a hot key is cut by
    map output, each piece meeting a copy of the small side's partition. That
    splits even identical rows, and unlike a random salt it gives the same rows
    again when a lost task is repeated. It works for the kinds in which only
    the large side is cut: inner, left, left_semi and left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join kind {how!r}")
    return large.join(small, list(on), how)


def ahead_of(df: DataFrame, marks: DataFrame | None, by: Sequence[str], field: str) -> DataFrame:
    """Rows above the mark of their source, and rows of sources without one; ``marks`` holds (by..., field), one row each.

    A plain join in front of whatever orders the rows: old rows go before they are shuffled by order.
    """
    if marks is None:
        return df
    if not by:
        mark = marks.agg(F.max(quoted(field))).first()[0]
        return df if mark is None else df.filter(quoted(field) > F.lit(mark))
    renamed = marks.select(*[quoted(c).alias(f"_m_{c}") for c in by], quoted(field).alias("_mark"))
    same = reduce(lambda a, b: a & b, [quoted(c).eqNullSafe(quoted(f"_m_{c}")) for c in by])
    joined = df.join(renamed, same, "left")
    return joined.filter(F.col("_mark").isNull() | (quoted(field) > F.col("_mark"))).select(*[quoted(c) for c in df.columns])


def ordered_scan(
    df: DataFrame,
    name: str,
    by: Sequence[str],
    order: Sequence[str],
    local: Callable[[WindowSpec], Column],
    summary: Column,
    fold: Callable[[Column, WindowSpec], Column],
    merge: Callable[[Column, Column], Column],
    splits: int | None = None,
    group_bound: int | None = None,
) -> DataFrame:
    """Add ``name``: a value that depends on all earlier rows of the group.

    Rows are cut into ordered splits by range partitioning on (group, order),
    whatever the size of a group: each split computes ``local`` alone, its
    ``summary`` (one row per group and split) is folded over the earlier
    splits, and ``merge`` combines the two. ``order`` must be unique inside a
    group. ``splits`` is the number of shuffle partitions unless given.

    ``group_bound`` states that no group can hold more rows than one task can
    scan, whatever the input. Such groups are one plain window.
    """
    order_cols = [quoted(c).asc() for c in order]
    if group_bound is not None:
        w = Window.partitionBy(*[quoted(c) for c in by]).orderBy(*order_cols)
        return df.withColumn(name, merge(local(w), F.lit(None)))

    ranges = [*[quoted(c).asc() for c in by], *order_cols]
    placed = df.repartitionByRange(splits, *ranges) if splits else df.repartitionByRange(*ranges)
    # The split id must not change when a task is run again: it is materialised.
    cut = checkpointed(placed.withColumn("_split", F.spark_partition_id()))
    keys_and_split = [*by, "_split"]
    sums = cut.groupBy(*[quoted(c) for c in keys_and_split]).agg(summary.alias("_summary"))
    earlier = (Window.partitionBy(*[quoted(c) for c in by]).orderBy("_split")
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = sums.select(*[quoted(c).alias(f"_k_{c}") for c in keys_and_split],
                        fold(F.col("_summary"), earlier).alias("_carry"))
    inner = Window.partitionBy(*[quoted(c) for c in keys_and_split]).orderBy(*order_cols)
    scanned = cut.withColumn("_local", local(inner))
    condition = reduce(lambda a, b: a & b,
                       [quoted(c).eqNullSafe(quoted(f"_k_{c}")) for c in keys_and_split])
    return (scanned.join(carry, condition, "left")
            .withColumn(name, merge(F.col("_local"), F.col("_carry")))
            .select(*[quoted(c) for c in df.columns], quoted(name)))
