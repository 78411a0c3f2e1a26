"""Operators that look at the rows before: change, high-water mark, numbering, last n.

``sizing`` options (``splits``, ``group_bound``) are those of ``ordered_scan``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from gridmill.functions.columns import quoted
from gridmill.operators.skew import ordered_scan


def _upto_previous(w):
    return w.rowsBetween(Window.unboundedPreceding, -1)


def pct_change(df: DataFrame, order: Sequence[str], col: str, by: Sequence[str] = (),
               name: str | None = None, **sizing) -> DataFrame:
    """Percent change against the row before, gaps filled forward; null after a zero."""
    name = name or f"{col}_change_pct"
    known = F.struct(*[quoted(o) for o in order])
    scanned = ordered_scan(
        df, "_previous", by, order,
        local=lambda w: F.last(quoted(col), ignorenulls=True).over(_upto_previous(w)),
        summary=F.max_by(quoted(col), F.when(quoted(col).isNotNull(), known)),
        fold=lambda s, w: F.last(s, ignorenulls=True).over(w),
        merge=lambda mine, carry: F.coalesce(mine, carry),
        **sizing,
    )
    current = F.coalesce(quoted(col), F.col("_previous"))
    change = (F.try_divide(current, F.col("_previous")) - 1) * 100
    return scanned.withColumn(name, change).drop("_previous")


def advance_only(df: DataFrame, order: Sequence[str], field: str, by: Sequence[str] = (),
                 marks: DataFrame | None = None, **sizing) -> DataFrame:
    """Rows whose field is above the starting mark and above every earlier row.

    ``marks`` holds (by..., field): the value published last per group. It is
    put in front of its group as one more row, so no join is needed.
    """
    rows = df.withColumn("_seed", F.lit(0))
    if marks is not None:
        seeds = marks.select(*[quoted(c) for c in by], quoted(field), F.lit(-1).alias("_seed"))
        rows = rows.unionByName(seeds, allowMissingColumns=True)
    scanned = ordered_scan(
        rows, "_highest", by, ["_seed", *order],
        local=lambda w: F.max(quoted(field)).over(_upto_previous(w)),
        summary=F.max(quoted(field)),
        fold=lambda s, w: F.max(s).over(w),
        merge=lambda mine, carry: F.greatest(mine, carry.cast(rows.schema[field].dataType)),
        **sizing,
    )
    ahead = F.col("_highest").isNull() | (quoted(field) > F.col("_highest"))
    return scanned.filter((F.col("_seed") == 0) & ahead).drop("_seed", "_highest")


def row_index(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), name: str = "row_index",
              **sizing) -> DataFrame:
    """Position of a row in its group, from 0."""
    return ordered_scan(
        df, name, by, order,
        local=lambda w: (F.row_number().over(w) - 1).cast("long"),
        summary=F.count(F.lit(1)),
        fold=lambda s, w: F.sum(s).over(w),
        merge=lambda mine, carry: mine + F.coalesce(carry.cast("long"), F.lit(0)),
        **sizing,
    )


def number_records(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), name: str = "key_id",
                   numbers: DataFrame | None = None, **sizing) -> DataFrame:
    """``record_0, record_1, ...`` in order; after the ``sent`` records that ``numbers`` has for a source."""
    numbered = row_index(df, order, by, "_index", **sizing)
    if numbers is not None:
        before = numbers.select(*[quoted(c) for c in by], F.col("sent").alias("_sent"))
        numbered = numbered.join(before, list(by), "left") if by else numbered.join(F.broadcast(before.limit(1)), how="left")
        numbered = numbered.withColumn("_index", F.col("_index") + F.coalesce("_sent", F.lit(0))).drop("_sent")
    return numbered.withColumn(name, F.concat(F.lit("record_"), F.col("_index").cast("string"))).drop("_index")


def last_n(df: DataFrame, order: str, n: int) -> DataFrame:
    """The last n rows in order; each task keeps only n rows."""
    return df.orderBy(quoted(order).desc()).limit(n).orderBy(quoted(order))


def sort_by(df: DataFrame, *cols: str) -> DataFrame:
    """Total order; give a unique last column so equal times can be split over tasks."""
    return df.orderBy(*[quoted(c) for c in cols])
