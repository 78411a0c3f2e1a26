"""Ledger checks and the high-water mark publisher."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridmill.functions.columns import all_of, quoted, select_fields
from gridmill.functions.timecols import iso_text
from gridmill.operators.ordered import advance_only, number_records
from gridmill.operators.shape import current_mark


def unprocessed(files: DataFrame, ledger: DataFrame, key: str = "s3_key") -> DataFrame:
    """Files that the ledger does not hold. Repeated ledger keys are merged before the join."""
    return files.join(ledger.select(quoted(key)).distinct(), key, "left_anti")


def ledger_count(ledger: DataFrame, key: str) -> DataFrame:
    return ledger.filter(F.col("s3_key") == F.lit(key)).agg(F.count(F.lit(1)).alias("count"))


def to_publish(df: DataFrame, order: Sequence[str], field: str, fields: Sequence[str], by: Sequence[str] = (),
               marks: DataFrame | None = None, predicates: Sequence[Column] = (),
               splits: int | None = None, numbers: DataFrame | None = None) -> DataFrame:
    """Rows a publisher sends: filtered, ahead of the mark, numbered in order.

    ``numbers`` holds (by..., sent): how many records of a source were sent before, so that numbers go on.
    """
    chosen = df.filter(all_of(*predicates))
    ahead = advance_only(chosen, order, field, by, marks, splits=splits)
    numbered = number_records(ahead, order, by, splits=splits, numbers=numbers)
    return select_fields(numbered, [*by, *[f for f in fields if f not in by], "key_id"])


def as_message(records: DataFrame, time_col: str = "date") -> DataFrame:
    return records.withColumn(time_col, iso_text(time_col))


def merged_marks(marks: DataFrame | None, seen: DataFrame, field: str, by: Sequence[str] = ()) -> DataFrame:
    """Marks after a publication; sources without new rows keep theirs.

    The newest row of a source is always published unless the mark is newer,
    so the rows seen need not be filtered first.
    """
    new = current_mark(seen, field, by)
    return new if marks is None else current_mark(marks.select(*new.columns).unionByName(new), field, by)
