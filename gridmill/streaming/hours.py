"""Totals of closed hours, with the rows that come too late as a second output."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

HOUR_MS = 3_600_000
HOURS = T.StructType([T.StructField("hour_start", T.TimestampType()), T.StructField("rows", T.LongType()),
                      T.StructField("total", T.LongType()), T.StructField("late", T.BooleanType())])


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each hour of a batch of rows: what a busy hour sends on is a few rows a task."""
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by("hour_start").aggregate([("hour_start", "count"), ("total", "sum")])
        if table.num_rows:
            yield pa.RecordBatch.from_pydict({
                "hour_start": table["hour_start"].combine_chunks(), "rows": table["hour_start_count"].combine_chunks(),
                "total": table["total_sum"].combine_chunks()})


class ClosedHours(StatefulProcessor):
    """Counts an hour until the watermark has passed its end; then gives its total once. What comes later is given as late."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", T.StructType([T.StructField("rows", T.LongType()), T.StructField("total", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        count = total = 0
        for frame in rows:
            count, total = count + int(frame["rows"].sum()), total + int(frame["total"].sum())
        start = pd.Timestamp(key[0])
        end = start.value // 1_000_000 + HOUR_MS
        if end <= timerValues.getCurrentWatermarkInMs():
            yield pd.DataFrame({"hour_start": [start], "rows": [count], "total": [total], "late": [True]})
            return
        held = self.sums.get() if self.sums.exists() else (0, 0)
        self.sums.update((held[0] + count, held[1] + total))
        self.handle.registerTimer(end)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows, total = self.sums.get()
        self.sums.clear()
        yield pd.DataFrame({"hour_start": [pd.Timestamp(key[0])], "rows": [rows], "total": [total], "late": [False]})

    def close(self) -> None:
        pass


def stream_hours(df: DataFrame, col: str, value: str, delay: str = "1 hour", digits: int = 2) -> DataFrame:
    """hour_start, rows, the value's sum and ``late``: one row for each closed hour, and one for each hour and batch of late rows.

    Every row of the stream is in one of them or in an hour that is still open; rows without a time are in none. Sums are
    exact in ``digits`` decimals. A null value counts as a row and adds nothing. The session's time zone must be UTC.
    """
    unit = 10**digits
    amount = (F.col(value).cast(f"decimal(18,{digits})") * unit).cast("long")
    # The watermark follows the time column, but the column itself does not go on: so Spark drops no late row behind it.
    hours = df.withWatermark(col, delay).select(F.date_trunc("hour", col).alias("hour_start"), F.coalesce(amount, F.lit(0).cast("long")).alias("total"))
    combined = hours.filter("hour_start IS NOT NULL").mapInArrow(_combined, "hour_start timestamp, rows long, total long")
    found = combined.groupBy("hour_start").transformWithStateInPandas(ClosedHours(), HOURS, "Append", "EventTime")
    return found.select("hour_start", "rows", (F.col("total") / unit).alias(value), "late")
