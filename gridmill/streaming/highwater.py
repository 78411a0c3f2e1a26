"""High-water marks as keyed state of a stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gridmill.functions.columns import quoted

#: Added to every row: a row that is ahead, or word that a source has fallen silent.
NOTICE = "notice"
AHEAD, SILENT = "ahead", "silent"


def _missing(value) -> bool:
    return value is None or value != value


class HighWater(StatefulProcessor):
    """Rows above the mark of their source and above all its rows before, by ``order`` within a micro-batch.

    The state of a source is its mark. A micro-batch reads and writes the marks of its own sources, whatever the number of
    sources there are. Rows at or below the mark go as they come in, what is left of one source and batch is ordered in memory.
    """

    def __init__(self, columns: Sequence[str], by: Sequence[str], order: Sequence[str], field: T.StructField, silent_ms: int | None):
        self.columns, self.by, self.order, self.field, self.silent_ms = list(columns), list(by), list(order), field, silent_ms
        self.out = Row(*columns, NOTICE)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.mark = handle.getValueState("mark", T.StructType([T.StructField("value", self.field.dataType)]))

    def _top(self):
        held = self.mark.get() if self.mark.exists() else None
        return None if held is None else held[0]

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        top, old = initialState[self.field.name], self._top()
        if not _missing(top) and (old is None or top > old):
            self.mark.update((top,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        top, field = self._top(), self.field.name
        kept = [r for r in rows if top is None or not _missing(r[field]) and r[field] > top]
        if self.silent_ms is not None:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old if isinstance(old, int) else old[0])
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.silent_ms)
        kept.sort(key=lambda r: [(True, 0) if _missing(r[c]) else (False, r[c]) for c in self.order])
        high, ahead = top, []
        for row in kept:
            value = row[field]
            if high is None or not _missing(value) and value > high:
                ahead.append(self.out(*(row[c] for c in self.columns), AHEAD))
                high = high if _missing(value) else value
        if high is not None and high != top:
            self.mark.update((high,))
        return iter(ahead)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """One row that names the source and its mark; the state stays."""
        row = dict.fromkeys(self.columns) | dict(zip(self.by, key, strict=True)) | {self.field.name: self._top()}
        yield self.out(*(row[c] for c in self.columns), SILENT)

    def close(self) -> None:
        pass


def stream_high_water(stream: DataFrame, order: Sequence[str], field: str, by: Sequence[str], marks: DataFrame | None = None,
                      silent_after: float | None = None) -> DataFrame:
    """The stream's rows that are ahead of their source's mark, with ``notice``.

    ``marks`` holds (by..., field): where sources start. With ``silent_after`` (seconds) a source without any row for that
    long gives one row with notice ``silent``, its mark and nulls. Restarted from its checkpoint, the stream goes on from its
    state. For sources of which one batch of rows is too much for a task, ``stream_advance_only`` cuts a source into splits.
    """
    # Rows are plain Python rows there, so times go as whole microseconds: no zone of a worker touches them.
    plain, silent_ms = _counted(stream), None if silent_after is None else int(silent_after * 1000)
    out = T.StructType([*[T.StructField(f.name, f.dataType) for f in plain.schema.fields], T.StructField(NOTICE, T.StringType())])
    processor = HighWater(plain.columns, by, order, plain.schema[field], silent_ms)
    start = None if marks is None else _counted(marks.select(*by, field)).groupBy(*by)
    found = plain.groupBy(*by).transformWithState(
        processor, out, "Append", "None" if silent_after is None else "ProcessingTime", initialState=start)
    return found.select(*[F.timestamp_micros(c).alias(f.name) if _is_time(f) else c
                          for f in stream.schema.fields for c in [quoted(f.name)]], NOTICE)


def _is_time(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.TimestampType)


def _counted(df: DataFrame) -> DataFrame:
    """Instants as microseconds since 1970."""
    def of(f: T.StructField) -> Column:
        return F.unix_micros(quoted(f.name)).alias(f.name) if _is_time(f) else quoted(f.name)

    return df.select(*[of(f) for f in df.schema.fields])
