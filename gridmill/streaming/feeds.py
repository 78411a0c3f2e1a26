"""Streaming forms of the load and gas feeds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from gridmill.functions.timecols import parse_iso, wall_clock, with_calendar_parts
from gridmill.schemas import GAS_MESSAGE, LOAD_MESSAGE
from gridmill.sources.messages import checked, message_stream, parse_messages


def typed_messages(messages: DataFrame, values: list[str], parts: tuple[str, ...], keep: tuple[str, ...] = ()) -> DataFrame:
    """Instant, single-precision values, and the calendar parts as the sender wrote them."""
    out = with_calendar_parts(messages.withColumn("_wall", wall_clock("date")), "_wall", parts)
    out = out.withColumns({"date": parse_iso("date"), **{v: F.col(v).cast("float") for v in values}})
    return out.select("date", *values, *parts, *keep)


def _feed(spark: SparkSession, source: str | Mapping, schema: T.StructType, values: list[str], parts: tuple[str, ...], bad: str, options) -> DataFrame:
    """Typed messages. ``bad`` says what becomes of those that are no such JSON object, or lack a time or a value.

    ``fail`` ends the stream at the first one, ``keep`` gives them too, with what is wrong in ``problem`` and the text in
    ``message`` (null for good ones), and ``drop`` leaves them out.
    """
    if bad not in ("fail", "keep", "drop"):
        raise ValueError(f"bad messages are to fail, keep or drop, not {bad!r}")
    judged = checked(parse_messages(message_stream(spark, source, **options), schema, keep="value"), "date", values)
    typed = typed_messages(judged, values, parts, ("problem", "value")).withColumnRenamed("value", "message")
    if bad == "drop":
        return typed.filter(F.col("problem").isNull()).drop("problem", "message")
    if bad == "keep":
        return typed.withColumn("message", F.when(F.col("problem").isNotNull(), F.col("message")))
    stop = F.raise_error(F.concat(F.col("problem"), F.lit(": "), F.coalesce("message", F.lit("null")))).cast("timestamp")
    return typed.withColumn("date", F.when(F.col("problem").isNotNull(), stop).otherwise(F.col("date"))).drop("problem", "message")


def stream_load(spark: SparkSession, source: str | Mapping, bad: str = "fail", **options) -> DataFrame:
    return _feed(spark, source, LOAD_MESSAGE, ["load"], ("day", "month", "year", "hour", "minute"), bad, options)


def stream_gas(spark: SparkSession, source: str | Mapping, bad: str = "fail", **options) -> DataFrame:
    return _feed(spark, source, GAS_MESSAGE, ["open_price", "close_price"], ("day", "year", "hour", "month", "minute"), bad, options)


def stream_closed_hours(df: DataFrame, col: str, value: str, delay: str = "1 hour") -> DataFrame:
    """Totals of completed hours; an hour is emitted once, when the watermark has passed it."""
    return (
        df.withWatermark(col, delay)
        .groupBy(F.window(col, "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(value).cast("decimal(18,2)")).cast("double").alias(value))
        .select(F.col("w.start").alias("hour_start"), "rows", value)
    )


def start(writer: DataStreamWriter, every: str | None = None) -> StreamingQuery:
    """Process what is available now and stop, or keep going at an interval."""
    if every:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def to_files(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a stream to Parquet files, exactly once."""
    return start(df.writeStream.format("parquet").outputMode("append").option("path", path)
                 .option("checkpointLocation", checkpoint), every)
