"""JSON message topics, read once for what is available now or continuously."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gridmill.functions.timecols import parse_iso
from gridmill.sources.topic import register

RAW = "_raw"


def message_stream(spark: SparkSession, source: str | Mapping, max_per_trigger: int | None = None) -> DataFrame:
    """Raw message text as a streaming table with one column ``value``.

    ``source`` is a folder of message files, or the options of a topic: one in
    a folder (``{"topic": path, "group": name}``) or of a broker
    (``{"kafka.bootstrap.servers": ..., "subscribe": ...}``). A topic is read
    from its group's or the earliest offset and then from the checkpoint.
    """
    if isinstance(source, str):
        reader = spark.readStream.format("text")
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return reader.load(source)
    if "topic" in source:
        return spark.readStream.format(register(spark)).options(**source).load().select("value")
    reader = spark.readStream.format("kafka").option("startingOffsets", "earliest")
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.options(**source).load().select(F.col("value").cast("string").alias("value"))


def parse_messages(raw: DataFrame, schema: T.StructType, fail_fast: bool = False, keep: str | None = None) -> DataFrame:
    """Message columns; text that is no such JSON object is kept in ``_raw``.

    With ``fail_fast`` one bad message fails the run instead; ``keep`` names a column that stays beside the parsed ones.
    """
    kept = [keep] if keep else []
    if fail_fast:
        parsed = F.from_json("value", schema, {"mode": "FAILFAST"})
        return raw.select(*kept, parsed.alias("m")).select(*kept, "m.*")
    with_raw = T.StructType([*schema.fields, T.StructField(RAW, T.StringType())])
    parsed = F.from_json("value", with_raw, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW})
    return raw.select(*kept, parsed.alias("m")).select(*kept, "m.*")


def read_messages(spark: SparkSession, source: str | Mapping, schema: T.StructType,
                  fail_fast: bool = False, max_per_trigger: int | None = None) -> DataFrame:
    return parse_messages(message_stream(spark, source, max_per_trigger), schema, fail_fast)


def good(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col(RAW).isNull()).drop(RAW) if RAW in messages.columns else messages


def checked(messages: DataFrame, time_col: str, values: Sequence[str]) -> DataFrame:
    """Messages with ``problem``: what is wrong with them, or null."""
    problem = F.when(F.col(RAW).isNotNull(), "no such JSON object").when(parse_iso(time_col).isNull(), f"no time in {time_col}")
    for c in values:
        problem = problem.when(F.col(c).isNull(), f"no value in {c}")
    return messages.withColumn("problem", problem)


def quarantined(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col(RAW).isNotNull()).select(RAW)
