"""Micro-batch sinks. Each of them may see a batch again and then replaces its own output."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from gridmill.functions.columns import quoted, warehouse_cast
from gridmill.operators.ingest import merged_marks
from gridmill.operators.ordered import advance_only
from gridmill.operators.quality import check_partition_column
from gridmill.operators.shape import current_mark
from gridmill.operators.skew import ahead_of, keyed_join
from gridmill.session import checkpointed
from gridmill.sinks.commits import CommitLog, read_position, write_position
from gridmill.sinks.lake import (
    BATCH, KEY, balanced, load_partitioned, overwrite_partitions, record_processed, write_once,
)
from gridmill.sinks.marks import read_marks, write_marks
from gridmill.sources.lake import PANDAS_INDEX, data_path, delete_folder, escaped, path_exists
from gridmill.sources.messages import checked, message_stream, parse_messages
from gridmill.sources.topic import commit_group
from gridmill.streaming.feeds import start, typed_messages


def for_each_batch(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None],
                   every: str | None = None) -> StreamingQuery:
    """Run a handler over what is available now, or go on at an interval.

    The batch is kept while the handler runs, which uses it more than once.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            handle(batch, batch_id)
        finally:
            batch.unpersist()

    return start(stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint), every)


def stream_write_once(stream: DataFrame, lake: str, feed: str, checkpoint: str, run_id: str = "stream",
                      key: Sequence[str] = (KEY,), every: str | None = None) -> StreamingQuery:
    """Write-once keys from a stream with a ``period_key`` column; late rows are counted."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        write_once(batch, lake, feed, f"{run_id}-{batch_id}", key, keep_late=True)

    return for_each_batch(stream, checkpoint, handle, every)


# -- high-water mark ---------------------------------------------------------------

def stream_advance_only(stream: DataFrame, out: str, state: str, checkpoint: str, order: Sequence[str], field: str,
                        by: Sequence[str], marks: DataFrame | None = None, splits: int | None = None,
                        every: str | None = None) -> StreamingQuery:
    """Rows ahead of their source's mark, across batches and restarts.

    The marks that batch n raises are stored as version n, so a repeated batch
    starts from the same marks, and a batch writes marks of its own sources
    only. Sources share the work of a batch even when one of them holds most of
    its rows; rows that are not above their mark go before the rest is ordered.
    """
    mark_schema = T.StructType([stream.schema[c] for c in [*by, field]])

    def handle(batch: DataFrame, batch_id: int) -> None:
        stored = read_marks(batch.sparkSession, state, batch_id, mark_schema)
        before = marks if stored is None else stored
        above = ahead_of(batch, before, by, field)
        ahead = advance_only(above, order, field, by, splits=splits)
        overwrite_partitions(ahead.withColumn("batch_id", F.lit(batch_id)), out, "batch_id")
        raised = merged_marks(marks, above, field, by) if stored is None else current_mark(above, field, by)
        write_marks(raised.select(*mark_schema.names), state, batch_id)

    return for_each_batch(stream, checkpoint, handle, every)


# -- messages to a landing table and a quarantine -----------------------------------------

QUARANTINE = T.StructType([T.StructField("problem", T.StringType()), T.StructField("message", T.StringType())])


def land_messages(spark: SparkSession, source: str | Mapping, schema: T.StructType, values: Sequence[str], parts: Sequence[str],
                  landed: str, quarantine: str, checkpoint: str, every: str | None = None, **options) -> StreamingQuery:
    """Good messages, typed, to a table of days; bad ones, as they came, to a quarantine with the reason.

    Both are written per micro-batch, so a repeated one replaces its own files. Days are UTC dates of the messages.
    """
    raw = message_stream(spark, source, **options)
    both = parse_messages(raw, schema, keep="value")

    def handle(batch: DataFrame, batch_id: int) -> None:
        judged = checked(batch, "date", values)
        bad = judged.filter(F.col("problem").isNotNull())
        overwrite_partitions(bad.select("problem", F.col("value").alias("message"), F.lit(batch_id).alias("batch_id")), quarantine, "batch_id")
        good_rows = typed_messages(judged.filter(F.col("problem").isNull()), list(values), tuple(parts))
        overwrite_partitions(balanced(good_rows.withColumns({"landed_day": F.to_date("date"), "batch_id": F.lit(batch_id)}), "landed_day"),
                             landed, "landed_day", "batch_id")
        days = [str(r[0]) for r in good_rows.select(F.to_date("date")).distinct().collect()]
        log = landing_log(batch.sparkSession, landed)
        number, last = None, log.last()
        while number is None:
            number, others = log.append({"kind": "batch", "batch_id": str(batch_id), "days": days}, last)
            last = others[-1]["number"] if others else last

    query = for_each_batch(both, checkpoint, handle, every)
    if not every and not isinstance(source, str) and "topic" in source and "group" in source:
        commit_group(query, source["topic"], source["group"])
    return query


def landing_log(spark: SparkSession, landed: str) -> CommitLog:
    """Which days each landing has added to, so that nobody lists the landing table."""
    return CommitLog(spark, f"{landed}-index", "landed")


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Messages that could not be used, and why."""
    return spark.read.schema(QUARANTINE).parquet(path).select(*QUARANTINE.names) if path_exists(spark, path) else spark.createDataFrame([], QUARANTINE)


# -- lake to warehouse ---------------------------------------------------------------

FAILURES = T.StructType([T.StructField("s3_key", T.StringType()), T.StructField("reason", T.StringType())])


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FAILURES).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], FAILURES)


def load_name(prefix: str, batch_id: str) -> str:
    """The id of the load of a lake batch: that of the feed and the batch."""
    return f"{prefix.strip('/').replace('/', '.')}-{batch_id}"


def load_batch(spark: SparkSession, lake: str, prefix: str, batch_id: str, schema: T.StructType, table: str, ledger: str,
               partition_col: str, at: datetime, failures: str | None = None, days: Sequence[str] | None = None) -> int:
    """Load one lake batch as one load, whose id is that of the feed and the batch; returns the number of objects that failed.

    A batch that is loaded again, because it was written again or an object was
    repaired, replaces its own rows. Objects that cannot be read, or hold no
    usable date, year or month, are left out, not recorded, and listed in
    ``failures``; so the next run tries them again. ``days`` are the batch's, by its commit.
    """
    load_id = load_name(prefix, batch_id)
    base = data_path(lake, prefix)
    if days is None:
        days = [r["period"] for r in CommitLog(spark, lake, prefix).live().filter(F.col(BATCH) == batch_id).collect()]
    paths = [p for p in (f"{base}/period={escaped(d)}/{BATCH}={escaped(batch_id)}" for d in days) if path_exists(spark, p)]
    if not paths:
        return 0
    # Damaged files give no rows here; they show as objects without any row.
    rows = (spark.read.schema(schema).option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").parquet(*paths)
            .drop(PANDAS_INDEX).select("*", F.col("_metadata.file_path").alias("s3_key")))
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(paths).select(F.col("path").alias("s3_key"))
    plain = lambda c: F.regexp_replace(c, "^([a-z0-9]+:)/+", "$1/")  # noqa: E731  file:/x and file:///x are one name
    audit = rows.groupBy(plain("s3_key").alias("name")).agg(
        F.count(quoted(partition_col)).alias("dates"), F.count("year").alias("years"), F.count("month").alias("months"))
    reason = (F.when(F.col("dates").isNull(), "no rows: damaged or empty").when(F.col("dates") == 0, f"no value in {partition_col}")
              .when((F.col("years") == 0) | (F.col("months") == 0), "no year or month"))
    audited = checkpointed(listed.withColumn("name", plain("s3_key")).join(audit, "name", "left").select("s3_key", "name", reason.alias("reason")))
    bad = audited.filter(F.col("reason").isNotNull())
    failed = bad.count()
    good = keyed_join(rows.withColumn("name", plain("s3_key")), bad.select("name"), ["name"], "left_anti") if failed else rows.withColumn("name", F.lit(""))
    load_partitioned(warehouse_cast(good.drop("s3_key", "name"), partition_col), table, partition_col, load_id)
    if failures:
        delete_folder(spark, f"{failures}/load_id={escaped(load_id)}")
        overwrite_partitions(bad.select("s3_key", "reason").withColumn("load_id", F.lit(load_id)), failures, "load_id")
    record_processed(ledger, audited.filter(F.col("reason").isNull()), at, load_id)
    return failed


def position_path(ledger: str) -> str:
    """Where the loads of a ledger keep how far they have come."""
    return f"{ledger.rstrip('/')}-position"


def load_open(spark: SparkSession, lake: str, prefix: str, schema: T.StructType, table: str, ledger: str, partition_col: str,
              at: datetime, failures: str | None = None, max_batches: int | None = None) -> list[str]:
    """Load what has been committed since the run before, and again the batches with objects that failed.

    ``max_batches`` leaves the rest to the next run. Returns the names of the batches loaded. The commits behind the run's
    position are all that is looked at, and the position moves on batch by batch.
    """
    check_partition_column(schema, partition_col)
    place = position_path(ledger)
    position = read_position(spark, place)
    again = {b: days for b, days in position["again"]}
    queue = [(b, days, None) for b, days in again.items()]
    queue += [(c["batch_id"], c["days"], c["number"]) for c in CommitLog(spark, lake, prefix).after(position["number"])]
    newest = {b: i for i, (b, _, _) in enumerate(queue)}
    loaded: list[str] = []
    for i, (batch_id, days, number) in enumerate(queue):
        if newest[batch_id] == i:
            if max_batches is not None and len(loaded) >= max_batches:
                break
            failed = load_batch(spark, lake, prefix, batch_id, schema, table, ledger, partition_col, at, failures, days)
            again.pop(batch_id, None)
            if failed:
                again[batch_id] = days
            loaded.append(batch_id)
        # A batch that was committed again is loaded once, at its newest commit.
        position = {"number": position["number"] if number is None else number, "again": list(again.items())}
        write_position(spark, place, position)
    return loaded


def stream_load_files(spark: SparkSession, lake: str, prefix: str, schema: T.StructType, table: str, ledger: str,
                      checkpoint: str, partition_col: str, at: datetime, failures: str | None = None,
                      max_files: int | None = None, every: str | None = None) -> StreamingQuery:
    """Load lake batches as they are committed.

    The stream sees commits only, and the position of the loads decides what is
    loaded. So a damaged object stops nothing, a new checkpoint loads nothing
    twice, and the objects of the feed are never listed.
    """
    check_partition_column(schema, partition_col)
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def handle(batch: DataFrame, batch_id: int) -> None:
        load_open(batch.sparkSession, lake, prefix, schema, table, ledger, partition_col, at, failures)

    return for_each_batch(reader.load(CommitLog(spark, lake, prefix).path), checkpoint, handle, every)


def load_incremental(spark: SparkSession, lake: str, prefix: str, schema: T.StructType, table: str, state: str,
                     partition_col: str, at: datetime, max_batches: int | None = None) -> DataFrame:
    """One run of the warehouse load; returns the objects that could not be loaded."""
    load_open(spark, lake, prefix, schema, table, f"{state}/ledger", partition_col, at, f"{state}/failures", max_batches)
    return read_failures(spark, f"{state}/failures")


def read_loaded(spark: SparkSession, table: str) -> DataFrame:
    """The loaded table without the load bookkeeping."""
    return spark.read.parquet(table).drop("load_id")
