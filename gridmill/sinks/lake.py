"""Writes: write-once lake keys, partitioned tables, messages, CSV, ledger."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gridmill.functions.columns import quoted, to_json_value
from gridmill.functions.timecols import instant
from gridmill.operators.skew import ahead_of, keyed_join
from gridmill.schemas import LEDGER
from gridmill.sinks.commits import ABANDONED, BATCH as COMMITTED, CommitLog
from gridmill.sources.lake import (
    data_path, delete_folder, delete_matching, escaped, folders, make_folder, meta_path, path_exists,
)
from gridmill.sources.topic import register

KEY = "period_key"
BATCH = "batch_id"


def overwrite_partitions(df: DataFrame, path: str, *cols: str) -> None:
    """Replace exactly the partitions present in ``df``: safe to repeat."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*cols).parquet(path))


def balanced(df: DataFrame, *cols: str) -> DataFrame:
    """Rows of a partition together, large partitions split over tasks by AQE."""
    return df.hint("rebalance", *cols)


# A lake feed is laid out as data/<feed>/period=<day>/batch_id=<batch>/*.parquet.
# Which keys are taken is kept beside it as claims/period=<day>/batch_id=<batch>,
# so that keys may be finer than folders: many hours or stations share the files
# of a day. A batch reads the claims of its own days only. The commit log says
# which batches are whole; what it does not name is no part of the lake.

#: Seconds after which a batch that has not been committed is given up, unless its writer says otherwise.
LEASE = 6 * 3600


def read_claims(spark: SparkSession, lake: str, feed: str, key: Sequence[str] = (KEY,),
                days: Sequence[str] | None = None) -> DataFrame:
    """Keys written so far and the batch that wrote them; ``days`` limits it to keys of these days."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*key, BATCH]])
    path = meta_path(lake, feed, "claims")
    paths = _claimed(spark, lake, feed, days)
    if not paths:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField("period", T.StringType())])
    claims = spark.read.schema(stored).option("basePath", path).parquet(*paths)
    live = CommitLog(spark, lake, feed).live(days).select(BATCH, "period")
    return claims.join(live, [BATCH, "period"], "left_semi").select(*key, BATCH)


def _claimed(spark: SparkSession, lake: str, feed: str, days: Sequence[str] | None) -> list[str]:
    """Folders with claims, of all days or of the given ones."""
    path = meta_path(lake, feed, "claims")
    if days is None:
        return [path] if folders(spark, path) else []
    return [p for p in (f"{path}/period={escaped(d)}" for d in days) if path_exists(spark, p)]


def existing_keys(spark: SparkSession, lake: str, feed: str, key: Sequence[str] = (KEY,),
                  days: Sequence[str] | None = None) -> DataFrame:
    """Keys that are already in the lake, of all days or of the given ones."""
    return read_claims(spark, lake, feed, key, days).select(*key).distinct()


def is_done(spark: SparkSession, lake: str, feed: str, batch_id: str) -> bool:
    return CommitLog(spark, lake, feed).holds(batch_id)


def _folder(lake: str, feed: str, kind: str, day: str, batch_id: str) -> str:
    base = data_path(lake, feed) if kind == "data" else meta_path(lake, feed, kind)
    return f"{base}/period={escaped(day)}/{BATCH}={escaped(batch_id)}"


def _remove_abandoned(spark: SparkSession, lake: str, feed: str, log: CommitLog, own: str) -> None:
    """Give up batches whose writers have died, and delete what they left. Only batches under way are listed.

    Giving up is a commit. Either it comes first and the writer, should it live after all, finds it and stops; or
    the batch comes first and stays.
    """
    marks = meta_path(lake, feed, "started")
    for name in folders(spark, marks):
        batch_id = unquote(name.removeprefix(f"{BATCH}="))
        until = [int(x.removeprefix("until=")) for x in folders(spark, f"{marks}/{name}") if x.startswith("until=")]
        if batch_id == own or max(until, default=0) > time.time():
            continue
        last = log.last()
        holds = log.holds(batch_id)
        while not holds:
            number, others = log.append({"kind": ABANDONED, "batch_id": batch_id, "days": []}, last)
            if number is not None:
                delete_matching(spark, f"{data_path(lake, feed)}/period=*/{name}")
                delete_matching(spark, f"{meta_path(lake, feed, 'claims')}/period=*/{name}")
                break
            last = others[-1]["number"]
            holds = any(c["batch_id"] == batch_id and c["kind"] == COMMITTED for c in others)
        delete_folder(spark, f"{marks}/{name}")


def write_once(df: DataFrame, lake: str, feed: str, batch_id: str, key: Sequence[str] = (KEY,),
               keep_late: bool = False, zones: tuple[Sequence[str], str] | None = None, lease: int = LEASE) -> DataFrame:
    """Write the rows of every key that no earlier batch has written.

    ``period_key`` starts with its day, which names the folder; ``key`` lists
    the (text) columns that make a key. Rows for keys of earlier batches are
    dropped; ``keep_late`` counts them per key. Data goes first, then the claims
    taken from the files written, then the commit. A batch that is repeated
    replaces its own files only.

    Any number of writers may share a feed. The order of commits decides: who
    finds others before it drops the keys they have taken, whatever was written
    by then, and tries again. A batch not committed within ``lease`` seconds
    counts as dead, and what it left is removed by the next writer.

    ``zones`` (columns that name a source, and a field) keeps the field's range
    by file and source, with which ``read_ahead`` finds files. Returns the keys
    of this batch.
    """
    spark = df.sparkSession
    log = CommitLog(spark, lake, feed)
    _remove_abandoned(spark, lake, feed, log, batch_id)
    started = f"{meta_path(lake, feed, 'started')}/{BATCH}={escaped(batch_id)}"
    make_folder(spark, f"{started}/until={int(time.time()) + lease}")
    last = log.last()

    placed = df.withColumn("period", F.substring(KEY, 1, 10))
    # The days of a batch: its slice, not its rows.
    days = [r[0] for r in placed.select("period").distinct().collect() if r[0] is not None]
    earlier = read_claims(spark, lake, feed, key, days).filter(F.col(BATCH) != batch_id).select(*key).distinct()
    # Days without any claim need no join, and so no shuffle by key.
    known = bool(_claimed(spark, lake, feed, days))
    fresh = (keyed_join(placed, earlier, key, "left_anti") if known else placed).withColumn(BATCH, F.lit(batch_id))
    _write_batch(fresh, lake, feed, batch_id, key, days, df.schema, zones)
    if keep_late:
        _count_late(keyed_join(df, earlier, key, "left_semi"), lake, feed, batch_id, key)

    while True:
        written = [d for d in days if path_exists(spark, _folder(lake, feed, "data", d, batch_id))]
        number, others = log.append({"kind": COMMITTED, "batch_id": batch_id, "days": written}, last)
        if number is not None:
            break
        last = others[-1]["number"]
        if any(c["kind"] == ABANDONED and c["batch_id"] == batch_id for c in others):
            raise RuntimeError(f"batch {batch_id} of {feed} was not committed in time and has been given up; run it again")
        rivals = {c["batch_id"]: c["days"] for c in others if c["kind"] == COMMITTED and c["batch_id"] != batch_id}
        shared = [d for d in written if any(d in x for x in rivals.values())]
        taken = read_claims(spark, lake, feed, key, shared).filter(F.col(BATCH).isin(list(rivals))).select(*key).distinct()
        own = _own_claims(spark, lake, feed, batch_id, key, shared)
        lost = [r[0] for r in keyed_join(own, taken, key, "left_semi").select("period").distinct().collect()]
        if not lost:
            continue
        # The keys that others were first to commit are theirs: the days in question are written again without them.
        left = [r[0] for r in keyed_join(own, taken, key, "left_anti").filter(F.col("period").isin(lost)).select("period").distinct().collect()]
        for day in set(lost) - set(left):
            delete_folder(spark, _folder(lake, feed, "data", day, batch_id))
            delete_folder(spark, _folder(lake, feed, "claims", day, batch_id))
        again = keyed_join(fresh.filter(F.col("period").isin(left)), taken, key, "left_anti")
        _write_batch(again, lake, feed, batch_id, key, left, df.schema, zones, written)
        if keep_late:
            before = read_claims(spark, lake, feed, key, days).filter(F.col(BATCH) != batch_id).select(*key).distinct()
            _count_late(keyed_join(df, before, key, "left_semi"), lake, feed, batch_id, key)
    delete_folder(spark, started)
    return read_claims(spark, lake, feed, key, days).filter(F.col(BATCH) == batch_id).select(*key)


def _write_batch(fresh: DataFrame, lake: str, feed: str, batch_id: str, key: Sequence[str], days: Sequence[str], schema: T.StructType,
                 zones: tuple[Sequence[str], str] | None, all_days: Sequence[str] | None = None) -> None:
    """Data of some days, then their claims, then the zones of the whole batch, each taken from the files written."""
    spark = fresh.sparkSession
    overwrite_partitions(balanced(fresh, "period"), data_path(lake, feed), "period", BATCH)
    claims = _written(spark, lake, feed, batch_id, days, schema).select(*key, "period").distinct()
    overwrite_partitions(claims.withColumn(BATCH, F.lit(batch_id)), meta_path(lake, feed, "claims"), "period", BATCH)
    if zones:
        by, field = zones
        rows = _written(spark, lake, feed, batch_id, days if all_days is None else all_days, schema)
        found = rows.groupBy(F.col("_metadata.file_path").alias("file_path"), *[quoted(c) for c in by]).agg(
            F.min(quoted(field)).alias("low"), F.max(quoted(field)).alias("high"), F.count(F.lit(1)).alias("rows"))
        found.write.mode("overwrite").parquet(f"{meta_path(lake, feed, 'zones')}/{BATCH}={escaped(batch_id)}")


def _own_claims(spark: SparkSession, lake: str, feed: str, batch_id: str, key: Sequence[str], days: Sequence[str]) -> DataFrame:
    """Keys and days that a batch has written, committed or not."""
    stored = T.StructType([T.StructField(c, T.StringType()) for c in [*key, "period", BATCH]])
    paths = [p for p in (_folder(lake, feed, "claims", d, batch_id) for d in days) if path_exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], stored)
    return spark.read.schema(stored).option("basePath", meta_path(lake, feed, "claims")).parquet(*paths)


def _count_late(late: DataFrame, lake: str, feed: str, batch_id: str, key: Sequence[str]) -> None:
    late.groupBy(*key).agg(F.count(F.lit(1)).alias("late_rows")).write.mode("overwrite") \
        .parquet(f"{meta_path(lake, feed, 'late')}/{BATCH}={escaped(batch_id)}")


def read_ahead(spark: SparkSession, lake: str, feed: str, schema: T.StructType, marks: DataFrame | None, by: Sequence[str], field: str) -> DataFrame:
    """Rows of the files that may hold something above the marks, by the zones kept when they were written.

    A file is read if one of its sources has no mark or a higher value than it. Batches written without zones are read whole.
    """
    live = CommitLog(spark, lake, feed).live()
    path = meta_path(lake, feed, "zones")
    fields = [*[schema[c] for c in by], T.StructField("low", schema[field].dataType), T.StructField("high", schema[field].dataType)]
    kept = T.StructType([T.StructField("file_path", T.StringType()), *fields, T.StructField(BATCH, T.StringType())])
    zoned = spark.read.schema(kept).parquet(path) if folders(spark, path) else spark.createDataFrame([], kept)
    mine = zoned.join(live.select(BATCH).distinct(), BATCH, "left_semi")
    open_ = ahead_of(mine, None if marks is None else marks.withColumnRenamed(field, "high"), by, "high")
    # Names of the files to read, which the scan holds on the driver in any case.
    paths = [r[0] for r in open_.select("file_path").distinct().collect()]
    whole = live.join(zoned.select(BATCH).distinct(), BATCH, "left_anti").collect()
    paths += [_folder(lake, feed, "data", r["period"], r[BATCH]) for r in whole]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def batch_objects(spark: SparkSession, lake: str, feed: str, batch_id: str) -> DataFrame:
    """The objects of a batch: path, size, time."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .load(f"{data_path(lake, feed)}/period=*/{BATCH}={escaped(batch_id)}/").select("path", "length", "modificationTime"))


def _written(spark: SparkSession, lake: str, feed: str, batch_id: str, days: Sequence[str], schema: T.StructType) -> DataFrame:
    """What a batch has in the lake."""
    base = data_path(lake, feed)
    paths = [p for p in (f"{base}/period={escaped(d)}/{BATCH}={escaped(batch_id)}" for d in days) if path_exists(spark, p)]
    stored = T.StructType([*schema.fields, T.StructField("period", T.StringType()), T.StructField(BATCH, T.StringType())])
    return spark.read.schema(stored).option("basePath", base).parquet(*paths) if paths else spark.createDataFrame([], stored)


def late_counts(spark: SparkSession, lake: str, feed: str, key: Sequence[str] = (KEY,)) -> DataFrame:
    """Dropped rows per key and batch."""
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in key], T.StructField("late_rows", T.LongType()),
                           T.StructField(BATCH, T.StringType())])
    path = meta_path(lake, feed, "late")
    return spark.read.schema(schema).parquet(path) if folders(spark, path) else spark.createDataFrame([], schema)


# -- tables ------------------------------------------------------------------------

def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition_col: str | None = None,
                 location: str | None = None) -> None:
    """Create the table when it is missing."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
                        for f in schema.fields)
    partition = f" PARTITIONED BY (`{partition_col}`)" if partition_col else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{partition}{place}")


def _clustered(df: DataFrame, partition_col: str) -> DataFrame:
    return balanced(df, partition_col).sortWithinPartitions(partition_col, "year", "month")


def append_partitioned(df: DataFrame, path: str, partition_col: str) -> None:
    """Append to a table partitioned by day, sorted by year and month."""
    _clustered(df, partition_col).write.mode("append").partitionBy(partition_col).parquet(path)


def load_partitioned(df: DataFrame, path: str, partition_col: str, load_id: str) -> None:
    """As append, but a repeated load replaces its own rows instead of adding them."""
    rows = df.withColumn("load_id", F.lit(load_id))
    (balanced(rows, partition_col).sortWithinPartitions(partition_col, "load_id", "year", "month")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col, "load_id").parquet(path))


# -- ledger ------------------------------------------------------------------------

def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path).select("s3_key", "processed_at")


def record_processed(path: str, keys: DataFrame, at: datetime, load_id: str) -> None:
    """Record the keys of one load; repeating the load replaces its records."""
    rows = keys.select("s3_key").distinct().withColumn("processed_at", instant(at)) \
        .withColumn("load_id", F.lit(load_id))
    overwrite_partitions(rows, path, "load_id")


# -- messages and files --------------------------------------------------------------

def publish(df: DataFrame, target: str | Mapping, mode: str = "append") -> None:
    """One JSON message per row, to a folder of files, a topic in a folder (``{"topic": path}``) or one of a broker, by its writer options."""
    messages = to_json_value(df)
    if isinstance(target, str):
        messages.write.mode(mode).text(target)
    elif "topic" in target:
        messages.write.format(register(df.sparkSession)).mode("append").options(**target).save()
    else:
        messages.write.format("kafka").options(**target).save()


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("error").option("header", "true").option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSSxxx") \
        .csv(path)
