"""End-to-end jobs: source to lake to warehouse table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta, timezone

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from gridmill.functions.columns import (
    all_of, drop_any_null, drop_for_parameter, kelvin_to_celsius, narrow, normalize_headers, quoted, rename,
)
from gridmill.functions.timecols import (
    BERLIN, as_utc, between, in_month, instant, local_midnight, parse_hour_stamp, parse_iso, to_local, with_calendar_parts,
)
from gridmill.operators.periods import (
    HOUR_KEY, closed_hours_end, slice_last_days, slice_next_days, slice_same_day, trading_hours,
)
from gridmill.operators.retention import drop_expired_partitions, expired_objects, purge
from gridmill.operators.shape import current_mark, dedup_prefer, union_sources
from gridmill.operators.skew import ahead_of
from gridmill.operators.stations import missing_stations
from gridmill.schemas import FORECAST_ELEMENTS, GAS_MESSAGE, KELVIN_COLUMNS, LOAD_MESSAGE, weather_parameter
from gridmill.session import checkpointed
from gridmill.operators.ingest import as_message, merged_marks, to_publish
from gridmill.sinks.lake import KEY, publish, read_ahead, read_ledger, write_once
from gridmill.sinks.marks import last_row, read_counts, read_marks, write_counts, write_marks, write_row
from gridmill.sources.forecast import forecast_wide, read_placemarks, read_steps
from gridmill.sources.lake import path_exists
from gridmill.streaming.sinks import land_messages, landing_log, load_incremental


# -- transforms ----------------------------------------------------------------------

def transform_forecast(wide: DataFrame, tz: str = BERLIN) -> DataFrame:
    """Readable names, local calendar parts, narrow types, then Celsius in single precision."""
    parts = with_calendar_parts(rename(wide, FORECAST_ELEMENTS), to_local("forecast_time", tz), ("day", "month", "year"))
    return kelvin_to_celsius(narrow(parts), KELVIN_COLUMNS)


def transform_generation(raw: DataFrame, headers: Sequence | None = None, tz: str = BERLIN) -> DataFrame:
    """Flat headers and local calendar parts."""
    named = normalize_headers(raw, headers)
    typed = named.withColumn("date", parse_iso("date")) if dict(named.dtypes)["date"] == "string" else named
    return with_calendar_parts(typed, to_local("date", tz))


def transform_climate(merged: DataFrame, parameter: str, tz: str = BERLIN) -> DataFrame:
    """Measurement time, local calendar parts, narrow types; the station stays as the lake folder."""
    kept = drop_for_parameter(merged, parameter)
    timed = rename(kept.withColumn("MESS_DATUM", parse_hour_stamp("MESS_DATUM")), {"MESS_DATUM": "measurement_time"})
    parts = with_calendar_parts(timed, to_local("measurement_time", tz), ("day", "month", "year", "hour"))
    return narrow(parts.withColumn("station", F.col("STATIONS_ID").cast("string")).drop("STATIONS_ID"))


def merge_climate(recent: DataFrame | None, historical: DataFrame | None) -> DataFrame:
    """Recent and historical rows, one per station and hour, the recent one preferred."""
    stacked = union_sources([recent, historical])
    others = [c for c in stacked.columns if c not in ("STATIONS_ID", "MESS_DATUM", "src_rank")]
    chosen = dedup_prefer(stacked, ["STATIONS_ID", "MESS_DATUM"], ["src_rank", *others])
    return chosen.drop("src_rank")


def gas_feed(quotes: DataFrame, tz: str = BERLIN) -> DataFrame:
    """Quote history to the published price table; ``date_local`` is the exchange-side wall time."""
    named = rename(quotes, {"Datetime": "date", "Open": "open_price", "Close": "close_price"})
    return named.withColumn("date_local", to_local("date", tz))


def load_feed(history: DataFrame, unique: Sequence[str] = ()) -> DataFrame:
    """Load history: published names, complete rows, in time order."""
    named = drop_any_null(rename(history, {"index": "date", "Actual Load": "load"}))
    return named.orderBy("date", *[quoted(c) for c in unique])


# -- jobs ------------------------------------------------------------------------------

def run_id(as_of: datetime) -> str:
    """Name of the lake batch of a run: a repeated run of the same instant replaces its own rows, any other adds to them."""
    return f"run-{as_utc(as_of):%Y%m%dT%H%M%S}"


def through_lake(rows: DataFrame, lake: str, feed: str, table: str, state: str, partition_col: str, at: datetime,
                 batch_id: str | None = None, key: Sequence[str] = (KEY,), keep_late: bool = False,
                 keep_days: int | None = None) -> DataFrame:
    """Write keyed rows once to the lake, then load the open batches; returns the objects that failed.

    The rows are a slice of a parsed source and are needed twice, so they are
    kept instead of being parsed again. With ``keep_days`` the load drops the
    table's days that are older.
    """
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_once(rows, lake, feed, batch_id or run_id(at), key, keep_late)
    finally:
        rows.unpersist()
    return to_warehouse(rows, lake, feed, table, state, partition_col, at, keep_days)


def to_warehouse(rows: DataFrame, lake: str, feed: str, table: str, state: str, partition_col: str,
                 at: datetime, keep_days: int | None = None) -> DataFrame:
    """Load the new lake objects of a feed, whose schema is that of the rows written; then drop expired days of the table."""
    failed = load_incremental(rows.sparkSession, lake, feed, rows.drop(KEY).schema, table, state, partition_col, at)
    if keep_days is not None:
        expire_table(rows.sparkSession, table, partition_col, at, keep_days)
    return failed


def weather_forecast_job(spark: SparkSession, paths, lake: str, table: str, state: str, as_of: datetime,
                         n_days: int = 3, stations=None, zipped: bool = False, batch_id: str | None = None,
                         strict: bool = True, keep_days: int | None = None) -> DataFrame:
    """Forecast files to the table of the next days. A key is a station and a day.

    Unless ``strict`` is off, a malformed placemark or a requested station without one fails the run.
    """
    places = read_placemarks(spark, paths, zipped)
    if strict and stations is not None:
        absent = [r[0] for r in missing_stations(places, stations).limit(20).collect()]
        if absent:
            raise ValueError(f"no forecast for stations: {', '.join(map(str, absent))}")
    wide = forecast_wide(places, read_steps(spark, paths, zipped), list(FORECAST_ELEMENTS), stations, strict).drop("file")
    rows = slice_next_days(transform_forecast(wide), "forecast_time", as_of, n_days)
    return through_lake(rows, lake, "weather_forecast", table, state, "forecast_time", as_of, batch_id,
                        ["station", KEY], keep_days=keep_days)


def generation_job(spark: SparkSession, raw: DataFrame, lake: str, table: str, state: str, as_of: datetime,
                   month: tuple[int, int] | None = None, headers: Sequence | None = None,
                   batch_id: str | None = None, keep_days: int | None = None) -> DataFrame:
    """Generation table to the table of the last five days."""
    rows = transform_generation(raw, headers)
    if month is not None:
        rows = rows.filter(in_month("date", *month))
    return through_lake(slice_last_days(rows, "date", as_of), lake, "electricity/generation", table, state, "date",
                        as_of, batch_id, keep_days=keep_days)


def historical_weather_job(spark: SparkSession, recent: DataFrame | None, historical: DataFrame | None, parameter: str,
                           lake: str, table: str, state: str, as_of: datetime, batch_id: str | None = None,
                           keep_days: int | None = None) -> DataFrame:
    """Two station tables to the table of the same calendar day in five years."""
    feed = f"historical_weather/{weather_parameter(parameter)[0]}"
    rows = transform_climate(merge_climate(recent, historical), parameter)
    return through_lake(slice_same_day(rows, "measurement_time", as_of), lake, feed, table, state, "measurement_time",
                        as_of, batch_id, ["station", KEY], keep_days=keep_days)


def closed_hours_job(spark: SparkSession, source: str | Mapping, schema: T.StructType, values: Sequence[str], feed: str, lake: str,
                     table: str, state: str, as_of: datetime, first: datetime, end: datetime, tz: str = BERLIN, keep_days: int | None = None) -> DataFrame:
    """Land the new messages, then pass on all hours that have closed since the run before; returns the objects that failed.

    Rows of an open hour wait in the landing table. The first run begins at
    ``first``, any other where the one before it ended, so no hour is left out,
    the last of a day neither. Rows that land after their hour has closed are
    looked for by landing batch, however late: those of hours passed on already
    are counted as late, those of hours that had no rows are loaded. A run reads
    the days since the run before and the days that landings since then have
    added to; other folders of the landing table are not listed. Messages that
    cannot be used are in ``state``/quarantine.
    """
    parts = ("day", "month", "year", "hour", "minute")
    land_messages(spark, source, schema, values, parts, f"{state}/landed", f"{state}/quarantine", f"{state}/consume")
    stamp = int(as_utc(as_of).timestamp())
    marks = T.StructType([T.StructField("begin", T.TimestampType()), T.StructField("end", T.TimestampType()), T.StructField("batch", T.LongType()), T.StructField("number", T.LongType())])
    begun = last_row(spark, f"{state}/closed", stamp, marks)
    begin, since = (as_utc(first),) * 2 if begun is None else (begun[c].astimezone(timezone.utc) for c in ("begin", "end"))
    until = max(as_utc(end), since)
    typed = T.StructType([T.StructField("date", T.TimestampType()), *[T.StructField(v, T.FloatType()) for v in values],
                          *[T.StructField(p, T.ShortType() if p == "year" else T.ByteType()) for p in parts],
                          T.StructField("landed_day", T.DateType()), T.StructField("batch_id", T.LongType())])
    rows = spark.createDataFrame([], typed)
    seen = -1 if begun is None else begun["batch"]
    landed_after = F.col("batch_id") > seen
    number = 0 if begun is None else begun["number"]
    landings = landing_log(spark, f"{state}/landed").after(number)
    days = {(since + timedelta(days=k)).date().isoformat() for k in range((until.date() - since.date()).days + 1)}
    days |= {d for c in landings for d in c["days"] if begin.date().isoformat() <= d <= until.date().isoformat()}
    paths = [p for p in (f"{state}/landed/landed_day={d}" for d in sorted(days)) if path_exists(spark, p)]
    if paths:
        rows = spark.read.schema(typed).option("basePath", f"{state}/landed").parquet(*paths)
    # Rows before ``since`` were passed on, unless they have landed after that.
    rows = rows.filter(between(F.col("date"), begin, until) & ((F.col("date") >= instant(since)) | landed_after))
    last = rows.agg(F.max("batch_id")).first()[0]
    closed = rows.select("date", *values, *parts).withColumn(KEY, F.date_format(to_local("date", tz), HOUR_KEY))
    failed = through_lake(closed, lake, feed, table, state, "date", as_of, keep_late=True, keep_days=keep_days)
    write_row(spark.createDataFrame([(begin, until, seen if last is None else max(last, seen), landings[-1]["number"] if landings else number)], marks), f"{state}/closed", stamp)
    return failed


def load_job(spark: SparkSession, source: str | Mapping, lake: str, table: str, state: str, as_of: datetime,
             keep_days: int | None = None) -> DataFrame:
    """Load messages to the table: completed hours, from the first run's day on."""
    end = closed_hours_end(as_of)
    return closed_hours_job(spark, source, LOAD_MESSAGE, ["load"], "electricity/load", lake, table, state, as_of,
                            local_midnight(end.date(), BERLIN), end, keep_days=keep_days)


def gas_job(spark: SparkSession, source: str | Mapping, lake: str, table: str, state: str, as_of: datetime,
            keep_days: int | None = None) -> DataFrame:
    """Gas messages to the table: completed trading hours, from the first run's trading day on."""
    first, end = trading_hours(as_of)
    return closed_hours_job(spark, source, GAS_MESSAGE, ["open_price", "close_price"], "others/gas", lake, table, state, as_of, first, end,
                            keep_days=keep_days)


SENT = T.StructField("sent", T.LongType())


def publish_incremental(df: DataFrame, target, state: str, run: int, order: Sequence[str], field: str,
                        fields: Sequence[str], by: Sequence[str] = (), marks: DataFrame | None = None,
                        predicates: Sequence[Column] = ()) -> None:
    """Send the rows ahead of the stored marks and store the marks that rise as version ``run``.

    Rows at or below their mark cannot be sent, so they go by a join with the
    marks before anything is ordered: what is shuffled is what is new. Sending
    comes first: a run that fails in between sends again. A folder target gets
    one subfolder per run, which a repeated run replaces. Record numbers go on
    from run to run. A repeated run starts from the marks and numbers it had;
    the versions of later runs stay as they are.
    """
    spark = df.sparkSession
    kinds = df.select(*[quoted(c) for c in [*by, field]]).schema
    stored = read_marks(spark, f"{state}/marks", run, kinds)
    before = marks if stored is None else stored
    above = ahead_of(df.filter(all_of(*predicates)), before, by, field)
    numbers = read_counts(spark, f"{state}/sent", run, T.StructType([*[kinds[c] for c in by], SENT]))
    kept = [*fields, *[c for c in [field] if c not in fields]]
    records = checkpointed(to_publish(above, order, field, kept, by, numbers=numbers))
    asked = records.select(*[quoted(c) for c in records.columns if c in {*by, *fields, "key_id"}])
    messages = as_message(asked) if "date" in asked.columns else asked
    if isinstance(target, str):
        publish(messages, f"{target.rstrip('/')}/run={run}", mode="overwrite")
    else:
        publish(messages, target)
    write_counts(records.groupBy(*[quoted(c) for c in by]).agg(F.count(F.lit(1)).alias("sent")), f"{state}/sent", run)
    # The newest row of a source is always sent unless the mark is newer.
    raised = merged_marks(marks, records, field, by) if stored is None else current_mark(records, field, by)
    write_marks(raised.select(*[quoted(c) for c in kinds.names]), f"{state}/marks", run)


def publish_from_lake(spark: SparkSession, lake: str, feed: str, schema: T.StructType, target, state: str, run: int, order: Sequence[str],
                      field: str, fields: Sequence[str], by: Sequence[str] = (), marks: DataFrame | None = None,
                      predicates: Sequence[Column] = ()) -> None:
    """As ``publish_incremental``, from a feed written with ``zones=(by, field)``.

    Only files that may hold something above the marks are read: a run over a history of which little is new reads that little.
    """
    kinds = T.StructType([schema[c] for c in [*by, field]])
    stored = read_marks(spark, f"{state}/marks", run, kinds)
    rows = read_ahead(spark, lake, feed, schema, marks if stored is None else stored, by, field)
    publish_incremental(rows, target, state, run, order, field, fields, by, marks, predicates)


def cleanup_job(ledger: DataFrame, as_of: datetime, days: int = 7, dry_run: bool = True, **options) -> DataFrame:
    """Report (and, unless dry, delete) objects loaded more than ``days`` ago."""
    return purge(expired_objects(ledger, as_of, days), dry_run=dry_run, **options)


def cleanup(spark: SparkSession, ledger_path: str, as_of: datetime, days: int = 7, **options) -> DataFrame:
    return cleanup_job(read_ledger(spark, ledger_path), as_of, days, **options)


def expire_table(spark: SparkSession, table: str, date_col: str, as_of: datetime, days: int) -> list[str]:
    """Table expiry as a step of a load run: drops the day folders older than ``days``; rows without a day stay."""
    return drop_expired_partitions(spark, table, date_col, as_of, days)
