"""Second runs, several feeds, damaged input: what one run alone does not show."""

import os
from datetime import date, datetime, timedelta, timezone

import pytest

from conftest import rows
from gridmill.operators import retention
from gridmill.operators.quality import malformed_rows
from gridmill.plans import jobs
from gridmill.schemas import FORECAST_ELEMENTS
from gridmill.sinks import lake as K
from gridmill.sources import climate, forecast, lake as S
from gridmill.streaming import sinks
from test_sources import FIRST, PLACE, SECOND, kml, series

AT = datetime(2024, 1, 17, 15, 30, tzinfo=timezone.utc)
FEED = "electricity/load"
TABLE = "date timestamp, v long, year int, month int"


def dated(spark, *values, day="2024-01-05"):
    return spark.createDataFrame([(f"{day}-{v}", v) for v in values], "period_key string, v long").selectExpr(
        "period_key", f"timestamp'{day}' AS date", "v", "2024 AS year", "1 AS month")


def load(spark, work, feed=FEED, state="s", **options):
    schema = spark.createDataFrame([], TABLE).schema
    return sinks.load_incremental(spark, f"{work}/lake", feed, schema, f"{work}/t", f"{work}/{state}", "date", AT, **options)


def loaded(spark, work):
    return rows(sinks.read_loaded(spark, f"{work}/t"), "v")


def test_two_feeds_into_one_table(spark, work):
    for feed, v in ((FEED, 1), ("others/gas", 2)):
        K.write_once(dated(spark, v), f"{work}/lake", feed, "a")
        load(spark, work, feed, feed)
    assert loaded(spark, work) == [(1,), (2,)]
    # A new state folder, as after its loss, loads the same batches into the same place.
    load(spark, work, FEED, "new")
    assert loaded(spark, work) == [(1,), (2,)]


def test_only_finished_batches_are_loaded(spark, work):
    K.write_once(dated(spark, 1), f"{work}/lake", FEED, "a")
    dead = dated(spark, 9).selectExpr("*", "'2024-01-05' AS period", "'dead' AS batch_id")
    K.overwrite_partitions(dead, S.data_path(f"{work}/lake", FEED), "period", "batch_id")
    S.make_folder(spark, f"{S.meta_path(f'{work}/lake', FEED, 'started')}/batch_id=dead")
    load(spark, work)
    assert loaded(spark, work) == [(1,)]
    K.write_once(dated(spark, 9), f"{work}/lake", FEED, "next")
    load(spark, work)
    assert loaded(spark, work) == [(1,), (9,)]


def test_repeated_batch_replaces_its_rows(spark, work):
    for _ in range(2):
        K.write_once(dated(spark, 1, 2), f"{work}/lake", FEED, "a")
        load(spark, work)
    load(spark, work)
    assert loaded(spark, work) == [(1,), (2,)]


def test_damaged_object_is_tried_again(spark, work):
    for batch, v in (("a", 1), ("b", 2), ("c", 3)):
        df = dated(spark, v)
        K.write_once(df.selectExpr("period_key", "cast(null AS timestamp) AS date", "v", "year", "month") if batch == "c" else df, f"{work}/lake", FEED, batch)
    [broken] = [r["path"] for r in K.batch_objects(spark, f"{work}/lake", FEED, "b").collect()]
    broken = broken.replace("file:", "")
    good = open(broken, "rb").read()
    for name, content in ((broken, b"no parquet"), (os.path.join(os.path.dirname(broken), f".{os.path.basename(broken)}.crc"), None)):
        if content is None:
            os.path.exists(name) and os.remove(name)
        else:
            open(name, "wb").write(content)
    failures = load(spark, work)
    assert rows(failures, "reason") == [("no rows: damaged or empty",), ("no value in date",)]
    assert loaded(spark, work) == [(1,)]
    open(broken, "wb").write(good)
    K.write_once(dated(spark, 3), f"{work}/lake", FEED, "c")
    assert load(spark, work).count() == 0
    assert loaded(spark, work) == [(1,), (2,), (3,)]


def test_bounded_run_leaves_the_rest_to_the_next(spark, work):
    for batch, v in (("a", 1), ("b", 2), ("c", 3)):
        K.write_once(dated(spark, v), f"{work}/lake", FEED, batch)
    load(spark, work, max_batches=2)
    assert len(loaded(spark, work)) == 2
    load(spark, work, max_batches=2)
    assert loaded(spark, work) == [(1,), (2,), (3,)]


def test_stream_of_names_loads_batches(spark, work):
    schema = spark.createDataFrame([], TABLE).schema
    for batch, v in (("a", 1), ("b", 2)):
        K.write_once(dated(spark, v), f"{work}/lake", FEED, batch)
        for checkpoint in ("c", "c", f"new-{batch}"):
            sinks.stream_load_files(spark, f"{work}/lake", FEED, schema, f"{work}/t", f"{work}/ledger", f"{work}/{checkpoint}", "date", AT, max_files=1)
    assert loaded(spark, work) == [(1,), (2,)]


def test_batch_reads_claims_of_its_days_only(spark, work):
    """What a batch lists and reads does not grow with the batches before it."""
    seen = []
    plain = K.read_claims

    def watched(spark, lake, feed, key=(K.KEY,), days=None):
        out = plain(spark, lake, feed, key, days)
        seen.append(len(out.inputFiles()))
        return out

    K.read_claims = watched
    try:
        for n in range(6):
            K.write_once(dated(spark, n, day=f"2024-01-{n + 1:02d}").coalesce(1), work, FEED, f"b{n}")
    finally:
        K.read_claims = plain
    assert max(seen) <= 1
    assert S.folders(spark, S.meta_path(work, FEED, "started")) == []


def generation(spark, *days):
    return spark.createDataFrame([(i, f"{d} 12:00:00+00:00") for i, d in enumerate(days)], "v long, Date string")


def test_generation_on_following_days(spark, work):
    days = [f"2024-01-{d:02d}" for d in range(9, 17)]
    for as_of in (datetime(2024, 1, 15, 9, tzinfo=timezone.utc), datetime(2024, 1, 16, 9, tzinfo=timezone.utc)):
        jobs.generation_job(spark, generation(spark, *days), f"{work}/lake", f"{work}/t", f"{work}/s", as_of)
    assert rows(sinks.read_loaded(spark, f"{work}/t"), "date") == [(date(2024, 1, d),) for d in range(10, 16)]
    assert K.existing_keys(spark, f"{work}/lake", "electricity/generation").count() == 6


def message(stamp, value):
    return f'{{"date": "{stamp}+00:00", "load": {value}, "key_id": "record_0"}}'


def test_open_hours_wait_for_the_next_run(spark, work):
    deliveries = [
        (datetime(2024, 1, 17, 15, 30), [message("2024-01-17 14:10:00", 1), message("2024-01-17 15:10:00", 2), "{broken"]),
        (datetime(2024, 1, 17, 16, 30), [message("2024-01-17 15:50:00", 3), message("2024-01-17 22:40:00", 4), message("never", 9)]),
        (datetime(2024, 1, 18, 9, 30), [message("2024-01-18 07:00:00", 5), message("2024-01-17 14:20:00", 8)]),
    ]
    for as_of, lines in deliveries:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{work}/in")
        for _ in range(2):  # every run twice
            jobs.load_job(spark, f"{work}/in", f"{work}/lake", f"{work}/t", f"{work}/s", as_of.replace(tzinfo=timezone.utc))
    assert rows(sinks.read_loaded(spark, f"{work}/t"), "load") == [(float(v),) for v in range(1, 6)]
    assert rows(sinks.read_quarantine(spark, f"{work}/s/quarantine"), "problem") == [("no such JSON object",), ("no time in date",)]
    assert rows(K.late_counts(spark, f"{work}/lake", FEED), "late_rows")[-1] == (1,)


def test_backlog_of_an_outage_is_loaded_or_counted(spark, work):
    deliveries = [
        (datetime(2024, 1, 17, 15, 30), [message("2024-01-17 14:10:00", 1)]),
        (datetime(2024, 1, 20, 9, 30), [message("2024-01-20 07:10:00", 2)]),
        (datetime(2024, 1, 21, 9, 30), [message("2024-01-17 14:20:00", 8), message("2024-01-17 20:10:00", 3), message("2024-01-18 11:10:00", 4)]),
    ]
    for as_of, lines in deliveries:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{work}/in")
        for _ in range(2):  # every run twice
            jobs.load_job(spark, f"{work}/in", f"{work}/lake", f"{work}/t", f"{work}/s", as_of.replace(tzinfo=timezone.utc))
    assert rows(sinks.read_loaded(spark, f"{work}/t"), "load") == [(1.0,), (2.0,), (3.0,), (4.0,)]
    assert rows(K.late_counts(spark, f"{work}/lake", FEED), "late_rows")[-1] == (1,)


def test_runs_list_the_days_of_new_landings_only(spark, work, monkeypatch):
    asked = []
    plain = jobs.path_exists
    monkeypatch.setattr(jobs, "path_exists", lambda spark, path: asked.append(path) or plain(spark, path))
    for day in range(10, 16):
        lines = [message(f"2024-01-{day} 07:10:00", day)] + ([message("2024-01-11 09:00:00", 1)] if day == 15 else [])
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{work}/in")
        asked.clear()
        jobs.load_job(spark, f"{work}/in", f"{work}/lake", f"{work}/t", f"{work}/s", datetime(2024, 1, day, 9, 30, tzinfo=timezone.utc))
    assert sorted(p[-10:] for p in asked) == ["2024-01-11", "2024-01-14", "2024-01-15"]
    assert rows(sinks.read_loaded(spark, f"{work}/t"), "load") == [(1.0,), *[(float(d),) for d in range(10, 16)]]


def test_gas_over_a_weekend(spark, work):
    gas = lambda stamp, v: f'{{"date": "{stamp}+00:00", "open_price": {v}, "close_price": {v}, "key_id": "record_0"}}'
    lines = [gas("2024-01-19 10:00:00", 1), gas("2024-01-19 22:10:00", 2), gas("2024-01-22 09:00:00", 3)]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{work}/in")
    for as_of, want in ((datetime(2024, 1, 20, 15), [1.0]), (datetime(2024, 1, 22, 12), [1.0, 2.0, 3.0])):
        jobs.gas_job(spark, f"{work}/in", f"{work}/lake", f"{work}/t", f"{work}/s", as_of.replace(tzinfo=timezone.utc))
        assert rows(sinks.read_loaded(spark, f"{work}/t"), "open_price") == [(v,) for v in want]


# -- sources -----------------------------------------------------------------------

def test_climate_columns_by_name(spark, work):
    os.makedirs(work)
    open(f"{work}/a.txt", "w").write("STATIONS_ID;MESS_DATUM;QN_9;TT_TU;eor\n 1;2024011700; 3; 5.5;eor\n")
    open(f"{work}/b.txt", "w").write("STATIONS_ID;MESS_DATUM;TT_TU;QN_9;eor\n 2;2024011700; 6.5; 3;eor\n")
    df = climate.read_climate_text(spark, work)
    assert rows(df, "STATIONS_ID", "TT_TU", "QN_9") == [(1, 5.5, 3.0), (2, 6.5, 3.0)]
    with pytest.raises(Exception):
        climate.read_climate_text(spark, work, ["STATIONS_ID", "MESS_DATUM", "QN_9", "TT_TU", "eor"]).collect()


LONG = PLACE.format(name="3", station="LONG", coords="1,2,3", body=series("TTT", "1 2 3 4"))
TEXT = PLACE.format(name="4", station="TEXT", coords="1,2,3", body=series("TTT", "1 x 3"))


@pytest.mark.parametrize("extra, problem", [(LONG, "length"), (TEXT, "number")])
def test_forecast_problems_are_errors(spark, work, extra, problem):
    os.makedirs(f"{work}/in")
    open(f"{work}/in/f.kml", "w").write(kml([FIRST, SECOND, extra]))
    places, steps = forecast.read_placemarks(spark, f"{work}/in"), forecast.read_steps(spark, f"{work}/in")
    assert rows(malformed_rows(places, steps), "problem") == [(problem,)]
    with pytest.raises(Exception, match=problem):
        forecast.forecast_wide(places, steps, list(FORECAST_ELEMENTS), strict=True).collect()
    with pytest.raises(Exception, match=problem):
        jobs.weather_forecast_job(spark, f"{work}/in", f"{work}/lake", f"{work}/t", f"{work}/s", AT - timedelta(days=1))
    jobs.weather_forecast_job(spark, f"{work}/in", f"{work}/lake", f"{work}/t", f"{work}/s", AT - timedelta(days=1), stations=["ULM"])
    assert sinks.read_loaded(spark, f"{work}/t").count() == 3
    with pytest.raises(ValueError, match="ATLANTIS"):
        jobs.weather_forecast_job(spark, f"{work}/in", f"{work}/lake", f"{work}/t", f"{work}/s", AT, stations=["ATLANTIS"])


def test_values_without_a_step_keep_their_rows(spark, work):
    os.makedirs(work)
    open(f"{work}/f.kml", "w").write(kml([LONG]))
    got = forecast.read_forecast_xml(spark, work)
    assert rows(got.selectExpr("step", "value", "forecast_time IS NULL")) == [(0, 1.0, False), (1, 2.0, False), (2, 3.0, False), (3, 4.0, True)]


# -- retention and reads ---------------------------------------------------------------

def test_rows_without_a_day_stay_in_both_forms(spark, work):
    df = spark.sql("SELECT 1 AS v, date'2024-01-01' AS date UNION ALL SELECT 2, date'2024-01-16' UNION ALL SELECT 3, null")
    df.write.partitionBy("date").parquet(work)
    want = [(2,), (3,)]
    assert rows(retention.expire_partitions(spark.read.parquet(work), "date", AT, 7), "v") == want
    assert jobs.expire_table(spark, work, "date", AT, 7) == ["2024-01-01"]
    assert rows(spark.read.parquet(work), "v") == want


@pytest.mark.parametrize("path, want", [
    ("s3a://bucket/data/x=1/f.parquet", ("s3://bucket", "bucket/data/x=1/f.parquet")),
    ("gs://b/f", ("gs://b", "b/f")),
    ("hdfs://node:9000/a/f", ("hdfs://node:9000/", "/a/f")),
    ("file:/tmp/f", ("file:///", "/tmp/f")),
    ("file:///tmp/f", ("file:///", "/tmp/f")),
    ("/tmp/f", ("file:///", "/tmp/f")),
])
def test_store_of_a_path(path, want):
    assert retention.store_uri(path) == want


def test_days_prune_the_scan(spark, work):
    for n in range(1, 5):
        K.write_once(dated(spark, n, day=f"2024-01-{n:02d}"), work, FEED, f"b{n}")
    got = S.read_lake(spark, work, FEED, days=("2024-01-02", "2024-01-03"))
    assert rows(got, "v") == [(2,), (3,)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "period" in filters


def test_batch_numbers_need_no_single_task(spark):
    keys = spark.range(1000).selectExpr("format_string('k%05d', id) AS s3_key").repartition(4)
    got = retention.delete_batches(keys, 10)
    assert rows(got) == [(f"k{i:05d}", i // 10) for i in range(1000)]


def test_one_call_for_a_thousand_keys(spark):
    """Calls follow the number of keys, whatever tasks they fall to; keys are computed once, failed ones alone are asked for again."""
    calls, asked, made = (spark.sparkContext.accumulator(0) for _ in range(3))

    def store(paths):
        calls.add(1)
        asked.add(len(paths))
        return ["busy" if p.endswith("7") and len(paths) > 200 else None for p in paths]

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    keys = spark.range(25_500).selectExpr("format_string('k%06d', id) AS s3_key").repartition(5).mapInArrow(count, "s3_key string")
    report = retention.purge(keys, size=1000, dry_run=False, delete=store, wait=0, tasks=3)
    assert report.groupBy("status").count().collect() == [("deleted", 25_500)]
    assert rows(report.groupBy("batch").count().selectExpr("count").distinct()) == [(500,), (1000,)]
    assert calls.value == 26 + 26 and asked.value == 25_500 + 2550
    assert made.value == 25_500


def test_answers_after_the_last_attempt(spark):
    keys = spark.range(5).selectExpr("concat('k', id) AS s3_key")
    report = retention.purge(keys, size=2, dry_run=False, delete=lambda p: ["denied" if x == "k3" else None for x in p], wait=0)
    assert rows(report.filter("status = 'failed'"), "s3_key", "error") == [("k3", "denied")]
    assert retention.purge(keys.limit(0), dry_run=False, wait=0).count() == 0
