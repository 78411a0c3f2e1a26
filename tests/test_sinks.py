"""Write-once keys, repeatable loads, retention, and streams that see a batch again."""

import os
from datetime import datetime, timezone

import pytest

from conftest import rows
from gridmill.operators import quality, retention, shape
from gridmill.plans import jobs, marts
from gridmill.sinks import lake as K
from gridmill.sources import lake as S
from gridmill.streaming import feeds as T, sinks

AT = datetime(2024, 1, 17, 15, 30, tzinfo=timezone.utc)
FEED = "electricity/load"


def keyed(spark, *pairs):
    return spark.createDataFrame(list(pairs), "period_key string, v long")


def stored(spark, lake):
    return rows(S.read_lake(spark, lake, f"{FEED}/"), "v")


def test_write_once_skips_keys_of_other_batches(spark, work):
    first = K.write_once(keyed(spark, ("a", 1), ("b", 2), ("b", 3)), work, FEED, "one")
    assert rows(first, "period_key") == [("a",), ("b",)]
    second = K.write_once(keyed(spark, ("b", 9), ("c", 4)), work, FEED, "two", keep_late=True)
    assert rows(second, "period_key") == [("c",)]
    assert stored(spark, work) == [(1,), (2,), (3,), (4,)]
    assert rows(K.late_counts(spark, work, FEED), "period_key", "late_rows") == [("b", 1)]
    assert rows(K.existing_keys(spark, work, FEED)) == [("a",), ("b",), ("c",)]


def test_write_once_repeated_batch_changes_nothing(spark, work):
    for _ in range(3):
        K.write_once(keyed(spark, ("a", 1), ("b", 2)), work, FEED, "one", keep_late=True)
    assert stored(spark, work) == [(1,), (2,)]
    assert K.late_counts(spark, work, FEED).count() == 0


def test_batch_that_died_before_its_claim_is_replaced(spark, work):
    """Data without a claim is no key of an earlier batch: the next run removes it and writes the key whole."""
    K.write_once(keyed(spark, ("k", 0)), work, FEED, "good")
    dead = keyed(spark, ("a", 7)).selectExpr("*", "period_key AS period", "'dead' AS batch_id")
    K.overwrite_partitions(dead, S.data_path(work, FEED), "period", "batch_id")
    S.make_folder(spark, f"{S.meta_path(work, FEED, 'started')}/batch_id=dead")
    K.write_once(keyed(spark, ("a", 1), ("a", 2)), work, FEED, "next")
    assert stored(spark, work) == [(0,), (1,), (2,)]
    assert S.folders(spark, S.meta_path(work, FEED, "started")) == []


def test_batch_repeated_after_a_crash_is_not_removed(spark, work):
    """A started mark beside a claim means a repeat was cut off: its files are complete."""
    K.write_once(keyed(spark, ("a", 1)), work, FEED, "one")
    S.make_folder(spark, f"{S.meta_path(work, FEED, 'started')}/batch_id=one")
    K.write_once(keyed(spark, ("a", 5), ("b", 2)), work, FEED, "two")
    assert stored(spark, work) == [(1,), (2,)]


def test_keys_finer_than_folders(spark, work):
    """Stations of one day share its folder, and each is written once."""
    df = lambda *r: spark.createDataFrame(list(r), "station string, period_key string, v long")
    K.write_once(df(("x", "2024-01-01", 1), ("y", "2024-01-01", 2)), work, FEED, "one", ["station", "period_key"])
    K.write_once(df(("y", "2024-01-01", 8), ("z", "2024-01-01", 3)), work, FEED, "two", ["station", "period_key"])
    assert stored(spark, work) == [(1,), (2,), (3,)]
    assert [n for n in S.folders(spark, S.data_path(work, FEED)) if "=" in n] == ["period=2024-01-01"]
    assert K.existing_keys(spark, work, FEED, ["station", "period_key"]).count() == 3


def test_empty_batch(spark, work):
    assert K.write_once(keyed(spark, ("a", 1)).where("v > 5"), work, FEED, "one").count() == 0
    assert K.existing_keys(spark, work, FEED).count() == 0


def test_hot_key_is_written_by_several_tasks(spark, work):
    """Rebalancing splits a key that holds most of the rows."""
    big = spark.range(200_000).selectExpr("'hot' AS period_key", "id AS v", "uuid() AS pad").repartition(8)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        K.write_once(big, work, FEED, "one")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert S.list_objects(spark, work, f"{FEED}/").count() > 1
    assert S.read_lake(spark, work, f"{FEED}/").count() == 200_000


def test_hot_key_of_a_stream_is_written_by_several_tasks(spark, work):
    """Adaptive execution is on inside micro-batches, too."""
    spark.range(200_000).selectExpr("'2024-01-01-05' AS period_key", "id AS v", "uuid() AS pad").repartition(8) \
        .write.parquet(f"{work}/in")
    stream = spark.readStream.schema("period_key string, v long, pad string").parquet(f"{work}/in")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        sinks.stream_write_once(stream, work, FEED, f"{work}/c")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert S.list_objects(spark, work, f"{FEED}/").count() > 1
    assert S.read_lake(spark, work, f"{FEED}/").count() == 200_000


def test_prefix_selects_feeds(spark, work):
    K.write_once(keyed(spark, ("a", 1)), work, FEED, "one")
    K.write_once(keyed(spark, ("a", 5)), work, "others/gas", "one")
    assert rows(S.read_lake(spark, work, "others/gas"), "v") == [(5,)]


def test_load_replaces_its_own_rows(spark, work):
    df = spark.createDataFrame([("2024-01-01", 1, 2024, 1), ("2024-01-02", 2, 2024, 1)],
                               "date string, v long, year long, month long").selectExpr("cast(date as date) date", "v", "year", "month")
    for load_id in ("x", "x", "y"):
        K.load_partitioned(df, work, "date", load_id)
    assert spark.read.parquet(work).count() == 4


def test_ensure_table_is_repeatable_and_keeps_not_null(spark):
    from gridmill.schemas import LEDGER
    from gridmill.session import scratch

    place = scratch(spark, "table")
    name = f"t_{place.rsplit('-', 1)[-1]}"
    K.ensure_table(spark, name, LEDGER, location=place)
    K.ensure_table(spark, name, LEDGER, location=place)
    assert spark.table(name).columns == ["s3_key", "processed_at"]


def test_purge_deletes_files(spark, work):
    os.makedirs(work)
    names = [f"{work}/f{i}.parquet" for i in range(25)]
    for n in names:
        open(n, "w").close()
    keys = spark.createDataFrame([(n,) for n in [*names, f"{work}/gone.parquet"]], "s3_key string")
    assert {r["status"] for r in retention.purge(keys, size=10).collect()} == {"expired"}
    assert all(os.path.exists(n) for n in names)
    report = retention.purge(keys, size=10, dry_run=False).collect()
    assert {r["status"] for r in report} == {"deleted"} and len(report) == 26
    assert sorted({r["batch"] for r in report}) == [0, 1, 2]
    assert not any(os.path.exists(n) for n in names)


def test_purge_reports_failures_and_batch_size(spark):
    seen = spark.sparkContext.accumulator(0)

    def refuse(paths):
        if len(paths) > 4:
            seen.add(1)
        return ["denied"] * len(paths)

    keys = spark.range(10).selectExpr("concat('k', id) AS s3_key")
    report = retention.purge(keys, size=4, dry_run=False, delete=refuse).collect()
    assert {(r["status"], r["error"]) for r in report} == {("failed", "denied")} and seen.value == 0


def test_delete_batches_over_hot_bound(spark):
    keys = spark.range(500).selectExpr("format_string('k%05d', id) AS s3_key").repartition(4)
    got = rows(retention.delete_batches(keys, 30, splits=6))
    assert got == [(f"k{i:05d}", i // 30) for i in range(500)]


def test_cleanup_over_a_loaded_lake(spark, work):
    df = keyed(spark, ("2024-01-01", 1), ("2024-01-02", 2)).selectExpr(
        "period_key", "v", "cast(period_key as timestamp) AS date", "2024 AS year", "1 AS month")
    K.write_once(df, work, FEED, "one")
    schema = df.drop("period_key").schema
    sinks.load_incremental(spark, work, FEED, schema, f"{work}/t", f"{work}/s", "date", AT)
    late = datetime(2024, 1, 25, tzinfo=timezone.utc)
    report = jobs.cleanup(spark, f"{work}/s/ledger", late, 7, dry_run=False).collect()
    assert len(report) == 2 and {r["status"] for r in report} == {"deleted"}
    assert S.list_objects(spark, work, FEED).count() == 0
    assert jobs.cleanup(spark, f"{work}/s/ledger", AT, 7).count() == 0


# -- streams -----------------------------------------------------------------------

def test_load_files_reports_bad_objects(spark, work):
    schema = "date timestamp, v long, year int, month int"
    good = spark.sql("SELECT 'a' AS period_key, timestamp'2024-01-01' AS date, 1L AS v, 2024 AS year, 1 AS month")
    no_date = spark.sql("SELECT 'b' AS period_key, cast(null AS timestamp) AS date, 2L AS v, 2024 AS year, 1 AS month")
    no_year = spark.sql("SELECT 'c' AS period_key, timestamp'2024-01-01' AS date, 3L AS v, cast(null AS int) AS year, 1 AS month")
    K.write_once(good.unionAll(no_date).unionAll(no_year), work, FEED, "one")
    failures = sinks.load_incremental(spark, work, FEED, spark.createDataFrame([], schema).schema, f"{work}/t", f"{work}/s", "date", AT)
    assert {(r["s3_key"].split("period=")[1][0], r["reason"]) for r in failures.collect()} == {
        ("b", "no value in date"), ("c", "no year or month")}
    assert rows(sinks.read_loaded(spark, f"{work}/t"), "v") == [(1,)]
    assert K.read_ledger(spark, f"{work}/s/ledger").count() == 1


def test_partition_column_is_checked(spark):
    def schema(text):
        return spark.createDataFrame([], text).schema

    with pytest.raises(ValueError, match="does not exist"):
        quality.check_partition_column(schema("v long"), "date")
    with pytest.raises(TypeError):
        quality.check_partition_column(schema("date string, year int, month int"), "date")
    with pytest.raises(ValueError, match="month"):
        quality.check_partition_column(schema("date timestamp, year int"), "date")


def test_write_once_stream_replay_and_late_file(spark, work):
    schema = "period_key string, v long"
    stream = lambda: spark.readStream.schema(schema).parquet(f"{work}/in")
    keyed(spark, ("a", 1), ("b", 2)).write.parquet(f"{work}/in")
    sinks.stream_write_once(stream(), work, FEED, f"{work}/c")
    sinks.stream_write_once(stream(), work, FEED, f"{work}/c")
    assert stored(spark, work) == [(1,), (2,)]
    keyed(spark, ("a", 5), ("c", 3)).write.mode("append").parquet(f"{work}/in")
    sinks.stream_write_once(stream(), work, FEED, f"{work}/c")
    assert stored(spark, work) == [(1,), (2,), (3,)]
    # A lost checkpoint replays everything under the same batch numbers.
    sinks.stream_write_once(stream(), work, FEED, f"{work}/c2", run_id="again")
    assert stored(spark, work) == [(1,), (2,), (3,)]


def test_marks_survive_a_repeated_batch(spark, work):
    schema = "by string, seq long, value long"
    df = lambda *r: spark.createDataFrame(list(r), schema)
    go = lambda checkpoint: sinks.stream_advance_only(
        spark.readStream.schema(schema).parquet(f"{work}/in"), f"{work}/out", f"{work}/m", f"{work}/{checkpoint}",
        ["seq"], "value", ["by"], marks=spark.createDataFrame([("y", 4)], "by string, value long"), splits=3)
    df(("x", 1, 5), ("x", 2, 3), ("x", 3, 6), ("y", 1, 4), ("y", 2, 5)).coalesce(1).write.parquet(f"{work}/in")
    go("c")
    df(("x", 4, 6), ("x", 5, 8), ("z", 1, 1)).coalesce(1).write.mode("append").parquet(f"{work}/in")
    go("c")
    want = [("x", 1, 5), ("x", 3, 6), ("x", 5, 8), ("y", 2, 5), ("z", 1, 1)]
    assert rows(spark.read.parquet(f"{work}/out"), "by", "seq", "value") == want
    marks = sinks.read_marks(spark, f"{work}/m", 99, spark.createDataFrame([], "by string, value long").schema)
    assert rows(marks) == [("x", 8), ("y", 5), ("z", 1)]


def test_marks_of_an_old_run_stay(spark, work):
    one = lambda v: spark.createDataFrame([("x", v)], "by string, value long")
    for v in range(13):
        sinks.write_marks(one(v), work, v)
    assert rows(sinks.read_marks(spark, work, 2, one(0).schema)) == [("x", 1)]
    assert rows(sinks.read_marks(spark, work, 40, one(0).schema)) == [("x", 12)]
    assert sinks.read_marks(spark, work, 0, one(0).schema) is None


def test_publish_incremental_starts_from_stored_marks(spark, work):
    schema = "src string, seq long, date timestamp, load double"
    rows_in = spark.sql("SELECT 's' AS src, id AS seq, timestampadd(HOUR, id, timestamp'2024-01-01') AS date, id * 1.0D AS load FROM range(5)")
    go = lambda df, run: jobs.publish_incremental(df, f"{work}/sent", f"{work}/m", run, ["seq"], "date", ["date", "load"], ["src"])
    go(rows_in.where("seq < 3"), 0)
    go(rows_in, 1)
    go(rows_in, 1)
    sent = spark.read.text(f"{work}/sent").selectExpr("get_json_object(value, '$.load') AS load", "run")
    assert rows(sent.selectExpr("cast(load as double)", "run")) == [(0.0, 0), (1.0, 0), (2.0, 0), (3.0, 1), (4.0, 1)]
    numbers = spark.read.text(f"{work}/sent").selectExpr("get_json_object(value, '$.key_id') AS k")
    assert rows(numbers) == [(f"record_{i}",) for i in range(5)]
    assert schema


def test_stream_goes_on_at_an_interval(spark, work):
    keyed(spark, ("a", 1)).write.parquet(f"{work}/in")
    stream = spark.readStream.schema("period_key string, v long").parquet(f"{work}/in")
    query = T.to_files(stream, f"{work}/out", f"{work}/c", every="1 second")
    try:
        query.processAllAvailable()
        keyed(spark, ("b", 2)).write.mode("append").parquet(f"{work}/in")
        query.processAllAvailable()
        assert spark.read.parquet(f"{work}/out").count() == 2
    finally:
        query.stop()


# -- marts and shapes ----------------------------------------------------------------

def test_gas_mart_over_two_years(spark):
    """Groups are dates, not labels: the same day of two years stays apart and in order."""
    data = [("2023-12-31", 1.0, 3.0), ("2024-12-30", 10.0, None), ("2024-12-31", 4.0, 4.0), ("2025-01-01", 6.0, 6.0)]
    gas = spark.createDataFrame(data, "d string, open_price double, close_price double") \
        .selectExpr("cast(d as timestamp) AS date", "open_price", "close_price")
    got = [tuple(r) for r in marts.mart_gas_prices(gas).select("day_label", "average_price", "price_change_pct", "price_change_text").collect()]
    assert got == [("Dec 30", 10.0, None, ""), ("Dec 31", 4.0, -60.0, "-60.00%"), ("Jan 01", 6.0, 50.0, "50.00%")]
    by_date = gas.selectExpr("cast(date as date) AS date", "open_price", "close_price")
    assert [r[1] for r in marts.mart_gas_prices(by_date).select("day", "average_price").collect()] == [10.0, 4.0, 6.0]
    assert marts.mart_gas_prices(gas.limit(0)).count() == 0


def test_generation_mix_calendar_uses_stored_parts(spark):
    df = spark.sql("SELECT timestamp'2023-02-01' AS date, 2 AS month, 29 AS day, '1.5' AS fossil_gas_actual_aggregated "
                   "UNION ALL SELECT timestamp'2024-02-01', 2, 29, 'n/e'")
    got = marts.mart_generation_mix(df, ["fossil_gas_actual_aggregated"], calendar=True).collect()
    with pytest.raises(ValueError, match="solar"):
        marts.mart_generation_mix(df)
    assert [(r["day_label"], r["energy_title"], r["generated"]) for r in got] == [("Feb 29", "Fossil Gas Actual Aggregated", 1.5)]


def test_generation_mix_with_all_types(spark):
    from gridmill.schemas import GENERATION_COLUMNS

    df = spark.createDataFrame([tuple(["2024-01-05 00:00:00"] + ["2"] * 11), tuple(["2024-01-05 01:00:00"] + ["x"] * 11)],
                               ["d", *GENERATION_COLUMNS])
    df = df.withColumn("date", df["d"].cast("timestamp")).drop("d")
    got = {r["energy_type"]: (r["energy_title"], r["generated"]) for r in marts.mart_generation_mix(df).collect()}
    assert got == {c: (c.replace("_", " ").title(), 2.0) for c in GENERATION_COLUMNS}


def test_sums_of_nothing_and_missing_sources(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0), (None, 3.0)], "k string, v double")
    assert rows(shape.sum_columns_by(df, ["k"], ["v"])) == [("a", 0.0), ("b", 2.0)]
    assert rows(shape.mean_all_by(df, "k")) == [("a", None), ("b", 2.0)]
    with pytest.raises(FileNotFoundError):
        shape.union_sources([None, None])
    assert rows(shape.row_counts(df, "k", ["a", "z"])) == [("a", 1), ("z", 0)]
    with pytest.raises(Exception, match="no rows from source z"):
        shape.row_counts(df, "k", ["a", "z"], required=True).collect()
