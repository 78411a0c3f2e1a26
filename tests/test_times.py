"""Time and period edges: month ends, leap days, weekends, daylight saving."""

from datetime import date, datetime, timezone

import pytest

from conftest import rows
from gridmill.functions import columns as C, timecols as X
from gridmill.operators import periods as P


def utc(*a):
    return datetime(*a, tzinfo=timezone.utc)


def hours(spark, first, last):
    """One row per hour, as instants."""
    return spark.sql(f"SELECT explode(sequence(timestamp'{first}', timestamp'{last}', interval 1 hour)) AS t")


def local_text(df):
    return [r[0] for r in rows(df.selectExpr("date_format(t, 'yyyy-MM-dd HH')"))]


def test_month_holds_its_last_day_and_december(spark):
    df = hours(spark, "2023-11-28 00:00:00", "2024-01-03 00:00:00")
    december = local_text(df.filter(X.in_month("t", 2023, 12)))
    assert (december[0], december[-1], len(december)) == ("2023-11-30 23", "2023-12-31 22", 31 * 24)


@pytest.mark.parametrize("month,count", [(3, 31 * 24 - 1), (10, 31 * 24 + 1)])
def test_month_with_clock_change(spark, month, count):
    df = hours(spark, "2024-02-27 00:00:00", "2024-11-03 00:00:00")
    assert df.filter(X.in_month("t", 2024, month)).count() == count


def test_days_around_clock_change(spark):
    df = hours(spark, "2024-03-29 00:00:00", "2024-04-02 00:00:00")
    assert df.filter(X.on_day("t", utc(2024, 3, 31, 10), X.BERLIN)).count() == 23
    df = hours(spark, "2024-10-25 00:00:00", "2024-10-29 00:00:00")
    assert df.filter(X.on_day("t", utc(2024, 10, 27, 10), X.BERLIN)).count() == 25
    # Two UTC hours share the local hour 02 in autumn; both belong to its key.
    keyed = P.slice_closed_hours(df, "t", utc(2024, 10, 27, 10))
    counts = {r["period_key"]: r["count"] for r in keyed.groupBy("period_key").count().collect()}
    assert counts["2024-10-27-02"] == 2 and counts["2024-10-27-03"] == 1


@pytest.mark.parametrize("as_of,keys", [
    (utc(2024, 1, 17, 15, 30), ("2024-01-17-00", "2024-01-17-15", 16)),   # Wednesday
    (utc(2024, 1, 20, 15, 30), ("2024-01-19-00", "2024-01-19-22", 23)),   # Saturday
    (utc(2024, 1, 21, 0, 5), ("2024-01-19-00", "2024-01-19-22", 23)),     # Sunday
])
def test_trading_hours(spark, as_of, keys):
    df = hours(spark, "2024-01-15 00:00:00", "2024-01-23 00:00:00")
    got = [r[0] for r in rows(P.slice_trading_hours(df, "t", as_of), "period_key")]
    assert (got[0], got[-1], len(got)) == keys


def test_closed_hours_at_local_midnight_are_empty(spark):
    df = hours(spark, "2024-01-15 00:00:00", "2024-01-23 00:00:00")
    assert P.slice_closed_hours(df, "t", utc(2024, 1, 17, 23, 10)).count() == 0


def test_last_and_next_days_exclude_today(spark):
    df = hours(spark, "2023-12-20 00:00:00", "2024-01-12 00:00:00")
    last = {r[0] for r in rows(P.slice_last_days(df, "t", utc(2024, 1, 3, 12)), "period_key")}
    assert last == {"2023-12-29", "2023-12-30", "2023-12-31", "2024-01-01", "2024-01-02"}
    after = {r[0] for r in rows(P.slice_next_days(df, "t", utc(2023, 12, 31, 12), 2), "period_key")}
    assert after == {"2024-01-01", "2024-01-02"}


def test_same_day_on_leap_day():
    assert P.same_days(utc(2024, 2, 29, 12), 5) == [date(2024, 2, 29), date(2020, 2, 29)]
    assert len(P.same_days(utc(2024, 3, 1, 12), 5)) == 5


def test_iso_text_with_mixed_offsets(spark):
    df = spark.createDataFrame([("2024-10-27 02:30:00+02:00",), ("2024-10-27 02:30:00+01:00",), ("junk",), (None,)], "d string")
    got = df.select(X.parse_iso("d").cast("string").alias("i"), X.wall_clock("d").cast("string").alias("w")).collect()
    assert [tuple(r) for r in got] == [
        ("2024-10-27 00:30:00", "2024-10-27 02:30:00"), ("2024-10-27 01:30:00", "2024-10-27 02:30:00"),
        (None, None), (None, None)]


def test_step_and_coordinates_fail_loudly(spark):
    bad_step = spark.createDataFrame([("2024-01-17",)], "s string").select(X.parse_step("s"))
    with pytest.raises(Exception, match="cannot parse forecast step"):
        bad_step.collect()
    missing = spark.createDataFrame([(None,)], "s string").select(X.parse_step("s"))
    with pytest.raises(Exception, match="undefined"):
        missing.collect()
    with pytest.raises(Exception, match="cannot parse coordinates"):
        spark.createDataFrame([("1,2",)], "s string").select(C.parse_coordinates("s")).collect()


def test_hour_stamp(spark):
    df = spark.createDataFrame([("2024011705",), ("202401170512",), ("2024011705:30",)], "s string")
    assert {str(r[0]) for r in df.select(X.parse_hour_stamp("s").cast("timestamp_ntz")).collect()} == {"2024-01-17 05:00:00"}


def test_period_path_needs_station(spark):
    with pytest.raises(ValueError):
        X.period_path("t", "weather_forecast")
    with pytest.raises(ValueError):
        X.period_path("t", "historical_weather", station="04931")


@pytest.mark.parametrize("value,text", [(0.125, "0.12"), (0.375, "0.38"), (1.005, "1.00"), (2.675, "2.67"),
                                        (1234567.891, "1234567.89"), (-0.001, "-0.00"), (None, "")])
def test_fixed2_rounds_as_python(spark, value, text):
    assert spark.createDataFrame([(value,)], "v double").select(C.fixed2("v")).first()[0] == text
    if value is not None:
        assert f"{value:.2f}" == text


def test_series_title_and_headers():
    assert C.header_name(("Fossil Gas", "Actual Aggregated")) == "fossil_gas_actual_aggregated"
    assert C.header_name(("Date", "")) == "date"
    assert C.header_name("Hydro Run-of-river/Poundage") == "hydro_run-of-river_poundage"


def test_series_title(spark):
    names = ["hydro_run-of-river_and_poundage_actual_aggregated", "wind_onshore", "a-b_c"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r[0]: r[1] for r in df.select("n", C.series_title("n")).collect()}
    assert got == {n: n.replace("_", " ").title() for n in names}


def test_split_series(spark):
    df = spark.createDataFrame([("  1.5 -  2\n 3 ",)], "s string")
    assert df.select(C.split_series("s")).first()[0] == [1.5, None, 2.0, 3.0]
    bad = spark.createDataFrame([("1 x",)], "s string")
    assert bad.select(C.split_series("s")).first()[0] == [1.0, None]
    with pytest.raises(Exception):
        bad.select(C.split_series("s", strict=True)).collect()


def test_narrow_and_celsius(spark):
    df = spark.createDataFrame([(40000, 280.15, "x"), (5, None, None)], "n long, temperature_2m double, s string")
    out = C.kelvin_to_celsius(C.narrow(df), ["temperature_2m"])
    assert dict(out.dtypes) == {"n": "smallint", "temperature_2m": "float", "s": "string"}
    assert rows(out, "n") == [(None,), (5,)]


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("1.5",), ("n/e",), ("NaN",), (None,)], "v string")
    assert [r[0] for r in C.coerce_numeric(df, ["v"]).collect()] == [1.5, None, None, None]
