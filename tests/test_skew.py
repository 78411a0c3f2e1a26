"""Joins beyond the broadcast bound, with a hot key that adaptive execution has to cut."""

import random

import pytest

from conftest import rows
from gridmill import feeds
from gridmill.operators.skew import keyed_join
from gridmill.operators.stations import attach_steps, for_stations, missing_stations


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_shuffled_equals_broadcast(spark, how):
    rng = random.Random(3)
    data = [(None if i % 11 == 0 else (0 if i % 3 == 0 else rng.randrange(30)), i) for i in range(400)]
    large = spark.createDataFrame(data, "k long, v long").repartition(5)
    small = spark.createDataFrame([(k, f"n{k}") for k in range(0, 40, 2)], "k long, name string")
    assert rows(keyed_join(large, small, ["k"], how)) == rows(large.join(small, "k", how))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_key_is_cut(spark, how):
    """A third of the rows have one key: no task may get all of them."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        large = spark.range(0, 90_000, 1, 12).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k",
                                                         "sha2(cast(id AS string), 256) AS payload")
        small = spark.range(0, 90_000, 5).selectExpr("id AS k").unionAll(spark.range(1).selectExpr("-1L AS k"))
        joined = keyed_join(large, small, ["k"], how)
        hot = 0 if how == "left_anti" else 30_000
        assert joined.where("k = -1").count() == hot
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_other_kinds_are_refused(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        keyed_join(df, df, ["id"], "full")


def test_stations(spark):
    df = spark.createDataFrame([("A", 1), ("B", 2), ("B", 3)], "station string, v int")
    assert rows(for_stations(df, None)) == rows(df)
    assert rows(for_stations(df, ["B"])) == [("B", 2), ("B", 3)]
    ids = spark.createDataFrame([("B",), ("B",), ("C",)], "station string")
    assert rows(for_stations(df, ids)) == [("B", 2), ("B", 3)]
    assert rows(missing_stations(df, ["A", "C"])) == [("C",)]


def test_attach_steps(spark):
    series = spark.createDataFrame([("f", 0, 1.0), ("f", 1, None), ("g", 0, 3.0), ("g", 1, 4.0)], "file string, step int, value double")
    steps = spark.createDataFrame([("f", 0, "t0"), ("f", 1, "t1"), ("g", 0, "u0")], "file string, step int, time string")
    assert rows(attach_steps(series, steps), "file", "step", "value", "time") == [
        ("f", 0, 1.0, "t0"), ("f", 1, None, "t1"), ("g", 0, 3.0, "u0"), ("g", 1, 4.0, None)]


def test_steps_of_a_hot_user_are_cut(spark, work):
    events = spark.range(0, 6_000, 1, 6).selectExpr("id AS event_id", "CASE WHEN id % 3 < 2 THEN 7 ELSE id END AS user_id", "'click' AS event_type",
                                                    "CAST(id AS double) AS value")
    events.write.parquet(f"{work}/events.parquet")
    got = feeds.forecast_long(spark, work)
    assert "_split" in got._jdf.queryExecution().toString()
    assert sorted(r.step for r in got.where("station = 'U7'").collect()) == list(range(4_000))
