"""Ordered operators against plain Python, with and without hot groups."""

import random

import pytest

from conftest import rows
from gridmill.operators.ordered import advance_only, number_records, pct_change, row_index


def sample(n=600, seed=7):
    """A third of the rows in one group, one group without a key, gaps and ties in the values."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        by = "hot" if i % 3 == 0 else (None if i % 7 == 0 else f"g{rng.randrange(12)}")
        value = None if rng.random() < 0.15 else float(rng.randrange(0, 40))
        out.append((by, i, rng.randrange(0, 5), value))
    rng.shuffle(out)
    return out


SCHEMA = "by string, seq long, tie int, value double"
HOT = [None, 7]


def groups(data):
    found = {}
    for r in sorted(data, key=lambda r: r[1]):
        found.setdefault(r[0], []).append(r)
    return found


@pytest.mark.parametrize("splits", HOT)
def test_row_index(spark, splits):
    data = sample()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = {(r["by"], r["seq"]): r["i"] for r in row_index(df, ["seq"], ["by"], "i", splits=splits).collect()}
    want = {(by, r[1]): i for by, rs in groups(data).items() for i, r in enumerate(rs)}
    assert got == want


@pytest.mark.parametrize("splits", HOT)
def test_number_records_without_group(spark, splits):
    data = sample()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = {r["seq"]: r["key_id"] for r in number_records(df, ["seq"], splits=splits).collect()}
    assert got == {i: f"record_{i}" for i in range(len(data))}


@pytest.mark.parametrize("splits", HOT)
@pytest.mark.parametrize("by", [["by"], []])
def test_pct_change(spark, splits, by):
    data = sample()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = {r["seq"]: r["c"] for r in pct_change(df, ["seq"], "value", by, "c", splits=splits).collect()}
    for rs in (groups(data) if by else {None: sorted(data, key=lambda r: r[1])}).values():
        last = None
        for r in rs:
            now = r[3] if r[3] is not None else last
            want = None if last is None or last == 0 else (now / last - 1) * 100
            assert got[r[1]] == (pytest.approx(want) if want is not None else None)
            last = now


@pytest.mark.parametrize("splits", HOT)
@pytest.mark.parametrize("with_marks", [False, True])
def test_advance_only(spark, splits, with_marks):
    data = [r for r in sample() if r[3] is not None]
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    start = {"hot": 12.0, "g1": 39.0, "absent": 5.0} if with_marks else {}
    marks = spark.createDataFrame(list(start.items()), "by string, value double") if with_marks else None
    got = rows(advance_only(df, ["seq"], "value", ["by"], marks, splits=splits), "seq", "by", "value")
    want = []
    for by, rs in groups(data).items():
        top = start.get(by)
        for r in rs:
            if top is None or r[3] > top:
                top = r[3]
                want.append((r[1], by, r[3]))
    assert [(s, v) for s, _, v in got] == [(s, v) for s, _, v in sorted(want, key=lambda w: w[0])]


@pytest.mark.parametrize("splits", HOT)
def test_copies_of_one_time_are_split(spark, splits):
    """All rows share one time; the second order column makes it unique."""
    df = spark.range(500).selectExpr("'s' AS by", "7 AS t", "id AS seq").repartition(4)
    got = row_index(df, ["t", "seq"], ["by"], "i", splits=splits).where("i <> seq").count()
    assert got == 0


def test_splits_and_bound(spark):
    df = spark.range(100).selectExpr("id % 3 AS by", "id AS seq")
    want = rows(row_index(df, ["seq"], ["by"], "i"))
    assert rows(row_index(df, ["seq"], ["by"], "i", splits=5)) == want
    assert rows(row_index(df, ["seq"], ["by"], "i", group_bound=34)) == want


def test_hot_splits_do_not_meet_in_one_task(spark):
    """The hot group is cut by order, so no task windows all of it."""
    from pyspark.sql import functions as F

    df = spark.range(2000).selectExpr("'hot' AS by", "id AS seq").repartition(4)
    out = row_index(df, ["seq"], ["by"], "i", splits=20)
    per_task = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task < 2000
