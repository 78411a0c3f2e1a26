"""The commit log, several writers of a feed, positions of loads, marks by version, and files found by zones."""

import threading
import time
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from conftest import rows
from gridmill.operators.skew import ahead_of
from gridmill.plans import jobs, refresh
from gridmill.sinks import commits, lake as K, marks
from gridmill.sinks.commits import ABANDONED, CommitLog
from gridmill.sources import lake as S
from gridmill.streaming import sinks

AT = datetime(2024, 1, 17, 15, 30, tzinfo=timezone.utc)
FEED = "electricity/load"


def dated(spark, *values, day="2024-01-05"):
    return spark.createDataFrame([(f"{day}-{v}", v) for v in values], "period_key string, v long").selectExpr(
        "period_key", f"timestamp'{day}' AS date", "v", "2024 AS year", "1 AS month").coalesce(1)


# -- log -----------------------------------------------------------------------------

def test_put_absent_has_one_winner(spark, work):
    won = []
    threads = [threading.Thread(target=lambda i=i: commits.put_absent(spark, f"{work}/x/1.json", f"writer {i}") and won.append(i)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and commits.read_text(spark, f"{work}/x/1.json") == f"writer {won[0]}"
    assert [n for n in S.folders(spark, f"{work}/x") if not n.endswith(".crc")] == ["1.json"]
    assert commits.read_text(spark, f"{work}/x/2.json") is None


def test_log_numbers_and_conflicts(spark, work):
    log = CommitLog(spark, work, FEED)
    assert log.last() == 0 and log.live().count() == 0
    assert log.append({"kind": "batch", "batch_id": "a", "days": ["2024-01-01"]}, 0) == (1, [])
    number, others = log.append({"kind": "batch", "batch_id": "b", "days": ["2024-01-01"]}, 0)
    assert number is None and [c["batch_id"] for c in others] == ["a"]
    assert log.append({"kind": "batch", "batch_id": "b", "days": ["2024-01-02"]}, 1) == (2, [])
    assert log.append({"kind": ABANDONED, "batch_id": "c", "days": []}, 2) == (3, [])
    assert rows(log.live()) == [("a", "2024-01-01", 1), ("b", "2024-01-02", 2)]
    assert rows(log.live(["2024-01-02"])) == [("b", "2024-01-02", 2)]
    assert log.holds("a") and not log.holds("c") and not log.holds("z")


def test_snapshots_carry_what_holds(spark, work, monkeypatch):
    monkeypatch.setattr(commits, "EVERY", 4)
    log = CommitLog(spark, work, FEED)
    for n in range(14):
        log.append({"kind": "batch", "batch_id": f"b{n % 9}", "days": [f"2024-01-{n + 1:02d}"]}, n)
    want = {f"b{n % 9}": (f"2024-01-{n + 1:02d}", n + 1) for n in range(14)}
    assert {r["batch_id"]: (r["period"], r["number"]) for r in log.live().collect()} == want
    assert log._base() == 12 and log.last() == 14 and log.holds("b8") and not log.holds("b9")
    assert sorted(n for n in S.folders(spark, log.path) if n.startswith("snapshot=")) == ["snapshot=12", "snapshot=8"]
    # A lost pointer is found again by listing.
    S.delete_folder(spark, f"{log.path}/snapshot")
    assert log._base() == 12


# -- several writers -----------------------------------------------------------------

def test_the_later_writer_drops_what_was_taken(spark, work, monkeypatch):
    """Both see an empty feed; the second to commit finds the first and keeps its own keys only."""
    plain, done = CommitLog.append, []

    def slow(self, entry, last):
        if entry["batch_id"] == "two" and not done:
            done.append(True)
            K.write_once(dated(spark, 1, 2).withColumn("v", F.col("v") * 10), work, FEED, "one")
            K.write_once(dated(spark, 7, day="2024-01-07"), work, FEED, "other day")
        return plain(self, entry, last)

    monkeypatch.setattr(CommitLog, "append", slow)
    df = dated(spark, 2, 3).unionAll(dated(spark, 4, day="2024-01-06")).unionAll(dated(spark, 7, day="2024-01-07"))
    mine = K.write_once(df, work, FEED, "two", keep_late=True, zones=((), "v"))
    assert rows(mine) == [("2024-01-05-3",), ("2024-01-06-4",)]
    assert rows(S.read_lake(spark, work, FEED), "v") == [(3,), (4,), (7,), (10,), (20,)]
    assert rows(K.read_claims(spark, work, FEED), "period_key", "batch_id") == [
        ("2024-01-05-1", "one"), ("2024-01-05-2", "one"), ("2024-01-05-3", "two"), ("2024-01-06-4", "two"), ("2024-01-07-7", "other day")]
    assert rows(K.late_counts(spark, work, FEED), "period_key", "late_rows") == [("2024-01-05-2", 1), ("2024-01-07-7", 1)]
    assert [c["days"] for c in CommitLog(spark, work, FEED).after(0)] == [["2024-01-05"], ["2024-01-07"], ["2024-01-05", "2024-01-06"]]


def test_two_writers_at_once_lose_no_key(spark, work):
    """Overlapping slices of four days, written by two threads: every key once, whoever was first."""
    errors = []

    def write(name, values):
        try:
            for n, part in enumerate((values[: len(values) // 2], values)):
                df = spark.createDataFrame([(f"2024-01-0{v % 4 + 1}-{v}", v, name) for v in part], "period_key string, v long, who string")
                K.write_once(df, work, FEED, f"{name}{n}")
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=write, args=x) for x in (("a", list(range(0, 30))), ("b", list(range(15, 45))))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    assert rows(S.read_lake(spark, work, FEED), "v") == [(v,) for v in range(45)]
    claims = K.read_claims(spark, work, FEED).collect()
    assert len(claims) == 45 == len({r["period_key"] for r in claims})
    assert [c["number"] for c in CommitLog(spark, work, FEED).after(0)] == [1, 2, 3, 4]


def test_a_batch_that_was_given_up_is_not_committed(spark, work, monkeypatch):
    plain, done = CommitLog.append, []

    def paused(self, entry, last):
        if entry["batch_id"] == "slow" and not done:
            done.append(True)
            time.sleep(1.1)
            K.write_once(dated(spark, 1), work, FEED, "next")
        return plain(self, entry, last)

    monkeypatch.setattr(CommitLog, "append", paused)
    with pytest.raises(RuntimeError, match="given up"):
        K.write_once(dated(spark, 1, 2), work, FEED, "slow", lease=1)
    assert rows(S.read_lake(spark, work, FEED), "v") == [(1,)]
    K.write_once(dated(spark, 1, 2), work, FEED, "slow")
    assert rows(S.read_lake(spark, work, FEED), "v") == [(1,), (2,)]


def test_a_batch_under_way_is_left_alone(spark, work):
    alive = dated(spark, 9).selectExpr("*", "'2024-01-05' AS period", "'alive' AS batch_id")
    K.overwrite_partitions(alive, S.data_path(work, FEED), "period", "batch_id")
    S.make_folder(spark, f"{S.meta_path(work, FEED, 'started')}/batch_id=alive/until={int(time.time()) + 600}")
    K.write_once(dated(spark, 1), work, FEED, "next")
    assert "batch_id=alive" in S.folders(spark, f"{S.data_path(work, FEED)}/period=2024-01-05")


# -- cost of run n -------------------------------------------------------------------

def counted(monkeypatch, run):
    """Paths of the shared store that a run asks for on the driver."""
    seen = []
    for module in (commits, S, K, sinks, marks):
        for name in ("read_text", "path_exists", "folders"):
            plain = getattr(module, name, None)
            if plain is not None:
                monkeypatch.setattr(module, name, lambda spark, path, plain=plain: seen.append(path) or plain(spark, path))
    out = run()
    monkeypatch.undo()
    return out, seen


def test_cost_of_a_run_does_not_grow_with_the_runs_before(spark, work, monkeypatch):
    lake, log = f"{work}/lake", CommitLog(spark, f"{work}/lake", FEED)
    schema = dated(spark, 1).drop("period_key").schema
    cost = {}
    for n in (5, 50):
        # The batches before are there and have been loaded.
        for k in range(log.last(), n - 1):
            log.append({"kind": "batch", "batch_id": f"old{k}", "days": [f"2023-{k % 12 + 1:02d}-01"]}, k)
        commits.write_position(spark, sinks.position_path(f"{work}/s/ledger"), {"number": n - 1, "again": []})
        K.write_once(dated(spark, n), lake, FEED, f"new{n}")
        _, seen = counted(monkeypatch, lambda: sinks.load_incremental(spark, lake, FEED, schema, f"{work}/t", f"{work}/s", "date", AT))
        cost[n] = seen
    assert rows(sinks.read_loaded(spark, f"{work}/t"), "v") == [(5,), (50,)]
    assert len(cost[50]) == len(cost[5]) < 12
    assert sum("/log/" in p for p in cost[50]) == 2  # the new commit, and the one that is not there yet
    _, idle = counted(monkeypatch, lambda: sinks.load_open(spark, lake, FEED, schema, f"{work}/t", f"{work}/s/ledger", "date", AT))
    assert len(idle) == 2


# -- marks and zones -----------------------------------------------------------------

def test_versions_hold_changes_only(spark, work, monkeypatch):
    monkeypatch.setattr(marks, "EVERY", 4)
    kind = spark.createDataFrame([], "src string, v long").schema
    state = {f"s{i}": i for i in range(20)}
    marks.write_marks(spark.createDataFrame(list(state.items()), kind), work, 0)
    history = [dict(state)]
    for run in range(1, 14):
        change = {f"s{run % 3}": 100 + run}
        marks.write_marks(spark.createDataFrame(list(change.items()), kind), work, run)
        state |= change
        history.append(dict(state))
        assert spark.read.parquet(f"{work}/version={run}").count() == 1
    for run in (1, 2, 6, 9, 14):
        assert dict(map(tuple, marks.read_marks(spark, work, run, kind).collect())) == history[run - 1]
        assert len(marks._parts(spark, work, run)) <= 2 * marks.EVERY + 1
    assert len([n for n in S.folders(spark, work) if n.startswith("whole=")]) == 2
    assert marks.read_marks(spark, work, 0, kind) is None


def test_counts_add_up(spark, work):
    kind = spark.createDataFrame([], "src string, sent long").schema
    for run in (0, 3, 3, 7):  # runs need not follow each other; one is repeated
        marks.write_counts(spark.createDataFrame([("a", run + 1)], kind), work, run)
    assert rows(marks.read_counts(spark, work, 8, kind)) == [("a", 13)]
    assert rows(marks.read_counts(spark, work, 7, kind)) == [("a", 5)]


def test_ahead_of_marks(spark):
    df = spark.createDataFrame([("x", 1), ("x", 5), ("y", 2), (None, 3), (None, 9), ("z", None)], "k string, v long")
    at = spark.createDataFrame([("x", 2), (None, 4)], "k string, v long")
    assert {tuple(r) for r in ahead_of(df, at, ["k"], "v").collect()} == {(None, 9), ("x", 5), ("y", 2), ("z", None)}
    assert {r["v"] for r in ahead_of(df, at.select("v"), [], "v").collect()} == {5, 9}
    assert ahead_of(df, None, ["k"], "v").count() == 6


def history(spark, first, last, day):
    return spark.range(first, last).selectExpr(
        f"concat('{day}-', id) AS period_key", "concat('s', id % 4) AS src", "id AS seq",
        "timestampadd(MINUTE, cast(id AS int), timestamp'2024-01-01') AS date", "id * 1.0D AS load").coalesce(1)


def test_a_run_reads_and_shuffles_what_is_new(spark, work):
    """A history of 40 files, one of which is new."""
    schema = history(spark, 0, 1, "x").drop("period_key").schema
    go = lambda run: jobs.publish_from_lake(spark, work, FEED, schema, f"{work}/sent", f"{work}/m", run, ["seq"], "date", ["date", "load"], ["src"])
    zones = (["src"], "date")
    old = history(spark, 0, 3900, "d").withColumn("period_key", F.format_string("2024-02-%02d-%d", F.expr("seq div 150 + 1"), F.col("seq")))
    K.write_once(old, work, FEED, "old", zones=zones)
    go(0)
    K.write_once(history(spark, 3900, 3940, "2024-03-01"), work, FEED, "new", zones=zones)
    stored = marks.read_marks(spark, f"{work}/m/marks", 1, spark.createDataFrame([], "src string, date timestamp").schema)
    found = K.read_ahead(spark, work, FEED, schema, stored, ["src"], "date")
    assert len(found.inputFiles()) == 1 and "batch_id=new" in found.inputFiles()[0]
    assert len(K.read_ahead(spark, work, FEED, schema, None, ["src"], "date").inputFiles()) == 27
    go(1)
    go(1)
    go(2)  # nothing is left
    sent = spark.read.text(f"{work}/sent").selectExpr("cast(get_json_object(value, '$.load') AS double) AS load", "run", "get_json_object(value, '$.key_id') AS k")
    assert {r["run"]: r["count"] for r in sent.groupBy("run").count().collect()} == {0: 3900, 1: 40}
    assert rows(sent.filter("run = 1").select("load")) == [(float(v),) for v in range(3900, 3940)]
    assert rows(sent.filter("run = 1").selectExpr("k").distinct())[0] == ("record_975",)


def test_old_rows_go_before_the_shuffle(spark, work):
    """Of a history without zones, only what is above the marks reaches the exchange."""
    df = history(spark, 0, 2000, "d").drop("period_key")
    at = df.filter("seq < 1980").groupBy("src").agg(F.max("date").alias("date"))
    above = ahead_of(df, at, ["src"], "date")
    assert above.count() == 20
    jobs.publish_incremental(df.filter("seq < 1980"), f"{work}/sent", f"{work}/m", 0, ["seq"], "date", ["load"], ["src"])
    jobs.publish_incremental(df, f"{work}/sent", f"{work}/m", 1, ["seq"], "date", ["load"], ["src"])
    sent = spark.read.text(f"{work}/sent")
    assert sent.filter("run = 1").count() == 20 and "date" not in sent.first()["value"]


def test_batches_without_zones_are_read_whole(spark, work):
    schema = history(spark, 0, 1, "x").drop("period_key").schema
    K.write_once(history(spark, 0, 50, "2024-01-01"), work, FEED, "plain")
    K.write_once(history(spark, 50, 60, "2024-01-02"), work, FEED, "zoned", zones=(["src"], "date"))
    late = spark.createDataFrame([(f"s{i}",) for i in range(4)], "src string").selectExpr("src", "timestamp'2030-01-01' AS date")
    assert K.read_ahead(spark, work, FEED, schema, late, ["src"], "date").count() == 50
    assert K.read_ahead(spark, work, FEED, schema, None, ["src"], "date").count() == 60


# -- marts kept up to date ---------------------------------------------------------------

def test_a_refresh_reads_the_days_that_changed(spark, work, monkeypatch):
    lake, table, ledger, mart = f"{work}/lake", f"{work}/t", f"{work}/s/ledger", f"{work}/mart"
    schema = dated(spark, 1).drop("period_key").schema
    read, plain = [], refresh.read_days

    def watched(*args, **options):
        out = plain(*args, **options)
        read.append(len({f.split("/date=")[1][:10] for f in out.inputFiles()}))
        return out

    monkeypatch.setattr(refresh, "read_days", watched)

    def run(batch, day, *values):
        K.write_once(dated(spark, *values, day=day), lake, FEED, batch)
        sinks.load_incremental(spark, lake, FEED, schema, table, f"{work}/s", "date", AT)
        return refresh.refresh_mart(spark, lake, FEED, table, ledger, mart, f"{work}/m", daily)

    daily = lambda df: df.groupBy(F.to_date("date").alias("day")).agg(F.sum("v").alias("v"), F.count("*").alias("n"))
    for n in range(1, 6):
        assert run(f"b{n}", f"2024-01-0{n}", n, n + 10) == [f"2024-01-0{n}"]
    assert run("late", "2024-01-03", 100) == ["2024-01-03"]
    assert read == [1] * 6
    whole = daily(sinks.read_loaded(spark, table)).selectExpr("cast(day AS date) AS day", "v", "n")
    assert rows(refresh.read_mart(spark, mart).select("day", "v", "n")) == rows(whole)
    assert refresh.refresh_mart(spark, lake, FEED, table, ledger, mart, f"{work}/m", daily) == []
    # A mart that begins later is computed at once from all that was loaded.
    assert len(refresh.refresh_mart(spark, lake, FEED, table, ledger, f"{work}/mart2", f"{work}/m2", daily)) == 5
    assert rows(refresh.read_mart(spark, f"{work}/mart2").select("day", "v", "n")) == rows(whole)
    assert refresh.read_mart(spark, mart, date(2024, 1, 4)).count() == 2


def test_a_commit_that_is_not_loaded_waits(spark, work):
    lake, table, ledger = f"{work}/lake", f"{work}/t", f"{work}/s/ledger"
    schema = dated(spark, 1).drop("period_key").schema
    go = lambda: refresh.refresh_mart(spark, lake, FEED, table, ledger, f"{work}/mart", f"{work}/m", lambda df: df.select("date", "v").withColumnRenamed("date", "day"))
    K.write_once(dated(spark, 1), lake, FEED, "a")
    assert go() == []
    bad = dated(spark, 2).selectExpr("period_key", "cast(null AS timestamp) AS date", "v", "year", "month")
    K.write_once(bad, lake, FEED, "b")
    sinks.load_incremental(spark, lake, FEED, schema, table, f"{work}/s", "date", AT)
    assert go() == ["2024-01-05"]
    assert commits.read_position(spark, f"{work}/m") == {"number": 2, "again": [["b", ["2024-01-05"]]]}
    K.write_once(dated(spark, 2), lake, FEED, "b")
    sinks.load_incremental(spark, lake, FEED, schema, table, f"{work}/s", "date", AT)
    assert go() == ["2024-01-05"]
    assert rows(refresh.read_mart(spark, f"{work}/mart"), "v") == [(1,), (2,)]
