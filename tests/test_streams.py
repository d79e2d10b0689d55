"""Streams over four polls and a restart: results, what each batch writes, late rows and timers."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from freshet.plans import history
from freshet.session import scratch_path
from freshet.streaming import feeds

START = datetime(2026, 1, 1)


def polled(spark, landing, schema, polls, start):
    """Two polls in two triggers, then a restart and the other two."""
    for pair in (polls[:2], polls[2:]):
        for rows in pair:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        feeds.run_available(lambda: start(feeds.read_files(spark, landing, spark.read.parquet(landing).schema, per_trigger=1)))


def written(spark, path):
    return {r["batch"]: r["count"] for r in spark.read.parquet(path).groupBy("batch").count().collect()}


def test_serving_view_writes_what_changed(spark):
    rnd = random.Random(1)
    first = [(k, START, k) for k in range(300)]
    polls = [first] + [[(rnd.randrange(300), START + timedelta(hours=rnd.randint(0, 90)), 1000 * p + i) for i in range(12)] for p in range(1, 4)]
    landing, out, check = (scratch_path(spark, n) for n in ("landing", "out", "check"))
    polled(spark, landing, "k long, t timestamp, v long", polls, lambda rows: feeds.serve_latest(feeds.latest_per_key(rows, ["k"], "t", ["v"]), out, check))
    best = {}
    for k, t, v in (r for poll in polls for r in poll):
        best[k] = max(best.get(k, (t, v)), (t, v))
    view = feeds.latest_view(spark, out, ["k"], ["t", "v"])
    assert {r.k: (r.t, r.v) for r in view.collect()} == best
    sizes = written(spark, out)
    assert sizes[0] == 300 and all(n <= 12 for batch, n in sizes.items() if batch)
    into = scratch_path(spark, "compacted")
    feeds.compact(spark, out, ["k"], ["t", "v"], into)
    assert spark.read.parquet(into).count() == 300 and feeds.latest_view(spark, into, ["k"], ["t", "v"]).count() == 300


def test_live_tail_keeps_recent_days_and_late_rows_aside(spark):
    day = lambda d, h=0: START + timedelta(days=d, hours=h)
    polls = [[(k, day(10, h), 1.0) for k in range(20) for h in range(5)], [(1, day(10, 2), 1.0), (2, day(11), 2.0), (3, day(1), 3.0)],
             [(4, day(14), 4.0), (5, day(10, 1), 5.0)], [(6, day(9, 23), 6.0), (7, day(13), 7.0), (7, day(13), 7.0), (8, day(12), 8.0)]]
    landing, out, late, check = (scratch_path(spark, n) for n in ("landing", "out", "late", "check"))
    polled(spark, landing, "k long, t timestamp, v double", polls, lambda rows: feeds.live_tail(rows, out, late, ["k"], "t", 4, check))
    sizes = written(spark, out)
    assert sizes == {0: 100, 1: 1, 2: 1, 3: 2}        # known rows are not written again, whatever the table holds
    assert sorted((r.k, r.t) for r in spark.read.parquet(late).collect()) == [(3, day(1)), (6, day(9, 23))]
    keys = {(k, t) for poll in polls for k, t, _ in poll}
    assert {(r.k, r.t) for r in feeds.tail_view(spark, out, "t", 4).collect()} == {(k, t) for k, t in keys if t >= day(10)}


def messages_of(rnd, areas, days):
    levels = [history.ALERT, history.WARNING, history.SEVERE, history.OFF]
    return [(f"A{a}", START + timedelta(minutes=rnd.randrange(days * 1440)), rnd.choice(levels), "message" if rnd.random() < 0.9 else "closed_fallback") for a in range(areas) for _ in range(25)]


def test_tracked_episodes_equal_the_batch_in_any_poll_order(spark):
    rnd = random.Random(4)
    rows = sorted(messages_of(rnd, 6, 20), key=lambda r: r[1] + timedelta(hours=rnd.uniform(-20, 20)))        # out of order within the lateness
    quarter = len(rows) // 4
    polls = [rows[:quarter], rows[quarter:2 * quarter] + rows[:5], rows[2 * quarter:3 * quarter], rows[3 * quarter:]]
    landing, out, check = (scratch_path(spark, n) for n in ("landing", "out", "check"))
    schema = "area_code string, time timestamp, level string, kind string"
    polled(spark, landing, schema, polls, lambda r: feeds.track_episodes(r, "2 days", 30, out, check))
    events = spark.createDataFrame(rows, schema).dropDuplicates(["area_code", "time", "level"]).withColumn("origin", F.lit("x"))
    episodes, _ = history.episodes_and_periods(events, F.lit("2026-03-01").cast("timestamp"))
    columns = ["area_code", "run", "start_time", "end_time", "start_level", "peak_level", "n_messages", "ended_by"]
    want = sorted(map(tuple, episodes.select(*columns).collect()), key=repr)
    assert sorted(map(tuple, feeds.episode_view(spark, out).select(*columns).collect()), key=repr) == want
    assert sum(written(spark, out).values()) < 4 * len(want)


def test_a_timer_marks_an_episode_that_stays_open(spark):
    at = lambda d: START + timedelta(days=d)
    polls = [[("A", at(0), history.ALERT, "message")], [("B", at(20), history.ALERT, "message"), ("B", at(21), history.OFF, "message")],
             [("B", at(45), history.WARNING, "message")], [("B", at(46), history.OFF, "message")]]
    landing, out, check = (scratch_path(spark, n) for n in ("landing", "out", "check"))
    polled(spark, landing, "area_code string, time timestamp, level string, kind string", polls, lambda r: feeds.track_episodes(r, "2 days", 30, out, check))
    view = {(r.area_code, r.start_time): (r.stale_open, r.ended_by) for r in feeds.episode_view(spark, out).collect()}
    assert view == {("A", at(0)): (True, "open"), ("B", at(20)): (False, "no_longer_in_force"), ("B", at(45)): (False, "no_longer_in_force")}
