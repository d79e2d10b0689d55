"""Streams over the events file: each query runs a stream over what has landed and reads what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.bindings.base import MESSAGES_SQL, messages, query, table, with_ctes
from freshet.operators.store import BatchTable, VersionedTable
from freshet.session import scratch_path
from freshet.streaming import feeds


def _stream(spark, d):
    return feeds.read_files(spark, d, table(spark, d, "events").schema, "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def _polled(spark, landing, files):
    rows = feeds.read_files(spark, landing, spark.read.parquet(landing).schema, per_trigger=files)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def _in_polls(rows, landing: str, run) -> None:
    """Land the rows in three polls and run the stream over them: two polls in two triggers, then a restart and the third.

    ``run`` takes the number of files of a poll.  A trigger takes a whole poll: state is gone through once a trigger, so triggers by file
    would make its cost files times rows.
    """
    files = 0
    key = F.pmod(F.xxhash64(*rows.columns), F.lit(3))
    for polls in ((0, 1), (2,)):
        for poll in polls:
            rows.filter(key == poll).write.mode("append").parquet(landing)
            files = files or len(rows.sparkSession.read.parquet(landing).inputFiles())
        run(files)


def _table(spark, name):
    return VersionedTable(spark, scratch_path(spark, name))


def _log(spark, name):
    return BatchTable(spark, scratch_path(spark, name))


@query("t01_deduplicated_append", "SELECT user_id, min(minute) AS first_minute, count(*) AS n FROM (SELECT DISTINCT user_id, date_trunc('minute', ts) AS minute FROM events) GROUP BY user_id")
def _(spark, d):
    out, check = scratch_path(spark, "t01-out"), scratch_path(spark, "t01-check")
    def run(files):
        minutes = _polled(spark, landing, files).select("user_id", F.date_trunc("minute", "ts").alias("minute"))
        feeds.run_available(lambda: feeds.append_to(feeds.deduplicated(minutes, ["user_id"], "minute", "40 days"), out, check))

    landing = scratch_path(spark, "t01-landing")
    _in_polls(table(spark, d, "events"), landing, run)
    return spark.read.parquet(out).groupBy("user_id").agg(F.min("minute").alias("first_minute"), F.count(F.lit(1)).alias("n"))


@query("t02_live_tail_with_retention", """
SELECT user_id, count(*) AS n FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 4 DAY GROUP BY user_id""")
def _(spark, d):
    out, late, landing, check = [scratch_path(spark, f"t02-{n}") for n in ("out", "late", "landing", "check")]
    _in_polls(table(spark, d, "events"), landing, lambda files: feeds.run_available(
        lambda: feeds.live_tail(_polled(spark, landing, files).select("user_id", "ts", "value"), out, late, ["user_id"], "ts", 4, check)))
    return feeds.tail_view(spark, out, "ts", 4).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("p10_live_tail_served_latest", "SELECT user_id, arg_max(value, ts) AS value, arg_max(event_type, ts) AS event_type FROM events GROUP BY user_id")
def _(spark, d):
    return _latest(spark, d).select("user_id", "value", "event_type")


@query("t06_newest_per_key_view", "SELECT user_id, arg_max(event_id, ts) AS event_id FROM events GROUP BY user_id")
def _(spark, d):
    return _latest(spark, d).select("user_id", "event_id")


def _latest(spark, d):
    out, landing, check = [scratch_path(spark, f"t06-{n}") for n in ("out", "landing", "check")]

    def run(files):
        newest = feeds.latest_per_key(_polled(spark, landing, files), ["user_id"], "ts", ["event_id", "value", "event_type"])
        feeds.run_available(lambda: feeds.serve_latest(newest, out, check))

    _in_polls(table(spark, d, "events"), landing, run)
    return feeds.latest_view(spark, out, ["user_id"], ["ts", "event_id"])


@query("t03_change_detection_with_state", """
WITH snap AS (SELECT user_id, CASE event_type WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 ELSE 4 END AS level, props, ts FROM events),
a AS (SELECT user_id, arg_max(level, ts) AS level, arg_max(props, ts) AS message FROM snap WHERE ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY 1),
b AS (SELECT user_id, arg_max(level, ts) AS level, arg_max(props, ts) AS message FROM snap WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1)
SELECT change_type, count(*) AS n FROM (SELECT 'NEW' AS change_type FROM a UNION ALL
  SELECT CASE WHEN a.user_id IS NULL THEN 'NEW' WHEN b.user_id IS NULL THEN 'CLOSED' WHEN a.level <> b.level THEN 'SEVERITY_CHANGE' ELSE 'MESSAGE_CHANGE' END FROM a FULL JOIN b ON a.user_id = b.user_id
  WHERE a.user_id IS NULL OR b.user_id IS NULL OR a.level <> b.level OR trim(a.message) <> trim(b.message)) GROUP BY 1""")
def _(spark, d):
    from freshet.bindings.forecast import _snapshots

    landing = scratch_path(spark, "t03-landing")
    feed, state = _snapshots(spark, d)
    # two polls land one after the other; the stream takes one snapshot per trigger
    snapshot = lambda df, n: df.withColumn("poll", F.lit(n)).coalesce(1).write.mode("append").parquet(landing)
    snapshot(state, 1)
    snapshot(feed, 2)
    rows = feeds.read_files(spark, landing, spark.read.parquet(landing).schema, per_trigger=1)
    held, log = _table(spark, "t03-state"), _log(spark, "t03-log")
    feeds.run_available(lambda: feeds.watch_changes(
        rows, held, log, "user_id", "level", "message", ["user_id", "change_type", "level", "at"], F.lit("2024-02-01").cast("timestamp_ntz"), scratch_path(spark, "t03-check")))
    return log.read().groupBy("change_type").agg(F.count(F.lit(1)).alias("n"))


@query("t05_exactly_once_commit", "SELECT (SELECT count(*) FROM events) AS children, 1 AS log_rows, (SELECT count(*) FROM events) AS logged")
def _(spark, d):
    child, log = _log(spark, "t05-child"), _log(spark, "t05-log")
    check = scratch_path(spark, "t05-check")
    start = lambda: feeds.commit_in_order(
        _stream(spark, d).select("event_id"), lambda b: [(child, b)], log, lambda b: b.agg(F.count(F.lit(1)).alias("n")), check)
    feeds.run_available(start)
    feeds.run_available(start)          # nothing new has landed: nothing is written twice
    both = child.read().select(F.lit(None).cast("long").alias("n")).unionByName(log.read().select(F.col("n").cast("long").alias("n")))
    return both.agg(F.count_if(F.col("n").isNull()).alias("children"), F.count("n").alias("log_rows"), F.sum("n").alias("logged"))


def _tracked(spark, d):
    out, landing, check = [scratch_path(spark, f"t07-{n}") for n in ("out", "landing", "check")]

    def run(files):
        rows = feeds.read_files(spark, landing, spark.read.parquet(landing).schema, per_trigger=files)
        feeds.run_available(lambda: feeds.track_episodes(rows, "40 days", 30, out, check))

    _in_polls(messages(spark, d).drop("user_id", "event_id"), landing, run)
    return feeds.episode_view(spark, out)


@query("t07_episode_tracking", with_ctes(MESSAGES_SQL) + "SELECT area_code, count(*) AS episodes, sum(n_messages) AS messages FROM episodes GROUP BY area_code")
def _(spark, d):
    return _tracked(spark, d).groupBy("area_code").agg(F.count(F.lit(1)).alias("episodes"), F.sum("n_messages").alias("messages"))


@query("t07_tracked_episodes", with_ctes(MESSAGES_SQL) + """
SELECT area_code, CAST(run AS BIGINT) AS run, start_time, end_time, start_level, peak_level, n_messages, CASE WHEN end_time IS NULL THEN 'open' ELSE 'no_longer_in_force' END AS ended_by FROM episodes""")
def _(spark, d):
    return _tracked(spark, d).drop("stale_open").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_time", "end_time")})
