"""Warning history, coverage and timing."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.bindings.base import MESSAGES_SQL, messages, query, stored, table, with_ctes
from freshet.functions.clock import minutes_between
from freshet.operators import intervals
from freshet.operators.pick import top_per_key, union_by_priority
from freshet.operators.scan import exact_median
from freshet.plans import history, timing

AS_OF = lambda: F.lit("2024-02-05 00:00:00").cast("timestamp_ntz")
DAY = lambda c="time": F.to_date(c)


def _history(spark, d):
    gap = (F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-11").cast("timestamp_ntz"))
    return history.episodes_and_periods(messages(spark, d), AS_OF(), gap)


HISTORY = with_ctes(MESSAGES_SQL)


@query("w06_episodes", HISTORY + """
SELECT area_code || '_' || strftime(start_time, '%Y%m%dT%H%M') AS episode_id, area_code, start_time, end_time, start_level, peak_level, n_messages,
  CASE WHEN end_time IS NULL THEN 'open' ELSE 'no_longer_in_force' END AS ended_by, end_time IS NULL AS is_open FROM episodes""")
def _(spark, d):
    episodes, _ = _history(spark, d)
    return episodes.select("episode_id", "area_code", "start_time", "end_time", "start_level", "peak_level", "n_messages", "ended_by", "is_open")


@query("w06_orphan_switch_offs", HISTORY + """
SELECT count(*) AS orphan_off FROM (SELECT area_code, run FROM ordered GROUP BY area_code, run HAVING count(*) FILTER (level <> 'off') = 0)""")
def _(spark, d):
    return history.orphan_offs(messages(spark, d))


@query("w07_periods_inside_episodes", HISTORY + """
SELECT e.area_code || '_' || strftime(e.start_time, '%Y%m%dT%H%M') || '_' || p.n AS period_id, p.level, p.start_time, p.end_time, p.started_by, p.ended_by
FROM periods p JOIN episodes e USING (area_code, run)""")
def _(spark, d):
    _, periods = _history(spark, d)
    return periods.select("period_id", "level", "start_time", "end_time", "started_by", "ended_by")


@query("w08_episode_measures", HISTORY + """
SELECT e.area_code, e.start_time, round((epoch_us(coalesce(e.end_time, TIMESTAMP '2024-02-05 00:00:00')) - epoch_us(e.start_time)) / 6e7, 1) AS minutes,
  count(s.n) AS n_severe_periods, count(s.n) > 0 AS had_severe,
  e.end_time IS NULL AND TIMESTAMP '2024-02-05 00:00:00' > e.start_time + INTERVAL 30 DAY AS stale_open,
  e.start_time <= TIMESTAMP '2024-01-10 00:00:00' AND (e.end_time IS NULL OR e.end_time >= TIMESTAMP '2024-01-11 00:00:00') AS spans_gap,
  CASE substr(e.area_code, 4, 3) WHEN 'FWF' THEN 'flood_warning' WHEN 'WAC' THEN 'flood_alert' ELSE 'unknown' END AS area_type
FROM episodes e LEFT JOIN periods s ON s.area_code = e.area_code AND s.run = e.run AND s.level = 'severe_flood_warning' GROUP BY ALL""")
def _(spark, d):
    episodes, _ = _history(spark, d)
    minutes = F.round(minutes_between(F.coalesce("end_time", AS_OF()), F.col("start_time")), 1)
    return episodes.select("area_code", "start_time", minutes.alias("minutes"), "n_severe_periods", "had_severe", "stale_open", "spans_gap", "area_type")


@query("w13_first_warning_level_period", HISTORY + """
SELECT e.area_code || '_' || strftime(e.start_time, '%Y%m%dT%H%M') AS episode_id, min(p.start_time) AS issue_time,
  coalesce(e.end_time, TIMESTAMP '2024-02-05 00:00:00') AS end_time
FROM periods p JOIN episodes e USING (area_code, run) WHERE p.level IN ('flood_warning', 'severe_flood_warning') GROUP BY 1, 3""")
def _(spark, d):
    episodes, periods = _history(spark, d)
    return timing.warning_issues(periods, episodes, AS_OF()).select("episode_id", "issue_time", "end_time")


@query("s20_change_log_to_events", """
SELECT CAST(user_id AS VARCHAR) AS area_code, CASE event_type WHEN 'error' THEN ts + INTERVAL 1 HOUR WHEN 'view' THEN ts + INTERVAL 5 MINUTE ELSE ts END AS time,
  CASE WHEN event_type = 'error' THEN 'off' WHEN value < 10 THEN 'severe_flood_warning' WHEN value < 50 THEN 'flood_warning' WHEN value < 120 THEN 'flood_alert' ELSE 'off' END AS level,
  CASE WHEN event_type = 'error' THEN 'closed_fallback' ELSE 'message' END AS kind
FROM events WHERE NOT (event_type = 'error' AND value >= 120)""")
def _(spark, d):
    e, v = table(spark, d, "events"), F.col("value")
    log = e.select(
        F.col("user_id").alias("flood_area_id"), F.when(v < 10, 1).when(v < 50, 2).when(v < 120, 3).otherwise(4).alias("severity_level"),
        F.when(F.col("event_type") == "error", "CLOSED").when(F.col("event_type") == "view", "MESSAGE_CHANGE").otherwise("NEW").alias("change_type"),
        F.col("ts").alias("time_severity_changed"), (F.col("ts") + F.expr("INTERVAL 5 MINUTES")).alias("time_message_changed"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("ingested_at"))
    return history.events_from_log(log).select("area_code", "time", "level", "kind")


@query("s19_message_history_scan", """
SELECT lpad(CAST(user_id AS VARCHAR), 3, '0') AS area_code, date_trunc('second', ts) AS time,
  CASE event_type WHEN 'signup' THEN 'flood_alert' WHEN 'purchase' THEN 'severe_flood_warning' WHEN 'click' THEN 'flood_warning' ELSE 'off' END AS level, count(*) > 0 AS kept
FROM events WHERE user_id % 10 <> 0 AND event_type <> 'view' GROUP BY ALL""")
def _(spark, d):
    return history.read_messages(_raw_messages(spark, d))[0].select("area_code", "time", "level", F.lit(True).alias("kept"))


def _raw_messages(spark, d):
    e, k = table(spark, d, "events"), F.col("event_type")
    return e.select(
        F.when(F.col("user_id") % 10 != 0, F.lpad(F.col("user_id").cast("string"), 3, "0")).alias("TACode"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("dateTime"),
        F.when(k == "signup", " Flood Alert ").when(k == "purchase", "Severe flood warning").when(k == "click", "Flood warning").when(k == "view", "Unheard of").alias("Severity"),
        F.when(k == "error", 4).when(k == "click", 1).alias("severity_number"), F.lit("history").alias("Source"))


@query("s19_dropped_rows_by_reason", """
SELECT count(*) AS rows, count(*) FILTER (user_id % 10 = 0) AS no_code, 0 AS no_time, count(*) FILTER (user_id % 10 <> 0 AND event_type = 'view') AS unknown_severity,
  count(*) FILTER (user_id % 10 <> 0 AND event_type <> 'view') AS kept FROM events""")
def _(spark, d):
    return history.read_messages(_raw_messages(spark, d))[1]


@query("u04_combine_event_sources", HISTORY + """,
both_sources AS (SELECT area_code, date_trunc('hour', time) AS time, level, 0 AS p FROM messages WHERE time < TIMESTAMP '2024-01-20 00:00:00'
                 UNION ALL SELECT area_code, date_trunc('hour', time), level, 1 FROM messages WHERE time >= TIMESTAMP '2024-01-15 00:00:00')
SELECT area_code, time, level, CASE min(p) WHEN 0 THEN 'history_file' ELSE 'change_log' END AS origin FROM both_sources GROUP BY area_code, time, level""")
def _(spark, d):
    m = messages(spark, d).select("area_code", F.date_trunc("hour", "time").alias("time"), "level", "kind", F.col("time").alias("at"))
    cut = lambda s: F.lit(s).cast("timestamp_ntz")
    file = m.filter(F.col("at") < cut("2024-01-20")).drop("at").withColumn("origin", F.lit("history_file"))
    log = m.filter(F.col("at") >= cut("2024-01-15")).drop("at").withColumn("origin", F.lit("change_log"))
    return history.combine(file, log).select("area_code", "time", "level", "origin")


@query("u02_warning_and_alert_areas", """
SELECT kind, area_id, name FROM (SELECT *, row_number() OVER (PARTITION BY kind, area_id ORDER BY p, name) AS n FROM (
  SELECT 'flood_warning' AS kind, p_partkey % 1500 AS area_id, p_name AS name, 0 AS p FROM part UNION ALL
  SELECT 'flood_warning', c_custkey, c_name, 1 FROM customer UNION ALL SELECT 'flood_alert', s_suppkey, s_name, 2 FROM supplier)) WHERE n = 1""")
def _(spark, d):
    part = table(spark, d, "part").select(F.lit("flood_warning").alias("kind"), (F.col("p_partkey") % 1500).alias("area_id"), F.col("p_name").alias("name"))
    cust = table(spark, d, "customer").select(F.lit("flood_warning").alias("kind"), F.col("c_custkey").alias("area_id"), F.col("c_name").alias("name"))
    supp = table(spark, d, "supplier").select(F.lit("flood_alert").alias("kind"), F.col("s_suppkey").alias("area_id"), F.col("s_name").alias("name"))
    return union_by_priority([part, cust, supp], ["kind", "area_id"], [F.col("name")])


@query("p16_warning_history_by_area", HISTORY + """
SELECT area_code, count(*) AS episodes, count(*) FILTER (end_time IS NULL) AS open_now, sum(n_messages) AS messages FROM episodes GROUP BY area_code""")
def _(spark, d):
    episodes, _ = _history(spark, d)
    return episodes.groupBy("area_code").agg(
        F.count(F.lit(1)).alias("episodes"), F.count_if("is_open").alias("open_now"), F.sum("n_messages").alias("messages"))


# ---- coverage ------------------------------------------------------------------------------------------------

COVERAGE_SQL = MESSAGES_SQL + """,
cover AS (SELECT area_code, CAST(time AS DATE) AS d, CAST(time AS DATE) - CAST(event_id % 3 AS INTEGER) AS s, max(CAST(event_id % 5 AS INTEGER)) AS rk,
            string_agg(DISTINCT CASE event_id % 4 WHEN 0 THEN 'river' WHEN 1 THEN 'coastal' WHEN 2 THEN 'surface' ELSE 'ground' END, ','
              ORDER BY CASE event_id % 4 WHEN 0 THEN 'river' WHEN 1 THEN 'coastal' WHEN 2 THEN 'surface' ELSE 'ground' END) AS sources
          FROM messages WHERE event_id % 5 >= 1 GROUP BY 1, 2, 3),
eps AS (SELECT area_code, run, CAST(start_time AS DATE) AS issue_date,
          greatest(coalesce(CAST(end_time AS DATE), CASE WHEN TIMESTAMP '2024-02-05 00:00:00' > start_time + INTERVAL 30 DAY THEN CAST(start_time AS DATE)
            ELSE DATE '2024-02-05' END), CAST(start_time AS DATE)) AS last_day,
          area_code || '_' || strftime(start_time, '%Y%m%dT%H%M') AS episode_id FROM episodes),
days AS (SELECT episode_id, area_code, issue_date, CAST(u.d AS DATE) AS d FROM eps, unnest(generate_series(CAST(issue_date AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL 1 DAY)) AS u(d)),
m AS (SELECT days.*, s, rk, sources FROM days JOIN cover USING (area_code, d)),
covered AS (
  SELECT e.episode_id, e.area_code, e.issue_date, coalesce(max(rk), 0) AS max_rank, coalesce(max(rk) FILTER (d = m.issue_date), 0) AS issue_day_rank,
    coalesce(max(rk) FILTER (d > m.issue_date), 0) AS later_rank, coalesce(max(rk) FILTER (d = m.issue_date AND s < m.issue_date), 0) AS rank_before,
    coalesce(max(rk) FILTER (d = m.issue_date AND s >= m.issue_date), 0) AS rank_same_day,
    min(s) FILTER (d = m.issue_date AND rk >= 1) AS first_cover_ge1, min(s) FILTER (d = m.issue_date AND rk >= 2) AS first_cover_ge2,
    min(s) FILTER (d = m.issue_date AND rk >= 3) AS first_cover_ge3, min(s) FILTER (d = m.issue_date AND rk >= 4) AS first_cover_ge4
  FROM eps e LEFT JOIN m ON m.episode_id = e.episode_id GROUP BY e.episode_id, e.area_code, e.issue_date)"""


def _links(spark, d):
    k = F.col("event_id")
    return messages(spark, d).select(
        "area_code", F.to_date("time").alias("d"), F.date_sub(F.to_date("time"), (k % 3).cast("int")).alias("s"), (k % 5).cast("int").alias("rk"),
        F.element_at(F.array(*[F.lit(s) for s in ("river", "coastal", "surface", "ground")]), (k % 4 + 1).cast("int")).alias("source"))


def _covered(spark, d):
    episodes, _ = _history(spark, d)
    return history.cover_episodes(episodes, history.best_coverage(_links(spark, d)), AS_OF())


@query("a09_best_coverage_per_area_day", with_ctes(COVERAGE_SQL) + "SELECT * FROM cover")
def _(spark, d):
    return history.best_coverage(_links(spark, d))


@query("j27_episode_days_in_force", with_ctes(COVERAGE_SQL) + "SELECT episode_id, area_code, issue_date, d FROM days")
def _(spark, d):
    return history.episode_days(_history(spark, d)[0], AS_OF())


@query("a10_coverage_timing_per_episode", with_ctes(COVERAGE_SQL) + "SELECT * FROM covered")
def _(spark, d):
    return _covered(spark, d).drop("area_type", "sources")


@query("p17_warning_against_forecast", with_ctes(COVERAGE_SQL) + """,
src AS (SELECT DISTINCT episode_id, x.s AS source, d = issue_date AS on_day FROM m, unnest(string_split(sources, ',')) AS x(s)),
agg AS (SELECT episode_id, string_agg(DISTINCT source, ',' ORDER BY source) FILTER (on_day) AS on_day, string_agg(DISTINCT source, ',' ORDER BY source) AS everyone FROM src GROUP BY episode_id)
SELECT c.episode_id, c.max_rank, CASE WHEN c.max_rank > 0 THEN coalesce(a.on_day, a.everyone) END AS sources FROM covered c LEFT JOIN agg a USING (episode_id)""")
def _(spark, d):
    return _covered(spark, d).select("episode_id", "max_rank", "sources")


CATEGORY_SQL = """,
cats AS (SELECT r AS threshold, CASE WHEN f < issue_date THEN 'before' WHEN f IS NOT NULL THEN 'same_day' WHEN later_rank >= r THEN 'later' ELSE 'none' END AS category
  FROM (SELECT issue_date, later_rank, 1 AS r, first_cover_ge1 AS f FROM covered UNION ALL SELECT issue_date, later_rank, 2, first_cover_ge2 FROM covered
        UNION ALL SELECT issue_date, later_rank, 3, first_cover_ge3 FROM covered UNION ALL SELECT issue_date, later_rank, 4, first_cover_ge4 FROM covered))
SELECT threshold, category, count(*) AS episodes, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY threshold), 1) AS share_pct FROM cats GROUP BY threshold, category"""


@query("a11_coverage_categories", with_ctes(COVERAGE_SQL) + CATEGORY_SQL)
def _(spark, d):
    return history.coverage_mix(_covered(spark, d))


@query("l10_coverage_mix", with_ctes(COVERAGE_SQL) + CATEGORY_SQL.replace(", round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY threshold), 1) AS share_pct", ""))
def _(spark, d):
    return history.coverage_mix(_covered(spark, d)).drop("share_pct")


# ---- timing --------------------------------------------------------------------------------------------------

TIMING_SQL = """
state AS (SELECT user_id, ts, value, lag(value) OVER w AS pv, lag(ts) OVER w AS pt,
            max(CASE WHEN value >= {t} THEN ts END) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
crossings AS (SELECT user_id, ts AS crossed_at FROM state WHERE value >= {t} AND pv < {t} AND (above IS NULL OR epoch_us(pt) - epoch_us(above) >= 21600000000))"""
CROSS = TIMING_SQL.replace("{t}", "100")
TRIGGER = CROSS + "," + TIMING_SQL.replace("{t}", "60").replace("state", "state2").replace("crossings", "triggers")
ISSUES_SQL = """,
issues AS (SELECT user_id, event_id AS episode_id, ts AS issue_time, ts + INTERVAL 48 HOUR AS end_time FROM events WHERE event_type = 'purchase')"""


def _crossings(spark, d, threshold):
    return timing.upcrossings(table(spark, d, "events"), ["user_id"], "ts", "value", F.lit(float(threshold)), 6.0)


def _issues(spark, d):
    return table(spark, d, "events").filter("event_type = 'purchase'").select(
        "user_id", F.col("event_id").alias("episode_id"), F.col("ts").alias("issue_time"), (F.col("ts") + F.expr("INTERVAL 48 HOURS")).alias("end_time"))


@query("w10_upcrossings_with_reset", with_ctes(CROSS) + "SELECT * FROM crossings")
def _(spark, d):
    return _crossings(spark, d, 100)


@query("j23_latest_issue_in_force", with_ctes(CROSS) + ISSUES_SQL + """
SELECT user_id, crossed_at, max(issue_time) AS issue_time FROM crossings JOIN issues USING (user_id) WHERE issue_time <= crossed_at AND end_time >= crossed_at GROUP BY 1, 2""")
def _(spark, d):
    return timing.issue_in_force(_crossings(spark, d, 100), _issues(spark, d), ["user_id"], ["user_id", "crossed_at"]).select("user_id", "crossed_at", "issue_time")


@query("j24_next_issue_within_tolerance", with_ctes(CROSS) + ISSUES_SQL + """
SELECT user_id, crossed_at, min(issue_time) AS issue_time FROM crossings JOIN issues USING (user_id)
WHERE issue_time > crossed_at AND issue_time <= crossed_at + INTERVAL 24 HOUR GROUP BY 1, 2""")
def _(spark, d):
    return timing.next_issue(_crossings(spark, d, 100), _issues(spark, d), ["user_id"], ["user_id", "crossed_at"], 24).select("user_id", "crossed_at", "issue_time")


@query("j25_last_trigger_within_lookback", with_ctes(TRIGGER) + """
SELECT c.user_id, c.crossed_at, max(t.crossed_at) AS trigger_time FROM crossings c LEFT JOIN triggers t
  ON t.user_id = c.user_id AND t.crossed_at <= c.crossed_at AND t.crossed_at >= c.crossed_at - INTERVAL 72 HOUR GROUP BY 1, 2""")
def _(spark, d):
    return intervals.last_before(_crossings(spark, d, 100), _crossings(spark, d, 60), ["user_id"], "crossed_at", "crossed_at", 72, "trigger_time").select(
        "user_id", "crossed_at", "trigger_time")


@query("j26_warnings_nothing_crossed", with_ctes(CROSS) + ISSUES_SQL + """
SELECT i.user_id, i.episode_id, EXISTS (SELECT 1 FROM events e WHERE e.user_id = i.user_id AND e.ts BETWEEN i.issue_time AND i.end_time) AS had_readings
FROM issues i WHERE NOT EXISTS (SELECT 1 FROM crossings c WHERE c.user_id = i.user_id AND c.crossed_at BETWEEN i.issue_time AND i.end_time)""")
def _(spark, d):
    issues = _issues(spark, d)
    hit = intervals.intervals_with_instants(issues, _crossings(spark, d, 100), ["user_id"], "crossed_at", "issue_time", "end_time", "episode_id")
    alone = issues.join(hit, "episode_id", "left_anti")
    low = table(spark, d, "events").select("user_id", F.col("ts").alias("read_at"))
    seen = intervals.intervals_with_instants(alone, low, ["user_id"], "read_at", "issue_time", "end_time", "episode_id").withColumn("_seen", F.lit(True))
    return alone.join(seen, "episode_id", "left").select("user_id", "episode_id", F.coalesce("_seen", F.lit(False)).alias("had_readings"))


VALIDATE = with_ctes(TRIGGER) + ISSUES_SQL + """,
live AS (SELECT c.user_id, c.crossed_at, max(issue_time) AS issue_time, arg_max(episode_id, (issue_time, episode_id)) AS episode_id FROM crossings c
         JOIN issues i ON i.user_id = c.user_id AND issue_time <= crossed_at AND end_time >= crossed_at GROUP BY 1, 2),
rest AS (SELECT * FROM crossings c WHERE NOT EXISTS (SELECT 1 FROM live l WHERE l.user_id = c.user_id AND l.crossed_at = c.crossed_at)),
late AS (SELECT c.user_id, c.crossed_at, min(issue_time) AS issue_time, arg_min(episode_id, (issue_time, episode_id)) AS episode_id FROM rest c
         JOIN issues i ON i.user_id = c.user_id AND issue_time > crossed_at AND issue_time <= crossed_at + INTERVAL 24 HOUR GROUP BY 1, 2),
res AS (
  SELECT user_id, 'res_event' AS kind, CASE WHEN (epoch_us(crossed_at) - epoch_us(issue_time)) / 3.6e9 >= 4.0 THEN 'on time' ELSE 'too short' END AS outcome, crossed_at, issue_time, episode_id FROM live
  UNION ALL SELECT user_id, 'res_event', 'late', crossed_at, issue_time, episode_id FROM late
  UNION ALL SELECT user_id, 'res_event', 'missed', crossed_at, NULL, NULL FROM rest r WHERE NOT EXISTS (SELECT 1 FROM late l WHERE l.user_id = r.user_id AND l.crossed_at = r.crossed_at)
  UNION ALL SELECT i.user_id, 'warning_only', CASE WHEN EXISTS (SELECT 1 FROM events e WHERE e.user_id = i.user_id AND e.ts BETWEEN i.issue_time AND i.end_time)
      THEN 'RES not reached' ELSE 'no readings' END, NULL, i.issue_time, i.episode_id FROM issues i
    WHERE NOT EXISTS (SELECT 1 FROM crossings c WHERE c.user_id = i.user_id AND c.crossed_at BETWEEN i.issue_time AND i.end_time)
      AND NOT EXISTS (SELECT 1 FROM late l WHERE l.user_id = i.user_id AND l.episode_id = i.episode_id)),
timed AS (
  SELECT r.*, CASE WHEN crossed_at IS NOT NULL AND issue_time IS NOT NULL THEN round((epoch_us(crossed_at) - epoch_us(issue_time)) / 3.6e9, 2) END AS lead_hours,
    (SELECT max(t.crossed_at) FROM triggers t WHERE t.user_id = r.user_id AND t.crossed_at <= coalesce(r.crossed_at, r.issue_time)
       AND t.crossed_at >= coalesce(r.crossed_at, r.issue_time) - INTERVAL 72 HOUR) AS trigger_time FROM res r)"""


def _validated(spark, d):
    gauge = lambda df: df.withColumn("target_lead_hours", F.lit(4.0))
    readings = gauge(table(spark, d, "events").select("user_id", F.col("user_id").alias("area"), F.col("ts").alias("read_at")))
    events = gauge(_crossings(spark, d, 100).withColumn("area", F.col("user_id")))
    issues = _issues(spark, d).withColumnRenamed("user_id", "area")
    return timing.validate(events, _crossings(spark, d, 60), readings, issues, ["user_id"], "area", "target_lead_hours")


@stored
def _results(spark, d):
    return _validated(spark, d)


@query("p18_warning_timing", VALIDATE + " SELECT user_id, kind, outcome, crossed_at, issue_time, episode_id, lead_hours, trigger_time FROM timed")
def _(spark, d):
    return _validated(spark, d).select("user_id", "kind", "outcome", "crossed_at", "issue_time", "episode_id", "lead_hours", "trigger_time")


@query("a43_timing_summary", VALIDATE + """
SELECT outcome, count(*) AS rows, round(count(*) FILTER (kind = 'res_event') / (SELECT count(*) FROM timed WHERE kind = 'res_event')::DOUBLE, 3) AS share_of_res_events,
  round(median(lead_hours), 4) AS median_lead_hours FROM timed GROUP BY outcome""")
def _(spark, d):
    return timing.timing_summary(_results(spark, d)).withColumn("median_lead_hours", F.round("median_lead_hours", 4))


@query("a43_exact_median_by_key", "SELECT l_returnflag, median(l_extendedprice) AS median_price FROM lineitem GROUP BY l_returnflag")
def _(spark, d):
    return exact_median(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", "median_price")


@query("l02_top_episodes_per_area", HISTORY + """
SELECT area_code, start_time, n_messages FROM (SELECT *, row_number() OVER (PARTITION BY area_code ORDER BY n_messages DESC, start_time) AS k FROM episodes) WHERE k <= 3""")
def _(spark, d):
    episodes, _ = _history(spark, d)
    return top_per_key(episodes, ["area_code"], [F.desc("n_messages"), F.col("start_time")], 3).select("area_code", "start_time", "n_messages")
