"""Warning history: messages and change-log rows to events, episodes and periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from freshet.functions.clock import micros
from freshet.functions import risk, text
from freshet.functions.risk import lookup
from freshet.operators.guards import dropped_report
from freshet.operators.pick import first_per_key, union_by_priority
from freshet.operators.scan import with_prior

ALERT, WARNING, SEVERE, OFF = "flood_alert", "flood_warning", "severe_flood_warning", "off"
# Message texts, severity numbers, level heights and the order of messages at one instant.
LEVEL_OF_TEXT = {"flood alert": ALERT, "flood warning": WARNING, "severe flood warning": SEVERE, "warning no longer in force": OFF}
LEVEL_OF_NUMBER = {1: SEVERE, 2: WARNING, 3: ALERT, 4: OFF}
HEIGHT = {ALERT: 1, WARNING: 2, SEVERE: 3}
TIE = {ALERT: 0, WARNING: 1, SEVERE: 2, OFF: 9}
EVENT_KEY = ["area_code", "time", "level"]


def _first_column(df: DataFrame, names: list[str]) -> Column:
    """The first of several columns that the file has, else NULL (names are taken as written)."""
    present = [n for n in names if n in df.columns]
    return F.col(present[0]).cast("string") if present else F.lit(None).cast("string")


def read_messages(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Message history to events, and a one-row report of what was dropped and why.

    ISO times first, then d/m/Y h:m am/pm, both as written.  The level is the text, else the number.
    """
    code = F.trim(_first_column(raw, ["TACode", "ta_code", "ea_area_code", "area_code"]))
    stamped = _first_column(raw, ["dateTime"])
    iso = text.any_time(F.regexp_replace(stamped, r"(Z|[+-]\d{2}:?\d{2})$", ""), [
        "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"])
    local = F.try_to_timestamp(F.upper(_first_column(raw, ["timeOfChange"])), F.lit("dd/MM/yyyy h:mma"))
    from_text = lookup(F.lower(F.trim(_first_column(raw, ["Severity", "severity_text"]))), LEVEL_OF_TEXT)
    from_number = lookup(_first_column(raw, ["severity", "severity_number"]).try_cast("double").cast("int"), LEVEL_OF_NUMBER)
    rows = raw.select(
        code.alias("area_code"), F.coalesce(iso, local).alias("time"), F.coalesce(from_text, from_number).alias("level"),
        _first_column(raw, ["Source"]).alias("source"), F.lit("history_file").alias("origin"), F.lit("message").alias("kind"),
        F.coalesce(from_text != from_number, F.lit(False)).alias("_disagrees"))
    no_code = F.col("area_code").isNull() | (F.col("area_code") == "")
    reasons = {"no_code": no_code, "no_time": F.col("time").isNull(), "unknown_severity": F.col("level").isNull()}
    report = dropped_report(rows, reasons)
    good = rows.filter(~no_code & F.col("time").isNotNull() & F.col("level").isNotNull())
    events = first_per_key(good.drop("_disagrees"), EVENT_KEY, [F.coalesce("source", F.lit(""))])
    return events, report


def events_from_log(log: DataFrame) -> DataFrame:
    """Change-log rows to events.

    NEW and SEVERITY_CHANGE count at the severity time, MESSAGE_CHANGE at the message time, both else at the poll.  CLOSED is
    a switch-off at the poll, unless the last level already was "no longer in force".
    """
    kind = F.upper("change_type")
    closed = kind == "CLOSED"
    level = lookup(F.col("severity_level").try_cast("int"), LEVEL_OF_NUMBER)
    own = F.when(kind == "MESSAGE_CHANGE", F.col("time_message_changed")).otherwise(F.col("time_severity_changed"))
    at = F.when(closed, F.col("ingested_at")).otherwise(F.coalesce(own, F.col("ingested_at")))
    fallback = closed & level.isNotNull() & (level != OFF)
    rows = log.select(
        F.trim(F.col("flood_area_id").cast("string")).alias("area_code"), at.alias("time"),
        F.when(fallback, OFF).otherwise(level).alias("level"), F.lit("change_log").alias("source"), F.lit("change_log").alias("origin"),
        F.when(fallback, "closed_fallback").otherwise("message").alias("kind"), (closed & ~fallback).alias("_skip"))
    kept = rows.filter((F.col("area_code") != "") & F.col("time").isNotNull() & F.col("level").isNotNull() & ~F.col("_skip"))
    return kept.drop("_skip")


def combine(*frames: DataFrame) -> DataFrame:
    """One event list; a repeat of (area, time, level) is kept from the earlier frame."""
    return union_by_priority(list(frames), EVENT_KEY, [F.col("kind")])


def with_runs(events: DataFrame, chunk: Column | None = None) -> DataFrame:
    """Events with their run in force (offs strictly before) and the level before them."""
    ordered = events.withColumn("_tie", lookup(F.col("level"), TIE))
    off = (F.col("level") == OFF).cast("long")
    return with_prior(ordered, ["area_code"], ["time", "_tie"], chunk,
                      last={"prior_level": F.col("level")}, total={"run": off})


def episodes_and_periods(events: DataFrame, as_of: Column, gap: tuple[Column, Column] | None = None,
                         chunk: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Runs of an area in force at any level, and the runs at one level inside them.

    Repeats of a level inside a run are updates; only level changes and the switch-off are kept for the period windows, and
    those windows are per run, so no task ever holds a whole area.
    """
    runs = with_runs(events, chunk)
    level_on = F.col("level") != OFF
    when = F.struct("time", "_tie")
    marks = runs.withColumn("_changes", level_on & (F.coalesce(F.col("prior_level") != F.col("level"), F.lit(True))))
    how = F.when(F.col("kind") == "closed_fallback", "dropped_from_feed").otherwise("no_longer_in_force")
    height = lookup(F.col("level"), HEIGHT)
    run_rows = marks.groupBy("area_code", "run").agg(
        F.min(F.when(level_on, F.col("time"))).alias("start_time"),
        F.max(F.when(~level_on, F.col("time"))).alias("end_time"),
        F.min_by(F.col("level"), F.when(level_on, when)).alias("start_level"),
        F.max_by(F.col("level"), height).alias("peak_level"),
        F.count_if(level_on).alias("n_messages"),
        F.min_by(F.col("origin"), F.when(level_on, when)).alias("start_origin"),
        F.max(F.when(~level_on, F.col("origin"))).alias("end_origin"),
        F.max(F.when(~level_on, how)).alias("ended_by"))
    in_force = run_rows.filter("n_messages > 0")
    episode_id = F.concat_ws("_", "area_code", F.date_format("start_time", "yyyyMMdd'T'HHmm"))

    compact = marks.filter(F.col("_changes") | ~level_on)
    in_run = Window.partitionBy("area_code", "run").orderBy("time", "_tie")
    steps = (compact.withColumn("end_time", F.lead("time").over(in_run)).withColumn("_next", F.lead("level").over(in_run))
             .withColumn("_how", F.lead(how).over(in_run)).withColumn("_n", F.row_number().over(in_run))
             .withColumn("_before", F.lag("level").over(in_run)).filter(level_on))
    step = lambda a, b: F.when(lookup(a, HEIGHT) > lookup(b, HEIGHT), "upgraded").otherwise("downgraded")
    ended = (F.when(F.col("_next").isNull(), "open").when(F.col("_next") == OFF, F.col("_how"))
             .otherwise(step(F.col("_next"), F.col("level"))))
    started = F.when(F.col("_before").isNull(), "issued").otherwise(step(F.col("level"), F.col("_before")))
    starts = in_force.select("area_code", "run", F.col("start_time").alias("_run_start"))
    minutes = lambda a, b: F.bround((micros(b) - micros(a)) / 6e7, 2)
    periods = (steps.join(starts, ["area_code", "run"]).select(
        F.concat_ws("_", "area_code", F.date_format("_run_start", "yyyyMMdd'T'HHmm"), F.col("_n").cast("string")).alias("period_id"),
        F.concat_ws("_", "area_code", F.date_format("_run_start", "yyyyMMdd'T'HHmm")).alias("episode_id"),
        "area_code", "run", "level", F.col("time").alias("start_time"), "end_time",
        minutes(F.col("time"), F.coalesce("end_time", as_of)).alias("duration_minutes"),
        started.alias("started_by"), ended.alias("ended_by"), F.col("end_time").isNull().alias("is_open"),
        F.col("origin").alias("start_origin"))
        .withColumn("duration_hours", F.bround(F.col("duration_minutes") / 60, 2)))

    severe = periods.filter(F.col("level") == SEVERE).groupBy("area_code", "run").agg(
        F.sum("duration_minutes").alias("_severe"), F.count(F.lit(1)).alias("_n_severe"))
    stop = F.coalesce(F.col("end_time"), as_of)
    spans = F.lit(False)
    if gap is not None:
        spans = (F.col("start_time") <= gap[0]) & F.coalesce(F.col("end_time") >= gap[1], F.lit(True))
    episodes = (in_force.join(severe, ["area_code", "run"], "left").select(
        episode_id.alias("episode_id"), "area_code", "run", risk.area_kind(F.col("area_code").cast("string")).alias("area_type"),
        "start_time", "end_time", minutes(F.col("start_time"), stop).alias("duration_minutes"), "start_level", "peak_level",
        F.col("_n_severe").isNotNull().alias("had_severe"), F.bround(F.coalesce("_severe", F.lit(0.0)), 2).alias("severe_minutes"),
        F.coalesce("_n_severe", F.lit(0)).alias("n_severe_periods"), "n_messages", F.coalesce("ended_by", F.lit("open")).alias("ended_by"),
        F.col("end_time").isNull().alias("is_open"),
        (F.col("end_time").isNull() & (as_of > F.col("start_time") + F.expr("INTERVAL 30 DAYS"))).alias("stale_open"),
        "start_origin", "end_origin", spans.alias("spans_gap"))
        .withColumn("duration_hours", F.bround(F.col("duration_minutes") / 60, 2)))
    return episodes, periods


def orphan_offs(events: DataFrame, chunk: Column | None = None) -> DataFrame:
    """Switch-offs of an area that had nothing on: a run with no level row."""
    runs = with_runs(events, chunk).groupBy("area_code", "run").agg(F.count_if(F.col("level") != OFF).alias("_levels"))
    return runs.filter("_levels = 0").agg(F.count(F.lit(1)).alias("orphan_off"))


# ---- warning against forecast --------------------------------------------------------------------------------

def episode_days(episodes: DataFrame, now: Column, span_days: int | None = None) -> DataFrame:
    """One row per episode and day in force: open runs to now, stale ones only their first day; ``span_days`` limits a run."""
    start, end = F.to_date("start_time"), F.to_date("end_time")
    stale = F.coalesce("stale_open", F.lit(False))
    last = F.coalesce(end, F.when(stale, start).otherwise(F.to_date(now)))
    last = F.greatest(last, start)
    if span_days is not None:
        last = F.least(last, F.date_add(start, span_days - 1))
    return (episodes.filter(F.col("start_time").isNotNull() & F.col("area_code").isNotNull())
            .select("episode_id", "area_code", start.alias("issue_date"), F.explode(F.sequence(start, last)).alias("d")))


def best_coverage(links: DataFrame) -> DataFrame:
    """Worst rank and sorted sources per area, forecast date and issue day."""
    return links.filter("rk >= 1").groupBy("area_code", "d", "s").agg(
        F.max("rk").alias("rk"), F.concat_ws(",", F.sort_array(F.collect_set("source"))).alias("sources"))


def cover_episodes(episodes: DataFrame, coverage: DataFrame, now: Column, span_days: int | None = None) -> DataFrame:
    """How each episode was covered, in one aggregate over (episode, day) x coverage."""
    m = episode_days(episodes, now, span_days).join(coverage, ["area_code", "d"])
    on_day, later = F.col("d") == F.col("issue_date"), F.col("d") > F.col("issue_date")
    early = F.col("s") < F.col("issue_date")
    best = lambda c: F.coalesce(F.max(F.when(c, F.col("rk"))), F.lit(0))
    # the number of flood sources is small and fixed, so a set of them is bounded
    parts = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(c, F.split("sources", ","))))))
    covered = m.groupBy("episode_id").agg(
        best(F.lit(True)).alias("max_rank"), best(on_day).alias("issue_day_rank"), best(later).alias("later_rank"),
        best(on_day & early).alias("rank_before"), best(on_day & ~early).alias("rank_same_day"),
        *[F.min(F.when(on_day & (F.col("rk") >= r), F.col("s"))).alias(f"first_cover_ge{r}") for r in (1, 2, 3, 4)],
        F.concat_ws(",", parts(on_day)).alias("_on"), F.concat_ws(",", parts(F.lit(True))).alias("_all"))
    base = episodes.filter(F.col("start_time").isNotNull() & F.col("area_code").isNotNull()).select(
        "episode_id", "area_code", "area_type", F.to_date("start_time").alias("issue_date"))
    ranks = ["max_rank", "issue_day_rank", "later_rank", "rank_before", "rank_same_day"]
    joined = base.join(covered, "episode_id", "left")
    sources = F.when(F.col("max_rank") > 0, F.when(F.col("_on") != "", F.col("_on")).otherwise(F.col("_all")))
    return joined.select(*base.columns, *[F.coalesce(r, F.lit(0)).alias(r) for r in ranks],
                         *[f"first_cover_ge{r}" for r in (1, 2, 3, 4)], sources.alias("sources"))


def coverage_category(issue_date: Column, first_cover: Column, later_rank: Column, rank: int) -> Column:
    return (F.when(first_cover < issue_date, "before").when(first_cover.isNotNull(), "same_day")
            .when(later_rank >= rank, "later").otherwise("none"))


def coverage_mix(covered: DataFrame) -> DataFrame:
    """Share of episodes per category at each risk threshold."""
    per = covered.select(F.explode(F.array(*[
        F.struct(F.lit(r).alias("threshold"), coverage_category(
            F.col("issue_date"), F.col(f"first_cover_ge{r}"), F.col("later_rank"), r).alias("category")) for r in (1, 2, 3, 4)])).alias("c"))
    counts = per.select("c.*").groupBy("threshold", "category").agg(F.count(F.lit(1)).alias("episodes"))
    total = F.sum("episodes").over(Window.partitionBy("threshold"))
    return counts.withColumn("share_pct", F.round(100 * F.col("episodes") / total, 1))
