"""Was each warning issued in time: threshold crossings against issue times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from freshet.functions.clock import micros
from freshet.functions import text
from freshet.operators.intervals import instants_in_intervals, intervals_with_instants, last_before, next_within
from freshet.operators.pick import first_per_key
from freshet.operators.scan import exact_median, with_prior
from freshet.session import cut_lineage


def upcrossings(readings: DataFrame, keys: list[str], time: str, value: str, threshold: Column, reset_hours: float = 6.0,
                chunk: Column | None = None) -> DataFrame:
    """Rows where the series rises to the threshold after being below it; the next counts only after ``reset_hours`` below.

    Closed form: at or above now, below one reading ago, and that reading came long enough after the last one above.  A series
    that starts above has no crossing.
    """
    usable = readings.filter(F.col(time).isNotNull() & F.col(value).isNotNull()).withColumn("_limit", threshold)
    above = F.col(value) >= F.col("_limit")
    state = with_prior(usable, keys, [time], chunk, last={
        "_prior": F.struct(F.col(time).alias("t"), F.col(value).alias("v")), "_above": F.when(above, F.col(time))})
    calm = F.col("_above").isNull() | (
        micros(F.col("_prior.t")) - micros(F.col("_above")) >= F.lit(int(reset_hours * 3_600_000_000)))
    hit = above & (F.col("_prior.v") < F.col("_limit")) & calm
    return state.filter(F.coalesce(hit, F.lit(False))).select(*keys, F.col(time).alias("crossed_at"))


def gauges(links: DataFrame, res_type: str = "RES", trigger_type: str = "ACTCON", purpose: str = "FW", season: str = "All") -> DataFrame:
    """One row per gauge with the value to beat, the trigger value, its warning area and its target lead."""
    label = lambda c: F.lower(F.coalesce(text.clean(F.col(c)), F.lit("")))
    used = links.filter(F.col("link_status").isin("linked", "linked_chosen") & (label("purpose") == purpose.lower())
                        & label("season").isin(season.lower(), ""))
    valued = (used.withColumn("_value", F.coalesce(F.col("value_in_measure_unit").try_cast("double"), F.col("value").try_cast("double")))
              .filter(F.col("_value").isNotNull()).withColumn("_key", text.id_key(F.col("fffs_id"))))
    res, trigger = label("type") == res_type.lower(), label("type") == trigger_type.lower()
    grouped = valued.groupBy(F.col("_key").alias("gauge_key"), "family", "measure_uri").agg(
        F.min("fffs_id").alias("fffs_id"), F.min(F.when(res, text.clean(F.col("target_area")))).alias("area_code"),
        F.min(F.when(res, F.col("_value"))).alias("res_value"), F.min(F.when(trigger, F.col("_value"))).alias("trigger_value"),
        (F.min(F.when(res, F.col("target_lead_minutes").try_cast("double"))) / 60).alias("target_lead_hours"))
    return grouped.filter(F.col("res_value").isNotNull())


def warning_issues(periods: DataFrame, episodes: DataFrame, as_of: Column) -> DataFrame:
    """Episodes that reached warning level: the start of the first such period, to the end of the episode."""
    first = (periods.filter(F.col("level").isin("flood_warning", "severe_flood_warning")).groupBy("episode_id")
             .agg(F.min("start_time").alias("issue_time"), F.min("area_code").alias("area_code")))
    ends = episodes.select("episode_id", F.coalesce("end_time", as_of).alias("end_time"))
    return first.join(ends, "episode_id")


def issue_in_force(events: DataFrame, issues: DataFrame, on: list[str], event_key: list[str]) -> DataFrame:
    """For each crossing, the latest issue in force at it."""
    pairs = instants_in_intervals(events, issues, on, "crossed_at", "issue_time", "end_time")
    return first_per_key(pairs, event_key, [F.col("issue_time"), F.col("episode_id")], highest=True)


def next_issue(events: DataFrame, issues: DataFrame, on: list[str], event_key: list[str], hours: int = 24) -> DataFrame:
    """For each crossing, the first issue in the hours after it."""
    pairs = next_within(events, issues, on, "crossed_at", "issue_time", hours)
    return first_per_key(pairs, event_key, [F.col("issue_time"), F.col("episode_id")])


def validate(events: DataFrame, triggers: DataFrame, readings: DataFrame, issues: DataFrame, gauge_keys: list[str], area: str,
             target_hours: str, late_hours: int = 24, lookback_hours: int = 72) -> DataFrame:
    """One row per crossing (on time, too short, late, missed) and per warning nothing crossed (RES not reached, no readings).

    ``events`` carry the gauge keys, the area, the target and ``crossed_at``; ``triggers`` the gauge keys and ``crossed_at``.
    """
    key = [*gauge_keys, "crossed_at"]
    # crossings are few beside the readings and used six times below: they are written once in the shared folder
    events = cut_lineage(events)
    live = issue_in_force(events, issues, [area], key)
    without = events.join(live.select(*key), key, "left_anti")
    after = next_issue(without, issues, [area], key, late_hours)
    hours = lambda a, b: (micros(a) - micros(b)) / 3.6e9
    lead = hours(F.col("crossed_at"), F.col("issue_time"))
    base = [*gauge_keys, area, target_hours]
    ontime = F.when(F.col(target_hours).isNull() | (lead >= F.col(target_hours)), "on time").otherwise("too short")
    hit = live.select(*base, F.lit("res_event").alias("kind"), ontime.alias("outcome"), "crossed_at", "issue_time", "episode_id")
    late = after.select(*base, F.lit("res_event").alias("kind"), F.lit("late").alias("outcome"), "crossed_at", "issue_time", "episode_id")
    missed = without.join(after.select(*key), key, "left_anti").select(
        *base, F.lit("res_event").alias("kind"), F.lit("missed").alias("outcome"), "crossed_at",
        F.lit(None).cast("timestamp").alias("issue_time"), F.lit(None).cast(dict(issues.dtypes)["episode_id"]).alias("episode_id"))

    # every warning of a gauge's area that no crossing of that gauge fell into
    gauge_rows = readings.select(*gauge_keys, area, target_hours).distinct()
    per_gauge = gauge_rows.join(issues, area).withColumn("_w", F.struct(*gauge_keys, "episode_id"))
    crossed = intervals_with_instants(per_gauge, events.select(*gauge_keys, "crossed_at"), gauge_keys, "crossed_at", "issue_time",
                                      "end_time", "_w")
    linked = late.select(F.struct(*gauge_keys, "episode_id").alias("_w")).distinct()
    alone = per_gauge.join(crossed, "_w", "left_anti").join(linked, "_w", "left_anti")
    seen = intervals_with_instants(alone, readings.select(*gauge_keys, "read_at"), gauge_keys, "read_at", "issue_time", "end_time",
                                   "_w").withColumn("_seen", F.lit(True))
    unreached = alone.join(seen, "_w", "left").select(
        *base, F.lit("warning_only").alias("kind"), F.when(F.col("_seen"), "RES not reached").otherwise("no readings").alias("outcome"),
        F.lit(None).cast("timestamp").alias("crossed_at"), "issue_time", "episode_id")
    rows = hit.unionByName(late).unionByName(missed).unionByName(unreached)
    rows = rows.withColumn("_at", F.coalesce("crossed_at", "issue_time"))
    timed = last_before(rows, triggers, gauge_keys, "_at", "crossed_at", lookback_hours, "trigger_time")
    both = F.col("crossed_at").isNotNull() & F.col("issue_time").isNotNull()
    return timed.select(
        *rows.columns[:-1], F.when(both, F.round(lead, 2)).alias("lead_hours"), "trigger_time",
        F.when(F.col("issue_time").isNotNull() & F.col("trigger_time").isNotNull(),
               F.round(hours(F.col("issue_time"), F.col("trigger_time")), 2)).alias("issue_delay_hours"))


def timing_summary(results: DataFrame) -> DataFrame:
    """Rows, exact median lead and share of the crossings, per outcome."""
    counts = results.groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("kind") == "res_event").alias("_events"))
    from pyspark.sql import Window

    total = F.sum("_events").over(Window.partitionBy(F.lit(0)))
    shares = counts.withColumn("share_of_res_events", F.round(F.try_divide(F.col("_events"), total), 3)).drop("_events")
    return shares.join(exact_median(results, ["outcome"], "lead_hours", "median_lead_hours"), "outcome", "left")
