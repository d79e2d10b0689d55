"""Briefing drafts: subject and body text for every (statement, constituency) at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from freshet.functions import risk
from freshet.functions.risk import lookup

# Wording of the briefing.
SOURCE_TITLES = {"river": "River flooding", "coastal": "Coastal flooding", "surface": "Surface water flooding", "ground": "Groundwater flooding"}
SOURCE_PHRASES = {"river": "river", "coastal": "coastal", "surface": "surface water", "ground": "groundwater"}
CLOSING = [
    "", "The Flood Guidance Statement forecasts the risk of flooding across England for the next five days. It is not a flood warning. "
        "Warnings and alerts for individual areas are issued separately by the Environment Agency.",
    "", "[Sender name and contact details to be added on review]"]


def long_date(day: Column) -> Column:
    return F.date_format(day, "EEEE d MMMM yyyy")


def source_title(source: Column) -> Column:
    return F.coalesce(lookup(source, SOURCE_TITLES), F.initcap(source))


def day_dates(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Dates of days 1 to 5 per key, missing ones counted from the lowest known day."""
    known = pairs.filter(F.col("day_index").isNotNull() & F.col("forecast_date").isNotNull())
    base = known.groupBy(*keys).agg(F.min(F.struct("day_index", "forecast_date")).alias("_base"), *[
        F.min(F.when(F.col("day_index") == n, F.to_date("forecast_date"))).alias(f"_known{n}") for n in range(1, 6)])
    counted = lambda n: F.date_add(F.to_date("_base.forecast_date"), (F.lit(n) - F.col("_base.day_index")).cast("int"))
    return base.select(*keys, *[F.coalesce(f"_known{n}", counted(n)).alias(f"date_day{n}") for n in range(1, 6)])


def _counted(n: Column, noun: str) -> Column:
    return F.when(n > 0, F.concat(n.cast("string"), F.lit(f" {noun}"), F.when(n == 1, "").otherwise("s")))


def areas_sentence(n_warning: Column, n_alert: Column, level: Column, sources: Column) -> Column:
    """How many warning and alert areas lie under the forecast; NULL when none do.  ``sources`` is a sorted array."""
    total = n_warning + n_alert
    subject = F.concat_ws(" and ", _counted(n_warning, "flood warning area"), _counted(n_alert, "flood alert area"))
    names = F.transform(F.array_sort(F.array_distinct(sources)), lambda s: F.coalesce(lookup(s, SOURCE_PHRASES), s))
    n = F.size(names)
    listed = (F.when(n > 1, F.concat(F.array_join(F.slice(names, F.lit(1), n - 1), ", "), F.lit(" and "), F.element_at(names, -1)))
              .when(n == 1, names[0]))
    kind = (F.when(n_warning == 0, "a flood alert").when(n_alert == 0, "a flood warning").otherwise("a flood warning or alert"))
    text = F.concat(
        subject, F.when(total == 1, " lies").otherwise(" lie"), F.lit(" under the forecast "), level,
        F.coalesce(F.concat(F.lit(" "), listed), F.lit("")), F.lit(" flood risk. "),
        F.when(total == 1, "This is a place").otherwise("These are places"), F.lit(" where the Environment Agency could issue "), kind,
        F.lit(" if the risk is realised."))
    return F.when(total > 0, text)


def drafts(situations: DataFrame, detail: DataFrame, areas: DataFrame, min_rank: int = 1) -> DataFrame:
    """Subject and body per (statement, constituency) at or above ``min_rank``.

    ``situations`` carries the situation columns and issued_at; ``detail`` the forecast rows (source, risk_rank, forecast_date,
    day_index, labels); ``areas`` the warning and alert areas under each constituency's polygons.  Texts are assembled from
    aggregates per key: a key has few sources and five days, so its lists are bounded.
    """
    key = ["statement_id", "constituency_id"]
    wanted = situations.filter(F.col("worst_rank") >= min_rank)
    at_worst = detail.join(wanted.select(*key, "worst_rank", "worst_date"), key).filter(
        (F.col("risk_rank") == F.col("worst_rank")) & (F.to_date("forecast_date") == F.to_date("worst_date")))
    line = F.concat(F.lit("  - "), source_title(F.col("source")), F.lit(": "), F.col("impact_label"), F.lit(" impact, "),
                    F.col("likelihood_label"), F.lit(" likelihood"))
    lines = at_worst.select(*key, line.alias("_line")).distinct().groupBy(*key).agg(
        F.concat_ws("\n", F.array_sort(F.collect_list("_line"))).alias("_lines"))
    dates = day_dates(detail, ["statement_id"])
    under = areas.join(wanted.select(*key, "worst_rank", "worst_sources"), key).filter(
        (F.col("risk_rank") == F.col("worst_rank")) & F.array_contains(F.split("worst_sources", ", "), F.col("source")))
    per = lambda kind: F.count_distinct(F.when(F.col("area_kind") == kind, F.col("area_code")))
    counts = under.groupBy(*key).agg(per("flood_warning").alias("_n_warning"), per("flood_alert").alias("_n_alert"))

    joined = wanted.join(lines, key, "left").join(counts, key, "left").join(dates, "statement_id", "left")
    level = risk.risk_level(F.col("worst_rank"))
    worst_day = long_date(F.to_date("worst_date"))
    n_w, n_a = (F.coalesce(c, F.lit(0)) for c in ("_n_warning", "_n_alert"))
    day_lines = [F.concat(
        F.lit(f"  - Day {n}, "), F.coalesce(long_date(F.col(f"date_day{n}")), F.lit(f"Day {n}")), F.lit(": "),
        F.coalesce(risk.risk_level(F.col(f"rank_day{n}")), F.lit("No risk flagged"))) for n in range(1, 6)]
    in_force_w = F.coalesce("severe_warnings", F.lit(0)) + F.coalesce("warnings", F.lit(0))
    in_force_a = F.coalesce("alerts", F.lit(0))
    optional = lambda c: F.when(c.isNotNull(), F.concat(F.lit("\n"), c))
    rising = F.when(F.col("escalated"), "This is higher than in the previous statement.")
    active = F.when(in_force_w + in_force_a > 0, F.concat(
        F.lit("The Environment Agency currently has "), in_force_w.cast("string"), F.lit(" flood warning(s) and "),
        in_force_a.cast("string"), F.lit(" flood alert(s) in force in the constituency.")))
    sentence = areas_sentence(n_w, n_a, level, F.split("worst_sources", ", "))
    body = F.concat_ws(
        "\n", F.concat(F.lit("Dear "), F.col("mp_name"), F.lit(",")), F.lit(""),
        F.concat(F.lit("The Flood Guidance Statement issued on "), F.substring(F.col("issued_at").cast("string"), 1, 10),
                 F.lit(" shows a "), level, F.lit(" flood risk for "), F.col("constituency_name"), F.lit(" on "), worst_day, F.lit(".")),
        F.lit(""), F.lit("Behind that risk:"), F.coalesce("_lines", F.lit("")), F.lit(""),
        F.lit("The forecast for each of the five days:"), *day_lines, optional(rising), optional(sentence), optional(active),
        *[F.lit(t) for t in CLOSING])
    subject = F.concat(F.lit("Flood forecast: "), level, F.lit(" risk for "), F.col("constituency_name"), F.lit(" on "), worst_day)
    return joined.select(
        *key, "constituency_name", "mp_name", "worst_rank", level.alias("worst_level"), "worst_date",
        F.col("escalated").alias("is_escalation"), "has_active_warning", subject.alias("subject"), body.alias("body"),
        F.lit("draft").alias("status"))


def backfill_window(statements: DataFrame, window: str, newest: Column | None = None) -> DataFrame:
    """Statements of a backfill window: ``"12"`` newest ones, ``"30d"`` days, ``"all"``, or ids ``"101,102"``."""
    spec = window.strip().lower()
    if spec == "all":
        return statements
    if spec.endswith("d") and spec[:-1].isdigit():
        edge = newest if newest is not None else F.current_timestamp()
        return statements.filter(F.col("issued_at") >= edge - F.expr(f"INTERVAL {int(spec[:-1])} DAYS"))
    if "," in spec:
        return statements.filter(F.col("statement_id").isin([int(i) for i in spec.split(",") if i.strip()]))
    return statements.orderBy(F.desc("issued_at"), F.desc("statement_id")).limit(int(spec))
