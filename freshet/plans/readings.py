"""Readings: archive plus live tail as one series, registers and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from freshet.functions.clock import micros
from freshet.functions import text
from freshet.operators.pick import first_per_key


def one_series(archive: DataFrame, live: DataFrame, keys: list[str], time: str, day: str, first_live_day: Column | None = None) -> DataFrame:
    """Archive and live rows with their origin; the archive wins per day and per exact (key, time).

    ``first_live_day`` bounds the archive scan of the second test to the partitions the live tail can touch.
    """
    held = archive if first_live_day is None else archive.filter(F.col(day) >= first_live_day)
    tail = (live.join(held.select(day).distinct(), day, "left_anti")
            .join(held.select(*keys, time).distinct(), [*keys, time], "left_anti").select(*live.columns))
    return (archive.withColumn("source", F.lit("archive"))
            .unionByName(tail.withColumn("source", F.lit("live")), allowMissingColumns=True))


def latest(series: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return first_per_key(series, keys, [F.col(c) for c in order], highest=True)


def deduplicate(rows: DataFrame, keys: list[str], arrival: list[Column], keep: str) -> DataFrame:
    """One row per key by an explicit arrival order: the first or the last."""
    return first_per_key(rows, keys, arrival, highest=keep == "last")


def release(live: DataFrame, archive: DataFrame, landed_day: Column, keys: list[str], time: str, day: str) -> DataFrame:
    """The live table after a day lands: rows up to that day go, and rows whose exact key landed."""
    from freshet.operators.upsert import release_covered

    return release_covered(live, archive, landed_day, [*keys, time], day)


def register(readings: DataFrame, measure: str, attributes: list[str]) -> DataFrame:
    """One row per measure, the least value of each attribute."""
    return readings.groupBy(measure).agg(*[F.min(a).alias(a) for a in attributes])


def assemble_register(existing: DataFrame, built: DataFrame, stations: DataFrame, measure: str, station: str, seen: Column) -> DataFrame:
    """New measures joined to station attributes (label falls back to the reading's own), added without touching held rows."""
    new = built.join(existing.select(measure).distinct(), measure, "left_anti")
    attributes = stations.withColumnRenamed("label", "_api_label")
    joined = new.join(attributes, station, "left")
    label = F.coalesce(text.blank_to_null(F.col("_api_label")), F.col("label"))
    rows = joined.withColumn("label", label).drop("_api_label").withColumn("first_seen", seen)
    return existing.unionByName(rows, allowMissingColumns=True)


def fullest_per_station(stations: DataFrame, key: Column, filled: list[str], tie: str) -> DataFrame:
    """One row per normalised station key: most non-NULL fields, then the lowest id."""
    score = sum([F.col(c).isNotNull().cast("int") for c in filled], F.lit(0))
    keyed = stations.withColumn("station_key", key)
    return first_per_key(keyed, ["station_key"], [-score, F.col(tie)])


def activity(readings: DataFrame, wanted: DataFrame, measure: str, time: str) -> DataFrame:
    return (readings.join(wanted.select(measure).distinct(), measure, "left_semi").groupBy(measure)
            .agg(F.count(F.lit(1)).alias("n_readings"), F.min(time).alias("first_reading"), F.max(time).alias("last_reading")))


def profile(readings: DataFrame, day: str, station: str, measure: str, value: str) -> DataFrame:
    return readings.agg(
        F.min(day).alias("earliest_date"), F.max(day).alias("latest_date"), F.count_distinct(day).alias("date_count"),
        F.count_distinct(station).alias("station_count"), F.count_distinct(measure).alias("measure_count"),
        F.count_if(F.col(value).isNull()).alias("null_values"), F.count(F.lit(1)).alias("reading_count"))


def profile_by(readings: DataFrame, by: str, measure: str) -> DataFrame:
    return readings.groupBy(by).agg(F.count_distinct(measure).alias("measures"), F.count(F.lit(1)).alias("reading_count"))


def mapped_measures(series: DataFrame, mapping: DataFrame, measure: str, text_columns: list[str], key: str) -> DataFrame:
    """Readings beside the least mapping values per measure and how many ids it has."""
    per = mapping.groupBy(measure).agg(
        *[F.min(c).alias(c) for c in text_columns], F.count_distinct(key).alias("mapping_ids"), F.max("n_readings").alias("n_readings"))
    return series.join(per, measure, "left")


def boundary(last_archived: Column) -> Column:
    """Where the archive ends: midnight after its last day."""
    return F.date_add(F.to_date(last_archived), 1).cast("timestamp")


def split_summary(readings: DataFrame, time: str, boundary_at: Column, now: Column) -> DataFrame:
    newest = F.max(time)
    return readings.agg(
        F.count(F.lit(1)).alias("readings"), F.count_if(F.col(time) < boundary_at).alias("archive"),
        F.count_if(F.col(time) >= boundary_at).alias("live"), newest.alias("newest"),
        F.round((micros(now) - micros(newest)) / 6e7, 1).alias("age_minutes"))


def recent_window(series: DataFrame, chosen: DataFrame, measure: str, time: str, now: Column, days: int) -> DataFrame:
    recent = series.filter(F.col(time) >= now - F.expr(f"INTERVAL {int(days)} DAYS"))
    return recent.join(chosen.select(measure).distinct(), measure, "left_semi")


# ---- register labels and facets ------------------------------------------------------------------------------

def unique_names(df: DataFrame, name: str, key: str, details: list[Column]) -> DataFrame:
    """Names told apart by details, then by the tail of the key.

    Each name decides for itself: a name of several keys takes a detail if its rows hold more than one value of it, then the next
    detail, and what still clashes takes the tail.  Rows elsewhere in the table change nothing, and every step is one aggregate.
    """
    def clashing(frame: DataFrame, *more: Column) -> DataFrame:
        return frame.groupBy(name).agg(F.count_distinct(key).alias("_keys"), *more).filter("_keys > 1").drop("_keys")

    current = df
    for detail in details:
        extra = F.trim(F.coalesce(detail.cast("string"), F.lit("")))
        apart = clashing(current, F.count_distinct(extra).alias("_kinds")).filter("_kinds > 1").select(name, F.lit(True).alias("_clash"))
        longer = F.when(F.col("_clash") & (extra != ""), F.concat(F.col(name), F.lit(" ("), extra, F.lit(")"))).otherwise(F.col(name))
        current = current.join(apart, name, "left").withColumn(name, longer).drop("_clash")
    tail = F.concat(F.col(name), F.lit(" ["), text.uri_tail(F.col(key)), F.lit("]"))
    marked = current.join(clashing(current).withColumn("_clash", F.lit(True)), name, "left")
    return marked.withColumn(name, F.when(F.col("_clash"), tail).otherwise(F.col(name))).drop("_clash")


def facet_options(df: DataFrame, choices: dict[str, str | None]) -> DataFrame:
    """(facet, option): the distinct values of each facet among the rows that match every OTHER choice."""
    flagged = df
    for facet, value in choices.items():
        flagged = flagged.withColumn(f"_ok_{facet}", F.lit(True) if value is None else F.coalesce(F.col(facet) == value, F.lit(False)))
    entries = []
    for facet in choices:
        others = F.lit(True)
        for other in choices:
            if other != facet:
                others = others & F.col(f"_ok_{other}")
        entries.append(F.struct(F.lit(facet).alias("facet"), F.when(others, F.col(facet).cast("string")).alias("option")))
    return (flagged.select(F.explode(F.array(*entries)).alias("e")).select("e.*").filter(F.col("option").isNotNull()).distinct())


def facet_filter(df: DataFrame, choices: dict[str, str | None]) -> DataFrame:
    for facet, value in choices.items():
        if value is not None:
            df = df.filter(F.col(facet) == value)
    return df


def measure_label(parameter: Column, qualifier: Column, unit: Column) -> Column:
    head = F.concat_ws(", ", F.coalesce(parameter, F.lit("measure")), text.blank_to_null(qualifier))
    return F.concat(head, F.coalesce(F.concat(F.lit(" ("), text.blank_to_null(unit), F.lit(")")), F.lit("")))
