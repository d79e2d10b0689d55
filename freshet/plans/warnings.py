"""Change detection between a warnings snapshot and the state held."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from freshet.functions import text


def detect_changes(feed: DataFrame, state: DataFrame, key: str, level: str, message: str, polled_at: Column) -> DataFrame:
    """NEW, SEVERITY_CHANGE, MESSAGE_CHANGE and CLOSED rows: one full outer join of the snapshot with the state.

    A severity change takes precedence over a new message; messages are compared trimmed.  A CLOSED row carries the last
    known state and the time of this poll.
    """
    # the state is written by earlier polls and the feed is one snapshot: both have one row per key
    a = feed.select(F.col(key), F.struct(*[c for c in feed.columns if c != key]).alias("_new"))
    b = state.select(F.col(key), F.struct(*[F.col(c) for c in feed.columns if c != key]).alias("_old"))
    plain = lambda side: F.trim(F.coalesce(F.col(f"{side}.{message}"), F.lit("")))
    kind = (F.when(F.col("_old").isNull(), "NEW").when(F.col("_new").isNull(), "CLOSED")
            .when(~F.col(f"_new.{level}").eqNullSafe(F.col(f"_old.{level}")), "SEVERITY_CHANGE")
            .when(plain("_new") != plain("_old"), "MESSAGE_CHANGE"))
    joined = a.join(b, key, "full").withColumn("change_type", kind).filter("change_type IS NOT NULL")
    row = F.coalesce("_new", "_old")
    columns = [polled_at.alias(c) if c == "ingested_at" else row[c].alias(c) for c in feed.columns if c != key]
    return joined.select(F.col(key), *columns, "change_type")


def with_log_id(rows: DataFrame, parts: list[str]) -> DataFrame:
    """The deterministic event id: the same change gives the same id, so a repeated poll appends nothing."""
    return rows.withColumn("log_id", text.url_event_id(*[F.col(p) for p in parts]))


def append_unseen(log: DataFrame, rows: DataFrame) -> DataFrame:
    return rows.join(log.select("log_id").distinct(), "log_id", "left_anti").dropDuplicates(["log_id"])
