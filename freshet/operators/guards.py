"""Expectations: counts that must hold before a table is replaced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


class Refused(Exception):
    """A refresh that must not overwrite what is held."""


def guard_row_count(new: DataFrame, existing: DataFrame | None, min_ratio: float = 0.8, min_rows: int = 1) -> int:
    """Refuse a refresh smaller than ``min_rows`` or than ``min_ratio`` of what is held.  Returns the new count."""
    n = new.count()
    if n < min_rows:
        raise Refused(f"only {n} rows (minimum {min_rows})")
    held = existing.count() if existing is not None else 0
    if held and n < held * min_ratio:
        raise Refused(f"{n} rows against {held} held (minimum ratio {min_ratio})")
    return n


def guard_truncation(df: DataFrame, limit: int | None = None, matched: int | None = None) -> int:
    """Refuse a page that reached its request limit, or that returned fewer than the service matched."""
    n = df.count()
    if limit is not None and n >= limit:
        raise Refused(f"{n} rows reached the request limit {limit}: the source was truncated")
    if matched is not None and n < matched:
        raise Refused(f"{n} rows returned of {matched} matched")
    return n


def guard_empty_feed(feed: DataFrame, state: DataFrame, most_held: int = 50) -> None:
    """An empty feed against a busy state is a bad response, not the end of every warning."""
    if feed.isEmpty() and state.limit(most_held + 1).count() > most_held:
        raise Refused(f"the feed is empty but more than {most_held} areas are held")


def guard_share(df: DataFrame, bad: Column, most: float) -> None:
    """Refuse when more than ``most`` of the rows are bad."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad")).first()
    if row["n"] and row["bad"] > most * row["n"]:
        raise Refused(f"{row['bad']} of {row['n']} rows failed (limit {most:.0%})")


def guard_no_fan_out(result: DataFrame, left: DataFrame) -> None:
    if result.count() != left.count():
        raise Refused("a join changed the number of rows")


def guard_unique(df: DataFrame, keys: list[str]) -> None:
    if not df.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise Refused(f"duplicate keys in {keys}")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def dropped_report(df: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """One row: how many rows each reason drops, a row counted at its first reason only."""
    earlier = F.lit(False)
    counts = [F.count(F.lit(1)).alias("rows")]
    for name, reason in reasons.items():
        counts.append(F.count_if(reason & ~earlier).alias(name))
        earlier = earlier | reason
    return df.agg(*counts, F.count_if(~earlier).alias("kept"))


def fingerprint(df: DataFrame, columns: list[str], out: str = "fingerprint") -> DataFrame:
    """A table fingerprint that does not gather the table: hashes of rows are combined by order-free sums.

    Per-row SHA-1 words are summed in exact decimals, so the value is the same for any partitioning and any lost task.
    """
    digest = F.sha1(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))
    word = lambda i: F.conv(F.substring(digest, i, 12), 16, 10).cast("decimal(38,0)")
    return (df.agg(F.count(F.lit(1)).alias("rows"), *[F.sum(word(1 + 12 * k)).alias(f"_w{k}") for k in range(3)])
            .select("rows", F.sha1(F.concat_ws("|", F.col("rows").cast("string"), "_w0", "_w1", "_w2")).alias(out)))
