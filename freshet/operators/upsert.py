"""Table upserts as DataFrame functions: each returns the NEW table, nothing is written here.

Keys that arrive with a batch are reduced to a distinct key set before the anti-join, so the batch side of the shuffle is
no wider than its keys.  No side is hinted: Spark broadcasts a key set only when its measured size allows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _keys(df: DataFrame, on: list[str]) -> DataFrame:
    return df.select(*on).distinct()


def replace_rows(existing: DataFrame, ids: DataFrame, incoming: DataFrame, on: list[str]) -> DataFrame:
    """Drop every existing row of ``ids`` and add ``incoming`` (which may be empty: the ids are then cleared)."""
    return existing.join(_keys(ids, on), on, "left_anti").unionByName(incoming, allowMissingColumns=True)


def replace_rows_of_source(existing: DataFrame, ids: DataFrame, incoming: DataFrame, on: list[str], source_column: str,
                           source: str, legacy: str) -> DataFrame:
    """As ``replace_rows`` but only for one source; rows with no source count as ``legacy``."""
    if source_column not in existing.columns:
        existing = existing.withColumn(source_column, F.lit(None).cast("string"))
    mine = F.coalesce(F.col(source_column), F.lit(legacy)) == source
    # one pass over the table: the row's source joins the key, so other sources can never match
    doomed = _keys(ids, on).withColumn("_source", F.lit(source))
    keyed = existing.withColumn("_source", F.when(mine, F.lit(source)))
    kept = keyed.join(doomed, on + ["_source"], "left_anti").select(*existing.columns)
    return kept.unionByName(incoming, allowMissingColumns=True)


def of_source(df: DataFrame, source: str, legacy: str, column: str = "geometry_source") -> DataFrame:
    """Rows of one source; a missing column or value means ``legacy``."""
    if column not in df.columns:
        return df if source == legacy else df.filter(F.lit(False))
    return df.filter(F.coalesce(F.col(column), F.lit(legacy)) == source)


def insert_new(existing: DataFrame, incoming: DataFrame, on: list[str]) -> DataFrame:
    """Insert-only merge: rows of ``incoming`` whose key the table does not hold, one per key."""
    fresh = incoming.join(_keys(existing, on), on, "left_anti").dropDuplicates(on)
    return existing.unionByName(fresh, allowMissingColumns=True)


def only_new(existing: DataFrame, incoming: DataFrame, on: list[str]) -> DataFrame:
    """The rows of ``incoming`` with an unseen key."""
    return incoming.join(_keys(existing, on), on, "left_anti")


def update_matched(existing: DataFrame, fixes: DataFrame, on: list[str], fill: list[str], overwrite: list[str],
                   stamp: dict[str, Column] | None = None) -> DataFrame:
    """Update matched rows: ``fill`` columns only where the fix has a value, ``overwrite`` columns always."""
    right = fixes.select(*on, *[F.col(c).alias(f"_fix_{c}") for c in fill + overwrite], F.lit(True).alias("_hit"))
    joined = existing.join(right, on, "left")
    columns = []
    for name in existing.columns:
        if name in fill:
            columns.append(F.coalesce(F.col(f"_fix_{name}"), F.col(name)).alias(name))
        elif name in overwrite:
            columns.append(F.when(F.col("_hit"), F.col(f"_fix_{name}")).otherwise(F.col(name)).alias(name))
        elif stamp and name in stamp:
            columns.append(F.when(F.col("_hit"), stamp[name]).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.col(name))
    return joined.select(*columns)


def release_covered(live: DataFrame, archive: DataFrame, through: Column, on: list[str], day: str) -> DataFrame:
    """Live rows the archive does not cover: later than ``through``, and not among the archive's exact keys."""
    newer = live.filter(F.col(day) > through)
    return newer.join(_keys(archive, on), on, "left_anti")


def trim_older(df: DataFrame, time: str, as_of: Column, days: int) -> DataFrame:
    return df.filter(F.col(time) >= as_of - F.expr(f"INTERVAL {int(days)} DAYS"))


def replace_open_rows(existing: DataFrame, incoming: DataFrame, scope: list[str], on: list[str], status: str,
                      open_value: str) -> DataFrame:
    """Within the ``scope`` keys of ``incoming``, replace rows still ``open_value``.

    Rows a person has moved on keep their place and their keys are not written again.
    """
    is_open = F.col(status) == open_value
    protected = existing.filter(~is_open)
    allowed = incoming.join(_keys(protected, on), on, "left_anti")
    untouched = existing.filter(is_open).join(_keys(incoming, scope), scope, "left_anti")
    return reduce(DataFrame.unionByName, [protected, untouched, allowed])


def outstanding(work: DataFrame, done: DataFrame, key: str, version: str) -> DataFrame:
    """Work items never logged, or logged at another version (missing versions are equal)."""
    logged = done.select(F.col(key), F.coalesce(F.col(version), F.lit("")).alias("_version")).distinct()
    tagged = work.withColumn("_version", F.coalesce(F.col(version), F.lit("")))
    return tagged.join(logged, [key, "_version"], "left_anti").drop("_version")


def complete(work: DataFrame, done: DataFrame, key: str, version: str) -> DataFrame:
    """Work items logged at their current version."""
    logged = done.select(F.col(key), F.coalesce(F.col(version), F.lit("")).alias("_version")).distinct()
    tagged = work.withColumn("_version", F.coalesce(F.col(version), F.lit("")))
    return tagged.join(logged, [key, "_version"], "left_semi").drop("_version")


def empty_table(spark, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
