"""Salting for equality joins with hot keys.

A key is hot when it holds more than ``1 / SHARE`` of the rows, so at most ``SHARE`` keys can be hot whatever the data: the list of
hot keys has a proven bound and may be broadcast.  A hot key gets one salt per ``1 / SHARE`` of the rows that it holds, hence at
most ``2 * SHARE`` salts exist in all and no task gets much more than that share of one key.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

SHARE = 4096
LEAST = 256        # below so many rows a key is never worth a split


def hot_rows(total: int) -> int:
    """Rows of one key above which it is split, for a table of ``total`` rows."""
    return max(LEAST, math.ceil(total / SHARE))


def _salts(counted: DataFrame, on: list[str], rows: str, limit: int) -> DataFrame:
    return counted.filter(F.col(rows) > limit).select(*on, F.ceil(F.col(rows) / limit).cast("int").alias("_salts"))


def _salt_left(left: DataFrame, hot: DataFrame, on: list[str], spread: list[str]) -> DataFrame:
    salt = F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(*spread), F.col("_salts")).cast("int")).otherwise(0)
    return left.join(F.broadcast(hot), on, "left").withColumn("_salt", salt).drop("_salts")


def salted(left: DataFrame, right: DataFrame, on: list[str], spread: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with a ``_salt`` to add to the join keys: rows of a hot key of ``left`` spread over its salts, the matching rows
    of ``right`` repeated once per salt; every other key keeps salt 0."""
    counted = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    limit = hot_rows(counted.agg(F.sum("_n")).first()[0] or 0)
    hot = _salts(counted, on, "_n", limit)
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    repeated = right.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return _salt_left(left, hot, on, spread), repeated, [*on, "_salt"]


def join_counted(left: DataFrame, right: DataFrame, on: list[str], spread: list[str], rows: str, total: int, how: str = "left") -> DataFrame:
    """``left`` joined to ``right``, which has one row per key and, in ``rows``, the number of ``left`` rows with that key; ``total``
    is the number of ``left`` rows.  Hot keys are split as in :func:`salted`, without counting again.  ``rows`` is dropped."""
    limit = hot_rows(total)
    repeated = (right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(
        F.when(F.col(rows) > limit, F.ceil(F.col(rows) / limit)).otherwise(1), F.lit(1)).cast("int") - 1))).drop(rows))
    return _salt_left(left, _salts(right, on, rows, limit), on, spread).join(repeated, [*on, "_salt"], how).drop("_salt")
