"""One row per key, chosen by an order.

``first_per_key`` is an aggregate, not a ranked window: each map task keeps one candidate per key, so a key holding a third of
all rows ships one row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], highest: bool = False) -> DataFrame:
    """The row with the lowest (or highest) ``order`` per key.  NULL keys form a group of their own."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if highest else F.min_by
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return chosen.select(*[F.col("_row." + c).alias(c) if c in rest else F.col(c) for c in df.columns])


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The best ``n`` per key; Spark trims each map task's groups before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def union_by_priority(frames: list[DataFrame], keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Union of frames where, per key, a row of an earlier frame wins (then the lowest ``order``)."""
    tagged = [f.withColumn("_priority", F.lit(i)) for i, f in enumerate(frames)]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return first_per_key(merged, keys, [F.col("_priority"), *(order or [])]).drop("_priority")


def sampled(df: DataFrame, key: str, run: str, size: int) -> DataFrame:
    """``size`` rows in a stable pseudo-random order by key and run name; Spark keeps the best ``size`` of each task only."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(run), F.col(key).cast("string"))), key).limit(size)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def numbered_ids(df: DataFrame, key: str, order: list[str], out: str = "site_id", chunk: Column | None = None) -> DataFrame:
    """``key`` made unique: the first keeps its value, repeats get ``#1``, ``#2`` and so on, in ``order`` (unique per key).

    Numbers are running counts; a ``chunk`` that does not decrease along ``order`` spreads a key that repeats very often.
    """
    from freshet.operators.scan import with_prior

    counted = with_prior(df, [key], order, chunk, total={"_n": F.lit(1)})
    unique = F.when(F.col("_n") > 0, F.concat(F.col(key), F.lit("#"), F.col("_n").cast("string"))).otherwise(F.col(key))
    return counted.withColumn(out, unique).drop("_n")
