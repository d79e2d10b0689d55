"""Ordered scans that split a hot key.

A plain ``partitionBy(key).orderBy(time)`` window puts one key in one task.  Here the rows of a hot key are cut into ranges of equal count
along the order, by borders taken from the data; each (key, range) is scanned on its own, one summary row per range carries the
state across ranges, and the two meet on the partitioning that the rows already have.  So rows move once, the result is exact, and
a key with half of all rows spreads over as many tasks as it has ranges.
"""

from __future__ import annotations

from freshet.operators.skew import hot_rows, join_counted
from freshet.session import stored_table
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

COARSE, FINE = 64, 32        # a key has at most COARSE * FINE ranges; a row finds its range in two steps


def _number(df: DataFrame, column: str) -> Column | None:
    """A number that ascends with the column, None where there is none (text)."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column) if isinstance(kind, T.NumericType) else None


def ranged(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``_key``, the keys as one value in which NULL equals NULL, and ``_chunk``, the range of its key that a row lies in.

    A key is hot from 1/4,096 of the rows on, so at most 4,096 keys have borders.  Rows of one key at one place of the first order column
    stay in one range; a text there gives no borders.
    """
    keyed = df.withColumn("_key", F.struct(*keys) if keys else F.struct(F.lit(0).alias("all")))
    at = _number(df, order[0])
    counts = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    total = (counts.agg(F.sum("_n")).first()[0] or 0) if at is not None else 0
    limit = hot_rows(total)
    hot = counts.filter(F.col("_n") > limit) if total else None
    if hot is None or hot.isEmpty():
        return keyed.withColumn("_chunk", F.lit(0))
    step = 1.0 / (COARSE * FINE)
    found = (keyed.join(F.broadcast(hot), "_key").withColumn("_at", at).groupBy("_key").agg(
        F.percentile_approx("_at", [step * i for i in range(1, COARSE * FINE)], 10_000).alias("_all"), F.max("_n").alias("_n")))
    every = F.greatest(F.lit(1), F.floor(F.lit(COARSE * FINE) / F.ceil(F.col("_n") / limit))).cast("int")        # ranges of about ``limit`` rows
    kept = F.array_distinct(F.filter("_all", lambda b, i: (i + 1) % every == 0))
    size = F.size("_kept")
    nested = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / FINE)), lambda i: F.slice("_kept", (i * FINE + 1).cast("int"), F.lit(FINE)))
    borders = stored_table(found.select("_key", kept.alias("_kept")).filter(size > 0).select("_key", nested.alias("_borders")), "borders")
    below = lambda rows, value: F.size(F.filter(rows, value))
    coarse = below(F.col("_borders"), lambda b: b[0] <= F.col("_at"))
    fine = below(F.get("_borders", F.col("_c") - 1), lambda b: b <= F.col("_at"))
    chunk = F.when(F.col("_borders").isNull() | (F.col("_c") == 0) | F.col("_at").isNull(), 0).otherwise((F.col("_c") - 1) * FINE + fine)
    placed = keyed.withColumn("_at", at).join(F.broadcast(borders), "_key", "left").withColumn("_c", coarse).withColumn("_chunk", chunk)
    return placed.select(*df.columns, "_key", F.col("_chunk").cast("int").alias("_chunk"))


def with_prior(df: DataFrame, keys: list[str], order: list[str], chunk: Column | None = None, last: dict[str, Column] | None = None,
               total: dict[str, Column] | None = None) -> DataFrame:
    """Add, for each row, state from the rows strictly before it in ``order`` within ``keys``.

    ``last`` columns get the latest non-NULL value of their expression, ``total`` columns the running sum.  Ranges come from the data
    (:func:`ranged`); a given ``chunk`` must not decrease along ``order``.  ``order`` must be unique per key.
    """
    last, total = last or {}, total or {}
    if chunk is None:
        chunked = ranged(df, keys, order)
    else:
        chunked = df.withColumn("_key", F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))).withColumn("_chunk", chunk)
    inside = Window.partitionBy("_key", "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    scanned = chunked
    for name, value in last.items():
        scanned = scanned.withColumn(f"_in_{name}", F.last(value, ignorenulls=True).over(inside))
    for name, value in total.items():
        scanned = scanned.withColumn(f"_in_{name}", F.coalesce(F.sum(value).over(inside), F.lit(0)))

    position = F.struct(*order)
    summary = chunked.groupBy("_key", "_chunk").agg(
        *[F.max_by(v, F.when(v.isNotNull(), position)).alias(f"_sum_{n}") for n, v in last.items()],
        *[F.sum(v).alias(f"_sum_{n}") for n, v in total.items()])
    before = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        "_key", "_chunk",
        *[F.last(f"_sum_{n}", ignorenulls=True).over(before).alias(f"_before_{n}") for n in last],
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in total])
    joined = scanned.join(carried, ["_key", "_chunk"])
    return joined.select(
        *df.columns,
        *[F.coalesce(F.col(f"_in_{n}"), F.col(f"_before_{n}")).alias(n) for n in last],
        *[(F.col(f"_in_{n}") + F.col(f"_before_{n}")).alias(n) for n in total])


def value_distribution(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key and distinct value: how many rows hold it and how many hold a smaller one.

    Rows are counted per value first.  The counts are dealt by (key, value) into ranges and written; running totals go over the ranges,
    one row per key and range, and then inside each range.  So no window holds the values of a key, however many it has.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    dealt = counts.withColumn("_key", F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))).repartitionByRange(*keys, "value")
    placed = stored_table(dealt.withColumn("_range", F.spark_partition_id()), "values")
    borders = placed.groupBy("_key", "_range").agg(F.sum("n").alias("_n"))
    if keys:
        lower = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        offsets = borders.select("_key", "_range", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_offset"), F.sum("_n").over(Window.partitionBy("_key")).alias("n_all"))
    else:        # one row per range, so no more rows than tasks
        held, offset, rows = sorted((r["_range"], r["_n"]) for r in borders.collect()), 0, []
        for at, n in held:
            rows.append((at, offset, sum(m for _, m in held)))
            offset += n
        offsets = df.sparkSession.createDataFrame(rows, "_range int, _offset long, n_all long").withColumn("_key", F.struct(F.lit(0).alias("all")))
    inside = Window.partitionBy("_key", "_range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    scanned = placed.withColumn("_below", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return scanned.join(offsets, ["_key", "_range"]).select(*keys, "value", "n", (F.col("_below") + F.col("_offset")).alias("n_below"), "n_all")


def exact_median(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Exact median per key (mean of the two middle values) from the value distribution."""
    d = value_distribution(df, keys, value)
    lo = F.floor((F.col("n_all") + 1) / 2)
    hi = F.ceil((F.col("n_all") + 1) / 2)
    holds = lambda rank: (F.col("n_below") < rank) & (rank <= F.col("n_below") + F.col("n"))
    middle = d.filter(holds(lo) | holds(hi))
    return middle.groupBy(*keys).agg(((F.min("value") + F.max("value")) / 2).alias(out))


def percent_rank_average(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Average-rank percentile of each row's value among all rows of its key (ties share their mean rank).

    The rows are written once and read for the distribution and for the join.  The distribution knows how many rows share a value, so
    a very frequent value is split over salts by that count.
    """
    rows = stored_table(df, "ranked")
    ranks = stored_table(value_distribution(rows, keys, value).select(
        *keys, F.col("value").alias(value), ((F.col("n_below") + (F.col("n") + 1) / 2) / F.col("n_all")).alias(out), F.col("n").alias("_rows")), "ranks")
    total = ranks.agg(F.sum("_rows")).first()[0] or 0
    return join_counted(rows, ranks, [*keys, value], [c for c in df.columns if c not in keys and c != value] or [value], "_rows", total)
