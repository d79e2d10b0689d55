"""Joins between instants and intervals as sweeps along time.

Instants and the ends of intervals are put in one order per key (:func:`~freshet.operators.scan.with_prior`, which cuts a hot key into ranges
taken from the data and carries the state across), so no calendar bucket bounds how many rows meet in one task and a long interval
is not repeated for every day that it lasts.  NULL keys and NULL times match nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from freshet.operators.scan import with_prior
from freshet.session import stored_table

BLOCK = 256        # positions that meet under one join key
BLOCKS = 4096        # blocks that an interval is unfolded to at a time


def _known(keys: list[str], *times: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, *times]])


def _held_pairs(instants: DataFrame, intervals: DataFrame, on: list[str], at: str, start: Column, end: Column, how: str, after_start: bool = False) -> DataFrame:
    """(_l, _r): instants with the intervals of their key from ``start`` to ``end``, both included unless ``after_start``.

    The sweep counts the instants up to each mark, which numbers the instants of a key and turns an interval into the run of numbers
    that it holds.  Runs are cut into blocks of ``BLOCK`` numbers: blocks inside a run match whole, so the rows compared are the pairs
    returned and at most two blocks more per interval.  An interval without instants ends there.
    """
    carried = [F.col(c).alias(f"_r{i}") for i, c in enumerate(intervals.columns)]
    spans = stored_table(intervals.select(*carried, *on, start.alias("_start"), end.alias("_end")).filter(_known(on, "_start", "_end"))
                         .withColumn("_id", F.monotonically_increasing_id()), "intervals")
    row = F.struct(*[F.col(c) for c in instants.columns])
    points = instants.select(*on, F.col(at).alias("_t"), F.lit(1).alias("_kind"), F.xxhash64(*instants.columns).alias("_id"), row.alias("_l"))
    marks = [spans.select(*on, F.col(t).alias("_t"), F.lit(kind).alias("_kind"), "_id") for t, kind in (("_start", 2 if after_start else 0), ("_end", 3))]
    order = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [points, *marks])
    swept = with_prior(stored_table(order, "marks"), on, ["_t", "_kind", "_id"], total={"_below": (F.col("_kind") == 1).cast("long")})
    upto = lambda closing: F.max(F.when((F.col("_kind") == 3) == closing, F.col("_below")))
    runs = swept.filter("_kind <> 1").groupBy("_id").agg(upto(False).alias("_low"), upto(True).alias("_high")).filter("_high > _low").join(spans, "_id")
    wide = BLOCK * BLOCKS
    coarse = runs.withColumn("_part", F.explode(F.sequence(F.floor(F.col("_low") / wide), F.floor((F.col("_high") - 1) / wide))))
    first = F.greatest(F.floor(F.col("_low") / BLOCK), F.col("_part") * BLOCKS)
    last = F.least(F.floor((F.col("_high") - 1) / BLOCK), F.col("_part") * BLOCKS + BLOCKS - 1)
    right = coarse.select(*on, *[f"_r{i}" for i in range(len(carried))], "_low", "_high", F.explode(F.sequence(first, last)).alias("_block")).alias("r")
    left = swept.filter("_kind = 1").select(*on, "_l", "_below", F.floor(F.col("_below") / BLOCK).alias("_block")).alias("l")
    condition = (F.col("l._below") >= F.col("r._low")) & (F.col("l._below") < F.col("r._high"))
    for key in [*on, "_block"]:
        condition = condition & (F.col(f"l.{key}") == F.col(f"r.{key}"))
    return left.join(right, condition, how).select("_l", F.struct(*[F.col(f"_r{i}").alias(c) for i, c in enumerate(intervals.columns)]).alias("_r"))


def instants_in_intervals(instants: DataFrame, intervals: DataFrame, on: list[str], at: str, start: str, end: str, how: str = "inner") -> DataFrame:
    """Pairs where ``start <= at <= end``; ``left`` keeps instants in no interval."""
    pairs = _held_pairs(instants, intervals, on, at, F.col(start), F.col(end), how)
    return pairs.select("_l.*", *[F.col("_r").getField(c).alias(c) for c in intervals.columns if c not in instants.columns])


def next_within(instants: DataFrame, events: DataFrame, on: list[str], at: str, when: str, hours: int) -> DataFrame:
    """Pairs with ``at < when <= at + hours``."""
    until = F.col(at) + F.expr(f"INTERVAL {hours} HOURS")
    pairs = _held_pairs(events, instants, on, when, F.col(at), until, "inner", after_start=True)
    return pairs.select("_r.*", *[F.col("_l").getField(c).alias(c) for c in events.columns if c not in instants.columns])


def _with_latest(asking: DataFrame, events: DataFrame, on: list[str], at: str, when: str) -> DataFrame:
    """(_row, _latest): each asking row with the time of the latest event of its key at ``at`` or before, one pass and no pairs."""
    rows = asking.select(*on, F.col(at).alias("_t"), F.lit(1).alias("_kind"), F.xxhash64(*asking.columns).alias("_id"),
                         F.struct(*[F.col(c) for c in asking.columns]).alias("_row"))
    told = events.select(*on, F.col(when).alias("_t")).filter(_known(on, "_t")).distinct().withColumns({"_kind": F.lit(0), "_id": F.lit(0).cast("long")})
    order = stored_table(rows.unionByName(told, allowMissingColumns=True), "marks")
    swept = with_prior(order, on, ["_t", "_kind", "_id"], last={"_latest": F.when(F.col("_kind") == 0, F.col("_t"))})
    return swept.filter("_kind = 1").select("_row", "_latest")


def intervals_with_instants(intervals: DataFrame, instants: DataFrame, on: list[str], at: str, start: str, end: str, row_id: str) -> DataFrame:
    """Ids of the intervals that hold at least one instant (EXISTS): those whose latest instant up to the end is not before the start."""
    asking = intervals.select(row_id, start, end, *[c for c in on if c not in (row_id, start, end)])
    found = _with_latest(asking, instants, on, end, at)
    return found.filter(F.col("_latest") >= F.col("_row").getField(start)).select(F.col("_row").getField(row_id).alias(row_id)).distinct()


def last_before(instants: DataFrame, events: DataFrame, on: list[str], at: str, when: str, hours: int, out: str) -> DataFrame:
    """The latest event in ``[at - hours, at]`` per instant, NULL when there is none."""
    found = _with_latest(instants, events, on, at, when)
    recent = F.col("_latest") >= F.col("_row").getField(at) - F.expr(f"INTERVAL {hours} HOURS")
    return found.select("_row.*", F.when(recent, F.col("_latest")).alias(out))
