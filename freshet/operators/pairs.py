"""Pairs of the members of sets: all of them, unfolded block by block, or those that share places, each summed in one group."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from freshet.operators.skew import salted
from freshet.session import stored_table

BLOCK = 128        # members of a block
LISTED = 256        # places of a member that travel as a list
MEMBERS = 3072        # members of either side of a group
PLACES = 1024        # places of a group taken at a time
SUMS = 1 << 23        # sums of pairs held at a time


def pairs_within(sets: DataFrame, members: str, a: str, b: str) -> DataFrame:
    """One row per pair ``a`` < ``b`` of the array ``members`` (ascending, distinct), beside the other columns of ``sets``.

    A set of n members is cut to blocks; a row carries the blocks from one of its blocks on, so a set is copied n / ``BLOCK`` times and
    not n times, and these rows are dealt to all tasks before the pairs are made.  Inside a task a pair of blocks is unfolded at a time.
    """
    others = [c for c in sets.columns if c != members]
    count = F.ceil(F.size(members) / BLOCK)
    cut = F.transform(F.sequence(F.lit(0), count.cast("int") - 1), lambda i: F.slice(members, i * BLOCK + 1, F.lit(BLOCK)))
    blocks = sets.filter(F.size(members) > 1).select(*others, cut.alias("_blocks"), F.xxhash64(*others, members).alias("_set"))
    first = blocks.select(*others, "_set", "_blocks", F.posexplode("_blocks").alias("_i", "_left"))
    later = first.select(*others, "_set", "_i", "_left", F.slice("_blocks", F.col("_i") + 1, F.size("_blocks")).alias("_later")).repartition("_set", "_i")
    met = later.select(*others, "_left", F.explode("_later").alias("_right"))
    each = met.select(*others, F.explode("_left").alias(a), "_right")
    return each.select(*others, a, F.explode(F.filter("_right", lambda x: x > F.col(a))).alias(b))


def pairs_sharing(members: DataFrame, values: DataFrame, place: str, measures: list[str]) -> DataFrame:
    """One row per pair ``id_a`` < ``id_b`` of ``members`` (``id``, ``place``) that share a place: ``shared``, the number of shared places, the
    sums of their ``measures`` and the number of places of each, ``size_a`` and ``size_b``.  A place with n rows of ``values`` counts n times.

    A member takes the list of its places to each of them.  Of the places of a pair the first one sums the pair, from the two lists, so pairs are
    not shuffled.  The members of a crowded place are cut to shares, and shares meet in pairs.  A member of more than ``LISTED`` places
    would be copied too often: its pairs are rows per shared place, added up.
    """
    own = members.select("id", place).filter("id IS NOT NULL").repartition(F.col("id")).distinct()
    sized = own.withColumn("_size", F.count(F.lit(1)).over(Window.partitionBy("id")))
    summed = values.groupBy(place).agg(F.count(F.lit(1)).alias("_w"), *[F.sum(m).alias(m) for m in measures])
    weights = [F.coalesce(F.col(c).cast("double"), F.lit(d)).alias(c) for c, d in (("_w", 1.0), *((m, 0.0) for m in measures))]
    every = stored_table(sized.join(summed, place, "left").select("id", place, "_size", *weights), "members")
    kind = every.schema
    out = T.StructType([*[T.StructField(f"id_{s}", kind["id"].dataType) for s in "ab"], T.StructField("shared", T.LongType()),
                        *[T.StructField(m, T.DoubleType()) for m in measures], *[T.StructField(f"size_{s}", T.LongType()) for s in "ab"]])
    listed, large = every.filter(F.col("_size") <= LISTED), every.filter(F.col("_size") > LISTED)
    crowded = listed.groupBy(place).agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("_cuts")).filter("_cuts > 1")
    lists = listed.groupBy("id", "_size").agg(F.collect_list(F.struct(place, "_w", *measures)).alias("_list"))
    parts = [F.col(f"_list.{c}").alias(n) for n, c in [("_places", place), ("_v0", "_w"), *((f"_v{i + 1}", m) for i, m in enumerate(measures))]]
    names = [f"_v{i}" for i in range(len(measures) + 1)]
    at = lists.select("id", "_size", *parts).select("*", F.posexplode("_places").alias("_at", "_place"))
    cut = at.join(F.broadcast(crowded.withColumnRenamed(place, "_place")), "_place", "left").withColumn("_cuts", F.coalesce("_cuts", F.lit(1)))
    mine = cut.withColumn("_part", F.pmod(F.xxhash64("id"), "_cuts").cast("int"))
    # share i * _cuts + j, i <= j: parts i and j
    shares = F.filter(F.sequence(F.lit(0), F.col("_cuts") * F.col("_cuts") - 1), lambda s: (
        (F.floor(s / F.col("_cuts")) == F.col("_part")) & (s % F.col("_cuts") >= F.col("_part"))) | (
        (s % F.col("_cuts") == F.col("_part")) & (F.floor(s / F.col("_cuts")) < F.col("_part"))))
    dealt = mine.withColumn("_share", F.explode(shares))
    tasks = int(every.sparkSession.conf.get("spark.sql.shuffle.partitions"))        # little data may be much work, so tasks are not merged by bytes

    def each(t: pa.Table) -> pa.Table:
        return pa.concat_tables([pa.table({f.name: pa.array([], type=_arrow(f.dataType)) for f in out}), *_pairs_of_place(t, names, measures)])

    found = dealt.repartition(tasks, "_place", "_share").groupBy("_place", "_share").applyInArrow(each, out)
    return found if large.isEmpty() else found.unionByName(_pairs_by_place(large, every, place, measures).select(*out.names))


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _pairs_of_place(t: pa.Table, names: list[str], measures: list[str]):
    """The pairs of one place's members that share no place before it, summed over this and the later places."""
    t = t.combine_chunks()
    ids = t.column("id")
    rank = np.asarray(pc.rank(ids.combine_chunks(), tiebreaker="dense")).astype(np.int64)
    t = t.take(pa.array(np.argsort(rank, kind="stable"))).combine_chunks()
    ids, part = t.column("id"), t.column("_part").to_numpy()
    share, cuts = t.column("_share").to_numpy()[0], t.column("_cuts").to_numpy()[0]
    sides = [np.flatnonzero(part == share // cuts), np.flatnonzero(part == share % cuts)]
    one_side = share // cuts == share % cuts
    if not len(sides[0]) or not len(sides[1]) or t.num_rows < 2:
        return
    lists = t.column("_places").combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    count = np.asarray(pc.list_value_length(lists)).astype(np.int64)
    number = np.asarray(pc.rank(lists.flatten(), null_placement="at_start", tiebreaker="dense")).astype(np.int64) - 1        # ascends with the place in every group
    here = number[t.column("_at").to_numpy()[0]]        # of the first row, whose list comes first
    row = np.repeat(np.arange(t.num_rows), count)
    weight = np.zeros((len(names), number.max() + 1))
    for k, name in enumerate(names):
        weight[k, number] = np.asarray(pc.list_flatten(t.column(name).combine_chunks()))
    common = np.bincount(number) > 1        # what one member has alone is in no pair
    used = np.cumsum(common) - 1
    here, keep = used[here], common[number]
    order = np.argsort(used[number[keep]], kind="stable")
    row, place, weight = row[keep][order], used[number[keep]][order], weight[:, common]
    fine, places = np.isfinite(weight), weight.shape[1]
    borders = [*range(0, here, PLACES), *range(here, places, PLACES), places]
    size = t.column("_size").to_numpy()
    step = max(1, SUMS // (len(names) * len(sides[1])))
    for low in range(0, len(sides[0]), step):
        left, base = sides[0][low:low + step], low if one_side else 0
        right = sides[1][base:]
        before, sums = np.zeros((len(left), len(right)), dtype=np.float32), np.zeros((len(names) * len(left), len(right)))
        for first, last in zip(borders, borders[1:]):
            a, b = np.searchsorted(place, [first, last])
            held = np.zeros((t.num_rows, last - first), dtype=np.float32 if last <= here else np.float64)
            held[row[a:b], place[a:b] - first] = 1
            x, y = held[left], held[right]
            if last <= here:
                before += x @ y.T
                continue
            v = np.where(fine[:, first:last], weight[:, first:last], 0.0)
            sums += np.concatenate([x * w for w in v]) @ y.T
            for k, c in zip(*np.nonzero(~fine[:, first:last])):
                sums[k * len(left):(k + 1) * len(left)] += np.where(np.outer(x[:, c], y[:, c]) > 0, weight[k, first + c], 0.0)
        i, j = np.nonzero(before == 0)
        if one_side:
            later = i < j
            i, j = i[later], j[later]
        low_row, high_row = np.minimum(left[i], right[j]), np.maximum(left[i], right[j])
        total = sums.reshape(len(names), len(left), len(right))[:, i, j]
        yield pa.table({"id_a": ids.take(pa.array(low_row)), "id_b": ids.take(pa.array(high_row)), "shared": np.rint(total[0]).astype(np.int64),
                        **{m: total[k + 1] for k, m in enumerate(measures)}, "size_a": size[low_row], "size_b": size[high_row]})


def _pairs_by_place(large: DataFrame, every: DataFrame, place: str, measures: list[str]) -> DataFrame:
    """The pairs with a member of many places: a row per shared place, added up."""
    key = F.coalesce(F.col(place), F.lit(0).cast(every.schema[place].dataType))
    side = lambda df, s: df.select(key.alias("_key"), F.col(place).isNull().alias("_none"), F.col("id").alias(f"_id_{s}"), F.col("_size").alias(f"_size_{s}"), "_w", *measures)
    one, two, on = salted(side(large, 0).drop("_w", *measures), side(every, 1), ["_key", "_none"], ["_id_0"])
    met = one.join(two.hint("merge"), on).filter((F.col("_id_0") != F.col("_id_1")) & ((F.col("_size_1") <= LISTED) | (F.col("_id_0") < F.col("_id_1"))))
    first = F.col("_id_0") < F.col("_id_1")
    sides = [F.when(first == (s == "a"), F.col(f"_{c}_0")).otherwise(F.col(f"_{c}_1")).alias(f"{c}_{s}") for c in ("id", "size") for s in "ab"]
    return met.select(*sides, "_w", *measures).groupBy("id_a", "id_b", "size_a", "size_b").agg(
        F.sum("_w").cast("long").alias("shared"), *[F.sum(m).alias(m) for m in measures])
