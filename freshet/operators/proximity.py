"""Near-duplicate places: drop candidates near a kept site, merge chains of sites.

Cells have a diagonal of one radius, so two sites in one cell are always within it: a crowded cell is settled by its key alone
and never compared pair by pair.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from freshet.operators.pick import first_per_key
from freshet.operators.skew import join_counted
from freshet.session import cut_lineage


def _fine_cells(df: DataFrame, radius: Column | float) -> DataFrame:
    side = radius / math.sqrt(2)
    return (df.withColumn("cell_x", F.floor(F.col("easting") / side).cast("long"))
            .withColumn("cell_y", F.floor(F.col("northing") / side).cast("long")))


def _around(df: DataFrame) -> DataFrame:
    """The 5 x 5 block around a cell without its corners: every cell that can hold a site within one radius."""
    steps = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if abs(i) + abs(j) < 4]
    shift = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps]))
    moved = df.withColumn("_step", shift)
    return (moved.withColumn("cell_x", F.col("cell_x") + F.col("_step.i"))
            .withColumn("cell_y", F.col("cell_y") + F.col("_step.j")).drop("_step"))


def drop_near_kept(candidates: DataFrame, kept: DataFrame, group: str, source: str, radius: float,
                   radius_by_source: dict[str, float] | None = None) -> DataFrame:
    """Candidates with no kept site of their group within the radius of that kept site's source.

    One pass per distinct radius.  Candidates sharing a fine cell with a kept site go by key alone; the rest are compared with
    the distinct positions kept around them by a semi-join, which stops at the first hit.
    """
    own = radius_by_source or {}
    left = candidates
    for r in sorted({radius, *own.values()}):
        named = [s for s, v in own.items() if v == r]
        mine = F.col(source).isin(named) if named else F.lit(False)
        if r == radius:
            mine = mine | ~F.col(source).isin(list(own)) | F.col(source).isNull()
        spots = _fine_cells(kept.filter(mine).select(group, "easting", "northing").distinct(), r)
        placed = _fine_cells(left, r).join(spots.select(group, "cell_x", "cell_y").distinct(), [group, "cell_x", "cell_y"], "left_anti")
        wide = _around(spots.select(group, F.col("easting").alias("_ke"), F.col("northing").alias("_kn"), "cell_x", "cell_y"))
        gap2 = F.pow(F.col("c.easting") - F.col("k._ke"), 2) + F.pow(F.col("c.northing") - F.col("k._kn"), 2)
        condition = ((F.col(f"c.{group}") == F.col(f"k.{group}")) & (F.col("c.cell_x") == F.col("k.cell_x"))
                     & (F.col("c.cell_y") == F.col("k.cell_y")) & (gap2 <= r * r))
        left = placed.alias("c").join(wide.alias("k"), condition, "left_anti").select(*candidates.columns)
    return left


def _links(sites: DataFrame, site_id: str, radius: float) -> DataFrame:
    """Edges that connect every chain: each site to its position's lowest id, each position to its cell's lowest id, and
    positions of neighbouring cells that are within the radius."""
    placed = _fine_cells(sites.select(F.col(site_id).alias("id"), "easting", "northing"), radius)
    spots = placed.groupBy("cell_x", "cell_y", "easting", "northing").agg(F.min("id").alias("spot"))
    to_spot = placed.join(spots, ["cell_x", "cell_y", "easting", "northing"]).select(F.col("id").alias("a"), F.col("spot").alias("b"))
    cells = spots.groupBy("cell_x", "cell_y").agg(F.min("spot").alias("cell_spot"))
    to_cell = spots.join(cells, ["cell_x", "cell_y"]).select(F.col("spot").alias("a"), F.col("cell_spot").alias("b"))
    # each cell is one component already, so one close pair per pair of neighbouring cells is enough: a position asks each
    # cell around it whether any position there is near, and the semi-join stops at the first that is
    asking = _around(spots.join(cells, ["cell_x", "cell_y"])).alias("p")
    held = spots.join(cells, ["cell_x", "cell_y"]).select(
        "cell_x", "cell_y", F.col("easting").alias("_e"), F.col("northing").alias("_n")).alias("q")
    gap2 = F.pow(F.col("p.easting") - F.col("q._e"), 2) + F.pow(F.col("p.northing") - F.col("q._n"), 2)
    near = ((F.col("p.cell_x") == F.col("q.cell_x")) & (F.col("p.cell_y") == F.col("q.cell_y")) & (gap2 <= radius * radius))
    answered = asking.join(held, near, "left_semi").select(F.col("p.cell_spot").alias("a"), "p.cell_x", "p.cell_y").distinct()
    across = answered.join(cells, ["cell_x", "cell_y"]).select("a", F.col("cell_spot").alias("b"))
    return to_spot.unionByName(to_cell).unionByName(across).filter("a <> b")


LINKS_PER_TASK = 100_000
LEAST_TASKS = 8


def _tasks(links: int) -> int:
    """Tasks for so many links: late rounds have few, and a file per task and shuffle partition costs more than they do."""
    return max(LEAST_TASKS, math.ceil(links / LINKS_PER_TASK))


def connected(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, root) of every linked node, by alternating large-star and small-star rounds until the links stop changing.

    Each round is a ``min`` per node and an equi-join; a node with very many links is split over salts by the number of its links.
    Lineage is cut in the shared folder after every round; the tasks of a round follow the number of links, without a shuffle of their own.
    """
    current = cut_lineage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    def large_star(e: DataFrame, rows: int) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("_links"))
        return join_counted(both, least, ["u"], ["v"], "_links", 2 * rows, "inner").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()

    def small_star(e: DataFrame, rows: int) -> DataFrame:
        least = e.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_links"))
        moved = join_counted(e, least, ["u"], ["v"], "_links", rows, "inner").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = state(current)
    for _ in range(rounds):
        n = _tasks(before[0])
        spread = large_star(current.coalesce(n), before[0]).coalesce(n)
        current = cut_lineage(small_star(spread, 2 * before[0]).coalesce(n))
        after = state(current)
        if after == before:
            return (current.select(F.col("u").alias("id"), F.col("v").alias("root"))
                    .unionByName(current.select(F.col("v").alias("id"), F.col("v").alias("root"))).distinct())
        before = after
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def clusters(sites: DataFrame, site_id: str, radius: float) -> DataFrame:
    """Each site with the lowest id of its chain of sites within ``radius`` of one another."""
    roots = connected(_links(sites, site_id, radius))
    labelled = sites.join(roots.withColumnRenamed("id", site_id), site_id, "left")
    return labelled.withColumn("cluster", F.coalesce("root", F.col(site_id))).drop("root")


def merge_clusters(sites: DataFrame, site_id: str, radius: float) -> DataFrame:
    """One site per chain: the shortest name, then the name, then the id."""
    order = [F.length("name"), F.col("name"), F.col(site_id)]
    return first_per_key(clusters(sites, site_id, radius), ["cluster"], order).select(*sites.columns)
