"""Rasters as runs: a row of pixels is (pixel_y, x_from, x_to) stretches, ends included; pixels themselves are never rows.

A shape is filled from its edges: each edge gives one crossing per row of pixels that it passes, the crossings of a row pair up to runs.
So the rows grow with the height of a shape in pixels and with its edges, not with its area, and edges go to the rows they cross
wherever they lie, so one very large shape is filled by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from freshet.operators.spatial import edges, spread, with_bounds
from freshet.session import stored_table

TILE = 64        # pixels of a row that share a join key


def _first_centre_after(x: Column, pixel: float) -> Column:
    return F.floor(x / pixel - 0.5) + 1


def _last_centre_before(x: Column, pixel: float) -> Column:
    return F.ceil(x / pixel - 0.5) - 1


def filled(areas: DataFrame, pixel: float, keep: list[str], shape_id: str | None = None) -> DataFrame:
    """(keep, pixel_y, x_from, x_to): the pixels whose centre lies inside a shape, even-odd, its boundary left out.

    ``shape_id`` tells shapes apart; without it shapes are written once under running numbers.
    """
    if shape_id is None:
        shape_id = "_shape"
        areas = stored_table(areas.select(*keep, "rings", F.monotonically_increasing_id().alias(shape_id)), "shapes")
    by = list(dict.fromkeys([shape_id, *keep]))
    e = F.col("e")
    each = spread(areas.select(*by, "rings"), by).select(*by, F.explode(edges(F.col("rings"))).alias("e")).select(
        *by, F.least(e.y1, e.y2).alias("low"), F.greatest(e.y1, e.y2).alias("high"), "e")
    rows = F.sequence(F.ceil(F.col("low") / pixel - 0.5), F.floor(F.col("high") / pixel - 0.5))        # centres level with the edge, both ends included
    level = each.filter(F.ceil(F.col("low") / pixel - 0.5) <= F.floor(F.col("high") / pixel - 0.5)).withColumn("pixel_y", F.explode(rows))
    middle = (F.col("pixel_y") + 0.5) * pixel
    crosses = (e.y1 > middle) != (e.y2 > middle)
    x = F.when(crosses, (e.x2 - e.x1) * (middle - e.y1) / (e.y2 - e.y1) + e.x1)
    # a level edge, or a corner, on the line of the centres: boundary, hence left out
    on_line = F.when((e.y1 == middle) & (e.y2 == middle), F.struct(F.least(e.x1, e.x2).alias("a"), F.greatest(e.x1, e.x2).alias("b"))).when(
        e.y1 == middle, F.struct(e.x1.alias("a"), e.x1.alias("b"))).when(e.y2 == middle, F.struct(e.x2.alias("a"), e.x2.alias("b")))
    grouped = level.groupBy(*by, "pixel_y").agg(F.sort_array(F.collect_list(x)).alias("xs"), F.collect_list(on_line).alias("lines"))
    pairs = F.transform(F.sequence(F.lit(0), F.floor(F.size("xs") / 2) - 1), lambda i: F.struct(
        _first_centre_after(F.get("xs", (2 * i).cast("int")), pixel).alias("a"), _last_centre_before(F.get("xs", (2 * i + 1).cast("int")), pixel).alias("b")))
    runs = F.filter(F.when(F.size("xs") >= 2, pairs).otherwise(F.expr("array()").cast("array<struct<a:bigint,b:bigint>>")), lambda r: r.a <= r.b)
    gaps = F.filter(F.transform("lines", lambda g: F.struct(F.ceil(g.a / pixel - 0.5).alias("a"), F.floor(g.b / pixel - 0.5).alias("b"))), lambda g: g.a <= g.b)
    cut = grouped.select(*by, "pixel_y", runs.alias("runs"), gaps.alias("gaps")).filter(F.size("runs") > 0)
    left = F.when(F.size("gaps") == 0, F.col("runs")).otherwise(_without(F.col("runs"), F.col("gaps")))
    return cut.select(*keep, "pixel_y", F.explode(left).alias("r")).select(*keep, "pixel_y", F.col("r.a").alias("x_from"), F.col("r.b").alias("x_to"))


def _without(runs: Column, gaps: Column) -> Column:
    """The runs less the gaps: stretches between all ends that lie in a run and in no gap."""
    ends = F.array_sort(F.array_distinct(F.flatten(F.transform(F.concat(runs, gaps), lambda r: F.array(r.a, r.b + 1)))))
    stretches = F.zip_with(ends, F.slice(ends, F.lit(2), F.size(ends)), lambda a, b: F.struct(a.alias("a"), (b - 1).alias("b")))
    held = lambda s, rows: F.exists(rows, lambda r: (r.a <= s.a) & (s.a <= r.b))
    return F.filter(stretches, lambda s: s.b.isNotNull() & held(s, runs) & ~held(s, gaps))


def worst(spans: DataFrame, keep: list[str], rank: str, ranks: list[int]) -> DataFrame:
    """Overlapping runs to runs that do not overlap, each with its worst rank, neighbours of one rank joined.

    A sweep over the ends of a row's runs counts the open runs of each rank.  Ends at one place are added up before the sort, so a row
    of pixels has at most as many events as pixels.
    """
    counts = [f"_n{r}" for r in ranks]
    end = lambda at, step: spans.select(*keep, "pixel_y", at.alias("x"), *[F.when(F.col(rank) == r, step).otherwise(0).alias(c) for r, c in zip(ranks, counts)])
    events = end(F.col("x_from"), 1).unionByName(end(F.col("x_to") + 1, -1)).groupBy(*keep, "pixel_y", "x").agg(*[F.sum(c).alias(c) for c in counts])
    row = Window.partitionBy(*keep, "pixel_y").orderBy("x")
    open_ = [F.sum(c).over(row.rowsBetween(Window.unboundedPreceding, 0)) for c in counts]
    ranked = events.select(*keep, "pixel_y", "x", F.coalesce(*[F.when(n > 0, r) for r, n in sorted(zip(ranks, open_), key=lambda p: -p[0])], F.lit(0)).alias("_rank"))
    changes = ranked.withColumn("_before", F.lag("_rank", 1, 0).over(row)).filter(F.col("_rank") != F.col("_before"))
    return (changes.withColumn("x_to", F.lead("x").over(row) - 1).filter(F.col("_rank") > 0)
            .select(*keep, "pixel_y", F.col("x").alias("x_from"), "x_to", F.col("_rank").alias(rank)))


def pixels(spans: DataFrame) -> DataFrame:
    """One row per pixel, for results that are asked for pixel by pixel."""
    rest = [c for c in spans.columns if c not in ("x_from", "x_to", "pixel_y")]
    return spans.select(*rest, F.explode(F.sequence("x_from", "x_to")).alias("pixel_x"), "pixel_y")


def cut_at(spans: DataFrame, width: int, out: str) -> DataFrame:
    """Runs cut at every ``width`` pixels; ``out`` numbers the stretch that a part lies in."""
    parts = spans.withColumn(out, F.explode(F.sequence(F.floor(F.col("x_from") / width), F.floor(F.col("x_to") / width))))
    return parts.withColumn("x_from", F.greatest("x_from", F.col(out) * width)).withColumn("x_to", F.least("x_to", (F.col(out) + 1) * width - 1))


def ranks_at(points: DataFrame, x: Column, y: Column, spans: DataFrame, source: str, rank: str, wanted: dict[str, str]) -> DataFrame:
    """Per point the rank of the run that holds its pixel, one column per source in ``wanted``, 0 outside.

    Runs are cut to tiles of a row; the runs of a tile (they do not overlap, so at most ``TILE`` a source) travel as one row, and each point
    meets one row.
    """
    mine = cut_at(spans.filter(F.col(source).isin(list(wanted))), TILE, "_tile")
    tiles = mine.groupBy(F.col("pixel_y").alias("_row"), "_tile").agg(F.collect_list(F.struct(F.col(source).alias("s"), "x_from", "x_to", F.col(rank).alias("r"))).alias("_runs"))
    placed = points.withColumn("_x", x).withColumn("_row", y).withColumn("_tile", F.floor(F.col("_x") / TILE)).join(tiles, ["_row", "_tile"], "left")

    def rank_of(name: str) -> Column:
        held = F.filter("_runs", lambda r: (r.s == name) & F.col("_x").between(r.x_from, r.x_to))
        return F.coalesce(F.get(held, F.lit(0)).r, F.lit(0))

    return placed.withColumns({out: rank_of(name) for name, out in wanted.items()}).select(*points.columns, *wanted.values())


def owned_cells(areas: DataFrame, area_id: str, cell: float = 100.0) -> DataFrame:
    """(id, cell_x, cell_y) of the cells whose centre an area holds; an area that holds none owns one inner cell."""
    runs = stored_table(filled(areas.select(area_id, "rings"), cell, [area_id], area_id), "runs")        # read twice below
    owned = pixels(runs).select(area_id, F.col("pixel_x").alias("cell_x"), F.col("pixel_y").alias("cell_y"))
    # no broadcast, the number of runs is not seen in the size of their file; written, or Spark works out the inner point of every area
    none = areas.select(area_id, "rings").join(runs.select(area_id).distinct().hint("merge"), area_id, "left_anti")
    small = with_bounds(stored_table(none, "small"))
    # an inner point: half way between the first two crossings of the line through the middle of the box
    mid = (F.col("min_y") + F.col("max_y")) / 2
    crossings = F.array_sort(F.transform(
        F.filter(edges(F.col("rings")), lambda e: (e.y1 > mid) != (e.y2 > mid)),
        lambda e: (e.x2 - e.x1) * (mid - e.y1) / (e.y2 - e.y1) + e.x1))
    inner = F.when(F.size(crossings) >= 2, (crossings[0] + crossings[1]) / 2).otherwise((F.col("min_x") + F.col("max_x")) / 2)
    single = small.select(area_id, F.floor(inner / cell).alias("cell_x"), F.floor(mid / cell).alias("cell_y"))
    return owned.unionByName(single)
