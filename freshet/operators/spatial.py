"""Spatial joins without a geometry library.

Areas carry ``rings`` (ARRAY<ARRAY<STRUCT<x,y>>>).  A join goes through grid cells: every area is exploded to the cells it
covers, points and areas meet on the cell, and the exact test runs only in the cells an edge crosses, against the few edges
that can matter there.  The cell is an equality key, so the shuffle spreads by place; a cell that holds a large share of all
points is salted.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from freshet.operators.kernels import box_overlap, cell_overlap, path_near, points_inside, segment_near
from freshet.operators.skew import salted
from freshet.session import stored_table


def edges(rings: Column) -> Column:
    """All edges of all rings as ARRAY<STRUCT<x1,y1,x2,y2>>."""
    def of_ring(ring: Column) -> Column:
        n = F.size(ring) - 1
        return F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), lambda a, b: F.struct(
            a.x.alias("x1"), a.y.alias("y1"), b.x.alias("x2"), b.y.alias("y2")))

    return F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) > 1), of_ring))


def _flat(edge_list: Column) -> Column:
    """Edges as one array of numbers: x1, y1, x2, y2, x1, ..."""
    return F.flatten(F.transform(edge_list, lambda e: F.array(e.x1, e.y1, e.x2, e.y2)))


def contains(edge_list: Column, x: Column, y: Column, on_edge: bool = True) -> Column:
    """Even-odd test over the edges (holes and several parts included); a point on an edge counts as ``on_edge`` says."""
    def crosses(e: Column) -> Column:
        spans = (e.y1 > y) != (e.y2 > y)
        return spans & (x < (e.x2 - e.x1) * (y - e.y1) / (e.y2 - e.y1) + e.x1)

    def touches(e: Column) -> Column:
        straight = (e.x2 - e.x1) * (y - e.y1) == (e.y2 - e.y1) * (x - e.x1)
        return (straight & x.between(F.least(e.x1, e.x2), F.greatest(e.x1, e.x2))
                & y.between(F.least(e.y1, e.y2), F.greatest(e.y1, e.y2)))

    odd = F.size(F.filter(edge_list, crosses)) % 2 == 1
    touching = F.exists(edge_list, touches)
    return (touching | odd) if on_edge else (~touching & odd)


def spread(df: DataFrame, by: list[str]) -> DataFrame:
    """``df`` dealt to all tasks: a few bytes of outlines may be much work, so neither files nor sizes set the number of tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(*by))


def with_bounds(areas: DataFrame, rings: str = "rings") -> DataFrame:
    points = F.flatten(F.col(rings))
    xs, ys = F.transform(points, lambda p: p.x), F.transform(points, lambda p: p.y)
    return (areas.withColumn("min_x", F.array_min(xs)).withColumn("max_x", F.array_max(xs))
            .withColumn("min_y", F.array_min(ys)).withColumn("max_y", F.array_max(ys)))


def _cells(df: DataFrame, cell: float, x0: str, x1: str, y0: str, y1: str) -> DataFrame:
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))
    return df.withColumn("cell_x", F.explode(span(x0, x1))).withColumn("cell_y", F.explode(span(y0, y1)))


def cover(areas: DataFrame, cell: float, keep: list[str], deal: bool = False) -> DataFrame:
    """One row per area and grid cell it meets.

    ``local`` holds the edges that decide membership inside the cell: those level with it and not wholly to its left.  It is
    NULL where the whole cell lies inside, so most candidates need no test and carry no geometry.
    """
    shaped = with_bounds(areas.select(*keep, "rings")).withColumn("_edges", edges(F.col("rings"))).drop("rings")
    rows = (shaped.withColumn("cell_y", F.explode(F.sequence(F.floor(F.col("min_y") / cell), F.floor(F.col("max_y") / cell))))
            .withColumn("_south", F.col("cell_y") * cell))
    # edges level with the row of cells are kept once per row, before the row is cut into cells
    level = lambda e: (F.greatest(e.y1, e.y2) >= F.col("_south")) & (F.least(e.y1, e.y2) <= F.col("_south") + cell)
    rows = rows.withColumn("_edges", F.filter("_edges", level))
    if deal:        # the cells of one very large area come from many tasks
        rows = spread(rows, [*keep, "cell_y"])
    cut = (rows.withColumn("cell_x", F.explode(F.sequence(F.floor(F.col("min_x") / cell), F.floor(F.col("max_x") / cell))))
           .withColumn("_west", F.col("cell_x") * cell))
    right_of = lambda e: F.greatest(e.x1, e.x2) >= F.col("_west")
    near = lambda e: right_of(e) & (F.least(e.x1, e.x2) <= F.col("_west") + cell)
    centre = contains(F.filter("_edges", right_of), F.col("_west") + cell / 2, F.col("_south") + cell / 2)
    marked = cut.withColumn("_crossed", F.exists("_edges", near)).withColumn("_inside", centre)
    return (marked.filter(F.col("_crossed") | F.col("_inside"))
            .select(*keep, "cell_x", "cell_y", F.when(F.col("_crossed"), F.filter("_edges", right_of)).alias("local")))


BLOCK = 1 << 18        # point and piece combinations tested at a time
PAIRS = 1 << 17        # pairs that leave a task at a time


def points_in_areas(points: DataFrame, areas: DataFrame, cell: float, keep_areas: list[str], x: str = "easting",
                    y: str = "northing", hot_cells: bool = True, keep_points: list[str] | None = None) -> DataFrame:
    """Every (point, area) pair with the point inside or on the boundary; a point may be in many areas.

    Areas are cut to cells and written once.  The points of a cell meet its pieces of areas as one block each, so the join has a row per cell and
    not per combination; blocks are tested as matrices and only the pairs become rows.  A cell crowded on either side is salted.
    ``keep_points`` names the columns of the points that are wanted, all by default.
    """
    wanted, on = keep_points or points.columns, ["cell_x", "cell_y"]
    local = F.transform(_flat(F.col("local")), lambda v: v.cast("double"))
    pieces = stored_table(cover(areas, cell, keep_areas, deal=True).select(*on, F.struct(*keep_areas).alias("_area"), local.alias("_local")), "pieces")
    at = F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    placed = points.select(F.floor(F.col(x) / cell).alias("cell_x"), F.floor(F.col(y) / cell).alias("cell_y"), at.alias("_at"),
                           F.col(points.columns[0]).alias("_first"), F.struct(*wanted).alias("_point")).dropna(subset=on)
    if hot_cells:
        pieces, placed, _ = salted(pieces, placed, on, ["_area"])
        pieces, placed = (df.withColumnRenamed("_salt", "_share") for df in (pieces, placed))
        placed, pieces, on = salted(placed, pieces, [*on, "_share"], ["_at", "_first"])
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))        # bytes say little about the work, so tasks are not merged by them
    block = lambda df, name, *columns: df.select(*on, F.struct(*columns).alias(name)).repartition(tasks, *on).groupBy(*on).agg(F.collect_list(name).alias(name))
    # neither side may be broadcast: its rows are estimated from the file, not from the cells that areas unfold to
    met = block(placed, "_points", "_at", "_point").join(block(pieces, "_pieces", "_area", "_local").hint("merge"), on)
    schema = T.StructType([*[points.schema[c] for c in wanted], *[areas.schema[c] for c in keep_areas]])
    return met.select("_points", "_pieces").mapInArrow(lambda batches: _pairs_of_blocks(batches, len(wanted), schema.names), schema)


def _pairs_of_blocks(batches: Iterator[pa.RecordBatch], n: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The pairs of each row's points and pieces; a piece without edges holds its whole cell."""
    for batch in batches:
        sizes = [np.asarray(pc.list_value_length(batch.column(i))).astype(np.int64) for i in (0, 1)]
        spots, pieces = (pc.list_flatten(batch.column(i)) for i in (0, 1))
        at, local = spots.field("_at"), pieces.field("_local")
        x, y = (np.asarray(at.field(c)) for c in ("x", "y"))
        count = np.where(np.asarray(local.is_null()), -1, np.asarray(pc.list_value_length(local).fill_null(0)).astype(np.int64) // 4)
        edges = np.asarray(pc.list_flatten(local)).astype(np.float64).reshape(-1, 4)
        first = np.cumsum(np.maximum(count, 0)) - np.maximum(count, 0)
        point, area = spots.field("_point"), pieces.field("_area")
        columns = [point.field(i) for i in range(n)], [area.field(i) for i in range(len(names) - n)]

        def taken(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            rows = [pa.array(np.concatenate(r)) for r in zip(*found)]
            return pa.RecordBatch.from_arrays([c.take(r) for side, r in zip(columns, rows) for c in side], names)

        found, held = [], 0
        for p, q, a, b in zip(*(np.cumsum(s) - e for s in sizes for e in (s, 0))):
            by = np.argsort(count[a:b], kind="stable") + a
            for run in np.split(by, np.flatnonzero(np.diff(count[by])) + 1):
                for start in range(0, len(run), step := max(1, BLOCK // (q - p))):
                    rows = run[start:start + step]
                    if (k := count[rows[0]]) < 0:
                        i, j = np.repeat(rows, q - p), np.tile(np.arange(p, q), len(rows))
                    else:
                        r, j = np.nonzero(points_inside(edges[first[rows, None] + np.arange(k)], x[p:q], y[p:q]))
                        i, j = rows[r], j + p
                    found.append((j, i))
                    held += len(i)
                    if held >= PAIRS:
                        yield taken(found)
                        found, held = [], 0
        if held:
            yield taken(found)


def candidate_pairs(left: DataFrame, right: DataFrame, cell: float, left_keep: list[str], right_keep: list[str],
                    same: list[tuple[str, str]] | None = None) -> DataFrame:
    """Pairs whose boxes meet, each produced in exactly one cell: the one holding the lower corner of the common box.

    No distinct is needed.  ``same`` adds equality conditions.  Sides carry min_x, max_x, min_y, max_y.  A crowded cell is salted, and
    neither side is broadcast: its rows are estimated from the file, not from the cells that shapes unfold to.
    """
    box = ["min_x", "max_x", "min_y", "max_y"]
    a = _cells(left.select(*left_keep, *[F.col(c).alias(f"a_{c}") for c in box]), cell, "a_min_x", "a_max_x", "a_min_y", "a_max_y")
    b = _cells(right.select(*right_keep, *[F.col(c).alias(f"b_{c}") for c in box]), cell, "b_min_x", "b_max_x", "b_min_y", "b_max_y")
    a, b, on = salted(a, b, ["cell_x", "cell_y"], [*left_keep[:1], "a_min_x", "a_min_y"])
    condition = reduce(and_, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on])
    for l, r in same or []:
        condition = condition & (F.col(f"a.{l}") == F.col(f"b.{r}"))
    corner_x = F.greatest(F.col("a_min_x"), F.col("b_min_x"))
    corner_y = F.greatest(F.col("a_min_y"), F.col("b_min_y"))
    owner = ((F.col("a.cell_x") == F.floor(corner_x / cell)) & (F.col("a.cell_y") == F.floor(corner_y / cell))
             & (corner_x <= F.least(F.col("a_max_x"), F.col("b_max_x"))) & (corner_y <= F.least(F.col("a_max_y"), F.col("b_max_y"))))
    joined = a.alias("a").join(b.alias("b").hint("merge"), condition & owner)
    return joined.select(*[F.col(f"a.{c}") for c in left_keep], *[F.col(f"b.{c}") for c in right_keep])


SIMPLE = 32        # edges of a shape that travels whole
SHORT = 4        # cells along the box of a line that travels whole


def overlaps(base: DataFrame, other: DataFrame, base_id: list[str], other_id: list[str], cell: float, min_area: float = 1.0,
             same: list[tuple[str, str]] | None = None) -> DataFrame:
    """Polygon pairs that really overlap, with the area and the share of the base polygon.

    Two shapes with few edges, and an id of their own, meet whole in the one cell that owns the pair and are measured there, so pairs are
    not shuffled.  All other pairs are sums over cells (:func:`_summed_by_cell`), where nothing grows with the vertices of a whole shape.
    Touching and sliver pairs (under ``min_area``) are dropped.
    """
    same = same or []
    a_keep = [*base_id, *[l for l, _ in same if l not in base_id]]
    b_keep = [*other_id, *[r for _, r in same if r not in other_id]]

    def shaped(areas: DataFrame, keep: list[str], side: str) -> DataFrame:
        once = F.count(F.lit(1)).over(Window.partitionBy(*keep)) == 1
        whole = areas.select(*keep, "rings").withColumn("_once", once)
        flat = F.transform(_flat(edges(F.col("rings"))), lambda v: v.cast("double"))
        simple = F.coalesce(F.size(F.flatten("rings")) <= SIMPLE, F.lit(True)) & F.col("_once")
        return stored_table(with_bounds(whole.select(*keep, "rings", simple.alias("simple"), flat.alias("flat"))), f"shapes-{side}")

    a, b = shaped(base, a_keep, "a"), shaped(other, b_keep, "b")
    box = ["min_x", "max_x", "min_y", "max_y"]
    # a shape alone in its own box gives its size; a base without id has none, so no pair
    sized = spread(a.filter("simple").dropna(subset=a_keep), base_id).withColumn(
        "base_m2", box_overlap("flat", F.lit(None).cast("array<double>"), "min_x", "min_y", "max_x", "max_y")).filter("base_m2 > 0")
    left = sized.select(*[F.col(c).alias(f"a_{c}") for c in a_keep], "base_m2", F.struct("flat", *box).alias("a_shape"), *box)
    right = b.filter("simple").select(*[F.col(c).alias(f"b_{c}") for c in b_keep], F.struct("flat", *box).alias("b_shape"), *box)
    a_ids, b_ids = [f"a_{c}" for c in a_keep], [f"b_{c}" for c in b_keep]
    met = candidate_pairs(left, right, cell, [*a_ids, "base_m2", "a_shape"], [*b_ids, "b_shape"], [(f"a_{l}", f"b_{r}") for l, r in same])
    x, y, z = F.col("a_shape"), F.col("b_shape"), {}
    z["west"], z["south"] = F.greatest(x.min_x, y.min_x), F.greatest(x.min_y, y.min_y)
    z["east"], z["north"] = F.least(x.max_x, y.max_x), F.least(x.max_y, y.max_y)
    common = (met.withColumns(z).filter("west < east AND south < north")
              .withColumn("overlap_m2", box_overlap("a_shape.flat", "b_shape.flat", "west", "south", "east", "north")))
    found = common.filter(F.col("overlap_m2") >= min_area).select(*a_ids, *b_ids, "overlap_m2", "base_m2")
    rest_a, rest_b = (not s.filter("NOT simple").isEmpty() for s in (a, b))
    if rest_a or rest_b:
        found = found.unionByName(_summed_by_cell(a if rest_b else a.filter("NOT simple"), b if rest_a else b.filter("NOT simple"), a_keep, b_keep, cell, min_area, same))
    return found.select(*[F.col(f"a_{c}").alias(c) for c in a_keep], *[F.col(f"b_{c}").alias(c) for c in b_keep if c not in a_keep],
                        "overlap_m2", (F.col("overlap_m2") / F.col("base_m2")).alias("share"))


def _summed_by_cell(base: DataFrame, other: DataFrame, a_keep: list[str], b_keep: list[str], cell: float, min_area: float,
                    same: list[tuple[str, str]]) -> DataFrame:
    """The pairs of which one shape is not ``simple``.

    Both sides are cut to grid cells and written once; shapes meet on the cell, and each cell's common part comes from the few edges
    there.  A base shape also meets nothing in each of its cells, which gives its own size, so one pass of the kernel measures
    pairs and sizes alike.  A crowded cell is salted.
    """
    def cut(areas: DataFrame, keep: list[str], side: str) -> DataFrame:
        cells = cover(areas, cell, [*keep, "simple"], deal=True).select(
            *[F.col(c).alias(f"{side}_{c}") for c in [*keep, "simple"]], "cell_x", "cell_y", _flat(F.col("local")).alias(f"{side}_local"))
        return stored_table(cells, f"cells-{side}")

    a, b = cut(base, a_keep, "a"), cut(other, b_keep, "b")
    left, right, on = salted(a, b, ["cell_x", "cell_y"], [f"a_{a_keep[0]}"])
    met = left.join(right.hint("merge"), on).filter(~(F.col("a_simple") & F.col("b_simple")))
    for l, r in same:
        met = met.filter(F.col(f"a_{l}") == F.col(f"b_{r}"))
    a_ids, b_ids = [f"a_{c}" for c in a_keep], [f"b_{c}" for c in b_keep]
    needed = [*a_ids, *b_ids, "cell_x", "cell_y", "a_local", "b_local"]
    alone = a.select(*a_ids, *[F.lit(None).cast(b.schema[c].dataType).alias(c) for c in b_ids], "cell_x", "cell_y", "a_local",
                     F.lit(None).cast("array<double>").alias("b_local"), F.lit(True).alias("alone"))
    every = met.select(*needed, F.lit(False).alias("alone")).unionByName(alone)
    parts = every.withColumn("common", cell_overlap("a_local", "b_local", "cell_x", "cell_y", F.lit(float(cell))))
    summed = stored_table(parts.groupBy(*a_ids, *b_ids, "alone").agg(F.sum("common").alias("overlap_m2")), "overlaps")
    size = summed.filter(F.col("alone") & (F.col("overlap_m2") > 0)).select(*a_ids, F.col("overlap_m2").alias("base_m2"))
    real = summed.filter(~F.col("alone") & (F.col("overlap_m2") >= min_area)).drop("alone").join(size, a_ids)
    return real.select(*a_ids, *b_ids, "overlap_m2", "base_m2")


def lines_near_areas(lines: DataFrame, areas: DataFrame, distance: float, line_id: list[str], area_id: list[str], cell: float,
                     same: list[tuple[str, str]] | None = None) -> DataFrame:
    """(line, area) pairs where the line, widened by ``distance`` each side, meets the area.

    The widened overlap is "closer than the distance, or with a vertex inside", so no buffer is built.  ``lines`` carries
    ``path`` ARRAY<STRUCT<x,y>>.  The share of a widened line means nothing, so none is given.

    A short line or a single segment meets an area whole, in the one cell that owns the pair.  Long lines are cut to segments, and their pairs, like those
    of repeated ids, are made distinct after a shuffle.
    """
    n = F.size("path") - 1
    pieces = F.zip_with(F.slice("path", F.lit(1), n), F.slice("path", F.lit(2), n), lambda s, e: F.struct(
        s.x.alias("x1"), s.y.alias("y1"), e.x.alias("x2"), e.y.alias("y2")))
    box = ["min_x", "max_x", "min_y", "max_y"]
    once = lambda ids: F.count(F.lit(1)).over(Window.partitionBy(*ids)) == 1
    flat = lambda edge_list: F.transform(_flat(edge_list), lambda v: v.cast("double"))
    keep_l = [*line_id, *[l for l, _ in same or [] if l not in line_id]]
    keep_a = [*area_id, *[r for _, r in same or [] if r not in area_id]]
    walked = with_bounds(lines.select(*keep_l, pieces.alias("pieces"), F.array("path").alias("_rings")), "_rings").withColumns(
        {c: F.col(c) + (distance if c.startswith("max") else -distance) for c in box})
    short = (F.size("pieces") <= SIMPLE) & (F.col("max_x") - F.col("min_x") <= SHORT * cell) & (F.col("max_y") - F.col("min_y") <= SHORT * cell)
    whole = F.coalesce(once(line_id) & ((F.size("pieces") == 1) | short), F.lit(False))
    paths = stored_table(walked.withColumn("whole", whole).drop("_rings").filter(F.size("pieces") > 0), "paths")
    # written: a join would work out the outlines again for each cell
    shapes = stored_table(with_bounds(areas).select(*keep_a, flat(edges(F.col("rings"))).alias("area_edges"), *box, once(area_id).alias("whole")), "outlines")
    taken = candidate_pairs(paths.filter("whole").withColumn("path", flat(F.col("pieces"))), shapes.filter("whole"), cell, [*keep_l, "path"], [*keep_a, "area_edges"], same)
    found = taken.filter(path_near("path", "area_edges", F.lit(float(distance)))).select(*line_id, *area_id)
    rest = [not df.filter("NOT whole").isEmpty() for df in (paths, shapes)]
    if not any(rest):
        return found
    p = F.col("piece")
    boxed = paths.select(*keep_l, "whole", F.explode("pieces").alias("piece")).withColumns({
        f"{end}_{c}": f(p[f"{c}1"], p[f"{c}2"]) + by for end, f, by in (("min", F.least, -distance), ("max", F.greatest, distance)) for c in "xy"})
    near = segment_near(*[p[c].cast("double") for c in ("x1", "y1", "x2", "y2")], "area_edges", F.lit(float(distance)))
    cut = [candidate_pairs(l, a, cell, [*keep_l, "piece"], [*keep_a, "area_edges"], same).filter(near).select(*line_id, *area_id) for some, l, a in (
        (rest[0], boxed.filter("NOT whole"), shapes), (rest[1], boxed.filter("whole"), shapes.filter("NOT whole"))) if some]
    return found.unionByName(reduce(DataFrame.unionByName, cut).distinct())


def nearest_area(points: DataFrame, areas: DataFrame, point_id: str, area_id: str, cell: float, within: float,
                 x: str = "easting", y: str = "northing") -> DataFrame:
    """The area of each point: the lowest id that holds it, else the nearest within ``within`` metres, else NULL.

    Adds ``area_id`` and ``placed_by`` (inside, nearest or none).  The fallback joins only the points no area holds.
    """
    cast_x, cast_y = F.col(x).cast("double"), F.col(y).cast("double")
    held = points_in_areas(points.select(point_id, x, y), areas, cell, [area_id], x, y, keep_points=[point_id])
    inside = stored_table(held.groupBy(point_id).agg(F.min(area_id).alias("_inside")), "inside")        # read twice below
    rest = points.join(inside, point_id, "left_anti")
    grown = (with_bounds(spread(areas.select(area_id, "rings"), [area_id])).withColumn("_edges", edges(F.col("rings")))
             .withColumn("min_x", F.col("min_x") - within).withColumn("max_x", F.col("max_x") + within)
             .withColumn("min_y", F.col("min_y") - within).withColumn("max_y", F.col("max_y") + within))
    boxes = _cells(grown.select(area_id, "_edges", "min_x", "max_x", "min_y", "max_y"), within, "min_x", "max_x", "min_y", "max_y")
    spots = rest.withColumn("cell_x", F.floor(F.col(x) / within)).withColumn("cell_y", F.floor(F.col(y) / within))

    def gap2(e: Column) -> Column:
        dx, dy = e.x2 - e.x1, e.y2 - e.y1
        length2 = dx * dx + dy * dy
        t = F.when(length2 == 0, 0.0).otherwise(
            F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((cast_x - e.x1) * dx + (cast_y - e.y1) * dy) / length2)))
        return F.pow(cast_x - (e.x1 + t * dx), 2) + F.pow(cast_y - (e.y1 + t * dy), 2)

    spots, boxes, on = salted(stored_table(spots, "outside"), boxes, ["cell_x", "cell_y"], [x, y])
    near = (spots.join(boxes.hint("merge"), on)
            .withColumn("_d", F.sqrt(F.array_min(F.transform("_edges", gap2)))).filter(F.col("_d") <= within)
            .groupBy(point_id).agg(F.min(F.struct("_d", area_id)).alias("_near")))
    joined = points.join(inside, point_id, "left").join(near, point_id, "left")
    chosen = F.coalesce(F.col("_inside"), F.col(f"_near.{area_id}"))
    how = F.when(F.col("_inside").isNotNull(), "inside").when(F.col("_near").isNotNull(), "nearest").otherwise("none")
    return joined.select(*points.columns, chosen.alias(area_id), how.alias("placed_by"))
