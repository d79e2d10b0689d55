"""What points and areas have in common, summed without a row per pair.

Areas are cut to grid cells (``spatial.cover``) and written once.  Points and pieces of areas are dealt by tile, a square of cells, and meet
there cell by cell as blocks of a matrix: one row per piece, one column per point.  What leaves a tile is one row per area (and code) or one
row per point, so what is shuffled follows the two inputs and not the pairs.  A crowded tile is split on both sides, the points by
place and the pieces by area, so that no group holds more than ``POINTS`` x ``PIECES`` rows.

Results that are many themselves (pairs of areas, areas by code) are not added up after the tiles either: an area that reaches over few tiles
has a home, the tile of its lower corner, and what such areas give is worked out whole in one tile, to which the points and pieces of
the tiles beyond it are copied.  Larger areas, and ids with several shapes, are summed tile by tile and added up.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from freshet.operators.kernels import points_inside
from freshet.operators.spatial import _flat, cover, with_bounds
from freshet.session import stored_table

SIDE = 4        # cells along a tile
POINTS = 16384        # points of a group
PIECES = 65536        # pieces of areas of a group
CODED = 16384        # pieces of a group whose rows leave by code
FEW = 2048        # pieces worth a task
BLOCK = 1 << 18        # point and piece combinations tested at a time
WIDE = 8        # cells along a tile in which pairs of larger areas are summed
HOME = 4        # cells along a tile that areas have their home in
REACH = 2        # tiles beyond its home, each way, that an area with a home may reach
SETTLED = 65536        # pieces of either side of a group that works out whole results
KEPT = 1 << 28        # combinations of points and pieces whose test is kept for later blocks of sums
PAIRED = 16384        # pieces of either side of a group of pairs
SUMS = 1 << 23        # sums of pairs held at a time
SPOTS = 1024        # points of a cell that meet both sides at a time


HOMES = ["home_x", "home_y"]


def pieces_of(areas: DataFrame, cell: float, keep: list[str]) -> DataFrame:
    """The cells of the areas, written: ``local`` has the flat edges that decide inside the cell, NULL where the whole cell is inside.

    ``home_x`` and ``home_y`` number the tile of the area's lower corner, NULL for an area that reaches more than ``REACH`` tiles beyond it and
    for an id with several shapes.
    """
    tile = lambda c: F.floor(F.floor(F.col(c) / cell) / HOME)
    once = F.count(F.lit(1)).over(Window.partitionBy(*keep)) == 1
    near = (tile("max_x") - tile("min_x") <= REACH) & (tile("max_y") - tile("min_y") <= REACH)
    homed = with_bounds(areas.select(*keep, "rings")).withColumn("_homed", once & near)
    homed = homed.select(*keep, "rings", *[F.when(F.col("_homed"), tile(f"min_{c}")).alias(f"home_{c}") for c in "xy"])
    cells = cover(homed, cell, [*keep, *HOMES], deal=True)
    local = F.transform(_flat(F.col("local")), lambda v: v.cast("double"))
    return stored_table(cells.select(*keep, *HOMES, "cell_x", "cell_y", local.alias("local")), "pieces")


def _columns(table: pa.Table, names: list[str]) -> np.ndarray:
    """Columns of numbers side by side."""
    if not names:
        return np.zeros((table.num_rows, 0))
    return np.column_stack([table.column(n).to_numpy().astype(np.float64) for n in names])


def _ids(table: pa.Table, columns: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The first row of each distinct key and, for each row, the number of its key."""
    joint = np.zeros(table.num_rows, dtype=np.int64)
    for name in columns:
        codes = table.column(name).combine_chunks().dictionary_encode()
        codes = codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
        joint = joint * (len(codes.dictionary) + 1) + np.asarray(codes.indices.fill_null(len(codes.dictionary))).astype(np.int64)
        joint = np.unique(joint, return_inverse=True)[1]
    _, first, inverse = np.unique(joint, return_index=True, return_inverse=True)
    return first, inverse


class _Met:
    """The points and the pieces of one group."""

    def __init__(self, points: pa.Table, pieces: pa.Table):
        local = pieces.column("local").combine_chunks()
        sizes = np.asarray(pc.list_value_length(local).fill_null(0)).astype(np.int64)
        self.edges = np.asarray(pc.list_flatten(local)).astype(np.float64).reshape(-1, 4)
        self.first = (np.cumsum(sizes) - sizes) // 4
        self.count = np.where(np.asarray(local.is_null()), -1, sizes // 4)
        self.x, self.y = _columns(points, ["_x", "_y"]).T
        cell = np.zeros(points.num_rows + pieces.num_rows, dtype=np.int64)
        for name in ("cell_x", "cell_y", "_part", "_share"):        # numbers of numbers: rows are not compared as rows
            values = np.unique(np.concatenate([t.column(name).to_numpy() for t in (points, pieces)]), return_inverse=True)[1]
            cell = np.unique(cell * (values.max() + 1) + values, return_inverse=True)[1]
        self.point_cell, self.piece_cell = cell[:points.num_rows], cell[points.num_rows:]
        self.at = {c: np.flatnonzero(self.point_cell == c) for c in np.unique(self.point_cell)}

    def blocks(self, chosen: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows of pieces, rows of points, which point is in which piece) for the chosen pieces."""
        chosen = chosen[np.lexsort((self.count[chosen], self.piece_cell[chosen]))]
        cells, counts = self.piece_cell[chosen], self.count[chosen]
        borders = np.flatnonzero((np.diff(cells) != 0) | (np.diff(counts) != 0)) + 1
        for run in np.split(chosen, borders):
            if not len(run) or self.piece_cell[run[0]] not in self.at:
                continue
            points, n = self.at[self.piece_cell[run[0]]], self.count[run[0]]
            for start in range(0, len(run), step := max(1, BLOCK // len(points))):
                rows = run[start:start + step]
                if n < 0:
                    yield rows, points, np.ones((len(rows), len(points)), dtype=bool)
                else:
                    own = self.edges[self.first[rows, None] + np.arange(n)]
                    yield rows, points, points_inside(own, self.x[points], self.y[points])


def _weighed(inside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Per piece the sums of its points' values; what is not a finite number counts only where its point is inside."""
    fine = np.isfinite(values)
    total = inside.astype(np.float64) @ np.where(fine, values, 0.0)
    for i in np.flatnonzero(~fine.all(axis=1)):
        total += np.where(inside[:, i, None], np.where(fine[i], 0.0, values[i]), 0.0)
    return total


def _grouped(points: DataFrame, pieces: DataFrame, cell: float, x: str, y: str, same: list[str], most: int):
    """Both sides with the numbers to group by.  A group takes several small tiles, or a share of a crowded one; few tiles are crowded,
    because each has its full share of rows."""
    tile = {"tile_x": F.floor(F.col("cell_x") / SIDE), "tile_y": F.floor(F.col("cell_y") / SIDE)}
    on = [*same, *tile]
    placed = points.withColumns({"cell_x": F.floor(F.col(x) / cell), "cell_y": F.floor(F.col(y) / cell), "_x": F.col(x).cast("double"),
                                 "_y": F.col(y).cast("double")}).withColumns(tile)
    cut = pieces.withColumns(tile)
    rows = stored_table(placed.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).join(cut.groupBy(*on).agg(F.count(F.lit(1)).alias("_m")), on), "tiles")
    n, m = rows.agg(F.sum("_n"), F.sum("_m")).first()
    least = math.ceil((m or 1) / FEW)        # little data may be much work: tasks follow the pieces and are not merged by bytes
    tasks = min(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), least)
    groups = max(tasks, math.ceil(2 * (n or 0) / POINTS), math.ceil(2 * (m or 0) / most))
    crowded = F.broadcast(rows.filter((F.col("_n") > POINTS) | (F.col("_m") > most)).select(
        *on, F.ceil(F.col("_n") / POINTS).cast("int").alias("_splits"), F.ceil(F.col("_m") / most).cast("int").alias("_cuts")))
    splits, cuts = F.coalesce("_splits", F.lit(1)), F.coalesce("_cuts", F.lit(1))
    own = [c for c in pieces.columns if c not in ("cell_x", "cell_y", "local")]
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = (placed.join(crowded, on, "left").withColumn("_part", F.pmod(F.xxhash64("_x", "_y", points.columns[0]), splits).cast("int"))
            .withColumn("_share", every(cuts)))
    right = (cut.join(crowded, on, "left").withColumn("_share", F.pmod(F.xxhash64(*own), cuts).cast("int")).withColumn("_part", every(splits)))
    group = F.pmod(F.xxhash64(*tile, "_part", "_share"), F.lit(groups)).cast("int")
    on = [*same, "_group"]
    dealt = lambda df: df.withColumn("_group", group).drop(*tile, "_splits", "_cuts").repartition(tasks, *on)
    return dealt(left), dealt(right), on


def _reduced(points: DataFrame, pieces: DataFrame, cell: float, x: str, y: str, same: list[str], most: int, schema: T.StructType,
             reduce: Callable[[pa.Table, pa.Table], pa.Table]) -> DataFrame:
    left, right, on = _grouped(points, pieces.drop(*HOMES), cell, x, y, same, most)
    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(_either(schema, reduce), schema)


def _at_homes(points: DataFrame, x: str, y: str, cell: float, columns: list[str], tiles: DataFrame) -> DataFrame:
    """``columns`` of the points, with their place and cell, beside the rows of ``tiles`` (``home_x``, ``home_y``) that the point may count in: those of
    its own tile and of the ``REACH`` tiles to the west and south."""
    at = {"cell_x": F.floor(F.col(x) / cell), "cell_y": F.floor(F.col(y) / cell)}
    placed = points.select(*columns, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), *[v.alias(n) for n, v in at.items()]).dropna(
        subset=list(at))
    for c in "xy":
        tile = F.floor(F.col(f"cell_{c}") / HOME)
        placed = placed.withColumn(f"home_{c}", F.explode(F.sequence(tile - REACH, tile)))
    return placed.join(tiles, HOMES)


def _tasks(points: DataFrame, pieces: int | None) -> int:
    """Tasks for so many pieces: little data may be much work, so tasks follow the pieces and are not merged by bytes."""
    return min(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil((pieces or 1) / FEW))


def _reduced_at_home(points: DataFrame, pieces: DataFrame, cell: float, keep: list[str], x: str, y: str, schema: T.StructType,
                     reduce: Callable[[pa.Table, pa.Table], pa.Table]) -> DataFrame:
    """What ``reduce`` makes of the areas with a home, each area in one group with all points that it may hold."""
    own = pieces.filter("home_x IS NOT NULL")
    rows = stored_table(own.groupBy(*HOMES).agg(F.count(F.lit(1)).alias("_m")).select(*HOMES, "_m", F.ceil(F.col("_m") / SETTLED).cast("int").alias("_cuts")), "homes")
    tasks, on = _tasks(points, rows.agg(F.sum("_m")).first()[0]), [*HOMES, "_share"]
    spots = _at_homes(points, x, y, cell, [c for c in points.columns if c not in (x, y)], rows).withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1)))
    shaped = own.join(rows, HOMES).withColumn("_share", F.pmod(F.xxhash64(*keep), "_cuts").cast("int"))
    dealt = lambda df: df.drop("_m", "_cuts").withColumn("_part", F.lit(0)).repartition(tasks, *on)
    return dealt(spots).groupBy(*on).cogroup(dealt(shaped).groupBy(*on)).applyInArrow(_either(schema, reduce), schema)


def _either(schema: T.StructType, reduce: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """``reduce`` for groups that have both points and pieces; others give nothing."""
    def each(a: pa.Table, b: pa.Table) -> pa.Table:
        if a.num_rows and b.num_rows:
            return reduce(a, b)
        return pa.table({f.name: pa.array([], type=_arrow(f.dataType)) for f in schema})

    return each


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def sums_in_areas(points: DataFrame, pieces: DataFrame, cell: float, keep: list[str], names: list[str], highest: list[str] | None = None,
                  same: list[str] | None = None, x: str = "easting", y: str = "northing") -> DataFrame:
    """Per area that holds a point: ``n_points``, the sums of the columns ``names`` and the greatest of ``highest`` (numbers, never NULL)
    of the points in it.  ``same`` names columns in which point and area have to agree."""
    highest, same = highest or [], same or []
    schema = T.StructType([*[pieces.schema[c] for c in keep], T.StructField("n_points", T.LongType()),
                           *[T.StructField(n, T.DoubleType()) for n in [*names, *highest]]])

    def reduce(a: pa.Table, b: pa.Table) -> pa.Table:
        met, values, tops = _Met(a, b), _columns(a, names), _columns(a, highest)
        hits, sums = np.zeros(b.num_rows, dtype=np.int64), np.zeros((b.num_rows, len(names)))
        best = np.full((b.num_rows, len(highest)), -np.inf)
        for rows, points, inside in met.blocks(np.arange(b.num_rows)):
            hits[rows] += inside.sum(axis=1)
            sums[rows] += _weighed(inside, values[points])
            for i in range(len(highest)):
                best[rows, i] = np.maximum(best[rows, i], np.where(inside, tops[points, i], -np.inf).max(axis=1))
        first, area = _ids(b, keep)
        count = np.bincount(area, weights=hits, minlength=len(first)).astype(np.int64)
        held = count > 0
        out = {c: b.column(c).take(pa.array(first[held])) for c in keep} | {"n_points": count[held]}
        out |= {n: np.bincount(area, weights=sums[:, i], minlength=len(first))[held] for i, n in enumerate(names)}
        for i, n in enumerate(highest):
            top = np.full(len(first), -np.inf)
            np.maximum.at(top, area, best[:, i])
            out[n] = top[held]
        return pa.table(out)

    parts = _reduced(points, pieces, cell, x, y, same, PIECES, schema, reduce)
    return parts.groupBy(*keep).agg(F.sum("n_points").alias("n_points"), *[F.sum(n).alias(n) for n in names], *[F.max(n).alias(n) for n in highest])


def sums_by_code(points: DataFrame, pieces: DataFrame, cell: float, keep: list[str], codes: dict[str, str], names: list[str],
                 x: str = "easting", y: str = "northing", total: str | None = None) -> DataFrame:
    """Per area, geography and code the sums of ``names`` (numbers, never NULL); ``codes`` names each geography's column of text.  Points
    without a code, or with an empty one, do not count there.  ``total`` names the sum that is also given over all points of the area.

    An area with a home is worked out whole there, so its rows by code are not shuffled.
    """
    totals = [] if total is None else ["_total"]
    schema = T.StructType([*[pieces.schema[c] for c in keep], T.StructField("geography", T.StringType()), T.StructField("code", T.StringType()),
                           *[T.StructField(n, T.DoubleType()) for n in [*names, *totals]]])
    wide = len(names) + 1

    def reduce(a: pa.Table, b: pa.Table) -> pa.Table:
        met, values = _Met(a, b), np.column_stack([np.ones(a.num_rows), _columns(a, names)])
        first, area = _ids(b, keep)
        known = {}
        for geography, column in codes.items():
            start, code = _ids(a, [column])
            texts = a.column(column).take(pa.array(start))
            known[geography] = (code, texts, np.array([t not in (None, "") for t in texts.to_pylist()], dtype=bool))
        by_area, found = np.argsort(area, kind="stable"), []
        columns = sum(len(u) for _, _, u in known.values()) * wide
        for chunk in _chunks(area[by_area], max(1, (1 << 22) // max(1, columns))):
            rows_of = by_area[chunk]
            low = area[rows_of[0]]
            sums = {g: np.zeros((area[rows_of[-1]] - low + 1, len(u), wide)) for g, (_, _, u) in known.items()}
            for rows, points, inside in met.blocks(rows_of):
                for g, (code, _, _) in known.items():
                    here, own = np.unique(code[points], return_inverse=True)
                    spread = np.zeros((len(points), len(here), wide))
                    spread[np.arange(len(points)), own] = values[points]
                    part = _weighed(inside, spread.reshape(len(points), -1)).reshape(len(rows), len(here), wide)
                    np.add.at(sums[g], (area[rows][:, None] - low, here[None, :]), part)
            whole = {c: sums[g][:, :, names.index(total) + 1].sum(axis=1) for c in totals for g in list(codes)[:1]}
            for g, (_, texts, usable) in known.items():
                i, j = np.nonzero((sums[g][:, :, 0] > 0) & usable)
                out = {c: b.column(c).take(pa.array(first[i + low])) for c in keep}
                out |= {"geography": pa.array(np.full(len(i), g, dtype=object), pa.string()), "code": texts.take(pa.array(j))}
                found.append(pa.table(out | {n: sums[g][i, j, k + 1] for k, n in enumerate(names)} | {c: v[i] for c, v in whole.items()}))
        return pa.concat_tables(found)

    found, rest = _reduced_at_home(points, pieces, cell, keep, x, y, schema, reduce), pieces.filter("home_x IS NULL")
    if rest.isEmpty():
        return found
    parts = _reduced(points, rest, cell, x, y, [], CODED, schema, reduce).drop(*totals)
    added = parts.groupBy(*keep, "geography", "code").agg(*[F.sum(n).alias(n) for n in names])
    if totals:
        every = sums_in_areas(points, rest, cell, keep, [total], x=x, y=y).select(*[F.col(c).alias(f"_{c}") for c in keep], F.col(total).alias("_total"))
        added = added.join(every, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keep]).select(*found.columns)
    return found.unionByName(added)


def _chunks(ordered: np.ndarray, most: int) -> list[np.ndarray]:
    """Stretches of the ascending numbers ``ordered`` with at most ``most`` different values each."""
    return np.split(np.arange(len(ordered)), np.flatnonzero(np.diff(ordered // most)) + 1)


def areas_over_points(points: DataFrame, pieces: DataFrame, cell: float, point: str, kind: str, x: str = "easting", y: str = "northing") -> DataFrame:
    """Per kind of area and point that any area of the kind holds: ``depth``, the number of such areas."""
    schema = T.StructType([pieces.schema[kind], points.schema[point], T.StructField("depth", T.LongType())])

    def reduce(a: pa.Table, b: pa.Table) -> pa.Table:
        met, (first, kinds) = _Met(a, b), _ids(b, [kind])
        found = []
        for i, row in enumerate(first):
            depth = np.zeros(a.num_rows, dtype=np.int64)
            for _, points, inside in met.blocks(np.flatnonzero(kinds == i)):
                depth[points] += inside.sum(axis=0)
            held = np.flatnonzero(depth)
            found.append(pa.table({kind: b.column(kind).take(pa.array(np.full(len(held), row))), point: a.column(point).take(pa.array(held)),
                                   "depth": depth[held]}))
        return pa.concat_tables(found)

    parts = _reduced(points, pieces, cell, x, y, [], PIECES, schema, reduce)
    return parts.groupBy(kind, point).agg(F.sum("depth").alias("depth"))


def _held(met: _Met, rows: np.ndarray, points: np.ndarray, area: np.ndarray, repeats: bool) -> tuple[np.ndarray, np.ndarray]:
    """The areas of the pieces ``rows`` of one cell and, per area, which ``points`` it holds (how often, if repeated areas count)."""
    inside = np.ones((len(rows), len(points)), dtype=bool)
    for n in np.unique(met.count[rows]):
        own = np.flatnonzero(met.count[rows] == n)
        for some in np.split(own, range(step := max(1, BLOCK // len(points)), len(own), step)) if n >= 0 else []:
            inside[some] = points_inside(met.edges[met.first[rows[some], None] + np.arange(n)], met.x[points], met.y[points])
    here, number = np.unique(area[rows], return_inverse=True)
    held = np.zeros((len(here), len(points)))
    if len(here) == len(rows):
        held[number] = inside
    else:
        np.add.at(held, number, inside)
    return here, held if repeats else np.minimum(held, 1.0)


def sums_of_pairs(points: DataFrame, left: DataFrame, right: DataFrame, cell: float, a_keep: list[str], b_keep: list[str], names: list[str],
                  same: list[str] | None = None, ordered: bool = False, x: str = "easting", y: str = "northing") -> DataFrame:
    """Per area of ``left`` and area of ``right`` (pieces, agreeing in ``same``) that hold a common point, the sums of ``names`` over the points
    in both.  ``ordered`` keeps the pairs with the first id below the second and counts a repeated area once; both sides are the same areas then,
    ids and ``same`` are not NULL.

    Two areas with a home are summed in one group (:func:`_pairs_at_home`), all other pairs tile by tile, added up after a shuffle.
    """
    same = same or []
    homed, rest = ([df.filter(f"home_x IS {has} NULL") for df in (left, right)] for has in ("NOT", ""))
    found = _pairs_at_home(points, *homed, cell, a_keep, b_keep, names, same, ordered, x, y)
    for one, two, some in ((rest[0], right, rest[0]), (homed[0], rest[1], rest[1])):
        if not some.isEmpty():
            found = found.unionByName(_pairs_by_tile(points, one, two, cell, a_keep, b_keep, names, same, ordered, x, y))
    return found


def _pairs_at_home(points: DataFrame, left: DataFrame, right: DataFrame, cell: float, a_keep: list[str], b_keep: list[str], names: list[str],
                   same: list[str], ordered: bool, x: str, y: str) -> DataFrame:
    """The pairs of two areas with a home, each whole in the tile of the greater home of the two on either axis.

    An area goes to the tiles from its home on, with its pieces there and beyond.  Crowded tiles are cut to shares of areas, and each share of one
    side meets each share of the other.  ``ordered``: both sides are ``left``, which travels once.
    """
    blank = lambda side, columns: [F.lit(None).cast(side.schema[c].dataType).alias(c) for c in columns]
    rest = [*HOMES, "cell_x", "cell_y", "local"]
    pieces = left.select(*same, *a_keep, *([] if ordered else blank(right, b_keep)), *rest, F.lit(0).alias("_side"))
    if not ordered:
        pieces = pieces.unionByName(right.select(*same, *blank(left, a_keep), *b_keep, *rest, F.lit(1).alias("_side")))
    for c in "xy":
        pieces = pieces.withColumn(f"_own_{c}", F.col(f"home_{c}")).withColumn(f"home_{c}", F.explode(F.sequence(f"home_{c}", F.floor(F.col(f"cell_{c}") / HOME))))
    counted = pieces.groupBy(*same, *HOMES).agg(F.count_if(F.col("_side") == 0).alias("_a"), F.count_if(F.col("_side") == 1).alias("_b"))
    cuts = lambda c: F.ceil(F.col(c) / SETTLED).cast("int")
    rows = stored_table(counted.filter("_a > 0" if ordered else "_a > 0 AND _b > 0").select(
        *same, *HOMES, (F.col("_a") + F.col("_b")).alias("_m"), cuts("_a").alias("_i"), cuts("_a" if ordered else "_b").alias("_j")), "homes")
    tasks, on = _tasks(points, rows.agg(F.sum("_m")).first()[0]), [*same, *HOMES, "_share"]
    dealt = lambda df: df.drop("_m", "_i", "_j").withColumn("_part", F.lit(0)).repartition(tasks, *on)
    # share i * _j + j: part i of the left areas and part j of the right ones; of the same areas i <= j
    every = F.sequence(F.lit(0), F.col("_i") * F.col("_j") - 1)
    if ordered:
        every = F.filter(every, lambda s: F.floor(s / F.col("_j")) <= s % F.col("_j"))
    spots = _at_homes(points, x, y, cell, names, rows).withColumn("_share", F.explode(every))
    of_a, of_b = (F.pmod(F.xxhash64(*keep), n).cast("int") for keep, n in ((a_keep, "_i"), (b_keep, "_j")))
    if ordered:
        mine = F.filter(every, lambda s: (F.floor(s / F.col("_j")) == of_a) | (s % F.col("_j") == of_a))
        part = of_a
    else:
        mine = F.when(F.col("_side") == 0, F.sequence(of_a * F.col("_j"), of_a * F.col("_j") + F.col("_j") - 1, F.lit(1))).otherwise(
            F.sequence(of_b, of_b + F.col("_j") * (F.col("_i") - 1), F.col("_j")))
        part = F.lit(0)
    shaped = pieces.join(rows, [*same, *HOMES]).withColumn("_first", part).withColumn("_later", F.col("_j")).withColumn("_share", F.explode(mine))
    schema = T.StructType([*[left.schema[c] for c in [*same, *a_keep]], *[right.schema[c] for c in b_keep], *[T.StructField(n, T.DoubleType()) for n in names]])

    def each(a: pa.Table, b: pa.Table) -> pa.Table:
        b = b.combine_chunks()        # rows are taken from it very often
        numbers = lambda c: b.column(c).to_numpy()
        if ordered:
            first, share, later = numbers("_first"), numbers("_share")[0], numbers("_later")[0]
            sides = [np.flatnonzero(first == share // later), np.flatnonzero(first == share % later)]
            one_side = share // later == share % later
        else:
            sides, one_side = [np.flatnonzero(numbers("_side") == s) for s in (0, 1)], False
        found = [pa.table({f.name: pa.array([], type=_arrow(f.dataType)) for f in schema})]
        if not len(sides[0]) or not len(sides[1]):
            return found[0]
        met, values, fine = _Met(a, b), _columns(a, names), np.isfinite(_columns(a, names))
        area, start, runs = np.zeros(b.num_rows, dtype=np.int64), [], []
        for own, keep in zip(sides, (a_keep, a_keep if ordered else b_keep)):
            rows_of, number = _ids(b.take(pa.array(own)), keep)
            rows_of = own[rows_of]
            # numbered by where the home lies: west, here, south, south-west; a pair belongs here if its homes reach this tile on both axes
            west, south = (numbers(f"_own_{c}")[rows_of] < numbers(f"home_{c}")[0] for c in "xy")
            kind = np.select([west & south, south, west], [3, 2, 0], 1)
            by, rank = np.argsort(kind, kind="stable"), np.empty(len(kind), dtype=np.int64)
            rank[by] = np.arange(len(by))
            area[own] = rank[number]
            start.append(rows_of[by])
            runs.append(np.searchsorted(kind[by], np.arange(5)))
        ids = np.unique(b.column(a_keep[0]).to_numpy(), return_inverse=True)[1] if ordered else None
        here = [{c: own[own_cells == c] for c in np.unique(own_cells)} for own in sides[:1 if one_side else 2] for own_cells in [met.piece_cell[own]]]
        blocks = [(c, some) for c, at in met.at.items() if all(c in h for h in here) for some in np.split(at, range(SPOTS, len(at), SPOTS))]
        keepable = sum(len(some) * sum(len(h[c]) for h in here) for c, some in blocks) <= KEPT
        kept = {}

        def held(k: int, c: int, some: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
            if k not in kept:
                sets = [(areas, inside > 0) for areas, inside in (_held(met, h[c], some, area, False) for h in here)]
                if not keepable:
                    return sets * 2 if one_side else sets
                kept[k] = sets
            return kept[k] * 2 if one_side else kept[k]

        n, (rows_at, columns_at) = len(names) + 1, runs
        # west meets here and south, here meets all, south meets west and here, south-west meets here; of the same areas each two meet once
        spans = [(0, columns_at[1], columns_at[3]), (1, 0, columns_at[4])]
        spans += [] if one_side else [(2, 0, columns_at[2]), (3, columns_at[1], columns_at[2])]
        for run, left_end, right_end in spans:
            step = max(1, SUMS // max(1, (right_end - left_end) * n))
            for low in range(rows_at[run], rows_at[run + 1], step):
                high, base = min(low + step, rows_at[run + 1]), max(left_end, low) if one_side else left_end
                width = right_end - base
                sums = np.zeros((n, (high - low) * width))
                for k, (c, some) in enumerate(blocks):
                    (one, x_in), (two, y_in) = held(k, c, some)
                    p, q, r, t = *np.searchsorted(one, [low, high]), *np.searchsorted(two, [base, right_end])
                    if p == q or r == t:
                        continue
                    x_in, y_in, v = x_in[p:q].astype(np.float64), y_in[r:t].astype(np.float64), np.where(fine[some], values[some], 0.0)
                    block = np.concatenate([x_in, *[x_in * v[:, i] for i in range(len(names))]]) @ y_in.T
                    at = ((one[p:q] - low)[:, None] * width + (two[r:t] - base)).ravel()
                    for own_sums, part in zip(sums, block.reshape(n, -1)):
                        own_sums[at] += part
                    for i, j in zip(*np.nonzero(~fine[some])):
                        sums[j + 1][at] += np.where(np.outer(x_in[:, i], y_in[:, i]) > 0, values[some[i], j], 0.0).ravel()
                i, j = np.divmod(np.flatnonzero(sums[0] > 0), max(1, width))
                if one_side and base < high:
                    later_one = i + low < j + base
                    i, j = i[later_one], j[later_one]
                if not len(i):
                    continue
                at_a, at_b = start[0][i + low], start[1][j + base]
                if ordered:
                    turned = ids[at_a] > ids[at_b]
                    at_a, at_b = np.where(turned, at_b, at_a), np.where(turned, at_a, at_b)
                out = {c: b.column(c).take(pa.array(at_a)) for c in [*same, *a_keep]}
                out |= {c: b.column(d).take(pa.array(at_b)) for c, d in zip(b_keep, a_keep if ordered else b_keep)}
                found.append(pa.table(out | {m: sums[k + 1][i * width + j] for k, m in enumerate(names)}))
        return pa.concat_tables(found)

    return dealt(spots).groupBy(*on).cogroup(dealt(shaped).groupBy(*on)).applyInArrow(_either(schema, each), schema)


def _pairs_by_tile(points: DataFrame, left: DataFrame, right: DataFrame, cell: float, a_keep: list[str], b_keep: list[str], names: list[str],
                   same: list[str], ordered: bool, x: str, y: str) -> DataFrame:
    """Any pairs of ``left`` and ``right``, summed tile by tile and added up.

    A tile multiplies the matrix of areas and points of one side with that of the other, so no row is made per point and pair.  The
    pieces of either side of a crowded tile are cut to shares, and each share of one meets each share of the other.
    """
    blank = lambda side, columns: [F.lit(None).cast(side.schema[c].dataType).alias(c) for c in columns]
    pieces = left.select(*same, *a_keep, *blank(right, b_keep), "cell_x", "cell_y", "local", F.lit(0).alias("_side")).unionByName(
        right.select(*same, *blank(left, a_keep), *b_keep, "cell_x", "cell_y", "local", F.lit(1).alias("_side")))
    tile = {"tile_x": F.floor(F.col("cell_x") / WIDE), "tile_y": F.floor(F.col("cell_y") / WIDE)}
    placed = points.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), *names, F.floor(F.col(x) / cell).alias("cell_x"),
                           F.floor(F.col(y) / cell).alias("cell_y")).dropna(subset=["cell_x", "cell_y"]).withColumns(tile)
    cut = pieces.withColumns(tile)
    pieces_in = cut.groupBy(*same, *tile).agg(F.count_if(F.col("_side") == 0).alias("_a"), F.count_if(F.col("_side") == 1).alias("_b"))
    both = pieces_in.filter("_a > 0 AND _b > 0").join(placed.groupBy(*tile).agg(F.count(F.lit(1)).alias("_n")), [*tile])
    parts_of = lambda c, most: F.ceil(F.col(c) / most).cast("int")
    rows = stored_table(both.select(*same, *tile, F.lit(1).alias("_one"), (F.col("_a") + F.col("_b")).alias("_m"), parts_of("_n", POINTS).alias("_splits"),
                                    parts_of("_a", PAIRED).alias("_i"), parts_of("_b", PAIRED).alias("_j")), "tiles")
    m = rows.agg(F.sum("_m")).first()[0]
    tasks = min(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil((m or 1) / FEW))
    on = [*same, *tile, "_part", "_share"]
    dealt = lambda df: df.drop("_one", "_m", "_splits", "_i", "_j").repartition(tasks, *on)
    spots = (placed.join(rows, [*tile]).withColumn("_part", F.pmod(F.xxhash64("_x", "_y"), "_splits").cast("int"))
             .withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_i") * F.col("_j") - 1))))
    of_a, of_b = (F.pmod(F.xxhash64(*keep), n).cast("int") for keep, n in ((a_keep, "_i"), (b_keep, "_j")))
    shares = F.when(F.col("_side") == 0, F.sequence(of_a * F.col("_j"), of_a * F.col("_j") + F.col("_j") - 1, F.lit(1))).otherwise(
        F.sequence(of_b, of_b + F.col("_j") * (F.col("_i") - 1), F.col("_j")))
    shaped = (cut.join(rows, [*same, *tile]).withColumn("_share", F.explode(shares))
              .withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_splits") - 1))))
    schema = T.StructType([*[left.schema[c] for c in [*same, *a_keep]], *[right.schema[c] for c in b_keep], *[T.StructField(n, T.DoubleType()) for n in names]])

    def each(a: pa.Table, b: pa.Table) -> pa.Table:
        return pa.concat_tables([pa.table({f.name: pa.array([], type=_arrow(f.dataType)) for f in schema}), *_pairs(a, b)])

    def _pairs(a: pa.Table, b: pa.Table) -> Iterator[pa.Table]:
        b = b.combine_chunks()        # rows are taken from it very often
        met, values = _Met(a, b), _columns(a, names)
        side = b.column("_side").to_numpy()
        rows_of, first, area = {}, {}, np.zeros(b.num_rows, dtype=np.int64)
        for s, keep in enumerate((a_keep, b_keep)):
            own = np.flatnonzero(side == s)
            start, area[own] = _ids(b.take(pa.array(own)), keep)
            first[s], cells = own[start], met.piece_cell[own]
            rows_of[s] = {c: own[cells == c] for c in np.unique(cells)}
        if ordered:
            ids = [b.column(k[0]).take(pa.array(first[s])).to_numpy() for s, k in enumerate((a_keep, b_keep))]
            ranks = np.unique(np.concatenate(ids), return_inverse=True)[1]
            ranks = ranks[:len(ids[0])], ranks[len(ids[0]):]
        step = max(1, SUMS // (len(first[1]) * (len(names) + 1) or 1))
        for low in range(0, len(first[0]), step):
            sums = np.zeros((len(names) + 1, min(step, len(first[0]) - low), len(first[1])))
            for c, points in met.at.items():
                mine = rows_of[0].get(c, np.zeros(0, dtype=np.int64))
                mine, other = mine[(area[mine] >= low) & (area[mine] < low + step)], rows_of[1].get(c, ())
                if not len(mine) or not len(other):
                    continue
                for some in np.split(points, range(SPOTS, len(points), SPOTS)):
                    (one, x_in), (two, y_in) = (_held(met, r, some, area, not ordered) for r in (mine, other))
                    at = np.ix_(one - low, two)
                    sums[0][at] += x_in @ y_in.T
                    for k in range(len(names)):
                        v = values[some, k]
                        fine = np.isfinite(v)
                        sums[k + 1][at] += (x_in * np.where(fine, v, 0.0)) @ y_in.T
                        for i in np.flatnonzero(~fine):
                            sums[k + 1][at] += np.where(np.outer(x_in[:, i], y_in[:, i]) > 0, v[i], 0.0)
            i, j = np.nonzero(sums[0] > 0)
            if ordered:
                below = ranks[0][i + low] < ranks[1][j]
                i, j = i[below], j[below]
            if len(i):
                at_a, at_b = pa.array(first[0][i + low]), pa.array(first[1][j])
                out = {c: b.column(c).take(at_a) for c in [*same, *a_keep]} | {c: b.column(c).take(at_b) for c in b_keep}
                yield pa.table(out | {n: sums[k + 1][i, j] for k, n in enumerate(names)})

    parts = dealt(spots).groupBy(*on).cogroup(dealt(shaped).groupBy(*on)).applyInArrow(_either(schema, each), schema)
    return parts.groupBy(*same, *a_keep, *b_keep).agg(*[F.sum(n).alias(n) for n in names])
