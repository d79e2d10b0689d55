"""The one measure Spark has no expression for: the area that two shapes have in common inside one grid cell.

A shape is given by the edges that matter in the cell: those level with it and not wholly to its left (see ``spatial.cover``).  All
cells of an Arrow batch are measured together in flat arrays.  A cell with many edges is quartered first, all such cells at once, each
quarter keeping its own edges, so memory is linear in the edges.  A box with few edges is cut at every height where an edge ends, meets
another edge or leaves the box; between two such heights the common width changes evenly, so its middle gives the area.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T

FEW = 12        # edges inside a box that are summed at once
DEEPEST = 24        # quarterings; a box so small is summed without the heights where edges meet
AT_ONCE = 4096        # boxes that are summed together
EDGES = 1 << 18        # edges that a segment is compared with at a time


def points_inside(edges: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Even-odd test of points (columns) in pieces (rows) with equally many edges; a point on an edge is inside."""
    odd = np.zeros((len(edges), len(x)), dtype=bool)
    touching = np.zeros_like(odd)
    for j in range(edges.shape[1]):
        x1, y1, x2, y2 = (edges[:, j, i, None] for i in range(4))
        rise, run = (x2 - x1) * (y - y1), (y2 - y1) * (x - x1)
        with np.errstate(divide="ignore", invalid="ignore"):
            odd ^= ((y1 > y) != (y2 > y)) & (x < rise / (y2 - y1) + x1)
        touching |= ((rise == run) & (x >= np.minimum(x1, x2)) & (x <= np.maximum(x1, x2))
                     & (y >= np.minimum(y1, y2)) & (y <= np.maximum(y1, y2)))
    return touching | odd


class _Edges:
    """Edges of many boxes, lower end first: corner columns, the box of each edge and the shape (0 or 1) that it belongs to."""

    def __init__(self, corners: np.ndarray, box: np.ndarray, side: np.ndarray):
        self.corners, self.box, self.side = corners, box, side

    def __getitem__(self, chosen: np.ndarray) -> "_Edges":
        return _Edges(self.corners[chosen], self.box[chosen], self.side[chosen])

    @property
    def low(self) -> np.ndarray:
        return self.corners[:, 1]

    @property
    def high(self) -> np.ndarray:
        return self.corners[:, 3]

    def left(self) -> np.ndarray:
        return np.minimum(self.corners[:, 0], self.corners[:, 2])

    def right(self) -> np.ndarray:
        return np.maximum(self.corners[:, 0], self.corners[:, 2])


def _repeat(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions ``starts[i], starts[i] + 1, ...``, ``counts[i]`` of them, for every i in turn."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def _by_box(box: np.ndarray, boxes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows by box, and the first row and number of rows of each box in that order."""
    counts = np.bincount(box, minlength=boxes)
    return np.argsort(box, kind="stable"), np.cumsum(counts) - counts, counts


class _Turns:
    """Edges to the right of their box: they only turn inside and outside around, at their ends.  Ends that two edges share cancel."""

    def __init__(self, key: np.ndarray, y: np.ndarray):
        self.key, self.y = key, y

    @classmethod
    def over(cls, edges: _Edges, south: np.ndarray, north: np.ndarray) -> "_Turns":
        key = np.tile(edges.box * 2 + edges.side, 2)
        y = np.clip(np.concatenate([edges.low, edges.high]), np.tile(south[edges.box], 2), np.tile(north[edges.box], 2))
        order = np.lexsort((y, key))
        key, y = key[order], y[order]
        first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (y[1:] != y[:-1])]) if len(key) else np.zeros(0, int)
        odd = first[np.diff(np.r_[first, len(key)]) % 2 == 1]
        return cls(key[odd], y[odd])

    def of(self, number: np.ndarray) -> "_Turns":
        """The turns of the boxes that have a new number, which ascends with the old one."""
        kept = number[self.key // 2] >= 0
        return _Turns(number[self.key[kept] // 2] * 2 + self.key[kept] % 2, self.y[kept])

    def odd(self, box: np.ndarray, side: int, y: np.ndarray) -> np.ndarray:
        """Whether an odd number of edges lies to the right of the boxes at the heights."""
        wanted = box * 2 + side
        key, at = np.r_[self.key, wanted], np.r_[self.y, y]
        asked = np.r_[np.zeros(len(self.key), bool), np.ones(len(wanted), bool)]
        order = np.lexsort((asked, at, key))
        below = np.cumsum(~asked[order])
        out = np.empty(len(key), dtype=np.int64)
        out[order] = below
        return (out[len(self.key):] - np.searchsorted(self.key, wanted)) % 2 == 1


def _heights(near: _Edges, level: _Edges, west, south, east, north, meet: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(box, height) of all cuts, sorted: ends of edges, their meetings, where they leave the box, and the box's own ends."""
    x1, y1, x2, y2 = near.corners.T
    slope = (x2 - x1) / (y2 - y1)
    foot, boxes = x1 - slope * y1, len(west)
    order, starts, counts = _by_box(near.box, boxes)
    counts = np.where(meet, counts, 0)
    mine = np.repeat(order, counts[near.box[order]])
    other = order[_repeat(starts[near.box[order]], counts[near.box[order]])]
    once = (mine < other) & (slope[mine] != slope[other])
    mine, other = mine[once], other[once]
    crossing = (foot[other] - foot[mine]) / (slope[mine] - slope[other])
    real = (crossing > np.maximum(y1[mine], y1[other])) & (crossing < np.minimum(y2[mine], y2[other]))
    slanted = np.flatnonzero(slope != 0)
    box = np.concatenate([np.arange(boxes), np.arange(boxes), level.box, near.box, near.box, near.box[mine[real]], near.box[slanted], near.box[slanted]])
    y = np.concatenate([south, north, level.low, y1, y2, crossing[real], (west[near.box[slanted]] - foot[slanted]) / slope[slanted],
                        (east[near.box[slanted]] - foot[slanted]) / slope[slanted]])
    inside = np.isfinite(y) & (y >= south[box]) & (y <= north[box])
    box, y = box[inside], y[inside]
    order = np.lexsort((y, box))
    box, y = box[order], y[order]
    new = np.r_[True, (box[1:] != box[:-1]) | (y[1:] != y[:-1])]
    return box[new], y[new]


def _summed(near: _Edges, level: _Edges, turns: _Turns, west, south, east, north, meet: np.ndarray) -> np.ndarray:
    """Common area per box."""
    boxes = len(west)
    box, y = _heights(near, level, west, south, east, north, meet)
    slab = np.flatnonzero(box[1:] == box[:-1])
    at, thick = box[slab], y[slab + 1] - y[slab]
    middle = (y[slab] + y[slab + 1]) / 2
    odd = [turns.odd(at, side, middle) for side in (0, 1)]
    # edges that cross the middle of a slab, from right to left
    order, starts, counts = _by_box(near.box, boxes)
    which = np.repeat(np.arange(len(at)), counts[at])
    edge = order[_repeat(starts[at], counts[at])]
    corners, height = near.corners[edge], middle[which]
    live = (corners[:, 1] <= height) & (corners[:, 3] > height)
    which, corners, height, side = which[live], corners[live], height[live], near.side[edge[live]]
    x = corners[:, 0] + (corners[:, 2] - corners[:, 0]) * ((height - corners[:, 1]) / (corners[:, 3] - corners[:, 1]))
    x = np.clip(x, west[at[which]], east[at[which]])
    order = np.lexsort((-x, which))
    which, x, side = which[order], x[order], side[order]
    per_slab = np.bincount(which, minlength=len(at))
    first = np.cumsum(per_slab) - per_slab
    some = per_slab > 0
    both = np.ones(len(which), bool)
    for s in (0, 1):
        passed = np.cumsum(side == s)
        before = np.r_[0, passed][first[which]]
        both &= ((passed - before + odd[s][which]) % 2).astype(bool)
    ends = np.r_[x[1:], 0.0] if len(x) else x
    last = (first + per_slab - 1)[some]
    ends[last] = west[at[some]]
    width = np.bincount(which, np.where(both, x - ends, 0.0), minlength=len(at)).astype(np.float64)
    lead = east[at].copy()        # from the right side to the first edge, or to the left side where there is none
    lead[some] -= x[first[some]]
    lead[~some] -= west[at[~some]]
    width += np.where(odd[0] & odd[1], lead, 0.0)
    return np.bincount(at, width * thick, minlength=boxes)


def common_areas(edges: _Edges, west: np.ndarray, south: np.ndarray, east: np.ndarray, north: np.ndarray) -> np.ndarray:
    """Area inside both shapes per box."""
    total, owner = np.zeros(len(west)), np.arange(len(west))
    for depth in range(DEEPEST + 1):
        if not len(owner):
            break
        b = edges.box
        edges = edges[(edges.high > south[b]) & (edges.low < north[b]) & (edges.right() >= west[b])]
        inside, sloping = edges.left() < east[edges.box], edges.low != edges.high
        near, level, turns = edges[inside & sloping], edges[inside & ~sloping], _Turns.over(edges[~inside & sloping], south, north)
        cut = inside.astype(np.int64)
        cuts = [np.bincount(edges.box, cut * (edges.side == s), minlength=len(owner)) for s in (0, 1)]
        empty = np.zeros(len(owner), bool)        # a shape whose boundary is elsewhere holds all of a box or nothing
        every, middle = np.arange(len(owner)), (south + north) / 2
        for s in (0, 1):
            empty |= (cuts[s] == 0) & ~turns.odd(every, s, middle)
        small = cuts[0] + cuts[1] <= FEW
        done = ~empty & (small | (depth == DEEPEST))
        finished = np.flatnonzero(done)
        for start in range(0, len(finished), AT_ONCE):
            part = finished[start:start + AT_ONCE]
            total += _sum_part(near, level, turns, part, owner, west, south, east, north, small, len(total))
        open_ = np.flatnonzero(~empty & ~done)
        edges, owner, west, south, east, north = _quartered(edges, open_, owner, west, south, east, north)
    return total


def _sum_part(near, level, turns, part, owner, west, south, east, north, small, rows) -> np.ndarray:
    """The finished boxes ``part`` summed and added up by row."""
    number = np.full(len(west), -1)
    number[part] = np.arange(len(part))

    def mine(e: _Edges) -> _Edges:
        chosen = e[number[e.box] >= 0]
        return _Edges(chosen.corners, number[chosen.box], chosen.side)

    areas = _summed(mine(near), mine(level), turns.of(number), west[part], south[part], east[part], north[part], small[part])
    return np.bincount(owner[part], areas, minlength=rows)


def _quartered(edges, open_, owner, west, south, east, north):
    """The open boxes cut in four, each quarter with the edges of its box."""
    number = np.full(len(west), -1)
    number[open_] = np.arange(len(open_))
    kept = edges[number[edges.box] >= 0]
    box = number[kept.box]
    w, s, e, n = west[open_], south[open_], east[open_], north[open_]
    x, y = (w + e) / 2, (s + n) / 2
    quarters = [(w, s, x, y), (x, s, e, y), (w, y, x, n), (x, y, e, n)]
    boxes = [np.concatenate(c) for c in zip(*quarters)]
    count = len(open_)
    spread = _Edges(np.tile(kept.corners, (4, 1)), np.concatenate([box + q * count for q in range(4)]), np.tile(kept.side, 4))
    return spread, np.tile(owner[open_], 4), *boxes


def common_area(a: np.ndarray, b: np.ndarray, box: tuple[float, float, float, float]) -> float:
    """Area inside two shapes, rows of x1, y1, x2, y2, and one box (west, south, east, north)."""
    corners = np.concatenate([a, b]).astype(np.float64)
    corners = np.where((corners[:, 1] > corners[:, 3])[:, None], corners[:, [2, 3, 0, 1]], corners)
    edges = _Edges(corners, np.zeros(len(corners), int), np.repeat([0, 1], [len(a), len(b)]))
    return float(common_areas(edges, *(np.array([v], dtype=np.float64) for v in box))[0])


def _side(local: pa.Array, side: int, box: tuple[np.ndarray, ...]) -> _Edges:
    """One shape's edges in all cells; a NULL stands for the whole cell, one upright edge on its right."""
    west, south, east, north = box
    lists = local.fill_null([]) if local.null_count else local
    whole = np.flatnonzero(local.is_null().to_numpy(zero_copy_only=False))
    counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) // 4
    corners = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, 4)
    corners = np.where((corners[:, 1] > corners[:, 3])[:, None], corners[:, [2, 3, 0, 1]], corners)
    beyond = (east - west)[whole]
    upright = np.stack([east[whole] + beyond, south[whole] - beyond, east[whole] + beyond, north[whole] + beyond], axis=1)
    rows = np.r_[np.repeat(np.arange(len(local)), counts), whole]
    return _Edges(np.concatenate([corners, upright]), rows, np.full(len(rows), side))


def _areas(left: pa.Array, right: pa.Array, cell_x: pa.Array, cell_y: pa.Array, cell: pa.Array) -> pa.Array:
    if not len(left):
        return pa.array([], pa.float64())
    x, y, size = (c.to_numpy(zero_copy_only=False).astype(np.float64) for c in (cell_x, cell_y, cell))
    return _in_boxes(left, right, (x * size, y * size, (x + 1) * size, (y + 1) * size))


def _in_boxes(left: pa.Array, right: pa.Array, box: tuple[np.ndarray, ...]) -> pa.Array:
    sides = [_side(left, 0, box), _side(right, 1, box)]
    edges = _Edges(*(np.concatenate([getattr(s, f) for s in sides]) for f in ("corners", "box", "side")))
    return pa.array(common_areas(edges, *box))


@F.arrow_udf(T.DoubleType())
def cell_overlap(left: pa.Array, right: pa.Array, cell_x: pa.Array, cell_y: pa.Array, cell: pa.Array) -> pa.Array:
    """Common area of two shapes in a cell, from flat edges; NULL edges stand for the whole cell."""
    return _areas(left, right, cell_x, cell_y, cell)


@F.arrow_udf(T.DoubleType())
def box_overlap(left: pa.Array, right: pa.Array, west: pa.Array, south: pa.Array, east: pa.Array, north: pa.Array) -> pa.Array:
    """Common area of two whole shapes inside the box, from all their flat edges; NULL edges stand for the whole box."""
    if not len(left):
        return pa.array([], pa.float64())
    return _in_boxes(left, right, tuple(c.to_numpy(zero_copy_only=False).astype(np.float64) for c in (west, south, east, north)))


def _to_segments(x, y, x1, y1, x2, y2) -> np.ndarray:
    """Squared distance of points to segments, row by row."""
    dx, dy = x2 - x1, y2 - y1
    length2 = dx * dx + dy * dy
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.where(length2 == 0, 0.0, np.clip(((x - x1) * dx + (y - y1) * dy) / length2, 0.0, 1.0))
    return (x - (x1 + t * dx)) ** 2 + (y - (y1 + t * dy)) ** 2


def _near(piece: np.ndarray, edge: np.ndarray, row: np.ndarray, rows: int, distance: float) -> np.ndarray:
    """Per row whether its segment comes closer than ``distance`` to one of its edges, or starts inside or on them (even-odd)."""
    (px1, py1, px2, py2), (ex1, ey1, ex2, ey2) = piece[row].T, edge.T
    side = lambda ax, ay, bx, by, cx, cy: (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
    d1, d2 = side(ex1, ey1, ex2, ey2, px1, py1), side(ex1, ey1, ex2, ey2, px2, py2)
    d3, d4 = side(px1, py1, px2, py2, ex1, ey1), side(px1, py1, px2, py2, ex2, ey2)
    close = (d1 * d2 < 0) & (d3 * d4 < 0)
    for x, y, other in ((px1, py1, edge.T), (px2, py2, edge.T), (ex1, ey1, piece[row].T), (ex2, ey2, piece[row].T)):
        close |= _to_segments(x, y, *other) < distance * distance
    with np.errstate(divide="ignore", invalid="ignore"):
        crosses = ((ey1 > py1) != (ey2 > py1)) & (px1 < (ex2 - ex1) * (py1 - ey1) / (ey2 - ey1) + ex1)
    touches = (((ex2 - ex1) * (py1 - ey1) == (ey2 - ey1) * (px1 - ex1)) & (px1 >= np.minimum(ex1, ex2)) & (px1 <= np.maximum(ex1, ex2))
               & (py1 >= np.minimum(ey1, ey2)) & (py1 <= np.maximum(ey1, ey2)))
    counted = lambda v: np.bincount(row, v, minlength=rows)
    return (counted(close | touches) > 0) | (counted(crosses) % 2 == 1)


def _segments_near(piece: np.ndarray, flat: pa.Array, within: float) -> np.ndarray:
    """Per row whether its segment comes closer than ``within`` to the shape of its flat edges, or starts inside it; some edges at a time."""
    counts = flat.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    edge = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, 4)
    ends, found = np.cumsum(counts), np.zeros(len(counts), dtype=bool)
    for first in range(0, len(edge), EDGES):
        last = min(first + EDGES, len(edge))
        row = np.searchsorted(ends, np.arange(first, last), side="right")
        # rows that a border cuts are compared whole, with the part in which they begin
        low, high = row[0] + (ends[row[0]] - counts[row[0]] < first), row[-1]
        if low > high:
            continue
        start, stop = ends[low] - counts[low], ends[high]
        own = np.repeat(np.arange(high - low + 1), counts[low:high + 1])
        found[low:high + 1] = _near(piece[low:high + 1], edge[start:stop], own, high - low + 1, within)
    return found


@F.arrow_udf(T.BooleanType())
def segment_near(x1: pa.Array, y1: pa.Array, x2: pa.Array, y2: pa.Array, flat: pa.Array, distance: pa.Array) -> pa.Array:
    """Whether a segment comes closer than ``distance`` to a shape, given by its flat edges, or starts inside it."""
    if not len(x1):
        return pa.array([], pa.bool_())
    piece = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in (x1, y1, x2, y2)])
    return pa.array(_segments_near(piece, flat, distance.to_numpy(zero_copy_only=False)[0]))


@F.arrow_udf(T.BooleanType())
def path_near(path: pa.Array, flat: pa.Array, distance: pa.Array) -> pa.Array:
    """Whether any segment of a path, given like the edges of a shape, comes closer than ``distance`` to the shape or starts inside it."""
    if not len(path):
        return pa.array([], pa.bool_())
    pieces = path.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    corners = path.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, 4)
    work = np.cumsum(pieces * (flat.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) // 4))
    ends, found = np.cumsum(pieces), np.zeros(len(pieces), dtype=bool)
    for rows in np.split(np.arange(len(pieces)), np.flatnonzero(np.diff(work // EDGES)) + 1):
        own = np.repeat(rows, pieces[rows])
        if len(own):
            near = _segments_near(corners[ends[rows[0]] - pieces[rows[0]]:ends[rows[-1]]], flat.take(pa.array(own)), distance.to_numpy(zero_copy_only=False)[0])
            found[rows] = np.bincount(own - rows[0], near, minlength=len(rows)) > 0
    return pa.array(found)
