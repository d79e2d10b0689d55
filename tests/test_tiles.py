"""Sums of points over areas tile by tile, against pairs counted one by one."""

import random

import pytest
from pyspark.sql import functions as F

from freshet.operators import skew, spatial, tiles
from freshet.plans import exposure
from freshet.session import stored_table

RINGS = "array<array<struct<x:double,y:double>>>"


def ring(*corners):
    return [[{"x": float(x), "y": float(y)} for x, y in (*corners, corners[0])]]


def _world(spark):
    rng = random.Random(7)
    spots = [(i, float(rng.randrange(-40, 400)), float(rng.randrange(-40, 400)), rng.choice([1.0, 2.5, 40.0]), rng.choice(["a", "b", "", None])) for i in range(400)]
    points = spark.createDataFrame([*spots, spots[0], (None, 50.0, 50.0, 9.0, "a"), (900, None, 5.0, 1.0, "a")], "point_id long, easting double, northing double, people double, pcon string")
    shapes = []
    for i in range(60):
        x, y, w, h = rng.randrange(-30, 300), rng.randrange(-30, 300), rng.randrange(5, 120), rng.randrange(5, 120)
        bent = ring((x, y), (x + w, y), (x + w, y + h), (x + w / 2, y + h / 3), (x, y + h)) if i % 2 else ring((x, y), (x + w, y), (x + w, y + h), (x, y + h))
        shapes.append(("flood_warning" if i % 3 else "flood_alert", i, bent))
    return points, spark.createDataFrame([*shapes, shapes[1]], f"kind string, area_id int, rings {RINGS}")


@pytest.mark.parametrize("most", [(16384, 65536), (25, 10)])
def test_sums_depths_and_codes_are_those_of_the_pairs(spark, monkeypatch, most):
    for name, value in zip(("POINTS", "PIECES", "CODED", "BLOCK"), (most[0], most[1], most[1], 64)):
        monkeypatch.setattr(tiles, name, value)
    points, areas = _world(spark)
    pairs = spatial.points_in_areas(points, areas, 25.0, ["kind", "area_id"]).cache()
    pieces = tiles.pieces_of(areas, 25.0, ["kind", "area_id"])
    whole = lambda df, *keys: {tuple(r)[:len(keys)]: tuple(r)[len(keys):] for r in df.collect()}
    want = whole(pairs.groupBy("kind", "area_id").agg(F.count(F.lit(1)), F.sum("people"), F.max("people")), "kind", "area_id")
    got = tiles.sums_in_areas(points.withColumn("top", F.col("people")), pieces, 25.0, ["kind", "area_id"], ["people"], ["top"])
    assert len(want) > 40 and whole(got, "kind", "area_id") == want
    want = whole(pairs.groupBy("kind", "point_id").agg(F.count(F.lit(1))), "kind", "point_id")
    assert whole(tiles.areas_over_points(points, pieces, 25.0, "point_id", "kind"), "kind", "point_id") == want
    want = whole(pairs.filter("pcon <> ''").groupBy("kind", "area_id", F.lit("constituency"), "pcon").agg(F.sum("people")), *range(4))
    assert whole(tiles.sums_by_code(points, pieces, 25.0, ["kind", "area_id"], {"constituency": "pcon"}, ["people"]), *range(4)) == want


def test_values_without_a_number_stay_where_they_are(spark):
    points = spark.createDataFrame([(1, 10.0, 10.0, float("nan")), (2, 60.0, 10.0, 3.0), (3, 61.0, 10.0, float("inf"))], "point_id int, easting double, northing double, v double")
    areas = spark.createDataFrame([("left", ring((0, 0), (50, 0), (50, 50), (0, 50))), ("mid", ring((55, 0), (60, 0), (60, 50), (55, 50))), ("right", ring((55, 0), (99, 0), (99, 50), (55, 50)))],
                                  f"area_id string, rings {RINGS}")
    got = {r.area_id: r.v for r in tiles.sums_in_areas(points, tiles.pieces_of(areas, 200.0, ["area_id"]), 200.0, ["area_id"], ["v"]).collect()}
    assert got["left"] != got["left"] and got["mid"] == 3.0 and got["right"] == float("inf")


def test_neither_side_of_the_cell_join_is_broadcast(spark):
    points, areas = _world(spark)
    plan = spatial.points_in_areas(points, areas, 25.0, ["area_id"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [cell_x" in plan and not [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "Inner" in line]


def test_figures_write_no_row_per_pair(spark):
    points = spark.range(300).select(F.col("id").alias("point_id"), F.col("id").cast("double").alias("easting"), F.lit(5.0).alias("northing"), F.lit(2.0).alias("people"))
    areas = spark.createDataFrame([("flood_warning", i, ring((-1, -1), (301, -1), (301, 9), (-1, 9))) for i in range(50)], f"kind string, area_id int, rings {RINGS}")
    members = exposure.membership(points, areas, 1000.0)
    rows = exposure.area_figures(members, points).select("people", F.round("people_split", 6).alias("split"), "people_unique").collect()
    assert {tuple(r) for r in rows} == {(600.0, 12.0, 0.0)} and len(rows) == 50
    assert members.depth.count() == 300 and members.pieces.count() == 50 * 4


def _pair_sums(held, values, couples):
    """Sums of ``values`` over the points that both areas of a couple hold, counted one by one."""
    out = {}
    for a, b in couples(held):
        common = held[a].keys() & held[b].keys()
        if common:
            out[a, b] = sum(held[a][p] * held[b][p] * values[p] for p in common)
    return out


@pytest.mark.parametrize("small", [False, True])
def test_pairs_of_areas_are_those_of_the_points_in_both(spark, monkeypatch, small):
    for name, value in {"WIDE": 2, "POINTS": 25, "PAIRED": 10, "SUMS": 20, "SPOTS": 3, "BLOCK": 16}.items() if small else ():
        monkeypatch.setattr(tiles, name, value)
    monkeypatch.setattr(exposure, "pairs_within", None)        # no set of areas is unfolded, no point meets an area in a row of its own
    monkeypatch.setattr(exposure, "points_in_areas", None)
    points, areas = _world(spark)
    pairs = spatial.points_in_areas(points.filter("point_id IS NOT NULL"), areas, 25.0, ["kind", "area_id"]).collect()
    values, held = {}, {}
    for r in points.filter("point_id IS NOT NULL").collect():
        values[r.point_id] = values.get(r.point_id, 0.0) + r.people
    for r in pairs:
        own = held.setdefault((r.kind, r.area_id), {})
        own[r.point_id] = own.get(r.point_id, 0) + 1
    once = {a: dict.fromkeys(p, 1) for a, p in held.items()}
    want = _pair_sums(once, values, lambda h: [(a, b) for a in h for b in h if a[0] == b[0] and a[1] < b[1]])
    got = exposure.pair_overlaps(exposure.membership(points, areas, 25.0), points, ["people"]).collect()
    assert len(want) > 50 and {((r.kind, r.area_a), (r.kind, r.area_b)): r.people for r in got} == want and len(got) == len(want)

    shapes = areas.filter("area_id % 4 = 2").select(F.col("area_id").alias("polygon_key"), "rings")
    keys = {a for a in held if a[1] % 4 == 2}
    want = _pair_sums(held, values, lambda h: [(a, b) for a in keys for b in h])
    got = exposure.guidance_by_area(points, shapes, areas, 25.0).collect()
    assert {(r.polygon_key, r.kind, r.area_id): r.people for r in got} == {(a[1], *b): v for (a, b), v in want.items()} and len(got) == len(want)


def test_a_point_with_two_places_joins_the_areas_of_both(spark):
    points = spark.createDataFrame([(1, 5.0, 5.0, 2.0), (1, 95.0, 5.0, 3.0), (2, 6.0, 6.0, 7.0)], "point_id int, easting double, northing double, people double")
    box = lambda x: ring((x, 0), (x + 10, 0), (x + 10, 10), (x, 10))
    areas = spark.createDataFrame([("flood_warning", 1, box(0)), ("flood_warning", 2, box(0)), ("flood_warning", 3, box(90))], f"kind string, area_id int, rings {RINGS}")
    got = exposure.pair_overlaps(exposure.membership(points, areas), points, ["people"]).collect()
    assert {(r.area_a, r.area_b): r.people for r in got} == {(1, 2): 12.0, (1, 3): 5.0, (2, 3): 5.0}
    under = exposure.guidance_by_area(points, areas.filter("area_id = 1").select(F.col("area_id").alias("polygon_key"), "rings"), areas).collect()
    assert {(r.polygon_key, r.area_id): r.people for r in under} == {(1, 1): 12.0, (1, 2): 12.0, (1, 3): 5.0}


@pytest.mark.parametrize("small", [False, True])
def test_points_meet_the_areas_of_a_cell_as_blocks(spark, monkeypatch, small):
    if small:        # cells crowded on both sides, blocks cut, pairs leaving a few at a time
        monkeypatch.setattr(spatial, "BLOCK", 16)
        monkeypatch.setattr(spatial, "PAIRS", 5)
        monkeypatch.setattr(skew, "LEAST", 3)
    points, areas = _world(spark)
    boxes = areas.filter("area_id % 2 = 0")        # those are upright boxes, so corners decide
    held = spatial.points_in_areas(points, boxes, 100.0 if small else 25.0, ["kind", "area_id"], keep_points=["point_id", "pcon"])
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert held.columns == ["point_id", "pcon", "kind", "area_id"]
    assert "MapInArrow" in plan and "collect_list" in plan and "SortMergeJoin [cell_x" in plan        # a row per cell meets a row per cell
    corners = [(r.kind, r.area_id, *(f(p[c] for p in r.rings[0]) for c in "xy" for f in (min, max))) for r in boxes.collect()]
    want = [(p.point_id, p.pcon, k, a) for p in points.collect() for k, a, x0, x1, y0, y1 in corners
            if p.easting is not None and x0 <= p.easting <= x1 and y0 <= p.northing <= y1]
    key = lambda r: tuple(map(str, r))
    assert len(want) > 200 and sorted(map(tuple, held.collect()), key=key) == sorted(want, key=key)


def test_site_list_makes_the_wanted_columns_only(spark):
    sites = spark.createDataFrame([(1, 5.0, 5.0, "one", 4), (2, 95.0, 5.0, "two", None)], "site_id int, easting double, northing double, name string, rofrs_rank int")
    areas = spark.createDataFrame([("flood_alert", i, ring((0, 0), (50, 0), (50, 50), (0, 50))) for i in (7, 8)], f"kind string, area_id int, rings {RINGS}")
    got = exposure.site_list(sites, areas, keep=["site_id"])
    assert got.columns == ["site_id", "kind", "area_id", "band"] and sorted(map(tuple, got.collect())) == [(1, "flood_alert", 7, "High"), (1, "flood_alert", 8, "High")]
    assert exposure.site_list(sites, areas).columns == [*sites.columns, "kind", "area_id", "band"]


def _above_the_tiles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[:plan.index("FlatMapCoGroupsInArrow")]


def test_pairs_of_areas_with_a_home_are_not_added_up_again(spark):
    points, areas = _world(spark)
    once = areas.filter("area_id <> 1")        # id 1 has two shapes
    assert tiles.pieces_of(areas, 25.0, ["kind", "area_id"]).filter("home_x IS NULL").select("area_id").distinct().collect() == [(1,)]
    pairs = exposure.pair_overlaps(exposure.membership(points, once, 25.0), points, ["people"])
    shapes = once.filter("area_id % 4 = 2").select(F.col("area_id").alias("polygon_key"), "rings")
    under = exposure.guidance_by_area(points, shapes, once, 25.0)
    for found in (pairs, under):
        assert found.count() > 50 and not any(step in _above_the_tiles(found) for step in ("Exchange", "Aggregate"))


def test_pairs_across_tiles_come_once(spark, monkeypatch):
    monkeypatch.setattr(tiles, "SETTLED", 12)        # tiles cut to shares
    side = 60.0        # areas of one cell up to three tiles and a larger one, some far apart and some one in another
    rng = random.Random(3)
    corners = [(i, *(w := (rng.randrange(-500, 900), rng.randrange(-500, 900))), w[0] + rng.randrange(10, 420), w[1] + rng.randrange(10, 420)) for i in range(80)]
    corners.append((99, -400, -400, 800, 500))
    points = spark.createDataFrame([(i, float(rng.randrange(-500, 1200)), float(rng.randrange(-500, 1200)), 1.0 if i else float("inf")) for i in range(500)],
                                   "point_id long, easting double, northing double, people double")
    areas = spark.createDataFrame([("flood_alert", f"a{i}", ring((a, b), (c, b), (c, d), (a, d))) for i, a, b, c, d in corners], f"kind string, area_id string, rings {RINGS}")
    spots = points.collect()
    held = {f"a{i}": {p.point_id for p in spots if a <= p.easting <= c and b <= p.northing <= d} for i, a, b, c, d in corners}
    total = lambda ids: sum(spots[p].people for p in ids)
    want = sorted((a, b, total(held[a] & held[b])) for a in held for b in held if a < b and held[a] & held[b])
    got = exposure.pair_overlaps(exposure.membership(points, areas, side), points, ["people"]).select("area_a", "area_b", "people").collect()
    assert len(want) > 100 and sorted(map(tuple, got)) == want
    shapes = areas.filter("area_id LIKE '%1'").select(F.col("area_id").alias("polygon_key"), "rings")
    want = sorted((a, b, total(held[a] & held[b])) for a in held for b in held if a.endswith("1") and held[a] & held[b])
    got = exposure.guidance_by_area(points, shapes, areas, side).select("polygon_key", "area_id", "people").collect()
    assert len(want) > 20 and sorted(map(tuple, got)) == want


def test_codes_of_areas_with_a_home_are_not_added_up_again(spark):
    points, areas = _world(spark)
    points = points.withColumn("ward", F.col("easting").cast("int") % 5)
    wide = spark.createDataFrame([("flood_alert", 500, ring((-40, -40), (400, -40), (400, 300), (-40, 300)))], areas.schema)
    members = exposure.membership(points.filter("point_id IS NOT NULL"), areas.filter("area_id <> 1").unionByName(wide), 25.0)
    codes, names = {"constituency": "pcon", "ward": "ward"}, spark.createDataFrame([("ward", "3", "three"), ("constituency", "a", "A")], "geography string, code string, name string")
    whole = lambda df: sorted((tuple(r) for r in df.select("kind", "area_id", "geography", "code", "people", "name", "share_of_area_people").collect()), key=str)
    figures = tiles.sums_in_areas(members.placed(points.select("point_id", "people").distinct()), members.pieces, 25.0, ["kind", "area_id"], ["people"])
    values = points.filter("point_id IS NOT NULL").distinct()
    want = whole(exposure.geography_shares(exposure.by_codes(members, values, codes, ["people"]), figures, names))
    found = exposure.by_codes(members, values, codes, ["addresses", "people"], total="people")
    assert len(want) > 200 and whole(exposure.geography_shares(found, None, names)) == want and any(r[1] == 500 for r in want)
    own = exposure.membership(points.filter("point_id IS NOT NULL"), areas.filter("area_id <> 1"), 25.0)
    shared = exposure.geography_shares(exposure.by_codes(own, values, codes, ["people"], total="people"), None, stored_table(names, "names"))
    assert shared.count() > 200 and not any(step in _above_the_tiles(shared) for step in ("SortMergeJoin", "Exchange hashpartitioning(kind", "Exchange hashpartitioning(area"))
