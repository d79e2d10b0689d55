"""Small hand-made inputs with known answers."""

import itertools
import random
import uuid
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.functions import place, risk, text
from freshet.operators import guards, proximity, spatial
from freshet.operators.kernels import common_area
from freshet.plans import briefing, exposure, grid, history, mapping, thresholds, timing
from freshet.sources import statements


def box(x0, y0, x1, y1):
    return [[{"x": float(x), "y": float(y)} for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]]


RINGS = "array<array<struct<x:double,y:double>>>"


def flat(rings):
    return np.array([(p["x"], p["y"], q["x"], q["y"]) for ring in rings for p, q in zip(ring[:-1], ring[1:])])


def test_common_area_of_known_shapes():
    cell = (0.0, 0.0, 16.0, 16.0)
    base, hole = flat(box(0, 0, 10, 10)), flat(box(0, 0, 10, 10) + box(2, 2, 4, 4))
    triangle = flat([[{"x": 0.0, "y": 0.0}, {"x": 10.0, "y": 0.0}, {"x": 0.0, "y": 10.0}, {"x": 0.0, "y": 0.0}]])
    everything = flat(box(-5, -5, 30, 30))
    assert common_area(base, flat(box(0, 0, 5, 10)), cell) == pytest.approx(50)
    assert common_area(base, flat(box(10, 0, 20, 10)), cell) == 0
    assert common_area(hole, everything, cell) == pytest.approx(96)
    assert common_area(hole, flat(box(0, 0, 4, 4)), cell) == pytest.approx(12)
    assert common_area(triangle, flat(box(0, 0, 5, 5)), cell) == pytest.approx(25)
    assert common_area(triangle, flat(box(5, 5, 10, 10)), cell) == pytest.approx(0, abs=1e-9)
    assert common_area(flat(box(0, 0, 10, 10) + box(12, 0, 14, 4)), everything, cell) == pytest.approx(108)


def wheel(n, x, y, r, seed):
    import math
    import random

    rnd = random.Random(seed)
    ring = [{"x": x + r * (1 + 0.002 * rnd.random()) * math.cos(2 * math.pi * i / n), "y": y + r * (1 + 0.002 * rnd.random()) * math.sin(2 * math.pi * i / n)} for i in range(n)]
    return [ring + ring[:1]]


def test_quarters_and_slabs_agree(monkeypatch):
    from freshet.operators import kernels

    a, b, cell = flat(wheel(14, 50, 50, 30, 1)), flat(wheel(15, 60, 50, 30, 2)), (0.0, 0.0, 100.0, 100.0)
    quartered = common_area(a, b, cell)
    monkeypatch.setattr(kernels, "FEW", 1000)
    assert common_area(a, b, cell) == pytest.approx(quartered, rel=1e-9)


def test_shapes_of_many_vertices_need_little_memory():
    import tracemalloc

    a, b = flat(wheel(20_000, 50, 50, 30, 1)), flat(wheel(20_000, 85, 50, 10, 2))
    tracemalloc.start()
    found = common_area(a, b, (60.0, 40.0, 80.0, 60.0))
    assert tracemalloc.get_traced_memory()[1] < 100e6 and 0 < found < 320
    tracemalloc.stop()


def test_overlap_of_real_shapes(spark):
    """An L, a box with a hole and a shape of two parts against a box, over several cells."""
    ell = [[{"x": float(x), "y": float(y)} for x, y in ((0, 0), (30, 0), (30, 10), (10, 10), (10, 30), (0, 30), (0, 0))]]
    shapes = [("ell", ell), ("holed", box(0, 0, 30, 30) + box(5, 5, 25, 25)), ("parts", box(0, 0, 10, 10) + box(20, 20, 30, 30)), ("whole", box(-7, -7, 50, 50))]
    base = spark.createDataFrame(shapes, f"id string, rings {RINGS}")
    other = spark.createDataFrame([(1, box(3, 3, 23, 23))], f"oid int, rings {RINGS}")
    want = {"ell": 7 * 20 + 7 * 13, "holed": 400 - 18 * 18, "parts": 49 + 9, "whole": 400}
    area = {"ell": 500, "holed": 500, "parts": 200, "whole": 57 * 57}
    for cell in (4.0, 7.0, 100.0):
        got = {r.id: (r.overlap_m2, r.share) for r in spatial.overlaps(base, other, ["id"], ["oid"], cell).collect()}
        assert got == {k: (pytest.approx(v), pytest.approx(v / area[k])) for k, v in want.items()}


def slow_common_area(a, b):
    """Slabs between all heights where edges end or meet, one by one."""
    edges = [(e, s) for s, shape in enumerate((a, b)) for e in flat(shape).tolist()]
    heights = {y for (x1, y1, x2, y2), _ in edges for y in (y1, y2)}
    for (p, _), (q, _) in itertools.combinations(edges, 2):
        d = (p[2] - p[0]) * (q[3] - q[1]) - (p[3] - p[1]) * (q[2] - q[0])
        if d:
            t = ((q[0] - p[0]) * (q[3] - q[1]) - (q[1] - p[1]) * (q[2] - q[0])) / d
            heights.add(p[1] + t * (p[3] - p[1]))
    total, cuts = 0.0, sorted(heights)
    for low, high in zip(cuts, cuts[1:]):
        y = (low + high) / 2
        xs = sorted((x1 + (x2 - x1) * (y - y1) / (y2 - y1), s) for (x1, y1, x2, y2), s in edges if (y1 <= y) != (y2 <= y))
        inside = [False, False]
        for (x, s), (following, _) in zip(xs, xs[1:]):
            inside[s] = not inside[s]
            total += (following - x) * (high - low) * all(inside)
    return total


def test_overlaps_of_random_shapes(spark):
    """Shapes with slanted, crossing and shared edges, many to a batch, over cells of several sizes."""
    rnd = random.Random(11)

    def ring(whole):
        x, y, at = rnd.randint(0, 60), rnd.randint(0, 60), lambda v: float(v if whole else v + rnd.random())
        points = [{"x": at(x + rnd.randint(-20, 20)), "y": at(y + rnd.randint(-20, 20))} for _ in range(rnd.randint(3, 9))]
        return points + points[:1]

    shapes = [[ring(k % 2) for _ in range(rnd.choice([1, 1, 2]))] for k in range(12)] + [wheel(16, 30, 30, 25, 3), box(0, 0, 60, 60), box(10, 10, 30, 30)]
    left = spark.createDataFrame(list(enumerate(shapes)), f"id int, rings {RINGS}")
    right = spark.createDataFrame(list(enumerate(shapes[6:])), f"oid int, rings {RINGS}")
    want = {(i, j): slow_common_area(a, b) for i, a in enumerate(shapes) for j, b in enumerate(shapes[6:])}
    size = {i: slow_common_area(a, a) for i, a in enumerate(shapes)}
    for cell in (9.0,):
        got = {(r.id, r.oid): (r.overlap_m2, r.share) for r in spatial.overlaps(left, right, ["id"], ["oid"], cell, 0.01).collect()}
        assert got == {k: (pytest.approx(v, rel=1e-6, abs=1e-6), pytest.approx(v / size[k[0]], rel=1e-6, abs=1e-6)) for k, v in want.items() if v >= 0.01}


def test_overlap_drops_touching_and_slivers(spark):
    base = spark.createDataFrame([("a", box(0, 0, 10, 10))], f"id string, rings {RINGS}")
    other = spark.createDataFrame([(1, box(0, 0, 5, 10)), (2, box(10, 0, 20, 10)), (3, box(9.9999, 0, 20, 10))], f"oid int, rings {RINGS}")
    rows = spatial.overlaps(base, other, ["id"], ["oid"], 4.0).select("oid", "share").collect()
    assert [(r.oid, round(r.share, 6)) for r in rows] == [(1, 0.5)]


def test_non_convex_membership_and_boundary(spark):
    u = [[{"x": float(x), "y": float(y)} for x, y in ((0, 0), (300, 0), (300, 300), (200, 300), (200, 100), (100, 100), (100, 300), (0, 300), (0, 0))]]
    areas = spark.createDataFrame([("u", u)], f"area_id string, rings {RINGS}")
    pts = spark.createDataFrame([(1, 50, 200), (2, 150, 200), (3, 250, 250), (4, 0, 10), (5, 150, 100), (6, 400, 50)], "point_id int, easting int, northing int")
    for cell in (40.0, 1000.0):
        got = spatial.points_in_areas(pts, areas, cell, ["area_id"]).select("point_id").collect()
        assert sorted(r.point_id for r in got) == [1, 3, 4, 5]


def test_area_exposure_example(spark):
    rows = [(1, 100, 2, 1, 0, 1, "nsul", 4, 2, "P1"), (2, 300, 4, 2, 1, 1, "nsul", 3, 2, "P1"), (3, 500, 6, 3, 1, 2, "nsul", 2, 1, "P1"),
            (4, 700, 8, 4, 2, 5, "nsul", 1, 0, "P2"), (5, 900, 10, 5, 2, 10, "nsul", 0, 0, "P2"), (6, 5000, 12, 6, 3, 3, "oa_centroid", 4, 2, "P3")]
    points = spark.createDataFrame(rows, "point_id int, easting int, people int, households int, over65 int, imd_decile int, point_source string, rofrs_rank int, fz_rank int, pcon string"
                                   ).withColumn("northing", F.lit(100))
    areas = spark.createDataFrame([("flood_warning", "A", box(0, 0, 600, 200)), ("flood_warning", "B", box(400, 0, 1000, 200)), ("flood_alert", "C", box(0, 0, 1000, 200))],
                                  f"kind string, area_id string, rings {RINGS}")
    members = exposure.membership(points, areas, 250.0)
    f = {r.area_id: r for r in exposure.area_figures(members, points).collect()}
    assert (f["A"].people_split, f["B"].people_split, f["A"].people_unique, f["C"].people_unique, f["C"].people_split) == (9, 21, 6, 30, 30)
    pair = exposure.pair_overlaps(members, points, ["addresses", "people"]).collect()
    assert [(r.area_a, r.area_b, r.people, r.addresses) for r in pair] == [("A", "B", 6, 1)]
    cov = {r.kind: r for r in exposure.distinct_coverage(exposure.point_flags(members, points, ["pcon"])).collect()}
    assert (cov["all"].people, cov["flood_warning"].people, cov["flood_warning"].people_high_medium_not_in_area) == (42, 30, 12)
    codes = {(r.area_id, r.code): r.people for r in exposure.by_codes(members, points, {"constituency": "pcon"}, ["people"]).collect()}
    assert (codes[("B", "P1")], codes[("B", "P2")]) == (6, 18)


def test_one_alert_episode(spark):
    raw = spark.createDataFrame([("011WAFX", "2026-06-01T09:00:00", "Flood alert"), ("011WAFX", "2026-06-02T09:30:00", "Warning no longer in force")], "TACode string, dateTime string, Severity string")
    events, report = history.read_messages(raw)
    episodes, periods = history.episodes_and_periods(events, F.lit("2026-06-10").cast("timestamp"))
    e, p = episodes.collect(), periods.collect()
    assert len(e) == len(p) == 1 and e[0].duration_minutes == 1470 and e[0].duration_hours == 24.5 and e[0].area_type == "flood_alert"
    assert (p[0].started_by, p[0].ended_by, e[0].episode_id) == ("issued", "no_longer_in_force", "011WAFX_20260601T0900")
    assert report.first()["kept"] == 2


def test_upgrade_downgrade_and_equal_times(spark):
    t = lambda h: datetime(2026, 6, 1) + timedelta(hours=h)
    rows = [("A", t(0), "flood_alert"), ("A", t(0), "flood_warning"), ("A", t(5), "severe_flood_warning"), ("A", t(8), "flood_warning"), ("A", t(9), "off"), ("A", t(10), "off")]
    events = spark.createDataFrame(rows, "area_code string, time timestamp, level string").withColumn("origin", F.lit("f")).withColumn("kind", F.lit("message"))
    episodes, periods = history.episodes_and_periods(events, F.lit("2026-07-30").cast("timestamp"))
    e = episodes.first()
    assert (e.start_level, e.peak_level, e.n_messages, e.severe_minutes, e.n_severe_periods) == ("flood_alert", "severe_flood_warning", 4, 180.0, 1)
    assert [(r.started_by, r.ended_by) for r in periods.orderBy("period_id").collect()] == [
        ("issued", "upgraded"), ("upgraded", "upgraded"), ("upgraded", "downgraded"), ("downgraded", "no_longer_in_force")]
    assert history.orphan_offs(events).first()[0] == 1


@pytest.mark.parametrize("values,hours", [([0, 3, 3, 2, 3, 0, 0, 0, 0, 0, 0, 0, 0, 3], [1, 13]), ([5, 5, 0], [])])
def test_upcrossings(spark, values, hours):
    start = datetime(2026, 1, 1)
    r = spark.createDataFrame([("m", start + timedelta(hours=i), float(v)) for i, v in enumerate(values)], "k string, t timestamp, v double")
    for chunk in (F.to_date("t"), F.date_trunc("hour", "t")):
        got = timing.upcrossings(r, ["k"], "t", "v", F.lit(3.0), 6.0, chunk).collect()
        assert sorted((x.crossed_at - start).total_seconds() / 3600 for x in got) == hours


def test_coverage_span_and_stale(spark):
    e = spark.createDataFrame([("e1", "A", datetime(2026, 1, 1), None, False), ("e2", "A", datetime(2026, 1, 1), None, True)],
                              "episode_id string, area_code string, start_time timestamp, end_time timestamp, stale_open boolean")
    n = {r.episode_id: r["count"] for r in history.episode_days(e, F.lit("2026-06-01").cast("timestamp"), 60).groupBy("episode_id").count().collect()}
    assert n == {"e1": 60, "e2": 1}
    assert history.episode_days(e, F.lit("2026-06-01").cast("timestamp")).count() == 152 + 1


def test_event_ids_match_the_standard(spark):
    keys = [f"area{i}|NEW|{i}" for i in range(50)]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select("k", text.url_event_id(F.col("k")).alias("u")).collect()
    assert all(r.u == str(uuid.uuid5(uuid.NAMESPACE_URL, r.k)) for r in rows)


def test_national_grid_position(spark):
    e, n = place.to_national_grid(F.lit(52.657977), F.lit(1.716038))
    r = spark.range(1).select(e.alias("e"), n.alias("n")).first()
    assert abs(r.e - 651409.8) < 10 and abs(r.n - 313177.3) < 10


def test_tile_round_trip(spark):
    r = spark.createDataFrame([(430000, 560000)], "e int, n int").select(place.tile_code(F.col("e"), F.col("n")).alias("t")).select(
        "t", place.tile_west(F.col("t")).alias("w"), place.tile_south(F.col("t")).alias("s")).first()
    assert (r.t, r.w, r.s) == ("NZ05", 400000, 550000)


def test_gauge_code_positions(spark):
    r = spark.createDataFrame([("5338N011W",), ("nonsense",)], "c string").select(place.gauge_positions(F.col("c")).alias("p")).collect()
    found = {(round(p.lat, 2), round(p.lon, 2)) for p in r[0].p}
    assert (53.63, -0.18) in found and (53.63, -1.02) in found and r[1].p == []


def test_clusters_chain_and_crowded_cells(spark):
    rows = [(i, float(i * 250), 0.0, "x" * (10 - i)) for i in range(4)] + [(10, 5000.0, 0.0, "far")] + [(100 + i, 9000.0, 9000.0, "same place") for i in range(20)]
    sites = spark.createDataFrame(rows, "id int, easting double, northing double, name string")
    kept = proximity.merge_clusters(sites, "id", 300.0).select("id").collect()
    assert sorted(r.id for r in kept) == [3, 10, 100]


def test_statement_rows_and_malformed(spark):
    body = ('{"id":7,"issued_at":"2026-01-05T10:30:00Z","risk_areas":[{"id":1,"risk_area_blocks":[{"id":11,"days":[1,3],"risk_levels":{"river":[4,4],"coastal":"x"},'
            '"polys":[{"id":5,"type":"polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]},{"id":6,"type":"polyline","coordinates":[[0,0],[1,1]]}]}]}]}')
    s = statements.parse_statements(spark.createDataFrame([(body,)], "body string"))
    rows = statements.risk_polygons(s, F.lit("now")).collect()
    assert len(rows) == 4 and {r.geometry_type for r in rows} == {"Polygon", "LineString"}
    assert {(r.day_index, r.forecast_date, r.risk_level, r.risk_colour) for r in rows} == {(1, "2026-01-05", "High", "Red"), (3, "2026-01-07", "High", "Red")}
    assert statements.malformed_levels(s).first()["skipped"] == 2


def _register(spark, rows):
    return spark.createDataFrame(rows, "measure_uri string, station_reference string, parameter string, qualifier string, period string, unit_name string, value_type string")


def test_matching_stages(spark):
    reg = _register(spark, [
        ("u1", "022006", "Water Level", "Stage", "900", "mASD", "instantaneous"), ("u2", "022006", "Water Level", "Logged", "900", "mASD", "instantaneous"),
        ("u3", "067_TG_148", "Rainfall", None, "900", "mm", "total"), ("u4", "S4", "Flow", "", "900", "m3/s", "mean"), ("u5", "S4", "Flow", "", "86400", "m3/s", "mean"),
        ("u6", "S6", "Water Level", "Stage", "900", "mAOD", "x"), ("u7", "S6", "Water Level", "Stage", "900", "mASD", "x"), ("u8", "S8", "Groundwater level", "", "900", "m", "x")])
    raw = spark.createDataFrame([
        ("1", "22006", "Water Level", "H.obs"), ("2", "067_TG 148", "Rainfall", "P.obs"), ("3", "S4", "Flow", "Q.obs"), ("4", "S6", "Water Level", None), ("5", "S8", "Stage", None),
        ("6", "S4", "Rainfall", None), ("7", "zz", "Flow", None), ("8", None, "Flow", None), ("9", "S4", "Flow", "H.obs"), ("10", "S4", "odd", None)],
        "ID string, TelemetryID string, TelemetryParameter string, ParameterID string")
    got = mapping.match(mapping.prepare_mapping(raw), reg)
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r.id, []).append((r.match_status, r.measure_uri))
    assert by_id["1"] == [("matched", "u1")] and by_id["2"] == [("matched", "u3")] and by_id["5"] == [("matched", "u8")]
    assert sorted(by_id["3"]) == [("ambiguous", "u4"), ("ambiguous", "u5")] and sorted(by_id["4"]) == [("matched", "u6"), ("matched", "u7")]
    assert [by_id[i][0][0] for i in ("6", "7", "8", "9", "10")] == ["no_parameter", "no_station", "no_telemetry_id", "conflict", "unknown_parameter"]
    activity = spark.createDataFrame([("u5", 9, datetime(2026, 1, 1), datetime(2026, 2, 1))], "measure_uri string, n_readings long, first_reading timestamp, last_reading timestamp")
    settled = mapping.settle_by_readings(got, activity, F.lit("2026-02-02").cast("timestamp")).filter("id = '3'").collect()
    assert [(r.match_status, r.measure_uri) for r in settled] == [("matched", "u5")]


def test_threshold_units(spark):
    maps = spark.createDataFrame([("1", "level", None, "u1", "mASD"), ("1", "level", None, "u2", "m"), ("2", "level", None, "u3", "mAOD")],
                                 "fffs_id string, telemetry_family string, code_family string, measure_uri string, unit_name string")
    raw = spark.createDataFrame([("a", "01", "mALD", "2.5", "0"), ("b", "2", "mALD", "2.5", "10"), ("c", "2", "mALD", "2.5", "0"), ("d", "9", "mALD", "1", "1")],
                                "ID string, Loc string, Unit string, Value string, Z string").withColumn("B", F.lit("Observed")).withColumn("C", F.lit("flood warning")).withColumn("P", F.lit("H.obs"))
    thr = thresholds.prepare(raw, {"id": "ID", "location": "Loc", "unit": "Unit", "value": "Value", "z": "Z", "basis": "B", "catdesc": "C", "parameter": "P"})
    got = {r.threshold_id: (r.link_status, r.unit_match, r.measure_uri, r.value_in_measure_unit) for r in thresholds.link(thr, maps, thresholds.aliases(None, spark)).collect()}
    assert got["a"] == ("linked", "datum_assumed", "u1", 2.5) and got["b"] == ("linked", "converted", "u3", 12.5)
    assert got["c"][0] == "unit_mismatch" and got["d"][0] == "no_gauge"


def test_areas_sentence(spark):
    s = briefing.areas_sentence(F.lit(2), F.lit(1), F.lit("Medium"), F.array(F.lit("river"), F.lit("coastal")))
    assert spark.range(1).select(s.alias("s")).first().s == (
        "2 flood warning areas and 1 flood alert area lie under the forecast Medium coastal and river flood risk. "
        "These are places where the Environment Agency could issue a flood warning or alert if the risk is realised.")


def test_totals_are_conserved(spark):
    areas = spark.createDataFrame([(1, box(0, 0, 1000, 500), 10.0), (2, box(10, 10, 20, 20), 7.0)], f"id int, rings {RINGS}, people double")
    cells = grid.apportion(areas, ["people"])
    assert cells.agg(F.sum("people")).first()[0] == pytest.approx(17.0) and cells.count() == 50


def test_guards(spark):
    small, large = spark.range(5), spark.range(100)
    with pytest.raises(guards.Refused):
        guards.guard_row_count(small, large)
    with pytest.raises(guards.Refused):
        guards.guard_empty_feed(small.limit(0), large, 50)
    with pytest.raises(guards.Refused):
        guards.guard_truncation(large, limit=100)
    assert risk.MATRIX_RANKS[3][3] == 4


def test_past_statement_text_family(spark):
    r = spark.createDataFrame([("Groundwater Level", "GW.obs"), ("Water Level", "GW.obs"), ("Flow", "H.obs")], "t string, c string").select(
        text.reconciled_family(text.text_family(F.col("t")), text.code_family(F.col("c"))).alias("f")).collect()
    assert [x.f for x in r] == ["groundwater", "groundwater", None]


def test_spans_of_odd_shapes(spark):
    """Holes, two parts, slanted edges, corners and level edges on the centres of pixels, against every pixel's own test."""
    from freshet.operators import spans

    ring = lambda *p: [{"x": float(x), "y": float(y)} for x, y in (*p, p[0])]
    shapes = [(1, "a", 1, box(0, 0, 95, 95) + box(15, 15, 35, 45)), (2, "a", 3, [ring((5, 5), (88, 20), (40, 91))]), (3, "a", 3, [ring((5, 5), (88, 20), (40, 91))]),
              (4, "b", 2, box(-25, -25, 25, 25) + box(45, 45, 85, 55)), (5, "b", 4, [ring((0, 0), (60, 60), (60, 0), (0, 60))]), (6, "b", 1, box(1, 1, 3, 3))]
    df = spark.createDataFrame(shapes, f"id int, source string, rank int, rings {RINGS}")
    centres = [(i, j, i * 10 + 5.0, j * 10 + 5.0) for i in range(-4, 11) for j in range(-4, 11)]
    pixels = spark.createDataFrame(centres, "i int, j int, x double, y double")
    inside = df.crossJoin(pixels).filter(spatial.contains(spatial.edges(F.col("rings")), F.col("x"), F.col("y"), False))
    for shape_id in (None, "id"):
        filled = spans.pixels(spans.filled(df, 10.0, ["source", "rank"], shape_id))
        assert sorted(map(tuple, filled.collect())) == sorted((r.source, r["rank"], r.i, r.j) for r in inside.collect())
    painted = grid.paint(df, 10.0, "id")
    want = {(r.source, r.i, r.j): r.worst for r in inside.groupBy("source", "i", "j").agg(F.max("rank").alias("worst")).collect()}
    assert {(r.source, r.pixel_x, r.pixel_y): r["rank"] for r in spans.pixels(painted).collect()} == want
    held = grid.with_hazard_ranks(pixels.select("i", "j", F.col("x").alias("easting"), F.col("y").alias("northing")), painted, {"a": "ra", "b": "rb"}, 10.0).collect()
    assert all((r.ra, r.rb) == (want.get(("a", r.i, r.j), 0), want.get(("b", r.i, r.j), 0)) for r in held) and len(held) == len(centres)


def test_a_large_shape_makes_few_span_rows(spark):
    df = spark.createDataFrame([("a", 2, wheel(500, 30_000, 30_000, 25_000, 4))], f"source string, rank int, rings {RINGS}")
    painted = grid.paint(df, 10.0)
    assert painted.count() <= 5100
    assert painted.agg(F.sum(F.col("x_to") - F.col("x_from") + 1)).first()[0] > 19e6        # pixels in those rows
