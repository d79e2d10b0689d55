"""Work that has to be dealt to all tasks and grow with the input: plans, batches, documents, pairs."""

import random

import pytest
from pyspark.sql import functions as F

from freshet.bindings import load, streams
from freshet.bindings.base import QUERIES
from freshet.operators import spans, spatial
from freshet.plans import grid
from freshet.session import scratch_path
from freshet.sources import places
from freshet.streaming import feeds

RINGS = "array<array<struct<x:double,y:double>>>"


def box(x0, y0, x1, y1):
    return [[{"x": float(x), "y": float(y)} for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_inner_points_are_worked_out_for_small_areas_only(spark):
    at = scratch_path(spark, "boxes")
    spark.createDataFrame([(1, 0.0, 0.0, 300.0, 200.0), (2, 310.0, 10.0, 330.0, 30.0)], "id int, x0 double, y0 double, x1 double, y1 double").write.parquet(at)
    from freshet.functions.place import box_rings

    areas = spark.read.parquet(at).select("id", box_rings(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]).alias("rings"))
    owned = spans.owned_cells(areas, "id", 100.0)
    assert sorted(map(tuple, owned.collect())) == sorted([*[(1, x, y) for x in range(3) for y in range(2)], (2, 3, 0)])
    cells = owned.select("id", (F.col("cell_y") * 10000 + F.col("cell_x")).alias("cell_key"))
    total = grid.union_total(spark.createDataFrame([(0, 5.0), (7, 1.0)], "cell_key long, people double"), cells, ["people"])
    assert total.first()[0] == 5.0 and "part=" not in plan_of(total) and at not in plan_of(total)


def test_precedence_does_not_broadcast_the_areas(spark):
    meta = spark.range(5).select("id", F.lit(True).alias("in_force"))
    plan = plan_of(grid.primary_area(spark.range(9).select("id", F.lit(1).alias("cell_key")), meta))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_a_trigger_takes_a_poll_of_many_files(spark):
    landing, out, check = (scratch_path(spark, n) for n in ("landing", "out", "check"))
    rows = spark.range(600).select(F.col("id").alias("k"), F.timestamp_seconds(F.col("id")).alias("ts")).repartition(7)
    def run(files):
        feeds.run_available(lambda: feeds.serve_latest(feeds.latest_per_key(streams._polled(spark, landing, files), ["k"], "ts", []), out, check))

    streams._in_polls(rows, landing, run)
    assert len(spark.read.parquet(landing).inputFiles()) == 21
    assert spark.read.parquet(out).groupBy("batch").count().count() == 3 and spark.read.parquet(out).count() == 600


def test_features_come_in_documents_of_bounded_size(spark, monkeypatch, tmp_path):
    load()
    spark.range(3000).select(F.col("id").alias("s_suppkey"), F.concat(F.lit("n"), "id").alias("s_name"), F.lit(3).alias("s_nationkey")).write.parquet(str(tmp_path / "supplier.parquet"))
    seen, read = [], places.geojson_features
    monkeypatch.setattr(places, "geojson_features", lambda docs, names: seen.append(docs) or read(docs, names))
    rows = QUERIES["s05_geojson_features"](spark, str(tmp_path))
    assert rows.distinct().count() == 3000 and seen[0].count() == 7 and seen[0].filter(F.length("body") > 200_000).count() == 0


def _shapes(spark, n, seed, columns):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y, w, h = rng.randrange(0, 300), rng.randrange(0, 300), rng.randrange(5, 90), rng.randrange(5, 90)
        bent = [[{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + w, y), (x + w, y + h), (x + w / 2, y + h / 3), (x, y + h), (x, y))]]
        rows.append((i, bent if i % 2 else box(x, y, x + w, y + h)))
    return spark.createDataFrame([*rows, rows[3], (None, rows[4][1])], f"{columns} long, rings {RINGS}")


def test_whole_shapes_measure_as_cells_do(spark, monkeypatch):
    a, b = _shapes(spark, 30, 1, "area_id"), _shapes(spark, 30, 2, "box_id")
    rows = {}
    for simple in (0, 5, 32):
        monkeypatch.setattr(spatial, "SIMPLE", simple)
        found = spatial.overlaps(a, b, ["area_id"], ["box_id"], 40.0)
        rows[simple] = sorted(((r.area_id, -1 if r.box_id is None else r.box_id, round(r.overlap_m2, 6), round(r.share, 6)) for r in found.collect()))
    assert len(rows[0]) > 50 and all([r[:2] for r in rows[n]] == [r[:2] for r in rows[0]] for n in (5, 32))
    for n in (5, 32):
        assert [v for r in rows[n] for v in r[2:]] == pytest.approx([v for r in rows[0] for v in r[2:]], rel=1e-6)


def test_pairs_of_whole_shapes_are_not_shuffled_or_broadcast(spark):
    a, b = _shapes(spark, 6, 1, "area_id").limit(6), _shapes(spark, 6, 2, "box_id").limit(6)
    plan = plan_of(spatial.overlaps(a, b, ["area_id"], ["box_id"], 40.0))
    top = plan[:plan.index("SortMergeJoin")]
    assert "Exchange" not in top and "Aggregate" not in top


@pytest.mark.parametrize("some", [1 << 18, 7])
def test_lines_near_areas_edges_in_parts(spark, monkeypatch, some):
    from freshet.operators import kernels

    import numpy as np
    import pyarrow as pa

    rng = random.Random(4)
    shapes = [[float(v) for e in zip(p, p[1:]) for c in e for v in c] for p in (
        [(rng.randrange(100), rng.randrange(100)) for _ in range(rng.randrange(1, 9))] for _ in range(200))]
    shapes = [s + s[-2:] + s[:2] if s else s for s in shapes]
    lines = np.array([[rng.randrange(100) for _ in range(4)] for _ in shapes], dtype=float)
    monkeypatch.setattr(kernels, "EDGES", some)
    columns = [pa.array(c) for c in lines.T]
    got = kernels.segment_near.func(*columns, pa.array(shapes, pa.list_(pa.float64())), pa.array([6.0] * len(shapes))).to_pylist()
    want = [bool(kernels._near(lines[i:i + 1], np.array(s).reshape(-1, 4), np.zeros(len(s) // 4, int), 1, 6.0)[0]) for i, s in enumerate(shapes)]
    assert got == want and 20 < sum(got) < 190
    plan = plan_of(spatial.lines_near_areas(spark.createDataFrame([(1, [(0.0, 0.0), (9.0, 0.0)])], "line_id int, path array<struct<x:double,y:double>>"),
                                            _shapes(spark, 5, 5, "area_id"), 2.0, ["line_id"], ["area_id"], 40.0))
    assert "ArrowEvalPython" in plan and "SortMergeJoin" in plan


def test_levels_are_read_before_days_multiply_the_rows(spark):
    from freshet.sources import statements

    at = scratch_path(spark, "bodies")
    body = '{"id":1,"issued_at":"2024-01-01T10:30:00Z","risk_areas":[{"id":2,"risk_area_blocks":[{"id":3,"days":[1,2,3],"risk_levels":{"river":[2,2],"sea":"none"},"polys":[]}]}]}'
    spark.createDataFrame([(body,)], "body string").write.parquet(at)
    typed = statements.parse_statements(spark.read.parquet(at))
    assert statements.malformed_levels(typed).first().asDict() == {"entries": 6, "skipped": 3}
    rows = statements.block_rows(typed, F.lit("now"))
    assert rows.count() == 3
    lines = plan_of(rows).splitlines()
    read = [i for i, line in enumerate(lines) if "from_json(ArrayType" in line]
    unfolded = [i for i, line in enumerate(lines) if "Generate explode" in line]        # the last to be unfolded stands first
    assert read and min(read) > min(unfolded)


def test_thresholds_are_worked_out_once(spark):
    from freshet.plans import thresholds

    at = scratch_path(spark, "thresholds")
    names = {"id": "ID", "location": "Loc", "basis": "B", "catdesc": "C", "parameter": "P", "unit": "U", "value": "V", "z": "Z"}
    raw = [("1", "007", "observed", "Flood Warning", "H.obs", "mASD", "1.5", "0")]
    spark.createDataFrame(raw, ", ".join(f"{c} string" for c in names.values())).write.parquet(at)
    mapped = spark.createDataFrame([("007", "level", None, "u1", "mASD")], "fffs_id string, telemetry_family string, code_family string, measure_uri string, unit_name string")
    linked = thresholds.link(thresholds.prepare(spark.read.parquet(at), names), mapped, thresholds.aliases(None, spark))
    assert at not in plan_of(linked)
    assert [(r.threshold_id, r.link_status, r.measure_uri) for r in linked.collect()] == [("1", "linked", "u1")]


def test_stations_of_one_name_are_dealt_to_many_tasks(spark):
    from freshet.plans import mapping

    names = spark.range(700).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("red bolt "), (F.col("id") + 10).cast("string")).alias("name"))
    stations = spark.range(60).select(F.col("id").cast("string").alias("station_reference"), F.when(F.col("id") < 50, "red bolt").otherwise("green nut").alias("label"))
    found = mapping.similar_names(names, stations, 0.6)
    assert found.groupBy("id").count().filter("count = 50").count() == 700 and found.count() == 700 * 50
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "b_tokens" in line and "Inner" in line]        # the list of hot keys may be broadcast
    assert joins and all("SortMergeJoin" in line and "_salt" in line for line in joins), plan


def test_the_list_by_name_is_not_grouped_again(spark):
    from freshet.plans import mapping

    rows = spark.createDataFrame([("1", "t1", None, "red bolt 1"), ("2", "s7", None, "red bolt 2"), (None, "s8", None, "red bolt 3"), ("3", "t3", None, "tall oak")],
                                 "id string, telemetry_id string, wiski_id string, location_name string")
    stations = spark.createDataFrame([("s7", "n7", "red bolt"), ("s7", "n7", "red bolt"), ("s8", "n8", "red bolt"), ("s9", "n9", "oak tall")], "station_reference string, notation string, label string").withColumns(
        {"rloi_id": F.lit(None).cast("string"), "wiski_id": F.lit(None).cast("string")})
    found = mapping.station_candidates(rows, stations, stations.filter("station_reference <> 's8'").select("station_reference"), 0.6)
    assert sorted((r.id or "", r.how, r.candidate_station_reference, r.candidate_in_register) for r in found.collect()) == [
        ("", "same after tidy-up", "s8", False), ("", "similar name", "s7", True), ("1", "similar name", "s7", True), ("1", "similar name", "s8", False),
        ("2", "same after tidy-up", "s7", True), ("3", "similar name", "s9", True)]


@pytest.mark.parametrize("listed", [256, 5])
def test_pairs_of_areas_in_cells_are_summed_in_their_first_cell(spark, monkeypatch, listed):
    from freshet.operators import pairs

    for name, value in {"LISTED": listed, "MEMBERS": 7, "PLACES": 3, "SUMS": 24}.items():
        monkeypatch.setattr(pairs, name, value)
    rng = random.Random(5)
    cells = [(i, k) for i in range(30) for k in rng.sample(range(25), rng.randrange(1, 9))]
    rows = [*cells, cells[0], (3, None), (4, None), (None, 2), (None, None)]
    values = {k: [(2.5, 1.0)] for k in range(20)} | {0: [(1.0, None), (4.0, 2.0)], 7: [(float("inf"), 1.0)]}
    found = grid.cell_pair_overlaps(spark.createDataFrame(rows, "id long, cell_key long"), spark.createDataFrame([(k, *v) for k, vs in values.items() for v in vs], "cell_key long, people double, homes double"),
                                    ["people", "homes"])
    held = {i: {k for a, k in rows if a == i} for i in range(30)}
    want = []
    for a in held:
        for b in held:
            if a < b and (both := held[a] & held[b]):
                sums = [sum(v[m] or 0.0 for k in both for v in values.get(k, [])) for m in (0, 1)]
                n = sum(len(values.get(k, [0])) for k in both)
                want.append((a, b, n, *sums, round(n / len(held[a]), 4), round(n / len(held[b]), 4)))
    got = sorted(map(tuple, found.collect()))
    assert len(want) > 200 and [r[:5] for r in got] == [r[:5] for r in want] and [r[5:] for r in got] == [pytest.approx(r[5:], abs=1e-4) for r in want]
    plan = plan_of(found)
    assert listed < 256 or not any(step in plan[:plan.index("FlatMapGroupsInArrow")] for step in ("Exchange", "Aggregate"))


def test_short_lines_meet_areas_whole(spark, monkeypatch):
    rng = random.Random(9)
    paths = [(i, [(float(rng.randrange(300)), float(rng.randrange(300)))] * (1 if i == 7 else 2)) for i in range(12)]
    paths = [(i, [(x + 9 * k, y + rng.randrange(12)) for k, (x, y) in enumerate(p * (1 + i % 3))]) for i, p in paths]
    lines = lambda rows: spark.createDataFrame(rows, "line_id int, path array<struct<x:double,y:double>>")
    areas = _shapes(spark, 30, 6, "area_id")
    rows = {}
    for short in (-1, 4, 100):
        monkeypatch.setattr(spatial, "SHORT", short)
        rows[short] = sorted(map(str, spatial.lines_near_areas(lines([*paths, paths[2], (None, paths[3][1])]), areas, 6.0, ["line_id"], ["area_id"], 40.0).collect()))
    assert len(rows[4]) > 20 and rows[4] == rows[-1] == rows[100] and len(set(rows[4])) == len(rows[4])
    plan = plan_of(spatial.lines_near_areas(lines(paths), areas.filter("area_id <> 3"), 6.0, ["line_id"], ["area_id"], 40.0))
    assert not any(step in plan[:plan.index("SortMergeJoin")] for step in ("Exchange", "Aggregate"))
