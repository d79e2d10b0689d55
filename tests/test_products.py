"""Exposure tables of one membership, and the states of the health checks."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from freshet.plans import exposure, health

NOW = datetime(2024, 1, 31)
RINGS = "array<array<struct<x:double,y:double>>>"


def box(x0, y0, x1, y1):
    return [[{"x": float(x), "y": float(y)} for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]]


def one(check):
    return check.frame.first().asDict()


def _suite(spark):
    points = spark.createDataFrame(
        [(1, 10.0, 10.0, 8.0, 4, "A", "x"), (2, 60.0, 10.0, 2.0, 1, "B", "x"), (3, 900.0, 900.0, 5.0, 3, "B", "y"), (4, 20.0, 20.0, 0.0, 0, None, "z")],
        "point_id long, easting double, northing double, people double, rofrs_rank int, pcon string, lad string")
    areas = spark.createDataFrame([("flood_warning", "w1", box(0, 0, 50, 50)), ("flood_warning", "w2", box(0, 0, 100, 50)), ("flood_alert", "a1", box(0, 0, 100, 100)),
                                   ("flood_alert", "far", box(5000, 5000, 5100, 5100))], f"kind string, area_id string, rings {RINGS}")
    lookup = spark.createDataFrame([("x", "north")], "district string, authority string")
    return exposure.AreaSuite(points, areas, {"constituency": "pcon", "district": "lad"}, {"fire": ("lad", lookup, "district", "authority")})


def test_area_exposure_lists_every_area(spark):
    sites = spark.createDataFrame([(7, 10.0, 10.0, "s", "health", 4, 2)], "site_id long, easting double, northing double, name string, site_group string, rofrs_rank int, fz_rank int")
    cells = spark.createDataFrame([(0.0, 0.0, 3.0, 10.0), (100.0, 0.0, 1.0, 90.0)], "easting double, northing double, people double, risk_score double")
    got = {r.area_id: r for r in _suite(spark).area_exposure(sites, cells).collect()}
    assert set(got) == {"w1", "w2", "a1", "far"}
    assert (got["w1"].people, got["w1"].people_unique, got["w1"].people_split) == (8.0, 0.0, 4.0)
    assert (got["w2"].people, got["w2"].people_unique, got["w2"].people_split, got["w2"].people_shared) == (10.0, 2.0, 6.0, 8.0)
    assert (got["a1"].people, got["a1"].people_unique, got["a1"].sites_health, got["a1"].grid_cells, got["a1"].risk_score) == (10.0, 10.0, 1, 1, 10.0)
    assert (got["far"].people, got["far"].sites, got["far"].grid_cells, got["far"].risk_score, got["far"].share_people_shared) == (0.0, 0, 0, None, None)


def test_geographies_through_codes_and_lookups(spark):
    suite = _suite(spark)
    names = spark.createDataFrame([("fire", "north", "North"), ("fire", "north", "Northern")], "geography string, code string, name string")
    rows = {(r.area_id, r.geography, r.code): (r.people, r.name, r.share_of_area_people) for r in suite.area_geographies(names).collect()}
    assert rows[("w2", "fire", "north")] == (10.0, "North", 1.0) and rows[("w2", "constituency", "B")] == (2.0, None, 0.2)
    assert ("w2", "fire", "z") not in rows and not any(code in (None, "") for _, _, code in rows)
    whole = {(r.geography, r.code): r.people for r in suite.geographies(names).collect()}
    assert whole[("constituency", "B")] == 7.0 and whole[("fire", "north")] == 10.0 and whole[("district", "y")] == 5.0
    pairs = suite.area_pairs().collect()
    assert [(r.area_a, r.area_b, r.people) for r in pairs] == [("w1", "w2", 8.0)]
    covered = {r.kind: (r.people, r.people_not_in_area) for r in suite.coverage().collect()}
    assert covered == {"all": (15.0, 0.0), "flood_warning": (10.0, 5.0), "flood_alert": (10.0, 5.0)}


def test_states_of_the_products_check(spark):
    now, schema = F.lit(NOW), "product string, built_at timestamp"
    areas = spark.range(10)

    def state(built, have=10):
        return one(health.products_check("p", spark.createDataFrame(built, schema), ["a", "b"], spark.range(have), areas, now, 30.0))

    fresh, old = NOW - timedelta(days=2), NOW - timedelta(days=40)
    assert state([]) == {"status": "info", "value": "not built", "detail": "no product yet"}
    assert state([("a", fresh), ("b", old), ("b", fresh), ("other", old)]) == {"status": "ok", "value": "2 days", "detail": "10 rows for 10 areas"}
    assert state([("a", fresh)])["detail"] == "missing: b"
    assert state([("a", fresh), ("b", old)], 8) == {"status": "warn", "value": "40 days", "detail": "oldest is 40 days old, warn over 30; 8 rows for 10 areas"}


def test_totals_and_quiet_feeds(spark):
    df = spark.createDataFrame([(1500.5, NOW - timedelta(hours=3))], "n double, t timestamp")
    assert one(health.range_check("r", df, F.sum("n"), 1000, 2000))["status"] == "ok"
    assert one(health.range_check("r", df, F.sum("n"), 2000, 3000)) == {"status": "warn", "value": "1,500"}
    assert one(health.range_check("r", df.limit(0), F.sum("n"), 0, 3000)) == {"status": "warn", "value": ""}
    assert one(health.quiet_age_check("q", df, "t", F.lit(NOW), "")) == {"status": "info", "value": "3.0 h"}
    assert one(health.quiet_age_check("q", df.limit(0), "t", F.lit(NOW), "")) == {"status": "info", "value": ""}
    assert one(health.age_check("a", df, "t", F.lit(NOW), 2.0, 4.0)) == {"status": "warn", "value": "3.0 h"}
    assert one(health.age_check("a", df.limit(0), "t", F.lit(NOW), 2.0, 4.0)) == {"status": "fail", "value": ""}


def test_report_takes_the_detail_of_the_row(spark):
    built = spark.createDataFrame([("a", NOW)], "product string, built_at timestamp")
    checks = [health.products_check("p", built, ["a", "b"], spark.range(1), spark.range(1), F.lit(NOW), 30.0),
              health.count_check("c", spark.range(3), F.count(F.lit(1)), [(F.col("n") >= 5, "ok")], "expected at least 5", "fail")]
    rows = {r.check_name: r for r in health.report(checks).collect()}
    assert (rows["p"].status, rows["p"].detail) == ("warn", "missing: b")
    assert (rows["overall"].status, rows["overall"].detail) == ("fail", "worst of the checks above; failing: c")
