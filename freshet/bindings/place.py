"""Spatial joins, cells, tiles, hazard and sites."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.bindings.base import PLACES_SQL, areas, points, query, site_boxes, sites, table, with_ctes
from freshet.functions import place, risk
from freshet.operators import proximity, spans, spatial
from freshet.plans import forecast, grid
from freshet.sources import places

PLACES = with_ctes(PLACES_SQL)


# ---- points and areas ----------------------------------------------------------------------------------------


@query("j12_points_in_areas", PLACES + "SELECT kind, area_id, point_id FROM members_of")
def _(spark, d):
    return spatial.points_in_areas(points(spark, d), areas(spark, d), 1000.0, ["kind", "area_id"], keep_points=["point_id"]).select("kind", "area_id", "point_id")


OVERLAP_SQL = PLACES + """,
pairs AS (SELECT a.area_id, b.box_id, a.kind, b.s_nationkey, (least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS common,
            (a.x1 - a.x0) * (a.y1 - a.y0) AS base FROM areas a JOIN site_boxes b ON a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1)"""


@query("j13_polygon_overlap_with_share", OVERLAP_SQL + " SELECT area_id, box_id, round(CAST(common AS DOUBLE), 3) AS overlap_m2, round(common / base, 9) AS share FROM pairs WHERE common >= 1")
def _(spark, d):
    found = spatial.overlaps(areas(spark, d), site_boxes(spark, d), ["area_id"], ["box_id"], 2000.0)
    return found.select("area_id", "box_id", F.round("overlap_m2", 3).alias("overlap_m2"), F.round("share", 9).alias("share"))


def _shapes(spark, d):
    source = F.element_at(F.array(F.lit("river"), F.lit("coastal"), F.lit("ground"), F.lit("surface")), (F.col("s_nationkey") % 4 + 1).cast("int"))
    shapes = site_boxes(spark, d).select(F.lit(1).alias("statement_id"), F.col("box_id").alias("poly_id"), source.alias("source"), "rings")
    codes = F.array(*[F.lit(c) for c in ("FWF", "WAC", "FWB", "FAG")])
    coded = areas(spark, d).select(F.col("area_id").alias("area_code"), F.element_at(codes, (F.col("area_id") % 4 + 1).cast("int")).alias("type_code"), "rings")
    return shapes, coded


SHAPES_SQL = OVERLAP_SQL + """,
linked AS (SELECT area_id, box_id, common / base AS share, CASE s_nationkey % 4 WHEN 0 THEN 'river' WHEN 1 THEN 'coastal' WHEN 2 THEN 'ground' ELSE 'surface' END AS source,
             CASE area_id % 4 WHEN 0 THEN 'FWF' WHEN 1 THEN 'WAC' WHEN 2 THEN 'FWB' ELSE 'FAG' END AS type_code FROM pairs WHERE common >= 1)"""


@query("j14_forecast_shape_by_source", SHAPES_SQL + """
SELECT area_id AS area_code, box_id AS poly_id, source, round(share, 6) AS share FROM linked WHERE share >= 0.25
  AND ((source = 'river' AND type_code IN ('FWF', 'FWB')) OR (source = 'coastal' AND type_code IN ('WAC', 'FWB')) OR (source = 'ground' AND type_code = 'FAG'))""")
def _(spark, d):
    shapes, coded = _shapes(spark, d)
    return forecast.shape_area_links(shapes, coded, 2000.0, 0.25, True).select("area_code", "poly_id", "source", F.round("share", 6).alias("share"))


@query("j15_forecast_shape_any_overlap", SHAPES_SQL + " SELECT area_id AS area_code, box_id AS poly_id, source, round(share, 6) AS share FROM linked")
def _(spark, d):
    shapes, coded = _shapes(spark, d)
    return forecast.shape_area_links(shapes, coded, 2000.0, None, False).select("area_code", "poly_id", "source", F.round("share", 6).alias("share"))


@query("p01_area_to_constituency_lookup", OVERLAP_SQL + " SELECT area_id, s_nationkey AS constituency_id, round(sum(common / base), 5) AS share FROM pairs WHERE common >= 1 GROUP BY 1, 2")
def _(spark, d):
    found = spatial.overlaps(areas(spark, d), site_boxes(spark, d), ["area_id"], ["box_id", "s_nationkey"], 2000.0)
    return found.groupBy("area_id", F.col("s_nationkey").alias("constituency_id")).agg(F.round(F.sum("share"), 5).alias("share"))


@query("p02_statement_intersections", SHAPES_SQL + """
SELECT source, type_code, count(*) AS links, count(*) FILTER (share >= 0.25) AS strong FROM linked GROUP BY source, type_code""")
def _(spark, d):
    shapes, coded = _shapes(spark, d)
    found = forecast.shape_area_links(shapes, coded, 2000.0, None, False).join(coded.select("area_code", "type_code"), "area_code")
    return found.groupBy("source", "type_code").agg(F.count(F.lit(1)).alias("links"), F.count_if(F.col("share") >= 0.25).alias("strong"))


@query("j16_widened_line_overlap", PLACES + """,
lines AS (SELECT s_suppkey AS line_id, (s_suppkey * 7919) % 90000 AS xa, (s_suppkey * 7919) % 90000 + 5000 AS xb, (s_suppkey * 104729) % 95000 AS y FROM supplier)
SELECT line_id, area_id FROM lines l JOIN areas a ON pow(greatest(0, a.x0 - l.xb, l.xa - a.x1), 2) + pow(greatest(0, a.y0 - l.y, l.y - a.y1), 2) < 1000000""")
def _(spark, d):
    k = F.col("s_suppkey")
    xa, y = k * 7919 % 90000, (k * 104729 % 95000).cast("double")
    lines = table(spark, d, "supplier").select(k.alias("line_id"), F.array(
        F.struct(xa.cast("double").alias("x"), y.alias("y")), F.struct((xa + 5000).cast("double").alias("x"), y.alias("y"))).alias("path"))
    return spatial.lines_near_areas(lines, areas(spark, d), 1000.0, ["line_id"], ["area_id"], 2000.0)


@query("j19_inside_else_nearest", PLACES + """,
gap AS (SELECT point_id, box_id, sqrt(pow(greatest(0, b.x0 - p.easting, p.easting - b.x1), 2) + pow(greatest(0, b.y0 - p.northing, p.northing - b.y1), 2)) AS d
        FROM points p JOIN site_boxes b ON b.x0 - 2000 <= p.easting AND p.easting <= b.x1 + 2000 AND b.y0 - 2000 <= p.northing AND p.northing <= b.y1 + 2000),
best AS (SELECT point_id, min(box_id) FILTER (d = 0) AS inside, arg_min(box_id, (d, box_id)) FILTER (d <= 2000) AS near FROM gap GROUP BY point_id)
SELECT p.point_id, coalesce(b.inside, b.near) AS box_id, CASE WHEN b.inside IS NOT NULL THEN 'inside' WHEN b.near IS NOT NULL THEN 'nearest' ELSE 'none' END AS placed_by
FROM points p LEFT JOIN best b USING (point_id)""")
def _(spark, d):
    return spatial.nearest_area(points(spark, d), site_boxes(spark, d), "point_id", "box_id", 1000.0, 2000.0).select("point_id", "box_id", "placed_by")


@query("j20_proximity_deduplication", PLACES + """
SELECT point_id FROM points c WHERE NOT EXISTS (SELECT 1 FROM sites k WHERE k.site_group = CASE c.pcon % 4 WHEN 0 THEN 'health' WHEN 1 THEN 'education' WHEN 2 THEN 'emergency' ELSE 'utilities' END
  AND pow(c.easting - k.easting, 2) + pow(c.northing - k.northing, 2) <= pow(CASE k.source WHEN 'postcode' THEN 4000 ELSE 1500 END, 2))""")
def _(spark, d):
    n = F.col("pcon") % 4
    group = F.when(n == 0, "health").when(n == 1, "education").when(n == 2, "emergency").otherwise("utilities")
    candidates = points(spark, d).select("point_id", "easting", "northing", group.alias("site_group"))
    return proximity.drop_near_kept(candidates, sites(spark, d), "site_group", "source", 1500.0, {"postcode": 4000.0}).select("point_id")


CLUSTER_SQL = PLACES + """,
pairs AS (SELECT a.point_id AS a, b.point_id AS b FROM points a JOIN points b ON abs(a.easting - b.easting) <= 600 AND abs(a.northing - b.northing) <= 600
          AND pow(a.easting - b.easting, 2) + pow(a.northing - b.northing, 2) <= 360000),
reach AS (SELECT point_id AS a, point_id AS b FROM points UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON p.a = r.b),
roots AS (SELECT a AS point_id, min(b) AS cluster FROM reach GROUP BY a)"""


def _named_points(spark, d):
    return points(spark, d).select("point_id", "easting", "northing", F.concat(F.col("lad"), F.lit(" "), (F.col("point_id") % 1000).cast("string")).alias("name"))


@query("j21_chained_clusters", CLUSTER_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + " SELECT * FROM roots")
def _(spark, d):
    return proximity.clusters(_named_points(spark, d), "point_id", 600.0).select("point_id", "cluster")


@query("j21_one_site_per_cluster", CLUSTER_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + """
SELECT cluster, arg_min(point_id, (length(name), name, point_id)) AS point_id FROM (SELECT r.*, p.lad || ' ' || CAST(p.point_id % 1000 AS VARCHAR) AS name FROM roots r JOIN points p USING (point_id)) GROUP BY cluster""")
def _(spark, d):
    from freshet.operators.pick import first_per_key

    labelled = proximity.clusters(_named_points(spark, d), "point_id", 600.0)
    return first_per_key(labelled, ["cluster"], [F.length("name"), F.col("name"), F.col("point_id")]).select("cluster", "point_id")


# ---- cells and tiles -----------------------------------------------------------------------------------------


@query("f21_cell_keys", PLACES + """
SELECT point_id, (northing // 100) * 10000 + easting // 100 AS cell_key, (easting // 100) * 100 AS cell_e, (northing // 100) * 100 AS cell_n FROM points""")
def _(spark, d):
    key = place.cell_key(F.col("easting"), F.col("northing"))
    return points(spark, d).select("point_id", key.alias("cell_key"), place.cell_easting(key).alias("cell_e"), place.cell_northing(key).alias("cell_n"))


@query("f22_tile_codes", PLACES + """
SELECT point_id, 'S' || substr('VWXYZQRSTULMNOPFGHJKABCDE', CAST((northing * 4 // 100000) * 5 + easting * 4 // 100000 + 1 AS INTEGER), 1)
  || CASE WHEN (easting * 4) % 100000 >= 50000 THEN '5' ELSE '0' END || CASE WHEN (northing * 4) % 100000 >= 50000 THEN '5' ELSE '0' END AS tile,
  ((easting * 4) // 50000) * 50000 AS west, ((northing * 4) // 50000) * 50000 AS south FROM points""")
def _(spark, d):
    tile = place.tile_code(F.col("easting") * 4, F.col("northing") * 4)
    return points(spark, d).select("point_id", tile.alias("tile"), place.tile_west(tile).alias("west"), place.tile_south(tile).alias("south"))


@query("s33_tile_file_inventory", """
WITH files AS (SELECT 'RoFRS_S' || chr(65 + CAST(p_partkey % 1500 % 20 AS INTEGER)) || lpad(CAST(p_partkey % 1500 // 20 AS VARCHAR), 2, '0')
                 || CASE WHEN p_partkey % 9 = 0 THEN '' ELSE '_v202606' END || CASE WHEN p_size % 3 = 0 THEN '_Climate_Change' ELSE '' END AS path FROM part),
t AS (SELECT regexp_extract(path, '_([A-Z]{2}[0-9]{2})_v[0-9]+', 1) AS tile, path FROM files WHERE lower(path) NOT LIKE '%climate_change%')
SELECT tile, count(*) AS files, CASE WHEN count(*) = 1 THEN 'ok' ELSE 'skipped: ' || count(*) || ' files' END AS note FROM t WHERE tile <> '' GROUP BY tile""")
def _(spark, d):
    p, k = table(spark, d, "part"), F.col("p_partkey") % 1500
    path = F.concat(F.lit("RoFRS_S"), F.char((F.lit(65) + k % 20)), F.lpad(F.floor(k / 20).cast("string"), 2, "0"),
                    F.when(F.col("p_partkey") % 9 == 0, "").otherwise("_v202606"), F.when(F.col("p_size") % 3 == 0, "_Climate_Change").otherwise(""))
    return places.tile_inventory(p.select(path.alias("path"))).select("tile", "files", "note")


@query("f26_gauge_code_readings", """
WITH codes AS (SELECT s_suppkey, '5' || lpad(CAST(s_suppkey % 600 AS VARCHAR), 3, '0') AS la, lpad(CAST(s_suppkey % 400 AS VARCHAR), 3, '0') AS lo FROM supplier),
lats AS (SELECT DISTINCT s_suppkey, coalesce(TRY_CAST(substr(la, 1, k) AS INTEGER), 0) + CAST(substr(la, k + 1) AS INTEGER) / 60.0 AS lat
         FROM codes, range(0, 4) r(k) WHERE CAST(substr(la, CAST(k + 1 AS INTEGER)) AS INTEGER) < 60),
lons AS (SELECT DISTINCT s_suppkey, -(coalesce(TRY_CAST(substr(lo, 1, k) AS INTEGER), 0) + CAST(substr(lo, k + 1) AS INTEGER) / 60.0) AS lon
         FROM codes, range(0, 3) r(k) WHERE CAST(substr(lo, CAST(k + 1 AS INTEGER)) AS INTEGER) < 60)
SELECT s_suppkey, la || 'N' || lo || 'W' AS code, round(lat, 6) AS lat, round(lon, 6) AS lon FROM codes JOIN lats USING (s_suppkey) JOIN lons USING (s_suppkey)
WHERE lat BETWEEN 49 AND 61 AND lon BETWEEN -9 AND 2.5""")
def _(spark, d):
    s = table(spark, d, "supplier")
    code = F.concat(F.lit("5"), F.lpad((F.col("s_suppkey") % 600).cast("string"), 3, "0"), F.lit("N"), F.lpad((F.col("s_suppkey") % 400).cast("string"), 3, "0"), F.lit("W"))
    found = s.select("s_suppkey", code.alias("code"), F.explode(place.gauge_positions(code)).alias("p"))
    return found.select("s_suppkey", "code", F.round("p.lat", 6).alias("lat"), F.round("p.lon", 6).alias("lon"))


@query("f27_haversine_km", """
SELECT c_custkey, round(2 * 6371.0088 * asin(sqrt(pow(sin(radians((52 + c_custkey % 300 / 100.0 - 51.5) / 2)), 2)
  + cos(radians(51.5)) * cos(radians(52 + c_custkey % 300 / 100.0)) * pow(sin(radians((c_custkey % 200 / 100.0 - 0.12) / 2)), 2))), 4) AS km FROM customer""")
def _(spark, d):
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    return c.select("c_custkey", F.round(place.haversine_km(F.lit(51.5), F.lit(0.12), 52 + k % 300 / 100.0, k % 200 / 100.0), 4).alias("km"))


@query("f19_band_rank_and_label", """
SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 ELSE 0 END AS rank,
  CASE p_size % 6 WHEN 0 THEN 'Very Low' WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' WHEN 3 THEN 'High' ELSE 'None' END AS label FROM part""")
def _(spark, d):
    texts = F.array(*[F.lit(x) for x in ("very_low", " LOW ", "Medium", "high", "Unavailable")] + [F.lit(None).cast("string")])
    rank = risk.band_rank(F.element_at(texts, (F.col("p_size") % 6 + 1).cast("int")))
    return table(spark, d, "part").select("p_partkey", rank.alias("rank"), risk.band_label(rank).alias("label"))


@query("f20_flood_zone_group", """
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'sea' WHEN 1 THEN 'river' WHEN 2 THEN 'river_and_sea' ELSE 'other' END AS zone FROM part""")
def _(spark, d):
    texts = F.array(*[F.lit(x) for x in ("Tidal Models", "fluvial", "River / Coastal", "undefined")])
    return table(spark, d, "part").select("p_partkey", risk.flood_zone_group(F.element_at(texts, (F.col("p_size") % 4 + 1).cast("int"))).alias("zone"))


# ---- geometry text -------------------------------------------------------------------------------------------

BOX_JSON_SQL = """
boxes AS (SELECT s_suppkey, (s_suppkey * 613) % 90000 AS x0, (s_suppkey * 977) % 90000 AS y0, s_suppkey % 4 AS k FROM supplier)"""


def _point(x, y):
    return F.concat(F.lit("["), x.cast("string"), F.lit(","), y.cast("string"), F.lit("]"))


def _ring(k):
    x0, y0 = k * 613 % 90000, k * 977 % 90000
    return F.concat(F.lit("["), F.concat_ws(",", _point(x0, y0), _point(x0 + 10, y0), _point(x0 + 10, y0 + 10), _point(x0, y0)), F.lit("]"))


def _coordinates(spark, d):
    k = F.col("s_suppkey")
    ring, kind = _ring(k), k % 4
    text = F.when(kind == 0, ring).when(kind == 1, F.concat(F.lit("["), ring, F.lit("]"))).when(kind == 2, F.concat(F.lit("[["), ring, F.lit("]]"))).otherwise(_point(k * 613 % 90000, k * 977 % 90000))
    return table(spark, d, "supplier").select("s_suppkey", text.alias("coordinates"), F.when(k % 3 == 0, "polygon").when(k % 3 == 1, "Polyline").otherwise("odd").alias("declared"))


@query("f07_geometry_type_inference", """
SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'LineString' WHEN 1 THEN 'Polygon' WHEN 2 THEN 'MultiPolygon' END AS geometry_type FROM supplier""")
def _(spark, d):
    return _coordinates(spark, d).select("s_suppkey", place.geometry_type(F.col("declared"), F.col("coordinates")).alias("geometry_type"))


@query("s32_tolerant_geometry_parse", """
SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'not a polygon' WHEN 1 THEN 'ok' WHEN 2 THEN 'ok' ELSE 'no geometry' END AS geometry_status,
  CASE WHEN s_suppkey % 4 IN (1, 2) THEN 4 END AS n_vertices FROM supplier""")
def _(spark, d):
    c = _coordinates(spark, d)
    kind = place.geometry_type(F.col("declared"), F.col("coordinates"))
    parsed = places.parsed_geometry(c.withColumn("geometry", place.geojson(kind, F.col("coordinates"))))
    n = F.when(F.col("rings").isNotNull(), F.size(F.flatten("rings")))
    return parsed.select("s_suppkey", "geometry_status", n.alias("n_vertices"))


@query("s08_admin_area_wkt", with_ctes(BOX_JSON_SQL) + """
SELECT s_suppkey, 'POLYGON ((' || x0 || ' ' || y0 || ', ' || x0 + 10 || ' ' || y0 || ', ' || x0 + 10 || ' ' || y0 + 10 || ', ' || x0 || ' ' || y0 || '))' AS wkt,
  CASE WHEN s_suppkey % 3 > 0 THEN '2024-05-01T00:00:00Z' END AS edited FROM boxes""")
def _(spark, d):
    features = table(spark, d, "supplier").select("s_suppkey", place.geojson(F.lit("Polygon"), F.concat(F.lit("["), _ring(F.col("s_suppkey")), F.lit("]"))).alias("geometry"),
                        F.when(F.col("s_suppkey") % 3 == 0, "1899-12-30T00:00:00Z").otherwise("2024-05-01T00:00:00Z").alias("edited"))
    return places.admin_areas(features, ["edited"]).select("s_suppkey", "wkt", "edited")


@query("s05_geojson_features", """
SELECT CAST(s_nationkey AS VARCHAR) AS nation, s_name AS name, 27700 AS epsg FROM supplier""")
def _(spark, d):
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("s_nationkey").cast("string").alias("nation"), F.col("s_name").alias("name")).alias("properties"),
                       F.struct(F.lit("Point").alias("type"), F.array(F.lit(1.0), F.lit(2.0)).alias("coordinates")).alias("geometry"))
    crs = F.struct(F.struct(F.lit("urn:ogc:def:crs:EPSG::27700").alias("name")).alias("properties"))
    s = table(spark, d, "supplier")
    part = F.pmod(F.xxhash64("s_suppkey", "s_name"), F.lit(s.count() // 500 + 1))        # documents of some hundred features, however many there are
    docs = s.groupBy("s_nationkey", part).agg(F.collect_list(feature).alias("features")).select(
        F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), crs.alias("crs"), "features")).alias("body"))
    return places.geojson_features(docs, ["nation", "name"]).select("nation", "name", "epsg")


@query("s25_bounding_box_scan", PLACES + "SELECT area_id FROM areas WHERE x0 <= 50000 AND x1 >= 20000 AND y0 <= 60000 AND y1 >= 30000")
def _(spark, d):
    boxed = spatial.with_bounds(areas(spark, d)).select("area_id", F.struct(
        F.col("min_x").alias("xmin"), F.col("min_y").alias("ymin"), F.col("max_x").alias("xmax"), F.col("max_y").alias("ymax")).alias("bbox"))
    return places.boxes_meeting(boxed, 20000.0, 30000.0, 50000.0, 60000.0).select("area_id")


# ---- cells of areas ------------------------------------------------------------------------------------------

CELL_GRID_SQL = PLACES + """,
grid AS (SELECT (northing // 1000) * 10000 + easting // 1000 AS cell_key, sum(people) AS people, sum(households) AS households FROM points GROUP BY 1),
area_cells AS (SELECT a.area_id AS id, cy * 10000 + cx AS cell_key FROM areas a, range(0, 100) x(cx), range(0, 100) y(cy)
               WHERE cx * 1000 + 500 > a.x0 AND cx * 1000 + 500 < a.x1 AND cy * 1000 + 500 > a.y0 AND cy * 1000 + 500 < a.y1)"""


def _cells(spark, d):
    key = (F.floor(F.col("northing") / 1000) * 10000 + F.floor(F.col("easting") / 1000)).cast("long")
    grid_rows = points(spark, d).groupBy(key.alias("cell_key")).agg(F.sum("people").alias("people"), F.sum("households").alias("households"))
    owned = spans.owned_cells(areas(spark, d).select(F.col("area_id").alias("id"), "rings"), "id", 1000.0)
    return grid_rows, owned.select("id", (F.col("cell_y") * 10000 + F.col("cell_x")).cast("long").alias("cell_key"))


@query("a30_cells_an_area_owns", CELL_GRID_SQL + " SELECT id, cell_key FROM area_cells")
def _(spark, d):
    return _cells(spark, d)[1]


@query("a30_apportion_to_cells", CELL_GRID_SQL + """
SELECT cell_key, round(sum(p.p_retailprice / n.n), 8) AS total FROM area_cells c JOIN (SELECT id, count(*) AS n FROM area_cells GROUP BY id) n USING (id)
JOIN part p ON p.p_partkey = c.id GROUP BY cell_key""")
def _(spark, d):
    valued = areas(spark, d).join(table(spark, d, "part").select(F.col("p_partkey").alias("area_id"), F.col("p_retailprice").alias("total")), "area_id")
    spread = grid.apportion(valued.select(F.col("area_id").alias("id"), "rings", "total"), ["total"], "id", 1000.0)
    return spread.select("cell_key", F.round("total", 8).alias("total"))


@query("a31_cells_to_areas", CELL_GRID_SQL + """
SELECT id, round(coalesce(sum(people), 0), 2) AS people, count(*) AS cells FROM area_cells LEFT JOIN grid USING (cell_key) GROUP BY id""")
def _(spark, d):
    g, cells = _cells(spark, d)
    return grid.cells_to_areas(g, cells, ["people"]).select("id", F.round("people", 2).alias("people"), "cells")


@query("a32_union_total", CELL_GRID_SQL + """
SELECT round(sum(people), 2) AS people, sum(households) AS households FROM grid WHERE cell_key IN (SELECT cell_key FROM area_cells)""")
def _(spark, d):
    g, cells = _cells(spark, d)
    return grid.union_total(g, cells, ["people", "households"]).select(F.round("people", 2).alias("people"), "households")


@query("a33_overlap_depth_histogram", CELL_GRID_SQL + """
SELECT n_areas, count(*) AS cells, round(sum(people), 2) AS people FROM (SELECT cell_key, count(*) AS n_areas FROM area_cells GROUP BY cell_key) LEFT JOIN grid USING (cell_key) GROUP BY n_areas""")
def _(spark, d):
    g, cells = _cells(spark, d)
    return grid.overlap_depth(cells, g, ["people"]).select("n_areas", "cells", F.round("people", 2).alias("people"))


PRIMARY_SQL = CELL_GRID_SQL + """,
meta AS (SELECT area_id AS id, area_id % 3 = 0 AS in_force, area_id % 4 AS severity, kind = 'flood_warning' AS is_warning, (x1 - x0) * (y1 - y0) / 1e6 AS area_km2 FROM areas),
prim AS (SELECT cell_key, id AS primary_id, n_areas FROM (SELECT c.cell_key, c.id, count(*) OVER (PARTITION BY c.cell_key) AS n_areas,
           row_number() OVER (PARTITION BY c.cell_key ORDER BY in_force DESC, severity DESC, is_warning DESC, area_km2, id) AS k FROM area_cells c JOIN meta USING (id)) WHERE k = 1)"""


def _meta(spark, d):
    b = spatial.with_bounds(areas(spark, d))
    k = F.col("area_id")
    return b.select(k.alias("id"), (k % 3 == 0).alias("in_force"), (k % 4).alias("severity"), (F.col("kind") == "flood_warning").alias("is_warning"),
                    ((F.col("max_x") - F.col("min_x")) * (F.col("max_y") - F.col("min_y")) / 1e6).alias("area_km2"))


@query("w09_primary_area_by_precedence", PRIMARY_SQL + " SELECT * FROM prim")
def _(spark, d):
    return grid.primary_area(_cells(spark, d)[1], _meta(spark, d))


@query("a34_gross_unique_split_by_precedence", PRIMARY_SQL + """
SELECT c.id, round(coalesce(sum(people), 0), 2) AS people_gross, round(coalesce(sum(CASE WHEN c.id = primary_id THEN people END), 0), 2) AS people_unique,
  round(coalesce(sum(people / n_areas), 0), 6) AS people_split, count(*) AS cells, count(*) FILTER (c.id = primary_id) AS cells_unique
FROM area_cells c LEFT JOIN grid USING (cell_key) JOIN prim USING (cell_key) GROUP BY c.id""")
def _(spark, d):
    g, cells = _cells(spark, d)
    r = grid.overlap_stats(g, cells, _meta(spark, d), ["people"])
    return r.select("id", F.round("people_gross", 2).alias("people_gross"), F.round("people_unique", 2).alias("people_unique"),
                    F.round("people_split", 6).alias("people_split"), "cells", "cells_unique")


@query("j28_cell_pair_overlaps", CELL_GRID_SQL + """,
p AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS shared_cells, round(coalesce(sum(people), 0), 2) AS people FROM area_cells a JOIN area_cells b ON a.cell_key = b.cell_key AND a.id < b.id
      LEFT JOIN grid g ON g.cell_key = a.cell_key GROUP BY 1, 2)
SELECT * FROM p""")
def _(spark, d):
    g, cells = _cells(spark, d)
    return grid.cell_pair_overlaps(cells, g, ["people"]).select("id_a", "id_b", "shared_cells", F.round("people", 2).alias("people"))


# ---- hazard --------------------------------------------------------------------------------------------------

PIXEL_SQL = PLACES + """,
hazard AS (SELECT box_id, x0, y0, x1, y1, s_nationkey % 4 + 1 AS rank, CASE s_nationkey % 2 WHEN 0 THEN 'rofrs' ELSE 'flood_zones' END AS source FROM site_boxes),
pixels AS (SELECT source, px AS pixel_x, py AS pixel_y, max(rank) AS rank
           FROM hazard h, unnest(range(CAST(h.x0 // 100 AS BIGINT), CAST(h.x1 // 100 AS BIGINT) + 1)) a(px), unnest(range(CAST(h.y0 // 100 AS BIGINT), CAST(h.y1 // 100 AS BIGINT) + 1)) b(py)
           WHERE px * 100 + 50 > h.x0 AND px * 100 + 50 < h.x1 AND py * 100 + 50 > h.y0 AND py * 100 + 50 < h.y1 GROUP BY 1, 2, 3)"""
LABELS = {1: "Very Low", 2: "Low", 3: "Medium", 4: "High"}


def _pixels(spark, d):
    source = F.when(F.col("s_nationkey") % 2 == 0, "rofrs").otherwise("flood_zones")
    hazard = site_boxes(spark, d).select("box_id", source.alias("source"), (F.col("s_nationkey") % 4 + 1).alias("rank"), "rings")
    return grid.paint(hazard, 100.0, "box_id")


@query("a35_painted_pixels", PIXEL_SQL + " SELECT source, pixel_x, pixel_y, rank FROM pixels")
def _(spark, d):
    return spans.pixels(_pixels(spark, d))


@query("a35_painted_spans", PIXEL_SQL + """,
runs AS (SELECT *, pixel_x - row_number() OVER (PARTITION BY source, pixel_y, rank ORDER BY pixel_x) AS run FROM pixels)
SELECT source, pixel_y, min(pixel_x) AS x_from, max(pixel_x) AS x_to, rank FROM runs GROUP BY source, pixel_y, rank, run""")
def _(spark, d):
    return _pixels(spark, d)


@query("a36_cell_shares_from_pixels", PIXEL_SQL + """
SELECT source, (pixel_y // 10) * 10000 + pixel_x // 10 AS cell_key, CASE rank WHEN 1 THEN 'Very Low' WHEN 2 THEN 'Low' WHEN 3 THEN 'Medium' ELSE 'High' END AS band,
  count(*) / 100.0 AS share FROM pixels GROUP BY 1, 2, 3""")
def _(spark, d):
    return grid.cell_shares(_pixels(spark, d), LABELS, 100.0, 1000.0)


@query("p20_hazard_cells", PIXEL_SQL + """
SELECT source, count(*) AS pixels, count(DISTINCT (pixel_y // 10) * 10000 + pixel_x // 10) AS cells, max(rank) AS worst FROM pixels GROUP BY source""")
def _(spark, d):
    cells = grid.cells_of(_pixels(spark, d), 100.0, 1000.0)
    return cells.groupBy("source").agg(F.sum("pixels").alias("pixels"), F.count_distinct("cell_key").alias("cells"), F.max("rank").alias("worst"))


@query("a36_band_shares_from_samples", PLACES + """
SELECT (northing // 10000) * 10000 + easting // 10000 AS cell_key, count(*) FILTER (rofrs_rank = 0) / count(*)::DOUBLE AS share_0,
  count(*) FILTER (rofrs_rank = 4) / count(*)::DOUBLE AS share_4, max(rofrs_rank) AS worst_band FROM points GROUP BY 1""")
def _(spark, d):
    key = F.floor(F.col("northing") / 10000) * 10000 + F.floor(F.col("easting") / 10000)
    samples = points(spark, d).select(key.alias("cell_key"), F.col("rofrs_rank").alias("rank"))
    return grid.band_shares_from_samples(samples).select("cell_key", "share_0", "share_4", "worst_band")


@query("a30_worst_band_by_cell", PLACES + "SELECT (northing // 5000) * 10000 + easting // 5000 AS cell_key, max(rofrs_rank) AS rank FROM points GROUP BY 1")
def _(spark, d):
    key = F.floor(F.col("northing") / 5000) * 10000 + F.floor(F.col("easting") / 5000)
    return grid.worst_band_by_cell(points(spark, d).select(key.alias("cell_key"), F.col("rofrs_rank").alias("rank")))


@query("j32_hazard_rank_at_points", PIXEL_SQL + """
SELECT p.point_id, coalesce(a.rank, 0) AS river_rank, coalesce(b.rank, 0) AS zone_rank FROM points p
LEFT JOIN pixels a ON a.source = 'rofrs' AND a.pixel_x = p.easting // 100 AND a.pixel_y = p.northing // 100
LEFT JOIN pixels b ON b.source = 'flood_zones' AND b.pixel_x = p.easting // 100 AND b.pixel_y = p.northing // 100""")
def _(spark, d):
    slim = points(spark, d).select("point_id", "easting", "northing")
    return grid.with_hazard_ranks(slim, _pixels(spark, d), {"rofrs": "river_rank", "flood_zones": "zone_rank"}, 100.0).select("point_id", "river_rank", "zone_rank")
