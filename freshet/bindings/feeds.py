"""Landed JSON and CSV: documents are built from the driver tables and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.bindings.base import query, table, with_ctes
from freshet.operators.upsert import outstanding
from freshet.sources import feeds, statements

INGESTED = lambda: F.lit("2024-02-01T00:00:00Z")


# ---- statements: one document per order, one risk area per line ----------------------------------------------

STATEMENT_SQL = """
line AS (SELECT o_orderkey AS statement_id, CAST(o_orderdate AS DATE) AS issued, l_linenumber AS area, l_linenumber * 10 AS block, l_suppkey AS poly, o_orderpriority AS headline,
           o_orderstatus, l_partkey % 5 + 1 AS x, l_suppkey % 4 + 1 AS y, l_quantity > 25 AS short_river, l_returnflag = 'R' AS beyond
         FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
day AS (SELECT line.*, 1 AS day_index FROM line UNION ALL SELECT line.*, 3 FROM line),
block AS (SELECT day.*, 'surface' AS source FROM day UNION ALL SELECT day.*, 'river' FROM day WHERE NOT short_river)"""


def _documents(spark, d):
    line = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    x, y = F.col("l_partkey") % 5 + 1, F.col("l_suppkey") % 4 + 1
    pair = F.concat(F.lit("["), x, F.lit(","), y, F.lit("]"))
    # text pieces keep the malformed entries a real feed has: a level that is no list, a polygon with no block
    river = F.when(F.col("l_quantity") > 25, "\"none\"").otherwise(pair)
    n = F.col("l_linenumber")
    ring = F.lit("[[[0,0],[1,0],[1,1],[0,0]]]")
    poly = F.concat(F.lit('{"id":'), "l_suppkey", F.lit(',"type":"polygon","poly_type":"inland","coordinates":'), ring, F.lit("}"))
    area = F.concat(
        F.lit('{"id":'), n, F.lit(',"beyond_five_days":'), F.when(F.col("l_returnflag") == "R", "true").otherwise("false"),
        F.lit(',"risk_area_blocks":[{"id":'), n * 10, F.lit(',"days":[1,3],"risk_levels":{"river":'), river, F.lit(',"surface":'), pair,
        F.lit('},"polys":['), poly, F.lit("]}]}"))
    concern = F.concat(F.lit('{"id":'), "l_suppkey", F.when(n % 2 == 0, F.concat(F.lit(',"risk_area_block_id":'), n * 10)).otherwise(""),
                       F.lit(',"type":"line","coordinates":[[0,0],[1,1]]}'))
    # an order has at most a handful of lines, so its document is small
    docs = line.groupBy("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus").agg(
        F.concat_ws(",", F.collect_list(area)).alias("areas"), F.concat_ws(",", F.collect_list(concern)).alias("maps"))
    body = F.concat(
        F.lit('{"id":'), "o_orderkey", F.lit(',"issued_at":"'), F.date_format("o_orderdate", "yyyy-MM-dd'T'10:30:00'Z'"), F.lit('","headline":"'), "o_orderpriority",
        F.lit('","sources":[{"coastal":"old"},{"river":"r"},{"coastal":"'), "o_orderstatus", F.lit('"}],"flood_risk_trend":{"day1":"up","day5":"down"},"risk_areas":['), "areas",
        F.lit('],"aoc_maps":[{"id":1,"polys":['), "maps", F.lit("]}]}"))
    return statements.parse_statements(docs.select(body.alias("body")))


@query("s01_statement_rows", """
SELECT DISTINCT o_orderkey AS statement_id, strftime(o_orderdate, '%Y-%m-%d') || 'T10:30:00Z' AS issued_at, o_orderpriority AS headline, 'up' AS flood_risk_trend_day1,
  o_orderstatus AS source_coastal, 'r' AS source_river, CAST(NULL AS VARCHAR) AS source_ground FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def _(spark, d):
    return statements.statement_rows(_documents(spark, d), INGESTED()).select(
        "statement_id", "issued_at", "headline", "flood_risk_trend_day1", "source_coastal", "source_river", "source_ground")


LEVEL_SQL = """CASE WHEN x > 4 OR y > 4 THEN 'Unknown' ELSE list_extract(['Very Low', 'Very Low', 'Low', 'Low', 'Very Low', 'Very Low', 'Low', 'Medium', 'Very Low', 'Low',
  'Medium', 'Medium', 'Very Low', 'Low', 'Medium', 'High'], CAST((y - 1) * 4 + x AS INTEGER)) END"""


@query("s01_risk_polygons", with_ctes(STATEMENT_SQL) + f"""
SELECT statement_id, area AS risk_area_id, block AS risk_area_block_id, poly AS poly_id, day_index, strftime(issued + (day_index - 1), '%Y-%m-%d') AS forecast_date, source,
  x AS risk_x, y AS risk_y, {LEVEL_SQL} AS risk_level, beyond AS beyond_five_days, 'Polygon' AS geometry_type FROM block""")
def _(spark, d):
    return statements.risk_polygons(_documents(spark, d), INGESTED()).select(
        "statement_id", "risk_area_id", "risk_area_block_id", "poly_id", "day_index", "forecast_date", "source", "risk_x", "risk_y", "risk_level", "beyond_five_days", "geometry_type")


@query("s01_risk_blocks", with_ctes(STATEMENT_SQL) + f"SELECT statement_id, block AS risk_area_block_id, day_index, source, {LEVEL_SQL} AS risk_level FROM block")
def _(spark, d):
    return statements.block_rows(_documents(spark, d), INGESTED()).select("statement_id", "risk_area_block_id", "day_index", "source", "risk_level")


@query("s01_concern_polygons", with_ctes(STATEMENT_SQL) + """
SELECT statement_id, 1 AS aoc_map_id, poly AS poly_id, CASE WHEN area % 2 = 0 THEN area * 10 END AS risk_area_block_id, 'LineString' AS geometry_type FROM line""")
def _(spark, d):
    return statements.concern_polygons(_documents(spark, d), INGESTED()).select("statement_id", "aoc_map_id", "poly_id", "risk_area_block_id", "geometry_type")


@query("s02_malformed_risk_entries", with_ctes(STATEMENT_SQL) + "SELECT count(*) * 4 AS entries, count(*) FILTER (short_river) * 2 AS skipped FROM line")
def _(spark, d):
    return statements.malformed_levels(_documents(spark, d))


@query("s03_flattened_sources", "SELECT DISTINCT o_orderkey AS statement_id, 'coastal=' || o_orderstatus || ',river=r' AS sources FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def _(spark, d):
    flat = F.map_entries(statements.flatten_sources(F.col("sources")))
    text = F.concat_ws(",", F.array_sort(F.transform(flat, lambda e: F.concat_ws("=", e.key, e.value))))
    return _documents(spark, d).select(F.col("id").alias("statement_id"), text.alias("sources"))


@query("s04_paged_backfill_with_resume", """
WITH pages_now AS (SELECT c_custkey // 50 AS page, count(*) AS n FROM customer WHERE c_custkey % 900 <> 899 GROUP BY 1)
SELECT page FROM pages_now WHERE page >= 2 AND page <= coalesce((SELECT min(page) FROM pages_now WHERE n < 50 AND page >= 2), 1e9)
  AND page NOT IN (SELECT p_partkey FROM part WHERE p_size < 10)""")
def _(spark, d):
    pages = table(spark, d, "customer").filter("c_custkey % 900 <> 899").groupBy(F.floor(F.col("c_custkey") / 50).alias("page")).agg(
        F.count(F.lit(1)).alias("rows")).withColumn("page_size", F.lit(50))
    done = table(spark, d, "part").filter("p_size < 10").select(F.col("p_partkey").alias("page"))
    return statements.pages_to_load(pages, done, 2).select("page")


# ---- readings ------------------------------------------------------------------------------------------------


@query("s09_readings_scan", """
SELECT CAST(user_id AS VARCHAR) AS measure_uri, event_type AS parameter, CASE WHEN event_type <> 'error' THEN value END AS value, CAST(NULL AS VARCHAR) AS qualifier,
  CAST(ts + INTERVAL 1 HOUR AS DATE) AS reading_date FROM events""")
def _(spark, d):
    e = table(spark, d, "events")
    raw = e.select(
        F.col("user_id").cast("string").alias("measure"), F.col("event_type").alias("parameterName"),
        F.when(F.col("event_type") != "error", F.col("value").cast("string")).otherwise("n/a").alias("value"),
        F.concat(F.lit("/landing/readings-"), F.date_format(F.col("ts") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd"), F.lit(".csv")).alias("_file"))
    return feeds.typed_readings(raw, {"measure": "measure_uri", "parameterName": "parameter"}, ["measure_uri", "parameter", "value", "qualifier"], ["value"])


@query("s09_date_mismatches", """
SELECT CAST(ts + INTERVAL 1 HOUR AS DATE) AS reading_date, count(*) AS rows, count(*) FILTER (CAST(ts AS DATE) <> CAST(ts + INTERVAL 1 HOUR AS DATE)) AS other_date FROM events GROUP BY 1""")
def _(spark, d):
    e = table(spark, d, "events").select("ts", F.to_date(F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("reading_date"))
    return feeds.date_mismatches(e, "ts")


@query("s12_blank_only_nulls", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'NA' WHEN p_size % 3 = 2 THEN p_name END AS note FROM part")
def _(spark, d):
    from freshet.session import scratch_path

    p = table(spark, d, "part").select(F.col("p_partkey").cast("string"), F.when(F.col("p_size") % 3 == 0, "NA").when(F.col("p_size") % 3 == 2, F.col("p_name")).alias("note"))
    path = scratch_path(spark, "blank-null-csv")
    p.write.option("header", True).csv(path)
    return feeds.read_blank_null_csv(spark, path).select(F.col("p_partkey").cast("long").alias("p_partkey"), "note")


@query("s13_latest_readings_feed", """
WITH i AS (SELECT event_id, 'm' || user_id AS measure_uri, date_trunc('minute', ts) AS date_time, CASE event_type WHEN 'error' THEN NULL ELSE value END AS value, event_type FROM events WHERE event_type <> 'signup'),
d AS (SELECT *, row_number() OVER (PARTITION BY measure_uri, date_time ORDER BY event_id DESC) AS n FROM i)
SELECT measure_uri, date_time, value, CAST(date_time AS DATE) AS reading_date FROM d WHERE n = 1""")
def _(spark, d):
    e, k = table(spark, d, "events"), F.col("event_type")
    uri = F.concat(F.lit("m"), "user_id")
    quoted = F.concat(F.lit('"'), uri, F.lit('"'))
    measure = F.when(k == "view", F.concat(F.lit("["), quoted, F.lit("]"))).when(k == "purchase", F.concat(F.lit('{"@id":'), quoted, F.lit("}"))).otherwise(quoted)
    value = F.when(k == "error", '"n/a"').when(k == "view", F.concat(F.lit('"'), "value", F.lit('|9"'))).otherwise(F.col("value").cast("string"))
    stamp = F.when(k == "signup", "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:00'Z'"))
    body = F.concat(F.lit('{"measure":'), measure, F.lit(',"dateTime":"'), stamp, F.lit('","value":'), value, F.lit("}"))
    return feeds.latest_readings(e.select("event_id", body.alias("body")), "body", "event_id", F.current_timestamp()).select("measure_uri", "date_time", "value", "reading_date")


@query("s14_warnings_feed", """
SELECT CAST(user_id AS VARCHAR) AS flood_area_id, CAST(user_id % 4 + 1 AS INTEGER) AS severity_level, arg_max(event_type, event_id) AS message,
  arg_max(CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('minute', ts) ELSE CAST(CAST(ts AS DATE) AS TIMESTAMP) END, event_id) AS time_raised, 'Severn' AS river_or_sea
FROM events GROUP BY user_id""")
def _(spark, d):
    e, k = table(spark, d, "events"), F.col("event_id") % 3
    stamp = (F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).when(k == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm")).otherwise(F.date_format("ts", "yyyy-MM-dd")))
    item = F.to_json(F.struct(
        F.col("user_id").cast("string").alias("floodAreaID"), (F.col("user_id") % 4 + 1).alias("severityLevel"), F.col("event_type").alias("message"),
        stamp.alias("timeRaised"), F.struct(F.lit("Severn").alias("riverOrSea")).alias("floodArea")))
    return feeds.warning_feed(e.select("event_id", item.alias("body")), "body", "event_id", F.current_timestamp()).select(
        "flood_area_id", "severity_level", "message", "time_raised", "river_or_sea")


@query("s15_stations", """
SELECT 'http://st/' || s_suppkey AS station_id, s_name AS label, CASE WHEN s_nationkey % 2 = 0 THEN 'Active' ELSE 'Suspended' END AS status FROM supplier""")
def _(spark, d):
    return feeds.stations(_station_items(spark, d)).select("station_id", "label", "status")


def _station_items(spark, d):
    s = table(spark, d, "supplier")
    label = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit('["'), "s_name", F.lit('","other"]'))).otherwise(F.concat(F.lit('"'), "s_name", F.lit('"')))
    measures = F.when(F.col("s_suppkey") % 5 > 0, F.concat(
        F.lit(',"measures":[{"@id":"'), "s_suppkey", F.lit('-a","parameter":"level"},{"@id":"'), "s_suppkey", F.lit('-b","parameter":"flow","unitName":"m3/s"}]'))).otherwise("")
    return s.select(F.concat(
        F.lit('{"@id":"http://st/'), "s_suppkey", F.lit('","label":'), label, F.lit(',"status":"http://status/'),
        F.when(F.col("s_nationkey") % 2 == 0, "Active").otherwise("Suspended"), F.lit('"'), measures, F.lit("}")).alias("body"))


@query("s15_station_measures", """
SELECT 'http://st/' || s_suppkey AS station_id, CASE WHEN s_suppkey % 5 > 0 THEN s_suppkey || '-' || m END AS measure_uri,
  CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN m = 'a' THEN 'level' ELSE 'flow' END AS parameter FROM supplier, (VALUES ('a'), ('b')) v(m) WHERE s_suppkey % 5 > 0 OR m = 'a'""")
def _(spark, d):
    return feeds.station_measures(_station_items(spark, d)).select("station_id", "measure_uri", "parameter")


@query("s16_member_contacts", """
SELECT c_custkey AS member_id, CASE WHEN c_nationkey = 7 THEN 'kept@held' WHEN c_nationkey % 2 = 0 THEN c_name || '@x' END AS email,
  CASE WHEN c_nationkey = 7 THEN NULL ELSE c_mktsegment END AS phone FROM customer""")
def _(spark, d):
    c = table(spark, d, "customer")
    failed = F.col("c_nationkey") == 7
    entries = F.array_compact(F.array(
        F.when(F.col("c_nationkey") % 2 == 0, F.struct(F.lit("email").alias("type"), F.concat("c_name", F.lit("@x")).alias("value"))),
        F.struct(F.lit("phone").alias("type"), F.col("c_mktsegment").alias("value"))))
    m = c.select(F.col("c_custkey").alias("member_id"), failed.alias("lookup_failed"), F.when(~failed, F.to_json(entries)).alias("contacts"))
    fresh = m.drop("contacts").join(feeds.contact_rows(m), "member_id")
    previous = c.select(F.col("c_custkey").alias("member_id"), F.lit("kept@held").alias("email"), *[F.lit(None).cast("string").alias(x) for x in ("phone", "website", "handle")])
    return feeds.keep_previous_contacts(fresh, previous).select("member_id", "email", "phone")


# ---- rapid guidance ------------------------------------------------------------------------------------------

GUIDANCE_SQL = """
g AS (SELECT o_orderkey, o_orderstatus, o_orderdate, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey AS VARCHAR)
        ELSE 'none_' || strftime(o_orderdate, '%Y-%m-%d') || 'T' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':00:00Z' END AS update_key FROM orders)"""


def _updates(spark, d):
    o, line = table(spark, d, "orders"), table(spark, d, "lineitem")
    f = F.col("o_orderstatus") == "F"
    coordinates = F.when(F.col("l_quantity") > 40, "[1,2]").otherwise("[[[0,0],[1,0],[1,1],[0,0]]]")
    poly = F.concat(F.lit('{"polygon_number":'), "l_linenumber", F.lit(',"coordinates":'), coordinates, F.lit(',"counties":["Kent","'), "l_returnflag", F.lit('"],"is_valid":'),
                    F.when(F.col("l_tax") > 0.02, "true").otherwise("false"), F.lit("}"))
    polys = line.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.concat_ws(",", F.collect_list(poly)).alias("polys"))
    joined = o.join(polys, "o_orderkey", "left")
    updated = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'"), F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit(":00:00Z"))
    body = F.when(f, F.concat(
        F.lit('{"id":'), "o_orderkey", F.lit(',"status":"Rapid Flooding Guidance Present","last_updated":"'), updated, F.lit('","polygons":['), F.coalesce("polys", F.lit("")), F.lit("]}"))).otherwise(
        F.concat(F.lit('{"status":"No Rapid Flood Guidance at this time","last_updated":"'), updated, F.lit('"}')))
    return feeds.parse_guidance(joined.select(body.alias("body")))


@query("s17_guidance_updates", with_ctes(GUIDANCE_SQL) + """
SELECT update_key, o_orderstatus = 'F' AS is_present, o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 24) AS last_updated,
  CASE WHEN o_orderstatus = 'F' THEN count(l_orderkey) ELSE 0 END AS n_polygons, CASE WHEN o_orderstatus = 'F' THEN count(l_orderkey) FILTER (l_tax > 0.02 AND l_quantity <= 40) ELSE 0 END AS n_valid
FROM g LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY update_key, o_orderstatus, o_orderdate, o_orderkey""")
def _(spark, d):
    return feeds.guidance_updates(_updates(spark, d), F.current_timestamp()).select("update_key", "is_present", "last_updated", "n_polygons", "n_valid")


@query("s17_guidance_polygons", with_ctes(GUIDANCE_SQL) + """
SELECT update_key, l_linenumber AS polygon_number, l_quantity <= 40 AS has_geometry, 'Kent, ' || l_returnflag AS counties, l_tax > 0.02 AS is_valid
FROM g JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'""")
def _(spark, d):
    return feeds.guidance_polygons(_updates(spark, d), F.current_timestamp()).select(
        "update_key", "polygon_number", F.col("geometry").isNotNull().alias("has_geometry"), "counties", "is_valid")


@query("s18_new_versions_only", """
SELECT DISTINCT o_custkey AS update_key, o_orderdate AS last_updated FROM orders WHERE (o_custkey, o_orderdate) NOT IN (SELECT o_custkey, o_orderdate FROM orders WHERE o_totalprice > 250000)""")
def _(spark, d):
    o = table(spark, d, "orders")
    pair = lambda df: df.select(F.col("o_custkey").alias("update_key"), F.col("o_orderdate").alias("last_updated"))
    return feeds.new_versions(pair(o), pair(o.filter("o_totalprice > 250000")))


@query("k15_done_unit_resume", """
SELECT DISTINCT c_nationkey AS unit FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 6000)""")
def _(spark, d):
    work = table(spark, d, "customer").select(F.col("c_nationkey").alias("unit"), F.lit("v1").alias("version")).distinct()
    done = table(spark, d, "supplier").filter("s_acctbal > 6000").select(F.col("s_nationkey").alias("unit"), F.lit("v1").alias("version"))
    return outstanding(work, done, "unit", "version").select("unit")
