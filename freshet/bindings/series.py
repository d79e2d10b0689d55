"""Reading series: archive plus live, latest, registers, profiles, facets."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.bindings.base import READINGS_SQL, archive_and_live, query, readings, table, with_ctes
from freshet.functions import text
from freshet.operators import guards, pick, upsert
from freshet.plans import readings as plan
from freshet.sources import feeds

NOW = "2024-02-01 00:00:00"
now = lambda: F.lit(NOW).cast("timestamp")

SERIES_SQL = """
series AS (
  SELECT user_id, ts, reading_date, event_id, event_type, value, 'archive' AS source FROM archive
  UNION ALL
  SELECT user_id, ts, reading_date, event_id, event_type, value, 'live' FROM live l
  WHERE NOT EXISTS (SELECT 1 FROM archive a WHERE a.reading_date = l.reading_date)
    AND NOT EXISTS (SELECT 1 FROM archive a WHERE a.user_id = l.user_id AND a.ts = l.ts))"""


def series(spark, d):
    archive, live = archive_and_live(spark, d)
    return plan.one_series(archive, live, ["user_id"], "ts", "reading_date", F.lit("2024-01-18").cast("date"))


@query("u01_archive_and_live_series", with_ctes(READINGS_SQL, SERIES_SQL) + "SELECT user_id, ts, value, source FROM series")
def _(spark, d):
    return series(spark, d).select("user_id", "ts", "value", "source")


@query("w01_latest_per_key", with_ctes(READINGS_SQL, SERIES_SQL) + """
SELECT user_id, ts, value, source FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM series) WHERE n = 1""")
def _(spark, d):
    return plan.latest(series(spark, d), ["user_id"], ["ts", "event_id"]).select("user_id", "ts", "value", "source")


@query("j09_live_rows_not_in_archive", with_ctes(READINGS_SQL) + """
SELECT user_id, ts, value FROM live l WHERE NOT EXISTS (SELECT 1 FROM archive a WHERE a.reading_date = l.reading_date)
  AND NOT EXISTS (SELECT 1 FROM archive a WHERE a.user_id = l.user_id AND a.ts = l.ts)""")
def _(spark, d):
    archive, live = archive_and_live(spark, d)
    return (live.join(archive.select("reading_date").distinct(), "reading_date", "left_anti")
            .join(archive.select("user_id", "ts").distinct(), ["user_id", "ts"], "left_anti").select("user_id", "ts", "value"))


@query("u03_union_of_layers", """
SELECT layer, count(*) AS n, round(sum(value), 4) AS total FROM (
  SELECT 'retail' AS layer, p_retailprice AS value FROM part UNION ALL SELECT 'supplier', s_acctbal FROM supplier
  UNION ALL SELECT 'customer', c_acctbal FROM customer) GROUP BY layer""")
def _(spark, d):
    layer = lambda t, c, n: table(spark, d, t).select(F.lit(n).alias("layer"), F.col(c).alias("value"))
    layers = pick.union_all([layer("part", "p_retailprice", "retail"), layer("supplier", "s_acctbal", "supplier"), layer("customer", "c_acctbal", "customer")])
    return layers.groupBy("layer").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("w12_deduplicate_keep_first", with_ctes(READINGS_SQL) + """
SELECT user_id, reading_date, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, reading_date, event_type ORDER BY ts, event_id) AS n FROM readings) WHERE n = 1""")
def _(spark, d):
    kept = plan.deduplicate(readings(spark, d), ["user_id", "reading_date", "event_type"], [F.col("ts"), F.col("event_id")], "first")
    return kept.select("user_id", "reading_date", "event_type", "event_id", "value")


@query("w12_deduplicate_keep_last", with_ctes(READINGS_SQL) + """
SELECT user_id, reading_date, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, reading_date ORDER BY ts DESC, event_id DESC) AS n FROM readings) WHERE n = 1""")
def _(spark, d):
    kept = plan.deduplicate(readings(spark, d), ["user_id", "reading_date"], [F.col("ts"), F.col("event_id")], "last")
    return kept.select("user_id", "reading_date", "event_id", "value")


@query("s10_missing_days", """
SELECT CAST(d AS DATE) AS reading_date FROM range(DATE '2023-12-25', DATE '2024-02-08', INTERVAL 1 DAY) t(d)
WHERE CAST(d AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events)""")
def _(spark, d):
    return feeds.missing_days(readings(spark, d), "reading_date", F.lit("2023-12-25").cast("date"), F.lit("2024-02-07").cast("date"))


@query("k08_release_covered_live_rows", with_ctes(READINGS_SQL) + """
SELECT user_id, ts, value FROM live l WHERE reading_date > (SELECT max(reading_date) FROM archive)
  AND NOT EXISTS (SELECT 1 FROM archive a WHERE a.user_id = l.user_id AND a.ts = l.ts)""")
def _(spark, d):
    archive, live = archive_and_live(spark, d)
    landed = archive.agg(F.max("reading_date").alias("d")).first()["d"]
    return plan.release(live, archive, F.lit(landed), ["user_id"], "ts", "reading_date").select("user_id", "ts", "value")


@query("k09_retention_trim", "SELECT user_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 14 DAY")
def _(spark, d):
    return upsert.trim_older(readings(spark, d), "ts", now(), 14).select("user_id", "ts", "value")


@query("a12_measure_register", """
SELECT user_id, min(event_type) AS parameter, min(value) AS least_value, min(ts) AS first_seen FROM events GROUP BY user_id""")
def _(spark, d):
    r = plan.register(readings(spark, d).withColumnsRenamed({"event_type": "parameter", "value": "least_value", "ts": "first_seen"}), "user_id", [
        "parameter", "least_value", "first_seen"])
    return r


STATIONS_SQL = """
stations AS (SELECT c_custkey % 400 AS user_id, CASE WHEN c_nationkey % 4 = 0 THEN '' ELSE c_name END AS api_label, c_mktsegment AS town, c_custkey
             FROM customer),
station AS (SELECT user_id, arg_min(api_label, c_custkey) AS api_label, arg_min(town, c_custkey) AS town FROM stations GROUP BY user_id)"""


def one_station(spark, d):
    c = table(spark, d, "customer").select(
        (F.col("c_custkey") % 400).alias("user_id"), F.when(F.col("c_nationkey") % 4 == 0, "").otherwise(F.col("c_name")).alias("label"),
        F.col("c_mktsegment").alias("town"), "c_custkey")
    return pick.first_per_key(c, ["user_id"], [F.col("c_custkey")]).drop("c_custkey")


@query("a13_register_assembly", with_ctes(READINGS_SQL, STATIONS_SQL) + """
SELECT user_id, parameter AS label, NULL AS town, 'held' AS origin FROM (SELECT user_id, min(event_type) AS parameter FROM archive GROUP BY user_id)
UNION ALL
SELECT b.user_id, coalesce(nullif(trim(s.api_label), ''), b.parameter), s.town, 'new'
FROM (SELECT user_id, min(event_type) AS parameter FROM live GROUP BY user_id) b LEFT JOIN station s USING (user_id)
WHERE b.user_id NOT IN (SELECT user_id FROM archive)""")
def _(spark, d):
    archive, live = archive_and_live(spark, d)
    named = lambda df: plan.register(df.withColumnRenamed("event_type", "label"), "user_id", ["label"])
    held = named(archive).withColumn("town", F.lit(None).cast("string")).withColumn("first_seen", F.lit("2024-01-01").cast("date"))
    built = plan.assemble_register(held, named(live), one_station(spark, d), "user_id", "user_id", F.lit("2024-02-01").cast("date"))
    return built.select("user_id", "label", "town", F.when(F.col("first_seen") < "2024-02-01", "held").otherwise("new").alias("origin"))


@query("p11_register_with_station_fixes", with_ctes(READINGS_SQL, STATIONS_SQL) + """
SELECT b.user_id, coalesce(nullif(trim(s.api_label), ''), b.label) AS label, s.town, b.n
FROM (SELECT user_id, min(event_type) AS label, count(*) AS n FROM readings GROUP BY user_id) b LEFT JOIN station s USING (user_id)""")
def _(spark, d):
    built = readings(spark, d).groupBy("user_id").agg(F.min("event_type").alias("label"), F.count(F.lit(1)).alias("n")).withColumn(
        "town", F.lit(None).cast("string"))
    fixes = one_station(spark, d).withColumn("label", text.blank_to_null(F.col("label")))
    return upsert.update_matched(built, fixes, ["user_id"], ["label"], ["town"])


@query("k07_update_matched_rows", """
SELECT p_partkey, coalesce(s_name, p_name) AS p_name, CASE WHEN s_suppkey IS NOT NULL THEN s_acctbal ELSE p_retailprice END AS p_retailprice
FROM part LEFT JOIN supplier ON s_suppkey = p_partkey""")
def _(spark, d):
    existing = table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice")
    fixes = table(spark, d, "supplier").select(F.col("s_suppkey").alias("p_partkey"), F.col("s_name").alias("p_name"), F.col("s_acctbal").alias("p_retailprice"))
    return upsert.update_matched(existing, fixes, ["p_partkey"], ["p_name"], ["p_retailprice"])


@query("w03_fullest_row_per_station", """
SELECT p_brand AS station_key, p_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY (CASE WHEN p_size > 10 THEN 1 ELSE 0 END) + (CASE WHEN p_type <> 'SMALL' THEN 1 ELSE 0 END)
    + (CASE WHEN p_retailprice > 1000 THEN 1 ELSE 0 END) DESC, p_partkey) AS n FROM part) WHERE n = 1""")
def _(spark, d):
    p = table(spark, d, "part").select(
        "p_brand", "p_partkey", F.when(F.col("p_size") > 10, F.col("p_size")).alias("a"), F.when(F.col("p_type") != "SMALL", F.col("p_type")).alias("b"),
        F.when(F.col("p_retailprice") > 1000, F.col("p_retailprice")).alias("c"))
    return plan.fullest_per_station(p, F.col("p_brand"), ["a", "b", "c"], "p_partkey").select("station_key", "p_partkey")


@query("a14_readings_with_mapping", with_ctes(READINGS_SQL) + """
SELECT r.user_id, r.ts, m.name, m.mapping_ids FROM readings r
LEFT JOIN (SELECT c_custkey % 400 AS user_id, min(c_name) AS name, count(DISTINCT c_nationkey) AS mapping_ids FROM customer GROUP BY 1) m USING (user_id)""")
def _(spark, d):
    mapping = table(spark, d, "customer").select(
        (F.col("c_custkey") % 400).alias("user_id"), F.col("c_name").alias("name"), "c_nationkey", F.lit(1).alias("n_readings"))
    return plan.mapped_measures(readings(spark, d), mapping, "user_id", ["name"], "c_nationkey").select("user_id", "ts", "name", "mapping_ids")


@query("a15_reading_activity", """
SELECT user_id, count(*) AS n_readings, min(ts) AS first_reading, max(ts) AS last_reading FROM events
WHERE user_id IN (SELECT c_custkey FROM customer) GROUP BY user_id""")
def _(spark, d):
    wanted = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return plan.activity(readings(spark, d), wanted, "user_id", "ts")


@query("a16_readings_profile", """
SELECT min(CAST(ts AS DATE)) AS earliest_date, max(CAST(ts AS DATE)) AS latest_date, count(DISTINCT CAST(ts AS DATE)) AS date_count,
  count(DISTINCT event_type) AS station_count, count(DISTINCT user_id) AS measure_count, count(*) FILTER (value IS NULL) AS null_values,
  count(*) AS reading_count FROM events""")
def _(spark, d):
    return plan.profile(readings(spark, d), "reading_date", "event_type", "user_id", "value")


@query("a16_profile_by_parameter", "SELECT event_type, count(DISTINCT user_id) AS measures, count(*) AS reading_count FROM events GROUP BY event_type")
def _(spark, d):
    return plan.profile_by(readings(spark, d), "event_type", "user_id")


@query("a44_archive_live_summary", """
SELECT count(*) AS readings, count(*) FILTER (ts < TIMESTAMP '2024-01-20 00:00:00') AS archive, count(*) FILTER (ts >= TIMESTAMP '2024-01-20 00:00:00') AS live,
  max(ts) AS newest, round((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max(ts))) / 6e7, 1) AS age_minutes FROM events""")
def _(spark, d):
    archive, _live = archive_and_live(spark, d)
    at = archive.agg(plan.boundary(F.max("ts")).alias("b")).first()["b"]
    return plan.split_summary(readings(spark, d), "ts", F.lit(at), now())


@query("f32_archive_boundary", with_ctes(READINGS_SQL) + """
SELECT CAST(max(reading_date) + 1 AS TIMESTAMP) AS boundary, TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 7 DAY AS window_start FROM archive""")
def _(spark, d):
    archive, _live = archive_and_live(spark, d)
    return archive.agg(plan.boundary(F.max("ts")).alias("boundary"), F.max(now() - F.expr("INTERVAL 7 DAYS")).alias("window_start"))


@query("f40_recent_window_of_chosen_keys", """
SELECT user_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 10 DAY
  AND user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def _(spark, d):
    chosen = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user_id"))
    return plan.recent_window(readings(spark, d), chosen, "user_id", "ts", now(), 10).select("user_id", "ts", "value")


@query("f39_facet_options", """
SELECT 'p_brand' AS facet, p_brand AS option FROM part WHERE p_type = 'LARGE' AND p_size = 7 GROUP BY p_brand
UNION ALL SELECT 'p_type', p_type FROM part WHERE p_brand = 'Brand#3' AND p_size = 7 GROUP BY p_type
UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR) FROM part WHERE p_brand = 'Brand#3' AND p_type = 'LARGE' GROUP BY p_size
UNION ALL SELECT 'p_name', p_name FROM part WHERE p_brand = 'Brand#3' AND p_type = 'LARGE' AND p_size = 7 GROUP BY p_name""")
def _(spark, d):
    return plan.facet_options(table(spark, d, "part"), {"p_brand": "Brand#3", "p_type": "LARGE", "p_size": 7, "p_name": None})


@query("f39_facet_filter", "SELECT p_partkey, p_name FROM part WHERE p_brand = 'Brand#3' AND p_type = 'LARGE'")
def _(spark, d):
    return plan.facet_filter(table(spark, d, "part"), {"p_brand": "Brand#3", "p_type": "LARGE", "p_size": None}).select("p_partkey", "p_name")


@query("f33_measure_labels", """
SELECT p_partkey, p_type || CASE WHEN p_size % 3 > 0 THEN ', ' || p_brand ELSE '' END || CASE WHEN p_size % 2 = 0 THEN ' (' || p_name || ')' ELSE '' END AS label
FROM part""")
def _(spark, d):
    p = table(spark, d, "part")
    qualifier = F.when(F.col("p_size") % 3 > 0, F.col("p_brand")).otherwise("")
    unit = F.when(F.col("p_size") % 2 == 0, F.col("p_name"))
    return p.select("p_partkey", plan.measure_label(F.col("p_type"), qualifier, unit).alias("label"))


@query("f33_unique_station_names", """
WITH a AS (SELECT s_suppkey, 'http://env/' || s_suppkey AS uri, CASE WHEN s_nationkey % 2 = 0 THEN 'Rainfall station' ELSE s_name END AS name,
             CAST(s_nationkey AS VARCHAR) AS ref FROM supplier),
c AS (SELECT *, count(DISTINCT uri) OVER (PARTITION BY name) > 1 AS clash FROM a),
t AS (SELECT *, CASE WHEN clash THEN name || ' (' || ref || ')' ELSE name END AS trial FROM c),
x AS (SELECT *, count(DISTINCT uri) OVER (PARTITION BY trial) > 1 AS still FROM t),
u AS (SELECT *, CASE WHEN (SELECT count(*) FILTER (still) < count(*) FILTER (clash) FROM x) THEN trial ELSE name END AS second FROM x),
z AS (SELECT *, count(DISTINCT uri) OVER (PARTITION BY second) > 1 AS last_clash FROM u)
SELECT s_suppkey, CASE WHEN last_clash THEN second || ' [' || s_suppkey || ']' ELSE second END AS station FROM z""")
def _(spark, d):
    s = table(spark, d, "supplier").select(
        "s_suppkey", F.concat(F.lit("http://env/"), F.col("s_suppkey").cast("string")).alias("uri"),
        F.when(F.col("s_nationkey") % 2 == 0, "Rainfall station").otherwise(F.col("s_name")).alias("station"), F.col("s_nationkey").cast("string").alias("ref"))
    return plan.unique_names(s, "station", "uri", [F.col("ref")]).select("s_suppkey", "station")


@query("a47_duplicate_keys", "SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def _(spark, d):
    return guards.duplicate_keys(table(spark, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day")), ["o_custkey", "day"])


@query("a48_value_count_profiles", """
SELECT 'segment' AS profile, c_mktsegment AS value, count(*) AS n FROM customer GROUP BY c_mktsegment
UNION ALL SELECT 'nation', CAST(c_nationkey AS VARCHAR), count(*) FROM customer GROUP BY c_nationkey""")
def _(spark, d):
    c = table(spark, d, "customer").select(F.explode(F.array(
        F.struct(F.lit("segment").alias("profile"), F.col("c_mktsegment").alias("value")),
        F.struct(F.lit("nation").alias("profile"), F.col("c_nationkey").cast("string").alias("value")))).alias("e")).select("e.*")
    return c.groupBy("profile", "value").agg(F.count(F.lit(1)).alias("n"))


@query("k10_row_count_guard", "SELECT (SELECT count(*) FROM events) AS new_rows, (SELECT count(*) FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00') AS held_rows, true AS allowed")
def _(spark, d):
    archive, _live = archive_and_live(spark, d)
    n = guards.guard_row_count(readings(spark, d), archive, 0.8, 100)
    return archive.agg(F.lit(n).cast("long").alias("new_rows"), F.count(F.lit(1)).alias("held_rows"), F.lit(True).alias("allowed"))


@query("s07_truncation_guard", "SELECT (SELECT count(*) FROM nation) AS rows_returned, 5000 AS request_limit, true AS complete")
def _(spark, d):
    n = guards.guard_truncation(table(spark, d, "nation"), limit=5000, matched=25)
    return table(spark, d, "nation").agg(F.count(F.lit(1)).alias("rows_returned"), F.lit(5000).alias("request_limit"), F.lit(n == 25).alias("complete"))


@query("l08_sample_with_cap", "SELECT c_custkey, c_name FROM customer ORDER BY md5('run-1|' || c_custkey), c_custkey LIMIT 300")
def _(spark, d):
    return pick.sampled(table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", "run-1", 300)


@query("l09_alert_levels_query", """
SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey
WHERE o_orderstatus = 'F' AND o_totalprice > 0.9 * (SELECT max(o_totalprice) FROM orders)""")
def _(spark, d):
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    top = orders.agg(F.max("o_totalprice").alias("m")).first()["m"]
    return (orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 0.9 * top)).join(customer, F.col("c_custkey") == F.col("o_custkey"))
            .select("o_orderkey", "c_name", "o_totalprice"))
