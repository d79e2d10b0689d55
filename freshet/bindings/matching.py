"""Gauge matching, thresholds and their reports: the register from parts, the mapping file from customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.bindings.base import query, similarity_sql, stored, table, tokens_sql, with_ctes
from freshet.plans import mapping, thresholds

NOW = lambda: F.lit("2024-02-01 00:00:00").cast("timestamp")

# the same rows in SQL: a register of measures, a mapping file, and every stage of the match
INPUT_SQL = """
register AS (
  SELECT 'http://env/measures/' || p_partkey AS measure_uri, p_partkey, p_partkey // 4 AS st,
    CASE WHEN (p_partkey // 4) % 10 = 0 THEN '06_TG_' || (p_partkey // 4) ELSE lpad(CAST(p_partkey // 4 AS VARCHAR), 6, '0') END AS station_key,
    CASE p_type WHEN 'SMALL' THEN 'flow' WHEN 'MEDIUM' THEN 'rainfall' WHEN 'PROMO' THEN 'groundwater' WHEN 'LARGE' THEN 'wind' ELSE 'level' END AS m_family,
    CASE p_size % 4 WHEN 0 THEN 'stage' WHEN 1 THEN 'downstream stage' WHEN 2 THEN 'logged' ELSE 'dir' END AS q, CASE WHEN p_size % 2 = 0 THEN '900' ELSE '86400' END AS per,
    CASE p_size % 3 WHEN 0 THEN 'maod' WHEN 1 THEN 'masd' ELSE '---' END AS unit, CASE p_partkey % 5 WHEN 0 THEN 'mean' WHEN 4 THEN '' ELSE 'instantaneous' END AS vt, p_name
  FROM part),
mapping AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_custkey,
    CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN (c_custkey // 3) % 10 = 0 THEN '06_TG ' || (c_custkey // 3) WHEN c_custkey % 13 = 0 THEN 'nowhere' || c_custkey
      WHEN c_custkey % 2 = 0 THEN CAST(c_custkey // 3 AS VARCHAR) ELSE lpad(CAST(c_custkey // 3 AS VARCHAR), 6, '0') END AS tid,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'level' WHEN 'MACHINERY' THEN 'flow' WHEN 'FURNITURE' THEN 'wind' WHEN 'HOUSEHOLD' THEN 'groundwater' END AS tf,
    CASE c_custkey % 6 WHEN 0 THEN 'level' WHEN 1 THEN 'groundwater' WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE 'wind' END AS cf,
    CASE WHEN c_custkey % 6 = 5 THEN 'dir' END AS word, CASE WHEN c_custkey % 5 = 0 THEN 'stage' END AS pq, c_custkey % 11 = 0 AS inactive
  FROM customer),
fam AS (SELECT *, coalesce(tf <> cf AND NOT (tf = 'level' AND cf = 'groundwater'), false) AS conflict,
          CASE WHEN tf = 'level' AND cf = 'groundwater' THEN 'groundwater' WHEN tf IS NOT NULL AND cf IS NOT NULL AND tf <> cf THEN NULL ELSE coalesce(tf, cf) END AS family FROM mapping),
stations AS (SELECT DISTINCT station_key FROM register),
placed AS (SELECT f.*, coalesce(a.station_key, b.station_key, c.station_key) AS station_key FROM fam f LEFT JOIN stations a ON a.station_key = f.tid
           LEFT JOIN stations b ON b.station_key = regexp_replace(f.tid, '(_TG)\\s+([0-9]+)$', '\\1_\\2') LEFT JOIN stations c ON c.station_key = CASE WHEN regexp_full_match(f.tid, '[0-9]{1,5}') THEN lpad(f.tid, 6, '0') ELSE f.tid END
           WHERE f.tid IS NOT NULL AND f.family IS NOT NULL),
c0 AS (SELECT p.id, p.family, p.pq, p.word, r.* FROM placed p JOIN register r USING (station_key)
       WHERE m_family = family OR (family = 'level' AND m_family = 'groundwater') OR (family = 'groundwater' AND m_family = 'level')),
c1 AS (SELECT * FROM (SELECT *, bool_or(m_family = family) OVER (PARTITION BY id) AS own FROM c0) WHERE NOT own OR m_family = family),
c2 AS (SELECT * FROM (SELECT *, coalesce(bool_or(q = pq) OVER (PARTITION BY id), false) AS hit, count(*) OVER (PARTITION BY id) AS n2 FROM c1) WHERE NOT hit OR q = pq),
c3 AS (SELECT * FROM (SELECT *, coalesce(bool_or(m_family = 'wind' AND q = word) OVER (PARTITION BY id), false) AS w FROM c2) WHERE NOT w OR q = word),
c4 AS (SELECT * FROM (SELECT *, bool_or(q <> 'logged') OVER (PARTITION BY id) AS f4, m_family = 'level' AND NOT (hit AND n2 > 1) AS free FROM c3) WHERE NOT (free AND f4) OR q <> 'logged'),
c5 AS (SELECT * FROM (SELECT *, bool_or(unit <> '---') OVER (PARTITION BY id) AS f5 FROM c4) WHERE NOT (free AND f5) OR unit <> '---'),
c6 AS (SELECT * FROM (SELECT *, bool_or(vt = 'instantaneous') OVER (PARTITION BY id) AND bool_and(vt <> '') OVER (PARTITION BY id) AS f6 FROM c5) WHERE NOT (free AND f6) OR vt = 'instantaneous'),
shape AS (SELECT id, count(*) AS n, count(DISTINCT q) AS nq, count(DISTINCT per) AS np, count(DISTINCT unit) AS nu, count(DISTINCT vt) AS nv, bool_and(vt <> '') AS kv FROM c6 GROUP BY id),
fit AS (SELECT c6.*, CASE WHEN n = 1 OR (n > 1 AND nq = 1 AND np = 1 AND ((nu = n AND nv <= 1) OR (kv AND nv = n AND nu <= 1))) THEN 'matched' ELSE 'ambiguous' END AS match_status
        FROM c6 JOIN shape USING (id)),
matched_rows AS (
  SELECT id, match_status, measure_uri FROM fit
  UNION ALL SELECT id, CASE WHEN tid IS NULL THEN 'no_telemetry_id' WHEN conflict THEN 'conflict' ELSE 'unknown_parameter' END, NULL FROM fam WHERE tid IS NULL OR family IS NULL
  UNION ALL SELECT id, CASE WHEN station_key IS NULL THEN 'no_station' ELSE 'no_parameter' END, NULL FROM placed p WHERE NOT EXISTS (SELECT 1 FROM c0 WHERE c0.id = p.id))"""
INPUT = with_ctes(INPUT_SQL)


@stored
def _register(spark, d):
    p, k, z = table(spark, d, "part"), F.col("p_partkey"), F.col("p_size")
    st = F.floor(k / 4)
    parameter = F.element_at(F.create_map(*[F.lit(x) for x in ("SMALL", "Flow", "MEDIUM", "Rainfall", "PROMO", "Groundwater", "LARGE", "Wind")]), F.col("p_type"))
    pick = lambda i, *v: F.element_at(F.array(*[F.lit(x) for x in v]), (i + 1).cast("int"))
    return p.select(
        F.concat(F.lit("http://env/measures/"), k).alias("measure_uri"),
        F.when(st % 10 == 0, F.concat(F.lit("06_TG_"), st)).otherwise(F.lpad(st.cast("string"), 6, "0")).alias("station_reference"), F.col("p_name").alias("station_label"),
        F.coalesce(parameter, F.lit("Water Level")).alias("parameter"), pick(z % 4, "Stage", "Downstream Stage", "Logged", "Dir").alias("qualifier"),
        F.when(z % 2 == 0, "900").otherwise("86400").alias("period"), pick(z % 3, "mAOD", "mASD", "---").alias("unit_name"),
        F.when(k % 5 == 0, "mean").when(k % 5 == 4, None).otherwise("instantaneous").alias("value_type"))


@stored
def _mapping(spark, d):
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    st = F.floor(k / 3)
    tid = (F.when(k % 17 == 0, None).when(st % 10 == 0, F.concat(F.lit("06_TG "), st)).when(k % 13 == 0, F.concat(F.lit("nowhere"), k))
           .when(k % 2 == 0, st.cast("string")).otherwise(F.lpad(st.cast("string"), 6, "0")))
    words = F.create_map(*[F.lit(x) for x in ("BUILDING", "Water Level", "MACHINERY", "Flow", "FURNITURE", "Wind speed and so on", "HOUSEHOLD", "Groundwater")])
    codes = F.array(*[F.lit(x) for x in ("H.obs", "GW.obs", "X.obs", "", None, "Wind.obs.dir")])
    raw = c.select(
        k.cast("string").alias("ID"), F.concat(F.lit("0"), k).alias("FFFS_ID"), F.concat("c_name", F.when(k % 11 == 0, " INACTIVE").otherwise("")).alias("FFFSLocName"),
        F.element_at(codes, (k % 6 + 1).cast("int")).alias("ParameterID"), tid.alias("TelemetryID"), F.element_at(words, F.col("c_mktsegment")).alias("TelemetryParameter"),
        F.when(k % 5 == 0, "Stage").alias("ParameterQualifier"), F.when(k % 7 == 0, "4.53E+08").otherwise(F.concat(F.lit("W"), k)).alias("WISKI_ID"),
        F.col("c_nationkey").alias("Site Region"))
    # the prepared file is a stored table: written once, so that the match reads plain columns
    return mapping.prepare_mapping(raw)


@stored
def _matched(spark, d):
    return mapping.match(_mapping(spark, d), _register(spark, d))


def _activity(spark, d):
    # two parts share a measure, so every other measure has no readings
    e = table(spark, d, "lineitem")
    return e.groupBy(F.concat(F.lit("http://env/measures/"), F.col("l_partkey") - F.col("l_partkey") % 2).alias("measure_uri")).agg(
        F.count(F.lit(1)).alias("n_readings"), F.min("l_shipdate").alias("first_reading"), F.max("l_shipdate").alias("last_reading"))


def _stations(spark, d):
    # four parts make a station, named by the first
    st = F.col("st")
    s = table(spark, d, "part").groupBy(F.floor(F.col("p_partkey") / 4).alias("st")).agg(F.min_by("p_name", "p_partkey").alias("label"))
    return s.select(
        F.lpad(st.cast("string"), 6, "0").alias("station_reference"), "label", F.concat(F.lit("nowhere"), st * 3).alias("notation"),
        F.concat(F.lit("R"), st).alias("rloi_id"), F.concat(F.lit("W"), st * 13).alias("wiski_id"), (52.0 + st % 300 / 100).cast("string").alias("lat"), (st % 200 / 100).cast("string").alias("long"))


@query("p12_prepared_mapping_file", """
SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 7 > 0 THEN 'W' || c_custkey END AS wiski_id, CASE WHEN c_custkey % 7 = 0 THEN '4.53E+08' ELSE 'W' || c_custkey END AS wiski_id_in_file,
  CAST(c_nationkey AS VARCHAR) AS src_site_region FROM customer""")
def _(spark, d):
    return _mapping(spark, d).select("id", "wiski_id", "wiski_id_in_file", "src_site_region")


@query("p12_gauge_entity_matching", INPUT + " SELECT * FROM matched_rows")
def _(spark, d):
    return mapping.match(_mapping(spark, d), _register(spark, d)).select("id", "match_status", "measure_uri")


@query("a38_match_report", INPUT + " SELECT match_status, count(*) AS lines, count(DISTINCT id) AS rows FROM matched_rows GROUP BY match_status")
def _(spark, d):
    return mapping.match_report(_matched(spark, d), examples=5).select("match_status", "lines", "rows")


@query("a38_measures_wanted_by_several", INPUT + """
SELECT measure_uri, count(DISTINCT id) AS rows FROM matched_rows WHERE match_status = 'matched' GROUP BY measure_uri HAVING count(DISTINCT id) > 1""")
def _(spark, d):
    return mapping.shared_measures(_matched(spark, d))


@query("p13_inactive_rows", INPUT + """
SELECT m.id, CASE WHEN f.inactive AND NOT EXISTS (SELECT 1 FROM matched_rows x WHERE x.id = m.id AND x.match_status = 'matched') THEN 'inactive' ELSE m.match_status END AS match_status, count(*) > 0 AS kept
FROM matched_rows m JOIN mapping f USING (id) GROUP BY 1, 2""")
def _(spark, d):
    return mapping.flag_inactive(_matched(spark, d)).select("id", "match_status", F.lit(True).alias("kept")).distinct()


def _scope(spark, d):
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(
        k.cast("string").alias("fffs_id"), F.when(k % 8 == 1, "FALSE").otherwise("TRUE").alias("keep"), F.lpad(F.floor(k / 3).cast("string"), 6, "0").alias("external_id"),
        F.when(k % 3 == 0, "H.obs").when(k % 3 == 1, "zzz").otherwise("Q.obs").alias("parameter"), F.lit(None).cast("string").alias("external_parameter"),
        F.when(k % 5 == 0, "NRW").alias("import_source"))


@query("p13_out_of_scope_rows", INPUT + """
SELECT m.id, CASE WHEN c_custkey % 8 = 1 THEN 'out_of_scope' ELSE m.match_status END AS match_status FROM matched_rows m JOIN mapping USING (id) GROUP BY 1, 2""")
def _(spark, d):
    return mapping.flag_out_of_scope(_matched(spark, d), _scope(spark, d)).select("id", "match_status").distinct()


ACTIVITY_SQL = INPUT + """,
act AS (SELECT 'http://env/measures/' || (l_partkey - l_partkey % 2) AS measure_uri, count(*) AS n_readings, max(l_shipdate) AS last_reading FROM lineitem GROUP BY 1),
amb AS (SELECT f.id, f.measure_uri, coalesce(a.n_readings, 0) AS n, a.last_reading, a.last_reading >= TIMESTAMP '2001-07-01 00:00:00' - INTERVAL 30 DAY AS recent, f.q || f.per || f.unit || f.vt AS same
        FROM fit f LEFT JOIN act a USING (measure_uri) WHERE f.match_status = 'ambiguous'),
per AS (SELECT id, count(*) FILTER (n > 0) AS nh, count(*) FILTER (n > 0 AND recent) AS nr, count(DISTINCT same) FILTER (n > 0) AS sh, count(DISTINCT same) FILTER (n > 0 AND recent) AS sr,
  arg_min(measure_uri, (-n, -epoch_us(last_reading), measure_uri)) FILTER (n > 0) AS has_uri, arg_min(measure_uri, (-n, -epoch_us(last_reading), measure_uri)) FILTER (n > 0 AND recent) AS recent_uri FROM amb GROUP BY id),
verdict AS (SELECT id, CASE WHEN nh = 0 THEN NULL WHEN nh = 1 THEN has_uri WHEN nr = 1 THEN recent_uri WHEN nr > 1 AND sr = 1 THEN recent_uri WHEN nr <= 1 AND sh = 1 THEN has_uri END AS chosen FROM per)"""


@query("p13_settled_by_readings", ACTIVITY_SQL + """
SELECT m.id, CASE WHEN v.chosen IS NOT NULL THEN 'matched' ELSE m.match_status END AS match_status, m.measure_uri FROM matched_rows m
LEFT JOIN verdict v ON v.id = m.id AND m.match_status = 'ambiguous' WHERE v.chosen IS NULL OR v.chosen = m.measure_uri""")
def _(spark, d):
    now = F.lit("2001-07-01 00:00:00").cast("timestamp")
    return mapping.settle_by_readings(_matched(spark, d), _activity(spark, d), now, 30).select("id", "match_status", "measure_uri")


@query("p13_retry_external_id")
def _(spark, d):
    return mapping.retry_external_id(_matched(spark, d), _mapping(spark, d), _scope(spark, d), _register(spark, d)).select("id", "match_status", "measure_uri", "match_note")


@query("p13_import_only_rows")
def _(spark, d):
    # every twelfth gauge stands in the mapping under other ids, so the import list alone knows it
    elsewhere = F.expr("CAST(CAST(id AS BIGINT) / 3 AS BIGINT) % 12 = 5")
    m = _mapping(spark, d).withColumns({c: F.when(elsewhere, F.concat(F.lit("other"), c)).otherwise(F.col(c)) for c in ("fffs_id", "telemetry_id")})
    r = _register(spark, d)
    return mapping.add_import_only(mapping.match(m, r), m, _scope(spark, d), r).filter("id LIKE 'import_%'").select("id", "fffs_id", "telemetry_id", "match_status", "measure_uri")


@query("j22_position_candidates", """
WITH st AS (SELECT DISTINCT lpad(CAST(p_partkey // 4 AS VARCHAR), 6, '0') AS station, 52.0 + (p_partkey // 4) % 300 / 100.0 AS lat, (p_partkey // 4) % 200 / 100.0 AS lon FROM part),
codes AS (SELECT s_suppkey, 52 + (s_suppkey % 60) / 60.0 AS lat, (s_suppkey % 60) / 60.0 AS lon FROM supplier)
SELECT CAST(s_suppkey AS VARCHAR) AS id, station AS candidate_station_reference, round(2 * 6371.0088 * asin(sqrt(pow(sin(radians((s.lat - c.lat) / 2)), 2)
  + cos(radians(c.lat)) * cos(radians(s.lat)) * pow(sin(radians((s.lon - c.lon) / 2)), 2))), 2) AS distance_km FROM codes c JOIN st s ON abs(s.lat - c.lat) < 0.05 AND abs(s.lon - c.lon) < 0.1
WHERE 2 * 6371.0088 * asin(sqrt(pow(sin(radians((s.lat - c.lat) / 2)), 2) + cos(radians(c.lat)) * cos(radians(s.lat)) * pow(sin(radians((s.lon - c.lon) / 2)), 2))) <= 3""")
def _(spark, d):
    minutes = F.lpad((F.col("s_suppkey") % 60).cast("string"), 2, "0")
    rows = table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"), F.concat(F.lit("52"), minutes, F.lit("N0"), minutes, F.lit("E")).alias("telemetry_id"), F.col("s_name").alias("location_name"))
    found = mapping.position_candidates(rows, _stations(spark, d))
    return found.select("id", "candidate_station_reference", "distance_km")


@query("a39_ambiguity_profile", INPUT + """,
a AS (SELECT id, count(*) AS candidates, count(DISTINCT q) AS nq, count(DISTINCT per) AS np, count(DISTINCT unit) AS nu, count(DISTINCT vt) AS nv FROM fit WHERE match_status = 'ambiguous' GROUP BY id),
s AS (SELECT id, count(*) FILTER (CAST(per AS INTEGER) = least_per) AS n FROM (SELECT *, min(CAST(per AS INTEGER)) OVER (PARTITION BY id) AS least_per FROM fit WHERE match_status = 'ambiguous') GROUP BY id)
SELECT id, candidates, CASE WHEN nq = 1 AND np > 1 THEN 'periods differ' WHEN nq > 1 AND np <= 1 THEN 'qualifiers differ' WHEN nq > 1 THEN 'qualifiers and periods differ'
  WHEN nu > 1 AND nv > 1 THEN 'alike but for unit (datum) and value type' WHEN nu > 1 THEN 'alike but for unit (datum)'
  WHEN nv > 1 THEN 'alike but for value type' ELSE 'alike in everything listed' END AS why, s.n = 1 AS settled_by_shortest_period FROM a JOIN s USING (id)""")
def _(spark, d):
    return mapping.ambiguity_profile(_matched(spark, d)).select("id", "candidates", "why", "settled_by_shortest_period")


@query("a40_stage_pairs", INPUT + """,
pair AS (SELECT id FROM fit WHERE match_status = 'ambiguous' GROUP BY id HAVING count(DISTINCT q) = 2 AND bool_and(q IN ('stage', 'downstream stage'))),
w AS (SELECT DISTINCT tid, tf FROM mapping JOIN pair USING (id)), same AS (SELECT DISTINCT m.tid, m.id, m.pq FROM mapping m JOIN w ON w.tid = m.tid AND (w.tf IS NULL OR coalesce(m.tf, '') = w.tf))
SELECT tid AS telemetry_id, count(*) AS file_rows, CASE WHEN count(*) = 1 AND count(pq) = 0 THEN 'one_row_no_qualifier' WHEN count(*) > 1 AND count(DISTINCT pq) <= 1 THEN 'same_qualifier' ELSE 'other' END AS file_describes
FROM same GROUP BY tid""")
def _(spark, d):
    return mapping.stage_pairs(_matched(spark, d)).select("telemetry_id", "file_rows", "file_describes")


@query("a41_unplaced_profile", INPUT + """,
u AS (SELECT DISTINCT id, coalesce(tid, '') AS tid FROM matched_rows JOIN mapping USING (id) WHERE match_status IN ('no_station', 'no_telemetry_id'))
SELECT 'shape' AS profile, regexp_replace(regexp_replace(tid, '[A-Za-z]', 'A', 'g'), '[0-9]', '9', 'g') AS value, count(*) AS rows FROM u GROUP BY 2
UNION ALL SELECT 'prefix', upper(substr(tid, 1, 2)), count(*) FROM u GROUP BY 2""")
def _(spark, d):
    unplaced = _matched(spark, d).filter(F.col("match_status").isin("no_station", "no_telemetry_id"))
    return mapping.unplaced_profile(unplaced).filter("profile IN ('shape', 'prefix')")


@stored
def _unplaced(spark, d):
    unplaced = _matched(spark, d).filter(F.col("match_status").isin("no_station", "no_telemetry_id"))
    return unplaced.withColumn("location_name", F.regexp_replace("location_name", "Customer#0*", "red bolt "))


@stored
def _candidates(spark, d):
    return mapping.station_candidates(_unplaced(spark, d), _stations(spark, d), _register(spark, d).select("station_reference"))


@query("j33_candidate_routes", INPUT + """,
un AS (SELECT DISTINCT id, tid, c_custkey FROM matched_rows JOIN mapping USING (id) WHERE match_status IN ('no_station', 'no_telemetry_id')),
st AS (SELECT p_partkey // 4 AS n, lpad(CAST(p_partkey // 4 AS VARCHAR), 6, '0') AS ref FROM part GROUP BY p_partkey // 4),
hits AS (SELECT un.id, 1 AS route, ref FROM un JOIN st ON un.tid = 'nowhere' || (st.n * 3) UNION ALL SELECT un.id, 2, ref FROM un JOIN st ON c_custkey % 7 > 0 AND c_custkey = st.n * 13
         UNION ALL SELECT un.id, 4, ref FROM un JOIN st ON regexp_replace(upper(un.tid), '^0+', '') = upper('nowhere' || (st.n * 3)))
SELECT id, CASE min(route) WHEN 1 THEN 'notation' WHEN 2 THEN 'wiskiID' ELSE 'same after tidy-up' END AS how, ref AS candidate_station_reference FROM hits GROUP BY id, ref""")
def _(spark, d):
    return _candidates(spark, d).filter("how <> 'similar name'").select("id", "how", "candidate_station_reference")


NAMES_SQL = INPUT + """,
un AS (SELECT DISTINCT id, tid, c_custkey FROM matched_rows JOIN mapping USING (id) WHERE match_status IN ('no_station', 'no_telemetry_id')),
st AS (SELECT p_partkey // 4 AS n, lpad(CAST(p_partkey // 4 AS VARCHAR), 6, '0') AS ref, arg_min(p_name, p_partkey) AS label FROM part GROUP BY p_partkey // 4),
hits AS (SELECT un.id, 1 AS route, n, ref, label FROM un JOIN st ON un.tid = 'nowhere' || (st.n * 3) UNION ALL SELECT un.id, 2, n, ref, label FROM un JOIN st ON c_custkey % 7 > 0 AND c_custkey = st.n * 13
         UNION ALL SELECT un.id, 4, n, ref, label FROM un JOIN st ON regexp_replace(upper(un.tid), '^0+', '') = upper('nowhere' || (st.n * 3))),
ta AS (SELECT id, """ + tokens_sql("'red bolt ' || c_custkey") + """ AS a FROM un WHERE id NOT IN (SELECT id FROM hits)),
tb AS (SELECT n, ref, label, """ + tokens_sql("label") + """ AS b FROM st),
named AS (SELECT id, n, ref, label, """ + similarity_sql("a", "b") + """ AS score FROM ta, tb WHERE len(list_intersect(a, b)) > 0),
cand AS (SELECT id, min(route) AS route, n, ref, label, 1.0 AS score FROM hits GROUP BY id, n, ref, label UNION ALL SELECT id, 5, n, ref, label, score FROM named WHERE score >= 0.7)"""


@query("j33_candidates_by_name", NAMES_SQL + """
SELECT id, 'similar name' AS how, ref AS candidate_station_reference, label AS candidate_label, score, n % 10 <> 0 AS candidate_in_register FROM cand WHERE route = 5""")
def _(spark, d):
    return _candidates(spark, d).filter("how = 'similar name'")


@query("a42_candidate_route_summary", NAMES_SQL + """,
best AS (SELECT id, arg_min(route, (n % 10 = 0, route, ref)) AS route, arg_min(n % 10 <> 0, (n % 10 = 0, route, ref)) AS held FROM cand GROUP BY id)
SELECT CASE route WHEN 1 THEN 'notation' WHEN 2 THEN 'wiskiID' WHEN 4 THEN 'same after tidy-up' WHEN 5 THEN 'similar name' ELSE 'no candidate' END AS how,
  CASE WHEN held THEN 'in the register' WHEN route IS NOT NULL THEN 'in the station list alone' END AS reachable, count(*) AS rows FROM un LEFT JOIN best USING (id) GROUP BY 1, 2""")
def _(spark, d):
    return mapping.candidate_summary(_unplaced(spark, d), _candidates(spark, d))


@query("a49_name_match_cases", NAMES_SQL + """
SELECT CASE WHEN NOT held THEN 'no readings' WHEN stations > 1 THEN 'several stations' WHEN score >= 1 THEN 'one exact' ELSE 'one close' END AS name_case, count(*) AS rows
FROM (SELECT id, count(DISTINCT ref) AS stations, max(score) AS score, bool_or(n % 10 <> 0) AS held FROM cand WHERE route = 5 GROUP BY id) GROUP BY 1""")
def _(spark, d):
    return mapping.name_case_profile(_candidates(spark, d))


@query("p14_tidal_summary", NAMES_SQL + """
SELECT id, count(DISTINCT ref) AS stations, count(DISTINCT measure_uri) AS measures, false AS any_tidal,
  coalesce(string_agg(DISTINCT nullif(vt, ''), ' | ' ORDER BY nullif(vt, '')), '') AS value_types FROM cand LEFT JOIN register r ON r.station_key = ref GROUP BY id""")
def _(spark, d):
    return mapping.tidal_summary(mapping.candidate_measures(_candidates(spark, d), _register(spark, d)))


@query("p14_unmapped_measures", INPUT + """
SELECT measure_uri, m_family AS family, CASE WHEN station_key IN (SELECT tid FROM mapping WHERE tid IS NOT NULL) THEN 'station known, measure unused' ELSE 'station unknown to the file' END AS why
FROM register r WHERE NOT EXISTS (SELECT 1 FROM matched_rows m WHERE m.measure_uri = r.measure_uri AND m.match_status = 'matched')""")
def _(spark, d):
    return mapping.unmapped_measures(_register(spark, d), _matched(spark, d)).select("measure_uri", "family", "why")


@query("p14_matched_name_check", INPUT + """,
pairs AS (SELECT m.id, tid AS telemetry_id, c_name AS location_name, p_name AS station_label, m.measure_uri, """ + tokens_sql("c_name") + " AS a, " + tokens_sql("p_name") + """ AS b
          FROM matched_rows m JOIN mapping USING (id) JOIN customer USING (c_custkey) JOIN part ON m.measure_uri = 'http://env/measures/' || p_partkey WHERE match_status = 'matched')
SELECT id, telemetry_id, location_name || CASE WHEN CAST(id AS BIGINT) % 11 = 0 THEN ' INACTIVE' ELSE '' END AS location_name, station_label, measure_uri, """ + similarity_sql("a", "b") + """ AS name_similarity
FROM pairs WHERE """ + similarity_sql("a", "b") + " < 0.4")
def _(spark, d):
    return mapping.name_check(_matched(spark, d))


KEPT_SQL = INPUT + """,
best AS (SELECT id, arg_min(match_status, CASE match_status WHEN 'matched' THEN 1 WHEN 'ambiguous' THEN 2 WHEN 'conflict' THEN 3 WHEN 'no_parameter' THEN 4 WHEN 'unknown_parameter' THEN 5
           WHEN 'no_station' THEN 6 ELSE 9 END) AS match_status FROM matched_rows GROUP BY id),
kept AS (SELECT CAST(c_custkey AS VARCHAR) AS fffs_id, b.match_status, lpad(CAST(c_custkey // 3 AS VARCHAR), 6, '0') AS external_id FROM customer JOIN best b ON b.id = CAST(c_custkey AS VARCHAR)
         WHERE c_custkey % 8 <> 1)"""


@stored
def _kept(spark, d):
    return mapping.kept_status(_scope(spark, d), _matched(spark, d))


@query("p14_kept_row_status", KEPT_SQL + " SELECT fffs_id, match_status, match_status = 'matched' AS paired, true AS in_mapping FROM kept")
def _(spark, d):
    return _kept(spark, d).select("fffs_id", "match_status", "paired", "in_mapping")


def _paired(spark, d):
    return mapping.pair_by_external_id(_kept(spark, d), _register(spark, d), _activity(spark, d))


@query("p14_pair_by_external_id")
def _(spark, d):
    return _paired(spark, d).select("fffs_id", "external_id", "paired", "paired_via", "external_status", "data_state")


@query("p14_numeric_id_variants", KEPT_SQL + """,
u AS (SELECT external_id, match_status FROM kept WHERE match_status <> 'matched')
SELECT external_id, match_status, external_id IN (SELECT station_key FROM register) AS found_as_written FROM u""")
def _(spark, d):
    return mapping.numeric_id_variants(_kept(spark, d), _register(spark, d)).select("external_id", "match_status", "found_as_written")


@query("p14_listed_station_check", KEPT_SQL + """,
u AS (SELECT external_id, match_status FROM kept WHERE match_status IN ('no_station', 'no_telemetry_id'))
SELECT external_id, match_status, CASE WHEN external_id IN (SELECT station_key FROM register) THEN 'register holds a measure'
  WHEN external_id IN (SELECT lpad(CAST(p_partkey // 4 AS VARCHAR), 6, '0') FROM part) THEN 'station list only' ELSE 'no list holds it' END AS verdict FROM u""")
def _(spark, d):
    return mapping.listed_check(_kept(spark, d), _register(spark, d), _stations(spark, d)).select("external_id", "match_status", "verdict")


@query("p14_gap_list")
def _(spark, d):
    kept = _kept(spark, d)
    return mapping.gap_list(kept, mapping.listed_check(kept, _register(spark, d), _stations(spark, d)))


@query("a41_unpaired_kept_profile")
def _(spark, d):
    return mapping.unpaired_profile(_kept(spark, d))


# ---- thresholds ----------------------------------------------------------------------------------------------

THRESHOLD_SQL = INPUT + """,
thr AS (SELECT CAST(o_orderkey AS VARCHAR) AS threshold_id, CAST(o_custkey AS VARCHAR) AS key, CASE o_orderstatus WHEN 'F' THEN 'level' WHEN 'O' THEN 'flow' END AS family,
          CASE o_orderkey % 4 WHEN 0 THEN 'maod' WHEN 1 THEN 'mald' WHEN 2 THEN 'masd' ELSE 'm3s' END AS unit_key, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderkey % 3 AS DOUBLE) ELSE 0 END AS z,
          CAST(o_orderkey % 50 AS DOUBLE) AS value FROM orders WHERE o_orderpriority <> '5-LOW'),
gauge AS (SELECT id AS key, coalesce(tf, cf) AS family, f.measure_uri, unit AS mu, vt, coalesce(a.n, 0) AS n FROM fit f JOIN (SELECT id AS mid, tf, cf FROM mapping) x ON x.mid = f.id
          LEFT JOIN (SELECT 'http://env/measures/' || (l_partkey - l_partkey % 2) AS measure_uri, count(*) AS n FROM lineitem GROUP BY 1) a USING (measure_uri)),
pairs AS (SELECT t.threshold_id, g.measure_uri, g.vt, g.n, CASE WHEN unit_key = mu THEN 0 WHEN unit_key = 'mald' AND mu = 'masd' THEN 1
            WHEN z <> 0 AND ((unit_key = 'maod' AND mu = 'masd') OR (unit_key IN ('mald', 'masd') AND mu = 'maod')) THEN 3 END AS kind FROM thr t JOIN gauge g USING (key, family)),
bk AS (SELECT threshold_id, kind, count(*) AS c, arg_min(measure_uri, (CASE WHEN vt = 'instantaneous' THEN 0 ELSE 1 END, -n, measure_uri)) AS uri FROM pairs WHERE kind IS NOT NULL GROUP BY 1, 2),
b AS (SELECT threshold_id, min(kind) AS kind, arg_min(c, kind) AS c, arg_min(uri, kind) AS uri FROM bk GROUP BY 1),
linked AS (SELECT t.threshold_id, CASE WHEN t.family IS NULL THEN 'no_family' WHEN t.key NOT IN (SELECT id FROM mapping) THEN 'no_gauge' WHEN t.threshold_id NOT IN (SELECT threshold_id FROM pairs) THEN 'no_measure'
             WHEN b.kind IS NULL THEN 'unit_mismatch' WHEN b.c = 1 THEN 'linked' ELSE 'linked_chosen' END AS link_status,
             CASE b.kind WHEN 0 THEN 'exact' WHEN 1 THEN 'datum_assumed' WHEN 3 THEN 'converted' END AS unit_match, b.uri AS measure_uri, coalesce(b.c, 0) AS n_candidates,
             CASE WHEN b.kind = 3 THEN t.value + CASE WHEN unit_key = 'maod' THEN -z ELSE z END ELSE t.value END AS value_in_measure_unit FROM thr t LEFT JOIN b USING (threshold_id))"""


def _thresholds(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    units = F.array(*[F.lit(x) for x in ("m AOD", "mALD", "mASD", "m3/s")])
    raw = o.select(
        k.alias("ID"), F.concat(F.lit("00"), "o_custkey").alias("Location"), F.when(F.col("o_orderpriority") == "5-LOW", "Forecast").otherwise("observed").alias("Threshold Basis"),
        F.lit("Flood Warning").alias("CatDesc"), F.when(F.col("o_orderstatus") == "F", "H.obs").when(F.col("o_orderstatus") == "O", "Q.obs").otherwise("??").alias("Parameter"),
        F.element_at(units, (k % 4 + 1).cast("int")).alias("Unit"), (k % 50).cast("string").alias("Value"), (k % 3).cast("string").alias("Z"),
        F.when(k % 2 == 0, "RES").otherwise("ACTCON").alias("Type"), F.lit("FW").alias("Purpose"), F.lit("120").alias("Lead"), F.lit("A1").alias("Area"))
    return thresholds.prepare(raw, {
        "id": "ID", "location": "Location", "basis": "Threshold Basis", "catdesc": "CatDesc", "parameter": "Parameter", "unit": "Unit", "value": "Value", "z": "Z", "type": "Type",
        "purpose": "Purpose", "lead": "Lead", "target_area": "Area"})


@stored
def _linked(spark, d):
    m = _matched(spark, d).join(_activity(spark, d), "measure_uri", "left")
    return thresholds.link(_thresholds(spark, d), m, thresholds.aliases(None, spark))


@query("p15_threshold_gauge_links", THRESHOLD_SQL + " SELECT * FROM linked")
def _(spark, d):
    return _linked(spark, d).select("threshold_id", "link_status", "unit_match", "measure_uri", F.col("n_candidates").cast("long").alias("n_candidates"), "value_in_measure_unit")


@query("p15_link_summary", THRESHOLD_SQL + " SELECT link_status, count(*) AS rows FROM linked GROUP BY link_status")
def _(spark, d):
    return thresholds.link_summary(_linked(spark, d)).groupBy("link_status").agg(F.sum("rows").alias("rows"))


@query("p18_gauges_from_links")
def _(spark, d):
    from freshet.plans.timing import gauges

    return gauges(_linked(spark, d))
