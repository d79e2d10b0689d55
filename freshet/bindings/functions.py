"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.bindings.base import query, similarity_sql, table, tokens_sql, url_id_sql
from freshet.functions import risk, text
from freshet.plans import thresholds


def pick_text(index, *values):
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (index + 1).cast("int"))


@query("f01_risk_rank_and_level", """
SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 1 WHEN '2' THEN 2 WHEN '3' THEN 3 WHEN '4' THEN 4 ELSE 0 END AS rank,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Very Low' WHEN '2' THEN 'Low' WHEN '3' THEN 'Medium' WHEN '4' THEN 'High' END AS level FROM orders""")
def _(spark, d):
    o = table(spark, d, "orders")
    level = pick_text(F.substring("o_orderpriority", 1, 1).cast("int") - 1, "Very Low", "Low", "Medium", "High", "None at all")
    rank = risk.risk_rank(level)
    return o.select("o_orderkey", rank.alias("rank"), risk.risk_level(rank).alias("level"))


@query("f02_risk_matrix", """
SELECT l_orderkey, l_linenumber, CASE WHEN x > 4 OR y > 4 THEN 'Unknown' ELSE
  list_extract(['Very Low', 'Very Low', 'Low', 'Low', 'Very Low', 'Very Low', 'Low', 'Medium', 'Very Low', 'Low', 'Medium', 'Medium', 'Very Low', 'Low', 'Medium', 'High'], CAST((y - 1) * 4 + x AS INTEGER)) END AS level,
  CASE WHEN x > 4 OR y > 4 THEN 'Unknown' ELSE
  list_extract(['Green', 'Green', 'Yellow', 'Yellow', 'Green', 'Green', 'Yellow', 'Amber', 'Green', 'Yellow', 'Amber', 'Amber', 'Green', 'Yellow', 'Amber', 'Red'], CAST((y - 1) * 4 + x AS INTEGER)) END AS colour,
  CASE x WHEN 1 THEN 'Minor' WHEN 2 THEN 'Moderate' WHEN 3 THEN 'Significant' WHEN 4 THEN 'Extreme' ELSE 'Unknown' END AS impact,
  CASE y WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' WHEN 3 THEN 'High' WHEN 4 THEN 'Very High' ELSE 'Unknown' END AS likelihood
FROM (SELECT l_orderkey, l_linenumber, l_partkey % 5 + 1 AS x, l_suppkey % 5 + 1 AS y FROM lineitem)""")
def _(spark, d):
    x, y = F.col("l_partkey") % 5 + 1, F.col("l_suppkey") % 5 + 1
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", risk.matrix_level(x, y).alias("level"), risk.matrix_colour(x, y).alias("colour"),
        risk.impact_label(x).alias("impact"), risk.likelihood_label(y).alias("likelihood"))


@query("f03_place_name_key", """
SELECT p_partkey, regexp_replace(replace(p_name, ' ', 'and'), '[^a-z0-9]', '', 'g') || CASE p_size % 3 WHEN 0 THEN 'eoa' WHEN 1 THEN 'nw' ELSE '' END AS name_key FROM part""")
def _(spark, d):
    name = F.concat(F.replace(F.initcap("p_name"), F.lit(" "), F.lit(" & ")), pick_text(F.col("p_size") % 3, " É-ôâ", "Ñŵ", "'"))
    return table(spark, d, "part").select("p_partkey", text.name_key(name).alias("name_key"))


@query("f04_general_name_key", """
SELECT doc_id, lower(regexp_replace(strip_accents(replace(lang || source, '&', 'and')), '[^A-Za-z0-9]', '', 'g')) || 'soz' AS name_key FROM documents""")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", text.general_name_key(F.concat("lang", "source", F.lit(" šö́Ž"))).alias("name_key"))


@query("f05_area_codes", """
SELECT p_partkey, code AS type_code, CASE WHEN code IN ('WAF', 'FAG') THEN 'flood_alert' WHEN code = 'FWT' THEN 'flood_warning' ELSE 'unknown' END AS kind,
  CASE substr(code, 3, 1) WHEN 'F' THEN 'fluvial' WHEN 'G' THEN 'groundwater' WHEN 'T' THEN 'tidal' END AS source,
  CASE code WHEN 'WAF' THEN 'Flood Alert Fluvial' WHEN 'FAG' THEN 'Flood Alert Groundwater' WHEN 'FWT' THEN 'Flood Warning Tidal' END AS type_text
FROM (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'WAF' WHEN 1 THEN 'FAG' WHEN 2 THEN 'FWT' ELSE 'XYZ' END AS code FROM part)""")
def _(spark, d):
    code = F.concat(F.lit("123"), pick_text(F.col("p_size") % 4, "WAF", "FAG", "FWT", "XYZ"), F.col("p_partkey"))
    short = text.F.when(F.lit(True), code)
    return table(spark, d, "part").select(
        "p_partkey", risk.type_code(short).alias("type_code"), risk.area_kind(code).alias("kind"), risk.area_source(code).alias("source"),
        risk.type_text(risk.type_code(code)).alias("type_text"))


@query("f06_reading_values", """
SELECT event_id, CASE event_type WHEN 'click' THEN value WHEN 'view' THEN value WHEN 'signup' THEN value END AS value FROM events""")
def _(spark, d):
    v, k = F.col("value").cast("string"), F.col("event_type")
    raw = (F.when(k == "click", v).when(k == "view", F.concat(F.lit(" "), v, F.lit("|3.0"))).when(k == "signup", F.concat(F.lit("["), v, F.lit(", 2]")))
           .when(k == "error", "NaN").otherwise("true"))
    return table(spark, d, "events").select("event_id", text.reading_value(raw).alias("value"))


@query("f08_forecast_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER) AS forecast_date FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", risk.forecast_date(F.col("o_orderdate"), F.col("o_orderkey") % 5 + 1).alias("forecast_date"))


@query("f09_clean_identifiers", "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN CAST(c_custkey AS VARCHAR) WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN c_custkey || '.50' ELSE c_name END AS cleaned FROM customer")
def _(spark, d):
    k = F.col("c_custkey")
    raw = (F.when(k % 5 == 0, F.concat(k, F.lit(".0"))).when(k % 5 == 1, " NaN ").when(k % 5 == 2, "  ").when(k % 5 == 3, F.concat(k, F.lit(".50")))
           .otherwise(F.concat(F.lit(" "), "c_name", F.lit(" "))))
    return table(spark, d, "customer").select("c_custkey", text.clean(raw).alias("cleaned"))


@query("f10_identifier_key", """
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey AS VARCHAR) WHEN 1 THEN 'E' || c_custkey || 'TH' ELSE 'A-00' || c_custkey END AS id_key FROM customer""")
def _(spark, d):
    k = F.col("c_custkey")
    raw = (F.when(k % 3 == 0, F.lpad(k.cast("string"), 9, "0")).when(k % 3 == 1, F.concat(F.lit("e0"), k, F.lit("th"))).otherwise(F.concat(F.lit("a-00"), k)))
    return table(spark, d, "customer").select("c_custkey", text.id_key(raw).alias("id_key"))


@query("f11_tidy_id_and_shape", """
SELECT c_custkey, CAST(c_custkey AS VARCHAR) || 'AB' AS tidy, regexp_replace(CAST(c_custkey AS VARCHAR), '[0-9]', '9', 'g') || '_AA' AS shape FROM customer""")
def _(spark, d):
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(
        "c_custkey", F.when(k == 0, "0AB").otherwise(text.tidy_id(F.concat(F.lit("0 0-"), k, F.lit("_ab")))).alias("tidy"),
        text.id_shape(F.concat(k, F.lit("_éb"))).alias("shape"))


@query("f12_identifier_repairs", """
SELECT c_custkey, '067_TG_' || c_custkey AS repaired, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS padded FROM customer""")
def _(spark, d):
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(
        "c_custkey", text.underscore_tg(F.concat(F.lit("067_TG "), k)).alias("repaired"), text.pad_six(k.cast("string")).alias("padded"))


@query("f13_measured_family", """
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'groundwater' WHEN 1 THEN 'flow' WHEN 2 THEN NULL ELSE 'rainfall' END AS family, p_size % 4 = 2 AS conflict FROM part""")
def _(spark, d):
    t = text.text_family(pick_text(F.col("p_size") % 4, "Water Level", "River flow", "Rainfall", None))
    c = text.code_family(pick_text(F.col("p_size") % 4, "GW.obs", "Q.obs.us", "H.obs", "P.obs"))
    return table(spark, d, "part").select("p_partkey", text.reconciled_family(t, c).alias("family"), text.family_conflict(t, c).alias("conflict"))


@query("f14_unit_agreement", """
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'maod' WHEN 1 THEN 'masd' WHEN 2 THEN 'm' ELSE NULL END AS unit_key,
  CASE p_size % 4 WHEN 1 THEN 'datum_assumed' WHEN 2 THEN 'alias' END AS agrees_with_mald FROM part""")
def _(spark, d):
    p = table(spark, d, "part").select("p_partkey", text.unit_key(pick_text(F.col("p_size") % 4, "m AOD", "mASD", " m", "none")).alias("measure_unit"))
    alias = thresholds.aliases(None, spark).filter("unit_key = 'mald'").select("measure_unit", F.col("unit_kind").alias("agrees_with_mald"))
    return p.join(alias, "measure_unit", "left").select("p_partkey", F.col("measure_unit").alias("unit_key"), "agrees_with_mald")


@query("f15_datum_conversion", """
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 2 = 0 THEN -CAST(p_size % 5 AS DOUBLE) ELSE CAST(p_size % 5 AS DOUBLE) END AS shift FROM part""")
def _(spark, d):
    z = (F.col("p_size") % 5).cast("double")
    even = F.col("p_size") % 2 == 0
    shift = thresholds.conversion(F.when(even, "maod").otherwise("mald"), F.when(even, "masd").otherwise("maod"), z)
    return table(spark, d, "part").select("p_partkey", shift.alias("shift"))


@query("f16_scientific_notation", "SELECT c_custkey, c_custkey % 2 = 0 AS spoiled FROM customer")
def _(spark, d):
    k = F.col("c_custkey")
    return table(spark, d, "customer").select("c_custkey", text.is_scientific(F.concat(k, F.when(k % 2 == 0, ".53E+08").otherwise("E"))).alias("spoiled"))


@query("f17_boolean_words", "SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN NULL ELSE false END AS keep FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", text.truth(pick_text(F.col("p_size") % 5, " Yes", "F", "1.0", "maybe", "NO ")).alias("keep"))


@query("f18_uri_keys", """
SELECT page_id, lower(regexp_replace(regexp_replace(url || '/', '^https?://', ''), '/+$', '')) AS station_key, regexp_extract(regexp_replace(url, '/+$', ''), '[^/]*$') AS tail FROM pages""")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", text.station_key(F.concat("url", F.lit("/"))).alias("station_key"), text.uri_tail(F.col("url")).alias("tail"))


@query("f28_token_overlap", "WITH t AS (SELECT p_partkey, " + tokens_sql("'The ' || p_name || ' Bridge'") + " AS a, " + tokens_sql(
       "CASE WHEN p_size % 2 = 0 THEN upper(p_name) ELSE p_name || ' harbour' END") + """ AS b FROM part)
SELECT p_partkey, CASE WHEN len(a) > 0 AND len(b) > 0 THEN round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b)))::DOUBLE, 6) ELSE 0.0 END AS jaccard FROM t""")
def _(spark, d):
    a = text.name_tokens(F.concat(F.lit("The "), "p_name", F.lit(" Bridge")))
    b = text.name_tokens(F.when(F.col("p_size") % 2 == 0, F.upper("p_name")).otherwise(F.concat("p_name", F.lit(" harbour"))))
    return table(spark, d, "part").select("p_partkey", F.round(text.token_overlap(a, b), 6).alias("jaccard"))


@query("f28_name_similarity", "WITH p AS (SELECT p_partkey, p_name, split_part(p_name, ' ', -1) || ' ' || p_brand AS other FROM part), t AS (SELECT *, "
       + tokens_sql("p_name") + " AS a, " + tokens_sql("other") + " AS b FROM p) SELECT p_partkey, p_name, other, " + similarity_sql("a", "b") + " AS similarity FROM t")
def _(spark, d):
    p = table(spark, d, "part").withColumn("other", F.concat(F.reverse(F.split("p_name", " "))[0], F.lit(" "), F.col("p_brand")))
    return p.select("p_partkey", "p_name", "other", text.name_similarity(text.name_tokens(F.col("p_name")), text.name_tokens(F.col("other"))).alias("similarity"))


@query("f29_welsh_name_hint", "SELECT p_partkey, p_size % 3 < 2 AS hint FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", text.welsh_hint(F.concat("p_name", pick_text(F.col("p_size") % 3, " Llanwrtyd", " Ty Newydd", " Typical"))).alias("hint"))


EVENT_KEY_SQL = "CAST(user_id AS VARCHAR) || '|' || event_type || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '|None'"


@query("f30_deterministic_event_ids", f"SELECT event_id, {url_id_sql(EVENT_KEY_SQL)} AS log_id FROM events")
def _(spark, d):
    e = table(spark, d, "events").withColumn("at_text", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return e.select("event_id", text.url_event_id(F.col("user_id"), F.col("event_type"), F.col("at_text"), F.lit(None)).alias("log_id"))


@query("f31_guidance_keys", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey AS VARCHAR) ELSE 'none_' || strftime(o_orderdate, '%Y-%m-%d') END AS update_key,
  o_orderstatus = 'F' AS present, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey AS VARCHAR) ELSE 'none_' || strftime(o_orderdate, '%Y-%m-%d') END || '|7' AS polygon_key FROM orders""")
def _(spark, d):
    f = F.col("o_orderstatus") == "F"
    key = text.guidance_key(F.when(f, F.col("o_orderkey")), F.date_format("o_orderdate", "yyyy-MM-dd"))
    status = F.when(f, " Rapid Flooding Guidance Present").when(F.col("o_orderstatus") == "O", "No Rapid Flood Guidance at this time")
    return table(spark, d, "orders").select(
        "o_orderkey", key.alias("update_key"), text.guidance_present(status).alias("present"), text.polygon_key(key, F.lit(7.0)).alias("polygon_key"))


@query("f38_values_at_the_table_edge", """
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey AS VARCHAR) WHEN 1 THEN c_custkey || '.5' END AS printed, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS filled FROM customer""")
def _(spark, d):
    k = F.col("c_custkey")
    number = F.when(k % 3 == 0, k.cast("double")).when(k % 3 == 1, k + 0.5).otherwise(F.lit(float("nan")))
    return table(spark, d, "customer").select(
        "c_custkey", text.whole_number_text(number).alias("printed"), text.blank_to_null(F.when(k % 2 == 0, F.col("c_name")).otherwise("  ")).alias("filled"))


@query("s24_ranked_hyperlinks", """
WITH l AS (SELECT DISTINCT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS link FROM pages),
a AS (SELECT DISTINCT page_id, CASE WHEN regexp_matches(link, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN link WHEN link LIKE '/%' THEN 'http://host' || link ELSE 'http://host/' || link END AS url FROM l),
s AS (SELECT *, CASE WHEN lower(url) LIKE '%.csv%' THEN 8 ELSE 0 END + CASE WHEN lower(url) LIKE '%http://host%' THEN 2 ELSE 0 END AS score FROM a WHERE lower(url) NOT LIKE '%preview%')
SELECT page_id, url, score, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, url) AS position FROM s""")
def _(spark, d):
    from freshet.sources.places import ranked_links

    return ranked_links(table(spark, d, "pages"), "html", "page_id", F.lit("http://host"), 'href="([^"]+)"', "preview", {".csv": 8, "http://host": 2})
