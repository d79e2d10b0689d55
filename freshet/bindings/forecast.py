"""Forecast products: changes, contacts, situation, monthly exposure, briefings, health."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.bindings.base import (FORECAST_SQL, MEMBERS_SQL, WARNINGS_SQL, area_lookup, constituencies, current_warnings, links, members, query,
                                   statements, stored, table, url_id_sql, with_ctes)
from freshet.functions import risk
from freshet.operators import guards, upsert
from freshet.plans import briefing, forecast, health, warnings

# ---- joins ---------------------------------------------------------------------------------------------------


@query("j01_inner_join", "SELECT l_orderkey, l_linenumber, o_orderpriority FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def _(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    return table(spark, d, "lineitem").join(orders, "l_orderkey").select("l_orderkey", "l_linenumber", "o_orderpriority")


@query("j02_left_join_with_matched_flag", with_ctes(MEMBERS_SQL) + """
SELECT c.constituency_id, c.name, m.name AS mp_name, m.member_id, m.member_id IS NOT NULL AS mp_matched
FROM constituencies c LEFT JOIN one_member m USING (name_key)""")
def _(spark, d):
    return forecast.with_members(constituencies(spark, d), members(spark, d), "name").select("constituency_id", "name", "mp_name", "member_id", "mp_matched")


@query("w02_one_member_per_name_key", with_ctes(MEMBERS_SQL) + "SELECT name_key, member_id, name FROM one_member")
def _(spark, d):
    return forecast.one_member_per_name(members(spark, d)).select("name_key", "member_id", "name")


@query("j03_fan_out_protected_join", with_ctes(MEMBERS_SQL) + """
SELECT c.c_custkey, m.member_id FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN one_member m ON m.name_key = regexp_replace(lower(n.n_name), '[^a-z0-9]', '', 'g')""")
def _(spark, d):
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    left = table(spark, d, "customer").select("c_custkey", "c_nationkey").join(nation, "c_nationkey")
    joined = forecast.with_members(left, members(spark, d), "n_name")
    guards.guard_no_fan_out(joined, left)
    return joined.select("c_custkey", "member_id")


@query("j05_full_outer_snapshot_compare", with_ctes(FORECAST_SQL) + """,
n AS (SELECT constituency_id, source, max(rank) AS rank FROM links WHERE year(forecast_date) = 2000 GROUP BY ALL),
p AS (SELECT constituency_id, source, max(rank) AS rank FROM links WHERE year(forecast_date) = 1999 GROUP BY ALL)
SELECT coalesce(n.constituency_id, p.constituency_id) AS constituency_id, coalesce(n.source, p.source) AS source,
       coalesce(p.rank, 0) AS previous_rank, coalesce(n.rank, 0) AS new_rank
FROM n FULL JOIN p ON n.constituency_id = p.constituency_id AND n.source = p.source""")
def _(spark, d):
    worst = lambda y: links(spark, d).filter(F.year("forecast_date") == y).groupBy("constituency_id", "source").agg(F.max("rank").alias("rank"))
    return forecast.compare(worst(2000), worst(1999), ["constituency_id", "source"]).select("constituency_id", "source", "previous_rank", "new_rank")


LOG_SQL = """
versions AS (SELECT o_orderkey AS statement_id, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS last_modified_at, o_orderdate AS issued_at FROM orders),
log AS (SELECT o_orderkey AS statement_id, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'older' ELSE o_orderpriority END AS last_modified_at
        FROM orders WHERE o_totalprice > 50000)"""


def _versions(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    work = o.select(k.alias("statement_id"), F.when(k % 4 != 0, F.col("o_orderpriority")).alias("last_modified_at"), F.col("o_orderdate").alias("issued_at"))
    done = o.filter("o_totalprice > 50000").select(k.alias("statement_id"), F.when(k % 4 == 0, None).when(k % 7 == 0, "older").otherwise(
        F.col("o_orderpriority")).alias("last_modified_at"))
    return work, done


@query("j06_version_matched_join", with_ctes(LOG_SQL) + """
SELECT v.statement_id FROM versions v JOIN log l ON l.statement_id = v.statement_id AND coalesce(l.last_modified_at, '') = coalesce(v.last_modified_at, '')""")
def _(spark, d):
    return upsert.complete(*_versions(spark, d), "statement_id", "last_modified_at").select("statement_id")


@query("k18_incremental_work_list", with_ctes(LOG_SQL) + """
SELECT v.statement_id FROM versions v WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.statement_id = v.statement_id
  AND coalesce(l.last_modified_at, '') = coalesce(v.last_modified_at, ''))""")
def _(spark, d):
    return upsert.outstanding(*_versions(spark, d), "statement_id", "last_modified_at").select("statement_id")


@query("k20_no_change_test", with_ctes(LOG_SQL) + """
SELECT v.statement_id, v.last_modified_at FROM versions v WHERE v.last_modified_at IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM log l WHERE l.statement_id = v.statement_id AND l.last_modified_at = v.last_modified_at)""")
def _(spark, d):
    work, done = _versions(spark, d)
    return upsert.only_new(done, work.filter("last_modified_at IS NOT NULL"), ["statement_id", "last_modified_at"]).select("statement_id", "last_modified_at")


@query("l01_latest_complete_statements", with_ctes(LOG_SQL) + """
SELECT v.statement_id FROM versions v JOIN log l ON l.statement_id = v.statement_id AND coalesce(l.last_modified_at, '') = coalesce(v.last_modified_at, '')
ORDER BY v.issued_at DESC, v.statement_id DESC LIMIT 12""")
def _(spark, d):
    return forecast.latest_complete(*_versions(spark, d), 12).select("statement_id")


@query("j07_left_anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def _(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct(), "c_custkey", "left_anti").select("c_custkey")


@query("j08_anti_by_null_test", "SELECT p_partkey FROM part LEFT JOIN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 45) ON l_partkey = p_partkey WHERE l_partkey IS NULL")
def _(spark, d):
    used = table(spark, d, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey")).distinct()
    return table(spark, d, "part").join(used, "p_partkey", "left_anti").select("p_partkey")


@query("j10_semi_join", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def _(spark, d):
    returned = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return table(spark, d, "orders").join(returned, "o_orderkey", "left_semi").select("o_orderkey")


@query("j11_normalised_key_join", """
SELECT s_suppkey, n_nationkey FROM supplier JOIN nation
ON regexp_replace(lower('Nation & ' || s_nationkey), '[^a-z0-9]', '', 'g') = replace(regexp_replace(lower(n_name), '[^a-z0-9]', '', 'g'), 'nation', 'nation')
   OR replace(lower('Nation & ' || s_nationkey), ' & ', 'and') = regexp_replace(replace(lower(n_name), 'nation_', 'nationand'), '[^a-z0-9]', '', 'g')""")
def _(spark, d):
    from freshet.functions.text import name_key

    s = table(spark, d, "supplier").select("s_suppkey", name_key(F.concat(F.lit("Nátion & "), F.col("s_nationkey").cast("string"))).alias("k"))
    n = table(spark, d, "nation").select("n_nationkey", name_key(F.replace(F.col("n_name"), F.lit("_"), F.lit(" and "))).alias("k"))
    return s.join(n, "k").select("s_suppkey", "n_nationkey")


# ---- aggregates ----------------------------------------------------------------------------------------------

CELLS_SQL = """,
cells AS (SELECT statement_id, constituency_id, forecast_date, source, max(rank) AS rank FROM counted GROUP BY ALL)"""


@query("a01_worst_rank_per_cell", with_ctes(FORECAST_SQL) + CELLS_SQL + " SELECT * FROM cells")
def _(spark, d):
    return forecast.worst_by_cell(links(spark, d))


@query("a02_conditional_distinct_counts", with_ctes(FORECAST_SQL) + """
SELECT statement_id, count(DISTINCT CASE WHEN rk >= 1 THEN constituency_id END) AS flagged, count(DISTINCT CASE WHEN rk >= 3 THEN constituency_id END) AS medium_plus
FROM (SELECT statement_id, constituency_id, max(rank) AS rk FROM counted GROUP BY ALL) GROUP BY statement_id""")
def _(spark, d):
    return forecast.headline_counts(links(spark, d))


@query("a02_warnings_by_severity", with_ctes(WARNINGS_SQL) + """
SELECT constituency_id, count(DISTINCT CASE WHEN severity_level = 1 THEN area_code END) AS severe_warnings,
  count(DISTINCT CASE WHEN severity_level = 2 THEN area_code END) AS warnings, count(DISTINCT CASE WHEN severity_level = 3 THEN area_code END) AS alerts
FROM warning_contacts WHERE is_in_force GROUP BY constituency_id""")
def _(spark, d):
    return forecast.warning_counts(_warning_contacts(spark, d))


def _warning_contacts(spark, d):
    lookup = area_lookup(spark, d).join(constituencies(spark, d).withColumnRenamed("name", "constituency_name"), "constituency_id")
    return forecast.warning_contacts(current_warnings(spark, d), lookup, members(spark, d))


PIVOT_SQL = """,
day_cells AS (SELECT {k}, forecast_date, day_index, source, max(rank) AS rk FROM counted WHERE rank > 0 GROUP BY ALL),
worst AS (SELECT {k}, max(rk) AS worst_rank FROM day_cells GROUP BY ALL),
pivot_rows AS (
  SELECT {k}, worst_rank, min(CASE WHEN rk = worst_rank THEN forecast_date END) AS worst_date,
    string_agg(DISTINCT CASE WHEN rk = worst_rank THEN source END, ', ' ORDER BY CASE WHEN rk = worst_rank THEN source END) AS worst_sources,
    max(CASE WHEN day_index = 1 THEN rk END) AS rank_day1, max(CASE WHEN day_index = 2 THEN rk END) AS rank_day2,
    max(CASE WHEN day_index = 3 THEN rk END) AS rank_day3, max(CASE WHEN day_index = 4 THEN rk END) AS rank_day4,
    max(CASE WHEN day_index = 5 THEN rk END) AS rank_day5
  FROM day_cells JOIN worst USING ({k}) GROUP BY {k}, worst_rank)"""
BY_STATEMENT = PIVOT_SQL.replace("{k}", "statement_id, constituency_id")
BY_AREA = PIVOT_SQL.replace("{k}", "constituency_id")


@query("a03_situation_pivot_by_day", with_ctes(FORECAST_SQL) + BY_AREA + " SELECT * FROM pivot_rows")
def _(spark, d):
    contacts = forecast.counted(links(spark, d), 0.01).withColumnRenamed("rank", "risk_rank")
    return forecast.situation_pivot(contacts, ["constituency_id"])


CHANGES_SQL = CELLS_SQL + """,
day1 AS (SELECT s.statement_id, s.issued_at, coalesce(min(l.forecast_date - (l.day_index - 1)), CAST(s.issued_at AS DATE)) AS d1
         FROM statements s LEFT JOIN links l USING (statement_id) GROUP BY s.statement_id, s.issued_at),
pairs AS (SELECT statement_id, lag(statement_id) OVER w AS previous_statement_id, d1, lag(d1) OVER w AS p1 FROM day1 WINDOW w AS (ORDER BY issued_at, statement_id)),
shared AS (SELECT *, greatest(d1, p1) AS first_day, least(d1, p1) + 4 AS last_day FROM pairs WHERE previous_statement_id IS NOT NULL),
new_cells AS (SELECT s.statement_id, s.previous_statement_id, s.d1, constituency_id, forecast_date, source, rank FROM cells c JOIN shared s USING (statement_id)
              WHERE forecast_date BETWEEN first_day AND last_day),
old_cells AS (SELECT s.statement_id, s.previous_statement_id, s.d1, constituency_id, forecast_date, source, rank FROM cells c
              JOIN shared s ON s.previous_statement_id = c.statement_id WHERE forecast_date BETWEEN first_day AND last_day),
both_cells AS (SELECT statement_id, previous_statement_id, d1, constituency_id, forecast_date, source, coalesce(o.rank, 0) AS previous_rank, coalesce(n.rank, 0) AS new_rank
               FROM new_cells n FULL JOIN old_cells o USING (statement_id, previous_statement_id, d1, constituency_id, forecast_date, source)),
changes AS (SELECT statement_id, previous_statement_id, constituency_id, forecast_date, source, date_diff('day', d1, forecast_date) + 1 AS day_index,
              previous_rank, new_rank, new_rank - previous_rank AS rank_change,
              CASE WHEN previous_rank = 0 THEN 'new' WHEN new_rank = 0 THEN 'cleared' WHEN new_rank > previous_rank THEN 'escalated' ELSE 'de_escalated' END AS change_type
            FROM both_cells WHERE previous_rank <> new_rank)"""


@stored
def _changes(spark, d):
    return forecast.changes(links(spark, d), statements(spark, d))


@query("p06_statement_changes", with_ctes(FORECAST_SQL) + CHANGES_SQL + " SELECT * FROM changes")
def _(spark, d):
    return forecast.changes(links(spark, d), statements(spark, d))


@query("a07_change_classification", with_ctes(FORECAST_SQL) + CHANGES_SQL + " SELECT change_type, rank_change, count(*) AS n FROM changes GROUP BY ALL")
def _(spark, d):
    return _changes(spark, d).groupBy("change_type", "rank_change").agg(F.count(F.lit(1)).alias("n"))


@query("a06_day_one_dates", with_ctes(FORECAST_SQL) + CHANGES_SQL + " SELECT statement_id, d1 AS day1 FROM day1")
def _(spark, d):
    return forecast.day_one(links(spark, d), statements(spark, d)).select("statement_id", "day1")


@query("a08_changes_log", with_ctes(FORECAST_SQL) + CHANGES_SQL + """,
head AS (SELECT statement_id, count(DISTINCT CASE WHEN rk >= 1 THEN constituency_id END) AS flagged, count(DISTINCT CASE WHEN rk >= 3 THEN constituency_id END) AS medium_plus
         FROM (SELECT statement_id, constituency_id, max(rank) AS rk FROM counted GROUP BY ALL) GROUP BY statement_id)
SELECT s.statement_id, s.previous_statement_id, CASE WHEN first_day <= last_day THEN first_day END AS days_from, CASE WHEN first_day <= last_day THEN last_day END AS days_to,
  (SELECT count(*) FROM changes c WHERE c.statement_id = s.statement_id) AS n_changes, CASE WHEN first_day <= last_day THEN 'compared' ELSE 'no_shared_days' END AS status,
  coalesce(p.flagged, 0) AS flagged_previous, coalesce(n.flagged, 0) AS flagged_new, coalesce(p.medium_plus, 0) AS medium_plus_previous, coalesce(n.medium_plus, 0) AS medium_plus_new
FROM shared s LEFT JOIN head n ON n.statement_id = s.statement_id LEFT JOIN head p ON p.statement_id = s.previous_statement_id""")
def _(spark, d):
    return forecast.changes_log(_changes(spark, d), links(spark, d), statements(spark, d))


@query("l05_latest_escalations", with_ctes(FORECAST_SQL) + CHANGES_SQL + """
SELECT constituency_id, forecast_date, source, previous_rank, new_rank, change_type FROM changes
WHERE statement_id = (SELECT max(statement_id) FROM changes) AND change_type IN ('escalated', 'new')""")
def _(spark, d):
    return forecast.latest_escalations(_changes(spark, d)).select("constituency_id", "forecast_date", "source", "previous_rank", "new_rank", "change_type")


@query("w04_last_statement_of_each_day", """
SELECT CAST(o_orderdate AS DATE) AS issue_date, max(o_orderkey) AS statement_id FROM orders GROUP BY 1""")
def _(spark, d):
    s = table(spark, d, "orders").select(F.col("o_orderkey").alias("statement_id"), F.col("o_orderdate").alias("issued_at"))
    return forecast.last_of_each_day(s).select("issue_date", "statement_id")


@query("w05_worst_row_per_cell", with_ctes(FORECAST_SQL) + """
SELECT constituency_id, forecast_date, source, poly_id, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY constituency_id, forecast_date, source ORDER BY rank DESC, coalesce(share, -1) DESC, poly_id) AS n FROM links) WHERE n = 1""")
def _(spark, d):
    from freshet.operators.pick import first_per_key

    worst = first_per_key(links(spark, d), ["constituency_id", "forecast_date", "source"], [-F.col("rank"), -F.coalesce("share", F.lit(-1.0)), F.col("poly_id")])
    return worst.select("constituency_id", "forecast_date", "source", "poly_id", "rank")


EXPOSURE_SQL = """,
first_day AS (SELECT l.statement_id, CAST(s.issued_at AS DATE) AS issue_date, constituency_id, forecast_date AS d, source, max(rank) AS rk
              FROM counted l JOIN statements s USING (statement_id) WHERE day_index = 1 GROUP BY ALL),
covered AS (SELECT s.statement_id, coalesce(min(f.d), CAST(s.issued_at AS DATE)) AS d1 FROM statements s LEFT JOIN first_day f USING (statement_id)
            GROUP BY s.statement_id, s.issued_at),
cover AS (SELECT strftime(d1, '%Y-%m') AS month, count(DISTINCT d1) AS days_covered FROM covered GROUP BY 1),
exposure_cells AS (SELECT constituency_id, d, source, max(rk) AS rk FROM first_day GROUP BY ALL
                   UNION ALL SELECT constituency_id, d, 'any', max(rk) FROM first_day GROUP BY ALL),
exposure AS (
  SELECT constituency_id, strftime(d, '%Y-%m') AS month, source, count(*) FILTER (rk = 1) AS days_very_low, count(*) FILTER (rk = 2) AS days_low,
    count(*) FILTER (rk = 3) AS days_medium, count(*) FILTER (rk = 4) AS days_high, count(*) FILTER (rk >= 3) AS days_medium_or_above,
    count(*) AS days_flagged, max(rk) AS worst_rank, max(days_covered) AS days_covered,
    CASE max(rk) WHEN 1 THEN 'Very Low' WHEN 2 THEN 'Low' WHEN 3 THEN 'Medium' WHEN 4 THEN 'High' END AS worst_level
  FROM exposure_cells JOIN cover ON month = strftime(d, '%Y-%m') WHERE rk >= 1 GROUP BY constituency_id, strftime(d, '%Y-%m'), source)"""


@query("p09_monthly_exposure", with_ctes(FORECAST_SQL) + EXPOSURE_SQL + " SELECT * FROM exposure")
def _(spark, d):
    return forecast.monthly_exposure(links(spark, d), statements(spark, d))


@query("a05_exposure_any_source", with_ctes(FORECAST_SQL) + EXPOSURE_SQL + " SELECT constituency_id, month, days_flagged, worst_rank FROM exposure WHERE source = 'any'")
def _(spark, d):
    return forecast.monthly_exposure(links(spark, d), statements(spark, d)).filter("source = 'any'").select(
        "constituency_id", "month", "days_flagged", "worst_rank")


@query("l02_most_exposed", with_ctes(FORECAST_SQL) + EXPOSURE_SQL + """
SELECT constituency_id, sum(days_medium_or_above) AS days_medium_or_above FROM exposure WHERE source = 'any' AND month >= '2000-08'
GROUP BY constituency_id ORDER BY 2 DESC, 1 LIMIT 20""")
def _(spark, d):
    return forecast.most_exposed(forecast.monthly_exposure(links(spark, d), statements(spark, d)), F.lit("2000-08"), 20)


# ---- contacts and situation ----------------------------------------------------------------------------------


@query("p03_warning_contacts", with_ctes(WARNINGS_SQL, MEMBERS_SQL) + """
SELECT w.area_code, w.constituency_id, w.severity_level, w.share, w.is_in_force, m.name AS mp_name, m.member_id IS NOT NULL AS mp_matched
FROM warning_contacts w JOIN constituencies c USING (constituency_id) LEFT JOIN one_member m USING (name_key)""")
def _(spark, d):
    return _warning_contacts(spark, d).select("area_code", "constituency_id", "severity_level", "share", "is_in_force", "mp_name", "mp_matched")


@query("j07_warnings_without_constituency", with_ctes(WARNINGS_SQL) + "SELECT area_code FROM warnings WHERE area_code NOT IN (SELECT area_code FROM warning_contacts)")
def _(spark, d):
    return forecast.without_constituency(current_warnings(spark, d), _warning_contacts(spark, d)).select("area_code")


@query("p04_forecast_contacts", with_ctes(FORECAST_SQL, MEMBERS_SQL) + """
SELECT l.statement_id, l.poly_id, l.day_index, l.source, l.constituency_id, l.rank AS risk_rank, l.share, m.name AS mp_name
FROM counted l JOIN constituencies c USING (constituency_id) LEFT JOIN one_member m USING (name_key)""")
def _(spark, d):
    named = links(spark, d).join(constituencies(spark, d).withColumnRenamed("name", "constituency_name"), "constituency_id")
    return forecast.forecast_contacts(named, members(spark, d)).select(
        "statement_id", "poly_id", "day_index", "source", "constituency_id", "risk_rank", "share", "mp_name")


SITUATION_SQL = BY_AREA + CHANGES_SQL + """,
wn AS (SELECT constituency_id, count(DISTINCT CASE WHEN severity_level = 1 THEN area_code END) AS severe_warnings,
  count(DISTINCT CASE WHEN severity_level = 2 THEN area_code END) AS warnings, count(DISTINCT CASE WHEN severity_level = 3 THEN area_code END) AS alerts
  FROM warning_contacts WHERE is_in_force GROUP BY constituency_id),
chg AS (SELECT constituency_id, count(*) AS n, max(CASE WHEN change_type IN ('escalated', 'new') THEN 1 ELSE 0 END) AS esc FROM changes
        WHERE statement_id = (SELECT max(statement_id) FROM changes) GROUP BY constituency_id),
situation AS (
  SELECT c.constituency_id, c.name AS constituency_name, m.member_id IS NOT NULL AS mp_matched, m.member_id AS mp_member_id, m.name AS mp_name, m.email AS mp_email,
    coalesce(p.worst_rank, 0) AS worst_rank,
    CASE coalesce(p.worst_rank, 0) WHEN 1 THEN 'Very Low' WHEN 2 THEN 'Low' WHEN 3 THEN 'Medium' WHEN 4 THEN 'High' ELSE 'None' END AS worst_level,
    p.worst_date, p.worst_sources, coalesce(rank_day1, 0) AS rank_day1, coalesce(rank_day2, 0) AS rank_day2, coalesce(rank_day3, 0) AS rank_day3,
    coalesce(rank_day4, 0) AS rank_day4, coalesce(rank_day5, 0) AS rank_day5, coalesce(chg.n, 0) > 0 AS changed, coalesce(chg.esc, 0) = 1 AS escalated,
    coalesce(severe_warnings, 0) AS severe_warnings, coalesce(warnings, 0) AS warnings, coalesce(alerts, 0) AS alerts,
    coalesce(severe_warnings, 0) + coalesce(warnings, 0) + coalesce(alerts, 0) > 0 AS has_active_warning
  FROM constituencies c LEFT JOIN one_member m USING (name_key) LEFT JOIN pivot_rows p USING (constituency_id) LEFT JOIN wn USING (constituency_id)
  LEFT JOIN chg USING (constituency_id))"""
SITUATION = with_ctes(FORECAST_SQL, WARNINGS_SQL, MEMBERS_SQL) + SITUATION_SQL


def _situation(spark, d):
    contacts = forecast.counted(links(spark, d), 0.01).withColumnRenamed("rank", "risk_rank")
    newest = _changes(spark, d)
    newest = newest.join(newest.agg(F.max("statement_id").alias("statement_id")), "statement_id", "left_semi")
    return forecast.situation(constituencies(spark, d), members(spark, d), contacts, _warning_contacts(spark, d), newest)


@stored
def _situations(spark, d):
    return _situation(spark, d)


@query("p07_constituency_situation", SITUATION + " SELECT * FROM situation")
def _(spark, d):
    return _situation(spark, d)


@query("j04_multi_way_left_join_defaults", SITUATION + " SELECT constituency_id, worst_rank, changed, warnings, alerts FROM situation")
def _(spark, d):
    return _situations(spark, d).select("constituency_id", "worst_rank", "changed", "warnings", "alerts")


@query("l03_watch_list", SITUATION + " SELECT constituency_name, mp_name, worst_rank, severe_warnings, warnings FROM situation WHERE worst_rank >= 2 OR has_active_warning")
def _(spark, d):
    return forecast.watch_list(_situations(spark, d)).select("constituency_name", "mp_name", "worst_rank", "severe_warnings", "warnings")


@query("l04_headline_counters", SITUATION + """
SELECT count(*) FILTER (worst_rank >= 3) AS at_risk_medium_or_above, count(*) FILTER (escalated) AS escalated, count(*) FILTER (has_active_warning) AS with_warning_or_alert
FROM situation""")
def _(spark, d):
    return forecast.headline(_situations(spark, d))


@query("a04_past_situations", with_ctes(FORECAST_SQL, MEMBERS_SQL) + BY_STATEMENT + CHANGES_SQL + """
SELECT a.statement_id, c.constituency_id, c.name AS constituency_name, m.name AS mp_name, coalesce(p.worst_rank, 0) AS worst_rank, p.worst_date, p.worst_sources,
  coalesce(rank_day1, 0) AS rank_day1, coalesce(rank_day5, 0) AS rank_day5,
  CASE WHEN s.statement_id IS NOT NULL THEN EXISTS (SELECT 1 FROM changes x WHERE x.statement_id = a.statement_id AND x.constituency_id = c.constituency_id
       AND x.change_type IN ('escalated', 'new')) END AS escalated, CAST(NULL AS BIGINT) AS warnings
FROM (SELECT DISTINCT statement_id FROM statements) a CROSS JOIN constituencies c LEFT JOIN pivot_rows p ON p.statement_id = a.statement_id AND p.constituency_id = c.constituency_id
LEFT JOIN one_member m USING (name_key) LEFT JOIN shared s ON s.statement_id = a.statement_id""")
def _(spark, d):
    return _past(spark, d).select(
        "statement_id", "constituency_id", "constituency_name", "mp_name", "worst_rank", "worst_date", "worst_sources", "rank_day1", "rank_day5", "escalated", "warnings")


@stored
def _past(spark, d):
    changed = _changes(spark, d)
    compared = forecast.statement_pairs(statements(spark, d))
    return forecast.past_situations(links(spark, d), statements(spark, d), constituencies(spark, d), members(spark, d), changed, compared)


# ---- briefings -----------------------------------------------------------------------------------------------


@query("l07_distinct_detail_rows", with_ctes(FORECAST_SQL) + "SELECT DISTINCT constituency_id, forecast_date, source, risk_level FROM links WHERE rank >= 1")
def _(spark, d):
    return links(spark, d).filter("rank >= 1").select("constituency_id", "forecast_date", "source", "risk_level").distinct()


@query("f36_day_dates", with_ctes(FORECAST_SQL) + """,
base AS (SELECT statement_id, min(day_index) AS k, arg_min(forecast_date, day_index) AS d FROM links GROUP BY statement_id)
SELECT statement_id, d + (1 - k) AS date_day1, d + (3 - k) AS date_day3, d + (5 - k) AS date_day5 FROM base""")
def _(spark, d):
    return briefing.day_dates(links(spark, d), ["statement_id"]).select("statement_id", "date_day1", "date_day3", "date_day5")


def _drafts(spark, d):
    past = _past(spark, d)
    detail = forecast.counted(links(spark, d), 0.01).filter("rank >= 1").select(
        "statement_id", "constituency_id", "source", F.col("rank").alias("risk_rank"), "forecast_date", "day_index",
        risk.impact_label(F.col("rank")).alias("impact_label"), risk.likelihood_label(F.col("day_index")).alias("likelihood_label"))
    areas = links(spark, d).select(
        "statement_id", "constituency_id", "source", F.col("rank").alias("risk_rank"), F.col("poly_id").alias("area_code"),
        F.when(F.col("poly_id") % 2 == 0, "flood_warning").otherwise("flood_alert").alias("area_kind"))
    return briefing.drafts(past, detail, areas, min_rank=3)


@query("p08_briefing_drafts", with_ctes(FORECAST_SQL, MEMBERS_SQL) + BY_STATEMENT + CHANGES_SQL + """,
wanted AS (SELECT p.*, c.name AS constituency_name, m.name AS mp_name, CAST(s.issued_at AS DATE) AS issued,
             CASE p.worst_rank WHEN 3 THEN 'Medium' ELSE 'High' END AS level, strftime(p.worst_date, '%A %-d %B %Y') AS worst_day
           FROM pivot_rows p JOIN constituencies c USING (constituency_id) LEFT JOIN one_member m USING (name_key) JOIN statements s USING (statement_id)
           WHERE p.worst_rank >= 3),
lines AS (SELECT statement_id, constituency_id, string_agg(DISTINCT '  - ' || CASE source WHEN 'river' THEN 'River flooding' WHEN 'coastal' THEN 'Coastal flooding'
            ELSE 'Surface water flooding' END || ': ' || CASE rank WHEN 3 THEN 'Significant' ELSE 'Extreme' END || ' impact, '
            || CASE day_index WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' WHEN 3 THEN 'High' WHEN 4 THEN 'Very High' ELSE 'Unknown' END || ' likelihood', chr(10)
            ORDER BY '  - ' || CASE source WHEN 'river' THEN 'River flooding' WHEN 'coastal' THEN 'Coastal flooding'
            ELSE 'Surface water flooding' END || ': ' || CASE rank WHEN 3 THEN 'Significant' ELSE 'Extreme' END || ' impact, '
            || CASE day_index WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' WHEN 3 THEN 'High' WHEN 4 THEN 'Very High' ELSE 'Unknown' END || ' likelihood') AS text
          FROM counted c JOIN wanted w USING (statement_id, constituency_id) WHERE c.rank = w.worst_rank AND c.forecast_date = w.worst_date GROUP BY ALL)
SELECT w.statement_id, w.constituency_id, 'Flood forecast: ' || level || ' risk for ' || constituency_name || ' on ' || worst_day AS subject,
  l.text AS behind, CASE WHEN mp_name IS NULL THEN true ELSE false END AS no_member
FROM wanted w JOIN lines l USING (statement_id, constituency_id)""")
def _(spark, d):
    drafts = _drafts(spark, d)
    behind = F.regexp_extract("body", r"(?s)Behind that risk:\n(.*?)\n\nThe forecast", 1)
    return drafts.select("statement_id", "constituency_id", "subject", behind.alias("behind"), F.col("mp_name").isNull().alias("no_member"))


@query("f35_briefing_text")
def _(spark, d):
    return _drafts(spark, d).select("statement_id", "constituency_id", "subject", "body", "is_escalation", "status")


@query("p08_backfill_window", with_ctes(FORECAST_SQL) + "SELECT statement_id FROM statements WHERE issued_at >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 365 DAY")
def _(spark, d):
    return briefing.backfill_window(statements(spark, d), "365d", F.lit("2001-08-01 00:00:00").cast("timestamp")).select("statement_id")


# ---- links ---------------------------------------------------------------------------------------------------

AREA_TREE_SQL = """
tree AS (SELECT p_partkey AS area_code, CASE WHEN p_partkey % 2 = 0 THEN 'flood_warning' ELSE 'flood_alert' END AS area_kind,
           CASE p_partkey % 4 WHEN 0 THEN 'FWF' WHEN 1 THEN 'WAF' WHEN 2 THEN 'FWC' ELSE 'WAC' END AS type_code,
           CASE WHEN p_size % 5 > 0 THEN CAST(p_partkey + p_size AS VARCHAR) END AS parent FROM part),
hits AS (SELECT l_orderkey AS statement_id, l_suppkey AS poly_id, CASE WHEN l_linestatus = 'O' THEN 'river' ELSE 'coastal' END AS source, l_partkey AS area_code
         FROM lineitem GROUP BY ALL),
rows_now AS (SELECT h.*, t.area_kind FROM hits h JOIN tree t USING (area_code))"""


def _tree(spark, d):
    k = F.col("p_partkey")
    tree = table(spark, d, "part").select(
        k.cast("string").alias("area_code"), F.when(k % 2 == 0, "flood_warning").otherwise("flood_alert").alias("area_kind"),
        F.element_at(F.array(F.lit("FWF"), F.lit("WAF"), F.lit("FWC"), F.lit("WAC")), (k % 4 + 1).cast("int")).alias("type_code"),
        F.when(F.col("p_size") % 5 > 0, (k + F.col("p_size")).cast("string")).alias("parent"))
    hits = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("statement_id"), F.col("l_suppkey").alias("poly_id"), F.when(F.col("l_linestatus") == "O", "river").otherwise("coastal").alias("source"),
        F.col("l_partkey").cast("string").alias("area_code")).distinct()
    return tree, hits.join(tree.select("area_code", "area_kind"), "area_code").withColumn("share", F.lit(0.5))


@query("j17_parent_link_expansion", with_ctes(AREA_TREE_SQL) + """
SELECT statement_id, poly_id, source, CAST(area_code AS VARCHAR) AS area_code, 'overlap' AS link_type FROM rows_now
UNION ALL
SELECT DISTINCT r.statement_id, r.poly_id, r.source, CAST(c.area_code AS VARCHAR), 'parent_alert' FROM rows_now r
JOIN tree c ON c.parent = CAST(r.area_code AS VARCHAR) AND c.area_kind = 'flood_warning'
WHERE r.area_kind = 'flood_alert' AND ((r.source = 'river' AND c.type_code IN ('FWF', 'WAF')) OR (r.source = 'coastal' AND c.type_code IN ('FWC', 'WAC')))
  AND NOT EXISTS (SELECT 1 FROM hits h WHERE h.statement_id = r.statement_id AND h.poly_id = r.poly_id AND h.source = r.source AND h.area_code = c.area_code)""")
def _(spark, d):
    tree, hits = _tree(spark, d)
    return forecast.parent_links(hits, tree).select("statement_id", "poly_id", "source", "area_code", "link_type")


@query("j17_unknown_parents", with_ctes(AREA_TREE_SQL) + """
SELECT CAST(area_code AS VARCHAR) AS area_code, parent FROM tree WHERE area_kind = 'flood_warning' AND parent IS NOT NULL
  AND parent NOT IN (SELECT CAST(area_code AS VARCHAR) FROM tree)""")
def _(spark, d):
    return forecast.unknown_parents(_tree(spark, d)[0]).select("area_code", "parent")


@query("j18_concern_areas_inherit_risk", """
SELECT l_orderkey AS statement_id, l_linenumber AS poly_id, l_suppkey AS risk_area_block_id, b.source, b.risk_level FROM lineitem
LEFT JOIN (SELECT o_orderkey, o_custkey % 100 AS block, o_orderstatus AS source, o_orderpriority AS risk_level FROM orders) b ON b.o_orderkey = l_orderkey AND b.block = l_suppkey""")
def _(spark, d):
    polygons = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("statement_id"), F.col("l_linenumber").alias("poly_id"), F.col("l_suppkey").alias("risk_area_block_id"))
    blocks = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("statement_id"), (F.col("o_custkey") % 100).alias("risk_area_block_id"), F.col("o_orderstatus").alias("source"),
        F.col("o_orderpriority").alias("risk_level"))
    return forecast.concern_with_risk(polygons, blocks).select("statement_id", "poly_id", "risk_area_block_id", "source", "risk_level")


# ---- warning change detection --------------------------------------------------------------------------------

SNAPSHOT_SQL = """
snap AS (SELECT user_id, event_type, ts, props, CASE event_type WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 ELSE 4 END AS level FROM events),
state AS (SELECT user_id, arg_max(level, ts) AS level, arg_max(props, ts) AS message, max(ts) AS at FROM snap WHERE ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY 1),
feed AS (SELECT user_id, arg_max(level, ts) AS level, arg_max(props, ts) AS message, max(ts) AS at FROM snap
         WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1)"""


def _snapshots(spark, d):
    e = table(spark, d, "events")
    level = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "view", 2).when(F.col("event_type") == "click", 3).otherwise(4)
    newest = lambda f: f.groupBy("user_id").agg(
        F.max_by(level, "ts").alias("level"), F.max_by("props", "ts").alias("message"), F.max("ts").alias("at"), F.max("ts").alias("ingested_at"))
    cut = lambda s: F.lit(s).cast("timestamp")
    state = newest(e.filter(F.col("ts") < cut("2024-01-16")))
    feed = newest(e.filter(F.col("ts") >= cut("2024-01-15")))
    return feed, state


@query("p05_warning_change_detection", with_ctes(SNAPSHOT_SQL) + """
SELECT coalesce(f.user_id, s.user_id) AS user_id, coalesce(f.level, s.level) AS level, coalesce(f.at, s.at) AS at,
  CASE WHEN s.user_id IS NULL THEN 'NEW' WHEN f.user_id IS NULL THEN 'CLOSED' WHEN f.level <> s.level THEN 'SEVERITY_CHANGE' ELSE 'MESSAGE_CHANGE' END AS change_type
FROM feed f FULL JOIN state s ON s.user_id = f.user_id
WHERE s.user_id IS NULL OR f.user_id IS NULL OR f.level <> s.level OR trim(f.message) <> trim(s.message)""")
def _(spark, d):
    feed, state = _snapshots(spark, d)
    guards.guard_empty_feed(feed, state, 50)
    changed = warnings.detect_changes(feed, state, "user_id", "level", "message", F.lit("2024-02-01").cast("timestamp_ntz"))
    return changed.select("user_id", "level", "at", "change_type")


LOG_KEY_SQL = "CAST(user_id AS VARCHAR) || '|' || change_type || '|' || level || '|' || strftime(\"at\", '%Y-%m-%d %H:%M:%S')"


@query("p05_change_log_ids", with_ctes(SNAPSHOT_SQL) + f""",
changed AS (SELECT coalesce(f.user_id, s.user_id) AS user_id, coalesce(f.level, s.level) AS level, coalesce(f.at, s.at) AS at,
  CASE WHEN s.user_id IS NULL THEN 'NEW' WHEN f.user_id IS NULL THEN 'CLOSED' WHEN f.level <> s.level THEN 'SEVERITY_CHANGE' ELSE 'MESSAGE_CHANGE' END AS change_type
FROM feed f FULL JOIN state s ON s.user_id = f.user_id WHERE s.user_id IS NULL OR f.user_id IS NULL OR f.level <> s.level OR trim(f.message) <> trim(s.message))
SELECT {url_id_sql(LOG_KEY_SQL)} AS log_id, user_id, change_type FROM changed""")
def _(spark, d):
    feed, state = _snapshots(spark, d)
    changed = warnings.detect_changes(feed, state, "user_id", "level", "message", F.lit("2024-02-01").cast("timestamp_ntz"))
    return warnings.with_log_id(changed.withColumn("at_text", F.date_format("at", "yyyy-MM-dd HH:mm:ss")), ["user_id", "change_type", "level", "at_text"]).select(
        "log_id", "user_id", "change_type")


# ---- health --------------------------------------------------------------------------------------------------


def _health(spark, d):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    e, n = table(spark, d, "events"), F.col("n")
    work, done = _versions(spark, d)
    situations = _situations(spark, d)        # written once for both checks
    checks = [
        health.age_check("newest_reading", e, "ts", now, 24.0, 72.0),
        health.age_check("newest_order", table(spark, d, "orders"), "o_orderdate", now, 100.0, 200.0, hours=24.0),
        health.age_check("live_readings_age", e, "ts", now, 12.0, None),
        health.count_check("intersections_pending", upsert.outstanding(work, done, "statement_id", "last_modified_at"), F.count(F.lit(1)),
                           [(n == 0, "ok"), (n >= 10, "fail")], "statements awaiting their intersections", "warn"),
        health.count_check("constituency_count", table(spark, d, "nation"), F.count(F.lit(1)), [(n >= 25, "ok")], "expected at least 25", "fail"),
        health.count_check("members_unmatched", situations.filter("NOT mp_matched"), F.count(F.lit(1)), [(n == 0, "ok"), (n <= 10, "info")],
                           "constituencies with no matched member", "warn"),
        health.age_check("situation_age", situations, "worst_date", now, 100.0, 200.0, hours=24.0),
        health.age_check("warnings_age", current_warnings(spark, d).filter("severity_level IN (1, 2, 3)"), "time_raised", now, 24.0, 72.0, empty="info"),
        health.count_check("warnings_unlinked", forecast.without_constituency(current_warnings(spark, d), _warning_contacts(spark, d)), F.count_distinct("area_code"),
                           [(n == 0, "ok")], "current warnings in no constituency", "warn"),
        health.age_check("member_details_age", _refreshed(spark, d), "refreshed_at", now, 30.0, 90.0, hours=24.0),
        health.count_check("member_count", members(spark, d), F.count(F.lit(1)), [(n >= 90, "ok")], "expected at least 90", "fail"),
        health.count_check("guidance_uncounted", _guidance_updates(spark, d).filter("is_present AND n_polygons > 0 AND NOT counted"), F.count(F.lit(1)), [(n == 0, "ok")],
                           "updates with polygons that are not counted yet, for information", "info"),
        health.quiet_age_check("guidance_feed_age", e.filter("event_type = 'signup'"), "ts", now, "time since the feed was last looked at, for information"),
        health.products_check("exposure_products", e.select(F.col("event_type").alias("product"), F.col("ts").alias("built_at")), PRODUCTS,
                              table(spark, d, "part").filter("p_size > 4"), table(spark, d, "part"), now, 0.5),
        health.range_check("exposure_people", table(spark, d, "customer"), F.sum(F.greatest("c_acctbal", F.lit(0.0))), 1e6, 1e9),
        health.missing_check("archive_age", "no check recorded yet", "info", spark)]
    return health.report(checks)


PRODUCTS = ["click", "purchase", "view", "grid"]


def _refreshed(spark, d):
    """Members with the day their details were last read: that of the latest shipment of the supplier behind them."""
    shipped = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("member_id")).agg(F.max("l_shipdate").alias("refreshed_at"))
    return members(spark, d).join(shipped, "member_id")


def _guidance_updates(spark, d):
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(k.alias("update_key"), (k % 11 != 0).alias("is_present"), (k % 3).alias("n_polygons"), (F.col("s_acctbal") > 0).alias("counted"))


HEALTH_SQL = with_ctes(FORECAST_SQL, WARNINGS_SQL, MEMBERS_SQL, LOG_SQL) + SITUATION_SQL + """,
ages AS (SELECT (SELECT date_diff('second', max(ts), TIMESTAMP '2024-02-01 00:00:00') / 3600.0 FROM events) AS reading,
                (SELECT date_diff('second', max(o_orderdate), TIMESTAMP '2024-02-01 00:00:00') / 86400.0 FROM orders) AS order_days),
counts AS (SELECT (SELECT count(*) FROM versions v WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.statement_id = v.statement_id
                     AND coalesce(l.last_modified_at, '') = coalesce(v.last_modified_at, ''))) AS pending, (SELECT count(*) FROM nation) AS places,
                  (SELECT count(*) FROM constituencies c LEFT JOIN one_member m USING (name_key) WHERE m.member_id IS NULL) AS unmatched,
                  (SELECT count(DISTINCT area_code) FROM warnings WHERE area_code NOT IN (SELECT area_code FROM warning_contacts)) AS unlinked, (SELECT count(*) FROM members) AS members,
                  (SELECT count(*) FROM supplier WHERE s_suppkey % 11 <> 0 AND s_suppkey % 3 > 0 AND NOT s_acctbal > 0) AS uncounted,
                  (SELECT count(*) FROM part WHERE p_size > 4) AS have, (SELECT count(*) FROM part) AS want, (SELECT sum(greatest(c_acctbal, 0.0)) FROM customer) AS people),
later AS (SELECT (SELECT date_diff('second', CAST(max(worst_date) AS TIMESTAMP), TIMESTAMP '2024-02-01 00:00:00') / 86400.0 FROM situation) AS situation,
                 (SELECT date_diff('second', max(time_raised), TIMESTAMP '2024-02-01 00:00:00') / 3600.0 FROM warnings WHERE severity_level <= 3) AS warned,
                 (SELECT date_diff('second', CAST(max(l_shipdate) AS TIMESTAMP), TIMESTAMP '2024-02-01 00:00:00') / 86400.0 FROM lineitem JOIN supplier ON s_suppkey = l_suppkey) AS refreshed,
                 (SELECT date_diff('second', max(ts), TIMESTAMP '2024-02-01 00:00:00') / 3600.0 FROM events WHERE event_type = 'signup') AS looked),
expected AS (SELECT unnest(['click', 'purchase', 'view', 'grid']) AS product, unnest([1, 2, 3, 4]) AS place),
built AS (SELECT e.place, e.product, max(ts) AS built_at FROM expected e LEFT JOIN events ON event_type = e.product GROUP BY ALL),
products AS (SELECT date_diff('microsecond', min(built_at), TIMESTAMP '2024-02-01 00:00:00') / 86400e6 AS age, count(built_at) AS there,
               'missing: ' || string_agg(product, ', ' ORDER BY place) FILTER (built_at IS NULL) AS missing FROM built),
problems AS (SELECT age, there, concat_ws('; ', missing, CASE WHEN age > 0.5 THEN printf('oldest is %.0f days old, warn over 0.5', age) END,
               CASE WHEN have < 0.9 * want THEN printf('%d rows for %d areas', have, want) END) AS text, printf('%d rows for %d areas', have, want) AS fine FROM products, counts),
checks AS (
  SELECT 'newest_reading' AS check_name, CASE WHEN reading > 72 THEN 'fail' WHEN reading > 24 THEN 'warn' ELSE 'ok' END AS status, printf('%.1f h', reading) AS value,
         'warn over 24, fail over 72' AS detail FROM ages
  UNION ALL SELECT 'newest_order', CASE WHEN order_days > 200 THEN 'fail' WHEN order_days > 100 THEN 'warn' ELSE 'ok' END, printf('%.1f days', order_days), 'warn over 100, fail over 200' FROM ages
  UNION ALL SELECT 'live_readings_age', CASE WHEN reading > 12 THEN 'warn' ELSE 'ok' END, printf('%.1f h', reading), 'warn over 12 (never fails)' FROM ages
  UNION ALL SELECT 'intersections_pending', CASE WHEN pending = 0 THEN 'ok' WHEN pending >= 10 THEN 'fail' ELSE 'warn' END, CAST(pending AS VARCHAR), 'statements awaiting their intersections' FROM counts
  UNION ALL SELECT 'constituency_count', CASE WHEN places >= 25 THEN 'ok' ELSE 'fail' END, CAST(places AS VARCHAR), 'expected at least 25' FROM counts
  UNION ALL SELECT 'members_unmatched', CASE WHEN unmatched = 0 THEN 'ok' WHEN unmatched <= 10 THEN 'info' ELSE 'warn' END, CAST(unmatched AS VARCHAR), 'constituencies with no matched member' FROM counts
  UNION ALL SELECT 'situation_age', CASE WHEN situation IS NULL OR situation > 200 THEN 'fail' WHEN situation > 100 THEN 'warn' ELSE 'ok' END, coalesce(printf('%.1f days', situation), ''), 'warn over 100, fail over 200' FROM later
  UNION ALL SELECT 'warnings_age', CASE WHEN warned IS NULL THEN 'info' WHEN warned > 72 THEN 'fail' WHEN warned > 24 THEN 'warn' ELSE 'ok' END, coalesce(printf('%.1f h', warned), ''), 'warn over 24, fail over 72' FROM later
  UNION ALL SELECT 'warnings_unlinked', CASE WHEN unlinked = 0 THEN 'ok' ELSE 'warn' END, CAST(unlinked AS VARCHAR), 'current warnings in no constituency' FROM counts
  UNION ALL SELECT 'member_details_age', CASE WHEN refreshed IS NULL OR refreshed > 90 THEN 'fail' WHEN refreshed > 30 THEN 'warn' ELSE 'ok' END, coalesce(printf('%.1f days', refreshed), ''), 'warn over 30, fail over 90' FROM later
  UNION ALL SELECT 'member_count', CASE WHEN members >= 90 THEN 'ok' ELSE 'fail' END, CAST(members AS VARCHAR), 'expected at least 90' FROM counts
  UNION ALL SELECT 'guidance_uncounted', CASE WHEN uncounted = 0 THEN 'ok' ELSE 'info' END, CAST(uncounted AS VARCHAR), 'updates with polygons that are not counted yet, for information' FROM counts
  UNION ALL SELECT 'guidance_feed_age', 'info', coalesce(printf('%.1f h', looked), ''), 'time since the feed was last looked at, for information' FROM later
  UNION ALL SELECT 'exposure_products', CASE WHEN there = 0 THEN 'info' WHEN text <> '' THEN 'warn' ELSE 'ok' END, CASE WHEN there = 0 THEN 'not built' ELSE printf('%.0f days', age) END,
              CASE WHEN there = 0 THEN 'no product yet' WHEN text <> '' THEN text ELSE fine END FROM problems
  UNION ALL SELECT 'exposure_people', CASE WHEN people BETWEEN 1e6 AND 1e9 THEN 'ok' ELSE 'warn' END, coalesce(format('{:,}', CAST(round_even(people, 0) AS BIGINT)), ''), 'expected 1,000,000 to 1,000,000,000' FROM counts
  UNION ALL SELECT 'archive_age', 'info', '', 'no check recorded yet'),
health AS (SELECT * FROM checks UNION ALL
  SELECT 'overall', arg_max(status, CASE status WHEN 'ok' THEN 0 WHEN 'info' THEN 1 WHEN 'warn' THEN 2 ELSE 3 END), '',
         'worst of the checks above' || coalesce('; failing: ' || string_agg(check_name, ', ' ORDER BY check_name) FILTER (status = 'fail'), '') FROM checks)
"""


@query("p28_feed_health", HEALTH_SQL + "SELECT check_name, status FROM health")
def _(spark, d):
    return _health(spark, d).select("check_name", "status")


@query("a37_health_checks_with_values", HEALTH_SQL + "SELECT * FROM health")
def _(spark, d):
    return _health(spark, d)


@query("l06_severity_ordered_listing", HEALTH_SQL + "SELECT * FROM health")
def _(spark, d):
    order = F.element_at(F.create_map(*[F.lit(x) for x in ("fail", 0, "warn", 1, "info", 2, "ok", 3)]), F.col("status"))
    return _health(spark, d).orderBy(order, "check_name").select("check_name", "status", "value", "detail")
