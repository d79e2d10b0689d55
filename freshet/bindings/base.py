"""Registration and the frames several families derive from the driver tables.

A frame has a Spark form and an SQL form (a CTE text) that compute the same columns from the same whole tables.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, its oracle."""
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [table(spark, folder, n) for n in names]


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def stored(build):
    """A product that later reports read as a table: written in the shared folder each time it is built."""
    from freshet.session import stored_table

    return lambda spark, folder: stored_table(build(spark, folder), build.__name__.strip("_"))


# ---- names: their words and how alike two of them are -------------------------------------------------------

def tokens_sql(name: str) -> str:
    from freshet.functions.text import FILLER_WORDS

    fillers = ", ".join(f"'{w}'" for w in FILLER_WORDS)
    return f"list_sort(list_distinct(list_filter(regexp_extract_all(lower({name}), '[a-z0-9]+'), lambda w: length(w) > 1 AND w NOT IN ({fillers}))))"


def similarity_sql(a: str, b: str) -> str:
    joined = [f"array_to_string({x}, ' ')" for x in (a, b)]
    return (f"CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN round(greatest(len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b})))::DOUBLE, "
            f"1 - levenshtein({joined[0]}, {joined[1]}) / greatest(length({joined[0]}), length({joined[1]}))::DOUBLE), 3) ELSE 0.0 END")


# ---- readings: one series per user, an archive and an overlapping live tail ---------------------------------

READINGS_SQL = """
readings AS (SELECT user_id, ts, CAST(ts AS DATE) AS reading_date, event_id, event_type, value FROM events),
archive AS (SELECT * FROM readings WHERE ts < TIMESTAMP '2024-01-20 00:00:00'),
live AS (SELECT * FROM readings WHERE ts >= TIMESTAMP '2024-01-18 12:00:00')"""


def readings(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    return e.select("user_id", "ts", F.to_date("ts").alias("reading_date"), "event_id", "event_type", "value")


def archive_and_live(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    r = readings(spark, folder)
    return (r.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp")),
            r.filter(F.col("ts") >= F.lit("2024-01-18 12:00:00").cast("timestamp")))


# ---- forecasts: one statement per order day, one link per order ----------------------------------------------

FORECAST_SQL = """
links AS (
  SELECT date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS statement_id, c_nationkey AS constituency_id,
         CAST(o_orderkey % 5 + 1 AS INTEGER) AS day_index,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER) AS forecast_date,
         CASE o_orderstatus WHEN 'F' THEN 'river' WHEN 'O' THEN 'coastal' ELSE 'surface' END AS source,
         5 - CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rank,
         CASE 5 - CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
           WHEN 1 THEN 'Very Low' WHEN 2 THEN 'Low' WHEN 3 THEN 'Medium' WHEN 4 THEN 'High' ELSE 'Unknown' END AS risk_level,
         CASE WHEN o_orderstatus <> 'O' THEN o_totalprice / 400000.0 END AS share, o_orderkey AS poly_id
  FROM orders JOIN customer ON c_custkey = o_custkey),
statements AS (
  SELECT DISTINCT date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS statement_id, o_orderdate AS issued_at FROM orders),
counted AS (SELECT * FROM links WHERE share IS NULL OR share >= 0.01)"""


def links(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer = tables(spark, folder, "orders", "customer")
    rank = 5 - F.substring("o_orderpriority", 1, 1).cast("int")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.date_diff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")).alias("statement_id"),
        F.col("c_nationkey").alias("constituency_id"), (F.col("o_orderkey") % 5 + 1).cast("int").alias("day_index"),
        F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 5).cast("int")).alias("forecast_date"),
        F.when(F.col("o_orderstatus") == "F", "river").when(F.col("o_orderstatus") == "O", "coastal").otherwise("surface").alias("source"),
        rank.alias("rank"), F.coalesce(F.element_at(F.create_map(*[F.lit(x) for x in (
            1, "Very Low", 2, "Low", 3, "Medium", 4, "High")]), rank), F.lit("Unknown")).alias("risk_level"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice") / 400000.0).alias("share"), F.col("o_orderkey").alias("poly_id"))


def statements(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.date_diff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")).alias("statement_id"),
        F.col("o_orderdate").alias("issued_at")).distinct()


MEMBERS_SQL = """
members AS (SELECT s_suppkey AS member_id, 'Nation-' || CAST(s_nationkey AS VARCHAR) AS constituency_name, s_name AS name,
                   lower(s_name) || '@example.org' AS email FROM supplier),
one_member AS (SELECT * FROM (SELECT *, regexp_replace(lower(constituency_name), '[^a-z0-9]', '', 'g') AS name_key,
                 row_number() OVER (PARTITION BY constituency_name ORDER BY member_id) AS rn FROM members) WHERE rn = 1),
constituencies AS (SELECT n_nationkey AS constituency_id, n_name AS name,
                     regexp_replace(lower(n_name), '[^a-z0-9]', '', 'g') AS name_key FROM nation)"""


def members(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("member_id"), F.concat(F.lit("Nation-"), F.col("s_nationkey").cast("string")).alias("constituency_name"),
        F.col("s_name").alias("name"), F.concat(F.lower("s_name"), F.lit("@example.org")).alias("email"))


def constituencies(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(F.col("n_nationkey").alias("constituency_id"), F.col("n_name").alias("name"))


WARNINGS_SQL = """
current AS (SELECT user_id AS area_code, arg_max(event_type, ts) AS event_type, max(ts) AS ts FROM events GROUP BY user_id),
warnings AS (SELECT area_code, CASE event_type WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 ELSE 4 END AS severity_level,
                    ts AS time_raised FROM current),
area_lookup AS (
  SELECT user_id AS area_code, CAST(user_id % 25 AS INTEGER) AS constituency_id, (user_id % 10) / 10.0 AS share FROM (SELECT DISTINCT user_id FROM events)
  UNION ALL
  SELECT user_id, CAST((user_id + 7) % 25 AS INTEGER), (user_id % 3) / 100.0 FROM (SELECT DISTINCT user_id FROM events)),
warning_contacts AS (
  SELECT w.area_code, l.constituency_id, w.severity_level, l.share, w.time_raised, w.severity_level IN (1, 2, 3) AS is_in_force
  FROM warnings w JOIN area_lookup l USING (area_code) WHERE l.share >= 0.01)"""


def current_warnings(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    latest = e.groupBy(F.col("user_id").alias("area_code")).agg(F.max_by("event_type", "ts").alias("event_type"), F.max("ts").alias("time_raised"))
    level = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "view", 2).when(F.col("event_type") == "click", 3).otherwise(4)
    return latest.select("area_code", level.alias("severity_level"), "time_raised")


def area_lookup(spark: SparkSession, folder: str) -> DataFrame:
    u = table(spark, folder, "events").select("user_id").distinct()
    nation = lambda k: ((F.col("user_id") + k) % 25).cast("int").alias("constituency_id")
    return u.select(F.col("user_id").alias("area_code"), nation(0), ((F.col("user_id") % 10) / 10.0).alias("share")).unionByName(
        u.select(F.col("user_id").alias("area_code"), nation(7), ((F.col("user_id") % 3) / 100.0).alias("share")))


# ---- warning messages: one area per user ---------------------------------------------------------------------

MESSAGES_SQL = """
messages AS (
  SELECT lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0') || CASE user_id % 3 WHEN 0 THEN 'FWF' WHEN 1 THEN 'WAC' ELSE 'XXX' END
           || CAST(user_id AS VARCHAR) AS area_code, ts AS time, user_id,
         CASE event_type WHEN 'signup' THEN 'flood_alert' WHEN 'purchase' THEN 'severe_flood_warning' WHEN 'error' THEN 'off'
           ELSE 'flood_warning' END AS level, event_id FROM events),
ordered AS (
  SELECT *, CASE level WHEN 'flood_alert' THEN 1 WHEN 'flood_warning' THEN 2 WHEN 'severe_flood_warning' THEN 3 END AS height,
         coalesce(sum(CASE WHEN level = 'off' THEN 1 ELSE 0 END) OVER (
           PARTITION BY area_code ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run,
         lag(level) OVER (PARTITION BY area_code ORDER BY time) AS prior_level FROM messages),
episodes AS (
  SELECT area_code, run, min(CASE WHEN level <> 'off' THEN time END) AS start_time, max(CASE WHEN level = 'off' THEN time END) AS end_time,
         arg_min(level, time) FILTER (level <> 'off') AS start_level, arg_max(level, height) FILTER (level <> 'off') AS peak_level,
         count(*) FILTER (level <> 'off') AS n_messages, min(user_id) AS user_id
  FROM ordered GROUP BY area_code, run HAVING count(*) FILTER (level <> 'off') > 0),
steps AS (
  SELECT *, lead(time) OVER w AS end_time, lead(level) OVER w AS next_level, lag(level) OVER w AS before_level, row_number() OVER w AS n
  FROM (SELECT * FROM ordered WHERE level = 'off' OR prior_level IS NULL OR prior_level = 'off' OR prior_level <> level)
  WINDOW w AS (PARTITION BY area_code, run ORDER BY time)),
periods AS (
  SELECT s.area_code, s.run, s.level, s.time AS start_time, s.end_time, s.n,
         CASE WHEN s.before_level IS NULL THEN 'issued'
              WHEN s.height > CASE s.before_level WHEN 'flood_alert' THEN 1 WHEN 'flood_warning' THEN 2 ELSE 3 END THEN 'upgraded' ELSE 'downgraded' END AS started_by,
         CASE WHEN s.next_level IS NULL THEN 'open' WHEN s.next_level = 'off' THEN 'no_longer_in_force'
              WHEN CASE s.next_level WHEN 'flood_alert' THEN 1 WHEN 'flood_warning' THEN 2 ELSE 3 END > s.height THEN 'upgraded' ELSE 'downgraded' END AS ended_by,
         round(epoch_us(coalesce(s.end_time, TIMESTAMP '2024-02-05 00:00:00')) / 6e7 - epoch_us(s.time) / 6e7, 1) AS minutes
  FROM steps s WHERE s.level <> 'off')"""


def messages(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.when(F.col("user_id") % 3 == 0, "FWF").when(F.col("user_id") % 3 == 1, "WAC").otherwise("XXX")
    level = (F.when(F.col("event_type") == "signup", "flood_alert").when(F.col("event_type") == "purchase", "severe_flood_warning")
             .when(F.col("event_type") == "error", "off").otherwise("flood_warning"))
    return table(spark, folder, "events").select(
        F.concat(F.lpad((F.col("user_id") % 1000).cast("string"), 3, "0"), kind, F.col("user_id").cast("string")).alias("area_code"),
        F.col("ts").alias("time"), "user_id", level.alias("level"), "event_id", F.lit("history_file").alias("origin"), F.lit("message").alias("kind"))


# ---- places: a point per customer, a box per part, a site per supplier ----------------------------------------

PLACES_SQL = """
points AS (
  SELECT c_custkey AS point_id, (c_custkey * 7919) % 100000 AS easting, (c_custkey * 104729) % 100000 AS northing,
         greatest(c_acctbal, 0.0) AS people, floor(greatest(c_acctbal, 0.0) / 2) AS households, floor(greatest(c_acctbal, 0.0) / 5) AS over65,
         c_custkey % 10 + 1 AS imd_decile, (c_custkey % 10 + 1) * 7.5 AS imd_score,
         CASE WHEN c_custkey % 7 = 0 THEN 'oa_centroid' ELSE 'nsul' END AS point_source,
         c_custkey % 5 AS rofrs_rank, c_custkey % 3 AS fz_rank, c_nationkey AS pcon, c_mktsegment AS lad FROM customer),
areas AS (
  SELECT p_partkey AS area_id, CASE WHEN p_partkey % 2 = 0 THEN 'flood_warning' ELSE 'flood_alert' END AS kind,
         (p_partkey * 613) % 90000 AS x0, (p_partkey * 977) % 90000 AS y0, (p_partkey * 613) % 90000 + 2000 + p_size * 100 AS x1,
         (p_partkey * 977) % 90000 + 2000 + p_size * 50 AS y1, p_brand, p_type, p_name FROM part),
members_of AS (SELECT a.kind, a.area_id, p.* FROM points p JOIN areas a ON p.easting BETWEEN a.x0 AND a.x1 AND p.northing BETWEEN a.y0 AND a.y1),
sites AS (
  SELECT s_suppkey AS site_id, (s_suppkey * 7919 + 37) % 100000 AS easting, (s_suppkey * 104729 + 91) % 100000 AS northing, s_name AS name,
         CASE s_nationkey % 4 WHEN 0 THEN 'health' WHEN 1 THEN 'education' WHEN 2 THEN 'emergency' ELSE 'utilities' END AS site_group,
         CASE WHEN s_acctbal < 3000 THEN 'postcode' ELSE 'surveyed' END AS source, s_suppkey % 5 AS rofrs_rank, s_suppkey % 3 AS fz_rank FROM supplier),
site_boxes AS (
  SELECT s_suppkey AS box_id, (s_suppkey * 613) % 90000 AS x0, (s_suppkey * 977) % 90000 AS y0, (s_suppkey * 613) % 90000 + 4000 AS x1,
         (s_suppkey * 977) % 90000 + 3000 AS y1, s_nationkey FROM supplier)"""


def points(spark: SparkSession, folder: str) -> DataFrame:
    k, people = F.col("c_custkey"), F.greatest(F.col("c_acctbal"), F.lit(0.0))
    return table(spark, folder, "customer").select(
        k.alias("point_id"), (k * 7919 % 100000).alias("easting"), (k * 104729 % 100000).alias("northing"), people.alias("people"),
        F.floor(people / 2).cast("double").alias("households"), F.floor(people / 5).cast("double").alias("over65"),
        (k % 10 + 1).alias("imd_decile"), ((k % 10 + 1) * 7.5).alias("imd_score"),
        F.when(k % 7 == 0, "oa_centroid").otherwise("nsul").alias("point_source"), (k % 5).alias("rofrs_rank"), (k % 3).alias("fz_rank"),
        F.col("c_nationkey").alias("pcon"), F.col("c_mktsegment").alias("lad"))


def areas(spark: SparkSession, folder: str) -> DataFrame:
    from freshet.functions.place import box_rings

    k = F.col("p_partkey")
    x0, y0 = k * 613 % 90000, k * 977 % 90000
    x1, y1 = x0 + 2000 + F.col("p_size") * 100, y0 + 2000 + F.col("p_size") * 50
    return table(spark, folder, "part").select(
        k.alias("area_id"), F.when(k % 2 == 0, "flood_warning").otherwise("flood_alert").alias("kind"), box_rings(x0, y0, x1, y1).alias("rings"),
        "p_brand", "p_type", "p_name")


def sites(spark: SparkSession, folder: str) -> DataFrame:
    k, n = F.col("s_suppkey"), F.col("s_nationkey") % 4
    return table(spark, folder, "supplier").select(
        k.alias("site_id"), ((k * 7919 + 37) % 100000).alias("easting"), ((k * 104729 + 91) % 100000).alias("northing"), F.col("s_name").alias("name"),
        F.when(n == 0, "health").when(n == 1, "education").when(n == 2, "emergency").otherwise("utilities").alias("site_group"),
        F.when(F.col("s_acctbal") < 3000, "postcode").otherwise("surveyed").alias("source"), (k % 5).alias("rofrs_rank"), (k % 3).alias("fz_rank"))


def site_boxes(spark: SparkSession, folder: str) -> DataFrame:
    from freshet.functions.place import box_rings

    k = F.col("s_suppkey")
    x0, y0 = k * 613 % 90000, k * 977 % 90000
    return table(spark, folder, "supplier").select(k.alias("box_id"), box_rings(x0, y0, x0 + 4000, y0 + 3000).alias("rings"), "s_nationkey")


def url_id_sql(key: str) -> str:
    """SQL for the version 5 identifier of a text expression in the URL namespace."""
    digest = f"sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({key}))"
    nibble = f"substr('89ab', (strpos('0123456789abcdef', substr({digest}, 17, 1)) - 1) % 4 + 1, 1)"
    return (f"substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-5' || substr({digest}, 14, 3) || '-' || {nibble} "
            f"|| substr({digest}, 18, 3) || '-' || substr({digest}, 21, 12)")
