"""People, sites and geographies: exposure products."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.bindings.base import PLACES_SQL, areas, points, query, site_boxes, sites, table, with_ctes
from freshet.bindings.place import LABELS, PIXEL_SQL, _pixels
from freshet.operators import guards, pick, proximity, tiles
from freshet.operators.scan import percent_rank_average
from freshet.operators.upsert import only_new
from freshet.session import stored_table
from freshet.plans import economics, exposure, grid
from freshet.sources import places
from freshet.sources import sites as site_sources

PLACES = with_ctes(PLACES_SQL)
DEPTH_SQL = PLACES + """,
deep AS (SELECT m.*, count(*) OVER (PARTITION BY kind, point_id) AS depth, CASE WHEN point_source = 'nsul' THEN 1.0 ELSE 0.0 END AS addresses,
           CASE WHEN rofrs_rank >= 3 THEN people ELSE 0 END AS people_hm FROM members_of m)"""


def _members(spark, d):
    return exposure.membership(points(spark, d), areas(spark, d))


def r2(*names):
    return [F.round(n, 2).alias(n) for n in names]


@query("f37_point_value_columns", PLACES + """
SELECT point_id, CASE WHEN point_source = 'nsul' THEN 1.0 ELSE 0.0 END AS addresses, people, CASE WHEN rofrs_rank = 4 THEN people ELSE 0 END AS people_rs_high,
  CASE WHEN rofrs_rank >= 3 THEN households ELSE 0 END AS households_rs_high_medium, CASE WHEN fz_rank = 2 THEN people ELSE 0 END AS people_fz3,
  CASE WHEN imd_decile <= 2 THEN people ELSE 0 END AS people_imd_1_2, people * imd_decile AS imd_w, 0.0 AS people_sw_high FROM points""")
def _(spark, d):
    return exposure.with_values(points(spark, d), ["point_id"]).select(
        "point_id", "addresses", "people", "people_rs_high", "households_rs_high_medium", "people_fz3", "people_imd_1_2", "imd_w", "people_sw_high")


@query("a20_gross_unique_split_per_area", DEPTH_SQL + """
SELECT kind, area_id, round(sum(people), 2) AS people, sum(addresses) AS addresses, round(sum(CASE WHEN depth = 1 THEN people ELSE 0 END), 2) AS people_unique,
  round(sum(people / depth), 6) AS people_split, round(sum(people_hm), 2) AS people_rs_high_medium FROM deep GROUP BY kind, area_id""")
def _(spark, d):
    f = exposure.area_figures(_members(spark, d), points(spark, d))
    return f.select("kind", "area_id", *r2("people"), "addresses", *r2("people_unique"), F.round("people_split", 6).alias("people_split"), *r2("people_rs_high_medium"))


@query("a24_derived_area_measures", DEPTH_SQL + """,
s AS (SELECT kind, area_id, sum(people) AS p, sum(CASE WHEN depth = 1 THEN people ELSE 0 END) AS u, sum(people * imd_decile) AS w, sum(people_hm) AS hm FROM deep GROUP BY 1, 2)
SELECT a.kind, a.area_id, round(coalesce(p, 0), 2) AS people, round(coalesce(p - u, 0), 2) AS people_shared, round(CASE WHEN p > 0 THEN w / p END, 1) AS decile,
  round(CASE WHEN p > 0 THEN hm / p END, 3) AS share_hm FROM areas a LEFT JOIN s ON s.kind = a.kind AND s.area_id = a.area_id""")
def _(spark, d):
    f = exposure.derived_measures(areas(spark, d), exposure.area_figures(_members(spark, d), points(spark, d)).withColumn("imd_raw", F.col("imd_w") / F.nullif(
        F.col("imd_wsum"), F.lit(0.0))).withColumn("hm_raw", F.col("people_rs_high_medium") / F.nullif(F.col("people"), F.lit(0.0))))
    has = F.col("people") > 0
    return f.select("kind", "area_id", *r2("people", "people_shared"), F.when(has, F.round("imd_raw", 1)).alias("decile"), F.when(has, F.round("hm_raw", 3)).alias("share_hm"))


@query("j28_area_pairs_sharing_points", DEPTH_SQL + """
SELECT a.kind, a.area_id AS area_a, b.area_id AS area_b, sum(a.addresses) AS addresses, round(sum(a.people), 2) AS people
FROM deep a JOIN deep b ON a.kind = b.kind AND a.point_id = b.point_id AND a.area_id < b.area_id GROUP BY 1, 2, 3""")
def _(spark, d):
    f = exposure.pair_overlaps(_members(spark, d), points(spark, d), ["addresses", "people"])
    return f.select("kind", "area_a", "area_b", "addresses", *r2("people"))


@query("a21_area_by_geography", DEPTH_SQL + """
SELECT kind, area_id, 'constituency' AS geography, CAST(pcon AS VARCHAR) AS code, round(sum(people), 2) AS people, sum(addresses) AS addresses FROM deep GROUP BY 1, 2, 4
UNION ALL SELECT kind, area_id, 'district', lad, round(sum(people), 2), sum(addresses) FROM deep GROUP BY 1, 2, 4""")
def _(spark, d):
    f = exposure.by_codes(_members(spark, d), points(spark, d), {"constituency": "pcon", "district": "lad"}, ["people", "addresses"])
    return f.select("kind", "area_id", "geography", "code", *r2("people"), "addresses")


@query("a21_share_of_area_people", DEPTH_SQL + """,
g AS (SELECT kind, area_id, lad AS code, sum(people) AS people FROM deep GROUP BY 1, 2, 3), t AS (SELECT kind, area_id, sum(people) AS total FROM deep GROUP BY 1, 2)
SELECT g.kind, g.area_id, g.code, round(g.people, 2) AS people, lower(g.code) AS name FROM g JOIN t USING (kind, area_id)""")
def _(spark, d):
    members, p = _members(spark, d), points(spark, d)
    coded = exposure.by_codes(members, p, {"district": "lad"}, ["people"])
    names = p.select(F.lit("district").alias("geography"), F.col("lad").alias("code"), F.lower("lad").alias("name")).distinct()
    return exposure.geography_shares(coded, exposure.area_figures(members, p), names).select("kind", "area_id", "code", *r2("people"), "name")


@query("j31_lookup_geography", DEPTH_SQL + """
SELECT kind, area_id, CAST(n_regionkey AS VARCHAR) AS code, round(sum(people), 2) AS people FROM deep JOIN nation ON n_nationkey = pcon WHERE n_regionkey <> 3 GROUP BY 1, 2, 3""")
def _(spark, d):
    lookup = table(spark, d, "nation").filter("n_regionkey <> 3").select(F.col("n_nationkey").alias("pcon"), "n_regionkey")
    coded = exposure.mapped_codes(points(spark, d), lookup, "pcon", "n_regionkey", "authority")
    f = exposure.by_codes(_members(spark, d), coded, {"authority": "authority"}, ["people"])
    return f.select("kind", "area_id", "code", *r2("people"))


FLAGS_SQL = PLACES + """,
flags AS (SELECT p.*, CASE WHEN point_source = 'nsul' THEN 1.0 ELSE 0.0 END AS addresses, CASE WHEN rofrs_rank >= 3 THEN people ELSE 0 END AS hm,
            EXISTS (SELECT 1 FROM members_of m WHERE m.point_id = p.point_id AND m.kind = 'flood_warning') AS w,
            EXISTS (SELECT 1 FROM members_of m WHERE m.point_id = p.point_id AND m.kind = 'flood_alert') AS a FROM points p)"""


def _flags(spark, d):
    return exposure.point_flags(_members(spark, d), points(spark, d), ["pcon"])


@query("a22_distinct_coverage_and_gap", FLAGS_SQL + """,
s AS (SELECT 'all' AS kind, sum(people) AS p, sum(hm) AS h, sum(addresses) AS n FROM flags UNION ALL SELECT 'flood_warning', sum(people), sum(hm), sum(addresses) FROM flags WHERE w
      UNION ALL SELECT 'flood_alert', sum(people), sum(hm), sum(addresses) FROM flags WHERE a)
SELECT kind, round(p, 2) AS people, n AS addresses, round(CASE WHEN kind = 'all' THEN 0 ELSE (SELECT p FROM s WHERE kind = 'all') - p END, 2) AS people_not_in_area,
  round(CASE WHEN kind = 'all' THEN 0 ELSE (SELECT h FROM s WHERE kind = 'all') - h END, 2) AS people_high_medium_not_in_area FROM s""")
def _(spark, d):
    return exposure.distinct_coverage(_flags(spark, d)).select("kind", *r2("people"), "addresses", *r2("people_not_in_area", "people_high_medium_not_in_area"))


@query("a23_constituency_gap", FLAGS_SQL + """
SELECT pcon, round(sum(people), 2) AS people, round(sum(CASE WHEN w THEN people ELSE 0 END), 2) AS people_in_warning_area, round(sum(CASE WHEN a THEN people ELSE 0 END), 2) AS people_in_alert_area,
  round(sum(hm) - sum(CASE WHEN w THEN hm ELSE 0 END), 2) AS people_high_medium_not_in_warning_area FROM flags GROUP BY pcon""")
def _(spark, d):
    f = exposure.coverage_by_code(_flags(spark, d), "pcon")
    return f.select("pcon", *r2("people", "people_in_warning_area", "people_in_alert_area", "people_high_medium_not_in_warning_area"))


@query("a26_geography_exposure", PLACES + """,
v AS (SELECT *, CASE WHEN point_source = 'nsul' THEN 1.0 ELSE 0.0 END AS addresses FROM points)
SELECT 'constituency' AS geography, CAST(pcon AS VARCHAR) AS code, sum(addresses) AS addresses, round(sum(people), 2) AS people, round(sum(CASE WHEN rofrs_rank = 4 THEN people ELSE 0 END), 2) AS people_rs_high FROM v GROUP BY pcon
UNION ALL SELECT 'district', lad, sum(addresses), round(sum(people), 2), round(sum(CASE WHEN rofrs_rank = 4 THEN people ELSE 0 END), 2) FROM v GROUP BY lad""")
def _(spark, d):
    f = exposure.geography_exposure(points(spark, d), {"constituency": "pcon", "district": "lad"})
    return f.select("geography", "code", "addresses", *r2("people", "people_rs_high"))


@query("j30_lookup_roll_up", PLACES + """
SELECT n_regionkey AS geography_code, round(sum(people), 2) AS people, count(DISTINCT n_nationkey) AS districts FROM points JOIN nation ON n_nationkey = pcon GROUP BY 1""")
def _(spark, d):
    by_district = points(spark, d).groupBy(F.col("pcon").alias("code")).agg(F.sum("people").alias("people"))
    lookup = table(spark, d, "nation").select(F.col("n_nationkey").alias("district_code"), F.lit("region").alias("geography"), F.col("n_regionkey").alias("geography_code"),
                                              F.col("n_regionkey").cast("string").alias("geography_name"))
    return exposure.rollup_through(by_district, lookup, ["people"]).select("geography_code", *r2("people"), "districts")


# ---- sites ---------------------------------------------------------------------------------------------------

SITE_MEMBERS_SQL = PLACES + """,
inside AS (SELECT a.kind, a.area_id, s.* FROM sites s JOIN areas a ON s.easting BETWEEN a.x0 AND a.x1 AND s.northing BETWEEN a.y0 AND a.y1)"""


@query("j36_site_membership_list", SITE_MEMBERS_SQL + """
SELECT kind, area_id, site_id, name, site_group, CASE rofrs_rank WHEN 4 THEN 'High' WHEN 3 THEN 'Medium' WHEN 2 THEN 'Low' WHEN 1 THEN 'Very Low' ELSE 'None' END AS band FROM inside""")
def _(spark, d):
    return exposure.site_list(sites(spark, d), areas(spark, d), keep=["site_id", "name", "site_group"]).select("kind", "area_id", "site_id", "name", "site_group", "band")


@query("a19_sites_per_area", SITE_MEMBERS_SQL + """
SELECT kind, area_id, count(*) AS sites, count(*) FILTER (site_group = 'health') AS sites_health, count(*) FILTER (rofrs_rank >= 3) AS sites_rs_high_medium,
  count(*) FILTER (fz_rank = 2) AS sites_fz3 FROM inside GROUP BY kind, area_id""")
def _(spark, d):
    f = exposure.site_counts(sites(spark, d), tiles.pieces_of(areas(spark, d), 1000.0, ["kind", "area_id"]), 1000.0)
    return f.select("kind", "area_id", "sites", "sites_health", "sites_rs_high_medium", "sites_fz3")


@query("a19_sites_to_cells", PLACES + """
SELECT (northing // 100) * 10000 + easting // 100 AS cell_key, count(*) AS critical_sites, count(*) FILTER (site_group = 'education') AS critical_education,
  count(*) FILTER (rofrs_rank >= 3) AS critical_in_rs_high_medium FROM sites GROUP BY 1""")
def _(spark, d):
    return grid.sites_to_cells(sites(spark, d)).select("cell_key", "critical_sites", "critical_education", "critical_in_rs_high_medium")


@query("f25_hospital_names", """
SELECT p_partkey FROM part WHERE p_size % 4 IN (0, 1)""")
def _(spark, d):
    names = F.array(*[F.lit(x) for x in ("General Hospital", "Walk-in Centre", "Hospital Car Park", "Village Hall")])
    name = F.concat(F.col("p_name"), F.lit(" "), F.element_at(names, (F.col("p_size") % 4 + 1).cast("int")))
    return table(spark, d, "part").filter(site_sources.is_hospital_name(name)).select("p_partkey")


@query("f24_postcode_normalise", "SELECT s_suppkey, 'S' || s_nationkey || 'X' || s_suppkey AS postcode FROM supplier")
def _(spark, d):
    from freshet.functions.text import postcode

    raw = F.concat(F.lit(" s"), F.col("s_nationkey"), F.lit("x "), F.col("s_suppkey"), F.lit(" "))
    return table(spark, d, "supplier").select("s_suppkey", postcode(raw).alias("postcode"))


@query("s29_school_and_health_sites", """
SELECT 'education' AS site_group, s_name AS name, CAST(s_suppkey AS VARCHAR) AS source_id FROM supplier WHERE s_nationkey % 2 = 0 AND s_suppkey % 5 > 0
UNION ALL SELECT 'health', c_name, CAST(c_custkey AS VARCHAR) FROM customer WHERE c_nationkey < 20""")
def _(spark, d):
    s = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("urn"), F.col("s_name").alias("name"), F.when(F.col("s_nationkey") % 2 == 0, "Open, but proposed to close").otherwise("Closed").alias("status"),
        F.lit("Primary").alias("phase"), F.lit("Academy").alias("establishment_type"), (F.col("s_suppkey") % 5).cast("string").alias("easting"), F.lit("9").alias("northing"),
        F.lit("AB1 2CD").alias("postcode"))
    codes = table(spark, d, "nation").filter("n_nationkey < 20").select(
        F.concat(F.lit("n "), F.col("n_nationkey")).alias("postcode"), (F.col("n_nationkey") + 1).cast("string").alias("easting"), F.lit("7").alias("northing"))
    orgs = table(spark, d, "customer").select(F.col("c_custkey").alias("org_id"), F.col("c_name").alias("name"), F.concat(F.lit("N"), F.col("c_nationkey")).alias("postcode"))
    both = pick.union_all([site_sources.school_sites(s), site_sources.health_sites(orgs, "GP practice", codes)])
    return both.select("site_group", "name", "source_id")


@query("f23_tagged_feature_classes", """
SELECT p_partkey, CASE p_size % 8 WHEN 0 THEN 'health' WHEN 1 THEN 'health' WHEN 2 THEN 'emergency' WHEN 3 THEN 'utilities' WHEN 6 THEN 'utilities' END AS site_group,
  CASE p_size % 8 WHEN 0 THEN 'hospital' WHEN 1 THEN 'care home' WHEN 2 THEN 'coastguard or lifeboat station' WHEN 3 THEN 'substation' WHEN 6 THEN 'water treatment works' END AS site_type FROM part""")
def _(spark, d):
    m = lambda *kv: F.create_map(*[F.lit(x) for x in kv])
    tags = F.array(m("amenity", "Hospital"), m("amenity", "social_facility", "social_facility", "nursing_home"), m("emergency", "lifeboat_station"),
                   m("power", "substation", "voltage", "132000;33000"), m("power", "substation", "voltage", "33000"), m("power", "plant", "plant:source", "solar"),
                   m("man_made", "water_works"), m("amenity", "school"))
    c = site_sources.feature_class(F.element_at(tags, (F.col("p_size") % 8 + 1).cast("int")))
    return table(spark, d, "part").select("p_partkey", c["site_group"].alias("site_group"), c["site_type"].alias("site_type"))


@query("u06_standardised_site_ids", """
SELECT CASE WHEN n > 1 THEN id || '#' || (n - 1) ELSE id END AS site_id, p_partkey FROM (
  SELECT p_brand || ':' || p_size AS id, p_partkey, row_number() OVER (PARTITION BY p_brand || ':' || p_size ORDER BY p_partkey) AS n FROM part)""")
def _(spark, d):
    p = table(spark, d, "part").select(F.concat_ws(":", "p_brand", F.col("p_size").cast("string")).alias("id"), "p_partkey")
    return pick.numbered_ids(p, "id", ["p_partkey"], chunk=F.floor(F.col("p_partkey") / 1000)).select("site_id", "p_partkey")


@query("p21_critical_sites", PLACES + """,
kept AS (SELECT * FROM sites WHERE source = 'surveyed'),
cand AS (SELECT * FROM sites WHERE source = 'postcode')
SELECT source || ':' || site_id AS site_id, name FROM kept UNION ALL
SELECT source || ':' || site_id, name FROM cand c WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.site_group = c.site_group AND pow(k.easting - c.easting, 2) + pow(k.northing - c.northing, 2) <= 25000000)""")
def _(spark, d):
    s = sites(spark, d)
    kept, candidates = s.filter("source = 'surveyed'"), s.filter("source = 'postcode'")
    extra = proximity.drop_near_kept(candidates, kept, "site_group", "source", 5000.0)
    both = kept.unionByName(extra).withColumn("key", F.concat_ws(":", "source", F.col("site_id").cast("string"))).drop("site_id")
    return pick.numbered_ids(both, "key", ["name"]).select("site_id", "name")


# ---- grid ----------------------------------------------------------------------------------------------------


@query("a17_points_to_cells", PLACES + """
SELECT (northing // 5000) * 10000 + easting // 5000 AS cell_key, round(sum(people), 2) AS people, count(*) FILTER (point_source = 'nsul') AS n_points,
  round(sum(CASE WHEN rofrs_rank = 3 THEN people ELSE 0 END), 2) AS people_rs_medium, round(coalesce(sum(people * imd_score) / nullif(sum(people), 0), avg(imd_score)), 4) AS imd_score FROM points GROUP BY 1""")
def _(spark, d):
    key = (F.floor(F.col("northing") / 5000) * 10000 + F.floor(F.col("easting") / 5000)).cast("long")
    f = grid.points_to_cells(points(spark, d).withColumn("cell_key", key))
    return f.select("cell_key", *r2("people"), "n_points", *r2("people_rs_medium"), F.round("imd_score", 4).alias("imd_score"))


@query("a18_band_shares_wide", PIXEL_SQL + """
SELECT (pixel_y // 10) * 10000 + pixel_x // 10 AS cell_key, count(*) FILTER (rank = 1) / 100.0 AS share_rs_very_low, count(*) FILTER (rank = 3) / 100.0 AS share_rs_medium
FROM pixels WHERE source = 'rofrs' GROUP BY 1""")
def _(spark, d):
    return grid.shares_wide(grid.cell_shares(_pixels(spark, d), LABELS, 100.0, 1000.0)).select("cell_key", "share_rs_very_low", "share_rs_medium")


GRID_SQL = PIXEL_SQL + """,
pc AS (SELECT (northing // 1000) * 10000 + easting // 1000 AS cell_key, sum(people) AS people, sum(people * imd_decile) / nullif(sum(people), 0) AS w, avg(imd_decile) AS u FROM points GROUP BY 1),
sc AS (SELECT (pixel_y // 10) * 10000 + pixel_x // 10 AS cell_key, 1 * (count(*) FILTER (source = 'rofrs' AND rank = 1) / 100.0) + 2 * (count(*) FILTER (source = 'rofrs' AND rank = 2) / 100.0) + 3 * (count(*) FILTER (source = 'rofrs' AND rank = 3) / 100.0) + 4 * (count(*) FILTER (source = 'rofrs' AND rank = 4) / 100.0) AS haz FROM pixels GROUP BY 1),
cc AS (SELECT (northing // 1000) * 10000 + easting // 1000 AS cell_key, count(*) AS critical_sites FROM sites GROUP BY 1),
g0 AS (SELECT cell_key, coalesce(people, 0) AS people, coalesce(w, u) AS dec, least(coalesce(haz, 0), 4) AS haz_rs, coalesce(critical_sites, 0) AS critical_sites
       FROM pc FULL JOIN sc USING (cell_key) FULL JOIN cc USING (cell_key)),
g AS (SELECT *, (SELECT count(*) FROM g0 b WHERE b.people < g0.people) AS less, (SELECT count(*) FROM g0 b WHERE b.people = g0.people) AS same, (SELECT count(*) FROM g0) AS n FROM g0)"""


def _grid(spark, d):
    coarse = lambda df: df.withColumn("cell_key", (F.floor(F.col("northing") / 1000) * 10000 + F.floor(F.col("easting") / 1000)).cast("long"))
    people = grid.points_to_cells(coarse(points(spark, d)))
    painted = stored_table(_pixels(spark, d), "pixels")
    bands = grid.cell_shares(painted.filter("source = 'rofrs'"), LABELS, 100.0, 1000.0)
    zones = grid.cell_shares(painted.filter("source <> 'rofrs'"), {1: "FZ2", 2: "FZ2", 3: "FZ3", 4: "FZ3"}, 100.0, 1000.0)
    shares = grid.shares_wide(bands.unionByName(zones))
    # the site table keyed by the same coarse cell
    crit = grid.sites_to_cells(coarse(sites(spark, d)).withColumn("easting", F.pmod("cell_key", F.lit(10000)) * 100).withColumn(
        "northing", F.floor(F.col("cell_key") / 10000) * 100))
    return grid.build_grid(people, shares, crit)


@query("j29_grid_outer_merge", GRID_SQL + " SELECT cell_key, round(people, 2) AS people, round(haz_rs, 4) AS haz_rs, critical_sites FROM g0")
def _(spark, d):
    return _grid(spark, d).select("cell_key", *r2("people"), F.round("haz_rs", 4).alias("haz_rs"), "critical_sites")


@query("w11_national_percentile", GRID_SQL + " SELECT cell_key, round((less + (same + 1) / 2.0) / n, 9) AS pct FROM g")
def _(spark, d):
    ranked = percent_rank_average(_grid(spark, d), [], "people", "pct")
    return ranked.select("cell_key", F.round("pct", 9).alias("pct"))


@query("p24_exposure_grid_and_score", GRID_SQL + """,
p AS (SELECT *, CASE WHEN people > 0 THEN round_even((less + (same + 1) / 2.0) / n, 4) ELSE 0 END AS pop_pct, coalesce(round_even(dec, 0), 0) AS decile FROM g)
SELECT cell_key, round(pop_pct, 4) AS pop_pct, round(haz_rs, 4) AS haz_rs,
  round_even(100 * (haz_rs / 4) * ((0.5 * pop_pct + 0.3 * CASE WHEN decile > 0 THEN (11 - decile) / 10 ELSE 0 END + 0.2 * (least(critical_sites, 3.0) / 3)) / 1.0), 2) AS risk_score FROM p""")
def _(spark, d):
    scored = grid.with_score(_grid(spark, d), {"pop": 0.5, "vulnerability": 0.3, "critical": 0.2})
    return scored.select("cell_key", "pop_pct", F.round("haz_rs", 4).alias("haz_rs"), "risk_score")


@query("a25_area_risk_score", PLACES + """,
cells AS (SELECT easting // 100 * 100 AS e, northing // 100 * 100 AS n, sum(people) AS people, max(rofrs_rank) * 10.5 AS score FROM points GROUP BY 1, 2),
inside AS (SELECT a.kind, a.area_id, c.* FROM cells c JOIN areas a ON c.e + 50 BETWEEN a.x0 AND a.x1 AND c.n + 50 BETWEEN a.y0 AND a.y1)
SELECT kind, area_id, count(*) AS grid_cells, max(score) AS risk_score_max, round_even(sum(people * score) / nullif(sum(people), 0), 2) AS risk_score FROM inside GROUP BY 1, 2""")
def _(spark, d):
    return exposure.area_scores(scored_cells(spark, d), tiles.pieces_of(areas(spark, d), 1000.0, ["kind", "area_id"]), 1000.0)


def scored_cells(spark, d):
    return points(spark, d).groupBy((F.floor(F.col("easting") / 100) * 100).alias("easting"), (F.floor(F.col("northing") / 100) * 100).alias("northing")).agg(
        F.sum("people").alias("people"), (F.max("rofrs_rank") * 10.5).alias("risk_score"))


# ---- census --------------------------------------------------------------------------------------------------

CENSUS_SQL = """
census AS (SELECT n_nationkey AS oa, CAST(1000 + n_nationkey * 37 AS DOUBLE) AS population, CAST(400 + n_nationkey AS DOUBLE) AS households FROM nation),
pts AS (SELECT c_custkey, c_nationkey AS oa FROM customer WHERE c_nationkey NOT IN (3, 7))"""


def _census(spark, d):
    k = F.col("n_nationkey")
    census = table(spark, d, "nation").select(k.alias("oa"), (1000 + k * 37).cast("double").alias("population"), (400 + k).cast("double").alias("households"))
    pts = points(spark, d).filter(~F.col("pcon").isin(3, 7)).select("point_id", F.col("pcon").alias("oa"), "easting", "northing")
    centres = table(spark, d, "nation").filter("n_nationkey <> 7").select(k.alias("oa"), (k * 1000).alias("easting"), (k * 2000).alias("northing"))
    return census, pts, centres


@query("a29_census_share_allocation", with_ctes(CENSUS_SQL) + """
SELECT oa, 'nsul' AS point_source, count(*) AS n, round(sum(people), 4) AS people FROM (SELECT p.oa, c.population / count(*) OVER (PARTITION BY p.oa) AS people FROM pts p JOIN census c USING (oa)) GROUP BY oa
UNION ALL SELECT oa, 'oa_centroid', 1, population FROM census WHERE oa NOT IN (SELECT oa FROM pts) AND oa <> 7""")
def _(spark, d):
    census, pts, centres = _census(spark, d)
    placed = grid.allocate(pts, census, centres)
    return placed.groupBy("oa", "point_source").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("people"), 4).alias("people"))


@query("a29_people_lost", with_ctes(CENSUS_SQL) + "SELECT count(*) AS areas_with_no_centre, coalesce(sum(population), 0) AS people_lost FROM census WHERE oa NOT IN (SELECT oa FROM pts) AND oa = 7")
def _(spark, d):
    return grid.unplaced_people(*_census(spark, d))


@query("p23_address_points", PIXEL_SQL + """,
census AS (SELECT n_nationkey AS pcon, 1000.0 + n_nationkey * 37 AS population FROM nation)
SELECT p.point_id, round(c.population / count(*) OVER (PARTITION BY p.pcon), 6) AS people, coalesce(x.rank, 0) AS rofrs_rank FROM points p JOIN census c USING (pcon)
LEFT JOIN pixels x ON x.source = 'rofrs' AND x.pixel_x = p.easting // 100 AND x.pixel_y = p.northing // 100""")
def _(spark, d):
    census, _, centres = _census(spark, d)
    pts = points(spark, d).select("point_id", F.col("pcon").alias("oa"), "easting", "northing")
    shared = grid.allocate(pts, census, centres)
    ranked = grid.with_hazard_rank(shared, _pixels(spark, d), "rofrs", "rofrs_rank", 100.0)
    return ranked.filter("point_id IS NOT NULL").select("point_id", F.round("people", 6).alias("people"), "rofrs_rank")


@query("s26_address_point_scan", """
SELECT c_custkey AS uprn, CASE WHEN c_nationkey % 3 = 0 THEN c_mktsegment ELSE 'C' || c_nationkey END AS ctyua, (((c_custkey * 104729) % 100000) // 100) * 10000 + ((c_custkey * 7919) % 100000) // 100 AS cell_key
FROM customer WHERE c_nationkey < 20 AND (c_custkey * 7919) % 100000 > 0 AND (c_custkey * 104729) % 100000 > 0 AND c_custkey % 10 > 0""")
def _(spark, d):
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    raw = c.select(
        k.alias("UPRN"), F.when(k % 10 > 0, (k * 7919 % 100000).cast("string")).otherwise("n/a").alias("GRIDGB1E"), (k * 104729 % 100000).cast("string").alias("GRIDGB1N"),
        F.col("c_mktsegment").alias("LAD25CD"), F.when(F.col("c_nationkey") % 6 == 0, "E99999999").when(F.col("c_nationkey") % 3 > 0, F.concat(F.lit("C"), "c_nationkey")).alias("CTY25CD"),
        F.when(F.col("c_nationkey") < 20, "E92000001").otherwise("W92000004").alias("CTRY25CD"))
    names = {"UPRN": "uprn", "GRIDGB1E": "easting", "GRIDGB1N": "northing", "LAD25CD": "lad", "CTY25CD": "cty", "CTRY25CD": "ctry"}
    return places.address_points(raw, names, "E92000001").select("uprn", "ctyua", "cell_key")


RESIDENTS = {"population": ["Residence type: Total; measures: Value"]}
OLDER = {"age65plus": ["Age: Aged 65 to 69 years", "Age: Aged 85 years and over"]}
HOMES = {"households": ["Number of households: Number of households; measures: Value"]}


def _census_table(residents, ages, homes):
    code = "geography code"
    joined = places.side_by_side([places.measures(residents, code, RESIDENTS), places.measures(ages, code, OLDER), places.measures(homes, code, HOMES)])
    return places.share_of(joined, "age65plus", "population", "share_65plus")


def _census_files(spark, d):
    c = table(spark, d, "customer").groupBy("c_nationkey").pivot("c_mktsegment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]).agg(F.count(F.lit(1)))
    code = F.concat(F.lit("E"), F.col("c_nationkey")).alias("geography code")
    total = F.col("AUTOMOBILE") + F.col("BUILDING") + F.col("FURNITURE") + F.col("HOUSEHOLD") + F.col("MACHINERY")
    residents = c.select(code, total.alias("Residence type: Total; measures: Value"))
    ages = c.select(code, total.alias("Age: Total"), F.col("AUTOMOBILE").alias("Age: Aged 60 to 64 years"), F.col("BUILDING").alias("Age: Aged 65 to 69 years"),
                    F.col("FURNITURE").alias("Age: Aged 85 years and over"), F.col("HOUSEHOLD").alias("Age: Aged 4 years and under"))
    homes = c.select(code, F.col("MACHINERY").alias("Number of households: Number of households; measures: Value"))
    health = c.select(code, F.col("AUTOMOBILE").alias("General health: Very good health"), F.when(F.col("c_nationkey") % 5 > 0, F.col("BUILDING")).alias("General health: Bad health"),
                      F.when(F.col("c_nationkey") % 10 > 0, F.col("FURNITURE")).alias("General health: Very bad health"))
    cars = c.filter("c_nationkey <> 4").select(code, F.col("HOUSEHOLD").alias("Number of cars: No cars or vans in household"))
    return residents, ages, homes, health, cars


CENSUS_FILES_SQL = """
f AS (SELECT c_nationkey, count(*) AS total, count(*) FILTER (c_mktsegment = 'BUILDING') AS b, count(*) FILTER (c_mktsegment = 'FURNITURE') AS u,
  count(*) FILTER (c_mktsegment = 'MACHINERY') AS m, count(*) FILTER (c_mktsegment = 'HOUSEHOLD') AS h FROM customer GROUP BY 1)"""


@query("s21_census_one_row_per_area", with_ctes(CENSUS_FILES_SQL) + """
SELECT 'E' || c_nationkey AS oa, total AS population, b + u AS age65plus, m AS households, round((b + u) / total::DOUBLE, 6) AS share_65plus FROM f""")
def _(spark, d):
    residents, ages, homes, _, _ = _census_files(spark, d)
    return _census_table(residents, ages, homes).withColumn("share_65plus", F.round("share_65plus", 6))


@query("s21_census_cross_check", with_ctes(CENSUS_FILES_SQL) + "SELECT 0 AS differs, 0 AS differs_by_more_than_5, 0.0 AS largest, 0.0 AS people FROM f LIMIT 1")
def _(spark, d):
    residents, ages, *_ = _census_files(spark, d)
    totals = places.side_by_side([places.measures(residents, "geography code", RESIDENTS), places.measures(ages, "geography code", {"age_total": ["Age: Total"]})])
    return places.gap_summary(totals, "population", "age_total")


@query("s22_vulnerability_columns", with_ctes(CENSUS_FILES_SQL) + """
SELECT 'E' || c_nationkey AS oa, CASE WHEN c_nationkey % 10 = 0 THEN NULL WHEN c_nationkey % 5 = 0 THEN u ELSE b + u END AS bad_health, CASE WHEN c_nationkey <> 4 THEN h END AS no_car_households FROM f""")
def _(spark, d):
    *_, health, cars = _census_files(spark, d)
    bad = {"bad_health": ["General health: Bad health", "General health: Very bad health"]}
    none = {"no_car_households": ["Number of cars: No cars or vans in household"]}
    return places.side_by_side([places.measures(cars, "geography code", none), places.measures(health, "geography code", bad)], how="full")


@query("s23_deprivation_table", """
SELECT 'E01' || p_partkey AS lsoa, CAST(p_size % 10 + 1 AS DOUBLE) AS imd_decile, p_retailprice AS imd_score, CAST(p_size AS DOUBLE) AS domain_income_decile FROM part WHERE p_size % 7 > 0""")
def _(spark, d):
    p = table(spark, d, "part").select(
        F.concat(F.when(F.col("p_size") % 7 > 0, "E01").otherwise("W01"), F.col("p_partkey")).alias("LSOA code (2021)"), F.col("p_retailprice").alias("Index of Multiple Deprivation (IMD) Score"),
        (F.col("p_size") % 10 + 1).alias("Index of Multiple Deprivation (IMD) Decile (where 1 is most deprived)"), F.col("p_size").alias("Income Decile (where 1 is most deprived)"))
    numbers = {"imd_score": "Index of Multiple Deprivation (IMD) Score", "imd_decile": "Index of Multiple Deprivation (IMD) Decile (where 1 is most deprived)",
               "domain_income_decile": "Income Decile (where 1 is most deprived)"}
    return places.england_only(places.named_columns(p, {"lsoa": "LSOA code (2021)"}, numbers), "lsoa", "E01").select("lsoa", "imd_decile", "imd_score", "domain_income_decile")


@query("p19_census_and_deprivation", with_ctes(CENSUS_FILES_SQL) + """
SELECT 'E' || c_nationkey AS oa, total AS population, b + u AS age65plus, m AS households, round((b + u) / total::DOUBLE, 6) AS share_65plus,
  CASE WHEN c_nationkey % 10 = 0 THEN NULL WHEN c_nationkey % 5 = 0 THEN u ELSE b + u END AS bad_health, CASE WHEN c_nationkey <> 4 THEN h END AS no_car_households,
  CAST(n_regionkey + 1 AS DOUBLE) AS imd_decile FROM f JOIN nation ON n_nationkey = c_nationkey""")
def _(spark, d):
    residents, ages, homes, health, cars = _census_files(spark, d)
    raw = table(spark, d, "nation").select(F.concat(F.lit("E"), F.col("n_nationkey")).alias("LSOA code"), (F.col("n_regionkey") + 1).alias("IMD decile"))
    deprivation = places.named_columns(raw, {"oa": "LSOA code"}, {"imd_decile": "IMD decile"})
    bad = places.measures(health, "geography code", {"bad_health": ["General health: Bad health", "General health: Very bad health"]})
    none = places.measures(cars, "geography code", {"no_car_households": ["Number of cars: No cars or vans in household"]})
    return places.side_by_side([_census_table(residents, ages, homes), bad, none, deprivation]).withColumn("share_65plus", F.round("share_65plus", 6))


@query("s28_code_names_and_lookup", """
SELECT 'N' || n_nationkey AS district_code, 'R' || n_regionkey AS geography_code, r_name AS geography_name FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_regionkey > 0""")
def _(spark, d):
    joined = table(spark, d, "nation").join(table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    raw = joined.select(F.concat(F.lit(" N"), "n_nationkey").alias("LAD24CD"), F.col("n_name").alias("LAD24NM"),
                        F.when(F.col("n_regionkey") > 0, F.concat(F.lit("R"), "n_regionkey")).otherwise("").alias("FRA24CD"), F.col("r_name").alias("FRA24NM"))
    return places.district_links(raw.union(raw), "fire_and_rescue_authority", "LAD24CD", "FRA24CD", "FRA24NM").select("district_code", "geography_code", "geography_name")


@query("u05_fill_names_from_later_sources", """
SELECT code, coalesce(a, b, c) AS name, CASE WHEN a IS NOT NULL THEN 'first' WHEN b IS NOT NULL THEN 'second' ELSE 'third' END AS source FROM (
  SELECT code, max(name) FILTER (p = 0) AS a, min(name) FILTER (p = 1) AS b, min(name) FILTER (p = 2) AS c FROM (
    SELECT n_nationkey AS code, n_name AS name, 0 AS p FROM nation WHERE n_regionkey < 2 UNION ALL SELECT n_nationkey, lower(n_name), 1 FROM nation WHERE n_regionkey < 4
    UNION ALL SELECT c_nationkey, c_name, 2 FROM customer) GROUP BY code)""")
def _(spark, d):
    n = table(spark, d, "nation")
    first = n.filter("n_regionkey < 2").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name"), F.lit("first").alias("source"))
    second = n.filter("n_regionkey < 4").select(F.col("n_nationkey").alias("code"), F.lower("n_name").alias("name"), F.lit("second").alias("source"))
    third = table(spark, d, "customer").select(F.col("c_nationkey").alias("code"), F.col("c_name").alias("name"), F.lit("third").alias("source"))
    return pick.union_by_priority([first, second, third], ["code"], [F.col("name")])


@query("s28_code_name_table", "SELECT 'N' || n_nationkey AS code, n_name AS name FROM nation")
def _(spark, d):
    n = table(spark, d, "nation").select(F.concat(F.lit("N"), "n_nationkey").alias("WD25CD"), F.col("n_name").alias("WD25NM"), F.lower("n_name").alias("WD25NMW"))
    return places.code_names(n.union(n), "WD25CD", "WD25NM")


@query("p22_responder_geographies", PLACES + """
SELECT r_name AS geography_name, round(sum(people), 2) AS people, count(DISTINCT pcon) AS districts FROM points JOIN nation ON n_nationkey = pcon JOIN region ON r_regionkey = n_regionkey GROUP BY 1""")
def _(spark, d):
    district = exposure.geography_exposure(points(spark, d), {"district": "pcon"}).select("code", "people")
    joined = table(spark, d, "nation").join(table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    lookup = places.district_links(joined, "combined_authority", "n_nationkey", "n_regionkey", "r_name")
    return exposure.rollup_through(district, lookup, ["people"]).select("geography_name", *r2("people"), "districts")


# ---- rapid guidance exposure ---------------------------------------------------------------------------------

GUIDANCE_SQL = PLACES + """,
under AS (SELECT b.box_id AS polygon_key, p.* FROM points p JOIN site_boxes b ON p.easting BETWEEN b.x0 AND b.x1 AND p.northing BETWEEN b.y0 AND b.y1)"""


def _guidance(spark, d):
    return site_boxes(spark, d).select(F.col("box_id").alias("polygon_key"), "rings")


@query("a27_guidance_exposure", GUIDANCE_SQL + """
SELECT b.box_id AS polygon_key, round(coalesce(sum(u.people), 0), 2) AS people, coalesce(sum(u.households), 0) AS households FROM site_boxes b LEFT JOIN under u ON u.polygon_key = b.box_id GROUP BY 1""")
def _(spark, d):
    return exposure.guidance_exposure(points(spark, d), _guidance(spark, d))[0].select("polygon_key", *r2("people"), "households")


@query("p26_guidance_by_constituency", GUIDANCE_SQL + "SELECT polygon_key, pcon, round(sum(people), 2) AS people FROM under GROUP BY 1, 2")
def _(spark, d):
    return exposure.guidance_exposure(points(spark, d), _guidance(spark, d))[1].select("polygon_key", "pcon", *r2("people"))


@query("a27_guidance_by_area", GUIDANCE_SQL + """
SELECT u.polygon_key, m.kind, m.area_id, round(sum(u.people), 2) AS people FROM under u JOIN members_of m ON m.point_id = u.point_id GROUP BY 1, 2, 3""")
def _(spark, d):
    return exposure.guidance_by_area(points(spark, d), _guidance(spark, d), areas(spark, d)).select("polygon_key", "kind", "area_id", *r2("people"))


@query("a28_partial_sums_add_up", PLACES + "SELECT kind, round(sum(people), 2) AS people, count(*) AS pairs FROM members_of GROUP BY kind")
def _(spark, d):
    # sums of two strips of points, added: what partial and final aggregation do
    p, a = points(spark, d), areas(spark, d)
    strips = [p.filter("northing < 50000"), p.filter("northing >= 50000")]
    parts = [exposure.kind_totals(exposure.membership(s, a), s) for s in strips]
    return pick.union_all(parts).groupBy("kind").agg(F.round(F.sum("people"), 2).alias("people"), F.sum("pairs").alias("pairs"))


@query("p25_area_exposure_suite", DEPTH_SQL + """
SELECT a.kind, count(*) AS areas, round(sum(coalesce(s.u, 0)), 2) AS people_unique, round(sum(coalesce(s.sp, 0)), 2) AS people_split FROM areas a
LEFT JOIN (SELECT kind, area_id, sum(CASE WHEN depth = 1 THEN people ELSE 0 END) AS u, sum(people / depth) AS sp FROM deep GROUP BY 1, 2) s ON s.kind = a.kind AND s.area_id = a.area_id GROUP BY a.kind""")
def _(spark, d):
    f = exposure.derived_measures(areas(spark, d), exposure.area_figures(_members(spark, d), points(spark, d)))
    return f.groupBy("kind").agg(F.count(F.lit(1)).alias("areas"), F.round(F.sum("people_unique"), 2).alias("people_unique"), F.round(F.sum("people_split"), 2).alias("people_split"))


@query("l02_worst_areas", DEPTH_SQL + "SELECT kind, area_id, sum(addresses) AS addresses FROM deep GROUP BY 1, 2 ORDER BY 3 DESC, kind, area_id LIMIT 15")
def _(spark, d):
    f = exposure.area_figures(_members(spark, d), points(spark, d))
    return f.orderBy(F.desc("addresses"), "kind", "area_id").limit(15).select("kind", "area_id", "addresses")


@query("k16_stale_result_signature", PLACES + "SELECT count(*) AS rows, true AS same_when_reordered, true AS changes_with_content FROM areas")
def _(spark, d):
    a = areas(spark, d).select("kind", "area_id")
    mark = lambda df, n: guards.fingerprint(df, ["kind", "area_id"]).select("rows", F.col("fingerprint").alias(n))
    again = mark(a.repartition(7, "area_id"), "b")
    other = mark(a.withColumn("area_id", F.col("area_id") + 1), "c")
    return mark(a, "a").join(again, "rows").join(other, "rows").select(
        "rows", (F.col("a") == F.col("b")).alias("same_when_reordered"), (F.col("a") != F.col("c")).alias("changes_with_content"))


# ---- economics -----------------------------------------------------------------------------------------------

ECONOMICS_SQL = """
bands AS (SELECT * FROM (VALUES ('high', 0.033, 0.1), ('medium', 0.01, 0.033), ('low', 0.001, 0.01), ('very_low', 0.0001, 0.001)) v(band, lo, hi)),
probs AS (SELECT 'prob_' || band AS item, 'low' AS scenario, lo AS value FROM bands UNION ALL SELECT 'prob_' || band, 'high', hi FROM bands
          UNION ALL SELECT 'prob_' || band, 'central', CASE band WHEN 'high' THEN 0.04 ELSE sqrt(lo * hi) END FROM bands)"""


@query("f34_hazard_probabilities", with_ctes(ECONOMICS_SQL) + """
SELECT c_mktsegment, item, scenario, round(value * count(*), 6) AS expected FROM customer, probs WHERE item = 'prob_' || CASE c_custkey % 5 WHEN 4 THEN 'high' WHEN 3 THEN 'medium' WHEN 2 THEN 'low' ELSE 'very_low' END
GROUP BY c_mktsegment, item, scenario, value""")
def _(spark, d):
    p = points(spark, d)
    band = F.when(F.col("rofrs_rank") == 4, "high").when(F.col("rofrs_rank") == 3, "medium").when(F.col("rofrs_rank") == 2, "low").otherwise("very_low")
    counts = p.groupBy(F.col("lad").alias("c_mktsegment"), F.concat(F.lit("prob_"), band).alias("item")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(economics.band_probabilities(spark), "item").select("c_mktsegment", "item", "scenario", F.round(F.col("value") * F.col("n"), 6).alias("expected"))


@query("k13_seed_missing_rows", with_ctes(ECONOMICS_SQL) + """,
held AS (SELECT DISTINCT 'prob_' || CASE p_size % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'low' ELSE 'medium' END AS item, CASE WHEN p_size % 2 = 0 THEN 'low' ELSE 'high' END AS scenario FROM part)
SELECT item, scenario FROM probs WHERE (item, scenario) NOT IN (SELECT item, scenario FROM held)""")
def _(spark, d):
    p = table(spark, d, "part")
    size = F.col("p_size")
    held = p.select(F.when(size % 3 == 0, "prob_high").when(size % 3 == 1, "prob_low").otherwise("prob_medium").alias("item"),
                    F.when(size % 2 == 0, "low").otherwise("high").alias("scenario"))
    return economics.missing_rows(held, economics.band_probabilities(spark)).select("item", "scenario")


def _assumptions(spark, d):
    held = table(spark, d, "region").filter("r_regionkey < 3").select(
        F.lit("prob_high").alias("item"), F.element_at(F.array(F.lit("low"), F.lit("central"), F.lit("high")), F.col("r_regionkey") + 1).alias("scenario"),
        ((3 - F.col("r_regionkey")) / 10).alias("value"))
    return held.unionByName(only_new(held, economics.default_rows(spark), ["item", "scenario"]))


@query("a45_assumption_checks", "SELECT 'prob_high should run low, central, high in order.' AS problem FROM region WHERE r_regionkey = 0")
def _(spark, d):
    return economics.check_assumptions(_assumptions(spark, d))


@query("p27_assumptions_table", with_ctes(ECONOMICS_SQL) + """
SELECT item, scenario, round(value, 9) AS value FROM probs WHERE item <> 'prob_high'
UNION ALL SELECT 'prob_high', CASE r_regionkey WHEN 0 THEN 'low' WHEN 1 THEN 'central' ELSE 'high' END, (3 - r_regionkey) / 10.0 FROM region WHERE r_regionkey < 3
UNION ALL SELECT 'price_uplift', s, 1.0 FROM (VALUES ('low'), ('central'), ('high')) v(s) UNION ALL SELECT 'damage_per_household', s, NULL FROM (VALUES ('low'), ('central'), ('high')) v(s)""")
def _(spark, d):
    return _assumptions(spark, d).select("item", "scenario", F.round("value", 9).alias("value"))
