"""The exposure suite: one query per output table, all columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.bindings.base import PLACES_SQL, areas, points, query, sites, table, with_ctes
from freshet.bindings.exposure import scored_cells
from freshet.plans import exposure

VALUES = {
    "addresses": "CASE WHEN point_source = 'nsul' THEN 1.0 ELSE 0.0 END", "people": "people", "households": "households", "over65": "over65",
    **{f"{c}_rs_{band}": f"CASE WHEN rofrs_rank = {rank} THEN {c} ELSE 0 END" for rank, band in exposure.BANDS.items() for c in ("people", "households")},
    "people_rs_high_medium": "CASE WHEN rofrs_rank >= 3 THEN people ELSE 0 END", "households_rs_high_medium": "CASE WHEN rofrs_rank >= 3 THEN households ELSE 0 END",
    "people_fz2": "CASE WHEN fz_rank = 1 THEN people ELSE 0 END", "people_fz3": "CASE WHEN fz_rank = 2 THEN people ELSE 0 END",
    "people_imd_1_2": "CASE WHEN imd_decile <= 2 THEN people ELSE 0 END"}
# the points of the given tables carry no surface-water band, no kind of zone 3 and no vulnerable people: these columns are 0
NONE = [*[f"people_sw_{band}" for band in [*exposure.BANDS.values(), "high_medium"]], *exposure.ZONES.values(),
        *[f"{c}{end}" for c in exposure.VULNERABLE.values() for end in ("", "_rs_high_medium")]]


def sums(names, condition=None, end=""):
    return ", ".join(f"round(sum({f'CASE WHEN {condition} THEN {n} ELSE 0 END' if condition else n}), 2) AS {n}{end}" for n in names)


SUITE_SQL = with_ctes(PLACES_SQL) + f""",
coded AS (SELECT p.*, n_regionkey AS rgn, point_id % 97 AS ward, point_id % 31 AS county, point_id % 13 AS force FROM points p LEFT JOIN nation ON n_nationkey = pcon AND n_regionkey <> 3),
valued AS (SELECT *, {', '.join(f'{sql} AS {n}' for n, sql in VALUES.items() if n != sql)} FROM coded),
deep AS (SELECT m.kind, m.area_id, v.*, count(*) OVER (PARTITION BY m.kind, m.point_id) AS depth FROM members_of m JOIN valued v USING (point_id)),
named AS (SELECT 'constituency' AS geography, CAST(n_nationkey AS VARCHAR) AS code, n_name AS name FROM nation UNION ALL SELECT 'region', CAST(r_regionkey AS VARCHAR), r_name FROM region),
flags AS (SELECT v.*, EXISTS (SELECT 1 FROM members_of m WHERE m.point_id = v.point_id AND m.kind = 'flood_warning') AS in_warning,
            EXISTS (SELECT 1 FROM members_of m WHERE m.point_id = v.point_id AND m.kind = 'flood_alert') AS in_alert FROM valued v)
"""
CODES = {"constituency": "pcon", "district": "lad", "ward": "ward", "county": "county", "police_force": "force", "region": "rgn"}


def by_each(source, keys, columns):
    """The rows of ``source`` summed by every geography's code."""
    return " UNION ALL ".join(f"SELECT {keys}'{g}' AS geography, CAST({c} AS VARCHAR) AS code, {columns} FROM {source} WHERE {c} IS NOT NULL GROUP BY ALL" for g, c in CODES.items())


def _suite(spark, d):
    k = F.col("point_id")
    coded = points(spark, d).withColumns({"ward": k % 97, "county": k % 31, "force": k % 13})
    regions = table(spark, d, "nation").filter("n_regionkey <> 3").select("n_nationkey", "n_regionkey")
    codes = {g: c for g, c in CODES.items() if g != "region"}
    return exposure.AreaSuite(coded, areas(spark, d), codes, {"region": ("pcon", regions, "n_nationkey", "n_regionkey")})


def _names(spark, d):
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    return nation.select(F.lit("constituency").alias("geography"), F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name")).union(
        region.select(F.lit("region"), F.col("r_regionkey").cast("string"), "r_name"))


def rounded(df, keep, exact=()):
    """Sums to two places, split ones to six, because their order differs; keys and finished columns as they are."""
    return df.select(*[c if c in keep or c in exact else F.round(c, 6 if c.endswith("_split") else 2).alias(c) for c in df.columns])


SHARES = {"share_people_shared": "people - people_unique", "share_people_high_medium": "people_rs_high_medium", "share_people_imd_1_2": "people_imd_1_2"}


@query("p25_area_exposure", SUITE_SQL + f""",
f AS (SELECT kind, area_id, {', '.join(f'sum({n}) AS {n}' for n in VALUES)}, {', '.join(f'sum(CASE WHEN depth = 1 THEN {n} ELSE 0 END) AS {n}_unique, sum({n} / depth) AS {n}_split' for n in exposure.ADDITIVE)},
        sum(people * imd_decile) AS w FROM deep GROUP BY 1, 2),
s AS (SELECT a.kind, a.area_id, count(*) AS sites, {', '.join(f"count(*) FILTER (site_group = '{g}') AS sites_{g}" for g in exposure.SITE_GROUPS)}, count(*) FILTER (rofrs_rank >= 3) AS sites_rs_high_medium,
        count(*) FILTER (fz_rank = 2) AS sites_fz3 FROM sites x JOIN areas a ON x.easting BETWEEN a.x0 AND a.x1 AND x.northing BETWEEN a.y0 AND a.y1 GROUP BY 1, 2),
cells AS (SELECT easting // 100 * 100 AS e, northing // 100 * 100 AS n, sum(people) AS people, max(rofrs_rank) * 10.5 AS score FROM points GROUP BY 1, 2),
c AS (SELECT a.kind, a.area_id, count(*) AS grid_cells, max(score) AS risk_score_max, round_even(sum(people * score) / nullif(sum(people), 0), 2) AS risk_score
      FROM cells JOIN areas a ON e + 50 BETWEEN a.x0 AND a.x1 AND n + 50 BETWEEN a.y0 AND a.y1 GROUP BY 1, 2)
SELECT a.kind, a.area_id, {', '.join(f'round(coalesce({n}, 0), 2) AS {n}' for n in [*VALUES, *[f'{n}_unique' for n in exposure.ADDITIVE]])},
  {', '.join(f'round(coalesce({n}_split, 0), 6) AS {n}_split' for n in exposure.ADDITIVE)}, {', '.join(f'0.0 AS {n}' for n in NONE)},
  round_even(w / nullif(people, 0), 2) AS imd_mean_decile, round(coalesce(people - people_unique, 0), 2) + 0.0 AS people_shared,
  {', '.join(f'round_even(({sql}) / nullif(people, 0), 4) + 0.0 AS {n}' for n, sql in SHARES.items())},
  {', '.join(f'coalesce({n}, 0) AS {n}' for n in ['sites', *[f'sites_{g}' for g in exposure.SITE_GROUPS], 'sites_rs_high_medium', 'sites_fz3', 'grid_cells'])}, risk_score, risk_score_max
FROM areas a LEFT JOIN f USING (kind, area_id) LEFT JOIN s USING (kind, area_id) LEFT JOIN c USING (kind, area_id)""")
def _(spark, d):
    f = _suite(spark, d).area_exposure(sites(spark, d), scored_cells(spark, d))
    finished = [c for c in f.columns if c.startswith(("sites", "share_", "risk_", "grid_", "imd_mean"))]
    return rounded(f, ["kind", "area_id"], finished)


@query("p25_area_pairs", SUITE_SQL + f"""SELECT a.kind, a.area_id AS area_a, b.area_id AS area_b, sum(a.addresses) AS addresses, round(sum(a.people), 2) AS people
FROM deep a JOIN deep b ON a.kind = b.kind AND a.point_id = b.point_id AND a.area_id < b.area_id GROUP BY 1, 2, 3""")
def _(spark, d):
    return rounded(_suite(spark, d).area_pairs(), ["kind", "area_a", "area_b"])


@query("p25_area_constituencies", SUITE_SQL + f"SELECT kind, area_id, CAST(pcon AS VARCHAR) AS pcon, {sums(exposure.BY_CONSTITUENCY)} FROM deep GROUP BY 1, 2, 3")
def _(spark, d):
    return rounded(_suite(spark, d).area_constituencies(), ["kind", "area_id", "pcon"])


@query("p25_area_geographies", SUITE_SQL + f""", g AS ({by_each('deep', 'kind, area_id, ', sums(exposure.BY_GEOGRAPHY) + ', sum(people) AS part')}), t AS (SELECT kind, area_id, sum(people) AS total FROM deep GROUP BY 1, 2)
SELECT kind, area_id, geography, code, {', '.join(exposure.BY_GEOGRAPHY)}, name, round_even(part / nullif(total, 0), 4) AS share_of_area_people
FROM g JOIN t USING (kind, area_id) LEFT JOIN named USING (geography, code)""")
def _(spark, d):
    f = _suite(spark, d).area_geographies(_names(spark, d))
    return rounded(f, ["kind", "area_id", "geography", "code", "name"], ["share_of_area_people"])


@query("p25_area_coverage", SUITE_SQL + f""", s AS ({' UNION ALL '.join(f"SELECT '{kind}' AS kind, {', '.join(f'sum({n}) AS {n}' for n in exposure.COVERED)} FROM flags WHERE {where}" for kind, where in (('all', 'true'), ('flood_warning', 'in_warning'), ('flood_alert', 'in_alert')))})
SELECT s.kind, {', '.join(f'round(s.{n}, 2) AS {n}' for n in exposure.COVERED)}, round(CASE WHEN s.kind = 'all' THEN 0 ELSE e.people - s.people END, 2) + 0.0 AS people_not_in_area,
  round(CASE WHEN s.kind = 'all' THEN 0 ELSE e.people_rs_high_medium - s.people_rs_high_medium END, 2) + 0.0 AS people_high_medium_not_in_area
FROM s JOIN s e ON e.kind = 'all' WHERE s.people IS NOT NULL""")
def _(spark, d):
    return rounded(_suite(spark, d).coverage(), ["kind"])


INSIDE = ["people", "people_rs_high_medium", "households_rs_high_medium", "people_fz3"]


@query("p25_constituency_coverage", SUITE_SQL + f"""SELECT pcon, {sums(exposure.COVERED)}, {', '.join(sums(INSIDE, f'in_{k}', f'_in_{k}_area') for k in ('warning', 'alert'))},
  {', '.join(f'round(sum(people_rs_high_medium) - sum(CASE WHEN in_{k} THEN people_rs_high_medium ELSE 0 END), 2) + 0.0 AS people_high_medium_not_in_{k}_area' for k in ('warning', 'alert'))}
FROM flags GROUP BY pcon""")
def _(spark, d):
    return rounded(_suite(spark, d).constituency_coverage(), ["pcon"])


@query("p25_area_sites", SUITE_SQL + """SELECT a.kind, a.area_id, s.site_id, s.easting, s.northing, s.name, s.site_group, s.source, s.rofrs_rank, s.fz_rank,
  CASE rofrs_rank WHEN 4 THEN 'High' WHEN 3 THEN 'Medium' WHEN 2 THEN 'Low' WHEN 1 THEN 'Very Low' ELSE 'None' END AS band
FROM sites s JOIN areas a ON s.easting BETWEEN a.x0 AND a.x1 AND s.northing BETWEEN a.y0 AND a.y1""")
def _(spark, d):
    return exposure.site_list(sites(spark, d), areas(spark, d)).select(
        "kind", "area_id", "site_id", "easting", "northing", "name", "site_group", "source", "rofrs_rank", "fz_rank", "band")


BY_CODE = ["addresses", "people", "households", "over65", *[f"people_rs_{b}" for b in exposure.BANDS.values()], "people_rs_high_medium", "households_rs_high_medium", "people_fz2", "people_fz3"]


@query("p22_all_geographies", SUITE_SQL + f""", g AS ({by_each('valued', '', sums(BY_CODE))})
SELECT g.*, {', '.join(f'0.0 AS {n}' for n in exposure.ZONES.values())}, name FROM g LEFT JOIN named USING (geography, code)""")
def _(spark, d):
    return rounded(_suite(spark, d).geographies(_names(spark, d)), ["geography", "code", "name"])
