"""People and sites in warning and alert areas, counted from address points."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from freshet.functions import risk
from freshet.operators.pairs import pairs_within
from freshet.operators.spatial import points_in_areas
from freshet.operators.tiles import areas_over_points, pieces_of, sums_by_code, sums_in_areas, sums_of_pairs
from freshet.session import stored_table

BANDS = {1: "very_low", 2: "low", 3: "medium", 4: "high"}
BASE = ["addresses", "people", "households", "over65"]
VULNERABLE = {"no_car_hh": "no_car_households", "bad_health": "people_bad_health", "limited_lot": "people_limited_lot"}
ZONES = {"fz_sea_rank": "people_fz3_sea", "fz_river_rank": "people_fz3_river", "fz_river_and_sea_rank": "people_fz3_both"}
# measures that also get a unique and a split view
ADDITIVE = [*BASE, "people_rs_high_medium"]
KINDS = ["flood_warning", "flood_alert"]


def point_values(columns: list[str]) -> dict[str, Column]:
    """The measures one address point carries, by name, from the columns it has (absent ones count as zero)."""
    def number(name: str) -> Column:
        return F.coalesce(F.col(name).try_cast("double"), F.lit(0.0)) if name in columns else F.lit(0.0)

    def only(condition: Column, value: Column) -> Column:
        return F.when(condition, value).otherwise(0.0)

    people, homes, river, zone, surface = (number(c) for c in ("people", "households", "rofrs_rank", "fz_rank", "rofsw_rank"))
    decile = F.col("imd_decile").try_cast("double") if "imd_decile" in columns else F.lit(None).cast("double")
    values = {
        "addresses": only(F.col("point_source") == "nsul", F.lit(1.0)) if "point_source" in columns else F.lit(1.0),
        "people": people, "households": homes, "over65": number("over65")}
    for rank, band in BANDS.items():
        values[f"people_rs_{band}"] = only(river == rank, people)
        values[f"households_rs_{band}"] = only(river == rank, homes)
        values[f"people_sw_{band}"] = only(surface == rank, people)
    values |= {
        "people_rs_high_medium": only(river >= 3, people), "households_rs_high_medium": only(river >= 3, homes),
        "people_sw_high_medium": only(surface >= 3, people), "people_fz2": only(zone == 1, people), "people_fz3": only(zone == 2, people)}
    values |= {name: only(number(c) == 2, people) for c, name in ZONES.items()}
    for source, name in VULNERABLE.items():
        values[name] = number(source)
        values[f"{name}_rs_high_medium"] = only(river >= 3, number(source))
    values |= {
        "people_imd_1_2": only(decile <= 2, people), "imd_w": F.coalesce(people * decile, F.lit(0.0)),
        "imd_wsum": only(decile.isNotNull(), people)}
    return values


def with_values(points: DataFrame, keep: list[str]) -> DataFrame:
    """Points reduced to ``keep`` and their measures."""
    values = point_values(points.columns)
    return points.select(*[c for c in keep if c not in values], *[v.alias(n) for n, v in values.items()])


class Membership:
    """Which points lie in which areas: the cells of the areas are written once, sums and depths come from them tile by tile without a
    row per pair; :attr:`pairs` lists the pairs themselves, only ids and coordinates travel through that join."""

    def __init__(self, points: DataFrame, areas: DataFrame, cell: float = 1000.0, keep: list[str] | None = None):
        self.areas, self.cell = areas, cell
        self.points = points.select("point_id", "easting", "northing", *(keep or []))

    @cached_property
    def pieces(self) -> DataFrame:
        return pieces_of(self.areas, self.cell, ["kind", "area_id"])

    @cached_property
    def pairs(self) -> DataFrame:
        return points_in_areas(self.points, self.areas, self.cell, ["kind", "area_id"])

    @cached_property
    def depth(self) -> DataFrame:
        """How many areas of the same kind cover the point: a warning and an alert over one address do not share it."""
        return stored_table(areas_over_points(self.points, self.pieces, self.cell, "point_id", "kind"), "depth")

    def placed(self, valued: DataFrame) -> DataFrame:
        """The coordinates of each point beside its values."""
        return self.points.select("point_id", "easting", "northing").join(valued, "point_id")


def membership(points: DataFrame, areas: DataFrame, cell: float = 1000.0, keep: list[str] | None = None) -> Membership:
    return Membership(points, areas, cell, keep)


def area_figures(members: Membership, points: DataFrame) -> DataFrame:
    """Gross, unique and split figures per area.  Split figures add up to the true total.

    A point's depth is a value of the point like the others, so every figure is a sum of values over the area.
    """
    names = list(point_values(points.columns))
    deep = members.depth.filter("kind IS NOT NULL")
    unique = {f"{n}_unique": F.when(F.col("depth") == 1, F.col(n)).otherwise(0.0) for n in ADDITIVE}
    split = {f"{n}_split": F.col(n) / F.col("depth") for n in ADDITIVE}
    valued = members.placed(with_values(points, ["point_id"])).join(deep, "point_id").withColumns(unique | split).drop("depth")
    return sums_in_areas(valued, members.pieces, members.cell, ["kind", "area_id"], [*names, *unique, *split], same=["kind"]).drop("n_points")


def kind_totals(members: Membership, points: DataFrame) -> DataFrame:
    """People and number of (point, area) pairs per kind of area."""
    valued = members.placed(points.select("point_id", "people"))
    return sums_in_areas(valued, members.pieces, members.cell, ["kind"], ["people"]).select("kind", "people", F.col("n_points").alias("pairs"))


def derived_measures(areas: DataFrame, figures: DataFrame) -> DataFrame:
    """Every area, those with nobody as 0, with mean decile, shared people and shares."""
    names = [c for c in figures.columns if c not in ("kind", "area_id")]
    joined = areas.select("kind", "area_id").join(figures, ["kind", "area_id"], "left").select(
        "kind", "area_id", *[F.coalesce(n, F.lit(0.0)).alias(n) for n in names])
    share = lambda c: F.bround(F.when(F.col("people") > 0, c / F.col("people")), 4)
    shared = F.col("people") - F.col("people_unique")
    return joined.select(
        *[c for c in joined.columns if c not in ("imd_w", "imd_wsum")],
        F.bround(F.when(F.col("imd_wsum") > 0, F.col("imd_w") / F.col("imd_wsum")), 2).alias("imd_mean_decile"),
        shared.alias("people_shared"), share(shared).alias("share_people_shared"),
        share(F.col("people_rs_high_medium")).alias("share_people_high_medium"), share(F.col("people_imd_1_2")).alias("share_people_imd_1_2"))


def _placed_once(members: Membership, values: DataFrame, names: list[str], repeats: bool) -> tuple[DataFrame, DataFrame]:
    """(points at their one place with the sums of all their rows of ``values``, the ids of points with several places).

    ``repeats``: a point listed n times is met n times on either side."""
    spots = members.points.dropna(subset=["point_id", "easting", "northing"]).groupBy("point_id", "easting", "northing").agg(F.count(F.lit(1)).alias("_n"))
    each = stored_table(spots.groupBy("point_id").agg(F.count(F.lit(1)).alias("_places"), F.min(F.struct("easting", "northing")).alias("_at"),
                                                     F.sum("_n").cast("double").alias("_n")), "spots")
    summed = values.groupBy("point_id").agg(*[F.sum(n).alias(n) for n in names])
    times = F.col("_n") * F.col("_n") if repeats else F.lit(1.0)
    once = each.filter("_places = 1").join(summed, "point_id").select(
        F.col("_at.easting").alias("easting"), F.col("_at.northing").alias("northing"), *[(F.col(n) * times).alias(n) for n in names])
    return once, each.filter("_places > 1").select("point_id")


def pair_overlaps(members: Membership, points: DataFrame, measures: list[str]) -> DataFrame:
    """Pairs of areas of one kind that share points, with what they share.

    The pairs are summed tile by tile (:func:`sums_of_pairs`); only points with several places are first reduced to the sets of areas
    that cover any of them, and these sets are unfolded block by block.
    """
    values = with_values(points, ["point_id"]).select("point_id", *measures)
    once, several = _placed_once(members, values, measures, False)
    pieces = members.pieces.filter("kind IS NOT NULL AND area_id IS NOT NULL")
    a, b = (pieces.withColumnRenamed("area_id", c) for c in ("area_a", "area_b"))
    found = sums_of_pairs(once, a, b, members.cell, ["area_a"], ["area_b"], measures, same=["kind"], ordered=True)
    if several.isEmpty():
        return found
    pairs = points_in_areas(members.points.join(several, "point_id", "left_semi"), members.areas, members.cell, ["kind", "area_id"])
    covers = pairs.filter("kind IS NOT NULL").groupBy("kind", "point_id").agg(F.array_sort(F.collect_set("area_id")).alias("areas"))
    sets = covers.join(values, "point_id").groupBy("kind", "areas").agg(*[F.sum(m).alias(m) for m in measures])
    rest = pairs_within(sets, "areas", "area_a", "area_b").select("kind", "area_a", "area_b", *measures)
    return found.unionByName(rest).groupBy("kind", "area_a", "area_b").agg(*[F.sum(m).alias(m) for m in measures])


def by_codes(members: Membership, points: DataFrame, codes: dict[str, str], measures: list[str], total: str | None = None) -> DataFrame:
    """Area x geography x code figures; points with a blank code do not count in that geography.  ``total`` names the measure that
    is also given, as ``_total``, over all points of the area."""
    valued = with_values(points, ["point_id", *codes.values()])
    columns = {g: f"_code_{i}" for i, g in enumerate(codes)}
    slim = valued.select("point_id", *measures, *[F.col(codes[g]).cast("string").alias(c) for g, c in columns.items()])
    return sums_by_code(members.placed(slim), members.pieces, members.cell, ["kind", "area_id"], columns, measures, total=total)


def mapped_codes(points: DataFrame, lookup: DataFrame, on: str, code: str, out: str) -> DataFrame:
    """Points with a geography reached through a lookup; unmapped points have no code."""
    return points.join(lookup.select(on, F.col(code).alias(out)), on, "left")


def geography_shares(by_code: DataFrame, figures: DataFrame | None, names: DataFrame) -> DataFrame:
    """Area x geography rows with the code's name and the share of the area's people; without ``figures`` the rows have the area's people themselves
    (``_total``), so that they are not shuffled for it."""
    named = names.groupBy("geography", "code").agg(F.min("name").alias("name"))
    if figures is None:
        joined = by_code.dropna(subset=["kind", "area_id"])
    else:
        joined = by_code.join(figures.select("kind", "area_id", F.col("people").alias("_total")), ["kind", "area_id"])
    joined = joined.join(named, ["geography", "code"], "left")
    return joined.withColumn("share_of_area_people", F.bround(F.try_divide("people", "_total"), 4)).drop("_total")


def point_flags(members: Membership, points: DataFrame, keep: list[str]) -> DataFrame:
    """Each point once, with whether a warning and whether an alert area holds it."""
    hit = lambda kind: F.max(F.col("kind") == kind)
    flags = members.depth.groupBy("point_id").agg(hit("flood_warning").alias("_w"), hit("flood_alert").alias("_a"))
    joined = with_values(points, ["point_id", *keep]).join(flags, "point_id", "left")
    no = F.lit(False)
    return joined.withColumn("in_warning", F.coalesce("_w", no)).withColumn("in_alert", F.coalesce("_a", no)).drop("_w", "_a")


COVERED = ["addresses", "people", "households", "over65", "people_rs_high_medium", "households_rs_high_medium", "people_fz3"]


def distinct_coverage(flags: DataFrame) -> DataFrame:
    """Totals over all points and over the points any area of a kind holds, with the people it misses."""
    rows = flags.select(*COVERED, "in_warning", "in_alert").withColumn("kind", F.explode(F.array(
        F.lit("all"), F.when(F.col("in_warning"), "flood_warning"), F.when(F.col("in_alert"), "flood_alert")))).filter("kind IS NOT NULL")
    sums = rows.groupBy("kind").agg(*[F.sum(c).alias(c) for c in COVERED])
    everyone = sums.filter("kind = 'all'").select(F.col("people").alias("_p"), F.col("people_rs_high_medium").alias("_h"), F.lit(1).alias("_one"))
    joined = sums.withColumn("_one", F.lit(1)).join(everyone, "_one")   # at most three rows against one
    gap = lambda total, c: F.when(F.col("kind") == "all", 0.0).otherwise(F.col(total) - F.col(c))
    return joined.select("kind", *COVERED, gap("_p", "people").alias("people_not_in_area"),
                         gap("_h", "people_rs_high_medium").alias("people_high_medium_not_in_area"))


def coverage_by_code(flags: DataFrame, code: str) -> DataFrame:
    """Per code: totals, what warning and alert areas cover, and the high or medium people they miss."""
    split = ["people", "people_rs_high_medium", "households_rs_high_medium", "people_fz3"]
    inside = [F.sum(F.when(F.col(f"in_{k}"), F.col(c)).otherwise(0.0)).alias(f"{c}_in_{k}_area") for k in ("warning", "alert") for c in split]
    sums = flags.groupBy(code).agg(*[F.sum(c).alias(c) for c in COVERED], *inside)
    miss = lambda k: (F.col("people_rs_high_medium") - F.col(f"people_rs_high_medium_in_{k}_area")).alias(
        f"people_high_medium_not_in_{k}_area")
    return sums.select("*", miss("warning"), miss("alert"))


SITE_GROUPS = ["health", "education", "emergency", "utilities"]


def site_counts(sites: DataFrame, pieces: DataFrame, cell: float) -> DataFrame:
    """Critical sites per area that has one: all, by group, in the higher bands and in zone 3."""
    group, one = F.lower("site_group"), lambda c: F.when(c, 1.0).otherwise(0.0)
    counted = {f"sites_{g}": one(group == g) for g in SITE_GROUPS}
    counted |= {"sites_rs_high_medium": one(F.col("rofrs_rank") >= 3), "sites_fz3": one(F.col("fz_rank") == 2)}
    placed = sites.select("easting", "northing", *[v.alias(n) for n, v in counted.items()])
    sums = sums_in_areas(placed, pieces, cell, ["kind", "area_id"], list(counted))
    return sums.select("kind", "area_id", F.col("n_points").alias("sites"), *[F.col(n).cast("long").alias(n) for n in counted])


def site_list(sites: DataFrame, areas: DataFrame, cell: float = 1000.0, keep: list[str] | None = None) -> DataFrame:
    """One row per site and area with the band label; sort by kind, area, worst band, name to read it.  ``keep`` names the columns of the sites."""
    banded = sites.withColumn("band", risk.band_label(F.coalesce("rofrs_rank", F.lit(0))))
    inside = points_in_areas(banded, areas, cell, ["kind", "area_id"], keep_points=[*(keep or sites.columns), "band"])
    return inside.select(*(keep or sites.columns), "kind", "area_id", "band")


def area_scores(cells: DataFrame, pieces: DataFrame, cell: float) -> DataFrame:
    """Risk score per area from the grid cells whose centre it holds: people-weighted mean and the highest."""
    people, score = (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in ("people", "risk_score"))
    centres = cells.select((F.col("easting") + 50.0).alias("easting"), (F.col("northing") + 50.0).alias("northing"), people.alias("_p"),
                           (people * score).alias("_sp"), score.alias("_max"))
    sums = sums_in_areas(centres, pieces, cell, ["kind", "area_id"], ["_p", "_sp"], ["_max"])
    return sums.select("kind", "area_id", F.col("n_points").alias("grid_cells"),
                       F.bround(F.when(F.col("_p") > 0, F.col("_sp") / F.col("_p")), 2).alias("risk_score"), F.bround("_max", 2).alias("risk_score_max"))


def geography_exposure(points: DataFrame, geographies: dict[str, str]) -> DataFrame:
    """Fifteen sums by every geography's code, one pass: the codes are grouping sets of one aggregate."""
    names = ["addresses", "people", "households", "over65", "people_rs_very_low", "people_rs_low", "people_rs_medium", "people_rs_high",
             "people_rs_high_medium", "households_rs_high_medium", "people_fz2", "people_fz3", *ZONES.values()]
    valued = with_values(points, list(geographies.values())).select(*geographies.values(), *names)
    columns = list(geographies.values())
    sets = [[c] for c in columns]
    summed = valued.groupingSets(sets, *columns).agg(*[F.sum(n).alias(n) for n in names], F.grouping_id().alias("_set"))
    # the grouping id has one bit per column, set where the column was rolled away
    full = (1 << len(columns)) - 1
    own = {g: full - (1 << (len(columns) - 1 - i)) for i, g in enumerate(geographies)}
    geography = F.coalesce(*[F.when(F.col("_set") == v, g) for g, v in own.items()])
    code = F.coalesce(*[F.when(F.col("_set") == own[g], F.col(c).cast("string")) for g, c in geographies.items()])
    return summed.select(geography.alias("geography"), code.alias("code"), *names).filter("code IS NOT NULL")


def rollup_through(by_district: DataFrame, lookup: DataFrame, measures: list[str]) -> DataFrame:
    """District figures added up into the geography a lookup puts them in; a split district counts in both."""
    joined = lookup.join(by_district.withColumnRenamed("code", "district_code"), "district_code")
    return joined.groupBy("geography", "geography_code", "geography_name").agg(
        *[F.sum(m).alias(m) for m in measures], F.count(F.lit(1)).alias("districts"))


# ---- the products of one membership --------------------------------------------------------------------------

BY_CONSTITUENCY = ["addresses", "people", "households", "over65", "people_rs_high_medium", "people_fz3"]
BY_GEOGRAPHY = ["addresses", "people", "households", "over65", "people_rs_high_medium"]


class AreaSuite:
    """The exposure tables of one set of points, areas, sites and scored cells.

    The areas are cut to cells once; every table but the lists is a sum over these, without a row per pair.  ``codes`` names the point
    column of each geography, ``lookups`` a geography reached through a table: its point column, the table, its key and its code.  A lookup
    has to be unique by key, or points would be counted twice; areas likewise by kind and id.
    """

    def __init__(self, points: DataFrame, areas: DataFrame, codes: dict[str, str], lookups: dict[str, tuple[str, DataFrame, str, str]] | None = None,
                 cell: float = 1000.0):
        self.areas, self.codes, self.cell = areas, dict(codes), cell
        for geography, (on, lookup, key, code) in (lookups or {}).items():
            points = mapped_codes(points, lookup.withColumnRenamed(key, on), on, code, f"_{geography}")
            self.codes[geography] = f"_{geography}"
        self.points = points
        self.members = membership(points, areas, cell)

    def area_exposure(self, sites: DataFrame, cells: DataFrame) -> DataFrame:
        """Every area once: gross, unique, split and derived figures, its critical sites and its score; areas without points, sites or cells
        have 0, the mean decile, the shares and the score are NULL where there is nobody to weigh."""
        figures = derived_measures(self.areas, area_figures(self.members, self.points))
        counted = site_counts(sites, self.members.pieces, self.cell)
        scores = area_scores(cells, self.members.pieces, self.cell)
        joined = figures.join(counted, ["kind", "area_id"], "left").join(scores, ["kind", "area_id"], "left")
        none = [c for c in counted.columns if c.startswith("sites")] + ["grid_cells"]
        return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in none})

    def area_pairs(self) -> DataFrame:
        return pair_overlaps(self.members, self.points, ["addresses", "people"])

    def area_constituencies(self, column: str = "pcon") -> DataFrame:
        each = by_codes(self.members, self.points, {"constituency": column}, BY_CONSTITUENCY)
        return each.drop("geography").withColumnRenamed("code", column)

    def area_geographies(self, names: DataFrame) -> DataFrame:
        return geography_shares(by_codes(self.members, self.points, self.codes, BY_GEOGRAPHY, total="people"), None, names)

    def coverage(self) -> DataFrame:
        return distinct_coverage(self._flags([]))

    def constituency_coverage(self, column: str = "pcon") -> DataFrame:
        return coverage_by_code(self._flags([column]), column)

    def area_sites(self, sites: DataFrame) -> DataFrame:
        return site_list(sites, self.areas, self.cell)

    def geographies(self, names: DataFrame) -> DataFrame:
        """Every geography's code with its name and the sums of all its points, inside areas or not."""
        named = names.groupBy("geography", "code").agg(F.min("name").alias("name"))
        return geography_exposure(self.points, self.codes).join(named, ["geography", "code"], "left")

    def _flags(self, keep: list[str]) -> DataFrame:
        return point_flags(self.members, self.points, keep)


# ---- rapid guidance ------------------------------------------------------------------------------------------

def guidance_exposure(points: DataFrame, polygons: DataFrame, cell: float = 1000.0) -> tuple[DataFrame, DataFrame]:
    """(per polygon, per polygon and constituency); every polygon is listed, zero where nobody is inside.

    Sums by key: strips or tiles of points simply add up in the partial and final aggregate.
    """
    shapes = polygons.withColumn("kind", F.lit("guidance")).withColumnRenamed("polygon_key", "area_id")
    members = membership(points, shapes, cell)
    names = [n for n in point_values(points.columns) if n not in ("imd_w", "imd_wsum")]
    valued = members.placed(with_values(points, ["point_id"]))
    sums = sums_in_areas(valued, members.pieces, cell, ["area_id"], names).withColumnRenamed("area_id", "polygon_key")
    per_polygon = polygons.select("polygon_key").join(sums, "polygon_key", "left").select(
        "polygon_key", *[F.coalesce(n, F.lit(0.0)).alias(n) for n in names])
    part = ["addresses", "people", "households", "people_rs_high_medium"]
    per_code = by_codes(members, points, {"constituency": "pcon"}, part).select(
        F.col("area_id").alias("polygon_key"), F.col("code").cast(points.schema["pcon"].dataType).alias("pcon"), *part)
    return per_polygon, per_code


def guidance_by_area(points: DataFrame, polygons: DataFrame, areas: DataFrame, cell: float = 1000.0) -> DataFrame:
    """People of each polygon who are in each warning or alert area: the two memberships meet on the points of a tile."""
    shapes = polygons.withColumn("kind", F.lit("guidance")).withColumnRenamed("polygon_key", "area_id")
    under, within = membership(points, shapes, cell), membership(points, areas, cell)
    part, keys = ["addresses", "people", "people_rs_high_medium"], ["polygon_key", "kind", "area_id"]
    values = with_values(points, ["point_id"]).select("point_id", *part)
    once, several = _placed_once(under, values, part, True)
    left = under.pieces.select(F.col("area_id").alias("polygon_key"), "home_x", "home_y", "cell_x", "cell_y", "local")
    found = sums_of_pairs(once, left, within.pieces, cell, ["polygon_key"], ["kind", "area_id"], part)
    if several.isEmpty():
        return found
    listed = points.join(several, "point_id", "left_semi")
    a, b = (membership(listed, m.areas, cell).pairs.select("kind", "area_id", "point_id") for m in (under, within))
    rest = a.select(F.col("area_id").alias("polygon_key"), "point_id").join(b, "point_id").join(values, "point_id").select(*keys, *part)
    return found.unionByName(rest).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in part])
