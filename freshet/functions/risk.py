"""Risk ranks, matrix labels, hazard bands and warning-area codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Public risk matrix and label texts.
LEVEL_NAMES = {1: "Very Low", 2: "Low", 3: "Medium", 4: "High"}
IMPACT_NAMES = {1: "Minor", 2: "Moderate", 3: "Significant", 4: "Extreme"}
LIKELIHOOD_NAMES = {1: "Low", 2: "Medium", 3: "High", 4: "Very High"}
LEVEL_COLOURS = {1: "Green", 2: "Yellow", 3: "Amber", 4: "Red"}
# One row per likelihood 1..4, one entry per impact 1..4: the rank of the risk level.
MATRIX_RANKS = [
    [1, 1, 2, 2],
    [1, 1, 2, 3],
    [1, 2, 3, 3],
    [1, 2, 3, 4],
]
# Characters 4 to 6 of a warning-area code.
ALERT_CODES = ["WAF", "WAT", "WAC", "FAG", "WAB"]
WARNING_CODES = ["FWF", "FWC", "FWG", "FWB", "FWT"]
CODE_TEXT = {
    "FWF": "Flood Warning Fluvial",
    "FWC": "Flood Warning Coastal",
    "FWG": "Flood Warning Groundwater",
    "FWB": "Flood Warning Both",
    "FWT": "Flood Warning Tidal",
    "WAF": "Flood Alert Fluvial",
    "WAT": "Flood Alert Tidal",
    "WAC": "Flood Alert Coastal",
    "FAG": "Flood Alert Groundwater",
    "WAB": "Flood Alert Both",
}
SOURCE_CODES = {
    "river": ["FWF", "WAF", "FWB", "WAB"],
    "coastal": ["FWC", "WAC", "FWB", "WAB", "FWT", "WAT"],
    "ground": ["FWG", "FAG"],
    "surface": [],
}
SOURCE_LETTERS = {"F": "fluvial", "C": "coastal", "T": "tidal", "G": "groundwater", "B": "fluvial and coastal"}


def lookup(key: Column, table: dict, default=None) -> Column:
    """A literal map lookup; unknown keys give ``default``."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    found = F.element_at(F.create_map(*entries), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def risk_rank(level: Column) -> Column:
    return lookup(level, {name: rank for rank, name in LEVEL_NAMES.items()}, 0)


def risk_level(rank: Column) -> Column:
    return lookup(rank.cast("int"), LEVEL_NAMES)


def matrix_rank(impact: Column, likelihood: Column) -> Column:
    """Rank of an (impact, likelihood) position, NULL off the 4 x 4 matrix."""
    grid = F.array(*[F.lit(r) for row in MATRIX_RANKS for r in row])
    on_grid = impact.between(1, 4) & likelihood.between(1, 4)
    return F.when(on_grid, F.element_at(grid, ((likelihood - 1) * 4 + impact).cast("int")))


def matrix_level(impact: Column, likelihood: Column) -> Column:
    return F.coalesce(risk_level(matrix_rank(impact, likelihood)), F.lit("Unknown"))


def matrix_colour(impact: Column, likelihood: Column) -> Column:
    return F.coalesce(lookup(matrix_rank(impact, likelihood), LEVEL_COLOURS), F.lit("Unknown"))


def impact_label(impact: Column) -> Column:
    return lookup(impact.cast("int"), IMPACT_NAMES, "Unknown")


def likelihood_label(likelihood: Column) -> Column:
    return lookup(likelihood.cast("int"), LIKELIHOOD_NAMES, "Unknown")


def band_rank(label: Column) -> Column:
    """Band text to 0..4; case, underscores and repeated spaces do not matter."""
    plain = F.trim(F.regexp_replace(F.lower(label), r"[_\s]+", " "))
    return F.coalesce(lookup(plain, {n.lower(): r for r, n in LEVEL_NAMES.items()}), F.lit(0))


def band_label(rank: Column) -> Column:
    return F.coalesce(risk_level(rank), F.lit("None"))


def flood_zone_group(text: Column) -> Column:
    sea = F.coalesce(F.lower(text).rlike("sea|coast|tidal"), F.lit(False))
    river = F.coalesce(F.lower(text).rlike("river|fluvial"), F.lit(False))
    return (F.when(sea & river, "river_and_sea").when(sea, "sea").when(river, "river").otherwise("other"))


def type_code(area_code: Column) -> Column:
    return F.when(F.length(area_code) >= 6, F.substring(area_code, 4, 3)).otherwise("")


def type_text(code: Column) -> Column:
    return lookup(code, CODE_TEXT)


def area_kind(area_code: Column) -> Column:
    code = F.substring(area_code, 4, 3)
    return (F.when(code.isin(ALERT_CODES), "flood_alert")
            .when(code.isin(WARNING_CODES), "flood_warning").otherwise("unknown"))


def area_source(area_code: Column) -> Column:
    return lookup(F.substring(area_code, 6, 1), SOURCE_LETTERS)


def forecast_date(issued: Column, day_index: Column) -> Column:
    return F.date_add(F.to_date(issued), (day_index - 1).cast("int"))
