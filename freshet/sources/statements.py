"""Forecast statements (nested JSON) to flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from freshet.functions import place, risk

POLY = "struct<id:bigint,type:string,poly_type:string,risk_area_block_id:bigint,coordinates:string>"
BLOCK = f"struct<id:bigint,days:array<bigint>,risk_levels:map<string,string>,polys:array<{POLY}>>"
STATEMENT = (
    "id bigint, issued_at string, last_modified_at string, next_issue_due_at string, headline string, amendments string, "
    "future_forecast string, sources array<map<string,string>>, "
    "flood_risk_trend struct<day1:string,day2:string,day3:string,day4:string,day5:string>, "
    "public_forecast struct<england_forecast:string,wales_forecast_english:string>, pdf_url string, detailed_csv_url string, "
    f"risk_areas array<struct<id:bigint,beyond_five_days:boolean,risk_area_blocks:array<{BLOCK}>>>, "
    f"aoc_maps array<struct<id:bigint,polys:array<{POLY}>>>")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON files, one document each, as (body, file)."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("body"), F.input_file_name().alias("file"))


def parse_statements(documents: DataFrame, body: str = "body") -> DataFrame:
    """One typed row per statement; coordinates and risk levels stay as JSON text until they are needed."""
    return documents.select(F.from_json(F.col(body), STATEMENT).alias("s")).select("s.*").filter("id IS NOT NULL")


def flatten_sources(sources: Column) -> Column:
    """``[{a: ..}, {b: ..}]`` to one map; a later key wins."""
    entries = F.flatten(F.transform(sources, lambda m: F.map_entries(m)))
    latest = F.filter(entries, lambda e, i: ~F.exists(
        F.slice(entries, i + 2, F.size(entries)), lambda later: later.key == e.key))
    return F.map_from_entries(latest)


def statement_rows(statements: DataFrame, ingested_at: Column) -> DataFrame:
    sources = flatten_sources(F.col("sources"))
    trend = [F.col(f"flood_risk_trend.day{n}").alias(f"flood_risk_trend_day{n}") for n in range(1, 6)]
    named = [F.element_at(sources, s).alias(f"source_{s}") for s in ("coastal", "ground", "river", "surface")]
    return statements.select(
        F.col("id").alias("statement_id"), "issued_at", "last_modified_at", "next_issue_due_at", "headline", "amendments",
        "future_forecast", *trend, *named, F.col("public_forecast.england_forecast").alias("england_forecast"),
        F.col("public_forecast.wales_forecast_english").alias("wales_forecast_english"), "pdf_url", "detailed_csv_url",
        ingested_at.alias("ingested_at"))


def _block_levels(statements: DataFrame) -> DataFrame:
    """One row per statement, block, day and source, malformed levels included (``levels`` NULL or short)."""
    areas = statements.select("id", "issued_at", F.explode("risk_areas").alias("a"))
    blocks = areas.select("id", "issued_at", F.col("a.id").alias("area"), "a.beyond_five_days", F.explode("a.risk_area_blocks").alias("b"))
    # levels are read once per source, before days and polygons multiply the rows
    sources = blocks.select("*", F.explode("b.risk_levels").alias("source", "raw")).withColumn("levels", F.from_json("raw", "array<int>"))
    return sources.select("*", F.explode("b.days").alias("day_index"))


def usable(levels: Column) -> Column:
    return F.coalesce(F.size(levels) >= 2, F.lit(False)) & levels[0].isNotNull() & levels[1].isNotNull()


def malformed_levels(statements: DataFrame) -> DataFrame:
    """The side count of skipped entries: one row with the entries seen and skipped."""
    return _block_levels(statements).agg(F.count(F.lit(1)).alias("entries"), F.count_if(~usable(F.col("levels"))).alias("skipped"))


def _risk_columns() -> list[Column]:
    x, y = F.col("levels")[0], F.col("levels")[1]
    return [
        F.col("id").alias("statement_id"), F.col("issued_at"), F.col("area").alias("risk_area_id"),
        F.col("b.id").alias("risk_area_block_id"), F.col("day_index"),
        F.date_format(risk.forecast_date(F.substring("issued_at", 1, 10), F.col("day_index")), "yyyy-MM-dd").alias("forecast_date"),
        F.col("source"), x.cast("long").alias("risk_x"), y.cast("long").alias("risk_y"), risk.impact_label(x).alias("impact_label"),
        risk.likelihood_label(y).alias("likelihood_label"), risk.matrix_level(x, y).alias("risk_level"),
        risk.matrix_colour(x, y).alias("risk_colour"), F.coalesce("beyond_five_days", F.lit(False)).alias("beyond_five_days")]


def block_rows(statements: DataFrame, ingested_at: Column) -> DataFrame:
    """Statement x block x day x source, no geometry."""
    return _block_levels(statements).filter(usable(F.col("levels"))).select(*_risk_columns(), ingested_at.alias("ingested_at"))


def risk_polygons(statements: DataFrame, ingested_at: Column) -> DataFrame:
    """Statement x block x day x polygon x source."""
    rows = _block_levels(statements).filter(usable(F.col("levels"))).withColumn("poly", F.explode("b.polys"))
    kind = place.geometry_type(F.col("poly.type"), F.col("poly.coordinates"))
    return rows.select(
        *_risk_columns(), F.col("poly.id").alias("poly_id"), F.col("poly.poly_type").alias("poly_type"),
        kind.alias("geometry_type"), place.geojson(kind, F.col("poly.coordinates")).alias("geometry"), ingested_at.alias("ingested_at"))


def concern_polygons(statements: DataFrame, ingested_at: Column) -> DataFrame:
    """Area-of-concern polygons; one without a block is kept, unlinked."""
    maps = statements.select(F.col("id").alias("statement_id"), "issued_at", F.explode("aoc_maps").alias("m"))
    polys = maps.select("statement_id", "issued_at", F.col("m.id").alias("aoc_map_id"), F.explode("m.polys").alias("poly"))
    kind = place.geometry_type(F.col("poly.type"), F.col("poly.coordinates"))
    return polys.select(
        "statement_id", "issued_at", "aoc_map_id", F.col("poly.id").alias("poly_id"), F.col("poly.risk_area_block_id"),
        F.col("poly.poly_type"), kind.alias("geometry_type"),
        place.geojson(kind, F.col("poly.coordinates")).alias("geometry"), ingested_at.alias("ingested_at"))


def pages_to_load(pages: DataFrame, done: DataFrame, start_page: int = 1) -> DataFrame:
    """Landed page files still to load: from ``start_page`` up to the first short or empty page, less the pages committed.

    ``pages`` has page, rows and page_size; the first short page ends the backfill.
    """
    wanted = pages.filter(F.col("page") >= start_page)
    last = wanted.filter(F.col("rows") < F.col("page_size")).agg(F.min("page").alias("p")).first()["p"]
    in_range = wanted if last is None else wanted.filter(F.col("page") <= last)
    return in_range.filter("rows > 0").join(done.select("page").distinct(), "page", "left_anti")
