"""Boundaries, address points, census, deprivation, sites and reference lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from freshet.functions import place, text

ESRI_NULL_DATE = "1899-12-30"


# ---- boundaries ----------------------------------------------------------------------------------------------

def geojson_features(documents: DataFrame, properties: list[str], body: str = "body") -> DataFrame:
    """FeatureCollection documents to rows: properties as text columns, ``geometry`` as GeoJSON text, ``epsg``.

    Without a ``crs`` member the code is 4326; an old-style member names it in its last digits.
    """
    name = F.get_json_object(body, "$.crs.properties.name")
    code = F.regexp_extract(F.coalesce(name, F.lit("")), r"(\d{4,5})\s*$", 1).try_cast("int")
    features = F.from_json(F.get_json_object(body, "$.features"), "array<struct<properties:map<string,string>,geometry:string>>")
    rows = documents.filter(F.get_json_object(body, "$.type") == "FeatureCollection").select(
        F.coalesce(code, F.lit(4326)).alias("epsg"), F.explode(features).alias("f"))
    return rows.select(*[F.element_at("f.properties", p).alias(p) for p in properties], F.col("f.geometry").alias("geometry"), "epsg")


def admin_areas(features: DataFrame, dates: list[str]) -> DataFrame:
    """Boundary rows with WKT text; the ESRI null date reads as NULL."""
    kind, coordinates = F.get_json_object("geometry", "$.type"), F.get_json_object("geometry", "$.coordinates")
    shaped = features.withColumn("wkt", place.wkt(kind, coordinates))
    for name in dates:
        shaped = shaped.withColumn(name, F.when(~F.col(name).startswith(ESRI_NULL_DATE), F.col(name)))
    return shaped


def parsed_geometry(areas: DataFrame, geometry: str = "geometry") -> DataFrame:
    """``rings`` and ``geometry_status`` per row; rows that are not polygons have NULL rings and are dropped by status."""
    g = F.col(geometry)
    status = place.geometry_status(g)
    return areas.withColumn("geometry_status", status).withColumn("rings", F.when(status == "ok", place.rings_from_geojson(g)))


def boxes_meeting(polygons: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float, bbox: str = "bbox") -> DataFrame:
    """Polygons whose stored box meets a tile; the filter is on struct fields, so Parquet statistics prune row groups."""
    b = lambda f: F.col(f"{bbox}.{f}")
    return polygons.filter((b("xmin") <= xmax) & (b("xmax") >= xmin) & (b("ymin") <= ymax) & (b("ymax") >= ymin))


def tile_inventory(listing: DataFrame, path: str = "path") -> DataFrame:
    """Present-day tile files: a tile with exactly one file is usable, any other is skipped with a note."""
    tagged = listing.withColumn("tile", place.tile_from_name(F.col(path))).filter(
        F.col("tile").isNotNull() & place.is_present_day(F.col(path)))
    grouped = tagged.groupBy("tile").agg(F.count(F.lit(1)).alias("files"), F.min(path).alias("first_path"))
    note = F.when(F.col("files") == 1, "ok").otherwise(F.concat(F.lit("skipped: "), F.col("files"), F.lit(" files")))
    return grouped.select("tile", "files", F.when(F.col("files") == 1, F.col("first_path")).alias("path"), note.alias("note"))


# ---- address points ------------------------------------------------------------------------------------------

NO_COUNTY = "E99999999"


def address_points(raw: DataFrame, renames: dict[str, str], country: str | None = None) -> DataFrame:
    """Typed address points: unplaced and foreign rows dropped, the county falls back to the district."""
    named = raw.select(*[F.col(f"`{a}`").alias(b) for a, b in renames.items() if a in raw.columns])
    placed = (named.withColumn("easting", F.col("easting").try_cast("double")).withColumn("northing", F.col("northing").try_cast("double"))
              .filter((F.col("easting") > 0) & (F.col("northing") > 0)))
    if country:
        placed = placed.filter(F.col("ctry") == country)
    county = F.when(F.coalesce("cty", F.lit(NO_COUNTY)) == NO_COUNTY, F.col("lad")).otherwise(F.col("cty"))
    return (placed.withColumn("ctyua", county).withColumn("cell_key", place.cell_key(F.col("easting"), F.col("northing")))
            .withColumn("tile", place.tile_code(F.col("easting"), F.col("northing"))).drop("cty", "ctry"))


# ---- published tables with named columns ---------------------------------------------------------------------
# Headers differ between releases, so callers say which columns they mean: {field: [headers]} or {field: header}.

def measures(raw: DataFrame, area: str, fields: dict[str, list[str]], key: str = "oa") -> DataFrame:
    """One numeric column per field, the sum of its headers; NULL where none of them holds a number."""
    def total(headers: list[str]) -> Column:
        parts = F.array(*[F.col(f"`{h}`").try_cast("double") for h in headers])
        held = F.filter(parts, lambda v: v.isNotNull())
        return F.when(F.size(held) > 0, F.aggregate(held, F.lit(0.0), lambda a, v: a + v))

    return raw.select(F.col(f"`{area}`").alias(key), *[total(headers).alias(f) for f, headers in fields.items()])


def side_by_side(tables: list[DataFrame], key: str = "oa", how: str = "left") -> DataFrame:
    """Tables with one row per area, joined on it."""
    return reduce(lambda a, b: a.join(b, key, how), tables)


def share_of(areas: DataFrame, part: str, whole: str, name: str) -> DataFrame:
    return areas.withColumn(name, F.when(F.col(whole) > 0, F.col(part) / F.col(whole)))


def gap_summary(areas: DataFrame, expected: str, counted: str, tolerances: tuple[float, float] = (0.5, 5.0)) -> DataFrame:
    """How far two columns that should agree lie apart: areas beyond each tolerance, the largest gap, the sum of gaps."""
    gap = F.col(counted) - F.col(expected)
    low, high = tolerances
    return areas.agg(F.count_if(F.abs(gap) > low).alias("differs"), F.count_if(F.abs(gap) > high).alias("differs_by_more_than_5"),
                     F.max(F.abs(gap)).alias("largest"), F.sum(gap).alias("people"))


def named_columns(raw: DataFrame, texts: dict[str, str], numbers: dict[str, str]) -> DataFrame:
    """The given headers under the given names, as text or as numbers (NULL where a cell is not one)."""
    return raw.select(*[F.trim(F.col(f"`{h}`").cast("string")).alias(f) for f, h in texts.items()],
                      *[F.col(f"`{h}`").try_cast("double").alias(f) for f, h in numbers.items()])


def england_only(df: DataFrame, code: str, prefix: str = "E") -> DataFrame:
    return df.filter(F.col(code).startswith(prefix))


def ranked_links(pages: DataFrame, html: str, page_id: str, base: Column, pattern: str, skip: str, points: dict[str, int]) -> DataFrame:
    """Links of each page that match ``pattern``, absolute, scored and numbered best first."""
    links = F.array_distinct(F.regexp_extract_all(F.col(html), F.lit(pattern), 1))
    rows = pages.select(page_id, base.alias("_base"), F.explode(links).alias("link"))
    absolute = F.when(F.col("link").rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), F.col("link")).when(
        F.col("link").startswith("/"), F.concat("_base", "link")).otherwise(F.concat("_base", F.lit("/"), "link"))
    lowered = F.lower("url")
    score = reduce(lambda a, b: a + b, [F.when(lowered.contains(w), p).otherwise(0) for w, p in points.items()], F.lit(0))
    scored = (rows.select(page_id, absolute.alias("url")).filter(~F.lower("url").contains(skip)).distinct()
              .withColumn("score", score))
    from pyspark.sql import Window

    order = Window.partitionBy(page_id).orderBy(F.desc("score"), "url")
    return scored.withColumn("position", F.row_number().over(order))


# ---- reference lists -----------------------------------------------------------------------------------------

def code_names(raw: DataFrame, code: str, name: str) -> DataFrame:
    """(code, name), one row per code; of several names the first in order."""
    return named_columns(raw, {"code": code, "name": name}, {}).groupBy("code").agg(F.min("name").alias("name"))


def district_links(raw: DataFrame, geography: str, district: str, code: str, name: str) -> DataFrame:
    """(district_code, geography, geography_code, geography_name) of one larger geography; rows without its code go."""
    rows = named_columns(raw, {"district_code": district, "geography_code": code, "geography_name": name}, {})
    coded = rows.withColumn("geography_code", text.clean(F.col("geography_code"))).filter("geography_code IS NOT NULL")
    links = coded.groupBy("district_code", "geography_code").agg(F.min("geography_name").alias("geography_name"))
    return links.select("district_code", F.lit(geography).alias("geography"), "geography_code", "geography_name")
