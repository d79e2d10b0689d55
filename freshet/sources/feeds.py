"""Polled feeds: readings, warnings, stations, members and rapid guidance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from freshet.functions import place, risk, text
from freshet.operators.pick import first_per_key

ISO_FORMATS = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd"]
ISO_ZONED = ["yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd'T'HH:mmXXX", *ISO_FORMATS]


# ---- readings ------------------------------------------------------------------------------------------------

def scan_readings(spark: SparkSession, path: str, renames: dict[str, str], wanted: list[str], numbers: list[str],
                  date_pattern: str = r"(\d{4}-\d{2}-\d{2})") -> DataFrame:
    """Daily readings CSV files as text, renamed; missing columns become NULL; ``reading_date`` is the date in the file name."""
    raw = spark.read.option("header", True).csv(path)
    return typed_readings(raw.withColumn("_file", F.input_file_name()), renames, wanted, numbers, date_pattern)


def typed_readings(raw: DataFrame, renames: dict[str, str], wanted: list[str], numbers: list[str],
                   date_pattern: str = r"(\d{4}-\d{2}-\d{2})", file: str = "_file") -> DataFrame:
    present = {renames.get(c, c): c for c in raw.columns}
    columns = []
    for name in wanted:
        value = F.col(f"`{present[name]}`") if name in present else F.lit(None).cast("string")
        columns.append((value.try_cast("double") if name in numbers else value).alias(name))
    return raw.select(*columns, F.to_date(F.regexp_extract(file, date_pattern, 1)).alias("reading_date"))


def date_mismatches(readings: DataFrame, row_time: str) -> DataFrame:
    """Rows whose own date is not the file's date, per file date."""
    return readings.groupBy("reading_date").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.to_date(row_time) != F.col("reading_date")).alias("other_date"))


def missing_days(held: DataFrame, day: str, first: Column, last: Column) -> DataFrame:
    """Dates of a window not held yet."""
    window = held.sparkSession.range(1).select(F.explode(F.sequence(first, last)).alias(day))
    return window.join(held.select(day).distinct(), day, "left_anti")


def read_blank_null_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV as text where only an empty field is NULL ("NA" stays text)."""
    return spark.read.option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def latest_readings(items: DataFrame, body: str, position: str, ingested_at: Column) -> DataFrame:
    """Latest-readings items (one JSON text per row).

    ``measure`` may be text, a list or an object with ``@id``.  No measure or no readable time: skipped.  An unreadable value
    is kept as NULL.  A (measure, time) seen twice keeps the later ``position``.
    """
    raw = F.get_json_object(body, "$.measure")
    listed = F.get_json_object(raw, "$[0]")
    measure = F.coalesce(F.get_json_object(raw, "$['@id']"), F.get_json_object(listed, "$['@id']"), listed, raw)
    when = text.any_time(F.get_json_object(body, "$.dateTime"), ISO_ZONED)
    rows = items.select(
        measure.alias("measure_uri"), when.alias("date_time"), F.to_date(when).alias("reading_date"),
        text.reading_value(F.get_json_object(body, "$.value")).alias("value"), ingested_at.alias("ingested_at"),
        F.col(position).alias("_position"))
    readable = rows.filter((F.col("measure_uri") != "") & F.col("date_time").isNotNull())
    return first_per_key(readable, ["measure_uri", "date_time"], [F.col("_position")], highest=True).drop("_position")


# ---- warnings ------------------------------------------------------------------------------------------------

WARNING_ITEM = (
    "floodAreaID string, severityLevel int, severity string, isTidal boolean, message string, timeRaised string, "
    "timeMessageChanged string, timeSeverityChanged string, description string, eaAreaName string, "
    "floodArea struct<riverOrSea:string,county:string>")


def warning_feed(items: DataFrame, body: str, position: str, ingested_at: Column) -> DataFrame:
    """The warnings feed: flat fields, three time layouts read as UTC, the last duplicate of an area wins."""
    rows = items.select(F.from_json(body, WARNING_ITEM).alias("w"), F.col(position).alias("_position"))
    flat = rows.filter(F.coalesce(F.col("w.floodAreaID"), F.lit("")) != "").select(
        F.col("w.floodAreaID").alias("flood_area_id"), F.col("w.severityLevel").alias("severity_level"),
        F.col("w.severity").alias("severity_label"), F.col("w.isTidal").alias("is_tidal"), F.col("w.message").alias("message"),
        *[text.any_time(F.col(f"w.{a}"), ISO_FORMATS).alias(b) for a, b in (
            ("timeRaised", "time_raised"), ("timeMessageChanged", "time_message_changed"), ("timeSeverityChanged", "time_severity_changed"))],
        F.col("w.description").alias("description"), F.col("w.eaAreaName").alias("ea_area_name"),
        F.col("w.floodArea.riverOrSea").alias("river_or_sea"), F.col("w.floodArea.county").alias("county"),
        ingested_at.alias("ingested_at"), F.col("_position"))
    return first_per_key(flat, ["flood_area_id"], [F.col("_position")], highest=True).drop("_position")


# ---- stations ------------------------------------------------------------------------------------------------

def scalar_or_first(body: str, path: str) -> Column:
    """A field that may be a value or a list: the value, or the first entry."""
    raw = F.get_json_object(body, path)
    return F.when(raw.startswith("["), F.get_json_object(raw, "$[0]")).otherwise(raw)


def stations(items: DataFrame, body: str = "body") -> DataFrame:
    fields = ["label", "stationReference", "notation", "riverName", "catchmentName", "town", "RLOIid", "wiskiID", "lat", "long",
              "easting", "northing", "gridReference"]
    return items.select(
        F.get_json_object(body, "$['@id']").alias("station_id"), *[scalar_or_first(body, f"$.{f}").alias(f) for f in fields],
        F.substring_index(scalar_or_first(body, "$.status"), "/", -1).alias("status"))


def station_measures(items: DataFrame, body: str = "body") -> DataFrame:
    """One row per station and measure; a station with none keeps one row with NULL measure fields."""
    schema = "array<struct<`@id`:string,parameter:string,parameterName:string,qualifier:string,period:string,unitName:string>>"
    exploded = items.select(
        F.get_json_object(body, "$['@id']").alias("station_id"),
        F.explode_outer(F.from_json(F.get_json_object(body, "$.measures"), schema)).alias("m"))
    return exploded.select(
        "station_id", F.col("m.@id").alias("measure_uri"), F.col("m.parameter").alias("parameter"), F.col("m.qualifier").alias("qualifier"),
        F.col("m.period").alias("period"), F.col("m.unitName").alias("unit_name"))


# ---- members -------------------------------------------------------------------------------------------------

CONTACT_FIELDS = ["email", "phone", "website", "handle"]


def contact_rows(members: DataFrame, contacts: str = "contacts") -> DataFrame:
    """The contact list of each member turned to columns by type."""
    listed = members.select("member_id", F.explode_outer(F.from_json(contacts, "array<struct<type:string,value:string>>")).alias("c"))
    return listed.groupBy("member_id").pivot("c.type", CONTACT_FIELDS).agg(F.max("c.value"))


def keep_previous_contacts(fresh: DataFrame, previous: DataFrame, failed: str = "lookup_failed") -> DataFrame:
    """A failed lookup keeps the values held before."""
    before = previous.select("member_id", *[F.col(c).alias(f"_was_{c}") for c in CONTACT_FIELDS])
    joined = fresh.join(before, "member_id", "left")
    kept = [F.when(F.col(failed), F.coalesce(F.col(c), F.col(f"_was_{c}"))).otherwise(F.col(c)).alias(c) for c in CONTACT_FIELDS]
    return joined.select(*[c for c in fresh.columns if c not in CONTACT_FIELDS], *kept)


# ---- rapid guidance ------------------------------------------------------------------------------------------

UPDATE = (
    "id bigint, status string, issued_at string, last_updated string, date_issued string, time_issued string, pdf_url string, "
    "national_summary string, polygons array<struct<polygon_number:int,coordinates:string,updated_at:string,latest_update:string,"
    "counties:array<string>,is_valid:boolean>>")


def parse_guidance(documents: DataFrame, body: str = "body") -> DataFrame:
    parsed = documents.select(F.from_json(body, UPDATE).alias("u")).select("u.*")
    return parsed.withColumn("update_key", text.guidance_key(F.col("id"), F.col("last_updated")))


def _polygon_geometry(coordinates: Column) -> Column:
    kind = risk.lookup(place.nesting_depth(coordinates), {3: "Polygon", 4: "MultiPolygon"})
    return place.geojson(kind, coordinates)


def guidance_polygons(updates: DataFrame, ingested_at: Column) -> DataFrame:
    """One row per polygon; one without usable coordinates is kept with a NULL geometry."""
    rows = updates.select("update_key", F.col("id").alias("guidance_id"), F.posexplode("polygons").alias("pos", "p"))
    return rows.select(
        "update_key", "guidance_id", F.coalesce("p.polygon_number", F.col("pos") + 1).alias("polygon_number"),
        _polygon_geometry(F.col("p.coordinates")).alias("geometry"),
        text.any_time(F.col("p.updated_at"), ISO_ZONED).alias("updated_at"), F.col("p.latest_update").alias("latest_update"),
        F.concat_ws(", ", "p.counties").alias("counties"), F.coalesce("p.is_valid", F.lit(False)).alias("is_valid"),
        ingested_at.alias("ingested_at"))


def guidance_updates(updates: DataFrame, ingested_at: Column) -> DataFrame:
    polygons = F.coalesce("polygons", F.array())
    valid = F.filter("polygons", lambda p: F.coalesce(p.is_valid, F.lit(False)) & _polygon_geometry(p.coordinates).isNotNull())
    return updates.select(
        "update_key", F.col("id").alias("guidance_id"), "status",
        (text.guidance_present(F.col("status")) & F.col("id").isNotNull()).alias("is_present"),
        text.any_time(F.col("issued_at"), ISO_ZONED).alias("issued_at"), text.any_time(F.col("last_updated"), ISO_ZONED).alias("last_updated"),
        "date_issued", "pdf_url", "national_summary", F.size(polygons).alias("n_polygons"),
        F.coalesce(F.size(valid), F.lit(0)).alias("n_valid"), ingested_at.alias("ingested_at"))


def new_versions(updates: DataFrame, stored: DataFrame) -> DataFrame:
    """Updates whose (key, last_updated) is not stored, one per version within the batch."""
    on = ["update_key", "last_updated"]
    return updates.dropDuplicates(on).join(stored.select(*on).distinct(), on, "left_anti")
