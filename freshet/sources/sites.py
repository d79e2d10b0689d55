"""Critical sites: schools, health organisations and tagged map features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from freshet.functions import place, text

# The words of hospital-type names, and of parts of a hospital.
HOSPITAL_WORDS = (
    r"(?i)\b(hospital|infirmary|a ?& ?e|accident|emergency (department|care)|urgent (treatment|care)|walk[- ]?in|minor injur|maternity|"
    r"birth ?(centre|center)|mental health unit|psychiatric)\b")
HOSPITAL_PARTS = (
    r"(?i)\b(ward|wards|department|dept|outpatient|outpatients|pharmacy|theatre|theatres|day (surgery|unit|case|hospital)|endoscopy|dialysis|"
    r"imaging|radiology|pathology|laboratory|catering|estates|car park|offices?|headquarters|admin|annex|annexe|block|building|wing)\b")
SUBSTATION_VOLTS = 66_000
SITE_COLUMNS = ["site_group", "site_type", "name", "easting", "northing", "postcode", "source", "source_id"]


def is_hospital_name(name: Column) -> Column:
    return name.rlike(HOSPITAL_WORDS) & ~name.rlike(HOSPITAL_PARTS)


def school_sites(schools: DataFrame) -> DataFrame:
    """Open establishments with coordinates; the phase names the type unless it says nothing."""
    phase = F.when(~F.coalesce("phase", F.lit("")).isin("", "Not applicable", "nan"), F.col("phase")).otherwise(F.col("establishment_type"))
    placed = schools.filter(F.lower("status").startswith("open")).withColumn(
        "easting", F.col("easting").try_cast("double")).withColumn("northing", F.col("northing").try_cast("double"))
    return placed.filter((F.col("easting") > 0) & (F.col("northing") > 0)).select(
        F.lit("education").alias("site_group"), phase.alias("site_type"), "name", "easting", "northing",
        F.coalesce("postcode", F.lit("")).alias("postcode"), F.lit("schools").alias("source"), F.col("urn").cast("string").alias("source_id"))


def health_sites(organisations: DataFrame, role: str, postcodes: DataFrame) -> DataFrame:
    """Organisations placed by their normalised postcode; those not found are dropped."""
    lookup = postcodes.select(text.postcode(F.col("postcode")).alias("_pc"), F.col("easting").try_cast("double").alias("easting"),
                              F.col("northing").try_cast("double").alias("northing"))
    first = lookup.groupBy("_pc").agg(F.min(F.struct("easting", "northing")).alias("_xy"))
    joined = organisations.withColumn("_pc", text.postcode(F.col("postcode"))).join(first, "_pc")
    placed = joined.filter((F.col("_xy.easting") > 0) & (F.col("_xy.northing") > 0))
    return placed.select(
        F.lit("health").alias("site_group"), F.lit(role).alias("site_type"), "name", F.col("_xy.easting").alias("easting"),
        F.col("_xy.northing").alias("northing"), "postcode", F.lit("health").alias("source"), F.col("org_id").cast("string").alias("source_id"))


def feature_class(tags: Column, include_schools: bool = False) -> Column:
    """(site_group, site_type) of a tagged feature, NULL when it is not a critical site.  The first rule that fits decides."""
    tag = lambda k: F.coalesce(F.lower(F.element_at(tags, k)), F.lit(""))
    amenity, care, emergency, power, made = tag("amenity"), tag("healthcare"), tag("emergency"), tag("power"), tag("man_made")
    volts = F.coalesce(F.array_max(F.transform(
        F.regexp_extract_all(tag("voltage"), F.lit(r"(\d+)"), 1), lambda v: v.try_cast("long"))), F.lit(0))
    renewable = (F.concat_ws(";", tag("plant:source"), tag("generator:source"))).rlike("solar|wind")
    rules = [
        ((amenity == "hospital") | (care == "hospital"), "health", "hospital"),
        ((amenity == "clinic") | (care == "clinic"), "health", "clinic"),
        ((amenity == "doctors") | (care == "doctor"), "health", "gp surgery"),
        ((amenity == "nursing_home") | ((amenity == "social_facility")
            & tag("social_facility").isin("nursing_home", "residential_home", "assisted_living")), "health", "care home"),
        (amenity == "college", "education", "college"),
        (amenity == "university", "education", "university"),
        (amenity == "kindergarten", "education", "nursery"),
        ((amenity == "school") & F.lit(include_schools), "education", "school"),
        (amenity == "police", "emergency", "police station"),
        (amenity == "fire_station", "emergency", "fire station"),
        ((amenity == "ambulance_station") | (emergency == "ambulance_station"), "emergency", "ambulance station"),
        (emergency.isin("lifeboat_station", "coast_guard") | (amenity == "coast_guard"), "emergency", "coastguard or lifeboat station"),
        (amenity == "prison", "emergency", "prison"),
        ((power == "substation") & ((tag("substation") == "transmission") | (volts >= SUBSTATION_VOLTS)), "utilities", "substation"),
        ((power == "plant") & renewable, None, None),
        (power == "plant", "utilities", "power station"),
        (made == "wastewater_plant", "utilities", "sewage works"),
        (made == "water_works", "utilities", "water treatment works"),
    ]
    nothing = F.lit(None).cast("struct<site_group:string,site_type:string>")
    result = None
    for condition, group, kind in rules:
        value = nothing if group is None else F.struct(F.lit(group).alias("site_group"), F.lit(kind).alias("site_type"))
        result = F.when(condition, value) if result is None else result.when(condition, value)
    return result.otherwise(nothing)


def feature_sites(features: DataFrame, include_schools: bool = False) -> DataFrame:
    """Tagged features (osm_id, kind, lon, lat, tags) that are critical sites, in national-grid metres."""
    easting, northing = place.to_national_grid(F.col("lat"), F.col("lon"))
    classed = features.withColumn("_c", feature_class(F.col("tags"), include_schools)).filter(F.col("_c").isNotNull())
    return classed.select(
        F.col("_c.site_group"), F.col("_c.site_type"), F.coalesce(F.element_at("tags", "name"), F.lit("")).alias("name"),
        easting.alias("easting"), northing.alias("northing"), F.lit("").alias("postcode"), F.lit("osm").alias("source"),
        F.concat_ws("/", "kind", F.col("osm_id").cast("string")).alias("source_id"))
