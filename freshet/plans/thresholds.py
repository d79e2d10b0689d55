"""Flood-warning thresholds linked to gauge measures of the same unit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from freshet.functions import text
from freshet.plans.mapping import joined_notes, lowered
from freshet.plans.notes import NOTES
from freshet.session import stored_table

# Units taken to mean the same, and the local datums.
SAME_DATUM = [("mald", "masd")]
BARE_METRE = [("mald", "m"), ("masd", "m"), ("maod", "m")]
LOCAL = ["mald", "masd"]
KINDS = ["exact", "datum_assumed", "alias", "converted"]
MEASURE = ["measure_uri", "station_reference", "station_label", "unit_name", "register_value_type", "n_readings"]


def prepare(raw: DataFrame, columns: dict[str, str], basis: str = "Observed", category: str = "Flood Warning") -> DataFrame:
    """The observed flood-warning thresholds in one shape.  ``columns`` names the file's column of each field."""
    col = lambda f: F.col(f"`{columns[f]}`") if f in columns else F.lit(None).cast("string")
    chosen = raw.filter((F.lower(text.clean(col("basis"))) == basis.lower()) & (F.lower(text.clean(col("catdesc"))) == category.lower()))
    texts = ["unit", "type", "purpose", "category", "season", "target_area", "parameter"]
    shaped = chosen.select(
        text.clean(col("id")).alias("threshold_id"), text.clean(col("location")).alias("fffs_id"), text.id_key(col("location")).alias("key"),
        *[text.clean(col(t)).alias(t) for t in texts], F.coalesce(text.code_family(col("parameter")), text.text_family(col("parameter"))).alias("family"),
        text.unit_key(col("unit")).alias("unit_key"), col("value").try_cast("double").alias("value"), col("z").try_cast("double").alias("z"),
        col("lead").try_cast("double").alias("target_lead_minutes"))
    return shaped.filter("key IS NOT NULL AND value IS NOT NULL")


def aliases(extra: DataFrame | None, spark) -> DataFrame:
    """(unit_key, measure_unit, kind): the built-in equivalents both ways, and a supplied table both ways as aliases."""
    rows = [(a, b, "datum_assumed") for a, b in SAME_DATUM] + [(a, b, "alias") for a, b in BARE_METRE]
    both = rows + [(b, a, k) for a, b, k in rows]
    table = spark.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(a).alias("unit_key"), F.lit(b).alias("measure_unit"), F.lit(k).alias("unit_kind")) for a, b, k in both])))
    if extra is not None:
        keyed = extra.select(text.unit_key(F.col("threshold_unit")).alias("a"), text.unit_key(F.col("measure_unit")).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
        given = keyed.select(F.col("a").alias("unit_key"), F.col("b").alias("measure_unit")).unionByName(
            keyed.select(F.col("b").alias("unit_key"), F.col("a").alias("measure_unit"))).distinct()
        new = given.join(table, ["unit_key", "measure_unit"], "left_anti").withColumn("unit_kind", F.lit("alias"))
        table = table.unionByName(new)
    return table


def conversion(unit: Column, measure_unit: Column, z: Column, zero_is_missing: bool = True) -> Column:
    """What to add to a threshold value to put it in the measure's datum; NULL when none applies."""
    usable = z.isNotNull() & ~F.isnan(z)
    if zero_is_missing:
        usable = usable & (z != 0)
    return F.when(usable & (unit == "maod") & measure_unit.isin(LOCAL), -z).when(usable & unit.isin(LOCAL) & (measure_unit == "maod"), z)


def link(thresholds: DataFrame, mapping: DataFrame, alias_table: DataFrame, zero_is_missing: bool = True) -> DataFrame:
    """Each threshold with its measure, status and how the units agree.

    One join on (gauge key, family); each candidate gets its kind of agreement, and the best kind, then instantaneous, most
    readings and the URI decide through one ``min_by``.
    """
    m = mapping.select(
        text.id_key(F.col("fffs_id")).alias("key"), F.coalesce(text.clean(F.col("telemetry_family")), F.col("code_family")).alias("family"),
        *[F.col(c) if c in mapping.columns else F.lit(None).cast("string").alias(c) for c in MEASURE]).filter("key IS NOT NULL")
    measures = m.filter("measure_uri IS NOT NULL").withColumn("measure_unit", text.unit_key(F.col("unit_name")))
    thresholds = stored_table(thresholds, "thresholds")        # read twice below; keys and families are worked out once
    t = thresholds.select("threshold_id", "key", "family", "unit_key", "z", "value")
    pairs = t.join(measures, ["key", "family"]).join(alias_table, ["unit_key", "measure_unit"], "left")
    shift = conversion(F.col("unit_key"), F.col("measure_unit"), F.col("z"), zero_is_missing)
    kind = (F.when(F.col("unit_key") == F.col("measure_unit"), 0).when(F.col("unit_kind") == "datum_assumed", 1)
            .when(F.col("unit_kind") == "alias", 2).when(shift.isNotNull(), 3))
    ranked = pairs.withColumn("_kind", kind).withColumn("_shift", shift)
    instant = F.when(lowered("register_value_type") == "instantaneous", 0).otherwise(1)
    order = F.struct("_kind", instant, -F.coalesce(F.col("n_readings").cast("double"), F.lit(0.0)), "measure_uri")
    agree = F.col("_kind").isNotNull()
    per_kind = ranked.filter(agree).groupBy("threshold_id", "_kind").agg(
        F.count(F.lit(1)).alias("_n"), F.min_by(F.struct(*MEASURE, "_shift"), order).alias("_m"))
    best = per_kind.groupBy("threshold_id").agg(F.min_by(F.struct("_kind", "_n", "_m"), "_kind").alias("_b"))
    units = ranked.groupBy("threshold_id").agg(F.array_join(F.array_sort(F.collect_set(F.coalesce(
        text.clean(F.col("unit_name")), F.lit("(no unit)")))), ", ").alias("_have"))
    gauges = m.select("key").distinct().withColumn("_gauge", F.lit(True))
    joined = thresholds.join(gauges, "key", "left").join(units, "threshold_id", "left").join(best, "threshold_id", "left")
    n = F.col("_b._n")
    status = (F.when(F.col("family").isNull(), "no_family").when(F.col("_gauge").isNull(), "no_gauge").when(F.col("_have").isNull(), "no_measure")
              .when(F.col("_b").isNull(), "unit_mismatch").when(n == 1, "linked").otherwise("linked_chosen"))
    moved = F.col("_b._kind") == 3
    in_unit = F.when(moved, F.round(F.col("value") + F.col("_b._m._shift"), 4)).otherwise(F.col("value"))
    unit_match = F.when(F.col("_b").isNotNull(), F.element_at(F.array(*[F.lit(k) for k in KINDS]), (F.col("_b._kind") + 1).cast("int")))
    datum = F.col("unit_key").isin("maod", *LOCAL)
    why = F.when(datum & F.col("z").isNull(), "; no z to convert with").when(
        datum & F.lit(zero_is_missing) & (F.col("z") == 0), "; z is 0, taken as not set").otherwise("")
    chose = F.when(n > 1, F.concat(n.cast("string"), F.lit(" measures agree on unit; chose the instantaneous one with the most readings"))).otherwise("")
    taken = F.concat(F.lit("measure unit "), F.col("_b._m.unit_name"), F.lit(" taken as the threshold's "), F.col("unit"))
    note = (F.when(status == "no_family", F.concat(F.lit("Parameter "), F.col("parameter"), F.lit(" names no family")))
            .when(status == "no_gauge", NOTES["gauge_unknown"])
            .when(status == "no_measure", F.concat(F.lit(NOTES["gauge_lacks"]), F.col("family")))
            .when(status == "unit_mismatch", F.concat(F.lit("threshold unit "), F.col("unit"), F.lit("; the gauge's "), F.col("family"),
                                                      F.lit(" measures are in "), F.col("_have"), why))
            .otherwise(joined_notes(chose, F.when(moved, "converted with z").when(F.col("_b._kind") > 0, taken).otherwise(""))))
    return joined.select(
        *thresholds.columns, status.alias("link_status"), note.alias("link_note"), F.coalesce(n, F.lit(0)).alias("n_candidates"),
        unit_match.alias("unit_match"), in_unit.alias("value_in_measure_unit"), F.when(moved, F.col("z")).alias("z_used"),
        *[F.col(f"_b._m.{c}").alias(c) for c in MEASURE])


def link_summary(linked: DataFrame) -> DataFrame:
    """Rows by status and, for mismatches, by threshold unit and the units the gauge has."""
    mismatch = F.col("link_status") == "unit_mismatch"
    return linked.groupBy("link_status", F.when(mismatch, F.col("unit")).alias("unit"), F.when(mismatch, F.col("link_note")).alias("detail")).agg(
        F.count(F.lit(1)).alias("rows"))
