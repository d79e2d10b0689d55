"""Assumptions behind indicative expected annual damage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from freshet.operators.upsert import only_new

SCENARIOS = ["low", "central", "high"]
# Annual chance range of each band, and the one central value that is not the geometric mean.
BAND_RANGES = {"high": (0.033, 0.10), "medium": (0.01, 0.033), "low": (0.001, 0.01), "very_low": (0.0001, 0.001)}
CENTRAL_SET = {"high": 0.04}


def band_probabilities(spark: SparkSession) -> DataFrame:
    """(item, scenario, value): range ends, and the geometric mean (or the set value) between them."""
    rows = [F.struct(F.lit(b).alias("band"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"),
                     F.lit(CENTRAL_SET.get(b)).cast("double").alias("set_value")) for b, (lo, hi) in BAND_RANGES.items()]
    bands = spark.range(1).select(F.inline(F.array(*rows)))
    per = F.create_map(F.lit("low"), F.col("lo"), F.lit("central"), F.coalesce("set_value", F.sqrt(F.col("lo") * F.col("hi"))),
                       F.lit("high"), F.col("hi"))
    return bands.select(F.concat(F.lit("prob_"), "band").alias("item"), F.explode(per).alias("scenario", "value"))


def default_rows(spark: SparkSession) -> DataFrame:
    """Seed rows: probabilities, price uplift 1.0, and the damage per household left empty."""
    seed = lambda item, value: spark.range(1).select(
        F.lit(item).alias("item"), F.explode(F.array(*[F.lit(s) for s in SCENARIOS])).alias("scenario"), F.lit(value).cast("double").alias("value"))
    return reduce(DataFrame.unionByName, [band_probabilities(spark), seed("price_uplift", 1.0), seed("damage_per_household", None)])


def missing_rows(existing: DataFrame, defaults: DataFrame) -> DataFrame:
    """Defaults whose (item, scenario) is absent: a value someone set is never overwritten."""
    return only_new(existing, defaults, ["item", "scenario"])


def check_assumptions(table: DataFrame) -> DataFrame:
    """Problems as sentences, one row each (none when the table is fine)."""
    wide = table.groupBy("item").pivot("scenario", SCENARIOS).agg(F.first("value"))
    low, central, high = (F.col(s) for s in SCENARIOS)
    values = F.array(low, central, high)
    prob, damage = F.col("item").startswith("prob_"), F.col("item") == "damage_per_household"
    full = low.isNotNull() & central.isNotNull() & high.isNotNull()
    text = lambda s: F.concat("item", F.lit(s))
    rules = [
        F.when(prob & ~full, text(" is missing a scenario.")),
        F.when(prob & full & F.exists(values, lambda v: (v <= 0) | (v > 1)), text(" must be between 0 and 1.")),
        F.when(damage & full & F.exists(values, lambda v: v < 0), F.lit("damage_per_household must not be negative.")),
        F.when((prob | damage) & full & ~((low <= central) & (central <= high)), text(" should run low, central, high in order."))]
    uplift = [F.when((F.col("item") == "price_uplift") & (F.col(s) <= 0), f"price_uplift ({s}) must be above 0.") for s in SCENARIOS]
    per_item = wide.select(F.explode(F.filter(F.array(*rules, *uplift), lambda p: p.isNotNull())).alias("problem"))
    order = ["high", "medium", "low", "very_low"]
    by_band = table.filter(F.col("item").startswith("prob_")).groupBy("scenario").pivot("item", [f"prob_{b}" for b in order]).agg(F.first("value"))
    falls = reduce(lambda a, b: a & b, [F.col(f"prob_{x}") >= F.col(f"prob_{y}") for x, y in zip(order, order[1:])])
    crossed = by_band.filter(~falls).select(F.concat(
        F.lit("In the "), "scenario", F.lit(" scenario a rarer band has a higher probability than a more frequent one.")).alias("problem"))
    return per_item.unionByName(crossed)
