"""Health checks over the products: one aggregate per check, the worst of them overall."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from freshet.functions.clock import micros
from freshet.operators.pick import union_all
from freshet.session import stored_table

SEVERITY = {"ok": 0, "info": 1, "warn": 2, "fail": 3}


@dataclass
class Check:
    """``frame`` has one row with ``status`` and ``value``; ``detail`` explains the limits, unless the row has its own."""

    name: str
    frame: DataFrame
    detail: str


def _age_text(age: Column, unit: str) -> Column:
    """An age with its unit; empty where there is none (format_string would print a NULL as a word)."""
    return F.when(age.isNull(), "").otherwise(F.format_string(f"%.1f {unit}", age))


def age_check(name: str, df: DataFrame, time: str, now: Column, warn: float, fail: float | None, hours: float = 1.0,
              empty: str = "fail") -> Check:
    """Age of the newest row in units of ``hours``; without ``fail`` the check warns at most."""
    age = (micros(now) - micros(F.max(time))) / (3.6e9 * hours)
    worst = F.when(age > (fail if fail is not None else float("inf")), "fail").when(age > warn, "warn").otherwise("ok")
    unit = "days" if hours == 24.0 else "h"
    row = df.agg(F.when(F.max(time).isNull(), empty).otherwise(worst).alias("status"),
                 _age_text(age, unit).alias("value"))
    return Check(name, row, f"warn over {warn:g}" + (f", fail over {fail:g}" if fail is not None else " (never fails)"))


def count_check(name: str, df: DataFrame, n: Column, rules: list[tuple[Column, str]], detail: str, otherwise: str = "ok") -> Check:
    """A count and the status of the first rule it meets; rules read the column ``n``."""
    status = F.lit(otherwise)
    for condition, value in reversed(rules):
        status = F.when(condition, value).otherwise(status)
    counted = df.agg(n.cast("long").alias("n"))
    return Check(name, counted.select(status.alias("status"), F.col("n").cast("string").alias("value")), detail)


def quiet_age_check(name: str, df: DataFrame, time: str, now: Column, detail: str) -> Check:
    """The age of the newest row in hours, for information only: a quiet side feed never raises the overall status."""
    age = (micros(now) - micros(F.max(time))) / 3.6e9
    return Check(name, df.agg(F.lit("info").alias("status"), _age_text(age, "h").alias("value")), detail)


def range_check(name: str, df: DataFrame, total: Column, low: float, high: float) -> Check:
    """A total that has to lie within limits; outside it warns, and so it does where there is no total."""
    summed = df.agg(total.cast("double").alias("n"))
    return Check(name, summed.select(F.when(F.col("n").between(low, high), "ok").otherwise("warn").alias("status"),
                                     F.coalesce(F.format_number("n", 0), F.lit("")).alias("value")), f"expected {low:,.0f} to {high:,.0f}")


def products_check(name: str, built: DataFrame, expected: list[str], rows: DataFrame, areas: DataFrame, now: Column, warn_days: float,
                   least_share: float = 0.9) -> Check:
    """Whether the ``expected`` products exist, are fresh and cover the areas.

    ``built`` has ``product`` and ``built_at``, the newest of each counts.  No product at all is information, anything else amiss a warning:
    a missing product, the oldest one over the limit, or rows for less than ``least_share`` of the areas.
    """
    known = built.filter(F.col("product").isin(expected)).groupBy("product").agg(F.max("built_at").alias("built_at"))
    state = known.agg(F.collect_set("product").alias("there"), ((micros(now) - micros(F.min("built_at"))) / 8.64e10).alias("age"))   # at most the expected names
    counted = rows.agg(F.count(F.lit(1)).alias("have"), F.lit(1).alias("_one")).join(areas.agg(F.count(F.lit(1)).alias("want"), F.lit(1).alias("_one")), "_one")
    one = state.withColumn("_one", F.lit(1)).join(counted, "_one")
    absent = F.array_except(F.array(*[F.lit(e) for e in expected]), "there")
    days = F.format_string("%.0f", "age")
    problems = F.concat_ws("; ", F.when(F.size(absent) > 0, F.concat(F.lit("missing: "), F.array_join(absent, ", "))),
                           F.when(F.col("age") > warn_days, F.concat(F.lit("oldest is "), days, F.lit(f" days old, warn over {warn_days:g}"))),
                           F.when(F.col("have") < least_share * F.col("want"), F.format_string("%d rows for %d areas", "have", "want")))
    none = F.size("there") == 0
    return Check(name, one.select(
        F.when(none, "info").when(problems != "", "warn").otherwise("ok").alias("status"), F.when(none, "not built").otherwise(F.concat(days, F.lit(" days"))).alias("value"),
        F.when(none, "no product yet").when(problems != "", problems).otherwise(F.format_string("%d rows for %d areas", "have", "want")).alias("detail")), "")


def missing_check(name: str, reason: str, status: str = "fail", spark=None) -> Check:
    """A check whose input does not exist: it is itself a result."""
    row = spark.range(1).select(F.lit(status).alias("status"), F.lit("").alias("value"))
    return Check(name, row, reason)


def report(checks: list[Check]) -> DataFrame:
    """check_name, status, value, detail for every check and the overall row; the checks are written once, since the overall row reads them too."""
    rows = stored_table(union_all([c.frame.select(F.lit(c.name).alias("check_name"), "status", "value", F.col("detail") if "detail" in c.frame.columns else F.lit(c.detail).alias("detail"))
                                   for c in checks]), "checks")
    order = F.element_at(F.create_map(*[F.lit(x) for p in SEVERITY.items() for x in p]), F.col("status"))
    overall = rows.agg(F.max_by("status", order).alias("status"), F.array_join(
        F.array_sort(F.collect_list(F.when(F.col("status") == "fail", F.col("check_name")))), ", ").alias("_failing")).select(
        F.lit("overall").alias("check_name"), "status", F.lit("").alias("value"),
        F.concat(F.lit("worst of the checks above"), F.when(F.col("_failing") != "", F.concat(F.lit("; failing: "), "_failing")).otherwise("")).alias("detail"))
    return rows.unionByName(overall)
