"""Forecast products: contacts, changes between statements, situation, monthly exposure, watch lists."""

from __future__ import annotations

from pyspark.sql.types import ArrayType
from pyspark.sql import Column, DataFrame, functions as F

from freshet.functions import risk, text
from freshet.operators.guards import guard_no_fan_out, guard_unique
from freshet.operators.pick import first_per_key
from freshet.operators.scan import with_prior
from freshet.operators.spatial import overlaps
from freshet.operators.upsert import complete

CELL = ["statement_id", "constituency_id", "forecast_date", "source"]


def latest_complete(statements: DataFrame, log: DataFrame, n: int = 1) -> DataFrame:
    """The newest ``n`` statements whose results are logged at their current version."""
    done = complete(statements, log, "statement_id", "last_modified_at")
    return done.orderBy(F.desc("issued_at"), F.desc("statement_id")).limit(n)


def last_of_each_day(statements: DataFrame) -> DataFrame:
    """The final statement of every issue date."""
    dated = statements.withColumn("issue_date", F.to_date("issued_at"))
    return first_per_key(dated, ["issue_date"], [F.col("issued_at"), F.col("statement_id")], highest=True)


def counted(links: DataFrame, min_share: float) -> DataFrame:
    """Links that count: a line (no share) or a share of at least ``min_share``."""
    return links.filter(F.col("share").isNull() | (F.col("share") >= min_share))


def one_member_per_name(members: DataFrame, name: str = "constituency_name") -> DataFrame:
    """One member per place-name key: the lowest id."""
    return first_per_key(members.withColumn("name_key", text.name_key(F.col(name))), ["name_key"], [F.col("member_id")])


def with_members(rows: DataFrame, members: DataFrame, name: str) -> DataFrame:
    """Rows with their member; ``mp_matched`` says whether one was found.  The member side is one row per key."""
    one = one_member_per_name(members).select("name_key", "member_id", F.col("name").alias("mp_name"), "email")
    keyed = rows.withColumn("name_key", text.name_key(F.col(name)))
    return keyed.join(one, "name_key", "left").withColumn("mp_matched", F.col("member_id").isNotNull()).drop("name_key")


def warning_contacts(warnings: DataFrame, lookup: DataFrame, members: DataFrame, min_share: float = 0.01) -> DataFrame:
    """Current warnings x the constituencies their area lies in x the member."""
    in_areas = warnings.join(lookup.filter(F.col("share") >= min_share), "area_code")
    return with_members(in_areas, members, "constituency_name").withColumn("is_in_force", F.col("severity_level").isin(1, 2, 3))


def without_constituency(warnings: DataFrame, contacts: DataFrame) -> DataFrame:
    return warnings.join(contacts.select("area_code").distinct(), "area_code", "left_anti")


def forecast_contacts(links: DataFrame, members: DataFrame, min_share: float = 0.01) -> DataFrame:
    rows = counted(links, min_share).withColumn("risk_rank", risk.risk_rank(F.col("risk_level")))
    return with_members(rows, members, "constituency_name")


# ---- changes -------------------------------------------------------------------------------------------------

def worst_by_cell(links: DataFrame, min_share: float = 0.01) -> DataFrame:
    return counted(links, min_share).groupBy(*CELL).agg(F.max("rank").alias("rank"))


def day_one(links: DataFrame, statements: DataFrame) -> DataFrame:
    """The date of day 1 of each statement, from its own rows; a quiet one falls back to its issue date."""
    known = (links.filter(F.col("forecast_date").isNotNull() & F.col("day_index").isNotNull()).groupBy("statement_id")
             .agg(F.min(F.date_sub("forecast_date", (F.col("day_index") - 1).cast("int"))).alias("_d1")))
    return statements.join(known, "statement_id", "left").select(
        "statement_id", "issued_at", F.coalesce("_d1", F.to_date("issued_at")).alias("day1"))


def statement_pairs(statements: DataFrame) -> DataFrame:
    """Each statement with the one before it; the scan is cut by month, so the history never sits in one task."""
    ordered = statements.select("statement_id", "issued_at")
    before = with_prior(ordered, [], ["issued_at", "statement_id"], None, last={
        "_before": F.struct("statement_id", "issued_at")})
    return before.filter("_before IS NOT NULL").select(
        "statement_id", "issued_at", F.col("_before.statement_id").alias("previous_statement_id"),
        F.col("_before.issued_at").alias("previous_issued_at"))


def change_type(before: Column, after: Column) -> Column:
    return (F.when(before == after, None).when(before == 0, "new").when(after == 0, "cleared")
            .when(after > before, "escalated").otherwise("de_escalated"))


def changes(links: DataFrame, statements: DataFrame, min_share: float = 0.01) -> DataFrame:
    """Every change between each statement and the one before it, over the days both cover.

    One full outer join for the whole history; the newest pair is a filter on ``statement_id``.
    """
    days = day_one(links, statements)
    d1 = lambda name: days.select(F.col("statement_id").alias(name), F.col("day1").alias(f"{name}_d1"))
    pairs = (statement_pairs(statements).join(d1("statement_id"), "statement_id")
             .join(d1("previous_statement_id"), "previous_statement_id")
             .withColumn("first_day", F.greatest("statement_id_d1", "previous_statement_id_d1"))
             .withColumn("last_day", F.date_add(F.least("statement_id_d1", "previous_statement_id_d1"), 4)))
    cells = worst_by_cell(links, min_share)
    shared = F.col("forecast_date").between(F.col("first_day"), F.col("last_day"))
    pair = ["statement_id", "previous_statement_id", "statement_id_d1"]
    cell = ["constituency_id", "forecast_date", "source"]
    new = cells.join(pairs, "statement_id").filter(shared).select(*pair, *cell, F.col("rank").alias("new_rank"))
    old = (cells.withColumnRenamed("statement_id", "previous_statement_id").join(pairs, "previous_statement_id").filter(shared)
           .select(*pair, *cell, F.col("rank").alias("previous_rank")))
    joined = new.join(old, [*pair, *cell], "full")
    before, after = F.coalesce("previous_rank", F.lit(0)), F.coalesce("new_rank", F.lit(0))
    return joined.select(
        "statement_id", "previous_statement_id", *cell, (F.date_diff("forecast_date", "statement_id_d1") + 1).alias("day_index"),
        before.alias("previous_rank"), after.alias("new_rank"), (after - before).alias("rank_change"),
        change_type(before, after).alias("change_type")).filter("change_type IS NOT NULL")


def compare(new: DataFrame, old: DataFrame, on: list[str], rank: str = "rank") -> DataFrame:
    """Two snapshots of worst ranks: previous and new rank per cell, a missing cell is rank 0."""
    a = new.select(*on, F.col(rank).alias("new_rank"))
    b = old.select(*on, F.col(rank).alias("previous_rank"))
    before, after = F.coalesce("previous_rank", F.lit(0)), F.coalesce("new_rank", F.lit(0))
    return a.join(b, on, "full").select(*on, before.alias("previous_rank"), after.alias("new_rank"),
                                        (after - before).alias("rank_change"), change_type(before, after).alias("change_type"))


def headline_counts(links: DataFrame, min_share: float = 0.01) -> DataFrame:
    """Constituencies each statement flags over all of its own days."""
    worst = counted(links, min_share).groupBy("statement_id", "constituency_id").agg(F.max("rank").alias("rank"))
    return worst.groupBy("statement_id").agg(F.count_if(F.col("rank") >= 1).alias("flagged"), F.count_if(F.col("rank") >= 3).alias("medium_plus"))


def changes_log(found: DataFrame, links: DataFrame, statements: DataFrame, min_share: float = 0.01) -> DataFrame:
    """One row per compared statement: how many changes (0 included), the days compared, the headline counts of both."""
    days = day_one(links, statements)
    d1 = lambda name: days.select(F.col("statement_id").alias(name), F.col("day1").alias(f"{name}_d1"))
    pairs = (statement_pairs(statements).join(d1("statement_id"), "statement_id").join(d1("previous_statement_id"), "previous_statement_id")
             .withColumn("days_from", F.greatest("statement_id_d1", "previous_statement_id_d1"))
             .withColumn("days_to", F.date_add(F.least("statement_id_d1", "previous_statement_id_d1"), 4)))
    head = headline_counts(links, min_share)
    named = lambda key, tag: head.select(
        F.col("statement_id").alias(key), F.col("flagged").alias(f"flagged_{tag}"), F.col("medium_plus").alias(f"medium_plus_{tag}"))
    counts = found.groupBy("statement_id").agg(F.count(F.lit(1)).alias("_n"))
    joined = (pairs.join(counts, "statement_id", "left").join(named("statement_id", "new"), "statement_id", "left")
              .join(named("previous_statement_id", "previous"), "previous_statement_id", "left"))
    shares_days = F.col("days_from") <= F.col("days_to")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return joined.select(
        "statement_id", "previous_statement_id", F.when(shares_days, F.col("days_from")).alias("days_from"),
        F.when(shares_days, F.col("days_to")).alias("days_to"), F.coalesce("_n", F.lit(0)).alias("n_changes"),
        F.when(shares_days, "compared").otherwise("no_shared_days").alias("status"), zero("flagged_previous"), zero("flagged_new"),
        zero("medium_plus_previous"), zero("medium_plus_new"))


# ---- situation -----------------------------------------------------------------------------------------------

def situation_pivot(contacts: DataFrame, keys: list[str]) -> DataFrame:
    """Worst rank, its first date and sources, and the rank of each day, in two aggregates."""
    cells = contacts.filter("risk_rank > 0").groupBy(*keys, "forecast_date", "day_index", "source").agg(F.max("risk_rank").alias("rk"))
    # best (rank, date, source) facts per rank first: a rank level per key is at most four rows
    by_rank = cells.groupBy(*keys, "rk").agg(
        F.min("forecast_date").alias("_date"), F.collect_set("source").alias("_sources"),
        *[F.max(F.when(F.col("day_index") == n, F.col("rk"))).alias(f"_d{n}") for n in range(1, 6)])
    top = F.max_by(F.struct("_date", "_sources"), "rk")
    return by_rank.groupBy(*keys).agg(
        F.max("rk").alias("worst_rank"), top.alias("_top"), *[F.max(f"_d{n}").alias(f"rank_day{n}") for n in range(1, 6)]).select(
        *keys, "worst_rank", F.col("_top._date").alias("worst_date"),
        F.concat_ws(", ", F.sort_array("_top._sources")).alias("worst_sources"), *[f"rank_day{n}" for n in range(1, 6)])


def warning_counts(contacts: DataFrame) -> DataFrame:
    """Areas in force per constituency by severity, each area once."""
    per = lambda level: F.count_distinct(F.when(F.col("severity_level") == level, F.col("area_code")))
    return contacts.filter("is_in_force").groupBy("constituency_id").agg(
        per(1).alias("severe_warnings"), per(2).alias("warnings"), per(3).alias("alerts"))


def situation(constituencies: DataFrame, members: DataFrame, contacts: DataFrame, warnings: DataFrame, change_rows: DataFrame,
              check: bool = True) -> DataFrame:
    """One row per constituency with its member, forecast, changes and warnings; quiet ones have zeros."""
    pivot = situation_pivot(contacts, ["constituency_id"])
    moved = change_rows.groupBy("constituency_id").agg(
        F.count(F.lit(1)).alias("_changes"), F.max(F.col("change_type").isin("escalated", "new")).alias("_escalated"))
    joined = (with_members(constituencies, members, "name").join(pivot, "constituency_id", "left")
              .join(warning_counts(warnings), "constituency_id", "left").join(moved, "constituency_id", "left"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    counts = [zero(c).alias(c) for c in ("severe_warnings", "warnings", "alerts")]
    result = joined.select(
        "constituency_id", F.col("name").alias("constituency_name"), "mp_matched", F.col("member_id").alias("mp_member_id"), "mp_name",
        F.col("email").alias("mp_email"), zero("worst_rank").alias("worst_rank"),
        F.coalesce(risk.risk_level(F.col("worst_rank")), F.lit("None")).alias("worst_level"), "worst_date", "worst_sources",
        *[zero(f"rank_day{n}").alias(f"rank_day{n}") for n in range(1, 6)], (zero("_changes") > 0).alias("changed"),
        F.coalesce("_escalated", F.lit(False)).alias("escalated"), *counts,
        (zero("severe_warnings") + zero("warnings") + zero("alerts") > 0).alias("has_active_warning"))
    if check:
        guard_unique(constituencies, ["constituency_id"])
        guard_no_fan_out(result, constituencies)
    return result


MOST_CONSTITUENCIES = 10_000


def past_situations(links: DataFrame, statements: DataFrame, constituencies: DataFrame, members: DataFrame,
                    change_rows: DataFrame | None = None, compared: DataFrame | None = None, min_share: float = 0.01) -> DataFrame:
    """The forecast half of the situation for EVERY past statement in one job; warning counts are not known (NULL).

    Every statement has a row for every constituency, rank 0 where nothing was forecast.  The list of constituencies is a reference
    list (some hundreds, guarded at ``MOST_CONSTITUENCIES``) and travels as one array, so rows are statements x constituencies and
    no join makes them.  ``escalated`` is NULL where a statement was never compared.
    """
    key = ["statement_id", "constituency_id"]
    pivot = situation_pivot(counted(links, min_share).withColumnRenamed("rank", "risk_rank"), key)
    places = sorted(r[0] for r in constituencies.select("constituency_id").distinct().limit(MOST_CONSTITUENCIES + 1).collect())
    if len(places) > MOST_CONSTITUENCIES:
        raise ValueError(f"more than {MOST_CONSTITUENCIES} constituencies")
    kind = constituencies.schema["constituency_id"].dataType
    every = statements.select("statement_id").distinct().withColumn("constituency_id", F.explode(F.lit(places).cast(ArrayType(kind))))
    pivot = every.join(pivot, key, "left")
    escalated = F.lit(None).cast("boolean")
    if change_rows is not None and compared is not None:
        rose = change_rows.filter(F.col("change_type").isin("escalated", "new")).select(*key, F.lit(True).alias("_rose")).distinct()
        known = compared.select("statement_id", F.lit(True).alias("_compared")).distinct()
        pivot = pivot.join(rose, key, "left").join(known, "statement_id", "left")
        escalated = F.when(F.col("_compared"), F.coalesce("_rose", F.lit(False)))
    joined = (pivot.join(with_members(constituencies, members, "name"), "constituency_id")
              .join(statements.select("statement_id", "issued_at"), "statement_id"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    unknown = [F.lit(None).cast("long").alias(c) for c in ("severe_warnings", "warnings", "alerts")]
    return joined.select(
        *key, "issued_at", F.col("name").alias("constituency_name"), "mp_matched", "mp_name", zero("worst_rank"), "worst_date",
        "worst_sources", *[zero(f"rank_day{n}") for n in range(1, 6)], escalated.alias("escalated"), *unknown,
        F.lit(None).cast("boolean").alias("has_active_warning"))


# ---- monthly exposure ----------------------------------------------------------------------------------------

def monthly_exposure(links: DataFrame, statements: DataFrame, min_share: float = 0.01) -> DataFrame:
    """Days at each rank per constituency, month and source, with ``any`` as the worst of the sources.

    Day 1 of the final statement of each date counts.  ``any`` comes from GROUPING SETS over one pass of the day cells.
    """
    final = last_of_each_day(statements).select("statement_id", "issue_date")
    first = (counted(links, min_share).filter((F.col("day_index") == 1) & F.col("forecast_date").isNotNull())
             .join(final, "statement_id").groupBy("statement_id", "issue_date", "constituency_id", "forecast_date", "source")
             .agg(F.max("rank").alias("rk")))
    month = F.date_format("_day", "yyyy-MM")
    covered = (final.join(first.groupBy("statement_id").agg(F.min("forecast_date").alias("_d1")), "statement_id", "left")
               .withColumn("_day", F.coalesce("_d1", "issue_date")))
    cover = covered.groupBy(month.alias("month")).agg(F.count_distinct("_day").alias("days_covered"))
    cells = first.groupingSets([["constituency_id", "forecast_date", "source"], ["constituency_id", "forecast_date"]],
                               "constituency_id", "forecast_date", "source").agg(F.max("rk").alias("rk"), F.grouping("source").alias("_any"))
    dated = cells.withColumn("source", F.when(F.col("_any") == 1, "any").otherwise(F.col("source"))).withColumn(
        "month", F.date_format("forecast_date", "yyyy-MM")).filter("rk >= 1")
    days = lambda c: F.count_if(c)
    rk = F.col("rk")
    result = dated.groupBy("constituency_id", "month", "source").agg(
        days(rk == 1).alias("days_very_low"), days(rk == 2).alias("days_low"), days(rk == 3).alias("days_medium"),
        days(rk == 4).alias("days_high"), days(rk >= 3).alias("days_medium_or_above"), days(rk >= 1).alias("days_flagged"),
        F.max(rk).alias("worst_rank"))
    return result.join(cover, "month").withColumn("worst_level", risk.risk_level(F.col("worst_rank")))


# ---- reports -------------------------------------------------------------------------------------------------

def watch_list(situations: DataFrame) -> DataFrame:
    return situations.filter((F.col("worst_rank") >= 2) | F.col("has_active_warning")).orderBy(
        F.desc("worst_rank"), F.desc("severe_warnings"), F.desc("warnings"), "constituency_name")


def headline(situations: DataFrame) -> DataFrame:
    return situations.agg(F.count_if(F.col("worst_rank") >= 3).alias("at_risk_medium_or_above"), F.count_if("escalated").alias("escalated"),
                          F.count_if("has_active_warning").alias("with_warning_or_alert"))


def latest_escalations(change_rows: DataFrame) -> DataFrame:
    newest = change_rows.agg(F.max("statement_id").alias("statement_id"))
    return (change_rows.filter(F.col("change_type").isin("escalated", "new")).join(newest, "statement_id", "left_semi")
            .orderBy(F.desc("new_rank"), "constituency_id"))


def most_exposed(exposure: DataFrame, since_month: Column, n: int = 20) -> DataFrame:
    recent = exposure.filter((F.col("source") == "any") & (F.col("month") >= since_month))
    return (recent.groupBy("constituency_id").agg(F.sum("days_medium_or_above").alias("days_medium_or_above"))
            .orderBy(F.desc("days_medium_or_above"), "constituency_id").limit(n))


# ---- statement intersections ---------------------------------------------------------------------------------

def parent_links(rows: DataFrame, areas: DataFrame) -> DataFrame:
    """Warning areas whose parent alert area is under a forecast shape, unless already under it.

    ``rows`` carry statement_id, poly_id, source, area_code, area_kind; added rows have no share and link_type parent_alert.
    """
    codes = F.create_map(*[x for s, c in risk.SOURCE_CODES.items() for x in (F.lit(s), F.array(*[F.lit(v) for v in c]).cast("array<string>"))])
    parent = F.trim(F.coalesce("parent", F.lit("")))
    children = areas.filter((F.col("area_kind") == "flood_warning") & (parent != "")).select(
        parent.alias("area_code"), F.col("area_code").alias("_child"), "type_code")
    key = ["statement_id", "poly_id", "source", "area_code"]
    raised = rows.filter(F.col("area_kind") == "flood_alert").drop("area_kind", "share").join(children, "area_code")
    fits = raised.filter(F.array_contains(F.element_at(codes, F.col("source")), F.col("type_code")))
    added = (fits.withColumn("area_code", F.col("_child")).drop("_child", "type_code").join(rows.select(*key), key, "left_anti")
             .dropDuplicates(key).withColumn("area_kind", F.lit("flood_warning")).withColumn("share", F.lit(None).cast("double"))
             .withColumn("link_type", F.lit("parent_alert")))
    return rows.withColumn("link_type", F.lit("overlap")).unionByName(added.select(*rows.columns, "link_type"))


def unknown_parents(areas: DataFrame) -> DataFrame:
    """Warning areas whose parent is no known area."""
    parent = F.trim(F.coalesce("parent", F.lit("")))
    named = areas.filter((F.col("area_kind") == "flood_warning") & (parent != "")).select("area_code", parent.alias("parent"))
    return named.join(areas.select(F.col("area_code").alias("parent")).distinct(), "parent", "left_anti")


def concern_with_risk(polygons: DataFrame, blocks: DataFrame) -> DataFrame:
    """Area-of-concern polygons with the day, source and risk of their block; unlinked ones have NULL risk."""
    fields = [c for c in blocks.columns if c not in polygons.columns or c in ("statement_id", "risk_area_block_id")]
    return polygons.join(blocks.select(*fields), ["statement_id", "risk_area_block_id"], "left")


def shape_area_links(shapes: DataFrame, areas: DataFrame, cell: float, min_share: float | None, by_source: bool) -> DataFrame:
    """Forecast polygons x areas with the share covered.

    With ``by_source`` an area meets only shapes of the sources its type code belongs to; ``min_share`` NULL keeps any overlap.
    """
    shape_key = ["statement_id", "poly_id", "source"]
    if not by_source:
        found = overlaps(areas, shapes, ["area_code"], shape_key, cell)
    else:
        pairs = [F.struct(F.lit(s).alias("area_source"), F.lit(c).alias("type_code")) for s, codes in risk.SOURCE_CODES.items() for c in codes]
        allowed = shapes.sparkSession.range(1).select(F.inline(F.array(*pairs)))
        found = overlaps(areas.join(allowed, "type_code"), shapes, ["area_code"], shape_key, cell,
                         same=[("area_source", "source")]).drop("area_source")
    return found if min_share is None else found.filter(F.col("share") >= min_share)
