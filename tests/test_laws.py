"""Laws: idempotent upserts and streams, chunk independence, plan shapes, and the registered SQL pairs."""

import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from freshet.operators import intervals, pairs, scan, upsert
from freshet.operators.store import VersionedTable
from freshet.session import scratch_path

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_upserts_twice_is_once(spark):
    old = spark.range(10).withColumn("v", F.lit("old"))
    new = spark.range(5, 15).withColumn("v", F.lit("new"))
    for op in (lambda t: upsert.replace_rows(t, new, new, ["id"]), lambda t: upsert.insert_new(t, new, ["id"]),
               lambda t: upsert.update_matched(t, new, ["id"], ["v"], [])):
        once = op(old)
        assert rows(op(once)) == rows(once)


def test_versioned_table_ignores_a_repeated_batch(spark):
    t = VersionedTable(spark, scratch_path(spark, "versions"))
    t.write(spark.range(3), version=0)
    t.write(spark.range(9), version=0)
    assert t.read().count() == 3
    t.write(t.read().unionByName(spark.range(3, 5)))
    assert t.read().count() == 5 and t.versions() == [0, 1]


def test_chunked_scan_equals_plain_scan(spark):
    rnd = random.Random(7)
    data = [(k, i, rnd.choice([None, 1.0, 2.0, 5.0])) for k in range(3) for i in range(60)]
    df = spark.createDataFrame(data, "k int, i int, v double")
    results = [rows(scan.with_prior(df, ["k"], ["i"], chunk, last={"p": F.col("v")}, total={"s": F.coalesce("v", F.lit(0.0))}))
               for chunk in (F.lit(0), F.floor(F.col("i") / 7), F.col("i"), None)]
    assert results[0] == results[1] == results[2] == results[3]


def test_ranges_of_a_hot_key_come_from_the_data(spark):
    """Half of the rows on one key and most of them in one hour: ranges of about equal count, and the plain result."""
    rnd = random.Random(2)
    data = [(None if k > 40 else k, i * 50 if i % 9 == 0 else 90_000 + i, rnd.choice([None, 1, 2])) for i in range(6000) for k in [0 if i % 2 else 1 + rnd.randint(0, 45)]]
    df = spark.createDataFrame(data, "k int, i int, v int").dropDuplicates(["k", "i"]).withColumn("t", F.timestamp_seconds("i"))
    parts = scan.ranged(df, ["k"], ["t"]).groupBy("_key", "_chunk").count()
    hot = [r["count"] for r in parts.filter("_key.k = 0").collect()]
    assert len(hot) >= 8 and max(hot) < 700 and parts.filter("_key.k IS NULL").count() >= 1
    state = dict(last={"p": F.col("v")}, total={"s": F.coalesce("v", F.lit(0))})
    assert rows(scan.with_prior(df, ["k"], ["t"], **state)) == rows(scan.with_prior(df, ["k"], ["t"], F.lit(0), **state))
    assert rows(scan.with_prior(df.filter("k = 3"), [], ["i"], **state)) == rows(scan.with_prior(df.filter("k = 3"), [], ["i"], F.lit(0), **state))


def test_average_rank_percentile(spark):
    import pandas as pd

    values = [random.Random(i).randint(0, 9) for i in range(80)]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id int, v double")
    want = pd.Series(values).rank(pct=True)
    got = scan.percent_rank_average(df, [], "v", "p").collect()
    assert all(r.p == pytest.approx(want[r.id]) for r in got)


def test_no_cartesian_or_nested_loop_on_spatial_and_interval_joins(spark):
    import __spark_entry__ as entry

    queries = entry.queries()
    for name in ("j12_points_in_areas", "j23_latest_issue_in_force", "j24_next_issue_within_tolerance", "j28_area_pairs_sharing_points", "u01_archive_and_live_series"):
        plan = queries[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_filters_and_columns_reach_the_scan(spark):
    import __spark_entry__ as entry

    plan = entry.queries()["k09_retention_trim"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "props" not in plan


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 200


@pytest.mark.parametrize("name", ["p06_statement_changes", "w06_episodes", "a20_gross_unique_split_per_area", "p05_warning_change_detection", "t06_newest_per_key_view"])
def test_sql_pair(spark, name):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as entry
    from tools.check import TABLES, rows_of

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    cur = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    want = rows_of(names, cur.fetchall())
    df = entry.queries()[name](spark, FOLDER)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def _sweep_tables(spark):
    """One key with most rows and many of them at one instant, long and empty intervals, NULL keys and times, repeated rows."""
    rnd = random.Random(9)
    at = lambda m: None if m is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=m)
    key = lambda: rnd.choice([1, 1, 1, 2, 3, None])
    points = [(key(), at(rnd.choice([500, 500, rnd.randint(0, 2000), None])), i % 40) for i in range(400)]
    spans = [(i, key(), at(s), at(s + rnd.choice([-5, 0, 10, 60, 1500]))) for i in range(60) for s in [rnd.choice([500, rnd.randint(0, 2000)])]] + [(99, 1, None, at(5))]
    return (points, spans, spark.createDataFrame(points, "k int, t timestamp_ntz, p int").withColumn("t", F.col("t").cast("timestamp")),
            spark.createDataFrame(spans, "i int, k int, s timestamp_ntz, e timestamp_ntz").withColumns({c: F.col(c).cast("timestamp") for c in "se"}))


def test_sweeps_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(intervals, "BLOCK", 5)
    monkeypatch.setattr(intervals, "BLOCKS", 3)
    points, spans, instants, held = _sweep_tables(spark)
    known = lambda *v: all(x is not None for x in v)
    inside = [(p, s) for p in points for s in spans if known(p[0], p[1], s[2]) and p[0] == s[1] and s[2] <= p[1] <= s[3]]
    got = intervals.instants_in_intervals(instants, held, ["k"], "t", "s", "e")
    assert got.columns == ["k", "t", "p", "i", "s", "e"]
    assert sorted((r["k"], r["t"], r["p"], r["i"]) for r in got.collect()) == sorted((*p, s[0]) for p, s in inside)
    left = intervals.instants_in_intervals(instants, held, ["k"], "t", "s", "e", "left").collect()
    met = {p for p, _ in inside}
    assert len(left) == len(inside) + sum(p not in met for p in points) and sum(r["i"] is None for r in left) == sum(p not in met for p in points)
    ids = intervals.intervals_with_instants(held, instants, ["k"], "t", "s", "e", "i")
    assert sorted(r["i"] for r in ids.collect()) == sorted({s[0] for _, s in inside})
    hours = datetime.timedelta(hours=2)
    after = [(s[0], p[2]) for s in spans for p in points if known(p[0], p[1], s[2]) and p[0] == s[1] and s[2] < p[1] <= s[2] + hours]
    found = intervals.next_within(held.select("i", "k", "s"), instants, ["k"], "s", "t", 2)
    assert found.columns == ["i", "k", "s", "t", "p"] and sorted((r["i"], r["p"]) for r in found.collect()) == sorted(after)
    last = {s: max((p[1] for p in points if known(p[0], p[1], s[2]) and p[0] == s[1] and s[2] - hours <= p[1] <= s[2]), default=None) for s in spans}
    prior = intervals.last_before(held, instants, ["k"], "s", "t", 2, "before")
    assert sorted((r["i"], str(r["before"])) for r in prior.collect()) == sorted((s[0], str(b)) for s, b in last.items())


def test_a_busy_day_is_cut_into_ranges(spark):
    """10,000 instants of one key on one day: the ranges that the sweep works on hold a small part each, and no pair is lost."""
    instants = spark.range(10_000).select(F.lit(1).alias("k"), F.timestamp_micros(F.col("id") * 8_000_000).alias("t"))
    held = spark.createDataFrame([(1, 1, 0, 86_400), (2, 1, 100, 200), (3, 1, 40_000, 40_000), (4, 2, 0, 86_400)], "i int, k int, s long, e long")
    held = held.withColumns({c: F.timestamp_seconds(c) for c in "se"})
    counts = {r["i"]: r["count"] for r in intervals.instants_in_intervals(instants, held, ["k"], "t", "s", "e").groupBy("i").count().collect()}
    assert counts == {1: 10_000, 2: 13, 3: 1}
    ranges = scan.ranged(instants, ["k"], ["t"]).groupBy("_chunk").count().collect()
    assert len(ranges) > 20 and max(r["count"] for r in ranges) < 600


def test_pairs_of_sets_are_unfolded_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(pairs, "BLOCK", 4)
    sets = [(1, list(range(n))) for n in (0, 1, 2, 4, 5, 9, 30)] + [(2, list(range(13))), (2, list(range(13)))]
    got = pairs.pairs_within(spark.createDataFrame(sets, "v int, m array<int>"), "m", "a", "b")
    assert sorted(tuple(r) for r in got.collect()) == sorted((v, *p) for v, m in sets for p in itertools.combinations(m, 2))


def test_one_large_set_is_copied_once_a_block(spark):
    """3,000 members: 24 rows carry its blocks before the pairs are made, not 3,000."""
    large = spark.createDataFrame([(list(range(3000)),)], "m array<int>")
    met = pairs.pairs_within(large, "m", "a", "b")
    assert met.count() == 3000 * 2999 // 2
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("posexplode") > plan.index("RepartitionByExpression") and plan.count("posexplode") == 1
