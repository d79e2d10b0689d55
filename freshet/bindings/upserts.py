"""Table upserts: an existing and an incoming part of the orders, split by date so that together they are the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.bindings.base import query, table, with_ctes
from freshet.operators import guards, store, upsert
from freshet.session import scratch_path

SPLIT_SQL = """
old AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate < TIMESTAMP '1999-06-01 00:00:00'),
incoming AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01 00:00:00')"""
SPLIT = with_ctes(SPLIT_SQL)


def _split(spark, d):
    o = table(spark, d, "orders")
    base = o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    cut = lambda s: F.lit(s).cast("date")
    return (base.filter(F.col("day") < cut("1999-06-01")),
            base.filter(F.col("day") >= cut("1998-06-01")).withColumn("o_totalprice", F.col("o_totalprice") + 1))


@query("k01_replace_rows_for_keys", SPLIT + "SELECT * FROM old WHERE o_custkey NOT IN (SELECT o_custkey FROM incoming) UNION ALL SELECT * FROM incoming")
def _(spark, d):
    old, incoming = _split(spark, d)
    return upsert.replace_rows(old, incoming, incoming, ["o_custkey"])


@query("k01_replace_one_source", SPLIT + """
SELECT o_orderkey, coalesce(src, 'legacy') AS source FROM (SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN 'concern' ELSE 'legacy' END AS src FROM old)
WHERE NOT (coalesce(src, 'legacy') = 'legacy' AND o_custkey IN (SELECT o_custkey FROM incoming WHERE o_orderstatus = 'P'))
UNION ALL SELECT o_orderkey, 'legacy' FROM incoming WHERE o_orderstatus = 'P'""")
def _(spark, d):
    old, incoming = _split(spark, d)
    held = old.select("o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") == "O", "concern").when(F.col("o_orderstatus") == "P", "legacy").alias("source"))
    new = incoming.filter("o_orderstatus = 'P'").select("o_orderkey", "o_custkey", F.lit("legacy").alias("source"))
    replaced = upsert.replace_rows_of_source(held, new, new, ["o_custkey"], "source", "legacy", "legacy")
    return replaced.select("o_orderkey", F.coalesce("source", F.lit("legacy")).alias("source"))


@query("k06_insert_only_merge", SPLIT + "SELECT * FROM old UNION ALL SELECT * FROM incoming WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)")
def _(spark, d):
    return upsert.insert_new(*_split(spark, d), ["o_orderkey"])


@query("k05_append_only_log", SPLIT + "SELECT o_orderkey FROM incoming WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)")
def _(spark, d):
    return upsert.only_new(*_split(spark, d), ["o_orderkey"]).select("o_orderkey")


@query("k11_status_protected_replace", """
WITH held AS (SELECT o_custkey AS statement_id, o_orderkey % 40 AS constituency_id, min(CASE o_orderstatus WHEN 'F' THEN 'sent' ELSE 'draft' END) AS status, 'old' AS v FROM orders
              WHERE o_orderdate < TIMESTAMP '1999-06-01 00:00:00' GROUP BY 1, 2),
fresh AS (SELECT DISTINCT o_custkey AS statement_id, o_orderkey % 40 AS constituency_id, 'draft' AS status, 'new' AS v FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01 00:00:00')
SELECT * FROM held WHERE status <> 'draft' UNION ALL SELECT * FROM held WHERE status = 'draft' AND statement_id NOT IN (SELECT statement_id FROM fresh)
UNION ALL SELECT * FROM fresh f WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.status <> 'draft' AND h.statement_id = f.statement_id AND h.constituency_id = f.constituency_id)""")
def _(spark, d):
    return upsert.replace_open_rows(*_drafts(spark, d), ["statement_id"], ["statement_id", "constituency_id"], "status", "draft")


def _drafts(spark, d):
    old, incoming = _split(spark, d)
    key = [F.col("o_custkey").alias("statement_id"), (F.col("o_orderkey") % 40).alias("constituency_id")]
    held = old.groupBy(*key).agg(F.min(F.when(F.col("o_orderstatus") == "F", "sent").otherwise("draft")).alias("status")).withColumn("v", F.lit("old"))
    fresh = incoming.select(*key).distinct().withColumn("status", F.lit("draft")).withColumn("v", F.lit("new"))
    return held, fresh


@query("k12_backfill_never_overwrites", """
WITH held AS (SELECT DISTINCT o_custkey AS statement_id, o_orderkey % 40 AS constituency_id FROM orders WHERE o_orderdate < TIMESTAMP '1999-06-01 00:00:00'),
fresh AS (SELECT DISTINCT o_custkey AS statement_id, o_orderkey % 40 AS constituency_id FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01 00:00:00')
SELECT * FROM fresh EXCEPT SELECT * FROM held""")
def _(spark, d):
    held, fresh = _drafts(spark, d)
    return upsert.only_new(held, fresh, ["statement_id", "constituency_id"]).select("statement_id", "constituency_id")


@query("k03_full_rebuild_versions", "SELECT count(*) AS rows, 2 AS versions FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01 00:00:00'")
def _(spark, d):
    old, incoming = _split(spark, d)
    t = store.VersionedTable(spark, scratch_path(spark, "rebuild"))
    t.write(old)
    t.write(incoming)
    return t.read().agg(F.count(F.lit(1)).alias("rows"), F.lit(len(t.versions())).alias("versions"))


@query("k04_replace_one_partition", """
SELECT o_orderpriority, count(*) AS rows, round(sum(CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice + 1 ELSE o_totalprice END), 2) AS total FROM orders GROUP BY 1""")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    path = scratch_path(spark, "by-priority")
    store.replace_partitions(o, path, ["o_orderpriority"])
    store.replace_partitions(o.filter("o_orderpriority = '2-HIGH'").withColumn("o_totalprice", F.col("o_totalprice") + 1), path, ["o_orderpriority"])
    return spark.read.parquet(path).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("k02_children_before_parent", "SELECT (SELECT count(*) FROM lineitem) AS children, (SELECT count(*) FROM orders) AS parents")
def _(spark, d):
    child, parent = (store.VersionedTable(spark, scratch_path(spark, n)) for n in ("child", "parent"))
    store.commit_children_first([(child, table(spark, d, "lineitem").select("l_orderkey"))], (parent, table(spark, d, "orders").select("o_orderkey")))
    both = child.read().select(F.lit("c").alias("t")).unionByName(parent.read().select(F.lit("p").alias("t")))
    return both.agg(F.count_if(F.col("t") == "c").alias("children"), F.count_if(F.col("t") == "p").alias("parents"))


@query("k19_latest_and_mapped_views", "SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey")
def _(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("all_orders_view")
    spark.sql("SELECT o_custkey, max_by(o_orderkey, o_orderkey) AS o_orderkey FROM all_orders_view GROUP BY o_custkey").createOrReplaceTempView("latest_orders_view")
    return spark.table("latest_orders_view")


@query("k21_create_if_absent_not_null_keys", "SELECT 0 AS rows_before, count(*) AS rows_after, count(*) FILTER (c_custkey IS NULL) AS null_keys FROM customer")
def _(spark, d):
    t = store.VersionedTable(spark, scratch_path(spark, "absent"), "c_custkey bigint, c_name string")
    before = t.read().count()
    rows = table(spark, d, "customer").select("c_custkey", "c_name")
    guards.guard_share(rows, F.col("c_custkey").isNull(), 0.0)
    t.write(t.read().unionByName(rows))
    return t.read().agg(F.lit(before).alias("rows_before"), F.count(F.lit(1)).alias("rows_after"), F.count_if(F.col("c_custkey").isNull()).alias("null_keys"))
