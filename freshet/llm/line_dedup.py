"""Line de-duplication: a repeated line stays in the first document that holds it.

Lines become 128-bit hashes.  They are range-partitioned by hash and sorted inside each range by document and position, so the
first document of a hash is the first row of its run and a running ``first`` marks every later one.  A very frequent line would
fill one range, so the runs are settled in two rounds: first per (hash, slice of documents), then among the first documents of
the slices; rows settled in round one take no part in round two, they travel under a hash of their own place.  No run of round
two is longer than the number of slices, apart from repeats inside one document.  What leaves is one run-length bitmap per
document, not text.

Defined cases: a NULL or empty text is one empty line; a NULL id counts as the largest id; rows that repeat an id are one
document as far as holding a line goes, and rows equal in id and text get equal bitmaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from freshet.llm.common import SPACES, ascii_lower, partitions, texts

LEAST_CHARS = 10        # shorter keys are never dropped
LAST_ID = 2**63 - 1


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return texts(docs, id_col, text_col).select(F.col("id").alias("doc_id"), F.coalesce("id", F.lit(LAST_ID)).alias("id"), "text", "mark")


def _hashed_lines(documents: DataFrame, least: int) -> DataFrame:
    lines = documents.select("id", "mark", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = lines.select("id", "mark", "pos", line_key(F.col("line")).alias("key")).filter(F.length("key") >= least)
    return keyed.select("id", "mark", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))


def _runs(positions: Column) -> Column:
    """Sorted positions as (first, last) runs."""
    firsts = F.filter(positions, lambda x, i: (i == 0) | (F.get(positions, i - 1) != x - 1))
    lasts = F.filter(positions, lambda x, i: (i == F.size(positions) - 1) | (F.get(positions, i + 1) != x + 1))
    return F.arrays_zip(firsts.alias("first"), lasts.alias("last"))


def drop_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_CHARS) -> DataFrame:
    """(id, mark, runs): the runs of line positions to drop, for documents that lose a line."""
    n = partitions(docs.sparkSession)
    lines = (_hashed_lines(_documents(docs, id_col, text_col), least)
             .withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
             .repartitionByRange(n, "h1", "h2", "slice"))
    in_slice = Window.partitionBy("h1", "h2", "slice").orderBy("id", "pos").rowsBetween(Window.unboundedPreceding, 0)
    one = lines.withColumn("settled", F.col("id") != F.first("id").over(in_slice))
    placed = one.select("id", "mark", "pos", "settled", F.when(F.col("settled"), F.xxhash64("id", "pos", "mark")).otherwise(F.col("h1")).alias("h1"),
                        F.when(F.col("settled"), F.col("pos").cast("long")).otherwise(F.col("h2")).alias("h2"))
    of_hash = Window.partitionBy("h1", "h2", "settled").orderBy("id", "pos").rowsBetween(Window.unboundedPreceding, 0)
    two = placed.withColumn("later", F.col("settled") | (F.col("id") != F.first("id").over(of_hash)))
    lost = two.filter("later").groupBy("id", "mark").agg(F.array_sort(F.collect_set("pos")).alias("lost"))
    return lost.select("id", "mark", _runs(F.col("lost")).alias("runs"))


def _lines_kept(joined: DataFrame, *carried) -> DataFrame:
    """``carried`` columns of (text, runs) rows with n_lines, n_dropped, keep_runs and kept_text."""
    none = F.array().cast("array<struct<first:int,last:int>>")
    split = joined.select(*carried, F.split("text", "\n", -1).alias("lines"), F.coalesce("runs", none).alias("runs"))
    names = [c for c in split.columns if c not in ("lines", "runs")]
    # the end of the text closes the last run of kept lines
    closed = split.withColumn("n_lines", F.size("lines")).withColumn(
        "stops", F.concat("runs", F.array(F.struct(F.col("n_lines").alias("first"), F.col("n_lines").alias("last")))))
    begin = lambda i: F.when(i == 0, 0).otherwise(F.get("stops", i - 1)["last"] + 1)        # noqa: E731
    kept = F.flatten(F.transform("stops", lambda s, i: F.slice("lines", begin(i) + 1, s["first"] - begin(i))))
    runs = F.flatten(F.transform("stops", lambda s, i: F.array(s["first"] - begin(i), s["last"] - s["first"] + 1)))
    return closed.select(
        *names, F.col("n_lines").cast("long").alias("n_lines"),
        F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["last"] - r["first"] + 1).alias("n_dropped"),
        F.slice(runs, 1, F.size("stops") * 2 - 1).alias("keep_runs"), F.array_join(kept, "\n").alias("kept_text"))


def deduplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_CHARS) -> DataFrame:
    """Per document: doc_id, mark (hash of its text), n_lines, n_dropped, keep_runs and kept_text.

    ``keep_runs`` is the keep bitmap of the lines, run-length compressed: lengths of alternating runs, kept lines first.
    """
    documents = _documents(docs, id_col, text_col)
    return _lines_kept(documents.join(drop_runs(docs, id_col, text_col, least), ["id", "mark"], "left"), "doc_id", "mark")


def rewrite(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_CHARS, least_words: int = 0) -> DataFrame:
    """``docs`` with the repeated lines gone from its texts, all other columns as they are; a NULL text stays NULL.

    A document that lost lines and has fewer than ``least_words`` words left goes; one that lost nothing stays, however short.  The rows
    travel once, to meet their bitmaps.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col], F.lit(0))        # never without fields
    rows = docs.select(rest.alias("row"), F.col(text_col).isNull().alias("unknown"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    kept = _lines_kept(rows.join(drop_runs(docs, id_col, text_col, least), ["id", "mark"], "left"), "row", "unknown")
    if least_words:
        found = F.size(F.regexp_extract_all("kept_text", F.lit(f"[^{SPACES}]+"), F.lit(0)))
        kept = kept.filter((F.col("n_dropped") == 0) | (found >= least_words))
    return kept.select(*[F.when(~F.col("unknown"), F.col("kept_text")).alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])
