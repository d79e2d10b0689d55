"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept and returns the columns of documents; the last one
returns token ids.  :func:`run` writes every stage's result as Parquet in the shared folder and reads it again, so lineage ends
there and a lost executor repeats at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from freshet.llm import bpe, decontaminate, line_dedup, minhash, quality
from freshet.llm.common import table
from freshet.llm.queries import vocabulary_path
from freshet.session import stored_table


NEAR_PER_CENT = 80        # similarity from which documents are near-duplicates
LEAST_WORDS = 10        # the first base rule, which holds for what the line stage leaves as well


def _marked(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` under one alias beside the two keys by which the operators name them."""
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose distributions are near a language's; rejected ones go."""
    return quality.keep(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; n_chars follows the text.  What is left of a document has to have
    the words that the base rules ask for, else it goes: empty texts and rumps are no documents.  Untouched documents stay."""
    rewritten = line_dedup.rewrite(docs, least_words=LEAST_WORDS)
    return rewritten.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else rewritten


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id; equal texts without an id are one document."""
    kept = minhash.near_duplicates(docs, per_cent=NEAR_PER_CENT).filter("kept").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct()
    met = _marked(docs).join(kept, F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left_semi")
    unnamed = met.filter("id IS NULL")
    if unnamed.isEmpty():
        return met.select("row.*")
    return met.filter("id IS NOT NULL").unionByName(unnamed.dropDuplicates(["mark"])).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    clean = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).filter("n_hit = 0").select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct()
    return _marked(docs).join(clean, F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left_semi").select("row.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number of its tokens and digests of its ids and of the bytes that they decode to."""
    return bpe.digests(docs, vocabulary_path()).withColumnRenamed("id", "doc_id")


STAGES = [("quality rules", quality_rules), ("line dedup", line_deduplication), ("MinHash near-dedup", near_duplicates),
          ("benchmark decontamination", decontamination), ("byte-level BPE", token_ids)]
ORACLE_SQL = None        # SQL can't say the merges of the last stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
