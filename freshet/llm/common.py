"""Small pieces that several corpus operators share.

Every operator selects the columns that it needs first, so further columns of any name do no harm, and casts ids to ``bigint``.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SPACES = " \t\n\x0b\x0c\r"        # the white space of the word and line rules: 0x20 and 0x09 to 0x0D


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are."""
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, mark): the text with NULL as empty, and a hash of it that tells rows with one id but other texts apart."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("mark"))


def repeated(df: DataFrame, copies: str) -> DataFrame:
    """One row for each input row that was counted in ``copies``."""
    return df.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).drop(copies)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
