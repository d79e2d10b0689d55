"""Benchmark decontamination by winnowing.

Documents and benchmark items become words, words become hashes, and in every window of ``WINDOW`` consecutive words the smallest
hash of ``GRAM`` words is kept with its place (the leftmost of equal ones).  Two equal windows keep the same gram at the same
place, so every shared span of ``WINDOW`` words or more has a common fingerprint.  Benchmark windows are indexed by their
fingerprint; each meeting of fingerprints is extended to the whole window and compared word by word, so hash collisions cost time
and never a wrong hit.  Items shorter than a window are one window of their own length, looked up at every position.

Only built-in functions run.  The index is broadcast in blocks of at most ``BLOCK`` windows, so a benchmark of any size is
searched with bounded memory; fingerprints of documents are never shuffled, only hits and one row per document are.

Defined cases: a NULL or empty text has no words; a NULL item id counts as the empty string; items without words hit nothing;
rows equal in id and text each get the same row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from freshet.llm.common import ascii_lower, repeated, texts
from freshet.session import stored_table

WINDOW = 10
GRAM = 5
BLOCK = 100_000
PLACE_BITS = 26        # of a packed fingerprint: gram hash above, place below
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DOCUMENT = -1        # packed value of the one row that stands for the document itself


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS, -1), "")


def _packed(hashes: Column, i: Column, n: int) -> Column:
    gram = F.xxhash64(*[F.get(hashes, i + j) for j in range(n)])
    return F.shiftleft(gram, PLACE_BITS).bitwiseOR(i.cast("long"))


def _hashed(df: DataFrame) -> DataFrame:
    """(.., words, n, hashes, grams): grams are packed (hash, place) of all runs of ``GRAM`` words."""
    h = df.withColumn("n", F.size("words")).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    places = F.when(F.col("n") >= WINDOW, F.sequence(F.lit(0), F.col("n") - GRAM)).otherwise(F.array().cast("array<int>"))
    return h.withColumn("grams", F.transform(places, lambda i: _packed(F.col("hashes"), i, GRAM)))


def _minima() -> Column:
    """Of every window, its smallest packed gram."""
    starts = F.when(F.col("n") >= WINDOW, F.sequence(F.lit(0), F.col("n") - WINDOW)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.least(*[F.get("grams", i + j) for j in range(WINDOW - GRAM + 1)]))


def _hash_of(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, PLACE_BITS)


def _place_of(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(2**PLACE_BITS - 1).cast("long")).cast("int")


def window_index(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(print, offset, length, window, items): each distinct window, its fingerprint and the items that hold it."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                             words(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("words"))
    whole = _hashed(items).withColumn("minima", _minima())
    long = whole.select("item", "words", F.posexplode_outer("minima").alias("start", "packed")).filter("start IS NOT NULL").select(
        "item", F.slice("words", F.col("start") + 1, WINDOW).alias("window"), F.lit(WINDOW).alias("length"),
        _hash_of(F.col("packed")).alias("print"), (_place_of(F.col("packed")) - F.col("start")).alias("offset"))
    n = F.col("n")
    short_print = reduce(lambda otherwise, k: F.when(n == k, _hash_of(_packed(F.col("hashes"), F.lit(0), k))).otherwise(otherwise),
                         range(1, WINDOW), F.lit(None).cast("long"))
    short = whole.filter((n > 0) & (n < WINDOW)).select(
        "item", F.col("words").alias("window"), n.alias("length"), short_print.alias("print"), F.lit(0).alias("offset"))
    return long.unionByName(short).groupBy("window").agg(
        F.first("length").alias("length"), F.first("print").alias("print"), F.first("offset").alias("offset"),
        F.array_sort(F.collect_set("item")).alias("items"))


def window_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(id, mark, n, start, length, items): one row per window hit, and per document one row with start NULL."""
    index = stored_table(window_index(benchmark), "windows")
    lengths = sorted(r[0] for r in index.select("length").distinct().collect())        # at most WINDOW values
    blocks = max(1, -(-index.count() // block))
    source = _hashed(texts(docs, id_col, text_col).select("id", "mark", words(F.col("text")).alias("words"))).withColumn(
        "packed", F.array_distinct(_minima()))
    for k in (k for k in lengths if k < WINDOW):
        all_places = F.when(F.col("n") >= k, F.sequence(F.lit(0), F.col("n") - k)).otherwise(F.array().cast("array<int>"))
        source = source.withColumn("packed", F.concat("packed", F.transform(all_places, lambda i: _packed(F.col("hashes"), i, k))))
    # the outer form: for the plain one Spark infers a filter that would work the whole array out once more
    prints = source.select("id", "mark", "n", "words", F.explode_outer(F.concat("packed", F.array(F.lit(DOCUMENT).cast("long")))).alias("packed"))
    prints = prints.select("id", "mark", "n", "words", _place_of(F.col("packed")).alias("place"),
                           F.when(F.col("packed") == DOCUMENT, F.lit(DOCUMENT).cast("long")).otherwise(_hash_of(F.col("packed"))).alias("print"))
    parts = []
    for b in range(blocks):
        part = index.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b).select("print", "offset", "length", "window", "items")
        if b == 0:
            own = docs.sparkSession.range(1).select(
                F.lit(DOCUMENT).cast("long").alias("print"), F.lit(None).cast("int").alias("offset"), F.lit(None).cast("int").alias("length"),
                F.lit(None).cast("array<string>").alias("window"), F.lit(None).cast("array<string>").alias("items"))
            part = part.unionByName(own)
        start = F.col("place") - F.col("offset")
        same = (start >= 0) & (start + F.col("length") <= F.col("n")) & (F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("length")) == F.col("window"))
        parts.append(prints.join(F.broadcast(part), "print").filter((F.col("print") == DOCUMENT) | same).select(
            "id", "mark", "n", start.alias("start"), "length", "items"))
    return reduce(DataFrame.unionByName, parts)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, mark, n_words, n_hit (words inside a hit), items (sorted as strings), spans (merged hits)."""
    hits = window_hits(docs, benchmark, id_col, text_col, block)
    found = hits.groupBy("id", "mark").agg(
        F.count_if(F.col("start").isNull()).alias("copies"), F.max("n").alias("n"),
        F.array_sort(F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", (F.col("start") + F.col("length")).alias("stop"))))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    empty = F.struct(F.array().cast("array<struct<start:int,stop:int>>").alias("done"), F.lit(-1).alias("start"), F.lit(-1).alias("stop"))

    def widen(a: Column, x: Column) -> Column:
        joins = x["start"] <= a["stop"]
        closed = F.when(a["start"] >= 0, F.concat(a["done"], F.array(F.struct(a["start"].alias("start"), a["stop"].alias("stop"))))).otherwise(a["done"])
        return F.when(joins, F.struct(a["done"].alias("done"), a["start"].alias("start"), F.greatest(a["stop"], x["stop"]).alias("stop"))).otherwise(
            F.struct(closed.alias("done"), x["start"].alias("start"), x["stop"].alias("stop")))

    def close(a: Column) -> Column:
        return F.when(a["start"] >= 0, F.concat(a["done"], F.array(F.struct(a["start"].alias("start"), a["stop"].alias("stop"))))).otherwise(a["done"])

    spans = found.withColumn("spans", F.aggregate("hits", empty, widen, close))
    return repeated(spans.select(
        F.col("id").alias("doc_id"), "mark", F.col("n").cast("long").alias("n_words"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"]).alias("n_hit"), "items", "spans", "copies"), "copies")
