"""Exact duplicates by an extendible-hash index on shared files.

1. Every scan task names the different texts that it sees: a row whose normalised text the task still remembers joins that entry, any
   other opens one.  So a text with very many copies gives about one entry a task, whatever it weighs in the table.  Rows, entries
   and the text of each entry's first row are written to the shared folder.
2. Entries whose 64-bit hash occurs once are done.  The others are put into buckets by leading hash bits.  A directory starts with one
   bucket; an overfull bucket is split by its next bit, for which the directory doubles, until every bucket fits or holds one hash only.
   The driver sees byte counts of hash cells, never hashes of documents.
3. An owner task takes whole buckets, that is ranges of hashes, in hash order.  It chains the different texts of a hash and compares the
   bytes of each entry with the chain.  The result, one row per entry with its place in the chain, is the index that is written.
4. Counts and the row that stays are combined per entry, then per chained text, and go back to the rows by entry.

Rows are never sent by text or by hash, only by entry, and an entry lies in one scan task.  Buckets are split by bytes; there are at most
``2 * MOST_BUCKETS`` of them, which bounds the directory.

Defined cases: NULL counts as the empty text; NULL ids are the smallest, so a group of NULL ids only keeps one of its rows and its
``keep_id`` is NULL; of rows that share text and the largest id exactly one stays; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from freshet.session import stored_table

REMEMBERED = 32 << 20        # bytes of text that a scan task remembers; beyond them the oldest are forgotten and may become entries again
BUCKET_BYTES = 64 << 20        # text of the entries in a bucket
MOST_BUCKETS = 32_768        # larger corpora get larger buckets
FIRST_BITS, NEXT_BITS, HASH_BITS = 12, 8, 64

ROWS = "row long, doc_id long, entry long, hash long, sha string, bytes long, text binary"


class _Remembered:
    """Texts that a task has named, up to a number of bytes, the longest unseen ones forgotten first."""

    def __init__(self, most: int):
        self.most, self.held = most, 0
        self.entries: OrderedDict[bytes, int] = OrderedDict()

    def find(self, text: bytes) -> int | None:
        entry = self.entries.get(text)        # dictionary keys are compared by their bytes
        if entry is not None:
            self.entries.move_to_end(text)
        return entry

    def add(self, text: bytes, entry: int) -> None:
        self.entries[text] = entry
        self.held += len(text) + 100
        while self.held > self.most:
            gone, _ = self.entries.popitem(last=False)
            self.held -= len(gone) + 100


def _name_entries(bits: int, remembered: int):
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("entry", pa.int64()), ("hash", pa.int64()), ("sha", pa.string()),
                        ("bytes", pa.int64()), ("text", pa.binary())])

    def run(batches):
        first, n = TaskContext.get().partitionId() << 33, 0
        known = _Remembered(remembered)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for start in range(0, len(ids), 256):
                out = []
                for doc_id, text in zip(ids[start:start + 256], texts.slice(start, 256)):
                    content = (text.as_py() or b"").lower()        # of bytes: A-Z only
                    entry = known.find(content)
                    if entry is None:
                        entry, sha = first + n, hashlib.sha256(content).digest()
                        known.add(content, entry)
                        hashed = int.from_bytes(sha[:8], "big") >> (HASH_BITS - bits) << (HASH_BITS - bits)
                        out.append((first + n, doc_id, entry, hashed - (1 << 64) if hashed >> 63 else hashed, sha.hex(), len(content), content))
                    else:
                        out.append((first + n, doc_id, entry, None, None, None, None))
                    n += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def _cells(heads: DataFrame, bits: int, parents: list[int] | None, parent_bits: int) -> dict[int, tuple[int, bool]]:
    """Bytes by leading hash bits, and whether a cell has several hashes; only below the given parent cells."""
    cell = F.shiftrightunsigned("hash", HASH_BITS - bits)
    rows = heads if parents is None else heads.filter(F.shiftrightunsigned("hash", HASH_BITS - parent_bits).isin(parents))
    found = rows.groupBy(cell.alias("cell")).agg(F.sum("bytes").alias("bytes"), (F.min("hash") < F.max("hash")).alias("several")).collect()
    return {r["cell"] % (1 << bits): (r["bytes"], r["several"]) for r in found}


def directory(heads: DataFrame, capacity: int) -> list[tuple[int, int]]:
    """Buckets as (leading bits, depth) in hash order; an overfull bucket is split by one bit at a time."""
    buckets: list[tuple[int, int]] = []
    bits, cells, open_ = FIRST_BITS, _cells(heads, FIRST_BITS, None, 0), [(0, 0)]
    while open_:
        overfull = []
        starts = np.array(sorted(cells), dtype=np.uint64)
        while open_:
            prefix, depth = open_.pop()
            low, high = prefix << (bits - depth), (prefix + 1) << (bits - depth)
            inside = [int(c) for c in starts[np.searchsorted(starts, np.uint64(low)):np.searchsorted(starts, np.uint64(high - 1), side="right")]]
            if not inside:
                continue
            many = len(inside) > 1 or cells[inside[0]][1]
            if sum(cells[c][0] for c in inside) <= capacity or not many:
                buckets.append((prefix, depth))
            elif depth < bits:
                open_ += [(2 * prefix, depth + 1), (2 * prefix + 1, depth + 1)]
            else:
                overfull.append((prefix, depth))
        if not overfull or bits == HASH_BITS:
            buckets += overfull
            break
        finer = min(HASH_BITS, bits + NEXT_BITS)
        cells, open_, bits = _cells(heads, finer, [p for p, _ in overfull], bits), overfull, finer
    return sorted(buckets, key=lambda b: b[0] << (HASH_BITS - b[1]))


def _bucket_of(buckets: list[tuple[int, int]]):
    starts = np.array([p << (HASH_BITS - d) for p, d in buckets], dtype=np.uint64)

    @F.pandas_udf(T.LongType())
    def find(hashed: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, hashed.to_numpy(dtype=np.int64).view(np.uint64), side="right") - 1)

    return find


def _chain(batches):
    """Entries in hash order: the different texts of a hash form a chain, each entry gets the place of its text."""
    schema = pa.schema([("bucket", pa.int64()), ("hash", pa.int64()), ("chain", pa.int32()), ("entry", pa.int64())])
    now, chain = None, []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(3)]
        out = []
        for bucket, hashed, entry, text in zip(*columns, batch.column(3)):
            if hashed != now:
                now, chain = hashed, []
            content = text.as_py()
            place = next((i for i, known in enumerate(chain) if known == content), len(chain))
            if place == len(chain):
                chain.append(content)
            out.append((bucket, hashed, place, entry))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def build_index(rows: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(bucket, hash, chain, entry) of the entries whose hash occurs more than once, as a table in the shared folder."""
    heads = rows.filter(F.col("hash").isNotNull())
    shared = stored_table(heads.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"), "dedup-hashes")
    met = heads.select("hash", "bytes").join(shared, "hash", "left_semi")
    total = met.agg(F.sum("bytes")).first()[0] or 0
    buckets = directory(met, max(bucket_bytes, -(-total // MOST_BUCKETS)))
    if not buckets:
        return rows.sparkSession.createDataFrame([], "bucket long, hash long, chain int, entry long")
    placed = heads.select("hash", "entry", "text").join(shared, "hash", "left_semi").withColumn("bucket", _bucket_of(buckets)("hash"))
    owned = placed.select("bucket", "hash", "entry", "text").repartition("bucket").sortWithinPartitions("bucket", "hash", "entry")
    return stored_table(owned.mapInArrow(_chain, "bucket long, hash long, chain int, entry long"), "dedup-index")


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES, hash_bits: int = HASH_BITS,
               remembered: int = REMEMBERED) -> DataFrame:
    """Per row: doc_id, keep_id (the largest id with the same normalised text), group_size, kept and text_sha256."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    rows = stored_table(texts.mapInArrow(_name_entries(hash_bits, remembered), ROWS), "dedup-rows")
    index = build_index(rows, bucket_bytes)
    entries = stored_table(rows.groupBy("entry").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "row")).alias("best"), F.max("sha").alias("sha")), "dedup-entries")
    linked = index.join(entries, "entry")
    chained = linked.groupBy("hash", "chain").agg(F.sum("n").alias("total"), F.max("best").alias("first"))
    joined = linked.select("entry", "hash", "chain").join(chained, ["hash", "chain"]).select("entry", "total", "first")
    settled = entries.join(joined, "entry", "left").select("entry", F.coalesce("first", "best").alias("keep"), F.coalesce("total", "n").alias("group_size"), "sha")
    return rows.select("row", "doc_id", "entry").join(settled, "entry").select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"), F.col("sha").alias("text_sha256"))


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rows equal in id and text give one."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = duplicates(docs, id_col, text_col).filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    marked = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), text.alias("text"))
    lowered = F.sha2(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").cast("binary"), 256)
    met = marked.join(kept, F.col("id").eqNullSafe(F.col("_id")) & (lowered == F.col("_sha")), "left_semi")
    return met.dropDuplicates(["id", "text"]).select("row.*")
