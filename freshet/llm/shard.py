"""Sharding by histogram sort: shards of nearly equal bytes, found before any row moves.

Each row has a 63-bit key: 39 bits of its text's hash, then 24 bits of its id's hash.  Equal texts lie next to each other, yet a
group of copies larger than a shard can be cut inside.  The splitters come from rounds of exact counts: evenly spaced probes cut
the key range, every task sums the bytes between probes, and only the intervals that still hold an undecided splitter are probed
again, finer, until each splitter is within the tolerance of its target.  The driver sees a bounded number of sums per round.
Rows then move once, to their shard and place.

Defined cases: a NULL text has 0 bytes, a NULL id is hashed as such; rows equal in id and text share a key and stay together,
with slots of their own; an empty table has no rows and no splitters are sought.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from freshet.session import stored_table

ROW_BYTES = 16        # counted for each row beside its text
KEY_BITS = 63
FIRST_BITS = 12        # probes of the first round: 2 ** FIRST_BITS
NEXT_BITS = 8        # probes inside an undecided interval in each later round
TOLERANCE = 0.001        # of a shard's share
LANES = 64        # parts of a shard that are numbered side by side


def with_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, key): all that the splitters and the exchange need."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    high = F.shiftleft(F.shiftrightunsigned(F.xxhash64(text), 25), 24)
    low = F.xxhash64(F.col(id_col)).bitwiseAND(F.lit(2**24 - 1).cast("long"))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
                       F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), high.bitwiseOR(low).alias("key"))


def splitters(keyed: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[int]:
    """``shards - 1`` keys; shard i holds the keys from splitter i - 1 up to, but without, splitter i."""
    width = KEY_BITS - FIRST_BITS
    sums = {r[0]: r[1] for r in keyed.groupBy(F.shiftright("key", width).alias("b")).agg(F.sum("size")).collect()}
    total = sum(sums.values())
    targets = [total * i / shards for i in range(1, shards)]
    within = tolerance * total / shards
    found: dict[int, int] = {}
    open_: dict[int, list[int]] = {0: list(range(len(targets)))}        # first key of an interval -> its undecided splitters
    below = {0: 0}        # first key of an interval -> exact bytes below it
    intervals = {0: sums}
    while open_:
        undecided: dict[int, list[int]] = {}
        for start, wanted in open_.items():
            cells = sorted(intervals[start].items())
            ends = list(accumulate((s for _, s in cells), initial=below[start]))        # bytes below each probe
            for i in wanted:
                at = min(max(bisect_left(ends, targets[i]) - 1, 0), len(cells) - 1) if cells else None
                if at is None:
                    found[i] = start
                    continue
                low, high = (cells[at][0] << width), ((cells[at][0] + 1) << width)
                near, key = min((abs(ends[at] - targets[i]), low), (abs(ends[at + 1] - targets[i]), high))
                if near <= within or width == 0:
                    found[i] = key
                else:
                    undecided.setdefault(low, []).append(i)
                    below[low] = ends[at]
        if not undecided:
            break
        finer = max(0, width - NEXT_BITS)
        cell = F.shiftright("key", width)
        counts = (keyed.filter(cell.isin([low >> width for low in undecided])).groupBy(F.shiftright("key", finer).alias("b")).agg(F.sum("size").alias("s")).collect())
        intervals = {low: {} for low in undecided}
        for r in counts:
            intervals[(r["b"] >> (width - finer)) << width][r["b"]] = r["s"]
        open_, width = undecided, finer
    return [found[i] for i in range(len(targets))]


def shard_of(key: Column, bounds: list[int]) -> Column:
    if not bounds:
        return F.lit(0)
    probes = F.lit(bounds).cast("array<bigint>")
    return F.size(F.filter(probes, lambda b: b <= key))


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", tolerance: float = TOLERANCE) -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard and slot (gapless from 0 in each shard).

    A shard is numbered in ``LANES`` lanes at once: a lane's rows are counted first, its slots start after those of the lanes
    before it, so no task holds a whole shard.  The table of lane sizes has at most ``shards * LANES`` rows.
    """
    keyed = stored_table(with_keys(docs, id_col, text_col), "shard-keys")
    bounds = splitters(keyed, shards, tolerance)
    placed = keyed.withColumn("shard", shard_of(F.col("key"), bounds)).withColumn("lane", F.pmod(F.xxhash64("doc_id", "size"), F.lit(LANES)).cast("int"))
    before = Window.partitionBy("shard").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    lanes = placed.groupBy("shard", "lane").agg(F.count(F.lit(1)).alias("rows")).select(
        "shard", "lane", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first_slot"))
    inside = Window.partitionBy("shard", "lane").orderBy("key", "doc_id", "size", "text_crc32")
    numbered = placed.withColumn("n", F.row_number().over(inside) - 1).join(F.broadcast(lanes), ["shard", "lane"])
    return numbered.select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (F.col("first_slot") + F.col("n")).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text", tolerance: float = TOLERANCE) -> None:
    """All columns of ``docs`` in folders ``shard=0`` and so on below ``path``; the rows with their texts move once."""
    keyed = stored_table(with_keys(docs, id_col, text_col), "shard-keys")
    bounds = splitters(keyed, shards, tolerance)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    high = F.shiftleft(F.shiftrightunsigned(F.xxhash64(text), 25), 24)
    key = high.bitwiseOR(F.xxhash64(F.col(id_col)).bitwiseAND(F.lit(2**24 - 1).cast("long")))
    lane = F.pmod(F.xxhash64(F.col(id_col)), F.lit(LANES))
    docs.withColumn("shard", shard_of(key, bounds)).repartition("shard", lane).write.partitionBy("shard").parquet(path)
