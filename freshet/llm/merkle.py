"""A Merkle manifest of a data set, kept as a log of tree nodes in postorder.

Rows are leaves; the leaves of a group (a source) form a tree whose nodes each hash ``RUN`` consecutive children, and the roots of the
groups form one more such tree.  The log holds every node at its postorder position, the place at which a builder reading the leaves
in order would complete it.  The position follows from the number of leaves alone (:func:`position`), so builders need not talk to
each other: each takes one aligned block of ``RUN ** LEVELS`` nodes, writes the nodes above them in completion order, and the roots of
the blocks are the leaves of the next round.  Proofs are read back block by block: the addresses of a node's siblings are computed,
and what lies above the block arrives as one row.

Leaves are numbered by one range exchange of digests and small counts, so a group with a third of all rows is spread like any
other; no task or group holds more than a block.  Texts are read once and never moved.

Defined cases: a NULL group is a group of its own and comes first; rows with a NULL order column come first; rows equal in group and
order follow each other by their digest and all are leaves; a NULL id is never tampered with; an empty table has no root and no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from freshet.session import scratch_path, stored_table

RUN = 16        # children of a node
BITS = 4        # RUN = 2 ** BITS
LEVELS = 3        # levels that one builder adds, so a block has RUN ** LEVELS nodes
BLOCK_BITS = BITS * LEVELS
DEEPEST = 15        # levels of 16 that a 63-bit number of leaves can have
HEX = 64        # characters of a digest
TOP = ""        # name of the tree over the groups; names of groups start with "n" or "s"

NODES = "grp string, size long, level int, idx long, pos long, digest string, id long, claim string, name string"
PATHS = "grp string, idx long, slots array<int>, others array<string>, subroot string"


def digest(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()


def height(size: int) -> int:
    """Levels above the leaves of a tree with ``size`` leaves."""
    levels = 0
    while size > 1:
        size, levels = -(-size // RUN), levels + 1
    return levels


def position(level: int, index: np.ndarray, size: int) -> np.ndarray:
    """Postorder positions of the nodes ``index`` of a level: after the last leaf below a node, all nodes that end there or before are
    complete but for those above it."""
    top = height(size)
    ends = np.minimum((np.asarray(index, dtype=np.int64) + 1) << (BITS * level), size)
    complete = sum(-(-ends // (1 << (BITS * j))) for j in range(top + 1))
    return complete - (top - level) - 1


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: every value as byte count, colon and text, a NULL as a dash."""
    return F.sha2(F.concat(*[_field(v) for v in values]).cast("binary"), 256)


def leaves(docs: DataFrame, group: str, order: str, values: list[Column], claim: Column | None = None) -> DataFrame:
    """Numbered leaves: (grp, idx, size, digest, id, claim, name).  ``claim`` is the digest that a row claims to have now, if another."""
    named = F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit("n"))        # NULL first, then by bytes
    rows = docs.select(named.alias("grp"), leaf_digest(*values).alias("digest"), F.col(order).cast("long").alias("id"),
                       (F.lit(None).cast("string") if claim is None else claim).alias("claim"), F.lit(None).cast("string").alias("name"))
    return numbered(stored_table(rows, "merkle-digests"), ["id", "digest"])


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, their number in their group from 0, and ``size``, the rows of the group."""
    dealt = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("grp", *order, "tie").sortWithinPartitions("grp", *order, "tie")
    placed = stored_table(dealt.drop("tie").withColumn("at", F.monotonically_increasing_id()), "merkle-order")        # task and place in it
    part, local = F.shiftrightunsigned("at", 33), F.col("at").bitwiseAND(F.lit(2**33 - 1))
    counts = placed.groupBy("grp", part.alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.min(local).alias("first"))
    group = Window.partitionBy("grp")
    before = F.coalesce(F.sum("rows").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = counts.select("grp", "part", (before - F.col("first")).alias("base"), F.sum("rows").over(group).alias("size"))
    return placed.withColumn("part", part).withColumn("local", local).join(bases, ["grp", "part"]).select(
        "grp", (F.col("base") + F.col("local")).alias("idx"), "size", "digest", "id", "claim", "name")


def _groups(batches, keys: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Columns of consecutive rows with the same keys; rows arrive sorted, a group may span batches."""
    held, held_key = None, None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        data = batch.to_pydict()
        key_rows = list(zip(*[data[k] for k in keys]))
        start = 0
        while start < len(key_rows):
            key, end = key_rows[start], start + 1
            while end < len(key_rows) and key_rows[end] == key:
                end += 1
            if key != held_key:
                if held is not None:
                    yield held_key, held
                held, held_key = {c: [] for c in data}, key
            for c, values in data.items():
                held[c].extend(values[start:end])
            start = end
    if held is not None:
        yield held_key, held


def _build(round_: int):
    """Completes the nodes above the aligned blocks of a round, in postorder; round 0 also logs the leaves."""
    low = round_ * LEVELS
    schema = pa.schema([("grp", pa.string()), ("size", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("pos", pa.int64()),
                        ("digest", pa.string()), ("id", pa.int64()), ("claim", pa.string()), ("name", pa.string())])

    def run(batches):
        for (grp, block), rows in _groups(batches, ["grp", "block"]):
            size, here, nodes = rows["size"][0], rows["digest"], []
            top = min(height(size), low + LEVELS)
            if round_ == 0:
                nodes += zip(position(0, np.array(rows["idx"]), size).tolist(), [0] * len(here), rows["idx"], here, rows["id"], rows["claim"], rows["name"])
            for level in range(low + 1, top + 1):
                here = [digest("".join(here[i:i + RUN]).encode()) for i in range(0, len(here), RUN)]
                index = (block << (BITS * (low + LEVELS - level))) + np.arange(len(here))
                nodes += [(p, level, i, h, None, None, None) for p, i, h in zip(position(level, index, size).tolist(), index.tolist(), here)]
            if not nodes:
                continue
            nodes.sort(key=lambda node: node[0])
            pos, levels, index, digests, ids, claims, names = zip(*nodes)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
                ([grp] * len(nodes), [size] * len(nodes), levels, index, pos, digests, ids, claims, names), schema)], schema=schema)

    return run


def _rounds(size: Column) -> Column:
    """Rounds that a tree with so many leaves needs."""
    need = F.lit(DEEPEST // LEVELS)
    for r in range(DEEPEST // LEVELS - 1, 0, -1):
        need = F.when(size <= F.lit(1 << (BLOCK_BITS * r)), r).otherwise(need)
    return need


@dataclass
class Manifest:
    """The log, as a folder of appended Parquet files, the number of rounds of its trees, and the root."""

    log: DataFrame
    rounds: int
    top_rounds: int
    root: str | None


def _append(rows: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Logs all nodes over ``rows``, round by round."""
    spark, r, rounds = rows.sparkSession, 0, 1
    while r < rounds:
        blocks = rows.withColumn("block", F.shiftright("idx", BLOCK_BITS)).repartition("grp", "block").sortWithinPartitions("grp", "block", "idx")
        blocks.mapInArrow(_build(r), NODES).write.mode("append").parquet(path)
        log = spark.read.schema(NODES).parquet(path)
        if r == 0:
            rounds = max(1, -(-height(log.agg(F.max("size")).first()[0] or 0) // LEVELS))
        r += 1
        rows = log.filter((F.col("level") == r * LEVELS) & (F.col("size") > F.lit(1 << (BLOCK_BITS * r)))).drop("level", "pos")
    return spark.read.schema(NODES).parquet(path), rounds


def _roots(log: DataFrame) -> DataFrame:
    """The last node of every tree."""
    return log.groupBy("grp").agg(F.max_by("digest", "pos").alias("digest"), F.max("size").alias("size"))


def build(rows: DataFrame) -> Manifest:
    """Logs the trees of all groups and the tree over their roots."""
    spark = rows.sparkSession
    below, rounds = _append(rows, scratch_path(spark, "merkle-log"))
    roots = _roots(below).select(F.lit(TOP).alias("grp"), "digest", F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("claim"), F.col("grp").alias("name"))
    above, top_rounds = _append(numbered(stored_table(roots, "merkle-roots"), ["name"]), scratch_path(spark, "merkle-top"))
    last = _roots(above).first()
    return Manifest(below.unionByName(above), rounds, top_rounds, last["digest"] if last else None)


def fold(node: str, slots: list[int], others: list[str]) -> str:
    """The root that a digest and the digests beside its way up give."""
    for slot, rest in zip(slots, others):
        node = digest((rest[:slot * HEX] + node + rest[slot * HEX:]).encode())
    return node


class _Block:
    """One aligned block of a tree as read from the log: its nodes by position, and the way from its root upward."""

    def __init__(self, rows: dict[str, list], low: int):
        ways = [i for i, p in enumerate(rows["pos"]) if p < 0]
        self.slots, self.others, self.subroot = rows["slots"][ways[0]], rows["others"][ways[0]], rows["subroot"][ways[0]]
        own = [i for i, p in enumerate(rows["pos"]) if p >= 0]
        self.size, self.low = rows["size"][own[0]], low
        self.top = min(height(self.size), low + LEVELS)
        self.nodes = {rows["pos"][i]: rows["digest"][i] for i in own}
        self.base = [i for i in own if rows["level"][i] == low]
        self.rows = rows
        self._runs: dict[tuple[int, int], list[str]] = {}

    def run(self, level: int, run: int) -> list[str]:
        """Digests of a run of siblings, from their positions."""
        if (level, run) not in self._runs:
            count = -(-self.size // (1 << (BITS * level)))
            at = position(level, np.arange(run * RUN, min(run * RUN + RUN, count)), self.size)
            self._runs[level, run] = [self.nodes[p] for p in at.tolist()]
        return self._runs[level, run]

    def way(self, index: int) -> tuple[list[int], list[str]]:
        """Slots and the other digests of the runs from a base node of the block to the root of the whole manifest."""
        slots, others = [], []
        for level in range(self.low, self.top):
            run, slot = index // RUN, index % RUN
            beside = self.run(level, run)
            slots.append(slot)
            others.append("".join(beside[:slot] + beside[slot + 1:]))
            index = run
        return slots + self.slots, others + self.others


def _blocks(log: DataFrame, paths: DataFrame, round_: int) -> DataFrame:
    """Nodes of a round's blocks in log order, each block led by the way above it."""
    low = round_ * LEVELS
    tall = F.col("size") > F.lit(1 << (BLOCK_BITS * round_)) if round_ else F.lit(True)        # other trees end below this round
    nodes = log.filter(F.col("level").between(low, low + LEVELS - 1) & tall).select(
        "grp", F.expr(f"shiftright(idx, {BLOCK_BITS} - (level - {low}) * {BITS})").alias("block"), "pos", "size", "level", "idx", "digest", "id", "claim", "name",
        F.lit(None).cast("array<int>").alias("slots"), F.lit(None).cast("array<string>").alias("others"), F.lit(None).cast("string").alias("subroot"))
    none = {"size": "long", "level": "int", "digest": "string", "id": "long", "claim": "string", "name": "string"}
    ways = paths.select("grp", F.col("idx").alias("block"), F.lit(-1).cast("long").alias("pos"), F.lit(-1).cast("long").alias("idx"),
                        *[F.lit(None).cast(t).alias(c) for c, t in none.items()], "slots", "others", "subroot")
    return nodes.unionByName(ways).repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")


def _descend(low: int, named: bool):
    """Ways from the base nodes of the blocks to the root; the base of the tree over groups is keyed by the groups' names."""
    schema = pa.schema([("grp", pa.string()), ("idx", pa.int64()), ("slots", pa.list_(pa.int32())), ("others", pa.list_(pa.string())), ("subroot", pa.string())])

    def run(batches):
        for (grp, _), rows in _groups(batches, ["grp", "block"]):
            block, out = _Block(rows, low), []
            for i in block.base:
                slots, others = block.way(rows["idx"][i])
                out.append((rows["name"][i], 0, slots, others, rows["digest"][i]) if named else (grp, rows["idx"][i], slots, others, block.subroot))
                if len(out) == 256:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def _ways(log: DataFrame, starts: DataFrame, rounds: int, named: bool) -> DataFrame:
    """Ways above the blocks of round 0 (or, ``named``, above the leaves), from the top round down; ``starts`` has those of whole trees."""
    paths = starts.filter(F.col("rounds") == rounds).drop("rounds")
    for r in range(rounds - 1, -1 if named else 0, -1):
        found = _blocks(log, paths, r).mapInArrow(_descend(r * LEVELS, named and r == 0), PATHS)
        paths = stored_table(found if named and r == 0 else found.unionByName(starts.filter(F.col("rounds") == r).drop("rounds")), "merkle-ways")
    return paths


def _judge(root: str, with_siblings: bool):
    fields = [("id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()),
              ("folded_root", pa.string()), ("verified", pa.bool_()), ("slots", pa.list_(pa.int32())), ("siblings", pa.list_(pa.string()))]
    schema = pa.schema(fields if with_siblings else fields[:7])

    def run(batches):
        for _, rows in _groups(batches, ["grp", "block"]):
            block, out = _Block(rows, 0), []
            above = "".join(block.others)
            seen: dict[tuple[int, str], str] = {}        # a parent is folded once for all children that give it the same digest
            for i in block.base:
                slots, others = block.way(rows["idx"][i])
                own = len(slots) - len(block.slots)
                proof = digest(("".join(others[:own]) + above).encode())
                node = rows["claim"][i] or rows["digest"][i]
                if own:
                    parent = fold(node, slots[:1], others[:1])
                    key = (rows["idx"][i] // RUN, parent)
                    if key not in seen:
                        seen[key] = fold(parent, slots[1:], others[1:])
                    folded = seen[key]
                else:
                    folded = fold(node, slots, others)
                row = (rows["id"][i], rows["digest"][i], block.subroot, root, proof, folded, folded == root)
                out.append((*row, slots, others) if with_siblings else row)
                if len(out) == 512:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def audit(manifest: Manifest, with_siblings: bool = False) -> DataFrame:
    """Per leaf: id, leaf, subroot, root, proof_sha256, folded_root and verified; on request also its proof: per level the node's slot in its run
    and the digests of the others, joined.  The root is folded from the claimed digest where a leaf has one."""
    columns = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    columns += ", slots array<int>, siblings array<string>" if with_siblings else ""
    spark = manifest.log.sparkSession
    if manifest.root is None:
        return spark.createDataFrame([], columns)
    top, below = manifest.log.filter(F.col("grp") == TOP), manifest.log.filter(F.col("grp") != TOP)
    start = spark.createDataFrame([(TOP, 0, [], [], None, manifest.top_rounds)], f"{PATHS}, rounds int")
    sizes = below.filter("level = 0 AND idx = 0").select("grp", _rounds(F.col("size")).alias("rounds"))
    starts = _ways(top, start, manifest.top_rounds, True).join(sizes, "grp")
    ways = _ways(below, starts, manifest.rounds, False)
    return _blocks(below, ways, 0).mapInArrow(_judge(manifest.root, with_siblings), columns)
