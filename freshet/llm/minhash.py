"""Near-duplicate texts: multi-index Hamming join of b-bit MinHash signatures, every link confirmed on whole shingle sets.

A text is the set of its distinct runs of five words.  Equal sets are one node from the start.  The signature of a set is
``HASHES`` MinHash values cut to ``BITS`` bits.  It is split into ``CHUNKS`` chunks; two signatures that differ in at most
``2 * CHUNKS - 1`` = 23 of the 60 values differ in at most one value of some chunk (pigeonhole), so each chunk is listed once per
allowed error, with that value left out, and all pairs within the distance meet under a common key.  At a similarity of 0.85 a
pair differs in 9 values on average; it differs in more than 23 with a probability of about 2e-6.  Links from a lower similarity on
take more and shorter chunks (:func:`chunks_for`): at 0.80, where 12 values differ on average, 15 chunks guarantee 29.

Keys are range-sorted by (key, id), which also cuts a key shared by very many texts; a task walks through its range and links each
text to the first of its key, so no pairs inside a group are made.  The connected texts form loose groups that contain every
pair within the distance.  Inside a loose group the full sets are compared in blocks of bounded size: a task gets one block or two,
counts all intersections by a matrix product and returns only a spanning forest of the confirmed links.  Blocks are first compared
with themselves, then the texts that stand for the parts found; only where a group falls into parts are its parts compared block by block.

Links are between rows, so that every NULL id is a document of its own; the component's name is the smallest id among its rows.

Defined cases: no words give an empty set, linked with nothing; fewer words than a shingle give one shingle; rows that repeat an id are
one document and share its component; a component of NULL ids only has a NULL name and keeps its first row, any other NULL id in a
component is not kept.
"""

from __future__ import annotations

from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from freshet.llm.common import partitions, texts
from freshet.llm.kernels import LOWER, gram_hashes, mix, owners, sequence_hash, slices, span_hashes, words
from freshet.operators.proximity import connected
from freshet.operators.skew import join_counted
from freshet.session import stored_table

SHINGLE = 5
HASHES = 60
CHUNKS = 12
BITS = 16
PER_CENT = 85        # linked from this similarity on, unless the caller says another
MISSED = 3e-6        # chance that a pair of just this similarity differs in more values than the join guarantees
BLOCK_TEXTS = 200        # texts of a block, and shingles of a block, on average
BLOCK_SHINGLES = 500_000
COLUMN_SLICE = 8192

_FACTORS = np.random.default_rng(1).integers(1, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = np.random.default_rng(2).integers(0, 2**32, HASHES, dtype=np.uint32)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a slice."""
    data = LOWER[data]
    starts, ends = words(data, offsets)
    h = span_hashes(data, starts, ends)
    grams = gram_hashes(h, n)
    bounds = np.searchsorted(starts, offsets)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        else:
            out.append(np.array([sequence_hash(h[a:b])], np.uint64) if b > a else np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(texts, HASHES) of the lowest ``BITS`` bits of each minimum; the sets must not be empty."""
    values = (mix(np.concatenate(sets)) >> np.uint64(32)).astype(np.uint32)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), HASHES), np.uint64)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat(values * _FACTORS[k] + _SHIFTS[k], at)
    return out & np.uint64(2**BITS - 1)


def chunks_for(per_cent: int) -> int:
    """The fewest chunks, ``CHUNKS`` at least, whose guaranteed distance leaves a pair of this similarity with a chance of ``MISSED``."""
    differ = 1 - per_cent / 100
    for chunks in (c for c in range(CHUNKS, HASHES // 3 + 1) if HASHES % c == 0):
        beyond = sum(comb(HASHES, k) * differ**k * (1 - differ)**(HASHES - k) for k in range(2 * chunks, HASHES + 1))
        if beyond <= MISSED:
            return chunks
    raise ValueError(f"signatures of {HASHES} values are too short for a similarity of {per_cent} %")


def chunk_keys(signature: np.ndarray, chunks: int = CHUNKS) -> np.ndarray:
    """(texts, HASHES): for each value of the signature, the key of its chunk without that value."""
    width = HASHES // chunks
    out = np.empty(signature.shape, np.int64)
    for k in range(HASHES):
        first = k - k % width
        key = np.full(len(signature), k + 1, np.uint64)
        for other in range(first, first + width):
            if other != k:
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, other])
        out[:, k] = key.view(np.int64)
    return out


_PRINTS = pa.schema([("id", pa.int64()), ("mark", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("keys", pa.list_(pa.int64()))])


def _prints(chunks: int):
    def run(batches):
        yield from _printed(batches, chunks)
    return run


def _printed(batches, chunks: int):
    for batch in batches:
        for a, b, data, offsets in slices(batch.column(1)):
            sets = shingle_sets(data, offsets)
            n = np.array([len(s) for s in sets])
            full = [s for s in sets if len(s)]
            keys = chunk_keys(signatures(full), chunks).ravel() if full else np.zeros(0, np.int64)
            sums = [np.array([f(s) for s in sets], np.uint64).view(np.int64) for f in (
                lambda s: mix(s).sum(dtype=np.uint64), lambda s: mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))]
            ends = np.concatenate([[0], np.cumsum((n > 0) * HASHES)]).astype(np.int32)
            yield pa.record_batch([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(n), pa.array(sums[0]), pa.array(sums[1]),
                                   pa.ListArray.from_arrays(pa.array(ends), pa.array(keys))], schema=_PRINTS)


def _leaders(batches):
    """Rows sorted by (key, id): (a, b, NULL) links a text to the first of its key; (first text, NULL, key) names the keys at both
    ends of the range, which may go on in the next one."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64())])
    last_key = leader = None
    opening = True
    for batch in batches:
        key, ids = (c.to_numpy() for c in batch.columns)
        if not len(key):
            continue
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[1:] != key[:-1]
        fresh[0] = last_key is None or key[0] != last_key
        at = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), -1))
        lead = np.where(at >= 0, ids[np.maximum(at, 0)], leader if leader is not None else 0)
        if opening:
            yield pa.record_batch([pa.array([ids[0]]), pa.array([None], pa.int64()), pa.array([key[0]])], schema=schema)
            opening = False
        linked = ids != lead
        pairs = np.unique(np.stack([ids[linked], lead[linked]]), axis=1)
        last_key, leader = key[-1], lead[-1]
        yield pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1]), pa.nulls(pairs.shape[1], pa.int64())], schema=schema)
    if not opening:
        yield pa.record_batch([pa.array([leader]), pa.array([None], pa.int64()), pa.array([last_key])], schema=schema)


def _loose_links(reps: DataFrame) -> DataFrame:
    n = partitions(reps.sparkSession)
    keyed = reps.select(F.explode_outer("keys").alias("key"), "id").filter("key IS NOT NULL")
    walked = keyed.repartitionByRange(n, "key", "id").sortWithinPartitions("key", "id").mapInArrow(_leaders, "a long, b long, key long")
    walked = stored_table(walked, "leaders")
    ends = walked.filter("key IS NOT NULL").select("key", "a")
    across = ends.join(ends.groupBy("key").agg(F.min("a").alias("b")), "key").filter("a <> b").select("a", "b")
    return walked.filter("b IS NOT NULL").select("a", "b").unionByName(across).distinct()


def confirmed_forest(ids: np.ndarray, sets: list[np.ndarray], per_cent: int = PER_CENT) -> list[tuple[int, int]]:
    """(text, lowest text of its group) for the groups that the links among these texts make."""
    size = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    inside = shared[place]
    owner, column = owner[inside], column[place[inside]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.int64)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMN_SLICE):
        a, b = np.searchsorted(column, [first, first + COLUMN_SLICE])
        x = np.zeros((len(sets), COLUMN_SLICE), np.float32)
        x[owner[a:b], column[a:b] - first] = 1
        common += np.rint(x @ x.T).astype(np.int64)
    linked = 100 * common >= per_cent * (size[:, None] + size[None, :] - common)
    root = np.full(len(sets), -1)
    edges = []
    for seed in np.argsort(ids, kind="stable").tolist():
        if root[seed] >= 0:
            continue
        root[seed] = seed
        frontier = [seed]
        while frontier:
            reached = np.flatnonzero(linked[frontier].any(axis=0) & (root < 0))
            root[reached] = seed
            edges += [(int(ids[i]), int(ids[seed])) for i in reached.tolist() if ids[i] != ids[seed]]
            frontier = reached.tolist()
    return edges


def _compare(per_cent: int):
    def run(batches):
        yield from _compared(batches, per_cent)
    return run


def _compared(batches, per_cent: int):
    """Rows sorted by (grp, low, high): each run is one pair of blocks."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    now, ids, sets = None, [], []

    def settled():
        edges = confirmed_forest(np.array(ids, np.int64), sets, per_cent) if len(ids) > 1 else []
        return pa.record_batch([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())], schema=schema)

    for batch in batches:
        for grp, low, high, i, s in zip(*(c.to_pylist() for c in batch.columns)):
            if (grp, low, high) != now:
                if len(ids) > 1:
                    yield settled()
                now, ids, sets = (grp, low, high), [], []
            ids.append(i)
            sets.append(np.frombuffer(s, np.uint64))
    if len(ids) > 1:
        yield settled()


def _packed_sets(batches):
    schema = pa.schema([("id", pa.int64()), ("grp", pa.int64()), ("own", pa.int32()), ("first", pa.int32()), ("last", pa.int32()), ("blocks", pa.int32()), ("shingles", pa.binary())])
    for batch in batches:
        for a, b, data, offsets in slices(batch.column(6)):
            yield pa.record_batch([*(batch.column(k).slice(a, b - a) for k in range(6)),
                                   pa.array([s.tobytes() for s in shingle_sets(data, offsets)], pa.binary())], schema=schema)


def _block_count(rows: str, shingles: str) -> Column:
    """The blocks of bounded size that so many texts with so many shingles need."""
    return F.greatest(F.ceil(F.col(rows) / BLOCK_TEXTS), F.ceil(F.col(shingles) / BLOCK_SHINGLES), F.lit(1)).cast("int")


def _in_blocks(members: DataFrame, total: int) -> DataFrame:
    """``members`` dealt to the blocks of their group, each of which is compared with itself only: ``first`` and ``last`` are NULL."""
    groups = members.groupBy("grp").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles")).withColumn("blocks", _block_count("rows", "shingles"))
    placed = join_counted(members, groups.drop("shingles"), ["grp"], ["id"], "rows", total)
    nothing = F.lit(None).cast("int")
    return placed.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumns({"first": nothing, "last": nothing})


def _links_of(met: DataFrame, per_cent: int) -> DataFrame:
    """The links confirmed inside the blocks or, with ``first`` and ``last``, between a block and the blocks of its group outside that range."""
    met = met.select("id", "grp", "own", "first", "last", "blocks", "text")
    sets = met.mapInArrow(_packed_sets, "id long, grp long, own int, first int, last int, blocks int, shingles binary")
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: ~x.between(F.col("first"), F.col("last")))
    dealt = sets.withColumn("other", F.explode(F.when(F.col("first").isNull(), F.array("own")).otherwise(others)))
    pairs = dealt.select("grp", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "id", "shingles")
    n = partitions(met.sparkSession)
    return pairs.repartition(n, "grp", "low", "high").sortWithinPartitions("grp", "low", "high").mapInArrow(_compare(per_cent), "a long, b long")


def _links_across(given: DataFrame, wide: DataFrame, links: DataFrame, per_cent: int) -> DataFrame:
    """The links still missing in groups of several blocks, whose blocks were compared with themselves (``links``).

    Round after round the first text of each part found stands for it, and these are dealt to blocks again, while their number halves; a
    group of copies of one text is whole then, after as many comparisons as it has texts.  Where a group still has several parts, all texts of
    different parts are compared: the blocks of a large part meet all blocks but those of that part.
    """
    steps, found, now = [], [], wide
    while True:
        stars = links.withColumnsRenamed({"a": "id", "b": "top"})
        step = stored_table(now.join(stars, "id", "left").withColumn("top", F.coalesce("top", "id")), "parts")
        steps.append(step)
        tops = step.filter("id = top").drop("top")
        split = stored_table(tops.groupBy("grp").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1"), "split")
        rows, left = step.count(), split.agg(F.sum("rows")).first()[0] or 0
        if not left or (found and 2 * left > rows):
            break
        now = join_counted(tops, split, ["grp"], ["id"], "rows", rows, "inner")
        placed = stored_table(_in_blocks(now, left), "tops")
        links = stored_table(_links_of(placed.join(given, "id"), per_cent), "links")
        found.append(links)
    if left:
        found.append(_links_between_parts(given, steps, split, per_cent))
    return reduce(DataFrame.unionByName, found) if found else links.limit(0)


def _links_between_parts(given: DataFrame, steps: list[DataFrame], split: DataFrame, per_cent: int) -> DataFrame:
    """Links between the parts of the groups in ``split``; parts of half a block or more have blocks of their own, others share blocks."""
    part = steps[-1].select(F.col("id").alias("top"), F.col("top").alias("part"))
    for step in reversed(steps[:-1]):        # a top stands for about one block, so no key of these joins is hot
        above = step.select("id", "top").join(part, "top", "left")
        part = above.select(F.col("id").alias("top"), F.coalesce("part", "top").alias("part"))
    members = steps[0].drop("top").join(part.withColumnRenamed("top", "id"), "id")
    total = steps[0].count()
    groups = members.groupBy("grp").agg(F.count(F.lit(1)).alias("rows")).join(split.select("grp"), "grp", "left_semi")
    members = stored_table(join_counted(members, groups, ["grp"], ["id"], "rows", total, "inner"), "members")
    parts = members.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"))
    parts = stored_table(parts.withColumn("large", (2 * F.col("rows") >= BLOCK_TEXTS) | (2 * F.col("shingles") >= BLOCK_SHINGLES)), "sizes")
    shared = parts.filter("NOT large").groupBy("grp").agg(F.sum("rows").alias("r"), F.sum("shingles").alias("s")).select("grp", _block_count("r", "s").alias("shared"))
    large = parts.filter("large").withColumn("width", _block_count("rows", "shingles"))
    upto = F.sum("width").over(Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    large = large.withColumn("upto", upto).join(shared, "grp", "left").withColumn("first", (F.coalesce("shared", F.lit(0)) + F.col("upto") - F.col("width")).cast("int"))
    spread = large.select("grp", "part", "first", "width")
    counts = (parts.join(spread, ["grp", "part"], "left").groupBy("grp").agg(F.sum("width").alias("wide")).join(shared, "grp", "left")
              .select("grp", "shared", (F.coalesce("wide", F.lit(0)) + F.coalesce("shared", F.lit(0))).cast("int").alias("blocks")))
    sizes = parts.join(spread, ["grp", "part"], "left").join(counts, "grp").select(
        "grp", "part", "rows", F.coalesce("first", F.lit(0)).alias("opening"), F.coalesce("width", "shared").alias("width"), "large", "blocks")
    placed = join_counted(members, sizes, ["grp", "part"], ["id"], "rows", total)
    closing = F.col("opening") + F.col("width") - 1
    placed = placed.withColumns({"own": (F.col("opening") + F.pmod(F.xxhash64("id"), F.col("width"))).cast("int"), "first": F.when(F.col("large"), F.col("opening")).otherwise(-1).cast("int"),
                                 "last": F.when(F.col("large"), closing).otherwise(-1).cast("int")})
    return _links_of(placed.join(given, "id"), per_cent)


def _nodes(base: DataFrame, total: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with their node, the first row with an equal set; the nodes with their keys; and links between the nodes of rows that repeat an id."""
    same = ["n", "h1", "h2"]
    classes = base.filter("n > 0").groupBy(*same).agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    held = stored_table(classes, "classes")
    named = join_counted(base.select("row", "id", "mark", *same), held, same, ["row"], "rows", total)
    rows = stored_table(named.select("row", "id", "mark", "n", F.coalesce("rep", "row").alias("node")), "nodes")
    reps = join_counted(base.select("row", "keys", *same), held, same, ["row"], "rows", total).filter("n > 0 AND (rep IS NULL OR rep = row)")
    repeated_ids = rows.filter("id IS NOT NULL").groupBy("id").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("rows")).filter("low < high")
    by_id = join_counted(rows.select("id", "row", "node"), repeated_ids.drop("high"), ["id"], ["row"], "rows", total, "inner")
    return rows, reps.select(F.col("row").alias("id"), "keys"), by_id.filter("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b")).distinct()


def _components(rows: DataFrame, links: DataFrame, total: int) -> DataFrame:
    """(row, component, first): the smallest id and the first row that links reach from a row."""
    found = connected(links).withColumnRenamed("id", "node")
    nodes = rows.groupBy("node").agg(F.min("id").alias("id"), F.min("row").alias("first"), F.count(F.lit(1)).alias("rows"))
    rooted = stored_table(nodes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    wide = rooted.groupBy("root").agg(F.min("id").alias("component"), F.min("first").alias("opening"), F.count(F.lit(1)).alias("nodes"))
    known = join_counted(rooted.select("node", "root", "rows"), wide, ["root"], ["node"], "nodes", total).select("node", "component", "opening", "rows")
    return join_counted(rows.select("row", "id", "mark", "n", "node"), known, ["node"], ["row"], "rows", total)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_cent: int = PER_CENT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable by links from ``per_cent`` on, its own included), kept and mark
    (hash of the text, which with doc_id names the row)."""
    source = texts(docs, id_col, text_col)
    prints = source.mapInArrow(_prints(chunks_for(per_cent)), "id long, mark long, n long, h1 long, h2 long, keys array<long>")
    base = stored_table(prints.withColumn("row", F.monotonically_increasing_id()), "prints")
    total = base.count()
    rows, reps, by_id = _nodes(base, total)
    loose = connected(_loose_links(reps)).withColumnRenamed("root", "grp")
    sized = stored_table(loose.join(rows.select(F.col("row").alias("id"), F.col("id").alias("doc"), "mark", "n"), "id"), "loose")
    given = source.select(F.col("id").alias("_doc"), F.col("mark").alias("_mark"), "text")
    given_twice = not rows.groupBy("id", "mark").count().filter("count > 1").isEmpty()
    met = _in_blocks(sized, total).join(given, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("mark") == F.col("_mark"))).drop("_doc", "_mark")
    if given_twice:        # a row given twice is met twice
        met = met.dropDuplicates(["id"])
    members = stored_table(met, "blocks")        # whole texts of loose groups, so that all texts are joined once only
    links = stored_table(_links_of(members, per_cent), "links")
    wide = members.filter("blocks > 1").select("id", "grp", "doc", "mark", "n")
    if not wide.isEmpty():
        links = links.unionByName(_links_across(members.filter("blocks > 1").select("id", "text"), wide, links, per_cent))
    labelled = _components(rows, links.unionByName(by_id), total)
    kept = F.coalesce(F.col("id") == F.col("component"), F.col("component").isNull() & (F.col("row") == F.col("opening")))
    return labelled.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), kept.alias("kept"), "mark")
