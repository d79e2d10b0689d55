"""Exact ranked search by inner products, documents ordered by the length of their impact vectors.

A document's vector has, per term that some query holds, its integer impact times the root of the term's weight; a query's vector has its
repeats times the same root, so their inner product is the score.  Vectors are dealt by length into ranges and met in buckets,
longest first.  For each query and bucket:

1. the bucket is skipped if the query's length times the longest vector cannot reach the query's threshold (Cauchy-Schwarz);
2. inside, the query's strongest coordinates are summed exactly from the bucket's inverted lists; what the others can add is bounded by
   Cauchy-Schwarz on the rests of both vectors and by the largest value of each coordinate in the bucket;
3. documents whose bound reaches the threshold are scored again in 64-bit integers.

The threshold is the score of the k-th best so far: first among the longest vectors of all, then among those that the task has seen.  Bounds
are rounded up, so no document is lost; a task returns at most k rows a query.

Queries are a stated set.  They are worked off in blocks of about ``BLOCK_BYTES`` of text, so what tasks receive (vocabulary, weights,
query vectors) has that bound; every block reads the documents once.  A query's text is never cut, however long.

Defined cases: NULL texts have no terms and are not counted; documents without a query term score 0 and are not returned; rows that
repeat a document id are documents of their own, with equal scores in any order; NULL document ids come after all others; rows that
repeat a query id are queries of their own; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from freshet.session import stored_table

BLOCK_BYTES = 8 << 20        # text of the queries that are searched at once
BUCKET = 2048        # vectors that are met at once
SEED = 4 * BUCKET        # about as many of the longest vectors give the first thresholds
FOCUS = 0.6        # share of a query's squared length in the coordinates that are summed first
LAST = 2**63 - 1

# separators to blanks and A-Z to lower case, on UTF-8 bytes; bytes from 0x80 on belong to words
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split(b" ") if text else []


def counted(text: bytes | None) -> Counter:
    found = Counter(terms(text))
    found.pop(b"", None)
    return found


@dataclass
class Queries:
    """A block of queries: their ids, and per query the vocabulary places and repeats of its terms."""

    ids: list[int | None]
    vocabulary: dict[bytes, int]
    places: list[np.ndarray]
    repeats: list[np.ndarray]


def query_block(rows: list) -> Queries:
    counts = [counted(bytes(r["text"]) if r["text"] is not None else None) for r in rows]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
    return Queries([r["id"] for r in rows], vocabulary, [np.array([vocabulary[t] for t in c], dtype=np.int64) for c in counts],
                   [np.array(list(c.values()), dtype=np.int64) for c in counts])


def _count(vocabulary):
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("places", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))])

    def run(batches):
        known = vocabulary.value
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for start in range(0, batch.num_rows, 256):
                out: list[list] = [[], [], []]
                for text in texts.slice(start, 256):
                    found = counted(text.as_py())
                    mine = [(known[t], c) for t, c in found.items() if t in known]
                    out[0].append(found.total())
                    out[1].append([p for p, _ in mine])
                    out[2].append([c for _, c in mine])
                yield pa.RecordBatch.from_arrays([ids.slice(start, 256), *[pa.array(c, f.type) for c, f in zip(out, list(schema)[1:])]], schema=schema)

    return run


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the offsets of its rows."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]].astype(np.int64), offsets - offsets[0]


def impacts(times: np.ndarray, damp: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * times) // (1000 * times + 8 * damp)


def _vectors(weights, documents: int, length: int):
    """Impacts and lengths of the documents that hold a query term."""
    schema = pa.schema([("id", pa.int64()), ("norm", pa.float64()), ("places", pa.list_(pa.int32())), ("impacts", pa.list_(pa.int32()))])

    def run(batches):
        w = weights.value.astype(np.float64)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            places, offsets = _flat(batch.column(2))
            times, _ = _flat(batch.column(3))
            damp = np.array([25 + (75 * n * documents) // length for n in batch.column(1).to_pylist()], dtype=np.int64)
            rows = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            impact = impacts(times, damp[rows])
            norm = np.sqrt(np.bincount(rows, w[places] * impact.astype(np.float64) ** 2, minlength=batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(norm), batch.column(2), pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(impact, pa.int32()))], schema=schema)

    return run


class _Bucket:
    """Vectors of similar length, by document and by coordinate."""

    def __init__(self, ids: list[int | None], norms: np.ndarray, places: np.ndarray, impact: np.ndarray, offsets: np.ndarray, size: int):
        self.ids = np.array([LAST if i is None else i for i in ids], dtype=np.int64)
        self.unnamed = np.array([i is None for i in ids])
        self.norms, self.longest, self.places, self.impact, self.offsets = norms, norms.max(), places, impact, offsets
        rows = np.repeat(np.arange(len(ids)), np.diff(offsets))
        order = np.argsort(places, kind="stable")
        self.by_place, self.rows, self.values = places[order], rows[order], impact[order]
        self.size = size

    def lists(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Postings of the wanted coordinates: entry numbers, and the first entry and entry count of each coordinate."""
        first, end = np.searchsorted(self.by_place, wanted), np.searchsorted(self.by_place, wanted, side="right")
        lengths = end - first
        starts = np.cumsum(lengths) - lengths
        return np.repeat(first - starts, lengths) + np.arange(lengths.sum()), starts, lengths

    def scores(self, chosen: np.ndarray, gains: np.ndarray) -> np.ndarray:
        """Exact scores of the chosen documents."""
        lengths = self.offsets[chosen + 1] - self.offsets[chosen]
        starts = np.cumsum(lengths) - lengths
        at = np.repeat(self.offsets[chosen] - starts, lengths) + np.arange(lengths.sum())
        return np.add.reduceat(gains[self.places[at]] * self.impact[at], starts)


class _Query:
    """One query's vector, strongest coordinates first, and its best documents so far."""

    def __init__(self, places: np.ndarray, repeats: np.ndarray, weights: np.ndarray, threshold: int, k: int):
        w = weights[places].astype(np.float64)
        order = np.argsort(-(repeats * np.sqrt(w)), kind="stable")
        self.places, self.repeats, self.w = places[order], repeats[order], w[order]
        square = self.repeats.astype(np.float64) ** 2 * self.w
        self.gains, self.length = self.repeats * weights[self.places], math.sqrt(square.sum())
        self.focus = int(np.searchsorted(np.cumsum(square), FOCUS * square.sum())) + 1 if len(places) else 0
        self.rest = math.sqrt(max(0.0, square[self.focus:].sum()))
        self.k, self.threshold = k, max(1, threshold)
        self.best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))

    def meet(self, bucket: _Bucket, dense: np.ndarray) -> None:
        up = 1 + 1e-9        # bounds are sums of at most some thousand rounded products
        if self.length * bucket.longest * up + 1 < self.threshold:
            return
        f = self.focus
        at, starts, lengths = bucket.lists(self.places)
        first = lengths[:f].sum()
        rows, values = bucket.rows[at[:first]], bucket.values[at[:first]].astype(np.float64)
        partial = np.bincount(rows, np.repeat(self.gains[:f].astype(np.float64), lengths[:f]) * values, minlength=len(bucket.norms))
        held = np.bincount(rows, np.repeat(self.w[:f], lengths[:f]) * values ** 2, minlength=len(bucket.norms))
        some = lengths[f:] > 0
        largest = np.maximum.reduceat(bucket.values[at], starts[f:][some]) if some.any() else np.zeros(0)
        beyond = float((self.gains[f:][some] * largest).sum())        # coordinate bounds of the rest
        bound = partial + np.minimum(self.rest * np.sqrt(np.maximum(0.0, bucket.norms ** 2 * up - held)), beyond)
        chosen = np.flatnonzero(bound * up + 1 >= self.threshold)
        if not len(chosen):
            return
        dense[self.places] = self.gains
        scores = bucket.scores(chosen, dense)
        dense[self.places] = 0
        real = scores >= self.threshold
        self._keep(scores[real], bucket.ids[chosen[real]], bucket.unnamed[chosen[real]])

    def _keep(self, scores, ids, unnamed) -> None:
        scores, ids, unnamed = (np.concatenate(pair) for pair in zip(self.best, (scores, ids, unnamed)))
        order = np.lexsort((unnamed, ids, -scores))[:self.k]
        self.best = scores[order], ids[order], unnamed[order]
        if len(order) == self.k:
            self.threshold = max(self.threshold, int(scores[order[-1]]))


def _buckets(batches, size: int) -> Iterator[_Bucket]:
    for batch in batches:
        for start in range(0, batch.num_rows, BUCKET):
            part = batch.slice(start, BUCKET)
            places, offsets = _flat(part.column(2))
            impact, _ = _flat(part.column(3))
            yield _Bucket(part.column(0).to_pylist(), part.column(1).to_numpy(), places, impact, offsets, size)


def _search(shared, k: int):
    schema = pa.schema([("q", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        block, weights, thresholds = shared.value
        queries = [_Query(p, r, weights, t, k) for p, r, t in zip(block.places, block.repeats, thresholds)]
        dense = np.zeros(len(weights), dtype=np.int64)
        for bucket in _buckets(batches, len(weights)):
            for query in queries:
                if query.length > 0:
                    query.meet(bucket, dense)
        out = [(i, block.ids[i], None if unnamed else int(doc), int(score)) for i, query in enumerate(queries) for score, doc, unnamed in zip(*query.best)]
        for start in range(0, len(out), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[start:start + 10_000]), schema)], schema=schema)

    return run


FOUND = "q int, item_id long, doc_id long, score long"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _search_block(docs: DataFrame, block: Queries, k: int) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    known = sc.broadcast(block.vocabulary)
    counts = stored_table(docs.mapInArrow(_count(known), "id long, n long, places array<int>, times array<int>"), "ranked-terms")
    documents, length = counts.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    held = counts.select(F.explode("places").alias("place")).groupBy("place").count().collect()        # one row a term of the block
    weights = np.zeros(len(block.vocabulary), dtype=np.int64)
    for r in held:
        weights[r["place"]] = weight(documents, r["count"])
    shared = sc.broadcast(weights)
    made = counts.filter(F.size("places") > 0).mapInArrow(_vectors(shared, documents, length or 1), "id long, norm double, places array<int>, impacts array<int>")
    spread = F.xxhash64("id", "places")        # copies have one length, hence the further keys
    vectors = stored_table(made.repartitionByRange(F.col("norm").desc(), spread).sortWithinPartitions(F.col("norm").desc()), "ranked-vectors")
    share = max(0.0, 1 - SEED / max(1, vectors.count()))
    cut = vectors.agg(F.percentile_approx("norm", share, 10_000)).first()[0] or 0.0        # a bounded sketch; only thresholds hang on it
    start = sc.broadcast((block, weights, [0] * len(block.ids)))
    longest = _ranked(vectors.filter(F.col("norm") >= cut).mapInArrow(_search(start, k), FOUND), k)
    seeds = longest.groupBy("q").agg(F.max("rank").alias("n"), F.min("score").alias("s")).filter(F.col("n") == k).collect()
    thresholds = [0] * len(block.ids)
    for r in seeds:
        thresholds[r["q"]] = r["s"]
    return _ranked(vectors.mapInArrow(_search(sc.broadcast((block, weights, thresholds)), k), FOUND), k)


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item, equal scores by ascending document id."""
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    asked = items.select(F.col(item_id).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    blocks = max(1, math.ceil((asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / block_bytes))
    result = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for b in range(blocks):
        block = query_block(asked.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect())
        if block.vocabulary:
            found = _search_block(texts, block, k).select("item_id", "rank", "doc_id", "score")
            result = result.unionByName(found) if blocks == 1 else result.unionByName(stored_table(found, "ranked-found"))
    return result
