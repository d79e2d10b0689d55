"""Byte-level BPE: texts to token ids and back, as numpy matrices over whole Arrow batches.

A slice of texts is cut into pieces by the published pattern, written here as run boundaries of character classes.  Equal pieces are
encoded once: pieces not met before are grouped by length into padded matrices of byte tokens, every row of a matrix merges its
leftmost pair of least rank each round, pair ranks come from a hashed table, and finished rows and used columns are compacted
away.  A worker keeps the pieces that it has encoded, up to a bound, and forgets them all when the bound is reached.

Defined cases: NULL and empty texts have no tokens.  A text of any length is encoded whole; it is worked on in slices that end
before white space that follows other characters, where the pattern never continues a piece.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from freshet.llm.kernels import mix, slices, span_hashes

# white space of the pattern: fixed values, the Unicode property White_Space
WHITE_SPACE = [0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# endings that the pattern cuts off after an apostrophe: fixed values
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]
OTHER, LETTER, NUMBER, SPACE = range(4)
NONE = np.int32(2**31 - 1)
LONG = 512        # bytes; a longer piece is merged with a heap, in n log n steps
MATRIX = 1 << 18        # cells of a matrix
KEPT = 1 << 18        # pieces that a worker remembers
TEXT_SLICE = 1 << 20


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    table = np.zeros(sys.maxunicode + 1, np.uint8)
    for i in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(i))[0]
        if kind == "L":
            table[i] = LETTER
        elif kind == "N":
            table[i] = NUMBER
    table[WHITE_SPACE] = SPACE
    return table


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places in ``points`` (code points of texts put together) where a piece of the pattern begins.

    ``first`` marks the first character of each text.  A piece is a run of one class with one plain space before it, a run of
    white space without the last one if something follows, or an apostrophe with one of the endings.
    """
    n = len(points)
    kind = character_classes()[points]
    change = first.copy()
    change[1:] |= kind[1:] != kind[:-1]
    is_space = kind == SPACE
    last = np.ones(n, bool)
    last[:-1] = first[1:]
    starts = change.copy()
    # the last white space before other characters begins a piece of its own, which a plain space shares with what follows
    solid_next = np.zeros(n, bool)
    solid_next[:-1] = ~is_space[1:] & ~first[1:]
    closing = is_space & solid_next
    starts |= closing
    joined = np.flatnonzero(closing & (points == 32)) + 1
    starts[joined] = False
    # an apostrophe that begins a piece, with an ending: what comes after the ending begins a piece too
    for at in np.flatnonzero((points == 39) & change & starts & ~last)[:, None]:
        i = int(at[0])
        for ending in ENDINGS:
            m = len(ending)
            if i + m < n and all(points[i + 1 + j] == ord(c) for j, c in enumerate(ending)) and not first[i + 1:i + 1 + m].any():
                starts[i + 1:i + 1 + m] = False
                if i + 1 + m < n:
                    starts[i + 1 + m] = True
                break
    return np.flatnonzero(starts)


class Vocabulary:
    """Ranks of byte strings, with the tables that encoding and decoding look things up in."""

    def __init__(self, path: str):
        pieces: list[bytes] = []
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.size = max(ranks.values()) + 1
        pieces = [b""] * self.size
        for piece, rank in ranks.items():
            pieces[rank] = piece
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        left, right, merged = [], [], []
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                a, b = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        self._hash_pairs(np.array(left, np.int64) << 32 | np.array(right, np.int64), np.array(merged, np.int32))
        self.bytes, self.byte_at, self.byte_len = _flat(pieces)
        self.digits, self.digit_at, self.digit_len = _flat([b"%d " % i for i in range(self.size)])

    def _hash_pairs(self, pairs: np.ndarray, merged: np.ndarray) -> None:
        """Open addressing: a pair lies at its slot or one of the next ``self.probes`` slots."""
        self.mask = np.int64((1 << max(4, int(len(pairs) * 4).bit_length())) - 1)
        self.pairs = np.full(int(self.mask) + 1, -1, np.int64)
        self.merged = np.full(int(self.mask) + 1, NONE, np.int32)
        slot, self.probes = self._slot(pairs), 0
        while len(pairs):
            self.probes += 1
            free = self.pairs[slot] == -1
            _, winner = np.unique(np.where(free, slot, -1), return_index=True)
            winner = winner[free[winner]]
            self.pairs[slot[winner]], self.merged[slot[winner]] = pairs[winner], merged[winner]
            rest = np.ones(len(pairs), bool)
            rest[winner] = False
            pairs, merged, slot = pairs[rest], merged[rest], (slot[rest] + 1) & self.mask

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return (mix(pairs.view(np.uint64)) & np.uint64(self.mask)).astype(np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each merged pair, ``NONE`` where the pair does not merge."""
        pairs = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slot = self._slot(pairs)
        held = self.pairs[slot]
        out = np.where(held == pairs, self.merged[slot], NONE)
        missing = np.flatnonzero((held != pairs) & (held != -1))
        for _ in range(self.probes - 1):
            if not len(missing):
                break
            slot[missing] = (slot[missing] + 1) & self.mask
            held = self.pairs[slot[missing]]
            hit = held == pairs[missing]
            out[missing[hit]] = self.merged[slot[missing[hit]]]
            missing = missing[~hit & (held != -1)]
        return out

    def merge_rows(self, rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of byte rows padded on the right: (rows, width) bytes and their true lengths."""
        n, width = rows.shape
        done_ids, done_len = np.full((n, width), -1, np.int32), lengths.astype(np.int64).copy()
        ids = self.byte_ids[rows]
        ids[np.arange(width)[None, :] >= lengths[:, None]] = -1
        if width == 1:
            return ids, done_len
        place, live = np.arange(n), lengths.astype(np.int64).copy()
        rank = np.full((n, width - 1), NONE, np.int32)
        real = ids[:, 1:] >= 0
        rank[real] = self.rank_of(ids[:, :-1][real], ids[:, 1:][real])
        while len(place):
            at = rank.argmin(axis=1)
            row = np.arange(len(place))
            best = rank[row, at]
            over = best == NONE
            if over.any():
                done_ids[place[over], :ids.shape[1]] = ids[over]
                done_len[place[over]] = live[over]
                go = ~over
                place, live, ids, rank, at, best = place[go], live[go], ids[go], rank[go], at[go], best[go]
                if not len(place):
                    break
                most = int(live.max())        # used columns only
                ids, rank = ids[:, :most], rank[:, :most - 1]
                row = np.arange(len(place))
            # each row closes the gap that its merge leaves
            column = np.arange(ids.shape[1] - 1)[None, :]
            after = column > at[:, None]
            ids[row, at] = best
            ids[:, :-1] = np.where(after, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            live -= 1
            if rank.shape[1] > 1:
                rank[:, :-1] = np.where(column[:, :-1] >= at[:, None], rank[:, 1:], rank[:, :-1])
            rank[:, -1] = NONE
            for side in (at - 1, at):
                ok = (side >= 0) & (side + 1 < live)
                r, s = row[ok], side[ok]
                rank[r, s] = self.rank_of(ids[r, s], ids[r, s + 1])
                gone = (side >= 0) & (side + 1 >= live) & (side < rank.shape[1])
                rank[row[gone], side[gone]] = NONE
        return done_ids, done_len

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece, with a linked list and a heap of (rank, place)."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        known: dict[tuple[int, int], int] = {}

        def rank(a: int, b: int) -> int:
            if (a, b) not in known:
                known[a, b] = int(self.rank_of(np.array([a]), np.array([b]))[0])
            return known[a, b]

        first = self.rank_of(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or rank(ids[i], ids[j]) != r:
                continue
            ids[i], alive[j], after[i] = r, False, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n:
                    pair = rank(ids[a], ids[after[a]])
                    if pair != NONE:
                        heapq.heappush(heap, (pair, a))
        return np.array([v for v, ok in zip(ids, alive) if ok], np.int32)

    def encode_pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, count of each piece) for pieces of bytes given by their places."""
        size = ends - starts
        count = np.zeros(len(starts), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        bucket = np.maximum(2, 2 ** np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
        for width in np.unique(bucket).tolist():
            chosen = np.flatnonzero(bucket == width)
            if width > LONG:
                for i in chosen.tolist():
                    ids = self.merge_long(data[starts[i]:ends[i]].tobytes())
                    count[i] = len(ids)
                    parts.append((np.full(len(ids), i), ids))
                continue
            step = max(1, MATRIX // width)
            for a in range(0, len(chosen), step):
                some = chosen[a:a + step]
                places = starts[some][:, None] + np.arange(width)[None, :]
                rows = data[np.minimum(places, len(data) - 1)]
                ids, length = self.merge_rows(rows, size[some])
                count[some] = length
                real = np.arange(width)[None, :] < length[:, None]
                parts.append((np.repeat(some, length), ids[real]))
        owner = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
        flat = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int32)
        return flat[np.argsort(owner, kind="stable")], count

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.bytes, self.byte_at[ids], self.byte_len[ids])


def _flat(items: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(x) for x in items], np.int64)
    return np.frombuffer(b"".join(items), np.uint8), np.cumsum(size) - size, size


def gather(values: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches ``values[at:at + size]`` one after the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(at - ends + size, size) + np.arange(total)]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Encodes slices of texts and remembers pieces; two 64-bit hashes tell pieces apart."""

    def __init__(self, path: str):
        self.vocabulary = vocabulary(path)
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)        # sorted by the first
        self.at, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray, check: np.ndarray) -> None:
        if len(self.hashes) + len(h) > KEPT:
            self._forget()
        ids, count = self.vocabulary.encode_pieces(data, starts, ends)
        at = len(self.ids) + np.cumsum(count) - count
        order = np.argsort(merged := np.concatenate([self.hashes, h]), kind="stable")
        self.hashes = merged[order]
        self.check, self.at, self.count = (np.concatenate(p)[order] for p in ((self.check, check), (self.at, at), (self.count, count)))
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, number of ids of each text) for texts of UTF-8 bytes given by their offsets."""
        total = np.zeros(len(offsets) - 1, np.int64)
        if not len(data):
            return np.zeros(0, np.int32), total
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        lead = (data & 0xC0) != 0x80        # first byte of a character
        byte_of = np.flatnonzero(lead)
        first = np.zeros(len(data) + 1, bool)
        first[offsets[:-1]] = True
        starts = byte_of[piece_starts(points, first[byte_of])]
        ends = np.append(starts[1:], len(data))
        h = span_hashes(data, starts, ends)
        check = span_hashes(data[::-1], (len(data) - ends)[::-1], (len(data) - starts)[::-1])[::-1]
        found, which = np.unique(h, return_inverse=True)
        one = np.empty(len(found), np.int64)
        one[which] = np.arange(len(h))
        if not np.array_equal(check[one][which], check):
            raise ArithmeticError("two pieces of a slice share a 64-bit hash")
        where = np.minimum(np.searchsorted(self.hashes, found), max(0, len(self.hashes) - 1))
        known = (self.hashes[where] == found) & (self.check[where] == check[one]) if len(self.hashes) else np.zeros(len(found), bool)
        if not known.all():
            if len(self.hashes) + int((~known).sum()) > KEPT:
                known[:] = False
                self._forget()
            fresh = np.sort(one[~known])
            self._learn(data, starts[fresh], ends[fresh], h[fresh], check[fresh])
            where = np.searchsorted(self.hashes, found)
        at, count = self.at[where][which], self.count[where][which]
        text = np.searchsorted(offsets, starts, "right") - 1
        np.add.at(total, text, count)
        return gather(self.ids, at, count), total


def text_slices(column: pa.Array):
    """Like :func:`kernels.slices`, but a long text comes in several parts; yields (row, parts) or (first, last, bytes, offsets)."""
    for a, b, data, offsets in slices(column, TEXT_SLICE):
        if b - a > 1 or len(data) <= 2 * TEXT_SLICE:
            yield a, b, [(data, offsets)]
            continue
        ascii_space = (data == 32) | ((data >= 9) & (data <= 13))
        # white space that follows another character; what is left of a multi-byte character before it is not white space here only
        # if it is ASCII, so the character before must be ASCII too
        cuts = np.flatnonzero(ascii_space[1:] & ~ascii_space[:-1] & (data[:-1] < 0x80)) + 1
        parts, at = [], 0
        while at < len(data):
            k = np.searchsorted(cuts, at + TEXT_SLICE)
            to = int(cuts[k]) if k < len(cuts) else len(data)
            parts.append((data[at:to], np.array([0, to - at])))
            at = to
        yield a, b, parts


_DIGEST = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _digests(path: str):
    def run(batches):
        encoder = Encoder(path)
        v = encoder.vocabulary
        for batch in batches:
            for a, b, parts in text_slices(batch.column(1)):
                n = np.zeros(b - a, np.int64)
                as_text, as_bytes = [hashlib.sha256() for _ in range(b - a)], [hashlib.sha256() for _ in range(b - a)]
                for data, offsets in parts:
                    ids, count = encoder.encode(data, offsets)
                    digits, decoded = gather(v.digits, v.digit_at[ids], v.digit_len[ids]), v.decode(ids)
                    ends = np.cumsum(count)
                    d_end, b_end = (np.append(0, np.cumsum(size[ids]))[np.append(0, ends)].tolist() for size in (v.digit_len, v.byte_len))
                    for i, c in enumerate(count.tolist()):
                        if c:
                            if n[i]:
                                as_text[i].update(b" ")
                            as_text[i].update(digits[d_end[i]:d_end[i + 1] - 1])
                            as_bytes[i].update(decoded[b_end[i]:b_end[i + 1]])
                            n[i] += c
                yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(n), pa.array([x.hexdigest() for x in as_text]),
                                       pa.array([x.hexdigest() for x in as_bytes])], schema=_DIGEST)
    return run


def _encoded(path: str):
    schema = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        encoder = Encoder(path)
        for batch in batches:
            for a, b, parts in text_slices(batch.column(1)):
                done = [encoder.encode(data, offsets) for data, offsets in parts]
                ids = np.concatenate([d[0] for d in done])
                count = done[0][1] if len(done) == 1 else np.array([sum(int(d[1][0]) for d in done)])
                offsets = np.append(0, np.cumsum(count)).astype(np.int32)
                yield pa.record_batch([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], schema=schema)
    return run


def _decoded(path: str):
    schema = pa.schema([("id", pa.int64()), ("text", pa.string())])

    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            texts = [None if ids is None else v.decode(np.array(ids, np.int64)).tobytes().decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], schema=schema)
    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of every text."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_encoded(path), "id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(id, text) of a table (id, ids)."""
    return encoded.select(F.col("id").cast("long").alias("id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(_decoded(path), "id long, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, SHA-256 of the decimal ids joined by spaces and of the bytes that the ids decode to."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _digests(path), "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
