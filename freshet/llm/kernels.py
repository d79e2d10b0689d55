"""Array kernels over Arrow batches of texts; every function sees one slice of a batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20        # texts of a batch are worked on in slices of about so many bytes; a longer text is a slice of its own
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_POWERS: list[np.ndarray] = []
_RANDOM = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of consecutive slices of a text column, NULL as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, to, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2 ** 64 and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        inverse = np.uint64(pow(int(_PRIME), -1, 2**64))
        _POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)])) for base in (_PRIME, inverse)]
    return _POWERS[0], _POWERS[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; spans are sorted and do not overlap.  Long slices are hashed piece by piece."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
        piece = data[base:int(ends[to - 1])]
        up, down = _powers(max(SLICE_BYTES, len(piece)) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_RANDOM[piece] * up[:len(piece)], out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _RANDOM[7])
        at = to
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the white-space separated words of a slice; no word crosses a text's border."""
    solid = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[:1], before[1:] = False, solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1:], after[:-1] = False, solid[1:]
    return starts, np.flatnonzero(solid & (~after | edge[1:])) + 1


def owners(offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The text that each place of a slice belongs to."""
    return np.searchsorted(offsets, starts, "right") - 1


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive values."""
    count = max(0, len(h) - n + 1)
    out = np.zeros(count, np.uint64)
    for j in range(n):
        out = mix(out) + h[j:j + count] * _RANDOM[j + 11]
    return mix(out)


def sequence_hash(h: np.ndarray) -> np.uint64:
    return gram_hashes(h, len(h))[0] ^ _RANDOM[100 + min(len(h), 100)]
