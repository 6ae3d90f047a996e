"""Words of whole texts, straight from Arrow's UTF-8 buffers.

A task gets its texts as Arrow batches. ``chunks`` hands them on in pieces of
a few megabytes (always whole texts), so the arrays derived from one piece
stay small however many rows a batch has. Null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20
#: For steps whose workers stay beside others in one executor: a quarter of the memory, no slower.
SMALL_CHUNK = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)
_M1, _M2, _SEED = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the n + 1 positions that bound its texts."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    _, bounds, data = col.buffers()
    at = np.frombuffer(bounds, np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of successive runs of whole texts of at most ``limit`` bytes (one text may exceed it)."""
    data, at = text_bytes(col)
    first, n = 0, len(at) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield first, end, data[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end


def hash_spans(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes a step."""
    wide = np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    h = mix(lens.astype(np.uint64) + _SEED)
    live, off = None, 0
    while live is None or len(live):
        at, left = (starts, lens) if live is None else (starts[live] + off, lens[live] - off)
        x = wide[at] & _KEEP[np.minimum(left, 8)]
        if live is None:
            h, live = mix(h ^ x), np.arange(len(starts))
        else:
            h[live] = mix(h[live] ^ x)
        live, off = live[left > 8], off + 8
    return h


def spans(data: np.ndarray, bounds: np.ndarray, gaps: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the maximal runs without white space (or other ``gaps``, a mark per byte), never across texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ink = ~gaps[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[bounds] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, ink[:-1]
    starts = np.flatnonzero(ink & (~before | fresh[:-1]))
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, ink[1:]
    ends = np.flatnonzero(ink & (~after | fresh[1:]))
    return starts, ends - starts + 1


def gram_buckets(data: np.ndarray, bounds: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets (2^bits) of all n-byte grams (n up to 4) inside texts, in order, and how many each text has."""
    sizes = np.maximum(np.diff(bounds) - n + 1, 0)
    if len(data) < n:
        return np.zeros(0, np.uint32), sizes
    wide = np.ndarray((len(data) - n + 1,), "<u4", np.concatenate([data, np.zeros(4, np.uint8)]), strides=(1,))
    grams = (wide & np.uint32((1 << (8 * n)) - 1 & 0xFFFFFFFF)) * np.uint32(2654435761) + np.uint32(n * 40503 << 16 & 0xFFFFFFFF)
    grams = (grams ^ (grams >> np.uint32(15))) * np.uint32(2246822519) >> np.uint32(32 - bits)
    across = np.zeros(len(grams), bool)
    for j in range(1, n):
        at = bounds[1:-1] - j
        across[at[(at >= 0) & (at < len(grams))]] = True
    return grams[~across], sizes


def bucket_sums(weights: np.ndarray, grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per text, the sum of each row of ``weights`` (rows x buckets) over the text's grams: texts x rows."""
    out = np.zeros((len(sizes), len(weights)))
    some = np.flatnonzero(sizes)
    if len(some):
        starts = (np.cumsum(sizes) - sizes)[some]
        for k, w in enumerate(weights):
            out[some, k] = np.add.reduceat(w[grams], starts)
    return out
