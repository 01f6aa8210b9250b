"""NumPy helpers that work on the buffers of an Arrow string column.

Everything here is per batch and allocates in proportion to a slice of at most
``SLICE_BYTES`` (or one text, if that is longer). Words are maximal runs of
bytes outside ``[\\x20\\x09-\\x0D]``, which is the same in UTF-8 and in code
points.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
U64 = np.uint64
_ROOT = 0x9E3779B97F4A7C15 | 1
_ROOT_INV = pow(_ROOT, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x):
    """Finaliser of splitmix64: a bijection of 64-bit values."""
    x = np.asarray(x, U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def seeded(n: int, seed: int):
    """n pseudo-random 64-bit values that depend on the seed only."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(_ROOT) + U64(seed * 0xD1342543DE82EF95 % (1 << 64)))


BYTE_CODE = seeded(256, 11)


def powers(n: int):
    """Powers 0..n of the rolling base, and of its inverse."""
    kept = worker_cache("powers")
    if len(kept.get("up", ())) <= n:
        for name, base in (("up", _ROOT), ("down", _ROOT_INV)):
            p = np.full(max(2 * n, 1 << 18) + 1, base & 0xFFFFFFFFFFFFFFFF, U64)
            p[0] = 1
            kept[name] = np.multiply.accumulate(p)
    return kept["up"][: n + 1], kept["down"][: n + 1]


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets, limit: int = SLICE_BYTES):
    """Ranges of rows of at most `limit` bytes, or of one longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def words(data, offsets, space=SPACE):
    """Starts and ends of words, and the number of the first word of each row (one more at the end).

    space: a flag for each byte value, true for bytes between words."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = ~space[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def prefix_hash(data):
    """Running sums from which span_hash gets the hash of any span."""
    n = len(data)
    total = np.zeros(n + 1, U64)
    np.cumsum(BYTE_CODE[data] * powers(n)[0][:n], out=total[1:])
    return total


def span_hash(total, starts, ends):
    """64-bit hash of the bytes [start, end) of each span; equal bytes give equal hashes anywhere."""
    h = (total[ends] - total[starts]) * powers(len(total))[1][starts]
    return mix(h ^ (ends - starts).astype(U64) * U64(0xFF51AFD7ED558CCD))


def shingles(hashes, first, k: int, seed: int = 7):
    """Hashes of runs of k words inside each row, and the number of the first run of each row.

    A row with fewer than k words, but one at least, has one run: all its words.
    """
    counts = np.diff(first)
    code = seeded(k, seed)
    n = len(hashes)
    full = np.zeros(max(n - k + 1, 0), U64)
    for j in range(k):
        full += mix(hashes[j : j + len(full)] + code[j]) * (code[j] | U64(1))
    runs = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    start = np.zeros(len(first), np.int64)
    np.cumsum(runs, out=start[1:])
    out = np.empty(int(start[-1]), U64)
    at = np.arange(len(out)) - np.repeat(start[:-1] - first[:-1], runs)
    short = np.flatnonzero((counts < k) & (counts > 0))
    is_short = np.zeros(len(out), bool)
    is_short[start[short]] = True
    out[~is_short] = full[at[~is_short]]
    h = np.zeros(len(short), U64)
    for j in range(k - 1):
        has = counts[short] > j
        h[has] += mix(hashes[first[:-1][short[has]] + j] + code[j]) * (code[j] | U64(1))
    out[start[short]] = h
    return mix(out), start


def normalised(data, starts, ends):
    """Words joined by single spaces (also after the last); their new starts and ends."""
    lengths = ends - starts
    stop = np.cumsum(lengths + 1)
    new_end = stop - 1
    out = np.full(int(stop[-1]) if len(stop) else 0, 0x20, np.uint8)
    take = np.ones(len(out), bool)
    take[new_end] = False
    keep = np.zeros(len(data) + 1, np.int8)
    np.add.at(keep, starts, 1)
    np.add.at(keep, ends, -1)
    out[take] = data[np.cumsum(keep[:-1], dtype=np.int8).astype(bool)]
    return out, new_end - lengths, new_end


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, across tasks."""
    import sys
    import types

    return sys.modules.setdefault(f"_llm_cache_{name}", types.ModuleType(f"_llm_cache_{name}")).__dict__
