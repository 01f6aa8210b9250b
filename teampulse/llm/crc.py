"""CRC-32 of many byte spans at once, from a table by byte and distance from the end of the span.

CRC-32 is linear over XOR: a span's value is the XOR of one precomputed word for each of its bytes, which depends on
the byte and its distance from the end only, and of a constant for its length. Spans over ``BLOCK`` bytes are cut into
blocks counted from their end; the blocks' sums are folded one after the other, each step moving the running value past
``BLOCK`` bytes by four entries of the same table.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 64
_POLY = 0xEDB88320
_ONES = 0xFFFFFFFF


def _table():
    """[distance from the end, byte]: what the byte adds to the CRC register, starting from zero."""
    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = (first >> np.uint32(1)) ^ (np.uint32(_POLY) * (first & np.uint32(1)))
    rows = [first]
    for _ in range(BLOCK - 1):
        rows.append((rows[-1] >> np.uint32(8)) ^ first[rows[-1] & np.uint32(255)])
    return np.stack(rows)


TABLE = _table()
_FLAT = TABLE.ravel()
#: crc32 of n zero bytes, n up to BLOCK: the part of a span's value that its length alone decides.
LENGTH = np.array([zlib.crc32(bytes(n)) for n in range(BLOCK + 1)], np.uint32)


def _past_a_block(state):
    """The register after BLOCK zero bytes."""
    s = state.astype(np.uint32)
    out = TABLE[BLOCK - 1][s & np.uint32(255)]
    for i in (1, 2, 3):
        out = out ^ TABLE[BLOCK - 1 - i][(s >> np.uint32(8 * i)) & np.uint32(255)]
    return out


def crc32_spans(data, starts, ends):
    """zlib.crc32 of the bytes [start, end) of each span. Spans are in order and don't overlap; none is empty."""
    if not len(starts):
        return np.zeros(0, np.uint32)
    lengths = ends - starts
    blocks = (lengths + BLOCK - 1) // BLOCK
    span_at = np.zeros(len(starts) + 1, np.int64)  # places of the spans' bytes when laid side by side
    np.cumsum(lengths, out=span_at[1:])
    place = np.arange(span_at[-1]) + np.repeat(starts - span_at[:-1], lengths)
    distance = np.repeat(ends - 1, lengths) - place
    added = _FLAT[((distance % BLOCK) << 8) | data[place]]
    first = (lengths - 1) % BLOCK + 1  # the block at the front takes what is left over
    number = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(blocks, out=number[1:])
    nth = np.arange(number[-1]) - np.repeat(number[:-1], blocks)
    begins = np.repeat(span_at[:-1], blocks) + np.where(nth == 0, 0, np.repeat(first, blocks) + (nth - 1) * BLOCK)
    sums = np.bitwise_xor.reduceat(added, begins)

    state = sums[number[:-1]] ^ LENGTH[first] ^ np.uint32(_ONES)
    long = np.flatnonzero(blocks > 1)
    step = 1
    while len(long):
        state[long] = _past_a_block(state[long]) ^ sums[number[long] + step]
        step += 1
        long = long[blocks[long] > step]
    return state ^ np.uint32(_ONES)
