"""Harmonic packing of tokenised documents (operator 9).

A document's ids are cut into pieces. Whole sequences of `CAPACITY` ids come
first. What is left, of length r, belongs to class k = floor(CAPACITY / r): k
pieces of that class fill a bin. If they would leave more than `SLACK` ids
empty, the piece CAPACITY // (k + 1) is cut off (an exact share of class k + 1)
and the rest is classed again. Every bin of class k takes exactly k pieces, so
each task fills bins by counting, independently of the others.

At the end of a task the unfilled bins' pieces are chained and cut at the
capacity; the last, shorter chain is cut at powers of two, which need no
padding. A task holds no more than its open bins.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from teampulse.llm import vec
from teampulse.llm.tokens import id_arrays, tokenizer_memory

CAPACITY = 2048
SLACK = CAPACITY // 32
END = 1
#: Sequence numbers of a task start at its number times this.
TASK_STRIDE = 1 << 40

_SCHEMA = ("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long")
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def cut_lengths(n: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document of n ids."""
    out = [(capacity, 1)] * (n // capacity)
    r = n % capacity
    while r:
        k = capacity // r
        if capacity - k * r <= slack:
            out.append((r, k))
            break
        out.append((capacity // (k + 1), k + 1))
        r -= capacity // (k + 1)
    return out


class Packer:
    """Fills the bins of one task; `rows` are the finished (doc, start, length, crc, doc length, sequence, offset)."""

    def __init__(self, first_sequence: int, capacity: int = CAPACITY, slack: int = SLACK):
        self.capacity, self.slack, self.next = capacity, slack, first_sequence
        self.open: dict[int, list] = {}
        self.rows: list[tuple] = []

    def _close(self, pieces):
        at = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next, at))
            at += n
        self.next += 1

    def add(self, doc, ids: bytes):
        """ids: the document's ids, its end mark included, as little-endian unsigned 32-bit integers."""
        total, start = len(ids) // 4, 0
        for length, k in cut_lengths(total, self.capacity, self.slack):
            piece = (doc, start, ids[4 * start : 4 * (start + length)], total)
            start += length
            if k == 1:
                self._close([piece])
                continue
            pieces = self.open.setdefault(k, [])
            pieces.append(piece)
            if len(pieces) == k:
                self._close(self.open.pop(k))

    def finish(self):
        """Pack the pieces of the open bins."""
        rest = [p for k in sorted(self.open) for p in self.open[k]]
        self.open.clear()
        left = sum(len(p[2]) // 4 for p in rest)
        chain, room = [], 0
        while rest:
            if not room:  # begin a sequence: a whole one, or the largest power of two that is left
                room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
                left -= room
            doc, start, ids, total = rest.pop(0)
            n = min(len(ids) // 4, room)
            chain.append((doc, start, ids[: 4 * n], total))
            room -= n
            if 4 * n < len(ids):
                rest.insert(0, (doc, start + n, ids[4 * n :], total))
            if not room:
                self._close(chain)
                chain = []


def packed(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The pieces of all rows of docs: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    path: a tokenizer file that every worker can read (default: the installed byte_bpe_50k.json). Null text reads as
    empty: one piece with the end mark. Repeated rows and null ids are packed each; an empty table gives no pieces.
    A task packs the rows of its input split, in their order, so a repeated task gives the same rows.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    end = np.array([END], "<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext

        memory = tokenizer_memory(path)
        packer = Packer(TaskContext.get().partitionId() * TASK_STRIDE)

        def taken():
            rows, packer.rows = packer.rows, []
            columns = list(zip(*rows)) if rows else [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:])],
                                              _NAMES)

        kind = pa.int64()
        for batch in batches:
            kind = batch.schema.field(0).type
            docs_of = iter(batch.column(0).to_pylist())
            data, offsets = vec.buffers(batch.column(1))
            for i, j in vec.slices(offsets):
                raw = data[offsets[i] : offsets[j]].tobytes()
                ids, begin = id_arrays(raw, offsets[i : j + 1] - offsets[i], memory)
                for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
                    packer.add(next(docs_of), ids[a:b].tobytes() + end)
            yield taken()
        packer.finish()
        yield taken()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {_SCHEMA}")
