"""Byte-level BPE through a sentencepiece model made from a rank file (operator 6).

The model is written out directly: one piece per token of the vocabulary, its
bytes mapped to the characters U+0100 .. U+01FF, its score the negative rank,
with identity normalisation and no white-space handling. The merges that
sentencepiece then does (best score first, leftmost on ties) are those of the
ranks. Each match of the pre-token pattern (`public_tokenizers.PATTERN`) is
encoded by itself, once for all its places in a worker's texts; a match that is
a token as a whole is that token. Decoding maps ids back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from teampulse.llm import vec
from teampulse.llm.tokens import Memory, id_arrays


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [ranks[i] for i in range(len(ranks))]


def mapped(raw: bytes) -> str:
    """One character, U+0100 + b, for each byte b."""
    b = np.frombuffer(raw, np.uint8)
    return np.stack([0xC4 + (b >> 6), 0x80 | (b & 0x3F)], axis=1).astype(np.uint8).tobytes().decode()


def unmapped(text: str) -> bytes:
    return bytes(ord(c) - 0x100 for c in text)


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, raw: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(raw)) + raw


def model_proto(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece model; the id of a token is its rank + 1 (0 is the unknown piece)."""
    # field numbers and enum values of sentencepiece's public model format (fixed values)
    normal, unknown, bpe = 1, 2, 2
    out = [_block(1, _block(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, unknown))]
    for rank, token in enumerate(tokens):
        piece = _block(1, mapped(token).encode()) + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank))
        out.append(_block(1, piece + _number(3, normal)))
    trainer = _number(3, bpe) + _number(4, len(tokens) + 1) + _number(40, 0) + b"".join(_number(f, -1) for f in (41, 42, 43))
    normalizer = _block(1, b"identity") + _block(2, b"") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(out) + _block(2, trainer) + _block(3, normalizer)


class Codec:
    """Encodes texts to ids (little-endian unsigned 32-bit) and decodes them."""

    def __init__(self, path: str):
        import sentencepiece

        self.tokens = read_ranks(path)
        self.rank = {t: i for i, t in enumerate(self.tokens)}
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.LoadFromSerializedProto(model_proto(self.tokens))
        self.memory = Memory(self.encode_pretokens)

    def encode_pretokens(self, pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all, number of ids of each)."""
        raw = [p.encode() for p in pretokens]
        text, ends = mapped(b"".join(raw)), np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw))).tolist()
        ids = self.model.encode([text[a:b] for a, b in zip([0, *ends], ends)], out_type=int, num_threads=1)
        # a pre-token that is a token needs no merges; merges need not lead to it
        ids = [x if len(x) == 1 or r not in self.rank else [self.rank[r] + 1] for x, r in zip(ids, raw)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), "<u4", int(sizes.sum())) - np.uint32(1), sizes

    def encode(self, raw: bytes, offsets) -> tuple[np.ndarray, np.ndarray]:
        """(ids, place of the first id of each text and the end) of UTF-8 texts at byte offsets."""
        return id_arrays(raw, offsets, self.memory)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def codec(path: str) -> Codec:
    """The worker's codec for a rank file."""
    kept = vec.worker_cache("bpe")
    if path not in kept:
        kept[path] = Codec(path)
    return kept[path]


def encoded(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row of docs, and its ids as bytes if asked.

    path: a rank file that every worker can read (default: the installed byte_bpe_50k.tiktoken). Null text reads as
    empty (no ids); repeated rows and null ids get a result each; an empty table gives an empty result.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches):
        own = codec(path)
        for batch in batches:
            data, offsets = vec.buffers(batch.column(1))
            out = ([], [], [], [])
            for i, j in vec.slices(offsets):
                flat, begin = own.encode(data[offsets[i] : offsets[j]].tobytes(), offsets[i : j + 1] - offsets[i])
                for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
                    ids = flat[a:b].tobytes()
                    out[0].append(b - a)
                    out[1].append(hashlib.sha256(ids).hexdigest())
                    out[2].append(hashlib.sha256(own.decode(flat[a:b])).hexdigest())
                    if with_ids:
                        out[3].append(ids)
            columns = [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()),
                       pa.array(out[2], pa.string())] + [pa.array(out[3], pa.binary())] * with_ids
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)
