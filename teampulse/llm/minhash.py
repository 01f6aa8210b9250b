"""One-permutation MinHash fingerprints (operator 4).

Every word shingle is hashed once; its top bits choose one of `BINS` bins, the
rest is its value, and a bin keeps its smallest value. An empty bin copies the
bin that a fixed random sequence of its own reaches first (optimal
densification), so equal bins of two sketches stay a fair draw of the Jaccard
similarity. The low `BITS` bits of every bin are packed into the fingerprint.
Two unequal values agree on those bits with chance c = 2^-BITS, so the share of
equal bins m is corrected to (m - c) / (1 - c).

A text without words has no bins: its fingerprint is the empty string, with
likeness 1 to another such and 0 to any other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.llm import vec
from teampulse.llm.frames import partitions_for
from teampulse.operators.ranking import positions

SHINGLE = 5
BINS = 512
BITS = 4
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketches(data, offsets, k: int = SHINGLE, bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """(bin values (rows x bins, uint64) after densification, rows with words) of a byte buffer."""
    parts = [_bins(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k, bins) for i, j in vec.slices(offsets)]
    if not parts:
        return np.zeros((0, bins), np.uint64), np.zeros(0, bool)
    table, has = np.concatenate([t for t, _ in parts]), np.concatenate([h for _, h in parts])
    _densify(table, has)
    return table, has


def _bins(data, offsets, k: int, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin values, rows with words); empty bins hold _EMPTY."""
    rows = len(offsets) - 1
    starts, ends, first = vec.words(data, offsets)
    table = np.full(rows * bins, _EMPTY, np.uint64)
    if len(starts):
        h, begin = vec.shingles(vec.span_hash(vec.prefix_hash(data), starts, ends), first, k)
        shift = np.uint64(64 - int(bins).bit_length() + 1)
        at = (h >> shift).astype(np.int64) + np.repeat(np.arange(rows), np.diff(begin)) * bins
        np.minimum.at(table, at, h & ((np.uint64(1) << shift) - np.uint64(1)))
    return table.reshape(rows, bins), np.diff(first) > 0


#: Bins that an empty bin looks at in its own fixed order; rows with fewer filled bins use the order's inverse.
ATTEMPTS = 1 << 14
FEW = 64


def _orders(bins: int):
    """(bin that each bin looks at, by attempt; first attempt at which bin b looks at bin j, by (b, j))."""
    kept = vec.worker_cache("minhash")
    if bins not in kept:
        column = np.arange(bins, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        steps = np.arange(ATTEMPTS, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        looks = np.stack([(vec.mix(column + s) % np.uint64(bins)).astype(np.int16) for s in steps])
        first = np.full((bins, bins), ATTEMPTS, np.int16)
        for attempt in range(ATTEMPTS - 1, -1, -1):
            first[np.arange(bins), looks[attempt]] = attempt
        kept[bins] = looks[:4096].copy(), first
    return kept[bins]


def _densify(table, has):
    filled = table != _EMPTY
    counts, bins = filled.sum(axis=1), table.shape[1]
    looks, first = _orders(bins)
    for r in np.flatnonzero(has & (counts < FEW)).tolist():
        full = np.flatnonzero(filled[r])
        source = full[first[:, full].argmin(axis=1)]
        table[r] = np.where(filled[r], table[r], table[r, source])
    row, column = np.nonzero(~filled & (counts >= FEW)[:, None])
    attempt = 0
    while len(row):  # about bins / counts attempts for most
        source = looks[attempt][column].astype(np.int64)
        hit = filled[row, source]
        table[row[hit], column[hit]] = table[row[hit], source[hit]]
        row, column = row[~hit], column[~hit]
        attempt += 1


def pack(table, has, bits: int = BITS) -> list[str]:
    """Hex strings of the low `bits` (1, 2, 4 or 8) of every bin; '' for rows without words."""
    low = (table & np.uint64((1 << bits) - 1)).astype(np.uint8)
    per = 8 // bits
    packed = np.zeros((len(low), low.shape[1] // per), np.uint8)
    for j in range(per):
        packed |= low[:, j::per] << np.uint8(8 - bits * (j + 1))
    return [p.tobytes().hex() if ok else "" for p, ok in zip(packed, has)]


def likeness(a, a_has, b, b_has, bits: int = BITS) -> np.ndarray:
    """Corrected share of equal low bits of rows of two sketch tables, 0 to 1."""
    mask, c = np.uint64((1 << bits) - 1), 2.0 ** -bits
    same = (((a ^ b) & mask) == 0).mean(axis=1)
    value = np.clip((same - c) / (1 - c), 0, 1)
    return np.where(a_has & b_has, value, (a_has == b_has).astype(float))


def likeness_of(x: str, y: str, bits: int = BITS) -> float:
    """Likeness of two stored fingerprints."""
    if not x or not y:
        return float(x == y)
    def nibbles(s):
        raw = np.unpackbits(np.frombuffer(bytes.fromhex(s), np.uint8)).reshape(-1, bits)
        return raw
    same = (nibbles(x) == nibbles(y)).all(axis=1).mean()
    return float(np.clip((same - 2.0 ** -bits) / (1 - 2.0 ** -bits), 0, 1))


def fingerprint_texts(texts: list[str]) -> list[str]:
    data, offsets = vec.buffers(pa.array(texts, pa.large_string()))
    return pack(*sketches(data, offsets))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of each row; null text reads as empty. One pass, no shuffle."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprint_texts(texts), pa.string())],
                                             ["id", "fingerprint"])

    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, fingerprint string")


#: Keys sampled for each range.
SAMPLED = 32


def _bounds(docs: DataFrame, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and ties of keys that cut docs into about `parts` ranges, in order: every SAMPLED-th of a sample of the keys,
    chosen by their hash and numbered by `positions`. 16 bytes for each range reach the driver."""
    n = docs.count()
    share = min(1 << 20, (SAMPLED * parts << 20) // max(n, 1) + 1)
    few = docs.where(F.pmod(F.xxhash64("id", "tie", F.lit(1)), F.lit(1 << 20)) < share).select("id", "tie", F.lit(0).alias("zero"))
    step = max(1, min(SAMPLED, n // parts))
    nth = positions(few, [], "zero", [F.col("id").asc(), F.col("tie").asc()], row_number="nth")
    cuts = nth.where(F.col("nth") % step == 0).select("id", "tie").distinct().collect() if parts > 1 else []
    cuts = sorted(tuple(r) for r in cuts)
    return np.array([c[0] for c in cuts], np.int64), np.array([c[1] for c in cuts], np.int64)


def ranks(ids, ties, id, tie) -> np.ndarray:
    """How many of the keys (ids, ties), which are sorted, are at or before each (id, tie)."""
    low, high = np.searchsorted(ids, id, "left"), np.searchsorted(ids, id, "right")
    out = high.copy()
    for run in np.unique(low[high > low]).tolist():
        rows = np.flatnonzero((low == run) & (high > low))
        out[rows] = run + np.searchsorted(ties[run : high[rows[0]]], tie[rows], "right")
    return out


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """(bucket, extra, id, tie, text): the rows dealt by ranges of (id, tie), each range also getting the first row of
    the next.

    The last range gets the first row of all. A range's copies have `extra` true and sort last. Range bounds are keys
    that occur, so the first row of a range is found by equality: one shuffle of the texts, and an extra row for each
    range. The tie is a hash of the text, so rows that share an id fall into many ranges.
    """
    parts = parts or partitions_for(docs, 16 << 20)
    docs = docs.withColumn("tie", F.xxhash64("text"))
    first = docs.agg(F.min(F.struct("id", "tie")).alias("key")).first()["key"]
    low = tuple(first) if first else (0, 0)
    ids, ties = _bounds(docs, parts)
    inner = ~((ids == low[0]) & (ties == low[1]))
    ids, ties = ids[inner], ties[inner]
    last = len(ids)

    @F.pandas_udf("bucket int, before int")
    def place(id: pd.Series, tie: pd.Series) -> pd.DataFrame:
        """The row's range, and the range before it if the row begins its own."""
        id, tie = id.to_numpy(), tie.to_numpy()
        bucket = ranks(ids, ties, id, tie)
        begins = np.where((id == low[0]) & (tie == low[1]), last, -1)
        if last:
            own = np.maximum(bucket - 1, 0)
            begins = np.where((bucket > 0) & (ids[own] == id) & (ties[own] == tie), own, begins)
        return pd.DataFrame({"bucket": bucket.astype("int32"), "before": begins.astype("int32")})

    placed = docs.withColumn("p", place("id", "tie"))
    dealt = placed.select("id", "tie", "text", F.explode(F.filter(F.array(
        F.struct(F.col("p.bucket").alias("bucket"), F.lit(False).alias("extra")),
        F.struct(F.col("p.before").alias("bucket"), F.lit(True).alias("extra"))), lambda d: d["bucket"] >= 0)).alias("d"))
    return dealt.select("d.bucket", "d.extra", "id", "tie", "text").repartitionById(last + 1, "bucket")


def edited(text: str, following: str) -> str:
    """text with its last floor(n/4) code points replaced by the first as many (or all) of the next text."""
    q = len(text) // 4
    return text[: len(text) - q] + following[:q]


_OUT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def _emit(ids, texts):
    """Result rows of texts[:-1]; each text is followed by its next."""
    edits = [edited(t, u) for t, u in zip(texts, texts[1:])]
    data, offsets = vec.buffers(pa.array(texts + edits, pa.large_string()))
    table, has = sketches(data, offsets)
    n = len(edits)
    own, after, edit = slice(0, n), slice(1, n + 1), slice(n + 1, None)
    names = [x.split()[0] for x in _OUT.split(", ")]
    return pa.RecordBatch.from_arrays([
        pa.array(ids[:n], pa.int64()), pa.array([len(t) for t in texts[:n]], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edits]),
        pa.array(pack(table[own], has[own])), pa.array(pack(table[edit], has[edit])),
        pa.array(likeness(table[own], has[own], table[edit], has[edit])),
        pa.array(likeness(table[own], has[own], table[after], has[after]))], names)


def edit_probe(docs: DataFrame, parts: int | None = None, flush_chars: int = 1 << 20) -> DataFrame:
    """Fingerprints of each document and of its edited text, with their likeness and that to the next document.

    Documents follow each other by id, then a hash of the text, then text (rows that repeat an id keep their own
    results); null ids come first, and after the last comes the first. A single document follows itself. Null text reads as empty; an empty
    table gives an empty result; other columns are not used.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    low, nulls = docs.agg(F.min("id"), F.count_if(F.col("id").isNull())).first()
    if not nulls:
        return _probe(with_next(docs, parts), flush_chars)
    stand_in = -1 if low is None else low - 1  # null ids take a place below the smallest id
    probed = _probe(with_next(docs.withColumn("id", F.coalesce("id", F.lit(stand_in))), parts), flush_chars)
    return probed.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(stand_in), F.col("doc_id")))


def _probe(dealt: DataFrame, flush_chars: int) -> DataFrame:
    ordered = dealt.sortWithinPartitions("bucket", "extra", "id", "tie", "text")

    def run(batches):
        ids, texts, chars, bucket, ended = [], [], 0, None, False
        for batch in batches:
            for b, extra, i, t in zip(*(batch.column(c).to_pylist() for c in (0, 1, 2, 4))):
                if b != bucket:
                    ids, texts, chars, bucket, ended = [], [], 0, b, False
                if ended:
                    continue  # only the first copy of the next range counts
                ids.append(i)
                texts.append(t)
                chars += len(t)
                ended = extra
                if len(texts) > 1 and (ended or chars >= flush_chars):
                    yield _emit(ids, texts)
                    ids, texts, chars = ids[-1:], texts[-1:], len(t)

    return ordered.mapInArrow(run, _OUT)
