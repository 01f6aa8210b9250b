"""Cross-entropy difference of documents under a target and a background language model (operator 2).

Both models are interpolated word bigram models of the same form over one
shared vocabulary: lower-cased words (letters, digits, non-ASCII bytes) and
pairs of neighbours in a text, told apart by their full 64-bit hash. The
background model counts all documents; the target model counts the labelled
documents of good quality that are not toxic. A word's probability is

    p(w) = (c(w) + 1) / (N + V)
    p(w | u) = (c(u, w) + MIX * p(w)) / (c(u) + MIX)

with the counts of the respective corpus and V, the number of different words
of all documents. The background's counts are scaled down to the target's number
of words, so that the models are matched in size too. A document's score is the
mean over its words of target loss less background loss, in bits: below 0 it
resembles the target more than the corpus at large.

Nothing is cut and nothing reaches the driver: documents are dealt into parts of
`PART_BYTES` by id; a part counts its own hashes and sends them, sorted, to
buckets of the hash range; a bucket adds up what all parts sent and answers each
with the corpus's counts of the hashes it asked for, in the same order; the part
scores its documents by the answers. Parts and buckets grow in number with the
input, the counts with its vocabulary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.llm import vec
from teampulse.llm.frames import partitions_for

#: Size of the tables of `entries`, `losses` and `document_losses` (the model of small corpora in one process).
WORD_BITS = 18
PAIR_BITS = 20
MIX = 16.0
PART_BYTES = 8 << 20
ANSWER = "part int, kind int, bucket int, target binary, background binary, n_words long, n_target long, n_background long"

_BETWEEN = np.ones(256, bool)
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _BETWEEN[_low:_high] = False


def hashes(data, offsets):
    """(word hashes, hashes of each word with the one before, number of the first word of each row)."""
    data = vec.LOWER[data]
    starts, ends, first = vec.words(data, offsets, _BETWEEN)
    if not len(starts):
        z = np.zeros(0, np.uint64)
        return z, z, first
    h = vec.span_hash(vec.prefix_hash(data), starts, ends)
    before = np.zeros(len(h), np.uint64)
    before[1:] = h[:-1]
    before[first[:-1][first[:-1] < len(h)]] = 0
    return h, vec.mix(before + vec.mix(h) * np.uint64(3)), first


def entries(data, offsets):
    """(word entries, pair entries, number of the first word of each row); a row's first word follows entry 0."""
    h, pair, first = hashes(data, offsets)
    return ((h >> np.uint64(64 - WORD_BITS)).astype(np.int64), (pair >> np.uint64(64 - PAIR_BITS)).astype(np.int64), first)


def losses(counted: DataFrame) -> dict:
    """Tables of both models from counts (entry, target, background) of `entries`."""
    rows = counted.toArrow()
    words = 1 << WORD_BITS
    total = np.zeros((2, words + (1 << PAIR_BITS)))
    at = rows["entry"].to_numpy()
    total[0, at], total[1, at] = rows["target"].to_numpy(), rows["background"].to_numpy()
    total[1] *= shrink(total[:, :words].sum(axis=1))
    n = total[:, :words].sum(axis=1, keepdims=True)
    return {"words": total[:, :words], "pairs": total[:, words:], "p": (total[:, :words] + 1) / (n + words)}


def shrink(sizes) -> float:
    """What the background's counts are multiplied by, from the words of (target, background)."""
    return sizes[0] / sizes[1] if 0 < sizes[0] < sizes[1] else 1.0


def mean_bits(word, pair, p, first):
    """Mean loss of the words of each row: counts of the words and of the pairs they end, and the words' p."""
    n = np.diff(first)
    opens = np.zeros(len(word), bool)
    opens[first[:-1][first[:-1] < len(word)]] = True
    history = np.zeros(len(word))
    history[1:] = word[:-1]
    bits = -np.log2((np.where(opens, 0, pair) + MIX * p) / (np.where(opens, 0, history) + MIX))
    return np.bincount(np.repeat(np.arange(len(n)), n), bits, len(n)) / np.maximum(n, 1)


def document_losses(model: dict, data, offsets):
    """(words, bits under the target, bits under the background) of each row of a byte buffer; 0 bits without words."""
    w, p, first = entries(data, offsets)
    return [np.diff(first), *(mean_bits(model["words"][k][w], model["pairs"][k][p], model["p"][k][w], first) for k in range(2))]


def part_hashes(column):
    """hashes() of a whole column, in slices."""
    data, offsets = vec.buffers(column)
    found = [hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in vec.slices(offsets)]
    if not found:
        z = np.zeros(0, np.uint64)
        return z, z, np.zeros(1, np.int64)
    n = np.concatenate([np.diff(f) for _, _, f in found])
    return np.concatenate([h for h, _, _ in found]), np.concatenate([p for _, p, _ in found]), np.concatenate([[0], np.cumsum(n)])


def distinct(h, pair, first):
    """[(sorted distinct hashes, place of each occurrence, occurrence's word)] of the words, and of the pairs inside a row."""
    inside = np.ones(len(h), bool)
    inside[first[:-1][first[:-1] < len(h)]] = False
    out = []
    for x, at in ((h, np.arange(len(h))), (pair[inside], np.flatnonzero(inside))):
        out.append((*np.unique(x, return_inverse=True), at))
    return out


def limits(sorted_hashes, buckets: int):
    """Where each bucket's range of hashes begins, and the end."""
    edges = np.array([(b << 64) // buckets for b in range(buckets)], np.uint64)
    return np.append(np.searchsorted(sorted_hashes, edges), len(sorted_hashes))


def packed(values) -> bytes:
    """64-bit values byte by byte, all highest bytes first: small and sorted values compress."""
    return np.ascontiguousarray(values).astype(np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes):
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(">u8").ravel().astype(np.uint64)


def spread_ids(n: int):
    """n ints that Spark's hash partitioning (Murmur3, seed 42) deals to n partitions, one each."""
    out, missing, low = np.full(n, -1, np.int64), n, 0
    while missing:
        v = np.arange(low, low + 8 * n, dtype=np.uint64)
        m, low = np.uint64(0xFFFFFFFF), low + 8 * n
        turn = lambda x, r: ((x << np.uint64(r)) | (x >> np.uint64(32 - r))) & m
        h = np.uint64(42) ^ turn(v * np.uint64(0xCC9E2D51) & m, 15) * np.uint64(0x1B873593) & m
        h = (turn(h, 13) * np.uint64(5) + np.uint64(0xE6546B64)) & m ^ np.uint64(4)
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor) & m
        at = h.astype(np.uint32).view(np.int32).astype(np.int64) % n
        new, where = np.unique(at, return_index=True)
        new, where = new[out[new] < 0], where[out[new] < 0]
        out[new] = v[where].astype(np.int64)
        missing -= len(new)
    return out.tolist()


def cross_entropy_difference(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_words, target_bits, background_bits, score) of each row of docs.

    Null text reads as empty; a text without words has bits and score 0. Repeated rows and null ids get a result each
    (null ids are in the background only). Without target rows the target model is the uniform prior. An empty table
    gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType
    texts = docs.select("doc_id", "text")
    n = partitions_for(docs, PART_BYTES, floor=8)
    ids = spread_ids(n)

    def dealt(key):
        return F.element_at(F.lit(ids), (F.pmod(key, F.lit(n)) + 1).cast("int")).cast("int").alias("part")

    of_id = F.xxhash64("doc_id")
    target = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast(kind).alias("doc_id"))
              .agg((F.coalesce(F.min("quality"), F.lit(0)) == 1).alias("good"), (F.max("toxic") == 1).alias("toxic"))
              .where(F.col("good") & ~F.coalesce("toxic", F.lit(False)))
              .select(dealt(of_id), "doc_id").repartition(n, "part"))
    # null ids are dealt out by text; both cogroups below read this one exchange
    texts = texts.select(dealt(F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(of_id)),
                         "doc_id", "text").repartition(n, "part")

    def count(key, rows: pa.Table, targets: pa.Table) -> pa.Table:
        """Own counts of a part, cut by bucket; every bucket gets a row of either kind."""
        out = []
        if rows.num_rows:
            aimed = pc.is_in(rows["doc_id"], value_set=targets["doc_id"].combine_chunks()).to_numpy()
            h, pair, first = part_hashes(rows["text"])
            aimed = np.repeat(aimed, np.diff(first))
            for k, (u, place, at) in enumerate(distinct(h, pair, first)):
                all_, own = np.bincount(place, minlength=len(u)), np.bincount(place[aimed[at]], minlength=len(u))
                cut = limits(u, n)
                out += [(ids[b], key[0].as_py(), k, packed(u[i:j]), packed(own[i:j]), packed(all_[i:j]))
                        for b, (i, j) in enumerate(zip(cut[:-1], cut[1:]))]
        return pa.table([pa.array(c, t.type) for c, t in zip(zip(*out) if out else [[]] * 6, counted_schema)], schema=counted_schema)

    counted_schema = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("kind", pa.int32()), ("hashes", pa.binary()),
                                ("target", pa.binary()), ("background", pa.binary())])
    asked = texts.groupBy("part").cogroup(target.groupBy("part")).applyInArrow(
        count, "bucket int, part int, kind int, hashes binary, target binary, background binary").repartition(n, "bucket")

    def add(rows: pa.Table) -> pa.Table:
        """The corpus's counts of the hashes that each part sent to a bucket, and the sums over its words."""
        out = []
        for k in (0, 1):
            own = rows.filter(pc.equal(rows["kind"], k))
            sent = [unpacked(x) for x in own["hashes"].to_pylist()]
            if not sent:
                continue
            u, place = np.unique(np.concatenate(sent), return_inverse=True)
            sums = [np.bincount(place, np.concatenate([unpacked(x) for x in own[c].to_pylist()]).astype(float), len(u))
                    for c in ("target", "background")]
            totals = (len(u), int(sums[0].sum()), int(sums[1].sum())) if k == 0 else (0, 0, 0)
            ends = np.cumsum([len(x) for x in sent])
            for part, bucket, size, end in zip(own["part"].to_pylist(), own["bucket"].to_pylist(), map(len, sent), ends):
                at = place[end - size : end]
                out.append((part, k, bucket, packed(sums[0][at]), packed(sums[1][at]), *totals))
        return pa.table([pa.array(c, t.type) for c, t in zip(zip(*out) if out else [[]] * 8, answer_schema)], schema=answer_schema)

    answer_schema = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("target", pa.binary()),
                               ("background", pa.binary()), ("n_words", pa.int64()), ("n_target", pa.int64()),
                               ("n_background", pa.int64())])
    answers = asked.groupBy("bucket").applyInArrow(add, ANSWER).repartition(n, "part")
    order = {b: i for i, b in enumerate(ids)}

    def score(rows: pa.Table, answered: pa.Table) -> pa.Table:
        h, pair, first = part_hashes(rows["text"])
        v, *sizes = (sum(answered[c].to_pylist()) for c in ("n_words", "n_target", "n_background"))
        found = distinct(h, pair, first)
        given = sorted(zip(answered["kind"].to_pylist(), map(order.get, answered["bucket"].to_pylist()), range(answered.num_rows)))
        bits = []
        for column, factor, size in (("target", 1.0, sizes[0]), ("background", shrink(sizes), sizes[1])):
            cells, per = answered[column].to_pylist(), []
            for k, (u, place, at) in enumerate(found):
                counts = np.concatenate([np.zeros(0, np.uint64), *(unpacked(cells[r]) for kk, _, r in given if kk == k)])
                assert len(counts) == len(u)
                c = np.zeros(len(h))
                c[at] = counts[place] * factor
                per.append(c)
            bits.append(mean_bits(*per, (per[0] + 1) / (size * factor + v), first) if len(h) else np.zeros(rows.num_rows))
        t, b = bits
        return pa.table({"doc_id": rows["doc_id"], "n_words": pa.array(np.diff(first).astype(np.int64)),
                         "target_bits": t, "background_bits": b, "score": t - b})

    return texts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        score, f"doc_id {kind.simpleString()}, n_words long, target_bits double, background_bits double, score double")
