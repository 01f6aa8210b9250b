"""SimHash near-duplicates (operator 10): pigeonhole blocks, then Hamming distance.

Fingerprint: 64 bits; bit j is set if it is set in over half of the XXH64
hashes (seed 42) of a text's word shingles, repeats included. Texts are linked
if their fingerprints differ in at most `max_bits` bits; a class is a
connected component of links.

Equal fingerprints are aggregated to one row first, so copies never meet.
Distinct fingerprints are cut into ``max_bits + 2`` blocks: two fingerprints
within `max_bits` bits agree on at least two whole blocks, so every pair of
blocks is a join key (15 keys of about 21 bits for 4). A key that more than
`HOT_KEY` fingerprints share is split again by the same rule over the bits it
does not fix, twice at most; what is left then has 20 free bits, so a group is
bounded by 2^20 fingerprints of 8 bytes. Inside a key every pair is compared
(in blocks of rows), but a key emits no more edges than a spanning forest of
its linked fingerprints needs: no all-pairs output, and no link is lost.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.llm import vec
from teampulse.llm.frames import looked_up, partitions_for, stored
from teampulse.llm.graph import connected_components

SEED = 42
HOT_KEY = 2048
LEVELS = 3


def batch_fingerprints(data, offsets, k: int) -> np.ndarray:
    """Fingerprints (uint64) of the rows of a byte buffer."""
    import xxhash

    hash64 = xxhash.xxh64_intdigest
    out = np.zeros(len(offsets) - 1, np.uint64)
    for i, j in vec.slices(offsets):
        offs = offsets[i : j + 1] - offsets[i]
        piece = vec.LOWER[data[offsets[i] : offsets[j]]]
        starts, ends, first = vec.words(piece, offs)
        if not len(starts):
            continue
        joined, starts, ends = vec.normalised(piece, starts, ends)
        counts = np.diff(first)
        runs = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
        begin = np.zeros(j - i + 1, np.int64)
        np.cumsum(runs, out=begin[1:])
        word = np.arange(begin[-1]) - np.repeat(begin[:-1] - first[:-1], runs)
        last = np.minimum(word + k, np.repeat(first[1:], runs)) - 1
        raw = joined.tobytes()
        h = np.fromiter((hash64(raw[a:b], SEED) for a, b in zip(starts[word].tolist(), ends[last].tolist())),
                        np.uint64, len(word))
        rows = np.flatnonzero(runs)
        out[i + rows] = _majority(h, begin[rows], runs[rows])
    return out


def _majority(h, begin, runs, chunk: int = 1 << 15):
    """Per run of hashes, the bits that are set in over half of them."""
    ones = np.zeros((len(runs), 64), np.int64)
    group = np.repeat(np.arange(len(runs)), runs)
    for at in range(0, len(h), chunk):
        bits = np.unpackbits(h[at : at + chunk].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        g = group[at : at + chunk]
        edge = np.flatnonzero(np.diff(g, prepend=-1))
        ones[g[edge]] += np.add.reduceat(bits, edge, axis=0, dtype=np.int64)
    major = ones * 2 > runs[:, None]
    return np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp: long, text_hash: long) of each row. Null text: as empty; no words: fingerprint zero."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))

    def run(batches):
        for batch in batches:
            data, offsets = vec.buffers(batch.column(1))
            fp = batch_fingerprints(data, offsets, k).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64()), batch.column(2)],
                                             ["id", "fp", "text_hash"])

    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, fp long, text_hash long")


def block_bits(free: int, blocks: int) -> list[int]:
    """Widths of `blocks` near-equal blocks of `free` bits."""
    return [free // blocks + (i < free % blocks) for i in range(blocks)]


def _level_keys(mask: int, max_bits: int):
    """For each pair of blocks of the bits outside `mask`: the bits that a key of both blocks and `mask` fixes."""
    free = [b for b in range(64) if not mask >> b & 1]
    blocks, at = [], 0
    for width in block_bits(len(free), max_bits + 2):
        blocks.append(sum(1 << b for b in free[at : at + width]))
        at += width
    for x, y in combinations(range(max_bits + 2), 2):
        yield mask | blocks[x] | blocks[y]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _exploded(rows: DataFrame, masks: dict, level: int, max_bits: int) -> tuple[DataFrame, dict]:
    """One row per fingerprint and key of the next level. `mask` is the number of a bit set of `masks`."""
    new, choices = {}, []
    for number, bits in masks.items():
        for key_bits in _level_keys(bits, max_bits):
            choices.append((number, len(new), _signed(key_bits)))
            new[len(new)] = key_bits
    lookup = rows.sparkSession.createDataFrame(choices, "mask int, child int, bits long")
    fan = (rows.join(F.broadcast(lookup), "mask") if level else
           rows.withColumn("one", F.explode(F.array(*[F.struct(F.lit(n).alias("child"), F.lit(b).alias("bits"))
                                                      for _, n, b in choices])))
           .select("fp", "one.child", "one.bits"))
    fan = fan.select("fp", F.col("child").alias("mask"), F.col("fp").bitwiseAND(F.col("bits")).alias("key"))
    return fan, new


def _forest(fp: np.ndarray, max_bits: int):
    """Edges (a, b) that join what is linked by pairs within max_bits, no more than len(fp) - 1."""
    parent = np.arange(len(fp))
    rows = max(1, min(16, (1 << 21) // len(fp)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for at in range(0, len(fp), rows):
        near = np.bitwise_count(fp[at : at + rows, None] ^ fp[None, at:]) <= max_bits
        a, b = np.nonzero(near)
        keep = b > a
        a, b = a[keep] + at, b[keep] + at
        if len(a) > len(fp):  # most pairs of a dense group are joined already
            label = np.fromiter(map(root, range(len(fp))), np.int64, len(fp))
            fresh = label[a] != label[b]
            a, b = a[fresh], b[fresh]
        for x, y in zip(a.tolist(), b.tolist()):
            u, v = root(x), root(y)
            if u != v:
                parent[max(u, v)] = min(u, v)
                out.append((x, y))
    return out


def _edges_of_keys(max_bits: int):
    """mapInArrow function over rows sorted by (mask, key): forest edges of each key."""

    def edges(mask, key, fp):
        n = len(fp)
        if n < 2:
            return np.zeros((0, 2), np.int64)
        new = np.flatnonzero((np.diff(mask) != 0) | (np.diff(key) != 0)) + 1
        begin = np.concatenate([[0], new])
        size = np.diff(np.append(begin, n))
        got = []
        two = begin[size == 2]
        near = np.bitwise_count(fp[two] ^ fp[two + 1]) <= max_bits
        got.append(np.stack([fp[two[near]], fp[two[near] + 1]], axis=1).view(np.int64))
        for b, s in zip(begin[size > 2].tolist(), size[size > 2].tolist()):
            group = fp[b : b + s]
            pairs = _forest(group, max_bits)
            if pairs:
                got.append(group[np.array(pairs)].view(np.int64))
        return np.concatenate(got)

    def run(batches):
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            cols = [np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)])
                    for i, h in enumerate(held)]
            if not len(cols[0]):
                continue
            last = np.searchsorted((cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]), True)
            held = [c[last:] for c in cols]
            yield _edge_batch(edges(cols[0][:last], cols[1][:last], cols[2][:last].view(np.uint64)))
        yield _edge_batch(edges(held[0], held[1], held[2].view(np.uint64)))

    return run


def _edge_batch(e):
    return pa.RecordBatch.from_arrays([pa.array(e[:, 0], pa.int64()), pa.array(e[:, 1], pa.int64())], ["a", "b"])


def links(nodes: DataFrame, max_bits: int, hot_key: int = HOT_KEY) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) whose components are those of all links."""
    rows, masks, out = nodes.select("fp"), {0: 0}, None
    parts = partitions_for(nodes)
    for level in range(LEVELS):
        keyed, masks = _exploded(rows, masks, level, max_bits)
        cold = keyed
        if level + 1 < LEVELS:
            hot = stored(keyed.groupBy("mask", "key").count().where(F.col("count") > hot_key).drop("count"), "hot-keys")
            if hot.isEmpty():
                rows = None
            else:
                rows = keyed.join(hot, ["mask", "key"], "left_semi").select("mask", "fp").distinct()
                cold = keyed.join(hot, ["mask", "key"], "left_anti")
        found = (cold.repartition(parts, "mask", "key").sortWithinPartitions("mask", "key", "fp")
                 .select("mask", "key", "fp").mapInArrow(_edges_of_keys(max_bits), "a long, b long"))
        out = found if out is None else out.unionByName(found)
        if level + 1 < LEVELS and rows is None:
            break
    return out.distinct()


def _classed(docs: DataFrame, k: int, max_bits: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """((id, fp, text_hash) of each row; (fp, size, component, component_id) of each different fingerprint)."""
    fps = stored(fingerprints(docs, k, id_col, text_col), "simhash")
    nodes = stored(fps.groupBy("fp").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size")), "simhash-nodes")
    parts = connected_components(links(nodes, max_bits))
    classed = nodes.join(parts, nodes["fp"] == parts["node"], "left").select(
        "fp", "rep", "size", F.coalesce("component", "fp").alias("component"))
    smallest = classed.groupBy("component").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("members"))
    return fps, stored(looked_up(classed, smallest, ["component"], "members").drop("rep"), "simhash-classes")


def near_duplicates(docs: DataFrame, k: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of docs: (id, fp: long, component_id).

    component_id is the smallest id in the row's class (null if the class has no id). Null text reads as empty;
    texts without words have fingerprint zero and link like any other. Repeated rows and ids stay, one result each.
    Other columns are not used. An empty table gives an empty result.
    """
    fps, classes = _classed(docs, k, max_bits, id_col, text_col)
    return looked_up(fps, classes.select("fp", "size", "component_id"), ["fp"], "size").select("id", "fp", "component_id")


def keep_first(docs: DataFrame, k: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of docs (same columns) for each class: of the rows with the smallest doc_id the one with the smallest hash
    of its text, of rows that agree in both one. Where no row of a class has an id, the text's hash decides."""
    fps, classes = _classed(docs, k, max_bits, "doc_id", "text")
    rows = looked_up(fps, classes.select("fp", "size", "component", "component_id"), ["fp"], "size")
    first = (rows.where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("component", "id", "text_hash")
             .agg(F.count(F.lit(1)).alias("times")))
    first = (first.groupBy("component", "id").agg(F.min("text_hash").alias("text_hash"),
                                                  F.min_by("times", "text_hash").alias("times")))
    kept = stored(first.select(F.col("id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash"), "times"), "simhash-kept")
    own = F.xxhash64(docs["text"])

    def of(chosen):
        return docs.join(chosen, docs["doc_id"].eqNullSafe(chosen["_kept_id"]) & (own == chosen["_kept_hash"]), "left_semi")

    # equal rows: copies combine in the task that reads them
    repeated = of(kept.where(F.col("times") > 1)).withColumn("_hash", F.xxhash64("text"))
    return of(kept.where(F.col("times") == 1)).unionByName(repeated.dropDuplicates(["doc_id", "_hash"]).drop("_hash"))
