"""Resampling of documents towards a target text, by hashed n-gram importance.

Features of a text are its runs of 1 to ``max_words`` consecutive words, joined by one space; a feature's bucket is its
CRC-32 (``crc``) modulo the number of buckets. Two passes over the documents: one counts the buckets (each task sends at
most one row per bucket), one adds up the buckets' gains. Gains are one number per bucket, whatever the input, and so
are all that a worker or the driver is sent. The draw is a Gumbel top-k: every document gets a score from its weight and
a hash of its id, and the first k in the order of the scores are taken. Their ranks come from ``positions``: ranges of
the scores with prefix sums, so no task or window holds all documents.

Defined results: a null text has no features, as an empty one; without features the weight is 0; a null id hashes as an
empty one; of equal scores the smaller id goes first, null ids last, and rows that repeat an id stand in some order;
an empty target or corpus counts 0; an empty table gives no rows; further columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.llm import vec
from teampulse.llm.crc import crc32_spans
from teampulse.llm.frames import stored
from teampulse.operators.ranking import positions

BUCKETS = 10_000
#: Between words: ASCII that is neither digit nor letter. All bytes of other characters belong to words.
BETWEEN = np.ones(256, bool)
BETWEEN[0x30:0x3A] = False
BETWEEN[0x41:0x5B] = False
BETWEEN[0x61:0x7B] = False
BETWEEN[0x80:] = False


def features(data, offsets, n_buckets: int = BUCKETS, max_words: int = 1):
    """Buckets of the features of each text, text after text (per text: shorter runs first), the features' number of
    each text, and its number of words."""
    data = vec.LOWER[data]
    starts, ends, first = vec.words(data, offsets, BETWEEN)
    n_words = np.diff(first)
    if max_words == 1:
        return crc32_spans(data, starts, ends) % np.uint32(n_buckets), n_words, n_words
    joined, starts, ends = vec.normalised(data, starts, ends)
    row = np.repeat(np.arange(len(n_words)), n_words)
    left = np.repeat(first[1:], n_words) - np.arange(len(starts))  # words from here to the end of the text
    values, rows = [], []
    for k in range(1, max_words + 1):
        at = np.flatnonzero(left >= k)
        run = np.zeros(len(at), np.uint32)
        for j in range(k):  # spans of one length overlap: every k-th is free of overlaps
            part = np.arange(j, len(at), k)
            run[part] = crc32_spans(joined, starts[at[part]], ends[at[part] + k - 1])
        values.append(run % np.uint32(n_buckets))
        rows.append(row[at])
    order = np.argsort(np.concatenate(rows), kind="stable")
    n = sum(np.bincount(r, minlength=len(n_words)) for r in rows)
    return np.concatenate(values)[order], n, n_words


def bucket_counts(docs: DataFrame, text_col: str = "text", n_buckets: int = BUCKETS, max_words: int = 1) -> DataFrame:
    """(bucket, n): how many features of all texts fall in each bucket that has any."""

    def count(batches):
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            data, offsets = vec.buffers(batch.column(0))
            for i, j in vec.slices(offsets):
                b, _, _ = features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], n_buckets, max_words)
                total += np.bincount(b, minlength=n_buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["bucket", "n"])

    parts = docs.select(docs[text_col].alias("text")).mapInArrow(count, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", n_buckets: int = BUCKETS, max_words: int = 1):
    """Gain of each bucket: floor(1000 * ln of its smoothed share in the target over that in the documents)."""
    s, t = np.zeros(n_buckets), np.zeros(n_buckets)
    for frame, counts in ((docs, s), (target, t)):
        for row in bucket_counts(frame, text_col, n_buckets, max_words).collect():  # at most n_buckets rows
            counts[row.bucket] = row.n
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n_buckets) / ((s + 1) * (t.sum() + n_buckets)))).astype(np.int64)


def weighted(docs: DataFrame, gain, id_col: str = "doc_id", text_col: str = "text", max_words: int = 1) -> DataFrame:
    """(id, n_features, n_words, weight): the floored mean of the gains of a text's features."""

    def score(batches):
        for batch in batches:
            data, offsets = vec.buffers(batch.column(1))
            out = []
            for i, j in vec.slices(offsets):
                b, n, words = features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], len(gain), max_words)
                total = np.zeros(len(b) + 1, np.int64)
                np.cumsum(gain[b], out=total[1:])
                stop = np.cumsum(n)
                out.append((n, words, (total[stop] - total[stop - n]) // np.maximum(n, 1)))
            columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out)] or [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "n_features", "n_words", "weight"])

    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    return rows.mapInArrow(score, "id long, n_features long, n_words long, weight long")


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, percent: int = 10,
              min_words: int = 20, seed: int = 2024, n_buckets: int = BUCKETS, max_words: int = 1) -> DataFrame:
    """(id, n_features, weight, score, rank): all documents; rank, from 1, of the floor(percent * N / 100) that are
    drawn out of the N documents with at least ``min_words`` words, null for the others."""
    gain = gains(docs, target, text_col, n_buckets, max_words)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = stored(weighted(docs, gain, id_col, text_col, max_words).withColumn("score", F.col("weight") + noise),
                    "resample-scores")
    enough = F.col("n_words") >= min_words
    ranked = positions(scored.where(enough), [], "score", [F.col("id").asc_nulls_last()], row_number="rank")
    drawn = scored.where(enough).agg(F.floor(F.count(F.lit(1)) * percent / F.lit(100)).alias("drawn"))
    ranked = ranked.crossJoin(F.broadcast(drawn)).withColumn("rank", F.when(F.col("rank") <= F.col("drawn"), F.col("rank")))
    columns = ["id", "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(
        scored.where(~enough).withColumn("rank", F.lit(None).cast("long")).select(*columns))
