"""Table CRC against zlib, importance resampling against plain Python."""

import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
from llm_cases import LOWER, TEXTS, documents, empty

from teampulse.llm import queries, resample
from teampulse.llm.crc import BLOCK, crc32_spans

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SF = "/root/testdata/sf0.001"


def test_crc_of_spans_equals_zlib():
    rnd = np.random.default_rng(5)
    lengths = [1, 2, 3, 4, 5, BLOCK - 1, BLOCK, BLOCK + 1, 2 * BLOCK - 1, 2 * BLOCK, 2 * BLOCK + 1, 2 * BLOCK + 3, 1000, 70_001,
               *rnd.integers(1, 300, 400)]
    data = rnd.integers(0, 256, sum(lengths) + 7 * len(lengths)).astype(np.uint8)
    ends = np.cumsum(np.array(lengths) + 7)
    starts = ends - lengths
    raw = data.tobytes()
    assert crc32_spans(data, starts, ends).tolist() == [zlib.crc32(raw[s:e]) for s, e in zip(starts, ends)]
    assert len(crc32_spans(data, starts[:0], ends[:0])) == 0


def plain(docs, target, percent=10, max_words=1, buckets=resample.BUCKETS):
    def feats(text):
        w = WORDS.findall((text or "").translate(LOWER))
        runs = [" ".join(w[i:i + k]) for k in range(1, max_words + 1) for i in range(len(w) - k + 1)]
        return [zlib.crc32(r.encode()) % buckets for r in runs], len(w)

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(feats(text)[0])
    for text in target:
        t.update(feats(text)[0])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        f, n = feats(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    enough = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(enough[:percent * len(enough) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_awkward_rows_equal_plain_python(spark):
    more = [(i, f"target words number {i} " + "alpha beta gamma " * (i % 9)) for i in range(100, 180)]
    more += [(None, "no id " * 30), (180, "ÄÖ x1y2 straße " * 20), (181, "z" * 5000 + " tail" * 30), (182, "UPPER lower " * 20)]
    target = spark.createDataFrame([(1, "alpha beta beta"), (2, None), (3, ""), (4, "Straße upper")], "item_id long, text string")
    docs = documents(spark, more=more)
    texts = ["alpha beta beta", None, "", "Straße upper"]
    for percent in (10, 55):
        assert got(resample.resampled(docs, target, percent=percent)) == plain([*TEXTS, *more], texts, percent)
    assert got(resample.resampled(docs, target, max_words=3, n_buckets=500)) == plain([*TEXTS, *more], texts, 10, 3, 500)


def test_repeated_rows_and_ties(spark):
    rows = [(7, "same words again and again " * 5)] * 40 + [(i, "same words again and again " * 5) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = resample.resampled(docs, docs, percent=50)
    assert got(out) == plain(rows, [t for _, t in rows], 50)


def test_empty_tables(spark):
    target = spark.createDataFrame([], "item_id long, text string")
    assert resample.resampled(empty(spark), target).count() == 0
    assert got(resample.resampled(documents(spark), target)) == plain(TEXTS, [])


def test_query_equals_plain_python(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    out = queries.op12_importance_resampling(spark, SF)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert got(out) == plain(docs, target)
