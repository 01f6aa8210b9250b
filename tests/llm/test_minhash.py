import hashlib

import numpy as np
import pyarrow as pa

import llm_cases as C
from pyspark.sql import functions as F

from teampulse.llm import minhash, vec


def _shingles(text, k=5):
    words = C.WORD.findall(text or "")
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def _jaccard(a, b):
    a, b = _shingles(a), _shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edit_probe_on_awkward_rows(spark):
    rows = C.TEXTS
    got = {r.doc_id: r for r in minhash.edit_probe(C.documents(spark), parts=4).collect()}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        q = len(t) // 4
        edit = t[: len(t) - q] + after[:q]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edit.encode()).hexdigest())
        assert r.fingerprint == minhash.fingerprint_texts([t])[0] and r.edited_fingerprint == minhash.fingerprint_texts([edit])[0]
        assert abs(r.near_edited - minhash.likeness_of(r.fingerprint, r.edited_fingerprint)) < 1e-9
        if len(_shingles(t) | _shingles(edit)) > 1000:
            assert abs(r.near_edited - _jaccard(t, edit)) < 0.12
    assert got[0].fingerprint == got[4].fingerprint


def test_ranges_of_any_number_give_the_same(spark):
    docs = C.documents(spark)
    want = sorted(map(tuple, minhash.edit_probe(docs, parts=1).collect()))
    for parts in (2, 7, 50):
        assert sorted(map(tuple, minhash.edit_probe(docs, parts=parts).collect())) == want


def test_single_null_and_repeated_ids(spark):
    one = minhash.edit_probe(C.documents(spark, [(7, "a b c d e f g h")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    rows = [(None, "alpha beta gamma"), (1, "one two three four"), (1, "one two three five"), (None, None)]
    got = minhash.edit_probe(C.documents(spark, rows)).collect()
    assert sorted((r.doc_id is None, r.n_chars) for r in got) == [(False, 18), (False, 18), (True, 0), (True, 16)]


def test_rows_that_share_an_id_are_spread_over_ranges(spark):
    rows = [(None, f"text number {i} has no id") for i in range(300)] + [(5, f"text {i} of id five") for i in range(300)]
    docs = C.documents(spark, rows)
    plain = docs.select(F.coalesce("doc_id", F.lit(-1)).alias("id"), "text")
    sizes = [r["count"] for r in minhash.with_next(plain, parts=10).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 200
    want = sorted(map(str, minhash.edit_probe(docs, parts=1).collect()))
    assert sorted(map(str, minhash.edit_probe(docs, parts=10).collect())) == want


def test_ranks_of_keys():
    rng = np.random.default_rng(3)
    keys = sorted({(int(a), int(b)) for a, b in rng.integers(0, 6, (30, 2))})
    ids, ties = (np.array(x, np.int64) for x in zip(*keys))
    rows = [(int(a), int(b)) for a, b in rng.integers(-1, 8, (200, 2))]
    got = minhash.ranks(ids, ties, *(np.array(x, np.int64) for x in zip(*rows)))
    assert got.tolist() == [sum(k <= r for k in keys) for r in rows]


def test_empty_table(spark):
    assert minhash.edit_probe(C.empty(spark)).collect() == []
    assert minhash.fingerprints(C.empty(spark)).collect() == []


def test_likeness_has_no_bias():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 400)]
        other = words[: rng.integers(50, 350)] + [f"v{x}" for x in rng.integers(0, 10**6, 200)]
        a, b = " ".join(words), " ".join(other)
        data, offsets = vec.buffers(pa.array([a, b]))
        table, has = minhash.sketches(data, offsets)
        errors.append(minhash.likeness(table[:1], has[:1], table[1:], has[1:])[0] - _jaccard(a, b))
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.05


def _mix(x):
    m = (1 << 64) - 1
    x &= m
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & m
    x = (x ^ x >> 27) * 0x94D049BB133111EB & m
    return x ^ x >> 31


def test_fingerprints_equal_plain_one_permutation_hashing():
    """Bins, densification and packing once more, bin by bin: an empty bin takes the first filled bin that it looks at."""
    for text in ("a b c d e f g", "one two", " ".join(f"w{i}" for i in range(90)), " ".join(f"v{i}" for i in range(700))):
        data, offsets = vec.buffers(pa.array([text]))
        starts, ends, first = vec.words(data, offsets)
        hashes, _ = vec.shingles(vec.span_hash(vec.prefix_hash(data), starts, ends), first, minhash.SHINGLE)
        bins, low = minhash.BINS, {}
        for h in hashes.tolist():
            b = h >> 55  # 512 bins
            low[b] = min(low.get(b, 1 << 64), h & (1 << 55) - 1)
        values = []
        for b in range(bins):
            j, attempt = b, 0
            while j not in low:
                j = _mix(b * 0x9E3779B97F4A7C15 + attempt * 0xC2B2AE3D27D4EB4F) % bins
                attempt += 1
            values.append(low[j] & 15)
        assert minhash.fingerprint_texts([text]) == ["".join(f"{v:x}" for v in values)]


def test_empty_bins_are_filled_alike():
    a, b = minhash.fingerprint_texts(["x y z"] * 2)
    assert a == b and len(a) == minhash.BINS * minhash.BITS // 4
    assert minhash.fingerprint_texts(["", " \n"]) == ["", ""]
    assert (minhash.likeness_of("", ""), minhash.likeness_of("", a)) == (1.0, 0.0)
    data, offsets = vec.buffers(pa.array(["x y z"]))
    table, _ = minhash.sketches(data, offsets)
    assert len(np.unique(table)) == 1  # one shingle fills every bin
