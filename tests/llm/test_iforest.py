import random
from collections import Counter

import numpy as np
import pyarrow as pa

import llm_cases as C
from teampulse.llm import iforest, vec


def _counts(text):
    text = text or ""
    words = C.WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    cover = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            cover.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if C.WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover))


def _corpus(n=260):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    rows, marks = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(30, 200))]
        bad = i % 8 == 0
        text = " ".join(w + rng.choice(["%%%", "***", "|"]) if bad else w for w in words)
        rows.append((1000 + i, text))
        marks.append((1000 + i, int(not bad), 0))
    return rows, marks


def test_counts_match_brute_force(spark):
    rows = [*C.TEXTS, (None, "a b"), (10, "x " * 30)]
    got = iforest.quality_rules(C.documents(spark, rows), C.labels(spark)).collect()
    want = sorted((str(i), *_counts(t)) for i, t in rows)
    assert sorted((str(r.id), *(r[c] for c in iforest.COUNTS)) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_anomalies_go_and_clean_text_stays(spark):
    rows, marks = _corpus()
    train = [m for m in marks if m[0] % 3]
    got = iforest.quality_rules(C.documents(spark, rows), C.labels(spark, [*train, (None, 1, 0), (1001, None, None)])).collect()
    bad = {i for i, q, _ in marks if not q}
    kept = {r.id for r in got if r.kept}
    assert not kept & bad
    assert len(kept) >= 0.97 * (len(rows) - len(bad))
    stage = iforest.keep_good(C.documents(spark, rows), C.labels(spark, train))
    assert stage.columns == C.documents(spark, rows).columns
    assert {r.doc_id for r in stage.collect()} == kept


def test_without_labels_and_empty(spark):
    rows, _ = _corpus(60)
    assert iforest.quality_rules(C.documents(spark, rows), C.labels(spark)).count() == 60
    assert iforest.quality_rules(C.empty(spark), C.labels(spark)).collect() == []
    assert iforest.keep_good(C.empty(spark), C.labels(spark)).collect() == []


def test_path_lengths_isolate_outliers():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (500, 3))
    forest = iforest.fit(x, x.min(0) - 5, x.max(0) + 5, trees=64, sample=128)
    far, near = iforest.score(forest, np.array([[6.0, 6, 6]])), iforest.score(forest, np.zeros((1, 3)))
    assert far > near and 0 < near < far <= 1


def test_equal_hashes_are_told_apart():
    data, offsets = vec.buffers(pa.array(["aa bb aa cc"]))
    starts, ends, _ = vec.words(data, offsets)
    ids = iforest._exact_ids(data, starts, ends, np.zeros(4, np.uint64))
    assert ids[0] == ids[2] and len(set(ids.tolist())) == 3
    assert iforest._repeated_words(np.array([1, 2] * 10, np.uint64)) == 20


def test_threshold_weighs_good_rows():
    assert iforest.threshold([(1000, 0, 50), (1000, 1, 50)]) > 1  # no cut gains: nothing goes
    cut = iforest.threshold([(500, 1, 1000), (1500, 0, 90), (1400, 0, 5), (600, 0, 5)])
    assert 500 / iforest.SCORE_STEPS < cut <= 1500 / iforest.SCORE_STEPS
    assert iforest.threshold([]) == iforest.UNCALIBRATED
