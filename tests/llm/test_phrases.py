"""Collocations against plain counting; the parse against its definition."""

import re
from collections import Counter

import numpy as np
from llm_cases import LOWER, TEXTS, empty
from pyspark.sql import functions as F

from teampulse.llm import frames, phrases, queries, vec

PIECE, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")
SF = "/root/testdata/sf0.001"


def pieces(text):
    return [w for w in (WORD.findall(p) for p in PIECE.split((text or "").translate(LOWER))) if w]


def plain(rows, min_count, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    cand = [p for p, a in f.items() if len(p) >= 3 and a >= min_count]
    longer = Counter()
    for p in cand:
        for k in range(2, len(p) - 1):
            for i in range(1, len(p) - k + 1):
                sub = (p[0], *p[i:i + k])
                longer[sub] = max(longer[sub], f[p])
    out = []
    for p in cand:
        if 100 * longer[p] >= 80 * f[p]:
            continue
        score, _, left, right = min((2000000 * f[p] // (f[p[:k + 1]] + f[(p[0], *p[k + 1:])]), k, f[p[:k + 1]], f[(p[0], *p[k + 1:])])
                                    for k in range(1, len(p) - 1))
        out.append((p[0], " ".join(p[1:]), f[p], left, right, n[p[0]], score))
    final = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        final += [(r[0], i, *r[1:]) for i, r in enumerate(mine, 1)]
    return sorted(final)


def got(frame):
    return sorted(tuple(r) for r in frame.collect())


def texts(spark):
    rnd = np.random.default_rng(3)
    common = "the old railway station of the northern town was open all winter and the small café near it too".split()
    rows = [("en", " ".join(rnd.choice(common, 30)) + ". New York City, at the end of the day! " + "of the " * 5) for _ in range(60)]
    rows += [("de", "Zug um Zug\tfährt der Zug; Zug um Zug\nZug um Zug.") for _ in range(40)]
    rows += [(None, "no language at all here"), ("und", "no language at all here"), ("", "an empty code an empty code")] * 12
    rows += [("en", t) for _, t in TEXTS] + [("en", None), ("en", ""), ("fr", None)]
    rows += [("en", "a " * 5000), ("en", "ab cd " * 3000), ("en", "x" * 100_000)]
    df = spark.createDataFrame([(i, t, lang, "clash", 1, 2) for i, (lang, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, phrase string, n long, part long").repartition(5)
    return rows, df


def test_equals_plain_counting(spark):
    rows, df = texts(spark)
    for min_count, top, trigger, size in ((10, 2000, 32, 1 << 23), (30, 7, 2, 1 << 12), (3, 50, 1, 1 << 14)):
        out = phrases.collocations(df, min_count=min_count, top=top, trigger=trigger, part_bytes=size)
        assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert got(out) == plain(rows, min_count, top)


def test_no_candidates_and_empty_tables(spark):
    _, df = texts(spark)
    assert phrases.collocations(df, min_count=10**9).count() == 0
    assert phrases.collocations(empty(spark)).count() == 0


def test_parse_covers_each_phrase_start_once():
    rnd = np.random.default_rng(1)
    text = " ".join(str(x) for x in rnd.integers(0, 40, 4000)) + ". one, two three\nfour"
    raw = np.frombuffer(text.encode(), np.uint8)
    for trigger in (1, 3, 32, 10**9):
        chunk, goes_on, at = phrases.parse(raw, np.array([0, len(raw)]), trigger)
        counted = Counter()
        for c, more in zip(chunk.to_pylist(), goes_on.tolist()):
            w = c.split(" ")
            counted.update(tuple(w[i:i + 4]) for i in range(len(w) - 3 if more else len(w)))
        want = Counter(tuple(w[i:i + 4]) for w in pieces(text) for i in range(len(w)))
        assert counted == want and not at.any()
        assert trigger > 40 or goes_on.sum() > 20
        assert trigger < 40 or len(chunk) == len(pieces(text))


def test_equal_passages_share_chunks():
    """What surrounds a passage changes the chunks at its ends only."""
    rnd = np.random.default_rng(2)
    passage = " ".join(f"w{x}" for x in rnd.integers(0, 10**6, 900))
    def chunks(t):
        raw = np.frombuffer(t.encode(), np.uint8)
        return set(phrases.parse(raw, np.array([0, len(raw)]), 8)[0].to_pylist())
    alone, inside = chunks(passage), chunks("before it " + passage + " after it")
    assert len(alone - inside) <= 2 < len(alone)


def test_hot_and_cold_keys_are_looked_up(spark):
    rows = spark.range(9000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.col("id")).alias("k"))
    facts = spark.range(0, 9000, 2).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    out = frames.looked_up(rows, facts, ["k"]).collect()
    want = {(i, k, 2 * k) for i in range(9000) for k in [0 if i % 3 == 0 else i if i % 3 == 1 else None] if k is not None and k % 2 == 0}
    assert {(r.id, r.k, r.v) for r in out} == want and len(out) == len(want)


def test_query_equals_plain_counting(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()]
    assert got(queries.op13_phrase_mining(spark, SF)) == plain(rows, 30, 2000)


def test_words_are_runs_of_bytes():
    data = np.frombuffer("a\x00b c\x1fd e".encode(), np.uint8)
    starts, ends, _ = vec.words(data, np.array([0, len(data)]), phrases.BETWEEN)
    assert [bytes(data[s:e]).decode() for s, e in zip(starts, ends)] == WORD.findall("a\x00b c\x1fd e")
