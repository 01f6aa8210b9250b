import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

import llm_cases as C
from teampulse.llm import suffix, vec


def _want(rows):
    raw = [(t or "").encode() for _, t in rows]
    out = []
    for b, gone in zip(raw, C.repeats(raw)):
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def _got(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_awkward_rows_match_brute_force(spark):
    got = _got(suffix.deduplicated(C.documents(spark)))
    assert got == dict(zip([i for i, _ in C.TEXTS], _want(C.TEXTS)))


@pytest.mark.parametrize("options", [{"hot_anchor": 1}, {"chunk_bytes": 1}, {"gram": 20}])
def test_hot_anchors_and_small_chunks_change_nothing(spark, options):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(2, 7))) for _ in range(60)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(5, 40))) + passage[rng.randint(0, 80):] * rng.randint(0, 2)
             + " ".join(rng.choice(words) for _ in range(9))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(suffix.deduplicated(docs, **options)) == dict(zip([i for i, _ in rows], _want(rows)))


def test_null_ids_come_first(spark):
    rows = [(5, C.PARAGRAPH), (None, "x" + C.PARAGRAPH)]
    got = _got(suffix.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got[None][1] == 0 and got[5][1] == len(C.PARAGRAPH)


def test_repeated_ids(spark):
    rows = [(1, C.PARAGRAPH), (1, C.PARAGRAPH), (1, "other " + C.PARAGRAPH), (0, "nothing")]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in
                 suffix.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    n = len(C.PARAGRAPH)
    assert got[0] == (0, 7, 0) and got[1][2] == got[2][2]  # equal rows, equal results
    assert sorted([got[1][2], got[3][2]]) == [0, n]        # one of the two texts keeps the passage


def test_empty_table(spark):
    assert suffix.deduplicated(C.empty(spark)).collect() == []
    assert suffix.without_repeats(C.empty(spark)).collect() == []


def test_without_repeats_keeps_rows_and_columns(spark):
    docs = C.documents(spark)
    out = suffix.without_repeats(docs)
    assert out.schema == docs.schema
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == len(C.TEXTS) and rows[3].text is None and rows[4].text == "" and rows[4].n_chars == 0
    assert rows[9].text.startswith("Intro words here") and "northern railway" not in rows[9].text
    assert all(r.text is None or r.n_chars == len(r.text) for r in rows.values())


def _by_shard(texts, length, gram):
    data, offsets = vec.buffers(pa.array(texts, pa.large_binary()))
    row, h, first, count = suffix.batch_anchors(data, offsets, length, gram)
    assert count.sum() == sum(max(0, len(t) - length + 1) for t in texts)  # each window has one anchor
    order = sorted(range(len(h)), key=lambda i: int(h[i]))
    contexts = [texts[row[i]][first[i] : first[i] + count[i] + length - 1] for i in order]
    which, begin, end = suffix.repeated_spans(contexts, row[order], first[order], length)
    gone = [np.zeros(len(t), bool) for t in texts]
    for w, b, e in zip(which, begin, end):
        i = order[w]
        gone[row[i]][first[i] + b : first[i] + e] = True
    return gone


@pytest.mark.parametrize("seed", range(40))
def test_shards_match_brute_force(seed):
    rng = random.Random(seed)
    base = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(5, 60))) for _ in range(4)]
    texts = [b"".join(rng.choice(base)[rng.randint(0, 4) : rng.randint(8, 60)] for _ in range(rng.randint(0, 4))) for _ in range(6)]
    for a, b in zip(C.repeats(texts, 20), _by_shard(texts, 20, 6)):
        assert (a == b).all()


def test_maximal_repeats_match_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        text = "".join(rng.choice("ab") for _ in range(30))
        order = sorted(range(len(text)), key=lambda i: text[i:])
        lcp = [0] * len(text)
        for k in range(1, len(text)):
            a, b = text[order[k - 1]:], text[order[k]:]
            while lcp[k] < min(len(a), len(b)) and a[lcp[k]] == b[lcp[k]]:
                lcp[k] += 1
        left = [256 if i == 0 else ord(text[i - 1]) for i in order]
        got = {text[order[f] :][:d]: {order[k] for k in range(f, l + 1)}
               for d, f, l in suffix.maximal_repeats(lcp, left, 3)}
        want = {}
        for n in range(3, len(text)):
            for i in range(len(text) - n + 1):
                s = text[i : i + n]
                places = {j for j in range(len(text) - n + 1) if text[j : j + n] == s}
                lefts = {text[j - 1] if j else None for j in places}
                rights = {text[j + n] if j + n < len(text) else None for j in places}
                if len(places) > 1 and (len(lefts) > 1 or None in lefts) and (len(rights) > 1):
                    want[s] = places
        assert got == want


def test_one_long_text_is_read_in_pieces(monkeypatch):
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 103, 5000, dtype=np.uint8)
    whole = suffix.batch_anchors(raw, np.array([0, 5000]))
    monkeypatch.setattr(suffix, "PIECE_BYTES", 700)
    parts = suffix.batch_anchors(raw, np.array([0, 5000]))
    assert whole[3].sum() == parts[3].sum() == 4901
    assert set(whole[1].tolist()) == set(parts[1].tolist())


def test_query_matches_its_sql(spark):
    import duckdb

    from teampulse.llm import queries

    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    df = queries.op5_suffix_array_dedup(spark, sf)
    sql = con.sql(queries.oracle_sql()["op5_suffix_array_dedup"])
    assert sorted(sql.columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*sql.columns).collect())) == sorted(sql.fetchall())
