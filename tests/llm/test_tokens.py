import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

import llm_cases as C
from teampulse.llm import bpe, packing, tokens, vec

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
ODD = ["it's we're 'tis  don't\n\n  x  ' s''s  I'll'd    a\x1c b\x85c ", "'", "'s", " 's", "x'r", "'re've", "\n\na  \n b ",
       "日本 語 12²½ Ⅷ'm", "a b　 c", "<|endoftext|> x", "é \U0001f600‍'ll"]


def _starts(text):
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return tokens.pretoken_starts(points, np.array([0, len(points)])).tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("'strevmld \n\t aZ1.,é² \x1c\x85'"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_pretokens_are_the_matches_of_the_pattern(text):
    assert _starts(text) == [m.start() for m in regex.finditer(P.PATTERN, text)]


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_sentencepiece_model_encodes_as_the_ranks_do(tiktoken_encoding):
    codec, texts = bpe.codec(RANKS), [t or "" for _, t in C.TEXTS] + ODD
    data, offsets = vec.buffers(pa.array(texts))
    for _ in range(2):  # the second time from memory
        ids, begin = codec.encode(data.tobytes(), offsets)
        for text, a, b in zip(texts, begin[:-1], begin[1:]):
            assert ids[a:b].tolist() == tiktoken_encoding.encode_ordinary(text)
            assert codec.decode(ids[a:b]) == text.encode()


def test_byte_map_round_trip():
    assert bpe.unmapped(bpe.mapped(bytes(range(256)))) == bytes(range(256))


def test_memory_starts_anew_and_survives_slot_collisions(monkeypatch, tiktoken_encoding):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 50)
    monkeypatch.setattr(tokens.Memory, "SLOTS", 3)
    memory = tokens.Memory(bpe.codec(RANKS).encode_pretokens)
    for text in [C.LONG, C.PARAGRAPH, *ODD, C.LONG]:
        raw = text.encode()
        ids, _ = tokens.id_arrays(raw, np.array([0, len(raw)]), memory)
        assert ids.tolist() == tiktoken_encoding.encode_ordinary(text)


def test_memory_of_a_worker_stays_small_however_many_pretokens_it_meets():
    """800,000 short pre-tokens, then 20 million characters of long ones, beside some that every text has."""
    import tracemalloc

    def learn(pretokens):
        return np.array([int(p) if len(p) < 10 else len(p) for p in pretokens], "<u4"), np.ones(len(pretokens), np.int64)

    memory = tokens.Memory(learn)
    tracemalloc.start()
    try:
        for k in range(240):
            own = range(1000 + 20_000 * k, 21_000 + 20_000 * k) if k < 40 else ()
            long = [str(k) * (100_000 // len(str(k)))] if k >= 40 else []
            raw = "".join([*(f" {i}" for i in [*range(1000), *own]), *(f" {x}" for x in long)]).encode()
            ids, begin = tokens.id_arrays(raw, np.array([0, len(raw)]), memory)
            assert ids.tolist() == [*range(1000), *own, *(len(x) + 1 for x in long)]
            if k in (39, 239):
                assert tracemalloc.get_traced_memory()[0] < 80 << 20
    finally:
        tracemalloc.stop()


def test_op6_rows(spark, tiktoken_encoding):
    rows = [*C.TEXTS, (None, "x"), (1, "Short text.")]
    got = bpe.encoded(C.documents(spark, rows), with_ids=True).collect()
    want = []
    for i, t in rows:
        ids = np.array(tiktoken_encoding.encode_ordinary(t or ""), "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), ids))
    assert sorted([(*r[:4], bytes(r.ids)) for r in got], key=str) == sorted(want, key=str)
    assert bpe.encoded(C.empty(spark)).collect() == []


def test_cut_lengths_use_reciprocal_shares():
    for n in [*range(0, 9000, 7), 2048, 4096, 1024, 683, 682]:
        pieces = packing.cut_lengths(n)
        assert sum(p for p, _ in pieces) == n
        for length, k in pieces:
            assert 0 <= packing.CAPACITY - k * length <= packing.SLACK or packing.CAPACITY // k == length


def _check(rows, want):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc, start, length, crc, total, sequence, offset in rows:
        by_doc[doc].append((start, length, crc, total))
        by_sequence[sequence].append((offset, length))
    for doc, ids in want.items():
        at = 0
        for start, length, crc, total in sorted(by_doc.pop(doc)):
            assert (start, total, crc) == (at, len(ids), zlib.crc32(np.array(ids[at : at + length], "<u4").tobytes()))
            at += length
        assert at == len(ids)
    assert not by_doc
    padding = used = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.CAPACITY
        used += at
        padding += 0 if at & (at - 1) == 0 else packing.CAPACITY - at
    return padding / max(used, 1)


def test_packer_loses_nothing_and_pads_little():
    rng = np.random.default_rng(1)
    want = {d: rng.integers(0, 50000, int(n)).tolist() for d, n in enumerate(rng.lognormal(6, 1.5, 3000).clip(1, 30000))}
    packer = packing.Packer(0)
    for d, ids in want.items():
        packer.add(d, np.array(ids, "<u4").tobytes())
    full = [r for r in packer.rows]
    packer.finish()
    assert _check(packer.rows, want) < 0.02
    counts = defaultdict(list)
    for r in full:
        counts[r[5]].append(packing.CAPACITY // r[2])
    assert all(len(k) <= min(k) for k in counts.values())  # a class's bins take its fixed count


def test_op9_rows(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(JSON)
    mark = "<|endoftext|>"
    marked = [f"hello {mark} world", mark, mark + mark, f"{mark} starts", f"ends {mark}", f"ends{mark}", f"a  {mark}  b\n\n{mark}",
              "<|endof", "text|> is not one", f"<|endoftext{mark}|>", f"l'{mark}'ll", f"12{mark}34 {mark[:-1]}", "née" + mark + "東京"]
    rows = [*C.TEXTS, *((100 + k, t) for k, t in enumerate([*ODD, *marked]))]
    docs = C.documents(spark, rows).repartition(3)
    got = [tuple(r) for r in packing.packed(docs).collect()]
    _check(got, {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END] for i, t in rows})
    assert packing.packed(C.empty(spark)).collect() == []
    assert packing.packed(C.documents(spark, [(None, "x"), (None, "x")])).count() >= 2
