import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import llm_cases as C
from teampulse.llm import simhash
from teampulse.llm.graph import connected_components

ROWS = [*C.TEXTS, (1, "Short text."), (1, "Another text with the same id."), (None, "Short text."), (None, "No id, alone here.")]


def _check(spark, rows, **options):
    got = simhash.near_duplicates(C.documents(spark, rows), **options).collect()
    prints = [C.simhash(t) for _, t in rows]
    roots = C.components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    smallest = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            smallest[r] = min(i, smallest.get(r, i))
    want = sorted([(i, p, smallest.get(r)) for (i, _), p, r in zip(rows, prints, roots)], key=str)
    assert sorted([(r.id, r.fp & (1 << 64) - 1, r.component_id) for r in got], key=str) == want


def test_awkward_rows_match_brute_force(spark):
    _check(spark, ROWS)


def test_empty_table(spark):
    assert simhash.near_duplicates(C.empty(spark)).collect() == []
    assert simhash.keep_first(C.empty(spark)).collect() == []


def test_keep_first_keeps_one_row_of_each_class(spark):
    docs = C.documents(spark)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert 0 in ids and 4 not in ids and 2 in ids and not {3, 5} & set(ids) and 6 in ids


def _near(rng, center, flips):
    for b in rng.sample(range(64), flips):
        center ^= 1 << b
    return center


@pytest.mark.parametrize("hot_key", [3, 40, 2048])
def test_links_match_brute_force_also_through_hot_keys(spark, hot_key):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for _ in range(6):  # dense groups, chains, and pairs at 4 and 5 bits
        c = rng.getrandbits(64)
        prints |= {_near(rng, c, rng.randint(1, 3)) for _ in range(30)}
        prints |= {c, _near(rng, c, 4), _near(rng, c, 5)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    parts = {r.node: r.component for r in connected_components(simhash.links(nodes, 4, hot_key)).collect()}
    roots = C.components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    groups = {}
    for p, r in zip(signed, roots):
        groups.setdefault(r, []).append(p)
    for members in groups.values():
        assert {parts.get(p, p) for p in members} == {min(members)}


def test_forest_of_a_dense_group_is_small():
    rng = random.Random(2)
    fp = np.unique(np.array([_near(rng, 12345, rng.randint(0, 2)) for _ in range(400)], np.uint64))
    assert len(simhash._forest(fp, 4)) == len(fp) - 1


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(7, 40)}}


def test_pigeonhole_blocks_cover_all_bits():
    for mask in simhash._level_keys(0, 4):
        assert 20 <= mask.bit_count() <= 22
    assert sum(simhash.block_bits(64, 6)) == 64


def test_near_duplicates_need_no_other_columns(spark):
    docs = C.documents(spark).select("doc_id", F.upper("text").alias("text"))
    assert simhash.near_duplicates(docs).count() == len(C.TEXTS)
