"""Keyed upsert semantics."""

import datetime as dt

import pytest

from teampulse.operators.merge import upsert

T = dt.datetime
LOAD = T(2024, 2, 1, 2)
SCHEMA = "k int, repo string, ins string, upd string, extracted_at timestamp_ntz"


def _merge(spark, existing, incoming, **kw):
    e = spark.createDataFrame(existing, SCHEMA)
    i = spark.createDataFrame(incoming, SCHEMA + ", _seq int")
    out = upsert(e, i, ["k", "repo"], ["upd"], loaded_at=LOAD, **kw)
    return {(r.k, r.repo): (r.ins, r.upd, r.extracted_at) for r in out.collect()}


def test_first_insert_last_update_within_batch(spark):
    got = _merge(spark, [], [(1, "r", "first", "a", None, 0), (1, "r", "second", "b", None, 1),
                             (1, "r", "third", "c", None, 2)])
    assert got == {(1, "r"): ("first", "c", LOAD)}


def test_existing_key_keeps_insert_only_and_takes_null_update(spark):
    old = T(2024, 1, 1)
    got = _merge(spark, [(1, "r", "stored", "x", old), (2, "r", "keep", "y", old)],
                 [(1, "r", "new", "z", None, 0), (1, "r", "newer", None, None, 1)])
    assert got[(1, "r")] == ("stored", None, LOAD)  # NULL overwrites, never coalesce(new, old)
    assert got[(2, "r")] == ("keep", "y", old)      # untouched row unchanged


def test_key_includes_repo(spark):
    got = _merge(spark, [(1, "a", "s", "x", None)], [(1, "b", "n", "y", None, 0)])
    assert set(got) == {(1, "a"), (1, "b")}


def test_scope_returns_only_touched_rows(spark):
    e = spark.createDataFrame([(1, "a", "s", "x", None), (2, "b", "t", "y", None)], SCHEMA)
    i = spark.createDataFrame([(1, "a", "n", "z", None, 0)], SCHEMA + ", _seq int")
    out = upsert(e, i, ["k", "repo"], ["upd"], loaded_at=LOAD, scope=["repo"])
    assert [(r.k, r.repo, r.upd) for r in out.collect()] == [(1, "a", "z")]
    with pytest.raises(ValueError):
        upsert(e, i, ["k"], ["upd"], scope=["repo"])


def test_requires_sequence(spark):
    e = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        upsert(e, e, ["k", "repo"], ["upd"])


def test_batch_is_read_once(spark, tmpdir_path):
    e = spark.createDataFrame([], SCHEMA)
    spark.createDataFrame([(1, "a", "n", "z", None, 0)], SCHEMA + ", _seq int").write.mode("overwrite").parquet(tmpdir_path)
    plan = upsert(e, spark.read.parquet(tmpdir_path), ["k", "repo"], ["upd"], loaded_at=LOAD)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Join") == 1


def test_repeated_and_unordered_rows_count_once(spark):
    row = (1, "r", "ins", "upd", None, 0)
    assert _merge(spark, [], [row, row, row]) == {(1, "r"): ("ins", "upd", LOAD)}
    ties = [(1, "r", f"i{n}", f"u{n}", None, 0) for n in range(6)]
    assert len({tuple(_merge(spark, [], order)[(1, "r")]) for order in (ties, ties[::-1], ties[3:] + ties[:3])}) == 1


def test_several_sequence_columns_order_a_batch(spark):
    e = spark.createDataFrame([], SCHEMA)
    i = spark.createDataFrame([(1, "r", "c", "c", None, 2, 0), (1, "r", "b", "b", None, 1, 9), (1, "r", "a", "a", None, 1, 1)],
                              SCHEMA + ", _seq int, _place int")
    got = upsert(e, i, ["k", "repo"], ["upd"], seq_col=("_seq", "_place"), loaded_at=LOAD).collect()
    assert [(r.ins, r.upd) for r in got] == [("a", "c")]


def test_null_key_fails_instead_of_vanishing(spark):
    with pytest.raises(Exception, match="NULL in key column repo"):
        _merge(spark, [], [(1, None, "a", "b", None, 0)])
