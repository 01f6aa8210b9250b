"""Stored upserts by bucket: one state after another, lost jobs, changed groups."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from teampulse import schemas
from teampulse.constants import UPDATE_COLS
from teampulse.functions import login_key
from teampulse.operators.merge import upsert
from teampulse.sources import store

T = dt.datetime
LOAD = T(2024, 2, 1)


def _commit(sha, login, message="m", repo="org/a", at=None):
    return (str(sha), login, "u", "User", message, T(2024, 1, 1), repo, at)


def _commits(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_COMMITS)


def _batch(spark, rows):
    return spark.createDataFrame([(*r, i, 0) for i, r in enumerate(rows)], schemas.batch("commits"))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _files(path, kind):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if kind in d and f.endswith(".parquet")}


def test_batches_equal_upserts_of_the_whole(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "commits")
    rows = [_commit(i, "ann") for i in range(200)]
    store.create(_commits(spark, rows), path, "commits", shards=4, buckets=4)
    want = _commits(spark, rows)
    for step, batch in enumerate(([_commit(7, "bo", "x"), _commit(7, None, "y"), _commit(900, "cy", "first"), _commit(900, "di", "2nd")],
                                  [], [_commit(i, "eve", repo="org/b") for i in range(0, 400, 3)])):
        at = LOAD + dt.timedelta(days=step)
        state = store.upsert_into(spark, path, "commits", _batch(spark, batch), loaded_at=at)
        after = upsert(want, _batch(spark, batch), ["sha"], UPDATE_COLS["commits"], seq_col=schemas.BATCH_ORDER, loaded_at=at)
        want = _commits(spark, after.collect())
        assert state.number == step + 1
        assert _rows(store.read(spark, path, "commits")) == _rows(want)


def test_neither_side_of_the_merge_is_exchanged(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "commits")
    store.create(_commits(spark, [_commit(i, "ann") for i in range(50)]), path, "commits", shards=2, buckets=4)
    store.upsert_into(spark, path, "commits", _batch(spark, [_commit(3, "bo"), _commit(77, "bo")]), loaded_at=LOAD)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = store.merge_plan(spark, path, "commits", LOAD)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Bucketed: true") == 2 and "Exchange" not in plan and "FullOuter" in plan


def test_only_touched_shards_are_written(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "commits")
    store.create(_commits(spark, [_commit(i, "ann") for i in range(64)]), path, "commits", shards=8, buckets=2)
    state = store.upsert_into(spark, path, "commits", _batch(spark, [_commit(7, "bo")]), loaded_at=LOAD)
    assert sorted(state.generation.values()) == [0] * 7 + [1]
    assert len(_files(path, "gen-1")) <= 2
    got = {r.sha: r.author_login for r in store.read(spark, path, "commits").collect()}
    assert len(got) == 64 and got["7"] == "bo"


def test_a_lost_write_leaves_the_old_table_and_can_be_run_again(spark, tmpdir_path, monkeypatch):
    path = os.path.join(tmpdir_path, "commits")
    store.create(_commits(spark, [_commit(i, "ann") for i in range(30)]), path, "commits", shards=2, buckets=2)
    old = _rows(store.read(spark, path, "commits"))
    batch = _batch(spark, [_commit(i, "bo") for i in range(20, 40)])
    real = store._publish

    def lost(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(store, "_publish", lost)  # all files are written, the state is not
    with pytest.raises(KeyboardInterrupt):
        store.upsert_into(spark, path, "commits", batch, loaded_at=LOAD)
    assert _files(path, "gen-1") and _rows(store.read(spark, path, "commits")) == old
    os.remove(sorted(_files(path, "gen-1"))[0])  # and part of them is lost
    assert _rows(store.read(spark, path, "commits")) == old
    monkeypatch.setattr(store, "_publish", real)
    store.upsert_into(spark, path, "commits", batch, loaded_at=LOAD)
    got = {r.sha: r.author_login for r in store.read(spark, path, "commits").collect()}
    assert got == {str(i): "bo" if i >= 20 else "ann" for i in range(40)}


def test_two_writers_of_one_state_cannot_both_win(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "commits")
    state = store.create(_commits(spark, [_commit(1, "ann")]), path, "commits", shards=1, buckets=1)
    with pytest.raises(RuntimeError):
        store._publish(spark, path, state)
    with pytest.raises(ValueError):
        store.create(_commits(spark, [_commit(1, "ann")]), path, "commits", shards=1, buckets=1)


def test_null_key_fails_and_repeats_count_once(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "reviews")
    row = (5, "org/a", "ann", "User", "APPROVED", T(2024, 1, 3), None)
    batch = spark.createDataFrame([(*row, 1, 0), (*row, 1, 1), (*row, 1, 1), (*row[:3], "Member", *row[4:], 1, 2)],
                                  schemas.batch("reviews"))
    store.upsert_into(spark, path, "reviews", batch, loaded_at=LOAD, shards=2, buckets=2)
    store.upsert_into(spark, path, "reviews", batch, loaded_at=LOAD)
    assert _rows(store.read(spark, path, "reviews")) == [(*row[:3], "Member", *row[4:6], LOAD)]
    bad = spark.createDataFrame([(5, "org/a", "ann", "User", "APPROVED", None, None, 1, 0)], schemas.batch("reviews"))
    with pytest.raises(Exception, match="NULL in key column submitted_at"):
        store.upsert_into(spark, path, "reviews", bad, loaded_at=LOAD)
    assert store.read(spark, path, "reviews").count() == 1


def test_changed_groups_hold_old_and_new_values(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "commits")
    store.create(_commits(spark, [_commit(i, f"Ann{i % 5}") for i in range(20)]), path, "commits", shards=2, buckets=2)
    by = {"engineer_login": login_key("author_login"), "repo": F.col("repo")}
    store.upsert_into(spark, path, "commits", _batch(spark, [_commit(3, "Bo")]), loaded_at=LOAD)
    store.upsert_into(spark, path, "commits", _batch(spark, [_commit(99, "cy", repo="org/z")]), loaded_at=LOAD)
    assert _rows(store.changed(spark, path, "commits", by, 0)) == [("ann3", "org/a"), ("bo", "org/a"), ("cy", "org/z")]
    assert _rows(store.changed(spark, path, "commits", by, 1)) == [("cy", "org/z")]
    assert _rows(store.changed(spark, path, "commits", by, 2)) == []


def test_expired_states_go_and_the_table_stays(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "commits")
    for i in range(4):
        store.upsert_into(spark, path, "commits", _batch(spark, [_commit(j, f"p{i}") for j in range(0, 30, i + 1)]), loaded_at=LOAD,
                          shards=3, buckets=2)
    want, before = _rows(store.read(spark, path, "commits")), _rows(store.read(spark, path, "commits", 2))
    store.expire(spark, path, keep=2)
    assert store.layouts(spark, path) == [2, 3] and not _files(path, "gen-0") and not _files(path, "delta-1")
    assert _rows(store.read(spark, path, "commits")) == want and _rows(store.read(spark, path, "commits", 2)) == before
