"""Daily load: two runs over landed files, merged by key (streaming/)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from teampulse.sources import extract as X
from teampulse.streaming import read_current, start_daily_load
from teampulse.streaming.daily_load import in_landing_order, merge_batch

T = dt.datetime


def _doc(number, login, title):
    return {"number": number, "title": title, "state": "closed",
            "user": {"login": login, "avatar_url": "u", "type": "User"},
            "merged_at": "2024-01-11T00:00:00Z", "created_at": "2024-01-10T00:00:00Z",
            "closed_at": "2024-01-11T00:00:00Z", "updated_at": "2024-01-11T00:00:00Z",
            "review_comments": 1, "comments": 2}


def test_two_daily_runs_upsert(spark, tmpdir_path):
    landing, table, ckpt = (os.path.join(tmpdir_path, p) for p in ("landing", "table", "ckpt"))

    def land(docs):
        X.land(spark.createDataFrame([("org/r", json.dumps(d)) for d in docs], "repo string, value string"),
               landing)

    def run(loaded_at):
        q = start_daily_load(spark, "pull_requests", landing, table, ckpt,
                             since=T(2024, 1, 1), loaded_at=loaded_at)
        q.awaitTermination(120)
        assert q.exception() is None

    land([_doc(1, "ann", "one"), _doc(2, "bo", "two")])
    run(T(2024, 1, 12, 2))
    land([_doc(2, "BO2", "two v2"), _doc(3, "cy", "three")])
    run(T(2024, 1, 13, 2))
    cur = {r.pr_number: (r.author_login, r.title, r.extracted_at)
           for r in read_current(spark, table, "pull_requests").collect()}
    assert cur == {1: ("ann", "one", T(2024, 1, 12, 2)),
                   2: ("bo", "two v2", T(2024, 1, 13, 2)),    # author is insert-only
                   3: ("cy", "three", T(2024, 1, 13, 2))}


def _lines(path, name, docs, mtime, pad=0):
    os.makedirs(path, exist_ok=True)
    full = os.path.join(path, name)
    with open(full, "w") as f:
        f.write("".join(json.dumps(d) + "\n" for d in docs) + " \n" * pad)
    os.utime(full, (mtime, mtime))


def _merge(spark, landing, table, batch_id, loaded_at=T(2024, 1, 12, 2)):
    landed = in_landing_order(spark.read.text(landing).select("*", "_metadata"))
    merge_batch(landed.withColumn("repo", F.lit("org/r")), batch_id, kind="pull_requests", table_path=table,
                since=T(2024, 1, 1), loaded_at=loaded_at)


def test_later_landed_file_wins_whatever_its_size(spark, tmpdir_path):
    for k, (old_pad, new_pad) in enumerate([(0, 5000), (5000, 0)]):
        landing, table = (os.path.join(tmpdir_path, f"{p}{k}") for p in ("landing", "table"))
        _lines(landing, "z.json", [_doc(1, "ann", "old")], 1_700_000_000, old_pad)
        _lines(landing, "a.json", [_doc(1, "ann", "new"), _doc(1, "ann", "newest")], 1_700_000_100, new_pad)
        _merge(spark, landing, table, 0)
        assert [r.title for r in read_current(spark, table, "pull_requests").collect()] == ["newest"]


def test_replayed_batch_gives_the_same_rows(spark, tmpdir_path):
    landing, table = (os.path.join(tmpdir_path, p) for p in ("landing", "table"))
    _lines(landing, "a.json", [_doc(i, "ann", f"t{i}") for i in range(5)], 1_700_000_000)
    _merge(spark, landing, table, 0)
    _lines(landing, "b.json", [_doc(i, "bo", f"u{i}") for i in range(3, 8)], 1_700_000_100)
    _merge(spark, landing, table, 1)
    first = sorted(map(tuple, read_current(spark, table, "pull_requests").collect()), key=str)
    _merge(spark, landing, table, 1)
    assert sorted(map(tuple, read_current(spark, table, "pull_requests").collect()), key=str) == first
    _merge(spark, landing, table, 2)
    assert sorted(d for d in os.listdir(table) if d.startswith("version=")) == ["version=1", "version=2"]


def test_unreadable_version_fails_the_batch(spark, tmpdir_path):
    landing, table = (os.path.join(tmpdir_path, p) for p in ("landing", "table"))
    _lines(landing, "a.json", [_doc(1, "ann", "t")], 1_700_000_000)
    assert read_current(spark, table, "pull_requests").count() == 0  # nothing written yet
    _merge(spark, landing, table, 0)
    for name in os.listdir(os.path.join(table, "version=0")):
        if name.endswith(".parquet"):
            with open(os.path.join(table, "version=0", name), "wb") as f:
                f.write(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet|read"):
        _merge(spark, landing, table, 1)
    assert not os.path.exists(os.path.join(table, "version=1", "_SUCCESS"))


def test_version_without_marker_does_not_count(spark, tmpdir_path):
    landing, table = (os.path.join(tmpdir_path, p) for p in ("landing", "table"))
    _lines(landing, "a.json", [_doc(1, "ann", "t")], 1_700_000_000)
    _merge(spark, landing, table, 0)
    os.makedirs(os.path.join(table, "version=1"))
    assert read_current(spark, table, "pull_requests").count() == 1
