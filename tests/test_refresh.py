"""Marts brought up to date by changed groups equal full builds, batch after batch."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from teampulse import schemas
from teampulse.plans import marts, refresh, staging
from teampulse.sources import store
from teampulse.sources.extract import KINDS

T = dt.datetime
AS_OF = T(2024, 2, 1)


def _day(rnd):
    return T(2024, 1, rnd.randint(1, 28), rnd.randint(0, 23))


def _rows(kind, ids, rnd, who=None):
    login = lambda: who or f"{rnd.choice(['Ann', 'bo', 'cy', 'DI'])}{rnd.randint(0, 3)}"
    repo = lambda i: f"org/r{i % 4}"
    out = []
    for place, i in enumerate(ids):
        if kind == "commits":
            row = (str(i), login(), "u", "User", f"feat: {i}", _day(rnd), repo(i), None)
        elif kind == "pull_requests":
            row = (i, repo(i), f" t{i} ", login(), "u", "User", "closed", _day(rnd), T(2024, 1, 1), _day(rnd), i % 3, i % 5, None)
        elif kind == "reviews":
            row = (i % 50, repo(i), login(), "User", rnd.choice(["APPROVED", "COMMENTED", "CHANGES_REQUESTED"]), _day(rnd), None)
        else:
            row = (i, repo(i), f"i{i}", "closed", login(), "User", T(2024, 1, 1), _day(rnd), _day(rnd), None)
        out.append((*row, place, 0))
    return out


def _load(spark, paths, kind, rows, shards=3):
    store.upsert_into(spark, paths[kind], kind, spark.createDataFrame(rows, schemas.batch(kind)), loaded_at=AS_OF, shards=shards, buckets=2)


def _sorted(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_three_batches_equal_full_builds(spark, tmpdir_path):
    rnd = random.Random(5)
    raw = {k: f"{tmpdir_path}/raw/{k}" for k in KINDS}
    mart = {m: f"{tmpdir_path}/marts/{m}" for m in ("impact", "weekly")}
    by_groups = []
    for batch in range(4):
        if batch == 0:
            for k in KINDS:
                _load(spark, raw, k, _rows(k, range(120), rnd))
        elif batch == 1:  # new rows, and rows that move to another engineer
            _load(spark, raw, "commits", _rows("commits", range(100, 160), rnd))
            _load(spark, raw, "issues", _rows("issues", range(20), rnd, who="zed"))
        elif batch == 2:  # the same table twice, and one repo whose engineers all stay as they were
            _load(spark, raw, "reviews", _rows("reviews", range(0, 200, 4), rnd))
            _load(spark, raw, "reviews", _rows("reviews", range(1, 200, 4), rnd, who="New"))
        by_groups.append(refresh.refresh(spark, raw, mart, AS_OF))
        stg = staging.staging({k: store.read(spark, p, k) for k, p in raw.items()})
        assert _sorted(refresh.read_mart(spark, mart["impact"])) == _sorted(marts.fct_engineer_impact(stg, AS_OF))
        assert _sorted(refresh.read_mart(spark, mart["weekly"])) == _sorted(marts.fct_engineer_weekly_trends(stg))
    assert by_groups == [False, True, True, True]
    # an engineer without any rows left goes from the mart, and a repo that no batch touched is not ranked again
    groups = refresh.changed_groups(spark, raw, {k: store.layout(spark, p).number for k, p in raw.items()})
    assert groups.count() == 0


def test_an_engineer_whose_rows_all_move_leaves_the_mart(spark, tmpdir_path):
    rnd = random.Random(6)
    raw = {k: f"{tmpdir_path}/raw/{k}" for k in KINDS}
    mart = {m: f"{tmpdir_path}/marts/{m}" for m in ("impact", "weekly")}
    _load(spark, raw, "commits", _rows("commits", range(0, 40, 4), rnd, who="gone") + _rows("commits", range(1, 40, 4), rnd, who="here"))
    refresh.refresh(spark, raw, mart, AS_OF)
    assert {r.engineer_login for r in refresh.read_mart(spark, mart["impact"]).collect()} == {"gone", "here"}
    _load(spark, raw, "commits", _rows("commits", range(0, 40, 4), rnd, who="heir"))
    assert refresh.refresh(spark, raw, mart, AS_OF)
    assert {r.engineer_login for r in refresh.read_mart(spark, mart["impact"]).collect()} == {"heir", "here"}
    assert {r.engineer_login for r in refresh.read_mart(spark, mart["weekly"]).where(F.col("commits") > 0).collect()} >= {"heir"}


def test_a_lost_refresh_leaves_the_old_marts(spark, tmpdir_path, monkeypatch):
    rnd = random.Random(7)
    raw = {k: f"{tmpdir_path}/raw/{k}" for k in KINDS}
    mart = {m: f"{tmpdir_path}/marts/{m}" for m in ("impact", "weekly")}
    with pytest.raises(LookupError):
        refresh.read_mart(spark, mart["impact"])
    _load(spark, raw, "commits", _rows("commits", range(40), rnd))
    refresh.refresh(spark, raw, mart, AS_OF)
    old = _sorted(refresh.read_mart(spark, mart["impact"]))
    _load(spark, raw, "commits", _rows("commits", range(40, 80), rnd))
    real, calls = store.put_text, []

    def second_is_lost(*args):
        calls.append(args)
        if len(calls) == 2:
            raise KeyboardInterrupt
        return real(*args)

    monkeypatch.setattr(store, "put_text", second_is_lost)  # the impact mart is new, the weekly one is not
    with pytest.raises(KeyboardInterrupt):
        refresh.refresh(spark, raw, mart, AS_OF)
    monkeypatch.setattr(store, "put_text", real)
    assert _sorted(refresh.read_mart(spark, mart["impact"])) != old
    assert not refresh.refresh(spark, raw, mart, AS_OF)  # the marts are of different states: built in full
    stg = staging.staging({k: store.read(spark, p, k) for k, p in raw.items()})
    assert _sorted(refresh.read_mart(spark, mart["weekly"])) == _sorted(marts.fct_engineer_weekly_trends(stg))


def test_empty_tables_have_empty_marts(spark, tmpdir_path):
    raw = {k: f"{tmpdir_path}/raw/{k}" for k in KINDS}
    mart = {m: f"{tmpdir_path}/marts/{m}" for m in ("impact", "weekly")}
    refresh.refresh(spark, raw, mart, AS_OF)
    assert refresh.refresh(spark, raw, mart, AS_OF)
    assert refresh.read_mart(spark, mart["impact"]).count() == refresh.read_mart(spark, mart["weekly"]).count() == 0
