"""What keeps a load's time in proportion to its rows: no schema defaults in the parse, one exchange of a batch, buckets by rows."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from teampulse import schemas
from teampulse.constants import UPDATE_COLS
from teampulse.operators.merge import condensed
from teampulse.plans import daily, refresh
from teampulse.sources import extract as X
from teampulse.sources import store
from teampulse.streaming.daily_load import in_landing_order

DOCUMENTS = [
    '{"number": 1, "title": "a"}',
    '{"number": 2, "review_comments": null, "comments": 4}',
    '{"number": 3, "review_comments": 2}',
    '{"number": 4, "review_comments": "two"}',
    '{"number": "x", "comments": 1}',
    '{"number": 5, "comments": 1, "comments": null}',
    '{"number": 6, "user": {"login": "a", "comments": 1}}',
    '{"number": 7, "user": "none"}',
    '{}', '[{"number": 8}]', '[]', 'null', '', 'no json', '{"number": 9', None,
]


def test_absent_counts_read_as_by_a_schema_default(spark):
    zero = {"CURRENT_DEFAULT": "0", "EXISTS_DEFAULT": "0"}
    names = schemas.ABSENT_IS_ZERO["pull_requests"]
    assert not any(f.metadata for f in schemas.PULL_PAYLOAD.fields)
    with_defaults = StructType([StructField(f.name, f.dataType, True, zero if f.name in names else None)
                                for f in schemas.PULL_PAYLOAD.fields])
    landed = spark.createDataFrame([("org/r", i, d) for i, d in enumerate(DOCUMENTS)], "repo string, _seq long, value string")
    got = X.parse(landed, "pull_requests")
    assert got.schema["d"].dataType.fieldNames() == schemas.PULL_PAYLOAD.fieldNames()
    want = landed.select("_seq", F.from_json("value", with_defaults).alias("d"))
    seen = {r["_seq"]: r["d"] for r in got.collect()}
    assert seen == {r["_seq"]: r["d"] for r in want.collect()}
    assert (seen[0].review_comments, seen[1].review_comments, seen[1].comments, seen[3].comments) == (0, None, 4, None)


def test_a_batch_is_exchanged_once(spark):
    keys, cols = schemas.KEYS["pull_requests"], schemas.RAW["pull_requests"].fieldNames()
    rows = spark.createDataFrame([], schemas.batch("pull_requests"))
    batch = condensed(rows, cols, keys, UPDATE_COLS["pull_requests"], partitions=4)
    plan = batch._jdf.queryExecution().sparkPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    initial = batch._jdf.queryExecution().executedPlan().toString()
    assert initial.count("Exchange hashpartitioning") == 1


def test_landed_rows_are_numbered_without_an_exchange_of_them(spark, tmpdir_path):
    X.land(spark.createDataFrame([("org/r", "{}")], "repo string, value string"), tmpdir_path + "/l")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        landed = in_landing_order(spark.read.text(tmpdir_path + "/l").select("*", "_metadata"))
        assert "SortMergeJoin" not in landed._jdf.queryExecution().executedPlan().toString()
        assert landed.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_daily_tables_get_buckets_by_rows(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(daily, "BUCKET_ROWS", 10)
    date = "2024-01-20T00:00:00Z"
    docs = {"commits": [f'{{"sha": "{i}", "author": {{"login": "a{i % 3}", "type": "User"}}, "commit": {{"message": "m", "author": {{"date": "{date}"}}}}}}'
                        for i in range(45)],
            "pull_requests": [f'{{"number": {i}, "user": {{"login": "a", "type": "User"}}, "merged_at": "{date}", "title": "t"}}' for i in range(3)],
            "reviews": [f'{{"pr_number": {i}, "reviews": [{{"user": {{"login": "b", "type": "User"}}, "state": "APPROVED", "submitted_at": "{date}"}}]}}'
                        for i in range(6)],
            "issues": [f'{{"number": 1, "closed_by": {{"login": "c", "type": "User"}}, "updated_at": "{date}", "closed_at": "{date}"}}']}
    landing = {kind: f"{tmpdir_path}/landing/{kind}" for kind in X.KINDS}
    for kind, path in landing.items():
        X.land(spark.createDataFrame([("org/r", d) for d in docs[kind]], "repo string, value string"), path)
    t = dt.datetime(2024, 1, 1)
    calls, real = [], X.extract_merged_prs
    monkeypatch.setattr(X, "extract_merged_prs", lambda *a, **k: calls.append(1) or real(*a, **k))
    paths = daily.run(spark, landing, f"{tmpdir_path}/warehouse", since=t, as_of=dt.datetime(2024, 2, 1), loaded_at=t, buckets=2)
    assert len(calls) == 1  # the PRs are parsed once for both kinds
    assert {kind: store.layout(spark, paths[kind]).buckets for kind in X.KINDS} == {"commits": 5, "pull_requests": 2, "reviews": 2, "issues": 2}
    got = {r.engineer_login: (r.commits, r.prs_merged, r.reviews) for r in refresh.read_mart(spark, paths["impact"]).collect()}
    assert got == {"a0": (15, 0, 0), "a1": (15, 0, 0), "a2": (15, 0, 0), "a": (0, 3, 0), "b": (0, 0, 3)}
