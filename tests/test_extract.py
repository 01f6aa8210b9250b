"""Landed JSON -> raw rows."""

import datetime as dt
import json

from pyspark.sql import functions as F

from teampulse.sources import extract as X

T = dt.datetime
SINCE = T(2024, 1, 10, 12, 0, 0, 500000)


def _landed(spark, docs, repo="org/r"):
    return spark.createDataFrame([(repo, json.dumps(d)) for d in docs], "repo string, value string")


def test_commits_file_round_trip(spark, tmpdir_path):
    docs = [
        {"sha": "a", "author": {"login": "Ann", "avatar_url": "u", "type": "User"},
         "commit": {"message": "x" * 600, "author": {"date": "2024-01-11T00:00:00Z"}}},
        {"sha": "b", "author": None, "commit": {"message": "m", "author": {"date": "2024-01-11T00:00:00Z"}}},
        {"sha": "c", "author": {"login": "renovate[bot]", "type": "User"},
         "commit": {"message": "m", "author": {"date": "2024-01-11T00:00:00Z"}}},
        {"sha": "d", "author": {"login": "Bo", "type": "User"},
         "commit": {"message": "m", "author": {"date": "2024-01-01T00:00:00Z"}}},
    ]
    X.land(_landed(spark, docs), tmpdir_path)
    landed = X.read_landed(spark, tmpdir_path)
    got = X.extract_commits(landed, SINCE).collect()
    assert [r.sha for r in got] == ["a"]
    assert len(got[0].message) == 600 and got[0].repo == "org/r"
    assert len(X.extract_commits(landed, SINCE, message_chars=500).first().message) == 500
    assert got[0].committed_at == T(2024, 1, 11)


def test_prs_missing_key_is_zero_null_stays_null(spark):
    user = {"login": "Ann", "avatar_url": "u", "type": "User"}
    base = {"title": "t", "state": "closed", "user": user, "created_at": "2024-01-11T00:00:00Z",
            "closed_at": "2024-01-11T00:00:00Z", "updated_at": "2024-01-11T00:00:00Z"}
    docs = [
        {**base, "number": 1, "merged_at": "2024-01-11T00:00:00Z"},                        # keys missing
        {**base, "number": 2, "merged_at": "2024-01-11T00:00:00Z", "review_comments": None, "comments": 4},
        {**base, "number": 3, "merged_at": ""},                                              # falsy
        {**base, "number": 4, "merged_at": None},
        {**base, "number": 5, "merged_at": "2024-01-10T12:00:00Z"},                          # same second
        {**base, "number": 6, "merged_at": "2024-01-10T11:59:59Z"},                          # earlier
        {**base, "number": 7, "merged_at": "2024-01-11T00:00:00Z", "user": {"login": "x", "type": "Bot"}},
    ]
    got = {r.pr_number: (r.review_comments, r.comments)
           for r in X.extract_merged_prs(_landed(spark, docs), SINCE).collect()}
    assert got == {1: (0, 0), 2: (None, 4), 5: (0, 0)}


def test_reviews_explode_and_drop_incomplete(spark):
    docs = [{"pr_number": 9, "reviews": [
        {"user": {"login": "ann", "type": "User"}, "state": "APPROVED", "submitted_at": "2024-01-11T00:00:00Z"},
        {"user": {"login": "", "type": "User"}, "state": "APPROVED", "submitted_at": "2024-01-11T00:00:00Z"},
        {"user": {"login": "bo", "type": "User"}, "state": "", "submitted_at": "2024-01-11T00:00:00Z"},
        {"user": {"login": "cy", "type": "User"}, "state": "COMMENTED", "submitted_at": None},
        {"user": {"login": "codecov[bot]", "type": "User"}, "state": "COMMENTED",
         "submitted_at": "2024-01-11T00:00:00Z"},
        {"user": None, "state": "COMMENTED", "submitted_at": "2024-01-11T00:00:00Z"}]}]
    got = X.extract_reviews(_landed(spark, docs)).collect()
    assert [(r.pr_number, r.reviewer_login, r.state) for r in got] == [(9, "ann", "APPROVED")]


def test_issues_drop_pull_requests_and_old_closes(spark):
    closer = {"login": "ann", "type": "User"}
    base = {"title": "t", "state": "closed", "closed_by": closer, "created_at": "2024-01-01T00:00:00Z",
            "updated_at": "2024-01-12T00:00:00Z"}
    docs = [
        {**base, "number": 1, "closed_at": "2024-01-11T00:00:00Z"},
        {**base, "number": 2, "closed_at": "2024-01-11T00:00:00Z", "pull_request": {"url": "u"}},
        {**base, "number": 3, "closed_at": "2024-01-09T00:00:00Z"},
        {**base, "number": 4, "closed_at": None},
        {**base, "number": 5, "closed_at": "2024-01-11T00:00:00Z", "closed_by": None},
        {**base, "number": 6, "closed_at": "2024-01-11T00:00:00Z", "updated_at": "2024-01-01T00:00:00Z"},
        {**base, "number": 7, "closed_at": "2024-01-11T00:00:00Z", "pull_request": {"html_url": "u"}},
        {**base, "number": 8, "closed_at": "2024-01-11T00:00:00Z", "pull_request": {}},
        {**base, "number": 9, "closed_at": "2024-01-11T00:00:00Z", "pull_request": None},
    ]
    got = sorted(r.issue_number for r in X.extract_closed_issues(_landed(spark, docs), SINCE).collect())
    assert got == [1, 8, 9]  # any object that is not empty marks a pull request


def test_reviews_of_all_filtered_prs(spark):
    prs = spark.createDataFrame([("org/r", i) for i in range(1, 101)], "repo string, pr_number int")
    reviews = spark.createDataFrame([("org/r", i, "x") for i in range(1, 201)] + [("org/s", 1, "x")],
                                    "repo string, pr_number int, reviewer_login string")
    got = sorted(r.pr_number for r in X.reviews_of(prs, reviews).collect())
    assert got == list(range(1, 101))


def test_offsets_are_instants_in_any_session_zone(spark):
    dates = ["2024-01-11T12:00:00+02:00", "2024-01-11T12:00:00Z", "2024-01-11T12:00:00", "2024-03-10T02:30:00-0800",
             "2024-11-03T09:30:00Z", "yesterday", "", None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(dates)], "i int, s string")
    want = [T(2024, 1, 11, 10), T(2024, 1, 11, 12), T(2024, 1, 11, 12), T(2024, 3, 10, 10, 30), T(2024, 11, 3, 9, 30),
            None, None, None]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [r.t for r in df.select("i", X.instant(F.col("s")).alias("t")).orderBy("i").collect()] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_unreadable_dates_are_counted(spark):
    docs = [{"sha": str(i), "commit": {"author": {"date": d}}} for i, d in enumerate(["2024-01-01T00:00:00Z", "soon", "", None])]
    parsed = X.parse(_landed(spark, docs), "commits")
    assert tuple(X.unreadable_dates(parsed, "commits").first()) == (4, 1)


def test_one_parse_per_document(spark):
    landed = _landed(spark, [{}])
    plans = [X.extract_commits(landed, SINCE), X.extract_merged_prs(landed, SINCE), X.extract_reviews(landed),
             X.extract_closed_issues(landed, SINCE)]
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1 and "json_object_keys" not in plan


def test_listed_bot_accounts(spark):
    from teampulse.functions import is_bot

    rows = [("dependabot",), ("POSTHOG-BOT",), ("ci[bot]",), ("ci[BOT]",), ("ann",)]
    df = spark.createDataFrame(rows, "login string").select(F.struct("login", F.lit("User").alias("type")).alias("u"))
    assert [r[0] for r in df.select(is_bot("u")).collect()] == [True, True, True, False, False]
