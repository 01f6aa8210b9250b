"""Column helpers and staging traps (T1, T2, T12, T18, P-functions)."""

import datetime as dt

from pyspark.sql import Row
from pyspark.sql import functions as F

from teampulse.functions import commit_type, discussion_level, is_bot, week_start
from teampulse.plans.staging import stg_commits, stg_issues, stg_pull_requests
from teampulse.schemas import RAW_COMMITS, RAW_ISSUES, RAW_PULL_REQUESTS, REVIEW_USER, USER

T = dt.datetime


def test_commit_type_uses_untrimmed_message(spark):
    # T2: ' feat: x' -> other (leading space); 'fixture' -> fix; 'testing' -> test; NULL -> other
    df = spark.createDataFrame([(" feat: x",), ("fixture",), ("testing",), ("FEAT: y",), (None,), ("docs",)],
                               "m string")
    got = [r.t for r in df.select(commit_type(F.col("m")).alias("t")).collect()]
    assert got == ["other", "fix", "test", "feature", "other", "docs"]


def test_discussion_level_null_is_high(spark):
    df = spark.createDataFrame([(0,), (3,), (4,), (10,), (11,), (None,)], "t int")
    got = [r.l for r in df.select(discussion_level(F.col("t")).alias("l")).collect()]
    assert got == ["no-discussion", "low", "medium", "medium", "high", "high"]


def test_stg_pull_requests_shadowed_columns(spark):
    # (review_comments NULL, comments 2) -> (0, 2, NULL, 'high')
    row = (1, "r", "  t ", "Bob", "a", "User", "closed", T(2024, 1, 2), T(2024, 1, 1), T(2024, 1, 2),
           None, 2, T(2024, 1, 3))
    df = spark.createDataFrame([row], RAW_PULL_REQUESTS)
    r = stg_pull_requests(df).collect()[0]
    assert (r.review_comments, r.comments, r.total_discussion, r.discussion_level) == (0, 2, None, "high")
    assert r.title == "t" and r.engineer_login == "bob"


def test_stg_commits_trim_and_classify(spark):
    rows = [("1", "Ann", "a", "User", " feat: x  ", T(2024, 1, 1, 10), "r", T(2024, 1, 3)),
            ("2", None, "a", "User", "fix", T(2024, 1, 1), "r", T(2024, 1, 3))]
    got = stg_commits(spark.createDataFrame(rows, RAW_COMMITS)).collect()
    assert len(got) == 1  # NULL author dropped
    assert got[0].message == "feat: x" and got[0].commit_type == "other"
    assert got[0].commit_date == dt.date(2024, 1, 1)


def test_hours_to_close_negative_and_null(spark):
    rows = [(1, "r", " i ", "closed", "Ann", "User", T(2024, 1, 2), T(2024, 1, 1), None, None),
            (2, "r", " i ", "closed", "Ann", "User", None, T(2024, 1, 1), None, None),
            (3, "r", " i ", "closed", "Ann", "User", T(2024, 1, 1), None, None, None)]
    got = {r.issue_number: r.hours_to_close for r in stg_issues(spark.createDataFrame(rows, RAW_ISSUES)).collect()}
    assert got == {1: -24.0, 2: None}  # closed_at NULL dropped


def test_week_start_is_monday(spark):
    df = spark.createDataFrame([(T(2024, 1, 1, 5),), (T(2024, 1, 7, 23),), (T(2024, 1, 8),), (None,)],
                               "ts timestamp_ntz")
    got = [r.w for r in df.select(week_start("ts").alias("w")).collect()]
    assert got == [T(2024, 1, 1), T(2024, 1, 1), T(2024, 1, 8), None]


def test_is_bot_rules(spark):
    users = [None, Row(login=None, avatar_url=None, type=None), Row(login="x", avatar_url=None, type="Bot"),
             Row(login="Dependabot", avatar_url=None, type="User"), Row(login="foo[bot]", avatar_url=None, type="User"),
             Row(login="foo[BOT]", avatar_url=None, type="User"), Row(login="ann", avatar_url=None, type="User")]
    from pyspark.sql.types import StructField, StructType
    df = spark.createDataFrame([(u,) for u in users], StructType([StructField("u", USER)]))
    got = [r.b for r in df.select(is_bot(F.col("u")).alias("b")).collect()]
    # '[bot]' is case-sensitive: 'foo[BOT]' is a person
    assert got == [True, True, True, True, True, False, False]
    df2 = spark.createDataFrame([(Row(login="org-bot", type="User"),)], StructType([StructField("u", REVIEW_USER)]))
    assert df2.select(is_bot(F.col("u"), extra_bots=("Org-Bot",)).alias("b")).collect()[0].b is True
