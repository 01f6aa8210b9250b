"""Leaderboard, trends, summary, run roll-up and insights."""

import datetime as dt

import pytest

from teampulse.plans import insights as D
from teampulse.plans import marts, reports, runs, staging
from teampulse.schemas import RAW_COMMITS, RAW_ISSUES, RAW_PULL_REQUESTS, RAW_REVIEWS, TASK_STATES

T = dt.datetime
AS_OF = T(2024, 1, 31)
R = "org/x"


def _raw(spark, commits=(), prs=(), reviews=(), issues=()):
    return {"commits": spark.createDataFrame(list(commits), RAW_COMMITS),
            "pull_requests": spark.createDataFrame(list(prs), RAW_PULL_REQUESTS),
            "reviews": spark.createDataFrame(list(reviews), RAW_REVIEWS),
            "issues": spark.createDataFrame(list(issues), RAW_ISSUES)}


def c(sha, login, avatar, ts, repo=R):
    return (sha, login, avatar, "User", "feat: x", ts, repo, None)


def pr(n, login, ts, rc=1, cm=1, title="t", repo=R):
    return (n, repo, title, login, "a", "User", "closed", ts, ts, ts, rc, cm, None)


def rv(n, login, state, ts, repo=R):
    return (n, repo, login, "User", state, ts, None)


def iss(n, login, ts, repo=R):
    return (n, repo, "i", "closed", login, "User", ts, ts, ts, None)


def test_avatar_fan_out_and_issue_only(spark):
    # One engineer with two avatars appears twice with full PR counts;
    # T7-like: an issues-only engineer is dropped by the > 0 floor.
    day = T(2024, 1, 20)
    raw = _raw(spark, commits=[c("1", "Ann", "u1", day), c("2", "ann", "u2", day)],
               prs=[pr(1, "ANN", day), pr(2, "ann", day)], issues=[iss(1, "zed", day)])
    lb = reports.leaderboard(raw, R, as_of=AS_OF, days=30, limit=20).collect()
    rows = sorted((r.engineer_login, r.avatar_url, r.commits, r.prs_merged, r.impact_rank) for r in lb)
    assert rows == [("ann", "u1", 1, 2, 1), ("ann", "u2", 1, 2, 1)]


def test_one_row_per_engineer_option(spark):
    raw = _raw(spark, commits=[c("1", "Ann", "u1", T(2024, 1, 20)), c("2", "ann", "u2", T(2024, 1, 21))],
               prs=[pr(1, "ANN", T(2024, 1, 20))])
    lb = reports.leaderboard(raw, R, as_of=AS_OF, days=30, one_row_per_engineer=True).collect()
    assert [(r.engineer_login, r.avatar_url, r.commits, r.active_days, r.prs_merged) for r in lb] == [
        ("ann", "u2", 2, 2, 1)]


def test_rank_ties_and_limit(spark):
    # T5: two tied at rank 1, next rank 3; limit cuts by login tie-break
    day = T(2024, 1, 28)
    raw = _raw(spark, prs=[pr(1, "b", day), pr(2, "a", day), pr(3, "c", day), pr(4, "b", day),
                           pr(5, "a", day)])
    lb = reports.leaderboard(raw, R, as_of=AS_OF, days=7, limit=3).collect()
    assert [(r.engineer_login, r.impact_rank) for r in lb] == [("a", 1), ("b", 1), ("c", 3)]
    lb = reports.leaderboard(raw, R, as_of=AS_OF, days=7, limit=1).collect()
    assert [(r.engineer_login, r.impact_rank) for r in lb] == [("a", 1)]
    with pytest.raises(ValueError):
        reports.leaderboard(raw, R, as_of=AS_OF, days=10)
    with pytest.raises(ValueError):
        reports.leaderboard_page(raw, R, as_of=AS_OF, days=7, limit=21)


def test_trends_partial_week_and_not_found(spark):
    # The window cut falls mid-week; the first bucket is partial
    raw = _raw(spark, commits=[c("1", "Ann", "u", T(2024, 1, 24, 9)), c("2", "ann", "u", T(2024, 1, 23, 23))],
               reviews=[rv(1, "ANN", "CHANGES_REQUESTED", T(2024, 1, 29))])
    tr = reports.engineer_trends(raw, "aNN", R, as_of=AS_OF, days=7).collect()
    assert [(r.week_start, r.commits, r.reviews, r.changes_requested, r.weekly_impact_score) for r in tr] == [
        (T(2024, 1, 22), 1, 0, 0, 1), (T(2024, 1, 29), 0, 1, 1, 7)]
    with pytest.raises(LookupError):
        reports.require_rows(reports.engineer_trends(raw, "nobody", R, as_of=AS_OF, days=7), "nobody")


def test_team_summary_null_authors(spark):
    # NULL authors count in totals but not among engineers
    day = T(2024, 1, 20)
    raw = _raw(spark, commits=[c("1", None, None, day), c("2", "Ann", "u", day), c("3", "ann", "v", day)],
               reviews=[rv(1, "b", "DISMISSED", day)])
    r = reports.team_summary(raw, R, as_of=AS_OF, days=30).collect()[0]
    assert (r.total_engineers, r.total_commits, r.total_prs_merged, r.total_reviews,
            r.total_issues_closed) == (1, 3, 0, 1, 0)


def test_mart_floor_and_states(spark):
    # mart: floor > 2 excludes issues; DISMISSED reviews are not staged
    day = T(2024, 1, 20)
    raw = _raw(spark, commits=[c(str(i), "Ann", "u", day) for i in range(2)],
               reviews=[rv(1, "ann", "DISMISSED", day), rv(2, "bo", "APPROVED", day),
                        rv(3, "bo", "COMMENTED", day), rv(4, "bo", "CHANGES_REQUESTED", day)],
               issues=[iss(i, "ann", day) for i in range(50)])
    m = marts.fct_engineer_impact(staging.staging(raw), AS_OF).collect()
    assert [(r.engineer_login, r.reviews, r.approvals, r.review_comments_given, r.impact_rank) for r in m] == [
        ("bo", 3, 1, 1, 1)]


def test_weekly_null_week_row(spark):
    raw = _raw(spark, commits=[c("1", "Ann", "u", None), c("2", "Ann", "u", None), c("3", "Ann", "u", T(2024, 1, 2))])
    w = marts.fct_engineer_weekly_trends(staging.staging(raw)).collect()
    assert sorted((r.week_start is None, r.commits) for r in w) == [(False, 1), (True, 2)]


def test_run_rollup(spark):
    # Only tracked tasks count; NULL -> unknown; absent task is fine; latest attempt wins
    rows = [(1, "extract_issues", "failed", 5, T(2024, 1, 1, 1), R),
            (1, "extract_reviews", None, 3, T(2024, 1, 1, 2), R),
            (1, "extract_commits", "failed", 7, T(2024, 1, 1, 3), R),
            (1, "extract_commits", "success", 9, T(2024, 1, 1, 4), R),
            (1, "log_pipeline_run", "failed", 0, T(2024, 1, 1, 5), R),
            (2, "extract_pull_requests", "success", 4, T(2024, 1, 2), R),
            (3, "log_pipeline_run", "success", 0, T(2024, 1, 3), R)]
    got = {r.run_at: r for r in runs.rollup_runs(spark.createDataFrame(rows, TASK_STATES)).collect()}
    r1 = got[T(2024, 1, 1, 5)]
    assert r1.status == "failed"
    assert r1.error_message == "Unsuccessful tasks: extract_issues=failed, extract_reviews=unknown"
    assert (r1.commits_loaded, r1.prs_loaded, r1.reviews_loaded, r1.issues_loaded) == (9, 0, 0, 0)
    r2 = got[T(2024, 1, 2)]
    assert (r2.status, r2.error_message, r2.prs_loaded) == ("success", None, 4)
    assert got[T(2024, 1, 3)].status == "success"


def _board(spark, rows):
    cols = ("engineer_login string, avatar_url string, commits long, prs_merged long, reviews long, "
            "changes_requested long, approvals long, issues_closed long")
    df = spark.createDataFrame(rows, cols)
    from teampulse.plans.marts import score_columns
    from teampulse.operators.ranking import rank_top_k
    return rank_top_k(df.select("*", *score_columns()), "impact_score", ["engineer_login", "avatar_url"],
                      20, "impact_rank")


def test_team_insight_ties_go_to_later_row_and_ratio(spark):
    # Equal PR counts -> the later row in board order wins; T14: no reviews -> NULL ratio
    lb = _board(spark, [("a", "", 0, 2, 0, 0, 0, 5), ("b", "", 0, 2, 0, 0, 0, 0)])
    r = D.team_insight(lb).collect()[0]
    assert (r.top_shipper, r.ship_review_ratio, r.review_heavy) == ("b", None, False)
    assert r.top_reviewer is None  # same login as top shipper (both 0 reviews -> later row 'b')
    lb2 = _board(spark, [("a", "", 0, 3, 1, 0, 0, 0), ("b", "", 0, 0, 2, 1, 0, 0)])
    r2 = D.team_insight(lb2).collect()[0]
    assert (r2.total_shipping, r2.total_reviewing, r2.ship_review_ratio) == (24, 13, 1.8)
    assert (r2.top_shipper, r2.top_reviewer, r2.top_reviewer_reviews) == ("a", "b", 3)


def test_badges_and_bars(spark):
    lb = _board(spark, [("a", "", 30, 10, 5, 3, 0, 0), ("b", "", 1, 0, 1, 0, 0, 0), ("c", "", 40, 1, 0, 0, 0, 0)])
    rel = {r.engineer_login: r.profile for r in D.profile_badge_relative(lb).collect()}
    assert rel == {"a": "All-Rounder", "b": "Code Reviewer", "c": "Code Engine"}
    ab = {r.engineer_login: r.profile for r in D.profile_badge_absolute(lb).collect()}
    assert ab == {"a": "All-Rounder", "b": "Code Reviewer", "c": "Code Engine"}
    comp = D.score_composition(lb).where("engineer_login = 'b'").collect()
    assert [(r.component, r.points) for r in comp] == [("Reviews", 3), ("Commits", 1)]
    fill = {r.metric: r.pct for r in D.metric_fill(lb).where("engineer_login = 'c'").collect()}
    assert fill["Commits"] == 100.0 and fill["PRs"] == 4.0
    pod = D.podium(lb).collect()
    assert sorted((r.position, r.slot) for r in pod) == [(1, 2), (2, 1), (3, 3)]
    assert D.podium(_board(spark, [("a", "", 1, 0, 0, 0, 0, 0)])).count() == 0


def test_full_board_ranks_everyone_and_titles_are_newest_first(spark):
    day = T(2024, 1, 28)
    prs = [pr(i, f"e{i % 40}", day, title=f"t{i}") for i in range(100)]
    raw = _raw(spark, prs=prs)
    full = reports.leaderboard(raw, R, as_of=AS_OF, days=7, limit=None)
    rows = {r.engineer_login: r for r in full.collect()}
    assert len(rows) == 40
    assert rows["e0"].recent_pr_titles == ["t80", "t40", "t0"] and rows["e39"].recent_pr_titles == ["t79", "t39"]
    page = reports.leaderboard(raw, R, as_of=AS_OF, days=7, limit=25).collect()
    assert len(page) == 25 and all(rows[r.engineer_login].impact_rank == r.impact_rank for r in page)


def test_complete_titles_are_sorted(spark):
    raw = _raw(spark, prs=[pr(i, f"E{i % 3}", T(2024, 1, 1 + i % 20), title=None if i % 7 == 0 else f" t{i} ") for i in range(60)])
    rows = marts.ordered_pr_titles(staging.stg_pull_requests(raw["pull_requests"])).collect()
    keys = [(r.repo, r.engineer_login, -r.merged_at.timestamp(), -r.pr_number) for r in rows]
    assert keys == sorted(keys) and len(rows) == 51 and rows[0].title.startswith("t")


def test_empty_board_insight_is_zero(spark):
    lb = reports.leaderboard_page(_raw(spark), R, as_of=AS_OF, days=7)
    row = D.team_insight(lb).first()
    assert (row.total_shipping, row.total_reviewing, row.review_heavy, row.ship_review_ratio) == (0, 0, False, None)
    assert D.podium(lb).count() == 0 and D.profile_badge_relative(lb).count() == 0


def test_mean_hours_do_not_depend_on_row_order(spark):
    from pyspark.sql import functions as F
    from teampulse.functions import elapsed_micros, mean_hours

    rows = [(T(2024, 1, 1), T(2024, 1, 1, i % 24, i % 60, 7 * i % 60, 13 * i)) for i in range(500)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    want = sum((b - a).total_seconds() for a, b in rows) / 500 / 3600
    got = {df.repartition(n).orderBy(F.rand(n)).agg(mean_hours(elapsed_micros("a", "b"))).first()[0] for n in (1, 3, 7)}
    assert len(got) == 1 and abs(got.pop() - want) < 1e-9


def test_weekly_table_is_written_sorted(spark, tmpdir_path):
    import pyarrow.parquet as pq

    raw = _raw(spark, commits=[c(str(i), f"e{i % 9}", "a", T(2024, 1, 1 + i % 28)) for i in range(300)])
    marts.write_weekly_trends(marts.fct_engineer_weekly_trends(staging.staging(raw)), tmpdir_path)
    import glob
    files = glob.glob(f"{tmpdir_path}/repo=*/*.parquet")
    for name in files:
        t = pq.ParquetFile(name).read()
        keys = list(zip(t["engineer_login"].to_pylist(), t["week_start"].to_pylist()))
        assert keys == sorted(keys)
    assert files
