"""Registered queries: one per operator of the inventory, each reading the
driver's test tables (via ``sources.fixtures``) in full.

``queries()[name](spark, sf_dir) -> DataFrame``; the matching DuckDB SQL is in
``teampulse.oracle``, which states the parameters again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from teampulse import constants as K
from teampulse import schemas
from teampulse.functions import in_window, is_bot
from teampulse.functions import sql as SQL
from teampulse.operators.merge import upsert
from teampulse.operators.ranking import positions
from teampulse.plans import aggregates as A
from teampulse.plans import insights as D
from teampulse.plans import daily, marts, refresh, reports, runs, staging
from teampulse.session import scratch_path
from teampulse.sources import extract as X
from teampulse.sources import fixtures as FX
from teampulse.sources import raw as R
from teampulse.sources import lookup, store, variant

# --- fixed query parameters ------------------------
AS_OF = FX.AS_OF
REPO = "org/repo0"
SINCE = dt.datetime(2024, 1, 15, 12, 0, 0, 500000)
LOGIN = "Eng-8"
BOARD_DAYS = 30
BOARD_LIMIT = 10
WINDOW_LIMIT = K.MAX_LIMIT
TREND_DAYS = 30
SUMMARY_DAYS = 30
FLAGSHIP_DAYS = 15

BUCKETS = 4
TITLE_PAGE = 5
LOOKUP_BUCKETS = 8

Query = Callable[[SparkSession, str], DataFrame]


def _raw(spark, sf_dir):
    return FX.raw_tables(spark, sf_dir)


def _stg(spark, sf_dir):
    return staging.staging(_raw(spark, sf_dir))


def _board(spark, sf_dir, days=BOARD_DAYS, limit=BOARD_LIMIT, titles=0):
    return reports.leaderboard(_raw(spark, sf_dir), REPO, as_of=AS_OF, days=days, limit=limit, title_count=titles)


def _trends(spark, sf_dir):
    return reports.engineer_trends(_raw(spark, sf_dir), LOGIN, REPO, as_of=AS_OF, days=TREND_DAYS)


def _runs(spark, sf_dir):
    return runs.rollup_runs(_raw(spark, sf_dir)["task_states"])


# --- extraction -------------------------------------------------------------

def _landed(spark, sf_dir, kind):
    raw = _raw(spark, sf_dir)
    build = {"commits": FX.commit_payloads, "pull_requests": FX.pull_payloads,
             "reviews": FX.review_payloads, "issues": FX.issue_payloads}[kind]
    return build(raw[kind])


def q_extract_commits(spark, sf_dir):
    return X.extract_commits(_landed(spark, sf_dir, "commits"), SINCE)


def q_extract_merged_prs(spark, sf_dir):
    return X.extract_merged_prs(_landed(spark, sf_dir, "pull_requests"), SINCE)


def q_extract_reviews(spark, sf_dir):
    return X.extract_reviews(_landed(spark, sf_dir, "reviews"))


def q_extract_closed_issues(spark, sf_dir):
    return X.extract_closed_issues(_landed(spark, sf_dir, "issues"), SINCE)


def q_bot_filter(spark, sf_dir):
    d = F.col("d")
    return X.parse(_landed(spark, sf_dir, "commits"), "commits").select(
        d["sha"].alias("sha"), "repo", is_bot(d["author"]).alias("is_bot"))


def q_merged_pr_reviews(spark, sf_dir):
    prs = X.extract_merged_prs(_landed(spark, sf_dir, "pull_requests"), SINCE)
    reviews = X.extract_reviews(_landed(spark, sf_dir, "reviews"))
    return X.reviews_of(prs, reviews)


def q_tagged_load(spark, sf_dir):
    rows = X.extract_closed_issues(_landed(spark, sf_dir, "issues"), SINCE)
    return X.tag_load(rows, FX.RELOADED_AT)


def q_unreadable_dates(spark, sf_dir):
    parts = [X.unreadable_dates(X.parse(_landed(spark, sf_dir, kind), kind), kind).select(F.lit(kind).alias("kind"), "*")
             for kind in X.DATES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- stored raw tables ------------------------------------------------------

def q_raw_commits_stored(spark, sf_dir):
    path = scratch_path(spark, "raw-commits")
    R.write_table(_raw(spark, sf_dir)["commits"], path, sort_by=("committed_at",))
    return R.read_raw(spark, path, "commits").where((F.col("repo") == REPO) & in_window("committed_at", AS_OF, BOARD_DAYS))


def q_staging_views(spark, sf_dir):
    staging.register_views(spark, _stg(spark, sf_dir))
    return spark.sql("""
        SELECT p.repo, p.engineer_login, count(*) AS reviewed_prs, count(DISTINCT r.engineer_login) AS reviewers
        FROM stg_pull_requests p JOIN stg_reviews r ON r.repo = p.repo AND r.pr_number = p.pr_number
        GROUP BY p.repo, p.engineer_login""")


def q_required_trends(spark, sf_dir):
    return reports.require_rows(_trends(spark, sf_dir), LOGIN)


# --- upserts and sinks ------------------------------------------------------

def _upsert(table):
    def q(spark, sf_dir):
        raw = _raw(spark, sf_dir)[table]
        id_col, changed = FX.upsert_changes(table)
        existing, incoming = FX.upsert_batches(raw, id_col, changed)
        return upsert(existing, incoming, schemas.KEYS[table], K.UPDATE_COLS[table],
                      seq_col="_seq", loaded_at=FX.RELOADED_AT)
    return q


def q_upsert_commits_bucketed(spark, sf_dir):
    """The same merge on a stored table laid out by key bucket."""
    raw = _raw(spark, sf_dir)["commits"]
    id_col, changed = FX.upsert_changes("commits")
    existing, incoming = FX.upsert_batches(raw, id_col, changed)
    path = scratch_path(spark, "raw-bucketed")
    store.create(existing, path, "commits", shards=BUCKETS, buckets=BUCKETS)
    store.upsert_into(spark, path, "commits", incoming, seq_col="_seq", loaded_at=FX.RELOADED_AT)
    return store.read(spark, path, "commits")


def _impact(df):
    """The mart or board with its title array as one string (arrays compare badly across engines)."""
    return df.withColumn("recent_pr_titles", F.array_join("recent_pr_titles", "|"))


def q_mart_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "mart-impact")
    R.write_mart(marts.fct_engineer_impact(_stg(spark, sf_dir), AS_OF), path,
                 sort_by=("impact_rank",))
    return _impact(spark.read.parquet(path))


def q_mart_rebuild(spark, sf_dir):
    """Two full builds; the second has no rows of one repo, which must leave the mart."""
    path = scratch_path(spark, "mart-rebuild")
    stg = _stg(spark, sf_dir)
    R.write_mart(marts.fct_engineer_impact(stg, AS_OF), path)
    fewer = {name: df.where(F.col("repo") != REPO) for name, df in stg.items()}
    R.write_mart(marts.fct_engineer_impact(fewer, AS_OF), path)
    return _impact(spark.read.parquet(path))


def q_weekly_trends_table(spark, sf_dir):
    path = scratch_path(spark, "mart-weekly")
    marts.write_weekly_trends(marts.fct_engineer_weekly_trends(_stg(spark, sf_dir)), path)
    return spark.read.parquet(path)


def q_pipeline_run_append(spark, sf_dir):
    """Two appends to the run log; the failed runs come without counts, which read 0."""
    path, rolled_at = scratch_path(spark, "pipeline-runs"), scratch_path(spark, "rolled")
    _runs(spark, sf_dir).write.parquet(rolled_at)
    rolled = spark.read.parquet(rolled_at)
    counts = [c for c, _ in K.COUNT_TASKS]
    R.append_run(rolled.where(F.col("status") == K.STATUS_SUCCESS), path)
    R.append_run(rolled.where(F.col("status") != K.STATUS_SUCCESS)
                 .withColumns({c: F.lit(None).cast("int") for c in counts}), path)
    return R.read_runs(spark, path)


NUMBER = {"commits": "CAST(sha AS BIGINT)", "pull_requests": "pr_number", "reviews": "pr_number", "issues": "issue_number"}


def _daily(spark, sf_dir, days=1):
    """The daily run over all landed documents; with several days, over a part of them each day."""
    store_path = scratch_path(spark, "daily")
    raw = _raw(spark, sf_dir)
    build = {"commits": FX.commit_payloads, "pull_requests": FX.pull_payloads,
             "reviews": FX.review_payloads, "issues": FX.issue_payloads}
    for day in range(days):
        landing = {}
        for kind in X.KINDS:
            landing[kind] = f"{store_path}/landing-{day}/{kind}"
            X.land(build[kind](raw[kind].where(F.expr(f"{NUMBER[kind]} % {days}") == day)), landing[kind])
        paths = daily.run(spark, landing, f"{store_path}/warehouse", since=SINCE, as_of=AS_OF, loaded_at=FX.RELOADED_AT,
                          buckets=BUCKETS, run_id=f"day-{day}")
    return paths


def q_daily_pipeline(spark, sf_dir):
    return _impact(refresh.read_mart(spark, _daily(spark, sf_dir)["impact"]))


def q_daily_pipeline_run(spark, sf_dir):
    return R.read_runs(spark, _daily(spark, sf_dir)["runs"])


def q_daily_refresh_impact(spark, sf_dir):
    """The impact mart after three daily loads, the second and third by changed groups."""
    return _impact(refresh.read_mart(spark, _daily(spark, sf_dir, days=3)["impact"]))


def q_daily_refresh_weekly(spark, sf_dir):
    return refresh.read_mart(spark, _daily(spark, sf_dir, days=3)["weekly"])


# --- ranks, pages and states of any size ---------------------------------------

def q_leaderboard_positions(spark, sf_dir):
    """The whole board with the place and the rank of every row."""
    return reports.leaderboard(_raw(spark, sf_dir), REPO, as_of=AS_OF, days=BOARD_DAYS, limit=None, with_position=True,
                               title_count=0)


def q_impact_positions(spark, sf_dir):
    """Place and rank of every engineer in every repo, by the score of the mart."""
    scored = marts.scored_activity(_stg(spark, sf_dir), title_count=0)
    return positions(scored.select("repo", "engineer_login", "impact_score"), ["repo"], "impact_score",
                     [F.col("engineer_login").asc()], row_number="place", rank="impact_rank")


def q_pr_title_pages(spark, sf_dir):
    pages = marts.pr_title_pages(_stg(spark, sf_dir)["pull_requests"], TITLE_PAGE)
    return pages.withColumn("titles", F.array_join("titles", "|"))


def q_active_days_merged(spark, sf_dir):
    """Active days from the merged states of three loads."""
    commits = _stg(spark, sf_dir)["commits"]
    parts = [A.active_day_states(commits.where(F.col("sha").cast("long") % 3 == i)) for i in range(3)]
    return A.active_days(A.merged_day_states(*parts))


def q_leaderboard_all_windows(spark, sf_dir):
    return reports.window_boards(_raw(spark, sf_dir), REPO, as_of=AS_OF, limit=WINDOW_LIMIT)


def q_engineer_trends_lookup(spark, sf_dir):
    """The trends of one engineer from the layout for look-ups."""
    path = scratch_path(spark, "lookup")
    lookup.write(_raw(spark, sf_dir), path, LOOKUP_BUCKETS)
    return reports.engineer_trends(lookup.read(spark, path, LOGIN, LOOKUP_BUCKETS), LOGIN, REPO, as_of=AS_OF, days=TREND_DAYS)


def _variant(extract, kind, *args):
    return lambda spark, sf_dir: extract(variant.parse(_landed(spark, sf_dir, kind), kind), *args)


def q_field_states(spark, sf_dir):
    """Fields of landed documents that were absent, null, mistyped or given, all four kinds."""
    parts = [variant.field_states(_landed(spark, sf_dir, kind), kind) for kind in X.KINDS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# --- SQL functions and views --------------------------------------------------

def _sql(text):
    def q(spark, sf_dir):
        SQL.register(spark, _raw(spark, sf_dir))
        return spark.sql(text)
    return q


SQL_TEXTS = {
    "sql_commit_kinds": """
        SELECT repo, commit_kind(message) AS commit_type, count(*) AS commits, count_if(is_bot(author_login, author_type)) AS by_bots
        FROM raw_commits GROUP BY repo, commit_kind(message)""",
    "sql_discussion_levels": """
        SELECT repo, discussion_level, count(*) AS prs, sum(total_discussion) AS discussion
        FROM v_pull_requests GROUP BY repo, discussion_level""",
    "sql_weekly_points": """
        SELECT engineer_login, repo, week_of(submitted_at) AS week_start, count(*) AS reviews,
               impact_points(0L, sum(is_changes_requested), count(*), 0L, 0L, sum(is_approval)) AS points
        FROM v_reviews GROUP BY engineer_login, repo, week_of(submitted_at)""",
}


# --- registry ---------------------------------------------------------------

def _leaderboard_days(days):
    return lambda spark, sf_dir: _board(spark, sf_dir, days=days, limit=WINDOW_LIMIT)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        # sources / extraction
        "extract_commits": q_extract_commits,
        "extract_merged_prs": q_extract_merged_prs,
        "extract_reviews": q_extract_reviews,
        "extract_closed_issues": q_extract_closed_issues,
        "bot_filter": q_bot_filter,
        "merged_pr_reviews": q_merged_pr_reviews,
        "tagged_load": q_tagged_load,
        "unreadable_dates": q_unreadable_dates,
        "raw_commits_stored": q_raw_commits_stored,
        "staging_views": q_staging_views,
        "mart_roundtrip": q_mart_roundtrip,
        "mart_rebuild": q_mart_rebuild,
        "weekly_trends_table": q_weekly_trends_table,
        "upsert_commits_bucketed": q_upsert_commits_bucketed,
        "daily_pipeline": q_daily_pipeline,
        "daily_pipeline_run": q_daily_pipeline_run,
        "daily_refresh_impact": q_daily_refresh_impact,
        "daily_refresh_weekly": q_daily_refresh_weekly,
        "required_trends": q_required_trends,
        "pipeline_run_append": q_pipeline_run_append,
        # staging
        "stg_commits": lambda s, d: _stg(s, d)["commits"],
        "stg_pull_requests": lambda s, d: _stg(s, d)["pull_requests"],
        "stg_reviews": lambda s, d: _stg(s, d)["reviews"],
        "stg_issues": lambda s, d: _stg(s, d)["issues"],
        # aggregates
        "commits_agg": lambda s, d: A.commits_agg(_stg(s, d)["commits"]),
        "prs_agg": lambda s, d: A.prs_agg(_stg(s, d)["pull_requests"]),
        "reviews_agg": lambda s, d: A.reviews_agg(_stg(s, d)["reviews"]),
        "issues_agg": lambda s, d: A.issues_agg(_stg(s, d)["issues"]),
        "weekly_commits": lambda s, d: A.weekly_commits(_stg(s, d)["commits"]),
        "weekly_prs": lambda s, d: A.weekly_prs(_stg(s, d)["pull_requests"]),
        "weekly_reviews": lambda s, d: A.weekly_reviews(_stg(s, d)["reviews"]),
        "recent_pr_titles": lambda s, d: marts.ordered_pr_titles(_stg(s, d)["pull_requests"]),
        "recent_pr_titles_top3": lambda s, d: marts.recent_pr_titles(_stg(s, d)["pull_requests"]),
        # marts
        "fct_engineer_impact": lambda s, d: _impact(marts.fct_engineer_impact(_stg(s, d), AS_OF)),
        "fct_engineer_weekly_trends": lambda s, d: marts.fct_engineer_weekly_trends(_stg(s, d)),
        # reports
        "leaderboard": lambda s, d: _impact(_board(s, d, titles=K.RECENT_TITLES)),
        "leaderboard_full": lambda s, d: _board(s, d, limit=None),
        "engineer_trends": _trends,
        "week_spine": lambda s, d: reports.week_spine(_raw(s, d), LOGIN, REPO, as_of=AS_OF, days=TREND_DAYS),
        "team_summary": lambda s, d: reports.team_summary(_raw(s, d), REPO, as_of=AS_OF, days=SUMMARY_DAYS),
        "pipeline_run_rollup": _runs,
        "pipeline_status": lambda s, d: reports.pipeline_status(_runs(s, d)),
        "latest_run": lambda s, d: reports.latest_run(_runs(s, d)),
        # insights
        "profile_badge_relative": lambda s, d: D.profile_badge_relative(_board(s, d)),
        "profile_badge_absolute": lambda s, d: D.profile_badge_absolute(_board(s, d)),
        "score_composition": lambda s, d: D.score_composition(_board(s, d)),
        "score_breakdown": lambda s, d: D.score_breakdown(_board(s, d)),
        "metric_fill": lambda s, d: D.metric_fill(_board(s, d)),
        "podium_top3": lambda s, d: D.podium(_board(s, d)),
        "team_insight": lambda s, d: D.team_insight(_board(s, d)),
        "trend_series": lambda s, d: D.trend_series(_trends(s, d)),
    }
    q |= {"leaderboard_positions": q_leaderboard_positions, "impact_positions": q_impact_positions,
          "pr_title_pages": q_pr_title_pages, "active_days_merged": q_active_days_merged,
          "leaderboard_all_windows": q_leaderboard_all_windows, "engineer_trends_lookup": q_engineer_trends_lookup}
    q |= {"variant_commits": _variant(X.extract_commits, "commits", SINCE),
          "variant_merged_prs": _variant(X.extract_merged_prs, "pull_requests", SINCE),
          "variant_reviews": _variant(X.extract_reviews, "reviews"),
          "variant_closed_issues": _variant(X.extract_closed_issues, "issues", SINCE), "field_states": q_field_states}
    q |= {name: _sql(text) for name, text in SQL_TEXTS.items()}
    q["sql_issues"] = _sql("SELECT * FROM v_issues")
    for days in K.VALID_DAYS:
        q[f"leaderboard_{days}d"] = _leaderboard_days(days)
    for table in ("commits", "pull_requests", "reviews", "issues"):
        q[f"upsert_{table}"] = _upsert(table)
    q["leaderboard_recent_titles"] = lambda s, d: _impact(_board(s, d, titles=K.RECENT_TITLES)).select(
        "engineer_login", "avatar_url", "impact_rank", "recent_pr_titles")
    q["fct_engineer_impact_titles"] = lambda s, d: _impact(marts.fct_engineer_impact(_stg(s, d), AS_OF)).select(
        "engineer_login", "repo", "impact_rank", "recent_pr_titles")
    # the same plans on the orders/lineitem volume variant
    q["vol_fct_engineer_impact"] = lambda s, d: marts.fct_engineer_impact(
        staging.staging(FX.volume_tables(s, d)), FX.VOLUME_AS_OF, title_count=0)
    q["vol_fct_engineer_weekly_trends"] = lambda s, d: marts.fct_engineer_weekly_trends(
        staging.staging(FX.volume_tables(s, d)))
    q["vol_leaderboard_90d"] = lambda s, d: reports.leaderboard(
        FX.volume_tables(s, d), REPO, as_of=FX.VOLUME_AS_OF, days=90, limit=WINDOW_LIMIT, title_count=0)
    return q


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _board(spark, sf_dir, days=FLAGSHIP_DAYS, limit=BOARD_LIMIT)
