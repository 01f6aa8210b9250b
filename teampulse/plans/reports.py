"""Windowed reports over the raw tables.

These read the raw tables directly (not the marts) and differ from the marts
on purpose: one repo, last N days, every review state counts, NULL discussion
counts as 0, commits grouped by (login, avatar) which repeats an engineer
once per avatar, activity floor > 0, one global rank.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from teampulse import constants as K
from teampulse.functions import in_window, login_key, week_start, weekly_score
from teampulse.operators.ranking import positions, rank_desc, rank_top_k, top_n_per_group
from teampulse.operators.sides import on_side, stack_sides
from teampulse.plans.marts import score_columns, with_titles


def _check(days: int, limit: int | None = None) -> None:
    if days not in K.VALID_DAYS:
        raise ValueError(f"days must be one of {sorted(K.VALID_DAYS)}")
    if limit is not None and limit < 0:
        raise ValueError("limit must not be negative")


def _recent(df: DataFrame, repo: str, ts: str, as_of: dt.datetime, days: int) -> DataFrame:
    return df.where((F.col("repo") == repo) & in_window(ts, as_of, days))


def leaderboard_activity(raw: dict[str, DataFrame], repo: str, as_of: dt.datetime,
                         days: int, one_row_per_engineer: bool = False) -> DataFrame:
    """``combined`` of the leaderboard: commit side keyed (login, avatar),
    PR/review/issue sides pivoted per login, then one full outer join.

    By default an engineer who committed with several avatar URLs appears once
    per avatar, each row carrying the full PR/review/issue counts (the
    reproduced behaviour). ``one_row_per_engineer=True`` keys the commit side
    by login alone and shows the avatar of the engineer's latest commit."""
    c = _recent(raw["commits"], repo, "committed_at", as_of, days).where(F.col("author_login").isNotNull())
    login = login_key("author_login").alias("engineer_login")
    stats = [F.count(F.lit(1)).alias("commits"),
             F.countDistinct(F.to_date("committed_at")).alias("active_days")]
    if one_row_per_engineer:
        latest = F.max_by("author_avatar_url", F.struct("committed_at", "sha")).alias("author_avatar_url")
        commits = c.groupBy(login).agg(latest, *stats)
    else:
        commits = c.groupBy(login, "author_avatar_url").agg(*stats)

    p = _recent(raw["pull_requests"], repo, "merged_at", as_of, days).where(F.col("author_login").isNotNull())
    r = _recent(raw["reviews"], repo, "submitted_at", as_of, days).where(F.col("reviewer_login").isNotNull())
    i = _recent(raw["issues"], repo, "closed_at", as_of, days).where(F.col("closed_by_login").isNotNull())
    u = stack_sides({
        "p": p.select(login_key("author_login").alias("engineer_login"),
                      (F.coalesce(F.col("review_comments"), F.lit(0))
                       + F.coalesce(F.col("comments"), F.lit(0))).alias("disc")),
        "r": r.select(login_key("reviewer_login").alias("engineer_login"), "state"),
        "i": i.select(login_key("closed_by_login").alias("engineer_login")),
    }, ["engineer_login"], {"disc": "double", "state": "string"})
    others = u.groupBy("engineer_login").agg(
        F.count(on_side("p")).alias("prs_merged"),
        F.avg(on_side("p", F.col("disc"))).alias("avg_discussion_per_pr"),
        F.count(on_side("r")).alias("reviews"),
        F.count(F.when(F.col("state") == K.APPROVED, 1)).alias("approvals"),
        F.count(F.when(F.col("state") == K.CHANGES_REQUESTED, 1)).alias("changes_requested"),
        F.count(on_side("i")).alias("issues_closed"))

    j = commits.join(others, "engineer_login", "full_outer")
    z = F.lit(0).cast("long")
    return j.select(
        "engineer_login",
        F.coalesce(F.col("author_avatar_url"), F.lit("")).alias("avatar_url"),
        F.coalesce(F.col("commits"), z).alias("commits"),
        F.coalesce(F.col("active_days"), z).alias("active_days"),
        F.coalesce(F.col("prs_merged"), z).alias("prs_merged"),
        F.coalesce(F.col("avg_discussion_per_pr"), F.lit(0.0)).alias("avg_discussion_per_pr"),
        F.coalesce(F.col("reviews"), z).alias("reviews"),
        F.coalesce(F.col("approvals"), z).alias("approvals"),
        F.coalesce(F.col("changes_requested"), z).alias("changes_requested"),
        F.coalesce(F.col("issues_closed"), z).alias("issues_closed"))


def leaderboard(raw: dict[str, DataFrame], repo: str, *, as_of: dt.datetime,
                days: int = K.DEFAULT_DAYS, limit: int | None = K.DEFAULT_LIMIT,
                with_position: bool = False, one_row_per_engineer: bool = False,
                title_count: int = K.RECENT_TITLES) -> DataFrame:
    """Engineers of ``repo`` over the last ``days`` days, with RANK() over every
    qualifying engineer (ties share a rank, the next rank skips): the first
    ``limit``, or with None the whole board. Ties at the cut are broken by
    login, then avatar URL. ``recent_pr_titles`` holds the newest
    ``title_count`` raw (untrimmed) titles of the engineer's PRs merged in the
    window (0: no such column). Rows come in order of rank, login and avatar.

    With ``limit`` None and ``with_position`` the place of every row of the
    whole board is numbered by ``positions``, which runs a job at once."""
    _check(days, limit)
    scored = (leaderboard_activity(raw, repo, as_of, days, one_row_per_engineer)
              .where(F.col("commits") + F.col("prs_merged") + F.col("reviews") > K.API_ACTIVITY_FLOOR)
              .select("*", *score_columns()))
    if limit is None and with_position:
        top = positions(scored, [], "impact_score", [F.col("engineer_login"), F.col("avatar_url")],
                        row_number="position", rank="impact_rank")
    elif limit is None:
        top = rank_desc(scored, [], "impact_score", "impact_rank", spread=("engineer_login", "avatar_url"))
    else:
        top = rank_top_k(scored, "impact_score", ["engineer_login", "avatar_url"], limit,
                         "impact_rank", "position" if with_position else None)
    if title_count:
        prs = (_recent(raw["pull_requests"], repo, "merged_at", as_of, days)
               .where(F.col("author_login").isNotNull())
               .select(login_key("author_login").alias("engineer_login"), "pr_number", "merged_at", "title"))
        top = with_titles(top, prs, ("engineer_login",), title_count)
    return top.orderBy("impact_rank", "engineer_login", "avatar_url")


def window_boards(raw: dict[str, DataFrame], repo: str, *, as_of: dt.datetime,
                  windows: tuple[int, ...] = K.VALID_DAYS, limit: int = K.DEFAULT_LIMIT) -> DataFrame:
    """The boards of several windows from one reading of each raw table: the
    rows of ``leaderboard(days=d, title_count=0)`` for each window, after a
    column ``days``.

    A row of a raw table counts in every window from the smallest that holds
    it. Commits are first condensed to one state per person, avatar and day:
    the smallest window that the day is in and the commits by window, so active
    days of all windows are counts over these states, without a distinct
    aggregate for each window."""
    for days in windows:
        _check(days, limit)
    sizes = sorted(set(windows))

    def first_window(ts: str) -> Column:
        out = None
        for i, days in enumerate(sizes):
            held = in_window(ts, as_of, days)
            out = F.when(held, i) if out is None else out.when(held, i)
        return out.alias("_w")

    def recent(df, ts, login):
        return _recent(df, repo, ts, as_of, sizes[-1]).where(F.col(login).isNotNull()).withColumn("_w", first_window(ts))

    each = list(range(len(sizes)))
    login = login_key("author_login").alias("engineer_login")
    by_day = recent(raw["commits"], "committed_at", "author_login").groupBy(
        login, "author_avatar_url", F.to_date("committed_at").alias("day")).agg(
        F.min("_w").alias("_day_w"), *[F.count(F.when(F.col("_w") == i, 1)).alias(f"_n{i}") for i in each])
    commits = by_day.groupBy("engineer_login", "author_avatar_url").agg(
        *[F.sum(sum((F.col(f"_n{j}") for j in range(i)), F.col(f"_n{i}"))).alias(f"commits_{i}") for i in each],
        *[F.count(F.when(F.col("_day_w") <= i, 1)).alias(f"days_{i}") for i in each])
    u = stack_sides({
        "p": recent(raw["pull_requests"], "merged_at", "author_login").select(
            login, "_w", (F.coalesce(F.col("review_comments"), F.lit(0)) + F.coalesce(F.col("comments"), F.lit(0))).alias("disc")),
        "r": recent(raw["reviews"], "submitted_at", "reviewer_login").select(
            login_key("reviewer_login").alias("engineer_login"), "_w", "state"),
        "i": recent(raw["issues"], "closed_at", "closed_by_login").select(
            login_key("closed_by_login").alias("engineer_login"), "_w"),
    }, ["engineer_login"], {"_w": "int", "disc": "double", "state": "string"})
    measures = []
    for i in each:
        held = F.col("_w") <= i
        measures += [F.count(F.when(held, on_side("p"))).alias(f"prs_{i}"),
                     F.avg(F.when(held, on_side("p", F.col("disc")))).alias(f"disc_{i}"),
                     F.count(F.when(held, on_side("r"))).alias(f"reviews_{i}"),
                     F.count(F.when(held & (F.col("state") == K.APPROVED), 1)).alias(f"approvals_{i}"),
                     F.count(F.when(held & (F.col("state") == K.CHANGES_REQUESTED), 1)).alias(f"changes_{i}"),
                     F.count(F.when(held, on_side("i"))).alias(f"issues_{i}")]
    j = commits.join(u.groupBy("engineer_login").agg(*measures), "engineer_login", "full_outer")
    z = F.lit(0).cast("long")

    def row(i):
        # an avatar without commits in a window is no row of its board; a person without any commits there is one
        commits_ = F.coalesce(F.col(f"commits_{i}"), z)
        return F.struct(
            F.lit(sizes[i]).alias("days"),
            F.when(commits_ > 0, F.coalesce(F.col("author_avatar_url"), F.lit(""))).otherwise(F.lit("")).alias("avatar_url"),
            commits_.alias("commits"), F.coalesce(F.col(f"days_{i}"), z).alias("active_days"),
            F.coalesce(F.col(f"prs_{i}"), z).alias("prs_merged"),
            F.coalesce(F.col(f"disc_{i}"), F.lit(0.0)).alias("avg_discussion_per_pr"),
            F.coalesce(F.col(f"reviews_{i}"), z).alias("reviews"), F.coalesce(F.col(f"approvals_{i}"), z).alias("approvals"),
            F.coalesce(F.col(f"changes_{i}"), z).alias("changes_requested"),
            F.coalesce(F.col(f"issues_{i}"), z).alias("issues_closed"))

    rows = (j.select("engineer_login", F.explode(F.array(*[row(i) for i in each])).alias("b")).select("engineer_login", "b.*")
            .where(F.col("commits") + F.col("prs_merged") + F.col("reviews") > K.API_ACTIVITY_FLOOR))
    # of a person without commits in a window, one row however many avatars other windows have; not beside rows with commits
    others = ["engineer_login", "days"]
    idle = rows.where(F.col("commits") == 0).dropDuplicates(others)
    idle = idle.join(rows.where(F.col("commits") > 0).select(*others).distinct(), others, "left_anti")
    scored = rows.where(F.col("commits") > 0).unionByName(idle).select("*", *score_columns())
    order = [F.col("impact_score").desc(), F.col("engineer_login").asc(), F.col("avatar_url").asc()]
    if limit == 0:
        scored, limit = scored.where(F.lit(False)), 1
    top = top_n_per_group(scored, ["days"], order, limit, "_pos").drop("_pos")
    ranked = top.withColumn("impact_rank", F.rank().over(Window.partitionBy("days").orderBy(F.col("impact_score").desc())).cast("long"))
    return ranked.orderBy("days", "impact_rank", "engineer_login", "avatar_url")


def leaderboard_page(raw: dict[str, DataFrame], repo: str, *, limit: int = K.DEFAULT_LIMIT, **options) -> DataFrame:
    """The board as a page: ``limit`` is at most ``MAX_LIMIT``."""
    if not 0 <= limit <= K.MAX_LIMIT:
        raise ValueError(f"limit must be between 0 and {K.MAX_LIMIT}")
    return leaderboard(raw, repo, limit=limit, **options)


def _engineer_weeks(raw: dict[str, DataFrame], login: str, repo: str, as_of: dt.datetime,
                    days: int) -> DataFrame:
    who = login.lower()
    mine = lambda df, col, ts: _recent(df, repo, ts, as_of, days).where(login_key(col) == who)
    return stack_sides({
        "c": mine(raw["commits"], "author_login", "committed_at").select(
            week_start("committed_at").alias("week_start")),
        "p": mine(raw["pull_requests"], "author_login", "merged_at").select(
            week_start("merged_at").alias("week_start")),
        "r": mine(raw["reviews"], "reviewer_login", "submitted_at").select(
            week_start("submitted_at").alias("week_start"), "state"),
    }, ["week_start"], {"state": "string"})


def week_spine(raw: dict[str, DataFrame], login: str, repo: str, *, as_of: dt.datetime,
               days: int = K.DEFAULT_DAYS) -> DataFrame:
    """Distinct weeks in which the engineer has any activity (UNION)."""
    _check(days)
    return _engineer_weeks(raw, login, repo, as_of, days).select("week_start").distinct()


def engineer_trends(raw: dict[str, DataFrame], login: str, repo: str, *, as_of: dt.datetime,
                    days: int = K.DEFAULT_DAYS) -> DataFrame:
    """Weekly activity of one engineer (login matched case-insensitively).
    The spine + LEFT JOIN form is computed as one grouping of the stacked
    sides: every spine week has at least one side by construction. Empty
    result = engineer not found (see ``require_rows``)."""
    _check(days)
    g = _engineer_weeks(raw, login, repo, as_of, days).groupBy("week_start").agg(
        F.count(on_side("c")).alias("commits"),
        F.count(on_side("p")).alias("prs_merged"),
        F.count(on_side("r")).alias("reviews"),
        F.count(F.when(F.col("state") == K.CHANGES_REQUESTED, 1)).alias("changes_requested"))
    return g.select("*", weekly_score("prs_merged", "changes_requested", "reviews", "commits")
                    .alias("weekly_impact_score")).orderBy("week_start")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise ``LookupError`` when ``df`` is empty (reads at most one row)."""
    if df.isEmpty():
        raise LookupError(f"No data for {what}")
    return df


def team_summary(raw: dict[str, DataFrame], repo: str, *, as_of: dt.datetime,
                 days: int = K.DEFAULT_DAYS) -> DataFrame:
    """Five totals; one aggregate per table, the 1-row results cross-joined.
    NULL authors count in the totals but not among engineers."""
    _check(days)
    commits = _recent(raw["commits"], repo, "committed_at", as_of, days).agg(
        F.countDistinct(login_key("author_login")).alias("total_engineers"),
        F.count(F.lit(1)).alias("total_commits"))
    prs = _recent(raw["pull_requests"], repo, "merged_at", as_of, days).agg(
        F.count(F.lit(1)).alias("total_prs_merged"))
    reviews = _recent(raw["reviews"], repo, "submitted_at", as_of, days).agg(
        F.count(F.lit(1)).alias("total_reviews"))
    issues = _recent(raw["issues"], repo, "closed_at", as_of, days).agg(
        F.count(F.lit(1)).alias("total_issues_closed"))
    return (commits.crossJoin(F.broadcast(prs)).crossJoin(F.broadcast(reviews))
            .crossJoin(F.broadcast(issues)))


RUN_COUNTS = ["commits_loaded", "prs_loaded", "reviews_loaded", "issues_loaded"]
RUN_COLUMNS = ["repo", "status", *RUN_COUNTS, "run_at", "error_message"]


def _run_order():
    return [F.col("run_at").desc_nulls_first(), *[F.col(c).asc() for c in ("repo", "status", "error_message", *RUN_COUNTS)]]


def pipeline_status(runs: DataFrame, n: int = K.PIPELINE_STATUS_RUNS) -> DataFrame:
    """The ``n`` latest runs, newest first (a run without time sorts first)."""
    return runs.select(*RUN_COLUMNS).orderBy(*_run_order()).limit(n)


def latest_run(runs: DataFrame) -> DataFrame:
    return pipeline_status(runs, 1)
