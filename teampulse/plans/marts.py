"""Gold models: engineer impact (C5) and weekly trends.

Both merge their sides with the union-all pivot (one shuffle on the grain)
instead of a chain of full outer joins; the per-repo rank is computed from a
score histogram so a repo holding most engineers is not ranked in one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from teampulse import constants as K
from teampulse.functions import elapsed_micros, impact_score, mean_hours, ts_lit, week_start, weekly_score
from teampulse.operators.ranking import positions, rank_desc, top_n_per_group
from teampulse.operators.sides import on_side, stack_sides
from teampulse.sources.raw import write_mart

GRAIN = ("engineer_login", "repo")


def score_columns(prs="prs_merged", changes="changes_requested", reviews="reviews",
                  issues="issues_closed", commits="commits", approvals="approvals"):
    """impact_score (double) and its six integer components."""
    c = F.col
    return [
        impact_score(prs, changes, reviews, issues, commits, approvals).cast("double").alias("impact_score"),
        (c(prs) * K.W_PRS).alias("score_from_prs"),
        (c(changes) * K.W_CHANGES).alias("score_from_catching_issues"),
        (c(reviews) * K.W_REVIEWS).alias("score_from_reviews"),
        (c(issues) * K.W_ISSUES).alias("score_from_issues"),
        (c(commits) * K.W_COMMITS).alias("score_from_commits"),
        (c(approvals) * K.W_APPROVALS).alias("score_from_approvals"),
    ]


#: Days that one bitmap of Spark's bitmap functions tells apart.
BITMAP_DAYS = 32768


def _days_in_bitmap(day) -> Column:
    """The number of different days, by one bitmap of days modulo ``BITMAP_DAYS``; fails where a group's days span more."""
    spread = F.datediff(F.max(day), F.min(day))
    n = F.bitmap_count(F.bitmap_construct_agg(F.pmod(F.unix_date(day), F.lit(BITMAP_DAYS))))
    return F.when(F.coalesce(spread, F.lit(0)) < BITMAP_DAYS, n).otherwise(
        F.raise_error(F.lit("days of one engineer span more than one bitmap")).cast("long"))


def engineer_activity(stg: dict[str, DataFrame], day_bitmaps: bool = False) -> DataFrame:
    """``combined``: one row per (engineer, repo) present on any side.

    Active days are counted by Spark's distinct aggregate, which exchanges
    (engineer, repo, day) first, or with ``day_bitmaps`` by a bitmap of days
    for each group, which takes one exchange and a sort aggregate."""
    u = stack_sides({
        "c": stg["commits"].select(*GRAIN, F.col("commit_date").alias("day")),
        "p": stg["pull_requests"].select(*GRAIN, F.col("total_discussion").alias("num")),
        "r": stg["reviews"].select(*GRAIN, F.col("is_approval").alias("appr"),
                                   F.col("is_changes_requested").alias("chg"),
                                   F.col("is_comment").alias("cmt")),
        "i": stg["issues"].select(*GRAIN, elapsed_micros("created_at", "closed_at").alias("micros")),
    }, GRAIN, {"day": "date", "num": "double", "micros": "long", "appr": "int", "chg": "int", "cmt": "int"})
    zero = F.lit(0).cast("long")
    return u.groupBy(*GRAIN).agg(
        F.count(on_side("c")).alias("commits"),
        (_days_in_bitmap(F.col("day")) if day_bitmaps else F.countDistinct(F.col("day"))).alias("active_days"),
        F.count(on_side("p")).alias("prs_merged"),
        F.coalesce(F.avg(on_side("p", F.col("num"))), F.lit(0.0)).alias("avg_discussion_per_pr"),
        F.count(on_side("r")).alias("reviews"),
        F.coalesce(F.sum("appr").cast("long"), zero).alias("approvals"),
        F.coalesce(F.sum("chg").cast("long"), zero).alias("changes_requested"),
        F.coalesce(F.sum("cmt").cast("long"), zero).alias("review_comments_given"),
        F.count(on_side("i")).alias("issues_closed"),
        F.coalesce(mean_hours("micros"), F.lit(0.0)).alias("avg_hours_to_close_issue"))


def scored_activity(stg: dict[str, DataFrame], floor: int = K.MART_ACTIVITY_FLOOR,
                    title_count: int = K.RECENT_TITLES) -> DataFrame:
    """Rows of the impact mart without rank: activity above the floor with its
    score and, unless ``title_count`` is 0, the newest titles. These join on
    the grain that both sides are already aggregated by."""
    scored = (engineer_activity(stg)
              .where(F.col("commits") + F.col("prs_merged") + F.col("reviews") > floor)
              .select("*", *score_columns()))
    return with_titles(scored, pr_titles(stg["pull_requests"]), GRAIN, title_count) if title_count else scored


def impact_columns(ranked: DataFrame, as_of: dt.datetime, title_count: int = K.RECENT_TITLES) -> DataFrame:
    """The mart's columns in order."""
    return ranked.select(
        "engineer_login", "repo", "commits", "active_days", "prs_merged",
        "avg_discussion_per_pr", "reviews", "approvals", "changes_requested",
        "review_comments_given", "issues_closed", "avg_hours_to_close_issue",
        "impact_score", "score_from_prs", "score_from_catching_issues",
        "score_from_reviews", "score_from_issues", "score_from_commits",
        "score_from_approvals", "impact_rank", ts_lit(as_of).alias("computed_at"),
        *(["recent_pr_titles"] if title_count else []))


def ranked_in_repo(scored: DataFrame, at_once: bool = False) -> DataFrame:
    """``impact_rank`` within each repo: by the histogram of scores, as part of
    the plan, or ``at_once`` by ``positions``, which runs a job and joins on no
    score, for builds that write the mart anyway."""
    if at_once:
        return positions(scored, ["repo"], "impact_score", [F.col("engineer_login").asc()], rank="impact_rank")
    return rank_desc(scored, ["repo"], "impact_score", "impact_rank", spread=GRAIN)


def fct_engineer_impact(stg: dict[str, DataFrame], as_of: dt.datetime, floor: int = K.MART_ACTIVITY_FLOOR,
                        title_count: int = K.RECENT_TITLES, at_once: bool = False) -> DataFrame:
    """``recent_pr_titles`` holds the newest ``title_count`` titles per
    engineer and repo (0: no such column); the full list is ``pr_titles``."""
    return impact_columns(ranked_in_repo(scored_activity(stg, floor, title_count), at_once), as_of, title_count)


def fct_engineer_weekly_trends(stg: dict[str, DataFrame]) -> DataFrame:
    """One row per (engineer, repo, week) with activity on any side. Commits
    without a timestamp form one NULL-week row per (engineer, repo)."""
    u = stack_sides({
        "c": stg["commits"].select(*GRAIN, week_start("committed_at").alias("week_start")),
        "p": stg["pull_requests"].select(*GRAIN, week_start("merged_at").alias("week_start")),
        "r": stg["reviews"].select(*GRAIN, week_start("submitted_at").alias("week_start"),
                                   F.col("is_changes_requested").alias("chg")),
    }, GRAIN, {"week_start": "timestamp_ntz", "chg": "int"})
    g = u.groupBy(*GRAIN, "week_start").agg(
        F.count(on_side("c")).alias("commits"),
        F.count(on_side("p")).alias("prs_merged"),
        F.count(on_side("r")).alias("reviews"),
        F.coalesce(F.sum("chg").cast("long"), F.lit(0).cast("long")).alias("changes_requested"))
    return g.select("*", weekly_score("prs_merged", "changes_requested", "reviews", "commits")
                    .alias("weekly_impact_score"))


def write_weekly_trends(trends: DataFrame, path: str) -> None:
    """C6 as a table, rebuilt in full: partitioned by repo, sorted by engineer and week."""
    write_mart(trends, path, sort_by=("engineer_login", "week_start"))


def pr_titles(stg_prs: DataFrame) -> DataFrame:
    """Every non-NULL title of each (engineer, repo) with its order keys: the
    title list unnested, one row per title, so no group is ever collected into
    a single value. See ``ordered_pr_titles`` for the sorted list."""
    return stg_prs.where(F.col("title").isNotNull()).select(
        "engineer_login", "repo", "pr_number", "merged_at", "title")


def ordered_pr_titles(stg_prs: DataFrame) -> DataFrame:
    """The complete title lists: sorted by repo and engineer, each newest merge
    first, then highest PR number (a range sort; a long list spans tasks)."""
    return pr_titles(stg_prs).orderBy("repo", "engineer_login", F.col("merged_at").desc(), F.col("pr_number").desc())


def pr_title_pages(stg_prs: DataFrame, page_size: int) -> DataFrame:
    """The complete title lists in pages: one row per engineer, repo and page
    (from 1) with an array of at most ``page_size`` titles, newest merge first,
    then highest PR number. Places come from ``positions`` (a job at once), so
    neither a list nor its numbering is ever in one task whole."""
    if page_size < 1:
        raise ValueError("a page has one title at least")
    placed = positions(pr_titles(stg_prs), GRAIN, "merged_at", [F.col("pr_number").desc()], row_number="nth")
    page = ((F.col("nth") - 1 - (F.col("nth") - 1) % page_size) / page_size + 1).cast("int")
    titles = F.transform(F.array_sort(F.collect_list(F.struct("nth", "title"))), lambda x: x["title"])
    return placed.groupBy(*GRAIN, page.alias("page")).agg(titles.alias("titles"))


def title_arrays(titles: DataFrame, keys: tuple[str, ...], n: int) -> DataFrame:
    """``keys`` + ``recent_pr_titles``: array of the newest ``n`` titles
    (merged_at desc, then pr_number desc). The top-n runs before any
    collection (partial group limit before the shuffle), so each array holds
    at most ``n`` values however active the engineer is."""
    top = top_n_per_group(titles.where(F.col("title").isNotNull()), keys,
                          [F.col("merged_at").desc(), F.col("pr_number").desc()], n, "_pos")
    ordered = F.array_sort(F.collect_list(F.struct("_pos", "title")))
    return top.groupBy(*keys).agg(F.transform(ordered, lambda x: x["title"]).alias("recent_pr_titles"))


def with_titles(df: DataFrame, titles: DataFrame, keys: tuple[str, ...], n: int) -> DataFrame:
    """Attach ``recent_pr_titles`` (newest ``n``; empty array when none)."""
    arr = title_arrays(titles, keys, n)
    empty = F.array().cast("array<string>")
    return (df.join(arr, list(keys), "left")
              .withColumn("recent_pr_titles", F.coalesce(F.col("recent_pr_titles"), empty)))


def recent_pr_titles(stg_prs: DataFrame, n: int = K.RECENT_TITLES) -> DataFrame:
    """Newest ``n`` titles per (engineer, repo) with their 1-based position."""
    top = top_n_per_group(pr_titles(stg_prs), GRAIN,
                          [F.col("merged_at").desc(), F.col("pr_number").desc()], n, "title_pos")
    return top.select("engineer_login", "repo", F.col("title_pos").cast("int"), "title")
