"""Per-side aggregates of the staging models (A1-A5).

All are plain ``groupBy().agg()``: Spark runs a partial (map-side) aggregate
before the shuffle, so a very active engineer or repo only sends one partial
row per input partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.functions import elapsed_micros, mean_hours, week_start

KEY = ("engineer_login", "repo")


def commits_agg(stg: DataFrame) -> DataFrame:
    return stg.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("total_commits"),
        F.countDistinct("commit_date").alias("active_days"),
        F.count(F.when(F.col("commit_type") == "feature", 1)).alias("feature_commits"),
        F.count(F.when(F.col("commit_type") == "fix", 1)).alias("fix_commits"),
        F.min("committed_at").alias("first_commit_at"),
        F.max("committed_at").alias("last_commit_at"))


def prs_agg(stg: DataFrame) -> DataFrame:
    """Counts per engineer and repo. The ordered title list of each group is
    served unnested by ``marts.ordered_pr_titles`` instead of as one array value."""
    return stg.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("prs_merged"),
        F.avg("total_discussion").alias("avg_discussion_per_pr"),
        F.max("merged_at").alias("last_pr_merged_at"))


def reviews_agg(stg: DataFrame) -> DataFrame:
    return stg.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.sum("is_approval").cast("long").alias("approvals"),
        F.sum("is_changes_requested").cast("long").alias("changes_requested"),
        F.sum("is_comment").cast("long").alias("review_comments"))


def issues_agg(stg: DataFrame) -> DataFrame:
    return stg.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("issues_closed"),
        mean_hours(elapsed_micros("created_at", "closed_at")).alias("avg_hours_to_close"))


def weekly_commits(stg: DataFrame) -> DataFrame:
    return (stg.groupBy(*KEY, week_start("committed_at").alias("week_start"))
            .agg(F.count(F.lit(1)).alias("commits")))


def weekly_prs(stg: DataFrame) -> DataFrame:
    return (stg.groupBy(*KEY, week_start("merged_at").alias("week_start"))
            .agg(F.count(F.lit(1)).alias("prs_merged")))


def weekly_reviews(stg: DataFrame) -> DataFrame:
    return (stg.groupBy(*KEY, week_start("submitted_at").alias("week_start"))
            .agg(F.count(F.lit(1)).alias("reviews"),
                 F.sum("is_changes_requested").cast("long").alias("changes_requested")))


# --- active days as mergeable states ----------------------------------------

#: Days of one bitmap: the bits of Spark's bitmap functions.
DAY_BUCKET = ("engineer_login", "repo", "day_bucket")


def active_day_states(stg_commits: DataFrame) -> DataFrame:
    """One bitmap of commit days per engineer, repo and span of 32,768 days: a state that other states of the same
    group merge with, whatever commits each was made from. Days lie in bitmaps by their number since 1970."""
    day = F.unix_date("commit_date")
    return (stg_commits.where(F.col("commit_date").isNotNull())
            .groupBy(*KEY, F.bitmap_bucket_number(day).alias("day_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(day)).alias("days")))


def merged_day_states(*states: DataFrame) -> DataFrame:
    """States of several loads as one."""
    every = states[0]
    for s in states[1:]:
        every = every.unionByName(s)
    return every.groupBy(*DAY_BUCKET).agg(F.bitmap_or_agg("days").alias("days"))


def active_days(states: DataFrame) -> DataFrame:
    """The exact number of different days of each engineer and repo, from merged states."""
    return states.groupBy(*KEY).agg(F.sum(F.bitmap_count("days")).alias("active_days"))
