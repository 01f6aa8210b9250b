"""Staging models (silver): cleaned, typed views over the raw tables.

Each model is a single ``select`` so every derived column reads the *raw*
input column (e.g. ``total_discussion`` uses the raw, uncoalesced counts and
``commit_type`` the untrimmed message), exactly as one SQL SELECT list does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse import constants as K
from teampulse.functions import commit_type, discussion_level, hours_between, login_key


def stg_commits(raw_commits: DataFrame) -> DataFrame:
    return raw_commits.where(F.col("author_login").isNotNull()).select(
        "sha",
        login_key("author_login").alias("engineer_login"),
        "author_avatar_url",
        F.col("committed_at"),
        F.to_date("committed_at").alias("commit_date"),
        F.trim(F.col("message")).alias("message"),
        commit_type(F.col("message")).alias("commit_type"),
        "repo",
        "extracted_at")


def stg_pull_requests(raw_prs: DataFrame) -> DataFrame:
    raw_total = F.col("review_comments") + F.col("comments")
    return raw_prs.where(F.col("author_login").isNotNull() & F.col("merged_at").isNotNull()).select(
        "pr_number",
        "repo",
        F.trim(F.col("title")).alias("title"),
        login_key("author_login").alias("engineer_login"),
        "author_avatar_url",
        "merged_at",
        "created_at",
        "closed_at",
        F.to_date("merged_at").alias("merged_date"),
        F.coalesce(F.col("review_comments"), F.lit(0)).alias("review_comments"),
        F.coalesce(F.col("comments"), F.lit(0)).alias("comments"),
        raw_total.alias("total_discussion"),
        discussion_level(raw_total).alias("discussion_level"),
        "extracted_at")


def stg_reviews(raw_reviews: DataFrame) -> DataFrame:
    flag = lambda s: F.when(F.col("state") == s, 1).otherwise(0)
    return raw_reviews.where(F.col("reviewer_login").isNotNull()
                             & F.col("state").isin(*K.STAGED_REVIEW_STATES)).select(
        "pr_number",
        "repo",
        login_key("reviewer_login").alias("engineer_login"),
        "state",
        "submitted_at",
        F.to_date("submitted_at").alias("review_date"),
        flag(K.APPROVED).alias("is_approval"),
        flag(K.CHANGES_REQUESTED).alias("is_changes_requested"),
        flag(K.COMMENTED).alias("is_comment"),
        "extracted_at")


def stg_issues(raw_issues: DataFrame) -> DataFrame:
    return raw_issues.where(F.col("closed_by_login").isNotNull() & F.col("closed_at").isNotNull()).select(
        "issue_number",
        "repo",
        F.trim(F.col("title")).alias("title"),
        login_key("closed_by_login").alias("engineer_login"),
        "created_at",
        "closed_at",
        F.to_date("closed_at").alias("closed_date"),
        hours_between("created_at", "closed_at").alias("hours_to_close"),
        "extracted_at")


def staging(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "commits": stg_commits(raw["commits"]),
        "pull_requests": stg_pull_requests(raw["pull_requests"]),
        "reviews": stg_reviews(raw["reviews"]),
        "issues": stg_issues(raw["issues"]),
    }


def register_views(spark, tables: dict[str, DataFrame], prefix: str = "stg_") -> None:
    """Silver layer as session views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
