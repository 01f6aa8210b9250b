"""The rules as SQL functions and views, for users who write SQL.

Functions (temporary, of the session): ``is_bot(login, type)``, ``commit_kind(message)``, ``discussion_kind(total)``,
``week_of(ts)`` and ``impact_points(prs, changes, reviews, issues, commits, approvals)``. They are SQL bodies, so Spark
inlines them: a query that calls them is planned like one that spells them out. Views: ``v_commits``,
``v_pull_requests``, ``v_reviews`` and ``v_issues`` over the raw tables, with the columns of the staging models.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from teampulse import constants as K


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bodies(extra_bots: tuple[str, ...] = ()) -> dict[str, str]:
    """Signature and body of each function."""
    bots = ", ".join(_text(b) for b in (*K.BOT_LOGINS, *(b.lower() for b in extra_bots)))
    kinds = " ".join(f"WHEN message ILIKE {_text(prefix + '%')} THEN {_text(kind)}" for prefix, kind in K.COMMIT_TYPES)
    return {
        "is_bot(login STRING, type STRING) RETURNS BOOLEAN":
            f"(login IS NULL AND type IS NULL) OR coalesce(type = {_text(K.BOT_TYPE)}, false) "
            f"OR lower(coalesce(login, '')) IN ({bots}) OR contains(coalesce(login, ''), {_text(K.BOT_MARKER)})",
        "commit_kind(message STRING) RETURNS STRING": f"CASE {kinds} ELSE {_text(K.COMMIT_TYPE_OTHER)} END",
        "discussion_kind(total INT) RETURNS STRING":
            f"CASE WHEN total = 0 THEN 'no-discussion' WHEN total <= {K.DISCUSSION_LOW_MAX} THEN 'low' "
            f"WHEN total <= {K.DISCUSSION_MEDIUM_MAX} THEN 'medium' ELSE 'high' END",
        "week_of(ts TIMESTAMP_NTZ) RETURNS TIMESTAMP_NTZ":
            "CAST(next_day(date_sub(CAST(ts AS DATE), 7), 'Mon') AS TIMESTAMP_NTZ)",
        "impact_points(prs BIGINT, changes BIGINT, reviews BIGINT, issues BIGINT, commits BIGINT, approvals BIGINT) RETURNS BIGINT":
            f"prs * {K.W_PRS} + changes * {K.W_CHANGES} + reviews * {K.W_REVIEWS} + issues * {K.W_ISSUES} "
            f"+ commits * {K.W_COMMITS} + approvals * {K.W_APPROVALS}",
    }


_STATES = ", ".join(_text(s) for s in K.STAGED_REVIEW_STATES)
_FLAG = {"is_approval": K.APPROVED, "is_changes_requested": K.CHANGES_REQUESTED, "is_comment": K.COMMENTED}
VIEWS = {
    "v_commits": """
        SELECT sha, lower(author_login) AS engineer_login, author_avatar_url, committed_at,
               CAST(committed_at AS DATE) AS commit_date, trim(message) AS message, commit_kind(message) AS commit_type,
               repo, extracted_at
        FROM raw_commits WHERE author_login IS NOT NULL""",
    "v_pull_requests": """
        SELECT pr_number, repo, trim(title) AS title, lower(author_login) AS engineer_login, author_avatar_url, merged_at,
               created_at, closed_at, CAST(merged_at AS DATE) AS merged_date,
               coalesce(raw_pull_requests.review_comments, 0) AS review_comments,
               coalesce(raw_pull_requests.comments, 0) AS comments,
               raw_pull_requests.review_comments + raw_pull_requests.comments AS total_discussion,
               discussion_kind(raw_pull_requests.review_comments + raw_pull_requests.comments) AS discussion_level,
               extracted_at
        FROM raw_pull_requests WHERE author_login IS NOT NULL AND merged_at IS NOT NULL""",
    "v_reviews": f"""
        SELECT pr_number, repo, lower(reviewer_login) AS engineer_login, state, submitted_at,
               CAST(submitted_at AS DATE) AS review_date,
               {", ".join(f"CAST(state = {_text(s)} AS INT) AS {c}" for c, s in _FLAG.items())}, extracted_at
        FROM raw_reviews WHERE reviewer_login IS NOT NULL AND state IN ({_STATES})""",
    "v_issues": """
        SELECT issue_number, repo, trim(title) AS title, lower(closed_by_login) AS engineer_login, created_at, closed_at,
               CAST(closed_at AS DATE) AS closed_date,
               timestampdiff(MICROSECOND, created_at, closed_at) / 3600000000D AS hours_to_close, extracted_at
        FROM raw_issues WHERE closed_by_login IS NOT NULL AND closed_at IS NOT NULL""",
}


def register(spark: SparkSession, raw: Mapping[str, DataFrame] | None = None, extra_bots: tuple[str, ...] = ()) -> None:
    """Define the functions and, given the raw tables by name, the views over them."""
    for signature, body in bodies(extra_bots).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    if raw is not None:
        for name in ("commits", "pull_requests", "reviews", "issues"):
            raw[name].createOrReplaceTempView(f"raw_{name}")
        for name, body in VIEWS.items():
            spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {body}")
