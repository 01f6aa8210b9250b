"""Explicit schemas: raw tables and landed JSON payloads. Nothing is inferred."""

from pyspark.sql.types import (
    ArrayType, IntegerType, LongType, MapType, StringType, StructField, StructType,
    TimestampNTZType,
)

S, I, L, TS = StringType(), IntegerType(), LongType(), TimestampNTZType()


def _struct(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


RAW_COMMITS = _struct(
    ("sha", S), ("author_login", S), ("author_avatar_url", S), ("author_type", S),
    ("message", S), ("committed_at", TS), ("repo", S), ("extracted_at", TS))

RAW_PULL_REQUESTS = _struct(
    ("pr_number", I), ("repo", S), ("title", S), ("author_login", S),
    ("author_avatar_url", S), ("author_type", S), ("state", S), ("merged_at", TS),
    ("created_at", TS), ("closed_at", TS), ("review_comments", I), ("comments", I),
    ("extracted_at", TS))

RAW_REVIEWS = _struct(
    ("pr_number", I), ("repo", S), ("reviewer_login", S), ("reviewer_type", S),
    ("state", S), ("submitted_at", TS), ("extracted_at", TS))

RAW_ISSUES = _struct(
    ("issue_number", I), ("repo", S), ("title", S), ("state", S),
    ("closed_by_login", S), ("closed_by_type", S), ("created_at", TS),
    ("closed_at", TS), ("updated_at", TS), ("extracted_at", TS))

RAW_PIPELINE_RUNS = _struct(
    ("run_at", TS), ("repo", S), ("status", S), ("commits_loaded", I),
    ("prs_loaded", I), ("reviews_loaded", I), ("issues_loaded", I),
    ("error_message", S))

TASK_STATES = _struct(
    ("run_id", L), ("task_id", S), ("state", S), ("loaded", I), ("ts", TS), ("repo", S))

RAW = {
    "commits": RAW_COMMITS,
    "pull_requests": RAW_PULL_REQUESTS,
    "reviews": RAW_REVIEWS,
    "issues": RAW_ISSUES,
    "pipeline_runs": RAW_PIPELINE_RUNS,
}



#: What orders the rows of a batch: the landed document, and the row's place in it.
BATCH_ORDER = ("_seq", "_place")


def batch(table: str) -> StructType:
    """Rows of a batch for a raw table: its columns and their landing order."""
    return StructType(RAW[table].fields + [StructField("_seq", L, True), StructField("_place", I, True)])


# Upsert keys per raw table.
KEYS = {
    "commits": ("sha",),
    "pull_requests": ("pr_number", "repo"),
    "reviews": ("repo", "pr_number", "reviewer_login", "state", "submitted_at"),
    "issues": ("issue_number", "repo"),
}

# --- landed JSON payloads (fields that are read); dates stay ISO strings ----
#: Counts that read 0 where their key is absent from a document; an explicit JSON null stays NULL.
ABSENT_IS_ZERO = {"pull_requests": ("review_comments", "comments")}

USER = _struct(("login", S), ("avatar_url", S), ("type", S))
REVIEW_USER = _struct(("login", S), ("type", S))

COMMIT_PAYLOAD = _struct(
    ("sha", S), ("author", USER),
    ("commit", _struct(("message", S), ("author", _struct(("date", S))))))

PULL_PAYLOAD = _struct(
    ("number", I), ("title", S), ("state", S), ("user", USER), ("merged_at", S),
    ("created_at", S), ("closed_at", S), ("updated_at", S),
    ("review_comments", I), ("comments", I))

REVIEWS_PAYLOAD = _struct(
    ("pr_number", I),
    ("reviews", ArrayType(_struct(("user", REVIEW_USER), ("state", S), ("submitted_at", S)))))

ISSUE_PAYLOAD = _struct(
    ("number", I), ("title", S), ("state", S),
    ("pull_request", MapType(S, S)), ("closed_by", REVIEW_USER),
    ("created_at", S), ("closed_at", S), ("updated_at", S))

PAYLOADS = {
    "commits": COMMIT_PAYLOAD,
    "pull_requests": PULL_PAYLOAD,
    "reviews": REVIEWS_PAYLOAD,
    "issues": ISSUE_PAYLOAD,
}
