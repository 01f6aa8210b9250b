"""Fixed values. These must equal the behaviour being reproduced; they are
stated here once, in natural order, and imported everywhere else."""

# --- fixed values: impact score weights -------------------------------------
# score = prs_merged*8 + changes_requested*4 + reviews*3 + issues_closed*2
#         + commits*1 + approvals*1
W_PRS = 8
W_CHANGES = 4
W_REVIEWS = 3
W_ISSUES = 2
W_COMMITS = 1
W_APPROVALS = 1

# --- fixed values: windows and limits ---------------------------------------
VALID_DAYS = (7, 15, 30, 60, 90)
DEFAULT_DAYS = 90
DEFAULT_LIMIT = 10
MAX_LIMIT = 20               # of the paged board only; a board without limit is whole
HISTORY_DAYS = 90            # extraction look-back

# --- fixed values: bot accounts ---------------------------------------------
# A deployment adds accounts of its own through ``is_bot(extra_bots=...)``.
BOT_LOGINS = (
    "dependabot",
    "dependabot[bot]",
    "posthog-bot",
    "github-actions[bot]",
    "renovate[bot]",
    "codecov[bot]",
)
BOT_MARKER = "[bot]"         # case-sensitive substring test
BOT_TYPE = "Bot"

# --- fixed values: commit classification (prefix, ILIKE on raw message) -----
COMMIT_TYPES = (
    ("feat", "feature"),
    ("fix", "fix"),
    ("chore", "chore"),
    ("refactor", "refactor"),
    ("test", "test"),
    ("docs", "docs"),
)
COMMIT_TYPE_OTHER = "other"

# --- fixed values: PR discussion levels -------------------------------------
# total == 0 -> no-discussion, <= 3 -> low, <= 10 -> medium, else high
DISCUSSION_LOW_MAX = 3
DISCUSSION_MEDIUM_MAX = 10

# --- fixed values: review states --------------------------------------------
APPROVED = "APPROVED"
CHANGES_REQUESTED = "CHANGES_REQUESTED"
COMMENTED = "COMMENTED"
STAGED_REVIEW_STATES = (APPROVED, CHANGES_REQUESTED, COMMENTED)

# --- fixed values: activity floors (commits + prs + reviews > floor) --------
MART_ACTIVITY_FLOOR = 2
API_ACTIVITY_FLOOR = 0

# --- fixed values: pipeline tasks -------------------------------------------
TRACKED_TASKS = (
    "extract_commits",
    "extract_pull_requests",
    "extract_reviews",
    "extract_issues",
    "run_dbt_transformations",
)
COUNT_TASKS = (
    ("commits_loaded", "extract_commits"),
    ("prs_loaded", "extract_pull_requests"),
    ("reviews_loaded", "extract_reviews"),
    ("issues_loaded", "extract_issues"),
)
STATUS_SUCCESS = "success"
STATUS_FAILED = "failed"
STATE_UNKNOWN = "unknown"
ERROR_PREFIX = "Unsuccessful tasks: "
PIPELINE_STATUS_RUNS = 5

# --- fixed values: relative profile badge (field averages) ------------------
REL_SHIP_FACTOR = 1.2
REL_REVIEW_FACTOR = 1.1
REL_CATCHES_MIN = 3
REL_REVIEW_DOMINANCE = 0.45
REL_PROLIFIC_COMMITS = 12
REL_ENGINE_FACTOR = 2.5

# --- fixed values: absolute profile badge -----------------------------------
ABS_SHIPPER_PRS = 10
ABS_REVIEWER_REVIEWS = 3
ABS_CATCHER_CHANGES = 2
ABS_ENGINE_COMMITS = 20
ABS_ENGINE_RATIO = 3
ABS_REVIEW_DOMINANCE = 0.6

# --- fixed values: badge names ----------------------------------------------
ALL_ROUNDER = "All-Rounder"
QUALITY_GUARDIAN = "Quality Guardian"
SHIPPING_REVIEWER = "Shipping Reviewer"
PROLIFIC_SHIPPER = "Prolific Shipper"
CODE_REVIEWER = "Code Reviewer"
FEATURE_SHIPPER = "Feature Shipper"
CODE_ENGINE = "Code Engine"
CONTRIBUTOR = "Contributor"

# --- fixed values: metric bar maxima (label, column, max) -------------------
METRIC_MAXIMA = (
    ("PRs", "prs_merged", 25),
    ("Reviews", "reviews", 20),
    ("Commits", "commits", 30),
    ("Issues", "issues_closed", 10),
)

# --- fixed values: score components (label, column) -------------------------
# Composition bar: five components, approvals omitted.
COMPOSITION = (
    ("PRs", "score_from_prs"),
    ("Catching issues", "score_from_catching_issues"),
    ("Reviews", "score_from_reviews"),
    ("Issues closed", "score_from_issues"),
    ("Commits", "score_from_commits"),
)
# Breakdown panel: all six components.
BREAKDOWN = (
    ("PRs Merged", "score_from_prs"),
    ("Changes Req", "score_from_catching_issues"),
    ("Reviews", "score_from_reviews"),
    ("Issues Closed", "score_from_issues"),
    ("Commits", "score_from_commits"),
    ("Approvals", "score_from_approvals"),
)
# Trend chart series (label, column).
TREND_SERIES = (
    ("PRs Merged", "prs_merged"),
    ("Reviews", "reviews"),
    ("Commits", "commits"),
)
PODIUM_SIZE = 3
RECENT_TITLES = 3            # newest titles shown beside a name

# --- fixed values: update columns of the keyed upserts ----------------------
UPDATE_COLS = {
    "commits": ("author_login", "author_avatar_url"),
    "pull_requests": ("title", "state", "merged_at", "closed_at", "review_comments", "comments"),
    "reviews": ("reviewer_type",),
    "issues": ("state", "closed_by_login", "closed_at", "updated_at"),
}
