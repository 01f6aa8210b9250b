"""Landed JSON payloads -> raw rows.

Input: a frame with ``value`` (one JSON document per row, as read by
``read_landed``) and, unless a literal ``repo`` is given, a ``repo`` column
(the landing folder's partition). Documents are parsed with an explicit
schema (``from_json``); nothing is inferred. Dates stay ISO strings in the
payload and become timestamps (without zone) here.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from teampulse import schemas
from teampulse.functions import is_bot, since_second, ts_lit


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines landing folder (optionally ``repo=`` partitioned) as text."""
    return spark.read.text(path)


def land(payloads: DataFrame, path: str) -> None:
    """Write payload documents as JSON lines, one folder per repo."""
    payloads.select("repo", "value").write.mode("append").partitionBy("repo").text(path)


_EPOCH = dt.datetime(1970, 1, 1)


def instant(s: Column) -> Column:
    """UTC wall time of an ISO string, whatever the session's zone. Its offset
    counts; without one it is taken as UTC. NULL if it can't be read (see
    ``unreadable_dates``)."""
    zoned = F.when(s.rlike(r"([Zz]|[+-]\d{2}:?\d{2})\s*$"), s).otherwise(F.concat(s, F.lit("Z")))
    return F.timestamp_add("MICROSECOND", F.unix_micros(zoned.try_cast("timestamp")), ts_lit(_EPOCH))


def _truthy(s: Column) -> Column:
    return s.isNotNull() & (s != "")


#: Field of a parse that holds the document if a field of it can't be read as its type.
_BAD = "_bad_document"


def _absent_as_zero(d: Column, value: Column, names: tuple[str, ...]) -> Column:
    """``d`` with 0 for the counts whose key a readable document does not have. Keys are listed only where a count is
    NULL; a default in the schema would be worked out anew for each document, at many times the cost of the parse."""
    for name in names:
        absent = d[name].isNull() & d[_BAD].isNull() & ~F.array_contains(F.json_object_keys(value), name)
        d = d.withField(name, F.when(absent, F.lit(0)).otherwise(d[name]))
    return d.dropFields(_BAD)


def parse(landed: DataFrame, kind: str, repo: str | None = None) -> DataFrame:
    """Parse each document once: (repo, d). The parse stands below a one-row
    generator, which filters and projections above are not pushed through, so
    no plan repeats it. A parsed frame is taken as it is."""
    if "d" in landed.columns:
        return landed if repo is None else landed.withColumn("repo", F.lit(repo))
    repo_col = F.lit(repo) if repo is not None else F.col("repo")
    order = [F.col("_seq")] if "_seq" in landed.columns else []
    schema, counts = schemas.PAYLOADS[kind], schemas.ABSENT_IS_ZERO.get(kind, ())
    if not counts:
        return landed.select(repo_col.alias("repo"), *order, F.explode(F.array(F.from_json("value", schema))).alias("d"))
    schema = StructType([*schema.fields, StructField(_BAD, StringType())])
    document = F.from_json("value", schema, {"columnNameOfCorruptRecord": _BAD})
    parsed = landed.select(repo_col.alias("repo"), *order, "value", F.explode(F.array(document)).alias("d"))
    return parsed.select("repo", *order, _absent_as_zero(F.col("d"), F.col("value"), counts).alias("d"))


KINDS = ("commits", "pull_requests", "reviews", "issues")
DATES = {
    "commits": lambda d: [d["commit"]["author"]["date"]],
    "pull_requests": lambda d: [d[c] for c in ("merged_at", "created_at", "closed_at", "updated_at")],
    "issues": lambda d: [d[c] for c in ("created_at", "closed_at", "updated_at")],
}


def unreadable_dates(parsed: DataFrame, kind: str) -> DataFrame:
    """One row: documents, and those with a date that is given but can't be
    read (their rows fall out of every time window)."""
    bad = [_truthy(s) & instant(s).isNull() for s in DATES[kind](F.col("d"))]
    any_bad = bad[0]
    for cond in bad[1:]:
        any_bad = any_bad | cond
    return parsed.agg(F.count(F.lit(1)).alias("documents"), F.count(F.when(any_bad, 1)).alias("unreadable"))


def _order(df: DataFrame) -> list[str]:
    """The landing order, where a load has put one."""
    return ["_seq"] if "_seq" in df.columns else []


def extract_commits(landed: DataFrame, since: dt.datetime, repo: str | None = None,
                    extra_bots: tuple[str, ...] = (), message_chars: int | None = None) -> DataFrame:
    """Non-bot commits dated at or after ``since``, with the whole message
    or its first ``message_chars`` characters (code points)."""
    d = F.col("d")
    p = parse(landed, "commits", repo)
    committed = instant(d["commit"]["author"]["date"])
    message = d["commit"]["message"]
    if message_chars is not None:
        message = F.substring(message, 1, message_chars)
    return (p.where(~is_bot(d["author"], extra_bots))
             .select(d["sha"].alias("sha"),
                     d["author"]["login"].alias("author_login"),
                     d["author"]["avatar_url"].alias("author_avatar_url"),
                     d["author"]["type"].alias("author_type"),
                     message.alias("message"),
                     committed.alias("committed_at"),
                     "repo", *_order(p))
             .where(F.col("committed_at") >= ts_lit(since)))


def extract_merged_prs(landed: DataFrame, since: dt.datetime, repo: str | None = None,
                       extra_bots: tuple[str, ...] = ()) -> DataFrame:
    """Merged (non-empty ``merged_at``) PRs at or after ``since`` (whole
    seconds), non-bot author. A discussion count whose key is absent from the
    document reads 0; an explicit JSON null stays NULL."""
    d = F.col("d")
    p = parse(landed, "pull_requests", repo)
    return (p.where(_truthy(d["merged_at"]))
             .where(since_second(instant(d["merged_at"]), since))
             .where(~is_bot(d["user"], extra_bots))
             .select(d["number"].alias("pr_number"), "repo",
                     d["title"].alias("title"),
                     d["user"]["login"].alias("author_login"),
                     d["user"]["avatar_url"].alias("author_avatar_url"),
                     d["user"]["type"].alias("author_type"),
                     d["state"].alias("state"),
                     instant(d["merged_at"]).alias("merged_at"),
                     instant(d["created_at"]).alias("created_at"),
                     instant(d["closed_at"]).alias("closed_at"),
                     d["review_comments"].alias("review_comments"),
                     d["comments"].alias("comments"),
                     instant(d["updated_at"]).alias("updated_at"), *_order(p)))


def extract_reviews(landed: DataFrame, repo: str | None = None,
                    extra_bots: tuple[str, ...] = ()) -> DataFrame:
    """S3: one row per (PR, review); bots and reviews without login,
    submission time or state are dropped. Where a load has numbered the
    documents (``_seq``), ``_place`` is the review's place in its document, so
    that the two order the rows, reviews repeated in one document included."""
    p = parse(landed, "reviews", repo)
    order = _order(p)
    r = p.select("repo", *order, F.col("d")["pr_number"].alias("pr_number"),
                 F.posexplode(F.col("d")["reviews"]).alias("_place", "r"))
    order = [*order, "_place"] if order else []
    rv = F.col("r")
    return (r.where(~is_bot(rv["user"], extra_bots))
             .where(_truthy(rv["user"]["login"]) & _truthy(rv["submitted_at"]) & _truthy(rv["state"]))
             .select("pr_number", "repo",
                     rv["user"]["login"].alias("reviewer_login"),
                     rv["user"]["type"].alias("reviewer_type"),
                     rv["state"].alias("state"),
                     instant(rv["submitted_at"]).alias("submitted_at"), *order))


def extract_closed_issues(landed: DataFrame, since: dt.datetime, repo: str | None = None,
                          extra_bots: tuple[str, ...] = ()) -> DataFrame:
    """Issues updated at or after ``since`` that are not pull requests,
    closed at or after ``since`` (whole seconds), closed by a non-bot."""
    d = F.col("d")
    p = parse(landed, "issues", repo)
    is_pr = F.coalesce(F.size(d["pull_request"]) > 0, F.lit(False))  # any non-empty object
    return (p.where(instant(d["updated_at"]) >= ts_lit(since))
             .where(~is_pr)
             .where(_truthy(d["closed_at"]) & since_second(instant(d["closed_at"]), since))
             .where(~is_bot(d["closed_by"], extra_bots))
             .select(d["number"].alias("issue_number"), "repo",
                     d["title"].alias("title"), d["state"].alias("state"),
                     d["closed_by"]["login"].alias("closed_by_login"),
                     d["closed_by"]["type"].alias("closed_by_type"),
                     instant(d["created_at"]).alias("created_at"),
                     instant(d["closed_at"]).alias("closed_at"),
                     instant(d["updated_at"]).alias("updated_at"), *_order(p)))


def tag_load(rows: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """Stamp rows with the load time (``extracted_at``)."""
    return rows.withColumn("extracted_at", ts_lit(loaded_at))


def reviews_of(prs: DataFrame, reviews: DataFrame) -> DataFrame:
    """The reviews of all of ``prs`` (the filtered list)."""
    return reviews.join(prs.select("repo", "pr_number").distinct(), ["repo", "pr_number"], "left_semi")
