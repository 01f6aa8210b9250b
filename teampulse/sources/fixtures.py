"""Raw activity tables derived from the driver's test tables.

``events`` supplies the activity tables row for row (FIXTURES.md §2);
``orders``/``lineitem`` supply a larger volume variant (FIXTURES.md §3).
Everything is a projection/filter of the given tables, so the work of every
query built on top grows with them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from teampulse.functions.columns import ts_lit

# --- fixed values: fixture clock and code lists -----------------------------
AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)
EXTRACTED_AT = dt.datetime(2024, 1, 31, 2, 0, 0)
RELOADED_AT = dt.datetime(2024, 2, 1, 2, 0, 0)
VOLUME_AS_OF = dt.datetime(2001, 8, 1, 0, 0, 0)
MESSAGE_PREFIXES = ("feat", "FIX", "chore", "refactor", "test", "docs", " feat", "bump")
REVIEW_STATES = ("APPROVED", "CHANGES_REQUESTED", "COMMENTED", "DISMISSED")
FIXTURE_TASKS = ("extract_commits", "extract_pull_requests", "extract_reviews",
                 "extract_issues", "run_dbt_transformations", "log_pipeline_run")
RETURNFLAG_STATES = (("A", "APPROVED"), ("R", "CHANGES_REQUESTED"), ("N", "COMMENTED"))
VOLUME_REPOS = 5


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: tuple[str, ...], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _hours_before(ts: Column, hours: Column) -> Column:
    return F.timestamp_add("HOUR", -hours, ts)


def activity(events: DataFrame) -> DataFrame:
    """Common columns: k from props, login, repo."""
    uid = F.col("user_id")
    login = (F.when(uid == 13, F.lit(None).cast("string"))
             .when(uid % 4 == 0, F.concat(F.lit("ENG-"), uid.cast("string")))
             .otherwise(F.concat(F.lit("eng-"), uid.cast("string"))))
    return events.select(
        "event_id", "ts", "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        login.alias("login"),
        F.concat(F.lit("org/repo"), (F.col("event_id") % 3).cast("string")).alias("repo"))


def raw_commits(events: DataFrame) -> DataFrame:
    a = activity(events).where(F.col("event_type") == "click")
    k = F.col("k")
    return a.select(
        F.col("event_id").cast("string").alias("sha"),
        F.col("login").alias("author_login"),
        F.concat(F.lit("https://a/"), F.col("login"),
                 F.when(k % 10 == 0, F.lit("?v=2")).otherwise(F.lit(""))).alias("author_avatar_url"),
        F.when(k % 20 == 3, F.lit("Bot")).otherwise(F.lit("User")).alias("author_type"),
        F.concat(_pick(MESSAGE_PREFIXES, k % 8), F.lit(": change "), k.cast("string"),
                 F.lit("  ")).alias("message"),
        F.when(k == 77, F.lit(None)).otherwise(F.col("ts")).alias("committed_at"),
        "repo",
        ts_lit(EXTRACTED_AT).alias("extracted_at"))


def raw_pull_requests(events: DataFrame) -> DataFrame:
    a = activity(events).where(F.col("event_type") == "purchase")
    k = F.col("k")
    return a.select(
        F.col("event_id").cast("int").alias("pr_number"),
        "repo",
        F.when(k % 9 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("  PR "), F.col("event_id").cast("string"), F.lit(" "))).alias("title"),
        F.col("login").alias("author_login"),
        F.concat(F.lit("https://a/"), F.col("login")).alias("author_avatar_url"),
        F.lit("User").alias("author_type"),
        F.lit("closed").alias("state"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("ts")).alias("merged_at"),
        _hours_before(F.col("ts"), k).alias("created_at"),
        F.col("ts").alias("closed_at"),
        F.when(k % 11 == 0, F.lit(None).cast("int")).otherwise(k % 5).alias("review_comments"),
        (k % 12).alias("comments"),
        ts_lit(EXTRACTED_AT).alias("extracted_at"))


def raw_reviews(events: DataFrame) -> DataFrame:
    a = activity(events).where((F.col("event_type") == "view") & F.col("login").isNotNull())
    return a.select(
        (F.col("event_id") - F.col("event_id") % 5).cast("int").alias("pr_number"),
        "repo",
        F.col("login").alias("reviewer_login"),
        F.lit("User").alias("reviewer_type"),
        _pick(REVIEW_STATES, F.col("k") % 4).alias("state"),
        F.col("ts").alias("submitted_at"),
        ts_lit(EXTRACTED_AT).alias("extracted_at"))


def raw_issues(events: DataFrame) -> DataFrame:
    a = activity(events).where(F.col("event_type") == "error")
    k = F.col("k")
    return a.select(
        F.col("event_id").cast("int").alias("issue_number"),
        "repo",
        F.concat(F.lit(" Issue "), k.cast("string")).alias("title"),
        F.lit("closed").alias("state"),
        F.col("login").alias("closed_by_login"),
        F.lit("User").alias("closed_by_type"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(_hours_before(F.col("ts"), k)).alias("created_at"),
        F.when(k == 50, F.lit(None)).otherwise(F.col("ts")).alias("closed_at"),
        F.col("ts").alias("updated_at"),
        ts_lit(EXTRACTED_AT).alias("extracted_at"))


def task_states(events: DataFrame) -> DataFrame:
    a = activity(events).where(F.col("event_type") == "signup")
    k = F.col("k")
    return a.select(
        F.floor(F.col("event_id") / 25).cast("long").alias("run_id"),
        _pick(FIXTURE_TASKS, k % 6).alias("task_id"),
        F.when(k == 33, F.lit(None).cast("string"))
         .when(k % 10 == 0, F.lit("failed")).otherwise(F.lit("success")).alias("state"),
        k.alias("loaded"),
        F.when((k % 16 == 9) | (F.col("event_id") % 75 < 3), F.lit(None)).otherwise(F.col("ts")).alias("ts"), "repo")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    events = load(spark, sf_dir, "events")
    return {
        "commits": raw_commits(events),
        "pull_requests": raw_pull_requests(events),
        "reviews": raw_reviews(events),
        "issues": raw_issues(events),
        "task_states": task_states(events),
    }


# --- upsert batches ---------------------------------------------------------

def _with_cutoff(df: DataFrame, id_col: Column) -> DataFrame:
    """Attach 60% of the table's largest id (a one-row aggregate, broadcast)."""
    cut = df.agg((F.max(id_col) * 0.6).alias("_cut"))
    return df.crossJoin(F.broadcast(cut))


def upsert_batches(df: DataFrame, id_col: str, changed: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split a raw table into (existing, incoming).

    existing = rows whose id is below 60% of the largest id; incoming = rows
    with even ids and all rows from that id on, each sent twice: ``_seq`` 0 as
    is, ``_seq`` 1 with the ``changed`` column expressions applied. Every row is
    on one side at least.
    """
    idc = F.col(id_col).cast("long")
    cols = df.columns
    cut = _with_cutoff(df, idc)
    existing = cut.where(idc < F.col("_cut")).select(*cols)
    sent = cut.where((idc % 2 == 0) | (idc >= F.col("_cut")))
    first = sent.select(*cols, F.lit(0).alias("_seq"))
    second = sent.select(*[changed.get(c, F.col(c)).alias(c) for c in cols], F.lit(1).alias("_seq"))
    return existing, first.unionByName(second)


def upsert_changes(table: str) -> tuple[str, dict[str, Column]]:
    """Id column and the second-copy changes for each raw table."""
    if table == "commits":
        return "sha", {
            "author_login": F.concat(F.col("author_login"), F.lit("-x")),
            "author_avatar_url": F.concat(F.col("author_avatar_url"), F.lit("?v=3")),
            "message": F.concat(F.lit("v2 "), F.col("message")),
        }
    if table == "pull_requests":
        return "pr_number", {
            "title": F.when(F.col("pr_number") % 4 == 0, F.lit(None).cast("string"))
                      .otherwise(F.concat(F.lit("v2 "), F.coalesce(F.col("title"), F.lit("")))),
            "author_login": F.upper(F.col("author_login")),
            "comments": F.col("comments") + 1,
        }
    if table == "reviews":
        return "pr_number", {"reviewer_type": F.lit("Member")}
    if table == "issues":
        return "issue_number", {
            "closed_by_login": F.upper(F.col("closed_by_login")),
            "title": F.concat(F.lit("v2 "), F.col("title")),
        }
    raise ValueError(table)


# --- landed JSON payloads ---------------------------------------------------

def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _user(login: Column, avatar: Column | None, utype: Column) -> Column:
    fields = [login.alias("login")]
    if avatar is not None:
        fields.append(avatar.alias("avatar_url"))
    fields.append(utype.alias("type"))
    return F.when(login.isNull(), F.lit(None)).otherwise(F.struct(*fields))


def _iso_offset(ts: Column) -> Column:
    """The same instant as a wall clock two hours ahead shows it."""
    return F.date_format(F.timestamp_add("HOUR", F.lit(2), ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'")


def commit_payloads(raw: DataFrame) -> DataFrame:
    """One JSON document per commit, as the commits endpoint returns them. By
    sha: 1 mod 29 has a ``[bot]`` login, 2 a listed bot's, 3 a long message, 4
    an empty author object, 5 a date that can't be read, 6 a date with an offset."""
    n = F.col("sha").cast("long") % 29
    login = F.when(n == 1, "ci[bot]").when(n == 2, "posthog-bot").otherwise(F.col("author_login"))
    user = F.when(n == 4, F.struct(F.lit(None).cast("string").alias("login"), F.lit(None).cast("string").alias("avatar_url"),
                                   F.lit(None).cast("string").alias("type"))).otherwise(
        _user(login, F.col("author_avatar_url"), F.when(n == 2, "User").otherwise(F.col("author_type"))))
    date = F.when(n == 5, "yesterday").when(n == 6, _iso_offset(F.col("committed_at"))).otherwise(_iso(F.col("committed_at")))
    message = F.when(n == 3, F.repeat(F.col("message"), 60)).otherwise(F.col("message"))
    doc = F.struct(
        F.col("sha").alias("sha"), user.alias("author"),
        F.struct(message.alias("message"), F.struct(date.alias("date")).alias("author")).alias("commit"))
    return raw.select("repo", F.to_json(doc).alias("value"))


def pull_payloads(raw: DataFrame) -> DataFrame:
    """PR documents. NULL fields of even numbers are explicit JSON nulls, those
    of odd ones are absent; numbers 3 mod 23 have an empty ``merged_at``."""
    doc = F.struct(
        F.col("pr_number").alias("number"), F.col("title"), F.col("state"),
        _user(F.col("author_login"), F.col("author_avatar_url"), F.col("author_type")).alias("user"),
        F.when(F.col("pr_number") % 23 == 3, F.lit("")).otherwise(_iso(F.col("merged_at"))).alias("merged_at"),
        _iso(F.col("created_at")).alias("created_at"),
        _iso(F.col("closed_at")).alias("closed_at"), _iso(F.col("closed_at")).alias("updated_at"),
        F.col("review_comments"), F.col("comments"))
    value = F.when(F.col("pr_number") % 2 == 0, F.to_json(doc, {"ignoreNullFields": "false"})).otherwise(F.to_json(doc))
    return raw.select("repo", value.alias("value"))


def review_payloads(raw: DataFrame) -> DataFrame:
    """One JSON document per PR with its list of reviews. A PR bucket holds at
    most five fixture events (pr_number = event_id - event_id % 5). Numbers 5
    mod 35 have reviews with an empty state, 10 mod 35 with an empty login, and
    15 mod 35 list all their reviews twice, the second time with type Member."""
    item = F.struct(
        F.struct(F.when(F.col("pr_number") % 35 == 10, F.lit("")).otherwise(F.col("reviewer_login")).alias("login"),
                 F.col("reviewer_type").alias("type")).alias("user"),
        F.when(F.col("pr_number") % 35 == 5, F.lit("")).otherwise(F.col("state")).alias("state"), _iso(F.col("submitted_at")).alias("submitted_at"))
    per_pr = raw.groupBy("repo", "pr_number").agg(F.collect_list(item).alias("reviews"))
    again = F.transform("reviews", lambda r: r.withField("user.type", F.lit("Member")))
    per_pr = per_pr.withColumn("reviews", F.when(F.col("pr_number") % 35 == 15, F.concat("reviews", again))
                               .otherwise(F.col("reviews")))
    return per_pr.select("repo", F.to_json(F.struct("pr_number", "reviews")).alias("value"))


def issue_payloads(raw: DataFrame) -> DataFrame:
    """Issue documents; numbers 5 and 6 mod 17 are pull requests in disguise
    (a ``pull_request`` object with ``url``, or with ``html_url`` only) and must
    be dropped; 7 mod 17 has an empty object and stays."""
    n = F.col("issue_number") % 17
    link = F.concat(F.lit("https://pr/"), F.col("issue_number").cast("string"))
    doc = F.struct(
        F.col("issue_number").alias("number"), F.col("title"), F.col("state"),
        F.when(n.isin(5, 6, 7), F.struct(F.when(n == 5, link).alias("url"), F.when(n == 6, link).alias("html_url")))
         .alias("pull_request"),
        _user(F.col("closed_by_login"), None, F.col("closed_by_type")).alias("closed_by"),
        _iso(F.col("created_at")).alias("created_at"), _iso(F.col("closed_at")).alias("closed_at"),
        _iso(F.col("updated_at")).alias("updated_at"))
    return raw.select("repo", F.to_json(doc).alias("value"))


# --- volume variant: orders / lineitem -------------------------------------

def volume_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Activity tables at TPC-H volume (FIXTURES.md §3)."""
    li = load(spark, sf_dir, "lineitem")
    od = load(spark, sf_dir, "orders")
    n_supp = load(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("_n"))
    eng = lambda c: F.concat(F.lit("eng-"), c.cast("string"))
    repo = lambda c: F.concat(F.lit("org/repo"), (c % VOLUME_REPOS).cast("string"))
    commits = li.where(F.col("l_linestatus") == "F").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                    F.col("l_partkey").cast("string")).alias("sha"),
        eng(F.col("l_suppkey")).alias("author_login"),
        F.concat(F.lit("https://a/"), eng(F.col("l_suppkey"))).alias("author_avatar_url"),
        F.lit("User").alias("author_type"),
        F.concat(F.lit("feat: "), F.col("l_returnflag")).alias("message"),
        F.col("l_shipdate").alias("committed_at"),
        repo(F.col("l_partkey")).alias("repo"),
        ts_lit(EXTRACTED_AT).alias("extracted_at"))
    state = None
    for flag, st in RETURNFLAG_STATES:
        cond = F.col("l_returnflag") == flag
        state = F.when(cond, st) if state is None else state.when(cond, st)
    reviews = li.where(F.col("l_linestatus") == "O").select(
        F.col("l_orderkey").cast("int").alias("pr_number"),
        repo(F.col("l_partkey")).alias("repo"),
        eng(F.col("l_suppkey")).alias("reviewer_login"),
        F.lit("User").alias("reviewer_type"),
        state.otherwise("COMMENTED").alias("state"),
        F.col("l_shipdate").alias("submitted_at"),
        ts_lit(EXTRACTED_AT).alias("extracted_at"))
    od_n = od.crossJoin(F.broadcast(n_supp))
    person = eng(F.col("o_custkey") % F.col("_n"))
    prs = od_n.where(F.col("o_orderstatus").isin("O", "P")).select(
        F.col("o_orderkey").cast("int").alias("pr_number"),
        repo(F.col("o_orderkey")).alias("repo"),
        F.concat(F.lit("PR "), F.col("o_orderpriority")).alias("title"),
        person.alias("author_login"),
        F.concat(F.lit("https://a/"), person).alias("author_avatar_url"),
        F.lit("User").alias("author_type"), F.lit("closed").alias("state"),
        F.col("o_orderdate").alias("merged_at"), F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("closed_at"),
        (F.col("o_orderkey") % 5).cast("int").alias("review_comments"),
        (F.col("o_custkey") % 7).cast("int").alias("comments"),
        ts_lit(EXTRACTED_AT).alias("extracted_at"))
    issues = od_n.where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").cast("int").alias("issue_number"),
        repo(F.col("o_orderkey")).alias("repo"),
        F.col("o_orderpriority").alias("title"), F.lit("closed").alias("state"),
        person.alias("closed_by_login"), F.lit("User").alias("closed_by_type"),
        F.col("o_orderdate").alias("created_at"), F.col("o_orderdate").alias("closed_at"),
        F.col("o_orderdate").alias("updated_at"), ts_lit(EXTRACTED_AT).alias("extracted_at"))
    return {"commits": commits, "pull_requests": prs, "reviews": reviews, "issues": issues}
