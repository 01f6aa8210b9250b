"""Look-ups of one engineer, SQL functions, boards of several windows, title pages, mergeable days."""

import datetime as dt
import random

from pyspark.sql import functions as F

from teampulse import constants as K
from teampulse import schemas
from teampulse.functions import commit_type, discussion_level, is_bot, week_start
from teampulse.functions import sql as SQL
from teampulse.plans import aggregates as A
from teampulse.plans import marts, reports
from teampulse.sources import lookup

T = dt.datetime
AS_OF = T(2024, 4, 1, 6)


def _raw(spark, n=900, logins=40):
    rnd = random.Random(3)
    at = lambda: AS_OF - dt.timedelta(hours=rnd.randint(-30, 24 * 100), minutes=rnd.randint(0, 59))
    who = lambda: rnd.choice([None, "HOT", "hot", *[f"Eng{i}" for i in range(logins)]])
    commits, prs, reviews, issues = [], [], [], []
    for i in range(n):
        login = who()
        commits.append((str(i), login, rnd.choice([None, "a", "b"]), "User", "m", rnd.choice([None, at(), at(), at()]), f"r{i % 2}", None))
        prs.append((i, f"r{i % 2}", f"t{i}", who(), "u", "User", "closed", rnd.choice([None, at(), at()]), at(), at(),
                    rnd.choice([None, 1, 2]), 3, None))
        reviews.append((i, f"r{i % 2}", who(), "User", rnd.choice(["APPROVED", "CHANGES_REQUESTED", "COMMENTED", "DISMISSED"]), at(), None))
        issues.append((i, f"r{i % 2}", "t", "closed", who(), "User", at(), at(), at(), None))
    return {k: spark.createDataFrame(v, schemas.RAW[k]) for k, v in
            (("commits", commits), ("pull_requests", prs), ("reviews", reviews), ("issues", issues))}


def _sorted(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_boards_of_all_windows_equal_single_boards(spark):
    raw = _raw(spark)
    got = reports.window_boards(raw, "r0", as_of=AS_OF, limit=15)
    for days in K.VALID_DAYS:
        one = reports.leaderboard(raw, "r0", as_of=AS_OF, days=days, limit=15, title_count=0)
        assert _sorted(got.where(F.col("days") == days).drop("days")) == _sorted(one)


def test_boards_of_all_windows_scan_each_table_once(spark, tmpdir_path):
    raw = {}
    for name, df in _raw(spark, 60).items():
        df.write.parquet(f"{tmpdir_path}/{name}")
        raw[name] = spark.read.parquet(f"{tmpdir_path}/{name}")
    rows = reports.window_boards(raw, "r0", as_of=AS_OF)
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = {name: plan.count(f"{tmpdir_path}/{name}]") for name in raw}
    shared = plan.count("ReusedExchange")
    assert set(scans.values()) == {1} or shared >= 1 and max(scans.values()) <= 1 + shared


def _numbers(plan, out):
    if plan.getClass().getSimpleName() == "FileSourceScanExec":
        out.append({"files": plan.metrics().apply("numFiles").value(), "rows": plan.metrics().apply("numOutputRows").value()})
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        _numbers(plan.executedPlan(), out)
    if hasattr(plan, "plan") and "QueryStage" in plan.getClass().getSimpleName():
        _numbers(plan.plan(), out)
    children = plan.children()
    for i in range(children.size()):
        _numbers(children.apply(i), out)
    return out


def test_lookup_reads_one_bucket_and_pushes_the_login(spark, tmpdir_path):
    raw = _raw(spark)
    lookup.write(raw, tmpdir_path, buckets=8)
    found = lookup.read(spark, tmpdir_path, "HOT", buckets=8)
    for name, (login, ts, more) in lookup.TABLES.items():
        want = raw[name].where((F.lower(login) == "hot") & F.col(ts).isNotNull()).select(F.lower(login).alias(login), "repo", ts, *more)
        assert _sorted(found[name]) == _sorted(want) and found[name].count() > 10
        plan = found[name]._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(engineer_login,hot)" in plan.split("PushedFilters: ")[1].split("]")[0]
        assert "login_bucket" in plan.split("PartitionFilters: ")[1].split("]")[0]
        probe = found[name].select("repo")
        probe.collect()
        read = _numbers(probe._jdf.queryExecution().executedPlan(), [])
        every = spark.read.parquet(f"{tmpdir_path}/{name}").inputFiles()
        assert len(read) == 1 and 0 < read[0]["files"] < len(every)
    a = reports.engineer_trends(found, "hot", "r0", as_of=AS_OF, days=90)
    assert _sorted(a) == _sorted(reports.engineer_trends(raw, "hot", "r0", as_of=AS_OF, days=90))
    assert all(df.count() == 0 for df in lookup.read(spark, tmpdir_path, "nobody", buckets=8).values())


def test_a_hot_engineer_is_written_by_several_tasks(spark, tmpdir_path):
    one = spark.range(20_000).select(F.lit("x").alias("author_login"), F.lit("r").alias("repo"),
                                     F.timestamp_add("SECOND", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("committed_at"))
    none = spark.createDataFrame([], schemas.RAW_PULL_REQUESTS), spark.createDataFrame([], schemas.RAW_REVIEWS)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lookup.write({"commits": one, "pull_requests": none[0], "reviews": none[1]}, tmpdir_path, buckets=4)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(spark.read.parquet(f"{tmpdir_path}/commits").inputFiles()) > 3


def test_sql_functions_equal_the_column_functions(spark):
    SQL.register(spark, extra_bots=("House-Bot",))
    users = [(login, kind) for login in (None, "", "ann", "Dependabot", "x[bot]", "X[BOT]", "house-bot", "it's") for kind in (None, "User", "Bot")]
    df = spark.createDataFrame(users, "login string, type string")
    both = df.select(F.expr("is_bot(login, type)").alias("a"), is_bot(F.struct("login", "type"), ("House-Bot",)).alias("b"))
    assert all(r.a == r.b for r in both.collect())
    texts = spark.createDataFrame([(t,) for t in ("feat: x", "FIX y", " feat", "docs", "choreography", "", None, "Test\nx")], "m string")
    assert all(r.a == r.b for r in texts.select(F.expr("commit_kind(m)").alias("a"), commit_type("m").alias("b")).collect())
    totals = spark.createDataFrame([(t,) for t in (None, 0, 1, 3, 4, 10, 11)], "t int")
    assert all(r.a == r.b for r in totals.select(F.expr("discussion_kind(t)").alias("a"), discussion_level("t").alias("b")).collect())
    days = spark.createDataFrame([(T(2024, 1, d, 23),) for d in range(1, 16)] + [(None,)], "ts timestamp_ntz")
    assert all(r.a == r.b for r in days.select(F.expr("week_of(ts)").alias("a"), week_start("ts").alias("b")).collect())
    assert spark.sql("SELECT impact_points(1, 2, 3, 4, 5, 6)").first()[0] == 8 + 8 + 9 + 8 + 5 + 6


def test_sql_views_equal_the_staging_models(spark):
    from teampulse.plans import staging

    raw = _raw(spark, 200)
    SQL.register(spark, raw)
    for name, df in staging.staging(raw).items():
        view = spark.table(f"v_{name}")
        assert view.columns == df.columns and _sorted(view) == _sorted(df)


def test_title_pages_hold_every_title_once_in_order(spark):
    prs = [(i, "r", f"t{i:05d}" if i % 10 else None, "hot", T(2024, 1, 1) + dt.timedelta(minutes=i // 2)) for i in range(3000)]
    prs += [(i, "r", f"t{i}", "cold", T(2024, 1, 1)) for i in range(5000, 5003)]
    df = spark.createDataFrame(prs, "pr_number int, repo string, title string, engineer_login string, merged_at timestamp_ntz")
    pages = marts.pr_title_pages(df, 7).collect()
    assert all(1 <= len(p.titles) <= 7 for p in pages)
    hot = [t for p in sorted((p for p in pages if p.engineer_login == "hot"), key=lambda p: p.page) for t in p.titles]
    want = [r[2] for r in sorted((r for r in prs if r[3] == "hot" and r[2]), key=lambda r: (r[4], r[0]), reverse=True)]
    assert hot == want
    assert [p.titles for p in pages if p.engineer_login == "cold"] == [["t5002", "t5001", "t5000"]]


def test_activity_by_day_bitmaps_takes_one_exchange(spark):
    from teampulse.plans import staging

    stg = staging.staging(_raw(spark, 400))
    got = marts.engineer_activity(stg, day_bitmaps=True)
    assert _sorted(got) == _sorted(marts.engineer_activity(stg))
    assert got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1
    far = spark.createDataFrame([("a", "r", dt.date(1900, 1, 1)), ("a", "r", dt.date(2024, 1, 1))], "engineer_login string, repo string, commit_date date")
    try:
        marts.engineer_activity({**stg, "commits": far}, day_bitmaps=True).collect()
        raise AssertionError("days beyond one bitmap must fail")
    except Exception as e:  # noqa: BLE001
        assert "span more than one bitmap" in str(e)


def test_day_states_merge_to_exact_counts(spark):
    rnd = random.Random(9)
    days = [dt.date(1969, 12, 30), dt.date(1970, 1, 1), dt.date(2059, 9, 18), dt.date(2059, 9, 19), dt.date(2059, 9, 20), dt.date(2200, 1, 1),
            *[dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(60)]]
    rows = [(rnd.choice(["a", "b"]), "r", rnd.choice([*days, None])) for _ in range(400)]
    parts = [spark.createDataFrame(rows[i::3], "engineer_login string, repo string, commit_date date") for i in range(3)]
    got = A.active_days(A.merged_day_states(*map(A.active_day_states, parts)))
    want = {}
    for who, _, day in rows:
        want.setdefault(who, set()).add(day)
    assert {r.engineer_login: r.active_days for r in got.collect()} == {w: len(d - {None}) for w, d in want.items()}
