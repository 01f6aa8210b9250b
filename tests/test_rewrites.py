"""Hand rewrites against their literal forms (R1-R3, histogram rank, top-n)."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from teampulse.operators.ranking import positions, rank_desc, rank_top_k, top_n_per_group


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_histogram_rank_equals_window_rank(spark):
    rnd = random.Random(7)
    data = [(f"e{i}", f"r{rnd.randint(0, 2)}", float(rnd.randint(0, 6))) for i in range(300)]
    data += [(f"h{i}", "hot", float(rnd.randint(0, 40))) for i in range(500)]  # one hot repo
    df = spark.createDataFrame(data, "e string, repo string, s double")
    got = rank_desc(df, ["repo"], "s", "rk")
    want = df.withColumn("rk", F.rank().over(Window.partitionBy("repo").orderBy(F.col("s").desc()))
                         .cast("long"))
    assert _rows(got.select("e", "repo", "s", "rk")) == _rows(want.select("e", "repo", "s", "rk"))


def test_rank_after_top_k_equals_rank_then_limit(spark):
    rnd = random.Random(3)
    data = [(f"e{i:03d}", f"a{rnd.randint(0, 1)}", float(rnd.randint(0, 5))) for i in range(200)]
    df = spark.createDataFrame(data, "login string, avatar string, s double")
    for k in (1, 3, 10, 20):
        got = rank_top_k(df, "s", ["login", "avatar"], k, "rk")
        full = df.withColumn("rk", F.rank().over(Window.orderBy(F.col("s").desc())).cast("long"))
        want = full.orderBy("rk", "login", "avatar").limit(k)
        assert _rows(got) == _rows(want)


def test_top_n_per_group_with_hot_group(spark):
    data = [("hot", i, i % 17) for i in range(2000)] + [("cold", i, i) for i in range(5)]
    df = spark.createDataFrame(data, "g string, id int, v int").repartition(8)
    got = top_n_per_group(df, ["g"], [F.col("v").desc(), F.col("id").desc()], 3, "pos")
    rows = sorted((r.g, r.pos, r.id) for r in got.collect())
    want = []
    for g in ("cold", "hot"):
        members = sorted(((v, i) for gg, i, v in data if gg == g), reverse=True)[:3]
        want += [(g, pos, i) for pos, (_, i) in enumerate(members, 1)]
    assert rows == want
    for n in (3, 1000, 1001, 5000):  # a partial limit before the shuffle, whatever n
        plan = top_n_per_group(df, ["g"], [F.col("v").desc()], n)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("WindowGroupLimit") == 2


def test_rank_reads_its_rows_once_and_survives_a_hot_score(spark):
    data = [(f"e{i}", "r", 1.0 if i % 10 else float(i)) for i in range(400)]
    df = spark.createDataFrame(data, "e string, repo string, s double").groupBy("e", "repo").agg(F.max("s").alias("s"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = rank_desc(df, ["repo"], "s", "rk", spread=("e", "repo"))
        rows = {r.e: r.rk for r in got.collect()}
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scores = {e: s for e, _, s in data}
    assert all(rk == 1 + sum(x > scores[e] for x in scores.values()) for e, rk in rows.items()) and len(rows) == 400
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_board_insights_compute_the_board_once(spark):
    from teampulse import registry as Q

    for name, scans in (("profile_badge_relative", 4), ("podium_top3", 4), ("leaderboard_full", 4)):
        plan = Q.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") <= 2 * scans if name == "leaderboard_full" else plan.count("FileScan") == scans


def _positions_cases():
    rnd = random.Random(11)
    rows = [(f"e{i}", "hot", float(rnd.randint(0, 3))) for i in range(900)]           # runs longer than a range
    rows += [(f"f{i}", "all-equal", 5.0) for i in range(400)]
    rows += [(f"g{i}", None, None if i % 3 else 1.0) for i in range(60)]              # NULL group, NULL scores
    rows += [(f"h{i}", f"r{i % 7}", float(rnd.randint(0, 9))) for i in range(100)]
    return rows + [("twice", "r1", 4.0), ("twice", "r1", 4.0)]


def test_positions_equal_windows(spark):
    df = spark.createDataFrame(_positions_cases(), "e string, repo string, s double").repartition(5)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    for flag in ("true", "false"):  # one range for all rows, or many
        spark.conf.set(coalesce, flag)
        try:
            for by in (["repo"], []):
                w = Window.partitionBy(*by)
                want = df.select("*", F.row_number().over(w.orderBy(F.col("s").desc(), "e")).cast("long").alias("n"),
                                 F.rank().over(w.orderBy(F.col("s").desc())).cast("long").alias("rk"))
                got = positions(df, by, "s", [F.col("e").asc()], row_number="n", rank="rk")
                assert got.columns == want.columns
                assert sorted(map(str, _rows_any(got))) == sorted(map(str, _rows_any(want)))
        finally:
            spark.conf.set(coalesce, before)


def _rows_any(df):
    return [tuple(r) for r in df.collect()]


def test_positions_of_one_repo_spread_over_ranges_and_join_on_no_score(spark):
    df = spark.range(20_000).select(F.concat(F.lit("e"), "id").alias("e"), F.lit("r").alias("repo"),
                                    F.lit(2.0).alias("s"))
    off = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        got = positions(df, ["repo"], "s", [F.col("e").asc()], row_number="n", rank="rk")
        plan = got._jdf.queryExecution().executedPlan().toString()
        rows = got.agg(F.min("n"), F.max("n"), F.countDistinct("n"), F.max("rk")).first()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert tuple(rows) == (1, 20_000, 20_000, 1)
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert joins and not any(" s#" in line or "[s#" in line for line in joins)


def test_positions_of_nothing(spark):
    df = spark.createDataFrame([], "e string, repo string, s double")
    assert positions(df, ["repo"], "s", row_number="n").count() == 0
