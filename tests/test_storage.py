"""Raw/mart storage helpers."""

import datetime as dt
import os

from pyspark.sql import functions as F

from teampulse.schemas import RAW_COMMITS
from teampulse.sources import raw as R

T = dt.datetime


def test_write_read_raw_partitioned(spark, tmpdir_path):
    rows = [("1", "ann", "u", "User", "m", T(2024, 1, 1), "org/a", None),
            ("2", "bo", "u", "User", "m", T(2024, 1, 2), "org/b", None)]
    path = os.path.join(tmpdir_path, "commits")
    R.write_table(spark.createDataFrame(rows, RAW_COMMITS), path, sort_by=("committed_at",))
    assert {d for d in os.listdir(path) if d.startswith("repo=")} == {"repo=org%2Fa", "repo=org%2Fb"}
    back = R.read_raw(spark, path, "commits")
    assert back.columns == RAW_COMMITS.fieldNames()
    pruned = back.where(F.col("repo") == "org/a")
    assert [r.sha for r in pruned.collect()] == ["1"]
    assert "PartitionFilters: [isnotnull(repo" in pruned._jdf.queryExecution().executedPlan().toString()


def test_append_run_defaults_counts(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "runs")
    runs = spark.createDataFrame([(T(2024, 1, 1), "org/a", "success", None, 3, None, None, None)],
                                 "run_at timestamp_ntz, repo string, status string, commits_loaded int, "
                                 "prs_loaded int, reviews_loaded int, issues_loaded int, error_message string")
    R.append_run(runs, path)
    R.append_run(runs, path)
    got = R.read_runs(spark, path).collect()
    assert len(got) == 2 and all((r.commits_loaded, r.prs_loaded, r.issues_loaded) == (0, 3, 0) for r in got)


MART = "repo string, engineer_login string, n int"


def test_rebuild_drops_repos_that_left(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "mart")
    R.write_mart(spark.createDataFrame([("r1", "a", 1), ("r2", "b", 2)], MART), path)
    R.write_mart(spark.createDataFrame([("r1", "a", 3)], MART), path)
    assert [(r.repo, r.n) for r in spark.read.parquet(path).collect()] == [("r1", 3)]


def test_touched_partitions_only(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "mart")
    R.write_table(spark.createDataFrame([("r1", "a", 1), ("r2", "b", 2)], MART), path)
    R.write_table(spark.createDataFrame([("r1", "a", 3)], MART), path, replace="touched")
    assert sorted((r.repo, r.n) for r in spark.read.parquet(path).collect()) == [("r1", 3), ("r2", 2)]


def test_one_large_repo_is_written_by_several_tasks(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "mart")
    df = spark.range(0, 4000).selectExpr("'r' AS repo", "cast(id AS string) AS engineer_login", "cast(id AS int) AS n")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        R.write_table(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = [f for f in os.listdir(os.path.join(path, "repo=r")) if f.endswith(".parquet")]
    assert len(files) > 1


def test_a_run_played_again_is_logged_once(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "runs")
    schema = ("run_at timestamp_ntz, repo string, status string, commits_loaded int, prs_loaded int, reviews_loaded int, "
              "issues_loaded int, error_message string")
    for status, run_id in (("failed", "2024-01-01"), ("success", "2024-01-01"), ("success", "2024-01-02")):
        R.append_run(spark.createDataFrame([(T(2024, 1, 1), "org/a", status, 1, 1, 1, 1, None)], schema), path, run_id)
    got = R.read_runs(spark, path)
    assert got.columns == [f.split(" ")[0] for f in schema.split(", ")]
    assert [r.status for r in got.collect()] == ["success", "success"]
