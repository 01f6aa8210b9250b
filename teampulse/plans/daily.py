"""The daily run: landed JSON -> keyed upserts -> both marts by changed groups -> one run-log row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from teampulse import constants as K
from teampulse import schemas
from teampulse.plans import refresh, runs
from teampulse.session import scratch_path
from teampulse.sources import extract as X
from teampulse.sources import raw as R
from teampulse.sources import store
from teampulse.streaming.daily_load import aligned, in_landing_order


#: A table gets a bucket for so many rows of its first batch, so a merge has tasks as its table has rows.
BUCKET_ROWS = 25_000


def _extracted(kind: str, landed: dict[str, DataFrame], since: dt.datetime, prs: DataFrame | None = None) -> DataFrame:
    """Rows of one kind; ``prs`` are the merged PRs where they have been extracted already."""
    if kind == "commits":
        return X.extract_commits(landed[kind], since)
    if kind == "pull_requests":
        return X.extract_merged_prs(landed[kind], since)
    if kind == "reviews":
        prs = X.extract_merged_prs(landed["pull_requests"].drop("_seq"), since) if prs is None else prs
        return X.reviews_of(prs, X.extract_reviews(landed[kind]))
    return X.extract_closed_issues(landed[kind], since)


def run(spark: SparkSession, landing: dict[str, str], warehouse: str, *, since: dt.datetime, as_of: dt.datetime,
        loaded_at: dt.datetime, buckets: int, repo: str = "all", run_id: str | None = None) -> dict[str, str]:
    """One run over the landing folders (kind -> path). Returns the paths of the
    raw tables by kind (``store.read``), of the marts "impact" and "weekly"
    (``refresh.read_mart``) and of the run log ("runs"). A run that is played
    again under its ``run_id`` loads the same rows and is logged once. A raw
    table that is not there yet gets ``buckets`` shards and as many buckets, or
    one for each ``BUCKET_ROWS`` rows of the batch where these are more."""
    paths = {kind: f"{warehouse}/raw/{kind}" for kind in X.KINDS}
    paths |= {"impact": f"{warehouse}/marts/impact", "weekly": f"{warehouse}/marts/weekly", "runs": f"{warehouse}/runs"}
    landed = {kind: in_landing_order(spark.read.text(path).select("*", "_metadata")) for kind, path in landing.items()}
    tasks, batches = [], {}
    for kind, task in zip(X.KINDS, K.TRACKED_TASKS):
        batch = scratch_path(spark, f"batch-{kind}")
        aligned(_extracted(kind, landed, since, batches.get("pull_requests")), kind).write.parquet(batch)
        rows = batches[kind] = spark.read.schema(schemas.batch(kind)).parquet(batch)
        loaded = rows.count()
        store.upsert_into(spark, paths[kind], kind, rows, loaded_at=loaded_at, shards=buckets,
                          buckets=max(buckets, -(-loaded // BUCKET_ROWS)))
        tasks.append((0, task, K.STATUS_SUCCESS, loaded, loaded_at, repo))
    refresh.refresh(spark, {kind: paths[kind] for kind in X.KINDS}, {m: paths[m] for m in ("impact", "weekly")}, as_of)
    tasks.append((0, K.TRACKED_TASKS[4], K.STATUS_SUCCESS, 0, loaded_at, repo))
    R.append_run(runs.rollup_runs(spark.createDataFrame(tasks, schemas.TASK_STATES)), paths["runs"], run_id)
    return paths
