"""Pipeline run roll-up (A10): task states of a run -> one run-log row.

A run is a (run_id, repo) pair. Each task's latest attempt (by time) decides
its state; a NULL state reads ``unknown``. An attempt without time counts too,
as one before all that have a time. The run succeeded iff every tracked task
that ran ended in ``success``; a tracked task absent from the run is not a
failure. A loaded count is reported only by an extract task whose latest
attempt succeeded, else 0. Of attempts at the same time the one that sorts last
counts. ``run_at`` is the latest time of the run's attempts, NULL if none has
one. One aggregation by run: a maximum per tracked task, combined before the
exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse import constants as K


def rollup_runs(task_states: DataFrame) -> DataFrame:
    attempt = F.struct("ts", F.coalesce(F.col("state"), F.lit(K.STATE_UNKNOWN)).alias("state"), "loaded")
    g = task_states.groupBy("run_id", "repo").agg(
        F.max("ts").alias("run_at"),
        *[F.max(F.when(F.col("task_id") == t, attempt)).alias(f"_t_{t}") for t in K.TRACKED_TASKS])
    g = g.select("run_at", "repo", *[F.col(f"_t_{t}.state").alias(f"_s_{t}") for t in K.TRACKED_TASKS],
                 *[F.when(F.col(f"_t_{t}.state") == K.STATUS_SUCCESS, F.col(f"_t_{t}.loaded")).alias(f"_n_{name}")
                   for name, t in K.COUNT_TASKS])

    bad = {t: F.col(f"_s_{t}").isNotNull() & (F.col(f"_s_{t}") != K.STATUS_SUCCESS)
           for t in K.TRACKED_TASKS}
    any_bad = None
    for cond in bad.values():
        any_bad = cond if any_bad is None else (any_bad | cond)
    details = F.concat_ws(", ", *[
        F.when(bad[t], F.concat(F.lit(t + "="), F.col(f"_s_{t}"))) for t in sorted(K.TRACKED_TASKS)])
    return g.select(
        "run_at", "repo",
        F.when(any_bad, F.lit(K.STATUS_FAILED)).otherwise(F.lit(K.STATUS_SUCCESS)).alias("status"),
        *[F.coalesce(F.col(f"_n_{name}"), F.lit(0)).cast("int").alias(name) for name, _ in K.COUNT_TASKS],
        F.when(any_bad, F.concat(F.lit(K.ERROR_PREFIX), details)).alias("error_message"))
