"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 5). Every query is run once to warm the JVM up, then
each is timed BENCH_RUNS times; the median is reported. Queries execute in full through the ``noop``
sink (nothing is collected to the driver).

Two families: the event-derived activity tables (C5-C10 at the driver's
scale factor) and a volume variant built from orders/lineitem (about six
times more rows), which exercises the same plans at larger size. ``value``
totals those nine, as in earlier rounds; extraction, upserts and the marts
with titles are timed too and listed with them in ``queries``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from teampulse import registry as Q  # noqa: E402
from teampulse.plans import marts, reports, runs, staging  # noqa: E402
from teampulse.session import build_session  # noqa: E402
from teampulse.sources import fixtures as FX  # noqa: E402


def headline(spark, sf_dir):
    raw = FX.raw_tables(spark, sf_dir)
    stg = staging.staging(raw)
    vol = FX.volume_tables(spark, sf_dir)
    vstg = staging.staging(vol)
    rolled = runs.rollup_runs(raw["task_states"])
    return {
        "fct_engineer_impact": lambda: marts.fct_engineer_impact(stg, Q.AS_OF, title_count=0),
        "fct_engineer_weekly_trends": lambda: marts.fct_engineer_weekly_trends(stg),
        "leaderboard_90d": lambda: reports.leaderboard(raw, Q.REPO, as_of=Q.AS_OF, days=90, limit=20, title_count=0),
        "engineer_trends": lambda: reports.engineer_trends(raw, Q.LOGIN, Q.REPO, as_of=Q.AS_OF, days=30),
        "team_summary": lambda: reports.team_summary(raw, Q.REPO, as_of=Q.AS_OF, days=30),
        "pipeline_status": lambda: reports.pipeline_status(rolled),
        "vol_fct_engineer_impact": lambda: marts.fct_engineer_impact(vstg, FX.VOLUME_AS_OF, title_count=0),
        "vol_fct_engineer_weekly_trends": lambda: marts.fct_engineer_weekly_trends(vstg),
        "vol_leaderboard_90d": lambda: reports.leaderboard(vol, Q.REPO, as_of=FX.VOLUME_AS_OF,
                                                           days=90, limit=20, title_count=0),
    }


def more(spark, sf_dir):
    """Timed beside the headline, not part of its total."""
    names = ("extract_commits", "extract_merged_prs", "extract_reviews", "extract_closed_issues", "upsert_commits",
             "upsert_pull_requests", "upsert_reviews", "upsert_issues", "fct_engineer_impact_titles", "leaderboard",
             "leaderboard_full", "leaderboard_positions", "leaderboard_all_windows", "pr_title_pages")
    registered = Q.queries()
    return {name: (lambda f=registered[name]: f(spark, sf_dir)) for name in names}


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    n = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(f"local[{cpus}]", max(cpus, 8), app_name="teampulse-bench",
                          extra={"spark.driver.memory": "8g"})
    times = {}
    total = headline(spark, sf_dir)
    plans = total | more(spark, sf_dir)
    for build in plans.values():
        run(build())
    for name, build in plans.items():
        samples = []
        for _ in range(n):
            t0 = time.perf_counter()
            run(build())
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 4)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_median", "value": round(sum(times[k] for k in total), 4),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "runs": n}))
    spark.stop()


if __name__ == "__main__":
    main()
