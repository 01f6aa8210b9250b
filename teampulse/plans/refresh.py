"""Marts kept up to date by the groups that a load has changed.

After a load, ``store.changed`` names the (engineer, repo) groups that the loaded rows were in before or are in now.
Only these are aggregated again, over the staging views semi-joined to them; all other mart rows are taken as they are.
Ranks are computed anew in the repos of changed groups only.

A mart's folder holds one finished build per sub-folder and a pointer file that is written last, so a reader never sees
a half-written mart and a lost job costs nothing but its work. The pointer also records which states of the raw tables
the build is of; without one the marts are built in full.
"""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from teampulse import constants as K
from teampulse.functions import login_key
from teampulse.plans import marts, staging
from teampulse.session import scratch_path
from teampulse.sources import raw as R
from teampulse.sources import store
from teampulse.sources.extract import KINDS

GRAIN = list(marts.GRAIN)
#: The engineer of a raw row, by table.
ENGINEER = {"commits": "author_login", "pull_requests": "author_login", "reviews": "reviewer_login",
            "issues": "closed_by_login"}
SORT = {"impact": ("impact_rank",), "weekly": ("engineer_login", "week_start")}


def changed_groups(spark: SparkSession, raw_paths: dict[str, str], since: dict[str, int]) -> DataFrame:
    """(engineer_login, repo) groups that any raw table's batches after the given states have touched."""
    parts = [store.changed(spark, raw_paths[kind], kind, {"engineer_login": login_key(col), "repo": F.col("repo")}, since[kind])
             for kind, col in ENGINEER.items()]
    return reduce(DataFrame.unionByName, parts).where(F.col("engineer_login").isNotNull()).distinct()


def _of(stg: dict[str, DataFrame], groups: DataFrame) -> dict[str, DataFrame]:
    return {kind: df.join(groups, GRAIN, "left_semi") for kind, df in stg.items()}


def refreshed_impact(stg: dict[str, DataFrame], mart: DataFrame, groups: DataFrame, as_of: dt.datetime,
                     floor: int = K.MART_ACTIVITY_FLOOR, title_count: int = K.RECENT_TITLES) -> DataFrame:
    """The impact mart after ``groups`` changed: equal to a full build over ``stg``."""
    anew = marts.scored_activity(_of(stg, groups), floor, title_count)
    repos = groups.select("repo").distinct()
    same = mart.join(groups, GRAIN, "left_anti")
    ranked = marts.ranked_in_repo(
        same.join(repos, "repo", "left_semi").drop("impact_rank", "computed_at").unionByName(anew), at_once=True)
    rest = same.join(repos, "repo", "left_anti").drop("computed_at")
    return marts.impact_columns(ranked.unionByName(rest), as_of, title_count)


def refreshed_weekly(stg: dict[str, DataFrame], mart: DataFrame, groups: DataFrame) -> DataFrame:
    """The weekly mart after ``groups`` changed: equal to a full build over ``stg``."""
    return mart.join(groups, GRAIN, "left_anti").unionByName(marts.fct_engineer_weekly_trends(_of(stg, groups)))


def _record(spark: SparkSession, path: str) -> dict | None:
    """The newest pointer of a mart folder: its build's folder and schema, and the state of each raw table."""
    found = store.texts(spark, f"{path}/_current")
    return json.loads(found[max(found, key=int)]) if found else None


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """The newest finished build of a mart."""
    record = _record(spark, path)
    if record is None:
        raise LookupError(f"no mart at {path}")
    return spark.read.schema(StructType.fromJson(record["schema"])).parquet(f"{path}/{record['build']}")


def refresh(spark: SparkSession, raw_paths: dict[str, str], mart_paths: dict[str, str], as_of: dt.datetime, *,
            full: bool = False) -> bool:
    """Bring the marts ("impact", "weekly" -> folder) to the raw tables' newest states: by changed groups, or in full
    where a mart has not been built or ``full`` asks for it. Returns whether it was by groups."""
    states = {kind: (store.layout(spark, path) or store.Layout(-1, 0, 0, {})).number for kind, path in raw_paths.items()}
    stg = staging.staging({kind: store.read(spark, path, kind) for kind, path in raw_paths.items()})
    records = {name: _record(spark, path) for name, path in mart_paths.items()}
    known = [r["states"] for r in records.values() if r]
    by_groups = not full and len(known) == len(records) and all(k == known[0] for k in known)
    if by_groups:
        at = scratch_path(spark, "changed-groups")
        changed_groups(spark, raw_paths, known[0]).write.parquet(at)  # read by every side of both marts
        groups = spark.read.schema("engineer_login string, repo string").parquet(at)
        new = {"impact": refreshed_impact(stg, read_mart(spark, mart_paths["impact"]), groups, as_of),
               "weekly": refreshed_weekly(stg, read_mart(spark, mart_paths["weekly"]), groups)}
    else:
        new = {"impact": marts.fct_engineer_impact(stg, as_of, at_once=True), "weekly": marts.fct_engineer_weekly_trends(stg)}
    for name, path in mart_paths.items():
        number = max([int(n) for n in store.texts(spark, f"{path}/_current")], default=-1) + 1
        R.write_mart(new[name], f"{path}/build-{number}", sort_by=SORT[name])
        store.put_text(spark, f"{path}/_current", str(number), json.dumps(
            {"build": f"build-{number}", "schema": new[name].schema.jsonValue(), "states": states}))
    return by_groups
