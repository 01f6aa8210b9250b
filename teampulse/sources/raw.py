"""Raw tables, marts and the run log on storage.

Layout: Parquet, partitioned by ``repo``; reports filter on repo first, so
partition pruning and the pushed filters cut the scan. Tables that batches are
merged into are in ``sources.store``.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from teampulse import schemas


def read_raw(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A raw table with its fixed schema (never inferred)."""
    schema = schemas.RAW[table]
    df = spark.read.schema(schema).parquet(path)
    return df.select(*schema.fieldNames())


def write_table(df: DataFrame, path: str, *, mode: str = "overwrite",
                partition_by: tuple[str, ...] = ("repo",), sort_by: tuple[str, ...] = (),
                replace: str = "all") -> None:
    """Write a table partitioned by ``partition_by`` and, in each file, sorted
    by ``sort_by``. Rows are range-spread on the partition columns and the sort
    columns, or a hash of the row, so one very large repo is written by several
    tasks. ``replace``: "all" overwrites the whole table, so partitions that are
    not in ``df`` go; "touched" only the partitions that ``df`` has."""
    if replace not in ("all", "touched"):
        raise ValueError(f"unknown replace {replace!r}")
    spread = [F.col(c) for c in (*partition_by, *sort_by)]
    out = df.repartitionByRange(*spread, F.xxhash64(*df.columns))
    if sort_by:
        out = out.sortWithinPartitions(*spread)
    (out.write.mode(mode).option("partitionOverwriteMode", "static" if replace == "all" else "dynamic")
        .partitionBy(*partition_by).parquet(path))


def write_mart(df: DataFrame, path: str, sort_by: tuple[str, ...] = ()) -> None:
    """A mart is rebuilt in full on every run."""
    write_table(df, path, mode="overwrite", sort_by=sort_by)


def append_run(runs: DataFrame, path: str, run_id: str | None = None) -> None:
    """Append run-log rows; counts missing from a row read 0. Rows appended under a ``run_id`` replace those of
    an earlier attempt under the same id, so a run that is played again is logged once."""
    counts = ["commits_loaded", "prs_loaded", "reviews_loaded", "issues_loaded"]
    fixed = runs.select(*[(F.coalesce(F.col(c), F.lit(0)).cast("int") if c in counts else F.col(c)).alias(c)
                          for c in schemas.RAW_PIPELINE_RUNS.fieldNames()])
    if run_id is not None and not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError("a run id has letters, digits, dots, dashes and underscores only")
    fixed.write.mode("overwrite").parquet(f"{path}/run={run_id or uuid.uuid4().hex}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    schema = schemas.RAW_PIPELINE_RUNS
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
