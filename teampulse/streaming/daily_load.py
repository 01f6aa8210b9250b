"""The daily extract-and-load as a Structured Streaming query.

Each scheduled run starts the query with ``trigger(availableNow=True)``: it
takes every JSON file landed since the previous run (the file source's
checkpoint remembers what was read), extracts rows, merges each micro-batch
into the raw table with the keyed upsert, and stops.

Storage: every micro-batch writes the merged table as a new version folder
``<table>/version=<batch id>``; a version counts once its ``_SUCCESS`` marker
is there. A batch that is replayed recomputes from the version before it and
rewrites its own folder with the same rows. Versions older than the previous
one are removed after a batch.

Order: rows of a batch are numbered by the landing time of their file, its
path, the part of the file and the place in it, none of which depends on how
Spark packs files into tasks.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from teampulse import schemas
from teampulse.constants import UPDATE_COLS
from teampulse.operators.merge import upsert
from teampulse.session import scratch_path
from teampulse.sources import extract as X

#: Rows of one part of a file get numbers below this.
PART_STRIDE = 1 << 33


def _extract(kind: str, landed: DataFrame, since: dt.datetime) -> DataFrame:
    if kind == "commits":
        return X.extract_commits(landed, since)
    if kind == "pull_requests":
        return X.extract_merged_prs(landed, since)
    if kind == "reviews":
        return X.extract_reviews(landed)
    if kind == "issues":
        return X.extract_closed_issues(landed, since)
    raise ValueError(kind)


def aligned(rows: DataFrame, kind: str) -> DataFrame:
    present = set(rows.columns)
    return rows.select(*[(F.col(f.name) if f.name in present else F.lit(0 if f.name == "_place" else None))
                         .cast(f.dataType).alias(f.name) for f in schemas.batch(kind).fields])


def in_landing_order(landed: DataFrame) -> DataFrame:
    """Number the rows (``_seq``) by file time, path, part and place. ``landed``
    has the file source's ``_metadata``. The parts of a batch's files are
    numbered by a window over one row for each part, not over the rows."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(PART_STRIDE - 1))
    part = ["file_modification_time", "file_path", "file_block_start"]
    rows = landed.select("*", *[F.col(f"_metadata.{c}").alias(f"_{c}") for c in part], place.alias("_place"))
    keys = [f"_{c}" for c in part]
    parts = rows.select(*keys).distinct().withColumn("_part", F.row_number().over(Window.orderBy(*keys)))
    return (rows.join(F.broadcast(parts), keys)  # the rows are not exchanged
            .withColumn("_seq", F.col("_part").cast("long") * PART_STRIDE + F.col("_place"))
            .drop(*keys, "_place", "_part"))


def _versions(spark: SparkSession, table_path: str, complete: bool = True) -> list[int]:
    """Versions in the table's folder, oldest first; none if the folder is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        m = re.fullmatch(r"version=(\d+)", status.getPath().getName())
        marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if m and (not complete or fs.exists(marker)):
            found.append(int(m[1]))
    return sorted(found)


def read_current(spark: SparkSession, table_path: str, kind: str, before: int | None = None) -> DataFrame:
    """The newest complete version of a raw table (below ``before`` when given);
    an empty frame if there is none yet. A version that can't be read is an
    error, never an empty table."""
    schema = schemas.RAW[kind]
    versions = [v for v in _versions(spark, table_path) if before is None or v < before]
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{table_path}/version={versions[-1]}")


def _drop_older(spark: SparkSession, table_path: str, batch_id: int) -> None:
    """Remove versions that neither a reader nor a replay of this batch needs."""
    needed = [v for v in _versions(spark, table_path) if v <= batch_id][-2:]
    for v in _versions(spark, table_path, complete=False):
        if needed and v < needed[0]:
            _remove(spark, f"{table_path}/version={v}")


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def merge_batch(batch: DataFrame, batch_id: int, *, kind: str, table_path: str,
                since: dt.datetime, loaded_at: dt.datetime) -> None:
    """Merge landed documents (``value``, ``repo``, ``_seq``) into the next version."""
    spark = batch.sparkSession
    staged = scratch_path(spark, f"batch-{kind}")  # parsed once, read by each step of the merge
    aligned(_extract(kind, batch, since), kind).write.parquet(staged)
    rows = spark.read.schema(schemas.batch(kind)).parquet(staged)
    current = read_current(spark, table_path, kind, before=batch_id)
    merged = upsert(current, rows, schemas.KEYS[kind], UPDATE_COLS[kind],
                    seq_col=schemas.BATCH_ORDER, loaded_at=loaded_at)
    merged.write.mode("overwrite").parquet(f"{table_path}/version={batch_id}")
    _remove(spark, staged)
    _drop_older(spark, table_path, batch_id)


def start_daily_load(spark: SparkSession, kind: str, landing: str, table_path: str,
                     checkpoint: str, *, since: dt.datetime, loaded_at: dt.datetime) -> StreamingQuery:
    """Start one run of the daily load for ``kind``; returns the query (it
    stops by itself once the landed backlog is processed)."""
    stream = spark.readStream.format("text").load(landing).select("*", "_metadata")
    return (stream.writeStream
            .foreachBatch(lambda b, i: merge_batch(in_landing_order(b), i, kind=kind, table_path=table_path,
                                                   since=since, loaded_at=loaded_at))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
