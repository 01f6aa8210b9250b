"""Raw tables for keyed upserts: Spark buckets of the key, replaced shard by shard.

    <path>/gen-<n>/shard=<s>/...    rows of a shard, in Spark's bucket files by key
    <path>/delta-<n>/shard=<s>/...  batch n, one row per key, in the same buckets
    <path>/_current/<n>             the generation each shard is read from, and the layout

A batch is read once: condensed to one row per key and written as a delta. Stored table and delta then have the same
buckets, so their full outer join exchanges neither. Only the shards that the delta holds are read and written, into a
folder of a new generation; the small file in ``_current`` comes last and is what makes it the table. A job that is lost
before that leaves the old table as it was, and running the batch again replaces the half-written folders.

Shards say how finely a batch can spare the rest of the table, buckets how many tasks merge it; both are fixed when the
table is created and may be as many as the table needs (rows of a bucket in one shard should fit a task).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from teampulse import schemas
from teampulse.constants import UPDATE_COLS
from teampulse.operators.merge import condensed, merged

SHARD = "shard"


@dataclass(frozen=True)
class Layout:
    """What a file of ``_current`` says: its number, the table's layout and the generation of each shard."""

    number: int
    buckets: int
    shards: int
    generation: dict[int, int]


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def put_text(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Write a small file beside its place and rename it there; fails if another writer has been first."""
    tmp, fs = _path(spark, f"{folder}/.{uuid.uuid4().hex}")
    out = fs.create(tmp)
    out.write(bytearray(text.encode()))
    out.close()
    final = _path(spark, f"{folder}/{name}")[0]
    if fs.exists(final) or not fs.rename(tmp, final):
        raise RuntimeError(f"{folder}/{name} has been written by another job")


def texts(spark: SparkSession, folder: str) -> dict[str, str]:
    """The small files of a folder by name; none if it is not there."""
    out = {}
    for name in _names(spark, folder):
        if not name.startswith("."):
            file, fs = _path(spark, f"{folder}/{name}")
            stream = fs.open(file)
            out[name] = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
    return out


def layouts(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the table's complete states, oldest first."""
    return sorted(int(n) for n in _names(spark, f"{path}/_current") if n.isdigit())


def layout(spark: SparkSession, path: str, number: int | None = None) -> Layout | None:
    """The newest state of the table, or the one with this number; None if the table is not there."""
    found = {int(n): text for n, text in texts(spark, f"{path}/_current").items()}
    if not found:
        return None
    number = max(found) if number is None else number
    facts = json.loads(found[number])
    return Layout(number, facts["buckets"], facts["shards"], {int(s): g for s, g in facts["generation"].items()})


def _publish(spark: SparkSession, path: str, state: Layout) -> None:
    put_text(spark, f"{path}/_current", str(state.number),
             json.dumps({"buckets": state.buckets, "shards": state.shards, "generation": state.generation}))


def _shard(keys, shards: int):
    return F.pmod(F.xxhash64(F.lit(SHARD), *keys), F.lit(shards)).cast("int").alias(SHARD)


def _write(rows: DataFrame, path: str, keys, buckets: int) -> None:
    """Bucket files of rows that have a shard column, below path; whatever a lost job left there goes."""
    spark = rows.sparkSession
    name = f"store_{uuid.uuid4().hex}"
    (rows.write.mode("overwrite").partitionBy(SHARD).bucketBy(buckets, *keys).format("parquet")
         .option("path", path).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # the catalog entry; the files stay


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


class _Buckets:
    """Bucket files as a table of the session's catalog, so that scans know their buckets; dropped on exit."""

    def __init__(self, spark, schema, keys, buckets, folders: dict[int, str]):
        self.spark, self.name = spark, f"store_{uuid.uuid4().hex}"
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE {self.name} ({_ddl(schema)}, {SHARD} INT) USING parquet PARTITIONED BY ({SHARD}) "
                  f"CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{next(iter(folders.values()), '/none')}-none'")
        if folders:
            spark.sql(f"ALTER TABLE {self.name} ADD " + " ".join(
                f"PARTITION ({SHARD}={s}) LOCATION '{folder}'" for s, folder in folders.items()))

    def __enter__(self) -> DataFrame:
        return self.spark.table(self.name)

    def __exit__(self, *_):
        self.spark.sql(f"DROP TABLE {self.name}")


def _shards_in(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in _names(spark, folder) if n.startswith(f"{SHARD}="))


def create(rows: DataFrame, path: str, table: str, *, shards: int, buckets: int) -> Layout:
    """Store rows, whose keys are unique, as the first state of a table; raises if the table is there."""
    spark = rows.sparkSession
    if layout(spark, path):
        raise ValueError(f"{path} holds a table")
    keys = schemas.KEYS[table]
    folder = f"{path}/gen-0"
    _write(rows.select(*schemas.RAW[table].fieldNames(), _shard(keys, shards)).repartition(buckets, *keys),
           folder, keys, buckets)
    state = Layout(0, buckets, shards, {s: 0 for s in _shards_in(spark, folder)})
    _publish(spark, path, state)
    return state


def read(spark: SparkSession, path: str, table: str, number: int | None = None) -> DataFrame:
    """The table in its newest state, or in the one with this number; empty if it is not there."""
    schema = schemas.RAW[table]
    state = layout(spark, path, number)
    if state is None or not state.generation:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/gen-{g}/{SHARD}={s}" for s, g in sorted(state.generation.items())])


def _delta_schema(table: str) -> StructType:
    """Columns of a condensed batch."""
    fields = {f.name: f for f in schemas.RAW[table].fields}
    keys, update = schemas.KEYS[table], UPDATE_COLS[table]
    insert = [c for c in fields if c not in keys and c not in update and c != "extracted_at"]
    parts = [fields[k] for k in keys]
    if insert:
        parts.append(StructField("_first", StructType([fields[c] for c in insert])))
    return StructType([*parts, StructField("_last", StructType([fields[c] for c in (*update, "extracted_at")]))])


@contextmanager
def _joined(spark: SparkSession, path: str, table: str, old: Layout, loaded_at: dt.datetime) -> Iterator[DataFrame]:
    """The shards that the delta after state ``old`` touches, merged: a join of buckets with buckets."""
    keys, cols = schemas.KEYS[table], schemas.RAW[table].fieldNames()
    delta = f"{path}/delta-{old.number + 1}"
    touched = _shards_in(spark, delta)
    kept = {s: f"{path}/gen-{g}/{SHARD}={s}" for s, g in old.generation.items() if s in touched}
    with (_Buckets(spark, schemas.RAW[table], keys, old.buckets, kept) as stored,
          _Buckets(spark, _delta_schema(table), keys, old.buckets, {s: f"{delta}/{SHARD}={s}" for s in touched}) as batch):
        yield merged(stored.select(*cols), batch.drop(SHARD), keys, UPDATE_COLS[table], loaded_at=loaded_at)


def upsert_into(spark: SparkSession, path: str, table: str, incoming: DataFrame, *, loaded_at: dt.datetime,
                seq_col=schemas.BATCH_ORDER, shards: int = 16, buckets: int = 16) -> Layout:
    """Merge a batch into the stored table and return its new state. ``incoming`` is read once. ``shards`` and
    ``buckets`` are those of a table that is not there yet; an empty batch makes a new state with the old rows."""
    keys, cols = schemas.KEYS[table], schemas.RAW[table].fieldNames()
    old = layout(spark, path) or Layout(-1, buckets, shards, {})
    number = old.number + 1
    seqs = [seq_col] if isinstance(seq_col, str) else [c for c in seq_col if c in incoming.columns]
    batch = condensed(incoming, cols, keys, UPDATE_COLS[table], seq_col=seqs, partitions=old.buckets)
    _write(batch.withColumn(SHARD, _shard(keys, old.shards)), f"{path}/delta-{number}", keys, old.buckets)
    touched = _shards_in(spark, f"{path}/delta-{number}")
    if touched:
        with _joined(spark, path, table, old, loaded_at) as out:
            _write(out.withColumn(SHARD, _shard(keys, old.shards)), f"{path}/gen-{number}", keys, old.buckets)
    state = Layout(number, old.buckets, old.shards, {**old.generation, **{s: number for s in touched}})
    _publish(spark, path, state)
    return state


def merge_plan(spark: SparkSession, path: str, table: str, loaded_at: dt.datetime) -> str:
    """The physical plan that merged the newest batch."""
    with _joined(spark, path, table, layout(spark, path, layouts(spark, path)[-2]), loaded_at) as out:
        return out._jdf.queryExecution().executedPlan().toString()


def changed(spark: SparkSession, path: str, table: str, columns: dict[str, Column], since: int) -> DataFrame:
    """The values that ``columns`` (name -> expression over the table) had or have in the rows that the batches after
    state ``since`` touched, distinct: the groups whose aggregates can have changed. ``since`` may be -1 (no table)."""
    keys = list(schemas.KEYS[table])
    key_schema = StructType([schemas.RAW[table][k] for k in keys])
    pick = [c.alias(name) for name, c in columns.items()]
    out = spark.createDataFrame([], schemas.RAW[table]).select(*pick)
    for number in layouts(spark, path):
        folder = f"{path}/delta-{number}"
        touched = _shards_in(spark, folder) if number > since else []
        if not touched:
            continue
        batch = spark.read.schema(key_schema).parquet(*[f"{folder}/{SHARD}={s}" for s in touched])
        for state in (n for n in (number - 1, number) if n >= 0):  # before and after the batch
            generation = layout(spark, path, state).generation
            folders = [f"{path}/gen-{generation[s]}/{SHARD}={s}" for s in touched if s in generation]
            if folders:
                rows = spark.read.schema(schemas.RAW[table]).parquet(*folders)
                out = out.unionByName(rows.join(batch, keys, "left_semi").select(*pick))
    return out.distinct()


def expire(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove states but the newest ``keep``, and the folders that none of these names."""
    if keep < 1:
        raise ValueError("keep must be positive")
    states = layouts(spark, path)
    stay = [layout(spark, path, n) for n in states[-keep:]]
    needed = {(g, s) for state in stay for s, g in state.generation.items()}
    for n in states[:-keep]:
        p, fs = _path(spark, f"{path}/_current/{n}")
        fs.delete(p, False)
    for name in _names(spark, path):
        kind, _, number = name.partition("-")
        if kind == "delta" and number.isdigit() and int(number) < stay[0].number:
            p, fs = _path(spark, f"{path}/{name}")
            fs.delete(p, True)
        if kind == "gen" and number.isdigit() and int(number) <= stay[-1].number:
            for s in _shards_in(spark, f"{path}/{name}"):
                if (int(number), s) not in needed:
                    p, fs = _path(spark, f"{path}/{name}/{SHARD}={s}")
                    fs.delete(p, True)
