"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from teampulse.llm import vec
from teampulse.session import scratch_path

#: Input bytes that one shuffle partition should get.
PARTITION_BYTES = 64 << 20


#: Rows and bytes of an Arrow batch for the Python workers, so that a batch of long texts stays small.
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def small_batches(spark: SparkSession) -> None:
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df below ``spark.checkpoint.dir`` and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions_for(df: DataFrame, bytes_per_partition: int = PARTITION_BYTES, floor: int | None = None) -> int:
    """Shuffle partitions for work in proportion to df's source: the session's number (or `floor`), or more for a larger source.

    Uses the size estimate of the optimised plan (file sizes), not a scan.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    session = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    floor = session if floor is None else floor
    # Spark's mark for an unknown size, or a part of it, is far above any table
    return max(floor, session) if size > 1 << 55 else max(floor, math.ceil(size / bytes_per_partition))


def hex64(column: str):
    """A signed 64-bit value as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


def filtered(df: DataFrame, text_col: str, keep) -> DataFrame:
    """The rows of df for which keep(bytes, offsets of the text column) is true, with all their columns."""
    place = df.columns.index(text_col)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(keep(*vec.buffers(batch.column(place))), pa.bool_()))

    return df.mapInArrow(run, df.schema)


#: A key is hot when it holds more than one in so many rows; the rows of a hot key are spread over so many tasks' keys.
HOT_SHARE = 1024
SALTS = 64


def looked_up(rows: DataFrame, facts: DataFrame, keys: list[str], size: str | None = None) -> DataFrame:
    """Inner equi-join of rows with facts, which have one row per key, whatever share of the rows a key has.

    The names of the keys with over 1/``HOT_SHARE`` of the rows, of which there are fewer than ``HOT_SHARE``, are
    broadcast. Their rows get one of ``SALTS`` salts by a hash of the row, their facts one row for each; all others have
    salt 0. ``size``: a column of facts that says how many rows a key has, dropped here; without it rows are counted.
    """
    if size is None:
        sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    else:
        sizes, facts = facts.select(*keys, F.col(size).alias("_rows")), facts.drop(size)
    total = sizes.agg(F.sum("_rows").alias("_all"))
    hot = (sizes.crossJoin(F.broadcast(total)).where(F.col("_rows") * HOT_SHARE > F.col("_all"))
           .select(*keys, F.lit(True).alias("_hot")))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted = rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt).drop("_hot")
    copies = facts.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(salts)).drop("_hot")
    return salted.join(copies, [*keys, "_salt"]).drop("_salt")
