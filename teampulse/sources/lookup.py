"""Activity laid out for looking up one engineer.

Each table holds the folded login as a stored column, lies in folders by a hash bucket of that login, and is sorted by
login, repo and time within files that carry a Bloom filter on the login. A look-up therefore lists one folder of
``buckets``, its equality on the login reaches the scan, and row groups of other people are skipped. A very active
engineer's rows are range-spread, so they are written and read by several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from teampulse.functions import login_key

BUCKET = "login_bucket"
BLOOM = "parquet.bloom.filter.enabled#engineer_login"
#: Table -> (login column, time column, further columns).
TABLES = {
    "commits": ("author_login", "committed_at", ()),
    "pull_requests": ("author_login", "merged_at", ()),
    "reviews": ("reviewer_login", "submitted_at", ("state",)),
}


def _bucket(login: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(login), F.lit(buckets)).cast("int")


def write(raw: dict[str, DataFrame], path: str, buckets: int = 64) -> None:
    """Lay out the tables' rows that have a login and a time; replaces what is at ``path``."""
    for name, (login, ts, more) in TABLES.items():
        rows = raw[name].where(F.col(login).isNotNull() & F.col(ts).isNotNull()).select(
            login_key(login).alias("engineer_login"), "repo", F.col(ts).alias("ts"), *more)
        rows = rows.withColumn(BUCKET, _bucket(F.col("engineer_login"), buckets))
        order = [BUCKET, "engineer_login", "repo", "ts"]
        (rows.repartitionByRange(*order).sortWithinPartitions(*order)
             .write.mode("overwrite").option(BLOOM, "true").partitionBy(BUCKET).parquet(f"{path}/{name}"))


def read(spark: SparkSession, path: str, login: str, buckets: int = 64) -> dict[str, DataFrame]:
    """The rows of one engineer, in the columns of the raw tables; ``buckets`` is that of ``write``."""
    who = F.lower(F.lit(login))
    out = {}
    for name, (login_col, ts, more) in TABLES.items():
        schema = f"engineer_login string, repo string, ts timestamp_ntz, {''.join(f'{c} string, ' for c in more)}{BUCKET} int"
        rows = spark.read.schema(schema).parquet(f"{path}/{name}")
        rows = rows.where((F.col(BUCKET) == _bucket(who, buckets)) & (F.col("engineer_login") == who))
        out[name] = rows.select(F.col("engineer_login").alias(login_col), "repo", F.col("ts").alias(ts), *more)
    return out
