"""Ranking operators that stay distributed under skew.

``rank_desc``   RANK() OVER (PARTITION BY p ORDER BY score DESC) without
                sending a whole partition group to one task: rank is
                1 + (rows with a strictly higher score in the group), computed
                from a per-(group, score) histogram and joined back.
``rank_top_k``  the first k rows of a global order plus their RANK(); ranks of
                the first k rows only depend on rows inside the first k.
``positions``   ROW_NUMBER() and RANK() of every row of every group, however
                large a group or a run of equal scores is: rows are range
                partitioned, numbered inside their range, and prefix sums over
                the ranges turn these numbers into those of the group.
``top_n_per_group``  row_number() <= n per group; Spark plans a partial
                group limit before the shuffle, so each input partition
                forwards at most n rows of a hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from teampulse.session import scratch_path

GROUP_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"


def rank_desc(df: DataFrame, by: Sequence[str], score: str, name: str = "rank",
              spread: Sequence[str] = ()) -> DataFrame:
    """A plan only: nothing runs here. ``spread``: columns that are near-unique
    in ``df``. The rows are dealt out by them once, and the histogram and the
    join-back both read that exchange, so ``df`` is not computed twice."""
    by = list(by)
    if spread:
        df = df.repartition(*spread)
    hist = df.groupBy(*by, score).agg(F.count(F.lit(1)).alias("_n"))
    w = ((Window.partitionBy(*by) if by else Window).orderBy(F.col(score).desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))  # without groups: over the distinct scores only
    ranks = hist.select(*by, score, (F.sum("_n").over(w) - F.col("_n") + 1).cast("long").alias(name))
    return df.join(ranks, by + [score], "inner")


def rank_top_k(df: DataFrame, score: str, tie_break: Sequence[str], k: int,
               rank_name: str = "rank", position_name: str | None = None) -> DataFrame:
    """Top k by ``score`` desc (then ``tie_break`` asc) with RANK() and
    optionally the 1-based position. Planned as TakeOrderedAndProject (per
    partition top-k, then a k-row merge); the window runs over k rows."""
    order = [F.col(score).desc()] + [F.col(c).asc() for c in tie_break]
    top = df.orderBy(*order).limit(k)
    w = Window.orderBy(F.col(score).desc())
    out = top.withColumn(rank_name, F.rank().over(w).cast("long"))
    if position_name:
        out = out.withColumn(position_name, F.row_number().over(Window.orderBy(*order)))
    return out


def top_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int,
                    position_name: str = "pos") -> DataFrame:
    """Spark limits groups before the shuffle up to the session's group-limit
    threshold; it is raised to ``n`` here, so no ``n`` sends whole groups."""
    if n < 1:
        raise ValueError("n must be positive")
    conf = df.sparkSession.conf
    if int(conf.get(GROUP_LIMIT_CONF, "1000")) < n:
        conf.set(GROUP_LIMIT_CONF, str(n))
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(position_name, F.row_number().over(w)).where(F.col(position_name) <= n)


_PART, _ROW, _RUN = "_range_part", "_range_row", "_range_run"


def positions(df: DataFrame, by: Sequence[str], score: str, ties: Sequence[Column] = (), *,
              row_number: str | None = None, rank: str | None = None) -> DataFrame:
    """``df`` with ROW_NUMBER() OVER (PARTITION BY ``by`` ORDER BY ``score`` DESC, ``ties``) and RANK() OVER
    (PARTITION BY ``by`` ORDER BY ``score`` DESC), each under the given name or left out; both are long.

    A NULL score sorts last, NULL group values form a group, and rows that agree in ``by``, ``score`` and ``ties``
    are numbered in some order. Ranges of one group and one score may span many tasks when ``ties`` tell their rows
    apart: no task holds a group or a run of equal scores whole.

    Runs one job at once: the ranges are chosen from a sample, so the numbered rows are written below
    ``spark.checkpoint.dir`` before they are counted. The facts joined back are one row for each range and group, on
    (range, group), never on the score.
    """
    by = list(by)
    reserved = {_PART, _ROW, _RUN} & set(df.columns)
    if reserved or not (row_number or rank):
        raise ValueError(f"reserved columns {sorted(reserved)}" if reserved else "name a row number or a rank")
    order = [F.col(score).desc(), *ties]
    ranges = df.repartitionByRange(*[F.col(c) for c in by], *order).withColumn(_PART, F.spark_partition_id())
    inside = Window.partitionBy(_PART, *by)
    path = scratch_path(df.sparkSession, "positions")
    numbered = ranges.select("*", F.row_number().over(inside.orderBy(*order)).cast("long").alias(_ROW),
                             F.rank().over(inside.orderBy(F.col(score).desc())).cast("long").alias(_RUN))
    numbered.write.parquet(path)
    placed = df.sparkSession.read.schema(numbered.schema).parquet(path)

    # one row per range and group: its rows, its first and last score, the place of its last run of equal scores
    facts = placed.groupBy(_PART, *by).agg(
        F.max(_ROW).alias("_n"), F.max(_RUN).alias("_last_run"),
        F.min_by(score, _ROW).alias("_first"), F.max_by(score, _ROW).alias("_last"))
    across = Window.partitionBy(*by).orderBy(_PART) if by else Window.orderBy(_PART)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    facts = facts.select("*", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
                         (F.lag("_n").over(across).isNotNull() & F.col("_first").eqNullSafe(F.lag("_last").over(across)))
                         .alias("_goes_on"))
    # the rank of the last run, where it begins in this range; a run that goes on takes the nearest one before
    begins = F.when(~(F.col("_goes_on") & (F.col("_last_run") == 1)), F.col("_before") + F.col("_last_run"))
    facts = (facts.withColumn("_begins", begins)
             .withColumn("_carried", F.last("_begins", ignorenulls=True).over(earlier)))
    facts = facts.select(F.col(_PART).alias("_p"), *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)],
                         "_before", "_goes_on", "_carried")
    same = F.col(_PART) == F.col("_p")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    out = [F.col(c) for c in df.columns]
    if row_number:
        out.append((F.col("_before") + F.col(_ROW)).alias(row_number))
    if rank:
        out.append(F.when(F.col("_goes_on") & (F.col(_RUN) == 1), F.col("_carried"))
                   .otherwise(F.col("_before") + F.col(_RUN)).alias(rank))
    return placed.join(facts, same).select(*out)
