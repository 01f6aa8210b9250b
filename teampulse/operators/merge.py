"""Keyed upsert (insert ... on conflict do update) as a DataFrame merge.

Statement-by-statement semantics of a batch sent in order:

* a key new to the table is inserted by its first row; later rows of the
  same batch only overwrite the *update* columns, so insert-only columns keep
  the first row's value and update columns take the last row's value;
* a key already stored keeps its stored insert-only columns and takes the
  batch's last value for every update column, NULL included (plain
  overwrite, never ``coalesce(new, old)``);
* the load stamp column is set to the load time on every touched row.

The batch is ordered by its sequence columns; rows that agree in them are
ordered by a hash of the row, so a repeated row counts once and the outcome
never depends on how Spark deals the rows out. A NULL in a key column fails
the job: such a row can't be merged and must not vanish.

Plan: one aggregation of the batch by key, which takes the first and the last
row of each key in one reading, and one full outer join with the stored table.
Keys are unique on both sides, so the join is 1:1 and cannot fan out. With
``scope`` set, only the stored rows of the scopes that the batch touches are
read and returned; ``sources.store`` keeps the stored side in buckets of the
key, so it is not exchanged at all.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from teampulse.functions.columns import ts_lit

FIRST, LAST = "_first", "_last"


def _columns(cols: Sequence[str], keys: Sequence[str], update_cols: Sequence[str], stamp_col: str | None):
    """(insert-only columns, the stamp column or nothing) of a table."""
    stamp = [stamp_col] if stamp_col and stamp_col in cols else []
    return [c for c in cols if c not in keys and c not in update_cols and c not in stamp], stamp


def condensed(incoming: DataFrame, cols: Sequence[str], keys: Sequence[str], update_cols: Sequence[str], *,
              seq_col: str | Sequence[str] = "_seq", stamp_col: str | None = "extracted_at",
              partitions: int | None = None) -> DataFrame:
    """One row per key of the batch: the key, ``_first`` (insert-only columns of its first row) and ``_last`` (update
    columns and stamp of its last row), each a struct, or without any columns absent. ``partitions``: the checked rows
    are dealt by key over so many tasks, and the aggregation needs no further exchange."""
    seqs = [seq_col] if isinstance(seq_col, str) else list(seq_col)
    if not seqs or not set(seqs) <= set(incoming.columns):
        raise ValueError(f"incoming batch needs its ordering columns {seqs!r}")
    keys, update_cols = list(keys), list(update_cols)
    insert_cols, stamp = _columns(cols, keys, update_cols, stamp_col)
    order = F.struct(*seqs, F.xxhash64(*[c for c in cols if c in incoming.columns]))
    present: dict[str, Column] = {
        k: F.coalesce(F.col(k), F.raise_error(F.lit(f"NULL in key column {k}")).cast(incoming.schema[k].dataType))
        for k in keys}
    out = []
    if insert_cols:
        out.append(F.min_by(F.struct(*insert_cols), order).alias(FIRST))
    if update_cols + stamp:
        out.append(F.max_by(F.struct(*update_cols, *stamp), order).alias(LAST))
    checked = incoming.withColumns(present)
    if partitions:
        checked = checked.repartition(partitions, *keys)
    return checked.groupBy(*keys).agg(*(out or [F.count(F.lit(1)).alias("_rows")]))


def merged(stored: DataFrame, batch: DataFrame, keys: Sequence[str], update_cols: Sequence[str], *,
           stamp_col: str | None = "extracted_at", loaded_at: dt.datetime | None = None) -> DataFrame:
    """``stored`` after a ``condensed`` batch: one full outer join on the key."""
    keys, cols = list(keys), stored.columns
    insert_cols, stamp = _columns(cols, keys, update_cols, stamp_col)
    old = stored.select(*keys, *[F.col(c).alias("_e_" + c) for c in cols if c not in keys], F.lit(True).alias("_in_table"))
    j = old.join(batch.withColumn("_in_batch", F.lit(True)), keys, "full_outer")
    in_table = F.coalesce(F.col("_in_table"), F.lit(False))
    in_batch = F.coalesce(F.col("_in_batch"), F.lit(False))
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c in insert_cols:
            out.append(F.when(in_table, F.col("_e_" + c)).otherwise(F.col(FIRST)[c]).alias(c))
        else:
            now = ts_lit(loaded_at) if c in stamp and loaded_at is not None else F.col(LAST)[c]
            out.append(F.when(in_batch, now).otherwise(F.col("_e_" + c)).alias(c))
    return j.select(*out)


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str], *, seq_col: str | Sequence[str] = "_seq",
           stamp_col: str | None = "extracted_at", loaded_at: dt.datetime | None = None,
           scope: Sequence[str] = ()) -> DataFrame:
    keys, update_cols = list(keys), list(update_cols)
    cols = existing.columns
    missing = [c for c in keys + update_cols if c not in cols]
    if missing:
        raise ValueError(f"unknown columns {missing}")
    if not set(scope) <= set(keys):
        raise ValueError("scope columns must be part of the key")
    batch = condensed(incoming, cols, keys, update_cols, seq_col=seq_col, stamp_col=stamp_col)
    stored = existing
    if scope:
        stored = stored.join(batch.select(*scope).distinct(), list(scope), "left_semi")
    return merged(stored, batch, keys, update_cols, stamp_col=stamp_col, loaded_at=loaded_at)


def submitted_count(incoming: DataFrame) -> DataFrame:
    """Rows submitted in a batch (what a load reports, not rows changed)."""
    return incoming.agg(F.count(F.lit(1)).alias("submitted"))
