"""Union-all pivot: several per-key sources merged with one shuffle.

A chain of FULL OUTER JOINs on coalesced keys re-partitions at every join.
When every side contributes rows keyed by the same columns, stacking the
sides (``unionByName`` with a side tag, missing columns NULL) and running one
``groupBy(keys)`` with conditional aggregates yields the same rows - one per
key present on any side - with a single shuffle and map-side combining.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDE = "_side"


def stack_sides(sides: Mapping[str, DataFrame], keys: Sequence[str],
                columns: Mapping[str, str]) -> DataFrame:
    """``sides``: tag -> frame holding ``keys`` and any of ``columns``
    (name -> type); absent columns are filled with typed NULLs."""
    parts = []
    for tag, df in sides.items():
        present = set(df.columns)
        parts.append(df.select(
            *keys, F.lit(tag).alias(SIDE),
            *[(F.col(c) if c in present else F.lit(None)).cast(t).alias(c) for c, t in columns.items()]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def on_side(tag: str, value: Column | None = None) -> Column:
    """``value`` on rows of side ``tag``, NULL elsewhere (for count/avg/sum)."""
    return F.when(F.col(SIDE) == tag, F.lit(1) if value is None else value)
