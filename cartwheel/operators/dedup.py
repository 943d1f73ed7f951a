"""Keyed dedup, anti-join against seen keys, distinct union.

All survivors are chosen with ``min_by``/``max_by`` over a struct ordering:
a hash/sort aggregate with map-side partial aggregation, so a key holding a
third of all rows is reduced to one row per map task before the shuffle
(a ``row_number`` window would sort the whole hot group in one task).  It
is also accepted on streaming DataFrames, where ``row_number`` is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ordering(order_cols):
    return F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_cols])


def pick_per_key(df: DataFrame, keys, order_cols, keep: str = "first") -> DataFrame:
    """One row per ``keys``: the row with the smallest (``keep='first'``) or
    largest (``keep='last'``) ``order_cols`` tuple.  ``order_cols`` should be
    unique within a key for a deterministic survivor."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = df.columns
    rest = [c for c in cols if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    payload = F.struct(*rest)
    pick = F.min_by(payload, _ordering(order_cols)) if keep == "first" else F.max_by(payload, _ordering(order_cols))
    return df.groupBy(*keys).agg(pick.alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest]).select(*cols)


def first_per_key(df: DataFrame, keys, order_cols) -> DataFrame:
    return pick_per_key(df, keys, order_cols, "first")


def latest_per_key(df: DataFrame, keys, order_cols) -> DataFrame:
    return pick_per_key(df, keys, order_cols, "last")


def anti_join_seen(batch: DataFrame, seen: DataFrame, keys) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``seen``; the seen side is reduced to its keys before the join,
    so a hot one is a single row.  No broadcast hint: the
    seen-key set grows with the data, so the join strategy is left to the
    size check of the planner/AQE (broadcast while small, shuffle beyond)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return batch.join(seen.select(*keys).distinct(), keys, "left_anti")


def distinct_union(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """Set union of the key columns of two frames (partial distinct per side)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return a.select(*keys).unionByName(b.select(*keys)).distinct()
