"""User dimension: latest value per user id."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.dedup import latest_per_key

USER_COLUMNS = ("id", "login_name", "user_level", "birthday", "gender")


def user_latest(changes: DataFrame, order_cols=("ts", "seq")) -> DataFrame:
    """Last arrival per id.  ``order_cols`` is the arrival order (e.g. topic
    timestamp, partition, offset), so reordering by an unkeyed producer is
    resolved by the order, not by processing sequence."""
    return latest_per_key(changes, "id", list(order_cols)).select(*USER_COLUMNS)
