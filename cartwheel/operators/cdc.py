"""Change-feed routing: keep row-data entries, route by (table, event type),
flatten the row list and emit each after-image as a JSON object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DEFAULT_TOPICS, ENTRY_ROWDATA, ROUTES
from ..functions.jsonfns import after_image_json


def route_expr(routes=ROUTES, topics=None, table: str = "table", event: str = "event_type") -> Column:
    """Topic for a (table, event type) pair, null when the pair is not routed.
    Routes are data: a tuple of (table, event types, logical stream)."""
    topics = {**DEFAULT_TOPICS, **(topics or {})}
    expr = None
    for tbl, events, stream in routes:
        cond = (F.col(table) == F.lit(tbl)) & F.col(event).isin(*events)
        expr = F.when(cond, F.lit(topics[stream])) if expr is None else expr.when(cond, F.lit(topics[stream]))
    return expr if expr is not None else F.lit(None).cast("string")


def route_changes(cdc: DataFrame, routes=ROUTES, topics=None, table_pattern: str | None = None) -> DataFrame:
    """(topic, value) messages.  ``table_pattern`` is an optional regex on the
    (schema-qualified) table name, like a subscription filter.  Order updates
    and all deletes are dropped by the default routes."""
    df = cdc.where(F.col("entry_type") == F.lit(ENTRY_ROWDATA))
    if table_pattern:
        df = df.where(F.col("table").rlike(table_pattern))
    routed = df.select(route_expr(routes, topics).alias("topic"), "table", "event_type", "rows")
    return (routed.where(F.col("topic").isNotNull())
                  .select("topic", "table", "event_type", F.explode("rows").alias("_row"))
                  .select("topic", "table", "event_type", after_image_json(F.col("_row.after")).alias("value")))


def to_topic_files(messages: DataFrame, path: str) -> None:
    """File form of a topic sink: one JSON-lines folder per topic."""
    messages.select("topic", "value").write.mode("append").partitionBy("topic").json(path)
