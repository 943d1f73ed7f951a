"""Daily active devices: first start-up per (day, device), cross-batch dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import anti_join_seen, distinct_union, first_per_key

DAU_KEYS = ("log_date", "mid")
# ts first; the remaining columns only break exact ties deterministically.
DAU_ORDER = ("ts", "uid", "type")


def daily_active(startup: DataFrame) -> DataFrame:
    """One row per (log_date, mid): the earliest start-up of the day."""
    return first_per_key(startup, list(DAU_KEYS), list(DAU_ORDER))


def daily_active_new(batch: DataFrame, seen: DataFrame) -> DataFrame:
    """The earliest row per (day, device) of devices not yet recorded for that (event) day.  All rows of a key
    stay or go together, so both sides are reduced to a row per key before the join."""
    return anti_join_seen(daily_active(batch), seen, list(DAU_KEYS))


def seen_union(seen: DataFrame, new_rows: DataFrame) -> DataFrame:
    return distinct_union(seen, new_rows, list(DAU_KEYS))


def first_day_per_device(dau: DataFrame) -> DataFrame:
    return dau.groupBy("mid").agg(F.min("log_date").alias("first_date"))


def new_devices_by_day(dau: DataFrame) -> DataFrame:
    """Devices whose first recorded day is that day, per day."""
    return (first_day_per_device(dau).groupBy(F.col("first_date").alias("log_date"))
            .agg(F.count(F.lit(1)).alias("new_mid")))


def devices_on(dau: DataFrame, date: str) -> DataFrame:
    """One row (dau, new_mid): devices of ``date`` and those of them without an earlier day, from one scan of the history
    up to ``date`` (one row per device-day or raw start-ups; a device counts once)."""
    per_mid = (dau.where(F.col("log_date") <= date).groupBy("mid")
                  .agg(F.min("log_date").alias("first_date"), F.max("log_date").alias("last_date")))
    return per_mid.agg(F.count(F.when(F.col("last_date") == date, 1)).alias("dau"),
                       F.count(F.when(F.col("first_date") == date, 1)).alias("new_mid"))


def stage_counts(startup: DataFrame, split_hour: str = "12") -> DataFrame:
    """Rows entering each dedup stage, as (stage, n): raw rows, rows after
    in-batch dedup, rows after the cross-batch filter (state = each day's
    hours before ``split_hour``, batch = the rest).  One scan; the three
    counts are aggregates over the same grouped keys."""
    per_key = (startup.groupBy(*DAU_KEYS)
               .agg(F.count(F.lit(1)).alias("n"),
                    F.max(F.col("log_hour") < split_hour).alias("has_early"),
                    F.max(F.col("log_hour") >= split_hour).alias("has_late")))
    totals = per_key.agg(
        F.sum("n").cast("long").alias("input"),
        F.count(F.lit(1)).alias("after_batch_dedup"),
        F.count(F.when(F.col("has_late") & ~F.col("has_early"), 1)).alias("after_state_filter"),
    )
    return totals.select(F.explode(F.array(
        F.struct(F.lit("input").alias("stage"), F.col("input").alias("n")),
        F.struct(F.lit("after_batch_dedup").alias("stage"), F.col("after_batch_dedup").alias("n")),
        F.struct(F.lit("after_state_filter").alias("stage"), F.col("after_state_filter").alias("n")),
    )).alias("s")).select("s.stage", "s.n")
