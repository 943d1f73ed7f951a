"""Report functions over the DAU and order tables (totals, hourly series,
today vs yesterday on the 24-hour axis, JSON edge)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import TOTAL_METRICS
from ..functions.timefns import with_log_date_hour
from .dau import devices_on


def previous_day_text(date: str) -> str:
    return (_dt.date.fromisoformat(date) - _dt.timedelta(days=1)).isoformat()


def dau_total(dau: DataFrame, date: str) -> DataFrame:
    """count(*) for a day; a day without rows gives 0."""
    return dau.where(F.col("log_date") == date).agg(F.count(F.lit(1)).alias("dau"))


def dau_by_hour(dau: DataFrame, date: str) -> DataFrame:
    return (dau.where(F.col("log_date") == date).groupBy("log_hour")
               .agg(F.count(F.lit(1)).alias("ct")))


def gmv_total(orders: DataFrame, date: str) -> DataFrame:
    """sum(total_amount) for a day; a day without rows gives NULL."""
    return orders.where(F.col("create_date") == date).agg(
        F.sum("total_amount").cast("double").alias("sum_amount"))


def gmv_by_hour(orders: DataFrame, date: str) -> DataFrame:
    return (orders.where(F.col("create_date") == date).groupBy("create_hour")
                  .agg(F.sum("total_amount").cast("double").alias("sum_amount")))


def gmv_by_day(orders: DataFrame) -> DataFrame:
    return orders.groupBy("create_date").agg(F.sum("total_amount").cast("double").alias("sum_amount"),
                                             F.count(F.lit(1)).alias("n_orders"))


def sums_by_zone_day(rows: DataFrame, ms: str, amount: str, zone: str) -> DataFrame:
    """(log_date, log_hour, sum_amount, n) of the days and hours of ``zone``; limit the days before (``timefns.within_days``)."""
    return (with_log_date_hour(rows, ms, zone).groupBy("log_date", "log_hour")
            .agg(F.sum(amount).cast("double").alias("sum_amount"), F.count(F.lit(1)).alias("n")))


def hour_axis(spark: SparkSession) -> DataFrame:
    """'00'..'23' (24 rows, fixed size)."""
    return spark.range(24).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hour"))


def _compare(spark: SparkSession, df: DataFrame, date_col: str, hour_col: str, date: str,
             value) -> DataFrame:
    """One scan over today + yesterday, split by conditional aggregates, then
    aligned on the 24-hour axis with zero fill.  Hours off the axis (free text in the source) are left out
    first, so the hourly aggregate has at most 24 rows and broadcasting it is size-bounded."""
    y = previous_day_text(date)
    hourly = (df.where(F.col(date_col).isin(date, y) & F.col(hour_col).rlike("^([01][0-9]|2[0-3])$"))
                .groupBy(F.col(hour_col).alias("hour"))
                .agg(F.sum(F.when(F.col(date_col) == date, value)).alias("today"),
                     F.sum(F.when(F.col(date_col) == y, value)).alias("yesterday")))
    return hour_axis(spark).join(F.broadcast(hourly), "hour", "left")


def dau_hours_compare(dau: DataFrame, date: str) -> DataFrame:
    j = _compare(dau.sparkSession, dau, "log_date", "log_hour", date, F.lit(1))
    return j.select("hour", F.coalesce("today", F.lit(0)).cast("long").alias("today"),
                    F.coalesce("yesterday", F.lit(0)).cast("long").alias("yesterday"))


def gmv_hours_compare(orders: DataFrame, date: str) -> DataFrame:
    j = _compare(orders.sparkSession, orders, "create_date", "create_hour", date, F.col("total_amount"))
    return j.select("hour", F.round(F.coalesce("today", F.lit(0.0)), 2).alias("today"),
                    F.round(F.coalesce("yesterday", F.lit(0.0)), 2).alias("yesterday"))


def realtime_total(dau: DataFrame, orders: DataFrame, date: str) -> DataFrame:
    """Three rows (id, name, value): DAU count, devices first seen that day,
    order amount (NULL when the day has no orders)."""
    (dau_id, dau_name), (new_id, new_name), (gmv_id, gmv_name) = TOTAL_METRICS
    metric = lambda i, n, v: F.struct(F.lit(i).alias("id"), F.lit(n).alias("name"), F.col(v).cast("double").alias("value"))
    d = devices_on(dau, date).select(F.inline(F.array(metric(dau_id, dau_name, "dau"), metric(new_id, new_name, "new_mid"))))
    g = gmv_total(orders, date).select(F.lit(gmv_id).alias("id"), F.lit(gmv_name).alias("name"),
                                       F.round("sum_amount", 2).alias("value"))
    return d.unionByName(g)


def realtime_total_json(dau: DataFrame, orders: DataFrame, date: str) -> DataFrame:
    """One row: the three totals as a JSON list of {id, name, value}; devices are whole numbers, the amount has two
    decimals and is left out on a day without orders."""
    amount_id = TOTAL_METRICS[2][0]
    as_json = lambda kind: F.to_json(F.struct("id", "name", F.col("value").cast(kind).alias("value")))
    place = F.array_position(F.array(*[F.lit(i) for i, _ in TOTAL_METRICS]), F.col("id"))
    rows = realtime_total(dau, orders, date).select(
        place.alias("place"), F.when(F.col("id") == amount_id, as_json("decimal(20,2)")).otherwise(as_json("long")).alias("text"))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda r: r["text"])
    return rows.agg(F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")).alias("json"))


def realtime_hours(metric_id: str, dau: DataFrame, orders: DataFrame, date: str) -> DataFrame:
    """Tidy (series, hour, value) for today and yesterday; ``order_amount``
    selects revenue, anything else DAU.  Hours without rows are absent (the
    caller zero-fills, see ``*_hours_compare``)."""
    y = previous_day_text(date)
    if metric_id == "order_amount":
        src, dcol, hcol, val = orders, "create_date", "create_hour", F.sum("total_amount").cast("double")
    else:
        src, dcol, hcol, val = dau, "log_date", "log_hour", F.count(F.lit(1)).cast("double")
    return (src.where(F.col(dcol).isin(date, y))
               .groupBy(F.when(F.col(dcol) == date, F.lit("today")).otherwise(F.lit("yesterday")).alias("series"),
                        F.col(hcol).alias("hour"))
               .agg(val.alias("value")))


def realtime_hours_json(metric_id: str, dau: DataFrame, orders: DataFrame, date: str) -> DataFrame:
    """One row: ``{"yesterday": {HH: v}, "today": {HH: v}}`` (hours sorted;
    an empty series is ``{}``).  At most 2 x 24 rows reach the final collect."""
    tidy = realtime_hours(metric_id, dau, orders, date)
    per = (tidy.groupBy("series")
               .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("hour", "value")))).alias("m")))
    empty = F.create_map().cast("map<string,double>")
    out = per.agg(
        F.coalesce(F.first(F.when(F.col("series") == "yesterday", F.col("m")), True), empty).alias("yesterday"),
        F.coalesce(F.first(F.when(F.col("series") == "today", F.col("m")), True), empty).alias("today"))
    return out.select(F.to_json(F.struct("yesterday", "today")).alias("json"))
