"""The report queries as Spark SQL with named parameters.

``register_tables`` exposes the keyed tables as temp views; the report
statements are plain SQL with ``:date`` markers (bound by ``spark.sql(...,
args=...)``, never by string formatting).  Catalyst plans them exactly like
the DataFrame versions in :mod:`cartwheel.plans.reports` (same pruning and
partial aggregation).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

DAU_VIEW = "dau"
ORDER_VIEW = "order_info"

SQL = {
    "dau_total": f"SELECT count(*) AS dau FROM {DAU_VIEW} WHERE log_date = :date",
    "dau_by_hour": f"SELECT log_hour, count(*) AS ct FROM {DAU_VIEW} WHERE log_date = :date GROUP BY log_hour",
    "gmv_total": f"SELECT CAST(sum(total_amount) AS DOUBLE) AS sum_amount FROM {ORDER_VIEW} "
                 f"WHERE create_date = :date",
    "gmv_by_hour": f"SELECT create_hour, CAST(sum(total_amount) AS DOUBLE) AS sum_amount FROM {ORDER_VIEW} "
                   f"WHERE create_date = :date GROUP BY create_hour",
    "hours_compare_dau": f"""
        SELECT h.hour, coalesce(g.today, 0) AS today, coalesce(g.yesterday, 0) AS yesterday
        FROM (SELECT lpad(CAST(id AS STRING), 2, '0') AS hour FROM range(24)) h
        LEFT JOIN (SELECT log_hour,
                          count_if(log_date = :date) AS today,
                          count_if(log_date = :yesterday) AS yesterday
                   FROM {DAU_VIEW} WHERE log_date IN (:date, :yesterday) GROUP BY log_hour) g
          ON h.hour = g.log_hour""",
}


def register_tables(spark: SparkSession, dau: DataFrame | None = None, orders: DataFrame | None = None) -> None:
    if dau is not None:
        dau.createOrReplaceTempView(DAU_VIEW)
    if orders is not None:
        orders.createOrReplaceTempView(ORDER_VIEW)


def run(spark: SparkSession, name: str, date: str) -> DataFrame:
    y = (_dt.date.fromisoformat(date) - _dt.timedelta(days=1)).isoformat()
    args = {"date": date}
    if ":yesterday" in SQL[name]:
        args["yesterday"] = y
    return spark.sql(SQL[name], args=args)
