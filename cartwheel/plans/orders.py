"""Orders: revenue tables and the order x line x user sale detail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import JOIN_LATE_BOUND
from ..functions.timefns import age_years
from ..operators.joins import full_outer_skew_safe, interval_join

# fixed values: the columns of the order table
ORDER_COLUMNS = ("id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status", "payment_way",
                 "user_id", "img_url", "total_amount", "expire_time", "delivery_address", "create_time", "operate_time",
                 "tracking_no", "parent_order_id", "out_trade_no", "trade_body", "create_date", "create_hour")


def order_revenue_rows(order_info: DataFrame) -> DataFrame:
    """Rows stored in the keyed order table (create_date/create_hour derived)."""
    return order_info.select(*ORDER_COLUMNS)


def _info(o: DataFrame) -> DataFrame:
    return o.select(F.col("id").alias("i_id"), F.col("user_id").alias("i_user_id"),
                    F.col("order_status").alias("i_status"), F.col("create_time").alias("i_create_time"),
                    F.col("create_date").alias("i_dt"), F.col("event_ts").alias("i_ts"))


def _detail(d: DataFrame) -> DataFrame:
    return d.select(F.col("id").alias("d_id"), F.col("order_id").alias("d_order_id"),
                    F.col("sku_id").alias("d_sku_id"), F.col("sku_name").alias("d_sku_name"),
                    F.col("order_price").alias("d_price"), F.col("event_ts").alias("d_ts"))


def merge_sale_detail(joined: DataFrame, strict_price: bool = True) -> DataFrame:
    """Order + line -> sale detail columns (renames; quantity and order total
    are dropped).  Price text -> double: ANSI cast raises on bad text; with
    ``strict_price=False`` bad text gives null."""
    price = F.col("d_price").cast("double") if strict_price else F.col("d_price").try_cast("double")
    return joined.select(
        F.col("d_id").alias("order_detail_id"),
        F.col("i_id").alias("order_id"),
        F.col("i_status").alias("order_status"),
        F.col("i_create_time").alias("create_time"),
        F.col("i_user_id").alias("user_id"),
        F.col("d_sku_id").alias("sku_id"),
        price.alias("sku_price"),
        F.col("d_sku_name").alias("sku_name"),
        F.col("i_dt").alias("dt"),
    )


def order_detail_join(order_info: DataFrame, order_detail: DataFrame, how: str = "inner") -> DataFrame:
    """Equi-join of orders and lines on order id (inner / full_outer / left ...); full outer in the form that takes hot ids."""
    i, d = _info(order_info), _detail(order_detail)
    if how == "full_outer":
        return full_outer_skew_safe(i, d, "i_id", "d_order_id")
    return i.join(d, i["i_id"] == d["d_order_id"], how)


def orders_without_detail(order_info: DataFrame, order_detail: DataFrame) -> DataFrame:
    return order_info.join(order_detail.select(F.col("order_id").alias("id")).distinct(), "id", "left_anti")


def sale_detail_interval(order_info: DataFrame, order_detail: DataFrame,
                         bound: str = JOIN_LATE_BOUND, strict_price: bool = True) -> DataFrame:
    """Late-tolerant join: a line matches its order when their event times are
    at most ``bound`` apart (either order of arrival)."""
    i, d = _info(order_info), _detail(order_detail)
    return merge_sale_detail(interval_join(i, d, "i_id", "d_order_id", "i_ts", "d_ts", bound, bound),
                             strict_price)


def sale_detail_all(order_info: DataFrame, order_detail: DataFrame, strict_price: bool = True) -> DataFrame:
    return merge_sale_detail(order_detail_join(order_info, order_detail, "inner"), strict_price)


def with_sku_name(sale: DataFrame, names: DataFrame) -> DataFrame:
    """Item names (sku_id, sku_name) for rows that are already reduced to those wanted."""
    return sale.drop("sku_name").join(names, "sku_id", "left").select(*sale.columns)


def with_user(sale: DataFrame, users: DataFrame, as_of=None) -> DataFrame:
    """Left lookup of the user dimension; a found user sets user_id, gender,
    level and age (whole 365-day years); a missing user leaves gender/level
    null and age 0 (so does a user without birthday).  No broadcast hint:
    the user table grows with the data; AQE splits a hot user's partition."""
    u = users.select(F.col("id").alias("u_id"), F.col("gender").alias("u_gender"),
                     F.col("user_level").alias("u_level"), F.col("birthday").alias("u_birthday"))
    j = sale.join(u, sale["user_id"] == u["u_id"], "left")
    found = F.col("u_id").isNotNull()
    return j.select(
        "order_detail_id", "order_id", "order_status", "create_time",
        F.when(found, F.col("u_id")).otherwise(F.col("user_id")).alias("user_id"),
        "sku_id",
        F.col("u_gender").alias("user_gender"),
        F.coalesce(F.when(found, age_years("u_birthday", as_of)), F.lit(0)).alias("user_age"),
        F.col("u_level").alias("user_level"),
        F.coalesce(F.col("sku_price"), F.lit(0.0)).alias("sku_price"),
        "sku_name", "dt",
    )


def reenrich_sale_detail(sale_docs: DataFrame, users: DataFrame, as_of=None) -> DataFrame:
    """Batch repair for documents written before their user row arrived: the
    user columns are recomputed from the current user table (a left join on
    user id; documents of still-unknown users keep the defaults)."""
    base = sale_docs.select("order_detail_id", "order_id", "order_status", "create_time", "user_id",
                            "sku_id", "sku_price", "sku_name", "dt")
    return with_user(base, users, as_of)
