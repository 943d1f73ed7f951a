"""Row types of the streams and outputs (field lists + typed casts)."""

from __future__ import annotations

from pyspark.sql import types as T

STARTUP_FIELDS = ("mid", "uid", "appid", "area", "os", "ch", "type", "vs", "ts")
STARTUP_CASTS = {"ts": "bigint"}

ORDER_FIELDS = ("id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status",
                "payment_way", "user_id", "img_url", "total_amount", "expire_time",
                "delivery_address", "create_time", "operate_time", "tracking_no",
                "parent_order_id", "out_trade_no", "trade_body")
ORDER_CASTS = {"total_amount": "double"}

ORDER_DETAIL_FIELDS = ("id", "order_id", "sku_name", "sku_id", "order_price", "img_url", "sku_num")
ORDER_DETAIL_CASTS: dict = {}  # price/quantity stay text on the wire; cast at merge

USER_FIELDS = ("id", "login_name", "user_level", "birthday", "gender")

NAME_VALUE = T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.StringType())])

CDC_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("entry_type", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("rows", T.ArrayType(T.StructType([
        T.StructField("after", T.ArrayType(NAME_VALUE)),
    ]))),
])
