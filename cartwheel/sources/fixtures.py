"""Stream-shaped views over the driver tables.

Every function maps a DataFrame to a DataFrame with plain column
expressions, so the same mapping serves a batch read and a ``readStream``
of the same files.  Ids travel as text, as on the wire.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import EVID_CLICK, EVID_COUPON, MS_PER_DAY
from ..functions.timefns import age_years, epoch_ms, with_create_date_hour, with_log_date_hour, within_days
from .tables import read_table

AS_OF = "2024-02-01 00:00:00"  # fixed "now" of the fixtures, for deterministic ages


def startup_from_events(events: DataFrame) -> DataFrame:
    """Device start-up log: mid = uid = user_id, type = event_type, ts = epoch ms."""
    return events.select(
        F.col("user_id").cast("string").alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.lit("app").alias("appid"),
        F.lit("area").alias("area"),
        F.lit("android").alias("os"),
        F.lit("web").alias("ch"),
        F.col("event_type").alias("type"),
        F.lit("1.0").alias("vs"),
        epoch_ms("ts").alias("ts"),
    )


def event_log_from_events(events: DataFrame) -> DataFrame:
    """Behaviour log: device = user_id % 10, click -> clickItem, purchase -> coupon,
    item id from the ``k`` property."""
    et = F.col("event_type")
    evid = (F.when(et == "click", F.lit(EVID_CLICK))
             .when(et == "purchase", F.lit(EVID_COUPON))
             .otherwise(et))
    return events.select(
        (F.col("user_id") % 10).cast("string").alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.lit("app").alias("appid"),
        F.lit("area").alias("area"),
        F.lit("android").alias("os"),
        F.lit("event").alias("type"),
        evid.alias("evid"),
        F.lit(None).cast("string").alias("pgid"),
        F.lit(None).cast("string").alias("npgid"),
        F.get_json_object("props", "$.k").alias("itemid"),
        epoch_ms("ts").alias("ts"),
    )


def create_time_text(orderdate: str = "o_orderdate", orderkey: str = "o_orderkey"):
    return F.concat(F.date_format(F.col(orderdate), "yyyy-MM-dd"), F.lit(" "),
                    F.lpad((F.col(orderkey) % 24).cast("string"), 2, "0"), F.lit(":00:00"))


def _wire_order_fields():
    """The order fields that reports do not read, derived from key, customer and priority."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    nothing = F.lit(None).cast("string")
    return [
        F.concat(F.lit("consignee-"), c.cast("string")).alias("consignee"),
        F.col("o_orderpriority").alias("order_comment"),
        F.concat(F.lit("138"), F.lpad((c % 100000000).cast("string"), 8, "0")).alias("consignee_tel"),
        (k % 3 + 1).cast("string").alias("payment_way"),
        nothing.alias("img_url"),
        F.concat(F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 1), "yyyy-MM-dd"),
                 F.lit(" 00:00:00")).alias("expire_time"),
        F.concat(F.lit("address-"), c.cast("string")).alias("delivery_address"),
        F.when(F.col("o_orderstatus") != "O", create_time_text()).alias("operate_time"),
        nothing.alias("tracking_no"),
        F.when(k % 10 == 0, (k + 1).cast("string")).alias("parent_order_id"),
        F.lpad(k.cast("string"), 18, "0").alias("out_trade_no"),
        F.concat(F.lit("trade-"), k.cast("string")).alias("trade_body"),
    ]


def order_info_from_orders(orders: DataFrame, customer: DataFrame | None = None) -> DataFrame:
    """Order rows; with ``customer`` all 20 columns of the wire type (``province_id`` costs one join), else
    those that the reports and joins read."""
    o = orders.select(
        *(_wire_order_fields() if customer is not None else []),
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_amount"),
        create_time_text().alias("create_time"),
        F.col("o_orderdate").cast("timestamp").alias("event_ts"),
        F.col("o_custkey").alias("_custkey"),
    )
    if customer is not None:
        c = customer.select(F.col("c_custkey").alias("_custkey"),
                            F.col("c_nationkey").cast("string").alias("province_id"))
        o = o.join(c, "_custkey", "left")
    return with_create_date_hour(o.drop("_custkey"))


def order_detail_from_lineitem(lineitem: DataFrame, part: DataFrame | None = None) -> DataFrame:
    """Order lines: id = orderkey-linenumber (not unique), price and quantity as text."""
    li = lineitem.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").alias("_partkey"),
        F.col("l_partkey").cast("string").alias("sku_id"),
        F.col("l_extendedprice").cast("string").alias("order_price"),
        F.col("l_quantity").cast("string").alias("sku_num"),
        F.col("l_suppkey").alias("suppkey"),
        F.col("l_shipdate").cast("timestamp").alias("event_ts"),
    )
    if part is not None:
        p = part.select(F.col("p_partkey").alias("_partkey"), F.col("p_name").alias("sku_name"))
        li = li.join(p, "_partkey", "left")
    else:
        li = li.withColumn("sku_name", F.lit(None).cast("string"))
    return li.drop("_partkey")


def _birthday(k):
    return F.date_format(F.date_add(F.lit("1960-01-01").cast("date"), ((k * 37) % 18000).cast("int")),
                         "yyyy-MM-dd")


def _gender(k):
    return F.when(k % 2 == 0, F.lit("M")).otherwise(F.lit("F"))


def user_info_from_customer(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.cast("string").alias("id"),
        F.col("c_name").alias("login_name"),
        F.col("c_mktsegment").alias("user_level"),
        _birthday(k).alias("birthday"),
        _gender(k).alias("gender"),
    )


def user_changes_from_customer(customer: DataFrame) -> DataFrame:
    """User change stream: every customer inserted once; customers whose key
    the change feed marks as UPDATE (key % 3 = 1) arrive again a day later with
    a new level.  ``ts``/``seq`` give arrival order."""
    base = user_info_from_customer(customer).withColumn("_k", F.col("id").cast("long"))
    t0 = F.lit(1704067200000)  # 2024-01-01T00:00:00Z
    ins = base.select("id", "login_name", "user_level", "birthday", "gender",
                      (t0 + F.col("_k")).alias("ts"), F.col("_k").alias("seq"))
    upd = base.where(F.col("_k") % 3 == 1).select(
        "id", "login_name", F.concat(F.col("user_level"), F.lit("-PLUS")).alias("user_level"),
        "birthday", "gender", (t0 + F.lit(MS_PER_DAY) + F.col("_k")).alias("ts"),
        (F.lit(10 ** 12) + F.col("_k")).alias("seq"))
    return ins.unionByName(upd)


def student_from_customer(customer: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Search documents: sex, favo (text), class_id, age (365-day years as of ``as_of``)."""
    k = F.col("c_custkey")
    return customer.select(
        k.cast("string").alias("doc_id"),
        _gender(k).alias("sex"),
        F.col("c_mktsegment").alias("favo"),
        F.col("c_nationkey").cast("string").alias("class_id"),
        age_years(_birthday(k), as_of).alias("age"),
    )


def _kv(*pairs):
    return F.array(*[F.struct(F.lit(n).alias("name"), v.cast("string").alias("value")) for n, v in pairs])


def _envelope(df: DataFrame, table: str, key, after) -> DataFrame:
    et = (F.when(key % 3 == 0, F.lit("INSERT"))
           .when(key % 3 == 1, F.lit("UPDATE"))
           .otherwise(F.lit("DELETE")))
    entry = F.when(key % 11 == 0, F.lit("TRANSACTIONBEGIN")).otherwise(F.lit("ROWDATA"))
    return df.select(
        F.lit(table).alias("table"),
        entry.alias("entry_type"),
        et.alias("event_type"),
        F.array(F.struct(after.alias("after"))).alias("rows"),
    )


def cdc_from_tables(orders: DataFrame, lineitem: DataFrame, customer: DataFrame) -> DataFrame:
    """Change-feed envelopes, one per source row; event type by key % 3
    (INSERT/UPDATE/DELETE), entry type ROWDATA except key % 11 = 0."""
    o = _envelope(orders, "order_info", F.col("o_orderkey"), _kv(
        ("id", F.col("o_orderkey")), ("user_id", F.col("o_custkey")),
        ("order_status", F.col("o_orderstatus")), ("total_amount", F.col("o_totalprice")),
        ("create_time", create_time_text())))
    li = _envelope(lineitem, "order_detail", F.col("l_orderkey"), _kv(
        ("id", F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))),
        ("order_id", F.col("l_orderkey")), ("sku_id", F.col("l_partkey")),
        ("order_price", F.col("l_extendedprice")), ("sku_num", F.col("l_quantity"))))
    k = F.col("c_custkey")
    c = _envelope(customer, "user_info", k, _kv(
        ("id", k), ("login_name", F.col("c_name")), ("user_level", F.col("c_mktsegment")),
        ("birthday", _birthday(k)), ("gender", _gender(k))))
    return o.unionByName(li).unionByName(c)


# ---- batch loaders over an sf directory -------------------------------------------------

def startup_log(spark: SparkSession, sf_dir: str, first: str | None = None, last: str | None = None, zone: str | None = None) -> DataFrame:
    """Start-ups of the days ``first`` to ``last`` (all days when None), days and hours of ``zone`` (UTC when None)."""
    ev = within_days(read_table(spark, sf_dir, "events", ["user_id", "event_type", "ts"]), "ts", first, last, zone)
    return with_log_date_hour(startup_from_events(ev), zone=zone)


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["user_id", "event_type", "props", "ts"])
    return with_log_date_hour(event_log_from_events(ev))


def busy(log: DataFrame) -> DataFrame:
    """The behaviour log at 60 times its pace (ts div 60): dense enough for windows of 5 minutes."""
    return log.withColumn("ts", F.expr("ts div 60"))


def busy_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return busy(event_log(spark, sf_dir))


ORDER_SOURCE = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


def order_info(spark: SparkSession, sf_dir: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Orders of the days ``first`` to ``last`` (all days when None)."""
    return order_info_from_orders(within_days(read_table(spark, sf_dir, "orders", ORDER_SOURCE), "o_orderdate", first, last))


def wire_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with all 20 columns of the wire type."""
    return order_info_from_orders(read_table(spark, sf_dir, "orders", [*ORDER_SOURCE, "o_orderpriority"]),
                                  customer_nation(spark, sf_dir))


def customer_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])


def sku_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part", ["p_partkey", "p_name"]).select(
        F.col("p_partkey").cast("string").alias("sku_id"), F.col("p_name").alias("sku_name"))


def order_detail(spark: SparkSession, sf_dir: str, with_name: bool = True) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                               "l_quantity", "l_extendedprice", "l_shipdate"])
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"]) if with_name else None
    return order_detail_from_lineitem(li, p)


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_info_from_customer(read_table(spark, sf_dir, "customer",
                                              ["c_custkey", "c_name", "c_mktsegment"]))


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_changes_from_customer(read_table(spark, sf_dir, "customer",
                                                 ["c_custkey", "c_name", "c_mktsegment"]))


def student(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    return student_from_customer(read_table(spark, sf_dir, "customer",
                                            ["c_custkey", "c_mktsegment", "c_nationkey"]), as_of)


def cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                             "o_orderdate"])
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey",
                                               "l_extendedprice", "l_quantity"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    return cdc_from_tables(o, li, c)
