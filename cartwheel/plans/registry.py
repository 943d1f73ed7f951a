"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver tables of ``sf_dir`` whole (through the fixture
views) and returns a DataFrame whose column names match the DuckDB oracle
in :mod:`cartwheel.plans.oracle`.  Parameters (dates, as-of time, search
terms) are fixed literals so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha1

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonfns import decode, row_json
from ..functions.text import match
from ..functions.timefns import age_years, daily_index_name, epoch_ms, with_log_date_hour, within_days
from ..operators.cdc import route_changes
from ..operators.dedup import latest_per_key
from ..operators import index
from ..operators.snapshots import Files
from ..operators.upsert import append, fill_missing_ids, read_keyed
from ..operators.windows import alert_members, alert_minutes, alert_text
from ..schemas import STARTUP_CASTS, STARTUP_FIELDS
from ..session import apply_runtime_conf, run_path, work_path
from ..sources import fixtures as fx
from ..sources.tables import read_table
from . import analysis, dau, orders, reports
from .alerts import coupon_alert_job
from .users import user_latest

# Query parameters (fixed so the oracle can use the same literals).
DAU_DATE = "2024-01-15"
NEW_DEVICE_DATE = "2024-01-02"
GMV_DATE = "1998-10-03"
SPLIT_HOUR = "12"
SHOP_ZONE = "Asia/Shanghai"
CLOCK_ZONE, CLOCK_DAYS = "America/New_York", ("1996-04-05", "1996-04-09")     # clocks went forward on 7 April
AS_OF = fx.AS_OF
JOIN_BOUND = "10 days"          # event times of the fixtures are whole days
ALERT_WINDOW, ALERT_SLIDE, ALERT_USERS = "1 hour", "5 minutes", 3
SEARCH_SEX, SEARCH_FAVO, SEARCH_FROM, SEARCH_SIZE = "F", "machinery", 10, 10
MATCH_TEXT = "que la"
SALE_DATE, SALE_KEYWORD, SALE_FROM, SALE_SIZE = "1995-07-12", "plate ring", 0, 20

STARTUP_COLS = ("mid", "uid", "appid", "area", "os", "ch", "type", "vs", "ts", "log_date", "log_hour")


def _startup(spark, sf):
    return fx.startup_log(spark, sf)


def _dau(spark, sf, first=None, last=None):
    """The DAU rows of the given days: a day's rows come from that day's start-ups only."""
    return dau.daily_active(fx.startup_log(spark, sf, first, last))


def _orders(spark, sf, first=None, last=None):
    return fx.order_info(spark, sf, first, last)


def _with_day_before(date):
    return reports.previous_day_text(date), date


def q_startup_enrich(spark, sf):
    return _startup(spark, sf).select(*STARTUP_COLS)


def q_dau_first_per_device(spark, sf):
    return _dau(spark, sf).select(*STARTUP_COLS)


def _state_and_batch(spark, sf):
    s = _startup(spark, sf)
    return s.where(F.col("log_hour") < SPLIT_HOUR), s.where(F.col("log_hour") >= SPLIT_HOUR)


def q_dau_anti_join_state(spark, sf):
    state, batch = _state_and_batch(spark, sf)
    return dau.daily_active_new(batch, state).select(*STARTUP_COLS)


def q_dau_state_union(spark, sf):
    state, batch = _state_and_batch(spark, sf)
    return dau.seen_union(state, dau.daily_active_new(batch, state))


def q_dau_total(spark, sf):
    return reports.dau_total(_dau(spark, sf, DAU_DATE, DAU_DATE), DAU_DATE)


def q_dau_by_hour(spark, sf):
    return reports.dau_by_hour(_dau(spark, sf, DAU_DATE, DAU_DATE), DAU_DATE)


def q_new_devices(spark, sf):
    return dau.new_devices_by_day(_dau(spark, sf))


def q_dau_stage_counts(spark, sf):
    return dau.stage_counts(_startup(spark, sf), SPLIT_HOUR)


def q_order_enrich(spark, sf):
    return orders.order_revenue_rows(fx.wire_orders(spark, sf))


def q_gmv_total(spark, sf):
    return reports.gmv_total(_orders(spark, sf, GMV_DATE, GMV_DATE), GMV_DATE).select(F.round("sum_amount", 2).alias("sum_amount"))


def q_gmv_by_hour(spark, sf):
    return reports.gmv_by_hour(_orders(spark, sf, GMV_DATE, GMV_DATE), GMV_DATE).select(
        "create_hour", F.round("sum_amount", 2).alias("sum_amount"))


def q_gmv_by_day(spark, sf):
    return reports.gmv_by_day(_orders(spark, sf)).select(
        "create_date", F.round("sum_amount", 2).alias("sum_amount"), "n_orders")


def q_dau_hours_compare(spark, sf):
    return reports.dau_hours_compare(_dau(spark, sf, *_with_day_before(DAU_DATE)), DAU_DATE)


def q_gmv_hours_compare(spark, sf):
    return reports.gmv_hours_compare(_orders(spark, sf, *_with_day_before(GMV_DATE)), GMV_DATE)


def _totals_input(spark, sf, date):
    """Start-ups up to the date (a device counts once a day, so they need no dedup first) and the date's orders."""
    return fx.startup_log(spark, sf, None, date), _orders(spark, sf, date, date), date


def q_realtime_total(spark, sf):
    return reports.realtime_total(*_totals_input(spark, sf, NEW_DEVICE_DATE))


def q_realtime_total_orders_day(spark, sf):
    return reports.realtime_total(*_totals_input(spark, sf, GMV_DATE))


def q_realtime_total_json(spark, sf):
    return reports.realtime_total_json(*_totals_input(spark, sf, GMV_DATE))


def _hours_input(spark, sf, date):
    days = _with_day_before(date)
    return _dau(spark, sf, *days), _orders(spark, sf, *days), date


def q_realtime_hours(spark, sf):
    return reports.realtime_hours("dau", *_hours_input(spark, sf, DAU_DATE))


def q_realtime_hours_gmv(spark, sf):
    r = reports.realtime_hours("order_amount", *_hours_input(spark, sf, GMV_DATE))
    return r.select("series", "hour", F.round("value", 2).alias("value"))


def q_realtime_hours_json(spark, sf):
    return reports.realtime_hours_json("dau", *_hours_input(spark, sf, DAU_DATE))


def q_decode_startup_json(spark, sf):
    ev = read_table(spark, sf, "events", ["user_id", "event_type", "ts"])
    wire = fx.startup_from_events(ev).select(row_json(*STARTUP_FIELDS).alias("value"))
    return with_log_date_hour(decode(wire, STARTUP_FIELDS, STARTUP_CASTS)).select(*STARTUP_COLS)


def q_json_roundtrip(spark, sf):
    cols = orders.ORDER_COLUMNS
    wire = fx.wire_orders(spark, sf).select(row_json(*cols).alias("value"))
    return decode(wire, cols, {"total_amount": "double"}).select(*cols)


def q_cdc_route(spark, sf):
    msgs = route_changes(fx.cdc(spark, sf))
    return msgs.groupBy("topic", "table", "event_type").agg(F.count(F.lit(1)).alias("n"))


def q_cdc_after_image_json(spark, sf):
    return after_images(route_changes(fx.cdc(spark, sf)))


def after_images(msgs):
    """(topic, id, image) of routed messages: every name and value of the JSON, as ``name=value`` sorted by name."""
    read = msgs.select("topic", F.from_json("value", "map<string,string>").alias("m"))
    pairs = F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null"))))
    return read.select("topic", F.col("m")["id"].alias("id"), F.array_join(F.array_sort(pairs), "|").alias("image"))


def _join_cols(j):
    return j.select(F.col("i_id").alias("order_id"), F.col("d_id").alias("order_detail_id"),
                    F.col("d_order_id").alias("detail_order_id"), F.col("i_user_id").alias("user_id"),
                    F.col("d_sku_id").alias("sku_id"), F.col("d_price").cast("double").alias("sku_price"))


def q_order_detail_full_outer(spark, sf):
    return _join_cols(orders.order_detail_join(_orders(spark, sf), fx.order_detail(spark, sf, False), "full_outer"))


def q_order_detail_inner(spark, sf):
    return _join_cols(orders.order_detail_join(_orders(spark, sf), fx.order_detail(spark, sf, False), "inner"))


def q_order_without_detail(spark, sf):
    return orders.orders_without_detail(_orders(spark, sf), fx.order_detail(spark, sf, False)).select(
        "id", "user_id", "create_time")


def q_sale_detail_interval_join(spark, sf):
    return orders.sale_detail_interval(_orders(spark, sf), fx.order_detail(spark, sf), JOIN_BOUND)


def _sale_with_user(spark, sf, day=None, names=True):
    """Orders (of one day), then their lines, then item names where they are read, then users."""
    sale = orders.sale_detail_all(_orders(spark, sf, day, day), fx.order_detail(spark, sf, False))
    if names:
        sale = orders.with_sku_name(sale, fx.sku_names(spark, sf))
    return orders.with_user(sale, fx.user_info(spark, sf), AS_OF)


def q_sale_detail_with_user(spark, sf):
    return _sale_with_user(spark, sf)


def q_user_age_years(spark, sf):
    return fx.user_info(spark, sf).select("id", "birthday", age_years("birthday", AS_OF).alias("user_age"))


def q_user_latest(spark, sf):
    return user_latest(fx.user_changes(spark, sf))


def q_coupon_alert(spark, sf):
    return alert_text(coupon_alert_job(fx.event_log(spark, sf), ALERT_WINDOW, ALERT_SLIDE, ALERT_USERS))


def q_coupon_alert_5s(spark, sf):
    """The operator's defaults: windows of 5 minutes every 5 seconds."""
    return alert_text(coupon_alert_job(fx.busy_event_log(spark, sf)))


def q_alert_per_minute(spark, sf):
    return alert_minutes(fx.event_log(spark, sf), ALERT_WINDOW, ALERT_SLIDE, ALERT_USERS).select(
        "alert_id", "mid", "window_end", "n_uids")


def q_alert_per_minute_5s(spark, sf):
    """Up to twelve windows of a device end in a minute; the last one is stored."""
    return alert_minutes(fx.busy_event_log(spark, sf)).select("alert_id", "mid", "window_end", "n_uids")


def q_coupon_alert_members(spark, sf):
    return alert_members(fx.event_log(spark, sf), ALERT_WINDOW, ALERT_SLIDE, ALERT_USERS)


def q_upsert_latest_by_id(spark, sf):
    d = fx.order_detail(spark, sf, False)
    latest = latest_per_key(d, "id", [F.col("event_ts"), F.col("sku_id").cast("long"), F.col("suppkey")])
    return latest.select("id", "order_id", "sku_id", "suppkey",
                         F.date_format("event_ts", "yyyy-MM-dd").alias("ship_date"),
                         F.col("order_price").cast("double").alias("sku_price"))


def q_bulk_upsert_documents(spark, sf):
    """Two bulk writes through the keyed sink: all orders, then cheaper replacements of every third.  Documents without
    an id (every seventh) are appended, each with an id of its own, which is not shown."""
    own = F.col("o_orderkey") % 7 != 0
    docs = read_table(spark, sf, "orders", fx.ORDER_SOURCE).select(
        F.when(own, F.col("o_orderkey").cast("string")).alias("id"), F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_totalprice").alias("total_amount"), (F.col("o_orderkey") % 3 == 0).alias("again"))
    table = f"{run_path(spark, 'documents')}/docs"
    again = docs.where("again").withColumn("total_amount", F.col("total_amount") - 1)
    for number, batch in enumerate((docs, again)):
        append(fill_missing_ids(batch.drop("again"), "id"), table, number)
    return read_keyed(spark, table, "id").select(
        F.when(~F.col("id").startswith("auto-"), F.col("id")).alias("id"), "user_id",
        F.round("total_amount", 2).alias("total_amount"))


def q_daily_partition_counts(spark, sf):
    from ..constants import SALE_DETAIL_INDEX
    d = fx.order_detail(spark, sf, False)
    return (d.groupBy(daily_index_name(SALE_DETAIL_INDEX, epoch_ms("event_ts")).alias("index_name"))
             .agg(F.count(F.lit(1)).alias("n_docs")))


def _student_search(spark, sf):
    return analysis.student_search(fx.student(spark, sf), SEARCH_SEX, SEARCH_FAVO, SEARCH_FROM, SEARCH_SIZE)


def q_search_total_hits(spark, sf):
    return _student_search(spark, sf).total


def q_search_terms_agg(spark, sf):
    return _student_search(spark, sf).buckets.select(
        F.col("key").alias("class_id"), "doc_count", "max_age")


def q_search_page(spark, sf):
    return _student_search(spark, sf).hits.select("doc_id", "sex", "favo", "class_id", "age")


def _documents(spark, sf):
    return read_table(spark, sf, "documents", ["doc_id", "text", "lang"])


def q_search_match(spark, sf):
    return _documents(spark, sf).where(match("text", MATCH_TEXT)).select("doc_id", "lang")


def q_search_match_all(spark, sf):
    return _documents(spark, sf).where(match("text", MATCH_TEXT, "and")).select("doc_id", "lang")


def _document_index(spark, sf) -> str:
    """The index over the table's texts: built when the table is first searched (or has changed), read from then on."""
    files = Files(spark, sf)
    name = sha1(repr([files.stamp(f) for f in sorted(spark.read.parquet(f"{sf}/documents.parquet").inputFiles())]).encode()).hexdigest()
    path = work_path(spark, "index", name)
    if not index.exists(spark, path):
        index.index_batch(_documents(spark, sf), path, 0)
    return path


def q_search_bm25(spark, sf):
    return index.ranked(spark, _document_index(spark, sf), MATCH_TEXT).select(F.col("doc").alias("doc_id"), F.round("score", 4).alias("score"))


def q_search_match_indexed(spark, sf):
    """The documents that hold every token, from the postings of the tokens alone."""
    return index.matching(spark, _document_index(spark, sf), MATCH_TEXT, "and").select(F.col("doc").alias("doc_id"))


def q_facet_gender(spark, sf):
    return analysis.facet_gender(_sale_with_user(spark, sf, names=False))


def q_facet_age_band(spark, sf):
    return analysis.facet_age_band(_sale_with_user(spark, sf, names=False))


def _sale_search(spark, sf):
    return analysis.sale_search(_sale_with_user(spark, sf, SALE_DATE), SALE_DATE, SALE_KEYWORD, SALE_FROM, SALE_SIZE)


def q_sale_search_page(spark, sf):
    return _sale_search(spark, sf)["detail"]


def q_sale_search_total(spark, sf):
    return _sale_search(spark, sf)["total"]


def q_sale_search_facets(spark, sf):
    return _sale_search(spark, sf)["facets"]


def q_sale_search_json(spark, sf):
    return analysis.sale_search_json(_sale_with_user(spark, sf, SALE_DATE), SALE_DATE, SALE_KEYWORD, SALE_FROM, SALE_SIZE)


def q_dau_hours_zone(spark, sf):
    """The hours of a day where the shops are, against those of the day before."""
    first, last = _with_day_before(DAU_DATE)
    return reports.dau_hours_compare(dau.daily_active(fx.startup_log(spark, sf, first, last, SHOP_ZONE)), DAU_DATE)


def q_gmv_zone_days(spark, sf):
    """Five days around the hour that a zone's clocks skip."""
    rows = within_days(read_table(spark, sf, "orders", ["o_orderdate", "o_totalprice"]), "o_orderdate", *CLOCK_DAYS, CLOCK_ZONE)
    return reports.sums_by_zone_day(rows.withColumn("ts", epoch_ms("o_orderdate")), "ts", "o_totalprice", CLOCK_ZONE).withColumn(
        "sum_amount", F.round("sum_amount", 2))


def _province_sales(spark, sf):
    return analysis.province_sales(
        read_table(spark, sf, "orders", ["o_custkey", "o_totalprice"]),
        read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"]),
        read_table(spark, sf, "nation", ["n_nationkey", "n_name"]))


def q_province_sales(spark, sf):
    return _province_sales(spark, sf)


def q_province_topk(spark, sf):
    return analysis.province_topk(_province_sales(spark, sf), 5)


def q_province_sales_bins(spark, sf):
    return analysis.province_sales_bins(_province_sales(spark, sf))


def q_sku_sales(spark, sf):
    return analysis.sku_sales(read_table(spark, sf, "lineitem", ["l_partkey"]),
                              read_table(spark, sf, "part", ["p_partkey", "p_name"]))


_BATCH = {
    "startup_enrich": q_startup_enrich,
    "dau_first_per_device": q_dau_first_per_device,
    "dau_anti_join_state": q_dau_anti_join_state,
    "dau_state_union": q_dau_state_union,
    "dau_total": q_dau_total,
    "dau_by_hour": q_dau_by_hour,
    "new_devices": q_new_devices,
    "dau_stage_counts": q_dau_stage_counts,
    "order_enrich": q_order_enrich,
    "gmv_total": q_gmv_total,
    "gmv_by_hour": q_gmv_by_hour,
    "gmv_by_day": q_gmv_by_day,
    "dau_hours_compare": q_dau_hours_compare,
    "gmv_hours_compare": q_gmv_hours_compare,
    "realtime_total": q_realtime_total,
    "realtime_total_orders_day": q_realtime_total_orders_day,
    "realtime_total_json": q_realtime_total_json,
    "realtime_hours": q_realtime_hours,
    "realtime_hours_gmv": q_realtime_hours_gmv,
    "realtime_hours_json": q_realtime_hours_json,
    "decode_startup_json": q_decode_startup_json,
    "json_roundtrip": q_json_roundtrip,
    "cdc_route": q_cdc_route,
    "cdc_after_image_json": q_cdc_after_image_json,
    "order_detail_full_outer": q_order_detail_full_outer,
    "order_detail_inner": q_order_detail_inner,
    "order_without_detail": q_order_without_detail,
    "sale_detail_interval_join": q_sale_detail_interval_join,
    "sale_detail_with_user": q_sale_detail_with_user,
    "user_age_years": q_user_age_years,
    "user_latest": q_user_latest,
    "coupon_alert": q_coupon_alert,
    "coupon_alert_5s": q_coupon_alert_5s,
    "alert_per_minute": q_alert_per_minute,
    "alert_per_minute_5s": q_alert_per_minute_5s,
    "coupon_alert_members": q_coupon_alert_members,
    "upsert_latest_by_id": q_upsert_latest_by_id,
    "bulk_upsert_documents": q_bulk_upsert_documents,
    "daily_partition_counts": q_daily_partition_counts,
    "search_total_hits": q_search_total_hits,
    "search_terms_agg": q_search_terms_agg,
    "search_page": q_search_page,
    "search_match": q_search_match,
    "search_match_all": q_search_match_all,
    "search_bm25": q_search_bm25,
    "search_match_indexed": q_search_match_indexed,
    "facet_gender": q_facet_gender,
    "facet_age_band": q_facet_age_band,
    "sale_search_page": q_sale_search_page,
    "sale_search_total": q_sale_search_total,
    "sale_search_facets": q_sale_search_facets,
    "sale_search_json": q_sale_search_json,
    "province_sales": q_province_sales,
    "province_topk": q_province_topk,
    "province_sales_bins": q_province_sales_bins,
    "sku_sales": q_sku_sales,
    "dau_hours_zone": q_dau_hours_zone,
    "gmv_zone_days": q_gmv_zone_days,
}


def _wrap(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_runtime_conf(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {k: _wrap(v) for k, v in _BATCH.items()}
    from ..streaming.register import stream_queries
    out.update({k: _wrap(v) for k, v in stream_queries().items()})
    return out
