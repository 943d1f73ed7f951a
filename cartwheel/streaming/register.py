"""Registered streaming queries.

Each source arrives in slices, ordered by its time or key: a slice is written to the run's source folder, the job runs over it
(``availableNow``) and ends; the next slice finds it restarted from its checkpoint.  So every query merges several
micro-batches through its sink.  Working folders are fresh per run, under the shared ``spark.checkpoint.dir``."""

from __future__ import annotations

import contextlib
import functools
import itertools
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import index
from ..operators.upsert import TidyBeside, append, stored
from ..session import many_batches, run_path
from ..sources import fixtures as fx
from ..sources.log import append_log, read_log
from ..sources.tables import read_table
from ..sources.topic import TopicSource
from ..plans import registry as R
from ..plans.orders import ORDER_COLUMNS, with_sku_name
from ..plans.reports import dau_hours_compare, gmv_by_day
from ..plans.users import USER_COLUMNS
from . import jobs, late
from .ttl_join import rocksdb, ttl_sale_detail_stream

SLICES = 3


def _slices(df: DataFrame, col: str, n: int = SLICES) -> list[DataFrame]:
    """The rows in ``n`` slices of equal ranges of ``col`` (rows without a value come last)."""
    low, high = df.agg(F.min(col), F.max(col)).first()
    if low is None:
        return [df]
    cuts = [low + (high - low) * i / n if not isinstance(low, int) else low + (high - low) * i // n for i in range(1, n)]
    out, rest = [], F.lit(True)
    for cut in cuts:
        before = F.coalesce(F.col(col) < F.lit(cut).cast(df.schema[col].dataType), F.lit(False))
        out.append(df.where(rest & before))
        rest = rest & ~before
    return [*out, df.where(rest)]


def _run(spark: SparkSession, run: str, feeds: dict[str, list[DataFrame]], start: Callable[[dict], StreamingQuery]) -> None:
    """Slice after slice: append it to the source folders, run the job until it has read them."""
    for i in range(max(len(f) for f in feeds.values())):
        for name, slices in feeds.items():
            if i < len(slices):
                slices[i].write.mode("append").parquet(f"{run}/src/{name}")
        streams = {name: TopicSource("parquet", path=f"{run}/src/{name}", schema=slices[0].schema).stream(spark)
                   for name, slices in feeds.items()}
        start(streams).awaitTermination()


def _events(spark, sf) -> dict[str, list[DataFrame]]:
    return {"events": _slices(read_table(spark, sf, "events", ["user_id", "event_type", "props", "ts"]), "ts")}


def _user_table(spark, sf, run) -> str:
    """Inserts come first, the changes of the same users in a later slice."""
    path = f"{run}/users"
    _run(spark, run, {"user_changes": _slices(fx.user_changes(spark, sf), "ts")},
         lambda s: jobs.start_user_dimension(s["user_changes"], path, f"{run}/ckpt_users", available_now=True))
    return path


def _dau_table(spark, sf, run, seen=False) -> str:
    path = f"{run}/dau"
    _run(spark, run, _events(spark, sf),
         lambda s: jobs.start_dau(fx.startup_from_events(s["events"]), path, f"{run}/ckpt",
                                  seen_path=f"{run}/seen" if seen else None, available_now=True))
    return path


def q_stream_dau(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.read_dau(spark, _dau_table(spark, sf, run_path(spark, "dau"), seen=True)).select(*R.STARTUP_COLS)


def q_stream_dau_report(spark: SparkSession, sf: str) -> DataFrame:
    """Stream -> keyed DAU table -> today vs yesterday report read from the
    table (partition-pruned by log_date)."""
    return dau_hours_compare(jobs.read_dau(spark, _dau_table(spark, sf, run_path(spark, "dau_report"))), R.DAU_DATE)


def _order_table(spark, sf, run) -> str:
    """An early version of every fifth order first, then the orders themselves in three slices."""
    path = f"{run}/orders"
    rows = read_table(spark, sf, "orders", [*fx.ORDER_SOURCE, "o_orderpriority"])
    early = rows.where("o_orderkey % 5 = 0").withColumns({"o_orderstatus": F.lit("early"), "o_totalprice": F.col("o_totalprice") + 10})
    nations = fx.customer_nation(spark, sf)
    _run(spark, run, {"orders": [early, *_slices(rows, "o_orderdate")]},
         lambda s: jobs.start_order_table(fx.order_info_from_orders(s["orders"], nations), path, f"{run}/ckpt_orders",
                                          available_now=True))
    return path


def q_stream_order_table(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.read_orders(spark, _order_table(spark, sf, run_path(spark, "orders"))).select(*ORDER_COLUMNS)


def q_stream_gmv(spark: SparkSession, sf: str) -> DataFrame:
    t = jobs.read_orders(spark, _order_table(spark, sf, run_path(spark, "gmv")))
    return gmv_by_day(t).select("create_date", F.round("sum_amount", 2).alias("sum_amount"), "n_orders")


def q_stream_user_latest(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.read_users(spark, _user_table(spark, sf, run_path(spark, "users"))).select(*USER_COLUMNS)


def q_stream_sale_detail(spark: SparkSession, sf: str) -> DataFrame:
    run = run_path(spark, "sale")
    users, out = _user_table(spark, sf, run), f"{run}/sale_detail"
    names = fx.sku_names(spark, sf)          # static side
    lines = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                               "l_extendedprice", "l_shipdate"])
    feeds = {"orders": _slices(read_table(spark, sf, "orders", fx.ORDER_SOURCE), "o_orderdate"),
             "lineitem": _slices(lines, "l_shipdate")}

    # the fixture's line id repeats across lines; the line's item completes the document key
    def start(s):
        return jobs.start_sale_detail_join(fx.order_info_from_orders(s["orders"]), fx.order_detail_from_lineitem(s["lineitem"]), out,
                                           f"{run}/ckpt_sale", R.JOIN_BOUND, lambda sale: with_sku_name(sale, names), users_path=users,
                                           as_of=R.AS_OF, keys=("order_detail_id", "sku_id"), available_now=True)
    _run(spark, run, feeds, start)
    return jobs.read_sale_detail(spark, out, ("order_detail_id", "sku_id")).select(
        "order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id", "user_gender",
        "user_age", "user_level", "sku_price", "sku_name", "dt")


def q_stream_coupon_alert(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of 5 minutes every 5 seconds.  A closing event long after the others lets the watermark pass the last windows."""
    run = run_path(spark, "alerts")
    feeds = _events(spark, sf)
    closing = feeds["events"][-1].limit(1).select(
        "user_id", F.lit("close").alias("event_type"), F.lit("{}").alias("props"), (F.col("ts") + F.expr("interval 400 days")).alias("ts"))
    feeds["events"].append(closing)
    _run(spark, run, feeds, lambda s: jobs.start_coupon_alerts(
        fx.busy(fx.event_log_from_events(s["events"])), f"{run}/alerts", f"{run}/ckpt", available_now=True))
    return R.alert_text(jobs.read_alerts(spark, f"{run}/alerts")).select(
        "alert_id", "mid", "window_start", "window_end", "n_uids", "uids", "item_ids", "events", "ts")


def q_stream_cdc_route(spark: SparkSession, sf: str) -> DataFrame:
    run = run_path(spark, "cdc")
    out = f"{run}/topics"
    _run(spark, run, {t: _slices(read_table(spark, sf, t), k) for t, k in (
        ("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("customer", "c_custkey"))},
         lambda s: jobs.start_change_router(fx.cdc_from_tables(s["orders"], s["lineitem"], s["customer"]), out, f"{run}/ckpt",
                                            available_now=True))
    return R.after_images(spark.read.schema("value string, topic string").json(out))


def q_stream_search_index(spark: SparkSession, sf: str) -> DataFrame:
    """Every fifth document is indexed with another text first, then all documents in three slices; BM25 over the index."""
    run = run_path(spark, "index")
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    early = docs.where("doc_id % 5 = 0").withColumn("text", F.concat(F.lit("que la que "), F.reverse("text")))
    _run(spark, run, {"documents": [early, *_slices(docs, "doc_id")]},
         lambda s: index.start_index(s["documents"], f"{run}/index", f"{run}/ckpt", available_now=True))
    return index.ranked(spark, f"{run}/index", R.MATCH_TEXT).select(F.col("doc").alias("doc_id"), F.round("score", 4).alias("score"))


FEED_PARTITIONS = 2


def q_stream_change_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of three tables as a topic log; the topics of a pattern are read at most 100 messages a micro-batch, by a stream for
    each log partition.  The job is lost in mid-log, after a micro-batch was written but before it was noted, and goes on from its
    checkpoints."""
    run = run_path(spark, "feed")
    log, tables = f"{run}/log", [f"{run}/messages/{part}" for part in range(FEED_PARTITIONS)]
    for number, (topic, name, key) in enumerate((("shop.supplier", "supplier", "s_suppkey"), ("shop.nation", "nation", "n_nationkey"),
                                                 ("other.region", "region", "r_regionkey"))):
        rows = read_table(spark, sf, name)
        append_log(rows.select(F.lit(topic).alias("topic"), F.col(key).cast("string").alias("key"), F.to_json(F.struct(key)).alias("value")),
                   log, number, partitions=FEED_PARTITIONS)
    written = itertools.count()

    def start(part: int, lost_at: int | None, tidy: TidyBeside) -> StreamingQuery:
        def write(batch: DataFrame, batch_id: int) -> None:
            append(batch, tables[part], batch_id, arranged=True)       # a file's messages
            if lost_at is not None and next(written) >= lost_at:
                raise RuntimeError("the driver is lost")
            tidy()
        return (read_log(spark, log, "shop.*", part=part).writeStream.option("checkpointLocation", f"{run}/ckpt/{part}")
                .trigger(availableNow=True).foreachBatch(write).start())

    def consume(lost_at: int | None) -> None:
        with contextlib.ExitStack() as ends:
            queries = []
            with many_batches(spark, run):
                for part, table in enumerate(tables):
                    queries.append(start(part, lost_at, ends.enter_context(TidyBeside(spark, table))))
                    ends.callback(queries[-1].stop)
            for query in queries:
                query.awaitTermination()

    try:
        consume(1)
    except StreamingQueryException:
        consume(None)
    rows = functools.reduce(DataFrame.unionByName, [r for r in (stored(spark, t) for t in tables) if r is not None])
    return rows.groupBy("topic", "key", "value").agg(F.count("*").alias("n_times"))


LATE_EVERY = 97      # lines of every 97th order come last, when most of them are late


def q_stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders joined with their lines in event time, with the lines of some orders arriving after all others: matched pairs, orders
    without a line in time, and late lines.  One micro-batch of lines is replayed."""
    run = run_path(spark, "late")
    orders = read_table(spark, sf, "orders", fx.ORDER_SOURCE)
    lines = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"])
    last = F.col("l_orderkey") % LATE_EVERY == 0
    far = F.expr("interval 4000 days")
    closing = lambda df, time, key: df.limit(1).withColumns({time: F.col(time) + far, key: F.lit(-1).cast("long")})
    feeds = {"orders": [*_slices(orders, "o_orderdate", 2), orders.limit(0), closing(orders, "o_orderdate", "o_orderkey")],
             "lineitem": [*_slices(lines.where(~last), "l_shipdate", 2), lines.where(last), closing(lines, "l_shipdate", "l_orderkey")]}
    parts = {"orders": fx.order_info_from_orders, "lineitem": fx.order_detail_from_lineitem}

    def start(s):
        for name, shape in parts.items():
            late.start_split(shape(s[name]), f"{run}/{name}", f"{run}/ckpt_{name}", bound=R.JOIN_BOUND, available_now=True).awaitTermination()
        clean = {name: late.clean_rows(spark, f"{run}/{name}", shape(s[name]).schema) for name, shape in parts.items()}
        i = clean["orders"].select(F.col("id").alias("i_id"), F.col("event_ts").alias("i_ts"))
        d = clean["lineitem"].select(F.col("id").alias("d_id"), F.col("order_id").alias("d_order_id"), F.col("sku_id").alias("d_sku_id"),
                                     F.col("event_ts").alias("d_ts"))
        return late.start_outer_join(i, d, "i_id", "d_order_id", "i_ts", "d_ts", f"{run}/joined", f"{run}/ckpt_join", R.JOIN_BOUND,
                                     available_now=True)

    _run(spark, run, feeds, start)
    again = spark.read.schema(lines.schema).parquet(f"{run}/src/lineitem").where(F.col("l_orderkey") % LATE_EVERY == 0)
    late.late_splitter(f"{run}/lineitem", "event_ts", R.JOIN_BOUND)(parts["lineitem"](again), 2)      # a replay changes nothing
    joined = stored(spark, f"{run}/joined").select(
        F.when(F.col("d_id").isNull(), "unmatched").otherwise("matched").alias("kind"), F.col("i_id").alias("order_id"),
        F.col("d_id").alias("order_detail_id"), F.col("d_sku_id").alias("sku_id"))
    return joined.unionByName(late.late_rows(spark, f"{run}/lineitem").select(
        F.lit("late").alias("kind"), "order_id", F.col("id").alias("order_detail_id"), "sku_id"))


def q_stream_ttl_join(spark: SparkSession, sf: str) -> DataFrame:
    """The processing-time TTL join: half of the lines wait for their orders, which come in two versions, the other half find them.
    Such a query never runs out of timers, so it is stopped once it has read everything.  No order here is hot (seven lines at
    most), so one salt will do."""
    run = run_path(spark, "ttl")
    orders = read_table(spark, sf, "orders", fx.ORDER_SOURCE)
    lines = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"])
    versions = orders.withColumn("offset", F.lit(2)).unionByName(
        orders.where("o_orderkey % 5 = 0").withColumns({"o_orderstatus": F.lit("early"), "offset": F.lit(1)}))
    versions = versions.repartition("o_orderkey")       # the versions of an order in one file, so in one micro-batch
    kinds = {"orders": versions, "lineitem": lines}
    for name, rows in kinds.items():
        rows.limit(0).write.parquet(f"{run}/src/{name}")
    src = {name: TopicSource("parquet", path=f"{run}/src/{name}", schema=rows.schema).stream(spark) for name, rows in kinds.items()}
    numbered = fx.order_info_from_orders(src["orders"].withColumn("o_orderstatus", F.concat_ws("/", "o_orderstatus", "offset")))
    numbered = numbered.withColumns({"offset": F.substring_index("order_status", "/", -1).cast("long"),
                                     "order_status": F.substring_index("order_status", "/", 1)})
    sale = ttl_sale_detail_stream(numbered, fx.order_detail_from_lineitem(src["lineitem"]), 3_600_000, salts=1, arrival="offset")
    with rocksdb(spark):
        q = (sale.writeStream.option("checkpointLocation", f"{run}/ckpt").trigger(processingTime="1 second")
             .foreachBatch(lambda batch, n: append(batch, f"{run}/sale", n)).start())
    done, read = 0, {}                # rows read by micro-batch; the query itself remembers the last hundred only
    try:
        half = F.col("l_linenumber") % 2 == 0
        for name, rows in (("lineitem", lines.where(half)), ("orders", versions), ("lineitem", lines.where(~half))):
            done += rows.count()
            rows.write.mode("append").parquet(f"{run}/src/{name}")
            while q.isActive and sum(read.values()) < done:
                time.sleep(0.5)
                read.update({p["batchId"]: p["numInputRows"] for p in q.recentProgress if p["numInputRows"]})
            if q.exception() is not None:
                raise q.exception()
    finally:
        q.stop()
    return stored(spark, f"{run}/sale").select("order_detail_id", "order_id", "order_status", "user_id", "sku_id", "sku_price")


def stream_queries() -> dict:
    return {
        "stream_dau": q_stream_dau,
        "stream_dau_report": q_stream_dau_report,
        "stream_order_table": q_stream_order_table,
        "stream_gmv": q_stream_gmv,
        "stream_user_latest": q_stream_user_latest,
        "stream_sale_detail": q_stream_sale_detail,
        "stream_coupon_alert": q_stream_coupon_alert,
        "stream_cdc_route": q_stream_cdc_route,
        "stream_search_index": q_stream_search_index,
        "stream_change_feed": q_stream_change_feed,
        "stream_late_rows": q_stream_late_rows,
        "stream_ttl_join": q_stream_ttl_join,
    }


def stream_oracles(batch_sql: dict) -> dict:
    from ..plans import oracle as O
    sale_user = O.w(O.ORDER_INFO, O.ORDER_DETAIL, O.USER_INFO) + """
, ch AS (
  SELECT id, login_name, user_level, birthday, gender, 1704067200000 + c_custkey AS ts, c_custkey AS seq FROM user_info
  UNION ALL
  SELECT id, login_name, user_level || '-PLUS', birthday, gender, 1704067200000 + 86400000 + c_custkey,
         1000000000000 + c_custkey FROM user_info WHERE c_custkey % 3 = 1),
ul AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, seq DESC) AS rn FROM ch)
       WHERE rn = 1),
s AS (SELECT d.id AS order_detail_id, o.id AS order_id, o.order_status, o.create_time, o.user_id, d.sku_id,
             d.order_price AS sku_price, d.sku_name, o.create_date AS dt
      FROM order_info o JOIN order_detail d ON o.id = d.order_id
       AND d.event_ts BETWEEN o.event_ts - INTERVAL 10 DAY AND o.event_ts + INTERVAL 10 DAY)
SELECT s.order_detail_id, s.order_id, s.order_status, s.create_time,
       CASE WHEN u.id IS NOT NULL THEN u.id ELSE s.user_id END AS user_id, s.sku_id, u.gender AS user_gender,
       coalesce(CASE WHEN u.id IS NOT NULL THEN """ + O.age_sql("u.birthday") + """ END, 0) AS user_age,
       u.user_level, coalesce(s.sku_price, 0.0) AS sku_price, s.sku_name, s.dt
FROM s LEFT JOIN ul u ON s.user_id = u.id"""
    late = f"l_orderkey % {LATE_EVERY} = 0 AND l_shipdate < (SELECT max(l_shipdate) FROM lineitem WHERE l_orderkey % {LATE_EVERY} <> 0) - INTERVAL 10 DAY"
    late_rows = f"""
WITH l AS (SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_orderkey || '-' || l_linenumber AS order_detail_id, CAST(l_partkey AS VARCHAR) AS sku_id,
                  l_shipdate, {late} AS late FROM lineitem),
m AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, l.order_detail_id, l.sku_id FROM orders LEFT JOIN l
      ON l.order_id = CAST(o_orderkey AS VARCHAR) AND NOT l.late
      AND l.l_shipdate BETWEEN o_orderdate - INTERVAL 10 DAY AND o_orderdate + INTERVAL 10 DAY)
SELECT CASE WHEN order_detail_id IS NULL THEN 'unmatched' ELSE 'matched' END AS kind, order_id, order_detail_id, sku_id FROM m
UNION ALL SELECT 'late', order_id, order_detail_id, sku_id FROM l WHERE late"""
    feed = """
SELECT 'shop.supplier' AS topic, CAST(s_suppkey AS VARCHAR) AS key, '{"s_suppkey":' || s_suppkey || '}' AS value, 1::BIGINT AS n_times FROM supplier
UNION ALL SELECT 'shop.nation', CAST(n_nationkey AS VARCHAR), '{"n_nationkey":' || n_nationkey || '}', 1 FROM nation"""
    return {
        "stream_change_feed": feed,
        "stream_late_rows": late_rows,
        "stream_ttl_join": """
SELECT l_orderkey || '-' || l_linenumber AS order_detail_id, CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS order_status,
       CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS sku_id, CAST(l_extendedprice AS DOUBLE) AS sku_price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "stream_dau": batch_sql["dau_first_per_device"],
        "stream_dau_report": batch_sql["dau_hours_compare"],
        "stream_order_table": batch_sql["order_enrich"],
        "stream_gmv": batch_sql["gmv_by_day"],
        "stream_user_latest": batch_sql["user_latest"],
        "stream_sale_detail": sale_user,
        "stream_coupon_alert": O.w(O.BUSY_LOG, O.ALERT_5S) + """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY alert_id ORDER BY ts DESC) AS rn FROM alerts) WHERE rn = 1""",
        "stream_cdc_route": batch_sql["cdc_after_image_json"],
        "stream_search_index": batch_sql["search_bm25"],
    }
