"""Structured Streaming wrappers.

Each job = source DataFrame -> the same pure transformation the batch form
uses -> watermark / trigger / checkpoint -> sink.  Keyed sinks go through
``foreachBatch`` + :func:`cartwheel.operators.upsert.append`: a replayed
micro-batch (after a crash or a lost executor) replaces its own folder, and
the ``read_*`` functions pick one row per key.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import ALERT_MIN_USERS, ALERT_SLIDE, ALERT_WINDOW, EVID_CLICK, JOIN_LATE_BOUND, TRIGGER_INTERVAL
from ..functions.timefns import with_log_date_hour
from ..operators.cdc import route_changes
from ..operators.dedup import latest_per_key
from ..operators.joins import interval_join
from ..operators import snapshots
from ..operators.upsert import append, append_accepted, append_distinct, fill_missing_ids, first_number, read_keyed, stored, tidy
from ..operators.windows import alert_rows, alerts_per_minute, interval_ms, pane_entries
from ..plans.dau import DAU_KEYS, DAU_ORDER, daily_active_new, daily_active
from ..plans.orders import merge_sale_detail, with_user
from ..plans.users import USER_COLUMNS


def _writer(df: DataFrame, name: str, checkpoint: str, trigger: str | None, available_now: bool):
    w = df.writeStream.queryName(name).option("checkpointLocation", checkpoint)
    if available_now:
        return w.trigger(availableNow=True)
    return w.trigger(processingTime=trigger or TRIGGER_INTERVAL)


# ---- daily active devices -------------------------------------------------------------

def dau_batch_writer(dau_path: str, seen_path: str | None = None, first: int = 0):
    """foreachBatch body: the earliest start-up per (day, device) of the batch is appended; which batch had a device first
    is decided when the table is read (``read_dau``).  With ``seen_path`` devices of the recorded set are left out
    (anti-join), and the new ones are added to the set; both sinks are written from one persisted batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch_id += first
        rows = with_log_date_hour(batch)
        rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if rows.isEmpty():
                return
            seen = stored(batch.sparkSession, seen_path) if seen_path else None
            # keys of this batch's own earlier attempt do not count as seen
            new = daily_active(rows) if seen is None else daily_active_new(rows, seen.where(F.col("batch_id") < batch_id))
            append_accepted(new, dau_path, batch_id, list(DAU_KEYS), "log_date", list(DAU_ORDER), "first")
            if seen_path:
                append_distinct(new.dropna(subset=list(DAU_KEYS)), seen_path, list(DAU_KEYS), batch_id, "log_date")
        finally:
            rows.unpersist()
    return write


def read_dau(spark: SparkSession, path: str) -> DataFrame:
    return read_keyed(spark, path, list(DAU_KEYS), list(DAU_ORDER), keep="first")


def start_dau(startup: DataFrame, dau_path: str, checkpoint: str, seen_path: str | None = None,
              trigger: str | None = None, available_now: bool = False) -> StreamingQuery:
    """``startup``: decoded start-up rows (mid, uid, ..., ts epoch ms)."""
    return (_writer(startup, "dau", checkpoint, trigger, available_now)
            .foreachBatch(dau_batch_writer(dau_path, seen_path, first_number(startup.sparkSession, dau_path, checkpoint))).start())


def dau_stream_dedup(startup: DataFrame, retention: str = "2 days") -> DataFrame:
    """Engine-managed alternative: bounded dedup state per (day, device)
    (survivor within a batch is arbitrary; state expires after ``retention``)."""
    rows = with_log_date_hour(startup).withColumn("event_ts", F.timestamp_millis("ts"))
    return rows.withWatermark("event_ts", retention).dropDuplicatesWithinWatermark(list(DAU_KEYS))


# ---- orders / revenue -----------------------------------------------------------------

def start_order_table(orders: DataFrame, table_path: str, checkpoint: str, order_by=("event_ts",),
                      trigger: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Keyed order table (id) with every column of the stream, partitioned by month; last write wins
    (``read_orders``).  Orders without an id go to the rejected table."""
    first = first_number(orders.sparkSession, table_path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            append_accepted(batch.withColumn("create_month", F.substring("create_date", 1, 7)), table_path,
                            first + batch_id, "id", "create_month", list(order_by))
        finally:
            batch.unpersist()
    return _writer(orders, "orders", checkpoint, trigger, available_now).foreachBatch(write).start()


def read_orders(spark: SparkSession, path: str, order_by=("event_ts",), where=None) -> DataFrame:
    """Latest version per order; ``where`` on create_month or create_date (fixed for an order) prunes months and row groups."""
    return read_keyed(spark, path, "id", list(order_by), where=where).drop("create_month")


# ---- user dimension -------------------------------------------------------------------

def start_user_dimension(users: DataFrame, table_path: str, checkpoint: str, order_by=("ts", "seq"),
                         trigger: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Latest value per user id (order = arrival order columns); users without an id go to the rejected table."""
    cols = [*USER_COLUMNS, *order_by]
    first = first_number(users.sparkSession, table_path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        # rows without an id are kept aside one by one, the others as the last one per user
        rows = batch.select(*cols)
        rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            known = latest_per_key(rows.where(F.col("id").isNotNull()), "id", list(order_by))
            append_accepted(known.unionByName(rows.where(F.col("id").isNull())), table_path, first + batch_id, "id", order_by=list(order_by))
        finally:
            rows.unpersist()
    return _writer(users, "users", checkpoint, trigger, available_now).foreachBatch(write).start()


def read_users(spark: SparkSession, path: str, order_by=("ts", "seq"), version: int | None = None) -> DataFrame | None:
    """Latest value per user, now or as of a snapshot version; None before the first write."""
    return read_keyed(spark, path, "id", list(order_by), version=version)


def version_for_batch(spark: SparkSession, path: str, checkpoint: str, batch_id: int) -> int | None:
    """The snapshot of a lookup table that micro-batch ``batch_id`` uses: the newest one when it first ran, noted beside its
    checkpoint, so a replay looks up the same values.  None while there is no table."""
    files, note = snapshots.Files(spark, checkpoint), f"{checkpoint}/lookups/{batch_id}"
    if files.names(note) is None:
        now = snapshots.current(spark, path)
        if now is None:
            return None
        files.create(note, str(now.version))
        files.delete(f"{checkpoint}/lookups/{batch_id - 100}")     # the engine replays the last micro-batch only
    return int(files.read(note))


# ---- sale detail ----------------------------------------------------------------------

def _order_side(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("id").alias("i_id"), F.col("user_id").alias("i_user_id"),
                         F.col("order_status").alias("i_status"), F.col("create_time").alias("i_create_time"),
                         F.col("create_date").alias("i_dt"), F.col("event_ts").alias("i_ts"))


def _line_side(details: DataFrame) -> DataFrame:
    return details.select(F.col("id").alias("d_id"), F.col("order_id").alias("d_order_id"),
                          F.col("sku_id").alias("d_sku_id"), F.col("sku_name").alias("d_sku_name"),
                          F.col("order_price").alias("d_price"), F.col("event_ts").alias("d_ts"))


def sale_detail_stream(orders: DataFrame, details: DataFrame, bound: str = JOIN_LATE_BOUND,
                       how: str = "inner") -> DataFrame:
    """Stream-stream interval join; watermarks on both sides bound the join
    state to ``bound`` of event time (what a TTL cache approximated)."""
    i, d = _order_side(orders).withWatermark("i_ts", bound), _line_side(details).withWatermark("d_ts", bound)
    return merge_sale_detail(interval_join(i, d, "i_id", "d_order_id", "i_ts", "d_ts", bound, bound, how))


SALE_ORDER = ["create_time", "sku_price"]


def start_sale_detail(sale: DataFrame, out_path: str, checkpoint: str, users_path: str | None = None,
                      as_of=None, keys=("order_detail_id",), partition: str = "processing_day",
                      trigger: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Enrich each micro-batch with the user table as it is now (its newest snapshot, so updates are seen; a replay
    takes the same one), then append the documents; the last write per ``keys`` wins (``read_sale_detail``).
    Documents without an id get one of their own and all stay.  The lookup reads the table's live folders, whose number
    compaction bounds, however many batches have written users.

    ``partition='processing_day'`` (default) writes each batch into the daily
    index of the write day (``day`` = days since epoch of the current date),
    so a micro-batch touches one partition; ``partition='event_day'`` uses
    the order's create date (``dt``) instead."""
    first = first_number(sale.sparkSession, out_path, checkpoint)
    write = _sale_writer(out_path, checkpoint, first, users_path, as_of, keys, partition)
    return _writer(sale, "sale_detail", checkpoint, trigger, available_now).foreachBatch(write).start()


def _sale_writer(out_path, checkpoint, first, users_path, as_of, keys, partition):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = version_for_batch(spark, users_path, checkpoint, batch_id) if users_path else None    # a damaged table raises
        users = read_users(spark, users_path, version=version) if version is not None else None
        if users is None:
            users = spark.createDataFrame([], "id string, login_name string, user_level string, "
                                              "birthday string, gender string")
        docs = with_user(batch, users, as_of)
        if partition == "processing_day":
            docs = docs.withColumn("day", F.unix_date(F.current_date()).cast("long"))
            part_col = "day"
        else:
            part_col = "dt"
        append(fill_missing_ids(docs, keys[0]), out_path, first + batch_id, part_col)
        tidy(spark, out_path, list(keys), SALE_ORDER)
    return write


def start_sale_detail_join(orders: DataFrame, details: DataFrame, out_path: str, checkpoint: str, bound: str = JOIN_LATE_BOUND,
                           shape: Callable[[DataFrame], DataFrame] | None = None, users_path: str | None = None, as_of=None,
                           keys=("order_detail_id",), partition: str = "processing_day",
                           trigger: str | None = None, available_now: bool = False) -> StreamingQuery:
    """``start_sale_detail`` over the inner join that ``sale_detail_stream`` makes, for large micro-batches.

    The engine's join puts every row of a micro-batch into its state store and takes it out again once the watermark has passed.
    Here a micro-batch is joined as it lies, with the rows that earlier ones left open, and only those rows stay open that a later
    one can still meet: within ``bound`` of the watermark, which is ``bound`` behind the slower side.  Rows that come after the
    watermark has passed them are dropped, as the engine does.  Open rows and the watermark are written beside the checkpoint, per
    micro-batch, so a replay finds those of its predecessor.  ``shape`` changes the pairs before users are looked up."""
    sides = _order_side(orders).unionByName(_line_side(details), allowMissingColumns=True)
    first = first_number(sides.sparkSession, out_path, checkpoint)
    write_sale = _sale_writer(out_path, checkpoint, first, users_path, as_of, keys, partition)
    time = F.coalesce("i_ts", "d_ts")       # a row has one side; rows without a time match nothing
    files = snapshots.Files(sides.sparkSession, checkpoint)
    open_rows, mark = lambda n: f"{checkpoint}/open/{n}", lambda n: f"{checkpoint}/watermarks/{n}"
    newest: dict[str, int] = {}         # greatest time of a side in this run, in ms: like the engine's, it starts anew with the run

    def back(spark: SparkSession, ms: int) -> int:
        return spark.sql(f"SELECT unix_millis(timestamp_millis({ms}) - INTERVAL {bound})").first()[0]

    def after(ms: int | None):
        return F.lit(True) if ms is None else time > F.timestamp_millis(F.lit(ms))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spark.conf.set("spark.sql.adaptive.enabled", "true")     # of the stream's own session; nothing is kept in state stores
        spark.conf.set("spark.sql.inMemoryColumnarStorage.compressed", "false")     # rows are read a few times only
        rows, watermark = batch.where(time.isNotNull()).withColumn("fresh", F.lit(True)), None
        if batch_id:
            watermark = json.loads(files.read(mark(batch_id - 1)))
            kept = spark.read.schema(batch.schema).parquet(open_rows(batch_id - 1))
            rows = rows.where(after(watermark)).unionByName(kept.withColumn("fresh", F.lit(False)))
        rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # first, so one pass fills the cache; the two sides of the join would wait for each other's blocks
            found = rows.where("fresh").agg(*[F.unix_millis(F.max(c)).alias(c) for c in ("i_ts", "d_ts")]).first().asDict()
            newest.update({c: max(ms, newest.get(c, ms)) for c, ms in found.items() if ms is not None})
            if len(newest) == 2:
                passed = back(spark, min(newest.values()))
                watermark = passed if watermark is None else max(watermark, passed)
            i = rows.where(F.col("i_ts").isNotNull()).select(*[c for c in rows.columns if c.startswith("i_")], F.col("fresh").alias("i_fresh"))
            d = rows.where(F.col("d_ts").isNotNull()).select(*[c for c in rows.columns if c.startswith("d_")], F.col("fresh").alias("d_fresh"))
            pairs = interval_join(i, d, "i_id", "d_order_id", "i_ts", "d_ts", bound, bound).where("i_fresh OR d_fresh")
            sale = merge_sale_detail(pairs)
            write_sale(shape(sale) if shape else sale, batch_id)
            still = rows.where(after(None if watermark is None else back(spark, watermark)))
            still.drop("fresh").hint("rebalance").write.mode("overwrite").parquet(open_rows(batch_id))
            files.delete(mark(batch_id))        # that of an attempt before
            files.create(mark(batch_id), json.dumps(watermark))
            for of in (open_rows, mark):
                files.delete(of(batch_id - 2))      # the engine replays the last micro-batch only
        finally:
            rows.unpersist()
    return _writer(sides, "sale_detail", checkpoint, trigger, available_now).foreachBatch(write).start()


def read_sale_detail(spark: SparkSession, path: str, keys=("order_detail_id",)) -> DataFrame:
    """Last write per document; within one micro-batch the latest creation time, then the larger price."""
    return read_keyed(spark, path, list(keys), SALE_ORDER)


# ---- coupon alerts --------------------------------------------------------------------

def coupon_alert_stream(events: DataFrame, window: str = ALERT_WINDOW, slide: str = ALERT_SLIDE,
                        min_users: int = ALERT_MIN_USERS, lateness: str = "1 minute") -> DataFrame:
    """Streaming alerts, each window judged once, when the watermark has passed its end.

    Two chained aggregations in append mode, both in the state store: events -> panes as wide as the slide (a count per
    device, pane, kind and key), and finished panes -> sliding windows (clicks, and the members as sets).  So a window sees
    every click that is not later than ``lateness``, whichever micro-batch brings it, nothing is read back from a table,
    and the watermark evicts panes and windows alike."""
    w_ms = interval_ms(window)
    ev = (events.select("mid", "uid", "evid", "itemid", "ts").withColumn("event_ts", F.timestamp_millis("ts"))
                .withWatermark("event_ts", lateness)
                .select("mid", "event_ts", F.explode(pane_entries()).alias("e")).where(F.col("e").isNotNull()))
    panes = (ev.groupBy("mid", F.window("event_ts", slide).alias("pane"), F.col("e.kind").alias("kind"), F.col("e.key").alias("key"))
               .agg(F.count(F.lit(1)).alias("n")))
    member = lambda kind: F.collect_set(F.when(F.col("kind") == kind, F.struct(F.col("key").alias("v"))))
    is_event = F.col("kind") == "evid"
    windows = (panes.groupBy("mid", F.window("pane", window, slide).alias("w"))
                    .agg(F.sum(F.when(is_event & (F.col("key") == EVID_CLICK), F.col("n")).otherwise(0)).alias("clicks"),
                         member("uid").alias("u"), member("item").alias("i"),
                         F.collect_list(F.when(is_event, F.struct(F.col("key").alias("evid"), "n"))).alias("e")))
    # a struct keeps null members through the collection
    values = lambda c: F.array_sort(F.transform(c, lambda s: s["v"]))
    kinds = F.array_sort(F.array_distinct(F.transform("e", lambda x: F.struct(x["evid"].alias("evid")))))
    total = lambda k: F.aggregate(F.filter("e", lambda x: x["evid"].eqNullSafe(k["evid"])), F.lit(0).cast("long"), lambda s, x: s + x["n"])
    counted = F.transform(kinds, lambda k: F.concat(F.coalesce(k["evid"], F.lit("null")), F.lit(":"), total(k).cast("string")))
    alerting = windows.where((F.col("clicks") == 0) & (F.size("u") >= min_users))
    return alert_rows(alerting.select("mid", F.unix_millis(F.col("w.start")).alias("wstart"), F.size("u").alias("n_uids"),
                                      values("u").alias("uids"), values("i").alias("item_ids"), counted.alias("events")), w_ms)


def start_coupon_alerts(events: DataFrame, alerts_path: str, checkpoint: str, window: str = ALERT_WINDOW, slide: str = ALERT_SLIDE,
                        min_users: int = ALERT_MIN_USERS, lateness: str = "1 minute",
                        trigger: str | None = None, available_now: bool = False) -> StreamingQuery:
    """The alerts of ``coupon_alert_stream`` as a keyed table by alert id, which names device and minute; the last window
    of a minute wins (``read_alerts``)."""
    first = first_number(events.sparkSession, alerts_path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        append(alerts_per_minute(batch), alerts_path, first + batch_id)
        tidy(batch.sparkSession, alerts_path, "alert_id", ALERT_ORDER)
    alerts = coupon_alert_stream(events, window, slide, min_users, lateness)
    return _writer(alerts, "coupon_alerts", checkpoint, trigger, available_now).outputMode("append").foreachBatch(write).start()


ALERT_ORDER = ["ts", "window_start"]


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """One alert per device-minute, the last that was raised."""
    return read_keyed(spark, path, "alert_id", ALERT_ORDER)


# ---- change-feed router ---------------------------------------------------------------

def start_change_router(cdc: DataFrame, out_path: str, checkpoint: str, routes=None, topics=None,
                        trigger: str | None = None, available_now: bool = False,
                        kafka_servers: str | None = None, table_pattern: str | None = None) -> StreamingQuery:
    """Route change entries to topics.  With ``kafka_servers`` the messages go
    to Kafka (``topic``/``value`` columns); otherwise to JSON files
    partitioned by topic."""
    from ..constants import ROUTES
    msgs = route_changes(cdc, routes or ROUTES, topics, table_pattern)
    if kafka_servers:
        w = (_writer(msgs.select("topic", "value"), "change_router", checkpoint, trigger, available_now)
             .format("kafka").option("kafka.bootstrap.servers", kafka_servers))
        return w.start()
    w = (_writer(msgs.select("topic", "value"), "change_router", checkpoint, trigger, available_now)
         .format("json").partitionBy("topic").option("path", out_path))
    return w.start()


def console_preview(df: DataFrame, name: str, num_rows: int = 10, checkpoint: str | None = None,
                    available_now: bool = False) -> StreamingQuery:
    """First rows of each micro-batch on the console."""
    w = (df.writeStream.queryName(name).format("console").option("numRows", num_rows)
           .option("truncate", "false").outputMode("append"))
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
