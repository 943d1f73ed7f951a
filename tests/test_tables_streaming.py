"""Keyed tables and streaming: idempotent upserts, batch == stream over
several micro-batches, replay convergence."""

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from cartwheel.operators import snapshots
from cartwheel.operators.upsert import append, compact, fill_missing_ids, read_keyed, stored, tidy
from cartwheel.plans import dau
from cartwheel.sources import fixtures as fx
from cartwheel.sources.topic import TopicSource
from cartwheel.streaming import jobs

from conftest import SF_SMALL


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


S = "id string, v string, ord long, day string"


def test_last_or_first_write_per_key_and_replay(spark, tmpdir_spark):
    p = f"{tmpdir_spark}/t"
    b1 = spark.createDataFrame([("1", "a", 1, "d1"), ("2", "b", 1, "d1"), ("3", "c", 9, "d2")], S)
    b2 = spark.createDataFrame([("1", "a2", 2, "d1"), ("2", "b0", 0, "d1"), ("2", "b1", -1, "d1")], S)
    append(b1, p, 0, "day")
    append(b2, p, 1, "day")
    last = [("1", "a2", 2, "d1"), ("2", "b0", 0, "d1"), ("3", "c", 9, "d2")]       # the last batch, whatever its order values
    read = lambda path=p, keep="last": _sorted(read_keyed(spark, path, "id", ["ord"], keep).select("id", "v", "ord", "day"))
    assert read() == last
    append(b2, p, 1, "day")          # replay: no change
    assert read() == last and stored(spark, p).count() == 6
    assert read(keep="first") == [("1", "a", 1, "d1"), ("2", "b", 1, "d1"), ("3", "c", 9, "d2")]
    append(b1.limit(0), p, 2, "day")
    before = stored(spark, p)
    assert compact(spark, p, "id", ["ord"], everything=True) == 1
    assert read() == last and stored(spark, p).count() == 3
    assert before.count() == 6                                                     # a reader from before still has its files


def test_live_folders_and_rewrites_grow_with_the_logarithm():
    from cartwheel.operators.upsert import FAN, _due
    s, n, moved, most = snapshots.Snapshot(0, None, []), 20_000, 0, 0
    for b in range(n):
        s.live.append(snapshots.Folder(f"b{b}", b, b))
        s.last = b
        while group := _due(s, FAN, False):
            moved += sum(f.high - f.low + 1 for f in group)
            s.live = [f for f in s.live if f not in group]
            s.live.append(snapshots.Folder(f"m{b}", group[0].low, group[-1].high, 1 + max(f.level for f in group)))
        most = max(most, len(s.live))
        if b == 1000:
            assert most <= 4 * FAN
    assert most <= 5 * FAN and moved <= 5 * n                                      # log_8 of 20,000 is 4.8
    assert sorted(x for f in s.live for x in range(f.low, f.high + 1)) == list(range(n))


def test_many_micro_batches_stay_few_files(spark, tmpdir_spark):
    p, n = f"{tmpdir_spark}/t", 30
    for b in range(n):
        append(spark.range(b, b + 3).select((F.col("id") % 40).cast("string").alias("id"), F.lit(b).cast("long").alias("v")), p, b)
        tidy(spark, p, "id", ["v"], fan=3, retain=0)                               # three levels
    s, files = snapshots.current(spark, p), snapshots.Files(spark, p)
    assert len(s.live) <= 3 * 3 and len(files.names(f"{p}/data")) <= len(s.live) + 3 and len(files.names(f"{p}/_snapshots")) <= 30
    assert max(f.level for f in s.live) == 3
    want = {str((b + i) % 40): b for b in range(n) for i in range(3)}
    assert {r.id: r.v for r in read_keyed(spark, p, "id", ["v"]).collect()} == want


def test_compaction_beside_a_writer_and_a_reader(spark, tmpdir_spark):
    import threading
    p, n = f"{tmpdir_spark}/t", 40
    row = lambda b: spark.createDataFrame([("k", b), (f"own{b}", b)], "id string, v long")
    append(row(0), p, 0)
    failed, done = [], threading.Event()

    def guarded(work):
        try:
            work()
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    def write():
        for b in range(1, n):
            append(row(b), p, b)
        done.set()

    def merge():
        while not done.is_set():
            compact(spark, p, "id", ["v"], fan=2)

    def read():
        last = 0
        while not done.is_set():
            now = {r.id: r.v for r in read_keyed(spark, p, "id", ["v"]).collect()}
            assert now["k"] >= last and len(now) == now["k"] + 2                    # whole micro-batches, never fewer than before
            last = now["k"]

    threads = [threading.Thread(target=guarded, args=(w,)) for w in (write, merge, read)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(240)
    assert not failed and done.is_set()
    assert {r.id: r.v for r in read_keyed(spark, p, "id", ["v"]).collect()} == {"k": n - 1, **{f"own{b}": b for b in range(n)}}


def test_snapshots_commit_once_and_expire(spark, tmpdir_spark):
    import pytest
    p = f"{tmpdir_spark}/t"
    for b in range(4):
        append(spark.createDataFrame([("k", b)], "id string, v long"), p, b)
    version = snapshots.current(spark, p).version
    assert not snapshots.Files(spark, p).create(f"{p}/_snapshots/{version:012d}.json", "{}")        # never overwritten
    assert compact(spark, p, "id", ["v"], everything=True) == 1
    assert read_keyed(spark, p, "id", ["v"], version=version).first().v == 3
    snapshots.Files(spark, p).fs.mkdirs(snapshots.Files(spark, p).path(f"{p}/data/folder=failed"))   # of a write that failed
    assert snapshots.expire(spark, p, 3600) == 0 and stored(spark, p, version).count() == 4
    assert snapshots.expire(spark, p, -1) == 4
    assert [r.v for r in read_keyed(spark, p, "id", ["v"]).collect()] == [3]
    with pytest.raises(RuntimeError):
        snapshots.current(spark, p, 999)


def test_columns_may_be_added_but_not_change_their_type(spark, tmpdir_spark):
    import pytest
    p = f"{tmpdir_spark}/t"
    append(spark.createDataFrame([("1", 1)], "id string, v long"), p, 0)
    append(spark.createDataFrame([("2", 2, "x")], "id string, v long, w string"), p, 1)
    assert _sorted(read_keyed(spark, p, "id").select("id", "v", F.coalesce("w", F.lit("-")))) == [("1", 1, "-"), ("2", 2, "x")]
    with pytest.raises(ValueError):
        append(spark.createDataFrame([("3", "3")], "id string, v string"), p, 2)


def test_users_without_id_are_kept_aside(spark, tmpdir_spark):
    cols = "id string, login_name string, user_level string, birthday string, gender string, ts long, seq long"
    src, out = f"{tmpdir_spark}/src", f"{tmpdir_spark}/users"
    spark.createDataFrame([("1", "a", "1", None, "M", 1, 1), ("1", "b", "1", None, "M", 2, 2), (None, "x", "1", None, "F", 1, 3),
                           (None, "y", "1", None, "F", 1, 4)], cols).coalesce(1).write.parquet(src)
    jobs.start_user_dimension(TopicSource("parquet", path=src).stream(spark), out, f"{tmpdir_spark}/ck", available_now=True).awaitTermination()
    assert [(r.id, r.login_name) for r in jobs.read_users(spark, out).collect()] == [("1", "b")]
    assert _sorted(stored(spark, f"{out}_rejected").select("login_name")) == [("x",), ("y",)]


def test_a_replayed_batch_looks_up_the_same_users(spark, tmpdir_spark):
    p, ck = f"{tmpdir_spark}/users", f"{tmpdir_spark}/ck"
    assert jobs.version_for_batch(spark, p, ck, 0) is None
    user = lambda level: spark.createDataFrame([("u", level, 1, 1)], "id string, user_level string, ts long, seq long")
    append(user("old"), p, 0)
    version = jobs.version_for_batch(spark, p, ck, 0)
    append(user("new"), p, 1)
    assert jobs.version_for_batch(spark, p, ck, 0) == version != jobs.version_for_batch(spark, p, ck, 1)
    assert jobs.read_users(spark, p, version=version).first().user_level == "old"
    assert jobs.read_users(spark, p).first().user_level == "new"


def test_failed_write_keeps_every_stored_row(spark, tmpdir_spark):
    import pytest
    p = f"{tmpdir_spark}/t"
    append(spark.createDataFrame([("1", "a", 1, "d1"), ("2", "b", 1, "d1")], S), p, 0)
    broken = spark.range(4).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") == 3, F.raise_error(F.lit("stop")))
                                   .otherwise("x").cast("string").alias("v"), F.col("id").alias("ord"), F.lit("d1").alias("day"))
    reader = read_keyed(spark, p, "id", ["ord"])
    with pytest.raises(Exception, match="stop"):
        append(broken, p, 1)
    assert {r.id: r.v for r in read_keyed(spark, p, "id", ["ord"]).collect()} == {"1": "a", "2": "b"}
    append(spark.createDataFrame([("2", "b2", 0, "d1")], S), p, 1)      # the retry; a reader planned before still finds its files
    assert {r.id: r.v for r in reader.collect()} == {"1": "a", "2": "b"}
    assert {r.id: r.v for r in read_keyed(spark, p, "id", ["ord"]).collect()} == {"1": "a", "2": "b2"}


def test_missing_and_damaged_tables_differ(spark, tmpdir_spark):
    import pytest
    assert stored(spark, f"{tmpdir_spark}/nowhere") is None and read_keyed(spark, f"{tmpdir_spark}/nowhere", "id") is None
    os.makedirs(f"{tmpdir_spark}/empty")
    with pytest.raises(RuntimeError):
        stored(spark, f"{tmpdir_spark}/empty")


def test_sale_documents_without_id_stay_and_the_last_write_wins(spark, tmpdir_spark):
    cols = "order_detail_id string, order_id string, order_status string, create_time string, user_id string, sku_id string, sku_price double, sku_name string, dt string"
    src, out = f"{tmpdir_spark}/src", f"{tmpdir_spark}/sale"
    row = lambda i, price: (i, "o", "1", "2024-01-01 00:00:00", "u", "s", price, "n", "2024-01-01")
    run = lambda: jobs.start_sale_detail(TopicSource("parquet", path=src).stream(spark), out, f"{tmpdir_spark}/ck",
                                         available_now=True).awaitTermination()
    spark.createDataFrame([row("1", 9.0), row(None, 5.0), row(None, 5.0)], cols).coalesce(1).write.parquet(src)
    run()
    spark.createDataFrame([row("1", 2.0)], cols).coalesce(1).write.mode("append").parquet(src)
    run()
    got = jobs.read_sale_detail(spark, out).collect()
    assert sorted(r.sku_price for r in got) == [2.0, 5.0, 5.0]


def test_a_click_in_a_later_micro_batch_stops_an_alert(spark, tmpdir_spark):
    from cartwheel.plans.alerts import stored_alerts
    cols = "mid string, uid string, evid string, itemid string, ts long"
    t0 = 1_700_000_000_000 // 300_000 * 300_000 + 57_000
    first = [(mid, f"u{i}", "coupon", "i", t0 + i) for mid in ("m", None) for i in range(3)] + [("m", None, "coupon", None, t0 + 7_000)]
    click = [(mid, "u9", "clickItem", "i", t0 + 20_000) for mid in ("m", None)]
    late = [("m", "u9", "clickItem", "i", t0)]                               # behind the watermark by then: left out
    closing = [("close", "u", "view", "i", t0 + 10 ** 9)]
    for part in (first, click, closing, late + [("close", "u", "view", "i", t0 + 2 * 10 ** 9)]):
        spark.createDataFrame(part, cols).coalesce(1).write.mode("append").parquet(f"{tmpdir_spark}/src")
        jobs.start_coupon_alerts(TopicSource("parquet", path=f"{tmpdir_spark}/src").stream(spark), f"{tmpdir_spark}/alerts",
                                 f"{tmpdir_spark}/ck", "5 minutes", "5 seconds", available_now=True).awaitTermination()
        if part is first:
            assert jobs.read_alerts(spark, f"{tmpdir_spark}/alerts") is None or not jobs.read_alerts(spark, f"{tmpdir_spark}/alerts").count()
    batch = stored_alerts(spark.createDataFrame(first + click, cols), "5 minutes", "5 seconds")
    got = jobs.read_alerts(spark, f"{tmpdir_spark}/alerts").select(*batch.columns)
    assert _sorted(got) == _sorted(batch) and 0 < batch.count() < stored_alerts(spark.createDataFrame(first, cols), "5 minutes", "5 seconds").count()


def test_null_ids_get_deterministic_ids(spark):
    df = spark.createDataFrame([(None, "x"), (None, "y"), ("k", "z")], "id string, v string")
    a = _sorted(fill_missing_ids(df, "id"))
    b = _sorted(fill_missing_ids(df, "id"))
    assert a == b and len({r[0] for r in a}) == 3


def _split_events(spark, folder, parts=3):
    """Write the events table as several files, one per micro-batch."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for i in range(parts):
        ev.where(F.col("event_id") % parts == i).coalesce(1).write.mode("append").parquet(folder)
    return ev.schema


def test_stream_dau_equals_batch_keys(spark, tmpdir_spark):
    src_dir = f"{tmpdir_spark}/events_split"
    schema = _split_events(spark, src_dir)
    stream = TopicSource("parquet", path=src_dir, schema=schema, options={"maxFilesPerTrigger": "1"}).stream(spark)
    out, ck = f"{tmpdir_spark}/dau", f"{tmpdir_spark}/ck"
    q = jobs.start_dau(fx.startup_from_events(stream), out, ck, seen_path=f"{tmpdir_spark}/seen",
                       available_now=True)
    q.awaitTermination()
    assert len(q.recentProgress) >= 3
    batch = dau.daily_active(fx.startup_log(spark, SF_SMALL))
    got = jobs.read_dau(spark, out)
    assert _sorted(got.select("log_date", "mid")) == _sorted(batch.select("log_date", "mid"))
    assert got.count() == batch.count()
    # replay the same input with a fresh checkpoint: the table does not change
    q2 = jobs.start_dau(fx.startup_from_events(
        TopicSource("parquet", path=src_dir, schema=schema).stream(spark)), out, f"{tmpdir_spark}/ck2",
        available_now=True)
    q2.awaitTermination()
    assert _sorted(jobs.read_dau(spark, out).select("log_date", "mid", "ts")) == \
        _sorted(got.select("log_date", "mid", "ts"))


def test_stream_dedup_within_watermark(spark, tmpdir_spark):
    src_dir = f"{tmpdir_spark}/events_split"
    schema = _split_events(spark, src_dir)
    stream = TopicSource("parquet", path=src_dir, schema=schema, options={"maxFilesPerTrigger": "1"}).stream(spark)
    name = "dedup_" + uuid.uuid4().hex[:8]
    q = (jobs.dau_stream_dedup(fx.startup_from_events(stream), "60 days")
         .writeStream.format("memory").queryName(name)
         .option("checkpointLocation", f"{tmpdir_spark}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    batch = dau.daily_active(fx.startup_log(spark, SF_SMALL))
    assert _sorted(spark.table(name).select("log_date", "mid")) == _sorted(batch.select("log_date", "mid"))


def test_json_topic_source_and_router(spark, tmpdir_spark):
    folder = f"{tmpdir_spark}/json_in"
    os.makedirs(folder)
    with open(f"{folder}/part-0.json", "w") as f:
        f.write('{"mid":"m1","uid":"u1","ts":"1704067200000"}\n{"mid":"m1","uid":"u2","ts":"1704067200005"}\n')
    from cartwheel.functions.jsonfns import decode
    from cartwheel.schemas import STARTUP_CASTS, STARTUP_FIELDS
    src = TopicSource("json", path=folder).stream(spark)
    rows = decode(src, STARTUP_FIELDS, STARTUP_CASTS)
    out = f"{tmpdir_spark}/dau"
    jobs.start_dau(rows, out, f"{tmpdir_spark}/ck", available_now=True).awaitTermination()
    r = jobs.read_dau(spark, out).collect()
    assert len(r) == 1 and r[0].uid == "u1"
    # change router to topic folders
    cdc_in = f"{tmpdir_spark}/cdc_in"
    fx.cdc(spark, SF_SMALL).write.parquet(cdc_in)
    cdc_stream = TopicSource("parquet", path=cdc_in).stream(spark)
    topics = f"{tmpdir_spark}/topics"
    jobs.start_change_router(cdc_stream, topics, f"{tmpdir_spark}/ck_cdc", available_now=True).awaitTermination()
    got = spark.read.json(topics).groupBy("topic").count().collect()
    assert {r.topic for r in got} == {"order", "order_detail", "user_info"}


def test_single_document_insert_and_rejected_rows(spark, tmpdir_spark):
    from cartwheel.operators.upsert import split_rejected
    p = f"{tmpdir_spark}/docs"
    doc = spark.createDataFrame([("1001", "Movie A", 1)], "id string, movie_name string, v long")
    append(doc, p, 0)                                                                  # one document with an explicit id
    append(doc.selectExpr("id", "'Movie B' AS movie_name", "CAST(0 AS LONG) AS v"), p, 1)   # same id replaces
    assert [(r.id, r.movie_name) for r in read_keyed(spark, p, "id").collect()] == [("1001", "Movie B")]
    rows = spark.createDataFrame([("a", "x"), (None, "y")], "mid string, day string")
    ok, bad = split_rejected(rows, ["mid", "day"])
    assert ok.count() == 1 and bad.first()._reason == "missing key: mid,day"


def test_console_preview_and_observed_counts(spark, tmpdir_spark):
    from cartwheel.operators.metrics import observe_count, observe_stream_count
    src = TopicSource("parquet", path=SF_SMALL, glob="region.parquet").stream(spark)
    q = jobs.console_preview(observe_stream_count(src, "regions"), "preview_" + uuid.uuid4().hex[:6],
                             checkpoint=f"{tmpdir_spark}/ck", available_now=True)
    q.awaitTermination()
    assert q.lastProgress["observedMetrics"]["regions"]["regions"] == 5
    df, obs = observe_count(spark.read.parquet(f"{SF_SMALL}/nation.parquet"), "nations")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["nations"] == 25


def test_stream_interval_join_equals_batch_over_time_ordered_batches(spark, tmpdir_spark):
    from cartwheel.plans import orders as orders_plan
    from cartwheel.sources.tables import read_table
    o_dir, l_dir = f"{tmpdir_spark}/orders_y", f"{tmpdir_spark}/lines_y"
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    years = sorted(r[0] for r in o.select(F.year("o_orderdate")).distinct().collect())
    for y in years:      # one file per year and table, written in event-time order
        o.where(F.year("o_orderdate") == y).coalesce(1).write.mode("append").parquet(o_dir)
        li.where(F.year("l_shipdate") == y).coalesce(1).write.mode("append").parquet(l_dir)
    li.where(F.year("l_shipdate") > years[-1]).coalesce(1).write.mode("append").parquet(l_dir)
    part = read_table(spark, SF_SMALL, "part", ["p_partkey", "p_name"])
    os_ = TopicSource("parquet", path=o_dir, schema=o.schema, options={"maxFilesPerTrigger": "1"}).stream(spark)
    ls_ = TopicSource("parquet", path=l_dir, schema=li.schema, options={"maxFilesPerTrigger": "1"}).stream(spark)
    sale = jobs.sale_detail_stream(fx.order_info_from_orders(os_), fx.order_detail_from_lineitem(ls_, part),
                                   "10 days")
    name = "sale_" + uuid.uuid4().hex[:6]
    q = (sale.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{tmpdir_spark}/ck")
             .trigger(availableNow=True).start())
    q.awaitTermination()
    assert len(q.recentProgress) >= 3
    batch = orders_plan.sale_detail_interval(fx.order_info(spark, SF_SMALL), fx.order_detail(spark, SF_SMALL),
                                             "10 days")
    assert _sorted(spark.table(name)) == _sorted(batch)


def test_sale_detail_join_gives_what_the_state_join_gives_and_keeps_few_rows(spark, tmpdir_spark):
    o_cols = "id string, user_id string, order_status string, create_time string, create_date string, event_ts timestamp"
    d_cols = "id string, order_id string, sku_id string, sku_name string, order_price string, event_ts timestamp"
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    day = lambda n: None if n is None else start + dt.timedelta(days=n)
    order = lambda key, n: (key, "u", "1", "t", "2024-01-01", day(n))
    line = lambda no, key, n: (no, key, "s", None, "2.5", day(n))
    slices = [     # bound 10 days
        ([order("none", None), *[order(f"x{i}", i % 30) for i in range(300)], order("a", 25), order("b", 29), order(None, 29)], []),
        ([order("y", 29)], [line("a1", "a", 28), line("a2", "a", 36), line("x", "x0", 0), line("n", None, 29), line("far", "a", 15), line("none", "a", None)]),
        ([order("c", 60), order("c", 60), order("late", 5)],
         [line("b1", "b", 39), line("b1", "b", 39), line("late", "x1", 1), line("c1", "c", 50), line("c2", "c", 70), line("c3", "c", 71)]),
        ([order("d", 90)], [line("c4", "c", 65), line("d1", "d", 100)]),
        ([order("e", 130)], [line("d2", "d", 95), line("e1", "e", 130)])]
    o_dir, d_dir, run = f"{tmpdir_spark}/o", f"{tmpdir_spark}/d", {}

    def engine(o, d):
        return jobs.start_sale_detail(jobs.sale_detail_stream(o, d, "10 days"), f"{tmpdir_spark}/engine", f"{tmpdir_spark}/ck_engine", available_now=True)

    def batches(o, d):
        return jobs.start_sale_detail_join(o, d, f"{tmpdir_spark}/batches", f"{tmpdir_spark}/ck_batches", "10 days", available_now=True)

    def go(job):
        o = TopicSource("parquet", path=o_dir, schema=spark.createDataFrame([], o_cols).schema).stream(spark)
        d = TopicSource("parquet", path=d_dir, schema=spark.createDataFrame([], d_cols).schema).stream(spark)
        run[job.__name__] = job(o, d)
        run[job.__name__].awaitTermination()

    for orders, lines in slices:
        spark.createDataFrame(orders, o_cols).coalesce(1).write.mode("append").parquet(o_dir)
        spark.createDataFrame(lines, d_cols).coalesce(1).write.mode("append").parquet(d_dir)
        go(engine)
        go(batches)
        assert not run["batches"].lastProgress["stateOperators"]
    rows = lambda name: sorted((r.order_detail_id, r.order_id) for r in stored(spark, f"{tmpdir_spark}/{name}").collect())
    assert rows("batches") == rows("engine")
    # "late" and its order came behind the watermark; c3 is 11 days from its order, a2 11 days
    assert [r[0] for r in rows("batches")] == ["a1", "b1", "b1", "c1", "c1", "c2", "c2", "c4", "c4", "d1", "d2", "e1", "far", "x"]
    folders = os.listdir(f"{tmpdir_spark}/ck_batches/open")
    assert len(folders) == 2
    left = spark.read.parquet(f"{tmpdir_spark}/ck_batches/open/{max(int(f) for f in folders)}")
    assert left.count() < 8
    # the last micro-batch is run again: nothing is doubled or lost
    before = rows("batches")
    last = max(int(n) for n in os.listdir(f"{tmpdir_spark}/ck_batches/commits") if n.isdigit())
    for name in os.listdir(f"{tmpdir_spark}/ck_batches/commits"):
        if name.lstrip(".").split(".")[0] == str(last):
            os.remove(f"{tmpdir_spark}/ck_batches/commits/{name}")
    go(batches)
    assert rows("batches") == before


def test_processing_time_ttl_join_matches_across_batches(spark, tmpdir_spark):
    from cartwheel.streaming.ttl_join import rocksdb, ttl_sale_detail_stream
    o_dir, l_dir = f"{tmpdir_spark}/o", f"{tmpdir_spark}/l"
    # lines arrive first (batch 1), their orders later (batch 2); one order never arrives
    lines = spark.createDataFrame([("1-1", "1", "10", "ring", "2.5"), ("1-2", "1", "11", "bolt", "3.0"),
                                   ("9-1", "9", "12", "rod", "1.0")],
                                  "id string, order_id string, sku_id string, sku_name string, order_price string")
    orders = spark.createDataFrame([("1", "u1", "O", "2024-01-01 05:00:00", "2024-01-01")],
                                   "id string, user_id string, order_status string, create_time string, "
                                   "create_date string")
    lines.coalesce(1).write.parquet(l_dir)
    spark.createDataFrame([], orders.schema).coalesce(1).write.parquet(o_dir)   # empty first file
    orders.coalesce(1).write.mode("append").parquet(o_dir)
    spark.createDataFrame([], lines.schema).coalesce(1).write.mode("append").parquet(l_dir)
    os_ = TopicSource("parquet", path=o_dir, schema=orders.schema, options={"maxFilesPerTrigger": "1"}).stream(spark)
    ls_ = TopicSource("parquet", path=l_dir, schema=lines.schema, options={"maxFilesPerTrigger": "1"}).stream(spark)
    name = "ttl_" + uuid.uuid4().hex[:6]
    # processing-time TTL keeps expiry batches running: drive it, then stop
    with rocksdb(spark):
        q = (ttl_sale_detail_stream(os_, ls_, 60_000).writeStream.format("memory").queryName(name)
             .option("checkpointLocation", f"{tmpdir_spark}/ck").trigger(processingTime="1 second").start())
    import time
    try:    # bounded wait: poll the sink instead of waiting for the query to go idle
        t0 = time.time()
        while time.time() - t0 < 90 and spark.table(name).count() < 2:
            time.sleep(2)
    finally:
        q.stop()
    got = sorted((r.order_detail_id, r.order_id, r.sku_price, r.dt) for r in spark.table(name).collect())
    assert got == [("1-1", "1", 2.5, "2024-01-01"), ("1-2", "1", 3.0, "2024-01-01")]


def test_ttl_join_takes_versions_by_arrival_and_spreads_a_hot_order(spark, tmpdir_spark):
    import time

    from cartwheel.streaming.ttl_join import PROVIDER, rocksdb, ttl_sale_detail_stream
    o_dir, l_dir = f"{tmpdir_spark}/o", f"{tmpdir_spark}/l"
    order = "id string, user_id string, order_status string, create_time string, create_date string, offset long"
    versions = [("hot", "u", s, "t", "d", n) for s, n in (("second", 2), ("first", 1), ("third", 3))] + [("x", "u", "only", "t", "d", 1)]
    spark.createDataFrame(versions, order).repartition(2).write.parquet(o_dir)
    lines = spark.range(2500).select(F.col("id").cast("string").alias("id"), F.lit("hot").alias("order_id"), F.lit("s").alias("sku_id"),
                                     F.lit("n").alias("sku_name"), F.lit("1.5").alias("order_price"))
    lines.write.parquet(l_dir)
    before, name = spark.conf.get(PROVIDER, None), "ttl_" + uuid.uuid4().hex[:6]
    sale = ttl_sale_detail_stream(TopicSource("parquet", path=o_dir).stream(spark), TopicSource("parquet", path=l_dir).stream(spark),
                                  600_000, salts=4, arrival="offset")
    assert "salt" in sale._jdf.queryExecution().logical().toString()
    with rocksdb(spark):
        q = (sale.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{tmpdir_spark}/ck")
                 .trigger(processingTime="1 second").start())
    assert spark.conf.get(PROVIDER, None) == before
    try:
        t0 = time.time()
        while time.time() - t0 < 90 and spark.table(name).count() < 2500:
            time.sleep(2)
    finally:
        q.stop()
    got = spark.table(name)
    assert got.count() == got.select("order_detail_id").distinct().count() == 2500
    assert {r.order_status for r in got.select("order_status").distinct().collect()} == {"third"}


def test_ttl_join_state_is_kept_by_buckets_of_orders(spark, tmpdir_spark, monkeypatch):
    """3000 orders in three micro-batches: the state has an entry per bucket and micro-batch, not per order.  Each line comes out
    once, in the version that was the latest when it met its order; lines beyond what a group may hold go through the state."""
    import time

    from cartwheel.streaming import ttl_join
    monkeypatch.setattr(ttl_join, "BUCKETS", 8)
    monkeypatch.setattr(ttl_join, "CHUNK", 100)
    monkeypatch.setattr(ttl_join, "PIECE", 150)
    o_dir, l_dir, name = f"{tmpdir_spark}/o", f"{tmpdir_spark}/l", "ttl_" + uuid.uuid4().hex[:6]
    order = lambda a, b, status, n: spark.range(a, b).select(
        F.col("id").cast("string").alias("id"), F.lit("u").alias("user_id"), F.lit(status).alias("order_status"),
        F.lit("t").alias("create_time"), F.lit("d").alias("create_date"), F.lit(n).cast("long").alias("offset"))
    line = lambda a, b, kind: spark.range(a, b).select(
        F.concat(F.lit(kind), F.col("id")).alias("id"), F.col("id").cast("string").alias("order_id"), F.lit("s").alias("sku_id"),
        F.lit("n").alias("sku_name"), F.lit("1.5").alias("order_price"))
    steps = [(None, line(0, 3500, "a")),                                              # wait
             (order(0, 3000, "one", 5), line(0, 3000, "b")),
             (order(0, 1000, "two", 6).unionByName(order(1000, 2000, "old", 4)), line(0, 3000, "c"))]
    order(0, 0, "", 0).write.parquet(o_dir)
    line(0, 0, "").write.parquet(l_dir)
    sale = ttl_join.ttl_sale_detail_stream(TopicSource("parquet", path=o_dir).stream(spark), TopicSource("parquet", path=l_dir).stream(spark),
                                           600_000, salts=1, arrival="offset")
    with ttl_join.rocksdb(spark):
        q = (sale.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{tmpdir_spark}/ck")
                 .trigger(processingTime="2 seconds").start())
    entries, done, seen = 0, 0, {}
    try:
        for orders, lines in steps:
            both = [(o_dir, orders.coalesce(1))] if orders is not None else []
            for place, rows in [*both, (l_dir, lines.coalesce(1))]:
                done += rows.count()
                rows.write.mode("append").parquet(place)
                t0 = time.time()
                while time.time() - t0 < 90 and sum(seen.values()) < done:
                    time.sleep(0.5)
                    for p in q.recentProgress:
                        seen[p["batchId"]] = p["numInputRows"]
                        entries = max(entries, p["stateOperators"][0]["numRowsTotal"])
    finally:
        q.stop()
    want = {**{f"a{i}": "one" for i in range(3000)}, **{f"b{i}": "one" for i in range(3000)},
            **{f"c{i}": "two" if i < 1000 else "one" for i in range(3000)}}
    got = [(r.order_detail_id, r.order_status) for r in spark.table(name).collect()]
    assert len(got) == len(want) and dict(got) == want
    assert 0 < entries < 500


def test_stream_dau_resumes_from_checkpoint(spark, tmpdir_spark):
    """A stopped job restarted on the same checkpoint continues where it left
    off; the keyed table ends equal to the batch result."""
    src_dir = f"{tmpdir_spark}/events_parts"
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.where(F.col("event_id") % 3 == 0).coalesce(1).write.parquet(src_dir)
    out, ck = f"{tmpdir_spark}/dau", f"{tmpdir_spark}/ck"
    run = lambda: jobs.start_dau(fx.startup_from_events(
        TopicSource("parquet", path=src_dir, schema=ev.schema).stream(spark)), out, ck, available_now=True)
    run().awaitTermination()
    first = jobs.read_dau(spark, out).count()
    for i in (1, 2):     # more data arrives while the job is down
        ev.where(F.col("event_id") % 3 == i).coalesce(1).write.mode("append").parquet(src_dir)
    run().awaitTermination()
    batch = dau.daily_active(fx.startup_log(spark, SF_SMALL))
    got = jobs.read_dau(spark, out)
    assert first < got.count() == batch.count()
    assert _sorted(got.select("log_date", "mid")) == _sorted(batch.select("log_date", "mid"))


def test_stream_alerts_over_time_ordered_batches_equal_batch(spark, tmpdir_spark):
    from cartwheel.operators.windows import coupon_alerts
    src_dir = f"{tmpdir_spark}/ev_days"
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    day = F.dayofmonth("ts")
    for lo, hi in ((1, 10), (11, 20), (21, 31)):     # three micro-batches in event-time order
        ev.where((day >= lo) & (day <= hi)).coalesce(1).write.mode("append").parquet(src_dir)
    closing = ev.limit(1).withColumns({"event_type": F.lit("close"), "ts": F.col("ts") + F.expr("interval 400 days")}).select(*ev.columns)
    closing.coalesce(1).write.mode("append").parquet(src_dir)
    stream = TopicSource("parquet", path=src_dir, schema=ev.schema, options={"maxFilesPerTrigger": "1"}).stream(spark)
    alerts = f"{tmpdir_spark}/alerts"
    q = jobs.start_coupon_alerts(fx.event_log_from_events(stream), alerts, f"{tmpdir_spark}/ck", "1 hour", "5 minutes", 2,
                                 available_now=True)
    q.awaitTermination()
    assert len(q.recentProgress) >= 4
    batch = coupon_alerts(fx.event_log(spark, SF_SMALL), "1 hour", "5 minutes", 2)
    cols = ["alert_id", "mid", "window_start", "n_uids", "uids", "item_ids", "events"]
    assert batch.count() and _sorted(jobs.read_alerts(spark, alerts).select(*cols)) == _sorted(batch.select(*cols))
