"""Topic log, late rows at the side, zone-aware days, one-pass facets."""

from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import __spark_entry__ as E
from cartwheel.functions import timefns
from cartwheel.operators.upsert import append, stored
from cartwheel.plans import reports
from cartwheel.session import many_batches
from cartwheel.sources import log
from cartwheel.streaming import late
from conftest import SF_SMALL
from test_plans import plan


def messages(spark, topic, first, n):
    return spark.range(first, first + n).select(F.lit(topic).alias("topic"), F.col("id").cast("string").alias("key"),
                                                F.concat(F.lit("v"), "id").alias("value"), F.col("id").alias("at"))


def test_offsets_are_gapless_and_replays_repeat_nothing(spark, tmpdir_spark):
    p = f"{tmpdir_spark}/log"
    log.append_log(messages(spark, "a", 0, 250), p, 0, ["at"], partitions=2)
    log.append_log(messages(spark, "a", 250, 130).unionByName(messages(spark, "b", 0, 7)), p, 1, ["at"], partitions=2)
    log.append_log(messages(spark, "a", 0, 999), p, 1, ["at"], partitions=2)               # the same micro-batch again
    rows = log.batch_log(spark, p).collect()
    assert Counter(r.topic for r in rows) == {"a": 380, "b": 7}
    for where in {(r.topic, r.part) for r in rows}:
        mine = sorted((r.offset, int(r.key)) for r in rows if (r.topic, r.part) == where)
        assert [o for o, _ in mine] == list(range(len(mine))) and [k for _, k in mine] == sorted(k for _, k in mine)
    assert log.batch_log(spark, p, "b*").count() == 7 and log.batch_log(spark, f"{p}/none").count() == 0


def test_bounded_batches_restart_in_mid_log(spark, tmpdir_spark):
    p, out, ck = f"{tmpdir_spark}/log", f"{tmpdir_spark}/out", f"{tmpdir_spark}/ck"
    log.append_log(messages(spark, "shop.x", 0, 330), p, 0, ["at"], partitions=2)
    log.append_log(messages(spark, "other", 0, 50), p, 1, ["at"], partitions=2)

    def run(lost_at=None):
        def write(batch, n):
            append(batch, out, n)
            if n == lost_at:
                raise RuntimeError("lost")
        q = log.read_log(spark, p, "shop.*").writeStream.option("checkpointLocation", ck).trigger(availableNow=True).foreachBatch(write).start()
        q.awaitTermination()

    with pytest.raises(StreamingQueryException):
        run(lost_at=2)
    run()
    log.append_log(messages(spark, "shop.x", 330, 20), p, 2, ["at"], partitions=2)
    run()
    rows = stored(spark, out)
    assert max(r["count"] for r in rows.groupBy("batch_id").count().collect()) <= 100
    assert Counter(int(r.key) for r in rows.collect()) == Counter(range(350))
    # latest: only what comes after the first start
    seen = []
    latest = lambda: (log.read_log(spark, p, "shop.*", starting="latest", checkpoint=f"{tmpdir_spark}/ck2").writeStream
                      .option("checkpointLocation", f"{tmpdir_spark}/ck2").trigger(availableNow=True)
                      .foreachBatch(lambda b, n: seen.extend(int(r.key) for r in b.collect())).start().awaitTermination())
    latest()
    assert seen == []
    log.append_log(messages(spark, "shop.x", 350, 9), p, 3, ["at"], partitions=2)
    latest()
    assert sorted(seen) == list(range(350, 359))


def test_streams_of_a_group_read_a_partition_each(spark, tmpdir_spark):
    p = f"{tmpdir_spark}/log"
    log.append_log(messages(spark, "shop.x", 0, 450).unionByName(messages(spark, "other", 0, 9)), p, 0, ["at"], partitions=2)
    log.append_log(messages(spark, "shop.y", 0, 3), p, 1, ["at"], partitions=2)
    setting, before = "spark.sql.streaming.checkpointFileManagerClass", dict(spark.conf.getAll)
    batches = {part: [] for part in (0, 1, 2)}          # nothing lies in the last

    def run():
        with many_batches(spark, p):
            assert setting in spark.conf.getAll
            queries = [log.read_log(spark, p, "shop.*", part=part).writeStream.option("checkpointLocation", f"{tmpdir_spark}/ck{part}")
                       .trigger(availableNow=True).foreachBatch(lambda b, n, to=to: to.append(b.collect())).start() for part, to in batches.items()]
        assert setting not in before and dict(spark.conf.getAll) == before
        for q in queries:
            q.awaitTermination()

    run()
    log.append_log(messages(spark, "shop.x", 450, 50), p, 2, ["at"], partitions=2)
    run()
    assert not batches[2] and all({r.part for r in b} == {part} and len(b) <= 100 for part, found in batches.items() for b in found)
    rows = [r for found in batches.values() for b in found for r in b]
    assert Counter((r.topic, int(r.key)) for r in rows) == Counter([("shop.x", i) for i in range(500)] + [("shop.y", i) for i in range(3)])
    for part in (0, 1):         # in the order of the log
        offsets = [o for b in batches[part] for o in sorted(r.offset for r in b if r.topic == "shop.x")]
        assert offsets == list(range(len(offsets))) and len(offsets) > 200


def test_late_rows_go_to_the_side_once(spark, tmpdir_spark):
    p = f"{tmpdir_spark}/split"
    rows = lambda *xs: spark.createDataFrame([(i, None if t is None else f"2024-01-{t:02d} 00:00:00") for i, t in xs], "id int, t string").select(
        "id", F.col("t").cast("timestamp").alias("event_ts"))
    write = late.late_splitter(p, "event_ts", "2 days")
    write(rows((1, 1), (2, 10), (3, None)), 0)         # nothing is late before a mark stands; a row without a time always is
    write(rows((4, 8), (5, 7), (6, 12)), 1)
    write(rows((4, 8), (5, 7), (6, 12)), 1)
    write(rows((7, 9), (8, 10)), 2)
    write(rows(), 3)
    clean = spark.read.schema("id int, event_ts timestamp").option("recursiveFileLookup", "true").parquet(f"{p}/clean")
    assert sorted(r.id for r in clean.collect()) == [1, 2, 4, 6, 8]
    assert {r.id: str(r.behind) for r in late.late_rows(spark, p).collect()} == {3: "None", 5: "2024-01-08 00:00:00", 7: "2024-01-10 00:00:00"}


def test_outer_join_keeps_only_rows_near_the_watermark(spark, tmpdir_spark, monkeypatch):
    p, ck = tmpdir_spark, f"{tmpdir_spark}/ck"
    shape = {"l": "l_id string, l_ts timestamp", "r": "r_id string, r_of string, r_ts timestamp"}

    def feed(left, right):
        for side, rows in (("l", left), ("r", [(f"{k}{n}", k, n) for k, n in right])):
            made = spark.createDataFrame(rows, shape[side].replace("timestamp", "int"))
            made = made.withColumn(f"{side}_ts", F.timestamp_seconds(F.lit(1704067200) + F.col(f"{side}_ts") * 86400))
            made.coalesce(1).write.mode("append").parquet(f"{p}/{side}")
        sides = [spark.readStream.schema(shape[s]).parquet(f"{p}/{s}") for s in "lr"]
        late.start_outer_join(*sides, "l_id", "r_of", "l_ts", "r_ts", f"{p}/out", ck, "2 days", available_now=True).awaitTermination()

    def found():
        rows = stored(spark, f"{p}/out").collect()
        return Counter((r.l_id, r.r_id) for r in rows)

    def opened(n):
        return sorted((r.l_id or r.r_id, r._met) for r in spark.read.parquet(f"{ck}/open/{n}").collect())

    feed([("a", 1), ("a", 1), ("b", 10), (None, 2), ("e", 3)], [("a", 2), ("c", 9), (None, 9)])
    want = Counter({("a", "a2"): 2, (None, None): 1, ("e", None): 1})
    assert found() == want                                            # the watermark is day 7
    assert opened(0) == [("b", False), ("c9", False)]
    add = late.append

    def lost(batch, path, n):
        add(batch, path, n)
        raise RuntimeError("lost")
    monkeypatch.setattr(late, "append", lost)
    with pytest.raises(StreamingQueryException):                      # written, not noted: the next run writes it again
        feed([("c", 8), ("f", 7), ("g", 6)], [("b", 12), ("b", 8), ("a", 3)])
    monkeypatch.setattr(late, "append", add)
    feed([], [])
    want += Counter({("c", "c9"): 1, ("b", "b12"): 1, ("b", "b8"): 1})
    assert found() == want                                            # a3 and g are behind; f, on the watermark, is not
    assert opened(1) == [("b", True), ("b12", False), ("b8", False), ("c", True), ("c9", False), ("f", False)]
    feed([("d", 8), ("z", 40)], [("y", 40)])
    want += Counter({("d", None): 1, ("f", None): 1})
    n = max(int(x) for x, _ in late.Files(spark, ck).names(f"{ck}/open") if x.isdigit())
    assert found() == want and opened(n) == [("y40", False), ("z", False)]
    assert late.Files(spark, ck).names(f"{ck}/state") is None


def test_late_rows_query_keeps_no_state_of_its_rows(spark, monkeypatch):
    from cartwheel.streaming import register
    runs, path = [], register.run_path
    monkeypatch.setattr(register, "run_path", lambda s, name: runs.append(path(s, name)) or runs[-1])
    assert E.queries()["stream_late_rows"](spark, SF_SMALL).where("kind = 'unmatched'").count() > 0
    files = late.Files(spark, runs[0])
    assert files.names(f"{runs[0]}/ckpt_join/offsets") and files.names(f"{runs[0]}/ckpt_join/state") is None


@pytest.mark.parametrize("date,zone,hours", [("2024-03-31", "Europe/Paris", 23), ("2024-10-27", "Europe/Paris", 25), ("2024-05-05", "Europe/Paris", 24),
                                             ("2024-03-10", "America/New_York", 23), ("2024-01-15", "Asia/Shanghai", 24)])
def test_days_of_a_zone(spark, date, zone, hours):
    every = spark.range(-4, 60).select(F.expr(f"timestamp_ntz'{date} 00:30:00' + make_interval(0, 0, 0, 0, cast(id as int) - 15)").alias("ts"))
    rows = timefns.within_days(every, "ts", date, date, zone)
    assert rows.count() == hours
    rows = timefns.with_log_date_hour(rows.select(timefns.epoch_ms("ts").alias("ts")), zone=zone).collect()
    assert {r.log_date for r in rows} == {date}
    assert len({r.log_hour for r in rows}) == min(24, hours)


def test_the_range_of_zone_days_reaches_the_scan(spark):
    p = plan(E.queries()["gmv_zone_days"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(o_orderdate,1996-04-05T05:00" in p and "LessThan(o_orderdate,1996-04-10T04:00" in p


def test_hours_off_the_axis_are_not_broadcast(spark):
    rows = spark.createDataFrame([("2024-01-02", h, 1.0) for h in ("00", "23", "24", "7", "x", None)], "create_date string, create_hour string, total_amount double")
    got = {r.hour: r.today for r in reports.gmv_hours_compare(rows, "2024-01-02").collect()}
    assert len(got) == 24 and sum(got.values()) == 2.0


def test_facets_plan_the_joins_once(spark):
    facets, page = (plan(E.queries()[q](spark, SF_SMALL)) for q in ("sale_search_facets", "sale_search_page"))
    scans = lambda p: p.split("\n\n")[0].count("Scan parquet")
    assert 0 < scans(facets) <= scans(page)


def test_a_commit_lists_no_earlier_versions(spark, tmpdir_spark, monkeypatch):
    from cartwheel.operators import snapshots, upsert
    path, listed = f"{tmpdir_spark}/t", []
    rows = spark.range(3).withColumn("v", F.lit("x"))
    upsert.append(rows, path, 0)
    names = snapshots.Files.names
    monkeypatch.setattr(snapshots.Files, "names", lambda self, p: listed.append(p) or names(self, p))
    for batch in range(1, 4):
        upsert.append(rows, path, batch, arranged=True)
    assert upsert.stored(spark, path).count() == 12 and snapshots.current(spark, path).version == 4
    assert not [p for p in listed if p.endswith("_snapshots")]
    snapshots._seen.clear()                                    # another process: the list is read, once
    assert snapshots.current(spark, path).version == 4 and len([p for p in listed if p.endswith("_snapshots")]) == 1
    with pytest.raises(RuntimeError, match="expired"):
        snapshots.current(spark, path, 9)


def test_merges_do_not_look_through_all_folders(spark, tmpdir_spark, monkeypatch):
    from cartwheel.operators import snapshots, upsert
    path, listed = f"{tmpdir_spark}/t", []
    names = snapshots.Files.names
    monkeypatch.setattr(snapshots.Files, "names", lambda self, p: listed.append(p) or names(self, p))
    with upsert.TidyBeside(spark, path, fan=2) as tidy:
        for batch in range(9):
            upsert.append(spark.range(3), path, batch, arranged=True)
            tidy()
    assert len([p for p in listed if p.endswith("/data")]) == 1       # one look within the hour, after many merges
    s = snapshots.current(spark, path)
    assert max(f.level for f in s.live) >= 2 and len(s.old) >= 6 and upsert.stored(spark, path).count() == 27
    snapshots.Files(spark, path).fs.mkdirs(snapshots.Files(spark, path).path(f"{path}/data/folder=failed"))
    assert snapshots.expire(spark, path, 0) == len(s.old) + 1         # a shorter time looks again
    assert upsert.stored(spark, path).count() == 27


def test_a_failed_merge_beside_a_writer_is_raised(spark, tmpdir_spark):
    from cartwheel.operators import snapshots, upsert
    path = f"{tmpdir_spark}/t"
    with pytest.raises(RuntimeError, match="not a keyed table"):
        with upsert.TidyBeside(spark, path) as tidy:
            snapshots.Files(spark, path).fs.mkdirs(snapshots.Files(spark, path).path(path))
            tidy()


def test_the_change_feed_is_lost_once_and_repeats_nothing(spark, monkeypatch):
    from cartwheel.streaming import register
    written, add = [], register.append
    monkeypatch.setattr(register, "append", lambda batch, path, n, **k: written.append((path, n, batch.count())) or add(batch, path, n, **k))

    rows = E.queries()["stream_change_feed"](spark, SF_SMALL).collect()
    places = Counter((path, n) for path, n, _ in written)
    assert max(places.values()) == 2 and all(m <= 100 for _, _, m in written)       # a micro-batch was written, lost and written again
    assert {r.topic for r in rows} == {"shop.supplier", "shop.nation"} and all(r.n_times == 1 for r in rows)
