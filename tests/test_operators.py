import math

from pyspark.sql import functions as F

from cartwheel.operators import cdc, dedup, search, windows
from cartwheel.operators.joins import interval_join
from cartwheel.plans import dau, orders, reports, users

STARTUP = "mid string, uid string, type string, ts long"


def _startup(spark, rows):
    from cartwheel.functions.timefns import with_log_date_hour
    return with_log_date_hour(spark.createDataFrame(rows, STARTUP))


DAY = 86_400_000
T0 = 1704067200000  # 2024-01-01T00:00Z


def test_dau_keeps_earliest_per_day_and_device(spark):
    rows = [("a", "u1", "s", T0 + 500), ("a", "u2", "s", T0 + 100),      # same day twice
            ("a", "u3", "s", T0 + DAY + 5),                              # next day
            ("b", "u9", "y", T0 + 7), ("b", "u8", "x", T0 + 7),          # equal ts: tie-break uid
            ("c", "u1", "s", T0 + DAY - 1), ("c", "u1", "s", T0 + DAY),  # 1 ms either side of midnight
            (None, "u0", "s", T0 + 3), (None, "u5", "s", T0 + 1)]        # null device is a key too
    got = {(r.log_date, r.mid): (r.uid, r.ts) for r in dau.daily_active(_startup(spark, rows)).collect()}
    assert got == {
        ("2024-01-01", "a"): ("u2", T0 + 100), ("2024-01-02", "a"): ("u3", T0 + DAY + 5),
        ("2024-01-01", "b"): ("u8", T0 + 7),
        ("2024-01-01", "c"): ("u1", T0 + DAY - 1), ("2024-01-02", "c"): ("u1", T0 + DAY),
        ("2024-01-01", None): ("u5", T0 + 1)}


def test_dau_new_against_seen_state(spark):
    seen = _startup(spark, [("a", "u", "s", T0), ("b", "u", "s", T0 + DAY)])
    batch = _startup(spark, [("a", "u", "s", T0 + 9), ("b", "u", "s", T0 + 9), ("b", "u", "s", T0 + 3)])
    got = sorted((r.log_date, r.mid, r.ts) for r in dau.daily_active_new(batch, seen).collect())
    assert got == [("2024-01-01", "b", T0 + 3)]   # b is only seen on day 2
    union = dau.seen_union(seen, dau.daily_active_new(batch, seen))
    assert union.count() == 3


def test_reports_empty_day(spark):
    d = _startup(spark, [("a", "u", "s", T0)])
    assert reports.dau_total(d, "2030-01-01").first().dau == 0
    o = spark.createDataFrame([("1", 10.0, "2024-01-01", "05")], "id string, total_amount double, "
                                                                   "create_date string, create_hour string")
    assert reports.gmv_total(o, "2030-01-01").first().sum_amount is None
    cmp = reports.gmv_hours_compare(o, "2024-01-02").orderBy("hour").collect()
    assert len(cmp) == 24 and cmp[5].yesterday == 10.0 and sum(r.today for r in cmp) == 0.0


def test_hours_compare_sums_match_totals(spark):
    rows = [(f"m{i}", "u", "s", T0 + i * 3_600_000 * 5) for i in range(10)]
    d = dau.daily_active(_startup(spark, rows))
    cmp = reports.dau_hours_compare(d, "2024-01-02").collect()
    assert sum(r.today for r in cmp) == reports.dau_total(d, "2024-01-02").first().dau
    assert sum(r.yesterday for r in cmp) == reports.dau_total(d, "2024-01-01").first().dau


def test_realtime_total_and_json(spark):
    d = dau.daily_active(_startup(spark, [("a", "u", "s", T0), ("a", "u", "s", T0 + DAY), ("b", "u", "s", T0 + DAY)]))
    o = spark.createDataFrame([("1", 10.5, "2024-01-02", "03")], "id string, total_amount double, "
                                                                  "create_date string, create_hour string")
    tot = {r.id: r.value for r in reports.realtime_total(d, o, "2024-01-02").collect()}
    assert tot == {"dau": 2.0, "new_mid": 1.0, "order_amount": 10.5}
    j = reports.realtime_hours_json("dau", d, o, "2024-01-02").first().json
    assert j == '{"yesterday":{"00":1.0},"today":{"00":2.0}}'
    j2 = reports.realtime_hours_json("order_amount", d, o, "2024-01-02").first().json
    assert j2 == '{"yesterday":{},"today":{"03":10.5}}'


def test_stage_counts(spark):
    rows = [("a", "u", "s", T0 + 1), ("a", "u", "s", T0 + 13 * 3_600_000), ("b", "u", "s", T0 + 14 * 3_600_000)]
    got = {r.stage: r.n for r in dau.stage_counts(_startup(spark, rows)).collect()}
    assert got == {"input": 3, "after_batch_dedup": 2, "after_state_filter": 1}


def _env(table, entry, event, rows):
    return (table, entry, event, [([(n, v) for n, v in r],) for r in rows])


CDC_SCHEMA = ("table string, entry_type string, event_type string, "
              "rows array<struct<after:array<struct<name:string,value:string>>>>")


def test_cdc_routing_matrix(spark):
    data = [
        _env("order_info", "ROWDATA", "INSERT", [[("id", "1")]]),
        _env("order_info", "ROWDATA", "UPDATE", [[("id", "2")]]),           # dropped
        _env("order_info", "TRANSACTIONBEGIN", "INSERT", [[("id", "3")]]),  # not row data
        _env("order_detail", "ROWDATA", "INSERT", [[("id", "4")], [("id", "5")]]),  # multi-row entry
        _env("order_detail", "ROWDATA", "DELETE", [[("id", "6")]]),
        _env("user_info", "ROWDATA", "UPDATE", [[("id", "7"), ("id", "8"), ("name", None)]]),
        _env("user_info", "ROWDATA", "DELETE", [[("id", "9")]]),
        _env("payment", "ROWDATA", "INSERT", [[("id", "10")]]),             # unknown table
    ]
    msgs = cdc.route_changes(spark.createDataFrame(data, CDC_SCHEMA)).collect()
    got = sorted((m.topic, m.value) for m in msgs)
    assert got == [("order", '{"id":"1"}'), ("order_detail", '{"id":"4"}'), ("order_detail", '{"id":"5"}'),
                   ("user_info", '{"id":"8","name":null}')]


def test_route_custom_topics(spark):
    df = spark.createDataFrame([_env("order_info", "ROWDATA", "INSERT", [[("id", "1")]])], CDC_SCHEMA)
    got = cdc.route_changes(df, topics={"order": "ORDERS_T"}).first()
    assert got.topic == "ORDERS_T"


EV = "mid string, uid string, evid string, itemid string, ts long"


def test_coupon_alert_cases(spark):
    M = 60_000
    rows = [
        # device d1: 3 users claim coupons, nobody clicks -> alert
        ("d1", "u1", "coupon", "i1", T0 + 1 * M), ("d1", "u2", "coupon", "i2", T0 + 2 * M),
        ("d1", "u3", "coupon", "i1", T0 + 3 * M), ("d1", "u3", "view", None, T0 + 3 * M),
        # device d2: 3 users but one click -> no alert
        ("d2", "u1", "coupon", "i1", T0 + 1 * M), ("d2", "u2", "coupon", "i1", T0 + 1 * M),
        ("d2", "u3", "coupon", "i1", T0 + 2 * M), ("d2", "u4", "clickItem", "i1", T0 + 3 * M),
        # device d3: 2 users, one repeated -> no alert
        ("d3", "u1", "coupon", "i1", T0 + 1 * M), ("d3", "u1", "coupon", "i2", T0 + 2 * M),
        ("d3", "u2", "coupon", "i1", T0 + 2 * M),
        # device d4: null user counts as a member of the user set
        ("d4", None, "coupon", "i1", T0 + 1 * M), ("d4", "u1", "coupon", "i1", T0 + 1 * M),
        ("d4", "u2", "coupon", "i1", T0 + 1 * M),
    ]
    ev = spark.createDataFrame(rows, EV)
    al = windows.coupon_alerts(ev, "5 minutes", "5 minutes", 3).collect()
    by_mid = {a.mid: a for a in al}
    assert set(by_mid) == {"d1", "d4"}
    a = by_mid["d1"]
    assert (a.n_uids, a.uids, a.item_ids, a.events) == (3, ["u1", "u2", "u3"], ["i1", "i2"], ["coupon:3", "view:1"])
    assert a.window_start == "2024-01-01 00:00:00" and a.alert_id == "d1" + str((T0 + 5 * M) // M)
    assert by_mid["d4"].uids == ["u1", "u2", None]


def test_coupon_alert_sliding_edges(spark):
    M = 60_000
    # three coupon users spread over 4 minutes: only windows covering all three alert
    rows = [("d", "u1", "coupon", "x", T0 + 0 * M), ("d", "u2", "coupon", "x", T0 + 2 * M),
            ("d", "u3", "coupon", "x", T0 + 4 * M)]
    al = windows.coupon_alerts(spark.createDataFrame(rows, EV), "5 minutes", "1 minute", 3).collect()
    assert [a.window_start for a in al] == ["2024-01-01 00:00:00"]
    al2 = windows.coupon_alerts(spark.createDataFrame(rows, EV), "6 minutes", "1 minute", 3).collect()
    assert sorted(a.window_start for a in al2) == ["2023-12-31 23:59:00", "2024-01-01 00:00:00"]


def test_interval_join_late_matrix(spark):
    S = 1000
    info = spark.createDataFrame([("o1", T0), ("o2", T0), ("o3", T0)], "id string, its long").withColumn(
        "i_ts", F.timestamp_millis("its"))
    det = spark.createDataFrame([
        ("d1", "o1", T0 - 5 * S),    # before, within bound
        ("d2", "o1", T0),            # same time
        ("d3", "o1", T0 + 10 * S),   # at the bound
        ("d4", "o1", T0 + 11 * S),   # beyond the bound
        ("d5", "o2", T0 + 2 * S), ("d5", "o2", T0 + 2 * S),  # duplicate detail
        ("d6", "o9", T0),            # order never arrives
    ], "did string, order_id string, dts long").withColumn("d_ts", F.timestamp_millis("dts"))
    got = sorted((r.id, r.did) for r in interval_join(info, det, "id", "order_id", "i_ts", "d_ts",
                                                        "10 seconds").collect())
    assert got == [("o1", "d1"), ("o1", "d2"), ("o1", "d3"), ("o2", "d5"), ("o2", "d5")]


def test_sale_detail_user_defaults(spark):
    sale = spark.createDataFrame([("d1", "o1", "1", "u1", "2.5"), ("d2", "o2", "1", "u404", "1.0"),
                                  ("d3", "o3", "1", "u2", "3.0")],
                                 "d_id string, i_id string, i_status string, i_user_id string, d_price string")
    sale = sale.select("*", F.lit("2024-01-01 01:00:00").alias("i_create_time"), F.lit("s").alias("d_sku_id"),
                       F.lit("n").alias("d_sku_name"), F.lit("2024-01-01").alias("i_dt"))
    merged = orders.merge_sale_detail(sale)
    u = spark.createDataFrame([("u1", "l", "gold", "2000-01-01", "F"), ("u2", "m", "silver", None, "M")],
                              "id string, login_name string, user_level string, birthday string, gender string")
    got = {r.order_detail_id: r for r in orders.with_user(merged, u, "2024-01-01 00:00:00").collect()}
    assert (got["d1"].user_age, got["d1"].user_gender, got["d1"].user_level, got["d1"].sku_price) == (24, "F", "gold", 2.5)
    assert (got["d2"].user_age, got["d2"].user_gender, got["d2"].user_level, got["d2"].user_id) == (0, None, None, "u404")
    assert (got["d3"].user_age, got["d3"].user_gender, got["d3"].user_level) == (0, "M", "silver")  # no birthday


def test_bad_price_strict_and_lenient(spark):
    import pytest
    from pyspark.errors import PySparkException
    sale = spark.createDataFrame([("d", "o", "1", "u", "x1")], "d_id string, i_id string, i_status string, "
                                 "i_user_id string, d_price string").select(
        "*", F.lit("t").alias("i_create_time"), F.lit("s").alias("d_sku_id"), F.lit("n").alias("d_sku_name"),
        F.lit("d").alias("i_dt"))
    with pytest.raises(PySparkException):
        orders.merge_sale_detail(sale).collect()
    assert orders.merge_sale_detail(sale, strict_price=False).first().sku_price is None


def test_user_latest_insert_then_update(spark):
    ch = spark.createDataFrame([("1", "a", "L1", "2000-01-01", "M", 5, 1), ("1", "a", "L2", "2000-01-01", "M", 9, 2),
                                ("2", "b", "L1", "1999-01-01", "F", 1, 3)],
                               "id string, login_name string, user_level string, birthday string, gender string, "
                               "ts long, seq long")
    got = {r.id: r.user_level for r in users.user_latest(ch).collect()}
    assert got == {"1": "L2", "2": "L1"}


def test_search_total_page_and_buckets(spark):
    docs = spark.createDataFrame([(str(i), "F" if i % 2 else "M", "ball game" if i % 3 else "chess", str(i % 4), 10 + i)
                                  for i in range(40)], "doc_id string, sex string, favo string, class_id string, age int")
    res = search.search(docs, "doc_id", filter_terms={"sex": "F"}, must_terms={"favo": "ball"},
                        aggs=search.TermsAgg("class_id", 2, "age"), offset=3, size=4,
                        order_cols=[F.col("doc_id").cast("int")])
    expect = [i for i in range(40) if i % 2 and i % 3]
    assert res.total.first().total == len(expect)
    assert [int(r.doc_id) for r in res.hits.collect()] == expect[3:7]
    b = res.buckets.collect()
    assert len(b) == 2 and b[0].doc_count >= b[1].doc_count
    counts = {}
    for i in expect:
        counts[str(i % 4)] = counts.get(str(i % 4), 0) + 1
    assert b[0].doc_count == max(counts.values())
    # pages concatenate to the full order
    pages = []
    for off in range(0, len(expect), 5):
        pages += [int(r.doc_id) for r in search.page(res.matched, [F.col("doc_id").cast("int")], off, 5).collect()]
    assert pages == expect


def test_bm25_matches_brute_force(spark):
    texts = {1: "la que la casa", 2: "que tal", 3: "nada aqui", 4: "la la la la la la la"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.score for r in search.bm25(df, "doc_id", "text", "que la").collect()}
    toks = {k: v.split() for k, v in texts.items()}
    n, avgdl = len(toks), sum(len(t) for t in toks.values()) / len(toks)
    exp = {}
    for q in ("que", "la"):
        dfq = sum(1 for t in toks.values() if q in t)
        idf = math.log(1 + (n - dfq + 0.5) / (dfq + 0.5))
        for d, t in toks.items():
            tf = t.count(q)
            if tf:
                exp[d] = exp.get(d, 0) + idf * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * len(t) / avgdl))
    assert set(got) == set(exp)
    for d in exp:
        assert abs(got[d] - exp[d]) < 1e-9
    top = search.bm25(df, "doc_id", "text", "que la", top_k=1).collect()
    assert top[0].doc_id == max(exp, key=exp.get)


def test_pick_per_key_skewed_key(spark):
    # one key holds most rows; result is still one row per key with the right survivor
    rows = [("hot", i, f"v{i}") for i in range(5000)] + [("cold", 7, "c")]
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(16)
    got = {r.k: r.v for r in dedup.latest_per_key(df, "k", ["o"]).collect()}
    assert got == {"hot": "v4999", "cold": "c"}


def test_reenrich_fills_users_that_arrived_late(spark):
    docs = spark.createDataFrame([("d1", "o1", "1", "t", "u7", "s", None, 0, None, 2.0, "n", "2024-01-01")],
                                 "order_detail_id string, order_id string, order_status string, create_time string, "
                                 "user_id string, sku_id string, user_gender string, user_age int, user_level string, "
                                 "sku_price double, sku_name string, dt string")
    u = spark.createDataFrame([("u7", "x", "gold", "2000-01-01", "F")], "id string, login_name string, "
                              "user_level string, birthday string, gender string")
    r = orders.reenrich_sale_detail(docs, u, "2024-01-01 00:00:00").first()
    assert (r.user_gender, r.user_level, r.user_age) == ("F", "gold", 24)


def test_sql_reports_equal_dataframe_reports(spark):
    from cartwheel.plans import sql_reports
    from cartwheel.sources import fixtures as fx
    d = dau.daily_active(fx.startup_log(spark, "/root/testdata/sf0.001"))
    o = fx.order_info(spark, "/root/testdata/sf0.001")
    sql_reports.register_tables(spark, d, o)
    srt = lambda df: sorted(tuple(r) for r in df.collect())
    day = d.select("log_date").orderBy("log_date").first().log_date
    gday = o.select("create_date").orderBy("create_date").first().create_date
    assert srt(sql_reports.run(spark, "dau_total", day)) == srt(reports.dau_total(d, day))
    assert srt(sql_reports.run(spark, "dau_by_hour", day)) == srt(reports.dau_by_hour(d, day))
    assert srt(sql_reports.run(spark, "gmv_total", gday)) == srt(reports.gmv_total(o, gday))
    assert srt(sql_reports.run(spark, "gmv_by_hour", gday)) == srt(reports.gmv_by_hour(o, gday))
    assert srt(sql_reports.run(spark, "hours_compare_dau", day)) == srt(reports.dau_hours_compare(d, day))


def test_today_text_dimension_lookup_and_topic_files(spark, tmpdir_spark):
    import datetime as dt
    from cartwheel.functions.timefns import today_text
    from cartwheel.operators.joins import dimension_lookup
    assert spark.range(1).select(today_text().alias("d")).first().d == dt.datetime.now(dt.timezone.utc).date().isoformat()
    fact = spark.createDataFrame([("1", 5), ("2", 7)], "k string, v int")
    dim = spark.createDataFrame([("1", "one")], "dk string, name string")
    got = sorted((r.k, r.name) for r in dimension_lookup(fact, dim, "k", "dk").collect())
    assert got == [("1", "one"), ("2", None)]
    msgs = spark.createDataFrame([("order", '{"id":"1"}'), ("user_info", '{"id":"2"}')], "topic string, value string")
    cdc.to_topic_files(msgs, f"{tmpdir_spark}/topics")
    back = spark.read.json(f"{tmpdir_spark}/topics")
    assert sorted((r.topic, r.value) for r in back.collect()) == [("order", '{"id":"1"}'), ("user_info", '{"id":"2"}')]


def test_coupon_alert_hot_device(spark):
    # one device holds nearly all rows: thousands of coupon users in one window, spread over many tasks
    M = 60_000
    hot = spark.range(0, 6000).select(F.lit("hot").alias("mid"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("uid"),
                                      F.lit("coupon").alias("evid"), (F.col("id") % 7).cast("string").alias("itemid"),
                                      (F.lit(T0) + (F.col("id") % 4) * M).alias("ts")).repartition(16)
    cold = spark.createDataFrame([("c", "u1", "clickItem", "1", T0)], EV)
    al = windows.coupon_alerts(hot.unionByName(cold), "5 minutes", "5 minutes", 3).collect()
    assert len(al) == 1 and al[0].mid == "hot" and al[0].n_uids == 6000
    assert al[0].item_ids == list("0123456") and al[0].events == ["coupon:6000"]
    mem = windows.alert_members(hot, "5 minutes", "5 minutes", 3)
    assert mem.where("kind = 'uid'").count() == 6000


def test_sale_search_empty_keyword_and_facet_shares(spark):
    from cartwheel.plans import analysis
    from cartwheel.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    sale = orders.with_user(orders.sale_detail_all(fx.order_info(spark, sf), fx.order_detail(spark, sf)),
                            fx.user_info(spark, sf), "2024-02-01 00:00:00")
    day = sale.groupBy("dt").count().orderBy(F.desc("count"), "dt").first().dt
    r = analysis.sale_search(sale, day, "", 0, 1000)
    n = sale.where(F.col("dt") == day).count()
    assert r["total"].first().total == n and r["detail"].count() == n       # empty keyword: no text filter
    for facet in ("age", "gender"):
        rows = r[facet].collect()
        assert sum(x.value for x in rows) == n
        assert abs(sum(x.share for x in rows) - 100.0) < 0.05


def test_alert_minute_keeps_the_last_window(spark):
    M = 60_000
    rows = [("d", f"u{i}", "coupon", "x", T0 + 10_000 + i) for i in range(3)]
    ev = spark.createDataFrame(rows, EV)
    al = windows.coupon_alerts(ev, "1 minute", "5 seconds", 3)
    assert al.count() == 12                      # every window that holds the three coupons
    stored = {r.alert_id: r for r in windows.alert_minutes(ev, "1 minute", "5 seconds", 3).collect()}
    by_list = {r.alert_id: r for r in windows.alerts_per_minute(al).collect()}
    short = {r.alert_id: r for r in windows.coupon_alerts(ev, "1 minute", "5 seconds", 3, per_minute=True).collect()}
    assert set(stored) == set(by_list) == set(short) == {f"d{T0 // M}", f"d{T0 // M + 1}"}
    for k, r in stored.items():
        assert r.ts == by_list[k].ts == short[k].ts and short[k].uids == by_list[k].uids == ["u0", "u1", "u2"]


def test_null_device_alerts_and_json_answers_without_rows(spark):
    from cartwheel.plans import analysis
    ev = spark.createDataFrame([(None, f"u{i}", "coupon", "x", T0) for i in range(3)], EV)
    al = windows.coupon_alerts(ev, "1 minute", "1 minute", 3).collect()
    assert len(al) == 1 and al[0].mid is None and al[0].uids == ["u0", "u1", "u2"]
    sale = spark.createDataFrame([], "order_detail_id string, order_id string, sku_id string, sku_price double, sku_name string, "
                                     "user_gender string, user_age int, dt string")
    got = analysis.sale_search_json(sale, "2024-01-01").collect()
    assert [r.json for r in got] == ['{"total":0,"stat":[{"options":[]},{"options":[]}],"detail":[]}']
