"""Physical-plan checks: pruning and pushdown reach the scan, broadcasts only
where the size is bounded, and no Python UDF in the hot paths."""

import io
from contextlib import redirect_stdout

import __spark_entry__ as E
from cartwheel.operators.upsert import append, read_keyed
from cartwheel.plans import dau, reports
from cartwheel.sources import fixtures as fx

from conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_report_on_dau_table_prunes_partitions(spark, tmpdir_spark):
    path = f"{tmpdir_spark}/dau"
    append(dau.daily_active(fx.startup_log(spark, SF_SMALL)), path, 0, "log_date")
    table = read_keyed(spark, path, ["log_date", "mid"], ["ts"], "first")
    p = plan(reports.dau_total(table, "2024-01-15"))
    assert "PartitionFilters: [isnotnull(log_date" in p and "(log_date#" in p and "= 2024-01-15)" in p
    got = reports.dau_total(table, "2024-01-15").first().dau
    assert got == dau.daily_active(fx.startup_log(spark, SF_SMALL)).where("log_date = '2024-01-15'").count()
    p2 = plan(reports.dau_hours_compare(table, "2024-01-15"))
    assert "PartitionFilters" in p2 and "2024-01-14" in p2


def test_scans_read_only_needed_columns(spark):
    q = E.queries()
    p = plan(q["search_match"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in p
    p = plan(q["dau_by_hour"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in p or \
        "ReadSchema: struct<user_id:bigint,event_type:string,ts:timestamp_ntz>" in p


def test_fixed_size_dimension_is_broadcast(spark):
    p = plan(E.queries()["province_sales"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
    # orders are reduced per customer before the customer join
    assert p.index("HashAggregate") < p.rindex("Join") or "partial_sum" in p


def test_no_python_udfs_in_registered_batch_queries(spark):
    for name, fn in E.queries().items():
        if name.startswith("stream_"):
            continue
        p = plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_dedup_uses_partial_aggregation(spark):
    p = plan(dau.daily_active(fx.startup_log(spark, SF_SMALL)))
    assert "partial_min_by" in p   # map-side reduction before the shuffle (skew-safe)


def test_a_write_reads_nothing_and_a_read_prunes(spark, tmpdir_spark):
    from pyspark.sql import functions as F
    path = f"{tmpdir_spark}/t"
    base = spark.range(0, 2000).select(F.col("id").cast("string").alias("id"),
                                       (F.col("id") % 20).cast("string").alias("day"), F.col("id").alias("v"))
    append(base, path, 0, "day")
    append(spark.createDataFrame([("5", "5", 99)], "id string, day string, v long"), path, 1, "day")
    p = plan(read_keyed(spark, path, "id", where=F.col("day") == "5"))
    assert "PartitionFilters: [isnotnull(day" in p and "= 5)" in p
    t = read_keyed(spark, path, "id")
    assert t.count() == 2000 and t.where("id = '5'").first().v == 99


def test_anti_join_reduces_both_sides(spark):
    rows = fx.startup_log(spark, SF_SMALL)
    p = plan(dau.daily_active_new(rows, rows.where("log_hour < '12'")))
    assert p.index("LeftAnti") > 0 and "partial_min_by" in p
    seen = p[p.index("(1) Scan"):]
    assert seen.count("HashAggregate") >= 2


def test_global_statistics_are_scalar_subqueries_not_joins(spark):
    q = E.queries()
    for name in ("search_bm25", "facet_gender"):
        p = plan(q[name](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
        assert "Subquery" in p, name


def test_date_reports_push_the_day_range_to_the_scan(spark):
    q = E.queries()
    for name, col, both in (
            ("dau_total", "ts", True), ("dau_by_hour", "ts", True), ("dau_hours_compare", "ts", True),
            ("realtime_hours", "ts", True), ("realtime_hours_json", "ts", True), ("realtime_total", "ts", False),
            ("realtime_total", "o_orderdate", True), ("realtime_total_orders_day", "o_orderdate", True),
            ("gmv_total", "o_orderdate", True), ("gmv_by_hour", "o_orderdate", True),
            ("gmv_hours_compare", "o_orderdate", True), ("realtime_hours_gmv", "o_orderdate", True),
            ("sale_search_page", "o_orderdate", True), ("sale_search_total", "o_orderdate", True),
            ("sale_search_facets", "o_orderdate", True)):
        pushed = [line for line in plan(q[name](spark, SF_SMALL)).splitlines() if "PushedFilters" in line]
        assert any(f"LessThan({col}," in line and (f"GreaterThanOrEqual({col}," in line or not both) for line in pushed), name


def test_totals_scan_events_once_and_facets_read_no_names(spark):
    q = E.queries()
    assert plan(q["realtime_total"](spark, SF_SMALL)).count("ReadSchema: struct<ts:timestamp_ntz,user_id:bigint") + \
        plan(q["realtime_total"](spark, SF_SMALL)).count("ReadSchema: struct<user_id:bigint,ts:timestamp_ntz") == 1
    for name in ("facet_gender", "facet_age_band"):
        assert "p_name" not in plan(q[name](spark, SF_SMALL)), name


def test_only_deciding_panes_are_copied_to_windows(spark):
    p = plan(E.queries()["alert_per_minute_5s"](spark, SF_SMALL))
    assert "collect_list" not in p and "Generate" in p
