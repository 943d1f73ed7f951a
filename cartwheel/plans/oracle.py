"""DuckDB twins of the registered queries (run on the same parquet tables).

Fixture views are inlined as CTEs.  Epoch milliseconds use
``epoch_us(ts) // 1000`` (floor, like Spark's ``unix_millis``); DuckDB ``//``
is integer division like Spark ``div``.
"""

from __future__ import annotations

from . import registry as R
from .reports import previous_day_text

STARTUP = r"""startup_log AS (
  SELECT CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid, 'app' AS appid,
         'area' AS area, 'android' AS os, 'web' AS ch, event_type AS type, '1.0' AS vs,
         epoch_us(ts) // 1000 AS ts,
         strftime(ts, '%Y-%m-%d') AS log_date, strftime(ts, '%H') AS log_hour
  FROM events)"""

DAU = r"""dau AS (
  SELECT mid, uid, appid, area, os, ch, type, vs, ts, log_date, log_hour FROM (
    SELECT *, row_number() OVER (PARTITION BY log_date, mid ORDER BY ts, uid, type) AS rn
    FROM startup_log) WHERE rn = 1)"""

EVENT_LOG = r"""event_log AS (
  SELECT CAST(user_id % 10 AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
         CASE event_type WHEN 'click' THEN 'clickItem' WHEN 'purchase' THEN 'coupon' ELSE event_type END AS evid,
         json_extract_string(props, '$.k') AS itemid, epoch_us(ts) // 1000 AS ts
  FROM events)"""

ORDER_INFO = r"""order_info AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
         o_orderstatus AS order_status, o_totalprice AS total_amount,
         strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':00:00' AS create_time,
         strftime(o_orderdate, '%Y-%m-%d') AS create_date,
         lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') AS create_hour,
         o_orderdate AS event_ts
  FROM orders)"""

WIRE_ORDERS = r"""wire_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(c_nationkey AS VARCHAR) AS province_id,
         'consignee-' || CAST(o_custkey AS VARCHAR) AS consignee, o_orderpriority AS order_comment,
         '138' || lpad(CAST(o_custkey % 100000000 AS VARCHAR), 8, '0') AS consignee_tel, o_orderstatus AS order_status,
         CAST(o_orderkey % 3 + 1 AS VARCHAR) AS payment_way, CAST(o_custkey AS VARCHAR) AS user_id,
         CAST(NULL AS VARCHAR) AS img_url, o_totalprice AS total_amount,
         strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') || ' 00:00:00' AS expire_time,
         'address-' || CAST(o_custkey AS VARCHAR) AS delivery_address, i.create_time,
         CASE WHEN o_orderstatus <> 'O' THEN i.create_time END AS operate_time, CAST(NULL AS VARCHAR) AS tracking_no,
         CASE WHEN o_orderkey % 10 = 0 THEN CAST(o_orderkey + 1 AS VARCHAR) END AS parent_order_id,
         lpad(CAST(o_orderkey AS VARCHAR), 18, '0') AS out_trade_no, 'trade-' || CAST(o_orderkey AS VARCHAR) AS trade_body,
         i.create_date, i.create_hour
  FROM orders JOIN order_info i ON i.id = CAST(o_orderkey AS VARCHAR) LEFT JOIN customer ON c_custkey = o_custkey)"""

ORDER_DETAIL = r"""order_detail AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
         CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
         l_partkey AS partkey, l_suppkey AS suppkey, p_name AS sku_name,
         l_extendedprice AS order_price, l_shipdate AS event_ts
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey)"""

USER_INFO = r"""user_info AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS login_name, c_mktsegment AS user_level,
         strftime(DATE '1960-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER), '%Y-%m-%d') AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         c_custkey, c_nationkey
  FROM customer)"""


def age_sql(birthday: str) -> str:
    return (f"CAST((epoch_us(TIMESTAMP '{R.AS_OF}') - epoch_us(CAST({birthday} AS TIMESTAMP))) "
            f"// 1000 // 31536000000 AS INTEGER)")


SALE_ALL = r"""sale AS (
  SELECT d.id AS order_detail_id, o.id AS order_id, o.order_status, o.create_time, o.user_id,
         d.sku_id, d.order_price AS sku_price, d.sku_name, o.create_date AS dt
  FROM order_info o JOIN order_detail d ON o.id = d.order_id)"""

SALE_USER = r"""sale_user AS (
  SELECT s.order_detail_id, s.order_id, s.order_status, s.create_time,
         CASE WHEN u.id IS NOT NULL THEN u.id ELSE s.user_id END AS user_id, s.sku_id,
         u.gender AS user_gender,
         coalesce(CASE WHEN u.id IS NOT NULL THEN {age} END, 0) AS user_age,
         u.user_level, coalesce(s.sku_price, 0.0) AS sku_price, s.sku_name, s.dt
  FROM sale s LEFT JOIN user_info u ON s.user_id = u.id)""".replace("{age}", age_sql("u.birthday"))

TOKENS = r"""list_filter(regexp_split_to_array(
    regexp_replace(lower(text), '([\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}])', ' \1 ', 'g'),
    '[^\p{L}\p{N}]+'), lambda x: x <> '')"""


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


STARTUP_COLS = "mid, uid, appid, area, os, ch, type, vs, ts, log_date, log_hour"

STATE_BATCH = rf"""state AS (SELECT DISTINCT log_date, mid FROM startup_log WHERE log_hour < '{R.SPLIT_HOUR}'),
batch_new AS (
  SELECT {STARTUP_COLS} FROM (
    SELECT b.*, row_number() OVER (PARTITION BY b.log_date, b.mid ORDER BY b.ts, b.uid, b.type) AS rn
    FROM startup_log b
    WHERE b.log_hour >= '{R.SPLIT_HOUR}'
      AND NOT EXISTS (SELECT 1 FROM state s WHERE s.log_date = b.log_date AND s.mid = b.mid)) WHERE rn = 1)"""


def _hours_compare(src: str, date_col: str, hour_col: str, date: str, value: str, cast: str) -> str:
    y = previous_day_text(date)
    zero = "0" if cast == "BIGINT" else "0.0"
    fin = (lambda c: f"CAST(coalesce(g.{c}, 0) AS BIGINT)") if cast == "BIGINT" else (
        lambda c: f"round(coalesce(g.{c}, {zero}), 2)")
    return rf"""h AS (SELECT lpad(CAST(r AS VARCHAR), 2, '0') AS hour FROM range(24) t(r)),
g AS (SELECT {hour_col} AS hour,
             sum(CASE WHEN {date_col} = '{date}' THEN {value} END) AS today,
             sum(CASE WHEN {date_col} = '{y}' THEN {value} END) AS yesterday
      FROM {src} WHERE {date_col} IN ('{date}', '{y}') GROUP BY {hour_col})
SELECT h.hour, {fin('today')} AS today, {fin('yesterday')} AS yesterday
FROM h LEFT JOIN g ON h.hour = g.hour"""


def _realtime_total(date: str) -> str:
    return w(STARTUP, DAU, ORDER_INFO) + rf"""
SELECT 'dau' AS id, '新增日活' AS name, CAST(count(*) AS DOUBLE) AS value FROM dau WHERE log_date = '{date}'
UNION ALL
SELECT 'new_mid', '新增设备', CAST(count(*) AS DOUBLE) FROM (
  SELECT mid FROM dau WHERE log_date = '{date}'
  EXCEPT ALL SELECT t.mid FROM dau t WHERE t.log_date = '{date}'
    AND EXISTS (SELECT 1 FROM dau e WHERE e.mid = t.mid AND e.log_date < '{date}'))
UNION ALL
SELECT 'order_amount', '新增交易额', round(CAST(sum(total_amount) AS DOUBLE), 2) FROM order_info WHERE create_date = '{date}'"""


def _realtime_total_json(date: str) -> str:
    return _realtime_total(date).replace("\nSELECT 'dau'", ", tot AS (SELECT 'dau'", 1) + r""")
SELECT '[' || string_agg('{"id":"' || id || '","name":"' || name || '"' || coalesce(',"value":' || CASE WHEN id = 'order_amount'
         THEN CAST(CAST(value AS DECIMAL(20,2)) AS VARCHAR) ELSE CAST(CAST(value AS BIGINT) AS VARCHAR) END, '') || '}', ','
       ORDER BY CASE id WHEN 'dau' THEN 1 WHEN 'new_mid' THEN 2 ELSE 3 END) || ']' AS json FROM tot"""


def _realtime_hours_json(date: str) -> str:
    return _realtime_hours(date, False).replace("SELECT CASE WHEN log_date", ", t AS (SELECT CASE WHEN log_date", 1) \
        .replace("GROUP BY 1, 2", "GROUP BY 1, 2)", 1).replace("WITH ", "WITH ", 1) + r"""
, m AS (SELECT series, map_from_entries(list({'k': hour, 'v': value} ORDER BY hour)) AS m FROM t GROUP BY series)
SELECT CAST(to_json({'yesterday': coalesce((SELECT m FROM m WHERE series = 'yesterday'), MAP {}),
                     'today': coalesce((SELECT m FROM m WHERE series = 'today'), MAP {})}) AS VARCHAR) AS json"""


def _realtime_hours(date: str, gmv: bool) -> str:
    y = previous_day_text(date)
    if gmv:
        return w(ORDER_INFO) + rf"""
SELECT CASE WHEN create_date = '{date}' THEN 'today' ELSE 'yesterday' END AS series, create_hour AS hour,
       round(CAST(sum(total_amount) AS DOUBLE), 2) AS value
FROM order_info WHERE create_date IN ('{date}', '{y}') GROUP BY 1, 2"""
    return w(STARTUP, DAU) + rf"""
SELECT CASE WHEN log_date = '{date}' THEN 'today' ELSE 'yesterday' END AS series, log_hour AS hour,
       CAST(count(*) AS DOUBLE) AS value
FROM dau WHERE log_date IN ('{date}', '{y}') GROUP BY 1, 2"""


BUSY_LOG = EVENT_LOG.replace("epoch_us(ts) // 1000 AS ts", "epoch_us(ts) // 1000 // 60 AS ts")

_ALERT = rf"""p AS (SELECT mid, uid, evid, itemid, (ts // {{S}}) * {{S}} AS pane FROM event_log),
win AS (SELECT mid, uid, evid, itemid, pane - k * {{S}} AS wstart FROM p CROSS JOIN range({{K}}) r(k)),
per AS (SELECT mid, wstart, evid, count(*) AS n FROM win GROUP BY mid, wstart, evid),
g AS (SELECT mid, wstart,
             count(*) FILTER (WHERE evid = 'clickItem') AS clicks,
             count(DISTINCT uid) FILTER (WHERE evid = 'coupon') AS n_uids,
             array_to_string(list_sort(list_distinct(list(uid) FILTER (WHERE evid = 'coupon'))), ',') AS uids,
             array_to_string(list_sort(list_distinct(list(itemid) FILTER (WHERE evid = 'coupon'))), ',') AS item_ids
      FROM win GROUP BY mid, wstart),
e AS (SELECT mid, wstart, string_agg(evid || ':' || CAST(n AS VARCHAR), ',' ORDER BY evid) AS events
      FROM per GROUP BY mid, wstart),
alerts AS (
  SELECT mid || CAST((wstart + {{W}}) // 60000 AS VARCHAR) AS alert_id, mid,
         strftime(make_timestamp(wstart * 1000), '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(make_timestamp((wstart + {{W}}) * 1000), '%Y-%m-%d %H:%M:%S') AS window_end,
         CAST(n_uids AS BIGINT) AS n_uids, uids, item_ids, events, wstart + {{W}} AS ts
  FROM g JOIN e USING (mid, wstart) WHERE clicks = 0 AND n_uids >= {R.ALERT_USERS})"""


def _alert(window_ms: int, slide_ms: int) -> str:
    return (_ALERT.replace("{S}", str(slide_ms)).replace("{K}", str(window_ms // slide_ms)).replace("{W}", str(window_ms)))


ALERT = _alert(3_600_000, 5 * 60_000)
ALERT_5S = _alert(5 * 60_000, 5_000)
PER_MINUTE = """
SELECT alert_id, mid, window_end, n_uids FROM (
  SELECT *, row_number() OVER (PARTITION BY alert_id ORDER BY ts DESC) AS rn FROM alerts) WHERE rn = 1"""

STUDENT = rf"""student AS (
  SELECT CAST(c_custkey AS VARCHAR) AS doc_id, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS sex,
         c_mktsegment AS favo, CAST(c_nationkey AS VARCHAR) AS class_id,
         {age_sql("strftime(DATE '1960-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER), '%Y-%m-%d')")} AS age,
         c_custkey
  FROM customer),
hits AS (SELECT * FROM student WHERE sex = '{R.SEARCH_SEX}'
         AND list_contains(list_filter(regexp_split_to_array(lower(favo), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> ''), '{R.SEARCH_FAVO}'))"""

DOCS = rf"""d AS (SELECT doc_id, lang, {TOKENS} AS t FROM documents)"""

MATCH_TERMS = "['la', 'que']"

PROVINCE = r"""ps AS (
  SELECT n_name AS name, CAST(count(*) AS BIGINT) AS order_count, round(sum(o_totalprice), 2) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY n_name)"""

SALE_HITS = rf"""hits AS (SELECT * FROM sale_user WHERE dt = '{R.SALE_DATE}'
  AND list_has_any({TOKENS.replace("lower(text)", "lower(sku_name)")}, ['plate', 'ring']))"""


def _facet(key_expr: str, src: str = "sale_user") -> str:
    return rf"""SELECT name, value, round(CAST(100.0 * value / sum(value) OVER () AS DOUBLE), 2) AS share
FROM (SELECT {key_expr} AS name, count(*) AS value FROM {src} GROUP BY 1)"""


GENDER_KEY = "CASE user_gender WHEN 'M' THEN '女' WHEN 'F' THEN '男' ELSE user_gender END"
AGE_KEY = "CASE WHEN user_age < 20 THEN '20岁以下' WHEN user_age < 30 THEN '20-30岁' ELSE '30岁以上' END"

JOIN_COLS = """o.id AS order_id, d.id AS order_detail_id, d.order_id AS detail_order_id, o.user_id,
  d.sku_id, d.order_price AS sku_price"""


def _image(**fields) -> str:
    """Names and values of an after image, sorted by name."""
    return " || '|' || ".join(f"'{name}=' || {fields[name]}" for name in sorted(fields))


def _cdc_after() -> str:
    ins = "o_orderkey % 3 = 0 AND o_orderkey % 11 <> 0"
    order = _image(id="o_orderkey", user_id="o_custkey", order_status="o_orderstatus", total_amount="CAST(o_totalprice AS VARCHAR)",
                   create_time="strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':00:00'")
    line = _image(id="l_orderkey || '-' || l_linenumber", order_id="l_orderkey", sku_id="l_partkey",
                  order_price="CAST(l_extendedprice AS VARCHAR)", sku_num="CAST(l_quantity AS VARCHAR)")
    user = _image(id="c_custkey", login_name="c_name", user_level="c_mktsegment",
                  birthday="strftime(DATE '1960-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER), '%Y-%m-%d')",
                  gender="CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END")
    return rf"""
SELECT 'order' AS topic, CAST(o_orderkey AS VARCHAR) AS id, {order} AS image FROM orders WHERE {ins}
UNION ALL
SELECT 'order_detail', CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR), {line}
FROM lineitem WHERE l_orderkey % 3 = 0 AND l_orderkey % 11 <> 0
UNION ALL
SELECT 'user_info', CAST(c_custkey AS VARCHAR), {user} FROM customer WHERE c_custkey % 3 IN (0, 1) AND c_custkey % 11 <> 0"""


def _cdc_route() -> str:
    def part(tbl, key, src, route):
        return rf"""SELECT '{tbl}' AS "table",
       CASE {key} % 3 WHEN 0 THEN 'INSERT' WHEN 1 THEN 'UPDATE' ELSE 'DELETE' END AS event_type, {route} AS topic
FROM {src} WHERE {key} % 11 <> 0"""
    order_route = "CASE WHEN o_orderkey % 3 = 0 THEN 'order' END"
    detail_route = "CASE WHEN l_orderkey % 3 = 0 THEN 'order_detail' END"
    user_route = "CASE WHEN c_custkey % 3 IN (0, 1) THEN 'user_info' END"
    return ("WITH env AS (" + part("order_info", "o_orderkey", "orders", order_route) + "\nUNION ALL\n"
            + part("order_detail", "l_orderkey", "lineitem", detail_route) + "\nUNION ALL\n"
            + part("user_info", "c_custkey", "customer", user_route) + ")\n"
            + 'SELECT topic, "table", event_type, count(*) AS n FROM env WHERE topic IS NOT NULL '
              'GROUP BY topic, "table", event_type')


def _user_latest() -> str:
    return w(USER_INFO) + r"""
, ch AS (
  SELECT id, login_name, user_level, birthday, gender, 1704067200000 + c_custkey AS ts, c_custkey AS seq FROM user_info
  UNION ALL
  SELECT id, login_name, user_level || '-PLUS', birthday, gender, 1704067200000 + 86400000 + c_custkey,
         1000000000000 + c_custkey FROM user_info WHERE c_custkey % 3 = 1)
SELECT id, login_name, user_level, birthday, gender FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, seq DESC) AS rn FROM ch) WHERE rn = 1"""


def oracle_sql() -> dict[str, str]:
    d, g = R.DAU_DATE, R.GMV_DATE
    q = {
        "startup_enrich": w(STARTUP) + f"SELECT {STARTUP_COLS} FROM startup_log",
        "dau_first_per_device": w(STARTUP, DAU) + f"SELECT {STARTUP_COLS} FROM dau",
        "dau_anti_join_state": w(STARTUP, STATE_BATCH) + "SELECT * FROM batch_new",
        "dau_state_union": w(STARTUP, STATE_BATCH) +
            "SELECT log_date, mid FROM state UNION SELECT log_date, mid FROM batch_new",
        "dau_total": w(STARTUP, DAU) + f"SELECT count(*) AS dau FROM dau WHERE log_date = '{d}'",
        "dau_by_hour": w(STARTUP, DAU) +
            f"SELECT log_hour, count(*) AS ct FROM dau WHERE log_date = '{d}' GROUP BY log_hour",
        "new_devices": w(STARTUP, DAU) +
            "SELECT first_date AS log_date, count(*) AS new_mid FROM "
            "(SELECT mid, min(log_date) AS first_date FROM dau GROUP BY mid) GROUP BY first_date",
        "dau_stage_counts": w(STARTUP) + rf"""
, k AS (SELECT log_date, mid, count(*) AS n, bool_or(log_hour < '{R.SPLIT_HOUR}') AS has_early,
               bool_or(log_hour >= '{R.SPLIT_HOUR}') AS has_late FROM startup_log GROUP BY log_date, mid)
SELECT 'input' AS stage, CAST(sum(n) AS BIGINT) AS n FROM k
UNION ALL SELECT 'after_batch_dedup', count(*) FROM k
UNION ALL SELECT 'after_state_filter', count(*) FILTER (WHERE has_late AND NOT has_early) FROM k""",
        "order_enrich": w(ORDER_INFO, WIRE_ORDERS) + "SELECT * FROM wire_orders",
        "gmv_total": w(ORDER_INFO) +
            f"SELECT round(CAST(sum(total_amount) AS DOUBLE), 2) AS sum_amount FROM order_info WHERE create_date = '{g}'",
        "gmv_by_hour": w(ORDER_INFO) +
            f"SELECT create_hour, round(CAST(sum(total_amount) AS DOUBLE), 2) AS sum_amount FROM order_info "
            f"WHERE create_date = '{g}' GROUP BY create_hour",
        "gmv_by_day": w(ORDER_INFO) +
            "SELECT create_date, round(CAST(sum(total_amount) AS DOUBLE), 2) AS sum_amount, count(*) AS n_orders "
            "FROM order_info GROUP BY create_date",
        "dau_hours_compare": w(STARTUP, DAU) + ", " + _hours_compare("dau", "log_date", "log_hour", d, "1", "BIGINT"),
        "gmv_hours_compare": w(ORDER_INFO) + ", " +
            _hours_compare("order_info", "create_date", "create_hour", g, "total_amount", "DOUBLE"),
        "dau_hours_zone": w(STARTUP.replace("FROM events)", "FROM (SELECT user_id, event_type, ts + INTERVAL 8 HOUR AS ts FROM events))"), DAU)
            + ", " + _hours_compare("dau", "log_date", "log_hour", d, "1", "BIGINT"),
        "gmv_zone_days": """
WITH l AS (SELECT o_orderdate - to_hours(CASE WHEN o_orderdate >= TIMESTAMP '1996-04-07 07:00:00' THEN 4 ELSE 5 END) AS t, o_totalprice FROM orders
           WHERE o_orderdate >= TIMESTAMP '1996-04-05 05:00:00' AND o_orderdate < TIMESTAMP '1996-04-10 04:00:00')
SELECT strftime(t, '%Y-%m-%d') AS log_date, strftime(t, '%H') AS log_hour, round(CAST(sum(o_totalprice) AS DOUBLE), 2) AS sum_amount,
       count(*) AS n FROM l GROUP BY ALL""",
        "realtime_total": _realtime_total(R.NEW_DEVICE_DATE),
        "realtime_total_orders_day": _realtime_total(g),
        "realtime_total_json": _realtime_total_json(g),
        "realtime_hours": _realtime_hours(d, False),
        "realtime_hours_gmv": _realtime_hours(g, True),
        "realtime_hours_json": _realtime_hours_json(d),
        "decode_startup_json": w(STARTUP) + f"SELECT {STARTUP_COLS} FROM startup_log",
        "json_roundtrip": w(ORDER_INFO, WIRE_ORDERS) + "SELECT * FROM wire_orders",
        "cdc_route": _cdc_route(),
        "cdc_after_image_json": _cdc_after(),
        "order_detail_full_outer": w(ORDER_INFO, ORDER_DETAIL) +
            f"SELECT {JOIN_COLS} FROM order_info o FULL OUTER JOIN order_detail d ON o.id = d.order_id",
        "order_detail_inner": w(ORDER_INFO, ORDER_DETAIL) +
            f"SELECT {JOIN_COLS} FROM order_info o JOIN order_detail d ON o.id = d.order_id",
        "order_without_detail": w(ORDER_INFO, ORDER_DETAIL) +
            "SELECT id, user_id, create_time FROM order_info o "
            "WHERE NOT EXISTS (SELECT 1 FROM order_detail d WHERE d.order_id = o.id)",
        "sale_detail_interval_join": w(ORDER_INFO, ORDER_DETAIL) + """
SELECT d.id AS order_detail_id, o.id AS order_id, o.order_status, o.create_time, o.user_id, d.sku_id,
       d.order_price AS sku_price, d.sku_name, o.create_date AS dt
FROM order_info o JOIN order_detail d ON o.id = d.order_id
 AND d.event_ts BETWEEN o.event_ts - INTERVAL 10 DAY AND o.event_ts + INTERVAL 10 DAY""",
        "sale_detail_with_user": w(ORDER_INFO, ORDER_DETAIL, USER_INFO, SALE_ALL, SALE_USER) +
            "SELECT * FROM sale_user",
        "user_age_years": w(USER_INFO) + f"SELECT id, birthday, {age_sql('birthday')} AS user_age FROM user_info",
        "user_latest": _user_latest(),
        "coupon_alert": w(EVENT_LOG, ALERT) + "SELECT * FROM alerts",
        "coupon_alert_5s": w(BUSY_LOG, ALERT_5S) + "SELECT * FROM alerts",
        "alert_per_minute": w(EVENT_LOG, ALERT) + PER_MINUTE,
        "alert_per_minute_5s": w(BUSY_LOG, ALERT_5S) + PER_MINUTE,
        "coupon_alert_members": w(EVENT_LOG, ALERT) + """
, q AS (SELECT mid, wstart FROM g WHERE clicks = 0 AND n_uids >= 3)
SELECT DISTINCT mid || CAST((wstart + 3600000) // 60000 AS VARCHAR) AS alert_id, 'uid' AS kind, uid AS member
FROM win JOIN q USING (mid, wstart) WHERE evid = 'coupon'
UNION ALL
SELECT DISTINCT mid || CAST((wstart + 3600000) // 60000 AS VARCHAR), 'item', itemid
FROM win JOIN q USING (mid, wstart) WHERE evid = 'coupon'""",
        "upsert_latest_by_id": w(ORDER_DETAIL) + """
SELECT id, order_id, sku_id, suppkey, strftime(event_ts, '%Y-%m-%d') AS ship_date, order_price AS sku_price FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY event_ts DESC, partkey DESC, suppkey DESC) AS rn
  FROM order_detail) WHERE rn = 1""",
        "bulk_upsert_documents": """
SELECT CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS id, CAST(o_custkey AS VARCHAR) AS user_id,
       round(CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 3 = 0 THEN o_totalprice - 1 ELSE o_totalprice END, 2) AS total_amount
FROM orders
UNION ALL
SELECT NULL, CAST(o_custkey AS VARCHAR), round(o_totalprice - 1, 2) FROM orders WHERE o_orderkey % 7 = 0 AND o_orderkey % 3 = 0""",
        "daily_partition_counts": """
SELECT 'sale_detail' || CAST((epoch_us(l_shipdate) // 1000) // 86400000 AS VARCHAR) AS index_name,
       count(*) AS n_docs FROM lineitem GROUP BY 1""",
        "search_total_hits": w(STUDENT) + "SELECT count(*) AS total FROM hits",
        "search_terms_agg": w(STUDENT) + """
SELECT class_id, count(*) AS doc_count, CAST(max(age) AS DOUBLE) AS max_age FROM hits
GROUP BY class_id ORDER BY doc_count DESC, class_id LIMIT 10""",
        "search_page": w(STUDENT) + f"""
SELECT doc_id, sex, favo, class_id, age FROM hits ORDER BY c_custkey, doc_id
LIMIT {R.SEARCH_SIZE} OFFSET {R.SEARCH_FROM}""",
        "search_match": w(DOCS) + f"SELECT doc_id, lang FROM d WHERE list_has_any(t, {MATCH_TERMS})",
        "search_match_all": w(DOCS) + f"SELECT doc_id, lang FROM d WHERE list_has_all(t, {MATCH_TERMS})",
        "search_match_indexed": w(DOCS) + f"SELECT doc_id FROM d WHERE list_has_all(t, {MATCH_TERMS})",
        "search_bm25": w(DOCS) + f"""
, st AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM d),
occ AS (SELECT doc_id, dl, term, count(*) AS tf FROM (
          SELECT doc_id, len(t) AS dl, unnest(list_filter(t, lambda x: list_contains({MATCH_TERMS}, x))) AS term FROM d)
        GROUP BY doc_id, dl, term),
dfq AS (SELECT term, count(*) AS df FROM occ GROUP BY term)
SELECT doc_id, round(sum(ln(1 + (st.n - dfq.df + 0.5) / (dfq.df + 0.5)) * tf * (1.2 + 1)
                       / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / st.avgdl))), 4) AS score
FROM occ JOIN dfq USING (term) CROSS JOIN st GROUP BY doc_id""",
        "facet_gender": w(ORDER_INFO, ORDER_DETAIL, USER_INFO, SALE_ALL, SALE_USER) + _facet(GENDER_KEY),
        "facet_age_band": w(ORDER_INFO, ORDER_DETAIL, USER_INFO, SALE_ALL, SALE_USER) + _facet(AGE_KEY),
        "sale_search_page": w(ORDER_INFO, ORDER_DETAIL, USER_INFO, SALE_ALL, SALE_USER, SALE_HITS) + f"""
SELECT * FROM hits ORDER BY order_detail_id, order_id, sku_id, sku_price
LIMIT {R.SALE_SIZE} OFFSET {R.SALE_FROM}""",
        "sale_search_facets": w(ORDER_INFO, ORDER_DETAIL, USER_INFO, SALE_ALL, SALE_USER, SALE_HITS) +
            "SELECT 'age' AS facet, * FROM (" + _facet(AGE_KEY, "hits") + ")\nUNION ALL\n"
            "SELECT 'gender' AS facet, * FROM (" + _facet(GENDER_KEY, "hits") + ")",
        "sale_search_total": w(ORDER_INFO, ORDER_DETAIL, USER_INFO, SALE_ALL, SALE_USER, SALE_HITS) +
            "SELECT count(*) AS total FROM hits",
        "sale_search_json": w(ORDER_INFO, ORDER_DETAIL, USER_INFO, SALE_ALL, SALE_USER, SALE_HITS) + f"""
, page AS (SELECT * FROM hits ORDER BY order_detail_id, order_id, sku_id, sku_price LIMIT {R.SALE_SIZE} OFFSET {R.SALE_FROM}),
age AS (""" + _facet(AGE_KEY, "hits") + """), gen AS (""" + _facet(GENDER_KEY, "hits") + """)
SELECT CAST(to_json({'total': (SELECT count(*) FROM hits),
  'stat': [{'options': (SELECT coalesce(list({'name': name, 'value': value, 'share': share} ORDER BY name), []) FROM age)},
           {'options': (SELECT coalesce(list({'name': name, 'value': value, 'share': share} ORDER BY name), []) FROM gen)}],
  'detail': (SELECT coalesce(list({'order_detail_id': order_detail_id, 'order_id': order_id, 'order_status': order_status,
     'create_time': create_time, 'user_id': user_id, 'sku_id': sku_id, 'user_gender': user_gender, 'user_age': user_age,
     'user_level': user_level, 'sku_price': sku_price, 'sku_name': sku_name, 'dt': dt}
     ORDER BY order_detail_id, order_id, sku_id, sku_price), []) FROM page)}) AS VARCHAR) AS json""",
        "province_sales": w(PROVINCE) + "SELECT * FROM ps",
        "province_topk": w(PROVINCE) + "SELECT * FROM ps ORDER BY value DESC, name LIMIT 5",
        "province_sales_bins": w(PROVINCE) + """
SELECT CASE WHEN b >= 6 THEN '600+' ELSE CAST(b * 100 AS VARCHAR) || '-' || CAST((b + 1) * 100 AS VARCHAR) END AS bin,
       count(*) AS provinces
FROM (SELECT least(order_count // 100, 6) AS b FROM ps) GROUP BY 1""",
        "sku_sales": "SELECT p_name AS name, CAST(count(*) AS BIGINT) AS num FROM lineitem "
                     "JOIN part ON l_partkey = p_partkey GROUP BY p_name",
    }
    from ..streaming.register import stream_oracles
    q.update(stream_oracles(q))
    return q
