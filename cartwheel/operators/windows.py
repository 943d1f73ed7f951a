"""Sliding-window coupon alert.

A sliding window of length W and slide S puts every row in W/S windows
(5 min / 5 s = 60 copies).  Rows are never copied: one scan and one
aggregation reduce them to S-wide panes in a long form (device, pane, kind,
key, count) holding event-id counts and the distinct coupon users and items
of each pane.  Only the pane rows of clicks and coupon users are copied to their
W/S windows, which qualifies the windows (hash aggregate of clicks and distinct users); the
windows that alert then name their panes, and member and event lists are gathered from those alone.  Every aggregate is partial-aggregated on the map side,
so a device holding a third of all rows is reduced before any shuffle, and
no list is built for windows that cannot alert.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import ALERT_MIN_USERS, ALERT_SLIDE, ALERT_WINDOW, EVID_CLICK, EVID_COUPON
from ..functions.timefns import alert_id

_UNITS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def interval_ms(text: str) -> int:
    m = re.fullmatch(r"\s*(\d+)\s*(millisecond|second|minute|hour|day)s?\s*", text.lower())
    if not m:
        raise ValueError(f"unsupported interval: {text!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


def _ms_text(c):
    return F.date_format(F.timestamp_millis(c), "yyyy-MM-dd HH:mm:ss")


def _pane(ts, slide_ms: int):
    return (F.floor(F.col(ts) / slide_ms) * slide_ms).cast("long")


def to_windows(df: DataFrame, window_ms: int, slide_ms: int, pane_col: str = "pane") -> DataFrame:
    """Copy each pane row to every window containing it (``wstart`` column)."""
    if window_ms % slide_ms:
        raise ValueError("window length must be a multiple of the slide")
    copies = window_ms // slide_ms
    rest = [c for c in df.columns if c != pane_col]
    return (df.select(*rest, pane_col, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_k"))
              .select(*rest, (F.col(pane_col) - F.col("_k") * F.lit(slide_ms)).alias("wstart")))


def pane_entries():
    """What one event adds to its pane, as an array of (kind, key): 'evid' its event id; for a coupon event also 'uid' and 'item',
    the user and the item (null is a member, as in a hash set)."""
    coupon = F.col("evid") == EVID_COUPON
    return F.array(F.struct(F.lit("evid").alias("kind"), F.col("evid").alias("key")),
                   F.when(coupon, F.struct(F.lit("uid").alias("kind"), F.col("uid").alias("key"))),
                   F.when(coupon, F.struct(F.lit("item").alias("kind"), F.col("itemid").alias("key"))))


def pane_long(events: DataFrame, slide_ms: int) -> DataFrame:
    """Pane aggregates in one long form (one scan, one aggregation):
    (mid, pane, kind, key, n) with the entries of ``pane_entries`` and how often each occurs."""
    return (events.select("mid", _pane("ts", slide_ms).alias("pane"), F.explode(pane_entries()).alias("e"))
                  .where(F.col("e").isNotNull())
                  .groupBy("mid", "pane", F.col("e.kind").alias("kind"), F.col("e.key").alias("key"))
                  .agg(F.count(F.lit(1)).alias("n")))


def window_long(panes: DataFrame, window_ms: int, slide_ms: int) -> DataFrame:
    """(mid, wstart, kind, key, n): pane rows merged into every window containing them."""
    w = to_windows(panes.select("mid", "pane", "kind", "key", "n"), window_ms, slide_ms)
    return w.groupBy("mid", "wstart", "kind", "key").agg(F.sum("n").alias("n"))


def qualifying_windows(wl: DataFrame, min_users: int) -> DataFrame:
    """(mid, wstart, n_uids) of windows with no click and >= min_users coupon users (hash aggregate; no lists)."""
    kind = F.col("kind")
    return (wl.groupBy("mid", "wstart")
              .agg(F.sum(F.when((kind == "evid") & (F.col("key") == EVID_CLICK), F.col("n")).otherwise(0)).alias("clicks"),
                   F.count(F.when(kind == "uid", 1)).alias("n_uids"))
              .where(f"n_uids >= {int(min_users)} and clicks = 0").select("mid", "wstart", "n_uids"))


def members_of(panes: DataFrame, windows: DataFrame, window_ms: int, slide_ms: int) -> DataFrame:
    """(mid, wstart, kind, key, n) of the given windows: each window names its panes, so panes of other windows are not copied."""
    own = windows.select(F.col("mid").alias("_mid"), "wstart",
                         F.explode(F.sequence(F.lit(0), F.lit(window_ms // slide_ms - 1))).alias("_k"))
    own = own.select("_mid", "wstart", (F.col("wstart") + F.col("_k") * F.lit(slide_ms)).alias("_pane"))
    return (panes.join(own, F.col("mid").eqNullSafe(F.col("_mid")) & (F.col("pane") == F.col("_pane")))
                 .groupBy("mid", "wstart", "kind", "key").agg(F.sum("n").alias("n")))


def alerting_windows(panes: DataFrame, window_ms: int, slide_ms: int, min_users: int) -> DataFrame:
    """(mid, wstart, n_uids) of the windows that alert; only panes of clicks and coupon users are copied to windows."""
    deciding = panes.where((F.col("kind") == "uid") | ((F.col("kind") == "evid") & (F.col("key") == EVID_CLICK)))
    return qualifying_windows(window_long(deciding, window_ms, slide_ms), min_users)


def last_of_minute(windows: DataFrame, window_ms: int) -> DataFrame:
    """Of the windows of a device that end in the same minute the latest (the one that would be written last)."""
    minute = F.floor((F.col("wstart") + F.lit(window_ms)) / 60_000)
    return (windows.groupBy("mid", minute.alias("_minute"))
                   .agg(F.max("wstart").alias("wstart"), F.max_by("n_uids", "wstart").alias("n_uids"))
                   .select("mid", "wstart", "n_uids"))


def _sorted_keys(kind: str):
    # struct keeps null members through collect_list; array_sort puts them last
    vals = F.transform(F.collect_list(F.when(F.col("kind") == kind, F.struct(F.col("key").alias("v")))),
                       lambda s: s["v"])
    return F.array_sort(vals)


def alert_documents(members: DataFrame, windows: DataFrame, window_ms: int) -> DataFrame:
    """Member rows of the alerting ``windows`` -> alert rows, members as arrays."""
    ev = F.array_sort(F.collect_list(F.when(F.col("kind") == "evid", F.struct(F.col("key").alias("evid"), "n"))))
    docs = (members.groupBy("mid", "wstart")
              .agg(_sorted_keys("uid").alias("uids"), _sorted_keys("item").alias("item_ids"),
                   F.transform(ev, lambda e: F.concat(F.coalesce(e["evid"], F.lit("null")), F.lit(":"), e["n"].cast("string"))).alias("events")))
    q = windows.withColumnsRenamed({"mid": "_mid", "wstart": "_wstart"})
    both = docs.join(q, F.col("mid").eqNullSafe(F.col("_mid")) & (F.col("wstart") == F.col("_wstart")))
    return alert_rows(both, window_ms)


def _panes(events: DataFrame, slide_ms: int) -> DataFrame:
    return pane_long(events.select("mid", "uid", "evid", "itemid", "ts"), slide_ms)


def coupon_alerts(events: DataFrame, window: str = ALERT_WINDOW, slide: str = ALERT_SLIDE,
                  min_users: int = ALERT_MIN_USERS, per_minute: bool = False) -> DataFrame:
    """Alert per (device, window): >= ``min_users`` distinct users claimed a
    coupon and nobody clicked an item.  ``events`` needs mid, uid, evid,
    itemid, ts (epoch ms).  ``uids``, ``item_ids`` and ``events`` of the output are arrays; ``events`` is the
    event-id multiset of the window as ``evid:count`` entries in evid order (the sorted list,
    run-length coded, so its size is bounded by the number of event ids).  With ``per_minute`` only the last window of
    each device-minute, chosen before any list is built."""
    w_ms, s_ms = interval_ms(window), interval_ms(slide)
    panes = _panes(events, s_ms)
    q = alerting_windows(panes, w_ms, s_ms, min_users)
    if per_minute:
        q = last_of_minute(q, w_ms)
    return alert_documents(members_of(panes, q, w_ms, s_ms), q, w_ms)


def alert_minutes(events: DataFrame, window: str = ALERT_WINDOW, slide: str = ALERT_SLIDE,
                  min_users: int = ALERT_MIN_USERS) -> DataFrame:
    """(alert_id, mid, window_start, window_end, n_uids, ts) of the stored alert per device-minute, without member lists."""
    w_ms, s_ms = interval_ms(window), interval_ms(slide)
    q = last_of_minute(alerting_windows(_panes(events, s_ms), w_ms, s_ms, min_users), w_ms)
    return alert_rows(q, w_ms, ())


def alert_members(events: DataFrame, window: str = ALERT_WINDOW, slide: str = ALERT_SLIDE,
                  min_users: int = ALERT_MIN_USERS) -> DataFrame:
    """Long form of alert membership: one row per (alert_id, kind, member),
    kind = 'uid' or 'item'.  Nothing is collected, so a window with any
    number of users stays spread over tasks."""
    w_ms, s_ms = interval_ms(window), interval_ms(slide)
    panes = _panes(events, s_ms)
    q = alerting_windows(panes, w_ms, s_ms, min_users).select("mid", "wstart")
    end = F.col("wstart") + F.lit(w_ms)
    return (members_of(panes.where(F.col("kind") != "evid"), q, w_ms, s_ms)
              .select(alert_id(F.coalesce("mid", F.lit("null")), end).alias("alert_id"), "kind", F.col("key").alias("member")))


def alert_rows(w: DataFrame, window_ms: int, lists=("uids", "item_ids", "events")) -> DataFrame:
    """Alert documents keyed by device + minute of emission (the window end)."""
    end = F.col("wstart") + F.lit(window_ms)
    return w.select(alert_id(F.coalesce("mid", F.lit("null")), end).alias("alert_id"),
                    "mid",
                    _ms_text(F.col("wstart")).alias("window_start"),
                    _ms_text(end).alias("window_end"),
                    F.col("n_uids").cast("long").alias("n_uids"),
                    *lists,
                    end.cast("long").alias("ts"))


def alert_text(alerts: DataFrame) -> DataFrame:
    """The member arrays as comma text (null members as ``null``), for flat reports."""
    return alerts.withColumns({c: F.array_join(c, ",", "null") for c in ("uids", "item_ids", "events")})


def alerts_per_minute(alerts: DataFrame) -> DataFrame:
    """At most one stored alert per device-minute: the last write (latest
    window end) wins."""
    from .dedup import latest_per_key
    return latest_per_key(alerts, "alert_id", ["ts", "window_start"])
