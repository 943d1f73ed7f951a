"""Coupon-abuse alerts from the behaviour log."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..constants import ALERT_MIN_USERS, ALERT_SLIDE, ALERT_WINDOW
from ..operators.windows import coupon_alerts


def coupon_alert_job(event_log: DataFrame, window: str = ALERT_WINDOW, slide: str = ALERT_SLIDE,
                     min_users: int = ALERT_MIN_USERS) -> DataFrame:
    ev = event_log.select("mid", "uid", "evid", "itemid", "ts")
    return coupon_alerts(ev, window, slide, min_users)


def stored_alerts(event_log: DataFrame, window: str = ALERT_WINDOW, slide: str = ALERT_SLIDE,
                  min_users: int = ALERT_MIN_USERS) -> DataFrame:
    """What the alert index holds: one document per device-minute."""
    return coupon_alerts(event_log, window, slide, min_users, per_minute=True)
