"""Time and date column expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

import datetime as _dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import MS_PER_DAY, MS_PER_MINUTE, MS_PER_YEAR


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(ts) -> Column:
    """Epoch milliseconds of a timestamp (floors sub-millisecond parts).

    ``TIMESTAMP_NTZ`` values are read as wall-clock time in the session time
    zone (pinned to UTC).
    """
    return F.unix_millis(_c(ts).cast("timestamp"))


def event_time(ms) -> Column:
    """Epoch ms -> TIMESTAMP, the type watermarks and windows need."""
    return F.timestamp_millis(_c(ms))


def _wall(ms, zone: str | None) -> Column:
    """Epoch ms as the wall clock of ``zone`` shows it (the session's own zone, UTC, when None)."""
    instant = F.timestamp_millis(_c(ms))
    return instant if zone is None else F.convert_timezone(None, F.lit(zone), instant.cast("timestamp_ntz"))


def log_date(ms, zone: str | None = None) -> Column:
    """``yyyy-MM-dd`` of an epoch-ms value, in ``zone``."""
    return F.date_format(_wall(ms, zone), "yyyy-MM-dd")


def log_hour(ms, zone: str | None = None) -> Column:
    """Two-digit hour ``HH`` of an epoch-ms value, in ``zone``.  Where clocks go back an hour comes twice a day, where they
    go forward one is missing."""
    return F.date_format(_wall(ms, zone), "HH")


def with_log_date_hour(df, ts_col: str = "ts", zone: str | None = None):
    """Add ``log_date`` and ``log_hour`` derived from epoch ms (overwrites)."""
    return df.withColumn("log_date", log_date(ts_col, zone)).withColumn("log_hour", log_hour(ts_col, zone))


def day_start(date: str, zone: str, days: int = 0) -> str:
    """UTC text of the midnight that begins ``date`` (plus ``days``) in ``zone``; days there may have 23 or 25 hours."""
    day = _dt.date.fromisoformat(date) + _dt.timedelta(days=days)
    local = _dt.datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(zone))
    return local.astimezone(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def create_date(create_time, strict: bool = True) -> Column:
    """Part of ``yyyy-MM-dd HH:mm:ss`` text before the space (pure text)."""
    parts = F.split(_c(create_time), " ")
    return parts[0] if strict else F.get(parts, 0)


def create_hour(create_time, strict: bool = True) -> Column:
    """First colon-separated part after the space.

    ``strict`` raises on text without a space (ANSI index error), like the
    original; non-strict gives null.
    """
    parts = F.split(_c(create_time), " ")
    if strict:
        return F.split(parts[1], ":")[0]
    return F.get(F.split(F.get(parts, 1), ":"), 0)


def with_create_date_hour(df, col: str = "create_time", strict: bool = True):
    return (df.withColumn("create_date", create_date(col, strict))
              .withColumn("create_hour", create_hour(col, strict)))


def within_days(df, col: str, first: str | None = None, last: str | None = None, zone: str | None = None):
    """Rows whose raw time column (UTC) lies on the days ``first`` to ``last`` (``yyyy-MM-dd``, both included; None = open), days of
    ``zone`` when given.  The bounds are literals of the column's own type, so the range reaches the scan, which a filter on
    derived day text does not."""
    kind = df.schema[col].dataType
    start = lambda date, days: (F.date_add(F.lit(date).cast("date"), days) if zone is None else F.lit(day_start(date, zone, days))).cast(kind)
    if first is not None:
        df = df.where(F.col(col) >= start(first, 0))
    if last is not None:
        df = df.where(F.col(col) < start(last, 1))
    return df


def age_years(birthday, as_of=None, calendar: bool = False) -> Column:
    """Whole 365-day years between midnight of ``birthday`` (yyyy-MM-dd) and
    ``as_of`` (a timestamp column/literal; default: now).  ``calendar=True``
    gives calendar age (birthdays counted on their date) instead."""
    as_of_c = F.current_timestamp() if as_of is None else (
        F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of)
    born = F.to_date(_c(birthday), "yyyy-MM-dd").cast("timestamp")
    if calendar:
        return F.floor(F.months_between(F.to_date(as_of_c), F.to_date(born)) / 12).cast("int")
    return ((F.unix_millis(as_of_c) - F.unix_millis(born)) / F.lit(MS_PER_YEAR)).cast("long").cast("int")


def previous_day(date) -> Column:
    """``yyyy-MM-dd`` text of the day before ``date`` (text or date)."""
    return F.date_format(F.date_sub(F.to_date(_c(date)), 1), "yyyy-MM-dd")


def today_text() -> Column:
    return F.date_format(F.current_date(), "yyyy-MM-dd")


def alert_id(mid, ts_ms) -> Column:
    """Document id ``mid`` followed by whole minutes since epoch (no separator)."""
    return F.concat(_c(mid).cast("string"), F.floor(_c(ts_ms) / MS_PER_MINUTE).cast("string"))


def day_number(ts_ms) -> Column:
    """Whole days since epoch of an epoch-ms value."""
    return F.floor(_c(ts_ms) / MS_PER_DAY).cast("long")


def daily_index_name(prefix: str, ts_ms) -> Column:
    return F.concat(F.lit(prefix), day_number(ts_ms).cast("string"))
