"""Arguments of queries, checked on the driver before a plan is built."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.schemas import LOOKBACK_HOURS

#: Names of time steps. Fixed values.
INTERVALS = {
    "1 minute": ("minute", "1m", "1min"),
    "5 minutes": ("five_minute", "5m", "5min", "5minute"),
    "1 hour": ("hour", "1h"),
    "1 day": ("day", "1d"),
}
#: Range presets: how far back, and the step. Fixed values.
PRESETS = {"24h": (timedelta(hours=24), "5 minutes"), "7d": (timedelta(days=7), "1 hour"), "30d": (timedelta(days=30), "1 day")}


def require_positive(name: str, value: int) -> int:
    if value <= 0:
        raise ValueError(f"{name} must be positive, not {value}")
    return value


def parse_interval(text: str | None) -> str:
    """The step for a name in any case; blank: an hour."""
    known = (text or "").strip().lower() or "hour"
    for step, names in INTERVALS.items():
        if known in names:
            return step
    raise ValueError(f"unknown interval: {text}")


def bucket(time_col: str | Column, interval: str | None) -> Column:
    """The start of the time's step. Unlike date_trunc, window() keeps the column's type."""
    return F.window(time_col, parse_interval(interval)).start


def _moment(value: str | datetime | None, default: datetime) -> datetime:
    if value is None or isinstance(value, str) and not value.strip():
        return default
    found = datetime.fromisoformat(value.strip()) if isinstance(value, str) else value
    return found.astimezone(timezone.utc).replace(tzinfo=None) if found.tzinfo else found


def resolve_range(from_=None, to=None, now: datetime | None = None) -> tuple[datetime, datetime]:
    """A half-open range in UTC: ``to`` is now unless given, ``from_`` a day before it."""
    end = _moment(to, now or datetime.now(timezone.utc).replace(tzinfo=None))
    start = _moment(from_, end - timedelta(hours=LOOKBACK_HOURS))
    if start >= end:
        raise ValueError(f"from must be before to: {start} >= {end}")
    return start, end


def preset_range(key: str | None, now: datetime) -> tuple[datetime, datetime, str]:
    back, step = PRESETS.get(key or "", PRESETS["24h"])
    return now - back, now, step


def in_range(df: DataFrame, from_=None, to=None, time_col: str = "event_time", now: datetime | None = None) -> DataFrame:
    """Rows of [from, to). Where the table is partitioned by event_date, its days are pruned too."""
    start, end = resolve_range(from_, to, now)
    kind = dict(df.dtypes)[time_col]
    at = lambda v: F.lit(v.isoformat(sep=" ")).cast(kind)
    df = df.where((F.col(time_col) >= at(start)) & (F.col(time_col) < at(end)))
    if "event_date" in df.columns:
        df = df.where(F.col("event_date").between(F.lit(start.date()), F.lit(end.date())))
    return df


def of_type(df: DataFrame, event_type: str | None = None) -> DataFrame:
    """Rows of one event type; blank: all."""
    return df.where(F.col("event_type") == event_type) if event_type and event_type.strip() else df


def length(interval: str) -> timedelta:
    """An interval of fixed length, "5 seconds" to "2 weeks", as Python has it."""
    n, unit = interval.split()
    return timedelta(**{unit.rstrip("s") + "s": int(n)})
