"""Clock and calendar expressions. Timestamps are UTC; IST is used only for civil days."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

IST_OFFSET = "INTERVAL '5:30' HOUR TO MINUTE"


def as_ts(value: Column | datetime | str) -> Column:
    """A clock argument as a timestamp column (operators never read the wall clock).

    Naive datetimes are UTC. They travel as text, because a datetime literal would be shifted by the
    time zone of the Python process.
    """
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(UTC).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def iso_ts(text: Column | str) -> Column:
    """``2026-01-01T00:00:00Z`` -> timestamp."""
    return F.to_timestamp(col(text))


def minute_ts(text: Column | str) -> Column:
    """``2026-01-01T00:00`` (already UTC) -> timestamp."""
    return F.to_timestamp(col(text), "yyyy-MM-dd'T'HH:mm")


def date_hhmm_ts(day: Column | str, hhmm: Column | str) -> Column:
    """A date plus an integer clock such as 635 (06:35) -> timestamp."""
    t = col(hhmm).cast("int")
    d = col(day).cast("date")
    return F.make_timestamp(
        F.year(d), F.month(d), F.day(d), (t / 100).cast("int"), t % 100, F.lit(0).cast("decimal(8,6)")
    )


def add(ts: Column | str, unit: str, amount: Column | int) -> Column:
    return F.timestamp_add(unit, amount if isinstance(amount, Column) else F.lit(amount), col(ts))


def whole(unit: str, start: Column | str, end: Column | str) -> Column:
    """Complete units between two instants, truncated toward zero."""
    return F.timestamp_diff(unit, col(start), col(end))


def hour_floor(ts: Column | str) -> Column:
    return F.date_trunc("hour", col(ts))


def half_hour_floor(ts: Column | str) -> Column:
    """Floor to the station hour, which starts at :30 UTC."""
    return add(F.date_trunc("hour", add(ts, "MINUTE", -30)), "MINUTE", 30)


def last_complete_hour(as_of: Column | datetime | str) -> Column:
    """Start of the newest station hour that has fully passed."""
    return add(half_hour_floor(as_ts(as_of)), "HOUR", -1)


def ist(ts: Column | str) -> Column:
    return col(ts) + F.expr(IST_OFFSET)


def ist_date(ts: Column | str) -> Column:
    return ist(ts).cast("date")


def iso_weekday(ts: Column | str) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(col(ts)) + 1


def month_key(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyy-MM")


def iso_text(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")
