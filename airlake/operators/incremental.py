"""High-water marks and partition predicates for bounded re-reads.

A mark is resolved to a literal on the driver (one ``max`` over one column) because only a literal
prunes directories at planning time.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALL = "0000"


def _max(df: DataFrame | None, column: str) -> datetime | None:
    if df is None:
        return None
    return df.agg(F.max(F.col(column).cast("timestamp_ntz"))).first()[0]


def since_day(target: DataFrame | None, column: str, days: int, fmt: str = "%Y-%m-%d") -> str:
    """``max(column) - days`` as a partition literal; ``'0000'`` (read all) on the first run."""
    newest = _max(target, column)
    return ALL if newest is None else (newest - timedelta(days=days)).strftime(fmt)


def since_hour(
    target: DataFrame | None,
    fetched: str,
    lookback_hours: int = 6,
) -> datetime | None:
    """Fetch-time mark. After a stop of any length everything since is read again; no hour is passed over."""
    newest = _max(target, fetched)
    if newest is None:
        return None
    return newest - timedelta(hours=lookback_hours)


def hours_from(mark: datetime | None) -> Column:
    """Lexicographic ``(dt, hour)`` predicate over string partition columns."""
    if mark is None:
        return F.lit(True)
    day, hour = mark.strftime("%Y-%m-%d"), mark.strftime("%H")
    return (F.col("dt") > day) | ((F.col("dt") == day) & (F.col("hour") >= hour))


def hours_before(as_of: datetime, hours: int) -> Column:
    return hours_from(as_of - timedelta(hours=hours))


def todo(expected: DataFrame, existing: DataFrame, keys: list[str], recent: Column) -> DataFrame:
    """Expected chunks not landed yet, plus every recent one (always refreshed)."""
    missing = expected.filter(~recent).join(existing.select(*keys), keys, "left_anti")
    return missing.unionByName(expected.filter(recent))


def todo_days(landed: DataFrame, keys: list[str], day: str, recent_days: int) -> DataFrame:
    """For each key how many days to fetch between its first and last landed day, and the last of them.

    Those are the days that have not landed and the ``recent_days`` last ones, as :func:`todo` lists them; here they are counted from the landed days,
    so that a span costs its landed days and not its length.
    """
    days = landed.where(F.col(day).isNotNull()).select(*keys, day).distinct()
    days = days.withColumn("last_day", F.max(day).over(Window.partitionBy(*keys)))
    old = F.count_if(F.date_diff("last_day", day) >= recent_days)
    return days.groupBy(*keys, "last_day").agg((F.date_diff("last_day", F.min(day)) + 1 - old).alias("days_to_fetch")).select(
        *keys, "days_to_fetch", "last_day"
    )
