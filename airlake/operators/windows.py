"""Trailing windows over a complete hourly grid.

All of these share one ``partitionBy(key).orderBy(hour)``: stacked together they cost one Exchange and
one Sort. On a grid a key holds at most one row per hour, so its window partition is bounded by the
length of the history (about 8,800 rows a year) however many raw readings arrived.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from airlake.functions.numeric import fixed_avg, fixed_sum


def series(key: str, hour: str) -> WindowSpec:
    return Window.partitionBy(key).orderBy(hour)


def trailing(key: str, hour: str, rows: int) -> WindowSpec:
    """The current row and the ``rows - 1`` before it."""
    return series(key, hour).rowsBetween(-(rows - 1), 0)


def running(key: str, hour: str) -> WindowSpec:
    return series(key, hour).rowsBetween(Window.unboundedPreceding, 0)


def rolling_mean(value: str, key: str, hour: str, rows: int) -> Column:
    return fixed_avg(value, trailing(key, hour, rows))


def rolling_sum(value: str, key: str, hour: str, rows: int) -> Column:
    return fixed_sum(value, trailing(key, hour, rows))


def is_flat(value: str, key: str, hour: str, rows: int) -> Column:
    """Stuck sensor: a full window of identical non-null values."""
    w = trailing(key, hour, rows)
    full = F.count(value).over(w) == rows
    return full & F.coalesce(F.max(value).over(w) == F.min(value).over(w), F.lit(False))


def lags(value: str, key: str, hour: str, steps: tuple[int, ...], prefix: str) -> list[Column]:
    w = series(key, hour)
    return [F.lag(value, n).over(w).alias(f"{prefix}{n}") for n in steps]


def last_valid(value: str | Column, key: str, hour: str) -> Column:
    """Last non-null value up to and including the current row (carry-forward)."""
    return F.last(value, ignorenulls=True).over(running(key, hour))


def last_seen(is_seen: Column, key: str, hour: str) -> Column:
    """Newest hour up to the current row at which ``is_seen`` held."""
    return F.max(F.when(is_seen, F.col(hour))).over(running(key, hour))


def same_clock_mean(value: str, key: str, hour: str, days: int = 7) -> Column:
    """Mean of the previous ``days`` rows at the same hour of day, current row excluded."""
    w = Window.partitionBy(key, F.hour(hour)).orderBy(hour).rowsBetween(-days, -1)
    return fixed_avg(value, w)


def changes(df: DataFrame, key: str, hour: str, state: str) -> DataFrame:
    """Rows whose state differs from the previous one of the same key (first rows included)."""
    previous = F.lag(state).over(series(key, hour))
    return df.withColumn("previous", previous).filter(
        F.col("previous").isNull() | (F.col("previous") != F.col(state))
    )
