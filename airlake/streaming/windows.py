"""Hourly counts, sliding sums and dedupe inside a stream.

These keep their totals (or the keys seen) in the state store: a lateness bounds the state and accepts that later rows are
dropped, which the caller has to ask for. :mod:`airlake.streaming.runs` has the forms without state, which drop nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.functions.numeric import fixed_sum
from airlake.functions.time import add



def _bounded(stream: DataFrame, ts: str, lateness: str | None) -> DataFrame:
    return stream.withWatermark(ts, lateness) if lateness else stream


def hourly_counts(
    stream: DataFrame, by: Sequence[str], ts: str, value: str, lateness: str | None = None
) -> DataFrame:
    """Tumbling hour per key."""
    return (
        _bounded(stream, ts, lateness)
        .groupBy(F.window(ts, "1 hour"), *by)
        .agg(F.count(F.lit(1)).alias("n"), fixed_sum(value).alias("total"))
        .select(*by, F.col("window.start").alias("hour_utc"), "n", "total")
    )


def sliding_sums(hours: DataFrame, by: Sequence[str], width: int) -> DataFrame:
    """Trailing ``width`` hours from hourly counts: each hour is added to the windows it is part of.

    Works on the hourly totals, never on raw rows, so the fan-out touches a few rows per key and day.
    """
    start = F.explode(F.sequence(F.lit(0), F.lit(width - 1)))
    spread = hours.withColumn("_back", start).withColumn(
        "window_start_utc", add("hour_utc", "HOUR", -F.col("_back"))
    )
    return spread.groupBy(*by, "window_start_utc").agg(
        F.sum("n").alias("n"), fixed_sum("total").alias("total")
    ).select(
        *by, "window_start_utc", add("window_start_utc", "HOUR", width).alias("window_end_utc"), "n", "total"
    )


def first_seen_only(stream: DataFrame, keys: Sequence[str], ts: str, lateness: str | None = None) -> DataFrame:
    """Drop repeats (first wins): only for feeds that never correct a row."""
    if lateness is None:
        return stream.dropDuplicates(list(keys))
    return _bounded(stream, ts, lateness).dropDuplicatesWithinWatermark(list(keys))
