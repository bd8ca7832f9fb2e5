"""Regular time axes: hourly grids with explicit gaps, calendars, chunk lists."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airlake.config import SECTORS
from airlake.functions.time import add, col, iso_weekday, last_complete_hour

ONE_HOUR = "INTERVAL '1' HOUR"
ONE_DAY = "INTERVAL '1' DAY"


def hourly_grid(df: DataFrame, key: str, hour: str, last_hour: Column) -> DataFrame:
    """Every hour per key from its first row up to ``last_hour``; only the key bounds are shuffled."""
    bounds = df.groupBy(key).agg(F.min(hour).alias("_first"))
    return bounds.filter(F.col("_first") <= last_hour).select(
        key, F.explode(F.sequence("_first", last_hour, F.expr(ONE_HOUR))).alias(hour)
    )


def with_gaps(df: DataFrame, key: str, hour: str, as_of: Column) -> DataFrame:
    """The complete hourly grid of unique (key, hour) rows; gap hours carry NULLs.

    Each row is spread over the hours up to the next row of its key (the last one up to the last
    complete hour). That needs no grid table and no join, and the result is already partitioned by
    key for the windows that follow.
    """
    last_hour = last_complete_hour(as_of)
    following = F.lead(hour).over(Window.partitionBy(key).orderBy(hour))
    spread = df.filter(F.col(hour) <= last_hour).withColumn(
        "_until", F.coalesce(following - F.expr(ONE_HOUR), last_hour)
    )
    every = spread.withColumn("_hour", F.explode(F.sequence(hour, "_until", F.expr(ONE_HOUR))))
    measured = F.col("_hour") == F.col(hour)
    return every.select(
        key,
        F.col("_hour").alias(hour),
        *[F.when(measured, F.col(c)).alias(c) for c in df.columns if c not in (key, hour)],
    )


def sector_hours(first_hour: DataFrame, last_hour: Column) -> DataFrame:
    """Sector x hour axis from a one-row frame holding ``first_hour``."""
    hours = first_hour.filter(F.col("first_hour") <= last_hour).select(
        F.explode(F.sequence("first_hour", last_hour, F.expr(ONE_HOUR))).alias("hour_utc")
    )
    sectors = F.explode(F.array(*[F.lit(s) for s in SECTORS]))
    return hours.select(sectors.alias("sector"), "hour_utc")


def civil_dates(bounds: DataFrame, festivals: DataFrame | None = None) -> DataFrame:
    """Calendar between the ``first_date`` and ``last_date`` of a one-row frame."""
    days = bounds.select(
        F.explode(F.sequence("first_date", "last_date", F.expr(ONE_DAY))).alias("date_ist")
    )
    out = days.select(
        "date_ist",
        F.year("date_ist").alias("year"),
        F.month("date_ist").alias("month"),
        iso_weekday("date_ist").alias("day_of_week"),
        iso_weekday("date_ist").isin(6, 7).alias("is_weekend"),
    )
    if festivals is None:
        return out.select(
            "*", F.lit(False).alias("is_festival"), F.lit(None).cast("string").alias("festival_name")
        )
    named = festivals.select(F.col("date").alias("date_ist"), F.col("name").alias("festival_name"))
    return out.join(named, "date_ist", "left").select(
        *out.columns, F.col("festival_name").isNotNull().alias("is_festival"), "festival_name"
    )


def month_chunks(df: DataFrame, start: str, end: str) -> DataFrame:
    """Per row, the calendar months of [start, end] clipped to it (``chunk_start``, ``chunk_end``)."""
    months = F.sequence(F.trunc(col(start), "month"), col(end), F.expr("INTERVAL '1' MONTH"))
    return df.withColumn("_month", F.explode(months)).select(
        *df.columns,
        F.greatest(col(start), F.col("_month")).alias("chunk_start"),
        F.least(col(end), F.last_day("_month")).alias("chunk_end"),
    )


def day_chunks(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.withColumn("day", F.explode(F.sequence(col(start), col(end), F.expr(ONE_DAY))))


def months_between(spark: SparkSession, start: date, end: date) -> DataFrame:
    one = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return month_chunks(one, "start", "end").select("chunk_start", "chunk_end")


def shifted(ts: str, hours: int = 0, minutes: int = 0) -> Column:
    return add(add(ts, "HOUR", hours), "MINUTE", minutes)
