"""Freshness of stations, of the feed as a whole, and of raw sources."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.config import CONFIG, Config
from airlake.functions.status import (
    change_message,
    feed_class,
    feed_message,
    freshness,
    source_freshness_class,
    station_message,
)
from airlake.functions.time import as_ts, whole
from airlake.operators.windows import changes, last_seen

KEY, HOUR = "location_id", "hour_start_utc"


def age_hours(last: Column | str, as_of: Column) -> Column:
    """Age from whole minutes."""
    return whole("MINUTE", last, as_of) / 60.0


def station_status(
    stations: DataFrame, latest: DataFrame, as_of: Column | datetime, cfg: Config = CONFIG
) -> DataFrame:
    """Every station with its last reading, last check and freshness class."""
    now = as_ts(as_of)
    pm25_at = F.when(F.col("parameter") == "pm25", F.col("reading_utc"))
    last = latest.groupBy(KEY).agg(
        F.max(pm25_at).alias("last_pm25_reading_utc"),
        F.max_by("value", pm25_at).alias("last_pm25_value"),
        F.max("reading_utc").alias("last_any_reading_utc"),
        F.max("last_fetched_at").alias("last_checked_utc"),
    )
    return stations.select(KEY, "station_name", "zone_id", "city_id").join(last, KEY, "left").select(
        "*",
        now.alias("snapshot_at"),
        age_hours("last_pm25_reading_utc", now).alias("age_hours"),
        freshness(age_hours("last_pm25_reading_utc", now), cfg).alias("status"),
    )


def feed_status(grid: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """Per hour, how many tracked stations had reported recently, and the feed class."""
    seen = grid.select(KEY, HOUR, last_seen(~F.col("is_missing"), KEY, HOUR).alias("_last"))
    live = F.coalesce(whole("HOUR", "_last", HOUR) <= cfg.live_max_hours, F.lit(False))
    counted = seen.groupBy(HOUR).agg(
        F.count(F.lit(1)).alias("stations_tracked"),
        F.count_if(live).alias("stations_live"),
        F.max("_last").alias("newest_report_utc"),
    )
    share = F.round(1 - F.col("stations_live") / F.col("stations_tracked"), 3)
    return counted.select(
        HOUR, "stations_tracked", "stations_live", share.alias("share_not_live"), "newest_report_utc",
        feed_class(share, cfg).alias("feed_status"),
    )


def feed_report(
    last_readings: DataFrame, as_of: Column | datetime, ts: str = "last_pm25_reading_utc",
    cfg: Config = CONFIG,
) -> DataFrame:
    """One row on the whole source from each station's last reading, classed as in :func:`station_status`; no stations means outage."""
    live = F.coalesce(freshness(age_hours(ts, as_ts(as_of)), cfg) == "live", F.lit(False))
    n = F.count(F.lit(1))
    totals = last_readings.agg(
        n.alias("stations_total"),
        F.count_if(live).alias("stations_live"),
        F.coalesce((n - F.count_if(live)) / F.nullif(n, F.lit(0)), F.lit(1.0)).alias("share_not_live"),
        F.max(ts).alias("newest_reading_utc"),
    )
    return totals.select(
        "*",
        feed_class("share_not_live", cfg).alias("feed_status"),
        feed_message(feed_class("share_not_live", cfg), F.col("share_not_live"), F.col("newest_reading_utc"))
        .alias("feed_message"),
    )


def station_messages(status: DataFrame, as_of: Column | datetime, cfg: Config = CONFIG) -> DataFrame:
    """Stations with their banner, given the state of the feed (one row, read as scalars)."""
    now = as_ts(as_of)
    feed = feed_report(status, now, cfg=cfg).select("feed_status").scalar()
    return status.withColumn(
        "message", station_message(F.col("status"), F.col("last_pm25_reading_utc"), now, feed)
    )


def status_changes(feed: DataFrame) -> DataFrame:
    """Hours at which the feed class changed, with the announcement (NULL when silent)."""
    one = feed.withColumn("_feed", F.lit("feed"))
    out = changes(one, "_feed", HOUR, "feed_status")
    return out.select(
        HOUR, "previous", "feed_status", "share_not_live", "newest_report_utc",
        change_message(
            F.col("previous"), F.col("feed_status"), F.col("share_not_live"), F.col("newest_report_utc")
        ).alias("announcement"),
    )


def source_freshness(
    df: DataFrame, ts: str, warn_hours: float, error_hours: float, as_of: Column | datetime,
    by: list[str] | None = None,
) -> DataFrame:
    """Age of the newest row (per source) against warn and error limits."""
    newest = df.groupBy(*(by or [])).agg(F.max(ts).alias("newest_utc"))
    age = age_hours("newest_utc", as_ts(as_of))
    return newest.select(
        "*", age.alias("age_hours"), source_freshness_class(age, warn_hours, error_hours).alias("freshness")
    )
