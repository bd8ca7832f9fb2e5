"""Queries behind the pages and the read API, as DataFrames."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.config import CONFIG, Config
from airlake.functions import aqi
from airlake.functions.status import STALE_FORECAST, fill, hour_window_text, ist_text
from airlake.functions.time import as_ts, whole
from airlake.operators.dedupe import arg_max, newest
from airlake.operators.reshape import melt
from airlake.operators.spatial import nearest
from airlake.plans.status import feed_report, station_messages

KEY, HOUR = "location_id", "hour_start_utc"


def latest_24h(aqi_rows: DataFrame) -> DataFrame:
    """Each station's newest hour with a 24 h mean."""
    row = F.struct("pm25_24h", "aqi_category", F.col(HOUR).alias("pm25_24h_as_of_utc"))
    best = arg_max(aqi_rows.filter("pm25_24h IS NOT NULL"), [KEY], F.col(HOUR), best=row)
    return best.select(KEY, "best.*")


def station_overview(stations: DataFrame, status: DataFrame, aqi_rows: DataFrame, zones: DataFrame) -> DataFrame:
    """One row per station: identity, zone, status, last reading, newest 24 h mean."""
    state = status.select(KEY, "status", "last_pm25_reading_utc", "last_pm25_value", "last_checked_utc")
    return (
        stations.join(state, KEY, "left")
        .join(latest_24h(aqi_rows), KEY, "left")
        .join(zones.select("zone_id", "zone_name"), "zone_id", "left")
        .orderBy("station_name", KEY)
    )


def zone_summary(zone_rows: DataFrame, zones: DataFrame) -> DataFrame:
    """Each zone's newest hour with a 24 h median, worst first."""
    last = newest(zone_rows.filter("pm25_24h_median IS NOT NULL"), ["zone_id"], HOUR)
    return last.join(zones.select("zone_id", "zone_name"), "zone_id", "left").orderBy(
        F.col("pm25_24h_median").desc(), "zone_id"
    )


def nearest_stations(overview: DataFrame, lat: float, lon: float, n: int) -> DataFrame:
    return nearest(overview, lat, lon, n)


def stations(overview: DataFrame, as_of: Column | datetime, zone: str | None = None, cfg: Config = CONFIG) -> DataFrame:
    """API station list with the freshness message; optionally one zone."""
    messages = station_messages(overview, as_of, cfg)
    rows = messages if zone is None else messages.filter(F.col("zone_id") == zone)
    return rows.withColumn("last_reading_ist", ist_text("last_pm25_reading_utc"))


def forecast(forecast_rows: DataFrame, station_id: int | None = None) -> DataFrame:
    """Latest issue per station (or one station), horizons in order, with a warning when stale."""
    rows = forecast_rows if station_id is None else forecast_rows.filter(F.col(KEY) == station_id)
    latest = rows.filter(F.col("issue_time_utc") == rows.agg(F.max("issue_time_utc")).scalar())
    warning = F.when(
        F.col("is_stale_input"),
        fill(
            STALE_FORECAST,
            when=F.coalesce(ist_text("last_valid_hour_utc"), F.lit("unknown")),
            age=F.coalesce(F.col("input_age_hours").cast("string"), F.lit("unknown")),
        ),
    )
    return latest.select(
        KEY, "horizon_h", "issue_time_utc", "target_hour_start_utc",
        hour_window_text("target_hour_start_utc").alias("target_hour_ist"),
        "pm25_pred",
        aqi.indicative_category("pm25_pred").alias("aqi_category_indicative"),
        "is_stale_input", "input_age_hours", "last_valid_hour_utc", "model_version",
        warning.alias("warning"),
    ).orderBy(KEY, "horizon_h")


def health(
    status: DataFrame, exported_at: Column | datetime, as_of: Column | datetime,
    model_version: str | None = None, cfg: Config = CONFIG,
) -> DataFrame:
    """One row: ok only while the feed is ok and the snapshot is younger than three hours."""
    age = whole("SECOND", as_ts(exported_at), as_ts(as_of)) / 60.0
    report = feed_report(status, as_of, cfg=cfg)
    ok = (F.col("feed_status") == "ok") & (age < 180)
    return report.select(
        F.when(ok, "ok").otherwise("degraded").alias("status"),
        as_ts(exported_at).alias("exported_at_utc"),
        F.round(age, 1).alias("snapshot_age_minutes"),
        "feed_status", "feed_message", "stations_total", "stations_live",
        F.lit(model_version).alias("model_version"),
    )


def city_now(city_rows: DataFrame) -> DataFrame:
    """Newest 24 h median per city with its category."""
    last = newest(city_rows.filter("pm25_24h_median IS NOT NULL"), ["city_id"], HOUR)
    return last.select(
        "city_id", HOUR, "pm25_24h_median",
        aqi.indicative_category("pm25_24h_median").alias("aqi_category"),
        "stations_reporting", "stations_expected",
    )


def city_tomorrow(forecast_rows: DataFrame) -> DataFrame:
    """Median of the latest 24 h forecasts per city, and whether any used stale inputs."""
    day = forecast_rows.filter("horizon_h = 24")
    latest = day.filter(F.col("issue_time_utc") == forecast_rows.agg(F.max("issue_time_utc")).scalar())
    out = latest.groupBy("city_id").agg(
        F.median("pm25_pred").alias("pm25_pred_median"), F.bool_or("is_stale_input").alias("any_stale")
    )
    return out.withColumn("aqi_category", aqi.indicative_category("pm25_pred_median"))


def history_series(aqi_rows: DataFrame) -> DataFrame:
    """Hourly and 24 h values as one long series per station."""
    return melt(aqi_rows, [KEY, HOUR], ["pm25", "pm25_24h"]).filter("value IS NOT NULL")


def forecast_vs_actual(accuracy: DataFrame) -> DataFrame:
    return melt(accuracy, [KEY, "horizon_h", "target_hour_start_utc"], ["pm25_pred", "pm25_actual"])
