"""Station selection from location metadata and the latest reading of every sensor."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.config import CONFIG, LOW_COST_PROVIDERS, Config
from airlake.functions.geo import assign_zone, zone_reason
from airlake.functions.text import agency_of, unit_key
from airlake.functions.time import as_ts
from airlake.operators.spatial import colocated_with

# locations: location_id, name, provider, is_monitor, is_mobile, latitude, longitude, first_utc,
#            last_utc, sensors array<struct<id, parameter, units>>
# latest:    location_id, sensor_id, reading_utc


def is_reference_grade() -> Column:
    """Neither low-cost nor mobile, and either a monitor or named after a known agency."""
    cheap = F.coalesce("provider", F.lit("")).isin(*LOW_COST_PROVIDERS)
    return ~cheap & ~F.col("is_mobile") & (F.col("is_monitor") | agency_of("name").isNotNull())


def candidates(locations: DataFrame, now: Column | datetime, cfg: Config = CONFIG) -> DataFrame:
    recent = F.col("last_utc") >= as_ts(now) - F.expr(f"INTERVAL '{cfg.active_within_days}' DAY")
    has_pm25 = F.exists("sensors", lambda s: s["parameter"] == "pm25")
    return locations.filter(is_reference_grade() & has_pm25 & recent)


def live_sensors(locations: DataFrame, latest: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """(location, sensor) pairs whose newest reading is close to the location's own newest."""
    seen = latest.groupBy("location_id", "sensor_id").agg(F.max("reading_utc").alias("reading_utc"))
    sensors = locations.select("location_id", "last_utc", F.inline("sensors")).withColumnRenamed("id", "sensor_id")
    lag = F.expr(f"INTERVAL '{cfg.live_sensor_lag_days}' DAY")
    return (
        sensors.join(seen, ["location_id", "sensor_id"])
        .filter(F.col("reading_utc") >= F.col("last_utc") - lag)
        .select("location_id", "sensor_id", "parameter", "units", "reading_utc")
    )


def sensor_maps(live: DataFrame) -> DataFrame:
    """Per location: newest PM2.5 sensor, and parameter key -> sensor id.

    A parameter live in two units gets the unit in its key. Map keys are the distinct parameters of
    one location, so the collected map stays small; the sensors behind a key are reduced first.
    """
    shared = live.groupBy("location_id", "parameter").agg(F.count(F.lit(1)).alias("n_live"))
    keyed = live.join(shared, ["location_id", "parameter"]).withColumn(
        "key", F.when(F.col("n_live") == 1, F.col("parameter")).otherwise(unit_key("parameter", "units"))
    )
    one = keyed.groupBy("location_id", "key").agg(F.max("sensor_id").alias("sensor_id"))
    maps = one.groupBy("location_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "sensor_id")))).alias("sensors")
    )
    pm25 = live.filter("parameter = 'pm25'").groupBy("location_id").agg(
        F.max_by("sensor_id", F.struct("reading_utc", "sensor_id")).alias("pm25_sensor_id")
    )
    return pm25.join(maps, "location_id")


def select_stations(
    locations: DataFrame, latest: DataFrame, now: Column | datetime, cfg: Config = CONFIG
) -> DataFrame:
    """Candidates with a live PM2.5 sensor, their zone, and the station they duplicate (if any)."""
    chosen = candidates(locations, now, cfg)
    maps = sensor_maps(live_sensors(chosen, latest, cfg))
    found = chosen.drop("sensors").join(maps, "location_id").select(
        "location_id",
        F.trim("name").alias("station_name"),
        agency_of("name").alias("agency"),
        "provider", "latitude", "longitude", "pm25_sensor_id", "sensors",
        assign_zone("name", "latitude", "longitude", cfg).alias("zone_id"),
        zone_reason("name", "latitude", "longitude", cfg).alias("zone_reason"),
        F.col("first_utc").alias("first_seen_utc"),
        F.col("last_utc").alias("last_seen_utc"),
    )
    return colocated_with(found, cfg=cfg)
