"""Station hours: complete grid, quality flags, 24 h means, area medians, city days, dimensions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.config import CONFIG, NW_ARC, Config
from airlake.functions import aqi
from airlake.functions.numeric import fixed_avg, half_up
from airlake.functions.time import add, as_ts, ist_date
from airlake.operators.timegrid import with_gaps
from airlake.operators.windows import is_flat, rolling_mean, trailing

KEY, HOUR = "location_id", "hour_start_utc"


def flag_quality(grid: DataFrame, cfg: Config = CONFIG, flat_value: str = "pm25_raw") -> DataFrame:
    """Flags per grid hour and the verdict ``is_valid``; ``pm25`` is kept only when valid.

    Gaps stay gaps: they are flagged, not filled.
    """
    flagged = grid.select(
        "*",
        F.col("pm25_raw").isNull().alias("is_missing"),
        F.coalesce(F.col("percent_complete") < cfg.min_coverage_pct, F.lit(False)).alias("is_low_coverage"),
        is_flat(flat_value, KEY, HOUR, cfg.flatline_hours).alias("is_flatline"),
    ).withColumn("is_out_of_range", F.coalesce("is_out_of_range", F.lit(False)))
    good = ~(
        F.col("is_missing") | F.col("is_out_of_range") | F.col("is_low_coverage") | F.col("is_flatline")
    )
    return flagged.select(
        "*",
        good.alias("is_valid"),
        F.when(good, F.col("pm25_raw")).alias("pm25"),
        add(HOUR, "HOUR", 1).alias("hour_end_utc"),
    )


def station_hourly(readings: DataFrame, as_of: Column | datetime, cfg: Config = CONFIG) -> DataFrame:
    """Unique staged readings -> complete flagged grid up to the last full hour before ``as_of``."""
    rows = readings.withColumnRenamed("pm25", "pm25_raw")
    return flag_quality(with_gaps(rows, KEY, HOUR, as_ts(as_of)), cfg)


def aqi_hourly(grid: DataFrame, stations: DataFrame, cfg: Config = CONFIG, breakpoints: DataFrame | None = None) -> DataFrame:
    """24 h mean (enough valid hours only), category and sub-index, with station attributes.

    With ``breakpoints`` the bands are those of the table instead of the configured ones.
    """
    day = trailing(KEY, HOUR, 24)
    valid_hours = F.count("pm25").over(day)
    rolled = grid.select(
        KEY, HOUR, "hour_end_utc", "pm25", "pm25_raw", "is_valid", "is_missing",
        valid_hours.alias("valid_hours_24h"),
        rolling_mean("pm25", KEY, HOUR, 24).alias("_mean"),
    ).withColumn(
        "pm25_24h",
        F.when(F.col("valid_hours_24h") >= cfg.min_hours_for_24h, half_up("_mean", 1)),
    )
    dims = stations.select(
        KEY, "zone_id", "city_id", F.col("colocated_with").isNotNull().alias("is_colocated_duplicate")
    )
    rows = rolled.join(dims, KEY)
    if breakpoints is None:
        rows = rows.withColumns({
            "aqi_category": aqi.category("pm25_24h", cfg),
            "aqi_category_order": aqi.category_order("pm25_24h", cfg),
            "pm25_subindex": aqi.subindex("pm25_24h", cfg),
        })
    else:
        rows = aqi.with_bands(rows, "pm25_24h", breakpoints, "aqi_category", "aqi_category_order", "pm25_subindex")
    return rows.select(
        KEY, "zone_id", "city_id", HOUR, "hour_end_utc", "pm25", "pm25_raw", "is_valid", "is_missing",
        "valid_hours_24h", "pm25_24h", "aqi_category", "aqi_category_order", "pm25_subindex", "is_colocated_duplicate",
    )


def area_hourly(aqi_rows: DataFrame, area: str) -> DataFrame:
    """Exact median over the area's stations per hour, with reporting counters.

    A group is one area in one hour: a value per station, counted by distinct value on the map side already.
    """
    rows = aqi_rows.filter("NOT is_colocated_duplicate")
    return rows.groupBy(area, HOUR).agg(
        F.median("pm25").alias("pm25_median"),
        F.median("pm25_24h").alias("pm25_24h_median"),
        F.count("pm25").alias("stations_reporting"),
        F.count("pm25_24h").alias("stations_with_24h_avg"),
        F.count(F.lit(1)).alias("stations_expected"),
    )


def city_daily(
    aqi_rows: DataFrame, fires_daily: DataFrame, dates: DataFrame, cfg: Config = CONFIG, breakpoints: DataFrame | None = None
) -> DataFrame:
    """City and IST day: median of full station days, its category, the day's fires, festivals."""
    station_day = (
        aqi_rows.filter("NOT is_colocated_duplicate")
        .groupBy("city_id", KEY, ist_date(HOUR).alias("date_ist"))
        .agg(fixed_avg("pm25").alias("day_mean"), F.count("pm25").alias("valid_hours"))
    )
    full = F.col("valid_hours") >= cfg.min_hours_for_24h
    city_day = station_day.groupBy("city_id", "date_ist").agg(
        half_up(F.median(F.when(full, F.col("day_mean"))), 1).alias("pm25_median"),
        F.count_if(full).alias("stations_with_full_day"),
    )
    fires = fires_daily.groupBy("city_id", F.col("acq_date").alias("date_ist")).agg(
        F.sum("fire_count").alias("fires_total"),
        F.sum(F.when(F.col("sector").isin(*NW_ARC), F.col("fire_count")).otherwise(0)).alias("fires_nw_arc"),
    )
    if breakpoints is None:
        city_day = city_day.withColumn("aqi_category", aqi.category("pm25_median", cfg))
    else:
        city_day = aqi.with_bands(city_day, "pm25_median", breakpoints, "aqi_category")
    return (
        city_day.join(fires, ["city_id", "date_ist"], "left")
        .join(dates.select("date_ist", "is_festival", "festival_name"), "date_ist", "left")
        .select(
            "city_id", "date_ist", "pm25_median", "stations_with_full_day",
            "aqi_category",
            F.coalesce("fires_total", F.lit(0)).alias("fires_total"),
            F.coalesce("fires_nw_arc", F.lit(0)).alias("fires_nw_arc"),
            "is_festival", "festival_name",
        )
    )


def dim_station(stations: DataFrame, grid: DataFrame) -> DataFrame:
    """Stations with the quality statistics of their history."""
    stats = grid.groupBy(KEY).agg(
        F.min(HOUR).alias("first_hour_utc"),
        F.max(F.when(~F.col("is_missing"), F.col(HOUR))).alias("last_reported_hour_utc"),
        F.count(F.lit(1)).alias("grid_hours"),
        half_up(F.count_if("is_valid") * 100 / F.count(F.lit(1)), 1).alias("pct_valid_hours"),
    )
    return stations.join(stats, KEY, "left").select(
        *stations.columns,
        F.col("colocated_with").isNotNull().alias("is_colocated_duplicate"),
        "first_hour_utc", "last_reported_hour_utc",
        F.coalesce("grid_hours", F.lit(0)).alias("grid_hours"),
        "pct_valid_hours",
        F.col("first_hour_utc").isNull().alias("has_no_history"),
    )


def dim_zone(zones: DataFrame, stations: DataFrame, points: DataFrame) -> DataFrame:
    """Zones with their station count (0 when none) and weather point."""
    counts = stations.groupBy("zone_id").agg(F.count(KEY).alias("station_count"))
    where = points.select(
        F.col("point_id").alias("zone_id"),
        F.col("latitude").alias("weather_point_lat"),
        F.col("longitude").alias("weather_point_lon"),
    )
    return (
        zones.join(counts, "zone_id", "left")
        .join(where, "zone_id", "left")
        .select(
            "zone_id", "zone_name", "city_id",
            F.coalesce("station_count", F.lit(0)).alias("station_count"),
            "weather_point_lat", "weather_point_lon",
        )
    )


def dim_city(cities: DataFrame) -> DataFrame:
    return cities.select("city_id", "city_name", "timezone")


def zone_centroids(stations: DataFrame) -> DataFrame:
    """One weather point per zone: the mean position of its non-co-located stations, 4 digits."""
    return (
        stations.filter("colocated_with IS NULL")
        .groupBy("zone_id")
        .agg(
            half_up(fixed_avg("latitude"), 4).alias("latitude"),
            half_up(fixed_avg("longitude"), 4).alias("longitude"),
        )
        .withColumnRenamed("zone_id", "point_id")
    )
