"""Fire detections: product preference, placement around the city, daily and rolling counts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.config import CONFIG, NW_ARC, Config
from airlake.functions.geo import bearing_deg, distance_band, haversine_km, sector_index, sector_name, sector_position
from airlake.functions.numeric import fixed_sum, half_up
from airlake.functions.time import add, as_ts, hour_floor
from airlake.operators.reshape import with_neighbours
from airlake.operators.timegrid import sector_hours
from airlake.operators.windows import rolling_sum, trailing

PRIMARY = "VIIRS_SNPP"


def _archived(points: DataFrame) -> DataFrame:
    return points.withColumn("_archive", F.coalesce(F.col("product") == "SP", F.lit(False)))


def preferred_product(points: DataFrame) -> DataFrame:
    """Archive over near-real-time per (day, sensor), every sensor kept.

    The choice is made on one partially aggregated flag per (day, sensor) and brought back as a semi
    join, so no window ever holds the detections of a day.
    """
    marked = _archived(points)
    keep = marked.groupBy("acq_date", "sensor").agg(F.bool_or("_archive").alias("_archive"))
    return marked.join(keep, ["acq_date", "sensor", "_archive"], "left_semi").drop("_archive")


def preferred(points: DataFrame) -> DataFrame:
    """One sensor per day (the primary one when it saw anything), archive files first."""
    marked = _archived(points)
    per_sensor = marked.groupBy("acq_date", "sensor").agg(F.bool_or("_archive").alias("_archive"))
    rank = F.struct(F.when(F.col("sensor") == PRIMARY, 0).otherwise(1), F.col("sensor"))
    keep = (
        per_sensor.groupBy("acq_date")
        .agg(F.min_by(F.struct("sensor", "_archive"), rank).alias("best"))
        .select("acq_date", "best.sensor", "best._archive")
    )
    return marked.join(keep, ["acq_date", "sensor", "_archive"], "left_semi").drop("_archive")


def locate(points: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """Detections with distance, bearing, sector and band as seen from the city centre."""
    here = (cfg.centre_lat, cfg.centre_lon, "latitude", "longitude")
    placed = preferred(points).filter("confidence <> 'l'").select(
        "*", haversine_km(*here).alias("_km"), bearing_deg(*here).alias("_bearing")
    )
    return placed.select(
        F.lit(cfg.city_id).alias("city_id"),
        "sensor", "product", "acquired_at_utc", "acq_date", "latitude", "longitude", "frp_mw",
        "confidence", "daynight",
        F.round("_km", 1).alias("distance_km"),
        F.round("_bearing", 1).alias("bearing_deg"),
        sector_name(sector_index("_bearing")).alias("sector"),
        distance_band("_km").alias("distance_band"),
    )


def daily(located: DataFrame) -> DataFrame:
    return located.groupBy("city_id", "acq_date", "sector", "distance_band").agg(
        F.count(F.lit(1)).alias("fire_count"), half_up(fixed_sum("frp_mw"), 1).alias("frp_sum_mw")
    )


def hourly(located: DataFrame) -> DataFrame:
    return located.groupBy("sector", hour_floor("acquired_at_utc").alias("hour_utc")).agg(
        F.count(F.lit(1)).alias("n"), fixed_sum("frp_mw").alias("frp")
    )


def rolling(located: DataFrame, as_of: Column | datetime, cfg: Config = CONFIG) -> DataFrame:
    """24/48/72 h sums per sector and hour, stamped with the first hour a forecast may use them."""
    counts = hourly(located)
    until = add(hour_floor(as_ts(as_of)), "HOUR", cfg.fire_grid_ahead_hours)
    first = counts.agg(F.min("hour_utc").alias("first_hour"))
    grid = sector_hours(first, until).join(counts, ["sector", "hour_utc"], "left").select(
        "sector", "hour_utc",
        F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("frp", F.lit(0.0)).alias("frp"),
    )

    def count_over(rows: int) -> Column:
        return F.sum("n").over(trailing("sector", "hour_utc", rows))

    return grid.select(
        "sector",
        sector_position("sector").alias("sector_index"),
        add("hour_utc", "HOUR", 1 + cfg.fire_lag_hours).alias("as_of_utc"),
        add("hour_utc", "HOUR", 1).alias("window_end_utc"),
        count_over(24).alias("n_24h"),
        count_over(48).alias("n_48h"),
        count_over(72).alias("n_72h"),
        half_up(rolling_sum("frp", "sector", "hour_utc", 24), 1).alias("frp_24h"),
    )


def nw_arc(rolled: DataFrame) -> DataFrame:
    return rolled.filter(F.col("sector").isin(*NW_ARC)).groupBy("as_of_utc").agg(
        F.max("window_end_utc").alias("fires_window_end_utc"),
        F.sum("n_24h").alias("fires_nw_arc_24h"),
        F.sum("n_72h").alias("fires_nw_arc_72h"),
    )


def upwind(rolled: DataFrame) -> DataFrame:
    """Sums over a wind sector and its two neighbours: expand to neighbours, then equality groups."""
    spread = with_neighbours(rolled, "sector_index", "wind_index")
    return spread.groupBy("as_of_utc", "wind_index").agg(
        F.sum("n_24h").alias("fires_upwind_24h"),
        F.sum("n_48h").alias("fires_upwind_48h"),
        F.sum("n_72h").alias("fires_upwind_72h"),
        fixed_sum("frp_24h").alias("fires_upwind_frp_24h"),
    )
