"""Raw envelopes to typed, deduplicated silver rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.config import CONFIG, Config
from airlake.functions.text import product_of, sensor_of
from airlake.functions.time import date_hhmm_ts, hour_floor, iso_ts, minute_ts, whole
from airlake.operators.dedupe import latest_wins, newest
from airlake.operators.reshape import previous_runs_to_rows
from airlake.schemas import BOUNDARY, CAMS, RUN_DAYS, WEATHER
from airlake.sources.envelopes import hourly_rows, page_results, point_responses, station_pages


def out_of_range(value: str, cfg: Config = CONFIG):
    """A missing value counts as out of range."""
    v = F.col(value)
    return v.isNull() | (v < cfg.pm25_min) | (v > cfg.pm25_max)


def stage_pm25(history: DataFrame, live: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """History and live hours: union, type, newest fetch per (station, hour), range flag.

    A tie on fetch time prefers the history file.
    """
    past = page_results(history, "location_id", "fetched_at").withColumn("source", F.lit("history"))
    now = page_results(station_pages(live, "fetched_at"), "location_id", "fetched_at").withColumn(
        "source", F.lit("hourly")
    )
    rows = (
        past.unionByName(now)
        .filter("m.parameter.name = 'pm25'")
        .select(
            "location_id",
            iso_ts("m.period.datetimeFrom.utc").alias("hour_start_utc"),
            iso_ts("m.period.datetimeTo.utc").alias("hour_end_utc"),
            F.col("m.value").alias("pm25"),
            F.col("m.coverage.observedCount").alias("observed_count"),
            F.col("m.coverage.expectedCount").alias("expected_count"),
            F.col("m.coverage.percentComplete").alias("percent_complete"),
            F.col("m.summary.min").alias("pm25_min"),
            F.col("m.summary.max").alias("pm25_max"),
            F.col("m.flagInfo.hasFlags").alias("has_openaq_flags"),
            iso_ts("fetched_at").alias("fetched_at"),
            "source",
        )
    )
    # The value closes the order so that equal fetches cannot flip between runs.
    kept = newest(
        rows, ["location_id", "hour_start_utc"], "fetched_at",
        F.col("source").asc(), F.col("pm25").desc_nulls_last(),
    )
    return kept.withColumn("is_out_of_range", out_of_range("pm25", cfg))


def stage_latest(raw: DataFrame, sensors: DataFrame) -> DataFrame:
    """Newest value per live sensor as seen by each fetch, with first and last sighting."""
    rows = page_results(station_pages(raw, "fetched_at"), "location_id", "fetched_at").select(
        "location_id",
        F.col("m.sensorsId").alias("sensor_id"),
        iso_ts("m.datetime.utc").alias("reading_utc"),
        F.col("m.value").alias("value"),
        iso_ts("fetched_at").alias("fetched_at"),
    )
    seen = rows.groupBy("location_id", "sensor_id", "reading_utc").agg(
        F.max_by(
            "value", F.when(F.col("value").isNotNull(), F.struct("fetched_at", "value"))
        ).alias("value"),
        F.min("fetched_at").alias("first_fetched_at"),
        F.max("fetched_at").alias("last_fetched_at"),
    )
    # Collapsed first, joined second: the join sees one row per reading, not one per fetch.
    return seen.join(sensors.select("sensor_id", "parameter"), "sensor_id").select(
        "location_id", "sensor_id", "parameter", "reading_utc", "value",
        "first_fetched_at", "last_fetched_at",
    )


def stage_weather_forecasts(raw: DataFrame) -> DataFrame:
    rows = hourly_rows(
        point_responses(raw, "forecast_issued_at"), (*WEATHER, BOUNDARY), "point_id", "forecast_issued_at"
    )
    issued, valid = iso_ts("forecast_issued_at"), minute_ts("time")
    return rows.select(
        "point_id",
        issued.alias("issued_at"),
        valid.alias("valid_time_utc"),
        whole("HOUR", hour_floor(issued), valid).alias("lead_hours"),
        *WEATHER,
        BOUNDARY,
    )


def stage_cams_forecasts(raw: DataFrame) -> DataFrame:
    rows = hourly_rows(
        point_responses(raw, "forecast_issued_at"), CAMS, "point_id", "forecast_issued_at"
    )
    issued, valid = iso_ts("forecast_issued_at"), minute_ts("time")
    return rows.select(
        "point_id",
        issued.alias("issued_at"),
        valid.alias("valid_time_utc"),
        whole("HOUR", hour_floor(issued), valid).alias("lead_hours"),
        F.col("pm2_5").alias("cams_pm25"),
        F.col("pm10").alias("cams_pm10"),
    )


def _overlapping(raw: DataFrame, variables) -> DataFrame:
    rows = hourly_rows(point_responses(raw, "fetched_at"), variables, "point_id", "fetched_at")
    return rows.select(
        "point_id", minute_ts("time").alias("time_utc"), *variables, iso_ts("fetched_at").alias("fetched_at")
    )


def stage_weather_actuals(raw: DataFrame) -> DataFrame:
    """Overlapping files: newest fetch per hour; hours not published yet are dropped."""
    rows = _overlapping(raw, (*WEATHER, BOUNDARY)).filter("temperature_2m IS NOT NULL")
    return newest(rows, ["point_id", "time_utc"], "fetched_at", F.col("temperature_2m").desc())


def stage_cams_history(raw: DataFrame) -> DataFrame:
    rows = _overlapping(raw, CAMS).withColumnsRenamed({"pm2_5": "cams_pm25", "pm10": "cams_pm10"})
    rows = rows.filter("cams_pm25 IS NOT NULL")
    return newest(rows, ["point_id", "time_utc"], "fetched_at", F.col("cams_pm25").desc())


def stage_previous_runs(raw: DataFrame) -> DataFrame:
    """Wide run columns to one row per (point, hour, days_before), read once."""
    wide = [f"{v}_previous_day{n}" for n in RUN_DAYS for v in WEATHER]
    rows = _overlapping(raw, wide)
    long = previous_runs_to_rows(rows, ["point_id", "time_utc", "fetched_at"], WEATHER, RUN_DAYS)
    kept = newest(
        long.filter("temperature_2m IS NOT NULL"),
        ["point_id", "time_utc", "days_before"], "fetched_at", F.col("temperature_2m").desc(),
    )
    return kept.select("point_id", "time_utc", "days_before", *WEATHER, "fetched_at")


def stage_fires(raw: DataFrame) -> DataFrame:
    """Header guard, types, product label, strongest row per detection."""
    typed = raw.filter("latitude <> 'latitude'").select(
        sensor_of("source").alias("sensor"),
        product_of("source").alias("product"),
        date_hhmm_ts("acq_date", "acq_time").alias("acquired_at_utc"),
        F.to_date("dt").alias("acq_date"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        F.col("frp").cast("double").alias("frp_mw"),
        F.lower(F.trim("confidence")).alias("confidence"),
        "daynight",
    )
    return latest_wins(
        typed, ["sensor", "product", "acquired_at_utc", "latitude", "longitude"],
        F.col("frp_mw").desc_nulls_last(), F.col("confidence").asc(), F.col("daynight").asc(),
        F.col("acq_date").desc(),
    )


def stage_predictions(raw: DataFrame) -> DataFrame:
    """One row per (station, issue, horizon); the latest run wins."""
    rows = raw.select("predicted_at", F.inline("predictions")).select(
        "location_id", "zone_id", "horizon_h",
        iso_ts("issue_time_utc").alias("issue_time_utc"),
        iso_ts("target_hour_start_utc").alias("target_hour_start_utc"),
        "pm25_pred", "input_age_hours", "is_stale_input",
        iso_ts("last_valid_hour_utc").alias("last_valid_hour_utc"),
        "model_version",
        iso_ts("predicted_at").alias("predicted_at"),
    )
    return newest(
        rows, ["location_id", "issue_time_utc", "horizon_h"], "predicted_at",
        F.col("model_version").desc_nulls_last(), F.col("pm25_pred").desc_nulls_last(),
    )
