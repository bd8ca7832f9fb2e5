"""Freshness, feed status, messages, and serving queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from airlake.catalog.inputs import CFG, Inputs, zone_of
from airlake.catalog.registry import query
from airlake.catalog.views import age_text, indicative, ist_text, using
from airlake.functions.time import add
from airlake.plans import evaluation, hourly, serving, status
from airlake.plans.features import input_staleness

KEY, HOUR = "location_id", "hour_start_utc"


def user_stations(i: Inputs):
    ids = i.events().select(F.col("user_id").alias(KEY)).distinct()
    return ids.select(
        KEY, F.concat(F.lit("Station "), F.col(KEY).cast("string")).alias("station_name"),
        zone_of(KEY).alias("zone_id"), F.lit("c0").alias("city_id"),
    )


def user_status(i: Inputs):
    return status.station_status(user_stations(i), i.latest(), i.as_of(), CFG)


@query("station_status", using("ustatus", body="SELECT * FROM ustatus"))
def _(i: Inputs):
    return user_status(i)


@query("feed_status", using("ufeed", body="SELECT * FROM ufeed"))
def _(i: Inputs):
    return status.feed_status(i.grid("user_id"), CFG)


_REPORT = """
    SELECT count(*) AS stations_total, count(*) FILTER (status = 'live') AS stations_live,
           (count(*) - count(*) FILTER (status = 'live')) / count(*) AS share_not_live,
           max(last_pm25_reading_utc) AS newest_reading_utc
    FROM ustatus"""
_SINCE = ist_text("newest_reading_utc")


def _feed_sql(body: str) -> str:
    return using("ustatus", body=f"""
    SELECT {body} FROM (
        SELECT *, CASE WHEN share_not_live >= 0.8 THEN 'outage' WHEN share_not_live >= 0.3 THEN 'degraded'
                       ELSE 'ok' END AS feed_status FROM ({_REPORT}))""")


_FEED_MESSAGE = f"""CASE feed_status
    WHEN 'outage' THEN 'Live updates are paused: our data source (OpenAQ / CPCB) has sent no new readings since '
        || {_SINCE} || '. You''re seeing the last available data for each station.'
    WHEN 'degraded' THEN 'Some stations (' || CAST(CAST(round_even(share_not_live * 100, 0) AS INT) AS VARCHAR)
        || '%) are reporting late or not at all.' END"""


@query("feed_report", _feed_sql(f"*, {_FEED_MESSAGE} AS feed_message"))
def _(i: Inputs):
    return status.feed_report(user_status(i), i.as_of(), cfg=CFG)


@query("health", _feed_sql(f"""
    CASE WHEN feed_status = 'ok' THEN 'ok' ELSE 'degraded' END AS status,
    (SELECT max(ts) - INTERVAL 45 MINUTE FROM events) AS exported_at_utc, 45.0::DOUBLE AS snapshot_age_minutes,
    feed_status, {_FEED_MESSAGE} AS feed_message, stations_total, stations_live, 'v1' AS model_version"""))
def _(i: Inputs):
    return serving.health(user_status(i), add(i.as_of(), "MINUTE", -45), i.as_of(), "v1", CFG)


_WHEN = (
    f"{ist_text('last_pm25_reading_utc')} || ' (' || {age_text('last_pm25_reading_utc', 'snapshot_at')} || ')'"
)
_MESSAGES = f"""
    SELECT location_id, status, CASE
        WHEN status = 'live' THEN NULL
        WHEN status = 'no_data' THEN 'No readings available for this station yet.'
        WHEN (SELECT count(*) FILTER (status <> 'live') / count(*) FROM ustatus) >= 0.8
            THEN 'The air quality data service isn''t sending new readings. Showing this station''s last reading from '
                 || {_WHEN} || '.'
        WHEN status = 'delayed' THEN 'Readings are delayed. Last reading: ' || {_WHEN} || '.'
        WHEN status = 'inactive' THEN 'This station''s sensor appears inactive. Showing its last reading from '
                 || {_WHEN} || '.'
        ELSE 'This station has been offline since ' || {_WHEN} || ' and is excluded from area averages.' END AS message
    FROM ustatus"""


@query("station_messages", using("ustatus", body=_MESSAGES))
def _(i: Inputs):
    return status.station_messages(user_status(i), i.as_of(), CFG).select(KEY, "status", "message")


_PCT = "CAST(round_even(share_not_live * 100, 0) AS INT)"
_NEWEST = ist_text("newest_report_utc")


@query("status_changes", using("ufeed", body=f"""
    SELECT hour_start_utc, previous, feed_status, share_not_live, newest_report_utc, CASE
        WHEN previous IS NULL AND feed_status = 'ok' THEN NULL
        WHEN feed_status = 'outage' THEN '🔴 OpenAQ outage: ' || {_PCT} || '% of stations have no live reading '
            || '(newest reading ' || coalesce({_NEWEST}, 'none') || '). The dashboard shows last-known data.'
        WHEN feed_status = 'degraded' THEN '🟠 OpenAQ degraded: ' || {_PCT} || '% of stations not live '
            || '(newest reading ' || coalesce({_NEWEST}, 'none') || ').'
        ELSE '🟢 OpenAQ back to normal: ' || (100 - {_PCT}) || '% of stations live (newest reading '
            || coalesce({_NEWEST}, 'none') || ').' END AS announcement
    FROM (SELECT *, lag(feed_status) OVER (ORDER BY hour_start_utc) AS previous FROM ufeed)
    WHERE previous IS DISTINCT FROM feed_status"""))
def _(i: Inputs):
    return status.status_changes(status.feed_status(i.grid("user_id"), CFG))


@query("source_freshness", using("ev", "clock", body="""
    SELECT event_type, newest_utc, age_hours, CASE WHEN age_hours > 0.5 THEN 'error' WHEN age_hours > 0.1 THEN 'warn'
           ELSE 'pass' END AS freshness
    FROM (SELECT event_type, max(ts) AS newest_utc,
                 date_sub('minute', max(ts), (SELECT now FROM clock)) / 60.0::DOUBLE AS age_hours
          FROM ev GROUP BY event_type)"""))
def _(i: Inputs):
    return status.source_freshness(i.events(), "ts", 0.1, 0.5, i.as_of(), by=["event_type"])


@query("input_staleness", using("aqi", body="""
    SELECT location_id, last_valid_hour_utc, input_age_hours, coalesce(input_age_hours, 999999) > 3 AS is_stale_input
    FROM (
        SELECT location_id, max(hour_start_utc) FILTER (pm25 IS NOT NULL) AS last_valid_hour_utc,
               date_sub('hour', max(hour_start_utc) FILTER (pm25 IS NOT NULL),
                        (SELECT max(hour_start_utc) FROM aqi)) AS input_age_hours
        FROM aqi GROUP BY 1)"""))
def _(i: Inputs):
    return input_staleness(i.gold_aqi(), CFG)


# --- serving ------------------------------------------------------------------------------------

_OVERVIEW = """
    SELECT s.location_id, s.station_name, s.zone_id, s.city_id, latitude, longitude, colocated_with, status,
           last_pm25_reading_utc, last_pm25_value, pm25_24h, aqi_category, pm25_24h_as_of_utc, zone_name
    FROM stations s
    LEFT JOIN ustatus u USING (location_id)
    LEFT JOIN (
        SELECT location_id, pm25_24h, aqi_category, hour_start_utc AS pm25_24h_as_of_utc FROM aqi
        WHERE pm25_24h IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY hour_start_utc DESC) = 1
    ) USING (location_id)
    LEFT JOIN zones z ON z.zone_id = s.zone_id"""


def _overview(i: Inputs):
    return serving.station_overview(i.stations(), user_status(i), i.aqi(), i.zones())


@query("station_overview", using("stations", "ustatus", "aqi", "zones", body=_OVERVIEW))
def _(i: Inputs):
    return _overview(i).select(
        KEY, "station_name", "zone_id", "city_id", "latitude", "longitude", "colocated_with", "status",
        "last_pm25_reading_utc", "last_pm25_value", "pm25_24h", "aqi_category", "pm25_24h_as_of_utc", "zone_name",
    )


@query("stations_api", using("stations", "ustatus", "aqi", "zones", body=f"""
    SELECT o.location_id, station_name, zone_name, status, {ist_text('last_pm25_reading_utc')} AS last_reading_ist, message
    FROM ({_OVERVIEW}) o
    JOIN (
        SELECT location_id, CASE WHEN status = 'live' THEN NULL
            WHEN (SELECT count(*) FILTER (status <> 'live') / count(*) FROM ustatus
                  WHERE location_id IN (SELECT location_id FROM stations)) >= 0.8
            THEN 'The air quality data service isn''t sending new readings. Showing this station''s last reading from '
                 || {_WHEN} || '.'
            WHEN status = 'delayed' THEN 'Readings are delayed. Last reading: ' || {_WHEN} || '.'
            WHEN status = 'inactive' THEN 'This station''s sensor appears inactive. Showing its last reading from '
                 || {_WHEN} || '.'
            ELSE 'This station has been offline since ' || {_WHEN} || ' and is excluded from area averages.' END AS message
        FROM ustatus) m USING (location_id)
    WHERE o.zone_id = 'z1'"""))
def _(i: Inputs):
    rows = serving.stations(_overview(i), i.as_of(), "z1", CFG)
    return rows.select(KEY, "station_name", "zone_name", "status", "last_reading_ist", "message")


@query("zone_summary", using("zone_hourly", "zones", body="""
    SELECT zone_id, hour_start_utc, round(pm25_24h_median, 6) AS pm25_24h_median, stations_reporting, zone_name
    FROM zone_hourly LEFT JOIN zones USING (zone_id)
    WHERE pm25_24h_median IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY hour_start_utc DESC) = 1"""))
def _(i: Inputs):
    rows = serving.zone_summary(hourly.area_hourly(i.aqi(), "zone_id"), i.zones())
    return rows.select(
        "zone_id", HOUR, F.round("pm25_24h_median", 6).alias("pm25_24h_median"), "stations_reporting", "zone_name"
    )


@query("city_now", using("city_hourly", body=f"""
    SELECT city_id, hour_start_utc, pm25_24h_median, {indicative('pm25_24h_median')} AS aqi_category,
           stations_reporting, stations_expected
    FROM (SELECT * REPLACE (round(pm25_24h_median, 6) AS pm25_24h_median) FROM city_hourly
          WHERE pm25_24h_median IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY city_id ORDER BY hour_start_utc DESC) = 1)"""))
def _(i: Inputs):
    rows = serving.city_now(hourly.area_hourly(i.aqi(), "city_id"))
    return rows.withColumn("pm25_24h_median", F.round("pm25_24h_median", 6))


@query("city_tomorrow", using("fcst", body=f"""
    SELECT city_id, round(m, 6) AS pm25_pred_median, any_stale, {indicative('m')} AS aqi_category
    FROM (SELECT city_id, median(pm25_pred) AS m, bool_or(is_stale_input) AS any_stale FROM fcst
          WHERE horizon_h = 24 AND issue_time_utc = (SELECT max(issue_time_utc) FROM fcst) GROUP BY 1)"""))
def _(i: Inputs):
    rows = serving.city_tomorrow(evaluation.forecasts(i.predictions(), i.stations(), CFG))
    return rows.withColumn("pm25_pred_median", F.round("pm25_pred_median", 6))


_TARGET_IST = (
    "strftime(target_hour_start_utc + INTERVAL 330 MINUTE, '%-d %b, %H:%M') || '–' || "
    "strftime(target_hour_start_utc + INTERVAL 390 MINUTE, '%H:%M') || ' IST'"
)


@query("forecast_with_warning", using("fcst", body=f"""
    SELECT location_id, horizon_h, issue_time_utc, target_hour_start_utc, {_TARGET_IST} AS target_hour_ist,
           pm25_pred, {indicative('pm25_pred')} AS aqi_category_indicative, is_stale_input, input_age_hours,
           last_valid_hour_utc, model_version,
           CASE WHEN is_stale_input THEN 'Forecasts use this station''s last known readings from '
               || {ist_text('last_valid_hour_utc')} || ' (' || input_age_hours
               || ' h old) because new readings aren''t arriving.' END AS warning
    FROM fcst WHERE issue_time_utc = (SELECT max(issue_time_utc) FROM fcst)"""))
def _(i: Inputs):
    return serving.forecast(evaluation.forecasts(i.predictions(), i.stations(), CFG))


@query("history_series", using("aqi", body="""
    SELECT location_id, hour_start_utc, series, value
    FROM (UNPIVOT (SELECT location_id, hour_start_utc, pm25, pm25_24h FROM aqi) ON pm25, pm25_24h
          INTO NAME series VALUE value)"""))
def _(i: Inputs):
    return serving.history_series(i.aqi())
