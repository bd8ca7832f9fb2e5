"""Explicit read schemas. Only fields that are used are declared; nothing is inferred."""

from __future__ import annotations

WEATHER = (
    "temperature_2m", "relative_humidity_2m", "wind_speed_10m", "wind_direction_10m",
    "precipitation", "surface_pressure",
)
BOUNDARY = "boundary_layer_height"
CAMS = ("pm2_5", "pm10")
RUN_DAYS = (1, 2, 3, 4)


def _series(names) -> str:
    return ", ".join(f"{n}: array<double>" for n in names)


def _responses(names) -> str:
    return (
        "array<array<struct<latitude: double, longitude: double, elevation: double, "
        f"utc_offset_seconds: int, hourly: struct<time: array<string>, {_series(names)}>>>>"
    )


MEASUREMENT = (
    "struct<value: double, parameter: struct<id: int, name: string, units: string>, "
    "period: struct<label: string, interval: string, datetimeFrom: struct<utc: string>, "
    "datetimeTo: struct<utc: string>>, "
    "coverage: struct<expectedCount: int, observedCount: int, percentComplete: double, "
    "percentCoverage: double>, summary: struct<min: double, max: double, avg: double, sd: double>, "
    "flagInfo: struct<hasFlags: boolean>>"
)
_PAGES = f"array<struct<results: array<{MEASUREMENT}>>>"
_POINTS = "points array<struct<id: string, latitude: double, longitude: double>>"

PM25_HOURLY = (
    "logical_hour string, fetched_at string, window_start string, window_end string, "
    f"stations map<string, {_PAGES}>, errors map<string, string>, dt string, hour string"
)
PM25_HISTORY = (
    "fetched_at string, location_id bigint, sensor_id bigint, window_start string, "
    f"window_end string, pages {_PAGES}, month string"
)
LATEST = (
    "logical_hour string, fetched_at string, stations map<string, array<struct<results: "
    "array<struct<datetime: struct<utc: string>, value: double, sensorsId: bigint, "
    "locationsId: bigint>>>>>, errors map<string, string>, dt string, hour string"
)
_FORECAST = "fetched_at string, forecast_issued_at string, logical_hour string, " + _POINTS
WEATHER_FORECASTS = f"{_FORECAST}, responses {_responses((*WEATHER, BOUNDARY))}, dt string, hour string"
CAMS_FORECASTS = f"{_FORECAST}, responses {_responses(CAMS)}, dt string, hour string"
_RANGE = "fetched_at string, start_date string, end_date string, " + _POINTS
WEATHER_ACTUALS = f"{_RANGE}, responses {_responses((*WEATHER, BOUNDARY))}, dt string"
PREVIOUS_RUNS = (
    f"{_RANGE}, responses "
    f"{_responses([f'{v}_previous_day{n}' for n in RUN_DAYS for v in WEATHER])}, dt string"
)
CAMS_HISTORY = f"{_RANGE}, responses {_responses(CAMS)}, dt string"
PREDICTIONS = (
    "predicted_at string, predictions array<struct<location_id: bigint, zone_id: string, "
    "horizon_h: int, issue_time_utc: string, target_hour_start_utc: string, pm25_pred: double, "
    "input_age_hours: int, is_stale_input: boolean, last_valid_hour_utc: string, "
    "model_version: string>>, dt string, hour string"
)
FIRES_CSV = ", ".join(
    f"{c} string"
    for c in (
        "latitude", "longitude", "bright_ti4", "scan", "track", "acq_date", "acq_time",
        "satellite", "instrument", "confidence", "version", "bright_ti5", "frp", "daynight", "type",
    )
)

DIMENSIONS = {
    "stations": (
        "location_id bigint, station_name string, agency string, provider string, latitude double, "
        "longitude double, pm25_sensor_id bigint, city_id string, zone_id string, "
        "colocated_with bigint, first_seen_utc string"
    ),
    "station_sensors": "location_id bigint, parameter string, sensor_id bigint",
    "zones": "zone_id string, zone_name string, city_id string",
    "cities": "city_id string, city_name string, timezone string",
    "weather_points": "point_id string, latitude double, longitude double",
    "aqi_breakpoints": (
        "category string, category_order int, pm25_low int, pm25_high int, aqi_low int, aqi_high int"
    ),
    "festivals": "date date, name string, region string",
}
