"""All thresholds and lookup values in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: these must equal the published rules for results to agree ----------------

# (category, order, pm25_low, pm25_high, aqi_low, aqi_high); the last band is open-ended.
AQI_BANDS: tuple[tuple[str, int, int, int | None, int, int], ...] = (
    ("good", 1, 0, 30, 0, 50),
    ("satisfactory", 2, 31, 60, 51, 100),
    ("moderately_polluted", 3, 61, 90, 101, 200),
    ("poor", 4, 91, 120, 201, 300),
    ("very_poor", 5, 121, 250, 301, 400),
    ("severe", 6, 251, None, 401, 500),
)

SECTORS: tuple[str, ...] = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")
NW_ARC: tuple[str, ...] = ("N", "NW", "W")

# Station-name keyword -> zone, first match wins.
ZONE_KEYWORDS: tuple[tuple[str, str], ...] = (
    ("noida", "noida"),
    ("gurugram", "gurugram"),
    ("gurgaon", "gurugram"),
    ("manesar", "gurugram"),
    ("ggn", "gurugram"),
    ("faridabad", "faridabad"),
    ("ghaziabad", "ghaziabad"),
    ("loni", "ghaziabad"),
    ("khora", "ghaziabad"),
    ("modinagar", "ghaziabad"),
    ("bahadurgarh", "bahadurgarh"),
)

AGENCIES: tuple[str, ...] = ("DPCC", "CPCB", "UPPCB", "HSPCB", "IMD", "IITM", "MHUA")
LOW_COST_PROVIDERS: tuple[str, ...] = ("AirGradient", "PurpleAir", "Clarity")

# --- end of fixed values ---------------------------------------------------------------------


@dataclass(frozen=True)
class Config:
    live_max_hours: int = 3
    delayed_max_hours: int = 6
    inactive_max_days: int = 7
    outage_share: float = 0.8
    degraded_share: float = 0.3

    pm25_min: float = 0.0
    pm25_max: float = 1000.0
    min_coverage_pct: float = 50.0
    flatline_hours: int = 6
    min_hours_for_24h: int = 16

    horizons: tuple[int, ...] = (24, 48, 72)
    issue_every_hours: int = 3
    min_valid_hours_to_issue: int = 6
    weather_lag_hours: int = 6
    cams_lag_hours: int = 12
    fire_lag_hours: int = 3
    fire_grid_ahead_hours: int = 26

    centre_lat: float = 28.6315
    centre_lon: float = 77.2167
    central_radius_km: float = 6.0
    city_id: str = "delhi_ncr"
    colocated_within_m: float = 100.0

    active_within_days: int = 30
    live_sensor_lag_days: int = 7
    refresh_days: int = 7
    repeat_alert_hours: int = 6

    holdout_days: int = 14
    min_holdout_days: int = 3
    min_train_months: int = 6
    drift_window_days: int = 7
    drift_reference_days: int = 180
    drift_min_served_hours: int = 24
    accuracy_windows: tuple[int, ...] = (7, 30)

    bands: tuple = field(default=AQI_BANDS)


CONFIG = Config()
