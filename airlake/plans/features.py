"""Forecast features for training and live scoring, from one builder so the two cannot drift apart.

The work is shaped around one wide frame keyed by station:

* everything known per zone or city and hour (medians, observed weather, forecasts per horizon, regional
  model, fire sums) is first assembled at zone x hour grain, which is small, and joined once;
* the target is a ``lead`` on the complete grid instead of a self-join;
* all station windows share one partitioning and ordering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.config import CONFIG, Config
from airlake.functions.geo import sector_index
from airlake.functions.time import add, hour_floor, ist, ist_date, iso_weekday, whole
from airlake.operators.dedupe import as_of_runs
from airlake.operators.windows import (
    lags,
    last_seen,
    last_valid,
    rolling_mean,
    same_clock_mean,
    series,
    trailing,
)
from airlake.plans import fires as fire_plans

KEY, HOUR = "location_id", "hour_start_utc"
LAGS = (1, 3, 6, 12, 24, 48)
OBS = (
    "temperature_2m", "relative_humidity_2m", "wind_speed_10m", "wind_direction_10m",
    "boundary_layer_height",
)
FC = (
    "temperature_2m", "relative_humidity_2m", "wind_speed_10m", "wind_direction_10m",
    "precipitation", "surface_pressure",
)
NEVER = 999_999

# The columns a model may see (never the target, audits or timing keys).
CATEGORICAL = ("location_id", "zone_id")
NUMERIC = (
    "pm25_lag0", "pm25_lag1", "pm25_lag3", "pm25_lag6", "pm25_lag12", "pm25_lag24", "pm25_lag48",
    "pm25_mean_6h", "pm25_max_6h", "pm25_mean_24h", "pm25_max_24h", "pm25_24h", "valid_hours_24h",
    "pm25_same_hour_7d", "pm25_last_valid", "hours_since_last_valid",
    "zone_pm25_median", "city_pm25_median", "city_pm25_24h_median",
    "obs_temperature_2m", "obs_relative_humidity_2m", "obs_wind_speed_10m",
    "obs_wind_direction_10m", "obs_boundary_layer_height",
    "fc_temperature_2m", "fc_relative_humidity_2m", "fc_wind_speed_10m", "fc_wind_direction_10m",
    "fc_precipitation", "fc_surface_pressure",
    "cams_pm25_lagged",
    "fires_upwind_24h", "fires_upwind_48h", "fires_upwind_72h", "fires_upwind_frp_24h",
    "fires_nw_arc_24h", "fires_nw_arc_72h",
    "target_hour_ist", "target_dow_ist", "target_month", "target_is_festival", "target_is_weekend",
)


def days_before(horizon: int) -> int:
    """Previous-run forecasts safe to use for a horizon of whole days."""
    return horizon // 24 + 1


def observed_weather(actuals: DataFrame) -> DataFrame:
    return actuals.select("point_id", F.col("time_utc").alias("obs_time"), *OBS)


def newest_forecast(forecasts: DataFrame, issue_time: Column) -> DataFrame:
    """Per (point, valid hour) the newest run issued by the issue time (as-of)."""
    run = as_of_runs(
        forecasts, ["point_id", "valid_time_utc"], "issued_at", issue_time,
        F.col("temperature_2m").desc_nulls_last(),
    )
    return run.select("point_id", F.col("valid_time_utc").alias("obs_time"), *OBS)


def cams_with_fallback(history: DataFrame, forecasts: DataFrame, issue_time: Column) -> DataFrame:
    """Regional history, else the newest forecast for that hour: union, then the larger value."""
    newest = as_of_runs(
        forecasts, ["point_id", "valid_time_utc"], "issued_at", issue_time,
        F.col("cams_pm25").desc_nulls_last(),
    ).select("point_id", F.col("valid_time_utc").alias("time_utc"), "cams_pm25")
    both = history.select("point_id", "time_utc", "cams_pm25").unionByName(newest)
    return both.groupBy("point_id", "time_utc").agg(F.max("cams_pm25").alias("cams_pm25"))


def forecasts_by_horizon(previous_runs: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """Previous-run rows turned round to the issue hour they serve: (point, hour, horizon)."""
    parts = [
        F.when(
            F.col("days_before") == days_before(h),
            F.struct(F.lit(h).alias("horizon_h"), add("time_utc", "MINUTE", -(30 + 60 * h)).alias(HOUR)),
        )
        for h in cfg.horizons
    ]
    served = F.filter(F.array(*parts), lambda s: s.isNotNull())
    return previous_runs.select(
        F.col("point_id").alias("zone_id"), F.inline(served), *[F.col(c).alias(f"fc_{c}") for c in FC]
    )


def forecast_columns(by_horizon: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """One struct of forecast weather per horizon, one row per (zone, hour)."""
    row = F.struct(*[f"fc_{c}" for c in FC])
    return by_horizon.groupBy("zone_id", HOUR).agg(
        *[F.max(F.when(F.col("horizon_h") == h, row)).alias(f"_fc_{h}") for h in cfg.horizons]
    )


def zone_context(
    zone_hourly: DataFrame, city_hourly: DataFrame, zones: DataFrame, weather: DataFrame,
    cams: DataFrame, fires_rolled: DataFrame, previous_runs: DataFrame, cfg: Config = CONFIG,
) -> DataFrame:
    """Everything shared by the stations of a zone in an hour, one row per (zone, hour)."""
    city = city_hourly.select(
        "city_id", HOUR,
        F.col("pm25_median").alias("city_pm25_median"),
        F.col("pm25_24h_median").alias("city_pm25_24h_median"),
    )
    base = (
        zone_hourly.select("zone_id", HOUR, F.col("pm25_median").alias("zone_pm25_median"))
        .join(zones.select("zone_id", "city_id"), "zone_id")
        .join(city, ["city_id", HOUR], "left")
        .select(
            "*",
            add(HOUR, "MINUTE", 30).alias("_obs_at"),
            add(add(HOUR, "MINUTE", 30), "HOUR", -cfg.cams_lag_hours).alias("_cams_at"),
            hour_floor(add(HOUR, "HOUR", 1)).alias("as_of_utc"),
        )
    )
    obs = weather.select(
        F.col("point_id").alias("zone_id"), F.col("obs_time").alias("_obs_at"),
        F.col("obs_time").alias("audit_obs_weather_time"),
        *[F.col(c).alias(f"obs_{c}") for c in OBS],
    )
    regional = cams.select(
        F.col("point_id").alias("zone_id"), F.col("time_utc").alias("_cams_at"),
        F.col("time_utc").alias("audit_cams_time"),
        F.col("cams_pm25").alias("cams_pm25_lagged"),
    )
    joined = (
        base.join(obs, ["zone_id", "_obs_at"], "left")
        .join(regional, ["zone_id", "_cams_at"], "left")
        .withColumn("wind_index", sector_index("obs_wind_direction_10m"))
    )
    sums = joined.join(fire_plans.nw_arc(fires_rolled), "as_of_utc", "left").join(
        fire_plans.upwind(fires_rolled), ["as_of_utc", "wind_index"], "left"
    )
    sums = sums.join(
        forecast_columns(forecasts_by_horizon(previous_runs, cfg), cfg), ["zone_id", HOUR], "left"
    )
    counts = (
        "fires_upwind_24h", "fires_upwind_48h", "fires_upwind_72h", "fires_nw_arc_24h", "fires_nw_arc_72h",
    )
    return sums.select(
        "zone_id", HOUR, "zone_pm25_median", "city_pm25_median", "city_pm25_24h_median",
        "audit_obs_weather_time", *[f"obs_{c}" for c in OBS], "audit_cams_time", "cams_pm25_lagged",
        *[f"_fc_{h}" for h in cfg.horizons],
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("fires_upwind_frp_24h", F.lit(0.0)).alias("fires_upwind_frp_24h"),
        add("fires_window_end_utc", "HOUR", cfg.fire_lag_hours).alias("audit_fires_published_by"),
    )


def station_windows(rows: DataFrame, mode: str, cfg: Config = CONFIG) -> DataFrame:
    """History windows per station on the complete grid.

    Live mode first carries the last known values over gaps; training leaves gaps missing.
    """
    live = mode == "live"
    seen = rows.withColumn("_observed", F.col("pm25"))
    if live:
        carried = {
            c: F.coalesce(F.col(c), last_valid(c, KEY, HOUR))
            for c in ("pm25", "zone_pm25_median", "city_pm25_median", "city_pm25_24h_median")
        }
        seen = seen.select(*[carried[c].alias(c) if c in carried else F.col(c) for c in seen.columns])
        seen = seen.drop("pm25_24h", "valid_hours_24h").select(
            "*",
            rolling_mean("pm25", KEY, HOUR, 24).alias("pm25_24h"),
            F.count("pm25").over(trailing(KEY, HOUR, 24)).alias("valid_hours_24h"),
        )
    targets = [] if live else [
        F.lead("_observed", h).over(series(KEY, HOUR)).alias(f"_target_{h}") for h in cfg.horizons
    ]
    return seen.select(
        "*",
        *lags("pm25", KEY, HOUR, LAGS, "pm25_lag"),
        rolling_mean("pm25", KEY, HOUR, 6).alias("pm25_mean_6h"),
        F.max("pm25").over(trailing(KEY, HOUR, 6)).alias("pm25_max_6h"),
        rolling_mean("pm25", KEY, HOUR, 24).alias("pm25_mean_24h"),
        F.max("pm25").over(trailing(KEY, HOUR, 24)).alias("pm25_max_24h"),
        last_valid("pm25", KEY, HOUR).alias("pm25_last_valid"),
        last_seen(F.col("_observed").isNotNull(), KEY, HOUR).alias("last_valid_hour_utc"),
        *targets,
    ).withColumn("pm25_same_hour_7d", same_clock_mean("pm25", KEY, HOUR))


def build(
    mode: str, aqi_rows: DataFrame, context: DataFrame, dates: DataFrame, cfg: Config = CONFIG
) -> DataFrame:
    """Feature rows keyed by (station, issue time, horizon). ``mode`` is ``train`` or ``live``."""
    if mode not in ("train", "live"):
        raise ValueError("mode must be 'train' or 'live'")
    live = mode == "live"
    rows = aqi_rows.filter("NOT is_colocated_duplicate").select(
        KEY, "zone_id", "city_id", HOUR, "pm25", "pm25_24h", "valid_hours_24h"
    )
    windowed = station_windows(rows.join(context, ["zone_id", HOUR], "left"), mode, cfg)
    if live:
        issues = windowed.filter(F.col(HOUR) == rows.agg(F.max(HOUR)).scalar())
    else:
        issues = windowed.filter(
            (F.hour(HOUR) % cfg.issue_every_hours == 0)
            & (F.col("valid_hours_24h") >= cfg.min_valid_hours_to_issue)
        )
    per_horizon = F.array(
        *[
            F.struct(
                F.lit(h).alias("horizon_h"),
                F.lit(days_before(h)).alias("weather_days_before"),
                (F.lit(None).cast("double") if live else F.col(f"_target_{h}")).alias("target_pm25"),
                *[F.col(f"_fc_{h}.fc_{c}").alias(f"fc_{c}") for c in FC],
            )
            for h in cfg.horizons
        ]
    )
    expanded = issues.select("*", F.inline(per_horizon)).select(
        "*",
        add(HOUR, "HOUR", 1).alias("issue_time_utc"),
        add(HOUR, "HOUR", F.col("horizon_h")).alias("target_hour_start_utc"),
    )
    calendar = dates.select("date_ist", "is_festival", "is_weekend")
    joined = expanded.withColumn("date_ist", ist_date("target_hour_start_utc")).join(
        calendar, "date_ist", "left"
    )
    target = "target_hour_start_utc"
    age = whole("HOUR", "last_valid_hour_utc", HOUR)
    forecast_at = add(HOUR, "MINUTE", 30 + 60 * F.col("horizon_h"))
    staleness = [
        age.alias("input_age_hours"),
        (F.coalesce(age, F.lit(NEVER)) > cfg.live_max_hours).alias("is_stale_input"),
        F.col("last_valid_hour_utc"),
    ] if live else []
    return joined.select(
        KEY, "zone_id", "city_id", "horizon_h",
        F.col(HOUR).alias("issue_hour_start_utc"), "issue_time_utc", target,
        "target_pm25",
        F.col("pm25").alias("pm25_lag0"), *[f"pm25_lag{n}" for n in LAGS],
        "pm25_mean_6h", "pm25_max_6h", "pm25_mean_24h", "pm25_max_24h",
        "pm25_24h", "valid_hours_24h", "pm25_same_hour_7d", "pm25_last_valid",
        age.alias("hours_since_last_valid"),
        "zone_pm25_median", "city_pm25_median", "city_pm25_24h_median",
        *[f"obs_{c}" for c in OBS],
        "weather_days_before", *[f"fc_{c}" for c in FC],
        "cams_pm25_lagged",
        # A zone-hour without context has no fires either.
        *[
            F.coalesce(c, F.lit(0)).alias(c)
            for c in ("fires_upwind_24h", "fires_upwind_48h", "fires_upwind_72h")
        ],
        F.coalesce("fires_upwind_frp_24h", F.lit(0.0)).alias("fires_upwind_frp_24h"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("fires_nw_arc_24h", "fires_nw_arc_72h")],
        F.hour(ist(target)).alias("target_hour_ist"),
        iso_weekday(ist(target)).alias("target_dow_ist"),
        F.month(ist(target)).alias("target_month"),
        F.coalesce("is_festival", F.lit(False)).alias("target_is_festival"),
        F.coalesce("is_weekend", F.lit(False)).alias("target_is_weekend"),
        *staleness,
        F.col("issue_time_utc").alias("audit_station_obs_until"),
        "audit_obs_weather_time",
        add(forecast_at, "HOUR", F.lit(cfg.weather_lag_hours) - 24 * F.col("weather_days_before"))
        .alias("audit_weather_forecast_available_by"),
        "audit_cams_time",
        "audit_fires_published_by",
    )


def input_staleness(aqi_rows: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """Age of each station's newest real value at the newest hour over all stations."""
    last = aqi_rows.groupBy(KEY).agg(
        F.max(F.when(F.col("pm25").isNotNull(), F.col(HOUR))).alias("last_valid_hour_utc")
    )
    age = whole("HOUR", F.col("last_valid_hour_utc"), aqi_rows.agg(F.max(HOUR)).scalar())
    return last.select(
        KEY, "last_valid_hour_utc", age.alias("input_age_hours"),
        (F.coalesce(age, F.lit(NEVER)) > cfg.live_max_hours).alias("is_stale_input"),
    )


def level_base() -> Column:
    """Recent level of the station: 24 h mean, else last value, at least 1."""
    return F.greatest(F.coalesce("pm25_mean_24h", "pm25_last_valid"), F.lit(1.0))


def encode_target(y: Column, base: Column, transform: str) -> Column:
    if transform == "absolute":
        return y
    if transform == "log_ratio":
        return F.log1p(F.greatest(y, F.lit(0.0))) - F.log1p(base)
    raise ValueError(f"unknown target transform {transform!r}")


def decode_target(prediction: Column, base: Column, transform: str) -> Column:
    if transform == "absolute":
        return prediction
    if transform == "log_ratio":
        return F.greatest(F.expm1(prediction + F.log1p(base)), F.lit(0.0))
    raise ValueError(f"unknown target transform {transform!r}")


def model_frame(features: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Only the allowed inputs, typed for a model; a missing input column is an error."""
    missing = [c for c in (*CATEGORICAL, *NUMERIC) if c not in features.columns]
    if missing:
        raise KeyError(f"feature columns missing from data: {missing}")
    types = dict(features.dtypes)
    def number(c: str) -> Column:
        return (F.col(c).try_cast("double") if types[c] == "string" else F.col(c).cast("double")).alias(c)
    return features.select(
        *keep, *[F.col(c).cast("string").alias(c) for c in CATEGORICAL], *[number(c) for c in NUMERIC]
    )


def training_rows(features: DataFrame) -> DataFrame:
    """Rows with a known target."""
    return features.filter("target_pm25 IS NOT NULL")


def training_order(features: DataFrame) -> DataFrame:
    """Reproducible total order (a distributed range sort)."""
    return training_rows(features).orderBy("issue_time_utc", KEY, "horizon_h")


def reference_sample(features: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """Repeatable one-in-five sample of the last 180 days of training features (24 h horizon)."""
    newest = features.agg(F.max("issue_hour_start_utc")).scalar()
    since = newest - F.expr(f"INTERVAL '{cfg.drift_reference_days}' DAY")
    return features.filter(
        (F.col("horizon_h") == 24)
        & (F.col("issue_hour_start_utc") >= since)
        & ((F.col(KEY) + F.hour("issue_hour_start_utc")) % 5 == 0)
    )
