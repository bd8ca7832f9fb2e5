"""Feature building, leakage checks, forecast tables, accuracy, baselines, folds, drift, models."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlake.catalog.inputs import CFG, Inputs
from airlake.catalog.registry import query
from airlake.catalog.views import avg6, dec, indicative, micro, using
from airlake.functions.time import add
from airlake.operators import checks, drift
from airlake.operators.dedupe import as_of_runs, asof_join
from airlake.operators.reshape import melt
from airlake.plans import evaluation as ev
from airlake.plans import features, models, serving
from airlake.session import shared_path
from airlake.sources.envelopes import read_served
from airlake.sources.tables import rebuild

KEY, HOUR = "location_id", "hour_start_utc"

def _mean_over(condition: str) -> str:
    """Exact mean of the values within some hours, from integer micro-units."""
    return (
        f"CAST(sum({micro('v')}) FILTER ({condition}) AS DOUBLE) / nullif(CAST(count(v) FILTER ({condition}) * 1000000 AS DOUBLE), 0)"
    )


# What a forecast row says about the hours before it: one join of issue hours with the readings up to a week back, by age in hours.
_PAST = f"""
    SELECT q.location_id, q.h, {', '.join(f"max(v) FILTER (age = {n}) AS pm25_lag{n}" for n in (0, 1, 3, 6, 12, 24, 48))},
           {_mean_over('age < 6')} AS pm25_mean_6h, max(v) FILTER (age < 6) AS pm25_max_6h,
           {_mean_over('age < 24')} AS pm25_mean_24h, max(v) FILTER (age < 24) AS pm25_max_24h,
           {_mean_over('age > 0 AND age % 24 = 0')} AS pm25_same_hour_7d, count(v) FILTER (age < 24) AS filled_24h
    FROM asked q JOIN (SELECT location_id, h AS at, v FROM level) p
      ON p.location_id = q.location_id AND p.at BETWEEN q.h - INTERVAL 168 HOUR AND q.h,
         LATERAL (SELECT date_diff('hour', p.at, q.h) AS age) GROUP BY ALL"""

# Detections by direction in the hours that were published at the time; the newest three are not.
_SMOKE = f"""
    SELECT t, i, count(*) FILTER (a >= t - INTERVAL 27 HOUR) AS d1, count(*) FILTER (a >= t - INTERVAL 51 HOUR) AS d2, count(*) AS d3,
           coalesce({dec(f"(sum({micro('frp_mw')}) FILTER (a >= t - INTERVAL 27 HOUR)) / 1000000.0", 1)}, 0) AS power
    FROM (SELECT DISTINCT t FROM asked),
         (SELECT acquired_at_utc AS a, frp_mw, list_position(['N','NE','E','SE','S','SW','W','NW'], sector) - 1 AS i FROM elocated)
    WHERE a >= t - INTERVAL 75 HOUR AND a < t - INTERVAL 3 HOUR GROUP BY ALL"""


def _carried(table: str, area: str, value: str) -> str:
    """For each asked row the last known value of its area, no older than the station's own first hour."""
    return f"""
        SELECT q.location_id, q.h, CASE WHEN m.hour_start_utc >= q.since THEN m.{value} END AS {table}_{value}
        FROM asked q ASOF LEFT JOIN (SELECT * FROM {table} WHERE {value} IS NOT NULL) m
          ON m.{area} = q.{area} AND q.h >= m.hour_start_utc"""


def _features_sql(mode: str, select: str = "SELECT * FROM final") -> str:
    """Feature rows put together from one subquery for each group of output columns, all keyed by the asked hours."""
    live = mode == "live"
    own = "(SELECT *, hour_start_utc AS h FROM aqi WHERE NOT is_colocated_duplicate)"
    wanted = f"h = (SELECT max(h) FROM {own})" if live else "hour(h) % 3 = 0 AND valid_hours_24h >= 6"
    known = f"(SELECT * FROM {own} WHERE pm25 IS NOT NULL)"
    filled = f"SELECT a.location_id, a.h, b.pm25 AS v FROM {own} a ASOF LEFT JOIN {known} b ON b.location_id = a.location_id AND a.h >= b.h"
    day = "past.pm25_mean_24h AS pm25_24h, past.filled_24h AS valid_hours_24h" if live else "q.pm25_24h, q.valid_hours_24h"
    if live:
        medians = [_carried("zone_hourly", "zone_id", "pm25_median"), _carried("city_hourly", "city_id", "pm25_median"),
                   _carried("city_hourly", "city_id", "pm25_24h_median")]
        seen = "ASOF LEFT JOIN wfc w ON w.point_id = q.zone_id AND w.valid_time_utc = q.t30 AND q.cut >= w.issued_at"
        seen_at, target = "w.valid_time_utc", "NULL::DOUBLE"
        air = """
            SELECT q.zone_id, q.t12, greatest(max(c.cams_pm25), max(2 * f.temperature_2m)) AS cams_pm25_lagged,
                   coalesce(max(c.time_utc), max(f.valid_time_utc)) AS audit_cams_time
            FROM (SELECT DISTINCT zone_id, t12, cut FROM asked) q
            ASOF LEFT JOIN wfc f ON f.point_id = q.zone_id AND f.valid_time_utc = q.t12 AND q.cut >= f.issued_at
            LEFT JOIN camsh c ON c.point_id = q.zone_id AND c.time_utc = q.t12 GROUP BY ALL"""
    else:
        on = [("zone_hourly", "zone_id", "pm25_median"), ("city_hourly", "city_id", "pm25_median"), ("city_hourly", "city_id", "pm25_24h_median")]
        medians = [
            f"SELECT q.location_id, q.h, m.{v} AS {t}_{v} FROM asked q LEFT JOIN {t} m ON m.{a} = q.{a} AND m.hour_start_utc = q.h"
            for t, a, v in on
        ]
        seen = "LEFT JOIN actuals w ON w.point_id = q.zone_id AND w.time_utc = q.t30"
        seen_at, target = "w.time_utc", "y.pm25"
        air = "SELECT point_id AS zone_id, time_utc AS t12, cams_pm25 AS cams_pm25_lagged, time_utc AS audit_cams_time FROM camsh"
    stale = """, age AS input_age_hours, coalesce(age, 999999) > 3 AS is_stale_input, said.h AS last_valid_hour_utc""" if live else ""
    body = f"""
    , asked AS (
        SELECT location_id, zone_id, city_id, h, pm25_24h, valid_hours_24h, (SELECT max(hour_start_utc) + INTERVAL 1 HOUR FROM aqi) AS cut,
               h + INTERVAL 30 MINUTE AS t30, h - INTERVAL 690 MINUTE AS t12, date_trunc('hour', h + INTERVAL 1 HOUR) AS t, since
        FROM {own} JOIN (SELECT location_id, min(h) AS since FROM {own} GROUP BY 1) USING (location_id) WHERE {wanted}
    ), level AS ({filled if live else f"SELECT location_id, h, pm25 AS v FROM {own}"}
    ), past AS ({_PAST}
    ), smoke AS ({_SMOKE}
    ), sky AS (
        SELECT q.location_id, q.h, {seen_at} AS audit_obs_weather_time, CAST(floor(((w.wind_direction_10m + 22.5) % 360) / 45) AS INT) AS wind,
               {', '.join(f'w.{c} AS obs_{c}' for c in features.OBS)}
        FROM asked q {seen}
    ), fires AS (
        SELECT q.location_id, q.h, {', '.join(f"coalesce(sum(d{n}) FILTER (beside), 0)::BIGINT AS fires_upwind_{24 * n}h" for n in (1, 2, 3))},
               CAST(coalesce(sum({micro('power')}) FILTER (beside), 0) AS DOUBLE) / 1000000 AS fires_upwind_frp_24h,
               coalesce(sum(d1) FILTER (i IN (0, 6, 7)), 0)::BIGINT AS fires_nw_arc_24h,
               coalesce(sum(d3) FILTER (i IN (0, 6, 7)), 0)::BIGINT AS fires_nw_arc_72h
        FROM asked q JOIN sky USING (location_id, h) LEFT JOIN smoke ON smoke.t = q.t,
             LATERAL (SELECT least(abs(i - wind), 8 - abs(i - wind)) <= 1 AS beside)
        GROUP BY ALL
    ), ahead AS (
        SELECT q.location_id, q.h, n AS horizon_h, n // 24 + 1 AS lead_days, {target} AS target_pm25,
               {', '.join(f'r.{c} AS fc_{c}' for c in features.FC)}, q.h + to_hours(n) AS aim, q.h + to_hours(n) + INTERVAL 330 MINUTE AS local
        FROM (SELECT *, unnest([24, 48, 72]) AS n FROM asked) q
        LEFT JOIN {own} y ON y.location_id = q.location_id AND y.h = q.h + to_hours(n)
        LEFT JOIN runs r ON r.point_id = q.zone_id AND r.days_before = n // 24 + 1 AND r.time_utc = q.t30 + to_hours(n)
    ), final AS (
        SELECT q.location_id, q.zone_id, q.city_id, ahead.horizon_h::BIGINT AS horizon_h, ahead.aim AS target_hour_start_utc, ahead.target_pm25,
               q.h AS issue_hour_start_utc, q.h + INTERVAL 1 HOUR AS issue_time_utc, q.h + INTERVAL 1 HOUR AS audit_station_obs_until,
               past.* EXCLUDE (location_id, h, filled_24h), {day}, last.v AS pm25_last_valid, age AS hours_since_last_valid,
               round(m1.zone_hourly_pm25_median, 6) AS zone_pm25_median, round(m2.city_hourly_pm25_median, 6) AS city_pm25_median,
               round(m3.city_hourly_pm25_24h_median, 6) AS city_pm25_24h_median,
               sky.* EXCLUDE (location_id, h, wind), air.cams_pm25_lagged, air.audit_cams_time, fires.* EXCLUDE (location_id, h),
               ahead.lead_days::BIGINT AS weather_days_before, ahead.* EXCLUDE (location_id, h, horizon_h, lead_days, target_pm25, aim, local),
               ahead.aim + INTERVAL 390 MINUTE - to_hours(24 * ahead.lead_days) AS audit_weather_forecast_available_by,
               CASE WHEN q.t BETWEEN open AND shut THEN q.t END AS audit_fires_published_by,
               hour(local) AS target_hour_ist, isodow(local) AS target_dow_ist, month(local) AS target_month,
               dates.date_ist IS NOT NULL AND dates.is_festival AS target_is_festival, dates.date_ist IS NOT NULL AND dates.is_weekend AS target_is_weekend
               {stale}
        FROM asked q JOIN ahead USING (location_id, h) JOIN past USING (location_id, h) JOIN sky USING (location_id, h) JOIN fires USING (location_id, h)
        JOIN ({medians[0]}) m1 USING (location_id, h) JOIN ({medians[1]}) m2 USING (location_id, h) JOIN ({medians[2]}) m3 USING (location_id, h)
        LEFT JOIN ({air}) air ON air.zone_id = q.zone_id AND air.t12 = q.t12
        LEFT JOIN dates ON dates.date_ist = local::DATE
        ASOF LEFT JOIN (SELECT * FROM level WHERE v IS NOT NULL) last ON last.location_id = q.location_id AND q.h >= last.h
        ASOF LEFT JOIN {known} said ON said.location_id = q.location_id AND q.h >= said.h,
        LATERAL (SELECT date_sub('hour', said.h, q.h) AS age),
        (SELECT date_trunc('hour', min(acquired_at_utc)) + INTERVAL 4 HOUR AS open FROM elocated),
        (SELECT date_trunc('hour', max(ts)) + INTERVAL 30 HOUR AS shut FROM events)
    )
    {select}"""
    return using("aqi", "zone_hourly", "city_hourly", "elocated", "actuals", "wfc", "runs", "camsh", "dates", body=body)


_MEDIANS = ("zone_pm25_median", "city_pm25_median", "city_pm25_24h_median")


def _stable(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in _MEDIANS})


@query("features_train", _features_sql("train"))
def _(i: Inputs):
    return _stable(i.features("train"))


@query("features_live", _features_sql("live"))
def _(i: Inputs):
    return _stable(i.features("live"))


_AUDITS = (
    "audit_station_obs_until", "audit_obs_weather_time", "audit_weather_forecast_available_by",
    "audit_cams_time", "audit_fires_published_by",
)


@query("leakage_offenders", _features_sql("train", f"""
    SELECT location_id, issue_time_utc, horizon_h FROM final
    WHERE greatest({', '.join(_AUDITS)}) > issue_time_utc
       OR date_sub('hour', issue_time_utc, target_hour_start_utc) <> horizon_h - 1"""))
def _(i: Inputs):
    return checks.leaks(i.features("train")).select(KEY, "issue_time_utc", "horizon_h")


@query("leakage_margins", _features_sql("train", """
    SELECT horizon_h, count(*) AS n,
           min(date_sub('minute', audit_obs_weather_time, issue_time_utc)) AS observed_min,
           min(date_sub('minute', audit_weather_forecast_available_by, issue_time_utc)) AS forecast_min,
           min(date_sub('minute', audit_cams_time, issue_time_utc)) AS cams_min,
           min(date_sub('minute', audit_fires_published_by, issue_time_utc)) AS fires_min
    FROM final GROUP BY 1"""))
def _(i: Inputs):
    def margin(c: str):
        return F.min(F.timestamp_diff("MINUTE", F.col(c), F.col("issue_time_utc")))

    return i.features("train").groupBy("horizon_h").agg(
        F.count(F.lit(1)).alias("n"),
        margin("audit_obs_weather_time").alias("observed_min"),
        margin("audit_weather_forecast_available_by").alias("forecast_min"),
        margin("audit_cams_time").alias("cams_min"),
        margin("audit_fires_published_by").alias("fires_min"),
    )


@query("modulo_sample", _features_sql("train", """
    SELECT location_id, issue_hour_start_utc, pm25_lag0, pm25_mean_24h FROM final
    WHERE horizon_h = 24
      AND issue_hour_start_utc >= (SELECT max(issue_hour_start_utc) - INTERVAL 180 DAY FROM final)
      AND (location_id + hour(issue_hour_start_utc)) % 5 = 0"""))
def _(i: Inputs):
    sample = features.reference_sample(i.features("train"), CFG)
    return sample.select(KEY, "issue_hour_start_utc", "pm25_lag0", "pm25_mean_24h")


@query("target_transform", using("issues", body="""
    SELECT location_id, horizon_h, issue_time_utc, greatest(coalesce(pm25_same_hour_7d, pm25_last_valid), 1) AS base,
           round(ln(1 + greatest(target_pm25, 0)) - ln(1 + greatest(coalesce(pm25_same_hour_7d, pm25_last_valid), 1)), 6)
               AS encoded,
           round(target_pm25, 6) AS decoded
    FROM (SELECT * REPLACE (CAST(horizon_h AS BIGINT) AS horizon_h) FROM issues) WHERE target_pm25 IS NOT NULL"""))
def _(i: Inputs):
    rows = features.training_rows(i.issue_rows()).withColumn("pm25_mean_24h", F.col("pm25_same_hour_7d"))
    rows = rows.withColumn("base", features.level_base())
    y = features.encode_target(F.col("target_pm25"), F.col("base"), "log_ratio")
    return rows.withColumn("y", y).select(
        KEY, "horizon_h", "issue_time_utc", "base", F.round("y", 6).alias("encoded"),
        F.round(features.decode_target(F.col("y"), F.col("base"), "log_ratio"), 6).alias("decoded"),
    )


# --- forecasts and accuracy -----------------------------------------------------------------------


def _forecasts(i: Inputs):
    return ev.forecasts(i.predictions(), i.stations(), CFG)


def _accuracy(i: Inputs):
    return ev.forecast_accuracy(_forecasts(i), i.gold_aqi(), CFG)


@query("forecasts", using("fcst", body="SELECT * FROM fcst"))
def _(i: Inputs):
    return _forecasts(i)


@query("forecast_accuracy", using("facc", body="""
    SELECT * REPLACE (round(error, 6) AS error, round(abs_error, 6) AS abs_error) FROM facc"""))
def _(i: Inputs):
    return _accuracy(i).withColumns({c: F.round(c, 6) for c in ("error", "abs_error")})


@query("accuracy_windows", using("facc", body=f"""
    SELECT horizon_h, CAST(d AS BIGINT) AS window_days, count(*) AS n, round(avg(abs_error), 6) AS mae,
           round(avg(error), 6) AS bias,
           round(count(*) FILTER (category_correct) / count(category_correct), 9) AS category_accuracy,
           count(*) FILTER (is_stale_input) AS n_stale_inputs
    FROM facc JOIN (VALUES (7), (30)) AS w(d)
      ON target_hour_start_utc >= (SELECT max(ts) FROM events) - to_days(d)
    GROUP BY ALL"""))
def _(i: Inputs):
    rows = ev.accuracy_windows(_accuracy(i), i.as_of(), CFG)
    return rows.withColumns({"mae": F.round("mae", 6), "bias": F.round("bias", 6), "category_accuracy": F.round("category_accuracy", 9)})


@query("accuracy_published", using("facc", body="""
    SELECT CAST(horizon_h AS VARCHAR) AS horizon, 'last_' || d || 'd' AS span, count(*)::BIGINT AS n, round(avg(abs_error), 3) AS mae,
           count(*) FILTER (is_stale_input)::BIGINT AS n_stale_inputs
    FROM facc JOIN (VALUES (7), (30)) AS w(d)
      ON target_hour_start_utc >= (SELECT max(ts) FROM events) - to_days(d)
    GROUP BY ALL"""))
def _(i: Inputs):
    """The accuracy summary as published, read back from its document."""
    path = f"{shared_path(i.spark, 'public')}/accuracy.json"
    now = i.events().agg(F.max(F.col("ts").cast("timestamp_ntz"))).first()[0]
    models.publish_summary(i.spark, path, models.accuracy_summary(_accuracy(i), now, CFG), now)
    value = "struct<n: bigint, mae: double, n_stale_inputs: bigint>"
    doc = i.spark.read.schema(f"horizons map<string, map<string, {value}>>").option("multiLine", True).json(path)
    spans = doc.select(F.explode("horizons").alias("horizon", "spans"))
    return spans.select("horizon", F.explode("spans").alias("span", "v")).select("horizon", "span", "v.*")


@query("forecast_vs_actual", using("facc", body="""
    SELECT location_id, horizon_h, target_hour_start_utc, series, value
    FROM (UNPIVOT (SELECT location_id, horizon_h, target_hour_start_utc, pm25_pred, pm25_actual FROM facc)
          ON pm25_pred, pm25_actual INTO NAME series VALUE value)"""))
def _(i: Inputs):
    return serving.forecast_vs_actual(_accuracy(i))


# --- baselines, skill, folds ----------------------------------------------------------------------

_SCORED = f"""
    , scored AS (
        SELECT CAST(horizon_h AS BIGINT) AS horizon_h, location_id, issue_time_utc, method, y_pred, y_true
        FROM (SELECT *, target_pm25 AS y_true, pm25_last_valid AS persistence,
                     coalesce(pm25_same_hour_7d, pm25_last_valid) AS seasonal_naive,
                     pm25_last_valid AS cams_lagged FROM issues WHERE target_pm25 IS NOT NULL)
        UNPIVOT (y_pred FOR method IN (persistence, seasonal_naive, cams_lagged))
    ), per AS (
        SELECT horizon_h, method, avg(abs(y_pred - y_true)) AS mae,
               round(sqrt(avg((y_pred - y_true) ** 2)), 6) AS rmse, avg(y_pred - y_true) AS bias,
               round(avg(CAST({indicative('y_true')} = {indicative('y_pred')} AS INT)), 9) AS category_accuracy,
               count(*) AS n
        FROM scored GROUP BY ALL
    )"""


def _scored(i: Inputs):
    rows = features.training_rows(i.issue_rows()).withColumnRenamed("target_pm25", "y_true")
    return ev.with_baselines(rows, ["horizon_h", KEY, "issue_time_utc", "y_true"])


def _metric_rounding(df: DataFrame) -> DataFrame:
    return df.withColumns({**{c: F.round(c, 6) for c in ("mae", "rmse", "bias")}, "category_accuracy": F.round("category_accuracy", 9)})


@query("baseline_metrics", using("issues", body=f"{_SCORED} SELECT * REPLACE (round(mae, 6) AS mae, round(bias, 6) AS bias) FROM per"))
def _(i: Inputs):
    return _metric_rounding(ev.metrics(_scored(i), ["horizon_h", "method"]))


@query("skill_by_horizon", using("issues", body=f"""{_SCORED}
    SELECT p.horizon_h, p.method, round(p.mae, 6) AS mae, round(1.0::DOUBLE - p.mae / q.mae, 9) AS skill
    FROM per p JOIN per q ON q.horizon_h = p.horizon_h AND q.method = 'persistence'"""))
def _(i: Inputs):
    rows = ev.skill_table(_scored(i), ["horizon_h"])
    return rows.select("horizon_h", "method", F.round("mae", 6).alias("mae"), F.round("skill", 9).alias("skill"))


_FOLD_ROWS = """
    SELECT o_orderkey, o_custkey, o_totalprice AS y_true, o_orderdate AS issue_time_utc, h AS horizon_h,
           o_orderdate - INTERVAL 1 HOUR + to_hours(h) AS target_hour_start_utc
    FROM orders, (VALUES (24), (48), (72)) AS v(h)"""


def _fold_rows(i: Inputs):
    """Orders as issue times spread over several years, three horizons each."""
    horizons = F.explode(F.array(*[F.lit(h) for h in CFG.horizons])).alias("horizon_h")
    return i.table("orders").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").alias("y_true"),
        F.col("o_orderdate").alias("issue_time_utc"), horizons,
    ).withColumn("target_hour_start_utc", add("issue_time_utc", "HOUR", F.col("horizon_h") - 1))


@query("monthly_folds", f"""
    WITH r AS ({_FOLD_ROWS}), months AS (
        SELECT unnest(generate_series(date_trunc('month', min(issue_time_utc)) + INTERVAL 6 MONTH,
                                      max(issue_time_utc), INTERVAL 1 MONTH)) AS m FROM r)
    SELECT strftime(m, '%Y-%m') AS fold, m AS test_start, m + INTERVAL 1 MONTH AS test_end,
           count(*) FILTER (target_hour_start_utc + INTERVAL 1 HOUR <= m) AS train_rows,
           count(*) FILTER (issue_time_utc >= m AND issue_time_utc < m + INTERVAL 1 MONTH) AS test_rows
    FROM months, r GROUP BY m HAVING train_rows > 0 AND test_rows > 0""")
def _(i: Inputs):
    return ev.monthly_folds(_fold_rows(i))


@query("holdout_split", f"""
    WITH r AS ({_FOLD_ROWS}), s AS (
        SELECT max(target_hour_start_utc) + INTERVAL 1 HOUR - INTERVAL 14 DAY AS start FROM r)
    SELECT o_orderkey, CAST(horizon_h AS BIGINT) AS horizon_h,
           CASE WHEN issue_time_utc >= start THEN 'holdout' ELSE 'train' END AS part
    FROM r, s WHERE issue_time_utc >= start OR target_hour_start_utc + INTERVAL 1 HOUR <= start""")
def _(i: Inputs):
    return ev.holdout_split(_fold_rows(i), CFG).select("o_orderkey", "horizon_h", "part")


_PER_FOLD = f"""
    WITH r AS ({_FOLD_ROWS}), p AS (
        SELECT *, 150000::DOUBLE + (o_custkey % 100) * 500 + h * 100 AS y_pred FROM (SELECT *, horizon_h AS h FROM r))
    SELECT strftime(issue_time_utc, '%Y-%m') AS fold, horizon_h, round(avg(abs(y_pred - y_true)), 6) AS mae, count(*) AS n
    FROM p GROUP BY ALL"""


def _per_fold(i: Inputs):
    guess = F.lit(150000.0) + F.col("o_custkey") % 100 * 500 + F.col("horizon_h") * 100
    rows = _fold_rows(i).withColumn("y_pred", guess)
    return ev.metrics(ev.fold_of(rows), ["fold", "horizon_h"]).withColumn("mae", F.round("mae", 6))


@query("fold_metrics", f"SELECT fold, CAST(horizon_h AS BIGINT) AS horizon_h, mae, n FROM ({_PER_FOLD})")
def _(i: Inputs):
    return _per_fold(i).select("fold", "horizon_h", "mae", "n")


@query("fold_pivot", f"""
    SELECT fold, max(mae) FILTER (horizon_h = 24) AS h24, max(mae) FILTER (horizon_h = 48) AS h48,
           max(mae) FILTER (horizon_h = 72) AS h72 FROM ({_PER_FOLD}) GROUP BY fold""")
def _(i: Inputs):
    return ev.fold_pivot(_per_fold(i), cfg=CFG)


@query("monthly_mae_series", f"""
    SELECT fold, series, value FROM (
        UNPIVOT (SELECT fold, max(mae) FILTER (horizon_h = 24) AS h24, max(mae) FILTER (horizon_h = 72) AS h72
                 FROM ({_PER_FOLD}) GROUP BY fold) ON h24, h72 INTO NAME series VALUE value)""")
def _(i: Inputs):
    return melt(ev.fold_pivot(_per_fold(i), cfg=CFG), ["fold"], ["h24", "h72"])


# --- as-of and fallback ---------------------------------------------------------------------------


@query("asof_latest_run", using("wfc", body="""
    SELECT point_id, valid_time_utc, max(issued_at) AS issued_at, arg_max(temperature_2m, issued_at) AS temperature_2m
    FROM wfc WHERE issued_at <= (SELECT max(ts) - INTERVAL 2 DAY FROM events) GROUP BY ALL"""))
def _(i: Inputs):
    runs = as_of_runs(
        i.weather_forecasts(), ["point_id", "valid_time_utc"], "issued_at", add(i.as_of(), "DAY", -2)
    )
    return runs.select("point_id", "valid_time_utc", "issued_at", "temperature_2m")


@query("asof_per_issue", using("issues", "wfc", body="""
    SELECT i.location_id, i.zone_id, i.horizon_h, i.issue_time_utc, r.issued_at, r.valid_time_utc, r.temperature_2m
    FROM issues AS i ASOF LEFT JOIN (
        SELECT point_id, issued_at, max(valid_time_utc) AS valid_time_utc, arg_max(temperature_2m, valid_time_utc) AS temperature_2m
        FROM wfc GROUP BY ALL) AS r ON i.zone_id = r.point_id AND i.issue_time_utc >= r.issued_at"""))
def _(i: Inputs):
    """Each issue row with the newest run issued before it (of that run the farthest hour)."""
    runs = i.weather_forecasts().withColumnRenamed("point_id", "zone_id")
    ready = i.aqi().where("NOT is_colocated_duplicate AND hour(hour_start_utc) % 3 = 0 AND valid_hours_24h >= 6")
    issues = ready.select(
        "location_id", "zone_id", F.explode(F.array(*map(F.lit, CFG.horizons))).alias("horizon_h"),
        F.col("hour_end_utc").alias("issue_time_utc"),
    )
    values = ["issued_at", "valid_time_utc", "temperature_2m"]
    return asof_join(issues, runs, ["zone_id"], "issue_time_utc", "issued_at", values, ties=["valid_time_utc"])


@query("union_fallback", using("camsh", "wfc", body="""
    SELECT point_id, time_utc, max(cams_pm25) AS cams_pm25 FROM (
        SELECT point_id, time_utc, cams_pm25 FROM camsh
        UNION ALL
        SELECT point_id, valid_time_utc, 2 * arg_max(temperature_2m, issued_at) FROM wfc
        WHERE issued_at <= (SELECT max(ts) FROM events) GROUP BY ALL)
    GROUP BY ALL"""))
def _(i: Inputs):
    return features.cams_with_fallback(i.cams_history(), i.cams_forecasts(), i.as_of())


# --- drift ----------------------------------------------------------------------------------------

_DRIFT = """
    WITH v AS (
        SELECT feature, x AS v, side FROM (
            SELECT 'value' AS feature, value AS x, CASE WHEN ts >= (SELECT max(ts) - INTERVAL 7 DAY FROM events)
                   THEN 1 ELSE 0 END AS side FROM events
            UNION ALL
            SELECT 'k', CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE),
                   CASE WHEN ts >= (SELECT max(ts) - INTERVAL 7 DAY FROM events) THEN 1 ELSE 0 END FROM events)
    ), n AS (
        SELECT feature, count(*) FILTER (side = 0) AS nr, count(*) FILTER (side = 1) AS nc FROM v GROUP BY 1
    ), c AS (
        SELECT feature, v, sum(r) OVER w / nr AS fr, sum(q) OVER w / nc AS fc, lead(v) OVER w AS nv, nr, nc FROM (
            SELECT feature, v, count(*) FILTER (side = 0) AS r, count(*) FILTER (side = 1) AS q FROM v GROUP BY ALL)
        JOIN n USING (feature) WINDOW w AS (PARTITION BY feature ORDER BY v))"""


def _sides(i: Inputs):
    rows = i.events().select("ts", "value", "k")
    since = add(i.as_of(), "DAY", -CFG.drift_window_days)
    cols = ["value", "k"]
    return (
        drift.long_form(rows.filter(F.col("ts") < since), cols, "reference"),
        drift.long_form(rows.filter(F.col("ts") >= since), cols, "current"),
    )


@query("drift_ks", f"""{_DRIFT}
    SELECT feature, nr AS n_reference, nc AS n_current, round(max(abs(fr - fc)), 9) AS ks FROM c GROUP BY ALL""")
def _(i: Inputs):
    d = drift.distances(*_sides(i))
    return d.select("feature", "n_reference", "n_current", F.round("ks", 9).alias("ks"))


@query("drift_ks_by_days", f"""{_DRIFT}
    SELECT feature, nr AS n_reference, nc AS n_current, round(max(abs(fr - fc)), 9) AS ks FROM c GROUP BY ALL""")
def _(i: Inputs):
    """The reference as stored counts of each day, the last of them added later; the current side counted anew."""
    rows = i.events().select("ts", "value", "k")
    since = add(i.as_of(), "DAY", -CFG.drift_window_days)
    path = shared_path(i.spark, "drift-days")
    past = rows.filter(F.col("ts") < since)
    last = past.agg(F.max(F.to_date("ts"))).scalar()
    drift.store_days(past.filter(F.to_date("ts") < last), ["value", "k"], "ts", path)
    drift.store_days(past.filter(F.to_date("ts") == last), ["value", "k"], "ts", path)
    reference = drift.merge_days(i.spark.read.parquet(path), F.lit(True))
    current = drift.counted(drift.long_form(rows.filter(F.col("ts") >= since), ["value", "k"], "current"))
    d = drift.distances_of_counts(reference, current)
    return d.select("feature", "n_reference", "n_current", F.round("ks", 9).alias("ks"))


@query("drift_wasserstein", f"""{_DRIFT}
    SELECT feature, round(sum(abs(fr - fc) * (nv - v)), 6) AS wasserstein,
           (SELECT round(stddev_pop(y.v), 6) FROM v y WHERE y.feature = c.feature AND side = 0) AS reference_std
    FROM c GROUP BY feature""")
def _(i: Inputs):
    d = drift.distances(*_sides(i))
    return d.select(
        "feature", F.round("wasserstein", 6).alias("wasserstein"), F.round("reference_std", 6).alias("reference_std")
    )


@query("drift_verdicts", f"""{_DRIFT}
    , d AS (
        SELECT feature, nr AS n_reference, nc AS n_current, max(abs(fr - fc)) AS ks,
               sum(abs(fr - fc) * (nv - v)) AS w,
               (SELECT stddev_pop(y.v) FROM v y WHERE y.feature = c.feature AND side = 0) AS s
        FROM c GROUP BY ALL
    ), p AS (
        SELECT feature, CASE WHEN any_value(l2) < 0.04 THEN 1 ELSE least(greatest(
                   2 * sum(CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2 * k * k * l2)), 0), 1) END AS p
        FROM (SELECT feature, ks * ks * n_reference * n_current / (n_reference + n_current) AS l2 FROM d),
             range(1, 101) AS r(k) GROUP BY 1
    )
    SELECT feature, n_reference, n_current, round(p, 4) AS ks_p_value, round(w / greatest(s, 0.001), 4) AS wasserstein_normed,
           m AS method, round(CASE m WHEN 'K-S p_value' THEN p ELSE w / greatest(s, 0.001) END, 4) AS value,
           CASE m WHEN 'K-S p_value' THEN p < 0.05 ELSE w / greatest(s, 0.001) > 0.1 END AS drifted
    FROM d JOIN p USING (feature), (VALUES ('K-S p_value'), ('Wasserstein distance (normed)')) AS t(m)""")
def _(i: Inputs):
    """Both methods side by side; neither choice depends on the number of rows."""
    sides = _sides(i)
    return drift.verdicts(*sides, method="ks").unionByName(drift.verdicts(*sides, method="wasserstein"))


# --- model ----------------------------------------------------------------------------------------

QUICK = models.TreeParams(trees=3, depth=3, min_instances=20)


@query("gbt_forecast")
def _(i: Inputs):
    """Fit one small model per horizon on the training features and score the live ones."""
    table = rebuild(i.features("train"), shared_path(i.spark, "training"), "quick")
    train, live = i.spark.read.parquet(table), i.features("live")
    fitted = {h: models.fit(train.filter(F.col("horizon_h") == h), params=QUICK) for h in CFG.horizons}
    return models.predict_live(live, fitted, "quick")


def _training(i: Inputs) -> DataFrame:
    return i.stored(i.features("train"), "training-features")


@query("training_order", _features_sql("train", """
    SELECT location_id, horizon_h, issue_time_utc, target_pm25,
           row_number() OVER (ORDER BY issue_time_utc, location_id, horizon_h) AS place
    FROM final WHERE target_pm25 IS NOT NULL"""))
def _(i: Inputs):
    """Training rows in the order that makes fits repeatable, numbered by partition of the range sort."""
    rows = i.stored(features.training_order(_training(i)), "ordered").withColumns(
        {"part": F.input_file_name(), "row": F.monotonically_increasing_id()}
    )
    key = F.struct("issue_time_utc", "location_id", "horizon_h")
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"), F.max(key).alias("last"))
    # one row a file of the range sort
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("first", "last")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("part").orderBy("row")
    return rows.withColumn("_n", F.row_number().over(inside)).join(parts, "part").select(
        "location_id", "horizon_h", "issue_time_utc", "target_pm25", (F.col("before") + F.col("_n")).alias("place")
    )


@query("served_features", _features_sql("live", """
    SELECT location_id, horizon_h, strftime(issue_time_utc, '%Y-%m-%dT%H:%M:%SZ') AS issue_time_utc, pm25_lag0, valid_hours_24h FROM final"""))
def _(i: Inputs):
    """The live rows written as served and read back from their day on."""
    path = shared_path(i.spark, "served")
    models.write_served(i.features("live"), path)
    schema = "location_id bigint, horizon_h int, issue_time_utc string, pm25_lag0 double, valid_hours_24h bigint"
    return read_served(i.spark, path, schema, "0000-00-00").drop("dt", "hour")


@query("out_of_fold", _features_sql("train", """
    , first AS (SELECT min(issue_time_utc) AS f FROM final),
    r AS (SELECT horizon_h, issue_time_utc + to_days(2 * date_diff('day', f, issue_time_utc)) AS issued FROM final, first WHERE target_pm25 IS NOT NULL),
    months AS (SELECT unnest(generate_series(date_trunc('month', min(issued)) + INTERVAL 1 MONTH, max(issued), INTERVAL 1 MONTH)) AS m FROM r)
    SELECT strftime(m, '%Y-%m') AS fold, horizon_h, count(*) FILTER (issued >= m AND issued < m + INTERVAL 1 MONTH) AS n, true AS in_range
    FROM months, r GROUP BY m, horizon_h HAVING n > 0 AND count(*) FILTER (issued + to_hours(horizon_h) <= m) > 0"""))
def _(i: Inputs):
    """Walk-forward predictions over the training rows, their days three apart so that they span months; rows by fold."""
    train = _training(i)
    first = train.agg(F.min("issue_time_utc")).scalar()
    days = F.make_dt_interval(2 * F.date_diff(F.to_date("issue_time_utc"), F.to_date(first)))
    spread = train.withColumns({c: F.col(c) + days for c in ("issue_time_utc", "issue_hour_start_utc")})
    spread = spread.withColumn("target_hour_start_utc", add("issue_time_utc", "HOUR", F.col("horizon_h") - 1))
    oof = models.out_of_fold(spread, params=models.TreeParams(trees=2, depth=2, min_instances=5), cfg=CFG, min_train_months=1)
    return oof.groupBy("fold", "horizon_h").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce(F.col("y_pred").between(0, 1000), F.lit(False))).alias("in_range"))


@query("model_card", _features_sql("train", """
    SELECT horizon_h, method, count(*) AS n, round(sum(abs(p - target_pm25)), 5) AS error_sum FROM (
        SELECT horizon_h, target_pm25, unnest(['cams_lagged', 'persistence', 'seasonal_naive']) AS method,
               unnest([coalesce(cams_pm25_lagged, pm25_last_valid), pm25_last_valid, coalesce(pm25_same_hour_7d, pm25_last_valid)]) AS p
        FROM final WHERE target_pm25 IS NOT NULL) GROUP BY ALL"""))
def _(i: Inputs):
    """The card of three small models: its baselines are checked by value, its own parts for being there."""
    train = _training(i)
    fitted = {h: models.fit(train.filter(F.col("horizon_h") == h), params=QUICK) for h in CFG.horizons}
    scored = [models.score(m, train.filter((F.col("horizon_h") == h) & F.col("target_pm25").isNotNull())) for h, m in fitted.items()]
    card = models.model_card(i.stored(reduce(DataFrame.unionByName, scored), "scored"), train, fitted)
    rows = []
    for h, spec in card["horizons"].items():
        assert set(spec["skill"]) == set(ev.BASELINES) and spec["per_month"] and 0 < len(spec["top_features"]) <= 10
        rows += [(int(h), b, spec[b]["n"], round(spec[b]["mae"] * spec[b]["n"], 5)) for b in ev.BASELINES]
    return i.spark.createDataFrame(rows, "horizon_h bigint, method string, n bigint, error_sum double")


@query("champion_holdout", _features_sql("train", """
    , known AS (SELECT * FROM final WHERE target_pm25 IS NOT NULL),
    cut AS (SELECT max(target_hour_start_utc) + INTERVAL 1 HOUR - INTERVAL 14 DAY AS t FROM known)
    SELECT horizon_h, role, count(*) AS n, true AS in_range
    FROM known, cut, (VALUES ('challenger'), ('production')) AS r(role) WHERE issue_time_utc >= t GROUP BY ALL"""))
def _(i: Inputs):
    """Challenger and production scored on the same holdout rows; errors are checked for their range, as SQL cannot fit trees."""
    train = _training(i)
    production = {h: models.fit(train.filter(F.col("horizon_h") == h), params=QUICK) for h in CFG.horizons}
    scored = models.holdout_scores(train, production, datetime(2000, 1, 1), params=QUICK, cfg=CFG)
    table = models.champion_table(scored)
    return table.select("horizon_h", "role", "n", F.coalesce((F.col("mae") > 0) & (F.col("mae") < 200), F.lit(False)).alias("in_range"))


@query("gbt_forecast_rows", _features_sql("live", """
    SELECT location_id, zone_id, CAST(horizon_h AS BIGINT) AS horizon_h, issue_time_utc, target_hour_start_utc,
           input_age_hours, is_stale_input, true AS is_valid FROM final"""))
def _(i: Inputs):
    """What the forecast must hold whatever the trees say: every station and horizon once, labelled, at or above zero, one decimal."""
    table = rebuild(i.features("train"), shared_path(i.spark, "training"), "rows")
    train, live = i.spark.read.parquet(table), i.features("live")
    fitted = {h: models.fit(train.filter(F.col("horizon_h") == h), params=QUICK) for h in CFG.horizons}
    got = models.predict_live(live, fitted, "rows")
    pred = F.col("pm25_pred")
    return got.select(
        "location_id", "zone_id", "horizon_h", "issue_time_utc", "target_hour_start_utc", "input_age_hours",
        "is_stale_input", F.coalesce((pred >= 0) & (pred == F.round(pred, 1)), F.lit(False)).alias("is_valid"),
    )

