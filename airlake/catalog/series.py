"""Time-series queries: dedupe, grids, quality, windows, air quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from airlake.catalog.inputs import CFG, Inputs
from airlake.catalog.registry import query
from airlake.catalog.views import avg6, banded, category, half, indicative, subindex, using
from airlake.functions import aqi
from airlake.functions.time import half_hour_floor
from airlake.operators import dedupe, windows
from airlake.operators.quantiles import median_of_large_groups
from airlake.operators.timegrid import with_gaps
from airlake.plans import fires, hourly

KEY, HOUR = "location_id", "hour_start_utc"


@query("latest_wins_dedupe", using("ev", body=f"""
    SELECT user_id, hour_start_utc, value, k, event_id FROM (
        SELECT *, {half('ts')} AS hour_start_utc FROM ev)
    QUALIFY rank() OVER (PARTITION BY user_id, hour_start_utc ORDER BY ts DESC, event_id DESC) = 1"""))
def _(i: Inputs):
    rows = i.events().withColumn(HOUR, half_hour_floor("ts"))
    kept = dedupe.newest(rows, ["user_id", HOUR], "ts", F.col("event_id").desc())
    return kept.select("user_id", HOUR, "value", "k", "event_id")


@query("arg_max_latest", using("ev", body="""
    SELECT user_id, arg_max(value, ts) AS value, arg_max(event_type, ts) AS event_type, max(ts) AS reading_utc
    FROM ev GROUP BY user_id"""))
def _(i: Inputs):
    return dedupe.arg_max(
        i.events(), ["user_id"], F.col("ts"),
        value=F.col("value"), event_type=F.col("event_type"), reading_utc=F.col("ts"),
    )


@query("first_last_seen", using("ev", body="""
    SELECT user_id, event_type, arg_max(value, ts) AS value, min(ts) AS first_seen, max(ts) AS last_seen
    FROM ev GROUP BY user_id, event_type"""))
def _(i: Inputs):
    return dedupe.first_last_seen(i.events(), ["user_id", "event_type"], "ts", "value")


@query("highest_value_dedupe", using("ev", body="""
    SELECT user_id, CAST(ts AS DATE) AS day, event_id, value FROM ev
    QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY value DESC, event_id) = 1"""), dates=("day",))
def _(i: Inputs):
    rows = i.events().withColumn("day", F.to_date("ts"))
    best = dedupe.latest_wins(rows, ["user_id", "day"], F.col("value").desc(), F.col("event_id").asc())
    return best.select("user_id", "day", "event_id", "value")


@query("hourly_grid_gaps", using("ugrid", body="""
    SELECT location_id, hour_start_utc, pm25_raw, is_missing FROM ugrid"""))
def _(i: Inputs):
    grid = with_gaps(i.staged("user_id"), KEY, HOUR, i.as_of())
    return grid.select(KEY, HOUR, F.col("pm25").alias("pm25_raw"), F.col("pm25").isNull().alias("is_missing"))


@query("quality_flags", using("hourly", body="""
    SELECT location_id, hour_start_utc, hour_start_utc + INTERVAL 1 HOUR AS hour_end_utc, pm25_raw, pm25,
           CAST(k + 40 AS DOUBLE) AS percent_complete, is_missing, is_out_of_range, is_low_coverage, is_flatline,
           is_valid, event_type AS source
    FROM hourly"""))
def _(i: Inputs):
    return i.grid().select(
        KEY, HOUR, "hour_end_utc", "pm25_raw", "pm25", "percent_complete", "is_missing", "is_out_of_range",
        "is_low_coverage", "is_flatline", "is_valid", "source",
    )


@query("flatline_flag", using("grid", body="""
    SELECT location_id, hour_start_utc, level,
           count(level) OVER w = 3 AND max(level) OVER w = min(level) OVER w AS is_flatline
    FROM (SELECT location_id, hour_start_utc, floor(pm25_raw / 60) AS level FROM grid)
    WINDOW w AS (PARTITION BY location_id ORDER BY hour_start_utc ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""))
def _(i: Inputs):
    grid = with_gaps(i.staged(), KEY, HOUR, i.as_of())
    level = grid.select(KEY, HOUR, F.floor(F.col("pm25") / 60).cast("double").alias("level"))
    return level.select("*", windows.is_flat("level", KEY, HOUR, 3).alias("is_flatline"))


@query("aqi_hourly", using("aqi", body="SELECT * FROM aqi"))
def _(i: Inputs):
    return i.aqi()


@query("aqi_subindex", using("ev", body=f"""
    SELECT event_id, {category('value')} AS category, CAST({banded('value', 1)} AS BIGINT) AS category_order,
           {subindex('value')} AS subindex, {indicative('value')} AS indicative
    FROM ev"""))
def _(i: Inputs):
    return i.events().select(
        "event_id",
        aqi.category("value").alias("category"),
        aqi.category_order("value").alias("category_order"),
        aqi.subindex("value").alias("subindex"),
        aqi.indicative_category("value").alias("indicative"),
    )


_AREA = """
    SELECT {0}, hour_start_utc, round(pm25_median, 6) AS pm25_median,
           round(pm25_24h_median, 6) AS pm25_24h_median, stations_reporting, stations_with_24h_avg,
           stations_expected
    FROM {1}"""


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("pm25_median", "pm25_24h_median")})


@query("zone_hourly_median", using("zone_hourly", body=_AREA.format("zone_id", "zone_hourly")))
def _(i: Inputs):
    return _rounded(hourly.area_hourly(i.aqi(), "zone_id"))


@query("city_hourly_median", using("city_hourly", body=_AREA.format("city_id", "city_hourly")))
def _(i: Inputs):
    return _rounded(hourly.area_hourly(i.aqi(), "city_id"))


@query("median_unbounded_groups", """
    SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 6) AS median_price
    FROM lineitem GROUP BY ALL""")
def _(i: Inputs):
    out = median_of_large_groups(
        i.table("lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", "median_price", 100.0
    )
    return out.withColumn("median_price", F.round("median_price", 6))


@query("city_daily", using("aqi", "edaily", "dates", body=f"""
    SELECT city_id, date_ist, m AS pm25_median, full_days AS stations_with_full_day,
           {category('m')} AS aqi_category, coalesce(fires_total, 0) AS fires_total,
           coalesce(fires_nw_arc, 0) AS fires_nw_arc, is_festival, festival_name
    FROM (
        SELECT city_id, date_ist, count(*) FILTER (n >= 16) AS full_days,
               CAST(CAST(CAST(median(d) FILTER (n >= 16) AS DECIMAL(24,6)) AS DECIMAL(24,1)) AS DOUBLE) AS m
        FROM (
            SELECT city_id, location_id, CAST(hour_start_utc + INTERVAL 330 MINUTE AS DATE) AS date_ist,
                   {avg6('pm25')} AS d, count(pm25) AS n
            FROM aqi WHERE NOT is_colocated_duplicate GROUP BY ALL)
        GROUP BY ALL
    ) LEFT JOIN (
        SELECT city_id, acq_date AS date_ist, CAST(sum(fire_count) AS BIGINT) AS fires_total,
               CAST(sum(fire_count) FILTER (sector IN ('N', 'W', 'NW')) AS BIGINT) AS fires_nw_arc
        FROM edaily GROUP BY ALL
    ) USING (city_id, date_ist)
    LEFT JOIN (SELECT date_ist, is_festival, festival_name FROM dates) USING (date_ist)"""), dates=("date_ist",))
def _(i: Inputs):
    daily = fires.daily(fires.locate(i.event_fires(), CFG))
    return hourly.city_daily(i.aqi(), daily, i.dates(), CFG)


_ROWS = "OVER (PARTITION BY location_id ORDER BY hour_start_utc ROWS BETWEEN {} PRECEDING AND {})"


@query("rolling_24h", using("uhourly", body=f"""
    SELECT location_id, hour_start_utc, count(pm25) {_ROWS.format(23, 'CURRENT ROW')} AS valid_hours_24h,
           {avg6('pm25', _ROWS.format(23, 'CURRENT ROW'))} AS mean_24h
    FROM uhourly"""))
def _(i: Inputs):
    return i.grid("user_id").select(
        KEY, HOUR,
        F.count("pm25").over(windows.trailing(KEY, HOUR, 24)).alias("valid_hours_24h"),
        windows.rolling_mean("pm25", KEY, HOUR, 24).alias("mean_24h"),
    )


@query("rolling_max_6h", using("uhourly", body=f"""
    SELECT location_id, hour_start_utc, max(pm25) {_ROWS.format(5, 'CURRENT ROW')} AS max_6h,
           {avg6('pm25', _ROWS.format(5, 'CURRENT ROW'))} AS mean_6h
    FROM uhourly"""))
def _(i: Inputs):
    return i.grid("user_id").select(
        KEY, HOUR,
        F.max("pm25").over(windows.trailing(KEY, HOUR, 6)).alias("max_6h"),
        windows.rolling_mean("pm25", KEY, HOUR, 6).alias("mean_6h"),
    )


@query("lag_family", using("uhourly", body="""
    SELECT location_id, hour_start_utc, lag(pm25, 1) OVER s AS pm25_lag1, lag(pm25, 3) OVER s AS pm25_lag3,
           lag(pm25, 6) OVER s AS pm25_lag6, lag(pm25, 12) OVER s AS pm25_lag12,
           lag(pm25, 24) OVER s AS pm25_lag24, lag(pm25, 48) OVER s AS pm25_lag48
    FROM uhourly WINDOW s AS (PARTITION BY location_id ORDER BY hour_start_utc)"""))
def _(i: Inputs):
    grid = i.grid("user_id")
    return grid.select(KEY, HOUR, *windows.lags("pm25", KEY, HOUR, (1, 3, 6, 12, 24, 48), "pm25_lag"))


@query("same_hour_7d", using("uhourly", body=f"""
    SELECT location_id, hour_start_utc, {avg6('pm25', '''OVER (
        PARTITION BY location_id, hour(hour_start_utc) ORDER BY hour_start_utc
        ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)''')} AS pm25_same_hour_7d
    FROM uhourly"""))
def _(i: Inputs):
    grid = i.grid("user_id")
    return grid.select(KEY, HOUR, windows.same_clock_mean("pm25", KEY, HOUR).alias("pm25_same_hour_7d"))


@query("locf_last_valid", using("uhourly", body="""
    SELECT location_id, hour_start_utc, last_value(pm25 IGNORE NULLS) OVER s AS last_valid,
           max(CASE WHEN pm25 IS NOT NULL THEN hour_start_utc END) OVER s AS last_valid_hour_utc
    FROM uhourly
    WINDOW s AS (PARTITION BY location_id ORDER BY hour_start_utc ROWS UNBOUNDED PRECEDING)"""))
def _(i: Inputs):
    return i.grid("user_id").select(
        KEY, HOUR,
        windows.last_valid("pm25", KEY, HOUR).alias("last_valid"),
        windows.last_seen(F.col("pm25").isNotNull(), KEY, HOUR).alias("last_valid_hour_utc"),
    )
