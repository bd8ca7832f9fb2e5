"""Building blocks of the checking SQL (DuckDB dialect), written independently of the Spark code."""

from __future__ import annotations

BANDS = (
    ("good", 1, 0, 30, 0, 50),
    ("satisfactory", 2, 31, 60, 51, 100),
    ("moderately_polluted", 3, 61, 90, 101, 200),
    ("poor", 4, 91, 120, 201, 300),
    ("very_poor", 5, 121, 250, 301, 400),
    ("severe", 6, 251, None, 401, 500),
)


def half(ts: str) -> str:
    return f"(date_trunc('hour', {ts} - INTERVAL 30 MINUTE) + INTERVAL 30 MINUTE)"


def micro(x: str) -> str:
    return f"CAST(round(({x}) * 1000000) AS BIGINT)"


def avg6(x: str, over: str = "") -> str:
    """Exact mean from integer micro-units."""
    return (
        f"(CAST(sum({micro(x)}) {over} AS DOUBLE) / nullif(CAST(count({x}) {over} * 1000000 AS DOUBLE), 0))"
    )


def dec(x: str, digits: int) -> str:
    return f"CAST(CAST(CAST({x} AS DECIMAL(24,6)) AS DECIMAL(24,{digits})) AS DOUBLE)"


def banded(x: str, column: int) -> str:
    """CASE over the rounded value picking one column of the band table."""
    arms = []
    for b in BANDS:
        test = f"round({x}) >= {b[2]}" + ("" if b[3] is None else f" AND round({x}) <= {b[3]}")
        value = f"'{b[0]}'" if column == 0 else str(b[column])
        arms.append(f"WHEN {test} THEN {value}")
    return "CASE " + " ".join(arms) + " END"


def category(x: str) -> str:
    return banded(x, 0)


def indicative(x: str) -> str:
    arms = " ".join(f"WHEN round_even({x}, 0) <= {b[3]} THEN '{b[0]}'" for b in BANDS[:-1])
    return f"CASE WHEN {x} IS NULL THEN NULL {arms} ELSE 'severe' END"


def subindex(x: str) -> str:
    arms = " ".join(
        f"WHEN round({x}) BETWEEN {b[2]} AND {b[3]} THEN "
        f"round({b[4]} + {b[5] - b[4]} * (round({x}) - {b[2]}) / {b[3] - b[2]})"
        for b in BANDS[:-1]
    )
    return f"CAST(CASE {arms} END AS BIGINT)"


def hours(start: str, end: str) -> str:
    """Complete hours between two timestamps."""
    return f"date_sub('hour', {start}, {end})"


def ist_text(ts: str) -> str:
    return f"strftime({ts} + INTERVAL 330 MINUTE, '%-d %b, %H:%M IST')"


def age_text(ts: str, now: str) -> str:
    s = f"date_sub('second', {ts}, {now})"
    return (
        f"CASE WHEN {s} < 3600 THEN CAST(greatest({s} // 60, 1) AS VARCHAR) || ' min ago' "
        f"WHEN {s} < 172800 THEN CAST({s} // 3600 AS VARCHAR) || ' h ago' "
        f"ELSE CAST({s} // 86400 AS VARCHAR) || ' days ago' END"
    )


def _staged(name: str, key: str) -> str:
    return f"""
        SELECT {key} AS location_id, {half('ts')} AS hour_start_utc, value, k, event_type
        FROM ev
        QUALIFY row_number() OVER (PARTITION BY {key}, {half('ts')} ORDER BY ts DESC, event_id DESC) = 1"""


def _grid(stg: str) -> str:
    return f"""
        SELECT location_id, hour_start_utc, value AS pm25_raw, k, event_type,
               value IS NULL AS is_missing,
               coalesce(value < 1 OR value > 300, FALSE) AS is_out_of_range,
               coalesce(k + 40 < 50, FALSE) AS is_low_coverage,
               count(value) OVER w = 6 AND max(value) OVER w = min(value) OVER w AS is_flatline
        FROM (
            SELECT location_id,
                   unnest(generate_series(min(hour_start_utc), (SELECT z FROM clock), INTERVAL 1 HOUR))
                       AS hour_start_utc
            FROM {stg} GROUP BY location_id
        ) LEFT JOIN {stg} USING (location_id, hour_start_utc)
        WINDOW w AS (PARTITION BY location_id ORDER BY hour_start_utc ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"""


def _fires(source: str) -> str:
    """Placement of detections; ``source`` names the view of raw ones."""
    a, b, c, d = "radians(28.6315)", "radians(latitude)", "radians(77.2167)", "radians(longitude)"
    return f"""
        SELECT f.*,
               6371 * 2 * asin(sqrt(sin(({b} - {a}) / 2) ** 2
                   + cos({a}) * cos({b}) * sin(radians(longitude - 77.2167) / 2) ** 2)) AS km,
               (degrees(atan2(sin(radians(longitude - 77.2167)) * cos({b}),
                   cos({a}) * sin({b}) - sin({a}) * cos({b}) * cos(radians(longitude - 77.2167)))) + 360) % 360
                   AS bearing
        FROM {source} f
        JOIN (
            SELECT acq_date, sensor, sp FROM (
                SELECT acq_date, sensor, max(CAST(product = 'SP' AS INT)) AS sp FROM {source} GROUP BY ALL
            ) QUALIFY row_number() OVER (
                PARTITION BY acq_date ORDER BY CAST(sensor <> 'VIIRS_SNPP' AS INT), sensor) = 1
        ) pick ON f.acq_date = pick.acq_date AND f.sensor = pick.sensor
              AND CAST(f.product = 'SP' AS INT) = pick.sp
        WHERE confidence <> 'l'"""


def _located(placed: str, city: str) -> str:
    return f"""
        SELECT '{city}' AS city_id, sensor, product, acquired_at_utc, acq_date, latitude, longitude, frp_mw,
               confidence, daynight, round(km, 1) AS distance_km, round(bearing, 1) AS bearing_deg,
               ['N','NE','E','SE','S','SW','W','NW'][1 + CAST(floor(((bearing + 22.5) % 360) / 45) AS INT)] AS sector,
               CASE WHEN km < 100 THEN '0-100km' WHEN km < 250 THEN '100-250km' ELSE '250km+' END AS distance_band
        FROM {placed}"""


def _rolling(located: str) -> str:
    w = "(PARTITION BY i ORDER BY h ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"
    return f"""
        SELECT ['N','NE','E','SE','S','SW','W','NW'][i + 1] AS sector, i AS sector_index,
               h + INTERVAL 4 HOUR AS as_of_utc, h + INTERVAL 1 HOUR AS window_end_utc,
               CAST(sum(coalesce(n, 0)) OVER {w.format(23)} AS BIGINT) AS n_24h,
               CAST(sum(coalesce(n, 0)) OVER {w.format(47)} AS BIGINT) AS n_48h,
               CAST(sum(coalesce(n, 0)) OVER {w.format(71)} AS BIGINT) AS n_72h,
               {dec(f"(sum(coalesce(frp, 0)) OVER {w.format(23)}) / 1000000.0", 1)} AS frp_24h
        FROM (
            SELECT i, unnest(generate_series(
                (SELECT date_trunc('hour', min(acquired_at_utc)) FROM {located}),
                (SELECT date_trunc('hour', max(ts)) + INTERVAL 26 HOUR FROM events), INTERVAL 1 HOUR)) AS h
            FROM range(8) AS r(i)
        ) LEFT JOIN (
            SELECT list_position(['N','NE','E','SE','S','SW','W','NW'], sector) - 1 AS i,
                   date_trunc('hour', acquired_at_utc) AS h, count(*) AS n, sum({micro('frp_mw')}) AS frp
            FROM {located} GROUP BY ALL
        ) USING (i, h)"""


def _area(area: str) -> str:
    return f"""
        SELECT {area}, hour_start_utc, median(pm25) AS pm25_median, median(pm25_24h) AS pm25_24h_median,
               count(pm25) AS stations_reporting, count(pm25_24h) AS stations_with_24h_avg,
               count(*) AS stations_expected
        FROM aqi WHERE NOT is_colocated_duplicate GROUP BY ALL"""


_LAST24 = "OVER (PARTITION BY location_id ORDER BY hour_start_utc ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"

# name -> (views it needs, body)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": ((), """
        SELECT event_id, ts, user_id, event_type, value,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, user_id % 8 AS loc,
               'z' || CAST((user_id % 8) % 3 AS VARCHAR) AS zone
        FROM events"""),
    "clock": ((), """
        SELECT max(ts) AS now, date_trunc('hour', max(ts) - INTERVAL 30 MINUTE) - INTERVAL 30 MINUTE AS z
        FROM events"""),
    "stg": (("ev",), _staged("stg", "loc")),
    "ustg": (("ev",), _staged("ustg", "user_id")),
    "grid": (("stg", "clock"), _grid("stg")),
    "ugrid": (("ustg", "clock"), _grid("ustg")),
    "hourly": (("grid",), """
        SELECT *, NOT (is_missing OR is_out_of_range OR is_low_coverage OR is_flatline) AS is_valid,
               CASE WHEN NOT (is_missing OR is_out_of_range OR is_low_coverage OR is_flatline)
                    THEN pm25_raw END AS pm25
        FROM grid"""),
    "uhourly": (("ugrid",), """
        SELECT *, NOT (is_missing OR is_out_of_range OR is_low_coverage OR is_flatline) AS is_valid,
               CASE WHEN NOT (is_missing OR is_out_of_range OR is_low_coverage OR is_flatline)
                    THEN pm25_raw END AS pm25
        FROM ugrid"""),
    "stations": (("ev",), """
        SELECT DISTINCT loc AS location_id, 'Station ' || loc AS station_name, 'CPCB' AS agency,
               'caaqm' AS provider, 28.4::DOUBLE + ((loc * 37) % 100) / 200::DOUBLE AS latitude,
               77.0::DOUBLE + ((loc * 53) % 100) / 200::DOUBLE AS longitude, loc + 1000 AS pm25_sensor_id,
               zone AS zone_id, 'c0' AS city_id, CASE WHEN loc % 8 = 7 THEN loc - 4 END AS colocated_with
        FROM ev"""),
    "zones": (("stations",), """
        SELECT DISTINCT zone_id, 'Zone ' || zone_id AS zone_name, city_id FROM stations"""),
    "aqi": (("hourly", "stations"), f"""
        SELECT location_id, zone_id, city_id, hour_start_utc, hour_start_utc + INTERVAL 1 HOUR AS hour_end_utc,
               pm25, pm25_raw, is_valid, is_missing, n AS valid_hours_24h, m AS pm25_24h,
               {category('m')} AS aqi_category, CAST({banded('m', 1)} AS BIGINT) AS aqi_category_order,
               {subindex('m')} AS pm25_subindex, colocated_with IS NOT NULL AS is_colocated_duplicate
        FROM (
            SELECT *, CASE WHEN n >= 16 THEN {dec('raw_mean', 1)} END AS m
            FROM (SELECT *, count(pm25) {_LAST24} AS n, {avg6('pm25', _LAST24)} AS raw_mean FROM hourly)
        ) JOIN stations USING (location_id)"""),
    "zone_hourly": (("aqi",), _area("zone_id")),
    "city_hourly": (("aqi",), _area("city_id")),
    "dates": ((), """
        SELECT CAST(d AS DATE) AS date_ist, year(d) AS year, month(d) AS month, isodow(d) AS day_of_week,
               isodow(d) >= 6 AS is_weekend, r_name IS NOT NULL AS is_festival, r_name AS festival_name
        FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)),
                     date_trunc('day', max(ts)) + INTERVAL 4 DAY, INTERVAL 1 DAY)) AS d FROM events)
        LEFT JOIN region
          ON CAST(d AS DATE) = (SELECT CAST(min(ts) AS DATE) FROM events) + CAST(r_regionkey * 7 AS INTEGER)"""),
    "ofire": ((), """
        SELECT CASE o_orderkey % 2 WHEN 0 THEN 'VIIRS_SNPP' ELSE 'VIIRS_NOAA20' END AS sensor,
               CASE o_orderstatus WHEN 'F' THEN 'SP' ELSE 'NRT' END AS product,
               o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_custkey % 60) AS acquired_at_utc,
               CAST(o_orderdate AS DATE) AS acq_date,
               27.5::DOUBLE + (o_custkey % 510) / 100::DOUBLE AS latitude,
               73.8::DOUBLE + (o_orderkey % 470) / 100::DOUBLE AS longitude,
               o_totalprice / 1000 AS frp_mw,
               CASE o_orderpriority[1] WHEN '1' THEN 'h' WHEN '5' THEN 'l' ELSE 'n' END AS confidence,
               CASE o_orderkey % 3 WHEN 0 THEN 'N' ELSE 'D' END AS daynight, o_orderkey AS order_id
        FROM orders"""),
    "oplaced": (("ofire",), _fires("ofire")),
    "olocated": (("oplaced",), _located("oplaced", "delhi_ncr")),
    "efire": (("ev",), """
        SELECT CASE event_id % 2 WHEN 0 THEN 'VIIRS_SNPP' ELSE 'VIIRS_NOAA20' END AS sensor,
               CASE event_type WHEN 'error' THEN 'NRT' ELSE 'SP' END AS product, ts AS acquired_at_utc,
               CAST(ts AS DATE) AS acq_date, 27.5::DOUBLE + ((user_id * 13) % 510) / 100::DOUBLE AS latitude,
               73.8::DOUBLE + (event_id % 470) / 100::DOUBLE AS longitude, value AS frp_mw,
               CASE WHEN k < 20 THEN 'l' WHEN k > 80 THEN 'h' ELSE 'n' END AS confidence, 'D' AS daynight
        FROM ev"""),
    "eplaced": (("efire",), _fires("efire")),
    "elocated": (("eplaced",), _located("eplaced", "c0")),
    "erolling": (("elocated",), _rolling("elocated")),
    "edaily": (("elocated",), f"""
        SELECT city_id, acq_date, sector, distance_band, count(*) AS fire_count,
               {dec(f"sum({micro('frp_mw')}) / 1000000.0", 1)} AS frp_sum_mw
        FROM elocated GROUP BY ALL"""),
    "actuals": (("ev",), """
        SELECT zone AS point_id, date_trunc('hour', ts) AS time_utc, max(value) AS temperature_2m,
               CAST(max(k) AS DOUBLE) AS relative_humidity_2m, min(value) AS wind_speed_10m,
               CAST(sum(k) * 7 % 360 AS DOUBLE) AS wind_direction_10m,
               CAST(count(*) * 100 AS DOUBLE) AS boundary_layer_height
        FROM ev GROUP BY ALL"""),
    "wfc": (("ev",), """
        SELECT zone AS point_id, date_trunc('hour', ts) AS issued_at,
               date_trunc('hour', ts) + to_hours(event_id % 48) AS valid_time_utc, value AS temperature_2m,
               CAST(k AS DOUBLE) AS relative_humidity_2m, value / 10 AS wind_speed_10m,
               CAST(k * 7 % 360 AS DOUBLE) AS wind_direction_10m, CAST(k * 10 AS DOUBLE) AS boundary_layer_height
        FROM ev
        QUALIFY row_number() OVER (PARTITION BY zone, date_trunc('hour', ts),
            date_trunc('hour', ts) + to_hours(event_id % 48) ORDER BY event_id DESC) = 1"""),
    "runs": (("ev",), """
        SELECT zone AS point_id, date_trunc('hour', ts) AS time_utc, 1 + event_id % 4 AS days_before,
               value AS temperature_2m, CAST(k AS DOUBLE) AS relative_humidity_2m, value / 10 AS wind_speed_10m,
               CAST(k * 7 % 360 AS DOUBLE) AS wind_direction_10m, k / 100::DOUBLE AS precipitation,
               k + 1000::DOUBLE AS surface_pressure
        FROM ev
        QUALIFY row_number() OVER (PARTITION BY zone, date_trunc('hour', ts), event_id % 4
                                   ORDER BY event_id DESC) = 1"""),
    "camsh": (("ev",), """
        SELECT zone AS point_id, date_trunc('hour', ts) AS time_utc,
               CASE WHEN count(*) % 2 = 0 THEN max(value) END AS cams_pm25
        FROM ev GROUP BY ALL"""),
    "issues": (("aqi",), f"""
        SELECT location_id, zone_id, city_id, hour_start_utc, horizon_h,
               hour_start_utc + INTERVAL 1 HOUR AS issue_time_utc,
               hour_start_utc + to_hours(horizon_h) AS target_hour_start_utc, pm25_last_valid, same7
                   AS pm25_same_hour_7d, last_valid_hour_utc,
               CASE horizon_h WHEN 24 THEN t24 WHEN 48 THEN t48 ELSE t72 END AS target_pm25
        FROM (
            SELECT *, lead(pm25, 24) OVER s AS t24, lead(pm25, 48) OVER s AS t48, lead(pm25, 72) OVER s AS t72,
                   last_value(pm25 IGNORE NULLS) OVER (s ROWS UNBOUNDED PRECEDING) AS pm25_last_valid,
                   max(CASE WHEN pm25 IS NOT NULL THEN hour_start_utc END)
                       OVER (s ROWS UNBOUNDED PRECEDING) AS last_valid_hour_utc,
                   {avg6('pm25', "OVER (PARTITION BY location_id, hour(hour_start_utc) ORDER BY hour_start_utc ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)")} AS same7
            FROM aqi WHERE NOT is_colocated_duplicate
            WINDOW s AS (PARTITION BY location_id ORDER BY hour_start_utc)
        ), (VALUES (24), (48), (72)) AS hz(horizon_h)
        WHERE hour(hour_start_utc) % 3 = 0 AND valid_hours_24h >= 6"""),
    "preds": (("issues",), f"""
        SELECT location_id, zone_id, city_id, horizon_h, issue_time_utc, target_hour_start_utc,
               {dec('pm25_last_valid * 0.9 + 5', 1)} AS pm25_pred,
               date_sub('hour', last_valid_hour_utc, hour_start_utc) AS input_age_hours,
               date_sub('hour', last_valid_hour_utc, hour_start_utc) > 3 AS is_stale_input,
               last_valid_hour_utc, 'v1' AS model_version, issue_time_utc AS predicted_at
        FROM issues"""),
    "fcst": (("preds",), f"""
        SELECT location_id, zone_id, city_id, CAST(horizon_h AS BIGINT) AS horizon_h, issue_time_utc,
               target_hour_start_utc, pm25_pred, {category('pm25_pred')} AS predicted_aqi_category,
               input_age_hours, is_stale_input, last_valid_hour_utc, model_version, predicted_at
        FROM preds"""),
    "facc": (("fcst", "aqi"), f"""
        SELECT f.location_id, f.zone_id, f.horizon_h, f.issue_time_utc, f.target_hour_start_utc, f.model_version,
               f.is_stale_input, f.pm25_pred, a.pm25 AS pm25_actual, f.pm25_pred - a.pm25 AS error,
               abs(f.pm25_pred - a.pm25) AS abs_error, f.predicted_aqi_category,
               {category('a.pm25')} AS actual_aqi_category,
               f.predicted_aqi_category = {category('a.pm25')} AS category_correct
        FROM fcst f JOIN aqi a ON a.location_id = f.location_id AND a.hour_start_utc = f.target_hour_start_utc
        WHERE a.is_valid"""),
    "ulatest": (("ev",), """
        SELECT user_id AS location_id, CASE WHEN k % 3 = 0 THEN 'pm10' ELSE 'pm25' END AS parameter,
               ts AS reading_utc, value FROM ev"""),
    "ustations": (("ev",), """
        SELECT DISTINCT user_id AS location_id, 'Station ' || user_id AS station_name,
               'z' || CAST(user_id % 3 AS VARCHAR) AS zone_id, 'c0' AS city_id FROM ev"""),
    "ustatus": (("ulatest", "ustations", "clock"), """
        SELECT *, CASE WHEN last_pm25_reading_utc IS NULL THEN 'no_data' WHEN age_hours <= 3 THEN 'live'
                       WHEN age_hours <= 6 THEN 'delayed' WHEN age_hours <= 168 THEN 'inactive'
                       ELSE 'offline' END AS status
        FROM (
            SELECT location_id, station_name, zone_id, city_id, last_pm25_reading_utc, last_pm25_value,
                   last_any_reading_utc, last_any_reading_utc AS last_checked_utc, now AS snapshot_at,
                   date_sub('minute', last_pm25_reading_utc, now) / 60.0::DOUBLE AS age_hours
            FROM ustations LEFT JOIN (
                SELECT location_id, max(reading_utc) FILTER (parameter = 'pm25') AS last_pm25_reading_utc,
                       arg_max(value, reading_utc) FILTER (parameter = 'pm25') AS last_pm25_value,
                       max(reading_utc) AS last_any_reading_utc
                FROM ulatest GROUP BY 1
            ) USING (location_id), clock)"""),
    "ufeed": (("uhourly",), """
        SELECT *, CASE WHEN share_not_live >= 0.8 THEN 'outage' WHEN share_not_live >= 0.3 THEN 'degraded'
                       ELSE 'ok' END AS feed_status
        FROM (
            SELECT hour_start_utc, count(*) AS stations_tracked,
                   count(*) FILTER (date_sub('hour', seen, hour_start_utc) <= 3) AS stations_live,
                   round(1 - count(*) FILTER (date_sub('hour', seen, hour_start_utc) <= 3) / count(*), 3)
                       AS share_not_live,
                   max(seen) AS newest_report_utc
            FROM (
                SELECT hour_start_utc, max(CASE WHEN NOT is_missing THEN hour_start_utc END) OVER (
                    PARTITION BY location_id ORDER BY hour_start_utc ROWS UNBOUNDED PRECEDING) AS seen
                FROM uhourly)
            GROUP BY 1)"""),
}


def using(*names: str, body: str) -> str:
    """``body`` with a WITH clause holding the named views and everything they need, in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in VIEWS[name][0]:
            visit(need)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in order)
    return f"WITH {ctes}\n{body}"
