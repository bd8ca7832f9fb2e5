"""Detections around the city, spatial joins, zones and dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from airlake.catalog.inputs import CFG, Inputs
from airlake.catalog.registry import query
from airlake.catalog.views import dec, micro, using
from airlake.config import CONFIG
from airlake.functions import geo
from airlake.functions.text import agency_of
from airlake.functions.time import add, as_ts
from airlake.operators import spatial
from airlake.operators.reshape import prefer_available
from airlake.plans import fires, hourly, stations

_PRODUCT = using("ofire", body="""
    SELECT order_id, sensor, product, acq_date FROM ofire
    QUALIFY dense_rank() OVER (PARTITION BY acq_date, sensor
                               ORDER BY CASE product WHEN 'SP' THEN 0 ELSE 1 END) = 1""")


@query("fires_prefer_product", _PRODUCT, dates=("acq_date",))
def _(i: Inputs):
    return fires.preferred_product(i.order_fires()).select("order_id", "sensor", "product", "acq_date")


@query("fires_located", using("olocated", body="SELECT * FROM olocated"), dates=("acq_date",))
def _(i: Inputs):
    return fires.locate(i.order_fires(), CONFIG)


@query("fires_daily", using("olocated", body=f"""
    SELECT city_id, acq_date, sector, distance_band, count(*) AS fire_count,
           {dec(f"sum({micro('frp_mw')}) / 1000000.0", 1)} AS frp_sum_mw
    FROM olocated GROUP BY ALL"""), dates=("acq_date",))
def _(i: Inputs):
    return fires.daily(fires.locate(i.order_fires(), CONFIG))


@query("fires_hourly", using("olocated", body=f"""
    SELECT sector, date_trunc('hour', acquired_at_utc) AS hour_utc, count(*) AS n,
           CAST(sum({micro('frp_mw')}) AS DOUBLE) / 1000000 AS frp
    FROM olocated GROUP BY ALL"""))
def _(i: Inputs):
    return fires.hourly(fires.locate(i.order_fires(), CONFIG))


@query("fires_sector_rolling", using("erolling", body="SELECT * FROM erolling"))
def _(i: Inputs):
    return fires.rolling(fires.locate(i.event_fires(), CFG), i.as_of(), CFG)


@query("upwind_sector_sum", using("erolling", body=f"""
    SELECT as_of_utc, w AS wind_index, CAST(sum(n_24h) AS BIGINT) AS fires_upwind_24h,
           CAST(sum(n_48h) AS BIGINT) AS fires_upwind_48h, CAST(sum(n_72h) AS BIGINT) AS fires_upwind_72h,
           CAST(sum({micro('frp_24h')}) AS DOUBLE) / 1000000 AS fires_upwind_frp_24h
    FROM erolling JOIN range(8) AS d(w)
      ON least(abs(sector_index - w), 8 - abs(sector_index - w)) <= 1
    GROUP BY ALL"""))
def _(i: Inputs):
    return fires.upwind(fires.rolling(fires.locate(i.event_fires(), CFG), i.as_of(), CFG))


@query("nw_arc_sum", using("erolling", body="""
    SELECT as_of_utc, max(window_end_utc) AS fires_window_end_utc, CAST(sum(n_24h) AS BIGINT) AS fires_nw_arc_24h,
           CAST(sum(n_72h) AS BIGINT) AS fires_nw_arc_72h
    FROM erolling WHERE sector_index IN (0, 6, 7) GROUP BY 1"""))
def _(i: Inputs):
    return fires.nw_arc(fires.rolling(fires.locate(i.event_fires(), CFG), i.as_of(), CFG))


# --- spatial --------------------------------------------------------------------------------------

_PLACES = """
    SELECT c_custkey AS location_id,
           28.3::DOUBLE + ((c_custkey * 7919) % 997) / 2000::DOUBLE + (c_custkey % 3) / 4000::DOUBLE AS latitude,
           76.9::DOUBLE + ((c_custkey * 104729) % 61) / 100::DOUBLE AS longitude
    FROM customer"""


def _places(i: Inputs):
    k = F.col("c_custkey")
    return i.table("customer").select(
        k.alias("location_id"),
        (F.lit(28.3) + k * 7919 % 997 / 2000 + k % 3 / 4000).alias("latitude"),
        (F.lit(76.9) + k * 104729 % 61 / 100).alias("longitude"),
    )


def _km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"6371 * 2 * asin(sqrt(sin(radians({lat2} - {lat1}) / 2) ** 2 + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * sin(radians({lon2} - {lon1}) / 2) ** 2))"
    )


@query("colocated_pairs", f"""
    WITH p AS ({_PLACES})
    SELECT b.location_id, (SELECT min(a.location_id) FROM p a
        WHERE a.location_id < b.location_id AND abs(a.latitude - b.latitude) < 0.002
          AND {_km('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude')} * 1000 < 100) AS colocated_with
    FROM p b""")
def _(i: Inputs):
    return spatial.colocated_with(_places(i)).select("location_id", "colocated_with")


@query("nearest_k", f"""
    WITH p AS ({_PLACES})
    SELECT location_id, latitude, longitude,
           round({_km('28.6315', '77.2167', 'latitude', 'longitude')}, 3) AS distance_km
    FROM p ORDER BY {_km('28.6315', '77.2167', 'latitude', 'longitude')}, location_id LIMIT 10""")
def _(i: Inputs):
    return spatial.nearest(_places(i), CONFIG.centre_lat, CONFIG.centre_lon, 10)


# Suppliers' depots: clustered, several at one spot.
_DEPOTS = """
    SELECT s_suppkey AS place_id, 28.3::DOUBLE + ((s_suppkey * 31) % 97) / 200::DOUBLE AS latitude,
           76.9::DOUBLE + ((s_suppkey * 17) % 13) / 20::DOUBLE + (s_suppkey % 2) * 90 AS longitude
    FROM supplier"""


def _depots(i: Inputs):
    k = F.col("s_suppkey")
    return i.table("supplier").select(
        k.alias("place_id"), (F.lit(28.3) + k * 31 % 97 / 200).alias("latitude"),
        (F.lit(76.9) + k * 17 % 13 / 20 + k % 2 * 90).alias("longitude"),
    )


@query("nearest_k_batch", f"""
    WITH p AS ({_PLACES}), d AS ({_DEPOTS}), far AS (
        SELECT p.location_id, d.place_id, round({_km('p.latitude', 'p.longitude', 'd.latitude', 'd.longitude')}, 6) AS distance_km
        FROM p, d)
    SELECT location_id, row_number() OVER (PARTITION BY location_id ORDER BY distance_km, place_id)::INT AS rank, place_id, distance_km
    FROM far QUALIFY rank <= 3""")
def _(i: Inputs):
    return spatial.nearest_join(_places(i), _depots(i), 3).select("location_id", "rank", "place_id", "distance_km")


@query("bounding_box", f"""
    WITH p AS ({_PLACES})
    SELECT location_id FROM p WHERE latitude BETWEEN 28.4 AND 28.6 AND longitude BETWEEN 77.0 AND 77.3""")
def _(i: Inputs):
    return _places(i).filter(geo.in_box("latitude", "longitude", 77.0, 28.4, 77.3, 28.6)).select("location_id")


_KEYWORDS = (
    ("noida", "noida"), ("gurugram", "gurugram"), ("gurgaon", "gurugram"), ("manesar", "gurugram"),
    ("ggn", "gurugram"), ("faridabad", "faridabad"), ("ghaziabad", "ghaziabad"), ("loni", "ghaziabad"),
    ("khora", "ghaziabad"), ("modinagar", "ghaziabad"), ("bahadurgarh", "bahadurgarh"),
)
_NAMES = "['Sector 62 Noida', 'Gurgaon', 'Loni Road', 'Anand Vihar', 'ITO', 'NOIDA Gurugram', 'Khora']"
_B = (
    "(degrees(atan2(sin(radians(longitude - 77.2167)) * cos(radians(latitude)), "
    "cos(radians(28.6315)) * sin(radians(latitude)) - sin(radians(28.6315)) * cos(radians(latitude)) "
    "* cos(radians(longitude - 77.2167)))) + 360) % 360"
)


@query("zone_assign", f"""
    WITH p AS ({_PLACES}), named AS (
        SELECT *, {_NAMES}[1 + location_id % 7] || ' - ' || ['DPCC', 'UPPCB', 'Other'][1 + location_id % 3] AS name,
               {_km('28.6315', '77.2167', 'latitude', 'longitude')} AS d, {_B} AS b FROM p)
    SELECT location_id, nullif(regexp_extract(name, '-\\s*(DPCC|CPCB|UPPCB|HSPCB|IMD|IITM|MHUA)\\s*$', 1), '') AS agency,
           coalesce(zone, CASE WHEN d <= 6 THEN 'delhi_central' WHEN b >= 315 OR b < 45 THEN 'delhi_north'
               WHEN b < 135 THEN 'delhi_east' WHEN b < 225 THEN 'delhi_south' ELSE 'delhi_west' END) AS zone_id,
           coalesce('name contains ''' || word || '''', CASE WHEN d <= 6 THEN printf('%.1f km from CP', d)
               ELSE printf('%.1f km from CP, bearing %.0f°', d, b) END) AS zone_reason
    FROM named LEFT JOIN (
        SELECT location_id, arg_min(word, i) AS word, arg_min(zone, i) AS zone
        FROM named JOIN (VALUES {', '.join(f"({n}, '{w}', '{z}')" for n, (w, z) in enumerate(_KEYWORDS))})
             AS kw(i, word, zone) ON contains(lower(name), word)
        GROUP BY 1
    ) USING (location_id)""")
def _(i: Inputs):
    names = F.array(*[F.lit(n) for n in (
        "Sector 62 Noida", "Gurgaon", "Loni Road", "Anand Vihar", "ITO", "NOIDA Gurugram", "Khora")])
    k = F.col("location_id")
    suffix = F.array(F.lit("DPCC"), F.lit("UPPCB"), F.lit("Other"))
    name = F.concat(
        F.element_at(names, (k % 7 + 1).cast("int")), F.lit(" - "), F.element_at(suffix, (k % 3 + 1).cast("int"))
    )
    return _places(i).withColumn("name", name).select(
        "location_id",
        agency_of("name").alias("agency"),
        geo.assign_zone("name", "latitude", "longitude").alias("zone_id"),
        geo.zone_reason("name", "latitude", "longitude").alias("zone_reason"),
    )


@query("zone_centroid", using("stations", body=f"""
    SELECT zone_id AS point_id, {dec(f"sum({micro('latitude')}) / count(*) / 1000000", 4)} AS latitude,
           {dec(f"sum({micro('longitude')}) / count(*) / 1000000", 4)} AS longitude
    FROM stations WHERE colocated_with IS NULL GROUP BY zone_id"""))
def _(i: Inputs):
    return hourly.zone_centroids(i.stations())


# --- dimensions -----------------------------------------------------------------------------------


@query("dim_date_spine", using("dates", body="SELECT * FROM dates"), dates=("date_ist",))
def _(i: Inputs):
    return i.dates()


@query("dim_station_stats", using("hourly", "stations", body=f"""
    SELECT s.*, colocated_with IS NOT NULL AS is_colocated_duplicate, first_hour_utc, last_reported_hour_utc,
           coalesce(grid_hours, 0) AS grid_hours, pct_valid_hours, first_hour_utc IS NULL AS has_no_history
    FROM stations s LEFT JOIN (
        SELECT location_id, min(hour_start_utc) AS first_hour_utc,
               max(hour_start_utc) FILTER (NOT is_missing) AS last_reported_hour_utc, count(*) AS grid_hours,
               {dec('count(*) FILTER (is_valid) * 100 / count(*)', 1)} AS pct_valid_hours
        FROM hourly GROUP BY 1) USING (location_id)"""))
def _(i: Inputs):
    return hourly.dim_station(i.stations(), i.grid())


@query("dim_zone_counts", """
    SELECT CAST(n_nationkey AS VARCHAR) AS zone_id, n_name AS zone_name, CAST(n_regionkey AS VARCHAR) AS city_id,
           count(s_suppkey) AS station_count, r_regionkey / 10::DOUBLE AS weather_point_lat,
           r_regionkey * 2::DOUBLE AS weather_point_lon
    FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey LEFT JOIN region ON r_regionkey = n_nationkey
    GROUP BY ALL""")
def _(i: Inputs):
    zones = i.table("nation").select(
        F.col("n_nationkey").cast("string").alias("zone_id"), F.col("n_name").alias("zone_name"),
        F.col("n_regionkey").cast("string").alias("city_id"),
    )
    stations = i.table("supplier").select(
        F.col("s_suppkey").alias("location_id"), F.col("s_nationkey").cast("string").alias("zone_id")
    )
    points = i.table("region").select(
        F.col("r_regionkey").cast("string").alias("point_id"),
        (F.col("r_regionkey") / 10).alias("latitude"), (F.col("r_regionkey") * 2.0).alias("longitude"),
    )
    return hourly.dim_zone(zones, stations, points)


@query("dim_city", """
    SELECT CAST(r_regionkey AS VARCHAR) AS city_id, r_name AS city_name, 'Asia/Kolkata' AS timezone FROM region""")
def _(i: Inputs):
    return hourly.dim_city(
        i.table("region").select(
            F.col("r_regionkey").cast("string").alias("city_id"), F.col("r_name").alias("city_name"),
            F.lit("Asia/Kolkata").alias("timezone"),
        )
    )


@query("availability_range", """
    WITH want AS (
        SELECT DISTINCT l_suppkey AS supplier, CAST(l_shipdate AS DATE) AS day FROM lineitem
    ), offer AS (
        SELECT l_suppkey AS supplier, l_returnflag AS product,
               CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS pref,
               CAST(min(l_shipdate) AS DATE) + 200 AS min_date, CAST(max(l_shipdate) AS DATE) - 200 AS max_date
        FROM lineitem GROUP BY ALL
    )
    SELECT supplier, day, arg_min(product, pref) AS product, CAST(min(pref) AS BIGINT) AS pref
    FROM want LEFT JOIN offer USING (supplier)
    WHERE day BETWEEN min_date AND max_date
    GROUP BY ALL
    UNION ALL
    SELECT supplier, day, NULL, NULL FROM want w WHERE NOT EXISTS (
        SELECT 1 FROM offer o WHERE o.supplier = w.supplier AND w.day BETWEEN min_date AND max_date)""", dates=("day",))
def _(i: Inputs):
    lines = i.table("lineitem").select(
        F.col("l_suppkey").alias("supplier"), F.col("l_returnflag").alias("product"),
        F.to_date("l_shipdate").alias("day"),
    )
    pref = F.when(F.col("product") == "A", 0).when(F.col("product") == "N", 1).otherwise(2)
    offers = lines.groupBy("supplier", "product").agg(
        F.date_add(F.min("day"), 200).alias("min_date"), F.date_sub(F.max("day"), 200).alias("max_date")
    ).withColumn("pref", pref)
    wanted = lines.select("supplier", "day").distinct()
    return prefer_available(wanted, offers, ["supplier"], "day", "pref")


# --- station selection ----------------------------------------------------------------------------

_SITES = """
    SELECT c_custkey AS location_id, 28.3::DOUBLE + ((c_custkey * 7919) % 997) / 2000::DOUBLE AS latitude,
           76.9::DOUBLE + ((c_custkey * 104729) % 61) / 100::DOUBLE AS longitude,
           'Site ' || c_custkey || CASE c_custkey % 4 WHEN 0 THEN ' - DPCC' WHEN 1 THEN ' Noida - UPPCB' ELSE '' END AS name,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN 'PurpleAir' ELSE 'caaqm' END AS provider,
           c_custkey % 5 = 0 AS is_monitor, c_custkey % 11 = 0 AS is_mobile,
           TIMESTAMP '2001-08-01' - to_days(c_custkey % 45) AS last_utc
    FROM customer"""
# Four sensors per site; an order is a reading of one of them, newest first.
_SENSORS = ((0, "pm25", "µg/m³"), (1, "co", "µg/m³"), (2, "co", "ppb"), (3, "no2", "ppb"))


@query("select_stations", f"""
    WITH site AS ({_SITES}), cand AS (
        SELECT *, nullif(regexp_extract(name, '-\\s*(DPCC|CPCB|UPPCB|HSPCB|IMD|IITM|MHUA)\\s*$', 1), '') AS agency FROM site
        WHERE provider NOT IN ('AirGradient', 'PurpleAir', 'Clarity') AND NOT is_mobile
          AND (is_monitor OR regexp_matches(name, '-\\s*(DPCC|CPCB|UPPCB|HSPCB|IMD|IITM|MHUA)\\s*$'))
          AND last_utc >= TIMESTAMP '2001-08-01' - INTERVAL 30 DAY
    ), live AS (
        SELECT location_id, sensor_id, s AS slot FROM (
            SELECT o_custkey AS location_id, o_custkey * 10 + o_orderkey % 4 AS sensor_id, o_orderkey % 4 AS s,
                   max(o_orderdate + INTERVAL 1000 DAY) AS seen_at FROM orders GROUP BY ALL)
        JOIN cand USING (location_id) WHERE seen_at >= last_utc - INTERVAL 7 DAY
    ), maps AS (
        SELECT location_id, max(sensor_id) FILTER (slot = 0) AS pm25_sensor_id,
               string_agg(CASE slot WHEN 0 THEN 'pm25' WHEN 3 THEN 'no2'
                   WHEN 1 THEN CASE WHEN n2 > 1 THEN 'co_ugm3' ELSE 'co' END
                   ELSE CASE WHEN n2 > 1 THEN 'co_ppb' ELSE 'co' END END || '=' || sensor_id, ','
                   ORDER BY CASE slot WHEN 0 THEN 'pm25' WHEN 3 THEN 'no2' WHEN 1 THEN 'co_a' ELSE 'co_b' END DESC) AS sensors
        FROM (SELECT *, count(*) FILTER (slot IN (1, 2)) OVER (PARTITION BY location_id) AS n2 FROM live)
        GROUP BY 1 HAVING count(*) FILTER (slot = 0) > 0
    ), found AS (SELECT * FROM cand JOIN maps USING (location_id))
    SELECT location_id, agency, pm25_sensor_id, array_to_string(list_sort(string_split(sensors, ',')), ',') AS sensors,
           (SELECT min(a.location_id) FROM found a WHERE a.location_id < b.location_id AND abs(a.latitude - b.latitude) < 0.002
              AND {_km('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude')} * 1000 < 100) AS colocated_with
    FROM found b""")
def _(i: Inputs):
    k = F.col("c_custkey")
    suffix = F.when(k % 4 == 0, " - DPCC").when(k % 4 == 1, " Noida - UPPCB").otherwise("")
    sensors = F.array(*[
        F.struct((k * 10 + n).alias("id"), F.lit(p).alias("parameter"), F.lit(u).alias("units")) for n, p, u in _SENSORS
    ])
    end = as_ts("2001-08-01 00:00:00")
    sites = i.table("customer").select(
        k.alias("location_id"),
        (F.lit(28.3) + k * 7919 % 997 / 2000).alias("latitude"),
        (F.lit(76.9) + k * 104729 % 61 / 100).alias("longitude"),
        F.concat(F.lit("Site "), k.cast("string"), suffix).alias("name"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "PurpleAir").otherwise("caaqm").alias("provider"),
        (k % 5 == 0).alias("is_monitor"), (k % 11 == 0).alias("is_mobile"),
        end.alias("first_utc"), add(end, "DAY", -(k % 45)).alias("last_utc"), sensors.alias("sensors"),
    )
    o = F.col("o_custkey")
    latest = i.table("orders").select(
        o.alias("location_id"), (o * 10 + F.col("o_orderkey") % 4).alias("sensor_id"),
        add("o_orderdate", "DAY", 1000).alias("reading_utc"),
    )
    rows = stations.select_stations(sites, latest, end)
    pairs = F.transform(
        F.map_entries("sensors"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))
    )
    return rows.select("location_id", "agency", "pm25_sensor_id", F.array_join(F.array_sort(pairs), ",").alias("sensors"), "colocated_with")
