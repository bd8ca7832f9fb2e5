"""Great-circle geometry, compass sectors, distance bands and zone assignment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airlake.config import CONFIG, SECTORS, ZONE_KEYWORDS, Config
from airlake.functions.time import col

EARTH_RADIUS_KM = 6371


def _c(value: Column | str | float) -> Column:
    return F.lit(float(value)) if isinstance(value, (int, float)) else col(value)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    half_dp = (p2 - p1) / 2
    half_dl = F.radians(_c(lon2) - _c(lon1)) / 2
    chord = F.pow(F.sin(half_dp), F.lit(2.0)) + F.cos(p1) * F.cos(p2) * F.pow(
        F.sin(half_dl), F.lit(2.0)
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))


def bearing_deg(lat1, lon1, lat2, lon2) -> Column:
    """Initial bearing from point 1 to point 2, 0 <= b < 360, clockwise from north."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dl = F.radians(_c(lon2) - _c(lon1))
    east = F.sin(dl) * F.cos(p2)
    north = F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dl)
    return (F.degrees(F.atan2(east, north)) + 360) % 360


def sector_index(bearing: Column | str) -> Column:
    """0 = N, clockwise in 45 degree steps centred on the compass points."""
    return F.floor(((col(bearing) + 22.5) % 360) / 45).cast("int")


def sector_name(index: Column | str) -> Column:
    names = F.array(*[F.lit(s) for s in SECTORS])
    return F.try_element_at(names, col(index) + 1)


def sector_position(name: Column | str) -> Column:
    names = F.array(*[F.lit(s) for s in SECTORS])
    return (F.array_position(names, col(name)) - 1).cast("int")


def distance_band(km: Column | str) -> Column:
    d = col(km)
    return (
        F.when(d < 100, "0-100km").when(d < 250, "100-250km").otherwise("250km+")
    )


def keyword_zone(name: Column | str, keywords=ZONE_KEYWORDS) -> Column:
    """Zone of the first keyword the lower-cased name contains, else NULL."""
    lowered = F.lower(col(name))
    return F.coalesce(*[F.when(lowered.contains(k), F.lit(z)) for k, z in keywords])


def assign_zone(name, lat, lon, cfg: Config = CONFIG) -> Column:
    """Keyword match, else central within the radius, else the compass quadrant."""
    d = haversine_km(cfg.centre_lat, cfg.centre_lon, lat, lon)
    b = bearing_deg(cfg.centre_lat, cfg.centre_lon, lat, lon)
    quarters = F.array(*[F.lit(f"delhi_{q}") for q in ("north", "east", "south", "west")])
    quadrant = F.try_element_at(quarters, F.floor(((b + 45) % 360) / 90).cast("int") + 1)
    return F.coalesce(
        keyword_zone(name), F.when(d <= cfg.central_radius_km, F.lit("delhi_central")), quadrant
    )


def zone_reason(name, lat, lon, cfg: Config = CONFIG) -> Column:
    lowered = F.lower(col(name))
    keyword = F.coalesce(*[F.when(lowered.contains(k), F.lit(k)) for k, _ in ZONE_KEYWORDS])
    d = haversine_km(cfg.centre_lat, cfg.centre_lon, lat, lon)
    b = bearing_deg(cfg.centre_lat, cfg.centre_lon, lat, lon)
    return (
        F.when(keyword.isNotNull(), F.format_string("name contains '%s'", keyword))
        .when(d <= cfg.central_radius_km, F.format_string("%.1f km from CP", d))
        .otherwise(F.format_string("%.1f km from CP, bearing %.0f°", d, b))
    )


def in_box(lat, lon, west: float, south: float, east: float, north: float) -> Column:
    return col(lat).between(south, north) & col(lon).between(west, east)
