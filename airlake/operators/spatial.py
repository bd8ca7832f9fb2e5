"""Nearest neighbours and co-located pairs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.config import CONFIG, Config
from airlake.functions.geo import EARTH_RADIUS_KM, haversine_km
from airlake.session import stored


def nearest(df: DataFrame, lat: float, lon: float, n: int, id_col: str = "location_id") -> DataFrame:
    """The ``n`` rows closest to a point: a projection and a top-k, no join."""
    d = haversine_km(lat, lon, "latitude", "longitude")
    return df.withColumn("distance_km", F.round(d, 3)).orderBy(d, id_col).limit(n)


def _on_sphere(lat: Column, lon: Column) -> list[Column]:
    """Metres from the centre of the earth along three axes: no poles, no seam."""
    r = EARTH_RADIUS_KM * 1000
    return [
        r * F.cos(F.radians(lat)) * F.cos(F.radians(lon)), r * F.cos(F.radians(lat)) * F.sin(F.radians(lon)),
        r * F.sin(F.radians(lat)),
    ]


def _cells(lat: Column, lon: Column, side: float | Column) -> list[Column]:
    """The cube of the given side that a point lies in, along three axes."""
    return [F.floor(a / side).cast("long").alias(f"_{k}") for k, a in zip("xyz", _on_sphere(lat, lon), strict=True)]


XYZ = ["_x", "_y", "_z"]
FINEST_M = 8.0  # side of the smallest cubes; each level doubles it, the last spans the earth
LEVELS = 22


def nearest_join(asked: DataFrame, places: DataFrame, k: int, place_id: str = "place_id") -> DataFrame:
    """Every row of ``asked`` (with latitude, longitude) with its ``k`` nearest places: rank, the place's id, distance_km.

    Nearer places come first (to the millimetre), then smaller ids. Exact, without comparing all with all:

    * points at one coordinate are asked once, and a coordinate keeps its k smallest place ids;
    * counts of places in cubes of 8, 16, 32 ... metres give each point the smallest cube whose 27 neighbours hold k of them;
    * their k-th distance is a bound. Where it is longer than the cube's side, the ring is widened to the level whose side is.

    Fewer than k places give fewer rows; rows without coordinates have none.
    """
    lat, lon = F.col("latitude"), F.col("longitude")
    located = "latitude IS NOT NULL AND longitude IS NOT NULL"
    spots = asked.where(located).select("latitude", "longitude").distinct()
    smallest = Window.partitionBy("latitude", "longitude").orderBy(place_id)
    few = places.where(located).where(F.col(place_id).isNotNull()).withColumn("_n", F.row_number().over(smallest)).where(F.col("_n") <= k)
    sites = few.groupBy("latitude", "longitude").agg(F.sort_array(F.collect_list(place_id)).alias("_ids"))
    sites = sites.select(lat.alias("_lat"), lon.alias("_lon"), "_ids")
    top = LEVELS - 1
    side = lambda level: FINEST_M * F.pow(F.lit(2.0), level)
    finest = lambda a, b: _cells(a, b, FINEST_M)
    up = lambda level: [F.floor(F.col(c) / F.pow(F.lit(2), level)).cast("long").alias(c) for c in XYZ]
    levels = F.explode(F.sequence(F.lit(0), F.lit(top)))
    around = lambda df: _around(df, 1)

    # counts by level, each from the one below it
    held = sites.select(*finest(F.col("_lat"), F.col("_lon")), F.size("_ids").alias("n")).groupBy(*XYZ).agg(F.sum("n").alias("n"))
    counts = held.select("*", levels.alias("_level")).select("_level", *up(F.col("_level")), "n")
    counts = counts.groupBy("_level", *XYZ).agg(F.sum("n").alias("n"))
    cells = spots.select("latitude", "longitude", *finest(lat, lon))
    leveled = cells.select("latitude", "longitude", *XYZ, levels.alias("_level"))
    leveled = leveled.select("latitude", "longitude", "_level", *up(F.col("_level")))
    asking = leveled.select("_level", *XYZ).distinct()
    enough = around(asking).join(counts, ["_level", *XYZ]).groupBy("_level", *[f"_from{c}" for c in XYZ]).agg(F.sum("n").alias("n"))
    enough = enough.where((F.col("n") >= k) | (F.col("_level") == top)).select("_level", *[F.col(f"_from{c}").alias(c) for c in XYZ])
    first = leveled.join(enough, ["_level", *XYZ], "left_semi").groupBy("latitude", "longitude").agg(F.min("_level").alias("_level"))
    first = stored(first, "nearest-levels")

    def candidates(points: DataFrame) -> DataFrame:
        used = [r[0] for r in points.select("_level").distinct().collect()]  # at most 22 numbers
        at = points.select("*", *finest(lat, lon)).select(*points.columns, *up(F.col("_level")))
        spread = sites.select("*", *finest(F.col("_lat"), F.col("_lon")), F.explode(F.array(*map(F.lit, used or [0]))).alias("_level"))
        spread = spread.select("_lat", "_lon", "_ids", "_level", *up(F.col("_level")))
        met = around(at).join(spread, ["_level", *XYZ])
        km = F.round(haversine_km(lat, lon, "_lat", "_lon"), 6)
        rows = met.select("latitude", "longitude", "_level", km.alias("distance_km"), F.explode("_ids").alias(place_id))
        best = Window.partitionBy("latitude", "longitude").orderBy("distance_km", place_id)
        return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    near = stored(candidates(first), "nearest-first")
    metres = F.max("distance_km") * 1000 + 0.01
    reach = near.groupBy("latitude", "longitude", "_level").agg(metres.alias("m"), F.max("rank").alias("n"))
    wider = F.when(F.col("n") < k, F.lit(top)).otherwise(F.least(F.ceil(F.log2(F.col("m") / FINEST_M)), F.lit(top))).cast("int")
    wide = reach.where((F.col("m") > side(F.col("_level"))) & (F.col("_level") < top)).select("latitude", "longitude", wider.alias("_level"))
    wide = stored(wide, "nearest-wide")
    settled = near.join(wide.select("latitude", "longitude"), ["latitude", "longitude"], "left_anti")
    found = settled.unionByName(candidates(wide)).select("latitude", "longitude", "rank", place_id, "distance_km")
    return asked.join(found, ["latitude", "longitude"]).select(*asked.columns, "rank", place_id, "distance_km")


def _around(df: DataFrame, reach: int) -> DataFrame:
    """Each row for every cube up to ``reach`` steps away; its own cube in ``_from_x`` and so on."""
    for c in XYZ:
        at = F.col(f"_from{c}")
        df = df.withColumnRenamed(c, f"_from{c}").withColumn(c, F.explode(F.sequence(at - reach, at + reach)))
    return df


FEW = 64  # comparisons of two cubes that are not worth a split
DEEPEST = 20


def colocated_with(df: DataFrame, id_col: str = "location_id", cfg: Config = CONFIG) -> DataFrame:
    """Per id, the smallest lower id closer than ``cfg.colocated_within_m``.

    * rows at one coordinate collapse to their smallest id first;
    * points fall into cubes whose diagonal is the limit: within a cube every point is near every other, so its
      smallest id is the answer there and no points are compared;
    * a pair of cubes up to two steps apart matters only while the other one holds an id below the best known. If all
      its points are within the limit its smallest id is taken, if none is the pair goes; a pair that the limit crosses is split
      into eighths on both sides, until it has few points to compare. Crowds are so compared along the limit only.
    """
    limit = cfg.colocated_within_m
    side = limit / math.sqrt(3) * (1 - 1e-9)
    points = df.groupBy("latitude", "longitude").agg(F.min(id_col).alias("_id"))
    points = points.where("latitude IS NOT NULL AND longitude IS NOT NULL")
    tree = lambda level: points.select("latitude", "longitude", "_id", *_cells(F.col("latitude"), F.col("longitude"), side / 2**level))
    roots = [f"_r{c}" for c in XYZ]
    cells = tree(0).groupBy(*XYZ).agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_n"))
    mine = cells.select(*[F.col(c).alias(f"_a{c}") for c in XYZ], F.col("_least").alias("_best"), F.col("_n").alias("_na"))
    theirs = _around(cells, 2)
    pairs = theirs.select(
        *[F.col(c).alias(f"_a{c}") for c in XYZ], *[F.col(f"_from{c}").alias(f"_b{c}") for c in XYZ], "_least", F.col("_n").alias("_nb")
    ).join(mine, [f"_a{c}" for c in XYZ])
    a, b = [f"_a{c}" for c in XYZ], [f"_b{c}" for c in XYZ]
    apart = lambda step: sum(
        (F.pow(F.greatest(F.abs(F.col(x) - F.col(y)) + step, F.lit(0)).cast("double"), F.lit(2.0)) for x, y in zip(a, b, strict=True)),
        F.lit(0.0),
    )
    found = []  # (latitude, longitude, _other): what comparisons and whole cubes have given
    level = 0
    while True:
        width = side / 2**level
        nearest, farthest = F.sqrt(apart(-1)) * width, F.sqrt(apart(1)) * width
        pairs = stored(pairs.where("_least < _best").where(nearest < limit * (1 + 1e-9)), f"near-pairs-{level}")
        if pairs.isEmpty():
            break
        whole = pairs.where(farthest < limit * (1 - 1e-9)).groupBy(*a).agg(F.min("_least").alias("_whole"))
        whole = stored(whole, f"near-whole-{level}")
        here = tree(level).select("latitude", "longitude", "_id", *[F.col(c).alias(x) for c, x in zip(XYZ, a, strict=True)])
        found.append(here.join(whole, a).select("latitude", "longitude", F.col("_whole").alias("_other")))
        crossing = pairs.where(farthest >= limit * (1 - 1e-9)).join(whole, a, "left")
        crossing = crossing.withColumn("_best", F.least("_best", "_whole")).where("_least < _best").drop("_whole")
        few = (F.col("_na") * F.col("_nb") <= FEW) | F.lit(level >= DEEPEST)
        others = tree(level).select(
            *[F.col(c).alias(x) for c, x in zip(XYZ, b, strict=True)],
            F.col("latitude").alias("_lat2"), F.col("longitude").alias("_lon2"), F.col("_id").alias("_other"),
        )
        metres = haversine_km("latitude", "longitude", "_lat2", "_lon2") * 1000
        compared = crossing.where(few).join(others, b).where("_other < _best").join(here, a).where(metres < limit)
        found.append(stored(compared.groupBy("latitude", "longitude").agg(F.min("_other").alias("_other")), f"near-found-{level}"))
        level += 1
        finer = tree(level).groupBy(*XYZ).agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_n"))
        finer = finer.select("*", *[F.floor(F.col(c) / 2).cast("long").alias(r) for c, r in zip(XYZ, roots, strict=True)])
        left = finer.select(*[F.col(r).alias(x) for r, x in zip(roots, a, strict=True)], *[F.col(c).alias(f"_new{x}") for c, x in zip(XYZ, a, strict=True)],
                            F.col("_n").alias("_na"))
        right = finer.select(*[F.col(r).alias(x) for r, x in zip(roots, b, strict=True)], *[F.col(c).alias(f"_new{x}") for c, x in zip(XYZ, b, strict=True)],
                             "_least", F.col("_n").alias("_nb"))
        split = crossing.where(~few).select(*a, *b, "_best").join(left, a).join(right, b)
        pairs = split.select(*[F.col(f"_new{x}").alias(x) for x in [*a, *b]], "_least", "_nb", "_best", "_na")
    own = tree(0).join(cells, XYZ).select("latitude", "longitude", F.col("_least").alias("_other"))
    for part in found:
        own = own.unionByName(part)
    best = own.groupBy("latitude", "longitude").agg(F.min("_other").alias("_best"))
    partner = F.when(F.col("_best") < F.col(id_col), F.col("_best"))
    return df.join(best, ["latitude", "longitude"], "left").select(*df.columns, partner.alias("colocated_with"))
