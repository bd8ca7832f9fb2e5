from __future__ import annotations

import math
import random

import numpy as np
import pytest
from helpers import hour, plan_of
from pyspark.sql import functions as F

from airlake.config import CONFIG
from airlake.functions import aqi
from airlake.functions.time import as_ts
from airlake.operators import checks, dedupe, drift, incremental, reshape, spatial, timegrid, windows
from airlake.operators.bands import band_totals, join_bands
from airlake.operators.dedupe import asof_join
from airlake.operators.quantiles import median_of_large_groups
from airlake.plans import hourly


def test_latest_wins_prunes_before_the_shuffle(frame):
    df = frame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 5, "x")], "k int, t int, v string")
    out = dedupe.newest(df, ["k"], "t", F.col("v").desc())
    assert sorted(map(tuple, out.collect())) == [(1, 3, "c"), (2, 5, "x")]
    plan = plan_of(out)
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_first_last_seen_skips_null_values(frame):
    df = frame([(1, 1, 5.0), (1, 2, None)], "k int, t int, v double")
    assert tuple(dedupe.first_last_seen(df, ["k"], "t", "v").first()) == (1, 5.0, 1, 2)


def test_as_of_takes_the_newest_run_before_the_cut(frame):
    df = frame([("p", 1, 10.0), ("p", 2, 20.0), ("p", 3, 30.0)], "point string, issued int, v double")
    assert dedupe.as_of_runs(df, ["point"], "issued", F.lit(2)).first()["v"] == 20.0


def readings(frame, rows):
    return frame(rows, "location_id long, hour_start_utc timestamp, pm25 double, percent_complete double, is_out_of_range boolean")


def test_grid_is_complete_and_gaps_are_flagged_not_filled(frame):
    df = readings(frame, [(1, hour(0), 10.0, 90.0, False), (1, hour(3), 12.0, 20.0, False), (2, hour(2), 2000.0, 90.0, True)])
    grid = hourly.station_hourly(df, as_ts(hour(5.5))).orderBy("location_id", "hour_start_utc").collect()
    assert [(r.location_id, r.hour_start_utc.hour) for r in grid] == [(1, h) for h in range(5)] + [(2, h) for h in (2, 3, 4)]
    first = [r for r in grid if r.location_id == 1]
    assert [r.is_missing for r in first] == [False, True, True, False, True]
    assert first[3].is_low_coverage and first[3].pm25 is None and first[3].pm25_raw == 12.0
    assert [r for r in grid if r.location_id == 2][0].is_out_of_range


def test_spread_grid_equals_joined_grid(frame):
    rng = random.Random(5)
    rows = [(k, hour(h), float(h), 90.0, False) for k in range(5) for h in sorted(rng.sample(range(60), 20))]
    df = readings(frame, rows)
    a = timegrid.with_gaps(df, "location_id", "hour_start_utc", as_ts(hour(50.2)))
    grid = timegrid.hourly_grid(df, "location_id", "hour_start_utc", timegrid.last_complete_hour(as_ts(hour(50.2))))
    b = grid.join(df, ["location_id", "hour_start_utc"], "left")
    cols = ["location_id", "hour_start_utc", "pm25"]
    assert sorted(map(str, a.select(cols).collect())) == sorted(map(str, b.select(cols).collect()))


def test_flatline_needs_a_full_window(frame):
    values = [5.0] * 6 + [6.0] + [7.0] * 5
    df = readings(frame, [(1, hour(n), v, 90.0, False) for n, v in enumerate(values)])
    out = hourly.station_hourly(df, as_ts(hour(20))).orderBy("hour_start_utc").limit(12).collect()
    assert [r.is_flatline for r in out] == [False] * 5 + [True] + [False] * 6


def test_24h_mean_needs_16_valid_hours(frame):
    df = readings(frame, [(1, hour(n), 40.0 + n % 2, 90.0, False) for n in range(16)])
    stations = frame([(1, "z", "c", None)], "location_id long, zone_id string, city_id string, colocated_with long")
    rows = hourly.aqi_hourly(hourly.station_hourly(df, as_ts(hour(17.5))), stations)
    by_hour = [r.pm25_24h for r in rows.orderBy("hour_start_utc").collect()]
    assert by_hour[:15] == [None] * 15
    assert by_hour[15] == 40.5


def test_window_family_shares_one_exchange_and_one_sort(frame):
    df = frame([(1, hour(n), float(n)) for n in range(5)], "location_id long, hour_start_utc timestamp, pm25 double")
    k, h = "location_id", "hour_start_utc"
    out = df.select(
        k, h, *windows.lags("pm25", k, h, (1, 3, 6), "lag"), windows.rolling_mean("pm25", k, h, 6).alias("m"),
        windows.last_valid("pm25", k, h).alias("l"), F.max("pm25").over(windows.trailing(k, h, 24)).alias("x"),
    )
    plan = plan_of(out)
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_grid_windows_need_no_further_exchange(frame):
    df = readings(frame, [(1, hour(0), 10.0, 90.0, False)])
    plan = plan_of(hourly.station_hourly(df, as_ts(hour(30))))
    assert plan.count("Exchange hashpartitioning") == 1


def test_same_clock_mean_excludes_the_current_row(frame):
    df = frame([(1, hour(24 * d), float(d)) for d in range(10)], "location_id long, hour_start_utc timestamp, pm25 double")
    out = df.select("hour_start_utc", windows.same_clock_mean("pm25", "location_id", "hour_start_utc").alias("m"))
    got = [r.m for r in out.orderBy("hour_start_utc").collect()]
    assert got[0] is None and got[1] == 0.0 and got[9] == 5.0


@pytest.mark.parametrize("width", [0.5, 1.0, 50.0])
def test_binned_median_is_exact(spark, width):
    rng = random.Random(3)
    rows = [(g, round(rng.gauss(100, 40), 2)) for g in "abc" for _ in range(rng.randint(1, 400))] + [("d", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    want = {g: float(np.median([v for k, v in rows if k == g])) for g in "abc"}
    got = {r.g: r.median for r in median_of_large_groups(df, ["g"], "v", bin_width=width).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[g] - want[g]) < 1e-6 for g in want)


def haversine(a, b):
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 6371 * 2 * math.asin(math.sqrt(h)) * 1000


def test_colocated_marks_only_the_higher_id(frame):
    rows = [(9, -3.25, 11.5), (4, -3.25, 11.5), (6, -3.25, 11.5), (1, 40.0, -120.0), (2, None, 11.5), (3, -3.25, None)]
    df = frame(rows, "location_id long, latitude double, longitude double")
    got = {r.location_id: r.colocated_with for r in spatial.colocated_with(df).collect()}
    assert got == {9: 4, 4: None, 6: 4, 1: None, 2: None, 3: None}


@pytest.mark.parametrize(
    "lat0, lon0", [(0.0, 77.0), (28.6, 77.0), (61.0, -20.0), (-45.0, 179.998), (88.0, 10.0), (-89.9985, 120.0), (0.0, -180.001)]
)
def test_colocated_equals_brute_force(spark, lat0, lon0):
    rng = random.Random(int(lat0 * 10) + 1)
    wide = 0.006 / max(math.cos(math.radians(lat0)), 1e-3)
    around = lambda x: (x + 180) % 360 - 180
    spots = [(lat0 + rng.uniform(0, 0.004), around(lon0 + rng.uniform(0, wide))) for _ in range(150)]
    spots += [(lat0 + 0.001 + rng.uniform(0, 1e-5), around(lon0 + 0.001)) for _ in range(60)] + [spots[0]] * 20
    ids = list(range(len(spots)))
    rng.shuffle(ids)
    rows = [(i, a, b) for i, (a, b) in zip(ids, spots, strict=True)]
    df = spark.createDataFrame(rows, "location_id long, latitude double, longitude double")
    got = {r.location_id: r.colocated_with for r in spatial.colocated_with(df).collect()}
    for i, a, b in rows:
        near = [j for j, c, d in rows if j < i and haversine((a, b), (c, d)) < CONFIG.colocated_within_m]
        assert got[i] == (min(near) if near else None)


def test_nearest_is_a_top_k_without_a_join(frame):
    df = frame([(1, 28.0, 77.0), (2, 28.5, 77.2), (3, 28.6, 77.2)], "location_id long, latitude double, longitude double")
    out = spatial.nearest(df, 28.6, 77.2, 2)
    assert [r.location_id for r in out.collect()] == [3, 2]
    assert "TakeOrderedAndProject" in plan_of(out) and "Join" not in plan_of(out)


def test_drift_equals_numpy(spark):
    rng = np.random.default_rng(1)
    ref, cur = np.round(rng.gamma(2, 20, 1500), 2), np.round(rng.gamma(2, 25, 400), 2)
    long = lambda v, side: spark.createDataFrame([("x", float(n), side) for n in v], "feature string, value double, side string")
    d = drift.distances(long(ref, "reference"), long(cur, "current")).first()
    grid = np.unique(np.concatenate([ref, cur]))
    f = np.searchsorted(np.sort(ref), grid, "right") / len(ref)
    g = np.searchsorted(np.sort(cur), grid, "right") / len(cur)
    assert d.ks == pytest.approx(np.abs(f - g).max(), abs=1e-9)
    assert d.wasserstein == pytest.approx(np.sum(np.abs(f - g)[:-1] * np.diff(grid)), abs=1e-6)
    assert d.reference_std == pytest.approx(ref.std(), abs=1e-6)


def test_drift_direction_depends_on_the_method(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(0, 1, 500)
    long = lambda v, side: spark.createDataFrame([("x", float(n), side) for n in v], "feature string, value double, side string")
    verdict = lambda x, y, how: drift.verdicts(long(x, "reference"), long(y, "current"), how).first()
    same = verdict(a, rng.normal(0, 1, 500), "ks")
    moved = verdict(a, rng.normal(1, 1, 500), "ks")
    assert same.method == "K-S p_value" and not same.drifted and same.value == same.ks_p_value > 0.05
    assert moved.drifted and moved.value < 0.05
    for times in (1, 3):  # the number of rows changes nothing
        far = verdict(np.tile(a, times), a + 1, "wasserstein")
        assert far.method.startswith("Wasserstein") and far.drifted and far.value == far.wasserstein_normed
    with pytest.raises(ValueError, match="method"):
        verdict(a, a, "psi")


def test_spread_of_large_levels_does_not_cancel(spark):
    rows = [("p", 1e9 + i % 7, side) for i in range(2000) for side in ("reference", "current")]
    df = spark.createDataFrame(rows, "feature string, value double, side string")
    d = drift.distances(df.filter("side = 'reference'"), df.filter("side = 'current'")).first()
    assert d.reference_std == pytest.approx(np.std([i % 7 for i in range(2000)]), rel=1e-9)


def test_high_water_marks(frame):
    from datetime import datetime

    df = frame([(hour(0),), (hour(10),)], "fetched_at timestamp")
    assert incremental.since_day(None, "fetched_at", 14) == "0000"
    assert incremental.since_day(df, "fetched_at", 1) == "2025-12-31"
    assert incremental.since_hour(df, "fetched_at") == datetime(2026, 1, 1, 4, 30)
    assert incremental.since_hour(None, "fetched_at") is None


def test_todo_keeps_recent_chunks(frame):
    want = frame([("a", 1), ("a", 2), ("a", 9)], "k string, day int")
    have = frame([("a", 1), ("a", 9)], "k string, day int")
    out = incremental.todo(want, have, ["k", "day"], F.col("day") > 7)
    assert sorted(r.day for r in out.collect()) == [2, 9]


def test_days_to_do_are_counted_as_they_would_be_listed(spark):
    dice = random.Random(3)
    rows = [(k, f"2024-02-{dice.randint(1, 29):02}") for k in (1, 2, 3) for _ in range(9 * k)] + [(4, "2024-03-01"), (5, None), (6, "0001-01-01"), (6, "9999-12-31")]
    landed = spark.createDataFrame(rows, "k int, day string").select("k", F.col("day").cast("date").alias("day"))
    got = incremental.todo_days(landed, ["k"], "day", 7)
    few = landed.where("k < 6")
    want = timegrid.day_chunks(few.groupBy("k").agg(F.min("day").alias("a"), F.max("day").alias("z")), "a", "z")
    want = incremental.todo(want, few, ["k", "day"], F.date_diff("z", "day") < 7).groupBy("k").agg(F.count("*"), F.max("day"))
    far = (6, 3_652_058, landed.where("k = 6").agg(F.max("day")).first()[0])
    assert sorted(map(tuple, got.collect())) == sorted([*map(tuple, want.collect()), far])


def test_month_chunks_cover_a_leap_february(spark):
    from datetime import date

    rows = timegrid.months_between(spark, date(2024, 1, 15), date(2024, 3, 2)).collect()
    assert [tuple(map(str, r)) for r in rows] == [
        ("2024-01-15", "2024-01-31"), ("2024-02-01", "2024-02-29"), ("2024-03-01", "2024-03-02"),
    ]


def test_neighbours_wrap_around(frame):
    out = reshape.with_neighbours(frame([(0,)], "i int"), "i", "w").collect()
    assert sorted(r.w for r in out) == [0, 1, 7]


def test_offers_are_chosen_by_rank_inside_their_range(frame):
    want = frame([("s", 5), ("s", 50), ("s", 99)], "sensor string, day int")
    offers = frame(
        [("s", "SP", 0, 0, 10), ("s", "NRT", 1, 0, 60)], "sensor string, product string, pref int, min_date int, max_date int"
    )
    got = {r.day: r["product"] for r in reshape.prefer_available(want, offers, ["sensor"], "day", "pref").collect()}
    assert got == {5: "SP", 50: "NRT", 99: None}


def test_checks_return_offenders(frame):
    df = frame([(1, "a", 5.0), (1, "b", None), (2, "c", 99.0)], "k int, s string, v double")
    assert [r.k for r in checks.unique(df, ["k"]).collect()] == [1]
    assert checks.not_null(df, "v").count() == 1
    assert [r.s for r in checks.accepted_values(df, "s", ["a", "b"]).collect()] == ["c"]
    assert [r.v for r in checks.accepted_range(df, "v", 0, 50).collect()] == [99.0]
    assert checks.expression_holds(df, F.col("v") < 50).count() == 1
    assert [r.k for r in checks.orphans(df, frame([(1,)], "k int"), ["k"]).collect()] == [2]


def test_bands_of_any_size_equal_a_nested_loop(spark):
    rng = random.Random(2)
    for n, spread in ((0, 1), (1, 10), (300, 1e3), (300, 1e-3), (200, 1e9)):
        bands = []
        for b in range(n):
            lo = rng.uniform(-spread, spread)
            width = spread * 10 ** rng.uniform(-6, 0.2)
            bands.append((b, None if b % 41 == 7 else lo, None if b % 37 == 5 else lo + width if b % 29 else lo - width))
        values = [(k, rng.uniform(-2 * spread, 2 * spread)) for k in range(150)] + [(1000, None), (1001, float("nan")), (1002, 0.0)]
        values += [(2000 + b, x) for b, lo, hi in bands[:20] for x in (lo, hi)]
        table = spark.createDataFrame(bands, "band int, lo double, hi double")
        df = spark.createDataFrame(values, "k int, v double")
        got = sorted((r.k, -1 if r.band is None else r.band) for r in join_bands(df, F.col("v"), table, "lo", "hi").collect())
        want = []
        for k, v in values:
            known = v is not None and v == v
            met = [b for b, lo, hi in bands if known and (lo is None or lo <= v) and (hi is None or v <= hi) and (None in (lo, hi) or lo <= hi)]
            want += [(k, b) for b in met or [-1]]
        assert got == sorted(want)


def test_bands_join_on_cells_without_a_nested_loop(spark):
    bands = spark.range(5000).select(F.col("id").alias("band"), (F.col("id") * 2).alias("lo"), (F.col("id") * 2 + 1).alias("hi"))
    df = spark.range(20_000).select(F.col("id").alias("v"))
    plan = plan_of(join_bands(df, F.col("v"), bands, "lo", "hi"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "_cell" in plan
    assert join_bands(df, F.col("v"), bands, "lo", "hi", "inner").count() == 10_000


def test_totals_over_bands_equal_those_of_the_pairs(spark):
    dice = random.Random(5)
    nan = float("nan")
    end = lambda: None if dice.random() < 0.2 else float(dice.randint(-20, 20))
    bands = [(b, end(), end()) for b in range(200)] + [(900, nan, None), (901, 7.0, 7.0), (902, None, -99.0), (903, None, None)]
    values = [None, nan, -0.0, 0.0, 7.0, 7.0, -99.0, 1e9, *[dice.uniform(-25, 25) for _ in range(150)]]
    df = spark.createDataFrame(list(enumerate(values)), "k int, v double")
    totals = {"n": (F.count("band"), "sum"), "first": (F.min("band"), "min"), "total": (F.sum("band"), "sum")}

    def up_to(x, y):
        return None not in (x, y) and (y != y or x <= y)

    for some in (bands, []):
        table = spark.createDataFrame(some, "band int, lo double, hi double")
        got = band_totals(df, F.col("v"), table, "lo", "hi", totals).select("k", "n", "first", "total")
        want = []
        for k, v in enumerate(values):
            met = [b for b, lo, hi in some if (lo is None or up_to(lo, v)) and (hi is None or up_to(v, hi))]
            want.append((k, len(met), met[0], sum(met)) if met else (k, None, None, None))
        assert sorted(map(tuple, got.collect())) == want


def test_totals_over_bands_make_no_row_for_a_pair(spark):
    n = 60_000  # 1.8 thousand million pairs
    bands = spark.range(n).select(F.col("id").alias("band"), F.lit(None).cast("long").alias("lo"), F.col("id").alias("hi"))
    got = band_totals(spark.range(n), F.col("id"), bands, "lo", "hi", {"n": (F.count("band"), "sum")})
    assert got.where(F.col("n") == n - F.col("id")).count() == n


def test_edited_breakpoints_change_categories(spark):
    df = spark.createDataFrame([(1, 30.4), (2, 30.5), (3, 700.0), (4, None), (5, -3.0)], "id int, pm double")
    table = aqi.breakpoints(spark)
    both = aqi.with_bands(df, "pm", table, "c", "o", "s").select("*", aqi.category("pm").alias("c2"), aqi.category_order("pm").alias("o2"), aqi.subindex("pm").alias("s2"))
    assert both.where("NOT (c <=> c2 AND o <=> o2 AND s <=> s2)").count() == 0 and both.count() == 5
    moved = table.withColumn("pm25_high", F.when(F.col("category") == "good", 20).otherwise(F.col("pm25_high")))
    assert {r.id: r.c for r in aqi.with_bands(df, "pm", moved, "c").collect()} == {1: None, 2: "satisfactory", 3: "severe", 4: None, 5: None}


@pytest.mark.parametrize("bucket", [1800, 86_400])
def test_asof_join_equals_a_search_per_row(frame, bucket):
    rng = random.Random(1)
    runs = [(rng.choice(["busy", "busy", "busy", "calm", None]), hour(rng.randint(0, 300) / 3), rng.randint(0, 9), n) for n in range(400)]
    asks = [(n, rng.choice(["busy", "calm", "new", None]), None if n % 50 == 3 else hour(rng.randint(-10, 330) / 3)) for n in range(300)]
    asks += asks[:5]
    left = frame(asks, "id int, k string, at timestamp")
    right = frame(runs, "k string, issued timestamp, tie int, v int")
    got = asof_join(left, right, ["k"], "at", "issued", ["issued", "tie", "v"], ties=["tie", "v"], bucket=bucket)
    assert got.columns == ["id", "k", "at", "issued", "tie", "v"]
    want = []
    for n, k, at in asks:
        met = [(t, tie, v) for kk, t, tie, v in runs if k is not None and at is not None and kk == k and t <= at]
        want.append((n, k, at, *(max(met) if met else (None, None, None))))
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


def test_asof_join_spreads_a_busy_key(spark):
    """A run every second for ten days in one key: no window partition holds more than a bucket."""
    runs = spark.range(864_000).select(F.lit("k").alias("k"), F.timestamp_seconds("id").alias("issued"), F.col("id").alias("v"))
    asks = spark.range(1000).select(F.lit("k").alias("k"), F.timestamp_seconds(F.col("id") * 863 + 5).alias("at"))
    got = asof_join(asks, runs, ["k"], "at", "issued", ["v"], bucket=3600)
    assert got.where("v <> unix_seconds(at)").count() == 0 and got.count() == 1000
    assert "hashpartitioning(k" in plan_of(got) and "_bucket" in plan_of(got).split("hashpartitioning(k")[1][:40]


def distance(a, b):
    return haversine(a, b) / 1000


@pytest.mark.parametrize("lat0, lon0", [(28.6, 77.2), (-89.999, 0.0), (10.0, 179.999)])
def test_nearest_join_equals_brute_force(spark, lat0, lon0):
    rng = random.Random(7)
    around = lambda s: (max(-90.0, min(90.0, lat0 + rng.gauss(0, s))), (lon0 + rng.gauss(0, s) + 180) % 360 - 180)
    places = [(n, *around(rng.choice([1e-4, 1e-2, 3]))) for n in range(250)]
    places += [(1000 + n, *places[0][1:]) for n in range(30)] + [(2000, -lat0, lon0 - 170 if lon0 > 0 else 170.0), (2001, None, 3.0), (None, lat0, lon0)]
    asked = [(n, *around(rng.choice([1e-4, 1e-2, 20]))) for n in range(80)] + [(500, *places[0][1:]), (501, *places[0][1:]), (502, None, 1.0)]
    df = spark.createDataFrame(asked, "id int, latitude double, longitude double")
    sites = spark.createDataFrame(places, "place_id int, latitude double, longitude double")
    got = {}
    for r in spatial.nearest_join(df, sites, 4).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append((r.place_id, r.distance_km))
    assert set(got) == {a[0] for a in asked if a[1] is not None}
    for n, *at in asked:
        if at[0] is None:
            continue
        far = sorted((round(distance(at, p[1:]), 6), p[0]) for p in places if p[0] is not None and p[1] is not None)
        assert [d for _, d in got[n]] == pytest.approx([d for d, _ in far[:4]], abs=2e-6)
        if far[3][0] < far[4][0] - 1e-5:
            assert {p for p, _ in got[n]} == {p for _, p in far[:4]}


def test_nearest_join_with_few_places(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 60.0, 60.0)], "id int, latitude double, longitude double")
    sites = spark.createDataFrame([(7, -10.0, 175.0), (8, 1.0, 1.0)], "place_id int, latitude double, longitude double")
    got = spatial.nearest_join(df, sites, 5).orderBy("id", "rank").collect()
    assert [(r.id, r.place_id) for r in got] == [(1, 8), (1, 7), (2, 8), (2, 7)]
    assert spatial.nearest_join(df, sites.limit(0), 2).count() == 0


def crowds(spark, n):
    """Two dense crowds, 60 to 100 m apart, numbered in opposite order: the worst case for a smallest partner."""
    rng = random.Random(n)
    rows = []
    for k in range(n // 2):
        a, b = rng.uniform(0, 2e-4), rng.uniform(0, 2e-4)
        rows.append((n - k, 28.6 + a, 77.2 + b))
        rows.append((k + 1, 28.6 + 7e-4 + a / 2, 77.2 + b))
    return rows, spark.createDataFrame(rows, "location_id int, latitude double, longitude double")


def test_colocated_crowds_equal_brute_force_and_compare_little(spark, monkeypatch):
    rows, df = crowds(spark, 600)
    got = {r.location_id: r.colocated_with for r in spatial.colocated_with(df).collect()}
    for i, *at in rows:
        near = [j for j, *other in rows if j < i and haversine(at, other) < CONFIG.colocated_within_m]
        assert got[i] == min(near, default=None), i
    # pairs of cubes looked at, by size: no more than a little above proportion
    seen = {}
    for n in (4000, 16_000):
        counts = []
        keep = spatial.stored
        monkeypatch.setattr(spatial, "stored", lambda d, name, counts=counts: (r := keep(d, name), counts.append(r.count()))[0])
        spatial.colocated_with(crowds(spark, n)[1]).count()
        monkeypatch.undo()
        seen[n] = sum(counts)
    assert seen[16_000] < 8 * seen[4000] and seen[16_000] < 16_000**2 / 50, seen


def test_drift_from_stored_days_equals_drift_from_rows(spark, tmp_path):
    days = spark.range(4000).select(
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 20).cast("int")).alias("d"),
        F.round(F.randn(1) * 3, 1).alias("a"), (F.col("id") % 7).cast("string").alias("b"),
    )
    days = spark.createDataFrame(days.collect(), days.schema)
    path, names = str(tmp_path / "days"), ["a", "b"]
    drift.store_days(days.where("d < '2026-01-15'"), names, "d", path)
    drift.store_days(days.where("d = '2026-01-14'").unionByName(days.where("d = '2026-01-15'")), names, "d", path)  # one again, one new
    assert spark.read.parquet(path).select("day").distinct().count() == 15
    now = drift.long_form(days.where("d > '2026-01-15'"), names, "current")
    reference = drift.merge_days(spark.read.parquet(path), F.col("day") > "2026-01-03")
    got = drift.distances_of_counts(reference, drift.counted(now)).orderBy("feature").collect()
    past = drift.long_form(days.where("d > '2026-01-03' AND d <= '2026-01-15'"), names, "reference")
    assert got == drift.distances(past, now).orderBy("feature").collect() and len(got) == 2


def test_bins_by_bisection(spark):
    for n in (1, 2, 7, 40, 63, 64, 65, 100, 130):
        cuts = [float(x // 2) for x in range(n)]
        df = spark.range(-2, n).select(F.array(*map(F.lit, cuts)).alias("c"), (F.col("id") / 2).alias("v"))
        got = df.select("v", drift._bin_of(F.col("c"), F.col("v"), n + 1).alias("b")).collect()
        assert all(r.b == sum(c < r.v for c in cuts) for r in got)
