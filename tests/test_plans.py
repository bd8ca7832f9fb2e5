from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from helpers import hour
from pyspark.sql import functions as F

from airlake.catalog.inputs import CFG, Inputs
from airlake.functions.time import as_ts
from airlake.operators import checks
from airlake.plans import evaluation as ev
from airlake.plans import features, fires, oplogs, serving, stations, status

BASE = "/root/testdata/sf0.001"


# --- fires ----------------------------------------------------------------------------------------


def detections(frame, rows):
    return frame(rows, "sensor string, product string, acq_date string, acquired_at_utc timestamp, latitude double, "
                       "longitude double, frp_mw double, confidence string, daynight string")  # fmt: skip


def test_archive_and_primary_sensor_are_preferred_per_day(frame):
    def row(sensor, product, day, confidence="n"):
        return (sensor, product, day, hour(0), 28.7, 77.2, 1.0, confidence, "D")

    df = detections(frame, [
        row("VIIRS_SNPP", "SP", "d1"), row("VIIRS_SNPP", "NRT", "d1"), row("VIIRS_NOAA20", "SP", "d1"),
        row("VIIRS_NOAA20", "NRT", "d2"), row("VIIRS_SNPP", "NRT", "d3", "l"), row("VIIRS_NOAA20", "SP", "d3"),
    ])
    got = sorted((r.acq_date, r.sensor, r["product"]) for r in fires.locate(df).collect())
    # On d3 the primary sensor saw something, though with low confidence: nothing is left.
    assert got == [("d1", "VIIRS_SNPP", "SP"), ("d2", "VIIRS_NOAA20", "NRT")]


def test_rolling_rows_are_usable_only_after_the_lag(frame):
    df = detections(frame, [("VIIRS_SNPP", "SP", "d", hour(0), 28.9, 77.2167, 2.5, "h", "D")])
    rows = fires.rolling(fires.locate(df), as_ts(hour(0))).filter("sector = 'N'").orderBy("as_of_utc").collect()
    first = rows[0]
    assert (first.n_24h, first.frp_24h) == (1, 2.5)
    assert first.as_of_utc - first.window_end_utc == timedelta(hours=3)
    assert len(rows) == 27
    assert [r.n_24h for r in rows] == [1] * 24 + [0] * 3


# --- station selection ----------------------------------------------------------------------------

LOCATIONS = (
    "location_id long, name string, provider string, is_monitor boolean, is_mobile boolean, latitude double, "
    "longitude double, first_utc timestamp, last_utc timestamp"
)


def located(frame, rows, sensors):
    s = F.array(*[F.struct(F.lit(i).cast("long").alias("id"), F.lit(p).alias("parameter"), F.lit(u).alias("units")) for i, p, u in sensors])
    return frame([(*r, hour(0), hour(240)) for r in rows], LOCATIONS).withColumn("sensors", s)


def test_reference_grade(frame):
    rows = [(1, "A - DPCC", "x", False, False, 28.0, 77.0), (2, "B", "PurpleAir", True, False, 28.0, 77.0),
            (3, "C", "x", True, False, 28.0, 77.0), (4, "D", "x", False, False, 28.0, 77.0), (5, "E", "x", True, True, 28.0, 77.0)]
    df = located(frame, rows, [(1, "pm25", "µg/m³")])
    assert sorted(r.location_id for r in df.filter(stations.is_reference_grade()).collect()) == [1, 3]


def test_selection_picks_live_sensors_and_splits_units(frame):
    sensors = [(10, "pm25", "µg/m³"), (11, "pm25", "µg/m³"), (12, "co", "µg/m³"), (13, "co", "ppb"), (14, "no2", "ppb")]
    df = located(frame, [(1, "Noida - UPPCB", "x", True, False, 28.0, 77.0), (2, "Far - CPCB", "x", True, False, 28.0, 77.00001)], sensors)
    latest = frame(
        [(k, s, hour(t)) for k in (1, 2) for s, t in ((10, 200), (11, 239), (12, 239), (13, 238), (14, 1))],
        "location_id long, sensor_id long, reading_utc timestamp",
    )
    got = {r.location_id: r for r in stations.select_stations(df, latest, as_ts(hour(250))).collect()}
    assert got[1].pm25_sensor_id == 11 and got[1].zone_id == "noida" and got[1].agency == "UPPCB"
    assert set(got[1].sensors) == {"pm25_ugm3", "co_ugm3", "co_ppb"}
    assert got[1].colocated_with is None and got[2].colocated_with == 1
    assert stations.select_stations(df, latest, as_ts(hour(2000))).count() == 0


# --- status ---------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("age", "state"), [(1, "live"), (3, "live"), (3.5, "delayed"), (7, "inactive"), (169, "offline"), (None, "no_data")]
)
def test_freshness_classes(frame, age, state):
    dims = frame([(1, "S", "z", "c")], "location_id long, station_name string, zone_id string, city_id string")
    at = [] if age is None else [(1, "pm25", hour(200 - age), 5.0, hour(200))]
    latest = frame(at or [(2, "pm25", hour(0), 1.0, hour(0))],
                   "location_id long, parameter string, reading_utc timestamp, value double, last_fetched_at timestamp")
    assert status.station_status(dims, latest, as_ts(hour(200))).first().status == state


def test_no_stations_is_an_outage(frame):
    empty = frame([(1, hour(0))], "location_id long, last_pm25_reading_utc timestamp").filter("location_id > 1")
    row = status.feed_report(empty, as_ts(hour(1))).first()
    assert (row.feed_status, row.share_not_live, row.newest_reading_utc) == ("outage", 1.0, None)


def test_health_needs_a_fresh_snapshot(frame):
    df = frame([(1, hour(10))], "location_id long, last_pm25_reading_utc timestamp")
    assert serving.health(df, as_ts(hour(9)), as_ts(hour(11))).first().status == "ok"
    assert serving.health(df, as_ts(hour(7)), as_ts(hour(11))).first().status == "degraded"


@pytest.mark.parametrize(("age", "live"), [(3 + 30 / 3600, 1), (3 + 60 / 3600, 0)])
def test_the_feed_counts_stations_by_whole_minutes_as_their_status_does(frame, age, live):
    df = frame([(1, hour(10))], "location_id long, last_pm25_reading_utc timestamp")
    assert status.feed_report(df, as_ts(hour(10 + age))).first().stations_live == live
    assert serving.health(df, as_ts(hour(10 + age)), as_ts(hour(10 + age))).first().stations_live == live


# --- features -------------------------------------------------------------------------------------


def aqi_frame(frame, pm25):
    rows = [(k, "z0", "c0", hour(n), pm25(k, n), 50.0, 20, False) for k in (1, 2) for n in range(24 * 9)]
    return frame(rows, "location_id long, zone_id string, city_id string, hour_start_utc timestamp, pm25 double, "
                       "pm25_24h double, valid_hours_24h long, is_colocated_duplicate boolean")  # fmt: skip


HISTORY = [f"pm25_lag{n}" for n in (0, 1, 3, 6, 12, 24, 48)] + [
    "pm25_mean_6h", "pm25_max_6h", "pm25_mean_24h", "pm25_max_24h", "pm25_same_hour_7d", "pm25_last_valid",
]


def context(spark, rows):
    cols = ["zone_pm25_median", "city_pm25_median", "city_pm25_24h_median", *[f"obs_{c}" for c in features.OBS], "cams_pm25_lagged"]
    fc = F.struct(*[F.lit(1.0).alias(f"fc_{c}") for c in features.FC])
    return rows.select("zone_id", "hour_start_utc").distinct().select(
        "*", *[F.lit(1.0).alias(c) for c in cols], *[fc.alias(f"_fc_{h}") for h in CFG.horizons],
        *[F.lit(2).alias(f"fires_upwind_{h}h") for h in (24, 48, 72)], F.lit(0.5).alias("fires_upwind_frp_24h"),
        *[F.lit(3).alias(f"fires_nw_arc_{h}h") for h in (24, 72)],
        *[F.col("hour_start_utc").alias(c) for c in ("audit_obs_weather_time", "audit_cams_time", "audit_fires_published_by")],
    )


def no_dates(spark):
    return spark.range(0).select(
        F.current_date().alias("date_ist"), F.lit(True).alias("is_festival"), F.lit(True).alias("is_weekend")
    )


def test_train_and_live_agree_on_gap_free_history(spark, frame):
    rows = aqi_frame(frame, lambda k, n: float((n * 7 + k) % 50))
    built = {m: features.build(m, rows, context(spark, rows), no_dates(spark)) for m in ("train", "live")}
    live = {(r.location_id, r.horizon_h): r for r in built["live"].collect()}
    assert len(live) == 6
    issue = next(iter(live.values())).issue_time_utc
    train = built["train"].filter(F.col("issue_time_utc") == F.lit(issue)).collect()
    if not train:  # the newest hour is not an issue hour; compare through a shifted copy
        shift = rows.withColumn("hour_start_utc", F.col("hour_start_utc") - F.expr(f"INTERVAL '{(issue.hour - 1) % 3}' HOUR"))
        live = {(r.location_id, r.horizon_h): r for r in features.build("live", shift, context(spark, shift), no_dates(spark)).collect()}
        issue = next(iter(live.values())).issue_time_utc
        train = features.build("train", shift, context(spark, shift), no_dates(spark)).filter(F.col("issue_time_utc") == F.lit(issue)).collect()
    assert len(train) == 6
    for r in train:
        for c in HISTORY:
            assert r[c] == live[(r.location_id, r.horizon_h)][c], c


def test_live_carries_over_gaps_and_says_so(spark, frame):
    rows = aqi_frame(frame, lambda k, n: None if n > 24 * 9 - 6 else 10.0 + k)
    got = features.build("live", rows, context(spark, rows), no_dates(spark)).filter("location_id = 1").first()
    assert got.pm25_lag0 == 11.0 and got.input_age_hours == 5 and got.is_stale_input
    assert got.target_pm25 is None and got.valid_hours_24h == 24


def test_leaks_are_found(spark, frame):
    rows = aqi_frame(frame, lambda k, n: 1.0 * n)
    good = features.build("train", rows, context(spark, rows), no_dates(spark))
    assert checks.leaks(good).count() == 0
    late = good.withColumn("audit_cams_time", F.col("issue_time_utc") + F.expr("INTERVAL 1 MINUTE"))
    assert checks.leaks(late).count() == good.count()
    moved = good.withColumn("target_hour_start_utc", F.col("issue_time_utc"))
    assert checks.leaks(moved).count() == good.count()


def test_target_is_the_value_of_the_target_hour(spark, frame):
    rows = aqi_frame(frame, lambda k, n: float(n))
    r = features.build("train", rows, context(spark, rows), no_dates(spark)).filter("horizon_h = 48").orderBy("issue_time_utc").first()
    assert r.target_pm25 == r.pm25_lag0 + 48
    assert r.weather_days_before == 3


def test_level_base_and_round_trip(frame):
    rows = [(0.0, 8.0), (None, 1.0), (37.5, None), (None, -2.0), (1e-9, 4.0)]
    df = frame(rows, "pm25_mean_24h double, pm25_last_valid double")
    assert [r[0] for r in df.select(features.level_base()).collect()] == [1.0, 1.0, 37.5, 1.0, 1.0]
    grid = frame([(y, b) for y in (0.0, 0.4, 7.25, 812.0) for b in (1.0, 3.5, 640.0)], "y double, b double")
    for mode in ("absolute", "log_ratio"):
        code = features.encode_target(F.col("y"), F.col("b"), mode)
        back = features.decode_target(code, F.col("b"), mode)
        assert grid.filter(F.abs(back - F.col("y")) > 1e-9 * (1 + F.col("y"))).count() == 0
    with pytest.raises(ValueError):
        features.decode_target(F.lit(1.0), F.lit(1.0), "ratio")


def test_models_see_no_target_audit_or_timing_columns(frame):
    seen = set(features.CATEGORICAL) | set(features.NUMERIC)
    assert not [c for c in seen if c.startswith("audit_") or c in ("target_pm25", "issue_time_utc", "target_hour_start_utc")]
    with pytest.raises(KeyError, match="pm25_lag0"):
        features.model_frame(frame([(1, "z")], "location_id long, zone_id string"))


# --- evaluation -----------------------------------------------------------------------------------


def test_errors_against_numpy_by_group(frame):
    rng = random.Random(11)
    rows = [(g, rng.uniform(0, 400), rng.uniform(0, 400)) for g in "abc" for _ in range(ord(g) - 90)] + [("d", 60.4, 59.6)]
    got = {r.g: r for r in ev.metrics(frame(rows, "g string, y_true double, y_pred double"), ["g"]).collect()}
    for g in "abcd":
        off = [p - y for k, y, p in rows if k == g]
        assert got[g].n == len(off)
        assert got[g].mae == pytest.approx(sum(map(abs, off)) / len(off), abs=1e-9)
        assert got[g].bias == pytest.approx(sum(off) / len(off), abs=1e-9)
        assert got[g].rmse == pytest.approx((sum(x * x for x in off) / len(off)) ** 0.5)
    assert got["d"].category_accuracy == 1.0  # both round to 60
    assert ev.metrics(frame(rows, "g string, y_true double, y_pred double").limit(0), ["g"]).count() == 0


def test_skill_is_the_share_of_error_removed(frame):
    df = frame([(3.0, 12.0), (12.0, 12.0), (15.0, 12.0)], "mae double, reference double")
    got = [r[0] for r in df.select(ev.skill(F.col("mae"), F.col("reference"))).collect()]
    assert got == pytest.approx([0.75, 0.0, -0.25])


def test_a_baseline_without_a_value_uses_the_last_reading(frame):
    rows = [(n, a, b) for n in (3.5, 0.0) for a in (None, 17.0) for b in (None, 0.25)]
    df = frame(rows, "pm25_last_valid double, pm25_same_hour_7d double, cams_pm25_lagged double")
    for r, (n, a, b) in zip(df.select(*[ev.baseline(x).alias(x) for x in ev.BASELINES]).collect(), rows, strict=True):
        assert (r.persistence, r.seasonal_naive, r.cams_lagged) == (n, n if a is None else a, n if b is None else b)


def issue_hours(frame, without=()):
    """Every five hours from mid-March to mid-December, three days ahead; whole months can be missing."""
    times = [datetime(2024, 3, 17, 0, 30) + timedelta(hours=5 * n) for n in range(272 * 24 // 5)]
    rows = [(t, t + timedelta(hours=72)) for t in times if t.month not in without]
    return frame(rows, "issue_time_utc timestamp, target_hour_start_utc timestamp")


def test_folds_are_calendar_months_after_purged_training(frame):
    df = issue_hours(frame)
    folds = ev.monthly_folds(df).orderBy("fold").collect()
    assert [f.fold for f in folds] == sorted({f.fold for f in folds}) and folds[-1].fold == "2024-12"
    assert "2024-10" not in [f.fold for f in ev.monthly_folds(issue_hours(frame, without=(10,))).collect()]
    for f in folds:
        train = ev.fold_train(df, f.test_start)
        newest = train.agg(F.max("target_hour_start_utc")).first()[0]
        assert newest + timedelta(hours=1) <= f.test_start
        assert train.count() == f.train_rows
        assert ev.fold_test(df, f.test_start, f.test_end).count() == f.test_rows


def test_holdout_is_never_before_the_production_cutoff(frame):
    df = issue_hours(frame)
    parts = {r.part: r for r in ev.holdout_split(df).groupBy("part").agg(
        F.min("issue_time_utc").alias("lo"), F.max("target_hour_start_utc").alias("hi")).collect()}
    assert parts["train"].hi + timedelta(hours=1) <= parts["holdout"].lo
    late = datetime(2024, 12, 9)
    lo = ev.holdout_split(df, not_before=late).filter("part = 'holdout'").agg(F.min("issue_time_utc")).first()[0]
    assert lo >= late


# --- logs -----------------------------------------------------------------------------------------


def test_requests_are_priced_by_tier_and_counted_by_area(spark):
    line = 'own store [17/Feb/2025:23:59:59 +0000] 10.0.0.9 who id {} {} "{}" 206 - 7 7 3 2 "-" "cli" -'
    listed = line.format("REST.GET.BUCKET", "-", "GET /?prefix=silver%2Fair%2Fdt=7%2F&max-keys=9 HTTP/1.1")
    put = line.format("REST.PUT.OBJECT", "silver/air/dt=7/part-1", "PUT /part-1 HTTP/1.1")
    got = line.format("REST.GET.OBJECT", "site/index", "GET /site/index HTTP/1.1")
    rows = [listed] * 3 + [put] * 2 + [got] * 5 + ["", "no log line"]
    totals, ops, areas = oplogs.report(oplogs.parse(spark.createDataFrame([(r,) for r in rows], "value string")))
    t = totals.first()
    assert (t.requests, t.tier1, t.tier2) == (10, 5, 5)
    assert t.cost_usd == pytest.approx((5 * 0.005 + 5 * 0.0004) / 1000)
    assert sorted(r[1] for r in ops.collect()) == [2, 3, 5]
    assert [(r.area, r.n) for r in areas.collect()] == [("silver/air/dt=7", 5)]


def test_nearest_serving_query_reads_the_overview(spark):
    i = Inputs(spark, BASE)
    rows = serving.nearest_stations(i.stations(), 28.6, 77.2, 3).collect()
    assert len(rows) == 3
    assert [r.distance_km for r in rows] == sorted(r.distance_km for r in rows)


def test_feature_tables_read_the_given_events_once(spark):
    """The feature plans scan the events many times: they scan the parsed table, in files of even size, not the given one."""
    i = Inputs(spark, BASE)
    plan = i.features("train")._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" not in plan  # of the given events
    assert "kept-events" in "".join(i.events().inputFiles())
    assert i.events().count() == i.table("events").count()
    again = [r for r in i.features("train").inputFiles() if "rolled-fires" in r]
    assert again and sorted(i.events().first().asDict()) == sorted(Inputs(spark, BASE).events().columns)
