from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from airlake.functions import aqi, geo, numeric, status
from airlake.functions import text as tx
from airlake.functions import time as tm


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()[0]


@pytest.mark.parametrize(
    ("value", "name"),
    [(0.0, "good"), (30.0, "good"), (30.4, "good"), (30.6, "satisfactory"), (60.0, "satisfactory"),
     (91.0, "poor"), (250.0, "very_poor"), (251.0, "severe"), (900.0, "severe")],
)
def test_categories_at_band_edges(spark, value, name):
    assert one(spark, aqi.category(F.lit(value))) == name
    assert one(spark, aqi.indicative_category(F.lit(value))) == name


def test_half_way_rounds_up_in_tables_and_to_even_in_forecast_labels(spark):
    assert one(spark, aqi.category(F.lit(30.5))) == "satisfactory"
    assert one(spark, aqi.indicative_category(F.lit(30.5))) == "good"


def test_subindex_interpolates_and_is_open_at_the_top(spark):
    assert one(spark, aqi.subindex(F.lit(30.0))) == 50
    assert one(spark, aqi.subindex(F.lit(31.0))) == 51
    assert one(spark, aqi.subindex(F.lit(45.0))) == 75
    assert one(spark, aqi.subindex(F.lit(300.0))) is None


@pytest.mark.parametrize(
    ("at", "floor"),
    [("2026-01-01 10:29:59", "2026-01-01 09:30:00"), ("2026-01-01 10:30:00", "2026-01-01 10:30:00"),
     ("2026-01-01 00:10:00", "2025-12-31 23:30:00")],
)
def test_station_hours_start_at_half_past(spark, at, floor):
    assert str(one(spark, tm.half_hour_floor(tm.as_ts(at)).cast("string"))) == floor


def test_last_complete_hour(spark):
    assert one(spark, tm.last_complete_hour("2026-01-01 10:45:00").cast("string")) == "2026-01-01 09:30:00"


def test_clock_arguments_do_not_depend_on_the_python_time_zone(spark, monkeypatch):
    import time
    from datetime import datetime

    monkeypatch.setenv("TZ", "Asia/Kolkata")
    time.tzset()
    try:
        assert one(spark, tm.as_ts(datetime(2026, 1, 1, 5)).cast("string")) == "2026-01-01 05:00:00"
    finally:
        monkeypatch.undo()
        time.tzset()


def test_date_and_integer_clock(spark):
    assert one(spark, tm.date_hhmm_ts(F.lit("2026-01-02"), F.lit("635")).cast("string")) == "2026-01-02 06:35:00"


def test_complete_hours_only(spark):
    got = one(spark, tm.whole("HOUR", tm.as_ts("2026-01-01 00:59:00"), tm.as_ts("2026-01-01 02:00:00")))
    assert got == 1


def test_sectors_and_bands(spark):
    for bearing, name in ((0, "N"), (22.4, "N"), (22.5, "NE"), (180, "S"), (337.4, "NW"), (337.5, "N")):
        assert one(spark, geo.sector_name(geo.sector_index(F.lit(float(bearing))))) == name
    assert one(spark, geo.distance_band(F.lit(99.99))) == "0-100km"
    assert one(spark, geo.distance_band(F.lit(250.0))) == "250km+"
    km = one(spark, geo.haversine_km(28.6315, 77.2167, 28.7315, 77.2167))
    assert abs(km - 11.1195) < 1e-3
    assert one(spark, geo.bearing_deg(28.0, 77.0, 28.0, 78.0)) == pytest.approx(89.76, abs=0.01)


@pytest.mark.parametrize(
    ("name", "lat", "lon", "zone"),
    [("Sector 1, Noida", 28.6, 77.2, "noida"), ("Old GURGAON road", 28.0, 77.0, "gurugram"),
     ("Loni", 28.7, 77.3, "ghaziabad"), ("Centre", 28.6315, 77.2167, "delhi_central"),
     ("Up", 28.75, 77.2167, "delhi_north"), ("Down", 28.5, 77.2167, "delhi_south"),
     ("Right", 28.6315, 77.33, "delhi_east"), ("Left", 28.6315, 77.1, "delhi_west")],
)
def test_zones(spark, name, lat, lon, zone):
    assert one(spark, geo.assign_zone(F.lit(name), F.lit(lat), F.lit(lon))) == zone


def test_ages_and_times_in_words(spark):
    now = tm.as_ts("2026-01-05 12:00:00")
    for at, words in (
        ("2026-01-05 11:59:50", "1 min ago"), ("2026-01-05 11:20:00", "40 min ago"),
        ("2026-01-04 12:00:00", "24 h ago"), ("2026-01-02 12:00:00", "3 days ago"),
    ):
        assert one(spark, status.age_text(tm.as_ts(at), now)) == words
    assert one(spark, status.ist_text(tm.as_ts("2026-01-05 20:00:00"))) == "6 Jan, 01:30 IST"
    assert one(spark, status.hour_window_text(tm.as_ts("2026-09-30 09:30:00"))) == "30 Sep, 15:00–16:00 IST"


def test_station_messages(spark):
    now, old = tm.as_ts("2026-01-05 12:00:00"), tm.as_ts("2026-01-05 07:00:00")

    def say(state, feed="ok", at=old):
        return one(spark, status.station_message(F.lit(state), at, now, F.lit(feed)))

    assert say("live") is None
    assert say("no_data", at=F.lit(None).cast("timestamp")).startswith("No readings")
    assert say("delayed") == "Readings are delayed. Last reading: 5 Jan, 12:30 IST (5 h ago)."
    assert "isn't sending new readings" in say("delayed", feed="outage")
    assert "offline since" in say("offline")


@pytest.mark.parametrize(
    ("previous", "current", "speaks"),
    [(None, "outage", True), ("outage", "outage", False), (None, "ok", False), ("outage", "ok", True)],
)
def test_announcements(spark, previous, current, speaks):
    expr = status.change_message(
        F.lit(previous).cast("string"), F.lit(current), F.lit(0.9), F.lit(None).cast("timestamp")
    )
    assert (one(spark, expr) is not None) == speaks


def test_text_helpers(spark):
    assert one(spark, tx.agency_of(F.lit("Anand Vihar - DPCC "))) == "DPCC"
    assert one(spark, tx.agency_of(F.lit("Anand Vihar"))) is None
    assert one(spark, tx.unit_key(F.lit("co"), F.lit("µg/m³"))) == "co_ugm3"
    assert one(spark, tx.sensor_of(F.lit("VIIRS_SNPP_NRT"))) == "VIIRS_SNPP"
    assert one(spark, tx.product_of(F.lit("VIIRS_SNPP_SP"))) == "SP"
    assert one(spark, tx.product_of(F.lit("VIIRS_SNPP"))) is None
    assert one(spark, tx.redact(F.lit("key=supersecret"), ["supersecret", "key"])) == "key=***"


def test_means_do_not_depend_on_row_order(spark):
    rows = [(float(v) / 7,) for v in range(1, 2000)]
    a = spark.createDataFrame(rows, "v double").agg(numeric.fixed_avg("v")).first()[0]
    b = spark.createDataFrame(rows[::-1], "v double").repartition(5).agg(numeric.fixed_avg("v")).first()[0]
    assert a == b
    assert spark.createDataFrame([(None,)], "v double").agg(numeric.fixed_avg("v")).first()[0] is None
