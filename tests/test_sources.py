from __future__ import annotations

import gzip
import json
from datetime import datetime

import pytest
from helpers import hour, plan_of
from pyspark.sql import functions as F

from airlake import schemas
from airlake.catalog import QUERIES, storage
from airlake.operators import incremental
from airlake.plans import staging
from airlake.sources import envelopes, files, snapshot, tables


def land(path, doc):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write(json.dumps(doc) + "\n")


def measurement(start, value, name="pm25"):
    return {
        "value": value,
        "parameter": {"id": 2, "name": name, "units": "µg/m³"},
        "period": {"datetimeFrom": {"utc": start}, "datetimeTo": {"utc": start.replace(":30:", ":31:")}},
        "coverage": {"observedCount": 4, "expectedCount": 4, "percentComplete": 100.0},
        "summary": {"min": 1.0, "max": 9.0},
        "flagInfo": {"hasFlags": False},
        "unknown": 1,
    }


def test_history_and_live_files_merge_with_the_newest_fetch(spark, tmp_path):
    a, b = "2026-01-01T00:30:00Z", "2026-01-01T01:30:00Z"
    land(tmp_path / "hist/month=2026-01/1.json.gz", {
        "fetched_at": "2026-01-02T00:00:00Z", "location_id": 7, "sensor_id": 1,
        "pages": [{"results": [measurement(a, 10.0), measurement(b, 20.0)]}]})
    land(tmp_path / "live/dt=2026-01-01/hour=06/f.json.gz", {
        "fetched_at": "2026-01-02T00:00:00Z", "stations": {"7": [{"results": [measurement(a, 11.0)]}]}})
    land(tmp_path / "live/dt=2026-01-02/hour=01/f.json.gz", {
        "fetched_at": "2026-01-02T01:00:00Z",
        "stations": {"7": [{"results": [measurement(b, 2000.0), measurement(b, 1.0, "pm10")]}]}})
    hist = envelopes.read_envelopes(spark, str(tmp_path / "hist"), schemas.PM25_HISTORY)
    live = envelopes.read_envelopes(spark, str(tmp_path / "live"), schemas.PM25_HOURLY)
    rows = staging.stage_pm25(hist, live).orderBy("hour_start_utc").collect()
    assert [(r.pm25, r.source, r.is_out_of_range) for r in rows] == [(10.0, "history", False), (2000.0, "hourly", True)]
    assert staging.stage_pm25(hist, live).filter("hour_start_utc = '2026-01-01 00:30:00'").count() == 1


def test_hour_predicate_prunes_partitions(spark, tmp_path):
    for dt, hh in (("2026-01-01", "23"), ("2026-01-02", "05"), ("2026-01-02", "06")):
        land(tmp_path / f"live/dt={dt}/hour={hh}/f.json.gz", {"fetched_at": "x", "stations": {}})
    since = incremental.hours_from(datetime(2026, 1, 2, 6))
    df = envelopes.read_envelopes(spark, str(tmp_path / "live"), schemas.PM25_HOURLY, since)
    assert [(r.dt, r.hour) for r in df.collect()] == [("2026-01-02", "06")]
    part = plan_of(df).split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "dt" in part and "hour" in part


def test_malformed_json_is_an_error(spark, tmp_path):
    (tmp_path / "dt=2026-01-01").mkdir()
    (tmp_path / "dt=2026-01-01/x.json").write_text('{"fetched_at": [broken\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        envelopes.read_envelopes(spark, str(tmp_path), schemas.WEATHER_ACTUALS).collect()


HEAD = "latitude,longitude,bright_ti4,scan,track,acq_date,acq_time,satellite,instrument,confidence,version,bright_ti5,frp,daynight"


def test_fire_files_of_14_and_15_columns(spark, tmp_path):
    day = tmp_path / "dt=2026-01-01"
    day.mkdir()
    (day / "VIIRS_SNPP_NRT.csv").write_text(
        HEAD + "\n28.1,77.1,1,1,1,2026-01-01,635,N,V,n,2,1,5.5,D\n" + HEAD + "\n28.1,77.1,1,1,1,2026-01-01,635,N,V,n,2,1,7.5,D\n"
    )
    (day / "VIIRS_NOAA20_SP.csv").write_text(HEAD + ",type\n28.2,77.2,1,1,1,2026-01-01,5,N,V, H,2,1,3.0,N,0\n")
    rows = staging.stage_fires(envelopes.read_fires(spark, str(tmp_path))).orderBy("sensor").collect()
    assert [(r.sensor, r["product"], r.frp_mw, r.confidence) for r in rows] == [
        ("VIIRS_NOAA20", "SP", 3.0, "h"), ("VIIRS_SNPP", "NRT", 7.5, "n"),
    ]
    assert [r.acquired_at_utc.strftime("%H:%M") for r in rows] == ["00:05", "06:35"]
    assert envelopes.read_fires(spark, str(tmp_path), since="2026-01-02").count() == 0


def test_bad_detections_are_quarantined(frame):
    df = frame([("n", "635"), ("x", "635"), ("h", "2475"), ("l", "abc")], "confidence string, acq_time string")
    good, bad = envelopes.split(df, envelopes.valid_detection())
    assert (good.count(), bad.count()) == (1, 3)


def test_mislabelled_forecasts_are_refused(frame):
    df = frame([("2026-01-01T10:40:00Z", "2026-01-01T10:00:00Z"), ("2026-01-01T15:00:00Z", "2026-01-01T10:00:00Z")],
               "fetched_at string, logical_hour string")
    assert df.filter(envelopes.on_time()).count() == 1


def test_dimensions_are_typed(spark, tmp_path):
    (tmp_path / "z.csv").write_text("zone_id,zone_name,city_id\nz1,Zone 1,c\n")
    assert tuple(envelopes.read_dim(spark, str(tmp_path / "z.csv"), "zones").first()) == ("z1", "Zone 1", "c")


def test_weather_forecast_lead_hours(spark, tmp_path):
    hourly = {"time": ["2026-01-01T10:00", "2026-01-01T12:00"], "temperature_2m": [1.0, 2.0], "precipitation": [0.0]}
    land(tmp_path / "dt=2026-01-01/hour=10/f.json.gz", {
        "forecast_issued_at": "2026-01-01T10:20:00Z", "points": [{"id": "z1"}],
        "responses": [[{"utc_offset_seconds": 0, "hourly": hourly}]]})
    raw = envelopes.read_envelopes(spark, str(tmp_path), schemas.WEATHER_FORECASTS)
    rows = staging.stage_weather_forecasts(raw).orderBy("valid_time_utc").collect()
    assert [(r.lead_hours, r.temperature_2m, r.precipitation) for r in rows] == [(0, 1.0, 0.0), (2, 2.0, None)]


# --- tables ---------------------------------------------------------------------------------------


def upsert(spark, path, rows, frame, extra=None):
    df = frame(rows, "k string, at timestamp, v int, fetched int")
    if extra:
        df = df.withColumn(extra, F.lit("new"))
    tables.upsert(spark, path, df, ["k", "at"], [F.col("fetched").desc()], "at")


def test_upsert_newest_wins_and_other_months_stay_untouched(spark, tmp_path, frame):
    path = str(tmp_path / "t")
    upsert(spark, path, [("a", hour(0), 1, 10), ("b", hour(24 * 40), 2, 10)], frame)
    february = {f: None for f in files.children(spark, f"{path}/month=2026-02")}
    upsert(spark, path, [("a", hour(0), 5, 20), ("c", hour(1), 6, 5)], frame, extra="note")
    upsert(spark, path, [("a", hour(0), 99, 1)], frame)
    got = {r.k: (r.v, r.note) for r in tables.read_table(spark, path).collect()}
    assert got == {"a": (5, "new"), "b": (2, None), "c": (6, "new")}
    assert {f: None for f in files.children(spark, f"{path}/month=2026-02")} == february


def test_upsert_twice_is_the_same_as_once(spark, tmp_path, frame):
    path = str(tmp_path / "t")
    for _ in range(2):
        upsert(spark, path, [("a", hour(0), 1, 10), ("b", hour(2), 2, 10)], frame)
    assert tables.read_table(spark, path).count() == 2


def test_compaction_keeps_rows_and_reduces_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).withColumn("month", F.lit("2026-01"))
    df.repartition(12).write.partitionBy("month").parquet(path)
    count = lambda: len([f for f in files.children(spark, f"{path}/month=2026-01") if f.endswith(".parquet")])
    assert count() == 12
    tables.compact(spark, path, ["2026-01"])
    assert count() < 4
    assert tables.read_table(spark, path).count() == 1000


def fragmented(spark, path):
    """One month with a large file and ten small ones."""
    df = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit("2026-01").alias("month"))
    df.where("id < 150000").coalesce(1).write.partitionBy("month").parquet(path)
    (large,) = files.sizes(spark, f"{path}/month=2026-01")
    df.where("id >= 150000").repartition(10).write.mode("append").partitionBy("month").parquet(path)
    return df, large


def test_compaction_packs_small_files_and_leaves_large_ones(spark, tmp_path):
    path = str(tmp_path / "t")
    df, large = fragmented(spark, path)
    before = files.sizes(spark, f"{path}/month=2026-01")
    small = [n for n in before if n != large]
    target = 4.5 * max(before[n] for n in small) / 2**20
    settings = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert tables.compact(spark, path, ["2026-01"], target) == 3  # bins of four, four and two
    after = files.sizes(spark, f"{path}/month=2026-01")
    assert large in after and len(after) == 4 and not set(small) & set(after)
    assert tables.read_table(spark, path).select("id", "text").exceptAll(df.select("id", "text")).count() == 0
    assert tables.read_table(spark, path).count() == 200_000
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == settings
    assert tables.compact(spark, path, ["2026-01", "2026-02"], target / 4) == 0


def test_a_broken_compaction_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    _, large = fragmented(spark, path)
    moved = []

    def one_only(session, source, goal):
        if moved:
            raise OSError("lost")
        moved.append(files.move(session, source, goal))

    monkeypatch.setattr(tables, "move", one_only)
    size = max(files.sizes(spark, f"{path}/month=2026-01").items(), key=lambda f: f[0] != large and f[1])[1]
    with pytest.raises(OSError, match="lost"):
        tables.compact(spark, path, ["2026-01"], 3.5 * size / 2**20)
    monkeypatch.undo()
    tables.compact(spark, path, [])
    rows = tables.read_table(spark, path)
    assert rows.count() == rows.select("id").distinct().count() == 200_000


def test_readers_move_to_a_rebuilt_table_in_one_step(spark, tmp_path):
    base = str(tmp_path / "gold")
    tables.rebuild_and_switch(spark, spark.range(3), base, "1")
    old = tables.read_current(spark, base)
    with pytest.raises(Exception, match="broken"):
        tables.rebuild_and_switch(spark, spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), base, "2")
    assert tables.read_current(spark, base).count() == 3
    tables.rebuild_and_switch(spark, spark.range(5), base, "3")
    assert (old.count(), tables.read_current(spark, base).count()) == (3, 5)


def test_streamed_envelopes_are_replayed_without_change(spark, tmp_path):
    from airlake.streaming import runs

    path, (table, bad, cp) = str(tmp_path / "in"), (str(tmp_path / n) for n in ("table", "bad", "cp"))
    doc = lambda k, v, at: json.dumps({"fetched_at": at, "items": [{"k": k, "v": v}, {"k": k + 1, "v": None}]})
    files_ = [[doc(1, 1.0, "2026-01-02T00:00:00Z"), "{oops"], [doc(1, 5.0, "2026-01-01T00:00:00Z"), doc(7, 2.0, "2026-01-03T00:00:00Z")]]
    schema = "fetched_at string, items array<struct<k: int, v: double>>"

    def run(checkpoint):
        stream = runs.read_json_files(spark, path, schema, files_per_batch=1)
        flatten = lambda d: d.select("fetched_at", F.inline("items"))
        stage = lambda d: d.withColumn("ts", F.to_timestamp(F.lit("2026-01-01 00:00:00")))
        runs.run_envelopes(spark, stream, table, bad, checkpoint, flatten, F.col("v").isNotNull(), stage, ["k", "ts"], [F.col("fetched_at").desc()], "ts")

    for n, lines in enumerate(files_):
        part = tmp_path / "in" / f"{n}.json"
        part.parent.mkdir(exist_ok=True)
        part.write_text("\n".join(lines) + "\n")
        run(cp)
    for checkpoint in (cp, str(tmp_path / "again")):  # nothing new, then all of it once more
        run(checkpoint)
        assert {r.k: r.v for r in tables.read_table(spark, table).collect()} == {1: 1.0, 7: 2.0}
        reasons = sorted(r.reason for r in spark.read.parquet(bad).collect())
        assert reasons == ["invalid"] * 3 + ["unreadable"]


def test_snapshot_reads_what_the_manifest_names(spark, tmp_path, frame):
    base = str(tmp_path / "public")
    df = frame([(1, hour(0))], "k int, at timestamp")
    for day in (1, 2, 3):
        snapshot.export_snapshot(spark, {"full": df, "empty": df.filter("k > 1")}, base, datetime(2026, 1, day))
    assert files.children(spark, f"{base}/full") == ["run=20260102T000000Z", "run=20260103T000000Z"]
    got = snapshot.read_snapshot(spark, base)
    assert got["full"].count() == 1 and got["empty"].count() == 0
    assert got["empty"].columns == ["k", "at"]


def test_a_failed_export_leaves_the_old_manifest(spark, tmp_path, frame):
    base = str(tmp_path / "public")
    df = frame([(1, hour(0))], "k int, at timestamp")
    snapshot.export_snapshot(spark, {"a": df}, base, datetime(2026, 1, 1))
    before = files.read_text(spark, f"{base}/manifest.json")
    broken = df.withColumn("k", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        snapshot.export_snapshot(spark, {"a": df, "b": broken}, base, datetime(2026, 1, 2))
    assert files.read_text(spark, f"{base}/manifest.json") == before
    assert snapshot.read_snapshot(spark, base)["a"].count() == 1


def test_documents_are_made_after_the_events_are_dealt(spark, monkeypatch):
    """The shuffle moves events, not the documents made of them, and writing by folder sorts no documents."""
    plans = {}

    def land(df, name, *parts):
        plans[name] = (df._jdf.queryExecution().optimizedPlan().toString(), parts)
        raise InterruptedError

    monkeypatch.setattr(storage, "_land", land)
    for name in ("staged_previous_runs", "stream_envelopes", "staged_latest", "staged_weather_forecasts", "since_day_mark"):
        with pytest.raises(InterruptedError):
            QUERIES[name](spark, "/root/testdata/sf0.001")
    assert len(plans) == 5
    for plan, parts in plans.values():
        made, dealt = plan.split("RebalancePartitions")
        assert "responses#" in made or "stations#" in made
        assert "responses#" not in dealt and "stations#" not in dealt
        assert "Sort [" + ", ".join(parts[:1]) in made
