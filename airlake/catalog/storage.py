"""Raw files, staging, incremental reads, upserts, compaction, snapshots: each writes below the shared
folder of the session and reads its own output back."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake import schemas
from airlake.catalog.conditions import user_status
from airlake.catalog.inputs import CFG, Inputs
from airlake.catalog.registry import query
from airlake.catalog.views import half, using
from airlake.functions.time import add, as_ts, half_hour_floor, hour_floor, iso_text, iso_ts, minute_ts
from airlake.operators import incremental
from airlake.plans import evaluation, fires, hourly, models, staging, status
from airlake.session import shared_path
from airlake.sources import envelopes, snapshot, tables
from airlake.sources.files import children, move, sizes
from airlake.streaming import runs

# --- raw envelopes built from the events ------------------------------------------------------------


# Documents are up to forty times the size of the event they are made of, so few bytes of events go to a task. One of them is
# made by more code than the JVM compiles as one method (8,000 bytes), so it is not generated as one.
_LANDING = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m", "spark.sql.codegen.hugeMethodLimit": "8000"}


def _dealt(i: Inputs, **parts: Column) -> DataFrame:
    """Events by the folders their documents go to, dealt and sorted while they are small.

    Documents are made after the shuffle, in the tasks that write them, however few splits the events are read in.
    """
    return i.events().withColumns(parts).hint("rebalance", *parts).sortWithinPartitions(*parts)


def _land(df: DataFrame, name: str, *parts: str) -> str:
    """Write one JSON document per line, gzip, partitioned; the documents come from :func:`_dealt` events."""
    conf, path = df.sparkSession.conf, shared_path(df.sparkSession, name)
    before = {k: conf.get(k) for k in _LANDING}
    try:
        for k, v in _LANDING.items():
            conf.set(k, v)
        df.write.partitionBy(*parts).option("compression", "gzip").json(path)
    finally:
        for k, v in before.items():
            conf.set(k, v)
    return path


def _measurement(value: Column) -> Column:
    start = half_hour_floor("ts")
    return F.struct(
        value.alias("value"),
        F.struct(
            F.lit(2).alias("id"), F.when(F.col("k") % 10 == 0, "pm10").otherwise("pm25").alias("name"),
            F.lit("µg/m³").alias("units"),
        ).alias("parameter"),
        F.struct(
            F.lit("1hour").alias("label"), F.lit("01:00:00").alias("interval"),
            F.struct(iso_text(start).alias("utc")).alias("datetimeFrom"),
            F.struct(iso_text(add(start, "HOUR", 1)).alias("utc")).alias("datetimeTo"),
        ).alias("period"),
        F.struct(
            F.lit(4).alias("expectedCount"), (F.col("k") % 5).cast("int").alias("observedCount"),
            (F.col("k") + 40.0).alias("percentComplete"), F.lit(100.0).alias("percentCoverage"),
        ).alias("coverage"),
        F.struct((value - 1).alias("min"), (value + 1).alias("max"), value.alias("avg"), F.lit(0.5).alias("sd")).alias("summary"),
        F.struct((F.col("k") % 7 == 0).alias("hasFlags")).alias("flagInfo"),
    )


def _pages(m: Column) -> Column:
    return F.array(F.struct(F.array(m).alias("results")))


def _day(ts: str = "ts") -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def _run_hour() -> Column:
    """The collector of these files runs every six hours."""
    return F.lpad((F.hour("ts") - F.hour("ts") % 6).cast("string"), 2, "0")


def _live_files(i: Inputs) -> str:
    docs = _dealt(i, dt=_day(), hour=_run_hour()).select(
        iso_text(hour_floor("ts")).alias("logical_hour"),
        iso_text("ts").alias("fetched_at"),
        F.create_map(F.col("location_id").cast("string"), _pages(_measurement(F.col("value")))).alias("stations"),
        "dt", "hour",
    )
    return _land(docs, "pm25_hours", "dt", "hour")


def _history_files(i: Inputs) -> str:
    docs = _dealt(i, month=F.date_format("ts", "yyyy-MM")).select(
        iso_text("ts").alias("fetched_at"), "location_id", F.col("user_id").alias("sensor_id"),
        F.when(F.col("event_id") % 2 == 0, _pages(_measurement(F.col("value") + 1)))
        .otherwise(_pages(_measurement(F.col("value"))).cast(_PAGES_TYPE)).alias("pages"),
        "month",
    )
    return _land(docs, "pm25_history", "month")


_PAGES_TYPE = f"array<struct<results: array<{schemas.MEASUREMENT}>>>"


@query("staged_pm25", using("ev", body=f"""
    SELECT location_id, hour_start_utc, hour_start_utc + INTERVAL 1 HOUR AS hour_end_utc, pm25,
           k % 5 AS observed_count, 4::BIGINT AS expected_count, k + 40::DOUBLE AS percent_complete,
           pm25 - 1 AS pm25_min, pm25 + 1 AS pm25_max, k % 7 = 0 AS has_openaq_flags,
           pm25 < 1 OR pm25 > 300 AS is_out_of_range, fetched_at, source
    FROM (
        SELECT loc AS location_id, {half('ts')} AS hour_start_utc, date_trunc('second', ts) AS fetched_at, k,
               value + CASE event_id % 2 WHEN 0 THEN 1 ELSE 0 END AS pm25, 'history' AS source FROM ev
        UNION ALL
        SELECT loc, {half('ts')}, date_trunc('second', ts), k, value, 'hourly' FROM ev)
    WHERE k % 10 <> 0
    QUALIFY row_number() OVER (PARTITION BY location_id, hour_start_utc
                               ORDER BY fetched_at DESC, source, pm25 DESC) = 1"""))
def _(i: Inputs):
    past = envelopes.read_envelopes(i.spark, _history_files(i), schemas.PM25_HISTORY)
    live = envelopes.read_envelopes(i.spark, _live_files(i), schemas.PM25_HOURLY)
    return staging.stage_pm25(past, live, CFG)


@query("incremental_hours", using("ev", body="""
    , t AS (SELECT max(date_trunc('second', ts)) FILTER (ts < (SELECT max(ts) - INTERVAL 2 DAY FROM ev)) AS newest FROM ev),
    m AS (SELECT newest - INTERVAL 6 HOUR AS mark FROM t)
    SELECT dt, hour, count(*) AS n FROM (
        SELECT strftime(ts, '%Y-%m-%d') AS dt, printf('%02d', hour(ts) // 6 * 6) AS hour FROM ev), m
    WHERE dt || hour >= strftime(mark, '%Y-%m-%d%H') GROUP BY ALL"""))
def _(i: Inputs):
    """Everything fetched since the mark of a table that stopped two days ago."""
    now = i.events().agg(F.max(F.col("ts").cast("timestamp_ntz"))).first()[0]
    loaded = i.events().select(F.date_trunc("second", "ts").alias("fetched_at"), "ts").filter(
        F.col("ts") < as_ts(now - timedelta(days=2))
    )
    mark = incremental.since_hour(loaded, "fetched_at", lookback_hours=6)
    files = envelopes.read_envelopes(i.spark, _live_files(i), schemas.PM25_HOURLY, incremental.hours_from(mark))
    return files.groupBy("dt", "hour").agg(F.count(F.lit(1)).alias("n"))


_LANDED = "SELECT strftime(ts, '%Y-%m-%d') AS dt, printf('%02d', hour(ts) // 6 * 6) AS hour FROM ev"


def _per_hour(files):
    return files.groupBy("dt", "hour").agg(F.count(F.lit(1)).alias("n"))


@query("clock_filter", using("ev", body=f"""
    SELECT dt, hour, count(*) AS n FROM ({_LANDED}), (SELECT max(ts) - INTERVAL 48 HOUR AS m FROM ev)
    WHERE dt || hour >= strftime(m, '%Y-%m-%d%H') GROUP BY ALL"""))
def _(i: Inputs):
    """Partitions of the last 48 hours by the clock, whatever was loaded before."""
    now = i.events().agg(F.max(F.col("ts").cast("timestamp_ntz"))).first()[0]
    recent = incremental.hours_before(now, 48)
    return _per_hour(envelopes.read_envelopes(i.spark, _live_files(i), schemas.PM25_HOURLY, recent))


@query("since_day_mark", using("ev", body=f"""
    SELECT dt, hour, count(*) AS n FROM ({_LANDED}), (SELECT max(ts) - INTERVAL 3 DAY AS m FROM ev)
    WHERE dt >= strftime(m, '%Y-%m-%d') GROUP BY ALL"""))
def _(i: Inputs):
    """Days from three before the newest loaded one on."""
    loaded = i.events().select(F.col("ts").alias("fetched_at"))
    days = F.col("dt") >= incremental.since_day(loaded, "fetched_at", 3)
    return _per_hour(envelopes.read_envelopes(i.spark, _live_files(i), schemas.PM25_HOURLY, days))


@query("staged_latest", using("ev", body="""
    SELECT location_id, user_id AS sensor_id, parameter, reading_utc, arg_max(value, (fetched_at, value)) AS value,
           min(fetched_at) AS first_fetched_at, max(fetched_at) AS last_fetched_at
    FROM (
        SELECT loc AS location_id, user_id, value, date_trunc('hour', ts) AS reading_utc,
               date_trunc('second', ts) AS fetched_at FROM ev)
    JOIN (SELECT DISTINCT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'pm10' ELSE 'pm25' END AS parameter
          FROM customer WHERE c_mktsegment <> 'MACHINERY') ON c_custkey = user_id
    GROUP BY ALL"""))
def _(i: Inputs):
    """Sensors are known through the customer table; sensors missing there are dead."""
    m = F.struct(
        F.struct(iso_text(hour_floor("ts")).alias("utc")).alias("datetime"), F.col("value").alias("value"),
        F.col("user_id").alias("sensorsId"), F.col("location_id").alias("locationsId"),
    )
    docs = _dealt(i, dt=_day(), hour=_run_hour()).select(
        iso_text("ts").alias("fetched_at"),
        F.create_map(F.col("location_id").cast("string"), _pages(m)).alias("stations"),
        "dt", "hour",
    )
    raw = envelopes.read_envelopes(i.spark, _land(docs, "latest", "dt", "hour"), schemas.LATEST)
    sensors = i.table("customer").filter("c_mktsegment <> 'MACHINERY'").select(
        F.col("c_custkey").alias("sensor_id"),
        F.when(F.col("c_custkey") % 3 == 0, "pm10").otherwise("pm25").alias("parameter"),
    )
    return staging.stage_latest(raw, sensors)


def _weather_docs(rows: DataFrame, variables, offset: Column | None = None, n_times: Column | None = None, **head: Column) -> DataFrame:
    """Per dealt event one envelope: its zone as a point, three hours of every variable (``n_times``: the first times only)."""
    times = F.array(*[F.date_format(add(hour_floor("ts"), "HOUR", n), "yyyy-MM-dd'T'HH:mm") for n in range(3)])
    # The last hour of every fifth event is not published yet.
    late = F.col("event_id") % 5 == 0

    def series(j: int) -> Column:
        return F.array(*[
            F.when(~late | F.lit(n < 2), F.round(F.col("value") + n + 10 * j, 2)) for n in range(3)
        ])

    if n_times is not None:
        times = F.slice(times, 1, n_times)
    hourly_part = F.struct(times.alias("time"), *[series(j).alias(v) for j, v in enumerate(variables)])
    response = F.struct(
        F.lit(28.6).alias("latitude"), F.lit(77.2).alias("longitude"), F.lit(200.0).alias("elevation"),
        (F.lit(0) if offset is None else offset).alias("utc_offset_seconds"), hourly_part.alias("hourly"),
    )
    point = F.struct(F.col("zone_id").alias("id"), F.lit(28.6).alias("latitude"), F.lit(77.2).alias("longitude"))
    parts = [c for c in ("dt", "hour") if c in rows.columns]
    return rows.select(
        iso_text("ts").alias("fetched_at"), F.array(point).alias("points"),
        F.array(F.array(response)).alias("responses"), *parts,
        *[c.alias(n) for n, c in head.items()],
    )


_WEATHER_ROWS = """
    SELECT zone AS point_id, date_trunc('second', ts) AS fetched_at, date_trunc('hour', ts) + to_hours(n) AS time_utc,
           CASE WHEN event_id % 5 <> 0 OR n < 2 THEN value + n END AS v
    FROM ev, range(3) AS r(n)"""


def _cols(names, start: int = 0) -> str:
    return ", ".join(f"round(v + {10 * (start + j)}, 2) AS {n}" for j, n in enumerate(names))


@query("staged_weather_forecasts", using("ev", body=f"""
    SELECT point_id, fetched_at AS issued_at, time_utc AS valid_time_utc,
           date_diff('hour', date_trunc('hour', fetched_at), time_utc) AS lead_hours,
           {_cols((*schemas.WEATHER, schemas.BOUNDARY))} FROM ({_WEATHER_ROWS})"""))
def _(i: Inputs):
    names = (*schemas.WEATHER, schemas.BOUNDARY)
    rows = _dealt(i, dt=_day(), hour=_run_hour())
    docs = _weather_docs(rows, names, forecast_issued_at=iso_text("ts"), logical_hour=iso_text(hour_floor("ts")))
    raw = envelopes.read_envelopes(i.spark, _land(docs, "forecasts", "dt", "hour"), schemas.WEATHER_FORECASTS)
    return staging.stage_weather_forecasts(raw)


@query("staged_cams_forecasts", using("ev", body=f"""
    SELECT point_id, fetched_at AS issued_at, time_utc AS valid_time_utc,
           date_diff('hour', date_trunc('hour', fetched_at), time_utc) AS lead_hours,
           round(v, 2) AS cams_pm25, round(v + 10, 2) AS cams_pm10 FROM ({_WEATHER_ROWS})"""))
def _(i: Inputs):
    docs = _weather_docs(_dealt(i, dt=_day(), hour=F.lit("00")), schemas.CAMS, forecast_issued_at=iso_text("ts"))
    raw = envelopes.read_envelopes(i.spark, _land(docs, "cams_forecasts", "dt", "hour"), schemas.CAMS_FORECASTS)
    return staging.stage_cams_forecasts(raw)


_NEWEST = "QUALIFY row_number() OVER (PARTITION BY point_id, time_utc ORDER BY fetched_at DESC, v DESC) = 1"


@query("staged_weather_actuals", using("ev", body=f"""
    SELECT point_id, time_utc, {_cols((*schemas.WEATHER, schemas.BOUNDARY))}, fetched_at
    FROM ({_WEATHER_ROWS}) WHERE v IS NOT NULL {_NEWEST}"""))
def _(i: Inputs):
    docs = _weather_docs(_dealt(i, dt=_day()), (*schemas.WEATHER, schemas.BOUNDARY))
    raw = envelopes.read_envelopes(i.spark, _land(docs, "actuals", "dt"), schemas.WEATHER_ACTUALS)
    return staging.stage_weather_actuals(raw)


@query("staged_cams_history", using("ev", body=f"""
    SELECT point_id, time_utc, round(v, 2) AS cams_pm25, round(v + 10, 2) AS cams_pm10, fetched_at
    FROM ({_WEATHER_ROWS}) WHERE v IS NOT NULL {_NEWEST}"""))
def _(i: Inputs):
    docs = _weather_docs(_dealt(i, dt=_day()), schemas.CAMS)
    raw = envelopes.read_envelopes(i.spark, _land(docs, "cams_history", "dt"), schemas.CAMS_HISTORY)
    return staging.stage_cams_history(raw)


@query("staged_previous_runs", using("ev", body=f"""
    SELECT point_id, time_utc, d AS days_before, {', '.join(
        f'round(v + 60 * (d - 1) + {10 * j}, 2) AS {n}' for j, n in enumerate(schemas.WEATHER))}, fetched_at
    FROM (SELECT * FROM ({_WEATHER_ROWS}) WHERE v IS NOT NULL {_NEWEST}), range(1, 5) AS r(d)"""))
def _(i: Inputs):
    docs = _weather_docs(_dealt(i, dt=_day()), [f"{v}_previous_day{n}" for n in schemas.RUN_DAYS for v in schemas.WEATHER])
    raw = envelopes.read_envelopes(i.spark, _land(docs, "previous_runs", "dt"), schemas.PREVIOUS_RUNS)
    return staging.stage_previous_runs(raw)


@query("staged_fires", using("ofire", body="""
    SELECT sensor, product, date_trunc('minute', acquired_at_utc) AS acquired_at_utc, acq_date, latitude, longitude,
           frp_mw, confidence, daynight
    FROM ofire
    QUALIFY row_number() OVER (PARTITION BY sensor, product, acquired_at_utc, latitude, longitude
                               ORDER BY frp_mw DESC, confidence, daynight) = 1"""), dates=("acq_date",))
def _(i: Inputs):
    """Detections as text columns (with a repeated header line per day), typed and deduplicated."""
    f = i.order_fires()
    text = f.select(
        F.col("latitude").cast("string").alias("latitude"), F.col("longitude").cast("string").alias("longitude"),
        F.date_format("acq_date", "yyyy-MM-dd").alias("acq_date"),
        F.concat(F.hour("acquired_at_utc"), F.lpad(F.minute("acquired_at_utc").cast("string"), 2, "0")).alias("acq_time"),
        F.concat(F.lit(" "), F.upper("confidence")).alias("confidence"),
        F.col("frp_mw").cast("string").alias("frp"), "daynight",
        F.concat_ws("_", "sensor", "product").alias("source"),
        F.date_format("acq_date", "yyyy-MM-dd").alias("dt"),
    )
    headers = text.select(*[
        F.concat(F.left("dt", F.lit(0)), F.lit(c)).alias(c) if c in ("latitude", "longitude", "acq_date", "acq_time", "confidence", "frp", "daynight") else F.col(c)
        for c in text.columns
    ])
    return staging.stage_fires(text.unionByName(headers))


@query("staged_predictions", using("preds", body="""
    SELECT location_id, zone_id, CAST(horizon_h AS BIGINT) AS horizon_h, issue_time_utc, target_hour_start_utc, pm25_pred,
           input_age_hours, is_stale_input, last_valid_hour_utc, model_version,
           (SELECT date_trunc('second', max(ts)) FROM events) AS predicted_at FROM preds"""))
def _(i: Inputs):
    """Predictions written as envelopes, written again (same issue hours replaced), and staged back."""
    path = shared_path(i.spark, "predictions")
    now = i.events().agg(F.max(F.col("ts").cast("timestamp_ntz"))).first()[0].replace(microsecond=0)
    rows = i.predictions()
    models.write_predictions(rows.withColumn("pm25_pred", F.col("pm25_pred") + 1), path, now - timedelta(hours=1))
    models.write_predictions(rows, path, now)
    return staging.stage_predictions(envelopes.read_envelopes(i.spark, path, schemas.PREDICTIONS))


# --- tables -----------------------------------------------------------------------------------------

def _upsert_order() -> list[Column]:
    return [F.col("fetched_at").desc(), F.col("event_id").desc()]


@query("incremental_upsert", using("ev", body=f"""
    , cut AS (SELECT max(ts) - INTERVAL 10 DAY AS t FROM ev)
    SELECT user_id, hour_start_utc, value, fetched_at, event_id, revision FROM (
        SELECT user_id, {half('ts')} AS hour_start_utc, value, ts AS fetched_at, event_id, NULL::BIGINT AS revision
        FROM ev, cut WHERE ts < t
        UNION ALL
        SELECT user_id, {half('ts')}, value + 0.5, ts + INTERVAL 1 DAY, event_id, 2 FROM ev, cut WHERE ts >= t - INTERVAL 3 DAY
        UNION ALL
        SELECT user_id, {half('ts')}, value - 9, ts - INTERVAL 1 DAY, event_id, 3 FROM ev, cut WHERE ts >= t - INTERVAL 5 DAY)
    QUALIFY row_number() OVER (PARTITION BY user_id, hour_start_utc ORDER BY fetched_at DESC, event_id DESC) = 1"""))
def _(i: Inputs):
    """Load, newer overlap with a new column, then a stale batch that must not win."""
    rows = i.events().select("user_id", half_hour_floor("ts").alias("hour_start_utc"), "value", "ts", "event_id")
    cut = add(i.as_of(), "DAY", -10)
    batches = [
        rows.filter(F.col("ts") < cut).withColumn("fetched_at", F.col("ts")),
        rows.filter(F.col("ts") >= add(cut, "DAY", -3)).withColumns(
            {"value": F.col("value") + 0.5, "fetched_at": add("ts", "DAY", 1), "revision": F.lit(2).cast("long")}
        ),
        rows.filter(F.col("ts") >= add(cut, "DAY", -5)).withColumns(
            {"value": F.col("value") - 9, "fetched_at": add("ts", "DAY", -1), "revision": F.lit(3).cast("long")}
        ),
    ]
    path = shared_path(i.spark, "readings")
    for batch in batches:
        tables.upsert(
            i.spark, path, batch.drop("ts"), ["user_id", "hour_start_utc"], _upsert_order(), "hour_start_utc"
        )
    out = tables.read_table(i.spark, path)
    return out.select("user_id", "hour_start_utc", "value", "fetched_at", "event_id", "revision")


@query("compaction", """
    SELECT o_orderkey, o_orderdate, o_totalprice, true AS large_kept FROM orders""")
def _(i: Inputs):
    """Months in many small files and one large one each: the small ones are packed, the large ones keep their names."""
    path = shared_path(i.spark, "fragmented")
    orders = tables.with_month(i.table("orders").select("o_orderkey", "o_orderdate", "o_totalprice"), "o_orderdate")
    large = orders.where("o_orderkey % 10 < 7").repartition("month")
    large.write.partitionBy("month").parquet(path)
    months = [c.split("=", 1)[1] for c in children(i.spark, path) if c.startswith("month=")]  # one name a month
    before = {m: set(sizes(i.spark, f"{path}/month={m}")) for m in months}
    target = min((n for m in months for n in sizes(i.spark, f"{path}/month={m}").values()), default=1) * 1.5 / 2**20
    orders.where("o_orderkey % 10 >= 7").repartition(4).write.mode("append").partitionBy("month").parquet(path)
    tables.compact(i.spark, path, months, target)
    after = {m: set(sizes(i.spark, f"{path}/month={m}")) for m in months}
    kept = all(before[m] <= after[m] for m in months)
    out = tables.read_table(i.spark, path)
    return out.select("o_orderkey", "o_orderdate", "o_totalprice", F.lit(kept).alias("large_kept"))


_BAD = "k % 13 = 0 OR (k % 11 = 0 AND event_id % 2 = 0)"


@query("stream_envelopes", using("ev", body=f"""
    SELECT point_id, time_utc, {_cols((*schemas.WEATHER, schemas.BOUNDARY))}, fetched_at,
           1 + (SELECT count(*) FROM ev WHERE {_BAD}) AS n_quarantined
    FROM (
        SELECT zone AS point_id, date_trunc('second', ts) AS fetched_at, date_trunc('hour', ts) + to_hours(n) AS time_utc,
               CASE WHEN event_id % 5 <> 0 OR n < 2 THEN value + n END AS v
        FROM ev, range(3) AS r(n) WHERE NOT ({_BAD}))
    WHERE v IS NOT NULL {_NEWEST}"""))
def _(i: Inputs):
    """Envelopes as they land, in micro-batches: wrong offsets, arrays of unequal length and a broken line are set aside."""
    names = (*schemas.WEATHER, schemas.BOUNDARY)
    offset = F.when(F.col("k") % 13 == 0, F.lit(19800)).otherwise(F.lit(0))
    short = (F.col("k") % 11 == 0) & (F.col("event_id") % 2 == 0)
    n_times = F.when(F.col("k") % 13 == 0, F.lit(3)).when(short, F.lit(2)).otherwise(F.lit(3))
    docs = _weather_docs(_dealt(i, dt=_day()), names, offset, n_times)
    path = _land(docs, "weather_stream", "dt")
    i.spark.createDataFrame([('{"fetched_at": "2024-',)], "value string").write.text(f"{path}/dt=0000-00-00")

    def stage(good: DataFrame) -> DataFrame:
        rows = envelopes.hourly_rows(good, names, "point_id", "fetched_at")
        known = rows.where(F.coalesce(*[F.col(c) for c in names]).isNotNull())
        return known.select("point_id", minute_ts("time").alias("time_utc"), *names, iso_ts("fetched_at").alias("fetched_at"))

    table, bad, checkpoint = (shared_path(i.spark, n) for n in ("weather", "weather-bad", "weather-checkpoint"))
    stream = runs.read_json_files(i.spark, path, schemas.WEATHER_ACTUALS, files_per_batch=8)
    runs.run_envelopes(
        i.spark, stream, table, bad, checkpoint, lambda d: envelopes.point_responses(d, "fetched_at"),
        envelopes.valid_response(names), stage, ["point_id", "time_utc"],
        [F.col("fetched_at").desc(), F.col(names[0]).desc()], "time_utc",
    )
    count = i.spark.read.parquet(bad).agg(F.count(F.lit(1)).alias("n_quarantined"))
    return tables.read_table(i.spark, table).drop("month").crossJoin(F.broadcast(count))


@query("fires_csv", using("ofire", body="""
    SELECT sensor || '_' || product AS source, year(acq_date) || '-01-01' AS dt, latitude::VARCHAR AS latitude,
           hour(acquired_at_utc)::VARCHAR || printf('%02d', minute(acquired_at_utc)) AS acq_time, daynight,
           order_id % 17 <> 0 AS is_valid
    FROM ofire WHERE acq_date >= DATE '1994-01-01'"""))
def _(i: Inputs):
    """Detection files, one a source and year: every column text, the source from the file name, wrong rows told apart."""
    path, staging = shared_path(i.spark, "fires-csv"), shared_path(i.spark, "fires-staging")
    names = [c.strip().split()[0] for c in schemas.FIRES_CSV.split(",")]
    known = {
        "latitude": F.col("latitude").cast("string"), "longitude": F.col("longitude").cast("string"),
        "acq_date": F.date_format("acq_date", "yyyy-MM-dd"), "daynight": F.col("daynight"),
        "acq_time": F.concat(F.hour("acquired_at_utc"), F.lpad(F.minute("acquired_at_utc").cast("string"), 2, "0")),
        "confidence": F.when(F.col("order_id") % 17 == 0, "?").otherwise(F.col("confidence")), "frp": F.col("frp_mw").cast("string"),
    }
    text = i.order_fires().select(
        *[known.get(c, F.lit("x")).alias(c) for c in names],
        F.concat(F.year("acq_date"), F.lit("-01-01")).alias("dt"), F.concat_ws("_", "sensor", "product").alias("source"),
    )
    text.repartition("dt", "source").write.option("header", True).partitionBy("dt", "source").csv(staging)
    for dt in [c for c in children(i.spark, staging) if c.startswith("dt=")]:  # a file a source and year, renamed as it would come
        for source in children(i.spark, f"{staging}/{dt}"):
            (name,) = sizes(i.spark, f"{staging}/{dt}/{source}")
            move(i.spark, f"{staging}/{dt}/{source}/{name}", f"{path}/{dt}/{source.split('=')[1]}.csv")
    raw = envelopes.read_fires(i.spark, path, "1994-01-01")
    return raw.select("source", "dt", "latitude", "acq_time", "daynight", F.coalesce(envelopes.valid_detection(), F.lit(False)).alias("is_valid"))


@query("dimension_csv", """
    SELECT s_suppkey AS location_id, s_name AS station_name FROM supplier""")
def _(i: Inputs):
    """A dimension kept as a CSV seed, read with its own types."""
    path = shared_path(i.spark, "dim-csv")
    kinds = [c.strip().split(None, 1) for c in schemas.DIMENSIONS["stations"].split(",")]
    known = {"location_id": F.col("s_suppkey"), "station_name": F.col("s_name")}
    seed = i.table("supplier").select(*[known.get(c, F.lit(None)).cast(k).alias(c) for c, k in kinds])
    seed.write.option("header", True).csv(path)
    return envelopes.read_dim(i.spark, path, "stations").select("location_id", "station_name")


@query("rebuild_switch", """
    SELECT o_orderkey, o_totalprice + 1 AS o_totalprice FROM orders""")
def _(i: Inputs):
    """A table rebuilt: readers of the old version keep it, new ones get the new one."""
    base = shared_path(i.spark, "rebuilt")
    rows = i.table("orders").select("o_orderkey", "o_totalprice")
    tables.rebuild_and_switch(i.spark, rows, base, "1")
    tables.rebuild_and_switch(i.spark, rows.withColumn("o_totalprice", F.col("o_totalprice") + 1), base, "2")
    return tables.read_current(i.spark, base)


@query("forecast_on_time", using("ev", body="""
    SELECT event_id, abs(date_diff('second', date_trunc('hour', ts) - to_hours(k % 5), date_trunc('second', ts))) <= 7200 AS on_time FROM ev"""))
def _(i: Inputs):
    """Forecasts labelled with an hour more than two hours from when they were fetched are refused."""
    rows = i.events().select(
        "event_id", iso_text("ts").alias("fetched_at"),
        iso_text(F.timestamp_seconds(F.unix_seconds(hour_floor("ts")) - F.col("k") % 5 * 3600)).alias("logical_hour"),
    )
    return rows.select("event_id", envelopes.on_time().alias("on_time"))


@query("snapshot_export", using("aqi", "zone_hourly", "city_hourly", "edaily", "fcst", "facc", "ustatus", "ufeed", "stations", "zones", body="""
    SELECT 'dim_station' AS dataset, count(*) AS n FROM stations
    UNION ALL SELECT 'dim_zone', count(*) FROM zones
    UNION ALL SELECT 'dim_city', count(*) FROM region
    UNION ALL SELECT 'station_status', count(*) FROM ustatus
    UNION ALL SELECT 'feed_status', count(*) FROM ufeed WHERE hour_start_utc >= (SELECT max(ts) - INTERVAL 30 DAY FROM events)
    UNION ALL SELECT 'aqi_hourly_recent', count(*) FROM aqi WHERE hour_start_utc >=
        (SELECT max(hour_start_utc) - INTERVAL 30 DAY FROM aqi WHERE pm25 IS NOT NULL)
    UNION ALL SELECT 'zone_hourly_recent', count(*) FROM zone_hourly WHERE hour_start_utc >=
        (SELECT max(hour_start_utc) - INTERVAL 30 DAY FROM zone_hourly WHERE pm25_median IS NOT NULL)
    UNION ALL SELECT 'city_hourly_recent', count(*) FROM city_hourly WHERE hour_start_utc >=
        (SELECT max(hour_start_utc) - INTERVAL 30 DAY FROM city_hourly WHERE pm25_median IS NOT NULL)
    UNION ALL SELECT 'city_daily', count(DISTINCT CAST(hour_start_utc + INTERVAL 330 MINUTE AS DATE)) FROM aqi WHERE NOT is_colocated_duplicate
    UNION ALL SELECT 'forecasts_latest', count(*) FROM fcst WHERE issue_time_utc = (SELECT max(issue_time_utc) FROM fcst)
    UNION ALL SELECT 'forecast_accuracy_recent', count(*) FROM facc WHERE target_hour_start_utc >= (SELECT max(ts) - INTERVAL 30 DAY FROM events)
    UNION ALL SELECT 'fires_daily', count(*) FROM edaily WHERE acq_date >= (SELECT CAST(max(ts) AS DATE) - 120 FROM events)"""))
def _(i: Inputs):
    """All twelve datasets published and read back through the manifest."""
    counts = None
    for name, df in _published(i).items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("dataset"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def _published(i: Inputs) -> dict[str, DataFrame]:
    base = shared_path(i.spark, "gold")
    aqi_rows = i.gold_aqi()
    forecasts = i.spark.read.parquet(
        tables.rebuild(evaluation.forecasts(i.predictions(), i.stations(), CFG), f"{base}/forecasts", "1")
    )
    daily = fires.daily(fires.locate(i.event_fires(), CFG))
    gold = {
        "dim_station": i.stations(),
        "dim_zone": i.zones(),
        "dim_city": i.table("region").select(F.col("r_regionkey").alias("city_id"), F.col("r_name").alias("city_name")),
        "station_status": user_status(i),
        "feed_status": status.feed_status(i.grid("user_id"), CFG),
        "aqi_hourly": aqi_rows,
        "zone_hourly": hourly.area_hourly(aqi_rows, "zone_id"),
        "city_hourly": hourly.area_hourly(aqi_rows, "city_id"),
        "city_daily": hourly.city_daily(aqi_rows, daily, i.dates(), CFG),
        "forecasts": forecasts,
        "forecast_accuracy": evaluation.forecast_accuracy(forecasts, aqi_rows, CFG),
        "fires_daily": daily,
    }
    now = i.events().agg(F.max(F.col("ts").cast("timestamp_ntz"))).first()[0]
    public = shared_path(i.spark, "public")
    snapshot.export_snapshot(i.spark, snapshot.export_filters(gold, i.as_of()), public, now)
    return snapshot.read_snapshot(i.spark, public)


def _cells(dataset: str, key: str, ts: str, value: str, source: str) -> str:
    return f"SELECT '{dataset}' AS dataset, CAST({key} AS VARCHAR) AS key, CAST({ts} AS TIMESTAMP) AS ts, CAST({value} AS DOUBLE) AS value FROM {source}"


_RECENT = "WHERE hour_start_utc >= (SELECT max(hour_start_utc) - INTERVAL 30 DAY FROM {0} WHERE {1} IS NOT NULL)"


@query("snapshot_values", using("aqi", "zone_hourly", "city_hourly", "edaily", "fcst", "facc", "stations", "zones", body=" UNION ALL ".join([
    _cells("aqi_hourly_recent", "location_id", "hour_start_utc", "pm25", "aqi " + _RECENT.format("aqi", "pm25")),
    _cells("zone_hourly_recent", "zone_id", "hour_start_utc", "pm25_median", "zone_hourly " + _RECENT.format("zone_hourly", "pm25_median")),
    _cells("city_hourly_recent", "city_id", "hour_start_utc", "pm25_median", "city_hourly " + _RECENT.format("city_hourly", "pm25_median")),
    _cells("forecasts_latest", "location_id || ' ' || horizon_h", "target_hour_start_utc", "pm25_pred",
           "fcst WHERE issue_time_utc = (SELECT max(issue_time_utc) FROM fcst)"),
    _cells("forecast_accuracy_recent", "location_id || ' ' || horizon_h", "target_hour_start_utc", "round(abs_error, 6)",
           "facc WHERE target_hour_start_utc >= (SELECT max(ts) - INTERVAL 30 DAY FROM events)"),
    _cells("fires_daily", "sector || ' ' || distance_band", "acq_date", "fire_count",
           "edaily WHERE acq_date >= (SELECT CAST(max(ts) AS DATE) - 120 FROM events)"),
    _cells("dim_station", "location_id", "NULL", "latitude", "stations"),
    _cells("dim_zone", "zone_id", "NULL", "NULL", "zones"),
])))
def _(i: Inputs):
    """Keys, times and values of the published datasets, row by row."""
    got = _published(i)
    pick = {
        "aqi_hourly_recent": ("location_id", "hour_start_utc", "pm25"),
        "zone_hourly_recent": ("zone_id", "hour_start_utc", "pm25_median"),
        "city_hourly_recent": ("city_id", "hour_start_utc", "pm25_median"),
        "forecasts_latest": ("concat_ws(' ', location_id, horizon_h)", "target_hour_start_utc", "pm25_pred"),
        "forecast_accuracy_recent": ("concat_ws(' ', location_id, horizon_h)", "target_hour_start_utc", "round(abs_error, 6)"),
        "fires_daily": ("concat_ws(' ', sector, distance_band)", "acq_date", "fire_count"),
        "dim_station": ("location_id", "NULL", "latitude"),
        "dim_zone": ("zone_id", "NULL", "NULL"),
    }
    out = None
    for name, (key, ts, value) in pick.items():
        one = got[name].selectExpr(
            f"'{name}' AS dataset", f"CAST({key} AS STRING) AS key", f"CAST({ts} AS TIMESTAMP) AS ts", f"CAST({value} AS DOUBLE) AS value"
        )
        out = one if out is None else out.unionByName(one)
    return out
