"""Streaming queries over the events file source, run to completion, and their batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.catalog.inputs import CFG, Inputs
from airlake.catalog.registry import query
from airlake.catalog.views import half, micro, using
from airlake.functions.time import half_hour_floor
from airlake.session import shared_path
from airlake.sources.tables import read_table
from airlake.streaming import alerts, runs, windows


def _stream(i: Inputs) -> DataFrame:
    path = f"{i.base}/events.parquet"
    s = runs.read_files(i.spark, path, i.spark.read.parquet(path).schema)
    return s.withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "k", F.get_json_object("props", "$.k").cast("long")
    )


def _shuffled_days(i: Inputs, files: int = 3) -> DataFrame:
    """The events in three files, each with days from all over the range: a stream of three micro-batches out of order."""
    path = shared_path(i.spark, "shuffled-days")
    rows = i.spark.read.parquet(f"{i.base}/events.parquet")
    part = F.pmod(F.xxhash64(F.to_date("ts")), F.lit(files))
    rows.repartition(files, part).write.parquet(path)
    return runs.read_files(i.spark, f"{path}/", rows.schema, files_per_batch=1).withColumn("ts", F.col("ts").cast("timestamp"))


def _paths(i: Inputs, name: str) -> tuple[str, str]:
    return shared_path(i.spark, name), shared_path(i.spark, f"{name}-checkpoint")


@query("stream_hourly_window", f"""
    SELECT event_type, date_trunc('hour', ts) AS hour_utc, count(*) AS n,
           CAST(sum({micro('value')}) AS DOUBLE) / 1000000 AS total FROM events GROUP BY ALL""")
def _(i: Inputs):
    table, checkpoint = _paths(i, "hourly-window")
    runs.run_hours(i.spark, _shuffled_days(i), table, checkpoint, ["event_type"], "ts", "value")
    return read_table(i.spark, table).select("event_type", "hour_utc", "n", F.col("total").cast("double").alias("total"))


@query("stream_sliding_24h", f"""
    WITH h AS (
        SELECT event_type, date_trunc('hour', ts) AS hour_utc, count(*) AS n, sum({micro('value')}) AS m
        FROM events GROUP BY ALL)
    SELECT event_type, hour_utc - to_hours(b) AS window_start_utc, hour_utc - to_hours(b) + INTERVAL 24 HOUR AS window_end_utc,
           sum(n)::BIGINT AS n, CAST(sum(m) AS DOUBLE) / 1000000 AS total
    FROM h, range(24) AS r(b) GROUP BY ALL""")
def _(i: Inputs):
    table, checkpoint = _paths(i, "sliding")
    hours = shared_path(i.spark, "sliding-hours")
    runs.run_sliding(i.spark, _shuffled_days(i), hours, table, checkpoint, ["event_type"], "ts", "value", 24)
    return read_table(i.spark, table).select("event_type", "window_start_utc", "window_end_utc", "n", "total")


@query("stream_upsert", using("ev", body=f"""
    SELECT user_id, hour_start_utc, value, event_id FROM (SELECT *, {half('ts')} AS hour_start_utc FROM ev)
    QUALIFY row_number() OVER (PARTITION BY user_id, hour_start_utc ORDER BY ts DESC, event_id DESC) = 1"""))
def _(i: Inputs):
    table, checkpoint = _paths(i, "stream-upsert")
    rows = _stream(i).select("user_id", half_hour_floor("ts").alias("hour_start_utc"), "value", "ts", "event_id")
    runs.run_upsert(
        i.spark, rows, table, checkpoint, ["user_id", "hour_start_utc"],
        [F.col("ts").desc(), F.col("event_id").desc()], "hour_start_utc",
    )
    return read_table(i.spark, table).select("user_id", "hour_start_utc", "value", "event_id")


@query("stream_dedupe", using("ev", body=f"""
    SELECT DISTINCT user_id, event_type, {half('ts')} AS hour_start_utc FROM ev"""))
def _(i: Inputs):
    table, checkpoint = _paths(i, "stream-dedupe")
    rows = _shuffled_days(i).select("user_id", "event_type", half_hour_floor("ts").alias("hour_start_utc"), "ts", "event_id")
    runs.run_first_seen(i.spark, rows, table, checkpoint, ["user_id", "event_type", "hour_start_utc"], "ts", ["event_id"])
    return i.spark.read.parquet(table).select("user_id", "event_type", "hour_start_utc")


def _runs(i: Inputs, run, parts: int = 4) -> None:
    """Events as they would arrive: written and processed one stretch of time after the other, with a restart between."""
    path = shared_path(i.spark, "arrivals")
    rows = i.spark.read.parquet(f"{i.base}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "k", F.get_json_object("props", "$.k").cast("long")
    )
    low, high = rows.agg(F.unix_micros(F.min("ts")), F.unix_micros(F.max("ts"))).first()
    if low is None:
        low = high = 0
    at = F.least((F.unix_micros("ts") - low) * parts / (high - low + 1), F.lit(parts - 1)).cast("int")
    for n in range(parts):
        rows.where(at == n).write.parquet(f"{path}/part{n}")
        run(i.spark.readStream.schema(rows.schema).parquet(f"{path}/part*"))


# The greedy rule as a recursion: from each sent alert jump to the first instant six hours on. A send that
# failed counts as none.
def _muted(arrived: str) -> str:
    return f"""
    WITH RECURSIVE e AS (
        SELECT event_type, ts FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) WHERE {arrived}
    ), sent(alert_key, sent_at) AS (
        SELECT event_type, min(ts) FROM e GROUP BY 1
        UNION ALL
        SELECT s.alert_key, min(e.ts) FROM sent s JOIN e
          ON e.event_type = s.alert_key AND e.ts >= s.sent_at + INTERVAL 6 HOUR
        GROUP BY s.alert_key, s.sent_at)
    SELECT alert_key, sent_at FROM sent"""


@query("alert_throttle", _muted("true"))
def _(i: Inputs):
    return alerts.mute_repeats(i.table("events"), "event_type", "ts", CFG)


@query("stream_alert_throttle", _muted("k % 5 <> 0"))
def _(i: Inputs):
    table, checkpoint = _paths(i, "throttle")
    arrived = F.col("k") % 5 != 0
    _runs(i, lambda stream: alerts.run_muting(stream, "event_type", "ts", table, checkpoint, CFG, delivered=arrived))
    return read_table(i.spark, table).select("alert_key", "sent_at")


@query("stream_status_changes", using("ev", body="""
    SELECT alert_key, "at", previous, status FROM (
        SELECT alert_key, ts AS at, status,
               coalesce(last_value(CASE WHEN arrived THEN status END IGNORE NULLS) OVER before,
                        CASE WHEN bool_or(status = 'ok') OVER before THEN 'ok' END) AS previous
        FROM (SELECT CAST(user_id AS VARCHAR) AS alert_key, ts, ['ok', 'degraded', 'outage'][1 + k % 3] AS status,
                     k % 4 <> 0 AS arrived FROM ev)
        WINDOW before AS (PARTITION BY alert_key ORDER BY ts, status ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    WHERE (previous IS NULL AND status <> 'ok') OR previous <> status"""))
def _(i: Inputs):
    table, checkpoint = _paths(i, "announce")
    names = F.array(F.lit("ok"), F.lit("degraded"), F.lit("outage"))
    status = F.element_at(names, (F.col("k") % 3 + 1).cast("int"))

    def run(stream: DataFrame) -> None:
        rows = stream.select(F.col("user_id").alias("source"), "ts", status.alias("status"), (F.col("k") % 4 != 0).alias("arrived"))
        alerts.run_announcing(rows, "source", "ts", "status", table, checkpoint, delivered=F.col("arrived"))

    _runs(i, run)
    return read_table(i.spark, table).select("alert_key", "at", "previous", "status")
