"""Public snapshot: every dataset written to a fresh run, the manifest last, old runs pruned."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from airlake.functions.time import as_ts
from airlake.sources import files

KEEP_RUNS = 2
RECENT_DAYS = 30
FIRE_DAYS = 120


def columns_of(df: DataFrame) -> list[tuple[str, str]]:
    return df.dtypes


def export_projection(df: DataFrame) -> DataFrame:
    """Explicit columns with timestamps cut to milliseconds."""
    return df.select(
        *[
            F.date_trunc("millisecond", F.col(c)).alias(c) if t.startswith("timestamp") else F.col(c)
            for c, t in columns_of(df)
        ]
    )


def recent_by_data(df: DataFrame, ts: str, value: str, days: int = RECENT_DAYS) -> DataFrame:
    """Rows within ``days`` of the newest row that has a value (scalar subquery, no join)."""
    newest = df.filter(F.col(value).isNotNull()).agg(F.max(ts)).scalar()
    return df.filter(F.col(ts) >= newest - F.expr(f"INTERVAL '{days}' DAY"))


def recent_by_clock(df: DataFrame, ts: str, as_of: Column | datetime, days: int = RECENT_DAYS) -> DataFrame:
    return df.filter(F.col(ts) >= as_ts(as_of) - F.expr(f"INTERVAL '{days}' DAY"))


def latest_only(df: DataFrame, ts: str) -> DataFrame:
    return df.filter(F.col(ts) == df.agg(F.max(ts)).scalar())


def export_filters(tables: Mapping[str, DataFrame], as_of: Column | datetime) -> dict[str, DataFrame]:
    """The twelve published datasets from the gold tables."""
    t = tables
    return {
        "dim_station": t["dim_station"],
        "dim_zone": t["dim_zone"],
        "dim_city": t["dim_city"],
        "station_status": t["station_status"],
        "feed_status": recent_by_clock(t["feed_status"], "hour_start_utc", as_of),
        "aqi_hourly_recent": recent_by_data(t["aqi_hourly"], "hour_start_utc", "pm25"),
        "zone_hourly_recent": recent_by_data(t["zone_hourly"], "hour_start_utc", "pm25_median"),
        "city_hourly_recent": recent_by_data(t["city_hourly"], "hour_start_utc", "pm25_median"),
        "city_daily": t["city_daily"],
        "forecasts_latest": latest_only(t["forecasts"], "issue_time_utc"),
        "forecast_accuracy_recent": recent_by_clock(
            t["forecast_accuracy"], "target_hour_start_utc", as_of
        ),
        "fires_daily": t["fires_daily"].filter(
            F.col("acq_date") >= F.date_sub(as_ts(as_of).cast("date"), FIRE_DAYS)
        ),
    }


def export_snapshot(
    spark: SparkSession,
    datasets: Mapping[str, DataFrame],
    base: str,
    now: datetime,
    descriptions: Mapping[str, str] | None = None,
) -> dict:
    """Write all datasets, then the manifest, then prune. A failed write leaves the old manifest."""
    run = now.strftime("%Y%m%dT%H%M%SZ")
    manifest: dict = {"exported_at": now.strftime("%Y-%m-%dT%H:%M:%SZ"), "datasets": {}}
    for name, df in datasets.items():
        path = f"{base}/{name}/run={run}"
        export_projection(df).write.mode("overwrite").option("compression", "snappy").parquet(path)
        keys = [f for f in files.children(spark, path) if f.endswith(".parquet")]
        manifest["datasets"][name] = {
            "path": path,
            "keys": keys,
            "schema": df.schema.json(),
            "description": (descriptions or {}).get(name, ""),
        }
    files.write_text(spark, f"{base}/manifest.json", json.dumps(manifest, indent=2))
    for name in datasets:
        for old in files.children(spark, f"{base}/{name}")[:-KEEP_RUNS]:
            files.delete_tree(spark, f"{base}/{name}/{old}")
    return manifest


def read_snapshot(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Datasets named by the manifest; one without files comes back empty with its schema."""
    manifest = json.loads(files.read_text(spark, f"{base}/manifest.json"))
    out = {}
    for name, spec in manifest["datasets"].items():
        schema = StructType.fromJson(json.loads(spec["schema"]))
        paths = [f"{spec['path']}/{k}" for k in spec["keys"]]
        out[name] = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return out
