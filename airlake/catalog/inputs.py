"""The given tables read as sensor data: readings, stations, detections, weather, predictions.

Every frame here is derived from whole tables; nothing is filtered away or capped.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.config import CONFIG
from airlake.functions.numeric import half_up
from airlake.functions.time import add, half_hour_floor, hour_floor, whole
from airlake.operators.dedupe import latest_wins, newest
from airlake.operators.timegrid import civil_dates
from airlake.plans import features, fires, hourly
from airlake.plans.staging import out_of_range
from airlake.session import shared_path, use_utc
from airlake.sources.tables import rebuild

STATIONS = 8
_KEPT = "kept-events"
CFG = replace(CONFIG, pm25_min=1.0, pm25_max=300.0, city_id="c0")


class Inputs:
    """Lazily derived frames over one dataset directory."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = use_utc(spark), base
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A given table, listed once per query."""
        if name not in self._tables:
            df = self.spark.read.parquet(f"{self.base}/{name}.parquet")
            zoneless = [c for c, t in df.dtypes if t == "timestamp_ntz"]
            self._tables[name] = (
                df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df
            )
        return self._tables[name]

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """A gold table several steps read: written once below the shared folder, then read back."""
        if name not in self._tables:
            path = rebuild(df, shared_path(self.spark, name), "1")
            self._tables[name] = self.spark.read.schema(df.schema).parquet(path)
        return self._tables[name]

    # --- readings and stations ----------------------------------------------------------------

    def events(self) -> DataFrame:
        if _KEPT in self._tables:
            return self._tables[_KEPT]
        return self.table("events").select(
            "event_id", "ts", "user_id", "event_type", "value",
            F.get_json_object("props", "$.k").cast("long").alias("k"),
            (F.col("user_id") % STATIONS).alias("location_id"),
        ).withColumn("zone_id", zone_of("location_id"))

    def keep_events(self) -> None:
        """For plans that scan the events many times: parsed once, into files of even size, however few splits the given files have."""
        self.stored(self.events().hint("rebalance"), _KEPT)

    def as_of(self) -> Column:
        return self.table("events").agg(F.max("ts")).scalar()

    def readings(self, key: str = "location_id") -> DataFrame:
        """Every raw reading, several per station hour."""
        return self.events().select(
            F.col(key).alias("location_id"),
            half_hour_floor("ts").alias("hour_start_utc"),
            F.col("value").alias("pm25"),
            (F.col("k") + 40.0).alias("percent_complete"),
            F.col("k").alias("observed_count"),
            F.col("ts").alias("fetched_at"),
            F.col("event_type").alias("source"),
            "event_id",
        )

    def staged(self, key: str = "location_id") -> DataFrame:
        kept = newest(
            self.readings(key), ["location_id", "hour_start_utc"], "fetched_at", F.col("event_id").desc()
        )
        return kept.drop("event_id", "fetched_at").withColumn("is_out_of_range", out_of_range("pm25", CFG))

    def grid(self, key: str = "location_id") -> DataFrame:
        return hourly.station_hourly(self.staged(key), self.as_of(), CFG)

    def stations(self, key: str = "location_id") -> DataFrame:
        ids = self.events().select(F.col(key).alias("location_id")).distinct()
        i = F.col("location_id")
        return ids.select(
            "location_id",
            F.concat(F.lit("Station "), i.cast("string")).alias("station_name"),
            F.lit("CPCB").alias("agency"),
            F.lit("caaqm").alias("provider"),
            (F.lit(28.4) + (i * 37) % 100 / 200).alias("latitude"),
            (F.lit(77.0) + (i * 53) % 100 / 200).alias("longitude"),
            (i + 1000).alias("pm25_sensor_id"),
            F.lit("c0").alias("city_id"),
            zone_of("location_id").alias("zone_id"),
            F.when(i % 8 == 7, i - 4).alias("colocated_with"),
        )

    def zones(self) -> DataFrame:
        return self.stations().groupBy("zone_id").agg(F.max("city_id").alias("city_id")).select(
            "zone_id", F.concat(F.lit("Zone "), "zone_id").alias("zone_name"), "city_id"
        )

    def aqi(self) -> DataFrame:
        return hourly.aqi_hourly(self.grid(), self.stations(), CFG)

    def gold_aqi(self) -> DataFrame:
        return self.stored(self.aqi(), "aqi_hourly")

    def latest(self) -> DataFrame:
        """Latest readings per user, each user taken as a station with two kinds of sensors."""
        return self.events().select(
            F.col("user_id").alias("location_id"),
            F.when(F.col("k") % 3 == 0, "pm10").otherwise("pm25").alias("parameter"),
            F.col("ts").alias("reading_utc"),
            "value",
            F.col("ts").alias("last_fetched_at"),
        )

    # --- calendar -----------------------------------------------------------------------------

    def dates(self) -> DataFrame:
        bounds = self.table("events").agg(
            F.min("ts").cast("date").alias("first_date"),
            F.date_add(F.max("ts").cast("date"), 4).alias("last_date"),
        )
        first = self.table("events").agg(F.min("ts").cast("date")).scalar()
        festivals = self.table("region").select(
            F.date_add(first, F.col("r_regionkey") * 7).alias("date"), F.col("r_name").alias("name")
        )
        return civil_dates(bounds, festivals)

    # --- detections ---------------------------------------------------------------------------

    def order_fires(self) -> DataFrame:
        """Orders as detections over several years."""
        o, c = F.col("o_orderkey"), F.col("o_custkey")
        return self.table("orders").select(
            F.when(o % 2 == 0, "VIIRS_SNPP").otherwise("VIIRS_NOAA20").alias("sensor"),
            F.when(F.col("o_orderstatus") == "F", "SP").otherwise("NRT").alias("product"),
            add(add("o_orderdate", "HOUR", o % 24), "MINUTE", c % 60).alias("acquired_at_utc"),
            F.col("o_orderdate").cast("date").alias("acq_date"),
            (F.lit(27.5) + c % 510 / 100).alias("latitude"),
            (F.lit(73.8) + o % 470 / 100).alias("longitude"),
            (F.col("o_totalprice") / 1000).alias("frp_mw"),
            F.when(F.col("o_orderpriority").startswith("1"), "h")
            .when(F.col("o_orderpriority").startswith("5"), "l")
            .otherwise("n")
            .alias("confidence"),
            F.when(o % 3 == 0, "N").otherwise("D").alias("daynight"),
            o.alias("order_id"),
        )

    def event_fires(self) -> DataFrame:
        """Events as detections, for dataflows that combine detections with readings."""
        e, k = F.col("event_id"), F.col("k")
        return self.events().select(
            F.when(e % 2 == 0, "VIIRS_SNPP").otherwise("VIIRS_NOAA20").alias("sensor"),
            F.when(F.col("event_type") == "error", "NRT").otherwise("SP").alias("product"),
            F.col("ts").alias("acquired_at_utc"),
            F.col("ts").cast("date").alias("acq_date"),
            (F.lit(27.5) + (F.col("user_id") * 13) % 510 / 100).alias("latitude"),
            (F.lit(73.8) + e % 470 / 100).alias("longitude"),
            F.col("value").alias("frp_mw"),
            F.when(k < 20, "l").when(k > 80, "h").otherwise("n").alias("confidence"),
            F.lit("D").alias("daynight"),
        )

    # --- weather and regional model -------------------------------------------------------------

    def actuals(self) -> DataFrame:
        return self.events().groupBy(F.col("zone_id").alias("point_id"), hour_floor("ts").alias("time_utc")).agg(
            F.max("value").alias("temperature_2m"),
            F.max("k").cast("double").alias("relative_humidity_2m"),
            F.min("value").alias("wind_speed_10m"),
            (F.sum("k") * 7 % 360).cast("double").alias("wind_direction_10m"),
            (F.count(F.lit(1)) * 100).cast("double").alias("boundary_layer_height"),
        )

    def weather_forecasts(self) -> DataFrame:
        rows = self.events().select(
            F.col("zone_id").alias("point_id"),
            hour_floor("ts").alias("issued_at"),
            add(hour_floor("ts"), "HOUR", F.col("event_id") % 48).alias("valid_time_utc"),
            F.col("value").alias("temperature_2m"),
            F.col("k").cast("double").alias("relative_humidity_2m"),
            (F.col("value") / 10).alias("wind_speed_10m"),
            (F.col("k") * 7 % 360).cast("double").alias("wind_direction_10m"),
            (F.col("k") * 10).cast("double").alias("boundary_layer_height"),
            "event_id",
        )
        return latest_wins(rows, ["point_id", "issued_at", "valid_time_utc"], F.col("event_id").desc())

    def previous_runs(self) -> DataFrame:
        rows = self.events().select(
            F.col("zone_id").alias("point_id"),
            hour_floor("ts").alias("time_utc"),
            (1 + F.col("event_id") % 4).cast("int").alias("days_before"),
            F.col("value").alias("temperature_2m"),
            F.col("k").cast("double").alias("relative_humidity_2m"),
            (F.col("value") / 10).alias("wind_speed_10m"),
            (F.col("k") * 7 % 360).cast("double").alias("wind_direction_10m"),
            (F.col("k") / 100).alias("precipitation"),
            (F.col("k") + 1000.0).alias("surface_pressure"),
            "event_id",
        )
        return latest_wins(rows, ["point_id", "time_utc", "days_before"], F.col("event_id").desc())

    def cams_history(self) -> DataFrame:
        """All hours; those of odd event counts have no value, so that the forecast fallback has gaps to fill."""
        hours = self.events().groupBy(
            F.col("zone_id").alias("point_id"), hour_floor("ts").alias("time_utc")
        ).agg(F.max("value").alias("cams_pm25"), F.count(F.lit(1)).alias("n"))
        return hours.select("point_id", "time_utc", F.when(F.col("n") % 2 == 0, F.col("cams_pm25")).alias("cams_pm25"))

    def cams_forecasts(self) -> DataFrame:
        return self.weather_forecasts().select(
            "point_id", "issued_at", "valid_time_utc", (F.col("temperature_2m") * 2).alias("cams_pm25")
        )

    # --- features and predictions ---------------------------------------------------------------

    def features(self, mode: str) -> DataFrame:
        self.keep_events()
        aqi_rows = self.gold_aqi()
        zone_rows, city_rows = hourly.area_hourly(aqi_rows, "zone_id"), hourly.area_hourly(aqi_rows, "city_id")
        # one row a sector and hour, read several times
        rolled = self.stored(fires.rolling(fires.locate(self.event_fires(), CFG), self.as_of(), CFG), "rolled-fires")
        if mode == "train":
            weather, cams = features.observed_weather(self.actuals()), self.cams_history()
        else:
            issue = add(aqi_rows.agg(F.max("hour_start_utc")).scalar(), "HOUR", 1)
            weather = features.newest_forecast(self.weather_forecasts(), issue)
            cams = features.cams_with_fallback(self.cams_history(), self.cams_forecasts(), issue)
        context = features.zone_context(
            zone_rows, city_rows, self.zones(), weather, cams, rolled, self.previous_runs(), CFG
        )
        return features.build(mode, aqi_rows, context, self.dates(), CFG)

    def issue_rows(self) -> DataFrame:
        """Station history and target per (station, issue, horizon), without weather context."""
        rows = self.gold_aqi().filter("NOT is_colocated_duplicate").withColumns(
            {
                c: F.lit(None).cast("double")
                for c in ("zone_pm25_median", "city_pm25_median", "city_pm25_24h_median")
            }
        )
        w = features.station_windows(rows, "train", CFG)
        per = F.array(
            *[
                F.struct(F.lit(h).alias("horizon_h"), F.col(f"_target_{h}").alias("target_pm25"))
                for h in CFG.horizons
            ]
        )
        return w.filter((F.hour("hour_start_utc") % 3 == 0) & (F.col("valid_hours_24h") >= 6)).select(
            "location_id", "zone_id", "city_id", "hour_start_utc", "pm25_last_valid", "pm25_same_hour_7d",
            "last_valid_hour_utc", F.inline(per),
        ).select(
            "*",
            add("hour_start_utc", "HOUR", 1).alias("issue_time_utc"),
            add("hour_start_utc", "HOUR", F.col("horizon_h")).alias("target_hour_start_utc"),
            F.lit(None).cast("double").alias("cams_pm25_lagged"),
        )

    def predictions(self) -> DataFrame:
        age = whole("HOUR", "last_valid_hour_utc", "hour_start_utc")
        return self.issue_rows().select(
            "location_id", "zone_id", "horizon_h", "issue_time_utc", "target_hour_start_utc",
            half_up(F.col("pm25_last_valid") * 0.9 + 5, 1).alias("pm25_pred"),
            age.cast("int").alias("input_age_hours"),
            (age > CFG.live_max_hours).alias("is_stale_input"),
            "last_valid_hour_utc",
            F.lit("v1").alias("model_version"),
            F.col("issue_time_utc").alias("predicted_at"),
        )


def zone_of(key: str) -> Column:
    return F.concat(F.lit("z"), (F.col(key) % 3).cast("string"))


def finish(df: DataFrame) -> DataFrame:
    """Results in the widest plain types: bigint, double, zone-less timestamps, dates as text."""

    def plain(name: str, kind: str) -> Column:
        if kind in ("int", "smallint", "tinyint"):
            return F.col(name).cast("long").alias(name)
        if kind in ("float",) or kind.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        if kind == "timestamp":
            return F.col(name).cast("timestamp_ntz").alias(name)
        if kind == "date":
            return F.col(name).cast("string").alias(name)
        return F.col(name)

    return df.select(*[plain(c, t) for c, t in df.dtypes])
