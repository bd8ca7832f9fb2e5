"""Forecast tables, accuracy, baselines, skill, walk-forward folds and holdout."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.config import CONFIG, Config
from airlake.functions import aqi
from airlake.functions.numeric import fixed_avg
from airlake.functions.time import add, as_ts

KEY, HOUR = "location_id", "hour_start_utc"
BASELINES = ("persistence", "seasonal_naive", "cams_lagged")


def forecasts(predictions: DataFrame, stations: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """Every prediction with its station's area and indicative category; stale ones stay, flagged."""
    dims = stations.select(KEY, "zone_id", "city_id")
    return predictions.drop("zone_id").join(dims, KEY).select(
        KEY, "zone_id", "city_id", "horizon_h", "issue_time_utc", "target_hour_start_utc", "pm25_pred",
        aqi.category("pm25_pred", cfg).alias("predicted_aqi_category"),
        "input_age_hours", "is_stale_input", "last_valid_hour_utc", "model_version", "predicted_at",
    )


def forecast_accuracy(forecast_rows: DataFrame, aqi_rows: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """Forecasts whose target hour turned out valid, next to what was measured."""
    actual = aqi_rows.filter("is_valid").select(
        KEY, F.col(HOUR).alias("target_hour_start_utc"), F.col("pm25").alias("pm25_actual")
    )
    error = F.col("pm25_pred") - F.col("pm25_actual")
    truth = aqi.category("pm25_actual", cfg)
    return forecast_rows.join(actual, [KEY, "target_hour_start_utc"]).select(
        KEY, "zone_id", "horizon_h", "issue_time_utc", "target_hour_start_utc", "model_version",
        "is_stale_input", "pm25_pred", "pm25_actual",
        error.alias("error"), F.abs(error).alias("abs_error"),
        "predicted_aqi_category", truth.alias("actual_aqi_category"),
        (F.col("predicted_aqi_category") == truth).alias("category_correct"),
    )


def baseline(name: str) -> Column:
    """A naive forecast; each falls back to persistence where its own input is missing."""
    last = F.col("pm25_last_valid")
    if name == "persistence":
        return last
    if name == "seasonal_naive":
        return F.coalesce("pm25_same_hour_7d", last)
    if name == "cams_lagged":
        return F.coalesce("cams_pm25_lagged", last)
    raise ValueError(f"unknown baseline {name!r}")


def with_baselines(features: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Long form: one row per feature row and baseline (``method``, ``y_pred``)."""
    wide = features.select(*keep, *[baseline(b).alias(b) for b in BASELINES])
    return wide.unpivot(list(keep), list(BASELINES), "method", "y_pred")


def metric_columns(truth: str = "y_true", predicted: str = "y_pred", cfg: Config = CONFIG) -> list[Column]:
    """MAE, RMSE, bias, category accuracy and n as aggregates."""
    err = F.col(predicted) - F.col(truth)
    hit = aqi.indicative_category(truth, cfg) == aqi.indicative_category(predicted, cfg)
    return [
        fixed_avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        fixed_avg(err).alias("bias"),
        F.avg(hit.cast("double")).alias("category_accuracy"),
        F.count(F.lit(1)).alias("n"),
    ]


def metrics(df: DataFrame, by: Sequence[str], truth: str = "y_true", predicted: str = "y_pred") -> DataFrame:
    return df.groupBy(*by).agg(*metric_columns(truth, predicted))


def skill(model_mae: Column, base_mae: Column) -> Column:
    """Above 0 when the model beats the baseline."""
    return 1.0 - model_mae / base_mae


def skill_table(scored: DataFrame, by: Sequence[str], method: str = "method", against: str = "persistence") -> DataFrame:
    """MAE per method with its skill against one of the methods (conditional max, no self-join)."""
    per = scored.groupBy(*by, method).agg(*metric_columns())
    base = F.max(F.when(F.col(method) == against, F.col("mae"))).over(Window.partitionBy(*by))
    return per.withColumn("skill", skill(F.col("mae"), base))


def accuracy_windows(accuracy: DataFrame, as_of: Column | datetime, cfg: Config = CONFIG) -> DataFrame:
    """Per horizon and trailing window: each row counts once in every window it falls in."""
    widest = max(cfg.accuracy_windows)
    now = as_ts(as_of)
    recent = accuracy.filter(
        F.col("target_hour_start_utc") >= now - F.expr(f"INTERVAL '{widest}' DAY")
    )
    days = F.explode(F.array(*[F.lit(d) for d in cfg.accuracy_windows]))
    fanned = recent.withColumn("window_days", days).filter(
        F.col("target_hour_start_utc") >= add(now, "DAY", -F.col("window_days"))
    )
    return fanned.groupBy("horizon_h", "window_days").agg(
        F.count(F.lit(1)).alias("n"),
        fixed_avg("abs_error").alias("mae"),
        fixed_avg("error").alias("bias"),
        F.avg(F.col("category_correct").cast("double")).alias("category_accuracy"),
        F.count_if("is_stale_input").alias("n_stale_inputs"),
    )


def monthly_folds(
    df: DataFrame, min_train_months: int = CONFIG.min_train_months,
    issue: str = "issue_time_utc", target: str = "target_hour_start_utc",
) -> DataFrame:
    """Fold list: test month, training cutoff, rows on both sides (empty folds left out).

    Counted from one pre-aggregate per (issue month, month the label ends in): training rows of a
    fold are the labels that end at or before its start, which purges the boundary.
    """
    start_of = F.trunc(F.col(issue).cast("date"), "month")
    ends = add(target, "HOUR", 1)
    # A label ending exactly at a month start still trains that month's fold.
    month_after = F.when(
        ends == F.date_trunc("month", ends), ends.cast("date")
    ).otherwise(F.add_months(F.trunc(ends.cast("date"), "month"), 1))
    tested = df.groupBy(start_of.alias("test_start")).agg(F.count(F.lit(1)).alias("test_rows"))
    ready = df.groupBy(month_after.alias("test_start")).agg(F.count(F.lit(1)).alias("_ready"))
    # One row per calendar month from here on, so a single running sum is small.
    months = tested.unionByName(ready, allowMissingColumns=True).groupBy("test_start").agg(
        F.max("test_rows").alias("test_rows"), F.max("_ready").alias("_ready")
    )
    upto = Window.orderBy("test_start").rowsBetween(Window.unboundedPreceding, 0)
    first = df.agg(F.add_months(F.trunc(F.min(issue).cast("date"), "month"), min_train_months)).scalar()
    folds = months.withColumn("train_rows", F.sum("_ready").over(upto)).filter(
        (F.col("test_start") >= first) & F.col("test_rows").isNotNull() & F.col("train_rows").isNotNull()
    )
    return folds.select(
        F.date_format("test_start", "yyyy-MM").alias("fold"),
        F.col("test_start").cast("timestamp").alias("test_start"),
        F.add_months("test_start", 1).cast("timestamp").alias("test_end"),
        "train_rows", "test_rows",
    )


def fold_train(df: DataFrame, test_start: datetime | Column, target: str = "target_hour_start_utc") -> DataFrame:
    return df.filter(add(target, "HOUR", 1) <= as_ts(test_start))


def fold_test(df: DataFrame, test_start: datetime | Column, test_end: datetime | Column, issue: str = "issue_time_utc") -> DataFrame:
    return df.filter((F.col(issue) >= as_ts(test_start)) & (F.col(issue) < as_ts(test_end)))


def fold_of(df: DataFrame, issue: str = "issue_time_utc") -> DataFrame:
    return df.withColumn("fold", F.date_format(issue, "yyyy-MM"))


def fold_pivot(per_fold: DataFrame, value: str = "mae", cfg: Config = CONFIG) -> DataFrame:
    """Fold rows, one column per horizon, gaps NULL."""
    wide = per_fold.groupBy("fold").pivot("horizon_h", list(cfg.horizons)).agg(F.max(value))
    return wide.withColumnsRenamed({str(h): f"h{h}" for h in cfg.horizons})


def holdout_start(df: DataFrame, cfg: Config = CONFIG, not_before: datetime | Column | None = None) -> Column:
    """Last label end minus the holdout length, but never before the production cutoff."""
    end = df.agg(F.max(add("target_hour_start_utc", "HOUR", 1))).scalar()
    start = end - F.expr(f"INTERVAL '{cfg.holdout_days}' DAY")
    return start if not_before is None else F.greatest(start, as_ts(not_before))


def holdout_split(
    df: DataFrame, cfg: Config = CONFIG, not_before: datetime | Column | None = None
) -> DataFrame:
    """Rows labelled ``train`` (label ends before the holdout) or ``holdout``; the rest is purged."""
    start = holdout_start(df, cfg, not_before)
    part = F.when(F.col("issue_time_utc") >= start, "holdout").when(
        add("target_hour_start_utc", "HOUR", 1) <= start, "train"
    )
    return df.withColumn("part", part).filter("part IS NOT NULL")
