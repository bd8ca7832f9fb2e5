"""Data-quality checks. Each returns the offending rows; an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.functions.time import whole


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def orphans(df: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key has no parent (NULL keys are not orphans)."""
    known = df.filter(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    return known.join(parent.select(*keys), list(keys), "left_anti")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(~F.col(column).isin(*values))


def accepted_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    c = F.col(column)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    return df.filter(bad)


def expression_holds(df: DataFrame, condition: Column) -> DataFrame:
    """Rows where the condition is false (unknown passes)."""
    return df.filter(~condition)


def starts_on_half_hour(df: DataFrame, column: str) -> DataFrame:
    return df.filter((F.minute(column) != 30) | (F.second(column) != 0))


def one_product_per_day(df: DataFrame) -> DataFrame:
    """(day, sensor) pairs that still mix products. Min/max instead of a distinct count."""
    return (
        df.groupBy("acq_date", "sensor")
        .agg(F.min("product").alias("_lo"), F.max("product").alias("_hi"))
        .filter("_lo <> _hi")
        .select("acq_date", "sensor")
    )


def leaks(features: DataFrame) -> DataFrame:
    """Feature rows that used an input newer than their issue time, or a misplaced target."""
    audits = [c for c in features.columns if c.startswith("audit_")]
    issue = F.col("issue_time_utc")
    late = F.lit(False)
    for c in audits:
        late = late | F.coalesce(F.col(c) > issue, F.lit(False))
    misplaced = (F.col("target_hour_start_utc") < issue) | (
        whole("HOUR", "issue_time_utc", "target_hour_start_utc") != F.col("horizon_h") - 1
    )
    return features.filter(late | misplaced)


def out_of_step(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys present on one side only (configuration kept in two places)."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    only_left = a.join(b, key, "left_anti").withColumn("missing_in", F.lit("right"))
    only_right = b.join(a, key, "left_anti").withColumn("missing_in", F.lit("left"))
    return only_left.unionByName(only_right)


def one_parent_each(membership: DataFrame, child: str, parent: str) -> DataFrame:
    """Children listed under no or several parents."""
    return (
        membership.groupBy(child)
        .agg(F.count(parent).alias("n_parents"))
        .filter("n_parents <> 1")
    )
