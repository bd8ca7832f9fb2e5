"""Access-log parsing and the request cost report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.functions.text import TIER1_USD, TIER2_USD, log_area, log_fields, price_tier

TOP_OPS = 8
TOP_AREAS = 10


def parse(lines: DataFrame, column: str = "value") -> DataFrame:
    """Log lines -> time, op, key, uri, tier, area; lines of another shape are dropped."""
    rows = lines.select(log_fields(column).alias("e")).where("e IS NOT NULL").select("e.*")
    return rows.select("*", price_tier("op").alias("tier"), log_area("op", "key", "uri").alias("area"))


def totals(entries: DataFrame) -> DataFrame:
    tier1 = F.count_if(F.col("tier") == 1)
    n = F.count(F.lit(1))
    return entries.agg(
        n.alias("requests"), tier1.alias("tier1"), (n - tier1).alias("tier2"),
        (tier1 * TIER1_USD + (n - tier1) * TIER2_USD).alias("cost_usd"),
    )


def top_counts(df: DataFrame, by: str, k: int) -> DataFrame:
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), by).limit(k)


def report(entries: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(totals, top operations, top areas of the expensive tier)."""
    return (
        totals(entries),
        top_counts(entries, "op", TOP_OPS),
        top_counts(entries.filter("tier = 1"), "area", TOP_AREAS),
    )
