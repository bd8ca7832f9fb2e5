"""Exact medians, in two forms.

``F.median`` keeps the distinct values of a group in one aggregation buffer: right for groups bounded by
a dimension (stations of a zone). ``median_of_large_groups`` is for groups with no such bound: values are
counted first (combined map-side), a running count over at most ``range / bin_width`` bins per group finds
where the middle lies, and only the one or two middle bins are looked at value by value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def median_of_large_groups(
    df: DataFrame, keys: Sequence[str], value: str, out: str = "median", bin_width: float = 1.0
) -> DataFrame:
    keys = list(keys)
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bin", F.floor(F.col("_v") / bin_width))
    )
    by_bin = Window.partitionBy(*keys).orderBy("_bin")
    bins = (
        counts.groupBy(*keys, "_bin")
        .agg(F.sum("_n").alias("_bin_n"))
        .select(
            *keys,
            "_bin",
            (F.sum("_bin_n").over(by_bin) - F.col("_bin_n")).alias("_before"),
            "_bin_n",
            F.sum("_bin_n").over(Window.partitionBy(*keys)).alias("_total"),
        )
        .withColumn("_lo", F.floor((F.col("_total") + 1) / 2))
        .withColumn("_hi", F.floor(F.col("_total") / 2) + 1)
        .filter("_before < _hi AND _before + _bin_n >= _lo")
    )
    in_bin = Window.partitionBy(*keys, "_bin").orderBy("_v")
    ranked = counts.join(bins, [*keys, "_bin"]).withColumn(
        "_upto", F.col("_before") + F.sum("_n").over(in_bin)
    )

    def at(rank: str):
        r = F.col(rank)
        return F.max(F.when((F.col("_upto") >= r) & (F.col("_upto") - F.col("_n") < r), F.col("_v")))

    middle = at("_lo") + at("_hi")
    return ranked.groupBy(*keys).agg((middle / 2).alias(out))
