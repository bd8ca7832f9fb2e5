"""Pick one row per key.

``row_number() = 1`` lets Spark place a group limit *before* the shuffle: each map task forwards at
most one row per key, so a key holding a large share of all rows never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_wins(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row per key in the given order (end the order with a unique tie-break)."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def newest(df: DataFrame, keys: Sequence[str], ts: str, *ties: Column) -> DataFrame:
    return latest_wins(df, keys, F.col(ts).desc_nulls_last(), *ties)


def arg_max(df: DataFrame, keys: Sequence[str], by: Column, **values: Column) -> DataFrame:
    """Per key, the values carried by the row where ``by`` is largest (null orders are ignored)."""
    return df.groupBy(*keys).agg(*[F.max_by(v, by).alias(name) for name, v in values.items()])


def first_last_seen(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """First and last sighting per key with one non-null value (the newest one)."""
    return df.groupBy(*keys).agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(ts))).alias(value),
        F.min(ts).alias("first_seen"),
        F.max(ts).alias("last_seen"),
    )


def as_of_runs(df: DataFrame, keys: Sequence[str], issued: str, cutoff: Column, *ties: Column) -> DataFrame:
    """As-of: the newest run per key among those issued at or before the cutoff."""
    return newest(df.filter(F.col(issued) <= cutoff), keys, issued, *ties)


def asof_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, values: Sequence[str],
    ties: Sequence[str] = (), bucket: int = 86_400,
) -> DataFrame:
    """Every left row with the ``values`` of the newest right row of its key at or before its own time (null: none).

    Of right rows at one time the greatest by ``ties`` counts. Both sides meet in buckets of ``bucket`` seconds: within a bucket
    the last right row is carried on by a window, and between buckets one row each, so a task holds a key's rows of one
    bucket, never a key. Left rows without a key or time stay, with nulls; such right rows say nothing. Names of
    ``values`` must not be columns of the left side.
    """
    keys, micros = list(keys), bucket * 1_000_000
    place = lambda ts: F.unix_micros(F.col(ts).cast("timestamp"))
    order = F.struct(F.lit(0).alias("side"), *[F.col(c) for c in ties])
    said = F.struct(*[F.col(c) for c in values])
    known = right.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, right_ts]))
    runs = known.select(*keys, place(right_ts).alias("_t"), order.alias("_order"), said.alias("_said"))
    runs = runs.withColumn("_bucket", F.floor(F.col("_t") / micros))
    timed = left.select(F.struct("*").alias("_row"), *keys, place(left_ts).alias("_t"))
    timed = timed.withColumn("_bucket", F.floor(F.col("_t") / micros))
    asks = timed.withColumn("_order", F.lit(None).cast(runs.schema["_order"].dataType))
    both = asks.unionByName(runs, allowMissingColumns=True)
    # at one moment right rows come first
    upto = Window.partitionBy(*keys, "_bucket").orderBy("_t", F.col("_row").isNotNull(), "_order")
    near = both.withColumn("_near", F.last("_said", True).over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    buckets = both.groupBy(*keys, "_bucket").agg(F.max_by("_said", F.when(F.col("_said").isNotNull(), F.struct("_t", "_order"))).alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.select(*keys, "_bucket", F.last("_end", True).over(earlier).alias("_before"))
    carried = carried.where(F.col("_before").isNotNull())
    found = near.where(F.col("_row").isNotNull()).join(carried, [*keys, "_bucket"], "left")
    timeless = F.col("_t").isNull()
    for k in keys:
        timeless = timeless | F.col(k).isNull()
    got = F.when(~timeless, F.coalesce("_near", "_before"))
    return found.select("_row", got.alias("_got")).select("_row.*", *[F.col(f"_got.`{c}`").alias(c) for c in values])
