"""Wide/long reshaping, circular neighbours, preference by availability."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.operators.dedupe import latest_wins


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name="series", value="value") -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def previous_runs_to_rows(
    df: DataFrame, ids: Sequence[str], variables: Sequence[str], days: Sequence[int] = (1, 2, 3, 4)
) -> DataFrame:
    """``<variable>_previous_dayN`` columns to one row per ``days_before``, in a single pass."""
    runs = F.array(
        *[
            F.struct(
                F.lit(n).alias("days_before"),
                *[F.col(f"{v}_previous_day{n}").alias(v) for v in variables],
            )
            for n in days
        ]
    )
    return df.select(*ids, F.inline(runs))


def with_neighbours(df: DataFrame, index: str, out: str, size: int = 8) -> DataFrame:
    """Each row once per ring position it is adjacent to (itself and both neighbours)."""
    i = F.col(index)
    return df.withColumn(out, F.explode(F.array(i, (i + 1) % size, (i + size - 1) % size)))


def prefer_available(wanted: DataFrame, offers: DataFrame, keys: Sequence[str], day: str, rank: str) -> DataFrame:
    """Per wanted row, the best-ranked offer whose [min_date, max_date] covers the day.

    Offers are joined on their equality keys, so the range test runs only within one key.
    """
    keys = list(keys)
    covered = wanted.join(offers, keys).filter(F.col(day).between(F.col("min_date"), F.col("max_date")))
    best = latest_wins(covered, [*keys, day], F.col(rank).asc())
    return wanted.join(best.drop("min_date", "max_date"), [*keys, day], "left")
