"""Order-independent arithmetic.

Floating-point sums depend on the order in which rows meet, which on a cluster changes with
partitioning and task retries. Sums over groups of any size are therefore decimals with twelve places (26 digits
before the point), and means one final division: the same rows always give the same bits. Sliding windows hold a few
hundred rows at most and stay with integer micro-units, which are several times faster there.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from airlake.functions.time import col

SCALE = 1_000_000


def micro(value: Column | str) -> Column:
    return F.rint(col(value) * SCALE).cast("long")


def from_micro(value: Column) -> Column:
    return value.cast("double") / SCALE


def exact(value: Column | str) -> Column:
    """A number as decimal, ready to be summed over any number of rows."""
    return col(value).cast("decimal(28,12)")


def fixed_sum(value: Column | str, over: WindowSpec | None = None) -> Column:
    if over is None:
        return F.sum(exact(value)).cast("double")
    return from_micro(F.sum(micro(value)).over(over))


def fixed_avg(value: Column | str, over: WindowSpec | None = None) -> Column:
    """Mean of the non-null values, NULL when there are none."""
    if over is None:
        # scaled before the division, so that six-digit readings divide as whole numbers
        total, n = F.sum(exact(value)) * F.lit(SCALE), F.count(col(value))
    else:
        total, n = F.sum(micro(value)).over(over), F.count(col(value)).over(over)
    return total.cast("double") / F.nullif(n * SCALE, F.lit(0)).cast("double")


def half_up(value: Column | str, digits: int = 0) -> Column:
    """Round half away from zero, after snapping to 6 digits so float noise cannot flip a tie."""
    return F.round(F.round(col(value), 6), digits)
