"""Distribution distance between a reference and a current sample, without a global sort task.

Values are counted per feature first. Quantile cuts per feature split the distinct values into bins of about
``BIN_VALUES``; running counts are taken inside each bin and the bins' own running counts are added. No window ever
spans the values of a whole feature, however many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN_VALUES = 20_000
MIN_BINS, MAX_BINS = 16, 10_000
FEW_CUTS = 64
P_VALUE_LIMIT = 0.05
DISTANCE_LIMIT = 0.1


def long_form(df: DataFrame, columns: list[str], side: str) -> DataFrame:
    """(feature, value) rows; booleans count as 0/1 and non-numbers as missing."""
    return _values(df, columns, []).withColumn("side", F.lit(side))


def _values(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    values = df.select(*keep, *[F.expr(f"try_cast(cast({c} as string) as double)").alias(c)
                                if dict(df.dtypes)[c] == "string" else F.col(c).cast("double").alias(c)
                                for c in columns])
    return values.unpivot(keep, columns, "feature", "value").filter("value IS NOT NULL")


def _bin_of(cuts: Column, v: Column, n_cuts: int) -> Column:
    """How many of the ascending cuts lie below ``v``: by comparing with all of a few, by bisection of many."""
    if n_cuts <= FEW_CUTS:
        return F.size(F.filter(cuts, lambda q: q < v))
    steps = F.sequence(F.lit(1), F.lit(max(1, n_cuts.bit_length())))
    middle = lambda s: F.floor((s["lo"] + s["hi"]) / 2).cast("int")
    below = lambda s: F.get(cuts, middle(s)) < v
    halve = lambda s: F.struct(
        F.when((s["lo"] < s["hi"]) & below(s), middle(s) + 1).otherwise(s["lo"]).alias("lo"),
        F.when((s["lo"] < s["hi"]) & ~below(s), middle(s)).otherwise(s["hi"]).alias("hi"),
    )
    whole = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))
    return F.aggregate(steps, whole, lambda s, _: halve(s), lambda s: s["lo"])


def _ks_p_value(lam2: Column) -> Column:
    """Asymptotic Kolmogorov survival function at the square of the scaled two-sample statistic."""
    sign = lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
        lambda total, k: total + sign(k) * F.exp(F.lit(-2.0) * k * k * lam2),
    )
    return F.when(lam2 < 0.04, 1.0).otherwise(F.greatest(F.least(2 * series, F.lit(1.0)), F.lit(0.0)))


def distances(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Per feature: sizes, KS statistic, Wasserstein distance, reference spread.

    Both inputs are (feature, value, side) rows from :func:`long_form`.
    """
    return distances_of_counts(counted(reference), counted(current))


def counted(rows: DataFrame) -> DataFrame:
    """(feature, value, n) of :func:`long_form` rows."""
    return rows.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def store_days(df: DataFrame, columns: list[str], day: str, path: str) -> None:
    """Exact value counts of the days in ``df``, one partition a day; days written again are replaced.

    Counts of several days add up, so a reference window is merged from its days and a new day costs one day's scan.
    """
    days = df.select(F.col(day).cast("date").alias("day"), *columns)
    rows = _values(days, columns, ["day"]).groupBy("day", "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    writer = rows.hint("rebalance", "day").write.mode("overwrite").partitionBy("day")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def merge_days(stored_days: DataFrame, days: Column) -> DataFrame:
    """(feature, value, n) over the days that meet the condition on ``day``."""
    return stored_days.where(days).groupBy("feature", "value").agg(F.sum("n").alias("n"))


def distances_of_counts(reference: DataFrame, current: DataFrame) -> DataFrame:
    """As :func:`distances`, from (feature, value, n) of each side."""
    side = lambda df, name, other: df.select("feature", F.col("value").alias("v"), F.col("n").alias(name), F.lit(0).cast("long").alias(other))
    both = side(reference, "r", "c").unionByName(side(current, "c", "r"))
    counts = both.groupBy("feature", "v").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    most = counts.groupBy("feature").count().agg(F.max("count")).first()[0] or 0  # one number
    n_bins = min(MAX_BINS, max(MIN_BINS, most // BIN_VALUES))
    cuts = counts.groupBy("feature").agg(
        F.percentile_approx("v", [i / n_bins for i in range(1, n_bins)], max(10000, 20 * n_bins)).alias("cuts")
    )
    # Proven bounds for both broadcasts: one row per feature (80 kB at MAX_BINS), and MAX_BINS rows per feature.
    binned = counts.join(F.broadcast(cuts), "feature").select(
        "feature", "v", "r", "c", _bin_of(F.col("cuts"), F.col("v"), n_bins).alias("bin")
    )
    by_bin = Window.partitionBy("feature").orderBy("bin")
    every = Window.partitionBy("feature")
    bins = (
        binned.groupBy("feature", "bin")
        .agg(F.sum("r").alias("br"), F.sum("c").alias("bc"), F.min("v").alias("bin_min"))
        .select(
            "feature", "bin",
            (F.sum("br").over(by_bin) - F.col("br")).alias("r_before"),
            (F.sum("bc").over(by_bin) - F.col("bc")).alias("c_before"),
            F.lead("bin_min").over(by_bin).alias("next_min"),
            F.sum("br").over(every).alias("n_reference"),
            F.sum("bc").over(every).alias("n_current"),
        )
    )
    inside = Window.partitionBy("feature", "bin").orderBy("v")
    steps = binned.join(F.broadcast(bins), ["feature", "bin"]).select(
        "feature", "n_reference", "n_current", "v", "r",
        (F.col("r_before") + F.sum("r").over(inside)).alias("r_upto"),
        (F.col("c_before") + F.sum("c").over(inside)).alias("c_upto"),
        F.coalesce(F.lead("v").over(inside), F.col("next_min"), F.col("v")).alias("next_v"),
    )
    gap = F.abs(
        F.col("r_upto") / F.nullif(F.col("n_reference"), F.lit(0))
        - F.col("c_upto") / F.nullif(F.col("n_current"), F.lit(0))
    )
    # centred on a value of the feature, so that large levels do not cancel
    near = F.col("v") - F.col("centre")
    centred = steps.join(F.broadcast(cuts.select("feature", F.get("cuts", F.lit(n_bins // 2 - 1)).alias("centre"))), "feature")
    mean = F.sum(near * F.col("r")) / F.sum("r")
    return centred.groupBy("feature", "n_reference", "n_current").agg(
        F.max(gap).alias("ks"),
        F.sum(gap * (F.col("next_v") - F.col("v"))).alias("wasserstein"),
        F.sqrt(F.greatest(F.sum(near * near * F.col("r")) / F.sum("r") - mean * mean, F.lit(0.0))).alias("reference_std"),
    )


METHODS = {"ks": "K-S p_value", "wasserstein": "Wasserstein distance (normed)"}


def verdicts(reference: DataFrame, current: DataFrame, method: str = "wasserstein") -> DataFrame:
    """One row per feature: both statistics, and the verdict of the chosen one whatever the number of rows.

    A p-value (``ks``) drifts when small, a distance (``wasserstein``) when large.
    """
    return verdicts_of(distances(reference, current), method)


def verdicts_of(measured: DataFrame, method: str = "wasserstein") -> DataFrame:
    """:func:`verdicts` from measured distances."""
    if method not in METHODS:
        raise ValueError(f"method is one of {sorted(METHODS)}")
    n, m = F.col("n_reference"), F.col("n_current")
    p_value = _ks_p_value(F.col("ks") * F.col("ks") * n * m / (n + m))
    normed = F.col("wasserstein") / F.greatest(F.col("reference_std"), F.lit(0.001))
    drifted = p_value < P_VALUE_LIMIT if method == "ks" else normed > DISTANCE_LIMIT
    return measured.select(
        "feature", F.lit(METHODS[method]).alias("method"),
        F.round(p_value if method == "ks" else normed, 4).alias("value"), drifted.alias("drifted"),
        F.round(p_value, 4).alias("ks_p_value"), F.round(normed, 4).alias("wasserstein_normed"),
        "n_reference", "n_current",
    )
