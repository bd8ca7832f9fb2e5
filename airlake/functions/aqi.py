"""AQI category and sub-index from PM2.5: as a CASE chain over the configured bands, or by a table of breakpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.config import CONFIG, Config
from airlake.functions.time import col
from airlake.operators.bands import join_bands


def _band_value(c: Column, pick, cfg: Config) -> Column:
    """First band whose [low, high] holds ``c``; NULL outside every band and for NULL."""
    out = None
    for band in cfg.bands:
        low, high = band[2], band[3]
        inside = (c >= low) if high is None else c.between(low, high)
        value = pick(band, c)
        out = F.when(inside, value) if out is None else out.when(inside, value)
    return out


def category(pm25: Column | str, cfg: Config = CONFIG) -> Column:
    """Category of the value rounded half up."""
    return _band_value(F.round(col(pm25)), lambda b, _: F.lit(b[0]), cfg)


def category_order(pm25: Column | str, cfg: Config = CONFIG) -> Column:
    return _band_value(F.round(col(pm25)), lambda b, _: F.lit(b[1]), cfg)


def subindex(pm25: Column | str, cfg: Config = CONFIG) -> Column:
    """Linear interpolation inside the band; NULL in the open-ended top band."""

    def interpolate(band, c):
        _, _, low, high, aqi_low, aqi_high = band
        if high is None:
            return F.lit(None).cast("int")
        return F.round(aqi_low + (aqi_high - aqi_low) * (c - low) / (high - low)).cast("int")

    return _band_value(F.round(col(pm25)), interpolate, cfg)


def indicative_category(pm25: Column | str, cfg: Config = CONFIG) -> Column:
    """Category for forecasts and scoring: half-even rounding, upper bounds only (so values
    below zero count as the first band)."""
    v = F.bround(col(pm25))
    out = None
    for band in cfg.bands:
        if band[3] is None:
            break
        out = (
            F.when(v <= band[3], band[0]) if out is None else out.when(v <= band[3], band[0])
        )
    return out.when(v.isNotNull(), F.lit(cfg.bands[-1][0]))


BREAKPOINTS = "category string, category_order int, pm25_low int, pm25_high int, aqi_low int, aqi_high int"


def breakpoints(spark: SparkSession, cfg: Config = CONFIG) -> DataFrame:
    """The configured bands as a table; any table with these columns does."""
    return spark.createDataFrame(list(cfg.bands), BREAKPOINTS)


def with_bands(df: DataFrame, pm25: str, table: DataFrame, category: str, order: str | None = None, subindex: str | None = None) -> DataFrame:
    """``df`` with the category, and if named the order and sub-index, of the band that holds the value rounded half up.

    The bands come from ``table`` (columns of :data:`BREAKPOINTS`, null pm25_high: open), so results follow its rows. A value in no
    band has nulls; one in several has a row for each.
    """
    names = [c.split()[0] for c in BREAKPOINTS.split(", ")]
    marked = table.select(*[F.col(c).alias(f"_{c}") for c in names])
    met = join_bands(df, F.round(pm25), marked, "_pm25_low", "_pm25_high")
    part = (F.round(pm25) - F.col("_pm25_low")) / (F.col("_pm25_high") - F.col("_pm25_low"))
    wanted = {category: F.col("_category")}
    if order:
        wanted[order] = F.col("_category_order")
    if subindex:
        wanted[subindex] = F.round(F.col("_aqi_low") + (F.col("_aqi_high") - F.col("_aqi_low")) * part).cast("int")
    return met.withColumns(wanted).drop(*marked.columns)
